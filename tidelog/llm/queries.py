"""One registered query for each operator, over whole tables, and SQL for those it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import bpe, decontaminate, hnsw, jaccard, lines, merkle, quality, secret_scan, sharding, substring, suffixes, vector_codes, voronoi
from tidelog.llm.common import table

SHARDS = 24
RANKS = "byte_bpe_multi_50k.tiktoken"


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring.dedup_substrings(table(spark, sf_dir, "documents"))
    return kept.select(
        F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = hnsw.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.select(
        F.col("id").alias("vec_id"),
        "n_links",
        F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"),
    )


def op3_shuffle_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    content = F.coalesce("text", F.lit(""))
    sized = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(content) + 8).cast("bigint").alias("size"),
        F.crc32(content).alias("text_crc32"),
    )
    return sharding.shuffle_into_shards(sized, SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    base = F.filter("spans", lambda s: s["kind"] != "entropy")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in secret_scan.KINDS],
        F.sha2(secret_scan.listed(base), 256).alias("base_sha256"),
        secret_scan.listed(F.col("spans")).alias("spans"),
    )


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffixes.dedup_suffixes(table(spark, sf_dir, "documents"))
    return kept.select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    scored = quality.classify(documents, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", *[F.round(c, 6).alias(c) for c in quality.OUTPUT[:4]], "rejected")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_lines", "n_lines_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = jaccard.similarity_join(table(spark, sf_dir, "documents"))
    return joined.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    encoded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), ranks, pattern)
    decoded = bpe.decode(encoded.select("doc_id", "ids"), ranks, pattern)
    return decoded.select(
        "doc_id",
        bpe.token_count("ids").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = voronoi.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = lambda n_chars: merkle.leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text"))
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    proved = merkle.manifest(
        table(spark, sf_dir, "documents"),
        leaf=digest(F.col("n_chars")),
        claimed=F.when(tampered, digest(F.col("n_chars").cast("decimal(20,0)") + 1)),
    )
    return proved.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    digest = F.lit(vector_codes.codebooks_sha256(books))
    return coded.select(F.col("id").alias("vec_id"), "code", "error", "label_error", digest.alias("codebooks_sha256"))


OP1_SQL = """
with split as (select doc_id, list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as words
    from documents),
windows as (select doc_id, pos, words[pos : pos + 12] as gram
    from (select doc_id, words, unnest(range(1, len(words) - 11)) as pos from split)),
hits as (select doc_id, pos from (select doc_id, pos, min(doc_id) over (partition by gram) as least from windows)
    where least < doc_id),
gone as (select distinct doc_id, pos + k as n from hits, (select unnest(range(13)) as k)),
marked as (select s.doc_id, s.word, n, g.n as gone_n
    from (select doc_id, unnest(words) as word, unnest(range(1, len(words) + 1)) as n from split) s
    left join gone g using (doc_id, n)),
kept as (select doc_id, count(*) as n_words, count(gone_n) as n_removed,
    string_agg(case when gone_n is null then word end, ' ' order by n) as kept from marked group by doc_id)
select doc_id, coalesce(n_words, 0) as n_words, coalesce(n_removed, 0) as n_removed,
    sha256(coalesce(kept, '')) as kept_sha256
from documents left join kept using (doc_id)
"""

OP4_SQL = """
with raw as (select doc_id, text, list_filter(regexp_split_to_array(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') as words from documents),
items as (select item_id, list_filter(regexp_split_to_array(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') as words from benchmark),
grams as (select distinct item_id, least(13, len(words)) as size,
        array_to_string(words[i : i + least(13, len(words)) - 1], ' ') as gram
    from (select item_id, words, unnest(range(1, greatest(2, len(words) - 11))) as i
          from items where len(words) > 0)),
places as (select doc_id, words, size, unnest(range(1, len(words) - size + 2)) as pos
    from raw, (select distinct size from grams)),
hits as (select doc_id, item_id, pos, size from
    (select doc_id, pos, size, array_to_string(words[pos : pos + size - 1], ' ') as gram from places)
    join grams using (gram, size)),
covered as (select doc_id, count(distinct pos + k) as n_hit
    from (select distinct doc_id, pos, size, unnest(range(size)) as k from hits) group by doc_id),
listed as (select doc_id, count(distinct item_id) as n_items,
        string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as items
    from hits group by doc_id)
select doc_id, coalesce(len(words), 0) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    sha256(coalesce(items, '')) as items_sha256,
    coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= coalesce(len(words), 0) as contaminated
from raw left join covered using (doc_id) left join listed using (doc_id)
"""

OP8_SQL = """
with split as (select doc_id, text, string_split(text, chr(10)) as lines from documents),
windows as (select doc_id, pos, [lines[pos], lines[pos + 1], lines[pos + 2]] as gram
    from (select doc_id, lines, unnest(range(1, len(lines) - 1)) as pos from split)),
later as (select doc_id, pos from (select doc_id, pos,
    row_number() over (partition by gram order by doc_id, pos) as nth from windows) where nth > 1),
gone as (select distinct doc_id, pos + k as n from later, (values (0), (1), (2)) as t(k)),
kept as (select doc_id, string_agg(line, chr(10) order by n) as text, count(gone_n) as dropped, count(*) as n_lines
    from (select s.doc_id, n, g.n as gone_n, case when g.n is null then line end as line
        from (select doc_id, unnest(lines) as line, unnest(range(1, len(lines) + 1)) as n from split) s
        left join gone g using (doc_id, n)) group by doc_id)
select d.doc_id, coalesce(n_lines, 0) as n_lines, coalesce(dropped, 0) as n_lines_removed,
    sha256(coalesce(k.text, '')) as kept_sha256
from documents d left join kept k using (doc_id)
"""

OP12_SQL = """
with recursive crc_table as (select list(list_reduce(list_prepend(i, range(8)),
        lambda a, k: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end) order by i) as crcs
    from range(256) as t(i)),
fields as (select row_number() over () as row, doc_id, lang, cast(n_chars as hugeint) as n_chars,
        xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(cast(doc_id as varchar), ''),
            lambda x: cast(ascii(x) as bigint))), lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1]))) % 7 = 0 as tampered,
        coalesce(strlen(cast(doc_id as varchar)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
            || coalesce(strlen(lang) || ':' || lang, '-') as front, coalesce(strlen(text) || ':' || text, '-') as back
    from documents, crc_table),
digests as (select row, doc_id, lang,
        sha256(front || coalesce(strlen(cast(n_chars as varchar)) || ':' || n_chars, '-') || back) as leaf,
        case when tampered then sha256(front || coalesce(strlen(cast(n_chars + 1 as varchar)) || ':' || (n_chars + 1), '-') || back)
            end as claimed
    from fields),
leaves as (select *, row_number() over (partition by lang order by doc_id nulls first, leaf, row) - 1 as idx,
        count(*) over (partition by lang) as n from digests),
nodes as (select 0 as level, lang, idx, n, leaf as digest from leaves
    union all
    select level + 1, lang, idx // 2, (n + 1) // 2, sha256(string_agg(digest, '' order by idx))
    from nodes where n > 1 group by level, lang, n, idx // 2),
subroots as (select lang, digest as subroot, row_number() over (order by lang nulls first) - 1 as idx, count(*) over () as n
    from nodes where n = 1),
upper_nodes as (select 0 as level, idx, n, subroot as digest from subroots
    union all
    select level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(digest, '' order by idx))
    from upper_nodes where n > 1 group by level, n, idx // 2),
walk as (select row, 0 as level, lang, idx, n, coalesce(claimed, leaf) as folded, '' as proof from leaves
    union all
    select w.row, w.level + 1, w.lang, w.idx // 2, (w.n + 1) // 2,
        sha256(case when w.idx % 2 = 1 then s.digest || w.folded else w.folded || coalesce(s.digest, '') end),
        w.proof || coalesce(s.digest, '')
    from walk w left join nodes s on s.level = w.level and s.lang is not distinct from w.lang and s.idx = xor(w.idx, 1)
    where w.n > 1),
upper_walk as (select w.row, 0 as level, r.idx, r.n, w.folded, w.proof
    from walk w join subroots r on r.lang is not distinct from w.lang where w.n = 1
    union all
    select w.row, w.level + 1, w.idx // 2, (w.n + 1) // 2,
        sha256(case when w.idx % 2 = 1 then s.digest || w.folded else w.folded || coalesce(s.digest, '') end),
        w.proof || coalesce(s.digest, '')
    from upper_walk w left join upper_nodes s on s.level = w.level and s.idx = xor(w.idx, 1)
    where w.n > 1)
select doc_id, leaf, subroot, u.digest as root, sha256(w.proof) as proof_sha256, w.folded as folded_root,
    w.folded = u.digest as verified
from leaves l join upper_walk w on w.row = l.row and w.n = 1 join upper_nodes u on u.n = 1
    join subroots r on r.lang is not distinct from l.lang
"""

#: Vectors of integers, of those whose components are all there and finite.
_KEPT_SQL = """
kept as (select row_number() over (order by vec_id) as row, vec_id, label,
        list_transform(embedding, lambda x: cast(floor({scale} * cast(x as double)) as bigint)) as v
    from embeddings where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding))
"""

OP11_SQL = f"""
with {_KEPT_SQL.format(scale=256)},
exact as (select row, vec_id, list_transform(v, lambda x: cast(x as double)) as v from kept),
scored as (select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score, q.row
    from exact q join exact c on q.row <> c.row where q.vec_id % 50 = 0)
select query_id, cast(rank as integer) as rank, vec_id, score
from (select *, row_number() over (partition by row order by score desc, vec_id) as rank from scored) where rank <= 5
"""


def _op13_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    near = """near{k} as materialized (select row, p, min({entries} * list_sum(list_transform(range(1, len(v) + 1),
        lambda i: (v[i] - word[i]) * (v[i] - word[i]))) + e) as best
    from cut join book{k} using (p) group by row, p)"""
    book = """book{n} as materialized (select b.p, b.e, coalesce(f.word, b.word) as word from book{k} b left join (
        select p, e, list((s - ((s % n) + n) % n) // n order by i) as word from (
            select p, best % {entries} as e, i, sum(v[i]) as s, count(*) as n
            from near{k} join cut using (row, p), (select unnest(range(1, (select max(len(v)) from cut) + 1)) as i)
            group by p, best % {entries}, i) group by p, e) f on f.p = b.p and f.e = b.e)"""
    steps = []
    for k in range(rounds):
        steps += [near.format(k=k, entries=entries), book.format(k=k, n=k + 1, entries=entries)]
    steps.append(near.format(k=rounds, entries=entries))
    return f"""
with {_KEPT_SQL.format(scale=4096)},
cut as materialized (select row, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] as v from kept, range({parts}) as t(p)),
book0 as materialized (select p, row - 1 as e, v as word from cut where row <= {entries}),
{", ".join(steps)},
coded as (select row, string_agg(printf('%02x', best % {entries}), '' order by p) as code,
    cast(sum(best // {entries}) as bigint) as error from near{rounds} group by row)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
    (select sha256(string_agg(array_to_string(word, ','), ',' order by p, e)) from book{rounds}) as codebooks_sha256
from coded join kept using (row)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_substring_dedup,
            op2_embedding_dedup,
            op3_shuffle_shards,
            op4_decontamination,
            op5_secret_scan,
            op6_suffix_dedup,
            op7_quality_classifier,
            op8_line_dedup,
            op9_jaccard_join,
            op10_byte_bpe,
            op11_top_k,
            op12_merkle_manifest,
            op13_vector_codes,
        )
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_substring_dedup": OP1_SQL,
        "op4_decontamination": OP4_SQL,
        "op8_line_dedup": OP8_SQL,
        "op11_top_k": OP11_SQL,
        "op12_merkle_manifest": OP12_SQL,
        "op13_vector_codes": _op13_sql(),
    }
