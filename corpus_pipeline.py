"""From raw documents to token ids: classify, drop repeated lines, join near copies, decontaminate, encode.

Each stage takes ``(spark, docs, sf_dir)`` and gives a DataFrame that is written and read
again as the next one's ``docs``; all but the last return the columns of ``documents``. Rows
with null ids pass every stage but the classifier's and the decontamination's verdicts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import bpe, decontaminate, jaccard, lines, quality
from tidelog.llm.common import staged, table, text_identity

RANKS = "byte_bpe_multi_50k.tiktoken"

#: The classifier is fitted on a sample and decides by floating-point scores: not for SQL.
ORACLE_SQL = None


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    scored = quality.classify(docs, table(spark, sf_dir, "labels"))
    return scored.where("not rejected").select(docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of repeated three-line windows; one that has no line left goes."""
    changed = F.col("n_lines_removed") > 0
    kept = lines.dedup_lines(docs).where(~changed | (F.col("n_lines_removed") < F.col("n_lines")))
    return kept.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars"))).select(docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies.

    Ids may repeat: documents are told apart by id and text, the first of a group in that order
    stays, and of its exactly repeated rows one (the least by its other columns).
    """
    key = ["doc_id", "t1", "t2"]
    groups = jaccard.similarity_join(docs, identity=True).where("id is not null and n_shingles > 0")
    marked = groups.groupBy(F.col("id").alias("doc_id"), "t1", "t2").agg(F.max("first").alias("first"), F.count(F.lit(1)).alias("n"))
    several = staged(marked.where("not first or n > 1"), "copies")
    known = text_identity("doc_id", "text")
    rows = docs.select("*", known["t1"].alias("t1"), known["t2"].alias("t2"))
    kept = rows.join(several, key, "left_anti").select(docs.columns)
    repeated = several.where("first")
    if repeated.isEmpty():
        return kept
    row = F.min(F.struct(*docs.columns)).alias("row")
    return kept.unionAll(rows.join(repeated, key, "left_semi").groupBy(*key).agg(row).select("row.*"))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no more than a trace of benchmark items."""
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return decontaminate.remove_documents(found).select(docs.columns)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, n_tokens, ids`` (packed), and whether the ids decode to the text."""
    import public_tokenizers

    ranks, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    rows = docs.select("doc_id", "lang", "source", "text")
    decoded = bpe.encode(rows, ranks, pattern, decoded="decoded")
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return decoded.select("doc_id", "lang", "source", bpe.token_count("ids").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES = [
    ("quality_classifier", classify),
    ("line_dedup", drop_lines),
    ("jaccard_join", one_of_each),
    ("decontamination", without_benchmark),
    ("byte_bpe", to_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
