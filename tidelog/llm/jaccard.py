"""Similarity join on word n-grams: rare-first prefixes, length, positional and suffix filters.

A text's set is its distinct shingles of ``size`` words (A-Z as a-z); a shorter text has its
whole word sequence as one, a text without words an empty set that links with nothing. Two
texts link when ``|A and B| * 100 >= percent * |A or B|``.

1. Blocks count their shingles and buckets add up (see ``blocks``): each text learns how
   common its shingles are, in classes of the logarithm.
2. A text's shingles are ordered rare-first. Two texts that link share one among their first
   ``n - ceil(percent * n / 100) + 1``: the *prefix*. Shingles of one text alone find no
   partner and only take up places. Texts of equal sets become one representative here.
3. Candidates are pairs with a common prefix shingle whose sizes (length filter) and places
   of that shingle (positional filter) leave room for enough overlap after it, as if it were
   the first that both have. For the first one that is right, and no later one leaves more
   room; so a pair passes at some shingle only if it does at its first, and the join
   keeps few of the many rows of a passage's shingles. A row that has no such room with the
   best of its group (or, of two, with the other) is left out before. What is left is compared by a
   histogram of hash classes (suffix filter), then set by set, once.
4. Groups around a common shingle may be large, so not all their pairs are made. Each group
   picks a *pivot* T, its most central member, and pairs with it are verified. Members that end
   up in one component need no further look; components are taken after the first pivots and at the end. A group with few pairs between components (a
   bounded number for each member) has them verified next. In any other group the members
   are *keyed anew by their difference* ``Dx`` from the pivot, the shingles that one of both
   has and the other has not. As ``x ^ y = Dx ^ Dy``, two members that link and that are not
   both linked with T must share a large part of their differences. So they meet in a
   rare-first prefix of these, and the new groups are treated in the same way until none is
   left. Here rare is what has a low count in a table of ``_SLOTS`` sums for each pivot, which any
   task can be given; so only the elements of prefixes become rows, not whole differences. Near copies with random edits share what the pivot lacks or has alone, which is
   common and comes last in that order; what is rare in their differences is their own.

   With ``f = (100 - percent) / (100 + percent)``, x and y link when ``|x ^ y| <= f (|x| + |y|)``,
   and ``|Dx & Dy| = (|Dx| + |Dy| - |x ^ y|) / 2``. If y does not link with T, ``|Dy| > f (|y| + |T|)``,
   so ``|Dx & Dy| > (|Dx| + f (|T| - |x|)) / 2``: the *strict* prefix of x leaves out as many, less one.
   If x links with T and y does not, that holds for x; for y there is ``|Dx & Dy| >= |Dy| - f (|x| + |y|)``
   with ``|x| <= 100 |y| / percent``: its *wide* prefix, which only meets those that link with T.

Shingles are told apart by 64 bits in the sets that decide on equality and on prefixes, and
by 48 bits inside the comparison of two sets. Null ids are after all others; rows of equal
ids are different texts. Other columns are not carried; join on the id, or where ids may
repeat on the id and the hashes of the text (``identity``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.joins import bounded
from tidelog.llm import blocks
from tidelog.llm.bytes_np import BYTE_VALUES, U64, Words, buffers, chunks, combined, give_back, is_space, lean, lowered, mix, prefix_sums, range_hashes
from tidelog.llm.common import merged, staged, text_identity
from tidelog.llm.components import components

COUNTS = "bucket int, block int, hashes binary, counts binary"
CLASSES = "block int, bucket int, at binary, classes binary"
SETS = "id bigint, n bigint, h1 bigint, h2 bigint, single int, prefix array<bigint>, shingles binary, histogram binary"
DIFFERENCES = (
    "base bigint, node bigint, n bigint, own double, component bigint, d bigint, single bigint, strict bigint, wide bigint, "
    "linked boolean, elements array<bigint>"
)
COMMON = "base bigint, slot smallint, count bigint"
PLACED = (
    "base bigint, shingle bigint, node bigint, n bigint, d bigint, own double, at bigint, component bigint, "
    "linked boolean, narrow boolean"
)
#: A group has its pairs between components verified if they are at most so many for each member.
PAIRS_PER_MEMBER = 64
#: Stands for what a pivot alone has in all the corpus; the last element of every difference.
_PIVOTS_OWN = -1
_BINS = 64
#: How common an element of differences is, is told by a sum for its low bits.
_SLOTS = 1024
#: Ids that are broadcast to find their rows at most: 8 MB.
_IDS = 1 << 20
#: Stored bytes for a task: entries that are joined with each other, candidates that are compared, other rows.
_ENTRIES, _CANDIDATES, _ROWS = 1 << 18, 1 << 16, 1 << 20


class _Sets:
    """Shingle sets of a block's texts: distinct hashes of each text, one text after the other."""

    def __init__(self, texts: pa.Table, size: int):
        raw, offsets = buffers(combined(texts["text"]))
        self.rows = len(texts)
        found, owners = [], []
        for a, b in chunks(offsets):
            part = lowered()[raw[offsets[a] : offsets[b]]]
            words = Words(part, offsets[a : b + 1] - offsets[a], is_space())
            sums = prefix_sums(words.hashes(part), 6)
            at = words.whole(size)
            count = np.diff(words.first)
            brief = np.flatnonzero((count > 0) & (count < size))
            hashes = np.concatenate(
                (range_hashes(sums, at, at + size, 6), range_hashes(sums, words.first[brief], words.first[brief + 1], 6))
            )
            owner = np.concatenate((words.row[at], brief)) + a
            order = np.lexsort((hashes, owner))
            hashes, owner = hashes[order], owner[order]
            fresh = np.ones(len(order), dtype=bool)
            fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
            found.append(hashes[fresh])
            owners.append(owner[fresh])
        self.hashes = np.concatenate(found) if found else np.zeros(0, U64)
        self.owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
        self.first = np.searchsorted(self.owner, np.arange(self.rows + 1))


class _Counted:
    """Distinct short hashes of a block in the order they are sent, with their counts."""

    def __init__(self, sets: _Sets, n: int):
        near = blocks.short(sets.hashes, n)
        self.values, self.inverse, self.counts = np.unique(near, return_inverse=True, return_counts=True)
        self.bucket = self.values >> np.uint64(32)


def _send(texts: pa.Table, size: int, n: int) -> pa.Table:
    own = _Counted(_Sets(texts, size), n)
    block = texts["block"][0].as_py()
    return blocks.frame(
        COUNTS,
        [
            (bucket, block, blocks.packed(own.values[s]), own.counts[s].astype("<u4").tobytes())
            for bucket, s in blocks.each(own.bucket)
        ],
    )


def _add_up(table: pa.Table) -> pa.Table:
    """For each block: which of its shingles several texts hold, and how many in logarithmic classes."""
    bucket = table["bucket"][0].as_py() if len(table) else 0
    hashes = [np.frombuffer(x, "<u4") for x in table["hashes"].to_pylist()]
    counts = np.concatenate([np.frombuffer(x, "<u4") for x in table["counts"].to_pylist()]).astype(np.int64)
    sizes = [len(x) for x in hashes]
    senders = table["block"].to_numpy()
    _, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
    total = np.bincount(inverse, weights=counts)[inverse]
    classes = np.minimum(255, 8 * np.log2(total)).astype(np.uint8)
    rows, begin = [], 0
    for block, count in zip(senders.tolist(), sizes, strict=True):
        several = np.flatnonzero(total[begin : begin + count] > 1)
        rows.append((block, bucket, several.astype("<u4").tobytes(), classes[begin + several].tobytes()))
        begin += count
    return blocks.frame(CLASSES, rows)


def _prefix_size(n: np.ndarray, percent: int) -> np.ndarray:
    return n - -(-n * percent // 100) + 1


def _describe(texts: pa.Table, answers: pa.Table, size: int, percent: int, n_buckets: int) -> pa.Table:
    """``SETS`` rows of a block; shingles only for one text of each set that has a shared prefix shingle."""
    sets = _Sets(texts, size)
    own = _Counted(sets, n_buckets)
    commonness = np.zeros(len(own.values), dtype=np.uint8)
    begins = {b: s.start for b, s in blocks.each(own.bucket)}
    for bucket, at, classes in zip(*(answers[c].to_pylist() for c in ("bucket", "at", "classes")), strict=True):
        commonness[begins[bucket] + np.frombuffer(at, "<u4").astype(np.int64)] = np.frombuffer(classes, np.uint8)
    common = commonness[own.inverse]
    n = np.diff(sets.first)
    identity = {c: texts[c] for c in ("t1", "t2") if c in texts.column_names}
    low = mix(sets.hashes ^ np.uint64(0x51ED))
    total = lambda values: np.diff(np.concatenate((np.zeros(1, U64), np.cumsum(values, dtype=U64)))[sets.first])
    h1, h2 = total(mix(sets.hashes)), total(mix(low))
    single = np.diff(np.concatenate(([0], np.cumsum(common == 0)))[sets.first])
    wanted = (n > 0) & (_prefix_size(n, percent) > single)
    order = np.lexsort((h2, h1))
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1])
    one = np.zeros(len(order), dtype=bool)
    one[order[fresh]] = True
    prefixes, shingles, histograms = [None] * sets.rows, [None] * sets.rows, [None] * sets.rows
    for row in np.flatnonzero(wanted & one).tolist():
        s = slice(sets.first[row], sets.first[row + 1])
        hashes, kind = sets.hashes[s], common[s]
        shared = kind > 0
        ranked = hashes[shared][np.lexsort((hashes[shared], kind[shared]))]
        prefixes[row] = ranked[: int(_prefix_size(n[row], percent) - single[row])].view(np.int64)
        few = np.sort(hashes[shared] >> U64(16))
        shingles[row] = few.view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
        histograms[row] = np.minimum(np.bincount((few >> U64(42)).astype(np.int64), minlength=_BINS), 65535).astype("<u2").tobytes()
    return pa.table(
        {
            "id": texts["id"],
            "n": pa.array(n, pa.int64()),
            "h1": pa.array(h1.view(np.int64), pa.int64()),
            "h2": pa.array(h2.view(np.int64), pa.int64()),
            "single": pa.array(single, pa.int32()),
            "prefix": pa.array(prefixes, pa.list_(pa.int64())),
            "shingles": pa.array(shingles, pa.binary()),
            "histogram": pa.array(histograms, pa.binary()),
            **identity,
        }
    )


def _wide(data: pa.Buffer) -> np.ndarray:
    """Sorted 48-bit hashes."""
    out = np.zeros((data.size // 6, 8), dtype=np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _overlap(a: pa.Buffer, b: pa.Buffer) -> int:
    few, many = sorted((_wide(a), _wide(b)), key=len)
    return int(blocks.member(few, many).sum())


def _asked(sets: DataFrame, nodes: DataFrame, most: int) -> DataFrame:
    """The sets of ``nodes``, ``most`` ids or fewer. A join by node alone would move all sets, however few are asked for."""
    return sets.join(bounded(nodes.toDF("node"), most, _IDS), "node", "left_semi")


def _verify(candidates: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` among distinct candidates ``a, b, n_a, n_b``.

    Histograms go first: they are small, and most pairs that fail do so there. The sets of
    what is left follow, one of each pair with the pair, the other where it meets them.
    """

    def near(batches):
        for batch in batches:
            left, right = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, _BINS).astype(np.int64)
                for c in ("x", "y")
            )
            most = np.minimum(left, right).sum(axis=1)
            # A full class may stand for more.
            most[((left == 65535) & (right == 65535)).any(axis=1)] = 1 << 40
            n = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            good = pa.array(most * (100 + percent) >= percent * n)
            yield batch.filter(good).select(["a", "b", "n_a", "n_b"])

    def link(batches):
        for batch in batches:
            left, right = batch.column("x"), batch.column("y")
            n = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            good = [
                _overlap(left[k].as_buffer(), right[k].as_buffer()) * (100 + percent) >= percent * n[k]
                for k in range(len(batch))
            ]
            yield batch.filter(pa.array(good, pa.bool_())).select(["a", "b"])
            give_back()

    def with_both(pairs: DataFrame, column: str) -> DataFrame:
        most = pairs.count()
        left, right = (_asked(sets, pairs.select(c), most) for c in ("a", "b"))
        first = pairs.join(left.select(F.col("node").alias("a"), F.col(column).alias("x")), "a")
        both = merged(first, _CANDIDATES, pairs).join(right.select(F.col("node").alias("b"), F.col(column).alias("y")), "b")
        return merged(both.select("a", "b", "n_a", "n_b", "x", "y"), _CANDIDATES, pairs)

    left = staged(
        with_both(candidates, "histogram").mapInArrow(near, "a bigint, b bigint, n_a bigint, n_b bigint"), "pairs"
    )
    return staged(with_both(left, "shingles").mapInArrow(link, "a bigint, b bigint"), "links")


def _reach(percent: int, size: str = "d") -> tuple[Column, Column]:
    """What an entry asks for and what it offers: two have room if neither asks for more than the other offers.

    This is the positional filter of ``_roomy``, solved for each side; ``size`` is that of the difference.
    """
    asks = F.col(size) * (100 + percent) - F.col("n") * (100 - percent)
    offers = (F.col(size) - 2 * F.col("at")) * (100 + percent) + F.col("n") * (100 - percent)
    return asks, offers


def _with_room(rows: DataFrame, percent: int) -> DataFrame:
    """Rows of sets that may have room with another one of their shingle: exact for two, by the best for more."""
    asks, offers = _reach(percent, "n")
    groups = rows.groupBy("shingle").agg(
        F.count(F.lit(1)).alias("members"),
        F.min(asks).alias("least"),
        F.max(offers).alias("most"),
        F.sum(asks).alias("all_asks"),
        F.sum(offers).alias("all_offers"),
    )
    fits = (asks <= F.col("most")) & (F.col("least") <= offers)
    of_two = (asks <= F.col("all_offers") - offers) & (F.col("all_asks") - asks <= offers)
    return rows.join(groups.where("members > 1 and least <= most"), "shingle").where(fits & ((F.col("members") > 2) | of_two))


def _roomy(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs that pass the length and the positional filter; a pair may come more than once.

    Of each side there is the size n of its set, the size d of its difference from the base (of
    a base that is empty, n), and the place ``at`` of a common element in the difference. Room
    is what comes from there on: all that both can have, if the element is the first common one.
    """
    small, large = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    room = F.least(F.col("d_a") - F.col("at_a"), F.col("d_b") - F.col("at_b"))
    fits = (F.col("d_a") + F.col("d_b") - 2 * room) * (100 + percent) <= (F.col("n_a") + F.col("n_b")) * (100 - percent)
    return pairs.where((small * 100 >= percent * large) & fits).select("a", "b", "n_a", "n_b")


def _pair(left: str, right: str) -> list[Column]:
    """The columns of a pair in order of its nodes, out of two sides of a join."""
    first = F.col(f"{left}.node") < F.col(f"{right}.node")
    side = lambda c: (F.when(first, F.col(f"{left}.{c}")).otherwise(F.col(f"{right}.{c}")),
                      F.when(first, F.col(f"{right}.{c}")).otherwise(F.col(f"{left}.{c}")))
    out = []
    for c, name in (("node", ""), ("n", "n_"), ("d", "d_"), ("at", "at_")):
        x, y = side(c)
        out += [x.alias(f"{name}a"), y.alias(f"{name}b")]
    return out


def similarity_join(
    df: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    size: int = 5,
    percent: int = 75,
    identity: bool = False,
) -> DataFrame:
    """``id, n_shingles, component`` for each row: the least id reachable by links, itself included.

    ``identity`` adds the text's hashes ``t1, t2`` as ``text_identity`` has them, and ``first``:
    whether the row's id and hashes are the least of its component. Equal rows share it.
    """
    n = blocks.pieces(df)
    # Sets take several times the room of their texts, so blocks are half as large.
    texts = blocks.in_blocks(df, 2 * n, id_column, text)
    marks, schema = [], SETS
    if identity:
        known_text = text_identity("id", "text")
        texts = texts.select("*", known_text["t1"].alias("t1"), known_text["t2"].alias("t2"))
        marks, schema = ["t1", "t2"], f"{SETS}, t1 bigint, t2 bigint"
    counts = texts.groupBy("block").applyInArrow(lean(lambda t: _send(t, size, n)), COUNTS)
    classes = counts.groupBy("bucket").applyInArrow(lean(_add_up), CLASSES)
    described = texts.groupBy("block").cogroup(classes.groupBy("block")).applyInArrow(
        lean(lambda t, a: _describe(t, a, size, percent, n)), schema
    )
    rows = staged(described.withColumn("node", F.monotonically_increasing_id()), "sets")

    # One representative of each set; the others are found again by the set's hash. What is
    # asked by a representative's node needs no other look at which rows are one.
    sets = rows.where("shingles is not null")
    heads = sets.groupBy("h1", "h2").agg(F.min("node").alias("node"))
    heads = staged(merged(heads, _ROWS, rows), "heads")
    prefix = (
        sets.join(heads.select("node"), "node", "left_semi")
        .select("node", "n", "single", F.posexplode("prefix").alias("k", "shingle"))
        .select("shingle", "node", "n", "single", (F.col("single") + F.col("k")).cast("bigint").alias("at"))
    )
    entries = staged(
        _with_room(prefix, percent).select(
            F.lit(0).cast("bigint").alias("base"),
            "shingle",
            "node",
            "n",
            F.col("n").alias("d"),
            (F.col("single") / F.col("n")).alias("own"),
            "at",
            F.col("node").alias("component"),
        ),
        "entries",
    )
    key = ["base", "shingle"]
    links = tested = roots = pending = None
    while True:
        pivots = staged(merged(_pivots(entries), _ROWS, entries), "pivots")
        around = (
            entries.alias("s")
            .join(pivots.alias("p"), key)
            .where("s.node <> p.node and s.component <> p.component")
            .select("base", *_pair("s", "p"))
        )
        fresh = _roomy(around, percent)
        fresh = merged(fresh, _ENTRIES, entries)
        found, tested = _tried(fresh if pending is None else fresh.unionAll(pending), tested, sets, percent)
        first_round = roots is None
        if first_round:  # most links are with pivots; what is found later is joined at the end
            roots = components(found)
        else:
            links = found if links is None else links.unionAll(found)
        state = _between(entries, roots)
        few = F.col("pairs") <= PAIRS_PER_MEMBER * F.col("members")
        pending = merged(_roomy(_cross_pairs(state.where(few)), percent), _ENTRIES, state).distinct()
        pending = staged(merged(pending, _ENTRIES, state), "candidates")
        entries = staged(_keyed_anew(state.where(~few), pivots, sets, percent, merge=first_round), "entries")
        if entries.isEmpty():
            break
    found, _ = _tried(pending, tested, sets, percent)
    roots = _joined(roots, found if links is None else links.unionAll(found))

    known = heads.join(roots, "node", "left").select("h1", "h2", F.coalesce("root", "node").alias("root"))
    keyed = rows.where("n > 0").join(known, ["h1", "h2"], "left")
    # Sets without a representative share nothing: their rows only have each other.
    key = F.when(F.col("root").isNotNull(), F.struct(F.lit(0).cast("bigint").alias("x"), F.col("root").alias("y"), F.lit(0).cast("bigint").alias("z"))).otherwise(
        F.struct(F.lit(1).cast("bigint").alias("x"), F.col("h1").alias("y"), F.col("h2").alias("z"))
    )
    keyed = keyed.select("id", "n", *marks, key.alias("key"))
    least = [F.min("id").alias("component")]
    first, alone = [], []
    if identity:
        own = F.struct(F.col("id").isNull().alias("no_id"), "id", "t1", "t2")
        least.append(F.min(own).alias("head"))
        first, alone = [(own == F.col("head")).alias("first")], [F.lit(True).alias("first")]
    return (
        keyed.join(keyed.groupBy("key").agg(*least), "key")
        .select("id", F.col("n").alias("n_shingles"), "component", *marks, *first)
        .unionAll(
            rows.where("n = 0").select("id", F.col("n").alias("n_shingles"), F.col("id").alias("component"), *marks, *alone)
        )
    )


def _pivots(entries: DataFrame) -> DataFrame:
    """The most central member of each group: few shingles of its own."""
    columns = ("node", "n", "d", "at", "component")
    least = entries.groupBy("base", "shingle").agg(F.min(F.struct("own", *columns)).alias("p"))
    return least.select("base", "shingle", *[F.col(f"p.{c}").alias(c) for c in columns])


def _tried(
    candidates: DataFrame, tested: DataFrame | None, sets: DataFrame, percent: int
) -> tuple[DataFrame, DataFrame]:
    """Links among candidates that were not verified before, and all pairs that were by now."""
    fresh = candidates.dropDuplicates(["a", "b"])
    fresh = fresh if tested is None else fresh.join(tested, ["a", "b"], "left_anti")
    fresh = staged(merged(fresh, _ROWS, candidates), "candidates")
    pairs = fresh.select("a", "b")
    return _verify(fresh, sets, percent), pairs if tested is None else tested.unionAll(pairs)


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Components (``node, root``) after more links."""
    root = lambda c: roots.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}"))
    between = (
        links.join(root("a"), "a", "left")
        .join(root("b"), "b", "left")
        .select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
        .where("a <> b")
    )
    moved = components(between)
    known = roots.join(moved.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left")
    after = known.select("node", F.coalesce("to", "root").alias("root")).unionAll(moved.join(roots, "node", "left_anti"))
    return staged(merged(after, _ROWS, roots, links), "roots")


def _between(entries: DataFrame, roots: DataFrame) -> DataFrame:
    """Entries of groups that span several components: with the component of each, how many
    members and pairs of different components its group has, and the largest component there."""
    located = entries.drop("component").join(roots, "node", "left").withColumn("component", F.coalesce("root", "node")).drop("root")
    located = merged(located, _ROWS, entries)
    sizes = located.groupBy("base", "shingle", "component").agg(F.count(F.lit(1)).cast("double").alias("m"))
    groups = merged(sizes, _ROWS, entries).groupBy("base", "shingle").agg(
        F.sum("m").alias("members"),
        ((F.sum("m") ** 2 - F.sum(F.col("m") ** 2)) / 2).alias("pairs"),
        F.max(F.struct("m", "component"))["component"].alias("major"),
    )
    return staged(merged(located.join(groups.where("pairs > 0"), ["base", "shingle"]), _ROWS, entries), "entries")


def _cross_pairs(state: DataFrame) -> DataFrame:
    """Pairs of members of one group in different components.

    The side that drives the join leaves out the largest component of each group.
    """
    marked = state.withColumn("outer", F.col("component") != F.col("major"))
    return (
        marked.where("outer").alias("s")
        .join(marked.alias("t"), ["base", "shingle"])
        .where(
            (F.col("s.component") != F.col("t.component")) & (~F.col("t.outer") | (F.col("s.node") < F.col("t.node")))
        )
        .select("base", *_pair("s", "t"))
    )


def _differences(percent: int):
    """For each member, its difference from the pivot and how long its prefixes are."""

    def run(batches):
        for batch in batches:
            n, t_n, single, t_single = (batch.column(c).to_numpy() for c in ("n", "t_n", "single", "t_single"))
            elements = []
            for own, other in zip(batch.column("shingles"), batch.column("t_shingles"), strict=True):
                elements.append(np.setxor1d(_wide(own.as_buffer()), _wide(other.as_buffer()), assume_unique=True).view(np.int64))
            d = np.fromiter(map(len, elements), np.int64, len(elements)) + single + t_single
            linked = d * (100 + percent) <= (n + t_n) * (100 - percent)
            strict = d - ((100 + percent) * d + (100 - percent) * (t_n - n)) // (2 * (100 + percent))
            wide = d + 1 - np.maximum(1, -(((100 - percent) * n - percent * d) // percent))
            own_of_pivot = np.full(1, _PIVOTS_OWN)
            elements = [np.concatenate((e, own_of_pivot)) if t else e for e, t in zip(elements, t_single.tolist(), strict=True)]
            yield pa.RecordBatch.from_pydict(
                {
                    **{c: batch.column(c) for c in ("base", "node", "n", "own", "component")},
                    "d": pa.array(d, pa.int64()),
                    "single": pa.array(single, pa.int64()),
                    "strict": pa.array(strict, pa.int64()),
                    "wide": pa.array(np.where(linked, strict, np.maximum(strict, wide)), pa.int64()),
                    "linked": pa.array(linked, pa.bool_()),
                    "elements": pa.array(elements, pa.list_(pa.int64())),
                }
            )
            give_back()

    return run


def _common(batches):
    """How often the members of each base have elements in each slot; a pivot's own count nowhere."""
    for batch in batches:
        lists = batch.column("elements")
        elements = lists.flatten().to_numpy()
        bases = np.repeat(batch.column("base").to_numpy(), lists.value_lengths().to_numpy())
        shared = elements != _PIVOTS_OWN
        elements, bases = elements[shared], bases[shared]
        named, base = np.unique(bases, return_inverse=True)
        at, counts = np.unique(base * _SLOTS + elements % _SLOTS, return_counts=True)
        yield pa.RecordBatch.from_pydict(
            {
                "base": pa.array(named[at // _SLOTS], pa.int64()),
                "slot": pa.array((at % _SLOTS).astype(np.int16), pa.int16()),
                "count": pa.array(counts, pa.int64()),
            }
        )
        give_back()


def _places(batches):
    """Each member's elements up to the end of its wide prefix, with their places among the base's: rare ones first."""
    columns = ("base", "node", "n", "d", "own", "component", "linked")
    for batch in batches:
        single, strict, wide = (batch.column(c).to_numpy() for c in ("single", "strict", "wide"))
        kept, ats = [], []
        for k, (elements, slots, kinds) in enumerate(zip(*(batch.column(c) for c in ("elements", "slots", "kinds")), strict=True)):
            own = elements.values.to_numpy()
            kind = np.zeros(_SLOTS, dtype=np.int16)
            if slots.is_valid:
                kind[slots.values.to_numpy()] = kinds.values.to_numpy()
            order = np.lexsort((own, kind[own % _SLOTS], own == _PIVOTS_OWN))[: max(0, int(wide[k] - single[k]))]
            kept.append(own[order])
            ats.append(single[k] + np.arange(len(order)))
        sizes = np.fromiter(map(len, kept), np.int64, len(kept))
        row, at = np.repeat(np.arange(len(kept)), sizes), np.concatenate([np.zeros(0, np.int64), *ats])
        repeated = batch.select(columns).take(pa.array(row))
        yield pa.RecordBatch.from_pydict(
            {
                "base": repeated.column("base"),
                "shingle": pa.array(np.concatenate([np.zeros(0, np.int64), *kept]), pa.int64()),
                **{c: repeated.column(c) for c in ("node", "n", "d", "own")},
                "at": pa.array(at, pa.int64()),
                "component": repeated.column("component"),
                "linked": repeated.column("linked"),
                "narrow": pa.array(at < strict[row], pa.bool_()),
            }
        )
        give_back()


def _keyed_anew(state: DataFrame, pivots: DataFrame, sets: DataFrame, percent: int, merge: bool) -> DataFrame:
    """Entries of groups by what is rare in the differences from a group's pivot.

    ``merge``: groups with one pivot become one, since each member's difference is the same.
    """
    chosen = pivots.select("base", "shingle", F.col("node").alias("pivot"))
    base = F.col("pivot") if merge else F.xxhash64("base", "shingle", "pivot")
    members = (
        state.join(chosen, ["base", "shingle"])
        .where("node <> pivot")
        .select(base.alias("base"), "pivot", "node", "n", "own", "component")
    )
    members = merged(merged(members, _ROWS, state).dropDuplicates(["base", "node"]), _ROWS, state)
    # A pivot may have very many members: its set goes to them in copies. A group keyed anew
    # has more than twice PAIRS_PER_MEMBER members, so copies are fewer than members.
    copies = F.explode(F.array(*[F.lit(k) for k in range(16)])).alias("copy")
    copy = F.pmod(F.xxhash64("node"), F.lit(16)).cast("int").alias("copy")
    members = staged(members, "members")
    most = members.count()
    of_pivots = _asked(sets, members.select("pivot"), most).select(
        F.col("node").alias("pivot"),
        F.col("n").alias("t_n"),
        F.col("single").alias("t_single"),
        F.col("shingles").alias("t_shingles"),
        copies,
    )
    of_members = _asked(sets, members.select("node"), most).select("node", "single", "shingles")
    with_sets = merged(members.join(of_members, "node"), _ENTRIES, state)
    with_both = with_sets.select("*", copy).join(of_pivots, ["pivot", "copy"])
    found = staged(merged(with_both, _ENTRIES, state).mapInArrow(_differences(percent), DIFFERENCES), "differences")

    counts = found.select("base", "elements").mapInArrow(_common, COMMON).groupBy("base", "slot").agg(F.sum("count").alias("count"))
    kind = F.floor(8 * F.log2("count")).cast("smallint").alias("kind")
    common = counts.groupBy("base").agg(F.collect_list(F.struct("slot", kind)).alias("c"))
    common = common.select("base", F.col("c.slot").alias("slots"), F.col("c.kind").alias("kinds"), copies)
    in_order = merged(found.select("*", copy).join(common, ["base", "copy"], "left"), _ENTRIES, found)
    placed = staged(in_order.drop("copy").mapInArrow(_places, PLACED), "placed")

    # Where one links with the pivot all may meet, else those in the strict prefix.
    asks, offers = _reach(percent)
    placed = placed.withColumn("asks", asks).withColumn("offers", offers)
    of = lambda f, c, name: [f(c).alias(f"{name}_all"), f(F.when(F.col("narrow"), F.col(c))).alias(f"{name}_narrow")]
    groups = placed.groupBy("base", "shingle").agg(
        F.max("linked").alias("some_linked"),
        *of(F.min, "component", "x"),
        *of(F.max, "component", "y"),
        *of(F.min, "asks", "least"),
        *of(F.max, "offers", "most"),
    )
    bounds = [F.when(F.col("some_linked"), F.col(f"{c}_all")).otherwise(F.col(f"{c}_narrow")).alias(c) for c in ("x", "y", "least", "most")]
    groups = groups.select("base", "shingle", "some_linked", *bounds).where("x < y and least <= most").drop("x", "y")
    return placed.join(groups, ["base", "shingle"]).where("(some_linked or narrow) and asks <= most and least <= offers").select(
        "base", "shingle", "node", "n", "d", "own", "at", "component"
    )
