"""Quality classifier: evidence of each document, shrunk site rates as its prior.

*Documents.* Two heads, low quality and toxicity, each a logistic regression on a few style
measures (shares of capitals, symbols, repeated words, ...) and on lexical evidence: how
many words, or beginnings of words, the text has of those that labelled documents of the
class hold much more often than others. Words are picked on one half of the labelled sample,
weights fitted on the other.

*Sites.* Hosts and their paths get rates of rejection from all documents, by grouped sums of
their evidence. The rate of a host is drawn to the global one,
the rate of a path to its host's, with strengths that follow from how much the rates vary
beyond chance (empirical Bayes), so a site of few documents says little.

*Together.* A document's odds of rejection are its own times the odds of its path over the
global odds; it is rejected when the probability reaches ``reject``. Its own evidence is
left out of the rates of its path and host, so that nothing counts twice.

The sample of labelled documents is bounded by ``sample`` (those with the smallest hashes of
their ids); scoring and sites cover all rows. Without labels of both kinds a head gives
every document the rate of the class in the sample.

* Null and empty texts have no words: their style measures are zeros.
* Null hosts and null paths are sites of their own. Null ids are scored, and have no label.
* Rows that repeat count each, and each leaves out itself only. Columns named as in ``OUTPUT``
  are replaced, others stay, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.bytes_np import Words, buffers, chunks, combined, is_space, lowered, powers, prefix_sums, range_hashes, slices, BYTE_VALUES
from tidelog.llm.common import staged

OUTPUT = ("p_low", "p_toxic", "p_site", "p_reject", "rejected")
SAMPLE = 8_000
#: Lengths of the word beginnings looked at, in bytes; whole words come in addition.
BEGINNINGS = (4, 5, 6, 7, 8, 10)
WORDS_KEPT = 4_000
#: A word counts as evidence when at least so many documents of the class hold it, and the
#: lower bound of its share among the documents that hold it (so many deviations) is above that.
LEAST_DOCUMENTS, LEAST_SHARE, DEVIATIONS = 5, 0.5, 2.0
_GROUPS = 9


def _byte_groups() -> np.ndarray:
    """Kind of each byte: 0 lower case and beyond ASCII, then capitals, digits, white space,
    line ends, exclamation marks, bars, other symbols, sentence punctuation."""
    out = np.full(256, 7, dtype=np.uint8)
    out[97:123] = 0
    out[128:] = 0
    out[65:91] = 1
    out[48:58] = 2
    out[[32, 9, 11, 12, 13]] = 3
    out[10] = 4
    out[33] = 5
    out[124] = 6
    out[[ord(c) for c in ".,;:'-()\"?/@_"]] = 8
    return out


class _Read:
    """Style measures of a run of texts and the hashes of their words and word beginnings."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        rows = len(offsets) - 1
        kinds = _byte_groups()[raw]
        counts = np.stack(
            [np.diff(np.concatenate(([0], np.cumsum(kinds == k)))[offsets]) for k in range(_GROUPS)], axis=1
        ).astype(float)
        # Words without the signs around them: letters, digits and what is beyond ASCII.
        low = lowered()[raw]
        self.words = Words(low, offsets, np.isin(np.arange(256), [*range(48), *range(58, 97), *range(123, 128)]))
        self.sums = prefix_sums(BYTE_VALUES[low], 1)
        self.hashes = range_hashes(self.sums, self.words.start, self.words.stop, 1)
        n = np.diff(self.words.first).astype(float)
        same = np.zeros(len(self.hashes), dtype=bool)
        same[1:] = (self.hashes[1:] == self.hashes[:-1]) & (self.words.row[1:] == self.words.row[:-1])
        again = np.bincount(self.words.row[same], minlength=rows)
        size = np.maximum(np.diff(offsets), 1)[:, None]
        self.style = np.concatenate(
            (
                np.sqrt(counts / size),
                np.log1p(counts[:, [1, 2, 5, 6, 7]]),
                np.sqrt(again / np.maximum(n, 1))[:, None],
                np.log1p(again)[:, None],
                np.log1p(n)[:, None],
                (size[:, 0] / np.maximum(n, 1)).clip(0, 50)[:, None] / 10,
            ),
            axis=1,
        )

    def tokens(self):
        """(hash, row) arrays, of whole words and of beginnings of longer ones."""
        yield self.hashes, self.words.row
        length = self.words.stop - self.words.start
        for k in BEGINNINGS:
            some = np.flatnonzero(length > k)
            start = self.words.start[some]
            yield range_hashes(self.sums, start, start + k, 1) ^ np.uint64(k), self.words.row[some]


STYLE = _GROUPS + 5 + 4


def _reads(column: pa.Array):
    raw, offsets = buffers(combined(column))
    for a, b in chunks(offsets, 1 << 20):
        yield a, _Read(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])


@dataclass(frozen=True)
class Model:
    """Lexical evidence (sorted hashes) and weights of each head, and the rate of rejection."""

    words: tuple[np.ndarray, np.ndarray]
    weights: tuple[np.ndarray, np.ndarray]
    center: np.ndarray
    spread: np.ndarray
    rate: float


def _measures(column: pa.Array, words: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Style measures and, for each head, number of its words and of distinct ones in the text."""
    out = np.zeros((len(column), STYLE + 4))
    for a, read in _reads(column):
        rows = len(read.style)
        out[a : a + rows, :STYLE] = read.style
        for head, some in enumerate(words):
            if not len(some):
                continue
            hits = [(h[at], r[at]) for h, r in read.tokens() for at in [np.flatnonzero(_among(h, some))]]
            hashes, owners = np.concatenate([h for h, _ in hits]), np.concatenate([r for _, r in hits])
            distinct = np.unique(np.stack([owners.astype(np.uint64), hashes]), axis=1)[0].astype(np.int64)
            out[a : a + rows, STYLE + 2 * head] = np.log1p(np.bincount(owners, minlength=rows))
            out[a : a + rows, STYLE + 2 * head + 1] = np.log1p(np.bincount(distinct, minlength=rows))
    return out


def _among(values: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Which values are in a short sorted array; 16 bits of each rule most out first."""
    table = np.zeros(1 << 16, dtype=bool)
    table[(some & np.uint64(0xFFFF)).astype(np.int64)] = True
    maybe = np.flatnonzero(table[(values & np.uint64(0xFFFF)).astype(np.int64)])
    at = np.searchsorted(some, values[maybe])
    at[at == len(some)] = 0
    out = np.zeros(len(values), dtype=bool)
    out[maybe] = some[at] == values[maybe]
    return out


def fit(
    labelled: DataFrame, text: str = "text", low: str = "low", toxic: str = "toxic", fold: str = "fold"
) -> Model:
    """Fit both heads on a bounded frame of labelled texts (0/1 columns; ``fold`` 0 or 1)."""
    chosen = _pick_words(labelled.where(F.col(fold) == 0), text, low, toxic)

    def measure(batches):
        for batch in slices(batches, "text"):
            values = _measures(batch.column("text"), chosen)
            yield pa.RecordBatch.from_pydict(
                {
                    "low": batch.column("low"),
                    "toxic": batch.column("toxic"),
                    "x": pa.array(list(values), pa.list_(pa.float64())),
                }
            )

    rows = (
        labelled.where(F.col(fold) == 1)
        .select(F.col(text).alias("text"), F.col(low).cast("int").alias("low"), F.col(toxic).cast("int").alias("toxic"))
        .mapInArrow(measure, "low int, toxic int, x array<double>")
        .collect()
    )
    x = np.array([r["x"] for r in rows]).reshape(-1, STYLE + 4)
    center = x.mean(axis=0) if len(x) else np.zeros(STYLE + 4)
    spread = np.maximum(x.std(axis=0), 1e-3) if len(x) else np.ones(STYLE + 4)
    z = (x - center) / spread
    y = [np.array([r[c] for r in rows], dtype=float) for c in ("low", "toxic")]
    either = np.maximum(*y)
    rate = (either.sum() + 0.5) / (len(either) + 1)
    return Model(chosen, (_logistic(z, y[0]), _logistic(z, y[1])), center, spread, float(rate))


def _pick_words(labelled: DataFrame, text: str, low: str, toxic: str) -> tuple[np.ndarray, np.ndarray]:
    """For each head the words that are the strongest evidence, by document counts."""

    def count(batches):
        for batch in slices(batches, "text"):
            flags = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("low", "toxic")], axis=1)
            for a, read in _reads(batch.column("text")):
                hashes, owners = (np.concatenate(x) for x in zip(*read.tokens(), strict=True))
                order = np.lexsort((owners, hashes))
                hashes, owners = hashes[order], owners[order]
                fresh = np.ones(len(order), dtype=bool)
                fresh[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
                hashes, owners = hashes[fresh], owners[fresh] + a
                values, head = np.unique(hashes, return_index=True)
                if not len(values):
                    continue
                both = np.add.reduceat(flags[owners], head, axis=0)
                yield pa.RecordBatch.from_pydict(
                    {
                        "word": pa.array(values.view(np.int64), pa.int64()),
                        "n": pa.array(np.diff(np.append(head, len(hashes))), pa.int64()),
                        "low": pa.array(both[:, 0], pa.int64()),
                        "toxic": pa.array(both[:, 1], pa.int64()),
                    }
                )

    counted = (
        labelled.select(F.col(text).alias("text"), F.col(low).cast("bigint").alias("low"), F.col(toxic).cast("bigint").alias("toxic"))
        .mapInArrow(count, "word bigint, n bigint, low bigint, toxic bigint")
        .groupBy("word")
        .agg(*[F.sum(c).alias(c) for c in ("n", "low", "toxic")])
    )
    out = []
    for head in ("low", "toxic"):
        share = F.col(head) / F.col("n")
        # Wilson's lower bound of the share.
        z = DEVIATIONS
        bound = (
            share + z * z / (2 * F.col("n")) - z * F.sqrt(share * (1 - share) / F.col("n") + z * z / (4 * F.col("n") ** 2))
        ) / (1 + z * z / F.col("n"))
        best = (
            counted.where(F.col(head) >= LEAST_DOCUMENTS)
            .select("word", bound.alias("bound"))
            .where(F.col("bound") > LEAST_SHARE)
            .orderBy(F.desc("bound"), "word")
            .limit(WORDS_KEPT)
        )
        out.append(np.sort(np.array([r["word"] for r in best.collect()], dtype=np.int64).view(np.uint64)))
    return out[0], out[1]


def _logistic(z: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 40) -> np.ndarray:
    """Weights (the constant last) by Newton's method; the class's rate alone if it is all or nothing."""
    x = np.concatenate((z, np.ones((len(z), 1))), axis=1)
    w = np.zeros(x.shape[1])
    rate = (y.sum() + 0.5) / (len(y) + 1)
    w[-1] = np.log(rate / (1 - rate))
    if not len(y) or y.min() == y.max():
        return w
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + penalty * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        move = np.linalg.solve(bend, slope)
        w -= move / max(1.0, np.abs(move).max())
        if np.abs(move).max() < 1e-6:
            break
    return w


def evidence(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with ``p_low`` and ``p_toxic``, from the text alone."""
    own = [f for f in df.schema.fields if f.name not in OUTPUT]
    schema = T.StructType([*own, T.StructField("p_low", T.DoubleType()), T.StructField("p_toxic", T.DoubleType())])

    def score(batches):
        for batch in slices(batches, text):
            z = (_measures(batch.column(text), model.words) - model.center) / model.spread
            odds = [np.clip(z @ w[:-1] + w[-1], -15, 15) for w in model.weights]
            columns = [batch.column(f.name) for f in own] + [pa.array(1 / (1 + np.exp(-o)), pa.float64()) for o in odds]
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema.fields])

    return df.select(*[F.col(f"`{f.name}`") for f in own]).mapInArrow(score, schema)


def _strength(groups: DataFrame, n: str, total: str, prior: Column) -> float:
    """How many documents a prior is worth, from the variance of rates beyond chance (moments)."""
    rate = F.col(total) / F.col(n)
    row = groups.where(F.col(n) > 0).agg(
        F.sum(F.col(n) * (rate - prior) ** 2), F.sum(prior * (1 - prior)), F.count(F.lit(1)), F.sum(n)
    ).first()
    if not row[2] or row[2] < 2:
        return 1e6
    spread, chance, groups_n, documents = float(row[0]), float(row[1]), row[2], float(row[3])
    extra = (spread - chance) / max(documents, 1.0)
    within = chance / groups_n
    return 1e6 if extra <= 0 else min(max(within / extra, 1.0), 1e6)


def site_counts(known: DataFrame, host: str, path: str, evidence: str, rate: float) -> tuple[DataFrame, float, float]:
    """What the rates of sites follow from: ``host, path, n, total, host_n, host_total``, and how many
    documents the prior of a host and that of a path are worth."""
    site = known.select(F.col(host).alias("host"), F.col(path).alias("path"), F.col(evidence).alias("known"))
    paths = staged(
        site.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("known").alias("total")), "paths"
    )
    hosts = paths.groupBy(F.col("host").alias("h")).agg(F.sum("n").alias("host_n"), F.sum("total").alias("host_total"))
    k_host = _strength(hosts, "host_n", "host_total", F.lit(rate))
    joined = paths.join(hosts, F.col("host").eqNullSafe(F.col("h"))).drop("h")
    k_path = _strength(joined, "n", "total", _shrunk("host_total", "host_n", k_host, F.lit(rate)))
    return joined, k_host, k_path


def _shrunk(total: str, n: str, strength: float, prior: Column, own: Column | None = None) -> Column:
    """A site's rate drawn to its prior; without the evidence of one of its documents, if given."""
    rest, others = (F.col(total), F.col(n)) if own is None else (F.greatest(F.col(total) - own, F.lit(0.0)), F.col(n) - 1)
    return (rest + strength * prior) / (others + strength)


def site_rates(known: DataFrame, host: str, path: str, evidence: str, rate: float) -> DataFrame:
    """``host, path, p_site``: the shrunk rate of rejection of each path."""
    sites, k_host, k_path = site_counts(known, host, path, evidence, rate)
    p_host = _shrunk("host_total", "host_n", k_host, F.lit(rate))
    return sites.select("host", "path", _shrunk("total", "n", k_path, p_host).alias("p_site"))


def _logit(p: Column, least: float) -> Column:
    """Log odds of a probability, kept away from 0 and 1."""
    kept = F.greatest(F.least(p, F.lit(1 - least)), F.lit(least))
    return F.log(kept / (1 - kept))


def classify(
    df: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    host: str = "source",
    path: str = "lang",
    sample: int = SAMPLE,
    reject: float = 0.5,
) -> DataFrame:
    """All rows of ``df`` with ``OUTPUT``.

    ``labels`` has the id, ``quality`` (1 good, 0 low) and ``toxic`` (1 toxic); rows with a
    null are passed over. Several labels of an id count as the worst. ``p_site`` is the rate
    of a document's path among its *other* documents.
    """
    given = (
        labels.where(F.col(id_column).isNotNull() & F.col("quality").isNotNull() & F.col("toxic").isNotNull())
        .groupBy(F.col(id_column).cast("bigint").alias("label_id"))
        .agg((1 - F.min("quality")).cast("int").alias("low"), F.max("toxic").cast("int").alias("toxic"))
    )
    chosen = given.orderBy(F.xxhash64(F.lit(9), "label_id"), "label_id").limit(sample)
    training = staged(
        df.select(F.col(id_column).cast("bigint").alias("label_id"), F.col(text).alias("text"))
        .join(F.broadcast(chosen), "label_id")  # at most ``sample`` rows
        .withColumn("fold", F.pmod(F.xxhash64(F.lit(10), "label_id"), F.lit(2))),
        "training",
    )
    model = fit(training)
    # Texts are read once: the rows go to the shared folder with their evidence, under names by
    # position, which clash with none of those added.
    own = [c for c in df.columns if c.lower() not in OUTPUT]
    columns = [F.col("`" + c.replace("`", "``") + "`").alias(f"c{k}") for k, c in enumerate(own)]
    sites_of = [F.col(host).alias("host"), F.col(path).alias("path")]
    read = df.select(*columns, *sites_of, *([] if text in own else [F.col(text).alias("text")]))
    scored = staged(evidence(read, model, f"c{own.index(text)}" if text in own else "text"), "scored")
    known = scored.withColumn("known", 1 - (1 - F.col("p_low")) * (1 - F.col("p_toxic")))
    sites, k_host, k_path = site_counts(known, "host", "path", "known", model.rate)
    sites = staged(sites.select(F.col("host").alias("h"), F.col("path").alias("p"), "n", "total", "host_n", "host_total"), "sites")
    p_host = _shrunk("host_total", "host_n", k_host, F.lit(model.rate), F.col("known"))
    shift = _logit(F.col("p_site"), 1e-6) - float(np.log(model.rate / (1 - model.rate)))
    return (
        known.join(sites, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("p")))
        .withColumn("p_site", _shrunk("total", "n", k_path, p_host, F.col("known")))
        .withColumn("p_reject", 1 / (1 + F.exp(-(_logit(F.col("known"), 1e-9) + shift))))
        .withColumn("rejected", F.col("p_reject") >= reject)
        .select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(own)], *OUTPUT)
    )
