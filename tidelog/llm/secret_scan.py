"""Secret scans: named patterns plus sliding-window entropy, with DataFrame functions only.

*Patterns*: the matches of ``BASE``, leftmost and not overlapping for each kind, less those
that fail their length test.

*Entropy*: candidate strings are runs of key-like characters. A window slides over each; its
Shannon entropy follows from character counts that change by one character in and one
character out. Windows that reach the threshold of the candidate's character class are
merged into spans of kind ``entropy``, unless the candidate matches the allow-list.

Offsets count code points from 0, ends are exclusive. Null texts have no spans. Every row
and column of the input comes back; a column named ``spans`` is replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kind, pattern, group whose length is tested, least length.
BASE = (
    (
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)
#: The same matches as the last two patterns with their length tests, found without the short ones.
LONG_ONLY = {"access": r"AKIA[A-Z0-9]{16,}", "hex": r"[0-9a-f]{24,}"}
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
#: Character classes of candidates, the first that fits counts: pattern and least entropy in bits.
#: Of windows of uniformly random characters of a class, at least nine in ten reach it (100,000 of
#: each: digits 93%, lower-case hex 92%, letters and digits 98%, all key characters 94%).
CLASSES = ((r"^[0-9]+$", 2.7), (r"^[0-9A-Fa-f]+$", 3.1), (r"^[A-Za-z0-9]+$", 3.7), (r"^", 3.8))
#: Candidates that are no secrets: words of one case, paths, rules of one character, placeholders.
ALLOWED = (
    r"^[A-Za-z]?[a-z]+([_/-][A-Za-z]?[a-z]+)*$",
    r"^[A-Z]+([_/-][A-Z]+)*$",
    r"^(.)\1+$",
    r"(?i)example|placeholder|changeme",
    r"^[0-9a-f]{8}-([0-9a-f]{4}-){3}[0-9a-f]{12}$",
)
KINDS = ("assign", "access", "hex", "entropy")
_STEP = 256


def _spans(text: Column, pattern: str, matches: Column) -> Column:
    """``start, end, value`` of each match: what lies between the matches has the rest of the text.

    Running totals go in steps, so that many matches in one text do not cost their square.
    """
    gaps = F.split(text, pattern, -1)
    parts = F.transform(
        F.sequence(F.lit(0), F.size(matches) - 1),
        lambda i: F.struct(
            F.length(F.get(gaps, i)).alias("gap"), F.length(F.get(matches, i)).alias("own"), F.get(matches, i).alias("value")
        ),
    )

    def step(first: Column) -> Column:
        before = F.aggregate(F.slice(parts, F.lit(1), first), F.lit(0), lambda n, p: n + p["gap"] + p["own"])

        def add(state: Column, p: Column) -> Column:
            start = state["at"] + p["gap"]
            end = start + p["own"]
            one = F.struct(start.alias("start"), end.alias("end"), p["value"].alias("value"))
            return F.struct(end.alias("at"), F.concat(state["out"], F.array(one)).alias("out"))

        empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
        return F.aggregate(
            F.slice(parts, first + 1, F.lit(_STEP)), F.struct(before.alias("at"), empty.alias("out")), add, lambda s: s["out"]
        )

    steps = F.sequence(F.lit(0), F.size(matches) - 1, F.lit(_STEP))
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return F.when(F.size(matches) > 0, F.flatten(F.transform(steps, step))).otherwise(none)


def _bits(n: Column) -> Column:
    return F.when(n > 1, n * F.log2(n)).otherwise(F.lit(0.0))


def _high_entropy(candidate: Column, window: int, least: Column) -> Column:
    """Merged runs of windows of ``candidate`` whose entropy reaches ``least``.

    The state holds the count of each character in the window and the sum of n * log2(n);
    a character that comes or goes changes one term of the sum.
    """
    characters = F.split(candidate["value"], "")
    codes = F.transform(characters, lambda c: F.ascii(c))
    total = F.size(codes)

    def change(state: Column, code: Column, by: int) -> tuple[Column, Column]:
        n = F.get(state["counts"], code)
        counts = F.transform(state["counts"], lambda have, at: F.when(at == code, have + by).otherwise(have))
        return counts, state["sum"] - _bits(n) + _bits(n + by)

    def slide(state: Column, i: Column) -> Column:
        counts, value = change(state, F.get(state["codes"], i), 1)
        after = F.struct(counts.alias("counts"), value.alias("sum"))
        fewer, less = change(after, F.get(state["codes"], F.greatest(i - window, F.lit(0))), -1)
        full = i >= window
        counts, value = F.when(full, fewer).otherwise(counts), F.when(full, less).otherwise(value)
        high = (i >= window - 1) & (math.log2(window) - value / window >= least)
        begin = candidate["start"] + i - (window - 1)
        end = candidate["start"] + i + 1
        last = F.element_at(state["runs"], -1)
        touches = (F.size(state["runs"]) > 0) & (F.try_element_at(state["runs"], F.lit(-1))["end"] >= begin)
        fresh = F.struct(begin.alias("start"), end.alias("end"))
        longer = F.struct(last["start"].alias("start"), end.alias("end"))
        runs = F.when(
            high,
            F.when(
                touches, F.concat(F.slice(state["runs"], F.lit(1), F.size(state["runs"]) - 1), F.array(longer))
            ).otherwise(F.concat(state["runs"], F.array(fresh))),
        ).otherwise(state["runs"])
        return F.struct(
            state["codes"].alias("codes"), counts.alias("counts"), value.alias("sum"), runs.alias("runs")
        )

    start = F.struct(
        codes.alias("codes"),
        F.array_repeat(F.lit(0), 128).alias("counts"),
        F.lit(0.0).alias("sum"),
        F.array().cast("array<struct<start:int,end:int>>").alias("runs"),
    )
    return F.aggregate(F.sequence(F.lit(0), total - 1), start, slide, lambda s: s["runs"])


def scan(
    df: DataFrame,
    text: str = "text",
    window: int = WINDOW,
    classes: tuple = CLASSES,
    allowed: tuple = ALLOWED,
) -> DataFrame:
    """``df`` with ``spans``: an array of (kind, start, end), ordered by start and kind."""
    own = [c for c in df.columns if c != "spans"]
    content = F.coalesce(F.col(text), F.lit(""))
    patterns = {kind: LONG_ONLY.get(kind, pattern) for kind, pattern, _, _ in BASE} | {"entropy": CANDIDATE}
    matched = df.select(
        F.struct(*own).alias("row"),
        content.alias("text"),
        *[F.regexp_extract_all(content, F.lit(p), F.lit(0)).alias(f"m_{kind}") for kind, p in patterns.items()],
    )
    placed = matched.select(
        "row", *[_spans(F.col("text"), p, F.col(f"m_{kind}")).alias(f"s_{kind}") for kind, p in patterns.items()]
    )

    def base(kind: str, pattern: str, group: int, least: int) -> Column:
        good = F.filter(
            f"s_{kind}", lambda s: F.length(F.regexp_extract(s["value"], pattern, group)) >= least
        )
        return F.transform(good, lambda s: _span(kind, s))

    def least(value: Column) -> Column:
        out = F.lit(classes[-1][1])
        for pattern, bits in reversed(classes[:-1]):
            out = F.when(value.rlike(pattern), F.lit(bits)).otherwise(out)
        return out

    suspects = F.filter("s_entropy", lambda s: ~_any(s["value"], allowed))
    runs = F.flatten(F.transform(suspects, lambda s: _high_entropy(s, window, least(s["value"]))))
    every = F.concat(*[base(*b) for b in BASE], F.transform(runs, lambda s: _span("entropy", s)))
    ordered = F.array_sort(every, _by_start)
    return placed.select(*[F.col(f"row.`{c}`") for c in own], ordered.alias("spans"))


def _any(value: Column, patterns: tuple) -> Column:
    out = F.lit(False)
    for pattern in patterns:
        out = out | value.rlike(pattern)
    return out


def _span(kind: str, s: Column) -> Column:
    return F.struct(
        s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")
    )


def _by_start(a: Column, b: Column) -> Column:
    def order(x: Column) -> Column:
        return F.struct(x["start"], x["rank"], x["end"])

    return F.when(order(a) < order(b), -1).when(order(a) > order(b), 1).otherwise(0)


def listed(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

