"""Folded tables of streams: same answers, bounded reads, folds that die, intervals, readiness."""

import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidelog.sources.shared import new_folder
from tidelog.streaming import delivery, order, readiness, snapshots, stateful

LATEST = "topic string, rkey string, rvalue string, roff bigint"


def write_batches(spark, path, rows, schema):
    """Many micro-batches at once; the last column of a row is its batch."""
    spark.createDataFrame(rows, f"{schema}, batch_id bigint").repartition("batch_id").write.partitionBy("batch_id").mode("append").parquet(path)


def opened(df):
    return {f.rsplit("/", 2)[-2] for f in df.inputFiles()}


def test_a_thousand_batches_from_few_folders(spark):
    r = random.Random(1)
    folder, schema = new_folder(spark, "many"), spark.createDataFrame([], LATEST).schema
    rows = [("t", f"k{r.randrange(40)}", f"v{n}", n, n) for n in range(1000)]
    rows += [("t", "late", "new", 5000, 10), ("t", "late", "old", 1, 990)]
    table = stateful.newest_updates(folder, every=50)
    write_batches(spark, table.path, [x for x in rows if x[-1] < 500], LATEST)
    table.fold_up_to(spark, schema, 449)
    write_batches(spark, table.path, [x for x in rows if x[-1] >= 500], LATEST)
    for upto in (699, 949):
        table.fold_up_to(spark, schema, upto)
    view = stateful.latest_view(spark, folder, schema)
    want = {}
    for _, key, value, offset, _ in rows:
        if key not in want or want[key][1] < offset:
            want[key] = (value, offset)
    assert {x.rkey: (x.rvalue, x.roff) for x in view.collect()} == want
    assert opened(view) == {"upto=949", *[f"batch_id={n}" for n in range(950, 1000)]}
    table.remove_folded(spark, keep=2)
    assert snapshots._numbers(spark, table.path, "batch_id=")[0] == 700
    assert {x.rkey: (x.rvalue, x.roff) for x in stateful.latest_view(spark, folder, schema).collect()} == want


def test_a_fold_that_dies(spark, monkeypatch):
    """The snapshot is written but not marked, or half written: readers take the older one."""
    folder, by, schema = new_folder(spark, "died"), ["k"], "k string, n bigint"
    table = stateful.total_updates(folder, by, every=4)
    step = lambda n: table.store(spark.createDataFrame([("a", n), (f"b{n % 3}", n)], schema), n)
    totals = lambda: {x.k: x.n for x in stateful.running_totals(spark, folder, schema, by).collect()}
    for n in range(7):
        step(n)
    assert table.folded(spark) == 3
    real = snapshots._file_system

    def failing(session, path):
        if "/current/7" in path:
            raise RuntimeError("lost power")
        return real(session, path)

    monkeypatch.setattr(snapshots, "_file_system", failing)
    with pytest.raises(RuntimeError):
        step(7)
    monkeypatch.setattr(snapshots, "_file_system", real)
    assert table.folded(spark) == 3 and totals() == {"a": 7, "b0": 6, "b1": 7, "b2": 5}
    step(7)  # the batch comes again
    assert table.folded(spark) == 7 and totals() == {"a": 7, "b0": 6, "b1": 7, "b2": 5}
    for n in range(8, 12):
        step(n)
    assert totals() == {"a": 11, "b0": 9, "b1": 10, "b2": 11}
    step(11)  # again, after it was folded
    assert totals() == {"a": 11, "b0": 9, "b1": 10, "b2": 11}


def test_deltas_add_up_when_folded(spark):
    folder, schema = new_folder(spark, "deltas"), "k string, n bigint, s decimal(10,2)"
    table = stateful.delta_updates(folder, ["k"], every=3)
    for n in range(8):
        table.store(spark.createDataFrame([("a", n), (None, 1)], "k string, n bigint").withColumn("s", F.col("n").cast("decimal(10,2)")), n)
    got = {x.k: (x.n, float(x.s)) for x in stateful.delta_totals(spark, folder, schema, ["k"]).collect()}
    assert got == {"a": (28, 28.0), None: (8, 8.0)}
    assert stateful.delta_totals(spark, new_folder(spark, "none"), schema, ["k"]).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_ledger_of_shuffled_overlapping_and_missing_ranges(spark, seed):
    """Positions by folded intervals are those of a set of offsets; the state is a row for each gap."""
    r = random.Random(seed)
    folder, handled, commits = new_folder(spark, "ledger"), {0: {}, 1: {}}, {}
    table = delivery.ledger_updates(folder, every=4)
    pieces = [(part, a, min(a + r.randint(1, 9), 200)) for part in (0, 1) for a in range(0, 200, 6)]
    r.shuffle(pieces)
    pieces = pieces[: len(pieces) - 5]
    for n in range(0, len(pieces), 3):
        some = [(part, a, b, b if r.random() < 0.8 else None) for part, a, b in pieces[n : n + 3]]
        for part, a, b, commit in some:
            for o in range(a, b):
                handled[part][o] = True
            commits.setdefault(part, []).append((a, b, commit))
        table.store(spark.createDataFrame([("t", *x) for x in some], delivery.RANGES), n // 3)
    gaps = {p: sum(1 for o in s if o - 1 not in s) for p, s in handled.items()}
    rows = delivery.intervals(spark, folder).collect()
    assert {p: sum(1 for x in rows if x.part == p) for p in gaps} == gaps
    want = {}
    for part, s in handled.items():
        end = 0
        while end in s:
            end += 1
        inside = [c for a, b, c in commits[part] if c is not None and a < end]
        if inside:
            want[part] = max(inside)
    assert {x.part: x.position for x in delivery.positions(spark, folder).collect()} == want


def test_readiness_latches_and_outlives_a_restart(spark):
    folder = new_folder(spark, "latch")
    ends = lambda *e: spark.createDataFrame([("t", p, n) for p, n in enumerate(e)] + [("empty", 0, 0), ("other", 0, 9)], "topic string, part int, end_off bigint")
    at = lambda *p: spark.createDataFrame([("t", k, n) for k, n in enumerate(p)], "topic string, part int, position bigint")

    def states():
        latch = readiness.Latch(folder, fold_every=2)  # as after a restart
        return {x.topic: x.state for x in latch.state(spark, ends(0)).collect()}

    latch = readiness.Latch(folder, fold_every=2)
    assert set(states().values()) == {"not started"}
    latch.observe(ends(5, 5), at(2), 0)
    assert states() == {"t": "not synced: 8 remaining", "empty": "synced", "other": "not started"}
    latch.observe(ends(5, 7), at(5, 7), 1)
    assert states()["t"] == "synced"
    latch.observe(ends(50, 70), at(5, 7), 2)
    latch.observe(ends(50, 70), at(5, 7), 2)
    latch.observe(ends(90, 70), at(), 3)
    assert states() == {"t": "synced", "empty": "synced", "other": "not started"}


def log_files(spark, groups):
    """A folder with one file for each list of (part, offset), in that order of time."""
    path = new_folder(spark, "files")
    for some in groups:
        rows = [("t", p, o, f"k{o}") for p, o in some]
        spark.createDataFrame(rows, "topic string, part int, roff bigint, rkey string").coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema("topic string, part int, roff bigint, rkey string").option("maxFilesPerTrigger", 1).parquet(path)


def test_order_by_state(spark):
    stream = log_files(spark, [[(0, 1), (0, 0)], [(1, 0)], [(0, 2), (0, 1), (0, 1)], [(0, 3), (1, 1)]])
    folder = new_folder(spark, "order")
    order.check_order(stream, folder, "ordered", drain=True).awaitTermination()
    got = sorted((x.part, x.batch_id, x.first, x.next, x.num_records, x.repeated) for x in order.checked(spark, folder).collect())
    assert got == [(0, 0, 0, 2, 2, 0), (0, 2, 1, 3, 3, 2), (0, 3, 3, 4, 1, 0), (1, 1, 0, 1, 1, 0), (1, 3, 1, 2, 1, 0)]


@pytest.mark.parametrize("groups", [[[(0, 2), (0, 3)], [(0, 0), (0, 1)]], [[(0, 0)], [(0, 2)]], [[(0, 0), (0, 2)]]])
def test_reversed_files_end_the_query(spark, groups):
    job = order.check_order(log_files(spark, groups), new_folder(spark, "reversed"), "reversed", drain=True)
    with pytest.raises(StreamingQueryException, match="came before"):
        job.awaitTermination()


def test_live_dedup_across_batches_and_a_crash(spark, monkeypatch):
    groups = [[(0, 0), (0, 1), (0, 1)], [(0, 5), (1, 0)], [(0, 1), (0, 2), (0, 5)], [(1, 0), (0, 3), (0, 4)], [(0, k) for k in range(7)]]
    stream, folder = log_files(spark, groups), new_folder(spark, "dedup")
    real, calls = snapshots.Updates.store, []

    def dying(self, batch, batch_id, mode="overwrite"):
        calls.append(batch_id)
        if batch_id == 2 and calls.count(2) == 1:
            # half written: some of the ranges, and nothing that says it is whole
            half = f"{self.path}/batch_id={batch_id}"
            batch.limit(1).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(half)
            raise RuntimeError("lost power")
        real(self, batch, batch_id, mode)
        if batch_id == 3 and calls.count(3) == 1:
            raise RuntimeError("lost power")

    monkeypatch.setattr(snapshots.Updates, "store", dying)
    for name in ("first", "second"):
        with pytest.raises(StreamingQueryException):
            order.deduplicate(stream, folder, name, drain=True, fold_every=2).awaitTermination()
    order.deduplicate(stream, folder, "third", drain=True, fold_every=2).awaitTermination()
    got = sorted((x.part, x.roff) for x in order.deduplicated(spark, folder, stream.schema).collect())
    assert got == [*[(0, k) for k in range(7)], (1, 0)]
    assert sorted((x.part, x.first, x.next) for x in delivery.intervals(spark, folder).collect()) == [(0, 0, 7), (1, 0, 1)]


def test_few_state_stores_for_few_keys(spark):
    """A batch commits every store; restarts keep their number."""
    import os

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 40)
    try:
        stream, folder = log_files(spark, [[(0, 0), (0, 1), (0, 2)], [(0, 3), (0, 4)], [(0, 5)]]), new_folder(spark, "few")
        values = stream.withColumn("value_us", F.col("roff") * 1_000_000)
        stateful.histogram_running(values, ["topic", "part"], "value_us", folder, "few", drain=True).awaitTermination()
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    stores = [n for n in os.listdir(f"{folder}/checkpoint/state/0") if n.isdigit()]
    assert len(stores) == stateful.FEW_STORES
    found = stateful.running_histograms(spark, folder, "topic string, part int", ["topic", "part"]).collect()
    assert [(r.num, r.min_us, r.max_us) for r in found] == [(6, 0, 5_000_000)]


def test_few_state_stores_for_few_partitions(spark):
    import os

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 40)
    try:
        folder = new_folder(spark, "few_order")
        order.check_order(log_files(spark, [[(0, 0)], [(0, 1)]]), folder, "few_order", drain=True).awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len([n for n in os.listdir(f"{folder}/checkpoint/state/0") if n.isdigit()]) == stateful.FEW_STORES
