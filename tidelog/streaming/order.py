"""Order and repeats of a stream, by what is known of the offsets of each partition.

``check_order`` keeps one number for each partition in Spark's state: the next offset. A batch
may bring offsets again, but must go on where the last one ended; if it does not, the query
ends with an error. ``deduplicate`` keeps the intervals of offsets that a job has handled, one
row for each gap (see ``delivery.merge_intervals``), not a row for each record.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidelog.functions.joins import bounded
from tidelog.sources.shared import merging_what_is_kept
from tidelog.streaming.delivery import PARTITION, RANGES, _ranges, _start, ledger_updates
from tidelog.streaming.snapshots import FOLD_EVERY
from tidelog.streaming.stateful import FEW_STORES, rocksdb_state

CHECKED = "topic string, part int, first bigint, next bigint, num_records bigint, repeated bigint"


def _go_on(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Compare a partition's offsets in a batch with where it stood."""
    topic, part = key
    expected = state.get[0] if state.exists else 0
    offsets = np.sort(np.concatenate([b["roff"].to_numpy() for b in batches]))
    fresh = np.unique(offsets[offsets >= expected])
    reached = expected + len(fresh)
    if len(fresh) and fresh[-1] + 1 != reached:
        missing = int(expected + np.argmax(fresh != np.arange(expected, reached)))
        raise ValueError(f"{topic} {part}: offset {int(fresh[fresh > missing][0])} came before {missing}")
    state.update((int(reached),))
    yield pd.DataFrame(
        {
            "topic": [topic],
            "part": [part],
            "first": [int(offsets[0])],
            "next": [int(reached)],
            "num_records": [len(offsets)],
            "repeated": [len(offsets) - len(fresh)],
        }
    )


def check_order(
    stream: DataFrame, folder: str, name: str, drain: bool = False, stores: int = FEW_STORES
) -> StreamingQuery:
    """End with an error when a partition does not go on where it stood; count what comes again.

    Only offsets go through Python, those of a partition in a batch at once; the trigger's
    limit bounds them. Partitions begin at offset 0. ``stores`` is how many state stores, and so
    tasks of a batch, share the partitions.
    """
    checked = (
        stream.select(*PARTITION, "roff")
        .groupBy(*PARTITION)
        .applyInPandasWithState(_go_on, CHECKED, "next bigint", "append", GroupStateTimeout.NoTimeout)
    )
    writer = (
        checked.writeStream.outputMode("append")
        .foreachBatch(lambda batch, n: batch.write.mode("overwrite").parquet(f"{folder}/checked/batch_id={n}"))
        .queryName(name)
        .option("checkpointLocation", f"{folder}/checkpoint")
    )
    with rocksdb_state(stream.sparkSession, stores):
        return (writer.trigger(availableNow=True) if drain else writer).start()


def checked(spark: SparkSession, folder: str) -> DataFrame:
    """What ``check_order`` has seen: a row for each partition and batch."""
    return spark.read.schema(f"{CHECKED}, batch_id bigint").parquet(f"{folder}/checked")


def unseen(batch: DataFrame, handled: DataFrame, known_rows: int) -> DataFrame:
    """Records whose offsets are in none of the intervals ``handled``, each once.

    ``known_rows`` is how many intervals there are; few are broadcast.
    """
    marks = bounded(handled.select(*PARTITION, "first", "next"), known_rows)
    inside = (F.col("r.roff") >= F.col("h.first")) & (F.col("r.roff") < F.col("h.next"))
    same = [F.col(f"r.{c}") == F.col(f"h.{c}") for c in PARTITION]
    return batch.alias("r").join(marks.alias("h"), [*same, inside], "left_anti").dropDuplicates([*PARTITION, "roff"])


def deduplicate(
    stream: DataFrame, folder: str, name: str, drain: bool = False, fold_every: int = FOLD_EVERY
) -> StreamingQuery:
    """Each record of a stream once, whenever it comes again; ``deduplicated`` reads them.

    A batch is written before the ledger says so. If the ledger has it already, a crash came
    after that, and nothing is left to do.
    """
    ledger = ledger_updates(folder, fold_every)

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if ledger.last(spark) >= batch_id:
            return
        # Kept, as they are counted and joined: merged once.
        with merging_what_is_kept(spark):
            handled = ledger.read(spark, RANGES, upto=batch_id - 1).persist()
        target = f"{folder}/results/batch_id={batch_id}"
        try:
            unseen(batch, handled, handled.count()).write.mode("overwrite").parquet(target)
        finally:
            handled.unpersist()
        written = spark.read.schema(batch.schema).parquet(target)
        ledger.store(_ranges(written, F.max("roff") + 1), batch_id)

    return _start(stream, name, step, folder, drain)


def deduplicated(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The records that ``deduplicate`` has let through, with ``batch_id``."""
    full = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(full).parquet(f"{folder}/results")
