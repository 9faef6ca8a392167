"""Running the caller's own function over records.

This is the one place where Python sees rows: the function is the caller's. Batches
travel as Arrow.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Takes a batch of records, returns one error text (or None) per record.
BatchProcessor = Callable[[pd.DataFrame], "pd.Series | list"]


def each(process: Callable[[dict[str, Any]], None]) -> BatchProcessor:
    """A function over one record as a batch function; an exception is that record's error."""

    def run(batch: pd.DataFrame) -> list:
        errors = []
        for record in batch.to_dict("records"):
            try:
                process(record)
                errors.append(None)
            except Exception as failure:
                errors.append(str(failure) or type(failure).__name__)
        return errors

    return run


def in_partition_order(batch: DataFrame) -> DataFrame:
    """Each partition whole in one task and in offset order; partitions run in parallel.

    For micro-batches, whose size the source's trigger limit bounds.
    """
    return batch.repartition("topic", "part").sortWithinPartitions("topic", "part", "roff")


def process_records(records: DataFrame, process: BatchProcessor, ordered: bool = False) -> DataFrame:
    """``records`` with an ``error`` column, null where processing succeeded.

    A failed record does not stop the run and is not retried.
    """
    schema = T.StructType(records.schema.fields + [T.StructField("error", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(error=pd.Series(process(batch), index=batch.index, dtype=object))

    source = in_partition_order(records) if ordered else records
    return source.mapInPandas(run, schema)


def process_batches(
    records: DataFrame, process: Callable[[Iterator[pd.DataFrame]], None], ordered: bool = False
) -> DataFrame:
    """Give each task's records to ``process`` as an iterator; one result row per task.

    An error is reported in the row and the run goes on, as for a failed poll.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = 0

        def counted() -> Iterator[pd.DataFrame]:
            nonlocal seen
            for batch in batches:
                seen += len(batch)
                yield batch

        error = None
        rows = counted()
        try:
            process(rows)
        except Exception as failure:
            error = str(failure) or type(failure).__name__
        for _ in rows:
            pass
        yield pd.DataFrame({"num_records": [seen], "error": pd.Series([error], dtype=object)})

    source = in_partition_order(records) if ordered else records
    return source.mapInPandas(run, "num_records bigint, error string")


def process_polls(
    records: DataFrame, process: Callable[[pd.DataFrame], Any], result: str = "double", ordered: bool = False
) -> DataFrame:
    """Give each poll of a partition to ``process`` as a whole; one row with what it returns.

    ``records`` has ``poll_id``, as ``scan.with_polls`` numbers them. Columns: ``topic, part, poll_id,
    num_records``, ``result`` (of that type) and ``error``. An error is that poll's alone: the task
    goes on with the next. A task's rows come sorted, as a stream of batches that is cut where the
    poll changes, so it holds one poll and one batch. Polls spread over tasks; ``ordered`` keeps those
    of a partition in one, in their order.
    """
    key = ["topic", "part", "poll_id"]

    def polls(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            if rows.empty:
                continue
            begins = (rows[key] != rows[key].shift()).any(axis=1)
            cuts = [*begins[begins].index.tolist(), len(rows)]
            for first, last in zip(cuts[:-2], cuts[1:-1]):
                yield rows.iloc[first:last]
            held = rows.iloc[cuts[-2] :]  # its poll may go on in the next batch
        if held is not None:
            yield held

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for poll in polls(batches):
            value = error = None
            try:
                value = process(poll.reset_index(drop=True))
            except Exception as failure:
                error = str(failure) or type(failure).__name__
            found = {c: [poll[c].iloc[0]] for c in key} | {"num_records": [len(poll)]}
            yield pd.DataFrame(found | {"result": pd.Series([value], dtype=object), "error": pd.Series([error], dtype=object)})

    dealt = ["topic", "part"] if ordered else key
    source = records.repartition(*dealt).sortWithinPartitions(*key, "roff")
    return source.mapInPandas(run, f"topic string, part int, poll_id bigint, num_records bigint, result {result}, error string")


def succeeded(processed: DataFrame) -> DataFrame:
    return processed.where(F.col("error").isNull()).drop("error")


def dead_letters(processed: DataFrame) -> DataFrame:
    """The records that were lost, with their error."""
    return processed.where(F.col("error").isNotNull())


def delivery_report(records: DataFrame, err: str, reason: str) -> DataFrame:
    """One row per record handed to the producer: outcome, and the reason of a failure."""
    return records.select(
        "topic",
        "part",
        "roff",
        F.when(F.col(err).isNull(), "success").otherwise("failure").alias("outcome"),
        F.coalesce(F.col(reason), F.lit("")).alias("reason"),
    )
