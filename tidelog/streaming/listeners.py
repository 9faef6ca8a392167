"""Reports on batches while a stream runs."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

OBSERVATION = "batch_size"


def observed(stream: DataFrame) -> DataFrame:
    """A stream that also measures each batch: records and value bytes."""
    return stream.observe(
        OBSERVATION,
        F.count(F.lit(1)).alias("num_records"),
        F.coalesce(F.sum(F.octet_length("rvalue")), F.lit(0)).alias("bytes"),
    )


class BatchListener(StreamingQueryListener):
    """Calls ``report(query_name, batch_id, num_records, bytes)`` after each batch."""

    def __init__(self, report: Callable[[str, int, int, int], None]):
        self._report = report

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        sizes = event.progress.observedMetrics.get(OBSERVATION)
        if sizes is not None:
            self._report(event.progress.name, event.progress.batchId, sizes.num_records, sizes.bytes)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def reports_of(spark: SparkSession, start: Callable[[str], StreamingQuery], patience: float = 30.0) -> DataFrame:
    """Run a query to its end and give what a listener was told: ``batch_id, num_records, bytes``.

    ``start`` starts the query under the name it is given, over a stream that is ``observed``.
    Reports come after their batches; ``patience`` is how many seconds to wait for the last.
    """
    name, told = f"listened-{uuid.uuid4().hex}", {}

    def report(query: str, batch_id: int, num_records: int, size: int) -> None:
        if query == name:
            told[batch_id] = (num_records, size)

    listener = BatchListener(report)
    spark.streams.addListener(listener)
    try:
        query = start(name)
        query.awaitTermination()
        last = query.lastProgress
        deadline = time.monotonic() + patience
        while last is not None and last.batchId not in told and time.monotonic() < deadline:
            time.sleep(0.05)
    finally:
        spark.streams.removeListener(listener)
    rows = [(batch_id, *sizes) for batch_id, sizes in sorted(told.items())]
    return spark.createDataFrame(rows, "batch_id bigint, num_records bigint, bytes bigint")
