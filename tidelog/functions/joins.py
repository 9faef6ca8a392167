"""Join sides of a checked size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000


def bounded(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast when ``rows``, a known upper bound, is small.

    Beyond the limit the frame is returned without a hint and the planner shuffles both
    sides; adaptive execution then splits skewed keys.
    """
    return F.broadcast(df) if rows <= limit else df
