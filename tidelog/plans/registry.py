"""Every query by name, with the SQL that DuckDB checks it against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidelog.plans.sql import VIEWS
from tidelog.plans.views import Inputs

_queries: dict[str, Callable[[Inputs], DataFrame]] = {}
_sql: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of ``Inputs``; ``sql`` may use the views of ``plans.sql``."""

    def add(build: Callable[[Inputs], DataFrame]):
        if name in _queries:
            raise ValueError(f"query {name} is registered twice")
        _queries[name] = build
        if sql is not None:
            _sql[name] = f"{VIEWS}\n{sql.strip()}"
        return build

    return add


def _load() -> None:
    from tidelog.plans import admin, logs, metering, streams  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()

    def runner(build):
        return lambda spark, sf_dir: build(Inputs(spark, sf_dir))

    return {name: runner(build) for name, build in _queries.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_sql)
