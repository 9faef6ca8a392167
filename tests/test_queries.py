"""Every registered query against its SQL, on the smallest data set."""

import duckdb
import pytest

import __spark_entry__ as repo
from tidelog.plans import registry
from tidelog.plans.views import Inputs
from tools.check import TABLES, rows_of

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(registry.queries()) == set(registry.oracle_sql())
    assert set(registry.queries()) <= set(repo.queries())


def test_entry(spark):
    assert repo.entry(spark).count() > 0


def test_a_table_that_changes_is_read_anew(spark, tmp_path):
    events = spark.read.parquet(f"{FOLDER}/events.parquet")
    events.where("event_id < 500").write.parquet(f"{tmp_path}/events.parquet")
    records = lambda: sum(r.end_off for r in Inputs(spark, str(tmp_path)).ends.collect())
    before, logged = records(), Inputs(spark, str(tmp_path)).record_log.count()
    assert before == logged == events.where("event_id < 500").count()
    first = Inputs(spark, str(tmp_path)).log_table.path
    assert Inputs(spark, str(tmp_path)).log_table.path == first  # nothing changed: the stored log serves
    events.where("event_id >= 500").write.mode("append").parquet(f"{tmp_path}/events.parquet")
    assert records() == Inputs(spark, str(tmp_path)).record_log.count() == events.count() > before


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query(spark, db, name):
    frame = registry.queries()[name](spark, FOLDER)
    got = [tuple(r) for r in frame.collect()]
    want = db.execute(registry.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(frame.columns) == sorted(columns)
    assert rows_of(frame.columns, got) == rows_of(columns, want.fetchall())
