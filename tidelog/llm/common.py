"""What the operators share: Spark-side helpers around folders, partitions and staged tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.sources.shared import new_folder, version_of


def partitions(spark: SparkSession) -> int:
    """How many pieces work is cut into: the session's shuffle partitions."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Cuts the lineage with a copy that outlives executors, and fixes what is not
    deterministic (row numbers, partition numbers) for every later reader.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def merged(df: DataFrame, per: int, *tables: DataFrame) -> DataFrame:
    """``df`` in a task for each ``per`` bytes of the staged ``tables`` it is made of, and one a core at least.

    Only takes tasks away: where little is left, each shuffle partition would cost a task and a file.
    Tables that are not in files have no size that is known, and ``df`` stays as it is.
    """
    spark = df.sparkSession
    folders = {path.rsplit("/", 1)[0] for t in tables for path in t.inputFiles()}
    if not folders:
        return df
    size = sum(version_of(spark, folder)[2] for folder in folders)
    return df.coalesce(max(spark.sparkContext.defaultParallelism, -(-size // per)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def block_of(blocks: int, *columns: Column | str) -> Column:
    """A stable piece number for a row, by the hash of its columns."""
    return F.pmod(F.xxhash64(*columns), F.lit(blocks)).cast("int")


def text_identity(id_column: str, text: str) -> Column:
    """What tells texts apart and orders them: (id, nulls last; content). Equal rows are one text."""
    return F.struct(
        F.col(id_column).isNull().alias("no_id"),
        F.col(id_column).alias("id"),
        F.xxhash64(F.lit(3), text).alias("t1"),
        F.xxhash64(F.lit(4), text).alias("t2"),
    )


def text_key(identity: Column) -> Column:
    """An identity without nulls, for joins."""
    return F.struct(
        F.coalesce(identity["id"].cast("string"), F.lit("")).alias("id"),
        identity["no_id"].alias("no_id"),
        identity["t1"].alias("t1"),
        identity["t2"].alias("t2"),
    )
