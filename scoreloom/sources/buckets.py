"""Storage dealt by a key: tables in as many buckets as one another meet without an exchange.

A store is a folder with one bucketed Parquet table per entry and ``layout`` (name, key, buckets). The session's catalog
only points to the files, so any later session can open the folder again.
"""

from __future__ import annotations

from hashlib import md5

from pyspark.sql import DataFrame, SparkSession


def _table(root: str, name: str) -> str:
    return f"dealt_{md5(f'{root}/{name}'.encode()).hexdigest()[:16]}"


def write_store(frames: dict[str, DataFrame], root: str, key: str, buckets: int) -> None:
    """Write frames that hold ``key``, each bucket as one sorted file."""
    spark = next(iter(frames.values())).sparkSession
    for name, df in frames.items():
        table = _table(root, name)
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        dealt = df.repartition(buckets, key).write.mode("overwrite").format("parquet")
        dealt.bucketBy(buckets, key).sortBy(key).option("path", f"{root}/{name}").saveAsTable(table)
    layout = spark.createDataFrame([(name, key, buckets) for name in frames], "name string, key string, buckets int")
    layout.coalesce(1).write.mode("overwrite").json(f"{root}/layout")


def open_store(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The frames of a store, with what the planner needs to know of their buckets."""
    found = {}
    for row in spark.read.schema("name string, key string, buckets int").json(f"{root}/layout").collect():
        table = _table(root, row.name)
        schema = spark.read.parquet(f"{root}/{row.name}").schema
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(
            f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (`{row.key}`) SORTED BY (`{row.key}`) "
            f"INTO {row.buckets} BUCKETS LOCATION '{root}/{row.name}'"
        )
        found[row.name] = spark.table(table)
    return found
