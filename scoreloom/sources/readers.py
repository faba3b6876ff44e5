"""Reading inputs into frames and views."""

from __future__ import annotations

import pathlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.features import KEYS, TARGET, nan_to_null
from ..operators.scoring import missing_required
from .schemas import SKIPPED_FILES, TABLES


def _list(spark: SparkSession, folder: str) -> list[str]:
    """Entries of a folder on any file system Spark can reach."""
    jvm, sc = spark._jvm, spark.sparkContext
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    return sorted(s.getPath().toString() for s in fs.listStatus(path))


def _csv(spark: SparkSession, path: str, known: T.StructType | None) -> DataFrame:
    """CSV with the header's columns; known columns get their declared type, the rest are inferred."""
    names = spark.read.option("header", True).csv(path).columns  # header only
    if known is not None and set(names) <= set(known.names):
        schema = T.StructType([known[n] for n in names])
        return spark.read.option("header", True).schema(schema).csv(path)
    df = spark.read.option("header", True).option("inferSchema", True).csv(path)
    if known is None:
        return df
    return df.withColumns({f.name: F.col(f.name).cast(f.dataType) for f in known.fields if f.name in df.columns})


def load_views(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Register every CSV or Parquet entry of a folder as a view named by its stem.

    NaN is turned into NULL on the way in. Parquet wins over a CSV of the same name.
    """
    found: dict[str, str] = {}
    for path in _list(spark, folder):
        name = pathlib.PurePosixPath(path).name
        stem, _, ext = name.rpartition(".")
        if ext in ("csv", "parquet") and stem not in SKIPPED_FILES:
            if ext == "parquet" or stem not in found:
                found[stem] = path
    frames = {}
    for stem, path in found.items():
        df = spark.read.parquet(path) if path.endswith(".parquet") else _csv(spark, path, TABLES.get(stem))
        frames[stem] = nan_to_null(df)
        frames[stem].createOrReplaceTempView(stem)
    return frames


def run_sql_file(spark: SparkSession, path: str) -> DataFrame:
    """Result of one SQL text file over the registered views, evaluated lazily."""
    text = "\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect())
    return spark.sql(text.rstrip().rstrip(";"))


def load_features(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """Feature table and its model columns (keys and target excluded, keys kept in the frame)."""
    df = spark.read.parquet(path)
    return df, [c for c in df.columns if c not in KEYS and c != TARGET]


def read_applicants(spark: SparkSession, path: str) -> DataFrame:
    """Applicant CSV as text columns (validation types them); a missing required column is an error."""
    df = spark.read.option("header", True).csv(path)
    lacking = missing_required(df)
    if lacking:
        raise ValueError(f"missing required columns: {', '.join(lacking)}")
    return df


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """Parquet, or CSV with inferred types when the path ends in .csv."""
    if path.endswith(".csv"):
        df = spark.read.option("header", True).option("inferSchema", True).csv(path)
    else:
        df = spark.read.parquet(path)
    return nan_to_null(df)


def read_pair(spark: SparkSession, baseline: str, current: str) -> tuple[DataFrame, DataFrame]:
    return read_any(spark, baseline), read_any(spark, current)


def read_comparison(spark: SparkSession, path: str) -> DataFrame:
    """Model comparison JSON as (model, auc, gini, ks): a record list, JSON lines, or an object keyed by model."""
    raw = spark.read.option("multiLine", True).json(path)
    names = {"model": ("Model", "model"), "auc": ("AUC-ROC", "AUC", "auc"), "gini": ("Gini", "gini"),
             "ks": ("KS Statistic", "KS", "ks")}
    pick = lambda have, f: next((n for n in names[f] if n in have), None)
    if pick(raw.columns, "model"):
        lines = spark.read.json(path) if raw.count() == 1 else raw
        raw = lines if pick(lines.columns, "model") else raw
        return raw.select(*[F.col(f"`{pick(raw.columns, f)}`").alias(f) for f in names])
    per_model = []
    for f in raw.schema.fields:
        inner = f.dataType.names
        per_model.append(F.struct(F.lit(f.name).alias("model"), *[
            F.col(f"`{f.name}`.`{pick(inner, k)}`").cast("double").alias(k) for k in ("auc", "gini", "ks")
        ]))
    return raw.select(F.explode(F.array(*per_model)).alias("r")).select("r.*")
