"""Writing results."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by=(), mode: str = "overwrite") -> None:
    """Feature tables, predictions, PSI, IV and WoE tables: Parquet by default, CSV with a header on request."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def write_metrics(df: DataFrame, path: str) -> None:
    """Metric records as JSON lines."""
    df.write.mode("overwrite").json(path)
