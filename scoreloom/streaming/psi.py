"""Stability of a score over event-time windows against a fixed baseline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scores import psi_status
from ..operators.binning import equal_width_bin
from ..operators.monitoring import psi_from_counts


def baseline_range(baseline: DataFrame, value: str) -> tuple[float, float]:
    row = baseline.agg(F.min(value).alias("lo"), F.max(value).alias("hi")).first()
    return float(row["lo"]), float(row["hi"])


def bin_counts(df: DataFrame, value: str, lo: float, hi: float, bins: int, keys=()) -> DataFrame:
    """Rows per baseline bin; values beyond the baseline range fall into the outer bins."""
    b = equal_width_bin(f"`{value}`", lo, hi, bins)
    return df.where(F.col(value).isNotNull()).groupBy(*keys, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def windowed_counts(
    stream: DataFrame, ts: str, value: str, lo: float, hi: float, bins: int = 10, window: str = "7 days", late: str = "1 day"
) -> DataFrame:
    """Counts per tumbling window and bin; state is one row per open window and bin."""
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    return bin_counts(timed, value, lo, hi, bins, keys=[F.window(ts, window).alias("w")]).select(
        F.col("w.start").alias("window_start"), "bin", "n"
    )


def start_counts_sink(counts: DataFrame, path: str, checkpoint: str, available_now: bool = True):
    """Store the windows and bins that each batch changes (update mode), under the number of the batch.

    A batch that is run again after a failure overwrites its own folder, so counts are exact. State of a window is
    dropped when the watermark passes it.
    """

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(put)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def stored_counts(spark: SparkSession, path: str) -> DataFrame:
    """The latest count of every window and bin."""
    rows = spark.read.schema("window_start timestamp, bin int, n long, batch long").parquet(path)
    return rows.groupBy("window_start", "bin").agg(F.max_by("n", "batch").alias("n"))


def psi_by_window(counts: DataFrame, baseline_counts: DataFrame, bins: int = 10) -> DataFrame:
    """PSI of every window against the baseline. Both inputs hold at most one row per bin (and window)."""
    base = baseline_counts.select(F.col("bin").alias("_b"), F.col("n").alias("_e"))
    filled = counts.groupBy("window_start").agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("m"))
    grid = filled.select("window_start", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "m").select(
        "window_start", "bin", F.coalesce(F.try_element_at("m", F.col("bin")), F.lit(0)).alias("n_a")
    )
    both = grid.join(F.broadcast(base), F.col("bin") == F.col("_b"), "left").select(
        "window_start", "bin", "n_a", F.coalesce("_e", F.lit(0)).alias("n_e")
    )
    out = psi_from_counts(both, ["window_start"], bins)
    return out.withColumn("status", psi_status(F.col("psi")))
