"""Group comparisons of a scored frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.aggregates import dbl, ratio
from ..functions.scores import gap_status
from .binning import interval_labels
from .metrics import segment_performance, unpivot_text

# Age bands of the audit and of the interactive report, and score bands.
AUDIT_AGES = ([18, 30, 45, 60, 100], ["18-30", "31-45", "46-60", "60+"])
REPORT_AGES = ([18, 30, 40, 50, 60, 100], ["18-30", "31-40", "41-50", "51-60", "60+"])
EDA_AGES = ([18, 25, 35, 45, 55, 65, 100], ["18-25", "26-35", "36-45", "46-55", "56-65", "65+"])
SCORE_BANDS = (
    [300, 450, 550, 620, 680, 750, 850], ["300-450", "450-550", "550-620", "620-680", "680-750", "750-850"],
)
HISTORY_BANDS = ([-1, 0, 2, 5, 10, 100], ["None", "1-2", "3-5", "6-10", "10+"])
CUT = 0.5
MIN_GROUP = 50


def with_age_band(df: DataFrame, profile=AUDIT_AGES, whole_years: bool = False, out: str = "AGE_BAND") -> DataFrame:
    age = "-DAYS_BIRTH / 365.25D"
    return df.withColumn(out, interval_labels(f"CAST({age} AS INT)" if whole_years else f"({age})", *profile))


def fairness_auc(df: DataFrame, segments: list[str], scores: dict[str, str], target: str, min_n: int = 0) -> DataFrame:
    """AUC of every model in every group."""
    return segment_performance(df, segments, scores, target, min_n)


def parity_gap(group_auc: DataFrame) -> DataFrame:
    """Smallest and largest AUC per model and segment, the gap and its verdict."""
    agg = group_auc.groupBy("model", "segment").agg(F.min("auc").alias("min_auc"), F.max("auc").alias("max_auc"))
    gap = F.round(F.col("max_auc") - F.col("min_auc"), 4)
    return agg.withColumn("gap", gap).withColumn("status", gap_status(F.col("gap")))


def acceptance_rate(df: DataFrame, segments: list[str], score: str, cut: float = CUT) -> DataFrame:
    """Share flagged (score at or above the cut) and accepted (below it) per group."""
    s = F.col(score)
    long = unpivot_text(df.where(s.isNotNull()), segments, ("segment", "segment_value"), [score])
    agg = long.where(F.col("segment_value").isNotNull()).groupBy("segment", "segment_value").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(s >= cut).alias("_f"), F.count_if(s < cut).alias("_a")
    )
    return agg.select(
        "segment", "segment_value", "n",
        (dbl(F.col("_f")) / F.col("n")).alias("flagged_rate"), (dbl(F.col("_a")) / F.col("n")).alias("accepted_rate"),
    )


def disparate_impact(df: DataFrame, segments: list[str], score: str, cut: float = CUT, min_n: int = MIN_GROUP) -> DataFrame:
    """Smallest over largest flagged rate among groups of more than ``min_n`` rows; NULL below two groups."""
    groups = acceptance_rate(df, segments, score, cut).where(F.col("n") > min_n)
    agg = groups.groupBy("segment").agg(
        F.count(F.lit(1)).alias("groups"), F.min("flagged_rate").alias("lo"), F.max("flagged_rate").alias("hi")
    )
    di = F.when(F.col("groups") >= 2, ratio(F.col("lo"), F.col("hi")))
    return agg.select("segment", "groups", di.alias("impact_ratio"), (di >= 0.8).cast("int").alias("passes_80_rule"))


def banded_rate(df: DataFrame, value: str, profile, target: str) -> DataFrame:
    """Count and default rate of every band of a SQL expression, empty bands kept."""
    edges, labels = profile
    y = F.col(target)
    agg = df.groupBy(interval_labels(value, edges, labels).alias("band")).agg(
        F.count(y).alias("n"), F.count_if(y == 1).alias("defaults")
    )
    bands = df.sparkSession.createDataFrame([(i, b) for i, b in enumerate(labels)], "band_no int, band string")
    n, d = F.coalesce("n", F.lit(0)), F.coalesce("defaults", F.lit(0))
    # Both sides have one row per band.
    return bands.join(F.broadcast(agg), "band", "left").select(
        "band_no", "band", n.alias("n"), d.alias("defaults"), ratio(d, n).alias("default_rate")
    )


def score_band_rate(df: DataFrame, score: str, target: str) -> DataFrame:
    return banded_rate(df, f"`{score}`", SCORE_BANDS, target)
