"""Exploratory tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.aggregates import dbl, ratio
from .binning import equal_width_sql
from .fairness import HISTORY_BANDS, banded_rate
from .features import numeric_columns
from .metrics import unpivot_text
from .ranking import exact_quantiles, two_sample_ks


def segment_default_rate(df: DataFrame, segments: list[str], target: str) -> DataFrame:
    """N, defaults and rate per value of every segment column; NULL values left out."""
    long = unpivot_text(df, segments, ("segment", "segment_value"), [target])
    y = F.col(target)
    return long.where(F.col("segment_value").isNotNull()).groupBy("segment", "segment_value").agg(
        F.count(y).alias("n"), F.count_if(y == 1).alias("defaults"),
        ratio(F.count_if(y == 1), F.count(y)).alias("default_rate"),
    )


def history_band_rate(df: DataFrame, count_col: str, overdue_col: str, target: str) -> DataFrame:
    """Default rate by band of history records and by presence of overdue amounts."""
    bands = banded_rate(df, f"coalesce(`{count_col}`, 0)", HISTORY_BANDS, target)
    y = F.col(target)
    has = F.when(F.coalesce(F.col(overdue_col), F.lit(0.0)) > 0, "Has overdue").otherwise("No overdue")
    flags = df.groupBy(has.alias("band")).agg(F.count(y).alias("n"), F.count_if(y == 1).alias("defaults"))
    return bands.select(F.lit("history_count").alias("profile"), "band", "n", "defaults", "default_rate").unionByName(
        flags.select(
            F.lit("overdue").alias("profile"), "band", "n", "defaults",
            ratio(F.col("defaults"), F.col("n")).alias("default_rate"),
        )
    )


def _one_row_to_long(row: DataFrame, names: list[str], fields: dict[str, str]) -> DataFrame:
    """Turn a one-row frame with columns ``<prefix><i>`` into one row per name."""
    per = F.array(*[
        F.struct(F.lit(n).alias("feature"), *[F.col(f"{p}{i}").alias(out) for out, p in fields.items()])
        for i, n in enumerate(names)
    ])
    return row.select(F.explode(per).alias("r")).select("r.*")


def missing_rate(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Share of NULLs per column with its severity flags, columns without NULLs left out."""
    columns = columns or df.columns
    total = F.count(F.lit(1))
    row = df.agg(*[
        x for i, c in enumerate(columns)
        for x in ((total - F.count(c)).alias(f"m{i}"), ratio(total - F.count(c), total).alias(f"r{i}"))
    ])
    out = _one_row_to_long(row, columns, {"missing": "m", "missing_rate": "r"}).where(F.col("missing_rate") > 0)
    return out.withColumns({
        "over_30": (F.col("missing_rate") > 0.3).cast("int"), "over_50": (F.col("missing_rate") > 0.5).cast("int"),
    })


def missing_summary(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Number of columns with any, more than 30 % and more than 50 % missing."""
    m = missing_rate(df, columns)
    return m.agg(
        F.count(F.lit(1)).alias("any_missing"), F.coalesce(F.sum("over_30"), F.lit(0)).alias("over_30"),
        F.coalesce(F.sum("over_50"), F.lit(0)).alias("over_50"),
    )


PAIR_SUMS = ("n", "sx", "sy", "sxx", "syy", "sxy")


def pair_sums(df: DataFrame, features: list[str]) -> DataFrame:
    """left_feature, right_feature and, over rows where both are given: n, sums, squares and products.

    Values are taken from the feature's mean, so nothing cancels. Each task multiplies blocks of rows as matrices
    and sends one row per pair, whatever the number of columns; NULL and NaN count as missing. The sums of masks
    over rows where both are missing are in ``both_missing``.
    """
    if len(features) < 2:
        return df.sparkSession.createDataFrame([], "left_feature string, right_feature string, " + ", ".join(f"{s} double" for s in (*PAIR_SUMS, "both_missing")))
    given = df.select(*[F.expr(f"nanvl(CAST(`{c}` AS DOUBLE), NULL)").alias(f"c{i}") for i, c in enumerate(features)])
    mean = given.agg(*[F.avg(c) for c in given.columns]).first()
    centre = np.array([0.0 if m is None else m for m in mean])
    left, right = np.triu_indices(len(features), 1)
    names = ["i", "j", *PAIR_SUMS, "both_missing"]

    def run(batches):
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                x = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in part.columns], 1) - centre
                here = ~np.isnan(x)
                x = np.where(here, x, 0.0)
                m = here.astype(float)
                gram = np.stack([m.T @ m, x.T @ m, m.T @ x, (x * x).T @ m, m.T @ (x * x), x.T @ x, (1 - m).T @ (1 - m)])
                total = gram if total is None else total + gram
        if total is not None:
            columns = [left.astype(np.int32), right.astype(np.int32), *(g[left, right] for g in total)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    parts = given.mapInArrow(run, "i int, j int, " + ", ".join(f"{s} double" for s in names[2:]))
    sums = parts.groupBy("i", "j").agg(*[F.sum(s).alias(s) for s in names[2:]])
    # As many rows as features, so this is a bounded broadcast.
    label = F.broadcast(df.sparkSession.createDataFrame(list(enumerate(features)), "k int, f string"))
    for side, out in (("i", "left_feature"), ("j", "right_feature")):
        sums = sums.join(label.select(F.col("k").alias(side), F.col("f").alias(out)), side)
    return sums.select("left_feature", "right_feature", *names[2:])


def comissing_pairs(df: DataFrame, columns: list[str], limit: int | None = None) -> DataFrame:
    """Rows in which two columns are NULL together, for all pairs of the columns (or of the first ``limit``)."""
    columns = columns if limit is None else columns[:limit]
    masks = df.select(*[F.when(F.col(c).isNotNull(), 1.0).alias(c) for c in columns])
    return pair_sums(masks, columns).select("left_feature", "right_feature", F.col("both_missing").cast("long").alias("both_missing"))


def class_balance(df: DataFrame, target: str) -> DataFrame:
    """Count and share per class with the negative-to-positive ratio beside them."""
    y = F.col(target)
    row = df.where(y.isNotNull()).agg(F.count_if(y == 0).alias("c0"), F.count_if(y == 1).alias("c1"))
    total = F.col("c0") + F.col("c1")
    per = F.array(*[
        F.struct(F.lit(k).alias("class"), F.col(f"c{k}").alias("n"), ratio(F.col(f"c{k}"), total).alias("share"),
                 ratio(F.col("c0"), F.col("c1")).alias("imbalance"))
        for k in (0, 1)
    ])
    return row.select(F.explode(per).alias("r")).select("r.*")


def top(df: DataFrame, by: str, k: int, name: str = "feature") -> DataFrame:
    """The ``k`` rows of the largest ``by``, ties by name: ranked missing rates, information values, VIF, segments, coefficients."""
    return df.where(F.col(by).isNotNull()).orderBy(F.desc(by), name).limit(k)


def preview(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """The first rows by key."""
    return df.orderBy(key).limit(n)


def corr_target(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """Pearson correlation with the target over pairwise complete rows, all features in one aggregate."""
    y = F.col(target).cast("double")
    row = df.agg(*[F.corr(F.col(c).cast("double"), y).alias(f"c{i}") for i, c in enumerate(features)])
    out = _one_row_to_long(row, features, {"corr": "c"})
    return out.withColumn("abs_corr", F.abs("corr"))


def top_corr(df: DataFrame, features: list[str], target: str, k: int = 20) -> DataFrame:
    return corr_target(df, features, target).where(F.col("corr").isNotNull()).orderBy(F.desc("abs_corr"), "feature").limit(k)


def corr_pairs(df: DataFrame, features: list[str], threshold: float | None = None) -> DataFrame:
    """Correlation of every feature pair over pairwise complete rows, optionally only |r| above the threshold."""
    sums = pair_sums(df, features)
    spread = lambda s, ss: F.greatest(F.col(ss) - F.col(s) * F.col(s) / F.col("n"), F.lit(0.0))
    both = F.sqrt(spread("sx", "sxx") * spread("sy", "syy"))
    corr = F.when((F.col("n") > 0) & (both > 0), (F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")) / both)
    out = sums.select("left_feature", "right_feature", corr.alias("corr"))
    return out if threshold is None else out.where(F.abs("corr") > threshold)


def hist_by_class(df: DataFrame, features: list[str], target: str, bins: int = 50) -> DataFrame:
    """Density histogram of every feature per class, each over its own range; empty bins absent."""
    y = F.col(target)
    base = df.where(y.isin(0, 1)).select(y.cast("int").alias("cls"), *[F.col(c).cast("double").alias(c) for c in features])
    span = base.groupBy("cls").agg(*[
        x for i, c in enumerate(features) for x in (F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}"))
    ]).collect()  # two rows
    bounds: dict[tuple[int, str], tuple[float, float]] = {}
    for r in span:
        for i, c in enumerate(features):
            if r[f"lo{i}"] is not None:
                lo, hi = r[f"lo{i}"], r[f"hi{i}"]
                bounds[r["cls"], c] = (lo - 0.5, hi + 0.5) if lo == hi else (lo, hi)

    def own_bin(c: str):
        branches = [
            f"WHEN cls = {cls} THEN {equal_width_sql(f'`{c}`', *bounds[cls, c], bins)}" for cls in (0, 1) if (cls, c) in bounds
        ]
        return F.expr(f"CASE {' '.join(branches)} END") if branches else F.lit(None).cast("int")

    long = base.select("cls", *[own_bin(c).alias(c) for c in features])
    counts = (
        long.unpivot(["cls"], features, "feature", "bin").where(F.col("bin").isNotNull())
        .groupBy("feature", "cls", "bin").agg(F.count(F.lit(1)).alias("n"))
    )
    rows = [(c, cls, float(lo), float((hi - lo) / bins)) for (cls, c), (lo, hi) in bounds.items()]
    widths = df.sparkSession.createDataFrame(rows, "feature string, cls int, lo double, width double")
    totals = counts.groupBy("feature", "cls").agg(F.sum("n").alias("total")).join(F.broadcast(widths), ["feature", "cls"])
    return counts.join(F.broadcast(totals), ["feature", "cls"]).select(
        "feature", "cls", "bin", "n", (F.col("lo") + F.col("bin") * F.col("width")).alias("left_edge"),
        (F.col("n") / (F.col("total") * F.col("width"))).alias("density"),
    )


def ks_two_sample(df: DataFrame, features: list[str], target: str) -> DataFrame:
    return two_sample_ks(df, features, target).select("feature", "n_0", "n_1", "ks")


def describe(df: DataFrame, features: list[str] | None = None) -> DataFrame:
    """Count, mean, std, min, quartiles, max and missing share per numeric column."""
    features = features or numeric_columns(df)
    long = df.select(*[F.col(c).cast("double").alias(c) for c in features]).unpivot([], features, "feature", "value")
    v = F.col("value")
    shape = long.groupBy("feature").agg(
        F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"),
        F.max(v).alias("max"), ratio(F.count_if(v.isNull()), F.count(F.lit(1))).alias("missing_pct"),
    )
    q = exact_quantiles(df, features, [0.25, 0.5, 0.75]).select(
        "feature", F.col("edges")[0].alias("q25"), F.col("edges")[1].alias("q50"), F.col("edges")[2].alias("q75")
    )
    return shape.join(q, "feature", "left").select(
        "feature", "count", "mean", "std", "min", "q25", "q50", "q75", "max", "missing_pct"
    )


def column_profile(df: DataFrame, feature: str, target: str) -> DataFrame:
    """Statistics of one column with its target correlation (given when more than 10 complete rows exist)."""
    y = F.col(target).cast("double")
    x = F.col(feature).cast("double")
    corr = df.agg(F.when(F.count(F.when(y.isNotNull(), x)) > 10, F.corr(x, y)).alias("target_corr"))
    d = describe(df, [feature]).select(
        "feature", "mean", F.col("q50").alias("median"), "std", "min", "max", F.col("missing_pct").alias("missing")
    )
    # One row on each side.
    return d.join(F.broadcast(corr.withColumn("feature", F.lit(feature))), "feature")


def box_stats(df: DataFrame, feature: str, target: str) -> DataFrame:
    """Quartiles per class, whiskers at the furthest values within 1.5 IQR, and the outlier count."""
    base = df.where(F.col(feature).isNotNull() & F.col(target).isin(0, 1)).select(
        F.col(target).cast("int").alias("cls"), F.col(feature).cast("double").alias("x")
    )
    q = exact_quantiles(base, ["x"], [0.25, 0.5, 0.75], ["cls"]).select(
        "cls", F.col("edges")[0].alias("q1"), F.col("edges")[1].alias("q2"), F.col("edges")[2].alias("q3")
    )
    iqr = F.col("q3") - F.col("q1")
    x, lo, hi = F.col("x"), F.col("q1") - iqr * 1.5, F.col("q3") + iqr * 1.5
    inside = (x >= lo) & (x <= hi)
    return base.join(F.broadcast(q), "cls").groupBy("cls", "q1", "q2", "q3").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.when(inside, x)).alias("whisker_lo"),
        F.max(F.when(inside, x)).alias("whisker_hi"), F.count_if(~inside).alias("outliers"),
    )


def header(df: DataFrame, target: str) -> DataFrame:
    """Rows, feature count, default rate and number of columns with NULLs, in one aggregate."""
    total = F.count(F.lit(1))
    row = df.agg(
        total.alias("rows"), ratio(F.count_if(F.col(target) == 1), F.count(target)).alias("default_rate"),
        *[F.when(F.count(c) < total, 1).otherwise(0).alias(f"m{i}") for i, c in enumerate(df.columns)],
    )
    missing = sum((F.col(f"m{i}") for i in range(1, len(df.columns))), F.col("m0"))
    return row.select("rows", F.lit(len(df.columns) - 2).alias("features"), "default_rate", missing.alias("columns_with_missing"))


def feature_kinds(df: DataFrame, derived: list[str]) -> DataFrame:
    """Counts of numeric, missing-flag, target-encoded and derived columns, and of NULL cells."""
    numeric = numeric_columns(df)
    nulls = sum((F.count(F.lit(1)) - F.count(c) for c in df.columns[1:]), F.count(F.lit(1)) - F.count(df.columns[0]))
    return df.agg(
        F.lit(len(df.columns)).alias("columns"),
        F.lit(len(numeric)).alias("numeric"),
        F.lit(sum(c.startswith("MISS_") for c in df.columns)).alias("missing_flags"),
        F.lit(sum(c.startswith("TE_") or c.endswith("_TE") for c in df.columns)).alias("target_encoded"),
        F.lit(sum(c in df.columns for c in derived)).alias("derived"),
        nulls.alias("null_cells"),
    )
