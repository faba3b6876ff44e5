"""Population stability and drift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.aggregates import ratio
from ..functions.scores import psi_status
from ..functions.sqltext import literal
from .binning import equal_width_bin, equal_width_sql
from .features import numeric_columns
from .ranking import cumulate_cells, settled_cells, value_cell

NO_VALUE = -(2**31)  # cell of missing values, below all others
SHARE_FLOOR = 1e-4
MIN_ROWS = 50

# Monitoring plan (metric, bound on the metric, severity rank, action).
TRIGGERS = (
    ("score_psi", ">", 0.10, 1, "Investigate"),
    ("score_psi", ">", 0.25, 2, "Retrain"),
    ("gini", "<", 0.50, 1, "Investigate"),
    ("gini", "<", 0.40, 2, "Retrain"),
    ("default_rate_shift", "abs>", 0.02, 1, "Recalibrate"),
    ("segment_auc_gap", ">", 0.05, 1, "Fairness review"),
    ("feature_psi", ">", 0.25, 1, "Feature review"),
)


def shared_numeric(baseline: DataFrame, current: DataFrame) -> list[str]:
    """Numeric columns present on both sides, keys and target left out."""
    other = set(numeric_columns(current))
    return [c for c in numeric_columns(baseline) if c in other]


def stack_sides(baseline: DataFrame, current: DataFrame, features: list[str]) -> DataFrame:
    """Both frames under each other as doubles with ``side`` 0 (baseline) or 1 (current)."""
    side = lambda df, v: df.select(
        F.lit(v).alias("side"), *[F.col(c).cast("double").alias(c) for c in features]
    )
    return side(baseline, 0).unionByName(side(current, 1))


def psi_component(expected: Column, actual: Column) -> Column:
    e, a = F.greatest(expected, F.lit(SHARE_FLOOR)), F.greatest(actual, F.lit(SHARE_FLOOR))
    return (a - e) * F.log(a / e)


def psi_from_counts(counts: DataFrame, keys: list[str], bins: int, expected: str = "n_e", actual: str = "n_a") -> DataFrame:
    """PSI per key from a frame (keys, bin, n_e, n_a).

    A bin without rows on either side has both shares at the floor and adds nothing, so it need not
    be present; the per-key lists are bounded by ``bins``.
    """
    per = counts.groupBy(*keys).agg(
        F.sum(expected).alias("n_expected"), F.sum(actual).alias("n_actual"),
        F.array_sort(F.collect_list(F.struct(F.col("bin").alias("b"), F.col(expected).alias("e"), F.col(actual).alias("a")))).alias("_bins"),
    )
    return per.select(*keys, "n_expected", "n_actual", psi_of_bins("_bins", F.col("n_expected"), F.col("n_actual")).alias("psi"))


def psi_of_bins(bins: str, n_e: Column, n_a: Column) -> Column:
    """PSI of an array of bins (.., e, a) with the totals of both sides."""
    total = F.aggregate(
        bins, F.lit(0.0), lambda acc, s: acc + psi_component(ratio(s["e"], n_e, F.lit(0.0)), ratio(s["a"], n_a, F.lit(0.0)))
    )
    return F.round(total, 4)


def psi_features(
    baseline: DataFrame, current: DataFrame, features: list[str] | None = None, bins: int = 10, min_rows: int = MIN_ROWS
) -> DataFrame:
    """PSI of every shared numeric column over equal-width bins of the pooled range.

    Two passes for all columns together: one for the ranges (one row to the driver), one for the bin
    counts. Columns with fewer than ``min_rows`` values on a side are left out.
    """
    features = features or shared_numeric(baseline, current)
    spark = baseline.sparkSession
    empty = "feature string, n_expected long, n_actual long, psi double, status string"
    if not features:
        return spark.createDataFrame([], empty)
    both = stack_sides(baseline, current, features)
    span = both.agg(
        *[F.min(c).alias(f"lo_{i}") for i, c in enumerate(features)],
        *[F.max(c).alias(f"hi_{i}") for i, c in enumerate(features)],
    ).first()
    ranged = {c: (span[f"lo_{i}"], span[f"hi_{i}"]) for i, c in enumerate(features) if span[f"lo_{i}"] is not None}
    if not ranged:
        return spark.createDataFrame([], empty)
    binned = both.select("side", *[equal_width_bin(f"`{c}`", lo, hi, bins).alias(c) for c, (lo, hi) in ranged.items()])
    counts = (
        binned.unpivot(["side"], list(ranged), "feature", "bin").where(F.col("bin").isNotNull())
        .groupBy("feature", "bin")
        .agg(F.count_if(F.col("side") == 0).alias("n_e"), F.count_if(F.col("side") == 1).alias("n_a"))
    )
    out = psi_from_counts(counts, ["feature"], bins)
    return out.where((F.col("n_expected") >= min_rows) & (F.col("n_actual") >= min_rows)).withColumn(
        "status", psi_status(F.col("psi"))
    )


def psi_score(baseline: DataFrame, current: DataFrame, score: str, bins: int = 10) -> DataFrame:
    """PSI and status of one score column."""
    return psi_features(baseline, current, [score], bins, min_rows=1)


def psi_report(psi: DataFrame) -> DataFrame:
    """Number and sorted names of features per status (bounded by the number of columns)."""
    return psi.groupBy("status").agg(
        F.count(F.lit(1)).alias("n_features"),
        F.array_join(F.array_sort(F.collect_list("feature")), ",").alias("features"),
    )


def drift_table(
    baseline: DataFrame, current: DataFrame, features: list[str] | None = None, bins: int = 10
) -> DataFrame:
    """Per shared numeric column: PSI, two-sample KS, moments, missing share, distinct values, range. NaN is missing.

    One pass counts the cells, whose table gives the moments; a second one ranks the values, from which KS, distinct
    values and the bins of the PSI come together.
    """
    features = features or shared_numeric(baseline, current)
    if not features:
        columns = [f"{m}_{tag} double" for tag in ("base", "cur") for m in ("mean", "std", "min", "max", "missing")]
        rest = "ks double, distinct_base long, distinct_cur long, psi double, status string, mean_shift double"
        return baseline.sparkSession.createDataFrame([], f"feature string, {', '.join(columns)}, {rest}")
    tags = {"base": 0, "cur": 1}
    long = stack_sides(baseline, current, features).unpivot(["side"], features, "feature", "value")
    long = long.withColumn("value", F.when(~F.isnan("value"), F.col("value")))
    v = F.col("value")
    totals, extra = {}, {}
    for tag, side in tags.items():
        p = F.col("side") == side
        x = F.when(p, v)
        totals[f"n_{tag}"] = F.when(p & v.isNotNull(), 1).otherwise(0)
        extra |= {
            f"avg_{tag}": F.avg(x), f"m2_{tag}": F.var_pop(x) * F.count(x), f"min_{tag}": F.min(x), f"max_{tag}": F.max(x), f"rows_{tag}": F.count_if(p),
        }
    cells = settled_cells(long, ["feature"], "value", totals, F.coalesce(value_cell(v), F.lit(NO_VALUE)), extra)
    shape = _moments(cells.table, tags).collect()  # a row per column
    ranked = cumulate_cells(cells._replace(rows=cells.rows.where(v.isNotNull())), ["feature"], "value", totals)
    whole = baseline.sparkSession.createDataFrame(shape, _moments(cells.table, tags).schema)
    ranges = {}
    for r in shape:
        ends = [r[f"{m}_{tag}"] for m in ("min", "max") for tag in tags if r[f"{m}_{tag}"] is not None]
        if ends:
            ranges[r["feature"]] = (min(ends), max(ends))
    n = lambda tag: F.col(f"n_{tag}")
    share = lambda tag: (n(tag) + F.col(f"n_{tag}_before")) / F.when(F.col(f"n_{tag}_all") > 0, F.col(f"n_{tag}_all"))
    bin_of = " ".join(f"WHEN {literal(f)} THEN {equal_width_sql('value', lo, hi, bins)}" for f, (lo, hi) in ranges.items())
    ranked = ranked.withColumn("_bin", F.expr(f"CASE feature {bin_of} END") if ranges else F.lit(None).cast("int"))
    counted = ranked.groupBy("feature").agg(
        F.max(F.abs(share("base") - share("cur"))).alias("ks"),
        *[F.count_if(n(tag) > 0).alias(f"distinct_{tag}") for tag in tags],
        F.max("n_base_all").alias("_e"), F.max("n_cur_all").alias("_a"),
        F.array(*[F.struct(F.sum(F.when(F.col("_bin") == b, n("base"))).alias("e"), F.sum(F.when(F.col("_bin") == b, n("cur"))).alias("a")) for b in range(bins)]).alias("_bins"),
    )
    psi = F.when((F.col("_e") > 0) & (F.col("_a") > 0), psi_of_bins("_bins", F.col("_e"), F.col("_a")))
    counted = counted.withColumn("psi", psi).drop("_bins", "_e", "_a").withColumn("status", F.when(F.col("psi").isNotNull(), psi_status(F.col("psi"))))
    shift = F.when(F.col("std_base") > 0, (F.col("mean_cur") - F.col("mean_base")) / F.col("std_base"))
    return F.broadcast(whole).join(counted, "feature", "left").withColumn("mean_shift", shift)


def _moments(cells: DataFrame, tags) -> DataFrame:
    """Mean, deviation, range and missing share of every column and side from its cells, merged around the mean."""
    of = Window.partitionBy("feature")  # over the cell table
    mean = {tag: F.sum(F.col(f"avg_{tag}") * F.col(f"n_{tag}")).over(of) / F.nullif(F.sum(f"n_{tag}").over(of), F.lit(0)) for tag in tags}
    cells = cells.withColumns({f"mean_{tag}": m for tag, m in mean.items()})
    out = []
    for tag in tags:
        n, off = F.col(f"n_{tag}"), F.col(f"avg_{tag}") - F.col(f"mean_{tag}")
        spread = F.sum(F.col(f"m2_{tag}") + n * off * off)
        out += [
            F.max(f"mean_{tag}").alias(f"mean_{tag}"), F.when(F.sum(n) > 1, F.sqrt(spread / (F.sum(n) - 1))).alias(f"std_{tag}"),
            F.min(f"min_{tag}").alias(f"min_{tag}"), F.max(f"max_{tag}").alias(f"max_{tag}"),
            ratio(F.sum(f"rows_{tag}") - F.sum(n), F.sum(f"rows_{tag}")).alias(f"missing_{tag}"),
        ]
    return cells.groupBy("feature").agg(*out)


def monitor_triggers(metrics: DataFrame) -> DataFrame:
    """Alerts of a long (subject, metric, value) frame: the most severe rule each metric breaks."""
    v, m = F.col("value"), F.col("metric")
    broken = []
    for metric, op, bound, rank, action in TRIGGERS:
        test = {">": v > bound, "<": v < bound, "abs>": F.abs(v) > bound}[op]
        broken.append(F.when(
            (m == metric) & test, F.struct(F.lit(rank).alias("severity"), F.lit(bound).alias("bound"), F.lit(action).alias("action"))
        ))
    # greatest skips NULLs and compares structs by severity first
    worst = F.greatest(*broken)
    return metrics.withColumn("_w", worst).where(F.col("_w").isNotNull()).select(
        "subject", "metric", "value", F.col("_w.severity").alias("severity"), F.col("_w.bound").alias("bound"),
        F.col("_w.action").alias("action"),
    )
