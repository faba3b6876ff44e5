"""Weight-of-evidence encoding, information value and scorecard points. The fitted state is a table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scores import BASE_ODDS, BASE_SCORE, PDO, iv_label, scale
from ..session import reliable
from .binning import number, quantile_edges, right_closed_pick, sql_double
from .encoding import category_counts
from .lookups import CategoryLookup

REGULARIZATION = 0.5
COLUMNS = (
    "feature", "kind", "bin", "lo", "hi", "category", "events", "non_events", "event_rate", "non_event_rate", "woe",
    "iv_component",
)


def _with_woe(stats: DataFrame, total_events: Column, total_non_events: Column, r: float) -> DataFrame:
    event_rate = (F.col("events") + F.lit(r)) / (total_events + F.lit(2 * r))
    non_event_rate = (F.col("non_events") + F.lit(r)) / (total_non_events + F.lit(2 * r))
    out = stats.withColumns({"event_rate": event_rate, "non_event_rate": non_event_rate})
    out = out.withColumn("woe", F.log(F.col("non_event_rate") / F.col("event_rate")))
    out = out.withColumn("iv_component", (F.col("non_event_rate") - F.col("event_rate")) * F.col("woe"))
    return out.select(*COLUMNS)


def bin_counts(df: DataFrame, edges: dict[str, list[float]], target: str) -> DataFrame:
    """(feature, bin, events, non_events) of right-closed bins, the first one closed on both sides.

    Tasks look up whole columns in the edges of a feature and emit one row per bin, so no row is copied per feature.
    """
    names, cuts = list(edges), [np.array(e, float) for e in edges.values()]

    def run(batches):
        sums = [np.zeros((2, len(c) - 1), np.int64) for c in cuts]
        for batch in batches:
            y = batch.column(0).to_numpy(zero_copy_only=False)
            for i, c in enumerate(cuts):
                x = batch.column(i + 1).to_numpy(zero_copy_only=False).astype(float)  # NULL becomes NaN, which no bin holds
                inside = (x >= c[0]) & (x <= c[-1])
                at = np.searchsorted(c[1:-1], x[inside], side="left")
                for k in (0, 1):
                    sums[i][k] += np.bincount(at[y[inside] == 1 - k], minlength=len(c) - 1)
        rows = [(f, b, int(e), int(n)) for f, s in zip(names, sums, strict=True) for b, (e, n) in enumerate(s.T) if e or n]
        columns = zip([pa.string(), pa.int32(), pa.int64(), pa.int64()], zip(*rows) if rows else [()] * 4, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for t, v in columns], names=["feature", "bin", "events", "non_events"])

    y = F.col(target)
    read = df.where(y.isNotNull()).select(y.cast("int").alias("_y"), *[F.expr(number(f)).cast("double").alias(f"_{i}") for i, f in enumerate(names)])
    found = read.mapInArrow(run, "feature string, bin int, events long, non_events long")
    return found.groupBy("feature", "bin").agg(F.sum("events").alias("events"), F.sum("non_events").alias("non_events"))


def fit_numeric(
    df: DataFrame, features: list[str], target: str, bins: int = 10, r: float = REGULARIZATION
) -> DataFrame:
    """WoE table of numeric features: quantile bins, NULLs excluded, empty bins smoothed like the rest.

    A feature without values or with a single distinct value has no bins.
    """
    spark = df.sparkSession
    edges = {f: e for f, e in quantile_edges(df.where(F.col(target).isNotNull()), features, bins).items() if len(e) > 1}
    grid_rows = [
        (f, i, float(e[i]), float(e[i + 1])) for f, e in edges.items() for i in range(len(e) - 1)
    ]
    grid = spark.createDataFrame(grid_rows, "feature string, bin int, lo double, hi double")
    counted = bin_counts(df, edges, target)
    # Bounded by features x bins on both sides.
    stats = grid.join(F.broadcast(counted), ["feature", "bin"], "left").select(
        "feature", F.lit("numeric").alias("kind"), "bin", "lo", "hi", F.lit(None).cast("string").alias("category"),
        F.coalesce("events", F.lit(0)).alias("events"), F.coalesce("non_events", F.lit(0)).alias("non_events"),
    )
    of_feature = Window.partitionBy("feature")
    return _with_woe(stats, F.sum("events").over(of_feature), F.sum("non_events").over(of_feature), r)


def fit_categorical(df: DataFrame, features: list[str], target: str, r: float = REGULARIZATION) -> DataFrame:
    """WoE table of text features: every category is a bin, NULLs excluded."""
    y = F.col(target)
    counted = category_counts(
        df.where(y.isNotNull()).select(target, *features), features,
        F.count_if(y == 1).alias("events"), F.count_if(y == 0).alias("non_events"),
    )
    totals = counted.groupBy("feature").agg(F.sum("events").alias("_te"), F.sum("non_events").alias("_tn"))
    stats = counted.join(F.broadcast(totals), "feature").select(
        "feature", F.lit("categorical").alias("kind"), F.lit(None).cast("int").alias("bin"),
        F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"), "category", "events",
        "non_events", "_te", "_tn",
    )
    return _with_woe(stats, F.col("_te"), F.col("_tn"), r)


class WoeModel:
    """Fitted encoder: a WoE table plus the features it was asked to fit.

    The table is finished when ``fit`` returns, so no later use reads the training data again: numeric bins are a
    local table of features x bins rows, categories are written to the shared checkpoint folder.
    """

    def __init__(self, table: DataFrame, features: list[str]):
        self.table = table
        self.features = list(features)

    @classmethod
    def fit(cls, df: DataFrame, target: str, numeric=(), categorical=(), bins: int = 10, r: float = REGULARIZATION):
        parts = []
        if numeric:
            made = fit_numeric(df, list(numeric), target, bins, r)
            parts.append(df.sparkSession.createDataFrame(made.collect(), made.schema))
        if categorical:
            parts.append(reliable(fit_categorical(df, list(categorical), target, r)))
        table = parts[0]
        for p in parts[1:]:
            table = table.unionByName(p)
        return cls(table, [*numeric, *categorical])

    def only(self, features: list[str]) -> "WoeModel":
        """The encoder of some of its features."""
        return WoeModel(self.table.where(F.col("feature").isin(features)), features)

    def numeric_bins(self) -> dict[str, list[tuple[float, float, float]]]:
        """(lo, hi, woe) per numeric feature in bin order: at most features x bins rows."""
        rows = self.table.where(F.col("kind") == "numeric").select("feature", "bin", "lo", "hi", "woe").collect()
        out: dict[str, list] = {}
        for r in sorted(rows, key=lambda r: (r["feature"], r["bin"])):
            out.setdefault(r["feature"], []).append((r["lo"], r["hi"], r["woe"]))
        return out

    def transform(self, df: DataFrame, only: list[str] | None = None, suffix: str = "", fill: float | None = None):
        """Replace (or add with a suffix) features by their WoE.

        NULL, out-of-range and unseen values become ``fill`` (NULL by default).
        """
        chosen = set(self.features if only is None else only)
        numeric = {f: b for f, b in self.numeric_bins().items() if f in chosen and f in df.columns}
        exprs = {}
        for f, bins in numeric.items():
            edges = [b[0] for b in bins] + [bins[-1][1]]
            exprs[f"{f}{suffix}"] = right_closed_pick(number(f), edges, [sql_double(b[2]) for b in bins], "double")
        types = dict(df.dtypes)
        texts = [f for f in self.features if f in chosen and f in types and types[f] == "string" and f not in numeric]
        if texts:
            cats = self.table.where((F.col("kind") == "categorical") & F.col("feature").isin(texts))
            df = CategoryLookup(cats, "woe").attach(df, {f: f"_woe_{f}" for f in texts})
            exprs.update({f"{f}{suffix}": F.col(f"_woe_{f}") for f in texts})
        if fill is not None:
            exprs = {k: F.coalesce(v, F.lit(fill)) for k, v in exprs.items()}
        # A constant feature has no bins: its evidence is missing, not its raw value.
        for f in chosen - set(numeric) - set(texts):
            if f in df.columns:
                exprs[f"{f}{suffix}"] = F.lit(fill).cast("double")
        return df.withColumns(exprs).drop(*[f"_woe_{f}" for f in texts])

    def iv_summary(self) -> DataFrame:
        """Information value and its label per feature; order by ``iv`` to rank."""
        spark = self.table.sparkSession
        asked = spark.createDataFrame([(f,) for f in self.features], "feature string")
        found = self.table.groupBy("feature").agg(F.sum("iv_component").alias("iv"))
        iv = F.coalesce("iv", F.lit(0.0))
        return asked.join(found, "feature", "left").select(
            "feature", iv.alias("iv"), iv_label(iv).alias("predictive_power")
        )

    def select_by_iv(self, floor: float = 0.02) -> list[str]:
        """Features with IV of at least ``floor``, strongest first."""
        kept = self.iv_summary().where(F.col("iv") >= floor).collect()
        return [r["feature"] for r in sorted(kept, key=lambda r: (-r["iv"], r["feature"]))]

    def save(self, path: str) -> None:
        self.table.write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "WoeModel":
        table = spark.read.parquet(path)
        features = [r["feature"] for r in table.select("feature").distinct().collect()]
        return cls(table, sorted(features))


def scorecard_points(
    table: DataFrame, coefficients: dict[str, float], intercept: float, pdo=PDO, base_score=BASE_SCORE,
    base_odds=BASE_ODDS,
) -> DataFrame:
    """Points of every (feature, bin); features without WoE rows simply do not appear.

    The base is spread evenly over all coefficients, so dropping one changes no other feature.
    """
    factor, offset = scale(pdo, base_score, base_odds)
    base = (offset + factor * intercept) / len(coefficients)
    spark = table.sparkSession
    coefs = spark.createDataFrame([(k, float(v)) for k, v in coefficients.items()], "feature string, coef double")
    return table.join(F.broadcast(coefs), "feature").select(
        "feature", "bin", "lo", "hi", "category",
        F.round("woe", 4).alias("woe"),
        F.round("coef", 4).alias("coefficient"),
        F.round(F.lit(base) + F.lit(factor) * F.col("coef") * F.col("woe"), 1).alias("points"),
    )


def fold_scaler(coefficients: dict[str, float], intercept: float, means: dict[str, float], stds: dict[str, float]):
    """Coefficients on raw WoE equal to those learnt on standardised WoE."""
    raw = {f: c / (stds[f] or 1.0) for f, c in coefficients.items()}
    return raw, intercept - sum(raw[f] * means[f] for f in raw)
