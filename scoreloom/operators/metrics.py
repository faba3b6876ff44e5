"""Tables that judge a scored frame."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.aggregates import dbl, ratio
from .binning import number, quantile_edges, right_closed_bin
from .features import numeric_columns
from .ranking import discrimination, discrimination_of_groups

THRESHOLDS = (0.3, 0.4, 0.5, 0.6, 0.7)
LGD = 0.45
REACH = 39  # bandwidths; exp(-39 ** 2 / 2) is below the smallest double


def decile_table(df: DataFrame, score: str, target: str, q: int = 10) -> DataFrame:
    """Deciles by score, 1 = riskiest, with cumulative capture and lift.

    When ties merge quantile edges there are fewer deciles, still numbered from 1.
    """
    y = F.col(target)
    edges = quantile_edges(df.where(y.isNotNull()), [score], q).get(score, [])
    bins = max(len(edges) - 1, 0)
    per = (
        df.where(F.col(score).isNotNull() & y.isNotNull())
        .groupBy((F.lit(bins) - right_closed_bin(number(score), edges)).alias("decile"))
        .agg(F.count(F.lit(1)).alias("count"), F.count_if(y == 1).alias("bads"))
    )
    whole = Window.partitionBy(F.lit(0))  # over at most q rows
    upto = whole.orderBy("decile").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    overall = ratio(F.sum("bads").over(whole), F.sum("count").over(whole))
    bad_rate = dbl(F.col("bads")) / F.col("count")
    return per.select(
        "decile", "count", "bads", (F.col("count") - F.col("bads")).alias("goods"),
        bad_rate.alias("bad_rate"),
        F.sum("bads").over(upto).alias("cumul_bads"),
        ratio(F.sum("bads").over(upto), F.sum("bads").over(whole)).alias("cumul_bad_pct"),
        F.when(overall > 0, bad_rate / overall).alias("lift"),
    )


def gains_lift(deciles: DataFrame) -> DataFrame:
    """Curve points: share of population by rank, captured bads, lift and the random baselines."""
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("decile"))
    return deciles.select(
        "decile", (rank * 10).alias("population_pct"), (F.col("cumul_bad_pct") * 100).alias("captured_pct"),
        (rank * 10).cast("double").alias("random_pct"), "lift", F.lit(1.0).alias("random_lift"),
    )


def cdf_grid(df: DataFrame, score: str, target: str, points: int = 500) -> DataFrame:
    """Class CDFs (strictly below) on ``points`` thresholds from 0 to 1 with their absolute gap."""
    step = 1.0 / (points - 1)
    s, y = F.col(score).cast("double"), F.col(target)
    at = lambda i: F.when(i == points - 1, F.lit(1.0)).otherwise(i * F.lit(step))
    # First threshold strictly above the score: the estimate is off by at most one step, so the two
    # thresholds around it settle the index against the exact grid values.
    low = F.least(F.greatest(F.floor(s / step) - 1, F.lit(-1)), F.lit(points - 1)).cast("int")
    passed = lambda i: F.when((i < points) & (at(i) <= s), 1).otherwise(0)
    first_above = low + passed(low) + passed(low + 1) + passed(low + 2)
    counts = (
        df.where(s.isNotNull() & y.isNotNull()).groupBy(first_above.alias("_g"))
        .agg(F.count_if(y == 0).alias("_n"), F.count_if(y == 1).alias("_p"))
    )
    grid = df.sparkSession.range(points + 1).select(F.col("id").cast("int").alias("point"))
    whole = Window.partitionBy(F.lit(0))  # over the grid
    upto = whole.orderBy("point").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = grid.join(F.broadcast(counts), F.col("point") == F.col("_g"), "left").select(
        "point", F.coalesce("_n", F.lit(0)).alias("_n"), F.coalesce("_p", F.lit(0)).alias("_p")
    )
    cdf = filled.select(
        "point", at(F.col("point")).alias("threshold"),
        ratio(F.sum("_n").over(upto), F.sum("_n").over(whole)).alias("cdf_good"),
        ratio(F.sum("_p").over(upto), F.sum("_p").over(whole)).alias("cdf_bad"),
    )
    return cdf.where(F.col("point") < points).withColumn("gap", F.abs(F.col("cdf_bad") - F.col("cdf_good")))


def cdf_grid_ks(df: DataFrame, score: str, target: str, points: int = 500) -> DataFrame:
    """Largest class gap on the grid and the first threshold that reaches it."""
    grid = cdf_grid(df, score, target, points)
    best = F.max_by(F.struct("threshold", "gap"), F.struct(F.col("gap"), -F.col("point")))
    return grid.agg(best.alias("b")).select(F.col("b.gap").alias("ks"), F.col("b.threshold").alias("threshold"))


def confusion_thresholds(df: DataFrame, score: str, target: str, thresholds=THRESHOLDS) -> DataFrame:
    """tn, fp, fn, tp, sensitivity and specificity at each threshold: one pass, no row copies."""
    s, y = F.col(score), F.col(target)
    aggs = []
    for i, t in enumerate(thresholds):
        hit = s >= F.lit(float(t))
        for name, p in (("tn", ~hit & (y == 0)), ("fp", hit & (y == 0)), ("fn", ~hit & (y == 1)), ("tp", hit & (y == 1))):
            aggs.append(F.count_if(p).alias(f"{name}{i}"))
    row = df.agg(*aggs)
    per = F.explode(F.array(*[
        F.struct(F.lit(float(t)).alias("threshold"), *[F.col(f"{n}{i}").alias(n) for n in ("tn", "fp", "fn", "tp")])
        for i, t in enumerate(thresholds)
    ]))
    c = F.col
    return row.select(per.alias("r")).select("r.*").select(
        "threshold", "tn", "fp", "fn", "tp",
        ratio(c("tp"), c("tp") + c("fn"), F.lit(0.0)).alias("sensitivity"),
        ratio(c("tn"), c("tn") + c("fp"), F.lit(0.0)).alias("specificity"),
    )


def calibration(df: DataFrame, score: str, target: str, bins: int = 10) -> DataFrame:
    """Mean predicted and observed rate per uniform bin of [0, 1]; empty bins are absent."""
    edges = [i / bins for i in range(bins + 1)]
    s, y = F.col(score).cast("double"), F.col(target)
    return (
        df.where(s.isNotNull() & y.isNotNull())
        .groupBy(right_closed_bin(number(score), edges).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"), F.avg(s).alias("mean_predicted"),
             ratio(F.count_if(y == 1), F.count(F.lit(1))).alias("observed_rate"))
        .where(F.col("bin").isNotNull())
    )


def brier_ece(df: DataFrame, score: str, target: str, bins: int = 10) -> DataFrame:
    """Brier score and the unweighted mean calibration gap, from one pass over the rows."""
    edges = [i / bins for i in range(bins + 1)]
    s, y = F.col(score).cast("double"), F.col(target).cast("double")
    per = (
        df.where(s.isNotNull() & y.isNotNull())
        .groupBy(right_closed_bin(number(score), edges).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum((s - y) * (s - y)).alias("sq"), F.avg(s).alias("p"), F.avg(y).alias("o"))
    )
    gap = F.when(F.col("bin").isNotNull(), F.abs(F.col("o") - F.col("p")))
    return per.agg((F.sum("sq") / F.sum("n")).alias("brier"), F.avg(gap).alias("ece"))


def expected_loss(df: DataFrame, pd_col: str, ead: str | float = 1.0, lgd: float = LGD, keys=()) -> DataFrame:
    """PD x LGD x EAD totals, overall or per key."""
    p = F.col(pd_col).cast("double")
    e = F.col(ead).cast("double") if isinstance(ead, str) else F.lit(float(ead))
    loss = p * F.lit(lgd) * e
    agg = df.groupBy(*keys).agg(
        F.sum(loss).alias("_el"), F.sum(e).alias("_ead"), F.avg(p).alias("_pd"), F.avg(loss).alias("_mean")
    )
    return agg.select(
        *keys,
        F.round("_el", 2).alias("total_expected_loss"),
        F.round("_ead", 2).alias("total_exposure"),
        F.round("_pd", 4).alias("mean_pd"),
        F.lit(lgd).alias("lgd_assumption"),
        F.round(ratio(F.col("_el"), F.col("_ead"), F.lit(0.0)), 6).alias("el_rate"),
        F.round("_mean", 2).alias("mean_el_per_loan"),
    )


def vif(df: DataFrame, features: list[str] | None = None, max_features: int | None = None) -> DataFrame:
    """Variance inflation of all numeric features that have no NULL (or of the ``max_features`` widest by variance).

    Only the matrix of correlations reaches the driver. A constant feature has no VIF.
    """
    from .profile import corr_pairs

    features = features or numeric_columns(df)
    first = df.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count(c).alias(f"n_{i}") for i, c in enumerate(features)],
        *[F.var_samp(F.col(c).cast("double")).alias(f"v_{i}") for i, c in enumerate(features)],
    ).first()
    whole = [i for i in range(len(features)) if first[f"n_{i}"] == first["_n"] and (first[f"v_{i}"] or 0) > 0]
    moving = [features[i] for i in sorted(whole, key=lambda i: (-first[f"v_{i}"], features[i]))[:max_features]]
    if not moving:
        return df.sparkSession.createDataFrame([], "feature string, vif double")
    at = {f: k for k, f in enumerate(moving)}
    r = np.eye(len(moving))
    for a, b, corr in corr_pairs(df, moving).collect():
        r[at[a], at[b]] = r[at[b], at[a]] = corr
    try:
        diag = np.diag(np.linalg.inv(r))
    except np.linalg.LinAlgError:
        diag = np.diag(np.linalg.pinv(r))
    return df.sparkSession.createDataFrame([(f, round(float(diag[at[f]]), 2)) for f in moving], "feature string, vif double")


def unpivot_text(df: DataFrame, columns: list[str], names: tuple[str, str], keep: list[str]) -> DataFrame:
    return df.select(*keep, *[F.col(c).cast("string").alias(c) for c in columns]).unpivot(keep, columns, *names)


GROUPS_AT_ONCE = 64  # segment values that one ranking carries


def segment_performance(
    df: DataFrame, segments: list[str], scores: dict[str, str], target: str, min_n: int = 0
) -> DataFrame:
    """N, default rate, AUC and Gini per model and segment value.

    One ranking per model serves all segment values; only with more than ``GROUPS_AT_ONCE`` of them rows are copied per
    segment and ranked by value. Absent segment columns, NULL values, one-class groups and groups of at most ``min_n``
    rows are left out.
    """
    segments = [s for s in segments if s in df.columns]
    text = [F.col(s).cast("string").alias(s) for s in segments]
    known = df.select(*text).groupBy(*segments).agg(F.lit(1)).limit(GROUPS_AT_ONCE ** 2).collect()
    values = sorted({(s, r[s]) for r in known for s in segments if r[s] is not None})
    if not values or len(values) > GROUPS_AT_ONCE or len(known) == GROUPS_AT_ONCE ** 2:
        long = unpivot_text(df, segments, ("segment", "segment_value"), [target, *scores.values()])
        by_model = _unpivot_scores(long, scores, [target, "segment", "segment_value"])
        out = discrimination(by_model, "score", target, ["model", "segment", "segment_value"])
    else:
        named = df.select(target, *text, *[F.col(c).cast("double").alias(m) for m, c in scores.items()])
        by_model = named.unpivot([target, *segments], list(scores), "model", "score")
        groups = [(str(i), F.col(s) == v) for i, (s, v) in enumerate(values)]
        out = discrimination_of_groups(by_model, "score", target, groups, ["model"])
        name = lambda k: F.element_at(F.array(*[F.lit(x[k]) for x in values]), F.col("group").cast("int") + 1)
        out = out.withColumns({"segment": name(0), "segment_value": name(1)})
    return out.where(F.col("auc").isNotNull() & (F.col("n") > min_n)).select(
        "model", "segment", "segment_value", "n",
        (dbl(F.col("n_pos")) / F.col("n")).alias("default_rate"),
        F.round("auc", 4).alias("auc"), F.round("gini", 4).alias("gini"),
    )


def _unpivot_scores(df: DataFrame, scores: dict[str, str], keep: list[str]) -> DataFrame:
    named = df.select(*keep, *[F.col(c).cast("double").alias(m) for m, c in scores.items()])
    return named.unpivot(keep, list(scores), "model", "score")


def compare_models(df: DataFrame, scores: dict[str, str], target: str) -> DataFrame:
    """One row per model: AUC, Gini, KS (4 digits) and the KS verdict."""
    long = _unpivot_scores(df, scores, [target])
    out = discrimination(long, "score", target, ["model"])
    return out.select(
        "model", F.round("auc", 4).alias("auc"), F.round("gini", 4).alias("gini"), F.round("ks", 4).alias("ks"),
        F.when(F.col("ks") > 0.30, "PASS").otherwise("REVIEW").alias("ks_verdict"),
    )


def best_model(comparison: DataFrame) -> DataFrame:
    """The row with the largest AUC; the first name wins a tie."""
    ranked = comparison.groupBy("auc").agg(F.min_by(F.struct(*comparison.columns), "model").alias("r"))
    return ranked.agg(F.max_by("r", "auc").alias("r")).select("r.*")


def overfit_gap(cv: DataFrame, holdout: DataFrame) -> DataFrame:
    """Hold-out AUC against mean cross-validated AUC per model."""
    gap = F.col("holdout_auc") - F.col("cv_auc")
    return (
        cv.groupBy("model").agg(F.avg("auc").alias("cv_auc"))
        .join(holdout.select("model", F.col("auc").alias("holdout_auc")), "model")
        .select("model", "cv_auc", "holdout_auc", gap.alias("gap"),
                F.when(F.abs(gap) < 0.08, "OK").otherwise("Check").alias("status"))
    )


def score_overlap(df: DataFrame, scores: dict[str, str], target: str, points: int = 1000) -> DataFrame:
    """Overlap of the two class densities: integral of min(f_good, f_bad) over [0, 1], Gaussian kernels.

    Every task adds the kernels of its own distinct scores to one vector of ``points`` values per
    (model, class), so tasks emit grid rows and never score x grid rows. A kernel is exactly 0 in double precision beyond
    ``REACH`` bandwidths, so sorted scores are added to the grid points within their reach only.
    """
    long = _unpivot_scores(df, scores, [target]).where(F.col("score").isNotNull() & F.col(target).isin(0, 1))
    stats = long.groupBy("model", F.col(target).cast("int").alias("cls")).agg(
        F.count(F.lit(1)).alias("n"), F.stddev_samp("score").alias("sd")
    ).collect()  # two rows per model
    width = {(r["model"], r["cls"]): (r["n"], (r["sd"] or 0.0) * r["n"] ** (-0.2)) for r in stats}
    grid = np.linspace(0.0, 1.0, points)

    def kernels(batches):
        acc: dict[tuple, np.ndarray] = {}
        for pdf in batches:
            for key, part in pdf.groupby(["model", "cls"]):
                n, h = width[key]
                if h <= 0:
                    continue
                total = acc.setdefault(key, np.zeros(points))
                part = part.sort_values("score")
                x, w = part["score"].to_numpy(), part["k"].to_numpy()
                for at in range(0, len(x), 500):
                    near = x[at:at + 500]
                    lo, hi = np.searchsorted(grid, [near[0] - REACH * h, near[-1] + REACH * h])
                    u = (grid[lo:hi, None] - near[None, :]) / h
                    total[lo:hi] += np.exp(-0.5 * u * u) @ w[at:at + 500] / (n * h * np.sqrt(2 * np.pi))
        for (model, cls), total in acc.items():
            yield pd.DataFrame({"model": model, "cls": cls, "point": np.arange(points), "f": total})

    counts = long.groupBy("model", F.col(target).cast("int").alias("cls"), "score").agg(
        F.count(F.lit(1)).cast("double").alias("k")
    )
    parts = counts.mapInPandas(kernels, "model string, cls int, point long, f double")
    both = parts.groupBy("model", "point").agg(
        F.sum(F.when(F.col("cls") == 0, F.col("f"))).alias("g"), F.sum(F.when(F.col("cls") == 1, F.col("f"))).alias("b")
    )
    end = F.when(F.col("point").isin(0, points - 1), 0.5).otherwise(1.0)
    inside = F.least(F.coalesce("g", F.lit(0.0)), F.coalesce("b", F.lit(0.0)))
    return both.groupBy("model").agg((F.sum(inside * end) / (points - 1)).alias("overlap"))
