"""Categorical encodings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lookups import CategoryLookup, local_if_small
from .ranking import cumulate


def category_counts(df: DataFrame, columns: list[str], *aggs: Column, by=()) -> DataFrame:
    long = df.unpivot([c for c in df.columns if c not in columns], columns, "feature", "category")
    return long.where(F.col("category").isNotNull()).groupBy("feature", "category", *by).agg(*aggs)


def frequency_table(df: DataFrame, columns: list[str]) -> DataFrame:
    """Share of each category among the non-NULL rows of its column."""
    counts = category_counts(df.select(*columns), columns, F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("feature").agg(F.sum("n").alias("total"))
    return counts.join(totals, "feature").select(
        "feature", "category", "n", (F.col("n").cast("double") / F.col("total")).alias("freq")
    )


def frequency_encode(df: DataFrame, columns: list[str]) -> DataFrame:
    """``FREQ_<column>``; NULL and unseen categories give 0."""
    if not columns:
        return df
    return CategoryLookup(frequency_table(df, columns), "freq").attach(df, {c: f"FREQ_{c}" for c in columns}, "0.0D")


MOST_FOLDS = 1000


def target_encode_oof(df: DataFrame, columns: list[str], target: str, fold: str, m: float = 20.0) -> DataFrame:
    """``TE_<column>``: smoothed target mean of the row's category over all other folds.

    (n * mean + m * prior) / (n + m), with n, mean and prior taken outside the row's own fold.
    NULL categories and categories seen in no other fold give the prior. One aggregation counts every category with its
    totals per fold side by side; the priors are a literal per fold, of which there are at most ``MOST_FOLDS``.
    """
    y = F.col(target).cast("double")
    rows = df.groupBy(fold).agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("s")).limit(MOST_FOLDS + 1).collect()
    if len(rows) > MOST_FOLDS:
        raise ValueError(f"more than {MOST_FOLDS} folds in {fold}")
    all_n, all_s = sum(r["n"] for r in rows), sum(r["s"] or 0.0 for r in rows)
    priors = {r[fold]: (all_s - (r["s"] or 0.0)) / (all_n - r["n"]) if all_n > r["n"] else None for r in rows if r[fold] is not None}
    at = lambda k: F.col(fold) == F.lit(k)
    cells = category_counts(
        df.select(fold, target, *columns), columns, F.count(F.lit(1)).alias("n"), F.sum(y).alias("s"),
        *[x for i, k in enumerate(priors) for x in (F.count_if(at(k)).alias(f"n{i}"), F.sum(F.when(at(k), y)).alias(f"s{i}"))],
    )
    kind = dict(df.dtypes)[fold]
    others = [
        F.when(F.col(f"n{i}") > 0, F.struct(
            F.lit(k).cast(kind).alias(fold),
            ((F.col("s") - F.coalesce(f"s{i}", F.lit(0.0)) + F.lit(p).cast("double") * m) / (F.col("n") - F.col(f"n{i}") + F.lit(m))).alias("te"),
        ))
        for i, (k, p) in enumerate(priors.items())
    ]
    none = f"CAST(NULL AS struct<`{fold}`: {kind}, te: double>)"
    own = cells.select("feature", "category", F.explode(F.array_compact(F.array(*others, F.expr(none)))).alias("o")).select("feature", "category", f"o.{fold}", "o.te")
    prior = F.coalesce(*[F.when(at(k), F.lit(p)) for k, p in priors.items()], F.lit(None).cast("double"))
    lookup = CategoryLookup(local_if_small(own), "te", by=fold)
    return lookup.attach(df.withColumn("_prior", prior), {c: f"TE_{c}" for c in columns}, "_prior").drop("_prior")


def category_code_table(df: DataFrame, columns: list[str]) -> DataFrame:
    """Alphabetical 0-based code of each category; fit once and reuse for every frame."""
    seen = category_counts(df.select(*columns), columns, F.count(F.lit(1)).alias("n"))
    ranked = cumulate(seen, ["feature"], "category", {"one": F.lit(1)}, cell=F.substring("category", 1, 3))
    return ranked.select("feature", "category", F.col("one_before").cast("int").alias("code"))


def apply_category_codes(df: DataFrame, table: DataFrame, columns: list[str]) -> DataFrame:
    """``CODE_<column>``; NULL and unseen categories give -1."""
    return CategoryLookup(table, "code").attach(df, {c: f"CODE_{c}" for c in columns}, "-1")
