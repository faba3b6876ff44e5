"""Reproducible splits, folds, samples and class weights from a hash of the key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lookups import local_if_small
from .ranking import bounds, cumulate, present

SEED = 42


def hash_token(key: str, seed: int = SEED) -> Column:
    """Portable pseudo-random token of a row key."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))


def hash_unit(key: str, seed: int = SEED) -> Column:
    """Uniform number in [0, 1) from the first 13 hex digits (52 bits) of the token."""
    digits = F.conv(F.substring(hash_token(key, seed), 1, 13), 16, 10).cast("double")
    return digits / F.lit(float(16 ** 13))


def class_rank(df: DataFrame, key: str, target: str, seed: int = SEED) -> DataFrame:
    """0-based position ``_rank`` of each key inside its class of ``_size`` rows, in hash order.

    The order is total because the token is followed by the key; cells are token prefixes.
    """
    rows = df.select(_class(target).alias("_t"), _token(key, seed).alias("_token"))
    ranked = cumulate(rows, ["_t"], "_token", {"_one": F.lit(1)}, cell=F.substring("_token", 1, 3))
    return ranked.select("_t", "_token", F.col("_one_before").alias("_rank"), F.col("_one_all").alias("_size"))


def _class(target: str) -> Column:
    """Class number; rows without an outcome form a class of their own."""
    return F.coalesce(F.col(target).cast("long"), F.lit(-1))


def _token(key: str, seed: int) -> Column:
    return F.concat(hash_token(key, seed), F.lit("|"), F.col(key).cast("string"))


def _first_of_class(df: DataFrame, key: str, target: str, share: str, seed: int) -> tuple[DataFrame, Column]:
    """Rows with ``_bound``, and whether a row is among the first round(share * class size) keys of its class in hash order.

    Only the last token taken of each class is looked up; the rows themselves are compared with it where they are.
    """
    tagged = df.withColumns({"_t": _class(target), "_token": _token(key, seed)})
    last = bounds(tagged.select("_t", "_token"), ["_t"], "_token", f"round(_all * {share}, 0)").withColumnRenamed("bound", "_bound")
    return tagged.join(local_if_small(last), "_t", "left"), F.coalesce(F.col("_token") <= F.col("_bound"), F.lit(False))


def stratified_split(df: DataFrame, key: str, target: str, test_share: float = 0.2, seed: int = SEED) -> DataFrame:
    """``is_test``: exactly round(share * class size) keys of each class, chosen by hash order. Rows without a key are left out."""
    rows, taken = _first_of_class(df.where(F.col(key).isNotNull()), key, target, f"{float(test_share)!r}D", seed)
    return rows.withColumn("is_test", taken.cast("int")).drop("_t", "_token", "_bound")


def stratified_folds(df: DataFrame, key: str, target: str, k: int = 5, seed: int = SEED) -> DataFrame:
    """``fold`` 0..k-1 with class sizes equal up to one key."""
    r = class_rank(df, key, target, seed).select("_t", "_token", (F.col("_rank") % k).cast("int").alias("fold"))
    tagged = df.withColumns({"_t": _class(target), "_token": _token(key, seed)})
    return tagged.join(r, ["_t", "_token"]).drop("_t", "_token")


def hash_split(df: DataFrame, key: str, share: float, seed: int = SEED, out: str = "is_test") -> DataFrame:
    """Approximate split without a shuffle: rows whose hash falls below the share."""
    return df.withColumn(out, (hash_unit(key, seed) < share).cast("int"))


def hash_folds(df: DataFrame, key: str, k: int = 5, seed: int = SEED) -> DataFrame:
    """Fold by hash without a shuffle; class shares are equal in expectation."""
    return df.withColumn("fold", F.floor(hash_unit(key, seed) * k).cast("int"))


def ordered_split(df: DataFrame, order: str, test_share: float = 0.2) -> DataFrame:
    """``is_test`` = 1 for the last share of rows by a unique order column: a number, date, timestamp or text.

    The last training value is one literal, found among the rows of a single cell; no row is moved to be split.
    """
    rows = present(df, [order])
    last = bounds(rows, [], order, f"floor(_all * {1.0 - test_share!r}D)").select("bound").collect()
    if not last or last[0]["bound"] is None:
        return rows.withColumn("is_test", F.lit(1))
    return rows.withColumn("is_test", (F.col(order) > F.lit(last[0]["bound"])).cast("int"))


def stratified_sample(df: DataFrame, key: str, target: str, n: int, seed: int = SEED) -> DataFrame:
    """About ``n`` rows with the class shares kept: exact per-class quotas by hash order."""
    total = df.count()
    quota = min(1.0, n / total) if total else 0.0
    rows, taken = _first_of_class(df, key, target, f"{quota!r}D", seed)
    return rows.where(taken).drop("_t", "_token", "_bound")


def class_counts(df: DataFrame, target: str) -> tuple[int, int]:
    row = df.agg(F.count_if(F.col(target) == 0).alias("n0"), F.count_if(F.col(target) == 1).alias("n1")).first()
    return row["n0"], row["n1"]


def balanced_weight(df: DataFrame, target: str, out: str = "weight") -> DataFrame:
    """n / (2 * class size)."""
    n0, n1 = class_counts(df, target)
    n = n0 + n1
    w = {k: (n / (2.0 * c) if c else 0.0) for k, c in ((0, n0), (1, n1))}
    return df.withColumn(out, F.when(F.col(target) == 1, F.lit(w[1])).otherwise(F.lit(w[0])))


def positive_weight(df: DataFrame, target: str, out: str = "weight") -> DataFrame:
    """Negatives over positives for positive rows, 1 for the rest."""
    n0, n1 = class_counts(df, target)
    return df.withColumn(out, F.when(F.col(target) == 1, F.lit(n0 / n1 if n1 else 1.0)).otherwise(F.lit(1.0)))
