"""Applicant-level feature derivation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rowwise
from .ranking import exact_quantiles

KEYS = ("SK_ID_CURR", "SK_ID_PREV")
TARGET = "TARGET"
NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
# Columns whose absence is a risk signal, and aggregate families flagged by their first column.
MISSING_FLAG_COLUMNS = (
    "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "AMT_GOODS_PRICE", "AMT_ANNUITY", "OCCUPATION_TYPE",
    "CNT_FAM_MEMBERS",
)
MISSING_FLAG_PREFIXES = ("bureau_", "bb_", "cc_", "inst_", "pos_", "prev_")
EXT_WEIGHTS = (0.2, 0.5, 0.3)
# Weights of the bureau risk score (debt, overdue, not current) and of payment discipline (on time, paid up), share of current
# months where none is known, and the most that a payment counts against what was due.
RISK_WEIGHTS, DISCIPLINE_WEIGHTS = (0.5, 0.3, 0.2), (0.5, 0.5)
CURRENT_UNKNOWN, PAID_CAP = 0.5, 1.5
DAYS_PER_YEAR = 365.25


def numeric_columns(df: DataFrame, exclude=(*KEYS, TARGET)) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and f.name not in exclude]


def string_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def nan_to_null(df: DataFrame) -> DataFrame:
    """One notion of missing inside the plans: NaN becomes NULL."""
    return df.select(*[
        F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)) else F.col(f.name)
        for f in df.schema.fields
    ])


def _over(num: Column, den: Column) -> Column:
    """num / (den + 1), NULL where den + 1 is zero."""
    shifted = den + 1
    return F.when(shifted != 0, num / shifted)


def derived_features(df: DataFrame) -> DataFrame:
    """Ratios, tenures, external-score interactions and row counts as one projection per dependency level."""
    have = set(df.columns)
    d = {c: F.col(c).cast("double") for c in have}
    credit, income, annuity = d["AMT_CREDIT"], d["AMT_INCOME_TOTAL"], d["AMT_ANNUITY"]
    goods = d["AMT_GOODS_PRICE"]

    if "CNT_FAM_MEMBERS" in have:
        family = d["CNT_FAM_MEMBERS"]
    elif "CNT_CHILDREN" in have:
        family = d["CNT_CHILDREN"] + 1
    else:
        family = F.lit(1.0)
    age = -d["DAYS_BIRTH"] / DAYS_PER_YEAR
    tenure = rowwise.clip(-d["DAYS_EMPLOYED"], lower=0.0) / DAYS_PER_YEAR

    out: dict[str, Column] = {
        "LOAN_INCOME_RATIO": _over(credit, income),
        "ANNUITY_INCOME_RATIO": _over(annuity, income),
        "CREDIT_GOODS_RATIO": _over(credit, goods),
        "CREDIT_TERM": _over(annuity, credit),
        "GOODS_INCOME_RATIO": _over(goods, income),
        "INCOME_PER_PERSON": income / rowwise.clip(family, lower=1.0),
        "AGE_YEARS": age,
        "EMPLOYMENT_YEARS": tenure,
        "REGISTRATION_YEARS": -d["DAYS_REGISTRATION"] / DAYS_PER_YEAR,
        "ID_PUBLISH_YEARS": -d["DAYS_ID_PUBLISH"] / DAYS_PER_YEAR,
        "EMPLOY_TO_AGE_RATIO": F.when(age + 0.01 != 0, tenure / (age + 0.01)),
        "PAYMENT_RATE": _over(annuity, credit),
        "CREDIT_OVERCHARGE": _over(credit - goods, goods),
        "ANNUITY_x_EMPLOYMENT": annuity * tenure,
        "INCOME_x_EXT2": income * d.get("EXT_SOURCE_2", F.lit(0.5)),
        "CREDIT_x_AGE": credit * age,
    }
    if "DAYS_LAST_PHONE_CHANGE" in have:
        out["PHONE_CHANGE_YEARS"] = -d["DAYS_LAST_PHONE_CHANGE"] / DAYS_PER_YEAR
    out.update(external_score_features(df.columns, age))

    for name, chosen in (
        ("DOCUMENT_COUNT", [c for c in df.columns if c.startswith("FLAG_DOCUMENT_")]),
        ("ADDR_MISMATCH_COUNT", [c for c in df.columns if c.startswith("REG_") and "NOT" in c]),
        ("BUREAU_ENQUIRY_TOTAL", [c for c in df.columns if c.startswith("AMT_REQ_CREDIT_BUREAU")]),
    ):
        if chosen:
            out[name] = rowwise.row_sum([F.col(c) for c in chosen])
    return df.withColumns(out)


def external_score_features(columns: list[str], age: Column) -> dict[str, Column]:
    """Row statistics, products and powers of the external scores that are present."""
    names = [c for c in columns if c.startswith("EXT_SOURCE_") and c[-1].isdigit()]
    if not names:
        return {}
    cols = [F.col(c).cast("double") for c in names]
    x = {c[len("EXT_SOURCE_"):]: F.col(c).cast("double") for c in names}
    low, high = rowwise.row_min(cols), rowwise.row_max(cols)
    out = {
        "EXT_SOURCE_MEAN": rowwise.row_mean(cols),
        "EXT_SOURCE_STD": rowwise.row_std(cols),
        "EXT_SOURCE_MIN": low,
        "EXT_SOURCE_MAX": high,
        "EXT_SOURCE_RANGE": high - low,
    }
    for a, b in (("1", "2"), ("2", "3"), ("1", "3")):
        if a in x and b in x:
            out[f"EXT_SRC_{a}x{b}"] = x[a] * x[b]
    for k in ("2", "3"):
        if k in x:
            out[f"EXT_SRC{k}_x_AGE"] = x[k] * age
    for k in ("1", "2", "3"):
        if k in x:
            out[f"EXT_SRC{k}_SQ"] = x[k] * x[k]
    if "2" in x:
        out["EXT_SRC2_CB"] = x["2"] * x["2"] * x["2"]
    if all(k in x for k in "123"):
        out["EXT_SRC_PROD"] = x["1"] * x["2"] * x["3"]
        w1, w2, w3 = EXT_WEIGHTS
        out["EXT_SOURCE_WEIGHTED"] = x["1"] * w1 + x["2"] * w2 + x["3"] * w3
    return out


def missing_flags(df: DataFrame) -> DataFrame:
    """``MISS_<column>`` 0/1 for the named columns and the first column of each aggregate family."""
    chosen = [c for c in MISSING_FLAG_COLUMNS if c in df.columns]
    for prefix in MISSING_FLAG_PREFIXES:
        first = next((c for c in df.columns if c.startswith(prefix)), None)
        if first:
            chosen.append(first)
    return df.withColumns({f"MISS_{c}": F.col(c).isNull().cast("int") for c in chosen})


def medians(df: DataFrame, columns: list[str]) -> dict[str, float | None]:
    """Exact medians, one number per column brought back to the driver."""
    edges = exact_quantiles(df, columns, [0.5])
    found = {r["feature"]: r["edges"][0] for r in edges.collect()}
    return {c: found.get(c) for c in columns}


def impute_median(df: DataFrame, columns=("EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3")) -> DataFrame:
    """Fill NULLs of the named columns with their exact median; an all-NULL column stays NULL."""
    present = [c for c in columns if c in df.columns]
    known = {c: m for c, m in medians(df, present).items() if m is not None}
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in known.items()})


def cross_table_features(df: DataFrame) -> DataFrame:
    """Composites over several history aggregates; each appears when its inputs do."""
    have = set(df.columns)
    c = lambda name: F.col(name).cast("double")
    out: dict[str, Column] = {}
    worst = [x for x in df.columns if "dpd" in x.lower() and "max" in x.lower()]
    if worst:
        out["WORST_DPD_ALL"] = rowwise.row_max([c(x) for x in worst])
    dpd_months = [x for x in df.columns if "months_with_dpd" in x.lower() or "dpd_count" in x.lower()]
    if dpd_months:
        out["TOTAL_DPD_MONTHS"] = rowwise.row_sum([c(x) for x in dpd_months])
    if {"debt_to_credit_ratio", "overdue_count", "bureau_loan_count"} <= have:
        unknown = F.lit(CURRENT_UNKNOWN)
        current = F.coalesce(c("bb_current_ratio"), unknown) if "bb_current_ratio" in have else unknown
        debt, overdue, behind = RISK_WEIGHTS
        out["BUREAU_RISK_SCORE"] = (
            F.coalesce(c("debt_to_credit_ratio"), F.lit(0.0)) * debt
            + (c("overdue_count") / rowwise.clip(c("bureau_loan_count"), lower=1.0)) * overdue
            + (F.lit(1.0) - current) * behind
        )
    if {"late_payment_ratio", "payment_to_due_ratio"} <= have:
        on_time, paid = DISCIPLINE_WEIGHTS
        out["PAYMENT_DISCIPLINE"] = (
            (F.lit(1.0) - F.coalesce(c("late_payment_ratio"), F.lit(0.0))) * on_time
            + rowwise.clip(F.coalesce(c("payment_to_due_ratio"), F.lit(1.0)), upper=PAID_CAP) / PAID_CAP * paid
        )
    if {"total_credit_amount", "AMT_INCOME_TOTAL"} <= have:
        out["TOTAL_EXPOSURE_RATIO"] = _over(
            F.coalesce(c("total_credit_amount"), F.lit(0.0)) + c("AMT_CREDIT"), c("AMT_INCOME_TOTAL")
        )
    return df.withColumns(out)


def numeric_only(df: DataFrame) -> DataFrame:
    """Drop text columns, turn booleans into 0/1 doubles and everything else into doubles; keys and target stay."""
    out = []
    for f in df.schema.fields:
        if f.name in KEYS or f.name == TARGET:
            out.append(F.col(f.name))
        elif isinstance(f.dataType, T.BooleanType):
            out.append(F.col(f.name).cast("int").cast("double").alias(f.name))
        elif isinstance(f.dataType, NUMERIC):
            out.append(F.col(f.name).cast("double").alias(f.name))
    return df.select(*out)


def coerce_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """Text to double, unreadable values to NULL."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns})


def align_columns(df: DataFrame, features: list[str], keep=()) -> DataFrame:
    """Exactly the model's columns in its order: missing ones as 0, extra ones dropped."""
    have = set(df.columns)
    return df.select(
        *keep, *[F.col(c).cast("double").alias(c) if c in have else F.lit(0.0).alias(c) for c in features]
    )
