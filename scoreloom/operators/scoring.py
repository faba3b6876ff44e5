"""Applicant validation, feature mapping, batch scoring and reason codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rowwise, scores
from ..functions.aggregates import ratio
from .binning import equal_width_bin
from .features import EXT_WEIGHTS

# Request fields as (name, type, default or None when required, low, low is open, high).
FIELDS = (
    ("age", "int", None, 18, False, 100),
    ("income", "double", None, 0, True, 1e9),
    ("loan_amount", "double", None, 0, True, 1e9),
    ("annuity", "double", None, 0, True, 1e8),
    ("goods_price", "double", 0.0, 0, False, 1e9),
    ("employment_years", "double", 0.0, 0, False, None),
    ("education_type", "string", "Secondary", None, False, None),
    ("family_status", "string", "Married", None, False, None),
    ("housing_type", "string", "House / apartment", None, False, None),
    ("bureau_loan_count", "int", 0, 0, False, None),
    ("active_credits", "int", 0, 0, False, None),
    ("total_debt", "double", 0.0, 0, False, 1e9),
    ("overdue_count", "int", 0, 0, False, None),
    ("ext_source_1", "double", "NULL", 0, False, 1),
    ("ext_source_2", "double", "NULL", 0, False, 1),
    ("ext_source_3", "double", "NULL", 0, False, 1),
)
REQUIRED = ("age", "income", "loan_amount", "annuity")
ALIASES = {"education_type": "education", "housing_type": "housing"}
MISSING_EXT = 0.5
HIGH_PD = 0.3

# Mean default rates per category used when only a request form is available.
TE_EDUCATION = {
    "Higher education": 0.0536, "Secondary": 0.0894, "Incomplete higher": 0.0848, "Lower secondary": 0.1092,
    "Academic degree": 0.0219,
}
TE_FAMILY = {"Married": 0.0756, "Single": 0.0981, "Civil marriage": 0.0994, "Separated": 0.0819, "Widow": 0.0583}
TE_HOUSING = {
    "House / apartment": 0.0780, "Rented apartment": 0.1230, "With parents": 0.1170, "Municipal apartment": 0.0854,
    "Office apartment": 0.0658,
}
# Population defaults for features a request form cannot provide.
FORM_CONSTANTS = {
    "total_overdue_amount": 0.0, "overdue_amount_last_12m": 0.0, "earliest_bureau_days": -1832.0,
    "latest_bureau_days": -300.0, "std_bureau_days": 500.0, "bureau_recent_ratio": 0.3, "BUREAU_ENQUIRY_TOTAL": 2.0,
    "TE_NAME_CONTRACT_TYPE": 0.0835, "TE_CODE_GENDER": 0.0700, "TE_FLAG_OWN_CAR": 0.0850,
    "TE_FLAG_OWN_REALTY": 0.0796, "TE_NAME_TYPE_SUITE": 0.0818, "TE_NAME_INCOME_TYPE": 0.0959,
    "TE_OCCUPATION_TYPE": 0.0807, "TE_WEEKDAY_APPR_PROCESS_START": 0.0815, "TE_ORGANIZATION_TYPE": 0.0853,
    "TE_FONDKAPREMONT_MODE": 0.0807, "TE_HOUSETYPE_MODE": 0.0807, "TE_WALLSMATERIAL_MODE": 0.0807,
    "TE_latest_app_status": 0.0737, "MISS_EXT_SOURCE_1": 0.0, "MISS_EXT_SOURCE_2": 0.0, "MISS_EXT_SOURCE_3": 0.0,
    "MISS_AMT_GOODS_PRICE": 0.0, "MISS_AMT_ANNUITY": 0.0, "MISS_OCCUPATION_TYPE": 1.0, "MISS_CNT_FAM_MEMBERS": 0.0,
    "MISS_bb_total_records": 1.0, "MISS_cc_count": 1.0, "MISS_pos_loan_count": 1.0, "MISS_prev_app_count": 1.0,
    "late_payments": 1.0, "late_payment_ratio": 0.015, "late_payments_last_12m": 0.0, "late_ratio_last_12m": 0.0,
    "late_ratio_trend": 0.0, "pos_dpd_rate_last_12m": 0.0, "approval_rate_last_12m": 0.4,
    "avg_utilisation_ratio": 0.23, "avg_drawing_count": 0.25,
}
# How a form's figures stand in for the credit history.
FORM_CONTRACTS, FORM_CONTRACTS_PER_CREDIT = 20.0, 5
FORM_LINES_PER_YEAR, FORM_LINES_PER_TWO_YEARS = 3, 2
FORM_ANNUITY_SHARE, FORM_DEBT_SPREAD, FORM_DAYS_PER_OVERDUE = 0.25, 0.5, 30
FORM_SETTLED_DAYS = -5 * 365.25


def missing_required(df: DataFrame) -> list[str]:
    """Required request columns the frame lacks."""
    return sorted(set(REQUIRED) - set(df.columns))


def validate(df: DataFrame, keep=()) -> DataFrame:
    """Typed request columns plus ``violations``, the list of broken rules of each row.

    Absent optional columns take their default, unreadable values and values outside their range are
    violations. Accepted rows have an empty list.
    """
    have = set(df.columns)
    typed: list[Column] = []
    broken: list[str] = []
    for name, kind, default, low, low_open, high in FIELDS:
        source = name if name in have else ALIASES.get(name)
        absent = source not in have
        empty = None if default == "NULL" else default
        if absent:
            typed.append(F.lit(empty).cast(kind).alias(name))
        else:
            value = F.expr(f"try_cast(`{source}` AS {kind})")
            typed.append((F.nanvl(value, F.lit(None).cast("double")) if kind == "double" else value).alias(name))
            typed.append(F.expr(f"nullif(CAST(`{source}` AS string), '') IS NOT NULL").alias(f"_given_{name}"))
            broken.append(f"CASE WHEN _given_{name} AND {name} IS NULL THEN '{name}: not {kind}' END")
        if default is None:
            broken.insert(len(broken) - (not absent), "'%s: missing'" % name if absent else
                          f"CASE WHEN NOT _given_{name} THEN '{name}: missing' END")
        if low is not None:
            broken.append(f"CASE WHEN {name} {'<=' if low_open else '<'} {low} THEN '{name}: too small' END")
        if high is not None:
            broken.append(f"CASE WHEN {name} > {int(high)} THEN '{name}: too large' END")
    # One generated row per request: the parsed values are computed once and not repeated in every rule.
    parsed = df.select(*keep, F.inline(F.array(F.struct(*typed))))

    def final(name, kind, default):
        if default in (None, "NULL") or f"_given_{name}" not in parsed.columns:
            return F.col(name)
        fallback = f"'{default}'" if kind == "string" else f"CAST({default} AS {kind})"
        return F.expr(f"CASE WHEN _given_{name} THEN {name} ELSE {fallback} END AS {name}")

    return parsed.select(
        *keep, *[final(n, k, d) for n, k, d, *_ in FIELDS],
        F.expr(f"array_compact(array({', '.join(broken)}))").alias("violations"),
    )


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted rows and rejected rows of a validated frame."""
    ok = F.size("violations") == 0
    return validated.where(ok).drop("violations"), validated.where(~ok)


def request_features(df: DataFrame, keep=(), profile: str = "service") -> DataFrame:
    """Model features of validated requests, with the training definitions of every ratio.

    ``profile`` "service" maps the request alone; "form" adds credit-history proxies, category means
    and population defaults.
    """
    c = lambda n: F.col(n).cast("double")
    age, income, loan, annuity = c("age"), c("income"), c("loan_amount"), c("annuity")
    goods, tenure = c("goods_price"), rowwise.clip(c("employment_years"), lower=0.0)
    e = [F.coalesce(c(f"ext_source_{k}"), F.lit(MISSING_EXT)) for k in (1, 2, 3)]
    e1, e2, e3 = e
    one = F.lit(1.0)
    low, high = rowwise.row_min(e), rowwise.row_max(e)
    out = {
        "AGE_YEARS": age, "AMT_INCOME_TOTAL": income, "AMT_CREDIT": loan, "AMT_ANNUITY": annuity,
        "AMT_GOODS_PRICE": goods, "EMPLOYMENT_YEARS": tenure, "bureau_loan_count": c("bureau_loan_count"),
        "active_credits": c("active_credits"), "total_debt": c("total_debt"), "overdue_count": c("overdue_count"),
        "EXT_SOURCE_1": e1, "EXT_SOURCE_2": e2, "EXT_SOURCE_3": e3,
        "LOAN_INCOME_RATIO": loan / (income + one), "ANNUITY_INCOME_RATIO": annuity / (income + one),
        "CREDIT_GOODS_RATIO": loan / (goods + one), "CREDIT_TERM": annuity / (loan + one),
        "GOODS_INCOME_RATIO": goods / (income + one), "INCOME_PER_PERSON": income,
        "DAYS_BIRTH": -F.abs(age) * 365.25, "DAYS_EMPLOYED": -F.abs(tenure) * 365.25,
        "REGISTRATION_YEARS": F.lit(5.0), "ID_PUBLISH_YEARS": F.lit(5.0),
        "EMPLOY_TO_AGE_RATIO": tenure / (age + 0.01),
        "EXT_SOURCE_MEAN": rowwise.row_mean(e), "EXT_SOURCE_STD": rowwise.row_std(e), "EXT_SOURCE_MIN": low,
        "EXT_SOURCE_MAX": high, "EXT_SOURCE_RANGE": high - low,
        "EXT_SRC_1x2": e1 * e2, "EXT_SRC_2x3": e2 * e3, "EXT_SRC_1x3": e1 * e3,
        "EXT_SRC2_x_AGE": e2 * age, "EXT_SRC3_x_AGE": e3 * age,
        "PAYMENT_RATE": annuity / (loan + one), "CREDIT_OVERCHARGE": (loan - goods) / (goods + one),
    }
    if profile == "form":
        out.update(_form_features(c, loan, annuity, e))
    return df.select(*keep, *[v.alias(k) for k, v in out.items()])


def _category_mean(column: str, table: dict[str, float], default: float) -> Column:
    out = F.lit(default)
    for name, mean in table.items():
        out = F.when(F.col(column) == name, F.lit(mean)).otherwise(out)
    return out


def _form_features(c, loan: Column, annuity: Column, e: list[Column]) -> dict[str, Column]:
    lines, active, debt, overdue = c("bureau_loan_count"), c("active_credits"), c("total_debt"), c("overdue_count")
    at_least_one = F.greatest(lines, F.lit(1.0))
    e1, e2, e3 = e
    w1, w2, w3 = EXT_WEIGHTS
    out = {
        "DAYS_REGISTRATION": F.lit(FORM_SETTLED_DAYS), "DAYS_ID_PUBLISH": F.lit(FORM_SETTLED_DAYS),
        "active_loans": active, "overdue_loan_count": overdue,
        "active_contracts": F.greatest(F.lit(FORM_CONTRACTS), active * FORM_CONTRACTS_PER_CREDIT),
        "avg_debt": debt / at_least_one, "debt_to_credit_ratio": debt / F.greatest(loan, F.lit(1.0)),
        "bureau_loans_last_12m": F.greatest(F.lit(1.0), F.floor(lines / FORM_LINES_PER_YEAR).cast("double")),
        "bureau_loans_last_24m": F.greatest(F.lit(1.0), F.floor(lines / FORM_LINES_PER_TWO_YEARS).cast("double")),
        "active_loans_last_12m": active, "avg_debt_last_12m": debt / at_least_one,
        "bureau_credit_type_count": at_least_one,
        "avg_bureau_annuity": F.when(lines > 0, annuity * FORM_ANNUITY_SHARE).otherwise(0.0),
        "std_debt_amount": debt * FORM_DEBT_SPREAD, "bureau_day_overdue_count": overdue, "max_bureau_day_overdue": overdue * FORM_DAYS_PER_OVERDUE,
        "MISS_bureau_loan_count": F.when(lines > 0, 0.0).otherwise(1.0),
        "EXT_SRC_1x2x3": e1 * e2 * e3, "EXT_SRC_PROD": e1 * e2 * e3,
        "EXT_SOURCE_WEIGHTED": e1 * w1 + e2 * w2 + e3 * w3,
        "TE_NAME_EDUCATION_TYPE": _category_mean("education_type", TE_EDUCATION, TE_EDUCATION["Secondary"]),
        "TE_NAME_FAMILY_STATUS": _category_mean("family_status", TE_FAMILY, TE_FAMILY["Married"]),
        "TE_NAME_HOUSING_TYPE": _category_mean("housing_type", TE_HOUSING, TE_HOUSING["House / apartment"]),
    }
    for k, x in zip("123", e):
        out[f"EXT_SRC{k}_SQ"] = x * x
        out[f"EXT_SRC{k}_CB"] = x * x * x
    out.update({k: F.lit(v) for k, v in FORM_CONSTANTS.items()})
    return out


def linear_logit(coefficients: dict[str, float], intercept: float) -> Column:
    out = F.lit(float(intercept))
    for name, coef in coefficients.items():
        out = out + F.lit(float(coef)) * F.col(name)
    return out


def linear_probability(coefficients: dict[str, float], intercept: float) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-linear_logit(coefficients, intercept)))


def decide(df: DataFrame, prob: str, safer_is_higher: bool = True, clip: bool = True) -> DataFrame:
    """Add probability (4 digits), score, tier and recommendation.

    The default score rises with safety; ``safer_is_higher=False`` gives the log-odds-of-default scale.
    """
    p = F.col(prob)
    score = scores.prob_score(p) if safer_is_higher else scores.logodds_score(scores.logit(p), clip=clip)
    tier = scores.risk_tier(p)
    return df.withColumns({
        "default_probability": F.round(p, 4), "credit_score": score, "risk_tier": tier,
        "recommendation": scores.recommendation(tier),
    })


def batch_summary(scored: DataFrame) -> DataFrame:
    """Applications, mean score, mean PD and decline share."""
    n = F.count(F.lit(1))
    return scored.agg(
        n.alias("applications"), F.avg("credit_score").alias("avg_score"), F.avg("default_probability").alias("avg_pd"),
        ratio(F.count_if(F.col("recommendation") == "Decline"), n).alias("decline_rate"),
    )


def reason_codes(coefficients: dict[str, float], means: dict[str, float], n: int = 3) -> Column:
    """Top ``n`` signed contributions coef * (x - mean) of each row with their direction.

    Equal magnitudes are ordered by feature name; a NULL input contributes nothing.
    """
    parts = []
    for name, coef in coefficients.items():
        v = F.coalesce(F.lit(float(coef)) * (F.col(name) - F.lit(float(means[name]))), F.lit(0.0))
        parts.append(F.struct((-F.abs(v)).alias("o"), F.lit(name).alias("feature"), v.alias("v")))
    top = F.slice(F.array_sort(F.array(*parts)), 1, n)
    return F.transform(top, lambda s: F.struct(
        s["feature"].alias("feature"), F.round(s["v"], 4).alias("value"),
        F.when(s["v"] > 0, "increases risk").otherwise("decreases risk").alias("direction"),
    ))


def high_risk(df: DataFrame, prob: str, cut: float = HIGH_PD) -> DataFrame:
    return df.where(F.col(prob) > cut)


def first_high_risk(df: DataFrame, prob: str, key: str, cut: float = HIGH_PD) -> DataFrame:
    """The first row by key above the cut, else the first row overall."""
    row = F.struct(*df.columns)
    hit = F.col(prob) > cut
    agg = df.agg(F.min_by(F.when(hit, row), F.when(hit, F.col(key))).alias("h"), F.min_by(row, F.col(key)).alias("a"))
    return agg.select(F.coalesce("h", "a").alias("r")).select("r.*")


def tier_mix(scored: DataFrame, bins: int = 30) -> DataFrame:
    """Histogram of the score per tier over the whole 300..850 scale."""
    b = equal_width_bin("credit_score", scores.SCORE_MIN, scores.SCORE_MAX, bins)
    return scored.where(F.col("credit_score").isNotNull()).groupBy("risk_tier", b.alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
