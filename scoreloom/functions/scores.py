"""Score scaling, tiers and status labels."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scorecard calibration and label cut points.
PDO = 20.0
BASE_SCORE = 600.0
BASE_ODDS = 1.0 / 19.0
SCORE_MIN, SCORE_MAX = 300, 850
PROB_FLOOR = 1e-10
TIER3_CUTS = (0.05, 0.15)
TIER5_CUTS = (0.2, 0.4, 0.6, 0.8)
TIER5_LABELS = ("Low Risk", "Low-Medium Risk", "Medium Risk", "Medium-High Risk", "High Risk")
TIER5_DECISIONS = ("Approve", "Approve", "Review", "Review", "Decline")
RECOMMENDATION = {"Low": "Approve", "Medium": "Review", "High": "Decline"}
IV_CUTS = (0.02, 0.1, 0.3, 0.5)
IV_LABELS = ("Useless", "Weak", "Medium", "Strong", "Suspicious")
PSI_CUTS = (0.10, 0.25)
PSI_LABELS = ("Stable", "Monitor", "ALERT: Model Review Required")
GAP_CUTS = (0.05, 0.08)
GAP_LABELS = ("Pass", "Caution", "Fail")


def step_label(x: Column, cuts, labels, right_closed: bool = False) -> Column:
    """Label of the interval holding x; intervals are [a, b) or, if ``right_closed``, (a, b]."""
    inside = (lambda c: x <= c) if right_closed else (lambda c: x < c)
    out = F.when(x.isNull(), F.lit(None).cast("string"))
    for cut, label in zip(cuts, labels):
        out = out.when(inside(F.lit(cut)), F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def scale(pdo: float = PDO, base_score: float = BASE_SCORE, base_odds: float = BASE_ODDS) -> tuple[float, float]:
    factor = pdo / math.log(2)
    return factor, base_score - factor * math.log(base_odds)


def logit(p: Column) -> Column:
    """Log-odds of p; p is floored so that p = 0 gives a finite value instead of NULL."""
    safe = F.greatest(p, F.lit(PROB_FLOOR))
    return F.when(p.isNotNull(), F.log(safe / (F.lit(1.0) - p + F.lit(PROB_FLOOR))))


def logodds_score(log_odds: Column, pdo=PDO, base_score=BASE_SCORE, base_odds=BASE_ODDS, clip: bool = False) -> Column:
    """Points of a log-odds value, rounded half to even."""
    factor, offset = scale(pdo, base_score, base_odds)
    points = F.bround(F.lit(offset) + F.lit(factor) * log_odds, 0)
    if clip:
        points = F.when(points.isNotNull(), F.least(F.greatest(points, F.lit(float(SCORE_MIN))), F.lit(float(SCORE_MAX))))
    return points.cast("int")


def prob_score(p: Column, pdo=PDO, base_score=BASE_SCORE, base_odds=BASE_ODDS) -> Column:
    """Score on the 300..850 scale, higher is safer; truncated to whole points."""
    factor, offset = scale(pdo, base_score, base_odds)
    odds = (F.lit(1.0) - p) / F.greatest(p, F.lit(PROB_FLOOR))
    raw = F.lit(offset) + F.lit(factor) * F.log(F.greatest(odds, F.lit(PROB_FLOOR)))
    bounded = F.least(F.greatest(raw, F.lit(float(SCORE_MIN))), F.lit(float(SCORE_MAX)))
    return F.when(p.isNotNull(), bounded).cast("int")


def risk_tier(p: Column, right_closed: bool = False) -> Column:
    """Three tiers. The service rule is p < cut; ``right_closed`` gives the batch rule p <= cut."""
    return step_label(p, TIER3_CUTS, ("Low", "Medium", "High"), right_closed)


def risk_tier5(p: Column) -> Column:
    return step_label(p, TIER5_CUTS, TIER5_LABELS)


def decision5(p: Column) -> Column:
    return step_label(p, TIER5_CUTS, TIER5_DECISIONS)


def recommendation(tier: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, action in RECOMMENDATION.items():
        out = F.when(tier == name, F.lit(action)).otherwise(out)
    return out


def iv_label(iv: Column) -> Column:
    return step_label(iv, IV_CUTS, IV_LABELS)


def psi_status(psi: Column) -> Column:
    return step_label(psi, PSI_CUTS, PSI_LABELS)


def gap_status(gap: Column) -> Column:
    return step_label(gap, GAP_CUTS, GAP_LABELS)


def affordability_flags(loan: Column, income: Column, annuity: Column, goods: Column) -> dict[str, Column]:
    """Ratios of the request and their warning labels; a missing amount gives neither."""
    at_least_one = lambda x: F.when(x.isNotNull(), F.greatest(x, F.lit(1.0)))  # noqa: E731  greatest() skips NULLs
    lti = loan / at_least_one(income)
    ati = annuity / at_least_one(income)
    ctg = loan / at_least_one(goods)
    flag = lambda x, bound, label: F.when(x > bound, label).when(x.isNotNull(), "OK")
    return {
        "loan_to_income": lti,
        "loan_to_income_flag": flag(lti, 5, "High"),
        "annuity_to_income": ati,
        "annuity_to_income_flag": flag(ati, 0.4, "High"),
        "credit_to_goods": ctg,
        "credit_to_goods_flag": flag(ctg, 1.2, "Over-financed"),
    }
