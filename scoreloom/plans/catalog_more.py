"""Registered queries over several operators: feature table, logistic fit, fold metrics, monitoring plan, ranked tables, request columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features, metrics, models, monitoring, profile, scoring, splits, woe
from ..session import fresh_checkpoint_path
from ..sources import roles
from ..streaming import score as stream_score_ops
from . import catalog as c
from . import oracles as sql
from .catalog import ORACLES, query, rounded
from .features import finished_features


def doubles_rounded(df, digits: int = 6):
    """Every double rounded: the columns are many and irrational ones are among them."""
    return rounded(df, **{name: digits for name, kind in df.dtypes if kind == "double"})


# -- the whole feature table ------------------------------------------------------------------------

_FEATURES = [
    "SELECT m.* EXCLUDE (EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3, NAME_INCOME_TYPE, NAME_HOUSING_TYPE, NAME_EDUCATION_TYPE, CODE_GENDER, OCCUPATION_TYPE, latest_app_status)",
    *[f"round(COALESCE(m.EXT_SOURCE_{k}, (SELECT quantile_cont(EXT_SOURCE_{k}, 0.5) FROM merged)), 12) AS EXT_SOURCE_{k}" for k in (1, 2, 3)],
    "r.* EXCLUDE (SK_ID_CURR)", "e.* EXCLUDE (SK_ID_CURR)", "f.* EXCLUDE (SK_ID_CURR)", "x.* EXCLUDE (SK_ID_CURR)",
    *[
        f"COALESCE(CAST(COUNT({k}) OVER (PARTITION BY {k}) AS DOUBLE) / (SELECT COUNT({k}) FROM merged), 0) AS FREQ_{k}"
        for k in ("NAME_INCOME_TYPE", "NAME_HOUSING_TYPE", "NAME_EDUCATION_TYPE", "CODE_GENDER", "OCCUPATION_TYPE", "latest_app_status")
    ],
]
_FEATURE_CTES = [
    *c._ALL_CTES, f"r AS ({c._RATIOS_SQL})", f"e AS ({c._EXT_SQL})", f"x AS ({c._CROSS_SQL})",
    "f AS (SELECT SK_ID_CURR, " + ", ".join(
        f"CASE WHEN {k} IS NULL THEN 1 ELSE 0 END AS MISS_{k}"
        for k in [*features.MISSING_FLAG_COLUMNS, "bureau_loan_count", "bb_total_records", "cc_count", "pos_loan_count", "prev_app_count"]
    ) + " FROM merged)",
    ", ".join(_FEATURES).join(("made AS (", """ FROM merged m JOIN r ON r.SK_ID_CURR = m.SK_ID_CURR JOIN e ON e.SK_ID_CURR = m.SK_ID_CURR
  JOIN f ON f.SK_ID_CURR = m.SK_ID_CURR JOIN x ON x.SK_ID_CURR = m.SK_ID_CURR)""")),
]


def _feature_table(spark, sf_dir):
    return finished_features(c._merged(spark, sf_dir))


@query(sql.with_(_FEATURE_CTES, "SELECT SK_ID_CURR, TARGET, CAST(COLUMNS(* EXCLUDE (SK_ID_CURR, TARGET)) AS DOUBLE) FROM made"))
def feature_table(spark, sf_dir):
    """Merged, derived, imputed, encoded and crossed features of every applicant, numbers only."""
    made = c.std_rounded(_feature_table(spark, sf_dir))
    return rounded(made, cc_utilisation_trend=6, EXT_SOURCE_STD=9, EXT_SOURCE_1=12, EXT_SOURCE_2=12, EXT_SOURCE_3=12)


# -- logistic fit that SQL repeats ------------------------------------------------------------------

_FIT = ["price", "quantity"]
_C = 0.5


def _newton_sql(steps: int = 8) -> list[str]:
    """Newton steps on (1, a, b), unrolled; the 3 x 3 system is solved by Cramer's rule."""
    out = [
        "enc AS MATERIALIZED (SELECT y, " + ", ".join(f"{c._lookup_sql(f)} AS {x}" for f, x in zip(_FIT, "ab", strict=True)) + " FROM accounts)",
        "st AS (SELECT AVG(a) AS ma, stddev_pop(a) AS sa, AVG(b) AS mb, stddev_pop(b) AS sb, CAST(COUNT(*) AS DOUBLE) AS n, CAST(SUM(y) AS DOUBLE) AS p FROM enc)",
        f"z AS MATERIALIZED (SELECT y, (a - ma) / sa AS a, (b - mb) / sb AS b, {_C!r}::DOUBLE * n / (2 * CASE WHEN y = 1 THEN p ELSE n - p END) AS w FROM enc, st)",
        "w0 AS (SELECT 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2)",
    ]
    for k in range(1, steps + 1):
        sums = ", ".join(f"SUM(w * p * (1 - p) * {x}) AS h{i}{j}" for i, j, x in (("0", "0", "1"), ("0", "1", "a"), ("0", "2", "b"), ("1", "1", "a * a"), ("1", "2", "a * b"), ("2", "2", "b * b")))
        out.append(
            f"g{k} AS (SELECT b0, b1, b2, SUM(w * (p - y)) AS g0, SUM(w * (p - y) * a) + b1 AS g1, SUM(w * (p - y) * b) + b2 AS g2, {sums} FROM "
            f"(SELECT z.*, w{k - 1}.*, 1 / (1 + exp(-(b0 + b1 * a + b2 * b))) AS p FROM z, w{k - 1}) GROUP BY b0, b1, b2)"
        )
        out.append(
            f"s{k} AS (SELECT b0, b1, b2, g0, g1, g2, h00, h01, h02, h11 + 1 AS h11, h12, h22 + 1 AS h22 FROM g{k})"
        )
        det = "(h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h12 * h02) + h02 * (h01 * h12 - h11 * h02))"
        out.append(
            f"w{k} AS (SELECT b0 - (g0 * (h11 * h22 - h12 * h12) - h01 * (g1 * h22 - h12 * g2) + h02 * (g1 * h12 - h11 * g2)) / {det} AS b0, "
            f"b1 - (h00 * (g1 * h22 - h12 * g2) - g0 * (h01 * h22 - h12 * h02) + h02 * (h01 * g2 - g1 * h02)) / {det} AS b1, "
            f"b2 - (h00 * (h11 * g2 - g1 * h12) - h01 * (h01 * g2 - g1 * h02) + g0 * (h01 * h12 - h11 * h02)) / {det} AS b2 FROM s{k})"
        )
    out.append(
        f"fit AS (SELECT b1 / sa AS ca, b2 / sb AS cb, b0 - b1 / sa * ma - b2 / sb * mb AS i FROM w{steps}, st)"
    )
    out.append("coefs AS (SELECT 'price' AS feature, ca AS coef, i FROM fit UNION ALL SELECT 'quantity', cb, i FROM fit)")
    return out


_FIT_CTES = [*c._WOE_CTES, *_newton_sql()]


def _fitted(spark, sf_dir):
    return models.fit_scorecard(roles.accounts(spark, sf_dir), _FIT, "TARGET", _C)


@query(sql.with_(_FIT_CTES, f"""SELECT feature, bin, round(lo, 9) AS lo, round(hi, 9) AS hi, round(woe, 4) AS woe, round(coef, 4) AS coefficient,
  round(({c._OFFSET!r}::DOUBLE + {c._FACTOR!r}::DOUBLE * i) / 2 + {c._FACTOR!r}::DOUBLE * coef * woe, 1) AS points FROM woe JOIN coefs USING (feature)"""))
def scorecard_newton(spark, sf_dir):
    """Points of a scorecard fitted on two features, against the same Newton steps in SQL."""
    card = _fitted(spark, sf_dir)
    return rounded(woe.scorecard_points(card.woe.table, card.coefficients, card.intercept).drop("category"), lo=9, hi=9)


@query(sql.with_(_FIT_CTES, "SELECT feature, round(coef, 6) AS coefficient, round(abs(coef), 6) AS size FROM coefs ORDER BY size DESC, feature LIMIT 1"))
def top_coefficients(spark, sf_dir):
    """The feature of the largest coefficient of the fitted scorecard."""
    card = _fitted(spark, sf_dir)
    rows = [(f, round(v, 6), round(abs(v), 6)) for f, v in card.coefficients.items()]
    return profile.top(spark.createDataFrame(rows, "feature string, coefficient double, size double"), "size", 1)


@query(sql.with_(_FIT_CTES, """SELECT y AS "TARGET", COUNT(*) AS n, round(AVG(1 / (1 + exp(-(i + ca * a + cb * b)))), 6) AS mean_probability FROM enc, fit GROUP BY y"""))
def scorecard_scores(spark, sf_dir):
    """Mean probability that the fitted scorecard gives each class."""
    scored = _fitted(spark, sf_dir).predict(roles.accounts(spark, sf_dir), "p")
    return scored.groupBy("TARGET").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("p"), 6).alias("mean_probability"))


# -- fold metrics and overfit gap over given scores -------------------------------------------------

_FOLDED = """fl AS (SELECT model, fold, y, s FROM (SELECT CAST(l_orderkey % 5 AS INTEGER) AS fold, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
  l_extendedprice / (l_extendedprice + 50000.0::DOUBLE) AS champion, l_quantity / (l_quantity + 25.0::DOUBLE) AS xgb FROM lineitem) UNPIVOT (s FOR model IN (champion, xgb))),
fc AS (SELECT model, fold, s, CAST(SUM(y) AS DOUBLE) AS pos, CAST(COUNT(*) - SUM(y) AS DOUBLE) AS neg FROM fl GROUP BY ALL),
fr AS (SELECT *, SUM(pos) OVER w - pos AS pos_before, SUM(neg) OVER w - neg AS neg_before, SUM(pos) OVER k AS p, SUM(neg) OVER k AS n FROM fc
  WINDOW w AS (PARTITION BY model, fold ORDER BY s ROWS UNBOUNDED PRECEDING), k AS (PARTITION BY model, fold)),
fm AS (SELECT model, fold, CAST(MAX(p) + MAX(n) AS BIGINT) AS n, CAST(MAX(p) AS BIGINT) AS n_pos, SUM(pos * (neg_before + neg / 2)) / (MAX(p) * MAX(n)) AS auc,
  greatest(MAX((p - pos_before) / p - (n - neg_before) / n), 0) AS ks FROM fr GROUP BY model, fold)"""


def _folded_scores(spark, sf_dir):
    l = roles.table(spark, sf_dir, "lineitem")
    sat = lambda x, half: x / (x + F.lit(half))
    rows = l.select(
        (F.col("l_orderkey") % 5).cast("int").alias("fold"), F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("TARGET"),
        sat(F.col("l_extendedprice"), 50000.0).alias("champion"), sat(F.col("l_quantity"), 25.0).alias("xgb"),
    )
    return rows.unpivot(["fold", "TARGET"], ["champion", "xgb"], "model", "score")


@query(sql.with_([_FOLDED], "SELECT model, fold, n, n_pos, round(auc, 9) AS auc, round(2 * auc - 1, 9) AS gini, round(ks, 9) AS ks FROM fm"))
def cv_fold_metrics(spark, sf_dir):
    return rounded(models.fold_metrics(_folded_scores(spark, sf_dir), "TARGET", "score"), auc=9, gini=9, ks=9)


@query(sql.with_([_FOLDED], """SELECT model, round(cv_auc, 9) AS cv_auc, holdout_auc, round(holdout_auc - cv_auc, 9) AS gap, CASE WHEN abs(holdout_auc - cv_auc) < 0.08 THEN 'OK' ELSE 'Check' END AS status
FROM (SELECT model, AVG(auc) AS cv_auc FROM fm WHERE fold < 4 GROUP BY model) JOIN (SELECT model, round(auc, 4) AS holdout_auc FROM fm WHERE fold = 4) USING (model)"""))
def overfit_gap_scores(spark, sf_dir):
    """Four folds as the cross-validated ones, the fifth as the hold-out."""
    scores = _folded_scores(spark, sf_dir)
    cv = models.fold_metrics(scores.where("fold < 4"), "TARGET", "score")
    held = scores.where("fold = 4").groupBy("TARGET", "score", "model").agg(F.count(F.lit(1)).alias("k"))
    wide = held.select("TARGET", F.explode(F.array_repeat(F.struct(
        F.when(F.col("model") == "champion", F.col("score")).alias("champion"), F.when(F.col("model") == "xgb", F.col("score")).alias("xgb")), F.col("k").cast("int"))).alias("r"))
    holdout = metrics.compare_models(wide.select("TARGET", "r.*"), {"champion": "champion", "xgb": "xgb"}, "TARGET")
    return rounded(metrics.overfit_gap(cv, holdout), cv_auc=9, gap=9)


# -- monitoring plan with all its metrics -----------------------------------------------------------

_PLAN = f"""WITH m AS (SELECT feature AS subject, 'score_psi' AS metric, psi AS value FROM ({ORACLES['psi_models']}) UNION ALL
  SELECT feature, 'feature_psi', psi FROM ({ORACLES['drift_table']}) UNION ALL
  SELECT model, 'gini', gini FROM ({ORACLES['model_compare']}) UNION ALL
  SELECT concat(model, ':', segment), 'segment_auc_gap', gap FROM ({ORACLES['parity_gap']}) UNION ALL
  SELECT 'portfolio', 'default_rate_shift', round((SELECT AVG(CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0 END) FROM lineitem) - 0.3::DOUBLE, 6)),
t(metric, op, bound, severity, action) AS (VALUES {", ".join(f"('{m}', '{op}', {bound!r}::DOUBLE, {rank}, '{action}')" for m, op, bound, rank, action in monitoring.TRIGGERS)})
SELECT subject, metric, value, severity, bound, action FROM m JOIN t USING (metric)
WHERE CASE op WHEN '>' THEN value > bound WHEN '<' THEN value < bound ELSE abs(value) > bound END
QUALIFY row_number() OVER (PARTITION BY subject, metric ORDER BY severity DESC) = 1"""


@query(_PLAN)
def monitoring_plan(spark, sf_dir):
    """Alerts of all five metrics of the plan."""
    named = lambda df, subject, metric, value: df.select(subject.alias("subject"), F.lit(metric).alias("metric"), F.col(value).alias("value"))
    scored = roles.scored(spark, sf_dir)
    base, cur = roles.event_halves(spark, sf_dir)
    groups = c.fairness.fairness_auc(scored, roles.SEGMENTS, roles.SCORES, "TARGET")
    shift = scored.agg(F.round(F.avg("TARGET") - 0.3, 6).alias("value")).withColumn("who", F.lit("portfolio"))
    parts = [
        named(c.psi_models(spark, sf_dir), F.col("feature"), "score_psi", "psi"),
        named(monitoring.drift_table(base, cur), F.col("feature"), "feature_psi", "psi"),
        named(metrics.compare_models(scored, roles.SCORES, "TARGET"), F.col("model"), "gini", "gini"),
        named(c.fairness.parity_gap(groups), F.concat("model", F.lit(":"), "segment"), "segment_auc_gap", "gap"),
        named(shift, F.col("who"), "default_rate_shift", "value"),
    ]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return monitoring.monitor_triggers(rows)


# -- ranked tables and preview ----------------------------------------------------------------------


@query(f"SELECT feature, psi, status FROM ({ORACLES['psi_features']}) ORDER BY psi DESC, feature LIMIT 3")
def top_psi(spark, sf_dir):
    return profile.top(c.psi_features(spark, sf_dir), "psi", 3).select("feature", "psi", "status")


@query(f"SELECT segment, segment_value, n, default_rate FROM ({ORACLES['segment_default_rate']}) ORDER BY default_rate DESC, segment_value LIMIT 5")
def top_segments(spark, sf_dir):
    rates = c.segment_default_rate(spark, sf_dir)
    return profile.top(rates, "default_rate", 5, "segment_value").select("segment", "segment_value", "n", "default_rate")


@query(f"SELECT feature, vif FROM ({ORACLES['vif']}) ORDER BY vif DESC, feature LIMIT 2")
def top_vif(spark, sf_dir):
    return profile.top(c.vif(spark, sf_dir), "vif", 2)


@query("""WITH r AS (SELECT corr(l_quantity, l_extendedprice) AS ab FROM lineitem)
SELECT 'l_quantity' AS feature, round(1 / (1 - ab * ab), 2) AS vif FROM r UNION ALL SELECT 'l_extendedprice', round(1 / (1 - ab * ab), 2) FROM r""")
def vif_widest(spark, sf_dir):
    """VIF among the two features of the largest variance."""
    return metrics.vif(roles.table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_tax"], max_features=2)


@query(sql.with_([sql.APPLICATION], "SELECT SK_ID_CURR, TARGET, NAME_INCOME_TYPE, AMT_CREDIT FROM application ORDER BY SK_ID_CURR LIMIT 5"))
def preview(spark, sf_dir):
    return profile.preview(roles.application(spark, sf_dir).select("SK_ID_CURR", "TARGET", "NAME_INCOME_TYPE", "AMT_CREDIT"), "SK_ID_CURR")


# -- every column of the request mappings -----------------------------------------------------------

_E = {"1": "0.5::DOUBLE", "2": "COALESCE(ext_source_2, 0.5::DOUBLE)", "3": "0.5::DOUBLE"}
_LIST = f"[{_E['1']}, {_E['2']}, {_E['3']}]"
_SERVICE = {
    "AGE_YEARS": "CAST(age AS DOUBLE)", "AMT_INCOME_TOTAL": "income", "AMT_CREDIT": "loan_amount", "AMT_ANNUITY": "annuity", "AMT_GOODS_PRICE": "goods_price",
    "EMPLOYMENT_YEARS": "0.0::DOUBLE", "bureau_loan_count": "CAST(bureau_loan_count AS DOUBLE)", "active_credits": "CAST(active_credits AS DOUBLE)", "total_debt": "total_debt",
    "overdue_count": "0.0::DOUBLE", **{f"EXT_SOURCE_{k}": e for k, e in _E.items()},
    "LOAN_INCOME_RATIO": "loan_amount / (income + 1)", "ANNUITY_INCOME_RATIO": "annuity / (income + 1)", "CREDIT_GOODS_RATIO": "loan_amount / (goods_price + 1)",
    "CREDIT_TERM": "annuity / (loan_amount + 1)", "GOODS_INCOME_RATIO": "goods_price / (income + 1)", "INCOME_PER_PERSON": "income",
    "DAYS_BIRTH": "-abs(CAST(age AS DOUBLE)) * 365.25::DOUBLE", "DAYS_EMPLOYED": "0.0::DOUBLE", "REGISTRATION_YEARS": "5.0::DOUBLE", "ID_PUBLISH_YEARS": "5.0::DOUBLE",
    "EMPLOY_TO_AGE_RATIO": "0.0::DOUBLE / (age + 0.01::DOUBLE)", "EXT_SOURCE_MEAN": f"({_E['1']} + {_E['2']} + {_E['3']}) / 3", "EXT_SOURCE_STD": f"list_stddev_samp({_LIST})",
    "EXT_SOURCE_MIN": f"list_min({_LIST})", "EXT_SOURCE_MAX": f"list_max({_LIST})", "EXT_SOURCE_RANGE": f"list_max({_LIST}) - list_min({_LIST})",
    "EXT_SRC_1x2": f"{_E['1']} * {_E['2']}", "EXT_SRC_2x3": f"{_E['2']} * {_E['3']}", "EXT_SRC_1x3": f"{_E['1']} * {_E['3']}", "EXT_SRC2_x_AGE": f"{_E['2']} * age", "EXT_SRC3_x_AGE": f"{_E['3']} * age",
    "PAYMENT_RATE": "annuity / (loan_amount + 1)", "CREDIT_OVERCHARGE": "(loan_amount - goods_price) / (goods_price + 1)",
}
_W = features.EXT_WEIGHTS
_FORM = {
    **_SERVICE, "DAYS_REGISTRATION": "-5 * 365.25::DOUBLE", "DAYS_ID_PUBLISH": "-5 * 365.25::DOUBLE", "active_loans": "CAST(active_credits AS DOUBLE)", "overdue_loan_count": "0.0::DOUBLE",
    "active_contracts": "greatest(20.0::DOUBLE, active_credits * 5)", "avg_debt": "total_debt / greatest(bureau_loan_count, 1)", "debt_to_credit_ratio": "total_debt / greatest(loan_amount, 1)",
    "bureau_loans_last_12m": "greatest(1.0::DOUBLE, floor(bureau_loan_count / 3))", "bureau_loans_last_24m": "greatest(1.0::DOUBLE, floor(bureau_loan_count / 2))",
    "active_loans_last_12m": "CAST(active_credits AS DOUBLE)", "avg_debt_last_12m": "total_debt / greatest(bureau_loan_count, 1)", "bureau_credit_type_count": "CAST(greatest(bureau_loan_count, 1) AS DOUBLE)",
    "avg_bureau_annuity": "CASE WHEN bureau_loan_count > 0 THEN annuity * 0.25::DOUBLE ELSE 0 END", "std_debt_amount": "total_debt * 0.5::DOUBLE", "bureau_day_overdue_count": "0.0::DOUBLE",
    "max_bureau_day_overdue": "0.0::DOUBLE", "MISS_bureau_loan_count": "CASE WHEN bureau_loan_count > 0 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END",
    "EXT_SRC_1x2x3": f"{_E['1']} * {_E['2']} * {_E['3']}", "EXT_SRC_PROD": f"{_E['1']} * {_E['2']} * {_E['3']}",
    "EXT_SOURCE_WEIGHTED": " + ".join(f"{_E[k]} * {w!r}::DOUBLE" for k, w in zip("123", _W, strict=True)),
    "TE_NAME_EDUCATION_TYPE": "CASE education_type " + " ".join(f"WHEN '{k}' THEN {v!r}::DOUBLE" for k, v in scoring.TE_EDUCATION.items()) + f" ELSE {scoring.TE_EDUCATION['Secondary']!r}::DOUBLE END",
    "TE_NAME_FAMILY_STATUS": f"{scoring.TE_FAMILY['Married']!r}::DOUBLE", "TE_NAME_HOUSING_TYPE": f"{scoring.TE_HOUSING['House / apartment']!r}::DOUBLE",
    **{f"EXT_SRC{k}_SQ": f"{e} * {e}" for k, e in _E.items()}, **{f"EXT_SRC{k}_CB": f"{e} * {e} * {e}" for k, e in _E.items()},
    **{k: f"({v!r})::DOUBLE" for k, v in scoring.FORM_CONSTANTS.items()},
}


def _request_sql(columns: dict[str, str]) -> str:
    # adding 0 makes a negative zero a plain one on both sides
    return sql.with_([c._VALID], "SELECT request_id, " + ", ".join(f"round({x}, 9) + 0 AS {k}" for k, x in columns.items()) + " FROM good")


def _all_columns(spark, sf_dir, profile_name):
    df = doubles_rounded(c._request_frame(spark, sf_dir, profile_name), 9)
    return df.select("request_id", *[(F.col(k) + F.lit(0.0)).alias(k) for k in df.columns if k != "request_id"])


@query(_request_sql(_SERVICE))
def service_columns(spark, sf_dir):
    """All columns of the service's request mapping."""
    return _all_columns(spark, sf_dir, "service")


@query(_request_sql(_FORM))
def form_columns(spark, sf_dir):
    """All columns of the form's request mapping."""
    return _all_columns(spark, sf_dir, "form")


# -- stream with a stored model ---------------------------------------------------------------------


@query(f"SELECT *, 1 AS model_version FROM ({ORACLES['batch_score']})")
def stream_model_score(spark, sf_dir):
    """Requests as a stream, scored with the model that the registry names for the batch."""
    root = fresh_checkpoint_path(spark, "registry")
    models.Linear(c.LINEAR, c.LINEAR_INTERCEPT).save(f"{root}/linear")
    models.publish(spark, root, "linear", f"{root}/linear")

    def prepare(batch):
        good, _ = scoring.split_valid(scoring.validate(roles.requests_of(batch), keep=["request_id"]))
        return scoring.request_features(good, keep=["request_id"])

    columns = ["request_id", "default_probability", "credit_score", "risk_tier", "recommendation", "model_version"]
    stream_score_ops.start_model_stream(c._stream(spark, sf_dir, "orders"), root, f"{root}/rows", f"{root}/state", prepare, columns).awaitTermination()
    return spark.read.parquet(f"{root}/rows").select(*columns)


# -- models on the whole feature table --------------------------------------------------------------


def _outcome(df):
    """An outcome with signal: a hash of the applicant against a probability that rises with credit per income and falls with the external scores."""
    risk = F.expr("-1.5D + 6D * (0.35D - coalesce(EXT_SOURCE_MEAN, 0.35D)) + 8D * coalesce(late_payment_ratio, 0.1D) + 4D * least(coalesce(LOAN_INCOME_RATIO, 0.2D), 1D)")
    chance = F.pmod(F.xxhash64("SK_ID_CURR", F.lit(splits.SEED)), F.lit(1_000_000)) / F.lit(1_000_000.0)
    return df.withColumn("TARGET", (chance < 1 / (1 + F.exp(-risk))).cast("int"))


def _selected(spark, sf_dir):
    """Feature table with outcome and folds, and its features by information value."""
    df = splits.hash_folds(_outcome(_feature_table(spark, sf_dir)), "SK_ID_CURR", 2)
    df = c.stored(df, "model-features")
    names = features.numeric_columns(df, exclude=(*features.KEYS, features.TARGET, "fold"))
    return df, names


@query()
def feature_selection(spark, sf_dir):
    """Information value of every column of the feature table and which reach the floor."""
    df, names = _selected(spark, sf_dir)
    model = woe.WoeModel.fit(df, "TARGET", numeric=names)
    return model.iv_summary().withColumn("selected", F.col("iv") >= models.IV_FLOOR)


@query()
def feature_scorecard(spark, sf_dir):
    """Scorecard on the feature table: selection at the usual floor, regularisation search over folds, metrics per fold."""
    df, names = _selected(spark, sf_dir)
    return models.train_scorecard(df, names, "TARGET", "SK_ID_CURR").cv


@query()
def feature_boosted(spark, sf_dir):
    """Boosted trees on the selected columns of the feature table, metrics per fold."""
    df, names = _selected(spark, sf_dir)
    kept = woe.WoeModel.fit(df, "TARGET", numeric=names).select_by_iv(models.IV_FLOOR)
    oof = models.out_of_fold(df, {"boosted": models.boosted(max_iter=20)}, kept, "TARGET", "SK_ID_CURR")
    return models.fold_metrics(oof, "TARGET")
