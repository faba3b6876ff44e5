"""Registered queries: every operator over the test tables, whole tables only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scores as fs
from ..operators import binning, encoding, fairness, features, history, metrics, monitoring, profile, ranking, scoring
from ..operators import models, splits, woe
from ..session import fresh_checkpoint_path, reliable, stored
from ..sources import roles
from ..streaming import psi as stream_psi_ops
from ..streaming import score as stream_score_ops
from . import oracles as sql
from .features import history_aggregates, merge_stored, store_histories

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    """Register a query under its function name, with its SQL when there is one."""

    def add(fn):
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLES[fn.__name__] = oracle
        return fn

    return add


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: F.round(c, d) for c, d in digits.items()})


def std_rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in df.columns if c.startswith("std_")})


# -- history ----------------------------------------------------------------------------------------


@query(sql.with_([sql.BUREAU], sql.BUREAU_AGG))
def bureau_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return std_rounded(history.bureau_history(roles.bureau(spark, sf_dir)))


@query(sql.with_([sql.BUREAU, sql.BUREAU_BALANCE], sql.BUREAU_BALANCE_AGG))
def bureau_balance_agg(spark, sf_dir):
    return history.bureau_balance_history(roles.bureau_balance(spark, sf_dir), roles.bureau(spark, sf_dir))


@query(sql.with_([sql.PREV, sql.CARD], sql.CARD_AGG))
def credit_card_agg(spark, sf_dir):
    out = history.credit_card_history(roles.credit_card(spark, sf_dir), roles.previous_application(spark, sf_dir))
    return rounded(std_rounded(out), cc_utilisation_trend=6)


@query(sql.with_([sql.PREV, sql.INSTALLMENTS], sql.INSTALLMENT_AGG))
def installment_features(spark, sf_dir):
    out = history.installment_history(roles.installments(spark, sf_dir), roles.previous_application(spark, sf_dir))
    return std_rounded(out)


@query(sql.with_([sql.PREV, sql.POS], sql.POS_AGG))
def pos_cash_agg(spark, sf_dir):
    out = history.pos_cash_history(roles.pos_cash(spark, sf_dir), roles.previous_application(spark, sf_dir))
    return std_rounded(out)


@query(sql.with_([sql.PREV], sql.PREV_AGG))
def previous_app_agg(spark, sf_dir):
    return std_rounded(history.previous_application_history(roles.previous_application(spark, sf_dir)))


@query(sql.with_([sql.PREV], """SELECT SK_ID_CURR, arg_max(NAME_CONTRACT_STATUS, (DAYS_DECISION, SK_ID_PREV)) AS latest_app_status,
  MAX(DAYS_DECISION) AS latest_decision_days FROM prev GROUP BY SK_ID_CURR"""))
def latest_status(spark, sf_dir):
    return history.latest_status(roles.previous_application(spark, sf_dir))


_ALL_CTES = [
    sql.PREV, sql.BUREAU, sql.BUREAU_BALANCE, sql.INSTALLMENTS, sql.POS, sql.CARD, sql.APPLICATION,
    f"bureau_h AS ({sql.BUREAU_AGG})", f"bb_h AS ({sql.BUREAU_BALANCE_AGG})", f"card_h AS ({sql.CARD_AGG})",
    f"inst_h AS ({sql.INSTALLMENT_AGG})", f"pos_h AS ({sql.POS_AGG})", f"prev_h AS ({sql.PREV_AGG})",
    """merged AS (SELECT a.*, b.* EXCLUDE (SK_ID_CURR, avg_credit_amount), b.avg_credit_amount AS bureau_avg_credit_amount,
      bb.* EXCLUDE (SK_ID_CURR), c.* EXCLUDE (SK_ID_CURR), i.* EXCLUDE (SK_ID_CURR), p.* EXCLUDE (SK_ID_CURR),
      v.* EXCLUDE (SK_ID_CURR, avg_credit_amount), v.avg_credit_amount AS prev_avg_credit_amount
    FROM application a LEFT JOIN bureau_h b USING (SK_ID_CURR) LEFT JOIN bb_h bb USING (SK_ID_CURR)
      LEFT JOIN card_h c USING (SK_ID_CURR) LEFT JOIN inst_h i USING (SK_ID_CURR) LEFT JOIN pos_h p USING (SK_ID_CURR)
      LEFT JOIN prev_h v USING (SK_ID_CURR))""",
]


def _children(spark, sf_dir):
    return dict(
        bureau=roles.bureau(spark, sf_dir), bureau_balance=roles.bureau_balance(spark, sf_dir),
        previous_application=roles.previous_application(spark, sf_dir),
        installments_payments=roles.installments(spark, sf_dir), pos_cash_balance=roles.pos_cash(spark, sf_dir),
        credit_card_balance=roles.credit_card(spark, sf_dir),
    )


def _merged(spark, sf_dir):
    return history.merge_features(roles.application(spark, sf_dir), history_aggregates(**_children(spark, sf_dir)))


@query(sql.with_(_ALL_CTES, "SELECT * FROM merged"))
def feature_merge(spark, sf_dir):
    return rounded(std_rounded(_merged(spark, sf_dir)), cc_utilisation_trend=6)


@query(ORACLES["feature_merge"])
def feature_merge_stored(spark, sf_dir):
    """The same from tables dealt by applicant."""
    store = fresh_checkpoint_path(spark, "store")
    store_histories(roles.application(spark, sf_dir), store, **_children(spark, sf_dir), count=int(spark.conf.get("spark.sql.shuffle.partitions")))
    return rounded(std_rounded(merge_stored(spark, store)), cc_utilisation_trend=6)


# -- features ---------------------------------------------------------------------------------------

_Y = "365.25::DOUBLE"
_RATIOS_SQL = f"""SELECT SK_ID_CURR, AMT_CREDIT / (AMT_INCOME_TOTAL + 1) AS LOAN_INCOME_RATIO,
  AMT_ANNUITY / (AMT_INCOME_TOTAL + 1) AS ANNUITY_INCOME_RATIO, AMT_CREDIT / (AMT_GOODS_PRICE + 1) AS CREDIT_GOODS_RATIO,
  AMT_ANNUITY / (AMT_CREDIT + 1) AS CREDIT_TERM, AMT_GOODS_PRICE / (AMT_INCOME_TOTAL + 1) AS GOODS_INCOME_RATIO,
  CASE WHEN CNT_FAM_MEMBERS IS NOT NULL THEN AMT_INCOME_TOTAL / greatest(CNT_FAM_MEMBERS, 1) END AS INCOME_PER_PERSON,
  -DAYS_BIRTH / {_Y} AS AGE_YEARS, greatest(-DAYS_EMPLOYED, 0) / {_Y} AS EMPLOYMENT_YEARS, -DAYS_REGISTRATION / {_Y} AS REGISTRATION_YEARS,
  -DAYS_ID_PUBLISH / {_Y} AS ID_PUBLISH_YEARS,
  (greatest(-DAYS_EMPLOYED, 0) / {_Y}) / (-DAYS_BIRTH / {_Y} + 0.01::DOUBLE) AS EMPLOY_TO_AGE_RATIO,
  -DAYS_LAST_PHONE_CHANGE / {_Y} AS PHONE_CHANGE_YEARS,
  CAST(FLAG_DOCUMENT_2 + FLAG_DOCUMENT_3 + FLAG_DOCUMENT_4 AS DOUBLE) AS DOCUMENT_COUNT,
  CAST(REG_REGION_NOT_LIVE_REGION + REG_CITY_NOT_WORK_CITY AS DOUBLE) AS ADDR_MISMATCH_COUNT,
  CAST(COALESCE(AMT_REQ_CREDIT_BUREAU_YEAR, 0) + COALESCE(AMT_REQ_CREDIT_BUREAU_MON, 0) AS DOUBLE) AS BUREAU_ENQUIRY_TOTAL,
  AMT_ANNUITY / (AMT_CREDIT + 1) AS PAYMENT_RATE, (AMT_CREDIT - AMT_GOODS_PRICE) / (AMT_GOODS_PRICE + 1) AS CREDIT_OVERCHARGE,
  AMT_ANNUITY * (greatest(-DAYS_EMPLOYED, 0) / {_Y}) AS ANNUITY_x_EMPLOYMENT, AMT_INCOME_TOTAL * EXT_SOURCE_2 AS INCOME_x_EXT2,
  AMT_CREDIT * (-DAYS_BIRTH / {_Y}) AS CREDIT_x_AGE
FROM application"""


@query(sql.with_([sql.APPLICATION], _RATIOS_SQL))
def derived_ratios(spark, sf_dir):
    app = roles.application(spark, sf_dir)
    out = features.derived_features(app)
    new = [c for c in out.columns if c not in app.columns and "EXT_S" not in c]
    return out.select("SK_ID_CURR", *new)


_EXT_SQL = """SELECT SK_ID_CURR, (COALESCE(a, 0) + COALESCE(b, 0) + COALESCE(c, 0)) / NULLIF(len(x), 0) AS EXT_SOURCE_MEAN, round(CASE WHEN len(x) > 1 THEN list_stddev_samp(x) END, 9) AS EXT_SOURCE_STD,
  list_min(x) AS EXT_SOURCE_MIN, list_max(x) AS EXT_SOURCE_MAX, list_max(x) - list_min(x) AS EXT_SOURCE_RANGE,
  a * b AS EXT_SRC_1x2, b * c AS EXT_SRC_2x3, a * c AS EXT_SRC_1x3, b * age AS EXT_SRC2_x_AGE, c * age AS EXT_SRC3_x_AGE,
  a * a AS EXT_SRC1_SQ, b * b AS EXT_SRC2_SQ, c * c AS EXT_SRC3_SQ, b * b * b AS EXT_SRC2_CB, a * b * c AS EXT_SRC_PROD,
  a * 0.2::DOUBLE + b * 0.5::DOUBLE + c * 0.3::DOUBLE AS EXT_SOURCE_WEIGHTED
FROM (SELECT SK_ID_CURR, EXT_SOURCE_1 AS a, EXT_SOURCE_2 AS b, EXT_SOURCE_3 AS c, -DAYS_BIRTH / 365.25::DOUBLE AS age,
  list_filter([EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3], lambda v: v IS NOT NULL) AS x FROM application)"""


@query(sql.with_([sql.APPLICATION], _EXT_SQL))
def ext_rowwise_stats(spark, sf_dir):
    app = roles.application(spark, sf_dir)
    new = features.external_score_features(app.columns, -F.col("DAYS_BIRTH") / 365.25)
    return rounded(app.select("SK_ID_CURR", *[v.alias(k) for k, v in new.items()]), EXT_SOURCE_STD=9)


_FLAGGED = list(features.MISSING_FLAG_COLUMNS)


@query(sql.with_(_ALL_CTES, "SELECT SK_ID_CURR, " + ", ".join(
    f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END AS MISS_{c}"
    for c in [*_FLAGGED, "bureau_loan_count", "bb_total_records", "cc_count", "pos_loan_count", "prev_app_count"]
) + " FROM merged"))
def missing_flags(spark, sf_dir):
    out = features.missing_flags(_merged(spark, sf_dir))
    return out.select("SK_ID_CURR", *[c for c in out.columns if c.startswith("MISS_")])


@query(sql.with_([sql.APPLICATION], "SELECT SK_ID_CURR, " + ", ".join(
    f"round(COALESCE(EXT_SOURCE_{k}, (SELECT quantile_cont(EXT_SOURCE_{k}, 0.5) FROM application)), 12) AS EXT_SOURCE_{k}" for k in (1, 2, 3)
) + " FROM application"))
def median_impute(spark, sf_dir):
    app = roles.application(spark, sf_dir)
    cols = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]
    return rounded(features.impute_median(app).select("SK_ID_CURR", *cols), **{c: 12 for c in cols})


_FREQ_COLS = roles.APPLICANT_TEXT


@query(sql.with_([sql.APPLICATION], "SELECT SK_ID_CURR, " + ", ".join(
    f"COALESCE(CAST(COUNT({c}) OVER (PARTITION BY {c}) AS DOUBLE) / (SELECT COUNT({c}) FROM application), 0) AS FREQ_{c}" for c in _FREQ_COLS
) + " FROM application"))
def freq_encode(spark, sf_dir):
    app = roles.application(spark, sf_dir)
    return encoding.frequency_encode(app, _FREQ_COLS).select("SK_ID_CURR", *[f"FREQ_{c}" for c in _FREQ_COLS])


_FOLDS_SQL = """folded AS (SELECT *, CAST((row_number() OVER (PARTITION BY TARGET
  ORDER BY md5(concat(CAST(SK_ID_CURR AS VARCHAR), ':42')), SK_ID_CURR) - 1) % 5 AS INTEGER) AS fold FROM application)"""
_TE_COLS = ["NAME_INCOME_TYPE", "NAME_HOUSING_TYPE", "OCCUPATION_TYPE"]


def _te_sql(c: str) -> str:
    n = f"(COUNT(*) OVER (PARTITION BY {c}) - COUNT(*) OVER (PARTITION BY {c}, fold))"
    s = f"(SUM(TARGET) OVER (PARTITION BY {c}) - SUM(TARGET) OVER (PARTITION BY {c}, fold))"
    prior = "(CAST(SUM(TARGET) OVER () - SUM(TARGET) OVER (PARTITION BY fold) AS DOUBLE) / (COUNT(*) OVER () - COUNT(*) OVER (PARTITION BY fold)))"
    return f"round(CASE WHEN {c} IS NULL THEN {prior} ELSE ({s} + {prior} * 20) / ({n} + 20) END, 9) AS TE_{c}"


@query(sql.with_([sql.APPLICATION, _FOLDS_SQL], "SELECT SK_ID_CURR, fold, " + ", ".join(_te_sql(c) for c in _TE_COLS) + " FROM folded"))
def target_encode_oof(spark, sf_dir):
    app = splits.stratified_folds(roles.application(spark, sf_dir), "SK_ID_CURR", "TARGET")
    out = encoding.target_encode_oof(app, _TE_COLS, "TARGET", "fold")
    return rounded(out.select("SK_ID_CURR", "fold", *[f"TE_{c}" for c in _TE_COLS]), **{f"TE_{c}": 9 for c in _TE_COLS})


_CROSS_SQL = """SELECT SK_ID_CURR, CAST(greatest(max_cc_dpd, max_dpd, max_dpd_def) AS DOUBLE) AS WORST_DPD_ALL,
  CAST(COALESCE(bb_dpd_count, 0) + COALESCE(cc_months_with_dpd, 0) + COALESCE(months_with_dpd, 0) AS DOUBLE) AS TOTAL_DPD_MONTHS,
  COALESCE(debt_to_credit_ratio, 0) * 0.5::DOUBLE + (CAST(overdue_count AS DOUBLE) / CASE WHEN bureau_loan_count IS NOT NULL THEN greatest(bureau_loan_count, 1) END) * 0.3::DOUBLE
    + (1 - COALESCE(bb_current_ratio, 0.5::DOUBLE)) * 0.2::DOUBLE AS BUREAU_RISK_SCORE,
  (1 - COALESCE(late_payment_ratio, 0)) * 0.5::DOUBLE + least(COALESCE(payment_to_due_ratio, 1), 1.5::DOUBLE) / 1.5::DOUBLE * 0.5::DOUBLE AS PAYMENT_DISCIPLINE,
  (COALESCE(total_credit_amount, 0) + AMT_CREDIT) / (AMT_INCOME_TOTAL + 1) AS TOTAL_EXPOSURE_RATIO
FROM merged"""


@query(sql.with_(_ALL_CTES, _CROSS_SQL))
def cross_table(spark, sf_dir):
    out = features.cross_table_features(_merged(spark, sf_dir))
    return out.select(
        "SK_ID_CURR", "WORST_DPD_ALL", "TOTAL_DPD_MONTHS", "BUREAU_RISK_SCORE", "PAYMENT_DISCIPLINE", "TOTAL_EXPOSURE_RATIO"
    )


@query(sql.with_([sql.APPLICATION], """SELECT SK_ID_CURR, EXT_SOURCE_2, 0.0::DOUBLE AS OWN_CAR_AGE, CAST(CNT_FAM_MEMBERS AS DOUBLE) AS CNT_FAM_MEMBERS,
  CAST(DAYS_BIRTH AS DOUBLE) AS DAYS_BIRTH FROM application"""))
def align_columns(spark, sf_dir):
    app = roles.application(spark, sf_dir)
    return features.align_columns(app, ["EXT_SOURCE_2", "OWN_CAR_AGE", "CNT_FAM_MEMBERS", "DAYS_BIRTH"], keep=["SK_ID_CURR"])


@query(sql.with_([sql.APPLICATION], "SELECT SK_ID_CURR, " + ", ".join(
    f"CASE WHEN {c} IS NULL THEN -1 ELSE CAST(dense_rank() OVER (PARTITION BY {c} IS NULL ORDER BY {c}) - 1 AS INTEGER) END AS CODE_{c}" for c in _FREQ_COLS
) + " FROM application"))
def category_codes(spark, sf_dir):
    app = roles.application(spark, sf_dir)
    table = encoding.category_code_table(app, _FREQ_COLS)
    return encoding.apply_category_codes(app, table, _FREQ_COLS).select("SK_ID_CURR", *[f"CODE_{c}" for c in _FREQ_COLS])


@query("SELECT request_id, TRY_CAST(age AS DOUBLE) AS age, TRY_CAST(annuity AS DOUBLE) AS annuity FROM ({REQUESTS})")
def coerce_numeric(spark, sf_dir):
    req = roles.requests(spark, sf_dir).select("request_id", "age", "annuity")
    return features.coerce_numeric(req, ["age", "annuity"])


# -- binning and weight of evidence -----------------------------------------------------------------

_ACCOUNTS = """accounts AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, l_orderkey AS order_id, l_extendedprice AS price,
  l_quantity AS quantity, NULLIF(l_discount, 0) AS discount, l_tax AS tax, l_linestatus AS status,
  CASE WHEN l_linenumber > 1 THEN CAST(l_linenumber AS VARCHAR) END AS line FROM lineitem)"""
_TENTHS = "[" + ", ".join(f"{i / 10}" for i in range(11)) + "]"
_EDGES = f"""long AS (UNPIVOT accounts ON price, quantity, discount, tax INTO NAME feature VALUE v),
edges AS (SELECT feature, list_sort(list_distinct(quantile_cont(v, {_TENTHS}))) AS e FROM long GROUP BY feature),
binned AS (SELECT long.*, e, CAST(greatest(len(list_filter(e, lambda x: x < v)), 1) - 1 AS INTEGER) AS bin FROM long JOIN edges USING (feature))"""
_WOE_SQL = f"""stats AS (SELECT feature, bin, e[bin + 1] AS lo, e[bin + 2] AS hi, CAST(SUM(y) AS BIGINT) AS events,
  CAST(COUNT(*) - SUM(y) AS BIGINT) AS non_events FROM binned GROUP BY feature, bin, e),
rates AS (SELECT *, (events + 0.5::DOUBLE) / (SUM(events) OVER (PARTITION BY feature) + 1.0::DOUBLE) AS event_rate,
  (non_events + 0.5::DOUBLE) / (SUM(non_events) OVER (PARTITION BY feature) + 1.0::DOUBLE) AS non_event_rate FROM stats),
woe AS (SELECT *, ln(non_event_rate / event_rate) AS woe, (non_event_rate - event_rate) * ln(non_event_rate / event_rate) AS iv_component FROM rates)"""
_WOE_CTES = [_ACCOUNTS, _EDGES, _WOE_SQL]
_CAT_WOE = """clong AS (UNPIVOT accounts ON status, line INTO NAME feature VALUE category),
cstats AS (SELECT feature, category, CAST(SUM(y) AS BIGINT) AS events, CAST(COUNT(*) - SUM(y) AS BIGINT) AS non_events FROM clong GROUP BY ALL),
crates AS (SELECT *, (events + 0.5::DOUBLE) / (SUM(events) OVER (PARTITION BY feature) + 1.0::DOUBLE) AS event_rate,
  (non_events + 0.5::DOUBLE) / (SUM(non_events) OVER (PARTITION BY feature) + 1.0::DOUBLE) AS non_event_rate FROM cstats),
cwoe AS (SELECT *, ln(non_event_rate / event_rate) AS woe, (non_event_rate - event_rate) * ln(non_event_rate / event_rate) AS iv_component FROM crates)"""
_WOE_ROUND = {"event_rate": 9, "non_event_rate": 9, "woe": 9, "iv_component": 9}
_WOE_OUT = ", ".join(f"round({c}, 9) AS {c}" for c in _WOE_ROUND)


@query(sql.with_([_ACCOUNTS, _EDGES], """, w AS (SELECT feature, bin, COUNT(*) AS n, MIN(v) AS min_v, MAX(v) AS max_v FROM binned GROUP BY feature, bin)
SELECT * FROM w"""))
def quantile_bins(spark, sf_dir):
    acc = roles.accounts(spark, sf_dir)
    cols = roles.ACCOUNT_FEATURES
    out = binning.quantile_bins(acc.select(*cols), cols, 10)
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"{c}_bin").alias("bin"), F.col(c).alias("v")) for c in cols
    ]))
    return out.select(pairs.alias("r")).select("r.*").where(F.col("bin").isNotNull()).groupBy("feature", "bin").agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("min_v"), F.max("v").alias("max_v")
    )


@query(sql.with_([sql.APPLICATION], """SELECT CASE WHEN a > 18 AND a <= 25 THEN '18-25' WHEN a > 25 AND a <= 35 THEN '26-35' WHEN a > 35 AND a <= 45 THEN '36-45'
  WHEN a > 45 AND a <= 55 THEN '46-55' WHEN a > 55 AND a <= 65 THEN '56-65' WHEN a > 65 AND a <= 100 THEN '65+' END AS AGE_BAND,
  COUNT(*) AS n, CAST(SUM(TARGET) AS BIGINT) AS defaults FROM (SELECT -DAYS_BIRTH / 365.25::DOUBLE AS a, TARGET FROM application) GROUP BY 1"""))
def fixed_bins(spark, sf_dir):
    app = fairness.with_age_band(roles.application(spark, sf_dir), fairness.EDA_AGES)
    return app.groupBy("AGE_BAND").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("TARGET") == 1).alias("defaults"))


_FIFTHS = "[0.0, 0.2, 0.4, 0.6, 0.8, 1.0]"


def _quintile_sql(x: str) -> str:
    e = f"(SELECT list_sort(list_distinct(quantile_cont({x}, {_FIFTHS}))) FROM base)"
    return f"['Very Low', 'Low', 'Medium', 'High', 'Very High'][CAST(greatest(len(list_filter({e}, lambda q: q < {x})), 1) AS INTEGER)]"


@query(sql.with_([sql.APPLICATION, "base AS (SELECT SK_ID_CURR, AMT_INCOME_TOTAL, AMT_CREDIT / (AMT_INCOME_TOTAL + 1) AS LOAN_INCOME_RATIO FROM application)"],
       f"SELECT SK_ID_CURR, {_quintile_sql('AMT_INCOME_TOTAL')} AS INCOME_BAND, {_quintile_sql('LOAN_INCOME_RATIO')} AS LTI_BAND FROM base"))
def quintile_bands(spark, sf_dir):
    app = roles.application(spark, sf_dir).select(
        "SK_ID_CURR", "AMT_INCOME_TOTAL", (F.col("AMT_CREDIT") / (F.col("AMT_INCOME_TOTAL") + 1)).alias("LOAN_INCOME_RATIO")
    )
    out = binning.quintile_bands(app, {"AMT_INCOME_TOTAL": "INCOME_BAND", "LOAN_INCOME_RATIO": "LTI_BAND"})
    return out.select("SK_ID_CURR", "INCOME_BAND", "LTI_BAND")


def _numeric_woe(spark, sf_dir):
    return woe.WoeModel.fit(roles.accounts(spark, sf_dir), "TARGET", numeric=roles.ACCOUNT_FEATURES)


@query(sql.with_(_WOE_CTES, f"SELECT feature, bin, round(lo, 9) AS lo, round(hi, 9) AS hi, events, non_events, {_WOE_OUT} FROM woe"))
def woe_fit_numeric(spark, sf_dir):
    return rounded(_numeric_woe(spark, sf_dir).table.drop("kind", "category"), lo=9, hi=9, **_WOE_ROUND)


@query(sql.with_([_ACCOUNTS, _CAT_WOE], f"SELECT feature, category, events, non_events, {_WOE_OUT} FROM cwoe"))
def woe_fit_categorical(spark, sf_dir):
    model = woe.WoeModel.fit(roles.accounts(spark, sf_dir), "TARGET", categorical=roles.ACCOUNT_CATEGORIES)
    return rounded(model.table.drop("kind", "bin", "lo", "hi"), **_WOE_ROUND)


def _lookup_sql(f: str) -> str:
    return f"(SELECT list(woe ORDER BY bin) FROM woe WHERE feature = '{f}')[CAST(greatest(len(list_filter((SELECT e FROM edges WHERE feature = '{f}'), lambda x: x < {f})), 1) AS INTEGER)]"


@query(sql.with_([*_WOE_CTES, _CAT_WOE], "SELECT order_id, price, quantity, " + ", ".join(
    f"round(CASE WHEN {f} IS NOT NULL THEN {_lookup_sql(f)} END, 9) AS {f}_woe" for f in roles.ACCOUNT_FEATURES
) + """, round(s.woe, 9) AS status_woe, round(l.woe, 9) AS line_woe FROM accounts LEFT JOIN cwoe s ON s.feature = 'status' AND s.category = status
  LEFT JOIN cwoe l ON l.feature = 'line' AND l.category = line"""))
def woe_transform(spark, sf_dir):
    acc = roles.accounts(spark, sf_dir)
    cols = [*roles.ACCOUNT_FEATURES, *roles.ACCOUNT_CATEGORIES]
    model = woe.WoeModel.fit(acc, "TARGET", numeric=roles.ACCOUNT_FEATURES, categorical=roles.ACCOUNT_CATEGORIES)
    out = model.transform(acc, suffix="_woe")
    return rounded(out.select("order_id", "price", "quantity", *[f"{c}_woe" for c in cols]), **{f"{c}_woe": 9 for c in cols})


_IV = "SELECT feature, SUM(iv_component) AS iv FROM (SELECT feature, iv_component FROM woe UNION ALL SELECT feature, iv_component FROM cwoe) GROUP BY feature"
_IV_LABEL = "CASE WHEN iv < 0.02 THEN 'Useless' WHEN iv < 0.1 THEN 'Weak' WHEN iv < 0.3 THEN 'Medium' WHEN iv < 0.5 THEN 'Strong' ELSE 'Suspicious' END"


def _full_woe(spark, sf_dir):
    return woe.WoeModel.fit(
        roles.accounts(spark, sf_dir), "TARGET", numeric=roles.ACCOUNT_FEATURES, categorical=roles.ACCOUNT_CATEGORIES
    )


@query(sql.with_([*_WOE_CTES, _CAT_WOE], f"SELECT feature, round(iv, 9) AS iv, {_IV_LABEL} AS predictive_power FROM ({_IV})"))
def iv_summary(spark, sf_dir):
    return rounded(_full_woe(spark, sf_dir).iv_summary(), iv=9)


@query(sql.with_([*_WOE_CTES, _CAT_WOE], f"SELECT {_IV_LABEL} AS predictive_power, COUNT(*) AS n_features FROM ({_IV}) GROUP BY 1"))
def iv_label_counts(spark, sf_dir):
    return _full_woe(spark, sf_dir).iv_summary().groupBy("predictive_power").agg(F.count(F.lit(1)).alias("n_features"))


@query(sql.with_([*_WOE_CTES, _CAT_WOE], f"SELECT feature FROM ({_IV}) WHERE iv >= 0.00005"))
def iv_select(spark, sf_dir):
    # The outcome of the test tables is independent of every feature, hence the low floor.
    kept = _full_woe(spark, sf_dir).select_by_iv(0.00005)
    return spark.createDataFrame([(f,) for f in kept], "feature string")


@query(sql.with_([*_WOE_CTES, _CAT_WOE], f"SELECT feature, round(iv, 9) AS iv FROM ({_IV}) ORDER BY iv DESC, feature LIMIT 3"))
def top_iv(spark, sf_dir):
    return profile.top(rounded(_full_woe(spark, sf_dir).iv_summary(), iv=9), "iv", 3).select("feature", "iv")


_COEFS = {"price": 0.5, "quantity": -0.3, "discount": 0.2, "tax": 0.1}
_FACTOR, _OFFSET = fs.scale()
_BASE = (_OFFSET + _FACTOR * -1.5) / 4


@query(sql.with_(_WOE_CTES, f"""SELECT feature, bin, round(lo, 9) AS lo, round(hi, 9) AS hi, round(woe, 4) AS woe, coef AS coefficient,
  round({_BASE!r}::DOUBLE + {_FACTOR!r}::DOUBLE * coef * woe, 1) AS points FROM woe JOIN (VALUES
  {', '.join(f"('{k}', {v}::DOUBLE)" for k, v in _COEFS.items())}) c(feature, coef) USING (feature)"""))
def scorecard_points(spark, sf_dir):
    return rounded(woe.scorecard_points(_numeric_woe(spark, sf_dir).table, _COEFS, -1.5).drop("category"), lo=9, hi=9)


# -- ranking and metrics ----------------------------------------------------------------------------

_RANKED = """counts AS (SELECT model, s, CAST(SUM(y) AS DOUBLE) AS pos, CAST(COUNT(*) - SUM(y) AS DOUBLE) AS neg FROM long GROUP BY model, s),
ranked AS (SELECT *, SUM(pos) OVER w - pos AS pos_before, SUM(neg) OVER w - neg AS neg_before, SUM(pos) OVER (PARTITION BY model) AS p,
  SUM(neg) OVER (PARTITION BY model) AS n FROM counts WINDOW w AS (PARTITION BY model ORDER BY s ROWS UNBOUNDED PRECEDING))"""
_DISC = """disc AS (SELECT model, CAST(MAX(p) + MAX(n) AS BIGINT) AS n, CAST(MAX(p) AS BIGINT) AS n_pos,
  SUM(pos * (neg_before + neg / 2)) / (MAX(p) * MAX(n)) AS auc,
  greatest(MAX((p - pos_before) / p - (n - neg_before) / n), 0) AS ks FROM ranked GROUP BY model)"""
_DISC_CTES = [sql.SCORED_LONG, _RANKED, _DISC]


def _long_scores(spark, sf_dir):
    return metrics._unpivot_scores(roles.scored(spark, sf_dir), roles.SCORES, ["TARGET"])


@query(sql.with_(_DISC_CTES, "SELECT model, n, n_pos, round(auc, 9) AS auc, round(2 * auc - 1, 9) AS gini FROM disc"))
def auc_gini(spark, sf_dir):
    out = ranking.discrimination(_long_scores(spark, sf_dir), "score", "TARGET", ["model"])
    return rounded(out.drop("ks"), auc=9, gini=9)


@query(sql.with_(_DISC_CTES, "SELECT round(ks, 9) AS ks, n FROM disc WHERE model = 'champion'"))
def ks(spark, sf_dir):
    out = ranking.discrimination(roles.scored(spark, sf_dir), "PRED_CHAMPION", "TARGET")
    return rounded(out.select("ks", "n"), ks=9)


@query(sql.with_(_DISC_CTES[:2], "SELECT model, s AS threshold, (n - neg_before) / n AS fpr, (p - pos_before) / p AS tpr FROM ranked"))
def roc_points(spark, sf_dir):
    return ranking.roc_points(_long_scores(spark, sf_dir), "score", "TARGET", ["model"]).select("model", F.col("threshold"), "fpr", "tpr")


_DECILE = [sql.SCORED, f"""de AS (SELECT list_sort(list_distinct(quantile_cont(PRED_CHAMPION, {_TENTHS}))) AS e FROM scored),
db AS (SELECT TARGET AS y, CAST(len(e) - 1 - (least(greatest(len(list_filter(e, lambda x: x < PRED_CHAMPION)), 1), len(e) - 1) - 1) AS INTEGER) AS decile FROM scored, de
  WHERE PRED_CHAMPION BETWEEN e[1] AND e[len(e)]),
dt AS (SELECT decile, COUNT(*) AS "count", CAST(SUM(y) AS BIGINT) AS bads FROM db GROUP BY decile),
deciles AS (SELECT decile, "count", bads, "count" - bads AS goods, bads / CAST("count" AS DOUBLE) AS bad_rate,
  CAST(SUM(bads) OVER (ORDER BY decile) AS BIGINT) AS cumul_bads, CAST(SUM(bads) OVER (ORDER BY decile) AS DOUBLE) / SUM(bads) OVER () AS cumul_bad_pct,
  (bads / CAST("count" AS DOUBLE)) / (CAST(SUM(bads) OVER () AS DOUBLE) / SUM("count") OVER ()) AS lift FROM dt)"""]


def _deciles(spark, sf_dir):
    return metrics.decile_table(roles.scored(spark, sf_dir), "PRED_CHAMPION", "TARGET")


@query(sql.with_(_DECILE, 'SELECT * REPLACE (round(lift, 9) AS lift) FROM deciles'))
def decile_table(spark, sf_dir):
    return rounded(_deciles(spark, sf_dir), lift=9)


@query(sql.with_(_DECILE, """SELECT decile, CAST(row_number() OVER (ORDER BY decile) * 10 AS INTEGER) AS population_pct, round(cumul_bad_pct * 100, 9) AS captured_pct,
  CAST(row_number() OVER (ORDER BY decile) * 10 AS DOUBLE) AS random_pct, round(lift, 9) AS lift, 1.0::DOUBLE AS random_lift FROM deciles"""))
def gains_lift(spark, sf_dir):
    return rounded(metrics.gains_lift(_deciles(spark, sf_dir)), captured_pct=9, lift=9)


_GRID = [sql.SCORED, """grid AS (SELECT CAST(i AS INTEGER) AS point, CASE WHEN i = 499 THEN 1.0::DOUBLE ELSE i * (1.0::DOUBLE / 499) END AS threshold FROM range(500) r(i)),
gc AS (SELECT point, threshold, CAST(COUNT(*) FILTER (WHERE TARGET = 0) AS DOUBLE) / (SELECT COUNT(*) FROM scored WHERE TARGET = 0) AS cdf_good,
  CAST(COUNT(*) FILTER (WHERE TARGET = 1) AS DOUBLE) / (SELECT COUNT(*) FROM scored WHERE TARGET = 1) AS cdf_bad
  FROM grid LEFT JOIN scored ON PRED_CHAMPION < threshold GROUP BY point, threshold)"""]


@query(sql.with_(_GRID, "SELECT point, threshold, cdf_good, cdf_bad, abs(cdf_bad - cdf_good) AS gap FROM gc"))
def cdf_grid(spark, sf_dir):
    return metrics.cdf_grid(roles.scored(spark, sf_dir), "PRED_CHAMPION", "TARGET")


@query(sql.with_(_GRID, "SELECT abs(cdf_bad - cdf_good) AS ks, threshold FROM gc ORDER BY ks DESC, point LIMIT 1"))
def cdf_grid_ks(spark, sf_dir):
    return metrics.cdf_grid_ks(roles.scored(spark, sf_dir), "PRED_CHAMPION", "TARGET")


_SEG_LONG = """seg AS (SELECT * FROM (SELECT model, y, s, 'CODE_GENDER' AS segment, CODE_GENDER AS segment_value FROM long UNION ALL
  SELECT model, y, s, 'AGE_BAND', AGE_BAND FROM long UNION ALL SELECT model, y, s, 'INCOME_BAND', INCOME_BAND FROM long) WHERE segment_value IS NOT NULL),
scnt AS (SELECT model, segment, segment_value, s, CAST(SUM(y) AS DOUBLE) AS pos, CAST(COUNT(*) - SUM(y) AS DOUBLE) AS neg FROM seg GROUP BY ALL),
srank AS (SELECT *, SUM(neg) OVER (PARTITION BY model, segment, segment_value ORDER BY s ROWS UNBOUNDED PRECEDING) - neg AS neg_before FROM scnt),
sauc AS (SELECT model, segment, segment_value, CAST(SUM(pos) + SUM(neg) AS BIGINT) AS n, SUM(pos) / (SUM(pos) + SUM(neg)) AS default_rate,
  round(SUM(pos * (neg_before + neg / 2)) / (SUM(pos) * SUM(neg)), 4) AS auc, round(2 * SUM(pos * (neg_before + neg / 2)) / (SUM(pos) * SUM(neg)) - 1, 4) AS gini
  FROM srank GROUP BY ALL HAVING SUM(pos) > 0 AND SUM(neg) > 0)"""
_SEG_CTES = [sql.SCORED_LONG, _SEG_LONG]


@query(sql.with_(_SEG_CTES, "SELECT * FROM sauc WHERE model = 'champion'"))
def segment_auc(spark, sf_dir):
    return metrics.segment_performance(roles.scored(spark, sf_dir), roles.SEGMENTS, {"champion": "PRED_CHAMPION"}, "TARGET")


@query(sql.with_([sql.SCORED], """SELECT t.t AS threshold, COUNT(*) FILTER (WHERE PRED_CHAMPION < t.t AND TARGET = 0) AS tn, COUNT(*) FILTER (WHERE PRED_CHAMPION >= t.t AND TARGET = 0) AS fp,
  COUNT(*) FILTER (WHERE PRED_CHAMPION < t.t AND TARGET = 1) AS fn, COUNT(*) FILTER (WHERE PRED_CHAMPION >= t.t AND TARGET = 1) AS tp,
  CAST(COUNT(*) FILTER (WHERE PRED_CHAMPION >= t.t AND TARGET = 1) AS DOUBLE) / COUNT(*) FILTER (WHERE TARGET = 1) AS sensitivity,
  CAST(COUNT(*) FILTER (WHERE PRED_CHAMPION < t.t AND TARGET = 0) AS DOUBLE) / COUNT(*) FILTER (WHERE TARGET = 0) AS specificity
FROM scored, (VALUES (0.3::DOUBLE), (0.4::DOUBLE), (0.5::DOUBLE), (0.6::DOUBLE), (0.7::DOUBLE)) t(t) GROUP BY t.t"""))
def confusion_thresholds(spark, sf_dir):
    return metrics.confusion_thresholds(roles.scored(spark, sf_dir), "PRED_CHAMPION", "TARGET")


_CAL = [sql.SCORED, f"""cb AS (SELECT CAST(greatest(len(list_filter({_TENTHS}::DOUBLE[], lambda x: x < PRED_CHAMPION)), 1) - 1 AS INTEGER) AS bin, PRED_CHAMPION AS s, TARGET AS y FROM scored),
cal AS (SELECT bin, COUNT(*) AS n, AVG(s) AS mean_predicted, AVG(y) AS observed_rate, SUM((s - y) * (s - y)) AS sq FROM cb GROUP BY bin)"""]


@query(sql.with_(_CAL, "SELECT bin, n, round(mean_predicted, 9) AS mean_predicted, observed_rate FROM cal"))
def calibration(spark, sf_dir):
    return rounded(metrics.calibration(roles.scored(spark, sf_dir), "PRED_CHAMPION", "TARGET"), mean_predicted=9)


@query(sql.with_(_CAL, "SELECT round(SUM(sq) / SUM(n), 9) AS brier, round(AVG(abs(observed_rate - mean_predicted)), 9) AS ece FROM cal"))
def brier_ece(spark, sf_dir):
    return rounded(metrics.brier_ece(roles.scored(spark, sf_dir), "PRED_CHAMPION", "TARGET"), brier=9, ece=9)


def _el_sql(group: str = "") -> str:
    key = f"{group}, " if group else ""
    tail = f" GROUP BY {group}" if group else ""
    loss = "PRED_CHAMPION * 0.45::DOUBLE * CAST(EAD AS DOUBLE)"
    return f"""SELECT {key}round(SUM({loss}), 2) AS total_expected_loss, round(SUM(CAST(EAD AS DOUBLE)), 2) AS total_exposure,
  round(AVG(PRED_CHAMPION), 4) AS mean_pd, 0.45::DOUBLE AS lgd_assumption, round(SUM({loss}) / SUM(CAST(EAD AS DOUBLE)), 6) AS el_rate,
  round(AVG({loss}), 2) AS mean_el_per_loan FROM scored{tail}"""


@query(sql.with_([sql.SCORED], _el_sql()))
def expected_loss(spark, sf_dir):
    return metrics.expected_loss(roles.scored(spark, sf_dir), "PRED_CHAMPION", "EAD")


@query(sql.with_([sql.SCORED], _el_sql("AGE_BAND")))
def expected_loss_by_segment(spark, sf_dir):
    return metrics.expected_loss(roles.scored(spark, sf_dir), "PRED_CHAMPION", "EAD", keys=["AGE_BAND"])


_COMPARE = """SELECT model, round(auc, 4) AS auc, round(2 * auc - 1, 4) AS gini, round(ks, 4) AS ks,
  CASE WHEN ks > 0.30 THEN 'PASS' ELSE 'REVIEW' END AS ks_verdict FROM disc"""


@query(sql.with_(_DISC_CTES, _COMPARE))
def model_compare(spark, sf_dir):
    return metrics.compare_models(roles.scored(spark, sf_dir), roles.SCORES, "TARGET")


@query(sql.with_(_DISC_CTES, f"SELECT * FROM ({_COMPARE}) ORDER BY auc DESC, model LIMIT 1"))
def best_model(spark, sf_dir):
    return metrics.best_model(metrics.compare_models(roles.scored(spark, sf_dir), roles.SCORES, "TARGET"))


@query(sql.with_([sql.SCORED], """, st AS (SELECT TARGET AS cls, COUNT(*) AS n, stddev_samp(PRED_CHAMPION) * pow(COUNT(*), -0.2::DOUBLE) AS h FROM scored GROUP BY 1),
k AS (SELECT TARGET AS cls, PRED_CHAMPION AS s, COUNT(*) AS k FROM scored GROUP BY 1, 2),
f AS (SELECT i AS point, k.cls, SUM(k.k * exp(-0.5::DOUBLE * pow((i / 999.0::DOUBLE - k.s) / st.h, 2))) / (ANY_VALUE(st.n) * ANY_VALUE(st.h) * sqrt(2 * pi())) AS f
  FROM range(1000) g(i), k JOIN st USING (cls) GROUP BY 1, 2),
m AS (SELECT point, MIN(f) AS v FROM f GROUP BY point)
SELECT 'champion' AS model, round(SUM(v * CASE WHEN point IN (0, 999) THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END) / 999, 6) AS overlap FROM m"""))
def score_overlap(spark, sf_dir):
    return rounded(metrics.score_overlap(roles.scored(spark, sf_dir), {"champion": "PRED_CHAMPION"}, "TARGET"), overlap=6)


@query("""WITH r AS (SELECT corr(l_quantity, l_extendedprice) AS ab, corr(l_quantity, l_tax) AS ac, corr(l_extendedprice, l_tax) AS bc FROM lineitem),
d AS (SELECT *, 1 + 2 * ab * ac * bc - ab * ab - ac * ac - bc * bc AS det FROM r)
SELECT 'l_quantity' AS feature, round((1 - bc * bc) / det, 2) AS vif FROM d UNION ALL
SELECT 'l_extendedprice', round((1 - ac * ac) / det, 2) FROM d UNION ALL SELECT 'l_tax', round((1 - ab * ab) / det, 2) FROM d""")
def vif(spark, sf_dir):
    return metrics.vif(roles.table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_tax"])


# -- monitoring -------------------------------------------------------------------------------------


def _psi_sql(long_cte: str = "long", keys: str = "feature") -> str:
    steps = " + ".join(f"CASE WHEN v >= lo + {i} * ((hi - lo) / 10) THEN 1 ELSE 0 END" for i in range(1, 10))
    return f"""span AS (SELECT {keys}, MIN(v) AS lo, MAX(v) AS hi FROM {long_cte} GROUP BY {keys}),
pb AS (SELECT {keys}, {steps} AS bin, side FROM {long_cte} JOIN span USING ({keys}) WHERE v IS NOT NULL),
pc AS (SELECT {keys}, bin, COUNT(*) FILTER (WHERE side = 0) AS e, COUNT(*) FILTER (WHERE side = 1) AS a FROM pb GROUP BY {keys}, bin),
ps AS (SELECT *, greatest(CAST(e AS DOUBLE) / SUM(e) OVER (PARTITION BY {keys}), 1e-4::DOUBLE) AS es, greatest(CAST(a AS DOUBLE) / SUM(a) OVER (PARTITION BY {keys}), 1e-4::DOUBLE) AS as_ FROM pc),
psi AS (SELECT {keys}, CAST(SUM(e) AS BIGINT) AS n_expected, CAST(SUM(a) AS BIGINT) AS n_actual, round(SUM((as_ - es) * ln(as_ / es)), 4) AS psi FROM ps GROUP BY {keys})"""


_PSI_STATUS = "CASE WHEN psi < 0.10 THEN 'Stable' WHEN psi < 0.25 THEN 'Monitor' ELSE 'ALERT: Model Review Required' END"
_PSI_CTES = [sql.EVENT_SIDES, _psi_sql()]


@query(sql.with_(_PSI_CTES, f"SELECT *, {_PSI_STATUS} AS status FROM psi WHERE feature = 'value'"))
def psi_score(spark, sf_dir):
    base, cur = roles.event_halves(spark, sf_dir)
    return monitoring.psi_score(base, cur, "value")


@query(sql.with_(_PSI_CTES, f"SELECT *, {_PSI_STATUS} AS status FROM psi WHERE n_expected >= 50 AND n_actual >= 50"))
def psi_features(spark, sf_dir):
    base, cur = roles.event_halves(spark, sf_dir)
    return monitoring.psi_features(base, cur)


@query(sql.with_(_PSI_CTES, f"""SELECT {_PSI_STATUS} AS status, COUNT(*) AS n_features, string_agg(feature, ',' ORDER BY feature) AS features
FROM psi WHERE n_expected >= 50 AND n_actual >= 50 GROUP BY 1"""))
def psi_report(spark, sf_dir):
    base, cur = roles.event_halves(spark, sf_dir)
    return monitoring.psi_report(monitoring.psi_features(base, cur))


_MODEL_SIDES = """mside AS (SELECT CASE WHEN l_shipdate < TIMESTAMP '1998-07-01 00:00:00' THEN 0 ELSE 1 END AS side,
  l_extendedprice / (l_extendedprice + 50000.0::DOUBLE) AS champion, l_quantity / (l_quantity + 25.0::DOUBLE) AS xgb, l_tax / (l_tax + 0.04::DOUBLE) AS lgb FROM lineitem),
long AS (SELECT side, 'champion' AS feature, champion AS v FROM mside UNION ALL SELECT side, 'xgb', xgb FROM mside UNION ALL SELECT side, 'lgb', lgb FROM mside)"""


@query(sql.with_([_MODEL_SIDES, _psi_sql()], f"SELECT *, {_PSI_STATUS} AS status FROM psi"))
def psi_models(spark, sf_dir):
    l = roles.table(spark, sf_dir, "lineitem")
    s = l.select(
        "l_shipdate", (F.col("l_extendedprice") / (F.col("l_extendedprice") + F.lit(50000.0))).alias("champion"),
        (F.col("l_quantity") / (F.col("l_quantity") + F.lit(25.0))).alias("xgb"), (F.col("l_tax") / (F.col("l_tax") + F.lit(0.04))).alias("lgb"),
    )
    cut = F.to_timestamp_ntz(F.lit("1998-07-01 00:00:00"))
    return monitoring.psi_features(s.where(F.col("l_shipdate") < cut), s.where(F.col("l_shipdate") >= cut), ["champion", "xgb", "lgb"])


_KS2 = """kc AS (SELECT feature, v, CAST(COUNT(*) FILTER (WHERE side = 0) AS DOUBLE) AS a, CAST(COUNT(*) FILTER (WHERE side = 1) AS DOUBLE) AS b FROM long WHERE v IS NOT NULL GROUP BY feature, v),
kr AS (SELECT *, SUM(a) OVER w / SUM(a) OVER (PARTITION BY feature) AS fa, SUM(b) OVER w / SUM(b) OVER (PARTITION BY feature) AS fb FROM kc
  WINDOW w AS (PARTITION BY feature ORDER BY v ROWS UNBOUNDED PRECEDING)),
ks2 AS (SELECT feature, MAX(abs(fa - fb)) AS ks, COUNT(*) FILTER (WHERE a > 0) AS distinct_base, COUNT(*) FILTER (WHERE b > 0) AS distinct_cur,
  CAST(SUM(a) AS BIGINT) AS n_0, CAST(SUM(b) AS BIGINT) AS n_1 FROM kr GROUP BY feature)"""


def _moments_sql() -> str:
    parts = []
    for tag, side in (("base", 0), ("cur", 1)):
        w = f"FILTER (WHERE side = {side})"
        parts.append(
            f"round(AVG(v) {w}, 9) AS mean_{tag}, round(stddev_samp(v) {w}, 9) AS std_{tag}, MIN(v) {w} AS min_{tag}, MAX(v) {w} AS max_{tag}, "
            f"CAST(COUNT(*) FILTER (WHERE side = {side} AND v IS NULL) AS DOUBLE) / COUNT(*) {w} AS missing_{tag}"
        )
    return ", ".join(parts)


@query(sql.with_([*_PSI_CTES, _KS2], f"""SELECT feature, m.* EXCLUDE (feature), ks, distinct_base, distinct_cur, psi, {_PSI_STATUS} AS status FROM (
  SELECT feature, {_moments_sql()}, round((AVG(v) FILTER (WHERE side = 1) - AVG(v) FILTER (WHERE side = 0)) / stddev_samp(v) FILTER (WHERE side = 0), 9) AS mean_shift
  FROM long GROUP BY feature) m JOIN ks2 USING (feature) JOIN psi USING (feature)"""))
def drift_table(spark, sf_dir):
    base, cur = roles.event_halves(spark, sf_dir)
    out = monitoring.drift_table(base, cur)
    return rounded(out, mean_base=9, mean_cur=9, std_base=9, std_cur=9, mean_shift=9)


_TRIGGER_SQL = f"""m AS (SELECT feature AS subject, 'feature_psi' AS metric, psi AS value FROM psi UNION ALL
  SELECT model, 'gini', round(2 * auc - 1, 4) FROM disc UNION ALL
  SELECT 'portfolio', 'default_rate_shift', round((SELECT AVG(TARGET) FROM scored) - 0.3::DOUBLE, 6))
SELECT subject, metric, value, CASE WHEN metric = 'gini' AND value < 0.40 THEN 2 ELSE 1 END AS severity,
  CASE metric WHEN 'gini' THEN CASE WHEN value < 0.40 THEN 0.40::DOUBLE ELSE 0.50::DOUBLE END WHEN 'feature_psi' THEN 0.25::DOUBLE ELSE 0.02::DOUBLE END AS bound,
  CASE metric WHEN 'gini' THEN CASE WHEN value < 0.40 THEN 'Retrain' ELSE 'Investigate' END WHEN 'feature_psi' THEN 'Feature review' ELSE 'Recalibrate' END AS action
FROM m WHERE (metric = 'gini' AND value < 0.50) OR (metric = 'feature_psi' AND value > 0.25) OR (metric = 'default_rate_shift' AND abs(value) > 0.02)"""


@query(sql.with_([sql.EVENT_SIDES.replace("long AS", "elong AS"), _psi_sql("elong"), *_DISC_CTES, _TRIGGER_SQL.split("\nSELECT subject")[0]],
                 "SELECT subject" + _TRIGGER_SQL.split("\nSELECT subject")[1]))
def monitor_triggers(spark, sf_dir):
    base, cur = roles.event_halves(spark, sf_dir)
    scored = roles.scored(spark, sf_dir)
    psi = monitoring.psi_features(base, cur, min_rows=1).select(
        F.col("feature").alias("subject"), F.lit("feature_psi").alias("metric"), F.col("psi").alias("value")
    )
    gini = metrics.compare_models(scored, roles.SCORES, "TARGET").select(
        F.col("model").alias("subject"), F.lit("gini").alias("metric"), F.col("gini").alias("value")
    )
    shift = scored.agg(F.round(F.avg("TARGET") - 0.3, 6).alias("value")).select(
        F.lit("portfolio").alias("subject"), F.lit("default_rate_shift").alias("metric"), "value"
    )
    return monitoring.monitor_triggers(psi.unionByName(gini).unionByName(shift))


# -- fairness and decision reports ------------------------------------------------------------------


@query(sql.with_(_SEG_CTES, "SELECT * FROM sauc WHERE n > 50"))
def fairness_auc(spark, sf_dir):
    return fairness.fairness_auc(roles.scored(spark, sf_dir), roles.SEGMENTS, roles.SCORES, "TARGET", min_n=50)


@query(sql.with_(_SEG_CTES, """SELECT *, CASE WHEN gap < 0.05 THEN 'Pass' WHEN gap < 0.08 THEN 'Caution' ELSE 'Fail' END AS status FROM (
  SELECT model, segment, MIN(auc) AS min_auc, MAX(auc) AS max_auc, round(MAX(auc) - MIN(auc), 4) AS gap FROM sauc GROUP BY model, segment)"""))
def parity_gap(spark, sf_dir):
    return fairness.parity_gap(fairness.fairness_auc(roles.scored(spark, sf_dir), roles.SEGMENTS, roles.SCORES, "TARGET"))


_ACCEPT = """acc AS (SELECT segment, segment_value, COUNT(*) AS n, CAST(COUNT(*) FILTER (WHERE s >= 0.5) AS DOUBLE) / COUNT(*) AS flagged_rate,
  CAST(COUNT(*) FILTER (WHERE s < 0.5) AS DOUBLE) / COUNT(*) AS accepted_rate FROM seg WHERE model = 'champion' GROUP BY 1, 2)"""


@query(sql.with_([*_SEG_CTES, _ACCEPT], "SELECT * FROM acc"))
def acceptance_rate(spark, sf_dir):
    return fairness.acceptance_rate(roles.scored(spark, sf_dir), roles.SEGMENTS, "PRED_CHAMPION")


@query(sql.with_([*_SEG_CTES, _ACCEPT], """SELECT segment, COUNT(*) AS groups, CASE WHEN COUNT(*) >= 2 THEN MIN(flagged_rate) / MAX(flagged_rate) END AS impact_ratio,
  CASE WHEN COUNT(*) >= 2 THEN CAST(MIN(flagged_rate) / MAX(flagged_rate) >= 0.8 AS INTEGER) END AS passes_80_rule FROM acc WHERE n > 50 GROUP BY segment"""))
def disparate_impact(spark, sf_dir):
    return fairness.disparate_impact(roles.scored(spark, sf_dir), roles.SEGMENTS, "PRED_CHAMPION")


def _prob_score_sql(p: str) -> str:
    return (
        f"CAST(trunc(least(greatest({_OFFSET!r}::DOUBLE + {_FACTOR!r}::DOUBLE * ln(greatest((1 - {p}) / greatest({p}, 1e-10::DOUBLE), 1e-10::DOUBLE)), 300), 850)) AS INTEGER)"
    )


_BANDS_SQL = "(VALUES (0, '300-450', 300, 450), (1, '450-550', 450, 550), (2, '550-620', 550, 620), (3, '620-680', 620, 680), (4, '680-750', 680, 750), (5, '750-850', 750, 850)) b(band_no, band, lo, hi)"


@query(sql.with_([sql.SCORED], f"""SELECT band_no, band, COUNT(cs) AS n, COUNT(*) FILTER (WHERE TARGET = 1) AS defaults, CAST(COUNT(*) FILTER (WHERE TARGET = 1) AS DOUBLE) / NULLIF(COUNT(cs), 0) AS default_rate
FROM {_BANDS_SQL} LEFT JOIN (SELECT TARGET, {_prob_score_sql('PRED_CHAMPION')} AS cs FROM scored) ON cs > lo AND cs <= hi GROUP BY band_no, band"""))
def score_band_rate(spark, sf_dir):
    s = roles.scored(spark, sf_dir).withColumn("cs", fs.prob_score(F.col("PRED_CHAMPION")))
    return fairness.score_band_rate(s, "cs", "TARGET")


# -- exploratory tables -----------------------------------------------------------------------------


@query(sql.with_([sql.APPLICATION], " UNION ALL ".join(
    f"SELECT '{c}' AS segment, {c} AS segment_value, COUNT(*) AS n, CAST(SUM(TARGET) AS BIGINT) AS defaults, AVG(TARGET) AS default_rate FROM application WHERE {c} IS NOT NULL GROUP BY {c}"
    for c in roles.APPLICANT_TEXT)))
def segment_default_rate(spark, sf_dir):
    return profile.segment_default_rate(roles.application(spark, sf_dir), roles.APPLICANT_TEXT, "TARGET")


_HB = """hb AS (SELECT TARGET, COALESCE(cnt, 0) AS cnt, COALESCE(overdue, 0) AS overdue FROM application LEFT JOIN (
  SELECT SK_ID_CURR, COUNT(*) AS cnt, SUM(AMT_CREDIT_SUM_OVERDUE) AS overdue FROM bureau GROUP BY 1) USING (SK_ID_CURR))"""


@query(sql.with_([sql.APPLICATION, sql.BUREAU, _HB], """SELECT 'history_count' AS profile, band, COUNT(TARGET) AS n, COUNT(*) FILTER (WHERE TARGET = 1) AS defaults,
  CAST(COUNT(*) FILTER (WHERE TARGET = 1) AS DOUBLE) / NULLIF(COUNT(TARGET), 0) AS default_rate
FROM (VALUES ('None', -1, 0), ('1-2', 0, 2), ('3-5', 2, 5), ('6-10', 5, 10), ('10+', 10, 100)) b(band, lo, hi) LEFT JOIN hb ON cnt > lo AND cnt <= hi GROUP BY band
UNION ALL SELECT 'overdue', CASE WHEN overdue > 0 THEN 'Has overdue' ELSE 'No overdue' END, COUNT(*), CAST(SUM(TARGET) AS BIGINT), AVG(TARGET) FROM hb GROUP BY 2"""))
def history_band_rate(spark, sf_dir):
    app, b = roles.application(spark, sf_dir), history.bureau_history(roles.bureau(spark, sf_dir))
    joined = app.join(b.select("SK_ID_CURR", "bureau_loan_count", "total_overdue_amount"), "SK_ID_CURR", "left")
    return profile.history_band_rate(joined, "bureau_loan_count", "total_overdue_amount", "TARGET")


_APP_COLS = [*roles.APPLICANT_NUMERIC, *roles.APPLICANT_TEXT]
_MISSING = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, COUNT(*) - COUNT({c}) AS missing, CAST(COUNT(*) - COUNT({c}) AS DOUBLE) / COUNT(*) AS missing_rate FROM application" for c in _APP_COLS
)


@query(sql.with_([sql.APPLICATION], f"SELECT *, CAST(missing_rate > 0.3 AS INTEGER) AS over_30, CAST(missing_rate > 0.5 AS INTEGER) AS over_50 FROM ({_MISSING}) WHERE missing > 0"))
def missing_rate(spark, sf_dir):
    return profile.missing_rate(roles.application(spark, sf_dir), _APP_COLS)


@query(sql.with_([sql.APPLICATION], f"SELECT COUNT(*) AS any_missing, COUNT(*) FILTER (WHERE missing_rate > 0.3) AS over_30, COUNT(*) FILTER (WHERE missing_rate > 0.5) AS over_50 FROM ({_MISSING}) WHERE missing > 0"))
def missing_summary(spark, sf_dir):
    return profile.missing_summary(roles.application(spark, sf_dir), _APP_COLS)


@query(sql.with_([sql.APPLICATION], f"SELECT feature, missing_rate FROM ({_MISSING}) WHERE missing > 0 ORDER BY missing_rate DESC, feature LIMIT 3"))
def top_missing(spark, sf_dir):
    return profile.top(profile.missing_rate(roles.application(spark, sf_dir), _APP_COLS), "missing_rate", 3).select("feature", "missing_rate")


@query(sql.with_([sql.APPLICATION], "SELECT SK_ID_CURR, TARGET, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in roles.APPLICANT_NUMERIC) + " FROM application"))
def numeric_only(spark, sf_dir):
    app = roles.application(spark, sf_dir).select("SK_ID_CURR", "TARGET", *roles.APPLICANT_NUMERIC, *roles.APPLICANT_TEXT)
    return features.numeric_only(app)


_KIND_COLS = [*roles.APPLICANT_NUMERIC, *roles.APPLICANT_TEXT]


@query(sql.with_([sql.APPLICATION], f"SELECT {len(_KIND_COLS) + 1} AS \"columns\", {len(roles.APPLICANT_NUMERIC)} AS numeric, 1 AS missing_flags, 0 AS target_encoded, 2 AS derived, "
                 + " + ".join(f"COUNT(*) - COUNT({c})" for c in _KIND_COLS) + " AS null_cells FROM application"))
def feature_kinds(spark, sf_dir):
    app = roles.application(spark, sf_dir).select(*_KIND_COLS)
    flagged = app.withColumn("MISS_EXT_SOURCE_1", F.col("EXT_SOURCE_1").isNull())
    return profile.feature_kinds(flagged, ["AMT_CREDIT", "DAYS_BIRTH", "absent"])


_BANDS = """aged AS (SELECT TARGET, CODE_GENDER, NAME_EDUCATION_TYPE, CAST(trunc(-DAYS_BIRTH / 365.25::DOUBLE) AS INTEGER) AS years, -DAYS_BIRTH / 365.25::DOUBLE AS age FROM application),
banded AS (SELECT *, CASE WHEN years > 18 AND years <= 30 THEN '18-30' WHEN years > 30 AND years <= 40 THEN '31-40' WHEN years > 40 AND years <= 50 THEN '41-50'
    WHEN years > 50 AND years <= 60 THEN '51-60' WHEN years > 60 AND years <= 100 THEN '60+' END AS REPORT_BAND,
  CASE WHEN age > 18 AND age <= 30 THEN '18-30' WHEN age > 30 AND age <= 45 THEN '31-45' WHEN age > 45 AND age <= 60 THEN '46-60' WHEN age > 60 AND age <= 100 THEN '60+' END AS AUDIT_BAND FROM aged)"""
_BAND_COLS = ["REPORT_BAND", "AUDIT_BAND", "CODE_GENDER", "NAME_EDUCATION_TYPE"]


@query(sql.with_([sql.APPLICATION, _BANDS], " UNION ALL ".join(
    f"SELECT '{c}' AS segment, {c} AS segment_value, COUNT(TARGET) AS n, COUNT(*) FILTER (WHERE TARGET = 1) AS defaults,"
    f" CAST(COUNT(*) FILTER (WHERE TARGET = 1) AS DOUBLE) / COUNT(TARGET) AS default_rate FROM banded WHERE {c} IS NOT NULL GROUP BY {c}" for c in _BAND_COLS)))
def age_report(spark, sf_dir):
    app = roles.application(spark, sf_dir).select("TARGET", "DAYS_BIRTH", "CODE_GENDER", "NAME_EDUCATION_TYPE")
    app = fairness.with_age_band(app, fairness.REPORT_AGES, whole_years=True, out="REPORT_BAND")
    app = fairness.with_age_band(app, fairness.AUDIT_AGES, out="AUDIT_BAND")
    return profile.segment_default_rate(app, _BAND_COLS, "TARGET")


_HOLES = ["AMT_GOODS_PRICE", "CNT_FAM_MEMBERS", "DAYS_LAST_PHONE_CHANGE", "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]


@query(sql.with_([sql.APPLICATION], " UNION ALL ".join(
    f"SELECT '{a}' AS left_feature, '{b}' AS right_feature, COUNT(*) FILTER (WHERE {a} IS NULL AND {b} IS NULL) AS both_missing FROM application"
    for i, a in enumerate(_HOLES) for b in _HOLES[i + 1:])))
def comissing_pairs(spark, sf_dir):
    return profile.comissing_pairs(roles.application(spark, sf_dir), _HOLES)


@query(sql.with_([sql.SCORED], """SELECT TARGET AS "class", COUNT(*) AS n, CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM scored) AS share,
  (SELECT CAST(COUNT(*) FILTER (WHERE TARGET = 0) AS DOUBLE) / COUNT(*) FILTER (WHERE TARGET = 1) FROM scored) AS imbalance FROM scored GROUP BY 1"""))
def class_balance(spark, sf_dir):
    return profile.class_balance(roles.scored(spark, sf_dir), "TARGET")


_CORR_TARGET = " UNION ALL ".join(f"SELECT '{c}' AS feature, corr(CAST({c} AS DOUBLE), CAST(TARGET AS DOUBLE)) AS corr FROM application" for c in roles.APPLICANT_NUMERIC)


@query(sql.with_([sql.APPLICATION], f"SELECT feature, round(corr, 9) AS corr, round(abs(corr), 9) AS abs_corr FROM ({_CORR_TARGET})"))
def corr_target(spark, sf_dir):
    return rounded(profile.corr_target(roles.application(spark, sf_dir), roles.APPLICANT_NUMERIC, "TARGET"), corr=9, abs_corr=9)


@query(sql.with_([sql.APPLICATION], f"SELECT feature, round(corr, 9) AS corr, round(abs(corr), 9) AS abs_corr FROM ({_CORR_TARGET}) WHERE corr IS NOT NULL ORDER BY abs(corr) DESC, feature LIMIT 5"))
def top_corr(spark, sf_dir):
    return rounded(profile.top_corr(roles.application(spark, sf_dir), roles.APPLICANT_NUMERIC, "TARGET", 5), corr=9, abs_corr=9)


_CORR_PAIRS = " UNION ALL ".join(
    f"SELECT '{a}' AS left_feature, '{b}' AS right_feature, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS corr FROM application"
    for i, a in enumerate(roles.APPLICANT_NUMERIC) for b in roles.APPLICANT_NUMERIC[i + 1:])


@query(sql.with_([sql.APPLICATION], f"SELECT left_feature, right_feature, round(corr, 9) AS corr FROM ({_CORR_PAIRS})"))
def corr_pairs(spark, sf_dir):
    return rounded(profile.corr_pairs(roles.application(spark, sf_dir), roles.APPLICANT_NUMERIC), corr=9)


@query(sql.with_([sql.APPLICATION], f"SELECT left_feature, right_feature, round(corr, 9) AS corr FROM ({_CORR_PAIRS}) WHERE abs(corr) > 0.7"))
def corr_high_pairs(spark, sf_dir):
    return rounded(profile.corr_pairs(roles.application(spark, sf_dir), roles.APPLICANT_NUMERIC, 0.7), corr=9)


_HIST_STEPS = " + ".join(f"CASE WHEN v >= lo + {i} * ((hi - lo) / 50) THEN 1 ELSE 0 END" for i in range(1, 50))


@query(sql.with_([_ACCOUNTS, f"""long AS (UNPIVOT accounts ON price, quantity, discount INTO NAME feature VALUE v),
span AS (SELECT feature, y, MIN(v) AS lo, MAX(v) AS hi, COUNT(*) AS total FROM long GROUP BY feature, y),
hb AS (SELECT feature, y AS cls, {_HIST_STEPS} AS bin, lo, hi, total FROM long JOIN span USING (feature, y))"""],
    """SELECT feature, cls, bin, COUNT(*) AS n, lo + bin * ((hi - lo) / 50) AS left_edge, COUNT(*) / (total * ((hi - lo) / 50)) AS density FROM hb GROUP BY feature, cls, bin, lo, hi, total"""))
def hist_by_class(spark, sf_dir):
    return profile.hist_by_class(roles.accounts(spark, sf_dir), ["price", "quantity", "discount"], "TARGET")


@query(sql.with_([_ACCOUNTS, "long AS (SELECT feature, v, y AS side FROM (UNPIVOT accounts ON price, quantity, discount, tax INTO NAME feature VALUE v))", _KS2],
                 "SELECT feature, n_0, n_1, ks FROM ks2"))
def ks_two_sample(spark, sf_dir):
    return profile.ks_two_sample(roles.accounts(spark, sf_dir), roles.ACCOUNT_FEATURES, "TARGET")


_DESC_LONG = "long AS (UNPIVOT (SELECT price, quantity, discount, tax FROM accounts) ON price, quantity, discount, tax INTO NAME feature VALUE v)"


@query(sql.with_([_ACCOUNTS, _DESC_LONG], """SELECT feature, COUNT(*) AS "count", round(AVG(v), 9) AS mean, round(stddev_samp(v), 9) AS std, MIN(v) AS min,
  round(quantile_cont(v, 0.25), 9) AS q25, round(quantile_cont(v, 0.5), 9) AS q50, round(quantile_cont(v, 0.75), 9) AS q75, MAX(v) AS max,
  CAST((SELECT COUNT(*) FROM accounts) - COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM accounts) AS missing_pct FROM long GROUP BY feature"""))
def describe(spark, sf_dir):
    acc = roles.accounts(spark, sf_dir)
    return rounded(profile.describe(acc, roles.ACCOUNT_FEATURES), mean=9, std=9, q25=9, q50=9, q75=9)


@query(sql.with_([_ACCOUNTS], """SELECT 'discount' AS feature, round(AVG(discount), 9) AS mean, round(quantile_cont(discount, 0.5), 9) AS median, round(stddev_samp(discount), 9) AS std,
  MIN(discount) AS min, MAX(discount) AS max, CAST(COUNT(*) - COUNT(discount) AS DOUBLE) / COUNT(*) AS missing, round(corr(discount, y), 9) AS target_corr FROM accounts"""))
def column_profile(spark, sf_dir):
    out = profile.column_profile(roles.accounts(spark, sf_dir), "discount", "TARGET")
    return rounded(out, mean=9, median=9, std=9, target_corr=9)


@query(sql.with_([_ACCOUNTS], """, q AS (SELECT y AS cls, round(quantile_cont(price, 0.25), 9) AS q1, round(quantile_cont(price, 0.5), 9) AS q2, round(quantile_cont(price, 0.75), 9) AS q3 FROM accounts GROUP BY y)
SELECT cls, q1, q2, q3, COUNT(*) AS n, MIN(price) FILTER (WHERE price >= q1 - (q3 - q1) * 1.5 AND price <= q3 + (q3 - q1) * 1.5) AS whisker_lo,
  MAX(price) FILTER (WHERE price >= q1 - (q3 - q1) * 1.5 AND price <= q3 + (q3 - q1) * 1.5) AS whisker_hi,
  COUNT(*) FILTER (WHERE NOT (price >= q1 - (q3 - q1) * 1.5 AND price <= q3 + (q3 - q1) * 1.5)) AS outliers
FROM accounts JOIN q ON cls = y GROUP BY cls, q1, q2, q3"""))
def box_stats(spark, sf_dir):
    return rounded(profile.box_stats(roles.accounts(spark, sf_dir), "price", "TARGET"), q1=9, q2=9, q3=9)


@query(sql.with_([_ACCOUNTS], """SELECT COUNT(*) AS "rows", 6 AS features, AVG(y) AS default_rate,
  CAST(COUNT(discount) < COUNT(*) AS INTEGER) + CAST(COUNT(line) < COUNT(*) AS INTEGER) AS columns_with_missing FROM accounts"""))
def header(spark, sf_dir):
    return profile.header(roles.accounts(spark, sf_dir), "TARGET")


# -- scoring ----------------------------------------------------------------------------------------

_REQ = f"""SELECT o_orderkey AS request_id, CAST(CAST(floor(-({sql._DAY}) / 25.0) AS INTEGER) AS VARCHAR) AS age,
  CAST(CAST(CASE WHEN o_totalprice > 20000 THEN o_totalprice - 20000 ELSE -o_totalprice END AS DECIMAL(12,2)) AS VARCHAR) AS income,
  CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS loan_amount,
  CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN CAST(CAST(CAST(o_totalprice AS DECIMAL(8,2)) * CAST(0.0625 AS DECIMAL(5,4)) AS DECIMAL(12,2)) AS VARCHAR) WHEN {sql._DAY} > -1000 THEN 'unknown' END AS annuity,
  CASE WHEN o_orderstatus <> 'O' THEN CAST(CAST(CAST(o_totalprice AS DECIMAL(8,2)) * CAST(0.75 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS VARCHAR) END AS goods_price,
  CASE o_orderstatus WHEN 'O' THEN 'Higher education' WHEN 'F' THEN 'Lower secondary' END AS education_type,
  CASE WHEN o_orderstatus = 'P' THEN CAST(CAST(CAST(o_totalprice AS DECIMAL(8,2)) * CAST(0.0000025 AS DECIMAL(8,7)) AS DECIMAL(8,4)) AS VARCHAR) END AS ext_source_2,
  CAST(CAST(floor(-({sql._DAY}) / 500.0) AS INTEGER) AS VARCHAR) AS bureau_loan_count,
  CAST(CAST(floor(-({sql._DAY}) / 900.0) AS INTEGER) AS VARCHAR) AS active_credits, CAST(CAST(CAST(o_totalprice AS DECIMAL(8,2)) * CAST(0.125 AS DECIMAL(4,3)) AS DECIMAL(12,2)) AS VARCHAR) AS total_debt FROM orders"""
ORACLES["coerce_numeric"] = ORACLES["coerce_numeric"].replace("{REQUESTS}", _REQ)

_VALID = f"""req AS ({_REQ}), typed AS (SELECT request_id, TRY_CAST(age AS INTEGER) AS age, TRY_CAST(income AS DOUBLE) AS income, TRY_CAST(loan_amount AS DOUBLE) AS loan_amount,
  TRY_CAST(annuity AS DOUBLE) AS annuity, annuity AS raw_annuity, COALESCE(TRY_CAST(goods_price AS DOUBLE), 0) AS goods_price, COALESCE(education_type, 'Secondary') AS education_type,
  TRY_CAST(ext_source_2 AS DOUBLE) AS ext_source_2, CAST(bureau_loan_count AS INTEGER) AS bureau_loan_count, CAST(active_credits AS INTEGER) AS active_credits,
  CAST(total_debt AS DOUBLE) AS total_debt FROM req),
checked AS (SELECT *, array_to_string(list_filter([CASE WHEN age < 18 THEN 'age: too small' END, CASE WHEN age > 100 THEN 'age: too large' END,
  CASE WHEN income <= 0 THEN 'income: too small' END, CASE WHEN raw_annuity IS NULL THEN 'annuity: missing' END,
  CASE WHEN raw_annuity IS NOT NULL AND annuity IS NULL THEN 'annuity: not double' END, CASE WHEN ext_source_2 > 1 THEN 'ext_source_2: too large' END], lambda x: x IS NOT NULL), ';') AS violations FROM typed),
good AS (SELECT * FROM checked WHERE violations = '')"""


def _validated(spark, sf_dir):
    return scoring.validate(roles.requests(spark, sf_dir), keep=["request_id"])


@query(sql.with_([_VALID], "SELECT request_id, age, income, loan_amount, annuity, goods_price, education_type, ext_source_2, violations FROM checked"))
def validate_applicants(spark, sf_dir):
    return _validated(spark, sf_dir).select(
        "request_id", "age", "income", "loan_amount", "annuity", "goods_price", "education_type", "ext_source_2",
        F.array_join("violations", ";").alias("violations"),
    )


@query(sql.with_([_VALID], """SELECT v AS violation, COUNT(*) AS n FROM (SELECT unnest(string_split(violations, ';')) AS v FROM checked WHERE violations <> '') GROUP BY v"""))
def rejected_reasons(spark, sf_dir):
    _, bad = scoring.split_valid(_validated(spark, sf_dir))
    return bad.select(F.explode("violations").alias("violation")).groupBy("violation").agg(F.count(F.lit(1)).alias("n"))


_FEAT = """feat AS (SELECT request_id, CAST(age AS DOUBLE) AS AGE_YEARS, income AS AMT_INCOME_TOTAL, loan_amount AS AMT_CREDIT, annuity AS AMT_ANNUITY, goods_price AS AMT_GOODS_PRICE,
  loan_amount / (income + 1) AS LOAN_INCOME_RATIO, annuity / (income + 1) AS ANNUITY_INCOME_RATIO, loan_amount / (goods_price + 1) AS CREDIT_GOODS_RATIO,
  annuity / (loan_amount + 1) AS CREDIT_TERM, goods_price / (income + 1) AS GOODS_INCOME_RATIO, -abs(CAST(age AS DOUBLE)) * 365.25::DOUBLE AS DAYS_BIRTH,
  0.5::DOUBLE AS EXT_SOURCE_1, COALESCE(ext_source_2, 0.5::DOUBLE) AS EXT_SOURCE_2, 0.5::DOUBLE AS EXT_SOURCE_3,
  0.5::DOUBLE * COALESCE(ext_source_2, 0.5::DOUBLE) AS EXT_SRC_1x2, COALESCE(ext_source_2, 0.5::DOUBLE) * age AS EXT_SRC2_x_AGE,
  (loan_amount - goods_price) / (goods_price + 1) AS CREDIT_OVERCHARGE, CAST(bureau_loan_count AS DOUBLE) AS bureau_loan_count,
  CAST(active_credits AS DOUBLE) AS active_credits, total_debt, education_type,
  greatest(COALESCE(ext_source_2, 0.5::DOUBLE), 0.5::DOUBLE) - least(COALESCE(ext_source_2, 0.5::DOUBLE), 0.5::DOUBLE) AS EXT_SOURCE_RANGE FROM good)"""
_FEAT_COLS = [
    "AGE_YEARS", "AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE", "LOAN_INCOME_RATIO", "ANNUITY_INCOME_RATIO",
    "CREDIT_GOODS_RATIO", "CREDIT_TERM", "GOODS_INCOME_RATIO", "DAYS_BIRTH", "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "EXT_SRC_1x2",
    "EXT_SRC2_x_AGE", "CREDIT_OVERCHARGE", "EXT_SOURCE_RANGE", "bureau_loan_count", "active_credits", "total_debt",
]


def _request_frame(spark, sf_dir, profile_name="service"):
    good, _ = scoring.split_valid(_validated(spark, sf_dir))
    return scoring.request_features(good, keep=["request_id"], profile=profile_name)


@query(sql.with_([_VALID, _FEAT], "SELECT request_id, " + ", ".join(_FEAT_COLS) + " FROM feat"))
def applicant_features(spark, sf_dir):
    return _request_frame(spark, sf_dir).select("request_id", *_FEAT_COLS)


@query(sql.with_([_VALID, _FEAT], """SELECT request_id, greatest(20.0::DOUBLE, active_credits * 5) AS active_contracts, total_debt / greatest(bureau_loan_count, 1) AS avg_debt,
  total_debt / greatest(AMT_CREDIT, 1) AS debt_to_credit_ratio, greatest(1.0::DOUBLE, floor(bureau_loan_count / 3)) AS bureau_loans_last_12m,
  CASE WHEN bureau_loan_count > 0 THEN AMT_ANNUITY * 0.25::DOUBLE ELSE 0 END AS avg_bureau_annuity, CASE WHEN bureau_loan_count > 0 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS MISS_bureau_loan_count,
  CASE education_type WHEN 'Higher education' THEN 0.0536::DOUBLE WHEN 'Lower secondary' THEN 0.1092::DOUBLE ELSE 0.0894::DOUBLE END AS TE_NAME_EDUCATION_TYPE,
  0.0756::DOUBLE AS TE_NAME_FAMILY_STATUS, EXT_SOURCE_2 * EXT_SOURCE_2 * EXT_SOURCE_2 AS EXT_SRC2_CB, 0.23::DOUBLE AS avg_utilisation_ratio FROM feat"""))
def form_features(spark, sf_dir):
    return _request_frame(spark, sf_dir, "form").select(
        "request_id", "active_contracts", "avg_debt", "debt_to_credit_ratio", "bureau_loans_last_12m", "avg_bureau_annuity",
        "MISS_bureau_loan_count", "TE_NAME_EDUCATION_TYPE", "TE_NAME_FAMILY_STATUS", "EXT_SRC2_CB", "avg_utilisation_ratio",
    )


@query(sql.with_([sql.SCORED], f"""SELECT CAST(round_even({_OFFSET!r}::DOUBLE + {_FACTOR!r}::DOUBLE * ln(PRED_CHAMPION / (1 - PRED_CHAMPION + 1e-10::DOUBLE)), 0) AS INTEGER) AS credit_score, COUNT(*) AS n FROM scored GROUP BY 1"""))
def score_logodds(spark, sf_dir):
    s = fs.logodds_score(fs.logit(F.col("PRED_CHAMPION")))
    return roles.scored(spark, sf_dir).groupBy(s.alias("credit_score")).agg(F.count(F.lit(1)).alias("n"))


@query(sql.with_([sql.SCORED], f"SELECT {_prob_score_sql('PRED_CHAMPION')} AS credit_score, COUNT(*) AS n FROM scored GROUP BY 1"))
def score_prob(spark, sf_dir):
    return roles.scored(spark, sf_dir).groupBy(fs.prob_score(F.col("PRED_CHAMPION")).alias("credit_score")).agg(F.count(F.lit(1)).alias("n"))


@query(sql.with_([sql.SCORED], """SELECT CASE WHEN p < 0.05 THEN 'Low' WHEN p < 0.15 THEN 'Medium' ELSE 'High' END AS risk_tier,
  CASE WHEN p <= 0.05 THEN 'Low' WHEN p <= 0.15 THEN 'Medium' ELSE 'High' END AS batch_tier,
  CASE WHEN p < 0.2 THEN 'Low Risk' WHEN p < 0.4 THEN 'Low-Medium Risk' WHEN p < 0.6 THEN 'Medium Risk' WHEN p < 0.8 THEN 'Medium-High Risk' ELSE 'High Risk' END AS tier5,
  CASE WHEN p < 0.4 THEN 'Approve' WHEN p < 0.8 THEN 'Review' ELSE 'Decline' END AS decision5,
  CASE WHEN p < 0.05 THEN 'Approve' WHEN p < 0.15 THEN 'Review' ELSE 'Decline' END AS recommendation, COUNT(*) AS n
FROM (SELECT PRED_LGB AS p FROM scored) GROUP BY ALL"""))
def risk_tier(spark, sf_dir):
    p = F.col("PRED_LGB")
    tier = fs.risk_tier(p)
    return roles.scored(spark, sf_dir).groupBy(
        tier.alias("risk_tier"), fs.risk_tier(p, right_closed=True).alias("batch_tier"), fs.risk_tier5(p).alias("tier5"),
        fs.decision5(p).alias("decision5"), fs.recommendation(tier).alias("recommendation"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query(sql.with_([_VALID], """SELECT request_id, loan_amount / greatest(income, 1) AS loan_to_income, CASE WHEN loan_amount / greatest(income, 1) > 5 THEN 'High' ELSE 'OK' END AS loan_to_income_flag,
  annuity / greatest(income, 1) AS annuity_to_income, CASE WHEN annuity / greatest(income, 1) > 0.4 THEN 'High' ELSE 'OK' END AS annuity_to_income_flag,
  loan_amount / greatest(goods_price, 1) AS credit_to_goods, CASE WHEN loan_amount / greatest(goods_price, 1) > 1.2 THEN 'Over-financed' ELSE 'OK' END AS credit_to_goods_flag FROM good"""))
def affordability_flags(spark, sf_dir):
    good, _ = scoring.split_valid(_validated(spark, sf_dir))
    flags = fs.affordability_flags(F.col("loan_amount"), F.col("income"), F.col("annuity"), F.col("goods_price"))
    return good.select("request_id", *[v.alias(k) for k, v in flags.items()])


# A hand-set linear model, so that its SQL can be written down.
LINEAR = {"AGE_YEARS": -0.02, "LOAN_INCOME_RATIO": 0.4, "ANNUITY_INCOME_RATIO": 1.5, "EXT_SOURCE_2": -2.0, "CREDIT_OVERCHARGE": 0.05}
LINEAR_INTERCEPT = -1.2
LINEAR_MEANS = {"AGE_YEARS": 50.0, "LOAN_INCOME_RATIO": 1.1, "ANNUITY_INCOME_RATIO": 0.07, "EXT_SOURCE_2": 0.5, "CREDIT_OVERCHARGE": 0.3}
_LOGIT = f"{LINEAR_INTERCEPT!r}::DOUBLE" + "".join(f" + ({v!r})::DOUBLE * {k}" for k, v in LINEAR.items())
_BATCH = f"""pr AS (SELECT *, 1 / (1 + exp(-({_LOGIT}))) AS p FROM feat), sc AS (SELECT request_id, p, round(p, 4) AS default_probability, {_prob_score_sql('p')} AS credit_score,
  CASE WHEN p < 0.05 THEN 'Low' WHEN p < 0.15 THEN 'Medium' ELSE 'High' END AS risk_tier, CASE WHEN p < 0.05 THEN 'Approve' WHEN p < 0.15 THEN 'Review' ELSE 'Decline' END AS recommendation FROM pr)"""
_BATCH_CTES = [_VALID, _FEAT, _BATCH]


def _batch(spark, sf_dir):
    frame = _request_frame(spark, sf_dir)
    return scoring.decide(frame.withColumn("p", scoring.linear_probability(LINEAR, LINEAR_INTERCEPT)), "p")


@query(sql.with_(_BATCH_CTES, "SELECT request_id, default_probability, credit_score, risk_tier, recommendation FROM sc"))
def batch_score(spark, sf_dir):
    return _batch(spark, sf_dir).select("request_id", "default_probability", "credit_score", "risk_tier", "recommendation")


@query(sql.with_(_BATCH_CTES, """SELECT COUNT(*) AS applications, round(AVG(credit_score), 6) AS avg_score, round(AVG(default_probability), 9) AS avg_pd,
  CAST(COUNT(*) FILTER (WHERE recommendation = 'Decline') AS DOUBLE) / COUNT(*) AS decline_rate FROM sc"""))
def batch_summary(spark, sf_dir):
    return rounded(scoring.batch_summary(_batch(spark, sf_dir)), avg_score=6, avg_pd=9)


_CONTRIB = ", ".join(f"{{'o': -abs(({c!r})::DOUBLE * ({k} - {LINEAR_MEANS[k]!r}::DOUBLE)), 'feature': '{k}', 'v': ({c!r})::DOUBLE * ({k} - {LINEAR_MEANS[k]!r}::DOUBLE)}}" for k, c in LINEAR.items())


@query(sql.with_([_VALID, _FEAT], f"""SELECT request_id, CAST(i AS INTEGER) AS rank, t[i].feature AS feature, round(t[i].v, 4) AS value, CASE WHEN t[i].v > 0 THEN 'increases risk' ELSE 'decreases risk' END AS direction
FROM (SELECT request_id, list_sort([{_CONTRIB}]) AS t FROM feat), range(1, 4) r(i)"""))
def reason_codes(spark, sf_dir):
    codes = scoring.reason_codes(LINEAR, LINEAR_MEANS, 3)
    frame = _request_frame(spark, sf_dir)
    return frame.select("request_id", F.posexplode(codes).alias("pos", "r")).select(
        "request_id", (F.col("pos") + 1).alias("rank"), "r.feature", "r.value", "r.direction"
    )


@query(sql.with_(_BATCH_CTES, "SELECT request_id, default_probability FROM sc WHERE p > 0.3"))
def high_risk(spark, sf_dir):
    return scoring.high_risk(_batch(spark, sf_dir), "p").select("request_id", "default_probability")


@query(sql.with_(_BATCH_CTES, "SELECT request_id, default_probability FROM sc ORDER BY (p > 0.3) DESC, request_id LIMIT 1"))
def first_high_risk(spark, sf_dir):
    rows = _batch(spark, sf_dir).select("request_id", "p", "default_probability")
    return scoring.first_high_risk(rows, "p", "request_id").drop("p")


_TIER_STEPS = " + ".join(f"CASE WHEN credit_score >= 300 + {i} * (550.0::DOUBLE / 30) THEN 1 ELSE 0 END" for i in range(1, 30))


@query(sql.with_(_BATCH_CTES, f"SELECT risk_tier, {_TIER_STEPS} AS bin, COUNT(*) AS n FROM sc GROUP BY 1, 2"))
def tier_mix(spark, sf_dir):
    return scoring.tier_mix(_batch(spark, sf_dir))


# -- splits -----------------------------------------------------------------------------------------

_MD5 = "md5(concat(CAST(SK_ID_CURR AS VARCHAR), ':42'))"


@query(sql.with_([sql.APPLICATION], f"""SELECT SK_ID_CURR, TARGET, CASE WHEN row_number() OVER (PARTITION BY TARGET ORDER BY {_MD5}, SK_ID_CURR) - 1
  < round(COUNT(*) OVER (PARTITION BY TARGET) * 0.2::DOUBLE) THEN 1 ELSE 0 END AS is_test FROM application"""))
def stratified_split(spark, sf_dir):
    app = roles.application(spark, sf_dir).select("SK_ID_CURR", "TARGET")
    return splits.stratified_split(app, "SK_ID_CURR", "TARGET")


@query(sql.with_([sql.APPLICATION, _FOLDS_SQL], "SELECT SK_ID_CURR, TARGET, fold FROM folded"))
def stratified_folds(spark, sf_dir):
    app = roles.application(spark, sf_dir).select("SK_ID_CURR", "TARGET")
    return splits.stratified_folds(app, "SK_ID_CURR", "TARGET")


@query(sql.with_([sql.APPLICATION], f"""SELECT SK_ID_CURR, TARGET FROM (SELECT SK_ID_CURR, TARGET, row_number() OVER (PARTITION BY TARGET ORDER BY {_MD5}, SK_ID_CURR) - 1 AS r,
  COUNT(*) OVER (PARTITION BY TARGET) AS c, COUNT(*) OVER () AS total FROM application) WHERE r < round(c * least(1.0::DOUBLE, 500 / CAST(total AS DOUBLE)))"""))
def stratified_sample(spark, sf_dir):
    app = roles.application(spark, sf_dir).select("SK_ID_CURR", "TARGET")
    return splits.stratified_sample(app, "SK_ID_CURR", "TARGET", 500)


@query("SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY o_orderkey) - 1 >= floor(COUNT(*) OVER () * 0.8::DOUBLE) THEN 1 ELSE 0 END AS is_test FROM orders")
def ordered_split(spark, sf_dir):
    return splits.ordered_split(roles.table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")


@query("""SELECT o_orderkey, CASE WHEN CAST('0x' || substr(md5(concat(CAST(o_orderkey AS VARCHAR), ':42')), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE < 0.2 THEN 1 ELSE 0 END AS shadow FROM orders""")
def shadow_split(spark, sf_dir):
    orders = roles.table(spark, sf_dir, "orders").select("o_orderkey")
    return splits.hash_split(orders, "o_orderkey", 0.2, out="shadow")


@query(sql.with_([sql.APPLICATION], """SELECT SK_ID_CURR, TARGET, CASE WHEN TARGET = 1 THEN (SELECT COUNT(*) / (2.0::DOUBLE * COUNT(*) FILTER (WHERE TARGET = 1)) FROM application)
  ELSE (SELECT COUNT(*) / (2.0::DOUBLE * COUNT(*) FILTER (WHERE TARGET = 0)) FROM application) END AS balanced,
  CASE WHEN TARGET = 1 THEN (SELECT CAST(COUNT(*) FILTER (WHERE TARGET = 0) AS DOUBLE) / COUNT(*) FILTER (WHERE TARGET = 1) FROM application) ELSE 1.0::DOUBLE END AS positive FROM application"""))
def class_weights(spark, sf_dir):
    app = roles.application(spark, sf_dir).select("SK_ID_CURR", "TARGET")
    return splits.positive_weight(splits.balanced_weight(app, "TARGET", "balanced"), "TARGET", "positive")


# -- models -----------------------------------------------------------------------------------------
# The outcome of the test tables is independent of every feature, so the IV floor is lifted here.

_MODEL_FEATURES = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "DAYS_BIRTH", "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]


def _training(spark, sf_dir):
    app = roles.application(spark, sf_dir).select("SK_ID_CURR", "TARGET", *_MODEL_FEATURES)
    return reliable(splits.stratified_folds(app, "SK_ID_CURR", "TARGET"))


def _scorecard(spark, sf_dir, df=None, c_grid=models.C_GRID):
    df = _training(spark, sf_dir) if df is None else df
    return models.train_scorecard(df, _MODEL_FEATURES, "TARGET", "SK_ID_CURR", c_grid=c_grid, iv_floor=0.0)


@query()
def scorecard_cv(spark, sf_dir):
    return _scorecard(spark, sf_dir).cv


@query()
def scorecard_fit(spark, sf_dir):
    card = _scorecard(spark, sf_dir)
    return woe.scorecard_points(card.woe.table, card.coefficients, card.intercept)


@query()
def gbt_cv(spark, sf_dir):
    df = _training(spark, sf_dir)
    oof = models.out_of_fold(df, {"boosted": models.boosted()}, _MODEL_FEATURES, "TARGET", "SK_ID_CURR")
    return models.fold_metrics(oof, "TARGET")


@query()
def grid_search(spark, sf_dir):
    df = _training(spark, sf_dir)
    return models.grid_search(df, _MODEL_FEATURES, "TARGET", "SK_ID_CURR")


def _bases():
    return {"boosted": models.boosted(), "forest": models.forest()}


@query()
def stacking(spark, sf_dir):
    return models.train_stacking(_training(spark, sf_dir), _bases(), _MODEL_FEATURES, "TARGET", "SK_ID_CURR").cv


def _holdout(spark, sf_dir):
    """Models fitted without the last fold, judged on it."""
    df = _training(spark, sf_dir)
    train, test = df.where(F.col("fold") < 4), df.where(F.col("fold") == 4)
    card = _scorecard(spark, sf_dir, train)
    tree = models.fit_tree(train, models.boosted(), _MODEL_FEATURES, "TARGET", "SK_ID_CURR")
    scored = tree.predict(card.predict(test, "p_scorecard"), "p_boosted")
    return card, metrics.compare_models(scored, {"scorecard": "p_scorecard", "boosted": "p_boosted"}, "TARGET")


@query()
def holdout_metrics(spark, sf_dir):
    return _holdout(spark, sf_dir)[1]


@query()
def overfit_gap(spark, sf_dir):
    card, holdout = _holdout(spark, sf_dir)
    return metrics.overfit_gap(card.cv, holdout)


# -- streaming --------------------------------------------------------------------------------------


def _stream(spark, sf_dir, name):
    """One table as a file stream."""
    schema = roles.table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


@query(ORACLES["batch_score"])
def stream_score(spark, sf_dir):
    predict = lambda df: df.withColumn("p", scoring.linear_probability(LINEAR, LINEAR_INTERCEPT))
    requests = roles.requests_of(_stream(spark, sf_dir, "orders"))
    scored = stream_score_ops.score_requests(requests, predict, "p", ["request_id"]).select(
        "request_id", "default_probability", "credit_score", "risk_tier", "recommendation"
    )
    out = fresh_checkpoint_path(spark, "stream-score")
    stream_score_ops.start_file_sink(scored, f"{out}/rows", f"{out}/state").awaitTermination()
    return spark.read.schema(scored.schema).parquet(f"{out}/rows")


@query(ORACLES["rejected_reasons"])
def stream_rejected(spark, sf_dir):
    requests = roles.requests_of(_stream(spark, sf_dir, "orders"))
    bad = stream_score_ops.rejected_requests(requests, ["request_id"]).select("request_id", "violations")
    out = fresh_checkpoint_path(spark, "stream-rejected")
    stream_score_ops.start_file_sink(bad, f"{out}/rows", f"{out}/state").awaitTermination()
    rows = spark.read.schema(bad.schema).parquet(f"{out}/rows")
    return rows.select(F.explode("violations").alias("violation")).groupBy("violation").agg(F.count(F.lit(1)).alias("n"))


_WEEKS = """edges AS (SELECT MIN(value) AS lo, MAX(value) AS hi FROM events),
binned AS (SELECT CAST(floor(epoch(ts) / 604800) AS BIGINT) AS week, STEPS AS bin FROM events, edges),
base AS (SELECT bin, COUNT(*) AS e FROM binned GROUP BY bin),
cells AS (SELECT w.week, b.bin, b.e, COUNT(x.bin) AS a FROM (SELECT DISTINCT week FROM binned) w CROSS JOIN base b
  LEFT JOIN binned x ON x.week = w.week AND x.bin = b.bin GROUP BY 1, 2, 3),
shares AS (SELECT *, greatest(CAST(e AS DOUBLE) / SUM(e) OVER (PARTITION BY week), 1e-4::DOUBLE) AS es,
  greatest(CAST(a AS DOUBLE) / SUM(a) OVER (PARTITION BY week), 1e-4::DOUBLE) AS s FROM cells)""".replace(
    "STEPS", " + ".join(f"CASE WHEN value >= lo + {i} * ((hi - lo) / 10) THEN 1 ELSE 0 END" for i in range(1, 10)))


@query(sql.with_([_WEEKS], f"""SELECT week, n_expected, n_actual, psi, {_PSI_STATUS} AS status FROM (SELECT week, CAST(SUM(e) AS BIGINT) AS n_expected,
  CAST(SUM(a) AS BIGINT) AS n_actual, round(SUM((s - es) * ln(s / es)), 4) AS psi FROM shares GROUP BY week)"""))
def stream_psi(spark, sf_dir):
    base = roles.table(spark, sf_dir, "events").select("ts", "value")
    lo, hi = stream_psi_ops.baseline_range(base, "value")
    counts = stream_psi_ops.windowed_counts(_stream(spark, sf_dir, "events").select("ts", "value"), "ts", "value", lo, hi)
    out = fresh_checkpoint_path(spark, "stream-psi")
    stream_psi_ops.start_counts_sink(counts, f"{out}/rows", f"{out}/state").awaitTermination()
    out = stream_psi_ops.psi_by_window(stream_psi_ops.stored_counts(spark, f"{out}/rows"), stream_psi_ops.bin_counts(base, "value", lo, hi, 10))
    week = F.floor(F.unix_timestamp("window_start") / 604800).cast("long")
    return out.select(week.alias("week"), "n_expected", "n_actual", "psi", "status")


from . import catalog_more  # noqa: E402, F401  registers its queries
