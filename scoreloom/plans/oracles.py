"""Equivalent SQL of the registered queries over the test tables."""

from __future__ import annotations

AS_OF = "DATE '2002-01-01'"


def _days(x: str, as_of: str = AS_OF) -> str:
    return f"CAST(date_diff('day', {as_of}, CAST({x} AS DATE)) AS INTEGER)"


def _months(x: str) -> str:
    return f"CAST((year({x}) - 2002) * 12 + month({x}) - 1 AS INTEGER)"


def _cents(x: str) -> str:
    return f"CAST(floor({x} * 100 + 0.5::DOUBLE) AS BIGINT)"


def _share(x: str, percent: str) -> str:
    return f"(({_cents(x)} * ({percent}) + 50) // 100)"


PREV = f"""prev AS (
  SELECT o_orderkey AS SK_ID_PREV, o_custkey AS SK_ID_CURR,
    CASE o_orderstatus WHEN 'O' THEN 'Approved' WHEN 'F' THEN 'Refused' ELSE 'Canceled' END AS NAME_CONTRACT_STATUS,
    CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'Cash loans' WHEN o_orderpriority = '3-MEDIUM'
      THEN 'Consumer loans' ELSE 'Revolving loans' END AS NAME_CONTRACT_TYPE,
    {_cents('o_totalprice')} AS AMT_APPLICATION,
    CASE WHEN o_orderstatus = 'P' THEN 0 ELSE {_cents('o_totalprice')} END AS AMT_CREDIT,
    CASE WHEN o_orderstatus <> 'F' THEN {_share('o_totalprice', '8')} END AS AMT_ANNUITY,
    {_days('o_orderdate')} AS DAYS_DECISION
  FROM orders)"""

_EV = _days("ts", "DATE '2024-02-01'")
BUREAU = f"""bureau AS (
  SELECT user_id AS SK_ID_CURR, event_id AS SK_ID_BUREAU,
    CASE WHEN event_type IN ('purchase','signup') THEN 'Active' WHEN event_type = 'error' THEN 'Bad debt' ELSE 'Closed' END AS CREDIT_ACTIVE,
    event_type AS CREDIT_TYPE, {_cents('value')} AS AMT_CREDIT_SUM,
    CASE WHEN event_type IN ('purchase','signup') THEN {_share('value', '40')}
         WHEN event_type <> 'error' THEN 0 END AS AMT_CREDIT_SUM_DEBT,
    CASE WHEN event_type = 'error' THEN {_share('value', '10')} ELSE 0 END AS AMT_CREDIT_SUM_OVERDUE,
    CASE WHEN event_type = 'purchase' THEN {_share('value', '5')} END AS AMT_ANNUITY,
    {_EV} * 40 AS DAYS_CREDIT,
    CASE WHEN event_type IN ('purchase','signup') THEN {_EV} * 40 + 365 END AS DAYS_CREDIT_ENDDATE,
    {_EV} AS DAYS_CREDIT_UPDATE,
    CASE WHEN event_type = 'error' THEN CAST(floor(value) AS INTEGER) ELSE 0 END AS CREDIT_DAY_OVERDUE
  FROM events)"""

BUREAU_BALANCE = f"""bureau_balance AS (
  SELECT l_orderkey AS SK_ID_BUREAU, {_months('l_shipdate')} AS MONTHS_BALANCE,
    CASE WHEN l_linestatus = 'F' AND l_returnflag = 'R' THEN CAST(least(l_linenumber, 5) AS VARCHAR)
         WHEN l_linestatus = 'F' AND l_returnflag = 'A' THEN 'C'
         WHEN l_linestatus = 'F' AND l_returnflag = 'N' THEN 'X' ELSE '0' END AS STATUS
  FROM lineitem)"""

_UNPAID = "(l_returnflag = 'N' AND l_linestatus = 'O')"
INSTALLMENTS = f"""ip AS (
  SELECT l_orderkey AS SK_ID_PREV, {_days('l_shipdate')} AS DAYS_INSTALMENT,
    CASE WHEN NOT {_UNPAID} THEN {_days('l_shipdate')} + CAST(l_quantity AS INTEGER) - 25 END AS DAYS_ENTRY_PAYMENT,
    {_cents('l_extendedprice')} AS AMT_INSTALMENT,
    CASE WHEN NOT {_UNPAID} THEN {_share('l_extendedprice', '100 - ' + _cents('l_discount'))} END AS AMT_PAYMENT
  FROM lineitem)"""

POS = f"""pc AS (
  SELECT l_orderkey AS SK_ID_PREV, {_months('l_shipdate')} AS MONTHS_BALANCE,
    CASE WHEN l_linestatus = 'F' THEN 'Completed' ELSE 'Active' END AS NAME_CONTRACT_STATUS,
    greatest(CAST(l_quantity AS INTEGER) - 40, 0) AS SK_DPD, greatest(CAST(l_quantity AS INTEGER) - 45, 0) AS SK_DPD_DEF,
    CAST(l_linenumber AS DOUBLE) AS CNT_INSTALMENT_FUTURE
  FROM lineitem)"""

CARD = f"""cc AS (
  SELECT l_orderkey AS SK_ID_PREV, {_months('l_shipdate')} AS MONTHS_BALANCE, {_cents('l_extendedprice')} AS AMT_BALANCE,
    CASE WHEN l_returnflag <> 'R' THEN CAST(l_quantity AS INTEGER) * 1000 ELSE 0 END AS AMT_CREDIT_LIMIT_ACTUAL,
    {_share('l_extendedprice', _cents('l_discount'))} AS AMT_DRAWINGS_CURRENT, l_linenumber AS CNT_DRAWINGS_CURRENT,
    {_share('l_extendedprice', _cents('l_tax'))} AS AMT_PAYMENT_CURRENT, {_share('l_extendedprice', '4')} AS AMT_INST_MIN_REGULARITY,
    greatest(CAST(l_quantity AS INTEGER) - 42, 0) AS SK_DPD
  FROM lineitem)"""


def _mean(x: str) -> str:
    return f"CAST(SUM({x}) AS DOUBLE) / NULLIF(COUNT({x}), 0)"


def _n_if(p: str) -> str:
    return f"COUNT(*) FILTER (WHERE {p})"


def _div(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0)"


def _std(x: str, d: int = 4) -> str:
    return f"round(stddev_samp(CAST({x} AS DOUBLE)), {d})"


BUREAU_AGG = f"""SELECT SK_ID_CURR, COUNT(*) AS bureau_loan_count,
  {_n_if("CREDIT_ACTIVE = 'Active'")} AS active_credits, {_n_if("CREDIT_ACTIVE = 'Closed'")} AS closed_credits,
  {_mean('AMT_CREDIT_SUM')} AS avg_credit_amount, CAST(SUM(AMT_CREDIT_SUM) AS DOUBLE) AS total_credit_amount,
  CAST(SUM(AMT_CREDIT_SUM_DEBT) AS DOUBLE) AS total_debt, {_mean('AMT_CREDIT_SUM_DEBT')} AS avg_debt,
  CAST(SUM(AMT_CREDIT_SUM_OVERDUE) AS DOUBLE) AS total_overdue_amount,
  {_n_if('AMT_CREDIT_SUM_OVERDUE > 0')} AS overdue_count,
  MIN(DAYS_CREDIT) AS earliest_bureau_days, MAX(DAYS_CREDIT) AS latest_bureau_days,
  MAX(DAYS_CREDIT_ENDDATE) AS latest_credit_enddate, {_mean('DAYS_CREDIT_UPDATE')} AS avg_days_since_update,
  CASE WHEN SUM(AMT_CREDIT_SUM) > 0 THEN {_div('SUM(AMT_CREDIT_SUM_DEBT)', 'SUM(AMT_CREDIT_SUM)')} END AS debt_to_credit_ratio,
  {_std('AMT_CREDIT_SUM')} AS std_credit_amount, {_std('AMT_CREDIT_SUM_DEBT')} AS std_debt_amount, {_std('DAYS_CREDIT')} AS std_bureau_days,
  {_n_if('DAYS_CREDIT >= -365')} AS bureau_loans_last_12m, {_n_if('DAYS_CREDIT >= -730')} AS bureau_loans_last_24m,
  {_n_if("DAYS_CREDIT >= -365 AND CREDIT_ACTIVE = 'Active'")} AS active_loans_last_12m,
  {_mean('CASE WHEN DAYS_CREDIT >= -365 THEN AMT_CREDIT_SUM_DEBT END')} AS avg_debt_last_12m,
  CAST(SUM(CASE WHEN DAYS_CREDIT >= -365 THEN AMT_CREDIT_SUM_OVERDUE ELSE 0 END) AS DOUBLE) AS overdue_amount_last_12m,
  COUNT(DISTINCT CREDIT_TYPE) AS bureau_credit_type_count, {_mean('AMT_ANNUITY')} AS avg_bureau_annuity,
  {_n_if('CREDIT_DAY_OVERDUE > 0')} AS bureau_day_overdue_count, MAX(CREDIT_DAY_OVERDUE) AS max_bureau_day_overdue,
  {_div(_n_if('DAYS_CREDIT >= -365'), 'COUNT(*)')} AS bureau_recent_ratio
FROM bureau GROUP BY SK_ID_CURR"""

BUREAU_BALANCE_AGG = f"""SELECT *, round({_div('bb_dpd_count', 'bb_total_records')}, 4) AS bb_dpd_ratio,
  round({_div('bb_closed_count', 'bb_total_records')}, 4) AS bb_closed_ratio,
  round({_div('bb_current_count', 'bb_total_records')}, 4) AS bb_current_ratio
FROM (SELECT b.SK_ID_CURR, COUNT(*) AS bb_total_records, COUNT(DISTINCT bb.SK_ID_BUREAU) AS bb_distinct_accounts,
  COUNT(DISTINCT bb.MONTHS_BALANCE) AS bb_months_covered, MIN(bb.MONTHS_BALANCE) AS bb_earliest_month,
  MAX(bb.MONTHS_BALANCE) AS bb_latest_month,
  {_n_if("bb.STATUS IN ('1','2','3','4','5')")} AS bb_dpd_count, {_n_if("bb.STATUS = 'C'")} AS bb_closed_count,
  {_n_if("bb.STATUS = '0'")} AS bb_current_count, {_n_if("bb.STATUS = 'X'")} AS bb_unknown_count,
  MAX(CASE WHEN bb.STATUS IN ('1','2','3','4','5') THEN CAST(bb.STATUS AS INTEGER) ELSE 0 END) AS bb_worst_dpd_bucket
  FROM bureau_balance bb JOIN bureau b ON bb.SK_ID_BUREAU = b.SK_ID_BUREAU GROUP BY b.SK_ID_CURR)"""

_USE = "CASE WHEN AMT_CREDIT_LIMIT_ACTUAL > 0 THEN CAST(AMT_BALANCE AS DOUBLE) / AMT_CREDIT_LIMIT_ACTUAL END"
_B6 = _mean("CASE WHEN MONTHS_BALANCE >= -6 THEN AMT_BALANCE END")
_BOLD = _mean("CASE WHEN MONTHS_BALANCE < -6 AND MONTHS_BALANCE >= -18 THEN AMT_BALANCE END")
CARD_AGG = f"""SELECT p.SK_ID_CURR, COUNT(DISTINCT cc.SK_ID_PREV) AS cc_count, COUNT(*) AS cc_balance_records,
  {_mean('AMT_BALANCE')} AS avg_cc_balance, CAST(MAX(AMT_BALANCE) AS DOUBLE) AS max_cc_balance,
  {_mean('AMT_CREDIT_LIMIT_ACTUAL')} AS avg_credit_limit,
  CASE WHEN AVG(AMT_CREDIT_LIMIT_ACTUAL) > 0 THEN ({_mean('AMT_BALANCE')}) / ({_mean('AMT_CREDIT_LIMIT_ACTUAL')}) END AS avg_utilisation_ratio,
  {_mean('AMT_DRAWINGS_CURRENT')} AS avg_drawings, CAST(SUM(AMT_DRAWINGS_CURRENT) AS DOUBLE) AS total_drawings,
  {_mean('CNT_DRAWINGS_CURRENT')} AS avg_drawing_count, {_mean('AMT_PAYMENT_CURRENT')} AS avg_payment,
  CAST(SUM(AMT_PAYMENT_CURRENT) AS DOUBLE) AS total_payment,
  {_n_if('AMT_PAYMENT_CURRENT < AMT_INST_MIN_REGULARITY')} AS min_payment_misses,
  {_mean('SK_DPD')} AS avg_cc_dpd, MAX(SK_DPD) AS max_cc_dpd, {_n_if('SK_DPD > 0')} AS cc_months_with_dpd,
  {_std('AMT_BALANCE')} AS std_cc_balance, {_std('AMT_DRAWINGS_CURRENT')} AS std_cc_drawings,
  MAX({_USE}) AS max_utilisation_ratio, {_B6} AS avg_balance_last_6m,
  {_mean('CASE WHEN MONTHS_BALANCE >= -12 THEN AMT_BALANCE END')} AS avg_balance_last_12m,
  {_n_if('MONTHS_BALANCE >= -12 AND SK_DPD > 0')} AS cc_dpd_last_12m,
  ({_B6}) - ({_BOLD}) AS cc_balance_trend,
  round(AVG(CASE WHEN MONTHS_BALANCE >= -6 THEN {_USE} END)
    - AVG(CASE WHEN MONTHS_BALANCE < -6 AND MONTHS_BALANCE >= -18 THEN {_USE} END), 6) AS cc_utilisation_trend
FROM cc JOIN prev p ON cc.SK_ID_PREV = p.SK_ID_PREV GROUP BY p.SK_ID_CURR"""

_LATE = "DAYS_ENTRY_PAYMENT > DAYS_INSTALMENT"
_R, _O = "DAYS_INSTALMENT >= -365", "DAYS_INSTALMENT < -365"
INSTALLMENT_AGG = f"""SELECT p.SK_ID_CURR, COUNT(*) AS total_installments, {_n_if(_LATE)} AS late_payments,
  {_n_if('DAYS_ENTRY_PAYMENT <= DAYS_INSTALMENT')} AS on_time_payments, {_div(_n_if(_LATE), 'COUNT(*)')} AS late_payment_ratio,
  {_mean('DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT')} AS avg_days_late, MAX(DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT) AS max_days_late,
  {_mean('AMT_PAYMENT')} AS avg_payment_amount, CAST(SUM(AMT_PAYMENT) AS DOUBLE) AS total_paid,
  {_mean('AMT_INSTALMENT')} AS avg_instalment_amount, CAST(SUM(AMT_INSTALMENT) AS DOUBLE) AS total_due,
  CAST(SUM(AMT_INSTALMENT - AMT_PAYMENT) AS DOUBLE) AS total_underpayment, {_mean('AMT_INSTALMENT - AMT_PAYMENT')} AS avg_underpayment,
  CASE WHEN SUM(AMT_INSTALMENT) > 0 THEN {_div('SUM(AMT_PAYMENT)', 'SUM(AMT_INSTALMENT)')} END AS payment_to_due_ratio,
  {_std('AMT_PAYMENT')} AS std_payment_amount, {_std('DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT')} AS std_days_late,
  {_n_if(f'{_R} AND {_LATE}')} AS late_payments_last_12m, {_n_if(_R)} AS total_installments_last_12m,
  COALESCE({_div(_n_if(f'{_R} AND {_LATE}'), _n_if(_R))}, 0) AS late_ratio_last_12m,
  ({_div(_n_if(f'{_R} AND {_LATE}'), _n_if(_R))}) - ({_div(_n_if(f'{_O} AND {_LATE}'), _n_if(_O))}) AS late_ratio_trend,
  {_n_if('DAYS_ENTRY_PAYMENT < DAYS_INSTALMENT - 5')} AS early_payment_count,
  {_mean('CASE WHEN DAYS_ENTRY_PAYMENT <= DAYS_INSTALMENT THEN DAYS_INSTALMENT - DAYS_ENTRY_PAYMENT END')} AS avg_days_early
FROM ip JOIN prev p ON ip.SK_ID_PREV = p.SK_ID_PREV GROUP BY p.SK_ID_CURR"""

_P12, _POLD = "MONTHS_BALANCE >= -12", "MONTHS_BALANCE < -12"
POS_AGG = f"""SELECT p.SK_ID_CURR, COUNT(DISTINCT pc.SK_ID_PREV) AS pos_loan_count, COUNT(*) AS pos_balance_records,
  {_n_if("pc.NAME_CONTRACT_STATUS = 'Completed'")} AS completed_contracts, {_n_if("pc.NAME_CONTRACT_STATUS = 'Active'")} AS active_contracts,
  {_mean('SK_DPD')} AS avg_dpd, MAX(SK_DPD) AS max_dpd, {_n_if('SK_DPD > 0')} AS months_with_dpd,
  {_mean('SK_DPD_DEF')} AS avg_dpd_def, MAX(SK_DPD_DEF) AS max_dpd_def,
  {_mean('CNT_INSTALMENT_FUTURE')} AS avg_remaining_instalments, MIN(CNT_INSTALMENT_FUTURE) AS min_remaining_instalments,
  {_div(_n_if("pc.NAME_CONTRACT_STATUS = 'Completed'"), 'COUNT(DISTINCT pc.SK_ID_PREV)')} AS contract_completion_rate,
  {_div(_n_if('SK_DPD > 0'), 'COUNT(*)')} AS dpd_rate, {_std('SK_DPD')} AS std_pos_dpd, {_std('CNT_INSTALMENT_FUTURE')} AS std_remaining_inst,
  {_n_if(f'{_P12} AND SK_DPD > 0')} AS pos_dpd_last_12m, {_n_if(_P12)} AS pos_records_last_12m,
  COALESCE({_div(_n_if(f'{_P12} AND SK_DPD > 0'), _n_if(_P12))}, 0) AS pos_dpd_rate_last_12m,
  ({_div(_n_if(f'{_P12} AND SK_DPD > 0'), _n_if(_P12))}) - ({_div(_n_if(f'{_POLD} AND SK_DPD > 0'), _n_if(_POLD))}) AS pos_dpd_trend
FROM pc JOIN prev p ON pc.SK_ID_PREV = p.SK_ID_PREV GROUP BY p.SK_ID_CURR"""

_A = "NAME_CONTRACT_STATUS = 'Approved'"
_D = "DAYS_DECISION >= -365"
PREV_AGG = f"""SELECT SK_ID_CURR, COUNT(*) AS prev_app_count, {_n_if(_A)} AS approved_apps,
  {_n_if("NAME_CONTRACT_STATUS = 'Refused'")} AS refused_apps, {_n_if("NAME_CONTRACT_STATUS = 'Canceled'")} AS canceled_apps,
  {_div(_n_if(_A), 'COUNT(*)')} AS approval_rate, {_mean('AMT_APPLICATION')} AS avg_application_amount,
  {_mean('AMT_CREDIT')} AS avg_credit_amount, {_mean('AMT_ANNUITY')} AS avg_annuity,
  CASE WHEN SUM(AMT_APPLICATION) > 0 THEN {_div('SUM(AMT_CREDIT)', 'SUM(AMT_APPLICATION)')} END AS credit_to_application_ratio,
  CASE WHEN SUM(AMT_CREDIT) > 0 THEN {_div('SUM(AMT_ANNUITY)', 'SUM(AMT_CREDIT)')} END AS annuity_to_credit_ratio,
  {_n_if("NAME_CONTRACT_TYPE = 'Cash loans'")} AS cash_loans, {_n_if("NAME_CONTRACT_TYPE = 'Consumer loans'")} AS consumer_loans,
  {_n_if("NAME_CONTRACT_TYPE = 'Revolving loans'")} AS revolving_loans,
  MAX(DAYS_DECISION) AS latest_decision_days, MIN(DAYS_DECISION) AS earliest_decision_days,
  {_std('AMT_APPLICATION')} AS std_application_amount, {_std('AMT_CREDIT')} AS std_prev_credit_amount,
  {_n_if(_D)} AS prev_apps_last_12m, {_n_if(_D + " AND NAME_CONTRACT_STATUS = 'Refused'")} AS refusals_last_12m,
  {_n_if(f'{_D} AND {_A}')} AS approvals_last_12m, {_div(_n_if(f'{_D} AND {_A}'), _n_if(_D))} AS approval_rate_last_12m,
  arg_max(NAME_CONTRACT_STATUS, (DAYS_DECISION, SK_ID_PREV)) AS latest_app_status
FROM prev GROUP BY SK_ID_CURR"""


def _mean_if(p: str) -> str:
    x = f"CASE WHEN {p} THEN {_cents('o_totalprice')} END"
    return f"CAST(SUM({x}) AS DOUBLE) / NULLIF(COUNT({x}), 0) / 50000000.0::DOUBLE"


_URG, _DAY = "o_orderpriority = '1-URGENT'", _days("o_orderdate")
_PRICE = _cents("o_totalprice")
APPLICATION = f"""application AS (
  SELECT c_custkey AS SK_ID_CURR, CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS TARGET, c_mktsegment AS NAME_INCOME_TYPE,
    n_name AS NAME_HOUSING_TYPE, r_name AS NAME_EDUCATION_TYPE, CASE WHEN c_nationkey < 12 THEN 'M' ELSE 'F' END AS CODE_GENDER,
    h.* EXCLUDE (o_custkey)
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN (SELECT o_custkey, CAST(SUM({_PRICE}) AS DOUBLE) / 100 AS AMT_INCOME_TOTAL, CAST(MAX({_PRICE}) AS DOUBLE) / 100 AS AMT_CREDIT,
    CAST(MIN({_PRICE}) AS DOUBLE) / 100 AS AMT_ANNUITY, CAST(MAX(CASE WHEN o_orderstatus = 'F' THEN {_PRICE} END) AS DOUBLE) / 100 AS AMT_GOODS_PRICE,
    NULLIF({_n_if(_URG)}, 0) AS CNT_FAM_MEMBERS, MIN({_DAY}) * 6 - 6570 AS DAYS_BIRTH,
    COALESCE(MAX(CASE WHEN {_URG} THEN {_DAY} END), 365243) AS DAYS_EMPLOYED, MIN({_DAY}) AS DAYS_REGISTRATION,
    MAX({_DAY}) AS DAYS_ID_PUBLISH, MAX(CASE WHEN o_orderstatus = 'P' THEN {_DAY} END) AS DAYS_LAST_PHONE_CHANGE,
    {_mean_if(_URG)} AS EXT_SOURCE_1, {_mean_if("o_orderstatus = 'F'")} AS EXT_SOURCE_2, {_mean_if("o_orderstatus = 'P'")} AS EXT_SOURCE_3,
    CASE WHEN {_n_if(_URG)} > 0 THEN 1 ELSE 0 END AS FLAG_DOCUMENT_2,
    CASE WHEN {_n_if("o_orderpriority = '2-HIGH'")} > 0 THEN 1 ELSE 0 END AS FLAG_DOCUMENT_3,
    CASE WHEN {_n_if("o_orderpriority = '5-LOW'")} > 0 THEN 1 ELSE 0 END AS FLAG_DOCUMENT_4,
    CASE WHEN COUNT(*) > 10 THEN 1 ELSE 0 END AS REG_REGION_NOT_LIVE_REGION,
    CASE WHEN {_n_if("o_orderstatus = 'P'")} > {_n_if("o_orderstatus = 'F'")} THEN 1 ELSE 0 END AS REG_CITY_NOT_WORK_CITY,
    {_n_if(f'{_DAY} >= -365')} AS AMT_REQ_CREDIT_BUREAU_YEAR, NULLIF({_n_if(f'{_DAY} >= -200')}, 0) AS AMT_REQ_CREDIT_BUREAU_MON,
    MAX(CASE WHEN {_URG} THEN o_orderstatus END) AS OCCUPATION_TYPE
    FROM orders GROUP BY o_custkey) h ON c_custkey = h.o_custkey)"""

SCORED = f"""scored AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS TARGET,
    l_extendedprice / (l_extendedprice + 50000.0::DOUBLE) AS PRED_CHAMPION,
    l_quantity / (l_quantity + 25.0::DOUBLE) AS PRED_XGB, l_tax / (l_tax + 0.04::DOUBLE) AS PRED_LGB,
    l_extendedprice AS EAD, l_linestatus AS CODE_GENDER,
    CASE WHEN year(l_shipdate) < 1997 THEN 'early' WHEN year(l_shipdate) < 2000 THEN 'middle' ELSE 'late' END AS AGE_BAND,
    CASE WHEN l_linenumber > 1 THEN CAST(l_linenumber AS VARCHAR) END AS INCOME_BAND
  FROM lineitem)"""
SCORED_LONG = SCORED + """, long AS (
  SELECT 'champion' AS model, TARGET AS y, PRED_CHAMPION AS s, * FROM scored UNION ALL
  SELECT 'xgb', TARGET, PRED_XGB, * FROM scored UNION ALL
  SELECT 'lgb', TARGET, PRED_LGB, * FROM scored)"""

EVENT_SIDES = """sides AS (
  SELECT CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN 0 ELSE 1 END AS side, value, CAST(user_id AS DOUBLE) AS "user",
    CAST(hour(ts) AS DOUBLE) AS hour, CAST(length(props) AS DOUBLE) AS props_len,
    CASE WHEN event_type = 'purchase' THEN value END AS spend
  FROM events), long AS (
  SELECT side, 'value' AS feature, value AS v FROM sides UNION ALL SELECT side, 'user', "user" FROM sides UNION ALL
  SELECT side, 'hour', hour FROM sides UNION ALL SELECT side, 'props_len', props_len FROM sides UNION ALL
  SELECT side, 'spend', spend FROM sides)"""


def with_(ctes, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body
