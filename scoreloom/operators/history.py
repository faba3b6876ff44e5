"""Six history aggregations, one row per applicant.

Child tables that hang below a loan travel once as the few columns that are read, meet the loan's applicant and are
reduced to one row per applicant where they meet. Both sides of that join are plain exchanges on the loan, so adaptive
execution splits a loan with very many rows, and an applicant's rows combine before they are exchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.aggregates import (
    Rollup, avg, avg_if, double, latest, named, recent_minus_older, share, std, sum0_if,
)

APPLICANT = "SK_ID_CURR"
LOAN = "SK_ID_PREV"
ACCOUNT = "SK_ID_BUREAU"


def _owners(parent: DataFrame, key: str) -> DataFrame:
    """Each (key, applicant) once with its number of copies, so a repeated parent row never multiplies the join.

    The grouping has an exchange of its own: the one by the key that the join adds is then free to be split.
    """
    return parent.select(key, APPLICANT).groupBy(key, APPLICANT).agg(F.count(F.lit(1)).alias("p_copies"))


def _held(child: DataFrame, owners: DataFrame, key: str, out: str) -> DataFrame:
    """Number of an applicant's keys that have a row in the child table, per number of copies."""
    return owners.join(child.select(key), key, "left_semi").groupBy(APPLICANT, "p_copies").agg(F.count(F.lit(1)).alias(out))


def _loan_rows(child: DataFrame, owners: DataFrame, roll: Rollup) -> DataFrame:
    """Partials of a child table per applicant and number of copies; loans are counted in rows of their own."""
    rows = child.join(owners, LOAN).groupBy(APPLICANT, "p_copies").agg(*roll.partials())
    if roll.counts_loans:
        rows = rows.unionByName(_held(child, owners, LOAN, f"{roll.p}loans"), allowMissingColumns=True)
    return rows


def _per_applicant(child: DataFrame, loans: DataFrame, make) -> DataFrame:
    r = Rollup()
    outputs = make(r)
    return _loan_rows(child, _owners(loans, LOAN), r).groupBy(APPLICANT).agg(*named(outputs))


def loan_rows(
    loans: DataFrame, cards: DataFrame | None = None, payments: DataFrame | None = None, snapshots: DataFrame | None = None
) -> DataFrame | None:
    """Rows per (applicant, copies) of all given child tables, each with the partials of its own table; None without any.

    The owners of the loans are the same frame for all, so they are dealt once.
    """
    owners, out = _owners(loans, LOAN), None
    for child, (prefix, make) in zip((cards, payments, snapshots), _LOAN_TABLES, strict=True):
        if child is not None:
            r = Rollup(prefix)
            make(r)
            part = _loan_rows(child, owners, r)
            out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def loan_tables(rows: DataFrame) -> dict[str, DataFrame]:
    """The card, instalment and point-of-sale features of ``loan_rows``, each from a grouping of its own rows."""
    out = {}
    for prefix, make in _LOAN_TABLES:
        r = Rollup(prefix)
        outputs = make(r)
        own = [c for c in (f"{r.p}here", f"{r.p}loans") if c in rows.columns]
        if own:
            of_table = rows.where(" OR ".join(f"{c} IS NOT NULL" for c in own))
            out[prefix.rstrip("_")] = of_table.groupBy(APPLICANT).agg(*named(outputs))
    return out


def loan_histories(rows: DataFrame) -> DataFrame:
    """The features of all ``loan_tables`` in one row per applicant.

    Features of a table in which an applicant has no row are NULL, as if each had been joined by itself.
    """
    out = None
    for part in loan_tables(rows).values():
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out.groupBy(APPLICANT).agg(*[F.max(c).alias(c) for c in out.columns if c != APPLICANT])


def bureau_history(bureau: DataFrame) -> DataFrame:
    """External credits: volume, amounts, overdue, timing, recency."""
    recent, active = "DAYS_CREDIT >= -365", "CREDIT_ACTIVE = 'Active'"
    return bureau.groupBy(APPLICANT).agg(*named({
        "bureau_loan_count": "count(1)",
        "active_credits": f"count_if({active})",
        "closed_credits": "count_if(CREDIT_ACTIVE = 'Closed')",
        "avg_credit_amount": avg("AMT_CREDIT_SUM"),
        "total_credit_amount": double("sum(AMT_CREDIT_SUM)"),
        "total_debt": double("sum(AMT_CREDIT_SUM_DEBT)"),
        "avg_debt": avg("AMT_CREDIT_SUM_DEBT"),
        "total_overdue_amount": double("sum(AMT_CREDIT_SUM_OVERDUE)"),
        "overdue_count": "count_if(AMT_CREDIT_SUM_OVERDUE > 0)",
        "earliest_bureau_days": "min(DAYS_CREDIT)",
        "latest_bureau_days": "max(DAYS_CREDIT)",
        "latest_credit_enddate": "max(DAYS_CREDIT_ENDDATE)",
        "avg_days_since_update": avg("DAYS_CREDIT_UPDATE"),
        "debt_to_credit_ratio": share("sum(AMT_CREDIT_SUM_DEBT)", "sum(AMT_CREDIT_SUM)"),
        "std_credit_amount": std("AMT_CREDIT_SUM"),
        "std_debt_amount": std("AMT_CREDIT_SUM_DEBT"),
        "std_bureau_days": std("DAYS_CREDIT"),
        "bureau_loans_last_12m": f"count_if({recent})",
        "bureau_loans_last_24m": "count_if(DAYS_CREDIT >= -730)",
        "active_loans_last_12m": f"count_if({recent} AND {active})",
        "avg_debt_last_12m": avg_if(recent, "AMT_CREDIT_SUM_DEBT"),
        "overdue_amount_last_12m": double(sum0_if(recent, "AMT_CREDIT_SUM_OVERDUE")),
        "bureau_credit_type_count": "bigint(size(collect_set(CREDIT_TYPE)))",
        "avg_bureau_annuity": avg("AMT_ANNUITY"),
        "bureau_day_overdue_count": "count_if(CREDIT_DAY_OVERDUE > 0)",
        "max_bureau_day_overdue": "max(CREDIT_DAY_OVERDUE)",
        "bureau_recent_ratio": share(f"count_if({recent})", "count(1)", "0.0D"),
    }))


def account_rows(balance: DataFrame, bureau: DataFrame) -> DataFrame:
    """Totals per applicant, number of copies and month, and rows of their own with the number of accounts."""
    owners = _owners(bureau, ACCOUNT)
    months = balance.join(owners, ACCOUNT).groupBy(APPLICANT, "p_copies", F.col("MONTHS_BALANCE").alias("p_month")).agg(*named({
        "p_rows": "count(1)",
        "p_dpd": "count_if(STATUS IN ('1', '2', '3', '4', '5'))",
        "p_closed": "count_if(STATUS = 'C')",
        "p_current": "count_if(STATUS = '0')",
        "p_unknown": "count_if(STATUS = 'X')",
        "p_worst": "max(CASE WHEN STATUS IN ('1', '2', '3', '4', '5') THEN CAST(STATUS AS INT) ELSE 0 END)",
    }))
    return months.unionByName(_held(balance, owners, ACCOUNT, "p_accounts"), allowMissingColumns=True)


def account_history(rows: DataFrame) -> DataFrame:
    """Features of ``account_rows`` from one grouping by applicant: sets of months combine before they are exchanged."""
    stats = rows.groupBy(APPLICANT).agg(*named({
        "bb_total_records": "sum(p_rows * p_copies)",
        "bb_distinct_accounts": "sum(p_accounts)",
        "bb_earliest_month": "min(p_month)",
        "bb_latest_month": "max(p_month)",
        "bb_dpd_count": "sum(p_dpd * p_copies)",
        "bb_closed_count": "sum(p_closed * p_copies)",
        "bb_current_count": "sum(p_current * p_copies)",
        "bb_unknown_count": "sum(p_unknown * p_copies)",
        "bb_worst_dpd_bucket": "max(p_worst)",
        "bb_months_covered": "bigint(size(collect_set(p_month)))",
    }))
    return stats.select("*", *named({
        f"bb_{k}_ratio": f"round({share(f'bb_{k}_count', 'bb_total_records')}, 4)" for k in ("dpd", "closed", "current")
    }))


def bureau_balance_history(balance: DataFrame, bureau: DataFrame) -> DataFrame:
    """Monthly status of external credits: history depth, delinquency mix, worst bucket."""
    return account_history(account_rows(balance, bureau))


def _card_features(r: Rollup) -> dict[str, str]:
    balance, limit = "AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL"
    use = f"CASE WHEN {limit} > 0 THEN {double(balance)} / {double(limit)} END"
    recent, older = "MONTHS_BALANCE >= -6", "MONTHS_BALANCE < -6 AND MONTHS_BALANCE >= -18"
    when = lambda p, x: f"CASE WHEN {p} THEN {x} END"
    balance_6m = r.avg("bal6", when(recent, balance))
    return {
        "cc_count": r.loans(),
        "cc_balance_records": r.rows(),
        "avg_cc_balance": r.avg("bal", balance),
        "max_cc_balance": double(r.max("bal", balance)),
        "avg_credit_limit": r.avg("lim", limit),
        "avg_utilisation_ratio": share(r.avg("bal", balance), f"({r.avg('lim', limit)})"),
        "avg_drawings": r.avg("draw", "AMT_DRAWINGS_CURRENT"),
        "total_drawings": double(r.sum("draw", "AMT_DRAWINGS_CURRENT")),
        "avg_drawing_count": r.avg("ndraw", "CNT_DRAWINGS_CURRENT"),
        "avg_payment": r.avg("pay", "AMT_PAYMENT_CURRENT"),
        "total_payment": double(r.sum("pay", "AMT_PAYMENT_CURRENT")),
        "min_payment_misses": r.count_if("minpay", "AMT_PAYMENT_CURRENT < AMT_INST_MIN_REGULARITY"),
        "avg_cc_dpd": r.avg("dpd", "SK_DPD"),
        "max_cc_dpd": r.max("dpd", "SK_DPD"),
        "cc_months_with_dpd": r.count_if("dpd", "SK_DPD > 0"),
        "std_cc_balance": r.std("bal", balance),
        "std_cc_drawings": r.std("draw", "AMT_DRAWINGS_CURRENT"),
        "max_utilisation_ratio": r.max("use", use),
        "avg_balance_last_6m": balance_6m,
        "avg_balance_last_12m": r.avg("bal12", when("MONTHS_BALANCE >= -12", balance)),
        "cc_dpd_last_12m": r.count_if("dpd12", "MONTHS_BALANCE >= -12 AND SK_DPD > 0"),
        "cc_balance_trend": f"({balance_6m}) - ({r.avg('balold', when(older, balance))})",
        "cc_utilisation_trend": f"({r.avg('use6', when(recent, use))}) - ({r.avg('useold', when(older, use))})",
    }


def credit_card_history(cards: DataFrame, loans: DataFrame) -> DataFrame:
    """Monthly card snapshots: utilisation, drawings, payments, days past due, trends."""
    return _per_applicant(cards, loans, _card_features)


def _payment_features(r: Rollup) -> dict[str, str]:
    due_day, paid_day, due, paid = "DAYS_INSTALMENT", "DAYS_ENTRY_PAYMENT", "AMT_INSTALMENT", "AMT_PAYMENT"
    late, on_time = f"{paid_day} > {due_day}", f"{paid_day} <= {due_day}"
    recent, older = f"{due_day} >= -365", f"{due_day} < -365"
    n, n_late = r.rows(), r.count_if("late", late)
    n_recent, late_recent = r.count_if("recent", recent), r.count_if("late12", f"{recent} AND {late}")
    n_older, late_older = r.count_if("older", older), r.count_if("lateold", f"{older} AND {late}")
    days_late, short = f"({paid_day} - {due_day})", f"({due} - {paid})"
    return {
        "total_installments": n,
        "late_payments": n_late,
        "on_time_payments": r.count_if("ontime", on_time),
        "late_payment_ratio": share(n_late, n, "0.0D"),
        "avg_days_late": r.avg("dl", days_late),
        "max_days_late": r.max("dl", days_late),
        "avg_payment_amount": r.avg("paid", paid),
        "total_paid": double(r.sum("paid", paid)),
        "avg_instalment_amount": r.avg("due", due),
        "total_due": double(r.sum("due", due)),
        "total_underpayment": double(r.sum("short", short)),
        "avg_underpayment": r.avg("short", short),
        "payment_to_due_ratio": share(r.sum("paid", paid), r.sum("due", due)),
        "std_payment_amount": r.std("paid", paid),
        "std_days_late": r.std("dl", days_late),
        "late_payments_last_12m": late_recent,
        "total_installments_last_12m": n_recent,
        "late_ratio_last_12m": share(late_recent, n_recent, "0.0D"),
        "late_ratio_trend": recent_minus_older(late_recent, n_recent, late_older, n_older),
        "early_payment_count": r.count_if("early", f"{paid_day} < {due_day} - 5"),
        "avg_days_early": r.avg("early", f"CASE WHEN {on_time} THEN {due_day} - {paid_day} END"),
    }


def installment_history(payments: DataFrame, loans: DataFrame) -> DataFrame:
    """Scheduled payments: lateness, shortfall, recency, trend."""
    return _per_applicant(payments, loans, _payment_features)


def _snapshot_features(r: Rollup) -> dict[str, str]:
    past_due, recent, older = "SK_DPD > 0", "MONTHS_BALANCE >= -12", "MONTHS_BALANCE < -12"
    n, n_dpd = r.rows(), r.count_if("dpd", past_due)
    n_recent, dpd_recent = r.count_if("recent", recent), r.count_if("dpd12", f"{recent} AND {past_due}")
    n_older, dpd_older = r.count_if("older", older), r.count_if("dpdold", f"{older} AND {past_due}")
    completed = r.count_if("done", "NAME_CONTRACT_STATUS = 'Completed'")
    loan_count, left = r.loans(), "CNT_INSTALMENT_FUTURE"
    return {
        "pos_loan_count": loan_count,
        "pos_balance_records": n,
        "completed_contracts": completed,
        "active_contracts": r.count_if("active", "NAME_CONTRACT_STATUS = 'Active'"),
        "avg_dpd": r.avg("dpd", "SK_DPD"),
        "max_dpd": r.max("dpd", "SK_DPD"),
        "months_with_dpd": n_dpd,
        "avg_dpd_def": r.avg("def", "SK_DPD_DEF"),
        "max_dpd_def": r.max("def", "SK_DPD_DEF"),
        "avg_remaining_instalments": r.avg("left", left),
        "min_remaining_instalments": r.min("left", left),
        "contract_completion_rate": share(completed, loan_count),
        "dpd_rate": share(n_dpd, n, "0.0D"),
        "std_pos_dpd": r.std("dpd", "SK_DPD"),
        "std_remaining_inst": r.std("left", left),
        "pos_dpd_last_12m": dpd_recent,
        "pos_records_last_12m": n_recent,
        "pos_dpd_rate_last_12m": share(dpd_recent, n_recent, "0.0D"),
        "pos_dpd_trend": recent_minus_older(dpd_recent, n_recent, dpd_older, n_older),
    }


def pos_cash_history(snapshots: DataFrame, loans: DataFrame) -> DataFrame:
    """Monthly point-of-sale and cash loan snapshots: completion, days past due, trend."""
    return _per_applicant(snapshots, loans, _snapshot_features)


#: Prefix of the partials and features of the tables below a loan, in the order of the arguments of ``loan_rows``.
_LOAN_TABLES = (("cc_", _card_features), ("inst_", _payment_features), ("pos_", _snapshot_features))


def previous_application_history(loans: DataFrame) -> DataFrame:
    """Past applications: outcome mix, amounts, recency and the latest outcome."""
    status = lambda v: f"NAME_CONTRACT_STATUS = '{v}'"
    kind = lambda v: f"count_if(NAME_CONTRACT_TYPE = '{v}')"
    recent, approved = "DAYS_DECISION >= -365", status("Approved")
    return loans.groupBy(APPLICANT).agg(*named({
        "prev_app_count": "count(1)",
        "approved_apps": f"count_if({approved})",
        "refused_apps": f"count_if({status('Refused')})",
        "canceled_apps": f"count_if({status('Canceled')})",
        "approval_rate": share(f"count_if({approved})", "count(1)"),
        "avg_application_amount": avg("AMT_APPLICATION"),
        "avg_credit_amount": avg("AMT_CREDIT"),
        "avg_annuity": avg("AMT_ANNUITY"),
        "credit_to_application_ratio": share("sum(AMT_CREDIT)", "sum(AMT_APPLICATION)"),
        "annuity_to_credit_ratio": share("sum(AMT_ANNUITY)", "sum(AMT_CREDIT)"),
        "cash_loans": kind("Cash loans"),
        "consumer_loans": kind("Consumer loans"),
        "revolving_loans": kind("Revolving loans"),
        "latest_decision_days": "max(DAYS_DECISION)",
        "earliest_decision_days": "min(DAYS_DECISION)",
        "std_application_amount": std("AMT_APPLICATION"),
        "std_prev_credit_amount": std("AMT_CREDIT"),
        "prev_apps_last_12m": f"count_if({recent})",
        "refusals_last_12m": f"count_if({recent} AND {status('Refused')})",
        "approvals_last_12m": f"count_if({recent} AND {approved})",
        "approval_rate_last_12m": share(f"count_if({recent} AND {approved})", f"count_if({recent})"),
        "latest_app_status": latest(
            "CASE WHEN DAYS_DECISION IS NOT NULL THEN NAME_CONTRACT_STATUS END", "DAYS_DECISION", LOAN
        ),
    }))


def latest_status(loans: DataFrame) -> DataFrame:
    """Outcome of each applicant's last decision; equal days are decided by the loan id."""
    return loans.groupBy(APPLICANT).agg(*named({
        "latest_app_status": latest("NAME_CONTRACT_STATUS", "DAYS_DECISION", LOAN),
        "latest_decision_days": "max(DAYS_DECISION)",
    }))


def merge_features(base: DataFrame, aggregates: dict[str, DataFrame], key: str = APPLICANT) -> DataFrame:
    """Left-join every aggregate that carries the key.

    A column produced by several sides is renamed ``<aggregate>_<column>`` on the aggregate sides; a
    clash with the base keeps the base name. All sides are keyed by the applicant, so each is
    shuffled once on it.
    """
    joined = [(name, frame) for name, frame in aggregates.items() if key in frame.columns]
    seen: dict[str, int] = {}
    for _, frame in joined:
        for column in frame.columns:
            seen[column] = seen.get(column, 0) + 1
    taken = set(base.columns) - {key}
    out = base
    for name, frame in joined:
        renamed = [
            F.col(c).alias(f"{name}_{c}") if c != key and (seen[c] > 1 or c in taken) else F.col(c)
            for c in frame.columns
        ]
        out = out.join(frame.select(*renamed), key, "left")
    return out
