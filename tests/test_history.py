"""Edge cases of the history aggregates and hot keys."""

import statistics
from fractions import Fraction

import duckdb
import pandas as pd
import pytest

from scoreloom.operators import history

PAYMENTS = "SK_ID_PREV long, DAYS_INSTALMENT int, DAYS_ENTRY_PAYMENT int, AMT_INSTALMENT double, AMT_PAYMENT double"
LOANS = (
    "SK_ID_PREV long, SK_ID_CURR long, NAME_CONTRACT_TYPE string, NAME_CONTRACT_STATUS string, AMT_APPLICATION double, "
    "AMT_CREDIT double, AMT_ANNUITY double, DAYS_DECISION int"
)


def loans(spark, pairs):
    return spark.createDataFrame([(p, c, "Cash loans", "Approved", 1.0, 1.0, 1.0, -10) for p, c in pairs], LOANS)


def test_installments_nulls_and_trend(spark):
    rows = [
        (1, -100, -90, 10.0, 10.0), (1, -200, -200, 10.0, 5.0), (1, -400, None, 10.0, None),  # applicant 7
        (2, -500, -510, 4.0, 4.0),  # applicant 8: only old rows
        (3, -5, -5, 4.0, 4.0),  # applicant 9: only recent rows
    ]
    got = {r["SK_ID_CURR"]: r for r in history.installment_history(
        spark.createDataFrame(rows, PAYMENTS), loans(spark, [(1, 7), (2, 8), (3, 9)])).collect()}
    a, b, c = got[7], got[8], got[9]
    assert (a["total_installments"], a["late_payments"], a["on_time_payments"]) == (3, 1, 1)
    assert a["late_payment_ratio"] == pytest.approx(1 / 3)
    assert a["late_ratio_trend"] == pytest.approx(0.5 - 0.0)
    assert a["payment_to_due_ratio"] == pytest.approx(0.5)
    assert b["late_ratio_last_12m"] == 0 and b["late_ratio_trend"] is None and b["early_payment_count"] == 1
    assert c["late_ratio_trend"] is None and c["std_payment_amount"] is None


def test_constant_column_has_zero_deviation(spark):
    rows = [(p, -10, -10, 0.1, 105.37) for p in (1, 2, 3) for _ in range(7)]
    row = history.installment_history(spark.createDataFrame(rows, PAYMENTS), loans(spark, [(1, 1), (2, 1), (3, 1)])).first()
    assert row["std_payment_amount"] == 0 and row["std_days_late"] == 0


def test_repeated_loan_rows_count_like_the_join(spark):
    """A loan listed twice doubles its rows but stays one distinct loan."""
    rows = [(1, -3, "Completed", 5, 0, 2.0), (1, -20, "Active", 0, 0, 3.0)]
    pos = spark.createDataFrame(rows, "SK_ID_PREV long, MONTHS_BALANCE int, NAME_CONTRACT_STATUS string, SK_DPD int, SK_DPD_DEF int, CNT_INSTALMENT_FUTURE double")
    row = history.pos_cash_history(pos, loans(spark, [(1, 5), (1, 5)])).first()
    assert (row["pos_balance_records"], row["pos_loan_count"], row["contract_completion_rate"]) == (4, 1, 2.0)


def test_hot_loan_and_hot_applicant_match_sql(spark):
    """A third of the payments belong to one loan, most loans to one applicant."""
    n = 6000
    pdf = pd.DataFrame({
        "SK_ID_PREV": [0 if i % 3 == 0 else i % 500 for i in range(n)],
        "DAYS_INSTALMENT": [-(i % 700) for i in range(n)],
        "DAYS_ENTRY_PAYMENT": [-(i % 700) + (i % 11) - 5 for i in range(n)],
        "AMT_INSTALMENT": [float(i % 97) for i in range(n)],
        "AMT_PAYMENT": [float(i % 89) for i in range(n)],
    }).astype({"DAYS_INSTALMENT": "int32", "DAYS_ENTRY_PAYMENT": "int32"})
    owners = pd.DataFrame({"SK_ID_PREV": range(500), "SK_ID_CURR": [1 if i < 400 else i for i in range(500)]})
    got = history.installment_history(spark.createDataFrame(pdf), spark.createDataFrame(owners)).toPandas()
    want = duckdb.query("""SELECT SK_ID_CURR, COUNT(*) AS n, SUM(AMT_PAYMENT) AS paid, stddev_samp(AMT_PAYMENT) AS sd
        FROM pdf JOIN owners USING (SK_ID_PREV) GROUP BY 1""").df()
    both = got.merge(want, on="SK_ID_CURR")
    assert len(both) == len(want) == len(got)
    assert (both["total_installments"] == both["n"]).all()
    assert both["total_paid"].to_numpy() == pytest.approx(both["paid"].to_numpy())
    assert both["std_payment_amount"].to_numpy() == pytest.approx(both["sd"].to_numpy(), nan_ok=True)


def test_latest_breaks_ties_by_loan(spark):
    rows = [(1, 9, "c", "Approved", 1.0, 1.0, 1.0, -5), (2, 9, "c", "Refused", 1.0, 1.0, 1.0, -5), (3, 9, "c", "Canceled", 1.0, 1.0, 1.0, -50)]
    assert history.latest_status(spark.createDataFrame(rows, LOANS)).first()["latest_app_status"] == "Refused"


def test_merge_renames_clashes_and_keeps_all_applicants(spark):
    base = spark.createDataFrame([(1, 5.0), (2, 6.0)], "SK_ID_CURR long, x double")
    a = spark.createDataFrame([(1, 1.0, 10.0)], "SK_ID_CURR long, amount double, x double")
    b = spark.createDataFrame([(1, 2.0)], "SK_ID_CURR long, amount double")
    no_key = spark.createDataFrame([(1,)], "other long")
    out = history.merge_features(base, {"a": a, "b": b, "c": no_key}).orderBy("SK_ID_CURR").collect()
    assert out[0].asDict() == {"SK_ID_CURR": 1, "x": 5.0, "a_amount": 1.0, "a_x": 10.0, "b_amount": 2.0}
    assert out[1]["a_amount"] is None


@pytest.mark.parametrize("loan", [lambda i: 1, lambda i: i])
def test_deviation_far_from_zero(spark, loan):
    """A spread of 1 around 1e7, within one loan and across three."""
    rows = [(loan(i), -10 - i, -10, 1.0, 1e7 + i) for i in range(3)]
    row = history.installment_history(spark.createDataFrame(rows, PAYMENTS), loans(spark, [(i, 7) for i in range(3)])).first()
    assert row["std_payment_amount"] == pytest.approx(1.0, rel=1e-9)


def test_balance_plan_reads_balances_once(spark):
    balance = spark.createDataFrame([(1, -1, "0"), (1, -2, "3"), (2, -1, "C"), (2, None, "X")], "SK_ID_BUREAU long, MONTHS_BALANCE int, STATUS string")
    bureau = spark.createDataFrame([(1, 9), (2, 9), (2, 9)], "SK_ID_BUREAU long, SK_ID_CURR long")
    out = history.bureau_balance_history(balance, bureau)
    row = out.first()
    assert (row.bb_distinct_accounts, row.bb_months_covered, row.bb_total_records, row.bb_worst_dpd_bucket) == (2, 2, 6, 3)
    assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("values", [(1e-7, 2e-7, 3e-7), (1e7, 1e7 + 1, 1e7 + 2), (-4.0, 1e9, 0.25), (1e12, 1e12 + 8, 5.0), (1 / 3, 1 / 3 + 1e-9, 1 / 3 - 1e-9), (0.0, 0.0, 0.0)])
def test_deviation_between_loans_of_any_size(spark, values):
    rows = [(i, -10, -10, 1.0, x) for i, x in enumerate(values)]
    row = history.installment_history(spark.createDataFrame(rows, PAYMENTS), loans(spark, [(i, 7) for i in range(3)])).first()
    assert row["std_payment_amount"] == pytest.approx(statistics.stdev(map(Fraction, values)), rel=1e-6)


def test_loan_tables_in_one_grouping(spark):
    """The joint grouping gives what each table gives by itself, and NULLs to applicants without rows in a table."""
    owned = loans(spark, [(1, 7), (2, 7), (2, 7), (3, 8), (4, 9)])
    payments = spark.createDataFrame([(1, -10, -8, 5.0, 4.0), (1, -400, -410, 5.0, 5.0), (2, -20, -20, 3.0, 3.0), (3, -5, None, 2.0, None)], PAYMENTS)
    pos = spark.createDataFrame([(2, -1, 3.0, "Active", 0, 0), (4, -2, 0.0, "Completed", 5, 1)], "SK_ID_PREV long, MONTHS_BALANCE int, CNT_INSTALMENT_FUTURE double, NAME_CONTRACT_STATUS string, SK_DPD int, SK_DPD_DEF int")
    both = {r.SK_ID_CURR: r.asDict() for r in history.loan_histories(history.loan_rows(owned, payments=payments, snapshots=pos)).collect()}
    for alone in (history.installment_history(payments, owned), history.pos_cash_history(pos, owned)):
        found = {r.SK_ID_CURR: r.asDict() for r in alone.collect()}
        for who, row in both.items():
            for name in alone.columns[1:]:
                assert row[name] == (found[who][name] if who in found else None), (who, name)
    assert history.loan_rows(owned) is None


def test_stored_tables_meet_without_an_exchange(spark, tmp_path):
    from scoreloom.plans import features as plans
    from scoreloom.sources import buckets

    base = spark.createDataFrame([(7, 1.0), (8, 2.0), (9, 3.0), (10, 4.0)], "SK_ID_CURR long, x double")
    children = dict(
        previous_application=loans(spark, [(1, 7), (2, 7), (3, 8)]),
        installments_payments=spark.createDataFrame([(1, -10, -8, 5.0, 4.0), (3, -20, -20, 3.0, 3.0)], PAYMENTS),
    )
    direct = history.merge_features(base, plans.history_aggregates(**children))
    store = str(tmp_path / "store")
    plans.store_histories(base, store, **children, count=4)
    for key, value in (("adaptive.enabled", "false"), ("autoBroadcastJoinThreshold", "-1")):
        spark.conf.set(f"spark.sql.{key}", value)
    try:
        merged = plans.merge_stored(spark, store)
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan
    assert sorted(map(str, merged.select(direct.columns).collect())) == sorted(map(str, direct.collect()))
    assert set(buckets.open_store(spark, store)) == {"base", "prev", "loans"}



def _moved(df):
    """Attributes of every exchange of the plan that is run without broadcasts, one list per exchange."""
    spark = df.sparkSession
    for key, value in (("adaptive.enabled", "false"), ("autoBroadcastJoinThreshold", "-1")):
        spark.conf.set(f"spark.sql.{key}", value)
    try:
        plan = df._jdf.queryExecution().executedPlan()
        found, queue = [], [plan]
        while queue:
            node = queue.pop()
            if node.nodeName() == "Exchange":
                found.append([node.output().apply(i).name() for i in range(node.output().size())])
            queue += [node.children().apply(i) for i in range(node.children().size())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    return found


def test_child_rows_travel_as_read(spark, sf_dir):
    """By the loan move the nine columns of a card row, not the buffers of its aggregates; those move by applicant."""
    from scoreloom.plans import catalog

    by_loan = [names for names in _moved(catalog.credit_card_agg(spark, sf_dir)) if "SK_ID_CURR" not in names]
    assert by_loan and max(map(len, by_loan)) == 9


def test_stored_loans_are_a_row_per_applicant(spark):
    """The table below the loans does not grow with the loans of an applicant; copies of a loan keep their weight."""
    owned = loans(spark, [(i, 7) for i in range(50)] + [(50, 7), (50, 7), (51, 8)])
    payments = spark.createDataFrame([(i, -10 - i, -8, 5.0, float(i)) for i in range(52)], PAYMENTS)
    rows = history.loan_rows(owned, payments=payments)
    assert rows.count() == 3  # 7 with one copy, 7 with two, 8
    row = {r.SK_ID_CURR: r for r in history.loan_tables(rows)["inst"].collect()}[7]
    paid = [*range(50), 50, 50]
    assert (row.total_installments, row.total_paid) == (52, sum(paid))
    assert row.std_payment_amount == pytest.approx(statistics.stdev(paid), rel=1e-12)
