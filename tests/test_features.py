"""Derivation, encoding, WoE, scoring and source edge cases."""

import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from scoreloom.functions import rowwise, scores
from scoreloom.operators import encoding, features, scoring, woe
from scoreloom.plans.features import build_features
from scoreloom.sources import readers, writers


def test_rowwise_skips_nulls(spark):
    df = spark.createDataFrame([(1.0, 3.0, None), (None, None, None), (2.0, None, None)], "a double, b double, c double")
    cols = [F.col(x) for x in "abc"]
    got = df.select(
        rowwise.row_mean(cols), rowwise.row_std(cols), rowwise.row_sum(cols), rowwise.row_min(cols), rowwise.row_max(cols)
    ).collect()
    assert tuple(got[0]) == pytest.approx((2.0, 2 ** 0.5, 4.0, 1.0, 3.0))
    assert tuple(got[1]) == (None, None, 0.0, None, None)
    assert got[2][1] is None


def test_null_family_stays_null(spark):
    base = dict(AMT_CREDIT=1.0, AMT_INCOME_TOTAL=10.0, AMT_ANNUITY=1.0, AMT_GOODS_PRICE=1.0, DAYS_BIRTH=-3652, DAYS_EMPLOYED=365243, DAYS_REGISTRATION=-1, DAYS_ID_PUBLISH=-1)
    df = spark.createDataFrame(pd.DataFrame([{**base, "CNT_FAM_MEMBERS": 0.0}, {**base, "CNT_FAM_MEMBERS": 4.0}])).unionByName(
        spark.createDataFrame(pd.DataFrame([base])).withColumn("CNT_FAM_MEMBERS", F.lit(None).cast("double")))
    got = [r["INCOME_PER_PERSON"] for r in features.derived_features(df).collect()]
    assert got == [10.0, 2.5, None]
    assert features.derived_features(df).first()["EMPLOYMENT_YEARS"] == 0


def test_median_of_all_null_column_stays_null(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None), (None, None)], "EXT_SOURCE_1 double, EXT_SOURCE_2 double")
    out = features.impute_median(df).collect()
    assert sorted(r["EXT_SOURCE_1"] for r in out) == [1.0, 2.0, 3.0]
    assert all(r["EXT_SOURCE_2"] is None for r in out)


def test_frequency_and_codes_for_null_and_unseen(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "k string")
    got = {r["k"]: r["FREQ_k"] for r in encoding.frequency_encode(df, ["k"]).collect()}
    assert got == {"b": pytest.approx(2 / 3), "a": pytest.approx(1 / 3), None: 0.0}
    table = encoding.category_code_table(df, ["k"])
    other = spark.createDataFrame([("b",), ("zzz",), (None,)], "k string")
    assert [r["CODE_k"] for r in encoding.apply_category_codes(other, table, ["k"]).collect()] == [1, -1, -1]


@pytest.mark.parametrize("expression_rows, broadcast_rows", [(0, 100), (0, 1)])
def test_lookup_sizes_agree(spark, monkeypatch, expression_rows, broadcast_rows):
    """Generated expression, broadcast join and shuffle join give the same values."""
    from scoreloom.operators import lookups

    rows = [("it's", 0, 1), ("a\\b", 1, 0), (None, 0, 1), ("it's", 1, 0), ("c", 0, 0)] * 3
    df = spark.createDataFrame(rows, "k string, fold int, y int")
    run = lambda: sorted(map(str, encoding.target_encode_oof(encoding.frequency_encode(df, ["k"]), ["k"], "y", "fold").collect()))
    want = run()
    monkeypatch.setattr(lookups, "EXPRESSION_ROWS", expression_rows)
    monkeypatch.setattr(lookups, "BROADCAST_ROWS", broadcast_rows)
    assert run() == want


def test_target_encoding_ignores_the_own_fold(spark):
    rows = [("a", 0, 1), ("a", 0, 1), ("a", 1, 0), ("b", 1, 0)]
    df = spark.createDataFrame(rows, "k string, fold int, y int")
    out = encoding.target_encode_oof(df, ["k"], "y", "fold", m=1.0).collect()
    got = {(r["k"], r["fold"]): r["TE_k"] for r in out}
    assert got["a", 0] == pytest.approx((0 + 0.0 * 1) / 2)  # other fold: one row, no positives, prior 0
    assert got["a", 1] == pytest.approx((2 + 1.0 * 1) / 3)
    assert got["b", 1] == pytest.approx(1.0)  # unseen elsewhere: prior of the other fold


@pytest.fixture(scope="module")
def credit():
    rng = np.random.default_rng(42)
    n = 1000
    x = pd.DataFrame({
        "income": rng.lognormal(10, 1, n), "age": rng.normal(40, 10, n).clip(18, 80), "loan_amount": rng.lognormal(11, 0.5, n),
        "bureau_count": rng.poisson(3, n),
    })
    p = 1 / (1 + np.exp(-(-2 + 0.5 * x["loan_amount"] / x["income"] - 0.02 * x["age"] + 0.3 * x["bureau_count"])))
    return x.assign(TARGET=(rng.random(n) < p).astype(int), id=range(n))


COLS = ["income", "age", "loan_amount", "bureau_count"]


def test_woe_matches_pandas(spark, credit):
    model = woe.WoeModel.fit(spark.createDataFrame(credit), "TARGET", numeric=COLS, bins=5)
    iv = {r["feature"]: r["iv"] for r in model.iv_summary().collect()}
    assert set(iv) == set(COLS) and all(v >= 0 for v in iv.values())
    out = model.transform(spark.createDataFrame(credit)).orderBy("id").toPandas()
    assert out.shape == credit.shape
    for c in COLS:
        b = pd.qcut(credit[c], 5, duplicates="drop")
        t = credit.groupby(b, observed=False)["TARGET"].agg(["sum", "count"])
        e = (t["sum"] + 0.5) / (t["sum"].sum() + 1)
        ne = (t["count"] - t["sum"] + 0.5) / ((t["count"] - t["sum"]).sum() + 1)
        want = np.log(ne / e)
        assert out[c].to_numpy() == pytest.approx(b.map(want).astype(float).to_numpy(), abs=1e-9)
        assert iv[c] == pytest.approx(((ne - e) * want).sum())


def test_woe_constant_null_and_unseen(spark):
    df = spark.createDataFrame(
        [(1.0, None, "a", 1), (1.0, 2.0, "a", 0), (1.0, 3.0, None, 0)], "flat double, x double, k string, y int"
    )
    model = woe.WoeModel.fit(df, "y", numeric=["flat", "x"], categorical=["k"], bins=2)
    assert {r["feature"]: r["iv"] for r in model.iv_summary().collect()}["flat"] == 0.0
    other = spark.createDataFrame([(1.0, 99.0, "new"), (1.0, None, None)], "flat double, x double, k string")
    assert all(v is None for r in model.transform(other).collect() for v in r)
    assert all(v == 0.0 for r in model.transform(other, fill=0.0).collect() for v in r)


def test_woe_save_and_load(spark, credit, tmp_path):
    model = woe.WoeModel.fit(spark.createDataFrame(credit), "TARGET", numeric=["age"])
    model.save(str(tmp_path / "woe"))
    again = woe.WoeModel.load(spark, str(tmp_path / "woe"))
    assert again.numeric_bins() == model.numeric_bins()


def test_scorecard_points(spark, credit):
    model = woe.WoeModel.fit(spark.createDataFrame(credit), "TARGET", numeric=COLS, bins=5)
    pts = woe.scorecard_points(model.table, dict(zip([*COLS[:3], "absent"], (0.5, -0.3, 0.2, 0.1))), -1.5)
    assert pts.count() == 15 and {r["feature"] for r in pts.select("feature").distinct().collect()} == set(COLS[:3])


def test_scores(spark):
    df = spark.createDataFrame([(-2.0,), (-1.0,), (0.0,), (1.0,), (2.0,)], "lo double")
    points = [r[0] for r in df.select(scores.logodds_score(F.col("lo"))).collect()]
    assert points == sorted(points) and points[2] == 685
    p = spark.createDataFrame([(0.0,), (1.0,), (0.05,), (None,)], "p double")
    got = p.select(scores.prob_score(F.col("p")), scores.risk_tier(F.col("p")), scores.risk_tier(F.col("p"), True), scores.logit(F.col("p"))).collect()
    assert got[0][0] == 850 and got[1][0] == 300 and got[2][1] == "Medium" and got[2][2] == "Low" and tuple(got[3]) == (None,) * 4
    assert got[0][3] is not None


@pytest.mark.parametrize("bad, reason", [
    ({"age": "10"}, "age: too small"), ({"age": "150"}, "age: too large"), ({"income": "-5000"}, "income: too small"),
    ({"age": "thirty-five"}, "age: not int"), ({"income": None}, "income: missing"), ({"ext_source_1": "1.5"}, "ext_source_1: too large"),
    ({}, None),
])
def test_validation(spark, bad, reason):
    row = {"age": "35", "income": "50000", "loan_amount": "100000", "annuity": "5000", "ext_source_1": "0.5", **bad}
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} string" for k in row))
    got = scoring.validate(df).first()
    assert got["violations"] == ([reason] if reason else [])
    assert got["education_type"] == "Secondary" and got["goods_price"] == 0.0


def test_absent_required_column_is_a_violation(spark):
    df = spark.createDataFrame([("35",)], "age string")
    assert scoring.missing_required(df) == ["annuity", "income", "loan_amount"]
    assert "income: missing" in scoring.validate(df).first()["violations"]


def test_reason_codes_order_and_direction(spark):
    df = spark.createDataFrame([(1.0, 5.0, None)], "a double, b double, c double")
    codes = df.select(scoring.reason_codes({"a": 1.0, "b": -1.0, "c": 9.0}, {"a": 0.0, "b": 0.0, "c": 0.0}, 2)).first()[0]
    assert [(c["feature"], c["value"], c["direction"]) for c in codes] == [("b", -5.0, "decreases risk"), ("a", 1.0, "increases risk")]


def test_sources_round_trip(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "bureau_balance.csv").write_text("SK_ID_BUREAU,MONTHS_BALANCE,STATUS\n1,-1,C\n1,-2,0\n")
    (raw / "sample_submission.csv").write_text("a\n1\n")
    tables = readers.load_views(spark, str(raw))
    assert list(tables) == ["bureau_balance"] and dict(tables["bureau_balance"].dtypes)["SK_ID_BUREAU"] == "bigint"
    (tmp_path / "q.sql").write_text("SELECT count(*) AS n FROM bureau_balance;")
    assert readers.run_sql_file(spark, str(tmp_path / "q.sql")).first()["n"] == 2
    (tmp_path / "people.csv").write_text("age,income\n1,2\n")
    with pytest.raises(ValueError, match="annuity, loan_amount"):
        readers.read_applicants(spark, str(tmp_path / "people.csv"))


def test_comparison_json_shapes(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"m1": {"AUC": 0.7, "Gini": 0.4, "KS": 0.3}, "m2": {"AUC": 0.8, "Gini": 0.6, "KS": 0.4}}, indent=2))
    (tmp_path / "b.json").write_text(json.dumps([{"Model": "m1", "AUC-ROC": 0.7, "Gini": 0.4, "KS Statistic": 0.3}], indent=2))
    assert {r["model"]: r["auc"] for r in readers.read_comparison(spark, str(tmp_path / "a.json")).collect()} == {"m1": 0.7, "m2": 0.8}
    assert tuple(readers.read_comparison(spark, str(tmp_path / "b.json")).first()) == ("m1", 0.7, 0.4, 0.3)
    frame = spark.createDataFrame([("m1", 0.7, 0.4, 0.3), ("m2", 0.8, 0.6, 0.4)], "model string, auc double, gini double, ks double")
    writers.write_metrics(frame, str(tmp_path / "out"))
    assert readers.read_comparison(spark, str(tmp_path / "out")).count() == 2


def test_build_features_end_to_end(spark, sf_dir, tmp_path):
    from scoreloom.sources import roles

    raw = tmp_path / "raw"
    roles.application(spark, sf_dir).write.parquet(str(raw / "application_train.parquet"))
    roles.bureau(spark, sf_dir).write.parquet(str(raw / "bureau.parquet"))
    roles.previous_application(spark, sf_dir).write.parquet(str(raw / "previous_application.parquet"))
    roles.installments(spark, sf_dir).write.parquet(str(raw / "installments_payments.parquet"))
    build_features(spark, str(raw), str(tmp_path / "features"))
    df, cols = readers.load_features(spark, str(tmp_path / "features"))
    assert df.count() == roles.application(spark, sf_dir).count()
    assert "FREQ_NAME_INCOME_TYPE" in cols and "PAYMENT_DISCIPLINE" in cols and "MISS_bureau_loan_count" in cols
    assert all(t in ("bigint", "int", "double") for _, t in df.dtypes) and "NAME_INCOME_TYPE" not in cols


def test_all_column_pairs(spark):
    import numpy as np
    import pandas as pd

    from scoreloom.operators import metrics, profile

    rng = np.random.default_rng(4)
    x = pd.DataFrame(rng.normal(1e6, 1, (200, 55)), columns=[f"c{i}" for i in range(55)])
    x.iloc[:, 50] = x.iloc[:, 3] + 0.1 * x.iloc[:, 50]
    df = spark.createDataFrame(x)
    assert metrics.vif(df).count() == 55
    want = x.corr()
    got = profile.corr_pairs(df, list(x.columns)).toPandas()
    assert len(got) == 55 * 54 // 2 and all(abs(want.loc[r.left_feature, r.right_feature] - r.corr) < 1e-9 for r in got.itertuples())
    holes = x.mask(rng.random(x.shape) < 0.3).iloc[:, :35]
    miss = profile.comissing_pairs(spark.createDataFrame(holes.astype(object).where(holes.notna(), None)), list(holes.columns)).toPandas()
    assert len(miss) == 595
    assert all((holes[r.left_feature].isna() & holes[r.right_feature].isna()).sum() == r.both_missing for r in miss.itertuples())


def test_one_wide_column_leaves_the_others(spark, monkeypatch):
    from scoreloom.operators import lookups

    monkeypatch.setattr(lookups, "BROADCAST_ROWS", 10)
    table = spark.createDataFrame([("wide", str(i), float(i)) for i in range(50)] + [("narrow", c, 1.0) for c in "ab"], "feature string, category string, v double")
    look = lookups.CategoryLookup(table, "v")
    assert look._expression("narrow") is not None and look._expression("wide") is None
    df = spark.createDataFrame([("7", "a"), ("99", "z"), (None, None)], "wide string, narrow string")
    out = look.attach(df, {"wide": "w", "narrow": "n"}, "-1.0D").collect()
    assert {(r.w, r.n) for r in out} == {(7.0, 1.0), (-1.0, -1.0)}


def test_missing_amounts_give_no_flag(spark):
    from pyspark.sql import functions as F

    from scoreloom.functions.scores import affordability_flags

    df = spark.createDataFrame([(100.0, 10.0, None), (None, 10.0, 50.0)], "loan double, income double, goods double")
    flags = affordability_flags(F.col("loan"), F.col("income"), F.lit(1.0), F.col("goods"))
    rows = df.select(*[v.alias(k) for k, v in flags.items()]).collect()
    assert rows[0].credit_to_goods_flag is None and rows[1].loan_to_income_flag is None and rows[0].loan_to_income_flag == "High"


def test_drift_without_shared_columns(spark):
    from scoreloom.operators import monitoring

    a, b = spark.createDataFrame([(1.0,)], "a double"), spark.createDataFrame([(1.0,)], "b double")
    assert monitoring.drift_table(a, b).count() == 0


def test_bins_are_counted_without_copies_of_rows(spark):
    """Counts per bin equal the bins as expressions: edges, values outside, NULL, NaN and infinities; no row per feature."""
    from pyspark.sql import functions as F

    from scoreloom.operators import binning, woe

    values = [0.0, -0.0, 1.0, 1.5, 2.0, 3.0, 3.5, -9.0, None, float("nan"), float("inf"), float("-inf")]
    df = spark.createDataFrame([(i % 2 if i % 7 else None, v, i) for i, v in enumerate(values * 3)], "y int, a double, b long")
    edges = {"a": [0.0, 1.0, 2.0, 3.0], "b": [2.0, 20.0]}
    counted = woe.bin_counts(df, edges, "y")
    assert "Expand" not in counted._jdf.queryExecution().executedPlan().toString()
    got = {(r.feature, r.bin): (r.events, r.non_events) for r in counted.collect()}
    want = {}
    for f, e in edges.items():
        rows = df.where("y IS NOT NULL").select("y", binning.right_closed_bin(binning.number(f), e).alias("bin")).where("bin IS NOT NULL")
        want |= {(f, r.bin): (r.p, r.n) for r in rows.groupBy("bin").agg(F.expr("count_if(y = 1)").alias("p"), F.expr("count_if(y = 0)").alias("n")).collect()}
    assert got == want and len(got) == 4
    assert woe.bin_counts(df, {}, "y").count() == 0
