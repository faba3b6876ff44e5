"""Exact ranking against brute force: ties, hot values, one-class groups, negative and extreme values."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from scoreloom.operators import binning, features, metrics, monitoring, profile, ranking, splits


def brute_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))


def brute_ks(y, s):
    return max(0.0, max((s[y == 1] >= t).mean() - (s[y == 0] >= t).mean() for t in np.unique(s)))


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(42)
    n = 1000
    x = np.where(np.arange(n) % 3 == 0, 0.25, np.round(rng.normal(0, 50, n), 1))  # one value holds a third
    y = (rng.random(n) < 1 / (1 + np.exp(-x / 40))).astype(int)
    return pd.DataFrame({"y": y, "s": x, "g": np.where(np.arange(n) < 700, "big", "small")})


def test_auc_ks_match_brute_force(spark, frame):
    row = ranking.discrimination(spark.createDataFrame(frame), "s", "y").first()
    y, s = frame["y"].to_numpy(), frame["s"].to_numpy()
    assert row["auc"] == pytest.approx(brute_auc(y, s), abs=1e-12)
    assert row["ks"] == pytest.approx(brute_ks(y, s), abs=1e-12)
    assert -1 <= row["gini"] <= 1 and 0 <= row["ks"] <= 1


def test_grouped_auc_and_one_class_group(spark, frame):
    extra = pd.DataFrame({"y": [1, 1], "s": [0.1, 0.2], "g": ["one", "one"]})
    df = spark.createDataFrame(pd.concat([frame, extra]))
    got = {r["g"]: r["auc"] for r in ranking.discrimination(df, "s", "y", ["g"]).collect()}
    for g, part in frame.groupby("g"):
        assert got[g] == pytest.approx(brute_auc(part["y"].to_numpy(), part["s"].to_numpy()), abs=1e-12)
    assert got["one"] is None


def test_perfect_model(spark):
    df = spark.createDataFrame(list(zip([0, 0, 0, 1, 1, 1], [.1, .2, .3, .7, .8, .9])), "y int, p double")
    row = ranking.discrimination(df, "p", "y").first()
    assert (row["auc"], row["gini"], row["ks"]) == (1.0, 1.0, 1.0)


def test_value_cell_is_monotone(spark):
    v = sorted([0.0, -1e300, 1e300, -1e-300, 1e-300, 5e-324, math.inf, -math.inf, 1.0, -1.0, 0.999999, 1.000001, 123.4, -123.4])
    rows = spark.createDataFrame([(x,) for x in v], "x double").select("x", ranking.value_cell(F.col("x")).alias("c")).collect()
    cells = [r["c"] for r in sorted(rows, key=lambda r: r["x"])]
    assert cells == sorted(cells)


def test_exact_quantiles_match_numpy(spark, frame):
    pdf = frame.assign(const=3.5, empty=np.nan)
    df = spark.createDataFrame(pdf).withColumn("empty", F.lit(None).cast("double"))
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {r["feature"]: r["edges"] for r in ranking.exact_quantiles(df, ["s", "const", "empty"], probs).collect()}
    assert got["s"] == pytest.approx(np.quantile(frame["s"], probs), abs=1e-12)
    assert got["const"] == [3.5] * 6 and "empty" not in got
    keyed = ranking.exact_quantiles(df, ["s"], [0.5], ["g"]).collect()
    assert {r["g"]: r["edges"][0] for r in keyed} == pytest.approx(frame.groupby("g")["s"].median().to_dict())


def test_approx_quantiles_same_shape(spark, frame):
    got = {r["feature"]: r["edges"] for r in ranking.approx_quantiles(spark.createDataFrame(frame), ["s"], [0.1, 0.5]).collect()}
    assert got["s"] == pytest.approx(np.quantile(frame["s"], [0.1, 0.5]), abs=1.0)


def test_quantile_bins_match_pandas(spark, frame):
    pdf = frame[["s"]]
    out = binning.quantile_bins(spark.createDataFrame(pdf), ["s"], 10).toPandas()
    want = pd.qcut(pdf["s"], 10, labels=False, duplicates="drop")
    assert (out.sort_values("s")["s_bin"].to_numpy() == want[pdf["s"].sort_values().index].to_numpy()).all()


def test_equal_width_matches_numpy(spark):
    x = np.round(np.random.default_rng(1).random(500), 2)
    got = spark.createDataFrame([(float(v),) for v in x], "x double").select(
        binning.equal_width_bin("x", 0.0, 1.0, 10).alias("b")).groupBy("b").count().toPandas().set_index("b")["count"]
    want = np.histogram(x, np.linspace(0, 1, 11))[0]
    assert [int(got.get(i, 0)) for i in range(10)] == list(want)


def test_decile_table(spark, frame):
    dec = metrics.decile_table(spark.createDataFrame(frame), "s", "y").orderBy("decile").toPandas()
    assert len(dec) <= 10 and dec["decile"].tolist() == list(range(1, len(dec) + 1))
    assert dec["cumul_bad_pct"].iloc[-1] == pytest.approx(1.0) and dec["count"].sum() == len(frame)


def test_psi_identical_shifted_constant(spark):
    rng = np.random.default_rng(0)
    few = [1.0] * 40 + [None] * 4960
    base, moved = (
        features.nan_to_null(spark.createDataFrame(pd.DataFrame({"x": rng.normal(m, 1, 5000), "c": 1.0, "few": few}))) for m in (0, 2)
    )
    same = monitoring.psi_score(base, base, "x").first()
    assert same["psi"] < 0.01 and same["status"] == "Stable"
    got = {r["feature"]: r for r in monitoring.psi_features(base, moved, ["x", "c", "few"]).collect()}
    assert got["x"]["psi"] > 0.25 and "ALERT" in got["x"]["status"]
    assert got["c"]["psi"] == 0 and "few" not in got


def test_psi_without_shared_columns_is_empty(spark):
    a, b = spark.createDataFrame([(1.0,)], "a double"), spark.createDataFrame([(1.0,)], "b double")
    assert monitoring.psi_features(a, b).count() == 0


def test_expected_loss(spark):
    zero = spark.createDataFrame([(0.0,)] * 100, "p double")
    assert metrics.expected_loss(zero, "p", 10000.0).first()["total_expected_loss"] == 0
    p = spark.createDataFrame([(.1,), (.2,), (.3,)], "p double")
    low, high = (metrics.expected_loss(p, "p", 1.0, lgd).first() for lgd in (0.2, 0.6))
    assert high["total_expected_loss"] > low["total_expected_loss"] and 0 <= high["el_rate"] <= 1


def test_vif(spark, frame):
    rng = np.random.default_rng(3)
    a = rng.normal(size=400)
    pdf = pd.DataFrame({"a": a, "b": a + rng.normal(size=400), "c": rng.normal(size=400), "flat": 1.0})
    got = {r["feature"]: r["vif"] for r in metrics.vif(spark.createDataFrame(pdf)).collect()}
    want = np.diag(np.linalg.inv(np.corrcoef(pdf[["a", "b", "c"]].T)))
    assert set(got) == {"a", "b", "c"} and all(v >= 1 for v in got.values())
    assert [got[k] for k in "abc"] == pytest.approx(want, abs=0.006)


def test_two_sample_ks(spark, frame):
    row = profile.ks_two_sample(spark.createDataFrame(frame), ["s"], "y").first()
    a, b = (np.sort(frame.loc[frame["y"] == k, "s"].to_numpy()) for k in (0, 1))
    grid = np.unique(frame["s"])
    want = np.abs(np.searchsorted(a, grid, "right") / len(a) - np.searchsorted(b, grid, "right") / len(b)).max()
    assert row["ks"] == pytest.approx(want)


def test_splits_are_stratified_and_stable(spark):
    df = spark.range(1000).selectExpr("id", "CASE WHEN id % 10 = 0 THEN 1 WHEN id % 97 = 1 THEN NULL ELSE 0 END AS y")
    parts = splits.stratified_split(df, "id", "y")
    assert parts.count() == 1000
    by = {r["y"]: (r["n"], r["t"]) for r in parts.groupBy("y").agg(F.count("*").alias("n"), F.sum("is_test").alias("t")).collect()}
    assert by[1] == (100, 20) and all(t == round(n * 0.2) for n, t in by.values())
    folds = splits.stratified_folds(df, "id", "y").groupBy("fold").agg(F.count_if(F.col("y") == 1).alias("p")).collect()
    assert [r["p"] for r in folds] == [20] * 5
    again = splits.stratified_split(df.repartition(7), "id", "y")
    assert parts.join(again, ["id", "is_test"]).count() == 1000


def test_crowded_cells_are_split(spark, monkeypatch):
    from pyspark.sql import functions as F

    from scoreloom.operators import ranking

    monkeypatch.setattr(ranking, "CELL_ROWS", 100)
    secs = spark.range(5000).select((F.col("id") * 397 % 5000 + 1_700_000_000).alias("x"))
    cells = ranking.with_cells(secs, [], "x")
    assert cells.groupBy("_cell").count().agg(F.max("count")).first()[0] <= 110
    ranks = ranking.cumulate(secs, [], "x", {"n": F.lit(1)})
    assert ranks.where(F.col("n_before") != F.col("x") - 1_700_000_000).count() == 0 and ranks.count() == 5000
    names = secs.select(F.format_string("Customer#%09d", F.col("x")).alias("x"))
    assert ranking.with_cells(names, [], "x").select("_cell").distinct().count() > 20
    r = ranking.cumulate(names, [], "x", {"n": F.lit(1)})
    assert r.where("n_before != int(substr(x, 10)) - 1700000000").count() == 0
    edges = ranking.exact_quantiles(secs, ["x"], [0.0, 0.5, 1.0]).first().edges
    assert edges == [1_700_000_000.0, 1_700_002_499.5, 1_700_004_999.0]


def test_cells_settle_in_a_dense_cluster(spark, monkeypatch):
    """Values that crowd again inside a slice of a crowded cell, a hot value among them, and long integers beyond 2**53."""
    monkeypatch.setattr(ranking, "CELL_ROWS", 100)
    x = np.r_[np.linspace(0.5, 0.50001, 1500), 0.5 + 1e-12 * np.arange(1500), np.full(700, 0.500003), 0.9]
    df = spark.createDataFrame(pd.DataFrame({"x": x}))
    cells = ranking.settled_cells(df, [], "x")
    large = cells.table.where("_rows > 110").collect()
    assert [(r["_first"], r["_last"]) for r in large] == [(0.500003, 0.500003)]
    got = ranking.cumulate(df, [], "x", {"n": F.lit(1)}).toPandas()
    values, counts = np.unique(x, return_counts=True)
    got = got.sort_values("x")
    assert got["x"].tolist() == values.tolist() and got["n"].tolist() == counts.tolist()
    assert got["n_before"].tolist() == (np.cumsum(counts) - counts).tolist() and set(got["n_all"]) == {len(x)}
    big = spark.range(400).selectExpr("9007199254740992 + id AS x")
    ranks = ranking.cumulate(big, [], "x", {"n": F.lit(1)})
    assert ranks.count() == 400 and ranks.where("n_before <> x - 9007199254740992").count() == 0


def test_values_are_exchanged_once(spark, frame):
    """Grouping by value and order inside the cell share one exchange; every other exchange is over the cell table."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = ranking.cumulate(spark.createDataFrame(frame), ["g"], "s", {"n": F.lit(1)})._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    dealt = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert sum("REPARTITION_BY_COL" in line for line in dealt) == 1
    assert not any("ENSURE_REQUIREMENTS" in line and " s#" in line.split("hashpartitioning")[1] for line in dealt)


def test_bounds(spark, monkeypatch):
    monkeypatch.setattr(ranking, "CELL_ROWS", 20)
    df = spark.range(1000).selectExpr("id % 3 AS k", "id * 7919 % 1000 AS x")
    got = {r.k: r.bound for r in ranking.bounds(df, ["k"], "x", "10").collect()}
    rows = [(r.k, r.x) for r in df.collect()]
    assert got == {k: sorted(x for j, x in rows if j == k)[9] for k in range(3)}
    assert ranking.bounds(df, ["k"], "x", "0").count() == 0
    all_rows = {r.k: r.bound for r in ranking.bounds(df, ["k"], "x", "_all + 5").collect()}
    assert all_rows == {k: max(x for j, x in rows if j == k) for k in range(3)}
    ties = spark.createDataFrame([(0.5,)] * 60 + [(0.7,)], "x double")
    assert ranking.bounds(ties, [], "x", "3").first().bound == 0.5


def test_segments_without_copies(spark, frame):
    """One ranking serves all segment values and agrees with ranking every segment by itself; many values fall back to that."""
    df = spark.createDataFrame(frame).withColumn("h", F.when(F.col("s") > 0, "up").otherwise(F.when(F.col("s") < -20, "down")))
    out = metrics.segment_performance(df, ["g", "h", "absent"], {"m": "s", "r": "y"}, "y")
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Expand") == 1
    got = {(r.model, r.segment, r.segment_value): (r.n, r.auc) for r in out.collect()}
    for seg in "gh":
        for v, auc in ((r[seg], r["auc"]) for r in ranking.discrimination(df.where(F.col(seg).isNotNull()), "s", "y", [seg]).collect()):
            assert got["m", seg, v][1] == pytest.approx(auc, abs=1e-4) and got["r", seg, v][1] == 1.0
    many = df.withColumn("t", (F.monotonically_increasing_id() % 90).cast("string"))
    assert metrics.segment_performance(many, ["t"], {"m": "s"}, "y").count() > 60


def test_drift_of_columns_together(spark):
    rng = np.random.default_rng(4)
    a = pd.DataFrame({"x": rng.normal(1e6, 1, 700), "c": 1.0, "h": np.where(np.arange(700) % 2 == 0, np.nan, rng.random(700)), "none": np.nan})
    b = pd.DataFrame({"x": rng.normal(1e6 + 1, 2, 900), "c": 1.0, "h": rng.random(900), "none": np.nan})
    out = monitoring.drift_table(*(spark.createDataFrame(d) for d in (a, b)))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand") <= 2
    got = {r.feature: r for r in out.collect()}
    for c in "xch":
        r, p, q = got[c], a[c].dropna(), b[c].dropna()
        want = (p.mean(), p.std(), p.min(), p.max(), a[c].isna().mean(), q.mean(), q.std(), q.min(), q.max(), b[c].isna().mean())
        assert [r[f"{m}_{t}"] for t in ("base", "cur") for m in ("mean", "std", "min", "max", "missing")] == pytest.approx(want, rel=1e-9, abs=1e-9)
        grid = np.unique(np.r_[p, q])
        gap = np.abs(np.searchsorted(np.sort(p), grid, "right") / len(p) - np.searchsorted(np.sort(q), grid, "right") / len(q)).max()
        assert r.ks == pytest.approx(gap) and (r.distinct_base, r.distinct_cur) == (p.nunique(), q.nunique())
    psi = {r.feature: r.psi for r in monitoring.psi_features(*(features.nan_to_null(spark.createDataFrame(d)) for d in (a, b)), list("xch"), min_rows=1).collect()}
    assert {c: got[c].psi for c in "xch"} == psi
    assert got["none"].psi is None and got["none"].missing_cur == 1.0 and got["none"].ks is None


def test_overlap_within_reach(spark, frame):
    """Kernels cut at their reach add up to what all kernels on the whole grid do."""
    rng = np.random.default_rng(2)
    s = np.r_[rng.normal(0.2, 0.01, 2000), rng.normal(0.23, 0.01, 500)]
    y = np.r_[np.zeros(2000), np.ones(500)].astype(int)
    got = metrics.score_overlap(spark.createDataFrame(pd.DataFrame({"s": s, "y": y})), {"m": "s"}, "y").first().overlap
    grid = np.linspace(0, 1, 1000)
    f = []
    for k in (0, 1):
        x = s[y == k]
        h = x.std(ddof=1) * len(x) ** -0.2
        f.append(np.exp(-0.5 * ((grid[:, None] - x) / h) ** 2).sum(1) / (len(x) * h * np.sqrt(2 * np.pi)))
    assert got == pytest.approx(np.trapezoid(np.minimum(*f), grid), rel=1e-9)


def test_nan_counts_as_null(spark):
    from scoreloom.operators import ranking

    df = spark.createDataFrame([(0.1, 0), (float("nan"), 1), (0.9, 1), (None, 0), (0.2, 0)], "s double, y int")
    assert ranking.discrimination(df, "s", "y").first().auc == 1.0
    assert ranking.exact_quantiles(df, ["s"], [0.5]).first().edges == [0.2]


def test_ordered_split_by_time_and_text(spark):
    from pyspark.sql import functions as F

    from scoreloom.operators import splits

    df = spark.range(100).select(F.col("id"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(id)").alias("t"), F.format_string("k%05d", F.col("id")).alias("s"))
    df = df.withColumn("d", F.col("t").cast("date"))
    for c in ("t", "s", "d"):
        assert {r.id for r in splits.ordered_split(df, c).where("is_test = 1").collect()} == set(range(80, 100))


def test_ranking_tasks_are_sized_by_rows(spark, monkeypatch):
    """Equal rows compress to next to nothing, so the number of parts follows the rows and is not merged by bytes."""
    monkeypatch.setattr(ranking, "TASK_ROWS", 1000)
    df = spark.range(9500).selectExpr("cast(id % 400 as double) AS s", "cast(id % 2 as int) AS y")
    ranked = ranking.ranked_scores(df, [], "s", "y")
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and ", 10), REPARTITION_BY_NUM" in plan
    assert (ranked.count(), ranked.selectExpr("sum(pos + neg)").first()[0]) == (400, 9500)


def test_quantiles_of_columns_are_counted_where_the_rows_are(spark, monkeypatch):
    """Without keys no row is copied per feature; close values, ties, signs, infinities and several passes stay exact."""
    rng = np.random.default_rng(5)
    n = 3000
    pdf = pd.DataFrame({
        "near": 1e9 + rng.normal(size=n) * 1e-3, "signed": rng.normal(size=n), "tied": rng.integers(-3, 4, n).astype(float),
        "wide": rng.normal(size=n) * 10.0 ** rng.integers(-200, 200, n), "holes": np.where(rng.random(n) < 0.5, np.nan, rng.random(n)),
        "ends": rng.choice([-np.inf, -0.0, 0.0, 1.0, np.inf], n, p=[0.04, 0.3, 0.3, 0.32, 0.04]),
    })
    df = spark.createDataFrame(pdf).repartition(3)
    monkeypatch.setattr(ranking, "settled_cells", None)  # the way with keys
    monkeypatch.setattr(ranking, "LISTED_ROWS", 50)
    monkeypatch.setattr(ranking, "MERGED_CELLS", 20)
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {r["feature"]: r["edges"] for r in ranking.exact_quantiles(df, list(pdf), probs).collect()}
    assert got.pop("ends")[1:5] == [0.0, 0.0, 0.0, 1.0]
    for name, edges in got.items():
        assert edges == pytest.approx(np.quantile(pdf[name].dropna(), probs), rel=1e-13), name
