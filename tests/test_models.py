"""Training on a frame with real signal, persistence and the streaming forms."""

import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from scoreloom.operators import metrics, models, ranking, splits


@pytest.fixture(scope="module")
def train(spark):
    rng = np.random.default_rng(7)
    n = 800
    a, b, c = rng.normal(size=n), rng.normal(size=n), rng.normal(size=n)
    y = (rng.random(n) < 1 / (1 + np.exp(-(1.5 * a - b)))).astype(int)
    pdf = pd.DataFrame({"id": range(n), "y": y, "a": a, "b": b, "c": c})
    df = spark.createDataFrame(pdf).withColumn("b", F.when(F.col("id") % 13 != 0, F.col("b")))
    out = splits.stratified_folds(df, "id", "y", k=2).cache()
    out.count()
    return out


def test_logistic_matches_newton(spark):
    """|w|^2 / 2 + C * sum(loss), solved by hand."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 2))
    y = (rng.random(200) < 1 / (1 + np.exp(-x[:, 0]))).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "y": y}))
    vec = models._standardised(df, ["a", "b"], {"a": 0.0, "b": 0.0}, {"a": 1.0, "b": 1.0}, ["y"])
    got = models.fit_logistic(vec, "y", 0.5)
    w, z = np.zeros(3), np.column_stack([np.ones(200), x])
    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ w))
        grad = 0.5 * z.T @ (p - y) + np.array([0, w[1], w[2]])
        hess = 0.5 * (z.T * (p * (1 - p))) @ z + np.diag([0, 1.0, 1.0])
        w -= np.linalg.solve(hess, grad)
    assert [got.intercept, *got.coefficients] == pytest.approx(w, abs=1e-5)


def test_fits_share_a_pass(spark):
    """Several regularisations at once equal one at a time; separable classes and an empty frame end too."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 3))
    y = (x[:, 0] > 0).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "y": y, "w": rng.random(300)}))
    vec = models._standardised(df, ["a", "b"], {"a": 0.0, "b": 0.0}, {"a": 1.0, "b": 1.0}, ["y", "w"])
    cs = (0.01, 1.0, 100.0)
    together = models.fit_logistics(vec, "y", cs, "w")
    for c, fit in zip(cs, together):
        alone = models.fit_logistic(vec, "y", c, "w")
        assert [fit.intercept, *fit.coefficients] == pytest.approx([alone.intercept, *alone.coefficients], rel=1e-6, abs=1e-9)
    assert together[2].coefficients[0] > together[0].coefficients[0] > 0
    assert models.fit_logistic(vec.limit(0), "y", 1.0) == models.Logistic([], 0.0)


def test_scorecard(spark, train, tmp_path):
    card = models.train_scorecard(train, ["a", "b", "c"], "y", "id", c_grid=(0.1, 1.0), bins=5)
    assert {"a", "b"} <= set(card.coefficients) and card.cv.count() == 2
    assert card.cv.agg(F.min("auc")).first()[0] > 0.7
    scored = card.predict(train)
    assert scored.count() == 800 and ranking.discrimination(scored, models.PROB, "y").first()["auc"] > 0.75
    card.save(str(tmp_path / "card"))
    again = models.Scorecard.load(spark, str(tmp_path / "card")).predict(train)
    left, right = (d.orderBy("id").toPandas()[models.PROB].to_numpy() for d in (scored, again))
    assert left == pytest.approx(right)


def test_trees_stacking_and_persistence(spark, train, tmp_path):
    bases = {"boosted": models.boosted(max_iter=4, max_depth=3), "forest": models.forest(trees=5, max_depth=3)}
    stack = models.train_stacking(train, bases, ["a", "b", "c"], "y", "id")
    assert stack.cv.agg(F.min("auc")).first()[0] > 0.7
    out = stack.predict(train)
    assert out.where(F.col(models.PROB).between(0, 1)).count() == 800
    stack.bases["boosted"].save(str(tmp_path / "tree"))
    again = models.TreeModel.load(spark, str(tmp_path / "tree")).predict(train)
    assert metrics.compare_models(again, {"m": models.PROB}, "y").first()["auc"] > 0.75


def test_tier_and_gap_tables(spark):
    cv = spark.createDataFrame([("m", 0, 0.7), ("m", 1, 0.8)], "model string, fold int, auc double")
    hold = spark.createDataFrame([("m", 0.85)], "model string, auc double")
    row = metrics.overfit_gap(cv, hold).first()
    assert row["gap"] == pytest.approx(0.1) and row["status"] == "Check"


def test_checkpoint_folder_of_the_session_is_used(spark):
    from scoreloom.session import checkpoint_root, reliable

    assert checkpoint_root(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir").rstrip("/")
    assert reliable(spark.range(5)).count() == 5


def test_scorecard_reads_the_bins_of_all_rows_once(spark, train, monkeypatch):
    """One encoder per fold and one of all rows, which selects and is final; folds overlap."""
    fits, open_now, most = [], [], []
    fit, scaler = models.WoeModel.fit.__func__, models._scaler
    monkeypatch.setattr(models.WoeModel, "fit", classmethod(lambda cls, df, *a, **k: fits.append(1) or fit(cls, df, *a, **k)))

    def slow(*a):
        open_now.append(1)
        most.append(len(open_now))
        out = scaler(*a)
        time.sleep(1)
        open_now.pop()
        return out

    monkeypatch.setattr(models, "_scaler", slow)
    card = models.train_scorecard(train, ["a", "b", "c"], "y", "id", c_grid=(0.1, 1.0), bins=5)
    assert len(fits) == 3 and max(most) == 2
    again = models.fit_scorecard(train, list(card.coefficients), "y", card.best_c, 5)
    assert card.coefficients == pytest.approx(again.coefficients) and card.intercept == pytest.approx(again.intercept)


def test_learners_share_the_filling(spark, train, monkeypatch):
    """Medians are found once per fold and once of all rows, not once per learner."""
    calls, medians = [], models.medians
    monkeypatch.setattr(models, "medians", lambda *a: calls.append(1) or medians(*a))
    bases = {"boosted": models.boosted(max_iter=2, max_depth=2), "forest": models.forest(trees=2, max_depth=2)}
    stack = models.train_stacking(train, bases, ["a", "b", "c"], "y", "id")
    assert len(calls) == 3 and set(stack.bases) == set(bases)
    alone = models.fit_tree(train, bases["boosted"], ["a", "b", "c"], "y", "id")
    assert alone.model.toDebugString == stack.bases["boosted"].model.toDebugString.replace(stack.bases["boosted"].model.uid, alone.model.uid)
