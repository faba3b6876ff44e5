"""Stored feature table to models, reports, scores and drift tables; every job as a command."""

import os
import subprocess
import sys

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from scoreloom.operators import models
from scoreloom.plans import jobs

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    rng = np.random.default_rng(5)
    n = 600
    a, b = rng.normal(size=n), rng.normal(size=n)
    y = (rng.random(n) < 1 / (1 + np.exp(-2 * a + b))).astype(int)
    pdf = pd.DataFrame({"SK_ID_CURR": range(n), "TARGET": y, "a": a, "b": b})
    path = str(tmp_path_factory.mktemp("jobs") / "features")
    spark.createDataFrame(pdf).write.parquet(path)
    return path


def test_train_evaluate_predict_and_psi(spark, data, tmp_path):
    out = str(tmp_path)
    small = {"boosted": models.boosted(max_iter=3, max_depth=2), "forest": models.forest(trees=4, max_depth=3)}
    jobs.train(spark, data, f"{out}/models", "scorecard")
    jobs.train(spark, data, f"{out}/models", "stacking", trees=small)
    report = {r.model: r for r in jobs.evaluate(spark, data, f"{out}/models", f"{out}/report").collect()}
    assert set(report) == {"scorecard", "stacking"} and all(r.auc > 0.7 for r in report.values())
    assert {"comparison", "overfit", "deciles", "gains", "roc", "calibration", "expected_loss", "vif"} <= set(os.listdir(f"{out}/report"))
    assert spark.read.parquet(f"{out}/report/overfit").count() == 2 and spark.read.parquet(f"{out}/report/deciles").select("model").distinct().count() == 2
    jobs.predict(spark, data, f"{out}/models", f"{out}/scored")
    scored = spark.read.parquet(f"{out}/scored")
    assert scored.count() == 600 and scored.where("credit_score BETWEEN 300 AND 850").count() == 600
    assert {r[0] for r in scored.select("recommendation").distinct().collect()} <= {"Approve", "Review", "Decline"}
    assert jobs.psi(spark, data, f"{out}/scored", f"{out}/psi").where("status = 'Stable'").count() == 2
    assert jobs.drift(spark, data, data, f"{out}/drift").count() == 2
    csv = f"{out}/applicants.csv"
    with open(csv, "w") as f:
        f.write("age,income,loan_amount,annuity\n30,1000,5000,100\n10,1000,5000,100\nx,1,1,1\n40,2000,1000,50\n")
    assert jobs.apply(spark, csv, f"{out}/models", f"{out}/applied", "stacking").first()["applications"] == 2
    bad = spark.read.parquet(f"{out}/applied/rejected").collect()
    assert len(bad) == 2 and all(r.violations for r in bad)


def test_folds_stay_when_rows_come(spark, data, tmp_path):
    more = str(tmp_path / "more")
    df = spark.read.parquet(data)
    df.unionByName(df.limit(1).selectExpr("9999999L AS SK_ID_CURR", "TARGET", "a", "b")).write.parquet(more)
    old, new = ({r.SK_ID_CURR: r.fold for r in jobs._folded(spark, p)[0].collect()} for p in (data, more))
    assert all(new[k] == f for k, f in old.items()) and set(old.values()) == set(range(5))


def test_fitted_encoder_reads_training_data_no_more(spark, data):
    from scoreloom.operators.woe import WoeModel

    df = spark.read.parquet(data).selectExpr("*", "IF(a > 0, 'p', 'n') AS sign")
    model = WoeModel.fit(df, "TARGET", numeric=["a", "b"], categorical=["sign"])
    other = spark.createDataFrame([(0.1, 0.2, "p")], "a double, b double, sign string")
    for frame in (model.transform(other), model.iv_summary(), model.table):
        assert data not in frame._jdf.queryExecution().optimizedPlan().toString() and "FileScan" not in frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("job", ["drift", "psi"])
def test_commands_start(data, tmp_path, job):
    out = str(tmp_path / job)
    conf = "--driver-memory 1g --conf spark.master=local[2] --conf spark.ui.enabled=false --conf spark.sql.shuffle.partitions=2 pyspark-shell"
    run = subprocess.run(
        [sys.executable, f"{ROOT}/run_job.py", job, "--baseline", data, "--current", data, "--output", out],
        env=os.environ | {"PYSPARK_SUBMIT_ARGS": conf}, cwd=str(tmp_path), capture_output=True, text=True, timeout=300,
    )
    assert run.returncode == 0, run.stderr[-2000:]
    assert any(f.endswith(".parquet") for f in os.listdir(out))


def test_stream_takes_the_newest_model(spark, data, tmp_path):
    """Rows scored as a stream equal those of ``predict``; a model published between batches serves the next one."""
    out, folder = str(tmp_path), str(tmp_path / "in")
    jobs.train(spark, data, f"{out}/models", "scorecard")
    assert models.publish(spark, f"{out}/registry", "scorecard", f"{out}/models/scorecard") == 1
    df = spark.read.parquet(data)
    df.where("SK_ID_CURR < 300").coalesce(1).write.parquet(folder)
    jobs.stream(spark, folder, f"{out}/registry", f"{out}/scored").awaitTermination()
    models.Linear({"a": 1.0}, -1.0).save(f"{out}/models/linear")
    assert models.publish(spark, f"{out}/registry", "linear", f"{out}/models/linear") == 2
    df.where("SK_ID_CURR >= 300").coalesce(1).write.mode("append").parquet(folder)
    jobs.stream(spark, folder, f"{out}/registry", f"{out}/scored").awaitTermination()
    got = spark.read.parquet(f"{out}/scored/rows")
    assert {r.model_version: r.n for r in got.groupBy("model_version").agg(F.count("*").alias("n")).collect()} == {1: 300, 2: 300}
    want = jobs.predict(spark, data, f"{out}/models", f"{out}/batch").select("SK_ID_CURR", "default_probability", "credit_score")
    first = got.where("model_version = 1").select("SK_ID_CURR", "default_probability", "credit_score")
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, want.where("SK_ID_CURR < 300").collect()))
    with pytest.raises(ValueError, match="no model"):
        models.load_version(spark, f"{out}/nothing")
