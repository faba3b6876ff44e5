"""Batch jobs, started as ``spark-submit run_job.py JOB ...`` from the repository root.

    features --input RAW --output FEATURES [--store STORE]
    train    --data FEATURES --output MODELS [--model scorecard|boosted|forest|stacking|all] [--grid]
    evaluate --data FEATURES --models MODELS --output REPORT
    predict  --input FEATURES --models MODELS --output SCORED [--model NAME]
    apply    --input APPLICANTS.csv --models MODELS --output OUT [--model NAME]
    publish  --models MODELS --model NAME --output REGISTRY
    stream   --input FEATURES_FOLDER --models REGISTRY --output SCORED
    psi      --baseline A --current B --output PSI
    drift    --baseline A --current B --output DRIFT
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.operators import features as feature_ops
from scoreloom.operators import metrics, models, monitoring, scoring, splits
from scoreloom.operators.ranking import roc_points
from scoreloom.plans.features import build_features
from scoreloom.session import build_session, reliable
from scoreloom.sources import readers, writers
from scoreloom.streaming import score as stream_score

KEY, TARGET = "SK_ID_CURR", "TARGET"
FOLDS = 5
TREES = {"boosted": models.boosted, "forest": models.forest}
KINDS = {k: v for k, v in models.KINDS.items() if k != "linear"}


def _folded(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """Feature table with folds by a hash of the key: a row keeps its fold whatever rows come or go."""
    df, features = readers.load_features(spark, path)
    return reliable(splits.hash_folds(df, KEY, FOLDS)), features


def train(
    spark: SparkSession, data: str, output: str, model: str = "all", holdout_fold: int | None = 4, grid: bool = False,
    trees: dict | None = None,
) -> None:
    """Fit and store models; rows of ``holdout_fold`` are kept away so that ``evaluate`` judges unseen rows.

    ``grid`` searches depth and step of the boosted model first. Every model stores its cross-validated metrics.
    """
    trees = dict(trees or {name: make() for name, make in TREES.items()})
    df, features = _folded(spark, data)
    if holdout_fold is not None:
        df = df.where(F.col("fold") != holdout_fold)
    wanted = set(KINDS) if model == "all" else {model}
    if "scorecard" in wanted:
        card = models.train_scorecard(df, features, TARGET, KEY)
        card.save(f"{output}/scorecard")
        writers.write_metrics(card.cv, f"{output}/scorecard/cv")
        writers.write_table(card.woe.iv_summary(), f"{output}/scorecard/iv_summary")
    if grid and wanted & {"boosted", "stacking"}:
        table = reliable(models.grid_search(df.withColumn("fold", F.col("fold") % F.lit(holdout_fold or FOLDS)), features, TARGET, KEY))
        writers.write_table(table, f"{output}/grid")
        best = table.orderBy(F.desc("mean_auc"), "max_depth", "step_size").first()
        trees["boosted"] = models.boosted(max_depth=best["max_depth"], step=best["step_size"])
    for name, estimator in trees.items():
        if name in wanted:
            models.fit_tree(df, estimator, features, TARGET, KEY).save(f"{output}/{name}")
            oof = models.out_of_fold(df, {name: estimator}, features, TARGET, KEY)
            writers.write_metrics(models.fold_metrics(oof, TARGET), f"{output}/{name}/cv")
    if "stacking" in wanted:
        stack = models.train_stacking(df, trees, features, TARGET, KEY)
        stack.save(f"{output}/stacking")
        writers.write_metrics(stack.cv, f"{output}/stacking/cv")


def _load(spark: SparkSession, models_dir: str, names=tuple(KINDS)) -> dict:
    """Stored models by name; asking for one by name that is not there is an error."""
    found = {}
    for name in names:
        try:
            found[name] = KINDS[name].load(spark, f"{models_dir}/{name}")
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(e) or len(names) == 1:
                raise
    if not found:
        raise ValueError(f"no model below {models_dir}")
    return found


def evaluate(spark: SparkSession, data: str, models_dir: str, output: str, holdout_fold: int = 4) -> DataFrame:
    """Report of every stored model on the held-out fold.

    Tables below ``output``: comparison, overfit, deciles, gains, roc, expected_loss, calibration, segments, vif.
    """
    df, features = _folded(spark, data)
    scored = df.where(F.col("fold") == holdout_fold)
    columns, cv = {}, None
    for name, model in _load(spark, models_dir).items():
        scored = model.predict(scored, f"p_{name}")
        columns[name] = f"p_{name}"
        part = spark.read.schema("fold int, auc double").json(f"{models_dir}/{name}/cv").withColumn("model", F.lit(name))
        cv = part if cv is None else cv.unionByName(part)
    scored = reliable(scored)
    comparison = reliable(metrics.compare_models(scored, columns, TARGET))
    writers.write_metrics(comparison, f"{output}/comparison")
    writers.write_table(metrics.overfit_gap(cv, comparison), f"{output}/overfit")
    for name, column in columns.items():
        deciles = reliable(metrics.decile_table(scored, column, TARGET))
        writers.write_table(deciles, f"{output}/deciles/model={name}")
        writers.write_table(metrics.gains_lift(deciles), f"{output}/gains/model={name}")
        writers.write_table(roc_points(scored, column, TARGET), f"{output}/roc/model={name}")
        writers.write_table(metrics.calibration(scored, column, TARGET), f"{output}/calibration/model={name}")
        exposure = "AMT_CREDIT" if "AMT_CREDIT" in scored.columns else 1.0
        writers.write_table(metrics.expected_loss(scored, column, exposure), f"{output}/expected_loss/model={name}")
    segments = [f.name for f in scored.schema.fields if f.dataType.simpleString() == "string"]
    if segments:
        writers.write_table(metrics.segment_performance(scored, segments, columns, TARGET), f"{output}/segments")
    numeric = [f for f in features if f in feature_ops.numeric_columns(scored)]
    writers.write_table(metrics.vif(scored, numeric).orderBy(F.desc("vif"), "feature"), f"{output}/vif")
    return comparison


def predict(spark: SparkSession, source: str, models_dir: str, output: str, model: str = "scorecard") -> DataFrame:
    """Score a stored feature table."""
    df = readers.read_any(spark, source)
    scored = _load(spark, models_dir, (model,))[model].predict(df, "p")
    out = scoring.decide(scored, "p").drop("p")
    writers.write_table(out, output)
    return out


def apply(spark: SparkSession, source: str, models_dir: str, output: str, model: str = "scorecard", profile: str = "form") -> DataFrame:
    """Applicant CSV to ``scored``, ``rejected`` (with what is wrong in each row) and ``summary``.

    The line order is kept as ``applicant``; features that the model knows and the form does not are missing values
    for trees and carry no evidence in the scorecard.
    """
    raw = readers.read_applicants(spark, source).withColumn("applicant", F.monotonically_increasing_id())
    good, bad = scoring.split_valid(reliable(scoring.validate(raw, keep=["applicant"])))
    fitted = _load(spark, models_dir, (model,))[model]
    made = scoring.request_features(good, keep=["applicant"], profile=profile)
    lacking = [f for f in fitted.inputs() if f not in made.columns]
    made = made.withColumns({f: F.lit(None).cast("double") for f in lacking})
    scored = reliable(scoring.decide(fitted.predict(made, "p"), "p").select("applicant", "default_probability", "credit_score", "risk_tier", "recommendation"))
    writers.write_table(scored, f"{output}/scored")
    writers.write_table(bad.select("applicant", "violations"), f"{output}/rejected")
    summary = scoring.batch_summary(scored)
    writers.write_metrics(summary, f"{output}/summary")
    return summary


def stream(spark: SparkSession, source: str, registry: str, output: str, available_now: bool = True):
    """Score a growing folder of feature tables with the newest published model of each batch; returns the running query."""
    schema = spark.read.parquet(source).schema
    rows = spark.readStream.schema(schema).parquet(source)
    return stream_score.start_model_stream(rows, registry, f"{output}/rows", f"{output}/state", available_now=available_now)


def psi(spark: SparkSession, baseline: str, current: str, output: str) -> DataFrame:
    out = monitoring.psi_features(*readers.read_pair(spark, baseline, current))
    writers.write_table(out, output)
    return out


def drift(spark: SparkSession, baseline: str, current: str, output: str) -> DataFrame:
    out = monitoring.drift_table(*readers.read_pair(spark, baseline, current))
    writers.write_table(out, output)
    return out


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="run_job.py")
    parser.add_argument("job", choices=["features", "train", "evaluate", "predict", "apply", "publish", "stream", "psi", "drift"])
    for name in ("input", "output", "data", "models", "baseline", "current", "store"):
        parser.add_argument(f"--{name}")
    parser.add_argument("--model", default=None)
    parser.add_argument("--grid", action="store_true")
    a = parser.parse_args(argv)
    spark = build_session(f"scoreloom-{a.job}")
    if a.job == "features":
        build_features(spark, a.input, a.output, store=a.store)
    elif a.job == "train":
        train(spark, a.data, a.output, a.model or "all", grid=a.grid)
    elif a.job == "evaluate":
        evaluate(spark, a.data, a.models, a.output).show()
    elif a.job == "predict":
        predict(spark, a.input, a.models, a.output, a.model or "scorecard")
    elif a.job == "apply":
        apply(spark, a.input, a.models, a.output, a.model or "scorecard").show()
    elif a.job == "publish":
        kind = a.model or "scorecard"
        print(models.publish(spark, a.output, kind, f"{a.models}/{kind}"))
    elif a.job == "stream":
        stream(spark, a.input, a.models, a.output).awaitTermination()
    elif a.job == "psi":
        psi(spark, a.baseline, a.current, a.output).orderBy(F.desc("psi")).show(12)
    else:
        drift(spark, a.baseline, a.current, a.output)


if __name__ == "__main__":
    main()
