"""Training, cross-validation and ensembling on Spark ML.

Every trainer works on a frame with a ``fold`` column. Predictions of all folds are stacked into one
out-of-fold frame, so the fold metrics of a model are a single grouped query.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from .features import medians
from .ranking import discrimination
from .scoring import linear_logit, linear_probability
from .splits import balanced_weight, positive_weight
from .woe import WoeModel, fold_scaler

# Regularisation grid of the scorecard.
C_GRID = (0.001, 0.01, 0.05, 0.1, 0.5, 1.0, 5.0)
IV_FLOOR = 0.02
PROB = "probability_1"
FITS_AT_ONCE = 2  # folds or models whose jobs share the executors; their frames are cached at the same time


def _at_once(run, items) -> list:
    """Results of ``run`` in the order of the items, a few of them at a time, so that their many short jobs overlap."""
    items = list(items)
    with ThreadPoolExecutor(max(1, min(FITS_AT_ONCE, len(items)))) as pool:
        return list(pool.map(inheritable_thread_target(SparkSession.getActiveSession())(run), items))


def _folds(df: DataFrame, fold: str) -> list:
    return sorted(r[0] for r in df.select(fold).distinct().collect())


def _stack(parts) -> DataFrame | None:
    out = None
    for part in parts:
        out = part if out is None else out.unionByName(part)
    return out


def fold_metrics(oof: DataFrame, target: str, score: str = PROB) -> DataFrame:
    """AUC, Gini and KS per (model, fold)."""
    return discrimination(oof, score, target, ["model", "fold"])


def _scaler(df: DataFrame, features: list[str]) -> tuple[dict[str, float], dict[str, float]]:
    """Mean and population standard deviation of every feature from one aggregate; a flat feature scales by 1."""
    row = df.agg(*[
        x for i, f in enumerate(features) for x in (F.avg(f).alias(f"m{i}"), F.stddev_pop(f).alias(f"s{i}"))
    ]).first()
    return (
        {f: float(row[f"m{i}"] or 0.0) for i, f in enumerate(features)},
        {f: float(row[f"s{i}"] or 0.0) or 1.0 for i, f in enumerate(features)},
    )


def _standardised(df: DataFrame, features: list[str], means, stds, keep: list[str]) -> DataFrame:
    return df.select(*keep, F.array(*[((F.col(f) - means[f]) / stds[f]).cast("double") for f in features]).alias("vec"))


class Logistic(NamedTuple):
    coefficients: list[float]
    intercept: float


def gram_sums(df: DataFrame, target: str, weight: str | None, beta: np.ndarray) -> np.ndarray:
    """Per row of ``beta`` (intercept first): weighted loss, gradient and the upper triangle of the Hessian, over all rows.

    Tasks multiply blocks of rows as matrices and emit one row per number; the numbers are added up by Spark.
    """
    models, k = beta.shape
    upper = np.triu_indices(k)

    def run(batches):
        out = np.zeros((models, 1 + k + len(upper[0])))
        for batch in batches:
            vec, y, w = (batch.column(i) for i in range(3))
            x = np.column_stack([np.ones(batch.num_rows), vec.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, k - 1)])
            y, w = y.to_numpy(zero_copy_only=False)[:, None], w.to_numpy(zero_copy_only=False)[:, None]
            z = x @ beta.T
            p = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
            out[:, 0] += (w * (np.logaddexp(0, z) - y * z)).sum(0)
            out[:, 1 : k + 1] += (w * (p - y)).T @ x
            for i, s in enumerate((w * p * (1 - p)).T):
                out[i, k + 1 :] += ((x * s[:, None]).T @ x)[upper]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(out.size)), pa.array(out.ravel())], names=["i", "v"])

    rows = df.select("vec", F.col(target).cast("double").alias("y"), (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("w"))
    sums = rows.where("y IS NOT NULL").mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(models * (1 + k + len(upper[0])))
    for i, v in sums:
        out[i] = v
    return out.reshape(models, -1)


def fit_logistics(df: DataFrame, target: str, cs, weight: str | None = None, max_iter: int = 50, tol: float = 1e-8) -> list[Logistic]:
    """Logistic regressions minimising |w|^2 / 2 + C * sum(weight * loss) over the ``vec`` column, one for each C.

    Newton steps, halved whenever the objective rose; one pass over the rows serves a step of all of them.
    """
    first = df.select(F.size("vec")).first()
    k = 1 + (first[0] if first else 0)
    upper = np.triu_indices(k)
    ridge = np.r_[0.0, np.ones(k - 1)]
    beta = np.zeros((len(cs), k))
    best, low, open_ = beta.copy(), np.full(len(cs), np.inf), np.ones(len(cs), bool)
    for _ in range(max_iter):
        at = np.flatnonzero(open_)
        for i, row in zip(at, gram_sums(df, target, weight, beta[at]), strict=True):
            objective = 0.5 * (ridge * beta[i]) @ beta[i] + cs[i] * row[0]
            if objective > low[i] + 1e-10 * abs(low[i]):  # more than rounding
                beta[i] = (best[i] + beta[i]) / 2
                continue
            best[i], low[i] = beta[i], objective
            hessian = np.zeros((k, k))
            hessian[upper] = cs[i] * row[k + 1 :]
            hessian = hessian + np.triu(hessian, 1).T + np.diag(ridge)
            step = np.linalg.lstsq(hessian, cs[i] * row[1 : k + 1] + ridge * beta[i], rcond=None)[0]
            beta[i] = best[i] - step
            open_[i] = np.abs(step).max() > tol
        if not open_.any():
            break
    return [Logistic([float(x) for x in b[1:]], float(b[0])) for b in best]


def fit_logistic(df: DataFrame, target: str, c: float, weight: str | None = None) -> Logistic:
    return fit_logistics(df, target, [c], weight)[0]


def logistic_probability(model: Logistic) -> Column:
    """Probability from the ``vec`` column."""
    terms = F.zip_with("vec", F.array(*[F.lit(x) for x in model.coefficients]), lambda a, b: a * b)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.aggregate(terms, F.lit(model.intercept), lambda a, b: a + b)))


def _with_prob(model, df: DataFrame) -> DataFrame:
    if isinstance(model, Logistic):
        return df.withColumn(PROB, logistic_probability(model))
    out = model.transform(df)
    return out.withColumn(PROB, vector_to_array("probability")[1])


@dataclass
class Scorecard:
    """Selected features, WoE table and coefficients on raw WoE."""

    woe: WoeModel
    coefficients: dict[str, float]
    intercept: float
    best_c: float = 1.0
    cv: DataFrame | None = field(default=None, repr=False)

    def predict(self, df: DataFrame, out: str = PROB) -> DataFrame:
        """Probability from generated expressions: no model object runs inside the tasks."""
        enc = self.woe.transform(df, only=list(self.coefficients), suffix="__woe", fill=0.0)
        coefs = {f"{f}__woe": c for f, c in self.coefficients.items()}
        prob = F.lit(1.0) / (F.lit(1.0) + F.exp(-linear_logit(coefs, self.intercept)))
        return enc.withColumn(out, prob).drop(*coefs)

    def inputs(self) -> list[str]:
        return list(self.coefficients)

    def save(self, path: str) -> None:
        spark = self.woe.table.sparkSession
        self.woe.save(f"{path}/woe")
        rows = [(f, float(c)) for f, c in self.coefficients.items()] + [("(intercept)", float(self.intercept))]
        spark.createDataFrame(rows, "feature string, coefficient double").write.mode("overwrite").parquet(f"{path}/coefficients")
        selected = spark.createDataFrame([(f,) for f in self.coefficients], "feature string")
        selected.write.mode("overwrite").json(f"{path}/selected_features")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Scorecard":
        rows = {r["feature"]: r["coefficient"] for r in spark.read.parquet(f"{path}/coefficients").collect()}
        intercept = rows.pop("(intercept)")
        return cls(WoeModel.load(spark, f"{path}/woe"), rows, intercept)


def _encode(train: DataFrame, others: list[DataFrame], features: list[str], target: str, keep: list[str], bins: int, woe: WoeModel | None = None):
    """Encoder (unless it is given) and scaler fitted on ``train`` alone, applied to every frame."""
    woe = woe or WoeModel.fit(train, target, numeric=features, bins=bins)
    encoded = [woe.transform(d.select(*keep, *features), fill=0.0) for d in (train, *others)]
    means, stds = _scaler(encoded[0], features)
    return woe, means, stds, [_standardised(d, features, means, stds, keep) for d in encoded]


def train_scorecard(
    df: DataFrame, features: list[str], target: str, key: str, fold: str = "fold", c_grid=C_GRID,
    iv_floor: float = IV_FLOOR, bins: int = 10,
) -> Scorecard:
    """IV preselection, regularisation search with encoder and scaler refitted per fold, final fit on all rows."""
    whole = WoeModel.fit(df, target, numeric=features, bins=bins)
    selected = whole.select_by_iv(iv_floor)
    if not selected:
        raise ValueError(f"no feature reaches an information value of {iv_floor}")
    keep = [key, target, fold]

    def scored(k) -> DataFrame:
        train, valid = df.where(F.col(fold) != k), df.where(F.col(fold) == k)
        _, _, _, (tr, va) = _encode(train, [valid], selected, target, keep, bins)
        tr = balanced_weight(tr, target).persist(StorageLevel.MEMORY_AND_DISK)
        fits = fit_logistics(tr, target, c_grid, "weight")
        tr.unpersist()
        part = va.select(*keep, *[logistic_probability(m).alias(f"c{i}") for i, m in enumerate(fits)])
        return part.unpivot(keep, [f"c{i}" for i in range(len(c_grid))], "model", PROB)

    stacked = _stack(_at_once(scored, _folds(df, fold)))
    stacked = stacked.persist(StorageLevel.MEMORY_AND_DISK)
    rows = fold_metrics(stacked, target).collect()  # grid x folds rows
    stacked.unpersist()
    aucs = [[r["auc"] for r in rows if r["model"] == f"c{i}" and r["auc"] is not None] for i in range(len(c_grid))]
    best = max(range(len(c_grid)), key=lambda i: (sum(aucs[i]) / max(len(aucs[i]), 1), -i))
    cv = df.sparkSession.createDataFrame(
        [("scorecard", int(r["fold"]), r["auc"], r["gini"], r["ks"]) for r in rows if r["model"] == f"c{best}"],
        "model string, fold int, auc double, gini double, ks double",
    )
    # A feature's bins depend on no other feature, so those of the preselection are the final ones.
    return fit_scorecard(df, selected, target, c_grid[best], bins, cv, whole.only(selected))


def fit_scorecard(
    df: DataFrame, features: list[str], target: str, c: float = 1.0, bins: int = 10, cv: DataFrame | None = None, woe: WoeModel | None = None,
) -> Scorecard:
    """Scorecard of given features at a given regularisation: balanced classes, coefficients on raw WoE.

    ``woe`` is their encoder where it is fitted on these rows already.
    """
    woe, means, stds, (full,) = _encode(df, [], features, target, [target], bins, woe)
    full = balanced_weight(full, target).persist(StorageLevel.MEMORY_AND_DISK)
    model = fit_logistic(full, target, c, "weight")
    full.unpersist()
    raw, intercept = fold_scaler(dict(zip(features, model.coefficients)), model.intercept, means, stds)
    return Scorecard(woe, raw, intercept, c, cv)


def filling(df: DataFrame, features: list[str]) -> tuple[dict[str, float], list[str]]:
    """Median of every feature (0 without a value) and the features with NULLs."""
    mid = {f: float(m or 0.0) for f, m in medians(df, features).items()}
    row = df.agg(*[F.count_if(F.col(f).isNull()).alias(f"n{i}") for i, f in enumerate(features)]).first()
    return mid, [f for i, f in enumerate(features) if row[f"n{i}"] > 0]


def tree_frame(
    train: DataFrame, others: list[DataFrame], features: list[str], keep: list[str], fill: tuple[dict[str, float], list[str]] | None = None,
) -> list[DataFrame]:
    """Vectors for tree learners: NULLs take the training median and a flag marks them."""
    mid, holes = fill or filling(train, features)
    assembler = VectorAssembler(inputCols=[*features, *[f"MISS_{f}" for f in holes]], outputCol="vec")

    def prepare(df: DataFrame) -> DataFrame:
        cols = [F.coalesce(F.col(f).cast("double"), F.lit(mid[f])).alias(f) for f in features]
        flags = [F.col(f).isNull().cast("double").alias(f"MISS_{f}") for f in holes]
        return assembler.transform(df.select(*keep, *cols, *flags)).select(*keep, "vec")

    return [prepare(d) for d in (train, *others)]


def boosted(max_iter=50, max_depth=4, step=0.1, subsample=0.8, min_rows=20, seed=42) -> GBTClassifier:
    return GBTClassifier(
        featuresCol="vec", labelCol="label", weightCol="weight", maxIter=max_iter, maxDepth=max_depth, stepSize=step,
        subsamplingRate=subsample, minInstancesPerNode=min_rows, seed=seed,
    )


def forest(trees=100, max_depth=6, min_rows=20, seed=42) -> RandomForestClassifier:
    return RandomForestClassifier(
        featuresCol="vec", labelCol="label", weightCol="weight", numTrees=trees, maxDepth=max_depth,
        minInstancesPerNode=min_rows, seed=seed,
    )


def _labelled(df: DataFrame, target: str) -> DataFrame:
    return positive_weight(df, target).withColumn("label", F.col(target).cast("double"))


def out_of_fold(
    df: DataFrame, estimators: dict, features: list[str], target: str, key: str, fold: str = "fold"
) -> DataFrame:
    """Long frame (key, target, fold, model, probability) of predictions on rows no model has seen."""
    keep = [key, target, fold]

    def predicted(k) -> DataFrame:
        tr, va = tree_frame(df.where(F.col(fold) != k), [df.where(F.col(fold) == k)], features, keep)
        tr = _labelled(tr, target).persist(StorageLevel.MEMORY_AND_DISK)
        fits = {name: est.copy().fit(tr) for name, est in estimators.items()}
        tr.unpersist()
        return _stack(_with_prob(fit, va).select(*keep, F.lit(name).alias("model"), PROB) for name, fit in fits.items())

    return _stack(_at_once(predicted, _folds(df, fold)))


@dataclass
class TreeModel:
    model: object
    features: list[str]
    fill: dict[str, float]
    flags: list[str]

    def predict(self, df: DataFrame, out: str = PROB) -> DataFrame:
        cols = {f"_x_{f}": F.coalesce(F.col(f).cast("double"), F.lit(float(self.fill[f]))) for f in self.features}
        cols.update({f"_m_{f}": F.col(f).isNull().cast("double") for f in self.flags})
        va = VectorAssembler(inputCols=list(cols), outputCol="vec").transform(df.withColumns(cols)).drop(*cols)
        scored = self.model.transform(va).withColumn(out, vector_to_array("probability")[1])
        return scored.drop("vec", "rawPrediction", "probability", "prediction")

    def inputs(self) -> list[str]:
        return list(self.features)

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        state = json.dumps({"features": self.features, "fill": self.fill, "flags": self.flags, "kind": type(self.model).__name__})
        self.spark().createDataFrame([(state,)], "state string").write.mode("overwrite").json(f"{path}/state")

    @staticmethod
    def spark() -> SparkSession:
        return SparkSession.getActiveSession()

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "TreeModel":
        from pyspark.ml import classification

        state = json.loads(spark.read.json(f"{path}/state").first()["state"])
        model = getattr(classification, state["kind"]).load(f"{path}/model")
        return cls(model, state["features"], state["fill"], state["flags"])


def fit_trees(df: DataFrame, estimators: dict, features: list[str], target: str, key: str) -> dict[str, TreeModel]:
    """Models of all rows; the learners share the filled vectors."""
    mid, flags = filling(df, features)
    (tr,) = tree_frame(df, [], features, [key, target], (mid, flags))
    tr = _labelled(tr, target).persist(StorageLevel.MEMORY_AND_DISK)
    fits = _at_once(lambda est: est.copy().fit(tr), estimators.values())
    tr.unpersist()
    return {name: TreeModel(fit, features, mid, flags) for name, fit in zip(estimators, fits, strict=True)}


def fit_tree(df: DataFrame, estimator, features: list[str], target: str, key: str) -> TreeModel:
    return fit_trees(df, {"tree": estimator}, features, target, key)["tree"]


def grid_search(
    df: DataFrame, features: list[str], target: str, key: str, fold: str = "fold", depths=(3, 5), steps=(0.05, 0.1),
    max_iter: int = 20, parallelism: int = 2,
) -> DataFrame:
    """Mean cross-validated AUC of every parameter combination of the boosted model."""
    (vec,) = tree_frame(df, [], features, [key, target, fold])
    vec = _labelled(vec, target).withColumn(fold, F.col(fold).cast("int")).persist(StorageLevel.MEMORY_AND_DISK)
    est = boosted(max_iter=max_iter)
    grid = ParamGridBuilder().addGrid(est.maxDepth, list(depths)).addGrid(est.stepSize, list(steps)).build()
    n_folds = vec.select(F.max(fold)).first()[0] + 1
    cv = CrossValidator(
        estimator=est, estimatorParamMaps=grid, foldCol=fold, numFolds=n_folds, parallelism=parallelism,
        evaluator=BinaryClassificationEvaluator(rawPredictionCol="rawPrediction", labelCol="label"),
    )
    fitted = cv.fit(vec)
    vec.unpersist()
    rows = [
        (int(g[est.maxDepth]), float(g[est.stepSize]), float(a)) for g, a in zip(grid, fitted.avgMetrics)
    ]
    return df.sparkSession.createDataFrame(rows, "max_depth int, step_size double, mean_auc double")


@dataclass
class Linear:
    """A linear model on given columns."""

    coefficients: dict[str, float]
    intercept: float

    def predict(self, df: DataFrame, out: str = PROB) -> DataFrame:
        return df.withColumn(out, linear_probability(self.coefficients, self.intercept))

    def inputs(self) -> list[str]:
        return list(self.coefficients)

    def save(self, path: str) -> None:
        rows = [(n, float(c)) for n, c in self.coefficients.items()] + [("(intercept)", float(self.intercept))]
        TreeModel.spark().createDataFrame(rows, "feature string, coefficient double").coalesce(1).write.mode("overwrite").parquet(f"{path}/coefficients")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Linear":
        rows = {r["feature"]: r["coefficient"] for r in spark.read.parquet(f"{path}/coefficients").collect()}
        intercept = rows.pop("(intercept)")
        return cls(rows, intercept)


@dataclass
class Stacking:
    """Base tree models and the logistic model over their probabilities."""

    bases: dict[str, TreeModel]
    coefficients: dict[str, float]
    intercept: float
    cv: DataFrame | None = field(default=None, repr=False)

    def predict(self, df: DataFrame, out: str = PROB) -> DataFrame:
        for name, base in self.bases.items():
            df = base.predict(df, f"_b_{name}")
        coefs = {f"_b_{n}": c for n, c in self.coefficients.items()}
        prob = F.lit(1.0) / (F.lit(1.0) + F.exp(-linear_logit(coefs, self.intercept)))
        return df.withColumn(out, prob).drop(*coefs)

    def inputs(self) -> list[str]:
        return sorted({f for b in self.bases.values() for f in b.features})

    def save(self, path: str) -> None:
        for name, base in self.bases.items():
            base.save(f"{path}/{name}")
        rows = [(n, float(c)) for n, c in self.coefficients.items()] + [("(intercept)", float(self.intercept))]
        TreeModel.spark().createDataFrame(rows, "base string, coefficient double").write.mode("overwrite").parquet(f"{path}/coefficients")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Stacking":
        rows = {r["base"]: r["coefficient"] for r in spark.read.parquet(f"{path}/coefficients").collect()}
        intercept = rows.pop("(intercept)")
        return cls({n: TreeModel.load(spark, f"{path}/{n}") for n in rows}, rows, intercept)


def train_stacking(
    df: DataFrame, estimators: dict, features: list[str], target: str, key: str, fold: str = "fold"
) -> Stacking:
    """Out-of-fold base scores, standardised, under a logistic model; its own metrics are cross-validated too."""
    names = sorted(estimators)
    oof = out_of_fold(df, estimators, features, target, key, fold)
    wide = oof.groupBy(key, target, fold).agg(*[
        F.max(F.when(F.col("model") == n, F.col(PROB))).alias(n) for n in names
    ]).persist(StorageLevel.MEMORY_AND_DISK)
    keep = [key, target, fold]

    def scored(k) -> DataFrame:
        train, valid = wide.where(F.col(fold) != k), wide.where(F.col(fold) == k)
        means, stds = _scaler(train, names)
        meta = fit_logistic(_standardised(train, names, means, stds, keep), target, 1.0)
        return _with_prob(meta, _standardised(valid, names, means, stds, keep)).select(*keep, PROB)

    stacked = _stack(_at_once(scored, _folds(wide, fold)))  # finding the folds fills the cache
    per_fold = fold_metrics(stacked.withColumn("model", F.lit("stacking")), target).collect()  # folds rows
    cv = df.sparkSession.createDataFrame(
        [(r["model"], int(r["fold"]), r["auc"], r["gini"], r["ks"]) for r in per_fold],
        "model string, fold int, auc double, gini double, ks double",
    )
    means, stds = _scaler(wide, names)
    meta = fit_logistic(_standardised(wide, names, means, stds, keep), target, 1.0)
    raw, intercept = fold_scaler(dict(zip(names, meta.coefficients)), meta.intercept, means, stds)
    wide.unpersist()
    bases = fit_trees(df, {n: estimators[n] for n in names}, features, target, key)
    return Stacking(bases, raw, intercept, cv)


#: Stored models by kind.
KINDS = {"scorecard": Scorecard, "boosted": TreeModel, "forest": TreeModel, "stacking": Stacking, "linear": Linear}


def publish(spark: SparkSession, registry: str, kind: str, path: str) -> int:
    """Make a stored model the current one of a registry; the entry is written last, so a reader never sees half a model."""
    known = versions(spark, registry)
    version = max(known, default=0) + 1
    spark.createDataFrame([(version, kind, path)], VERSIONS).coalesce(1).write.mode("append").json(f"{registry}/versions")
    return version


VERSIONS = "version int, kind string, path string"


def versions(spark: SparkSession, registry: str) -> dict[int, tuple[str, str]]:
    """Published models: version -> (kind, path)."""
    try:
        rows = spark.read.schema(VERSIONS).json(f"{registry}/versions").collect()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        rows = []
    return {r["version"]: (r["kind"], r["path"]) for r in rows}


def load_version(spark: SparkSession, registry: str, version: int | None = None):
    """(version, model) of the given or the newest version."""
    known = versions(spark, registry)
    if not known:
        raise ValueError(f"no model is published in {registry}")
    version = max(known) if version is None else version
    kind, path = known[version]
    return version, KINDS[kind].load(spark, path)
