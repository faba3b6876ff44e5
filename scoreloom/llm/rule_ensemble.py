"""Quality scores by a sparse rule ensemble.

Documents become statistics (shares of symbols, capitals, repeated words and lines, ...). Small trees are grown on a
bounded sample of labelled rows; each path from a root to a node is a rule, a conjunction of thresholds. A logistic
model with an L1 penalty weighs the rules, most of which get weight zero. What remains is compiled into one Spark
column expression, so scoring a corpus is a scan without Python.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE, TREES, DEPTH, BINS, PENALTY, SEED = 20_000, 40, 3, 32, 0.002, 17

WORDS = "filter(split(coalesce(text, ''), '[ \\\\t\\\\n\\\\x0B\\\\f\\\\r]+'), x -> x <> '')"
LINES = "filter(split(coalesce(text, ''), '\\\\n'), x -> x <> '')"
#: name -> expression over text, _w (words), _l (lines).
STATISTICS = {
    "log_chars": "ln(1 + length(_t))",
    "log_words": "ln(1 + size(_w))",
    "word_length": "length(_t) / (1 + size(_w))",
    "distinct_words": "size(array_distinct(_w)) / greatest(1, size(_w))",
    "distinct_lines": "size(array_distinct(_l)) / greatest(1, size(_l))",
    "words_per_line": "size(_w) / (1 + size(_l))",
    "symbols": "regexp_count(_t, '[#$%&*+<=>@^_{|}~]') / (1 + size(_w))",
    "marks": "regexp_count(_t, '!!|\\\\?\\\\?|[*%$&#]{2}| \\\\| ') / (1 + size(_w))",
    "digits": "regexp_count(_t, '[0-9]+') / (1 + size(_w))",
    "capitals": "regexp_count(_t, '\\\\p{Lu}{2,}') / (1 + size(_w))",
    "stops": "regexp_count(_t, '[.]') / (1 + size(_w))",
    "doubled": "regexp_count(_t, '(?<![^ \\\\n])([^ \\\\n]+) \\\\1(?![^ \\\\n])') / (1 + size(_w))",
}
FEATURES = list(STATISTICS)


def statistics(docs: DataFrame) -> DataFrame:
    """`docs` with the statistics of whole texts as columns `_s_<name>`; NULL texts count as empty."""
    base = docs.selectExpr("*", "coalesce(text, '') AS _t", f"{WORDS} AS _w", f"{LINES} AS _l")
    made = [f"coalesce(double({e}), 0D) AS _s_{name}" for name, e in STATISTICS.items()]
    return base.selectExpr(*[f"`{c}`" for c in docs.columns], *made)


@dataclass(frozen=True)
class Rule:
    """All of (feature number, upper?, threshold) hold: value > threshold if upper, else value <= threshold."""

    parts: tuple[tuple[int, bool, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        ok = np.ones(len(x), bool)
        for f, upper, t in self.parts:
            ok &= (x[:, f] > t) if upper else (x[:, f] <= t)
        return ok

    def sql(self) -> str:
        return " AND ".join(f"_s_{FEATURES[f]} {'>' if upper else '<='} {t!r}D" for f, upper, t in self.parts)


@dataclass(frozen=True)
class Model:
    bias: float
    rules: list[tuple[float, Rule]]

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.bias + sum((w * r.holds(x) for w, r in self.rules), np.zeros(len(x)))

    def sql(self) -> str:
        """The score as an SQL expression over the statistics."""
        terms = [f"CASE WHEN {r.sql()} THEN {w!r}D ELSE 0D END" for w, r in self.rules]
        return f"1D / (1D + exp(-({' + '.join([f'{self.bias!r}D', *terms])})))"


def grow(x: np.ndarray, y: np.ndarray, rng: np.random.Generator, depth: int = DEPTH) -> list[Rule]:
    """Rules of all nodes below the root of one tree, on a bootstrap sample and a random half of the features."""
    rows = rng.integers(0, len(y), len(y))
    some = rng.choice(x.shape[1], max(1, x.shape[1] // 2), replace=False)
    found: list[Rule] = []

    def split(rows: np.ndarray, parts: tuple, level: int) -> None:
        if parts:
            found.append(Rule(parts))
        v = y[rows]
        if level == depth or len(rows) < 20 or v.min() == v.max():
            return
        best = (1e-9, None)
        whole = v.mean() * (1 - v.mean()) * len(v)
        for f in some:
            values = x[rows, f]
            for t in np.unique(np.quantile(values, np.linspace(0, 1, BINS + 1)[1:-1])):
                left = values <= t
                n = left.sum()
                if 5 <= n <= len(v) - 5:
                    p, q = v[left].mean(), v[~left].mean()
                    gain = whole - p * (1 - p) * n - q * (1 - q) * (len(v) - n)
                    if gain > best[0]:
                        best = (gain, (int(f), float(t), left))
        if best[1]:
            f, t, left = best[1]
            split(rows[left], (*parts, (f, False, t)), level + 1)
            split(rows[~left], (*parts, (f, True, t)), level + 1)

    split(rows, (), 0)
    return found


def lasso(a: np.ndarray, y: np.ndarray, penalty: float = PENALTY, steps: int = 400) -> tuple[float, np.ndarray]:
    """Bias and weights of the L1-penalised logistic fit, by accelerated proximal gradient."""
    n = len(y)
    mean, spread = a.mean(0), np.maximum(a.std(0), 1e-9)
    z = (a - mean) / spread
    rate = 4 / (np.linalg.norm(z, 2) ** 2 / n + 1)
    w, bias, v, vb, t = np.zeros(z.shape[1]), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))), np.zeros(z.shape[1]), 0.0, 1.0
    vb = bias
    for _ in range(steps):
        r = 1 / (1 + np.exp(-np.clip(z @ v + vb, -30, 30))) - y
        new = v - rate * (z.T @ r) / n
        new = np.sign(new) * np.maximum(np.abs(new) - rate * penalty, 0)
        new_bias = vb - rate * r.mean()
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, vb = new + (t - 1) / nt * (new - w), new_bias + (t - 1) / nt * (new_bias - bias)
        w, bias, t = new, new_bias, nt
    weights = w / spread
    return float(bias - (weights * mean).sum()), weights


def fit_rows(x: np.ndarray, y: np.ndarray) -> Model:
    """Model of a matrix of statistics and 0/1 labels; a single class or no row gives a constant."""
    if not len(y) or y.min() == y.max():
        return Model(0.0 if not len(y) else (4.0 if y[0] else -4.0), [])
    rng = np.random.default_rng(SEED)
    seen: dict[bytes, Rule] = {}
    for _ in range(TREES):
        for rule in grow(x, y, rng):
            seen.setdefault(np.packbits(rule.holds(x)).tobytes(), rule)  # rules that pick the same rows are one
    rules = list(seen.values())
    a = np.stack([r.holds(x) for r in rules], 1).astype(np.float64)
    bias, w = lasso(a, y.astype(np.float64))
    return Model(bias, [(float(v), r) for v, r in zip(w, rules, strict=True) if abs(v) > 1e-6])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Model:
    """Learn from at most about `sample` labelled documents, chosen by a hash of the id.

    Rows with a NULL id or label teach nothing; several labels of an id each count.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("_y")).where("doc_id IS NOT NULL AND _y IN (0, 1)")
    n = known.count()
    few = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(2**20)) < int(2**20 * min(1.0, sample / max(n, 1))))
    few = few.orderBy(F.xxhash64("doc_id", "_y"), "doc_id", "_y").limit(2 * sample)  # only ids with very many labels exceed it
    rows = statistics(docs.select("doc_id", "text").join(F.broadcast(few), "doc_id")).select("doc_id", "_y", *[f"_s_{f}" for f in FEATURES]).toPandas()
    rows = rows.sort_values(list(rows.columns), kind="stable")
    return fit_rows(rows[[f"_s_{f}" for f in FEATURES]].to_numpy(float).reshape(-1, len(FEATURES)), rows["_y"].to_numpy(int))


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """`docs` with score (0 to 1) and predicted, which replace input columns of these names.

    NULL texts are scored as empty ones; repeated rows and NULL ids are scored like any other.
    """
    docs = docs.drop("score", "predicted")
    out = statistics(docs).selectExpr(*[f"`{c}`" for c in docs.columns], f"{model.sql()} AS score")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
