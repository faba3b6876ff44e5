"""Nearest neighbours by inverted lists with an adaptive dimension scan.

Centroids are learned from a bounded sample; every vector is indexed in the list of its nearest centroid. Vectors are
turned by one random rotation, which spreads distances evenly over the dimensions, and the vectors of a list lie in
bounded blocks, by column groups. A scan adds up squared differences column group by column group: after d of D
dimensions, partial * D / d estimates the full distance, and a candidate whose partial sum exceeds
best * d / D * (1 + e / sqrt(d)) ** 2 is abandoned, a test of the hypothesis that it still belongs to the nearest.
What survives is measured exactly on the original vectors in double precision.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.common import stored

SAMPLE, MOST_LISTS, ROUNDS, SEED = 20_000, 4096, 12, 5
BLOCK, QUERIES = 4096, 512  # vectors of a block of a list, queries of a block
COLUMNS, EPSILON = 16, 2.1
LEAST = 200  # vectors that the lists of a query hold at least
RECALL, TRIALS = 0.97, 300  # share of neighbours that the probed lists are to hold, sample queries that tell how many it takes


@dataclass(frozen=True)
class Index:
    """Rotation, centroids in rotated space, and vectors per list."""

    rotation: np.ndarray
    centroids: np.ndarray
    sizes: np.ndarray

    def lists(self, x: np.ndarray) -> np.ndarray:
        """Nearest list of each rotated vector."""
        c = self.centroids
        return (np.einsum("ij,ij->i", c, c)[None] - 2 * x @ c.T).argmin(1)

    def probes(self, x: np.ndarray, probes: int, least: int) -> list[np.ndarray]:
        """Lists that each rotated query reads, nearest first."""
        c = self.centroids
        order = np.argsort(np.einsum("ij,ij->i", c, c)[None] - 2 * x @ c.T, axis=1, kind="stable")
        held = np.cumsum(self.sizes[order], axis=1)
        return [o[: max(probes, int(np.searchsorted(h, least)) + 1)] for o, h in zip(order, held, strict=True)]


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, v: rows whose vector is neither NULL, empty nor zero and has finite components only, as doubles.

    Rows without an id take no part; of several rows of an id the smallest vector does.
    """
    v = vectors.selectExpr("vec_id", "CAST(embedding AS array<double>) AS v").where(
        "vec_id IS NOT NULL AND v IS NOT NULL AND size(v) > 0 AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
        " AND exists(v, x -> x <> 0)"
    )
    return v.groupBy("vec_id").agg(F.min("v").alias("v"))


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten()).reshape(len(flat), -1) if len(flat) else np.zeros((0, 0))


def train(vectors: DataFrame, n: int, dim: int, k_nearest: int, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray, int]:
    """Rotation, centroids and lists to probe, from a sample of about `sample` of the n vectors chosen by a hash of the id.

    Neighbours within the sample lie farther apart than those among all vectors, so the number errs on the safe side.
    """
    rows = vectors.where(F.pmod(F.xxhash64("vec_id"), F.lit(2**20)) < int(2**20 * min(1.0, sample / max(n, 1)))).orderBy("vec_id").select("v").toArrow()
    rng = np.random.default_rng(SEED)
    rotation = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
    x = _matrix(rows.column("v"))
    x = np.unique(x, axis=0) @ rotation if len(x) else np.zeros((1, dim))
    k = int(max(1, min(MOST_LISTS, np.sqrt(n), len(x))))
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(ROUNDS):
        near = (np.einsum("ij,ij->i", c, c)[None] - 2 * x @ c.T).argmin(1)
        count = np.bincount(near, minlength=k)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], x[rng.integers(0, len(x), k)])
    norm = np.einsum("ij,ij->i", c, c)[None]
    near = (norm - 2 * x @ c.T).argmin(1)
    places = []
    for i in rng.choice(len(x), min(TRIALS, len(x)), replace=False):
        d = ((x - x[i]) ** 2).sum(1)
        d[i] = np.inf
        best = np.argsort(d, kind="stable")[: min(k_nearest, len(x) - 1)]
        rank = np.empty(k, np.int64)
        rank[np.argsort(norm[0] - 2 * c @ x[i], kind="stable")] = np.arange(k)
        places.append(rank[near[best]])
    return rotation, c, int(np.quantile(np.concatenate(places), RECALL)) + 1 if len(x) > 1 else 1


def _assign(shared, probes: int = 0, least: int = 0):
    """list, vec_id, v per vector; with `probes` one row per list that a query reads."""

    def run(batches):
        index = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1)) @ index.rotation
            if probes:
                lists = index.probes(x, probes, least)
                row = np.repeat(np.arange(len(x)), [len(p) for p in lists])
                near = np.concatenate(lists)
            else:
                row, near = np.arange(len(x)), index.lists(x)
            yield pa.RecordBatch.from_arrays([pa.array(near.astype(np.int32)), batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row))], ["list", "vec_id", "v"])

    return run


def _pack(key, table):
    """One row per block: ids in order and vectors as bytes."""
    table = table.sort_by("vec_id")
    v = _matrix(table.column("v"))
    ids = table.column("vec_id").to_numpy()
    return pa.table({"list": [key[0].as_py()], "ids": [ids.astype(np.int64).tobytes()], "vs": [v.tobytes()]}, schema=pa.schema([("list", pa.int32()), ("ids", pa.binary()), ("vs", pa.binary())]))


def _packed(rows: DataFrame, sizes: DataFrame, most: int) -> DataFrame:
    """Blocks of at most about `most` rows of a list, dealt by a hash of the id."""
    dealt = rows.join(F.broadcast(sizes), "list").withColumn("part", F.expr(f"pmod(xxhash64(vec_id), 1 + n DIV {most})"))
    return dealt.groupBy("list", "part").applyInArrow(_pack, "list int, ids binary, vs binary")


def nearest_in_block(
    query: np.ndarray, own: int, ids: np.ndarray, v: np.ndarray, columns: list[np.ndarray], turned: np.ndarray, k: int, known: float = np.inf
) -> tuple[np.ndarray, np.ndarray]:
    """Ids and exact distances of the k nearest of a block that no test abandons, ties to the smaller id.

    `known` is the k-th distance of the blocks before: nothing farther is of use.
    """
    dim = v.shape[1]
    live = np.flatnonzero(ids != own)
    if not len(live):
        return live, np.zeros(0)
    partial = np.zeros(len(live))
    head = live[: 4 * k]  # a first bound from a few vectors, measured in full
    some = np.sqrt(((v[head] - query) ** 2).sum(1))
    bound = min(known, np.partition(some, k - 1)[k - 1] if len(some) >= k else np.inf) ** 2
    seen = 0
    for g in columns:
        width = g.shape[1]
        d = g[live] - turned[seen : seen + width]
        partial += np.einsum("ij,ij->i", d, d)
        seen += width
        if seen < dim and np.isfinite(bound):
            keep = partial <= bound * seen / dim * (1 + EPSILON / np.sqrt(seen)) ** 2
        elif np.isfinite(bound):
            keep = partial <= bound * (1 + 1e-9)
        else:
            continue
        live, partial = live[keep], partial[keep]
    exact = np.sqrt(((v[live] - query) ** 2).sum(1))
    order = np.lexsort((ids[live], exact))[:k]
    return ids[live[order]], exact[order]


def _scan(shared, dim: int, k: int):
    """query_id, vec_id, score: the k nearest of each block for each query that probes its list."""

    def run(batches):
        index = shared.value
        best: dict[int, np.ndarray] = {}  # the k smallest distances of each query of this task
        last = None
        for batch in batches:
            out: list[tuple] = []
            for ids, vs, qids, qvs in zip(*(batch.column(c) for c in ("ids", "vs", "qids", "qvs")), strict=True):
                ids, vs = ids.as_py(), vs.as_py()
                if last is None or last[0] != ids or last[1] != vs:
                    v = np.frombuffer(vs).reshape(-1, dim)
                    t = v @ index.rotation
                    last = ids, vs, np.frombuffer(ids, np.int64), v, [np.ascontiguousarray(t[:, c : c + COLUMNS]) for c in range(0, dim, COLUMNS)]
                _, _, number, v, columns = last
                q = np.frombuffer(qvs.as_py()).reshape(-1, dim)
                for own, query, turned in zip(np.frombuffer(qids.as_py(), np.int64), q, q @ index.rotation, strict=True):
                    own = int(own)
                    so_far = best.get(own, np.zeros(0))
                    found, score = nearest_in_block(query, own, number, v, columns, turned, k, so_far[-1] if len(so_far) == k else np.inf)
                    best[own] = np.sort(np.concatenate([so_far, score]))[:k]
                    out += zip([own] * len(found), found.tolist(), score.tolist(), strict=True)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["query_id", "vec_id", "score"])

    return run


def search(vectors: DataFrame, every: int = 100, k: int = 10, least: int = LEAST) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id is divisible by `every`, its k nearest other rows.

    vectors: vec_id, embedding. Vectors that are NULL, empty, zero or hold a NULL or non-finite component take no
    part; vectors are compared with those of their own length; an empty table gives no rows. Equal distances are ordered
    by id. Each list is split into blocks, so one list may hold any share of the vectors, and queries are dealt in
    blocks, too; per query and block only k rows travel on.
    """
    spark = vectors.sparkSession
    clean = stored(usable(vectors).withColumn("dim", F.size("v")), "vectors")
    shapes = sorted((r["dim"], r["count"]) for r in clean.groupBy("dim").count().collect())  # a row per length
    schema = "query_id long, rank int, vec_id long, score double"
    out = None
    for dim, n in shapes:
        part = _search(clean.where(F.col("dim") == dim).select("vec_id", "v"), dim, n, every, k, least)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out


def _search(clean: DataFrame, dim: int, n: int, every: int, k: int, least: int) -> DataFrame:
    """`search` among n stored vectors of one length."""
    spark = clean.sparkSession
    rotation, centroids, probes = train(clean, n, dim, k)
    first = spark.sparkContext.broadcast(Index(rotation, centroids, np.zeros(len(centroids))))
    assigned = stored(clean.mapInArrow(_assign(first), "list int, vec_id long, v array<double>"), "vector-lists")
    held = np.zeros(len(centroids), np.int64)
    for r in assigned.groupBy("list").agg(F.count("*").alias("n")).collect():
        held[r["list"]] = r["n"]
    shared = spark.sparkContext.broadcast(Index(rotation, centroids, held))
    asked = clean.where(F.col("vec_id") % every == 0).mapInArrow(_assign(shared, probes, least), "list int, vec_id long, v array<double>")
    of_list = spark.createDataFrame([(i, int(x)) for i, x in enumerate(held)], "list int, n long")
    blocks = _packed(assigned, of_list, BLOCK)
    # a query probes few lists, so a list has at most about its share of the queries' probes
    questions = _packed(asked, of_list.withColumn("n", F.col("n") * probes), QUERIES * every).selectExpr("list", "ids AS qids", "vs AS qvs")
    near = blocks.join(questions, "list").select("ids", "vs", "qids", "qvs").mapInArrow(_scan(shared, dim, k), "query_id long, vec_id long, score double")
    best = near.groupBy("query_id").agg(F.expr(f"slice(array_sort(collect_list(struct(score, vec_id))), 1, {k})").alias("best"))
    return best.selectExpr("query_id", "posexplode(best) AS (p, b)").selectExpr("query_id", "p + 1 AS rank", "b.vec_id", "b.score")
