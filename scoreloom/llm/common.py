"""Helpers shared by the operators: tables, the held-out split, row keys, hashing of words and byte windows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.session import checkpoint_root, fresh_checkpoint_path

MIX = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def held_out(doc_id: Column) -> Column:
    return F.coalesce(fold(doc_id) == 0, F.lit(False))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame below the shared checkpoint folder and read it again: several later jobs start from it."""
    spark = df.sparkSession
    checkpoint_root(spark)
    path = fresh_checkpoint_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def placed(rows: DataFrame, order: list, name: str) -> DataFrame:
    """`rows` in the order of the columns `order`, stored, with _part and _pos, the place among all rows from 0.

    Rows that tie in all of `order` are dealt by where they were read, so that many equal rows don't meet in one task.
    Only the row count of each range is collected.
    """
    spark = rows.sparkSession
    rows = rows.withColumn("_tie", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
    rows = stored(rows.withColumn("_at", F.monotonically_increasing_id()), name)
    counts = sorted(rows.groupBy(F.expr("shiftright(_at, 33)").alias("p")).count().collect())
    offsets, total = [], 0
    for part, n in counts:
        offsets.append((part, total))
        total += n
    offsets = F.broadcast(spark.createDataFrame(offsets, "_part long, _offset long"))
    rows = rows.withColumn("_part", F.expr("shiftright(_at, 33)")).join(offsets, "_part")
    return rows.withColumn("_pos", F.expr("_offset + (_at & 8589934591L)")).drop("_at", "_offset")


def row_key(docs: DataFrame) -> tuple[DataFrame, bool]:
    """`docs` with `_key` and whether the ids are unique. `_key` is a long that is unique per distinct (doc_id, text) and sorts like (doc_id, text), NULL ids last.

    With unique non-NULL ids, the normal case, that is the id itself. Otherwise the distinct rows are numbered
    by a range-partitioned sort, so that rows sharing an id are different documents and repeated rows are one; the numbers
    come back by id and SHA-256 of the text, so texts are moved for the sort alone and never leave the JVM.
    """
    odd = (
        docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL").limit(1).count()
    )
    if not odd:
        return docs.withColumn("_key", F.col("doc_id").cast("long")), True
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    order = docs.select(F.col("doc_id").alias("_key_id"), F.col("text").alias("_key_text")).distinct()
    keys = placed(order, [F.col("_key_id").asc_nulls_last(), "_key_text"], "row-keys")
    keys = stored(keys.select("_key_id", F.col("_key_text").isNull().alias("_key_none"), F.sha2(F.coalesce("_key_text", F.lit("")), 256).alias("_key_sha"), F.col("_pos").alias("_key")), "row-keys")
    same = docs.doc_id.eqNullSafe(keys._key_id) & (docs.text.isNull() == keys._key_none) & (digest == keys._key_sha)
    return docs.join(keys, same).drop("_key_id", "_key_none", "_key_sha"), False


def mixed(h: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that all bits depend on all bits."""
    h = (h ^ (h >> np.uint64(32))) * MIX
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range [start, end) of `data`, from prefix sums of a polynomial modulo 2**64."""
    n = len(data)
    power, inverse = _powers(n + 1)
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTE[data] * power[:n], out=total[1:])
    return mixed((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))


_BYTE = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_CACHE: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_CACHE.get("p", ())) < n:
        size = max(n, 1 << 20)
        p = 0x9E3779B97F4A7C15 * 2 + 1 & (1 << 64) - 1
        for name, base in (("p", p), ("i", pow(p, -1, 1 << 64))):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            _CACHE[name] = np.cumprod(x, dtype=np.uint64)
    return _CACHE["p"][:n], _CACHE["i"][:n]


def sliced(batches, at_once: int = 256):
    """Arrow batches cut into small ones, so that a task holds few rows as Python values."""
    for batch in batches:
        for i in range(0, batch.num_rows, at_once):
            yield batch.slice(i, at_once)


def rows_of(batches):
    """Rows of Arrow batches as tuples."""
    for batch in sliced(batches):
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def chunks(batches, most_bytes: int):
    """Regroup Arrow batches of (key, text, ...) into lists of rows of about `most_bytes` of text; one row at least."""
    rows, size = [], 0
    for row in rows_of(batches):
        rows.append(row)
        size += len(row[1]) if row[1] else 0
        if size >= most_bytes:
            yield rows
            rows, size = [], 0
    if rows:
        yield rows
