"""Removal of long repeated byte strings by minimiser runs with hash grouping.

This stands in for bucket-pointer refinement: no bucket is sorted on the bucket identifiers of later offsets and nothing
recurses. Whether a window of fixed length occurred before is decided by equality alone, so a full suffix order is not
needed, and every round of looking up identifiers at later offsets would shuffle a row per byte.

A string of `length` bytes is to be removed wherever it occurs again. Sorting all suffixes of a corpus would shuffle
every byte many times over, so the suffixes are grouped only as far as a decision needs:

1. Initial buckets. Every window of `length` bytes belongs to the bucket of the smallest q-gram hash inside it;
   equal windows choose the same q-gram at the same offset. Neighbouring windows that choose the same occurrence form
   a run, and only runs are shuffled: bucket, identifier of the whole run's bytes, position.
2. Refinement on identifiers. Within a bucket, runs with the same identifier are equal from end to end, so all but
   the first are repeated as a whole. A bucket with a single identifier is finished.
3. Refinement at later offsets. Runs of buckets that hold several identifiers overlap in part. They are refined to
   buckets of single windows, whose first member alone is no repeat; this settles them for good.

Each part of a task reports one run or window of each kind, the first, and marks the others itself, so text that a
third of all documents share costs a row per part of a task. Documents meet their marks in one join.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from scoreloom.llm.common import _BYTE, _powers, mixed, row_key, rows_of, sliced, stored

LENGTH, GRAM = 100, 32
PART = 1_000_000  # bytes that a task handles at once
HOT = 2_000  # identifiers of a bucket up to which its runs are compared byte by byte in one group
MARKED = 255  # number of windows that marks a row as an interval; a run has fewer
REPEATED, BY_RUN, BY_WINDOW = 0, 1, 2
RESULTS = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")
RUNS = "bucket long, ident long, key long, pos long"
MARKS = "key long, kind byte, id long, begin long, upto long"
PIECES = "id long, ident long, key long, pos long, piece binary"


class Bytes:
    """Slices of texts laid end to end, with prefix sums of a polynomial hash."""

    def __init__(self, slices: list[tuple[int, int, bytes]]):
        self.data = np.frombuffer(b"".join(s[2] for s in slices), np.uint8)
        size = np.fromiter((len(s[2]) for s in slices), np.int64, len(slices))
        self.first = np.r_[0, np.cumsum(size)]
        self.key = np.fromiter((s[0] for s in slices), np.int64, len(slices))
        self.shift = np.fromiter((s[1] for s in slices), np.int64, len(slices)) - self.first[:-1]
        self.power, self.inverse = _powers(len(self.data) + 1)
        self.total = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_BYTE[self.data] * self.power[:-1], out=self.total[1:])

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.total[end] - self.total[start]) * self.inverse[start] + (end - start).astype(np.uint64))

    def grams(self, size: int) -> np.ndarray:
        n = max(0, len(self.data) - size + 1)
        return mixed((self.total[size : size + n] - self.total[:n]) * self.inverse[:n])

    def owner(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, at, side="right") - 1


def slices(batches, length: int, most: int = PART):
    """(key, offset, bytes) lists of about `most` bytes; long texts are cut so that every window lies in one slice."""
    held, size = [], 0
    for key, text in rows_of(batches):
        raw = (text or "").encode("utf-8", "surrogatepass")
        for at in range(0, max(1, len(raw) - length + 1), most):
            piece = raw[at : at + most + length - 1]
            held.append((key, at, piece))
            size += len(piece)
            if size >= most:
                yield held
                held, size = [], 0
    if held:
        yield held


def smallest(grams: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest (first on ties) of each `width` neighbouring hashes."""
    m, reach = (grams & ~np.uint64(127)), 1
    while reach * 2 <= width:
        m = np.minimum(m[:-reach], m[reach:] + np.uint64(reach))
        reach *= 2
    gap = width - reach
    if gap:
        m = np.minimum(m[:-gap], m[gap:] + np.uint64(gap))
    return np.arange(len(m)) + (m & np.uint64(127)).astype(np.int64)


def runs(b: Bytes, length: int, gram: int):
    """bucket, identifier, slice, start and number of windows of each run, in order of position."""
    n = len(b.data) - length + 1
    if n < 1:
        z = np.zeros(0, np.int64)
        return z.view(np.uint64), z.view(np.uint64), z, z, z
    grams = b.grams(gram)
    at = smallest(grams, length - gram + 1)
    start = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    cuts = np.concatenate([b.first[:-1], np.maximum(b.first[1:] - length + 1, 0)])
    start = np.unique(np.concatenate([start, cuts[cuts < n]]))
    count = np.diff(np.r_[start, n])
    own = b.owner(start)
    inside = start + length <= b.first[own + 1]  # the rest are windows across two slices
    start, count, own = start[inside], count[inside], own[inside]
    return grams[at[start]], b.hashes(start, start + count + length - 1), own, start, count


def first_of_each(ids: list[np.ndarray], key: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the first by (key, start) of each combination of ids, and of all others."""
    order = np.lexsort((start, key, *ids[::-1]))
    new = np.zeros(len(order), bool)
    if len(order):
        new[0] = True
        for x in ids:
            new[1:] |= x[order[1:]] != x[order[:-1]]
    return order[new], order[~new]


def merged(key: np.ndarray, begin: np.ndarray, upto: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unions of intervals that touch or overlap, per key."""
    if not len(key):
        return key, begin, upto
    o = np.lexsort((begin, key))
    key, begin, upto = key[o], begin[o], upto[o]
    new_key = np.r_[True, key[1:] != key[:-1]]
    lift = np.cumsum(new_key) * (int(upto.max()) + 1)  # keeps the running maximum within a key
    high = np.maximum.accumulate(upto + lift)
    new = new_key | np.r_[True, begin[1:] + lift[1:] > high[:-1]]
    s = np.flatnonzero(new)
    e = np.r_[s[1:], len(key)] - 1
    return key[s], begin[s], high[e] - lift[e]


def _rows(names: str, *columns) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "byte": pa.int8(), "binary": pa.binary()}
    fields = [f.split() for f in names.split(", ")]
    made = [pa.array(c.view(np.int64) if getattr(c, "dtype", None) == np.uint64 else c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(made, [f[0] for f in fields])


def _columns(batch) -> list[np.ndarray]:
    return [c.to_numpy(zero_copy_only=False) for c in batch.columns]


def _find_runs(length: int, gram: int):
    """Step 1: the first run of each kind of a part, and intervals for all others."""

    def run(batches):
        for part in slices(batches, length):
            b = Bytes(part)
            bucket, ident, own, start, count = runs(b, length, gram)
            key, at = b.key[own], start + b.shift[own]
            first, rest = first_of_each([bucket, ident], key, at)
            k, begin, upto = merged(key[rest], at[rest], at[rest] + count[rest] + length - 1)
            spread = mixed(k.astype(np.uint64) + begin.astype(np.uint64)).view(np.int64)
            yield _rows(
                RUNS, np.r_[bucket[first].view(np.int64), spread], np.r_[ident[first].view(np.int64), upto], np.r_[key[first], k],
                np.r_[at[first] << 8 | count[first], begin << 8 | MARKED],
            )

    return run


def _refine_runs(length: int):
    """Step 2 over rows sorted by bucket, identifier, key and position: repeated runs, and runs still to be compared."""

    def run(batches):
        last = None  # bucket and identifier of the last run
        held = None  # first runs (key, pos) of the last bucket, while they may turn out few
        hot = False

        def opened(bucket, key, pos, kind):
            begin = pos >> 8
            return _rows(MARKS, key, np.full(len(key), kind, np.int8), bucket, begin, begin + (pos & 255) + length - 1)

        def settle(bucket, key, pos):
            """Buckets that are complete: one identifier is finished, few are compared by run, many by window."""
            new = np.r_[True, bucket[1:] != bucket[:-1]]
            size = np.diff(np.r_[np.flatnonzero(new), len(bucket)])[np.cumsum(new) - 1]
            for kind, some in ((BY_RUN, (size > 1) & (size <= HOT)), (BY_WINDOW, size > HOT)):
                if some.any():
                    yield opened(bucket[some], key[some], pos[some], kind)

        for batch in batches:
            bucket, ident, key, pos = _columns(batch)
            done = (pos & 255) == MARKED
            if done.any():
                n = int(done.sum())
                yield _rows(MARKS, key[done], np.full(n, REPEATED, np.int8), np.zeros(n, np.int64), pos[done] >> 8, ident[done])
                bucket, ident, key, pos = (x[~done] for x in (bucket, ident, key, pos))
            if not len(bucket):
                continue
            new = np.r_[last is None or (bucket[0], ident[0]) != last, (bucket[1:] != bucket[:-1]) | (ident[1:] != ident[:-1])]
            last = bucket[-1], ident[-1]
            if not new.all():
                k, begin = key[~new], pos[~new] >> 8
                k, begin, upto = merged(k, begin, begin + (pos[~new] & 255) + length - 1)
                yield _rows(MARKS, k, np.full(len(k), REPEATED, np.int8), np.zeros(len(k), np.int64), begin, upto)
            bucket, key, pos = bucket[new], key[new], pos[new]
            if not len(bucket):
                continue
            if held is not None:
                if hot:
                    more = bucket == held[0][0]
                    if more.any():
                        yield opened(bucket[more], key[more], pos[more], BY_WINDOW)
                    bucket, key, pos = bucket[~more], key[~more], pos[~more]
                    if not len(bucket):
                        continue
                    hot = False
                else:
                    bucket, key, pos = np.r_[held[0], bucket], np.r_[held[1], key], np.r_[held[2], pos]
            whole = bucket != bucket[-1]
            if whole.any():
                yield from settle(bucket[whole], key[whole], pos[whole])
            held = bucket[~whole], key[~whole], pos[~whole]
            if len(held[0]) > HOT:
                yield opened(*held, BY_WINDOW)
                held, hot = tuple(x[:1] for x in held), True
        if held is not None and not hot:
            yield from settle(*held)

    return run


def _cut_pieces(length: int):
    """Step 3, per document: the bytes of runs to compare, or the windows of runs of crowded buckets."""

    def run(batches):
        pieces: list[tuple] = []
        wide: list[tuple] = []
        buckets: list[int] = []
        size = 0

        def flush():
            if pieces:
                yield _rows(PIECES, *map(list, zip(*pieces, strict=True)))
            if wide:
                b = Bytes(wide)
                own = np.repeat(np.arange(len(wide)), np.diff(b.first) - length + 1)
                at = np.arange(len(own)) + own * (length - 1)
                h, bucket = b.hashes(at, at + length), np.array(buckets, np.int64)[own].view(np.uint64)
                key, start = b.key[own], at + b.shift[own]
                first, rest = first_of_each([bucket, h], key, start)
                k, begin, upto = merged(key[rest], start[rest], start[rest] + length)
                spread = mixed(k.astype(np.uint64) + begin.astype(np.uint64)).view(np.int64)
                none = pa.nulls(len(first) + len(k), pa.binary())
                yield _rows(
                    PIECES, np.r_[bucket[first].view(np.int64), spread], np.r_[h[first].view(np.int64), upto], np.r_[key[first], k],
                    np.r_[start[first] << 8 | 1, begin << 8 | MARKED], none,
                )

        for key, text, found in rows_of(b.select([0, 1, 2]) for b in batches):
            raw = text.encode("utf-8", "surrogatepass")
            for m in found:
                begin, upto = m["begin"], m["upto"]
                size += upto - begin
                if m["kind"] == BY_RUN:
                    pieces.append((m["id"], 0, key, begin << 8 | upto - begin - length + 1, raw[begin:upto]))
                else:
                    wide.append((key, begin, raw[begin:upto]))
                    buckets.append(m["id"])
                if size >= PART:
                    yield from flush()
                    pieces, wide, buckets, size = [], [], [], 0
        yield from flush()

    return run


def _refine_pieces(length: int):
    """Step 3 over rows sorted by bucket, identifier, key and position: windows that are not the first of their kind."""

    def marks(key, begin, upto):
        k, begin, upto = merged(key, begin, upto)
        return _rows(MARKS, k, np.full(len(k), REPEATED, np.int8), np.zeros(len(k), np.int64), begin, upto)

    def compare(rows: list[tuple]):
        b = Bytes([(key, pos >> 8, piece) for _, key, pos, piece in rows])
        own = np.repeat(np.arange(len(rows)), np.diff(b.first) - length + 1)
        at = np.arange(len(own)) + own * (length - 1)
        bucket = np.array([r[0] for r in rows], np.int64)[own]
        key, start = b.key[own], at + b.shift[own]
        _, rest = first_of_each([bucket, b.hashes(at, at + length)], key, start)
        if len(rest):
            yield marks(key[rest], start[rest], start[rest] + length)

    def run(batches):
        held: list[tuple] = []
        size = 0
        last = None
        for batch in batches:
            ident, key, pos = (batch.column(c).to_numpy() for c in (1, 2, 3))
            bucket, whole = batch.column(0).to_numpy(), batch.column(4).is_valid().to_numpy(zero_copy_only=False)
            done = (pos & 255) == MARKED
            if done.any():
                yield marks(key[done], pos[done] >> 8, ident[done])
            single = ~whole & ~done
            if single.any():
                b, i, k, p = bucket[single], ident[single], key[single], pos[single] >> 8
                again = np.r_[last == (b[0], i[0]), (b[1:] == b[:-1]) & (i[1:] == i[:-1])]
                last = b[-1], i[-1]
                if again.any():
                    yield marks(k[again], p[again], p[again] + length)
            if whole.any():
                for r in zip(bucket[whole].tolist(), key[whole].tolist(), pos[whole].tolist(), batch.column(4).filter(pa.array(whole)).to_pylist(), strict=True):
                    if size >= PART and r[0] != held[-1][0]:
                        yield from compare(held)
                        held, size = [], 0
                    held.append(r)
                    size += len(r[3])
        if held:
            yield from compare(held)

    return run


def _cut_text(names: list[str]):
    """Per document: its own columns, bytes, removed bytes, spans, digest of what is kept, and the kept text."""

    def cut(text, found):
        raw = (text or "").encode("utf-8", "surrogatepass")
        kept, spans, at = [], [], 0
        for m in sorted((f["begin"], f["upto"]) for f in found or ()):
            if spans and m[0] <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], m[1])
            else:
                spans.append([*m])
        for begin, upto in spans:
            kept.append(raw[at:begin])
            at = upto
        left = b"".join([*kept, raw[at:]])
        return len(raw), len(raw) - len(left), len(spans), hashlib.sha256(left).hexdigest(), left.decode("utf-8", "ignore")

    def run(batches):
        kinds = [*[pa.int64()] * 3, pa.string(), pa.string()]
        for batch in sliced(batches):
            out = [cut(*r) for r in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            made = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[3:], *made], names)

    return run


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """`docs` with n_bytes, n_removed, n_spans, kept_sha256 and kept, which replace input columns of these names.

    A byte goes if a string of `length` bytes that covers it also starts earlier: in a document of a smaller id, or
    in the same document before. `kept` is what remains as text, without the bytes of characters cut in two.
    NULL texts are empty. Rows that repeat an id and a text are one document and get the same result; different
    texts under one id are different documents, in the order of the texts; NULL ids come last.
    """
    docs = docs.drop(*RESULTS, "_key", "_found")
    keyed, unique = row_key(docs)
    if unique:
        return _removed(keyed, docs, length, gram)
    distinct = keyed.select("_key", "text").distinct()
    cut = _removed(distinct, distinct.select("_key"), length, gram).withColumnRenamed("_key", "_of")
    return keyed.join(cut, keyed._key == cut._of, "left").drop("_key", "_of")


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """`docs` with repeated strings cut out of the text; texts of which nothing is left stay as empty texts."""
    cut = repeats(docs, length, gram)
    return cut.withColumn("text", F.when(F.col("text").isNotNull(), F.col("kept"))).select(*docs.columns)


def _removed(keyed: DataFrame, carried: DataFrame, length: int, gram: int) -> DataFrame:
    """The columns of `carried` with the results, one row per key.

    Both joins deal out the same columns of the documents by key, so Spark shuffles the texts once for the two.
    """
    base = keyed.where("_key IS NOT NULL")
    own = [F.col("_key").alias("_k"), F.col("text").alias("_t"), "_found", *[F.col(f"`{c}`") for c in carried.columns]]
    found = base.select("_key", "text").mapInArrow(_find_runs(length, gram), RUNS)
    found = found.repartition("bucket").sortWithinPartitions("bucket", "ident", "key", "pos")
    marks = stored(found.mapInArrow(_refine_runs(length), MARKS), "marks")
    opened = marks.where(f"kind <> {REPEATED}").groupBy(F.col("key").alias("_key")).agg(F.collect_list(F.struct("kind", "id", "begin", "upto")).alias("_found"))
    pieces = base.join(opened, "_key").select(*own).mapInArrow(_cut_pieces(length), PIECES)
    pieces = pieces.repartition("id", "ident").sortWithinPartitions("id", "ident", "key", "pos")
    more = pieces.mapInArrow(_refine_pieces(length), MARKS)
    all_marks = marks.where(f"kind = {REPEATED}").union(more).groupBy(F.col("key").alias("_key")).agg(F.collect_list(F.struct("begin", "upto")).alias("_found"))
    made = [StructField(c, StringType() if c in ("kept_sha256", "kept") else LongType()) for c in RESULTS]
    schema = StructType([*carried.schema.fields, *made])
    return base.join(all_marks, "_key", "left").select(*own).mapInArrow(_cut_text(schema.names), schema)
