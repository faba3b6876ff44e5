"""Similarity join on word shingles by Jaccard similarity, with token-combination prefixes.

A document is its set of distinct shingles of `WIDTH` words. Two sets of at least similarity t share at least
t * |x| of x's shingles, so at most |x| - ceil(t * |x|) of any chosen prefix of x are not shared. The prefix is
extended until its signatures outnumber those losses:

* rare shingles count one each and are indexed alone;
* frequent shingles, a bounded broadcast set that changes cost but not results, are dealt into small classes by
  hash; of a class of m prefix shingles any two shared ones give a common pair, so it counts m - 1 and is indexed as
  all its pairs. The number of classes follows the size of the set, so pairs stay in proportion to the prefix.

Every further signature in the prefix is one more that linked sets are bound to share. Long sets, which a sketch of
fixed size cannot tell apart, extend their prefixes in proportion and are compared only if they share that many.

Rare shingles come first in the global order, so most documents never need a pair, and a passage that a third of
the documents share yields no long postings. Candidates of a posting are screened by size and by a 512-bit parity
sketch, whose Hamming distance bounds the symmetric difference from below, so no true link is lost; then the
shingle sets themselves decide. Equal sets are represented by one document throughout.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.common import MIX, chunks, mixed, row_key, stored, word_hashes

WIDTH, PERCENT = 4, 85
WORDS = 8  # 64-bit words of a sketch
CLASS_LEVEL = 5  # sets of 2**5 to 2**6 shingles use two classes, twice as many for every doubling
LONG, LONG_STEP = 512, 16  # sets above LONG extend their prefix by a signature for every LONG_STEP shingles more
FREQUENT_LIMIT, FREQUENT_IN_TASK = 50_000, 4
BLOCK = 4096  # members of a posting that meet in one group
SMALL = 16  # members of a posting up to which its pairs are counted before they are screened
PAIRS = 100_000  # pairs of members screened at once
SKETCH = [f"s{i}" for i in range(WORDS)]
BROADCAST_PAIRS = 250_000
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingle_sets(texts: list, width: int = WIDTH) -> list[np.ndarray]:
    """Sorted 64-bit hashes of the distinct shingles of each text; fewer words than `width` are one shingle."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = _LOWER[np.frombuffer(b" ".join(raw) + b" ", np.uint8)]
    first = np.r_[0, np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 1)]
    space = _SPACE[data]
    before = np.r_[True, space[:-1]]
    start, end = np.flatnonzero(~space & before), np.flatnonzero(space & ~before)
    h = word_hashes(data, start, end)
    cut = np.searchsorted(start, first)
    n = np.diff(cut)
    full = h[: max(0, len(h) - width + 1)].copy()
    for j in range(1, width):
        full = mixed(full * MIX + h[j : len(full) + j])
    out = []
    for a, m in zip(cut[:-1], n, strict=True):
        if m >= width:
            out.append(np.unique(full[a : a + m - width + 1]))
        elif m:
            x = h[a : a + 1]
            for j in range(1, m):
                x = mixed(x * MIX + h[a + j : a + j + 1])
            out.append(mixed(x + np.uint64(m)))
        else:
            out.append(h[:0])
    return out


def sketch(s: np.ndarray) -> np.ndarray:
    """Parity of the shingles that fall on each of 64 * WORDS bits."""
    bits = np.bincount((mixed(s) >> np.uint64(40)).astype(np.int64) & (64 * WORDS - 1), minlength=64 * WORDS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def losses(n: int, percent: int) -> int:
    """Shingles of a set of n that a linked set may lack."""
    return n + (-percent * n) // 100


def shared(n):
    """Signatures that two linked sets share at least, given the size of the smaller."""
    return 1 + np.maximum(n - LONG, 0) // LONG_STEP


def signatures(s: np.ndarray, frequent: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Signatures of a set: two linked sets have `shared` of the smaller size in common."""
    if not len(s):
        return s
    need = losses(len(s), percent) + int(shared(len(s)))
    where = np.searchsorted(frequent, s)
    often = np.zeros(len(s), bool)
    inside = where < len(frequent)
    often[inside] = frequent[where[inside]] == s[inside]
    rare = s[~often]
    if len(rare) >= need:
        return rare[:need]
    out = [rare]
    need -= len(rare)
    level = max(0, len(s).bit_length() - 1 - CLASS_LEVEL)
    levels = [level]
    if level and percent * len(s) < 100 << (level + CLASS_LEVEL):  # a linked set may lie below the level's bound
        levels.append(level - 1)
    rest = s[often]
    for lv in levels:
        classes = 2 << lv
        of = (mixed(rest ^ MIX) >> np.uint64(20)).astype(np.int64) & (classes - 1)
        order = np.lexsort((np.arange(len(rest)), of))
        nth = np.empty(len(rest), np.int64)
        counts = np.bincount(of, minlength=classes)
        nth[order] = np.arange(len(rest)) - np.repeat(np.cumsum(counts) - counts, counts)
        gain = np.cumsum(nth > 0)
        take = int(np.searchsorted(gain, need)) + 1
        if take > len(rest):  # only in sets of one or two shingles, which link with equal sets alone
            continue
        p, c = rest[:take], of[:take]
        for k in range(classes):
            m = p[c == k]
            if len(m) > 1:
                i, j = np.triu_indices(len(m), 1)
                out.append(mixed(mixed(m[i] + np.uint64(lv)) * MIX + m[j]))
    return np.unique(np.concatenate(out))


def _set_rows(frequent: np.ndarray, percent: int, width: int, most: int):
    """Per document: size, 128-bit identity, sketch and signatures of its set."""

    def run(batches):
        for rows in chunks(batches, most):
            sets = shingle_sets([r[1] for r in rows], width)
            sigs = [signatures(s, frequent, percent).view(np.int64) for s in sets]
            ident = np.array([[mixed(s).sum(dtype=np.uint64), mixed(s ^ MIX).sum(dtype=np.uint64)] for s in sets], np.uint64).view(np.int64)
            lists = pa.ListArray.from_arrays(np.r_[0, np.cumsum([len(x) for x in sigs])].astype(np.int32), np.concatenate(sigs))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([len(s) for s in sets], pa.int32()), pa.array(ident[:, 0]), pa.array(ident[:, 1]), lists]
                + [pa.array(c) for c in np.stack([sketch(s) for s in sets], 1)],
                ["key", "n", "h1", "h2", "sigs", *SKETCH],
            )

    return run


def frequent_shingles(base: DataFrame, width: int = WIDTH, limit: int = FREQUENT_LIMIT, in_task: int = FREQUENT_IN_TASK) -> np.ndarray:
    """At most `limit` shingles, those of most documents first, counted where a part of a task holds `in_task` of them.

    The choice decides which signatures are pairs, never which documents link.
    """

    def run(batches):
        for rows in chunks(batches, 2_000_000):
            found, n = np.unique(np.concatenate(shingle_sets([r[1] for r in rows], width)), return_counts=True)
            keep = n >= in_task
            yield pa.RecordBatch.from_arrays([pa.array(found[keep].view(np.int64)), pa.array(n[keep].astype(np.int64))], ["s", "n"])

    top = base.mapInArrow(run, "s long, n long").groupBy("s").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "s").limit(limit)
    return np.sort(np.array([r[0] for r in top.select("s").collect()], np.int64).view(np.uint64))


def _screen(percent: int, across: bool):
    """Pairs of a posting that size and sketch allow.

    across=False: for each member the one of smaller key with the nearest sketch here, ties to the smallest.
    across=True: all pairs of different labels, with the signatures they share here and those they need to share.
    Pairs are made `PAIRS` at a time and reduced at once: the first kind keeps one row a member, the second is passed on.
    """

    def pairs(key, n, bits, label, block, group):
        """Row numbers (smaller key, larger key) and sketch distances, at most about `PAIRS` at a time."""
        begin = np.r_[True, group[1:] != group[:-1]]
        at = np.arange(len(key))
        place = at - np.maximum.accumulate(np.where(begin, at, 0))
        todo = np.cumsum(place)
        lo = 0
        while lo < len(key):
            hi = max(lo + 1, int(np.searchsorted(todo, (todo[lo - 1] if lo else 0) + PAIRS, side="right")))
            j = np.repeat(at[lo:hi], place[lo:hi])
            i = j - place[j] + np.arange(len(j)) - np.repeat(np.cumsum(place[lo:hi]) - place[lo:hi], place[lo:hi])
            ok = (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])) & (key[i] != key[j]) & ((block[i, 0] != block[j, 0]) | (block[i, 1] == block[i, 2]))
            if across:
                ok &= label[i] != label[j]
            i, j = i[ok], j[ok]
            apart = np.bitwise_count(bits[i] ^ bits[j]).sum(1, dtype=np.int64)
            ok = (100 + percent) * apart <= (100 - percent) * (n[i] + n[j])
            i, j, apart = i[ok], j[ok], apart[ok]
            if len(i):
                first = key[i] < key[j]
                yield np.where(first, i, j), np.where(first, j, i), apart
            lo = hi

    def rows(small, large, n, count):
        both = n[:, 0] + n[:, 1]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (small, large, count, shared(n.min(1)), both)], ["a", "b", "n", "need", "total"])

    def nearest(key, n, found):
        far = np.iinfo(np.int64).max
        best, of = np.full(len(key), far), np.full(len(key), -1)  # per row: distance and row of the nearest smaller key
        for i, j, apart in found:
            o = np.lexsort((key[i], apart, j))
            o = o[np.r_[True, j[o[1:]] != j[o[:-1]]]]
            i, j, apart = i[o], j[o], apart[o]
            better = (apart < best[j]) | ((apart == best[j]) & (key[i] < key[of[j]]))
            best[j[better]], of[j[better]] = apart[better], i[better]
        j = np.flatnonzero(of >= 0)
        o = j[np.lexsort((key[of[j]], best[j], key[j]))]  # a key may stand in several postings
        if len(o):
            o = o[np.r_[True, key[o[1:]] != key[o[:-1]]]]
            sizes = np.stack([n[of[o]], n[o]], 1)
            yield rows(key[of[o]], key[o], sizes, shared(sizes.min(1)))

    def counted(key, n, found):
        held: list[np.ndarray] = []

        def merged():
            bad, count = np.unique(np.concatenate(held), axis=0, return_counts=True)
            held.clear()
            return rows(bad[:, 0], bad[:, 1], bad[:, 2:], count)

        for i, j, _ in found:
            held.append(np.stack([key[i], key[j], n[i], n[j]], 1))
            if sum(map(len, held)) >= 2 * PAIRS:
                yield merged()
        if held:
            yield merged()

    def run(batches):
        held: list[pa.Table] = []

        def flush(t: pa.Table):
            t = t.combine_chunks()
            col = lambda c: t.column(c).to_numpy()
            bits = np.stack([col(c) for c in SKETCH], 1).view(np.uint64)
            block = np.stack([col(c) for c in ("block", "bi", "bj")], 1)
            ids = np.stack([col("sig"), block[:, 1].astype(np.int64), block[:, 2].astype(np.int64)], 1)
            group = np.r_[0, np.cumsum((ids[1:] != ids[:-1]).any(1))]
            key, n = col("key"), col("n").astype(np.int64)
            yield from (counted if across else nearest)(key, n, pairs(key, n, bits, col("label"), block, group))

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(pa.Table.from_batches([batch]))
            if sum(t.num_rows for t in held) >= 60_000:
                t = pa.concat_tables(held)
                last = [t.column(c)[-1].as_py() for c in ("sig", "bi", "bj")]
                same = np.logical_and.reduce([t.column(c).to_numpy() == v for c, v in zip(("sig", "bi", "bj"), last, strict=True)])
                cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
                if cut:
                    yield from flush(t.slice(0, cut))
                held = [t.slice(cut)]
        if held:
            yield from flush(pa.concat_tables(held))

    return run


def _candidates(postings: DataFrame, sketches: DataFrame, percent: int, across: bool) -> DataFrame:
    """a < b: pairs worth verifying, from postings (sig, key, n, label, place, size) and sketches (key, s0, ...).

    Pairs of small postings are counted first and screened by sketch after that. Members of larger postings meet with
    their sketches, block by block, so a posting may hold any share of the documents. To find each member one near
    partner, its own block and the first one are enough; all blocks meet when different components are compared.
    """
    few = postings.where(f"size <= {SMALL}").groupBy("sig").agg(F.sort_array(F.collect_list(F.struct("key", "n", "label"))).alias("m"))
    few = few.selectExpr("posexplode(m) AS (p, y)", "m").selectExpr("y", "explode(slice(m, 1, p)) AS x")
    few = few.where(f"100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n)" + (" AND x.label <> y.label" if across else ""))
    few = few.selectExpr("x.key AS a", "y.key AS b", "1L AS n", f"bigint(1 + greatest(least(x.n, y.n) - {LONG}, 0) DIV {LONG_STEP}) AS need", "bigint(x.n + y.n) AS total")

    dealt = postings.where(f"size > {SMALL}").withColumns({"block": F.expr(f"int(place DIV {BLOCK})"), "blocks": F.expr(f"int((size - 1) DIV {BLOCK})")})
    others = "sequence(0, blocks)" if across else "IF(block = 0, sequence(0, blocks), array(0, block))"
    dealt = dealt.selectExpr("sig", "key", "n", "label", "block", f"explode({others}) AS other")
    dealt = dealt.selectExpr("sig", "key", "n", "label", "block", "least(block, other) AS bi", "greatest(block, other) AS bj")
    rows = dealt.join(sketches, "key").repartition("sig", "bi", "bj").sortWithinPartitions("sig", "bi", "bj")
    rows = rows.select("sig", "key", "n", "block", "bi", "bj", "label", *SKETCH)
    many = rows.mapInArrow(_screen(percent, across), "a long, b long, n long, need long, total long")

    found = few.union(many).groupBy("a", "b").agg(F.sum("n").alias("n"), F.max("need").alias("need"), F.max("total").alias("total"))
    # across components the count decides; within them any choice is right, since those pairs follow later
    found = found.where("n >= need" if across else "4 * n >= need")
    for side in "ab":
        found = found.join(sketches.select(F.col("key").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in SKETCH]), side)
    apart = " + ".join(f"bit_count(a_{c} ^ b_{c})" for c in SKETCH)
    found = found.where(f"{100 + percent} * ({apart}) <= {100 - percent} * total")
    if across:
        return found.select("a", "b")
    return found.groupBy("b").agg(F.min_by("a", F.struct(F.expr(apart), "a")).alias("a")).select("a", "b")


def verified(pairs: DataFrame, base: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """a, b, linked: the exact test on the shingle sets of two texts. `pairs` is a stored table."""
    few = F.broadcast if pairs.count() <= BROADCAST_PAIRS else lambda x: x
    left = base.join(few(pairs), base.key == pairs.b).select("a", "b", F.col("text").alias("tb"))
    hubs = pairs.select("a").distinct()
    right = base.join(few(hubs), base.key == hubs.a).select("a", F.col("text").alias("ta"))

    def run(batches):
        for rows in chunks((b.select(["b", "tb", "a", "ta"]) for b in batches), 500_000):
            x, y = shingle_sets([r[1] for r in rows], width), shingle_sets([r[3] for r in rows], width)
            both = [len(np.intersect1d(p, q, assume_unique=True)) for p, q in zip(x, y, strict=True)]
            ok = [100 * o >= percent * (len(p) + len(q) - o) and o > 0 for o, p, q in zip(both, x, y, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([r[2] for r in rows], pa.int64()), pa.array([r[0] for r in rows], pa.int64()), pa.array(ok)], ["a", "b", "linked"])

    return left.join(right, "a").mapInArrow(run, "a long, b long, linked boolean")


def components(edges: DataFrame) -> DataFrame:
    """key, label: the smallest key that each endpoint of a stored edge list (a, b) can reach."""
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    label = stored(both.groupBy("a").agg(F.min("b").alias("m")).selectExpr("a AS key", "least(a, m) AS label"), "labels")
    while True:
        near = both.join(label.withColumnRenamed("key", "b"), "b").groupBy("a").agg(F.min("label").alias("m"))
        step = label.join(near, label.key == near.a).selectExpr("key", "label AS old", "least(label, m) AS label")
        up = step.selectExpr("key AS label", "label AS top")
        new = stored(step.join(up, "label").selectExpr("key", "old", "least(label, top) AS label"), "labels")
        moved = new.where("label <> old").limit(1).count()
        label = new.select("key", "label")
        if not moved:
            return label


def similar(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """`docs` with n_shingles, is_first (of its component) and component_id, the smallest id that links can reach.

    Words are runs of anything but ASCII white space, A-Z lower-cased. NULL and empty texts have no shingles and are
    alone, as are texts that link with nothing. Rows that repeat an id and a text are one document and get the same
    result; of different texts under one id each is a document; NULL ids sort last, and a component whose smallest
    member has a NULL id has a NULL component_id. Result columns replace input columns of these names.
    """
    docs = docs.drop("n_shingles", "is_first", "component_id", "_key")
    keyed, unique = row_key(docs)
    base = keyed.select(F.col("_key").alias("key"), "text")
    base = base if unique else base.distinct()
    frequent = base.sparkSession.sparkContext.broadcast(frequent_shingles(base, width))

    def rows(batches):
        yield from _set_rows(frequent.value, percent, width, 1_000_000)(batches)

    sets = stored(base.mapInArrow(rows, "key long, n int, h1 long, h2 long, sigs array<long>, " + ", ".join(f"{c} long" for c in SKETCH)), "sets")
    same = ["n", "h1", "h2"]
    first = sets.where("n > 0").groupBy(*same).agg(F.min("key").alias("rep"))
    own = sets.select("key", "n", "sigs").join(first.select(F.col("rep").alias("key")), "key", "left_semi")
    posting = "PARTITION BY sig"
    postings = stored(
        own.selectExpr("key", "n", "explode(sigs) AS sig")
        .selectExpr("sig", "key", "n", f"row_number() OVER ({posting} ORDER BY n, key) - 1 AS place", f"count(*) OVER ({posting}) AS size")
        .where("size > 1"),
        "postings",
    )
    bare = sets.select("key", *SKETCH)
    pairs = stored(_candidates(postings.withColumn("label", F.col("key")), bare, percent, False), "pairs")
    tested = stored(verified(pairs, base, percent, width), "tested")
    label = components(tested.where("linked"))
    labelled = sets.select("key").join(label, "key", "left").selectExpr("key", "coalesce(label, key) AS label")
    split = (
        postings.join(labelled, "key")
        .selectExpr("sig", "key", "n", "label", "place", "size", f"min(label) OVER ({posting}) <> max(label) OVER ({posting}) AS several").where("several")
    )
    more = _candidates(split.drop("several"), bare, percent, True)
    more = stored(more.join(tested.select("a", "b"), ["a", "b"], "left_anti"), "pairs")
    links = tested.where("linked").select("a", "b").union(verified(more, base, percent, width).where("linked").select("a", "b"))
    label = components(stored(links, "links"))
    of_set = sets.where("n > 0").join(first, same).select("key", "n", "rep")
    of_set = of_set.join(label.withColumnRenamed("key", "rep"), "rep", "left").selectExpr("key AS _set", "n AS _n", "coalesce(label, rep) AS _of")
    out = keyed.join(of_set, keyed._key == of_set._set, "left").selectExpr(
        *[f"`{c}`" for c in docs.columns], "bigint(coalesce(_n, 0)) AS n_shingles", "coalesce(_of, _key) AS _label", "coalesce(_of, _key) = _key AS is_first"
    )
    if unique:
        return out.withColumnRenamed("_label", "component_id")
    ids = keyed.selectExpr("_key AS _label", "doc_id AS component_id").distinct()
    return out.join(ids, "_label").drop("_label")


def keep_one_each(docs: DataFrame, **options) -> DataFrame:
    """The smallest document of every component, once."""
    return similar(docs, **options).where("is_first").select(*docs.columns).dropDuplicates(["doc_id", "text"])
