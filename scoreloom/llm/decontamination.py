"""Benchmark decontamination with DataFrame and SQL functions only.

A window is a run of `width` consecutive words of a benchmark item, or the whole item if it is shorter. Up to `set_limit`
distinct windows are shipped as a hash set inside the plan, so that documents are scanned once, without a shuffle. Up to
`broadcast_limit` their 64-bit hashes, a few dozen bytes each, are broadcast: the windows of documents are looked up where
they are read, and only hits go on to be verified word by word. A benchmark beyond that is joined by shuffle on the hashes.
The results are the same each time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WIDTH, SET_LIMIT, BROADCAST_LIMIT = 13, 20_000, 4_000_000
WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" r'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+', 0)"
)
RESULTS = ("n_words", "spans", "n_hit", "items")
NO_SPANS, NO_ITEMS = "CAST(array() AS array<struct<start: int, len: int>>)", "CAST(array() AS array<string>)"
IS_CONTAMINATED = "n_hit > 0 AND 20 * n_hit >= n_words"


def item_windows(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """item, len, win: the distinct windows of each item, words joined by one space. Items without words have none."""
    return (
        benchmark.selectExpr("CAST(item_id AS string) AS item", f"{WORDS} AS w")
        .where("size(w) > 0")
        .selectExpr("item", f"least(size(w), {width}) AS len", "w")
        .selectExpr("item", "len", "explode(transform(sequence(1, size(w) - len + 1), i -> concat_ws(' ', slice(w, i, len)))) AS win")
        .distinct()
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, set_limit: int = SET_LIMIT, broadcast_limit: int = BROADCAST_LIMIT
) -> DataFrame:
    """`docs` with n_words, spans (start, len of each occurring window, in words from 1), n_hit, items (sorted ids).

    NULL or empty texts have no words and no hits; an empty benchmark hits nothing; items with a NULL id count in
    n_hit but in no id list; repeated rows get the same result each; other columns are kept, but for those named
    like a result, which the result replaces.
    """
    docs = docs.drop(*RESULTS)
    windows = item_windows(benchmark, width)
    found = windows.select("len", "win").distinct().limit(set_limit + 1).collect()
    if len(found) > set_limit:
        return _by_hash(docs, windows, sorted(r[0] for r in windows.select("len").distinct().collect()), broadcast_limit)
    return docs.selectExpr("*", f"inline(array({_row(windows, found)}))")


def _let(value: str, name: str, body: str) -> str:
    """Bind an expression to a name, so that it is computed once per row wherever the optimizer moves it."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _covered(spans: str) -> str:
    """Words inside any of the spans, which are sorted by start."""
    return (
        f"aggregate({spans}, struct(0L AS n, 1L AS upto), (a, s) -> struct(a.n + greatest(0L, s.start + s.len - greatest(s.start, a.upto)) AS n,"
        " greatest(a.upto, bigint(s.start + s.len)) AS upto), a -> a.n)"
    )


def _row(windows: DataFrame, found: list) -> str:
    """The results of a row as one struct: word hashes, window hashes looked up in the set, then the words themselves."""
    if not found:
        return f"struct(bigint(size({WORDS})) AS n_words, {NO_SPANS} AS spans, 0L AS n_hit, {NO_ITEMS} AS items)"
    spark = windows.sparkSession
    hashed = spark.createDataFrame([tuple(r) for r in found], "len int, win string").selectExpr(
        "len", "win", "xxhash64(transform(split(win, ' '), x -> xxhash64(x))) AS h"
    )
    parts = []
    by_len: dict[int, list] = {}
    for r in hashed.collect():
        by_len.setdefault(r.len, []).append(r)
    for n, rows in sorted(by_len.items()):
        parts.append(
            f"transform(filter(sequence(1, greatest(size(h) - {n - 1}, 1)), i -> i + {n - 1} <= size(h)"
            f" AND xxhash64(slice(h, i, {n})) IN ({', '.join(f'bigint({_quoted(str(r.h))})' for r in rows)})"
            f" AND concat_ws(' ', slice(w, i, {n})) IN ({', '.join(_quoted(r.win) for r in rows)})), i -> struct(i AS start, {n} AS len))"
        )
    spans = _let("transform(w, x -> xxhash64(x))", "h", f"array_sort(concat({', '.join(parts)}))")
    of_item = windows.where("item IS NOT NULL").groupBy("item").agg(F.sort_array(F.collect_list("win")).alias("wins")).orderBy("item").collect()
    items = NO_ITEMS
    if of_item:
        table = ", ".join(f"struct({_quoted(r.item)} AS item, array({', '.join(map(_quoted, r.wins))}) AS wins)" for r in of_item)
        found_in = f"array_sort(transform(filter(array({table}), t -> arrays_overlap(t.wins, k)), t -> t.item))"
        hit = "array_distinct(transform(sp, s -> concat_ws(' ', slice(w, s.start, s.len))))"
        items = f"CASE WHEN size(sp) = 0 THEN {NO_ITEMS} ELSE {_let(hit, 'k', found_in)} END"
    body = f"struct(bigint(size(w)) AS n_words, sp AS spans, {_covered('sp')} AS n_hit, {items} AS items)"
    return _let(WORDS, "w", _let(spans, "sp", body))


def _by_hash(docs: DataFrame, windows: DataFrame, lens: list[int], broadcast_limit: int) -> DataFrame:
    """The way for a benchmark of any size: hashes of document windows meet those of the benchmark, then the words of the hits."""
    base = docs.selectExpr("*", f"{WORDS} AS _w", "sha2(coalesce(text, ''), 256) AS _row")
    hashes = windows.selectExpr("xxhash64(len, transform(split(win, ' '), x -> xxhash64(x))) AS h").distinct()
    if hashes.limit(broadcast_limit + 1).count() <= broadcast_limit:
        hashes = F.broadcast(hashes)
    parts = ", ".join(
        f"transform(filter(sequence(1, greatest(size(_h) - {n - 1}, 1)), i -> i + {n - 1} <= size(_h)),"
        f" i -> struct(i AS start, {n} AS len, xxhash64({n}, slice(_h, i, {n})) AS h))"
        for n in lens
    )
    words = base.selectExpr("_row", "transform(_w, x -> xxhash64(x)) AS _h").selectExpr("_row", f"inline(concat({parts}))")
    hits = words.join(hashes, "h", "left_semi").select("_row", "start", "len").distinct()
    hits = hits.groupBy("_row").agg(F.collect_list(F.struct("start", "len")).alias("_at"))
    texts = base.select("_row", "_w").join(hits, "_row").dropDuplicates(["_row"])  # documents with hits only
    spots = texts.selectExpr("_row", "inline(transform(_at, s -> struct(s.start AS start, s.len AS len, concat_ws(' ', slice(_w, s.start, s.len)) AS win)))")
    spots = spots.join(windows, ["win", "len"])
    found = spots.groupBy("_row").agg(F.array_sort(F.collect_set(F.struct("start", "len"))).alias("spans"), F.array_sort(F.collect_set("item")).alias("items"))
    out = base.selectExpr("* EXCEPT (_w)", "bigint(size(_w)) AS n_words").join(found, "_row", "left")
    out = out.withColumns({"spans": F.coalesce("spans", F.expr(NO_SPANS)), "items": F.coalesce("items", F.expr(NO_ITEMS))})
    return out.selectExpr(*[f"`{c}`" for c in docs.columns], "n_words", "spans", f"{_covered('spans')} AS n_hit", "items")


def remove_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Documents of which less than a twentieth of the words is hit, with the columns they came with."""
    return contamination(docs, benchmark, **options).where(f"NOT ({IS_CONTAMINATED})").select(*docs.columns)


def remove_spans(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """All documents, each hit word cut out of the text with the separators before it; NULL stays NULL."""
    gap = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
    pieces = f"regexp_extract_all(text, r'{gap}*[^{gap[1:]}+', 0)"
    cut = (
        f"CASE WHEN size(spans) = 0 THEN text ELSE concat(array_join(filter({pieces}, (x, i) -> NOT exists(spans,"
        f" s -> i + 1 >= s.start AND i + 1 < s.start + s.len)), ''), regexp_extract(text, r'{gap}*\\z', 0)) END"
    )
    return contamination(docs, benchmark, **options).withColumn("text", F.expr(cut)).select(*docs.columns)
