"""Exact ranking over data of any size.

Every value is placed in a cell by a monotone function of the value. The table of cells (rows, smallest and largest
value, totals) is counted once and stored; cells with too many rows are sliced between their own smallest and largest
value, again and again, until each fits or holds one value. Offsets of cells are prefix sums over the cell table. A large
cell of one value is ranked by the table alone; the rows of all others are exchanged once, by cell, and that exchange
serves both the grouping by value and the order inside the cell. No window ever covers a whole key, and because cells
depend only on the values, recomputing a lost task always gives the same placement. NaN counts as NULL.
"""

from __future__ import annotations

from math import ceil, floor
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .lookups import local_if_small

CELLS_PER_DECADE = 5000
CELL_ROWS = 50_000  # rows of a cell beyond which it is split, or the share of all rows below, if that is more
CROWDED_CELLS = 50_000  # cells that are split at once at most; they are broadcast
SLICES = 64  # of a crowded cell, at least
TASK_ROWS = 500_000  # that the exchange by cell deals to a task on average
LISTED_ROWS = 5_000_000  # of all cells with a wanted quantile, up to which their values are listed
MERGED_CELLS = 100_000  # that a task holds of a column before it adds up those of its blocks
FIRST_BITS, NEXT_BITS = 16, 10  # of a double in its order, that make the cells of the first and of a further pass
_EXPONENT_SHIFT = 330  # above the largest decimal exponent of a double, keeps cell numbers positive


def value_cell(x: Column, per_decade: int = CELLS_PER_DECADE) -> Column:
    """Monotone integer cell of a value: logarithmic grid mirrored around zero."""
    size = F.least(F.log10(F.abs(x)), F.lit(float(_EXPONENT_SHIFT)))  # infinities share the outermost cell
    cell = (F.floor((size + _EXPONENT_SHIFT) * per_decade) + 1).cast("int")
    return F.when(x == 0, F.lit(0)).otherwise(cell * F.signum(x).cast("int"))


def number_of(df: DataFrame, column: str) -> Column | None:
    """A column as a double in the same order: numbers, booleans, dates and timestamps; None for text."""
    kind = dict(df.dtypes)[column]
    x = F.col(column)
    if kind == "date":
        return F.unix_date(x).cast("double")
    if kind.startswith("timestamp"):
        return F.unix_micros(x.cast("timestamp")).cast("double")
    return None if kind.startswith(("string", "varchar", "char")) else x.cast("double")


class Cells(NamedTuple):
    """Rows with ``_cell``, the stored table of cells with ``_rows``, ``_first``, ``_last`` and the totals, the rows
    that only a cell of one value may exceed (None if no cell does), and the number of all rows."""

    rows: DataFrame
    table: DataFrame
    limit: int | None
    count: int


def settled_cells(
    rows: DataFrame, keys: list[str], value: str, totals: dict[str, Column] | None = None, cell: Column | None = None,
    extra: dict[str, Column] | None = None,
) -> Cells:
    """Cells in the order of the values, split until each holds at most ``limit`` rows or a single value.

    A slice of numbers is an equal part of the cell's own range, a slice of text the two characters after what its
    smallest and largest value have in common; either way both ends part, so the splitting ends. Values that are not
    NULL are expected, unless ``cell`` has a place for them. ``extra`` are further aggregates of the cell table.
    """
    aggregates = [F.sum(t).alias(n) for n, t in (totals or {}).items()] + [x.alias(n) for n, x in (extra or {}).items()]
    number = number_of(rows, value)
    if cell is None:
        cell = F.substring(value, 1, 3) if number is None else value_cell(number)
    v = F.col(value) if number is None else number

    def counted(df: DataFrame) -> DataFrame:
        ends = [F.min(v).alias("_lo"), F.max(v).alias("_hi"), F.min(value).alias("_first"), F.max(value).alias("_last")]
        return stored(df.groupBy(*keys, "_cell").agg(F.count(F.lit(1)).alias("_rows"), *ends, *aggregates), "cells")

    rows = rows.withColumn("_cell", cell)
    table = counted(rows)
    seen, most = table.agg(F.sum("_rows"), F.max("_rows")).first()
    limit = max(CELL_ROWS, (seen or 0) // CROWDED_CELLS)
    if (most or 0) <= limit:
        return Cells(rows, table, None, seen or 0)
    full = f"_rows > {limit} AND _lo < _hi" + ("" if number is None else " AND _hi - _lo < double('infinity')")
    kind = "string" if number is None else "long"
    path = F.array(F.col("_cell").cast(kind))
    rows, table, depth = rows.withColumn("_cell", path), table.withColumn("_cell", path), 1
    crowded = table.where(full)
    while not crowded.isEmpty():
        ends = F.broadcast(crowded.select(*keys, "_cell", "_rows", "_lo", "_hi"))  # at most CROWDED_CELLS rows
        if number is None:
            same = "aggregate(sequence(1, greatest(1, length(_lo))), 0, (n, i) -> IF(n = i - 1 AND substr(_lo, i, 1) = substr(_hi, i, 1), i, n))"
            part = F.expr(f"substr(`{value}`, 1 + {same}, 2)")
        else:
            part = F.floor((v - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * F.expr(f"greatest({SLICES}, 2 * ceil(_rows / {limit}))")).cast("long")
        inside = F.col("_rows").isNotNull()
        rows = rows.join(ends, [*keys, "_cell"], "left").withColumn("_cell", F.when(inside, F.concat("_cell", F.array(part))).otherwise(F.col("_cell")))
        rows = rows.drop("_rows", "_lo", "_hi")
        depth += 1
        finer = counted(rows.where(F.size("_cell") == depth))
        table = table.where(f"NOT coalesce(size(_cell) = {depth - 1} AND {full}, false)").unionByName(finer)
        crowded = finer.where(full)
    return Cells(rows, table, limit, seen)


def with_cells(rows: DataFrame, keys: list[str], value: str, cell: Column | None = None) -> DataFrame:
    """Rows with their settled ``_cell``."""
    return settled_cells(rows, keys, value, None, cell).rows


def present(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows without NULL or NaN in the columns."""
    kinds = dict(df.dtypes)
    tests = [f"`{c}` IS NOT NULL" + (f" AND NOT isnan(`{c}`)" if kinds[c] in ("double", "float") else "") for c in columns]
    return df.where(" AND ".join(tests))


def cumulate(
    rows: DataFrame, keys: list[str], value: str, totals: dict[str, Column], cell: Column | None = None
) -> DataFrame:
    """One row per (keys, value) with each total ``t``, its ``<t>_before`` (sum over strictly smaller values
    of the key) and ``<t>_all``; rows with a NULL or NaN key or value are left out.

    ``cell`` must not decrease as the value grows; the default fits numbers, dates, timestamps and text. Totals are
    computed behind the exchange, so the rows that travel hold no more than the columns which the totals read.
    """
    return cumulate_cells(settled_cells(present(rows, [*keys, value]), keys, value, totals, cell), keys, value, totals)


def cumulate_cells(cells: Cells, keys: list[str], value: str, totals: dict[str, Column]) -> DataFrame:
    """``cumulate`` over settled cells, whose table holds the totals."""
    names = list(totals)
    # A key has at most as many cells as the grid and its splits: these windows run over the cell table, not the data.
    by_key = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    upto = by_key.orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    table = cells.table.select(
        *keys, "_cell", "_rows", "_first", "_last", *names,
        *[(F.sum(t).over(upto) - F.col(t)).alias(f"_o_{t}") for t in names],
        *[F.sum(t).over(by_key).alias(f"{t}_all") for t in names],
    )
    base, alone = cells.rows, None
    if cells.limit is not None:
        one = (F.col("_rows") > cells.limit) & (F.col("_first") == F.col("_last"))
        # At most rows / limit cells, hence CROWDED_CELLS.
        base = base.join(F.broadcast(cells.table.where(one).select(*keys, "_cell")), [*keys, "_cell"], "left_anti")
        alone = table.where(one).select(
            *keys, F.col("_first").alias(value), *names, *[F.col(f"_o_{t}").alias(f"{t}_before") for t in names], *[f"{t}_all" for t in names]
        )
    # Sorted runs of narrow rows compress so well that parts sized by their bytes would hold too many of them.
    parts = [-(-cells.count // TASK_ROWS)] if cells.count > TASK_ROWS else []
    counts = base.repartition(*parts, *keys, "_cell").groupBy(*keys, "_cell", value).agg(*[F.sum(t).alias(n) for n, t in totals.items()])
    inner = (
        Window.partitionBy(*keys, "_cell").orderBy(value)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = counts.select("*", *[(F.sum(t).over(inner) - F.col(t)).alias(f"_i_{t}") for t in names])
    ranked = ranked.join(table.select(*keys, "_cell", *[f"_o_{t}" for t in names], *[f"{t}_all" for t in names]), [*keys, "_cell"]).select(
        *keys, value, *names,
        *[(F.col(f"_o_{t}") + F.col(f"_i_{t}")).alias(f"{t}_before") for t in names],
        *[f"{t}_all" for t in names],
    )
    return ranked if alone is None else ranked.unionByName(alone)


def ranked_scores(df: DataFrame, keys: list[str], score: str, target: str) -> DataFrame:
    """Distinct scores per key with positives and negatives, cumulated; rows without an outcome are left out."""
    y = F.col(target)
    totals = {"pos": F.when(y == 1, 1).otherwise(0), "neg": F.when(y == 0, 1).otherwise(0)}
    return cumulate(df.where(y.isNotNull()), keys, score, totals)


def discrimination(df: DataFrame, score: str, target: str, keys: list[str] | None = None) -> DataFrame:
    """N, positives, AUC, Gini and KS per key, ties counted half; one-class keys give NULL.

    KS is the largest TPR - FPR over thresholds "score >= s" (never below 0).
    """
    keys = keys or []
    r = ranked_scores(df, keys, score, target)
    d = lambda name: F.col(name).cast("double")
    wins = F.sum(d("pos") * (d("neg_before") + d("neg") / 2))
    p, n = F.max("pos_all"), F.max("neg_all")
    gap = F.when(
        (F.col("pos_all") > 0) & (F.col("neg_all") > 0),
        (d("pos_all") - d("pos_before")) / d("pos_all") - (d("neg_all") - d("neg_before")) / d("neg_all"),
    )
    agg = r.groupBy(*keys).agg(
        wins.alias("_wins"), p.alias("n_pos"), n.alias("n_neg"), F.greatest(F.max(gap), F.lit(0.0)).alias("_ks")
    )
    both = (F.col("n_pos") > 0) & (F.col("n_neg") > 0)
    auc = F.when(both, F.col("_wins") / (d("n_pos") * d("n_neg")))
    return agg.select(
        *keys,
        (F.col("n_pos") + F.col("n_neg")).alias("n"),
        "n_pos",
        auc.alias("auc"),
        (auc * 2 - 1).alias("gini"),
        F.when(both, F.col("_ks")).alias("ks"),
    )


def discrimination_of_groups(df: DataFrame, score: str, target: str, groups: list[tuple[str, Column]], keys: list[str]) -> DataFrame:
    """(keys, group, n, n_pos, auc, gini) of named, possibly overlapping groups of rows, from one ranking per key.

    The ranking carries positives and negatives of every group, so no row is copied per group; ``groups`` are few.
    """
    y, totals = F.col(target), {}
    for i, (_, inside) in enumerate(groups):
        totals[f"p{i}"] = F.when(inside & (y == 1), 1).otherwise(0)
        totals[f"n{i}"] = F.when(inside & (y == 0), 1).otherwise(0)
    any_group = F.lit(False)
    for _, inside in groups:
        any_group = any_group | F.coalesce(inside, F.lit(False))
    r = cumulate(df.where(y.isNotNull() & any_group), keys, score, totals)
    d = lambda name: F.col(name).cast("double")
    row = r.groupBy(*keys).agg(*[
        F.struct(F.max(f"p{i}_all").alias("p"), F.max(f"n{i}_all").alias("n"), F.sum(d(f"p{i}") * (d(f"n{i}_before") + d(f"n{i}") / 2)).alias("w")).alias(f"g{i}")
        for i in range(len(groups))
    ])
    per = F.explode(F.array(*[F.struct(F.lit(name).alias("group"), F.col(f"g{i}.p"), F.col(f"g{i}.n"), F.col(f"g{i}.w")) for i, (name, _) in enumerate(groups)]))
    row = row.select(*keys, per.alias("g")).select(*keys, "g.*").where("p + n > 0")
    auc = F.when((F.col("p") > 0) & (F.col("n") > 0), F.col("w") / (d("p") * d("n")))
    return row.select(*keys, "group", (F.col("p") + F.col("n")).alias("n"), F.col("p").alias("n_pos"), auc.alias("auc"), (auc * 2 - 1).alias("gini"))


def roc_points(df: DataFrame, score: str, target: str, keys: list[str] | None = None) -> DataFrame:
    """One point per distinct score: shares of negatives and positives at or above it."""
    keys = keys or []
    r = ranked_scores(df, keys, score, target)
    d = lambda name: F.col(name).cast("double")
    return r.where((F.col("pos_all") > 0) & (F.col("neg_all") > 0)).select(
        *keys,
        F.col(score).alias("threshold"),
        ((d("neg_all") - d("neg_before")) / d("neg_all")).alias("fpr"),
        ((d("pos_all") - d("pos_before")) / d("pos_all")).alias("tpr"),
    )


def two_sample_ks(df: DataFrame, features: list[str], flag: str) -> DataFrame:
    """Two-sided KS distance between the flag = 0 and flag = 1 rows of every feature."""
    long = df.select(flag, *[F.col(c).cast("double").alias(c) for c in features]).unpivot(
        [flag], features, "feature", "value"
    )
    r = ranked_scores(long, ["feature"], "value", flag)
    d = lambda name: F.col(name).cast("double")
    share = lambda t: (d(f"{t}_before") + d(t)) / F.when(F.col(f"{t}_all") > 0, d(f"{t}_all"))
    gap = F.abs(share("pos") - share("neg"))
    both = (F.col("pos_all") > 0) & (F.col("neg_all") > 0)
    return r.groupBy("feature").agg(
        F.max("neg_all").alias("n_0"),
        F.max("pos_all").alias("n_1"),
        F.count_if(F.col("neg") > 0).alias("distinct_0"),
        F.count_if(F.col("pos") > 0).alias("distinct_1"),
        F.max(F.when(both, gap)).alias("ks"),
    )


def exact_quantiles(df: DataFrame, features: list[str], probs: list[float], keys: list[str] | None = None) -> DataFrame:
    """Frame (keys, feature, edges) of exact linear-interpolated quantiles, all features in one plan.

    Rows are counted per cell, the prefix sums of the cells tell which cells hold a wanted order statistic, and only
    the rows of those cells (at most two per quantile) are counted by value. No pass shuffles more than cell counts and
    the values of the picked cells. Without keys the counts are made in blocks of rows, so no row is copied per feature.
    """
    if not keys:
        return _column_quantiles(df, features, probs)
    long = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in features]).unpivot(
        keys, features, "feature", "value"
    )
    by = [*keys, "feature"]
    long, cells, *_ = settled_cells(present(long, ["value"]), by, "value")
    cells = cells.withColumnRenamed("_rows", "_n")
    of_key = Window.partitionBy(*by)  # over the cell table
    upto = of_key.orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cells = cells.select(
        *by, "_cell", "_n", (F.sum("_n").over(upto) - F.col("_n")).alias("_before"), F.sum("_n").over(of_key).alias("_all")
    )
    picked = _with_wanted(cells, probs).where(F.size("_w") > 0).select(*by, "_cell", "_before", "_all")
    picked = local_if_small(picked)
    values = long.join(picked, [*by, "_cell"]).groupBy(*by, "_cell", "_before", "_all", "value").agg(
        F.count(F.lit(1)).alias("_n")
    )
    inner = Window.partitionBy(*by, "_cell").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    values = values.withColumn("_before", F.col("_before") + F.sum("_n").over(inner) - F.col("_n"))
    hits = _with_wanted(values, probs).select(*by, "value", "_before", "_n", F.explode("_w").alias("_w"))
    lo, hi = F.floor("_w.h"), F.ceil("_w.h")
    here = lambda rank: (rank >= F.col("_before")) & (rank < F.col("_before") + F.col("_n"))
    points = hits.groupBy(*by, F.col("_w.i").alias("_i")).agg(
        F.max(F.when(here(lo), F.col("value"))).alias("_lo"),
        F.max(F.when(here(hi), F.col("value"))).alias("_hi"),
        F.max(F.col("_w.h") - lo).alias("_f"),
    )
    edge = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_f")
    # The list is bounded by the number of requested quantiles.
    listed = F.array_sort(F.collect_list(F.struct(F.col("_i").alias("i"), edge.alias("v"))))
    return points.groupBy(*by).agg(F.transform(listed, lambda s: s["v"]).alias("edges"))


def _leading_bits(df: DataFrame, features: list[str], shift: int, parents: dict[int, list[int]] | None, above: int) -> DataFrame:
    """(feature, parent, cell, n, lo, hi): rows per column number and leading bits of the value in its order.

    A double's bits are turned into an integer of the same order; a cell is that integer without its last ``shift`` bits.
    With ``parents`` only rows are counted whose cell without the last ``above`` bits is one of its column's.
    """
    first = np.int64(shift)
    inside = None if parents is None else {i: np.array(sorted(p), np.int64) for i, p in parents.items()}
    chosen = list(range(len(features))) if parents is None else sorted(parents)

    def heads(k):
        """Where the cells of sorted integers begin."""
        return np.flatnonzero(np.diff(k >> first, prepend=~(k[0] >> first)))

    def merged(parts):
        n, lo, hi = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(lo)
        n, lo, hi = n[order], lo[order], hi[order]
        at = heads(lo)
        return np.add.reduceat(n, at), lo[at], np.maximum.reduceat(hi, at)

    def run(batches):
        parts, held = {i: [] for i in chosen}, dict.fromkeys(chosen, 0)
        for batch in batches:
            for c, i in enumerate(chosen):
                x = batch.column(c).to_numpy(zero_copy_only=False).astype(float)
                k = (x[~np.isnan(x)] + 0.0).view(np.int64)  # adding 0 makes a negative zero a plain one
                k = k ^ ((k >> np.int64(63)) & np.int64(2**63 - 1))
                if inside is not None:
                    cell, known = k >> np.int64(above), inside[i]
                    k = k[known[np.minimum(np.searchsorted(known, cell), len(known) - 1)] == cell]
                if not len(k):
                    continue
                k.sort()
                at = heads(k)
                ends = np.r_[at[1:], len(k)]
                parts[i].append((ends - at, k[at], k[ends - 1]))
                held[i] += len(at)
                if held[i] > max(MERGED_CELLS, len(parts[i][0][0])):
                    parts[i], held[i] = [merged(parts[i])], 0
        for i in chosen:
            if parts[i]:
                n, lo, hi = merged(parts[i])
                cell = lo >> first
                parent = cell if inside is None else cell >> np.int64(above - shift)
                columns = [pa.array(np.full(len(cell), i, np.int32)), *(pa.array(v) for v in (parent, cell, n, lo, hi))]
                yield pa.RecordBatch.from_arrays(columns, names=["feature", "parent", "cell", "n", "lo", "hi"])

    read = df.select(*[F.col(features[i]).cast("double").alias(f"_{i}") for i in chosen])
    found = read.mapInArrow(run, "feature int, parent long, cell long, n long, lo long, hi long")
    return found.groupBy("feature", "parent", "cell").agg(F.sum("n").alias("_n"), F.min("lo").alias("_lo"), F.max("hi").alias("_hi"))


def _column_quantiles(df: DataFrame, features: list[str], probs: list[float]) -> DataFrame:
    """``exact_quantiles`` without keys: passes over finer and finer leading bits, until each wanted cell holds one value.

    Per pass at most two cells per quantile reach the driver.
    """
    spark, found = df.sparkSession, {}
    shift, above, parents, starts = 64 - FIRST_BITS, 64, None, None
    while True:
        counted = _leading_bits(df, features, shift, parents, above)
        if starts is None:
            group = Window.partitionBy("feature")
            counted = counted.withColumns({"_start": F.lit(0).cast("long"), "_all": F.sum("_n").over(group)})
        else:
            group = Window.partitionBy("feature", "parent")
            known = spark.createDataFrame(starts, "feature int, parent long, _start long, _all long")
            counted = counted.join(F.broadcast(known), ["feature", "parent"])
        upto = group.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        counted = counted.withColumn("_before", F.col("_start") + F.sum("_n").over(upto) - F.col("_n"))
        # At most 2 x quantiles x features rows.
        picked = _with_wanted(counted, probs).where(F.size("_w") > 0).select("feature", "cell", "_n", "_lo", "_hi", "_before", "_all").collect()
        for r in picked:
            if r["_lo"] == r["_hi"]:
                for i, q in enumerate(probs):
                    h = (r["_all"] - 1) * float(q)
                    for end, rank in enumerate((floor(h), ceil(h))):
                        if r["_before"] <= rank < r["_before"] + r["_n"]:
                            found[r["feature"], i, end] = r["_lo"], h - floor(h)
        rest = [r for r in picked if r["_lo"] != r["_hi"]]
        if not rest:
            break
        parents, starts = {}, []
        for r in rest:
            parents.setdefault(r["feature"], []).append(r["cell"])
            starts.append((r["feature"], r["cell"], r["_before"], r["_all"]))
        few = sum(r["_n"] for r in rest) <= LISTED_ROWS and max(r["_n"] for r in rest) <= TASK_ROWS
        shift, above = (0 if few else max(0, shift - NEXT_BITS)), shift
    order = sorted({(i, q) for i, q, _ in found})
    edges: dict[str, list[float]] = {}
    for i, q in order:
        (lo, part), (hi, _) = found[i, q, 0], found[i, q, 1]
        lo, hi = _double_of(lo), _double_of(hi)
        edges.setdefault(features[i], []).append(lo + (hi - lo) * part)
    return spark.createDataFrame(list(edges.items()), "feature string, edges array<double>")


def _double_of(k: int) -> float:
    """The double of an integer of the same order."""
    bits = np.array([k], np.int64)
    return float((bits ^ ((bits >> np.int64(63)) & np.int64(2**63 - 1))).view(float)[0])


def _with_wanted(counted: DataFrame, probs: list[float]) -> DataFrame:
    """Add ``_w``: the quantiles (index i, fractional rank h) whose neighbours fall in this row's run of ranks."""
    wanted = ", ".join(f"named_struct('i', {i}, 'h', (_all - 1) * {float(q)!r}D)" for i, q in enumerate(probs))
    inside = "({0}(w.h) >= _before AND {0}(w.h) < _before + _n)"
    return counted.withColumn(
        "_w", F.expr(f"filter(array({wanted}), w -> {inside.format('floor')} OR {inside.format('ceil')})")
    )


def bounds(rows: DataFrame, keys: list[str], value: str, wanted: str) -> DataFrame:
    """(keys, bound): the largest value with fewer than ``wanted`` smaller rows in its key; absent where that is none.

    ``wanted`` is SQL over ``_all``, the rows of the key. Rows up to the bound are the first ``wanted`` (and the ties of
    the last). Cells are counted for all rows, and only those of one cell per key are put in order.
    """
    cells = settled_cells(present(rows, [*keys, value]), keys, value)
    by_key = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))  # over the cell table
    upto = by_key.orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    table = cells.table.withColumns({"_before": F.sum("_rows").over(upto) - F.col("_rows"), "_all": F.sum("_rows").over(by_key)})
    table = table.withColumn("_wanted", F.expr(f"least(_all, {wanted})")).where("_before < _wanted AND _wanted <= _before + _rows")
    picked = local_if_small(table.select(*keys, "_cell", "_before", "_wanted"))
    found = cells.rows.join(picked, [*keys, "_cell"]).groupBy(*keys, value, "_before", "_wanted").agg(F.count(F.lit(1)).alias("_n"))
    inner = by_key.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = found.withColumn("_before", F.col("_before") + F.sum("_n").over(inner) - F.col("_n")).where("_before < _wanted")
    return found.groupBy(*keys).agg(F.max(value).alias("bound"))


def approx_quantiles(df: DataFrame, features: list[str], probs: list[float], accuracy: int = 10000) -> DataFrame:
    """Same shape from bounded sketches: one pass without unpivoting, for very wide or very large inputs."""
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), probs, accuracy).alias(c) for c in features])
    return row.unpivot([], features, "feature", "edges").where(F.col("edges").isNotNull())
