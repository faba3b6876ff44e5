"""Ordered groups of any size, cut into superblocks of a bounded number of rows.

`ordered` gives every row its place within its group, `keyed` names the superblock of a place: a group of more than
`size` rows is cut into blocks of `size` consecutive rows, small groups that begin in the same stretch of `size` rows
share one superblock, which so holds less than 2 * `size` rows. `scan` carries values along the superblocks of each
group, level by level, so that no task sees more than one superblock however long a group is.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.common import placed, stored

SIZE = 4096


def ordered(rows: DataFrame, group: str, order: list, name: str) -> DataFrame:
    """`rows` with _tree (the group: the place of its first row), _n (its rows) and _pos (place in it from 0).

    `group` is a column, NULL a group of its own; groups follow each other in its order, NULL first. Ranges of a large
    group are joined to its facts one by one, so no task holds a whole group.
    """
    rows = placed(rows, [F.col(group).asc_nulls_first(), *order], name)
    runs = rows.groupBy(F.col(group).alias("_g"), F.col("_part").alias("_p")).agg(F.min("_pos").alias("_first"), F.count("*").alias("_rows"))
    trees = runs.groupBy(F.col("_g").alias("_h")).agg(F.min("_first").alias("_tree"), F.sum("_rows").alias("_n"))
    facts = runs.join(trees, F.col("_g").eqNullSafe(F.col("_h"))).select("_g", "_p", "_tree", "_n")
    rows = rows.join(facts, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_part") == F.col("_p")))
    return rows.withColumn("_pos", F.expr("_pos - _tree")).drop("_g", "_p", "_part")


def keyed(rows: DataFrame, size: int = SIZE) -> DataFrame:
    """`rows` with _anchor and _block, which name the superblock."""
    return rows.withColumn("_anchor", F.expr(f"IF(_n <= {size}, -1 - _tree DIV {size}, _tree)")).withColumn("_block", F.expr(f"IF(_n <= {size}, 0L, _pos DIV {size})"))


def _each(rows: pd.DataFrame):
    """(tree, its rows in the frame, in order)."""
    rows = rows.sort_values(["_tree", "_pos"], kind="stable")
    yield from rows.groupby("_tree", sort=False)


def tops(rows: DataFrame, value: str, kind: str, up: Callable, size: int = SIZE) -> DataFrame:
    """One row per group and superblock: _tree, _n (superblocks of the group), _pos (which of them), value `up(values, whole)` of type `kind`.

    `whole` tells that the superblock holds the whole group.
    """

    def reduce(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for tree, g in _each(frame):
            n = int(g["_n"].iat[0])
            out.append((tree, -(-n // size), key[1], up(list(g[value]), n <= size)))
        return pd.DataFrame(out, columns=["_tree", "_n", "_pos", "value"])

    rows = keyed(rows.select("_tree", "_n", "_pos", value), size)
    return rows.groupBy("_anchor", "_block").applyInPandas(reduce, f"_tree long, _n long, _pos long, value {kind}")


def scan(items: DataFrame, kind: str, outer_kind: str, up: Callable, along: Callable, seed, size: int = SIZE) -> tuple[DataFrame, DataFrame]:
    """What surrounds each item, and the value of each whole group.

    `items` holds _tree, _n, _pos, value (`kind`), stored. `up(values, whole)` reduces a superblock; `along(outer, values, whole)`
    gives what surrounds each of its values when `outer` surrounds the superblock and `seed` a whole group.
    Returns (_tree, _pos, value, outer) per item and (_tree, value) per group.
    """
    above = stored(tops(items, "value", kind, up, size), "superblocks")
    done = above.where("_n = 1").select("_tree", "value")
    literal = "''" if seed == "" else f"array({', '.join(f'{x}L' for x in seed)})"
    around = above.where("_n = 1").selectExpr("_tree", "_pos", "1L AS _m", f"CAST({literal} AS {outer_kind}) AS outer")
    rest = above.where("_n > 1")
    if not rest.isEmpty():
        higher, more = scan(rest, kind, outer_kind, up, along, seed, size)
        done = done.unionByName(more)
        around = around.unionByName(higher.select("_tree", "_pos", F.lit(2).cast("long").alias("_m"), "outer"))
    around = around.withColumn("_anchor", F.expr(f"IF(_m = 1, -1 - _tree DIV {size}, _tree)")).withColumn("_block", F.expr("IF(_m = 1, 0L, _pos)"))

    def surround(key: tuple, frame: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        known, out = dict(zip(outer["_tree"], outer["outer"], strict=True)), []
        for tree, g in _each(frame):
            values = list(g["value"])
            found = along(known[tree], values, int(g["_n"].iat[0]) <= size)
            out += [(tree, p, v, o) for p, v, o in zip(g["_pos"], values, found, strict=True)]
        return pd.DataFrame(out, columns=["_tree", "_pos", "value", "outer"])

    joined = keyed(items.select("_tree", "_n", "_pos", "value"), size).groupBy("_anchor", "_block").cogroup(around.groupBy("_anchor", "_block"))
    result = joined.applyInPandas(surround, f"_tree long, _pos long, value {kind}, outer {outer_kind}")
    return stored(result, "superblocks"), stored(done, "superblocks")
