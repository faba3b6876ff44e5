"""Merkle manifest of a dataset, by exchange of subtrees between superblocks.

Every row is a leaf; the leaves of a group (a source) ascend by id, and runs of `FAN` consecutive nodes become the SHA-256
of their concatenated hex digests until one node, the subroot, remains. Subroots in the order of their groups become the
root by the same rule. Leaves are cut into superblocks of `FAN ** 3`. A first pass reduces each superblock to its top; tops
are reduced again, superblock by superblock, until the root is known, and come back as the outer nodes of each superblock:
the siblings from its top to the root. In the last pass leaves and outer nodes are cogrouped by superblock, and one task call
finishes the local levels, joins both parts of each proof and folds it.

A path is written as text: levels separated by `/`, each the digests left and right of the node separated by `|`.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.common import placed, stored
from scoreloom.llm.superblocks import keyed, ordered, scan, tops

FAN = 16
LEVELS = 3  # of a superblock
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PROOF = "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def levels(nodes: list[str], whole: bool, fan: int = FAN, depth: int = LEVELS) -> list[list[str]]:
    """Levels of a superblock from its nodes to its top; one that is a whole tree ends as soon as one node remains."""
    out = [nodes]
    while len(out[-1]) > 1 if whole else len(out) <= depth:
        out.append([digest("".join(out[-1][i : i + fan])) for i in range(0, len(out[-1]), fan)])
    return out


def paths(steps: list[list[str]], outer: str, fan: int = FAN) -> list[str]:
    """Path of every node of the lowest level of `steps`, continued by `outer`."""
    found = [outer]
    for level in reversed(steps[:-1]):
        below = []
        for i in range(len(level)):
            first = i - i % fan
            step = "".join(level[first:i]) + "|" + "".join(level[i + 1 : first + fan])
            below.append(f"{step}/{found[i // fan]}" if found[i // fan] else step)
        found = below
    return found


def siblings(path: str) -> str:
    """All digests of a path, level by level, left to right."""
    return path.replace("/", "").replace("|", "")


def fold(node: str, path: str) -> str:
    """The root that a node leads to along a path."""
    for step in path.split("/") if path else ():
        left, right = step.split("|")
        node = digest(left + node + right)
    return node


def leaf(text: str = "text", fields=FIELDS) -> str:
    """SQL of a row's digest: every field as `-` if NULL, else its UTF-8 length, `:` and value; `text` stands in for the text."""
    parts = [text if f == "text" else f"CAST(`{f}` AS string)" for f in fields]
    return "sha2(concat(" + ", ".join(f"coalesce(concat(octet_length({p}), ':', {p}), '-')" for p in parts) + "), 256)"


TAMPERED = "IF(crc32(CAST(CAST(doc_id AS string) AS binary)) % 5 = 0, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), text)"


def manifest(docs: DataFrame, altered: str = "text", fan: int = FAN, depth: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row of documents.

    `altered` is SQL for a text that may differ from the one the manifest was made of: its row's leaf is computed anew and
    folded along the original siblings. NULL fields are written `-`, empty ones `0:`; NULL ids come first in their source and
    NULL sources first of all. Rows that share an id are ordered by their leaves; repeated rows are leaves of their own.
    Other columns take no part and are not returned. An empty table gives no rows.
    """
    size = fan**depth
    rows = docs.selectExpr("doc_id", "source", f"{leaf()} AS leaf", f"{leaf(altered)} AS altered")
    rows = ordered(rows, "source", [F.col("doc_id").asc_nulls_first(), "leaf"], "merkle-leaves")

    def up(nodes, whole):
        return levels(nodes, whole, fan, depth)[-1][0]

    def along(outer, nodes, whole):
        return paths(levels(nodes, whole, fan, depth), outer, fan)

    inner = stored(tops(rows.withColumnRenamed("leaf", "value"), "value", "string", up, size), "merkle-tops")
    within, subroots = scan(inner, "string", "string", up, along, "", size)
    places = placed(subroots, ["_tree"], "merkle-subroots").withColumnRenamed("_tree", "_source")
    trees = places.selectExpr("_source", "0L AS _tree", "_pos", "value")
    n = trees.count()
    over, root = scan(trees.withColumn("_n", F.lit(n).cast("long")), "string", "string", up, along, "", size)
    root = [r.value for r in root.collect()]  # one row, none for an empty table
    over = over.selectExpr("_pos AS _place", "value AS subroot", "outer AS _over").join(places.selectExpr("_source AS _tree", "_pos AS _place"), "_place")
    outer = within.select("_tree", "_pos", "outer").join(over, "_tree")
    outer = outer.join(inner.selectExpr("_tree", "_pos", "_n = 1 AS _small"), ["_tree", "_pos"]).selectExpr(
        "_tree", "subroot", "concat_ws('/', IF(outer = '', NULL, outer), IF(_over = '', NULL, _over)) AS outer",
        f"IF(_small, -1 - _tree DIV {size}, _tree) AS _anchor", "IF(_small, 0L, _pos) AS _block",
    )

    def prove(key: tuple, leaves: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        known = {t: (s, o) for t, s, o in zip(outer["_tree"], outer["subroot"], outer["outer"], strict=True)}
        out = []
        for tree, g in leaves.sort_values(["_tree", "_pos"]).groupby("_tree", sort=False):
            subroot, rest = known[tree]
            nodes = list(g["leaf"])
            steps = levels(nodes, int(g["_n"].iat[0]) <= size, fan, depth)
            for doc, node, changed, path in zip(g["doc_id"], nodes, g["altered"], paths(steps, rest, fan), strict=True):
                folded = fold(changed, path)
                out.append((None if pd.isna(doc) else int(doc), node, subroot, root[0], digest(siblings(path)), folded, folded == root[0]))
        return pd.DataFrame(out, columns=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]).astype({"doc_id": "Int64"})

    leaves = keyed(rows.selectExpr("_tree", "_n", "_pos", "CAST(doc_id AS string) AS doc_id", "leaf", "altered"), size)
    return leaves.groupBy("_anchor", "_block").cogroup(outer.groupBy("_anchor", "_block")).applyInPandas(prove, f"doc_id long, {_PROOF}")
