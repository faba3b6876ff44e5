"""Repair of damaged conversations by cheapest edits, the least audit among them chosen by path ranking.

The rows of a conversation and the states of the pattern `(s?(ua)+)?` span a graph of nodes (row, state). Its arcs are edits:
Keep, Rerole to user or assistant, Delete, Insert an empty turn. A DP from the end gives the cost to go of every node; arcs
that keep to it are optimal. Nodes are then ranked by their least audit of 1, 2, 4, ... initials: a pair of ranks, the node's
and that of the node which the pointer of the same length leads to, gives the rank of twice the length. At each node the arc of
the least (initial, rank of its end) is taken, and the path is read off the doubled pointers. An initial leads from a node to
one node only, because a row has one role and a state one next role, so the least audit of every length has a single end.

Conversations of more than `size` rows are cut into superblocks. Costs between the ends of a block are a (min, +) matrix and
the exits of its ranked paths a map of states; both are carried along the blocks by `superblocks.scan`, so a conversation
that holds a third of all rows is worked on block by block, and only its finished pieces are hashed in order, as a stream.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.common import rows_of, stored
from scoreloom.llm.superblocks import SIZE, keyed, ordered, scan

# States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant. Costs of the edits and what a state turns to.
NEXT = np.array([2, 2, 3, 2])
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
FAR = 1 << 50
ACCEPT = (0, FAR, FAR, 0)
INITIALS = "DIKR"
FAULTS = ("sound", "blank", "duplicate", "truncated")
_BLANK = r"text NOT RLIKE '[^\\x20\\x09-\\x0D]'"
_CUT = r"text NOT RLIKE '[.!?][\\x20\\x09-\\x0D]*\\z'"


def kept_state(initial: str) -> np.ndarray:
    """State after keeping a row of that role from each state, -1 where the pattern forbids it."""
    return np.array({"s": (1, -1, -1, -1), "u": (2, 2, -1, 2), "a": (-1, -1, 3, -1)}.get(initial, (-1, -1, -1, -1)))


_KEPT = np.stack([kept_state(x) for x in "sua?"])


def relaxed(v: np.ndarray) -> np.ndarray:
    """Costs to go of the states (first axis) of a layer when inserts are allowed in it."""
    two = np.minimum(v[2], INSERT + v[3])
    three = np.minimum(v[3], INSERT + v[2])
    return np.minimum(np.stack([np.minimum(v[0], INSERT + two), np.minimum(v[1], INSERT + two), two, three]), FAR)


def arcs(kind: int, fault: int) -> tuple[np.ndarray, np.ndarray]:
    """Costs and end states of Delete, Keep, Rerole of a row from each state: [edit, state]."""
    kept = _KEPT[kind]
    extra = TRUNCATED if fault == 3 else 0
    no = fault in (1, 2)
    cost = np.array([[DELETE] * 4, [FAR if no or s < 0 else extra for s in kept], [FAR if no else REROLE + extra] * 4])
    return cost, np.stack([np.arange(4), np.maximum(kept, 0), NEXT])


_COST, _TO = (np.stack([np.stack([arcs(k, f)[i] for f in range(4)]) for k in range(4)]) for i in (0, 1))  # [kind, fault, edit, state]


class Rows:
    """Kinds and faults of the rows of several conversations, one behind the other, and their layers of nodes.

    A conversation of m rows has m + 1 layers of four states; a node is layer * 4 + state.
    """

    def __init__(self, kinds, faults, sizes):
        self.kinds, self.faults, self.sizes = (np.asarray(x, np.int64) for x in (kinds, faults, sizes))
        self.first = np.r_[0, np.cumsum(self.sizes)]  # row
        self.top = self.first + np.arange(len(self.first))  # layer of the first row
        self.bottom = self.top[1:] - 1  # layer behind the last row
        self.layer = np.arange(len(self.kinds)) + np.repeat(np.arange(len(self.sizes)), self.sizes)

    def costs(self, ends: np.ndarray) -> np.ndarray:
        """Cost to go [layer, state] of all nodes, given that of each conversation's last layer; all of them advance together."""
        v = np.empty((len(self.kinds) + len(self.sizes), 4), np.int64)
        v[self.bottom] = ends
        order = np.argsort(-self.sizes, kind="stable")
        active = np.searchsorted(-self.sizes[order], -np.arange(1, int(self.sizes.max(initial=0)) + 1), side="right")
        for back, n in enumerate(active, 1):
            c = order[:n]
            row, layer = self.first[c + 1] - back, self.bottom[c] - back
            cost, to = _COST[self.kinds[row], self.faults[row]], _TO[self.kinds[row], self.faults[row]]
            ahead = np.take_along_axis(v[layer + 1][:, None].repeat(3, 1), to, 2)
            v[layer] = relaxed((cost + ahead).min(1).T).T
        return v

    def ranked(self, v: np.ndarray, last: np.ndarray):
        """Edit (index in INITIALS) of each node, -1 at the end of its path, and the doubled pointers of the least audits.

        The layer behind the last row holds exits, or, where `last` says so, the inserts that complete the pattern.
        """
        layers = len(v)
        cost, end = np.full((4, layers, 4), FAR), np.zeros((4, layers, 4), np.int64)
        c, to = _COST[self.kinds, self.faults], _TO[self.kinds, self.faults]
        for e, i in enumerate((0, 2, 3)):  # Delete, Keep, Rerole
            ahead = self.layer[:, None] + 1
            cost[i, self.layer] = c[:, e] + v[ahead, to[:, e]]
            end[i, self.layer] = ahead * 4 + to[:, e]
        cost[1], end[1] = INSERT + v[:, NEXT], np.arange(layers)[:, None] * 4 + NEXT
        good = (cost == v) & (v < FAR)
        closed = self.bottom[~last]
        good[:, closed] = False
        good[:, self.bottom[:, None], [0, 3]] = False  # the pattern is complete
        code = np.where(good, np.arange(4)[:, None, None], 8).reshape(4, -1)
        end, n = end.reshape(4, -1), layers * 4
        first = code.min(0)
        letter = np.where(first == 8, 0, first + 1)  # 0: end of the path
        goal = np.arange(n)
        to = np.where(letter > 0, end[np.minimum(first, 3), goal], goal)
        rank, pointers = letter, [to]
        for _ in range(max(1, int(3 * (int(self.sizes.max(initial=0)) + 2)).bit_length())):
            rank = np.unique(rank * (n + 5) + rank[pointers[-1]], return_inverse=True)[1]
            pointers.append(pointers[-1][pointers[-1]])
        # the least (initial, rank of the end) among the optimal arcs of each node
        key = code * (n + 5) + rank[end]
        return np.where(first == 8, -1, key.argmin(0)), pointers


TOGETHER = 64  # rows of conversations whose paths are read off in one matrix


def walks(starts: np.ndarray, sizes: np.ndarray, pointers) -> list[np.ndarray]:
    """Nodes of the paths from `starts`, their ends included, by doubling the known part."""
    out: list = [None] * len(starts)
    short = np.flatnonzero(sizes <= TOGETHER)
    for some in (short, *np.flatnonzero(sizes > TOGETHER)[:, None]):
        if not len(some):
            continue
        path = starts[some][:, None]
        for p in pointers:
            path = np.concatenate([path, p[path]], 1)
            if (path[:, -1] == path[:, -2]).all():
                break
        ends = (path == path[:, -1:]).argmax(1)
        for i, line, e in zip(some, path, ends, strict=True):
            out[i] = line[: e + 1]
    return out


ROLES = ("", "", "user", "assistant")


def piece(path, edit, top: int, roles, texts, faults, turns) -> tuple:
    """Cost, audit, repaired lines and counts of the rows of a block along its path; `top` is the layer of the first row."""
    audit, lines, total = [], [], 0
    nodes = path.tolist()
    for a, b in zip(nodes, nodes[1:]):  # noqa: B905
        i, e, state = a // 4 - top, edit[a], b % 4
        audit.append(INITIALS[e])
        if e == 1:
            total += INSERT
            lines.append(ROLES[state] + ":")
        else:
            total += DELETE if e == 0 else (e == 3) * REROLE + (faults[i] == 3) * TRUNCATED
            if e:
                lines.append((roles[i] if e == 2 else ROLES[state]) + ":" + texts[i])
    wrong = sum(1 for x, y in zip(roles, roles[1:]) if x[:1] + y[:1] not in ("su", "ua", "au"))  # noqa: B905
    known = [t for t in turns if t is not None]
    distinct = sum(1 for k, t in enumerate(known) if not k or t != known[k - 1])
    return (
        int(total), "".join(audit), "\n".join(lines), len(lines), *[sum(f == k for f in faults) for k in (1, 2, 3)], wrong,
        known[0] if known else None, known[-1] if known else None, distinct, roles[0][:1] if roles else None, roles[-1][:1] if roles else None,
    )


PIECE = (
    "cost long, audit string, body string, n_lines long, blank long, duplicate long, truncated long, illegal long, low long, high long,"
    " turns long, head string, tail string"
)
_PIECE = ["cost", "audit", "body", "n_lines", "blank", "duplicate", "truncated", "illegal", "low", "high", "turns", "head", "tail"]
RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def joined(pieces):
    """Columns of RESULT from the pieces of one conversation in order; bodies are hashed one by one."""
    hashed, some, audit, n = sha256(), False, [], dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost"), 0)
    low = high = tail = None
    distinct = 0
    for p in pieces:
        for k in n:
            n[k] += int(p[k])
        if p["n_lines"]:
            hashed.update(("\n" if some else "").encode() + p["body"].encode())
            some = True
        audit.append(p["audit"])
        if p["head"] is not None:
            n["illegal"] += tail is not None and tail + p["head"] not in ("su", "ua", "au")
            tail = p["tail"]
        if p["low"] is not None:
            distinct += p["turns"] - (high == p["low"])
            low, high = p["low"] if low is None else low, p["high"]
    gaps = 0 if low is None else high - low + 1 - distinct
    return gaps, n["blank"], n["duplicate"], n["truncated"], n["illegal"], n["cost"], "".join(audit), hashed.hexdigest()


def _product(a, b):
    return (a[:, :, None] + b[None, :, :]).min(1).clip(max=FAR)


def _matrix(values) -> np.ndarray:
    return np.array(list(values), np.int64).reshape(4, 4)


def _matrices_up(values, whole):
    out = _matrix(values[0])
    for v in values[1:]:
        out = _product(out, _matrix(v))
    return out.ravel().tolist()


def _ends(outer, values, whole):
    """Cost to go behind each block, from that behind the last one."""
    found, e = [], np.array(list(outer), np.int64)
    for v in reversed(values):
        found.append(e.tolist())
        e = (_matrix(v) + e).min(1).clip(max=FAR)
    return found[::-1]


def _maps_up(values, whole):
    state = list(range(4))
    for v in values:
        state = [int(v[s]) for s in state]
    return state


def _entries(outer, values, whole):
    """State in which each block is entered."""
    found, s = [], int(outer[0])
    for v in values:
        found.append([s])
        s = int(v[s])
    return found


def _live(frame: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame, Rows]:
    """First rows of the conversations of a superblock, all rows that are not gone in order, and these as `Rows`."""
    frame = frame.sort_values(["_tree", "_pos"], kind="stable")
    heads = frame[~frame["_tree"].duplicated()]
    live = frame[~frame["_gone"].to_numpy(bool)]
    sizes = live["_tree"].value_counts().reindex(heads["_tree"], fill_value=0).to_numpy()
    kinds = [k if x and (k := "sua".find(x[0])) >= 0 else 3 for x in live["role"]]
    return heads, live, Rows(kinds, live["_fault"].to_numpy(), sizes)


def repair(rows: DataFrame, size: int = SIZE) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation.

    `rows` holds conv_id, turn, role, text and may hold _gone: such rows only name their conversation. NULL roles and texts are one
    space, a NULL conv_id is a conversation of its own, NULL turns come first. Rows of one turn are ordered by role, then by the
    SHA-256 of role and text, so repeated rows stay adjacent. Roles that begin with neither s, u nor a can't be kept. Other
    columns take no part. An empty table gives no rows.
    """
    gone = "_gone" if "_gone" in rows.columns else "false AS _gone"
    rows = rows.selectExpr("conv_id", "CAST(turn AS long) AS turn", "coalesce(role, ' ') AS role", "coalesce(text, ' ') AS text", gone)
    rows = rows.withColumn("_same", F.expr("sha2(concat(length(role), ':', role, text), 256)"))
    rows = ordered(rows, "conv_id", [F.col("turn").asc_nulls_first(), "role", "_same"], "conversations")
    rows = rows.withColumn("_blank", F.expr(_BLANK))
    first = rows.where("NOT _gone AND NOT _blank").groupBy("_tree", "_same").agg(F.min("_pos").alias("_first"), F.count("*").alias("_k")).where("_k > 1").drop("_k")
    rows = rows.join(first, ["_tree", "_same"], "left").withColumn("_fault", F.expr(f"CASE WHEN _blank THEN 1 WHEN _pos > _first THEN 2 WHEN {_CUT} THEN 3 ELSE 0 END"))
    rows = rows.select("_tree", "_n", "_pos", "_gone", "conv_id", "turn", "role", "text", "_fault")
    rows = keyed(rows, size)

    many = rows.where(f"_n > {size}").select("_tree", "_n", "_pos", "_gone", "role", "_fault", "_anchor", "_block")
    bounds = _bounds(many, size) if not many.isEmpty() else None

    def solve(key: tuple, frame: pd.DataFrame, edges: pd.DataFrame | None = None) -> pd.DataFrame:
        heads, live, r = _live(frame)
        known = {} if edges is None else {t: (e, list(v), x) for t, e, v, x in zip(edges["_tree"], edges["entry"], edges["ahead"], edges["last"], strict=True)}
        whole = (0, relaxed(np.array(ACCEPT)).tolist(), True)
        entry, ends, last = zip(*[known.get(t, whole) for t in heads["_tree"]], strict=True)
        v = r.costs(np.array(ends, np.int64))
        edit, pointers = r.ranked(v, np.array(last, bool))
        paths = walks(r.top[:-1] * 4 + np.array(entry, np.int64), r.sizes, pointers)
        edit, out = edit.tolist(), []
        roles, texts, faults = (live[c].tolist() for c in ("role", "text", "_fault"))
        turns = [None if t is None else int(t) for t in live["turn"]]
        for i, (tree, conv) in enumerate(zip(heads["_tree"], heads["conv_id"], strict=True)):
            of = slice(r.first[i], r.first[i + 1])
            found = piece(paths[i], edit, int(r.top[i]), roles[of], texts[of], faults[of], turns[of])
            head = (None if conv is None else int(conv), tree, key[1])
            out.append(head + (joined([dict(zip(_PIECE, found, strict=True))]) if edges is None else found))
        names = [x.split()[0] for x in (RESULT if edges is None else PIECE).split(", ")]
        ints = ["conv_id", *([] if edges is None else ["low", "high"])]
        return pd.DataFrame(out, columns=["conv_id", "_tree", "_block", *names]).astype(dict.fromkeys(ints, "Int64"))

    texts = rows.select("_tree", "_n", "_pos", "_gone", F.col("conv_id").cast("string"), F.col("turn").cast("string"), "role", "text", "_fault", "_anchor", "_block")
    whole = texts.where(f"_n <= {size}").groupBy("_anchor", "_block").applyInPandas(lambda key, frame: solve(key, frame), f"conv_id long, _tree long, _block long, {RESULT}")
    whole = whole.drop("_tree", "_block")
    if bounds is None:
        return whole
    blocks = texts.where(f"_n > {size}").groupBy("_anchor", "_block").cogroup(bounds.groupBy("_anchor", "_block"))
    pieces = blocks.applyInPandas(lambda key, a, b: solve(key, a, b), f"conv_id long, _tree long, _block long, {PIECE}")
    return whole.unionByName(_streamed(pieces))


def _bounds(many: DataFrame, size: int) -> DataFrame:
    """_tree, _anchor, _block, entry, ahead, last: how the least path enters each block and the cost to go behind it."""

    def matrix(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        heads, _, r = _live(frame)
        units = [r.costs(np.where(np.arange(4) == end, 0, FAR)[None].repeat(len(heads), 0))[r.top[:-1]] for end in range(4)]
        values = np.stack(units, 2).reshape(len(heads), 16).tolist()
        return pd.DataFrame({"_tree": heads["_tree"], "_n": -(-heads["_n"] // size), "_pos": key[1], "value": values})

    schema = "_tree long, _n long, _pos long, value array<long>"
    matrices = stored(many.groupBy("_anchor", "_block").applyInPandas(matrix, schema), "repair-matrices")
    seed = relaxed(np.array(ACCEPT)).tolist()
    ends, _ = scan(matrices, "array<long>", "array<long>", _matrices_up, _ends, seed, size)
    ends = ends.join(matrices.select("_tree", "_pos", "_n"), ["_tree", "_pos"])
    ends = ends.selectExpr("_tree", "_n AS _m", "_tree AS _anchor", "_pos AS _block", "outer AS ahead", "_pos = _n - 1 AS last")

    def exits(key: tuple, frame: pd.DataFrame, edges: pd.DataFrame) -> pd.DataFrame:
        heads, _, r = _live(frame)
        known = {t: (m, list(v), x) for t, m, v, x in zip(edges["_tree"], edges["_m"], edges["ahead"], edges["last"], strict=True)}
        m, ends, last = zip(*[known[t] for t in heads["_tree"]], strict=True)
        _, pointers = r.ranked(r.costs(np.array(ends, np.int64)), np.array(last, bool))
        values = [(pointers[-1][t * 4 : t * 4 + 4] % 4).tolist() for t in r.top[:-1]]
        return pd.DataFrame({"_tree": heads["_tree"], "_n": m, "_pos": key[1], "value": values})

    maps = many.groupBy("_anchor", "_block").cogroup(ends.groupBy("_anchor", "_block")).applyInPandas(exits, schema)
    entries, _ = scan(stored(maps, "repair-maps"), "array<long>", "array<long>", _maps_up, _entries, [0], size)
    entries = entries.selectExpr("_tree", "_pos AS _block", "outer[0] AS entry")
    return ends.join(entries, ["_tree", "_block"]).select("_tree", "_anchor", "_block", "entry", "ahead", "last")


def _streamed(pieces: DataFrame) -> DataFrame:
    """Results of long conversations: SHA-256 needs their pieces in order, so these stream by, one in memory at a time."""
    names = ["conv_id", "_tree", "_block", *_PIECE]
    schema = f"conv_id long, {RESULT}"

    def merge(batches):
        def rows():
            for r in rows_of(batches):
                yield dict(zip(names, r, strict=True))

        source, found = rows(), []
        row = next(source, None)
        while row is not None:
            tree, conv = row["_tree"], row["conv_id"]

            def same():
                nonlocal row
                while row is not None and row["_tree"] == tree:  # noqa: B023
                    yield row
                    row = next(source, None)

            found.append((conv, *joined(same())))
            if len(found) >= 64:
                yield _batch(found, schema)
                found = []
        if found:
            yield _batch(found, schema)

    return pieces.select(*names).repartition("_tree").sortWithinPartitions("_tree", "_block").mapInArrow(merge, schema)


def _batch(rows: list, schema: str) -> pa.RecordBatch:
    fields = [x.split() for x in schema.split(", ")]
    types = [pa.int64() if kind == "long" else pa.string() for _, kind in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=[n for n, _ in fields])


def damaged(rows: DataFrame) -> DataFrame:
    """Rows of conversations damaged by a hash of their place: dropped (kept as _gone), emptied, without end marks, repeated or made user rows."""
    key = "concat(coalesce(CAST(conv_id AS string), ' '), ':', coalesce(CAST(turn AS string), ' '))"
    rows = rows.selectExpr("conv_id", "turn", "coalesce(role, ' ') AS role", "coalesce(text, ' ') AS text", f"crc32(CAST({key} AS binary)) % 20 AS _h")
    return rows.selectExpr(
        "conv_id", "turn", "IF(_h = 4, 'user', role) AS role", "CASE _h WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text", "_h = 0 AS _gone",
        "explode(array_repeat(0, IF(_h = 3, 2, 1))) AS _copy",
    ).drop("_copy")
