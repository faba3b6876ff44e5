"""Packing of examples into fixed sequences: vector bin packing by the dot-product heuristic.

Every example has a demand vector (tokens, segments, loss-bearing tokens) and every sequence a capacity for each.
Whole sequences' worth of a long example become sequences of their own; what is left of each example is an item.
A sequence takes, again and again, the item with the largest weighted dot product of its demand and the remaining
capacity among those that fit in all dimensions. When none fits, the head of the item with the largest dot product
fills the gap. Each task packs its own rows with a bounded pool of items, so nothing is shuffled; what remains at
the end of a task is laid into sequences whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from scoreloom.llm.common import rows_of

POOL = 4096  # items that a task holds at once
PIECE = "start long, length long, ids_crc32 long, doc_tokens long, loss_tokens long, sequence_id long, offset long"


@dataclass(frozen=True)
class Limits:
    """What a sequence may hold."""

    tokens: int = 1024
    segments: int = 256
    loss_tokens: int = 1024


class Item:
    """The ids of an example (id, number of ids, number of leading ids without loss) from `start` on."""

    __slots__ = ("example", "start", "ids")

    def __init__(self, example: tuple, start: int, ids: np.ndarray):
        self.example, self.start, self.ids = example, start, ids

    def demand(self) -> tuple[int, int, int]:
        end = self.start + len(self.ids)
        return len(self.ids), 1, max(0, end - max(self.start, self.example[2]))

    def most(self, tokens: int, loss: int) -> int:
        """How many ids from the start fit into so many tokens and loss-bearing tokens."""
        return min(tokens, len(self.ids), max(0, self.example[2] - self.start) + loss)

    def cut(self, size: int) -> tuple[Item, Item]:
        return Item(self.example, self.start, self.ids[:size]), Item(self.example, self.start + size, self.ids[size:].copy())


class Packer:
    """Packs items in arrival order, pool by pool; yields (sequence number, offset, item)."""

    def __init__(self, limits: Limits):
        self.limits = np.array([limits.tokens, limits.segments, limits.loss_tokens], np.int64)
        if self.limits.min() < 1:
            raise ValueError("limits must be positive")
        self.pool: list[Item] = []
        self.sequences = 0

    def add(self, doc, ids: np.ndarray, without_loss: int) -> Iterator[tuple[int, int, Item]]:
        rest = Item((doc, len(ids), without_loss), 0, ids)
        while len(rest.ids):
            item, rest = rest.cut(rest.most(int(self.limits[0]), int(self.limits[2])))
            if len(item.ids) == self.limits[0]:
                yield from self._place([item])
            else:
                self.pool.append(Item(item.example, item.start, item.ids.copy()))
        if len(self.pool) >= POOL:
            yield from self._pack(last=False)

    def finish(self) -> Iterator[tuple[int, int, Item]]:
        yield from self._pack(last=True)

    def _place(self, items: list[Item]) -> Iterator[tuple[int, int, Item]]:
        offset = 0
        for item in items:
            yield self.sequences, offset, item
            offset += len(item.ids)
        self.sequences += 1

    def _pack(self, last: bool) -> Iterator[tuple[int, int, Item]]:
        """Fill sequences from the pool; unless `last`, stop while a quarter of the pool is left to choose from."""
        items, self.pool = self.pool, []
        demand = np.array([i.demand() for i in items], np.int64).reshape(-1, 3)
        live = np.ones(len(items), bool)
        weight = 1.0 / self.limits / self.limits
        left = len(items)
        while left > (0 if last else POOL // 4):
            room, chosen = self.limits.copy(), []
            while left and room.min() > 0:
                score = np.where(live, demand @ (weight * room), -1.0)
                fits = np.where((demand <= room).all(1), score, -1.0)
                k = int(fits.argmax())
                if fits[k] >= 0:
                    part, live[k], left = items[k], False, left - 1
                else:
                    k = int(score.argmax())
                    part, items[k] = items[k].cut(items[k].most(int(room[0]), int(room[2])))
                    demand[k] = items[k].demand()
                chosen.append(part)
                room -= np.array(part.demand())
            if last and not left and room[0]:
                yield from self._powers(chosen)
            else:
                yield from self._place(chosen)
        self.pool = [items[k] for k in np.flatnonzero(live)]

    def _powers(self, items: list[Item]) -> Iterator[tuple[int, int, Item]]:
        """Lay a last, partly filled sequence into sequences of falling powers of two."""
        total = sum(len(i.ids) for i in items)
        while total:
            want = size = 1 << (total.bit_length() - 1)
            chosen = []
            while want:
                head, rest = items[0].cut(want)
                items = [rest, *items[1:]] if len(rest.ids) else items[1:]
                chosen.append(head)
                want -= len(head.ids)
            yield from self._place(chosen)
            total -= size


_ENCODERS: dict[tuple[str, str], object] = {}


def encoder(json_path: str, rank_path: str | None):
    """text -> ids of the tokenizer file `json_path`.

    `rank_path` names the same vocabulary as ranks, which is read about four times as fast; texts that spell an
    added token of the tokenizer always go through the tokenizer itself, which gives that token's id.
    """
    if (json_path, rank_path) not in _ENCODERS:
        import base64
        import json
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        with open(json_path, encoding="utf-8") as f:
            added = [t["content"] for t in json.load(f)["added_tokens"]]
        slow: list = []  # loaded when a text needs it
        fast = None
        if rank_path:
            import public_tokenizers
            import tiktoken

            with open(rank_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

        def encode(text: str) -> list[int]:
            if fast is None or any(t in text for t in added):
                if not slow:
                    from tokenizers import Tokenizer

                    slow.append(Tokenizer.from_file(json_path))
                return slow[0].encode(text, add_special_tokens=False).ids
            return fast(text)

        _ENCODERS[json_path, rank_path] = encode
    return _ENCODERS[json_path, rank_path]


def vocabulary() -> tuple[str, str]:
    """Paths of the default tokenizer and of its ranks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def pack_documents(
    docs: DataFrame, limits: Limits = Limits(), *, paths: tuple[str, str | None] | None = None, end_id: int = 0,
    loss_from: str | None = None, with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, loss_tokens, sequence_id, offset [, ids].

    A document is the ids of its text followed by `end_id`; NULL texts are empty and so hold that id alone. The
    column `loss_from` gives the number of leading ids that bear no loss (NULL or absent: none), as for the prompt
    of instruction data. Every id lies in exactly one piece, pieces of a sequence follow each other without gap.
    Repeated rows and NULL ids are packed like any other row; an empty table gives no rows. sequence_id is unique
    across tasks: the task's partition number and a count within it.
    """
    paths = paths or vocabulary()
    kind = docs.schema["doc_id"].dataType.simpleString()
    cols = ["doc_id", "text", *([loss_from] if loss_from else [])]
    schema = f"doc_id {kind}, {PIECE}" + (", ids array<int>" if with_ids else "")

    def run(batches):
        encode, packer = encoder(*paths), Packer(limits)
        base = TaskContext.get().partitionId() << 33
        tail = np.array([end_id], "<u4")

        def rows(placed):
            for number, offset, item in placed:
                doc, n, _ = item.example
                extra = [item.ids.tolist()] if with_ids else []
                yield (doc, item.start, len(item.ids), zlib.crc32(item.ids), n, item.demand()[2], base + number, offset, *extra)

        def placed():
            for doc, text, *free in rows_of(batches):
                ids = np.concatenate([np.array(encode(text or ""), "<u4"), tail])
                yield from rows(packer.add(doc, ids, max(0, free[0] or 0) if free else 0))
            yield from rows(packer.finish())

        out = []
        for row in placed():
            out.append(row)
            if len(out) >= (500 if with_ids else 20_000):
                yield _batch(out, with_ids, kind)
                out = []
        if out:
            yield _batch(out, with_ids, kind)

    return docs.select(*cols).mapInArrow(run, schema)


def _batch(rows: list[tuple], with_ids: bool, kind: str) -> pa.RecordBatch:
    names = ["doc_id", *(c.split()[0] for c in PIECE.split(", ")), *(["ids"] if with_ids else [])]
    types = [{"string": pa.string(), "int": pa.int32()}.get(kind, pa.int64()), *[pa.int64()] * 7, *([pa.list_(pa.int32())] if with_ids else [])]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
