"""Token counts that follow edits.

The pre-tokens of a document, which a byte-level BPE encodes independently, are grouped into leaves; a segment tree
over the leaves holds sums of characters and tokens. An edit finds its leaves by descending the tree. Only those are
encoded again, with as many leaves before them as the edit can influence (its pre-token pattern looks ahead, never
behind) and as many after them until a new pre-token boundary meets an old leaf boundary. The sums above follow.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from scoreloom.llm.common import sliced

LEAF = 32  # pre-tokens of a leaf
CACHE = 500_000  # pre-tokens whose counts a task remembers
Edit = tuple[int, int, str]  # characters [start, end) become a text

_COUNTERS: dict[str, Counter] = {}


class Counter:
    """Counts tokens of single pre-tokens."""

    def __init__(self, rank_path: str):
        import base64

        import public_tokenizers
        import regex
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(rank_path, "rb"))}
        self.encode = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.split = regex.compile(public_tokenizers.PATTERN).findall
        self.known: dict[str, int] = {}

    def counts(self, pieces: list[str]) -> list[int]:
        known = self.known
        try:
            return [known[p] for p in pieces]
        except KeyError:
            if len(known) > CACHE:
                known.clear()
            for p in pieces:
                if p not in known:
                    known[p] = len(self.encode(p))
            return [known[p] for p in pieces]


def counter(rank_path: str) -> Counter:
    if rank_path not in _COUNTERS:
        _COUNTERS[rank_path] = Counter(rank_path)
    return _COUNTERS[rank_path]


def leaves(text: str, c: Counter) -> tuple[list[int], list[int]]:
    """Characters and tokens of each leaf of a text."""
    pieces = c.split(text)
    n = c.counts(pieces)
    cuts = range(0, len(pieces), LEAF)
    return [sum(map(len, pieces[i : i + LEAF])) for i in cuts], [sum(n[i : i + LEAF]) for i in cuts]


class SegmentTree:
    """Sums of characters and tokens over leaves; node i has the children 2i and 2i + 1."""

    def __init__(self, chars: list[int], tokens: list[int]):
        self.size = 1
        while self.size < max(1, len(chars)):
            self.size *= 2
        pad = [0] * (self.size - len(chars))
        self.n = len(chars)
        self.chars = [0] * self.size + list(chars) + pad
        self.tokens = [0] * self.size + list(tokens) + pad
        for i in range(self.size - 1, 0, -1):
            self._sum(i)

    def _sum(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def set(self, leaf: int, chars: int, tokens: int) -> None:
        i = self.size + leaf
        self.chars[i], self.tokens[i] = chars, tokens
        while i > 1:
            i //= 2
            self._sum(i)

    def find(self, at: int) -> tuple[int, int]:
        """The leaf that holds character `at`, and where it begins; the last leaf for the end of the text."""
        if at >= self.chars[1]:
            return self.n - 1, self.chars[1] - self.chars[self.size + self.n - 1] if self.n else 0
        i, begin = 1, 0
        while i < self.size:
            i *= 2
            if at >= begin + self.chars[i]:
                begin += self.chars[i]
                i += 1
        return i - self.size, begin

    def leaf_lists(self) -> tuple[list[int], list[int]]:
        s = self.size
        kept = [i for i in range(self.n) if self.chars[s + i]]
        return [self.chars[s + i] for i in kept], [self.tokens[s + i] for i in kept]


class Document:
    """A text with its tree. Leaves that an edit empties stay as zeros; what it adds goes into the leaves it touches."""

    def __init__(self, text: str, chars: list[int], tokens: list[int], c: Counter):
        self.text, self.tree, self.counter, self.encoded = text, SegmentTree(chars, tokens), c, 0

    @property
    def tokens(self) -> int:
        return self.tree.tokens[1]

    def apply(self, edit: Edit) -> None:
        start, end, new = edit
        old, tree = self.text, self.tree
        start = max(0, min(start, len(old)))
        end = max(start, min(end, len(old)))
        self.text = old[:start] + new + old[end:]
        if not tree.n:
            self.tree = SegmentTree(*leaves(self.text, self.counter))
            self.encoded += len(self.text)
            return
        first, left = tree.find(start)
        while first > 0 and not old[left:start].strip():  # a run of blanks before the edit looks ahead into it
            first -= 1
            left -= tree.chars[tree.size + first]
        last, right = tree.find(max(start, end - 1))
        right += tree.chars[tree.size + last]
        shift = len(new) - (end - start)
        while True:
            beyond = right
            after = last
            while after + 1 < tree.n and not old[right:beyond].strip():  # what a pre-token that ends here looks at
                after += 1
                beyond += tree.chars[tree.size + after]
            pieces, at, stop = self.counter.split(self.text[left : beyond + shift]), left, None
            if right == len(old):
                stop = len(pieces)
            else:
                for i, p in enumerate(pieces):
                    if at == right + shift:
                        stop = i
                        break
                    at += len(p)
            if stop is not None:
                break
            last += 1
            right += tree.chars[tree.size + last]
        self.encoded += right + shift - left
        pieces = pieces[:stop]
        n = self.counter.counts(pieces)
        places = last - first + 1
        step = -(-len(pieces) // places) or 1
        for k in range(places):
            a, b = k * step, (k + 1) * step
            tree.set(first + k, sum(map(len, pieces[a:b])), sum(n[a:b]))


def build_trees(docs: DataFrame, rank_path: str) -> DataFrame:
    """`docs` with leaf_chars, leaf_tokens and n_tokens; NULL and empty texts have no leaves and no tokens."""
    docs = docs.drop("leaf_chars", "leaf_tokens", "n_tokens")
    ints = ArrayType(IntegerType())
    schema = StructType([*docs.schema.fields, StructField("leaf_chars", ints), StructField("leaf_tokens", ints), StructField("n_tokens", LongType())])
    at = docs.columns.index("text")

    def run(batches):
        c = counter(rank_path)
        for batch in sliced(batches):
            made = [leaves(t or "", c) for t in batch.column(at).to_pylist()]
            kind = pa.list_(pa.int32())
            new = [pa.array([m[0] for m in made], kind), pa.array([m[1] for m in made], kind), pa.array([sum(m[1]) for m in made], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], schema.names)

    return docs.mapInArrow(run, schema)


def recount(trees: DataFrame, rank_path: str, find: Callable[[str], Iterable[Edit]] | None = None) -> DataFrame:
    """Apply edits to documents with trees; adds n_edits, n_tokens_after, n_encoded and updates text, leaves and n_chars.

    Edits are the column `edits`, an array of (start, end, text) in characters of the text as it stands when its turn
    comes, or what `find` makes of a text. Positions outside a text are moved to its ends; a NULL or empty list
    leaves a document as it is; edits of a NULL text apply to an empty one. `n_encoded` is the number of characters
    encoded again. Repeated rows and NULL ids need no care: a row's result depends on that row alone.
    """
    trees = trees.drop("n_edits", "n_tokens_after", "n_encoded")
    kept = [c for c in trees.columns if c != "edits"]
    fields = [f for f in trees.schema.fields if f.name in kept]
    schema = StructType([*fields, StructField("n_edits", IntegerType()), StructField("n_tokens_after", LongType()), StructField("n_encoded", LongType())])
    names = trees.columns

    def run(batches):
        c = counter(rank_path)
        for batch in sliced(batches):
            column = {n: batch.column(i) for i, n in enumerate(names)}
            texts, chars, tokens = (column[n].to_pylist() for n in ("text", "leaf_chars", "leaf_tokens"))
            given = column["edits"].to_pylist() if find is None else [find(t) if t else () for t in texts]
            out = []
            for t, ch, tk, edits in zip(texts, chars, tokens, given, strict=True):
                if not edits:
                    out.append((t, ch, tk, 0, sum(tk), 0))
                    continue
                d = Document(t or "", ch, tk, c)
                for e in edits:
                    d.apply((e["start"], e["end"], e["text"] or "") if isinstance(e, dict) else e)
                out.append((d.text, *d.tree.leaf_lists(), len(edits), d.tokens, d.encoded))
            cols = list(zip(*out, strict=True)) if out else [[]] * 6
            ints = pa.list_(pa.int32())
            column |= {"text": pa.array(cols[0], pa.string()), "leaf_chars": pa.array(cols[1], ints), "leaf_tokens": pa.array(cols[2], ints)}
            new = [pa.array(cols[3], pa.int32()), pa.array(cols[4], pa.int64()), pa.array(cols[5], pa.int64())]
            yield pa.RecordBatch.from_arrays([*(column[n] for n in kept), *new], schema.names)

    return trees.mapInArrow(run, schema)


def redactions(text: str) -> list[Edit]:
    """Edits that mask mail addresses, telephone and card numbers, last first so that positions hold."""
    import re

    if not _MASKS:
        # What is masked and by what.
        _MASKS.append((re.compile(r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+"), "<email>"))
        _MASKS.append((re.compile(r"\+?\d[\d ().-]{7,}\d"), "<number>"))
    found = sorted(((m.start(), m.end(), new) for pattern, new in _MASKS for m in pattern.finditer(text)), reverse=True)
    out: list[Edit] = []
    for start, end, new in found:
        if not out or end <= out[-1][0]:
            out.append((start, end, new))
    return out


_MASKS: list = []
