"""Language identification by cross-parsing entropy.

For each language the suffix automaton of a bounded piece of labelled text accepts exactly the substrings of that
text. A document is parsed against it greedily: every phrase is the longest match that continues from where the
last one ended. Few phrases mean a good description; phrases are normalised to bits per character,
(phrases * log2(length of the longest reference) + LITERAL * letters that the reference lacks) / characters, and the
language with the fewest bits wins. A phrase costs the same in every language, so a short reference is no advantage.

Texts are parsed in blocks of `BLOCK` normalised characters, so that all blocks of a batch advance together, one
character a step, as array operations; a phrase ends with its block in every language alike.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from scoreloom.llm.common import MIX, sliced

BLOCK = 256
UNDETERMINED = "und"
PIECES = 8  # places of a long document that a reference is taken from
LITERAL = 8.0  # bits of a letter that a reference lacks, on top of its phrase
EVIDENCE = 50  # characters at most that the posterior counts as independent

_TABLES: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def _unicode() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: whether it is a letter, and its lower-case code point where that is a single one."""
    if not _TABLES:
        letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
        lower = np.arange(0x110000, dtype=np.uint32)
        for i in np.flatnonzero(letter):
            small = chr(i).lower()
            if len(small) == 1:
                lower[i] = ord(small)
        _TABLES["u"] = letter, lower
    return _TABLES["u"]


def normalised(text: str) -> str:
    """Lower-cased letters; every run of other characters is one space, none at the ends."""
    letter, lower = _unicode()
    p = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    p = np.where(letter[p], lower[p], 32)
    p = p[(p != 32) | np.r_[False, p[:-1] != 32]]
    if len(p) and p[-1] == 32:
        p = p[:-1]
    return p.astype("<u4").tobytes().decode("utf-32-le")


def suffix_automaton(text: str) -> list[dict[str, int]]:
    """Transitions of the states of the suffix automaton of a text; state 0 is the start."""
    go: list[dict[str, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        new = len(go)
        go.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in go[p]:
            go[p][c] = new
            p = link[p]
        if p >= 0:
            q = go[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                twin = len(go)
                go.append(dict(go[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and go[p].get(c) == q:
                    go[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return go


@dataclass(frozen=True)
class Model:
    """Automata of all languages in one table of edges, and what normalises their phrases."""

    languages: list[str]
    alphabet: str
    roots: list[int]
    states: int
    edges: np.ndarray  # state, code, next state
    bits: float  # per phrase, whatever the language


def build(texts: dict[str, str]) -> Model:
    """Model of normalised reference texts by language, in the order of the languages' names; every letter of them has a code."""
    languages = sorted(texts)
    alphabet = "".join(sorted(set().union(*texts.values())))
    code = {c: i + 1 for i, c in enumerate(alphabet)}
    roots, edges, n = [], [], 0
    for name in languages:
        go = suffix_automaton(texts[name])
        roots.append(n)
        edges += [(n + s, code[c], n + to) for s, out in enumerate(go) for c, to in out.items()]
        n += len(go)
    return Model(languages, alphabet, roots, n, np.array(edges, np.int32).reshape(-1, 3), math.log2(max([2, *map(len, texts.values())])))


class Transitions:
    """Next states by state and code, as a hash table with linear probing: memory follows the edges, not states x alphabet."""

    def __init__(self, edges: np.ndarray, width: int):
        self.width = width
        bits = max(4, (4 * len(edges)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.next = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        key = edges[:, 0].astype(np.int64) * width + edges[:, 1]
        slot, left = self.slots(key), np.arange(len(key))
        while len(left):
            free = left[self.keys[slot[left]] < 0]
            self.keys[slot[free]] = key[free]  # of several on one slot the last stays
            placed = self.keys[slot[left]] == key[left]
            self.next[slot[left[placed]]] = edges[left[placed], 2]
            left = left[~placed]
            slot[left] = slot[left] + 1 & self.mask

    def slots(self, key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * MIX >> self.shift).astype(np.int64)

    def __call__(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Next states, -1 where there is none."""
        key = (state * self.width + code).ravel()
        slot = self.slots(key)
        found = self.keys[slot]
        to = self.next[slot].astype(np.int64)
        wrong = np.flatnonzero(found != key)
        to[wrong] = -1
        wrong = wrong[found[wrong] >= 0]
        while len(wrong):
            at = slot[wrong] = slot[wrong] + 1 & self.mask
            found = self.keys[at]
            hit = found == key[wrong]
            to[wrong[hit]] = self.next[at[hit]]
            wrong = wrong[~hit & (found >= 0)]
        return to.reshape(state.shape)


class Parser:
    """Counts phrases of many texts at once."""

    def __init__(self, model: Model):
        self.model = model
        width = len(model.alphabet) + 1
        self.go = Transitions(model.edges, width)
        letter, lower = _unicode()
        known = np.zeros(0x110000, np.uint32)
        known[[ord(c) for c in model.alphabet]] = np.arange(1, width)
        self.code = np.where(letter, known[lower], known[32])  # 0: unknown letter
        self.space = known[32]
        self.blank = ~letter
        root = np.array(model.roots, np.int64)
        self.root = root[:, None]
        self.restart = np.repeat(self.root, width, 1)  # language x code
        first = model.edges[np.isin(model.edges[:, 0], root)]
        self.restart[np.searchsorted(root, first[:, 0]), first[:, 1]] = first[:, 2]

    def codes(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Codes of all normalised texts one after the other, and where each begins (one more at the end)."""
        joined = "\n".join(texts) + "\n"
        p = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        size = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        first = np.r_[0, np.cumsum(size)]
        blank = self.blank[p]
        ends = first[1:] - 1
        keep = ~blank
        keep[1:] |= blank[1:] & ~blank[:-1]  # the first of a run of blanks
        keep[0] = not blank[0]
        keep[first[:-1]] = ~blank[first[:-1]]
        keep[ends] = False
        kept = np.r_[0, np.cumsum(keep)]
        last = kept[ends] - 1  # a blank at the end of a text goes, too
        packed, where = self.code[p[keep]], kept[first]
        tail = np.flatnonzero((last >= where[:-1]) & (kept[ends] > where[:-1]))
        tail = tail[blank[keep][last[tail]]] if len(packed) else tail
        if len(tail):
            gone = np.zeros(len(packed), bool)
            gone[last[tail]] = True
            where = where - np.r_[0, np.cumsum(gone)][where]
            packed = packed[~gone]
        return packed, where

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases (text x language) and normalised lengths of texts."""
        count, _, size = self.parse(texts)
        return count, size

    def parse(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phrases and letters that the reference lacks (text x language), and normalised lengths of texts."""
        codes, where = self.codes(texts)
        size = np.diff(where)
        blocks = -(-size // BLOCK)
        owner = np.repeat(np.arange(len(texts)), blocks)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        begin = where[owner] + nth * BLOCK
        length = np.minimum(BLOCK, where[owner + 1] - begin)
        order = np.argsort(-length, kind="stable")
        owner, begin, length = owner[order], begin[order], length[order]
        grid = np.zeros((BLOCK, len(owner)), np.uint32)  # step x block: what a step reads is contiguous
        live = np.searchsorted(-length, -np.arange(1, BLOCK + 1), side="right")
        for step in range(BLOCK):
            grid[step, : live[step]] = codes[begin[: live[step]] + step]
        state = np.repeat(self.root, len(owner), 1)
        count, missed = np.zeros(state.shape, np.int32), np.zeros(state.shape, np.int32)
        for step in range(BLOCK):
            k = live[step]
            if not k:
                break
            c = grid[step, :k]
            to = self.go(state[:, :k], c)
            which, block = np.nonzero(to < 0)
            if len(which):
                again = self.restart[which, c[block]]
                old, root = state[which, block], self.root[which, 0]
                count[which, block] += (old != root).astype(np.int32) + (again == root)
                missed[which, block] += (again == root) & (c[block] != self.space)
                to[which, block] = again
            state[:, :k] = to
        count += state != self.root
        total = np.zeros((2, len(self.model.languages), len(texts)), np.int64)
        for i in range(len(state)):
            total[0, i] = np.bincount(owner, count[i], len(texts))
            total[1, i] = np.bincount(owner, missed[i], len(texts))
        return total[0].T, total[1].T, size


def shares(sizes: list[int], total: int) -> list[int]:
    """Equal shares of a total; what a small size leaves unused passes on to the others."""
    out = [0] * len(sizes)
    order = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))
    for k, i in enumerate(order):
        out[i] = min(sizes[i], total // (len(sizes) - k))
        total -= out[i]
    return out


def sample(docs: DataFrame, languages: list[tuple[str, int]], chars: int, documents: int) -> dict[str, str]:
    """Normalised reference text per language: about `documents` documents by hash of the id, at most `chars` characters.

    All sampled documents share the characters equally. Of a long one, `PIECES` pieces spread evenly over its whole length are read.
    """
    rate = F.create_map(*[F.lit(x) for name, n in languages for x in (name, min(1.0, documents / n) * 2**20)])
    picked = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(2**20)) < rate[F.col("lang")])
    piece = -(-chars // PIECES)
    at = f"1 + bigint(i) * (length(text) - {piece}) div {max(1, PIECES - 1)}"
    pieces = f"CASE WHEN length(text) <= {chars} THEN array(text) ELSE transform(sequence(0, {PIECES - 1}), i -> substring(text, int({at}), {piece})) END"
    rows = picked.selectExpr("lang", "doc_id", f"{pieces} AS pieces").collect()
    by: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r.lang, r.doc_id, r.pieces)):
        by.setdefault(r.lang, []).append(" ".join(normalised(p) for p in r.pieces).strip())
    out = {}
    for name, texts in by.items():
        texts = [t for t in texts if t]
        room = max(0, chars - len(texts) + 1)  # blanks between texts
        out[name] = " ".join(_spread(t, n) for t, n in zip(texts, shares([len(t) for t in texts], room), strict=True) if n)
    return {k: v for k, v in out.items() if v}


def _spread(text: str, chars: int) -> str:
    """`chars` characters of a text, blanks between pieces included, in up to `PIECES` pieces from its beginning to its end."""
    if len(text) <= chars:
        return text
    n = max(1, min(PIECES, chars // 50))
    size = (chars - n + 1) // n
    return " ".join(text[k * (len(text) - size) // max(1, n - 1) :][:size].strip() for k in range(n))


def fit(labelled: DataFrame, chars: int = 24_000, documents: int = 60) -> Model:
    """Learn from doc_id, text, lang; rows with a NULL in any of them teach nothing.

    The sample is bounded whatever the table holds: per language about `documents` documents, chosen by a hash of
    the id, of which `chars` characters are kept, an equal share of each from all over its length. Rows are counted per language first, so every language that has
    text is learned, rare ones from all their rows.
    """
    docs = labelled.select("doc_id", "text", "lang").dropna().where(r"text RLIKE '\\p{L}'")
    counts = docs.groupBy("lang").count().collect()
    return build(sample(docs, [(r[0], r[1]) for r in counts], chars, documents) if counts else {})


def identify(docs: DataFrame, model: Model, most_chars: int = 1_000_000) -> DataFrame:
    """`docs` with lang_pred and score (0 to 1), which replace input columns of these names.

    NULL texts, texts without a letter, and any text when no language was learned give `und` with score 0. Ties go
    to the first language by name. A text in an alphabet that no language knows has single-letter phrases only and
    gets the first language too, with a score near 1 / languages. Repeated rows and NULL ids need no care: each
    row is judged by its text alone.
    """
    docs = docs.drop("lang_pred", "score")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = StructType([*docs.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    at = docs.columns.index("text")

    def run(batches):
        parser = None
        for batch in sliced(batches, 1024):
            texts = batch.column(at).to_pylist()
            if parser is None:
                parser = Parser(shared.value)
            named, scores = [], []
            for part in _parts(texts, most_chars):
                a, b = _judge(parser, part)
                named += a
                scores += b
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(named, pa.string()), pa.array(scores, pa.float64())], [*batch.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(run, schema)


def _parts(texts: list, most: int):
    part, size = [], 0
    for t in texts:
        part.append(t or "")
        size += len(t or "")
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part


def _judge(parser: Parser, texts: list[str]) -> tuple[list[str], list[float]]:
    model = parser.model
    if not model.languages:
        return [UNDETERMINED] * len(texts), [0.0] * len(texts)
    phrases, missed, size = parser.parse(texts)
    bits = (phrases * model.bits + missed * LITERAL) / np.maximum(size, 1)[:, None]
    best = bits.argmin(1)
    odds = np.exp2(-(bits - bits.min(1, keepdims=True)) * np.minimum(size, EVIDENCE)[:, None])
    score = 1 / odds.sum(1)
    return (
        [model.languages[b] if n else UNDETERMINED for b, n in zip(best, size, strict=True)],
        [float(s) if n else 0.0 for s, n in zip(score, size, strict=True)],
    )


def keep_identified(docs: DataFrame, model: Model) -> DataFrame:
    """Documents whose language can be told; a NULL `lang` is filled with the one found."""
    found = identify(docs, model).where(F.col("lang_pred") != UNDETERMINED)
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)
