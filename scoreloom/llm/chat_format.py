"""Chat formatting: who says what in a raw transcript, by a hidden Markov model over its lines.

A line is described by its speaker marker (a user-like, assistant-like or system-like name, another name, a quote or
bullet sign, none) and by what the line is like (blank line before it, question, length, code or list). The hidden
state is the speaker's role together with whether the line begins a turn. Start, transition and emission
probabilities are counted on labelled transcripts; Viterbi gives the likeliest roles of all lines of a transcript at
once, so lines without a marker take their role from their surroundings. Turns are rendered in one canonical form.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from scoreloom.llm.common import sliced

ROLES = ("system", "user", "assistant")
STATES = [(r, begins) for r in ROLES for begins in (True, False)]
SAMPLE = 2_000

# Names that transcripts use for the three roles.
NAMES = {
    "system": "system sys instruction instructions context",
    "user": "user human me you customer client question q prompt input student visitor guest",
    "assistant": "assistant ai bot chatbot model agent answer a response output gpt support teacher expert",
}
_ROLE_OF = {name: role for role, names in NAMES.items() for name in names.split()}
_MARKER = re.compile(
    r"^\s*(?:[-*>]\s+)?(?:\#{1,6}\s*|\*\*|__|<\|?|\[)?(?:im_start\|>\s*)?([A-Za-z][A-Za-z0-9 ._-]{0,24}?)(?:\*\*|__|\|?>|\])?\s*(:|>|\||-)?(?:\*\*|__)?(?:\s+|$)"
)
_STRONG = re.compile(r"^\s*(?:[-*>]\s+)?(\#{1,6}\s*|\*\*|__|<\|?|\[)")
MARKERS = ("none", *ROLES, "name", "sign")
FEATURES = {"marker": len(MARKERS), "blank": 2, "question": 2, "length": 4, "form": 3}


def marker(line: str) -> tuple[str, int]:
    """Kind of the speaker marker at the start of a line, and where the line's own text begins."""
    m = _MARKER.match(line)
    if m and (m[2] or _STRONG.match(line)):
        word = m[1].strip().lower()
        if word in _ROLE_OF:
            return _ROLE_OF[word], m.end()
        if m[2] == ":" and len(word.split()) <= 3 and m[1][0].isupper():
            return "name", m.end()
    sign = re.match(r"^\s*(?:>+|-{1,2}|–|—)\s+", line)
    return ("sign", sign.end()) if sign else ("none", 0)


def observe(lines: list[str]) -> tuple[list[int], np.ndarray]:
    """Numbers of the lines that are not blank, and their features (line x feature)."""
    at, rows, blank = [], [], 1
    for i, line in enumerate(lines):
        if not line.strip():
            blank = 1
            continue
        kind, start = marker(line)
        body = line[start:].strip()
        length = 0 if len(body) < 30 else 1 if len(body) < 100 else 2 if len(body) < 300 else 3
        form = 1 if re.match(r"(?:```|    |\t)", line) else 2 if re.match(r"\s*(?:\d+[.)]|[-*•])\s", line) else 0
        at.append(i)
        rows.append((MARKERS.index(kind), blank, int(body.endswith("?")), length, form))
        blank = 0
    return at, np.array(rows, np.int64).reshape(-1, len(FEATURES))


@dataclass(frozen=True)
class Model:
    """Log probabilities."""

    start: np.ndarray
    move: np.ndarray
    emit: list[np.ndarray]  # per feature: state x value

    def scores(self, x: np.ndarray) -> np.ndarray:
        return sum((e[:, x[:, k]].T for k, e in enumerate(self.emit)), np.zeros((len(x), len(STATES))))


def fit_counts(sequences: list[tuple[np.ndarray, list[int]]]) -> Model:
    """Model of (features, states) sequences; unseen events keep a small probability."""
    n = len(STATES)
    start, move = np.full(n, 0.1), np.full((n, n), 0.1)
    emit = [np.full((n, v), 0.1) for v in FEATURES.values()]
    for s in range(n):
        if not STATES[s][1]:
            start[s] = 1e-6
        for t in range(n):  # a line inside a turn continues the turn of its own role
            if not STATES[t][1] and STATES[t][0] != STATES[s][0]:
                move[s, t] = 1e-6
    for x, states in sequences:
        if len(states):
            start[states[0]] += 1
            np.add.at(move, (states[:-1], states[1:]), 1)
            for k in range(len(emit)):
                np.add.at(emit[k], (states, x[:, k]), 1)
    return Model(np.log(start / start.sum()), np.log(move / move.sum(1, keepdims=True)), [np.log(e / e.sum(1, keepdims=True)) for e in emit])


def viterbi(model: Model, x: np.ndarray) -> tuple[list[int], float]:
    """Likeliest states of a sequence, ties to the earlier state, and their log probability."""
    if not len(x):
        return [], 0.0
    e = model.scores(x)
    best, back = model.start + e[0], []
    for row in e[1:]:
        way = best[:, None] + model.move
        back.append(way.argmax(0))
        best = way.max(0) + row
    path = [int(best.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1], float(best.max())


def messages(lines: list[str], at: list[int], states: list[int]) -> list[tuple[str, str]]:
    """Turns as (role, text): markers stripped, blank lines inside a turn kept, white space at the ends not."""
    out: list[tuple[str, list[str]]] = []
    last = 0
    for i, s in zip(at, states, strict=True):
        role, begins = STATES[s]
        if begins or not out or out[-1][0] != role:
            out.append((role, [lines[i][marker(lines[i])[1] :]]))
        else:
            out[-1][1].extend(["" for _ in range(last + 1, i)])
            out[-1][1].append(lines[i])
        last = i
    return [(role, "\n".join(part).strip()) for role, part in out]


def render(turns: list[tuple[str, str]]) -> str:
    """The canonical form: each turn between its role and an end mark, in order; marks inside a text are escaped as `<\\|`."""
    return "".join(f"<|{role}|>\n{text.replace('<|', '<' + chr(92) + '|')}\n<|end|>\n" for role, text in turns)


def fit(labelled: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from transcripts with roles: `text` and `roles`, an array with one entry per line that is not blank.

    An entry is a role, with a leading `+` where the line begins a turn. About `sample` transcripts are used, chosen
    by a hash of the text; rows with a NULL or with entries that do not match the lines teach nothing.
    """
    known = labelled.select("text", "roles").dropna()
    n = known.count()
    rows = known.where(F.pmod(F.xxhash64("text"), F.lit(2**20)) < int(2**20 * min(1.0, sample / max(n, 1))))
    rows = rows.orderBy(F.xxhash64("text", "roles"), "text").limit(2 * sample).collect()  # only texts that repeat very often exceed it
    names = {("+" if begins else "") + role: i for i, (role, begins) in enumerate(STATES)}
    sequences = []
    for text, roles in sorted((r.text, r.roles) for r in rows):
        at, x = observe(text.split("\n"))
        if len(roles) == len(at) and all(r in names for r in roles):
            sequences.append((x, [names[r] for r in roles]))
    return fit_counts(sequences)


def parse(transcripts: DataFrame, model: Model) -> DataFrame:
    """`transcripts` with messages, line_roles (as `fit` takes them), rendered and log_p for the column `text`.

    NULL and blank texts have no messages and render as an empty text. A transcript is a row and is decoded as a
    whole, in time and space linear in its lines. Input columns named like a result are replaced.
    """
    transcripts = transcripts.drop("messages", "line_roles", "rendered", "log_p")
    shared = transcripts.sparkSession.sparkContext.broadcast(model)
    turn = StructType([StructField("role", StringType()), StructField("text", StringType())])
    made = [StructField("messages", ArrayType(turn)), StructField("line_roles", ArrayType(StringType())), StructField("rendered", StringType()), StructField("log_p", DoubleType())]
    schema = StructType([*transcripts.schema.fields, *made])
    where = transcripts.columns.index("text")
    kinds = [pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])), pa.list_(pa.string()), pa.string(), pa.float64()]

    def run(batches):
        for batch in sliced(batches):
            out = []
            for text in batch.column(where).to_pylist():
                lines = (text or "").split("\n")
                at, x = observe(lines)
                states, p = viterbi(shared.value, x)
                turns = messages(lines, at, states)
                roles = [("+" if STATES[s][1] else "") + STATES[s][0] for s in states]
                out.append(([{"role": r, "text": t} for r, t in turns], roles, render(turns), p))
            new = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)] if out else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], schema.names)

    return transcripts.mapInArrow(run, schema)
