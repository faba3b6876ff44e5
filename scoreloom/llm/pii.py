"""Personal data: fixed patterns, and a character-level bidirectional LSTM with CRF transitions that adds what they miss.

The network is trained in numpy from labelled spans: those of the patterns in a bounded sample of documents, as they stand and
rewritten in other notations (`(at)` and `dot`, other separators, no country prefix). Every character has a class; an LSTM of
`HIDDEN` cells reads each window forwards and another backwards, both states give the scores of the tags (none or one of four
kinds), and the CRF's best path tags the window. Windows of `WINDOW` characters overlap by `OVERLAP`; where two meet, the cut is laid
at the character nearest to the middle of the overlap on which both agree, so a span is never cut by a window's edge.

A found span is added when it touches no pattern span, no letter or digit adjoins it, and its content fits its kind: an address
with both marks, four numbers up to 255, 14 to 19 digits that pass the Luhn test, 10 to 15 digits.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.common import chunks

KINDS = ("email", "ip", "card", "phone")  # tag 0 is none, tag i + 1 the kind i
HIDDEN, EMBEDDING = 8, 6
WINDOW, OVERLAP = 512, 40
PAD, CLASSES = 0, 99  # classes: padding, 95 printable ASCII characters, control, other letter, other
SAMPLE = 4000  # documents that labelled spans are taken from
PER_DOCUMENT = 8  # pieces of a document at most, per sort
SEED = 11

_MAIL_END = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*+\Z")
# In a run of digits a match fails from every digit if it fails from the first, so only that one is tried.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_NUMBERS = re.compile(r"[0-9][0-9. -]{6,}")  # holds whole matches of the two around it
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile("[^0-9]+")
_LOCAL_CHARACTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = sum(int(c) for c in digits[-1::-2]) + sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])
    return total % 10 == 0


def _mails(text: str):
    at, free = text.find("@"), 0
    while at >= 0:
        m = _MAIL_END.match(text, at)
        if m:
            start = at
            while start > free and text[start - 1] in _LOCAL_CHARACTERS:
                start -= 1
            if start < at:
                yield start, m.end()
                free = m.end()
        at = text.find("@", max(at + 1, free))


def _valid(kind: str, found: str) -> bool:
    if kind == "ip":
        return all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in found.split("."))
    digits = _NOT_DIGIT.sub("", found)
    return 14 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 10 <= len(digits) <= 15


def base_spans(text: str, check=_valid) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the patterns' matches that pass their checks, by start, then kind as listed."""
    found = [(s, 0, e) for s, e in _mails(text)]
    for r in _NUMBERS.finditer(text):
        found += [(m.start(), 1, m.end()) for m in _IP.finditer(text, r.start(), r.end()) if check("ip", m[0])]
        found += [(m.start(), 2, m.end()) for m in _CARD.finditer(text, r.start(), r.end()) if check("card", m[0])]
    found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if check("phone", m[0])]
    return [(s, KINDS[k], e) for s, k, e in sorted(found)]


_AT = r"(?:\s?@\s?|\s?[(\[{<]\s?at\s?[)\]}>]\s?)"
_DOT = r"(?:\.|\s?[(\[{<]\s?dot\s?[)\]}>]\s?|\sdot\s)"
_ADDRESS = re.compile(rf"[a-z0-9._%+-]+(?:{_AT}[a-z0-9-]+(?:{_DOT}[a-z0-9-]+)+|\sat\s[a-z0-9-]+(?:\sdot\s[a-z0-9-]+)+)", re.IGNORECASE)


def fits(kind: str, text: str, start: int, end: int) -> bool:
    """Whether a span found by the network is what its kind calls for."""
    if (start and text[start - 1].isalnum()) or (end < len(text) and text[end].isalnum()):
        return False
    found = text[start:end]
    if kind == "email":
        return _ADDRESS.fullmatch(found) is not None
    parts = re.findall("[0-9]+", found)
    digits = "".join(parts)
    if kind == "ip":
        return len(parts) == 4 and all(len(p) < 4 and int(p) <= 255 for p in parts)
    return 14 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 10 <= len(digits) <= 15


# --- the network -----------------------------------------------------------------------------------------------------------

_TABLE: list[np.ndarray] = []


def encoded(text: str) -> np.ndarray:
    """Class of every code point."""
    if not _TABLE:
        table = np.full(0x110000, CLASSES - 1, np.uint8)
        table[[i for i in range(128, 0x30000) if chr(i).isalpha()]] = CLASSES - 2
        table[:32] = CLASSES - 3
        table[127] = CLASSES - 3
        table[32:127] = np.arange(1, 96)
        _TABLE.append(table)
    return _TABLE[0][np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]


NAMES = ("e", "w", "g", "u", "a", "b", "t")


@dataclass(frozen=True)
class Model:
    """Character vectors, then input, bias and recurrent weights of both directions (gates: in, forget, out, cell), tag weights, bias and transitions."""

    e: np.ndarray  # [EMBEDDING, CLASSES]
    w: np.ndarray  # [2, 4 * HIDDEN, EMBEDDING]
    g: np.ndarray  # [2, 4 * HIDDEN]
    u: np.ndarray  # [2, 4 * HIDDEN, HIDDEN]
    a: np.ndarray  # [2, tags, HIDDEN]
    b: np.ndarray  # [tags]
    t: np.ndarray  # [tags, tags]


TAGS = 1 + len(KINDS)
_ALLOWED = (np.eye(TAGS, dtype=bool)) | (np.arange(TAGS) == 0) | (np.arange(TAGS) == 0)[:, None]  # kinds never touch
_NEVER = np.float32(-1e4)
_CLOSED = -60.0  # of the in and forget gates on padding, so the state behind it is that of a fresh start


def initial(rng: np.random.Generator, hidden: int = HIDDEN) -> Model:
    e = rng.normal(0, 1, (EMBEDDING, CLASSES))
    e[:, PAD] = 0
    w, u = rng.normal(0, 0.3, (2, 4 * hidden, EMBEDDING)), rng.normal(0, 0.3, (2, 4 * hidden, hidden))
    g = np.tile(np.repeat([0.0, 1.0, 0.0], [hidden, hidden, 2 * hidden]), (2, 1))
    a = rng.normal(0, 0.3, (2, TAGS, hidden))
    return Model(*(np.asarray(p, np.float32) for p in (e, w, g, u, a, np.r_[2.0, np.zeros(TAGS - 1)], np.where(_ALLOWED, 0, _NEVER))))


def inputs(p: dict[str, np.ndarray], direction: int) -> np.ndarray:
    """Input of every gate by character class, [4 * hidden, CLASSES]."""
    x = p["w"][direction] @ p["e"] + p["g"][direction][:, None]
    x[: x.shape[0] // 2, PAD] = _CLOSED
    return x


def emissions(model: Model, codes: np.ndarray) -> np.ndarray:
    """Tag scores [step, tag, window] of windows of character classes [step, window], padded behind their ends.

    One product a step: gates and the tag scores of the step before, from the state, the character's vector, one and the padding mark.
    """
    steps, n = codes.shape
    hidden = model.u.shape[2]
    size, gates = 4 * hidden, 3 * hidden
    out = np.empty((steps, TAGS, n), np.float32)
    out[:] = model.b[:, None]
    vectors = np.concatenate([model.e, np.ones((1, CLASSES)), np.arange(CLASSES)[None] == PAD]).astype(np.float32)
    z, s = np.empty((size + TAGS, n), np.float32), np.empty((hidden, n), np.float32)
    gate, inner, forget, outer, cell, tag = z[:gates], z[:hidden], z[hidden : 2 * hidden], z[2 * hidden : gates], z[gates:size], z[size:]
    for d in range(2):
        closed = np.zeros((size, 1))
        closed[: 2 * hidden] = _CLOSED
        m = np.zeros((size + TAGS, hidden + len(vectors)), np.float32)
        # sigmoid(x) = (1 + tanh(x / 2)) / 2; the state is kept doubled, its halves are in the weights
        m[:size] = np.concatenate([model.u[d] / 2, model.w[d], model.g[d][:, None], closed], 1) * np.repeat([0.5, 1.0], [gates, hidden])[:, None]
        m[size:, :hidden] = model.a[d] / 2
        state, c = np.zeros((hidden + len(vectors), n), np.float32), np.zeros((hidden, n), np.float32)
        h, read = state[:hidden], state[hidden:]
        before = -1
        for i in range(steps) if d == 0 else range(steps - 1, -1, -1):
            np.take(vectors, codes[i], axis=1, out=read, mode="clip")
            np.matmul(m, state, out=z)
            if before >= 0:
                out[before] += tag
            before = i
            np.tanh(z[:size], out=z[:size])
            gate += 1
            c *= forget
            np.multiply(inner, cell, out=s)
            c += s
            c *= 0.5
            np.tanh(c, out=s)
            np.multiply(outer, s, out=h)
        out[before] += m[size:] @ state
    return out


def best_tags(model: Model, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Tags [step, window] of the CRF's best paths; 0 behind a window's end."""
    steps, _, n = scores.shape
    t = model.t
    stay, enter, leave = np.diag(t)[1:, None].copy(), t[0, 1:, None].copy(), t[1:, 0, None].copy()
    v = np.empty_like(scores)
    v[0] = scores[0]
    kinds, none, came = np.empty((TAGS - 1, n), np.float32), np.empty(n, np.float32), np.zeros(n, bool)
    for i in range(1, steps):  # a kind follows itself or none
        p, q = v[i - 1], v[i]
        np.add(p[0], enter, out=q[1:])
        np.add(p[1:], stay, out=kinds)
        np.maximum(q[1:], kinds, out=q[1:])
        np.add(p[1:], leave, out=kinds)
        np.max(kinds, axis=0, out=none)
        np.add(p[0], t[0, 0], out=q[0])
        came |= none > q[0]
        np.maximum(q[0], none, out=q[0])
        q += scores[i]
    last = lengths - 1
    now = v[last, :, np.arange(n)].argmax(1)
    tags = np.zeros((steps, n), np.uint8)
    some = np.flatnonzero(came | (now > 0))  # the best paths of all others are none from end to end
    if len(some):
        last, now, k, v = last[some], now[some], np.zeros(len(some), np.int64), v[:, :, some]
        for i in range(steps - 1, -1, -1):
            k = np.where(last == i, now, k)
            tags[i, some] = k
            if i:
                k = np.where(last >= i, (v[i - 1] + t[:, k]).argmax(0), 0)
    return tags


def window_starts(length: int, window: int = WINDOW, overlap: int = OVERLAP) -> list[int]:
    """Starts of the windows of a text; the last one reaches its end."""
    return [0, *range(window - overlap, length - overlap, window - overlap)] if length > window else [0]


def reconciled(length: int, starts: list[int], tags: list[np.ndarray]) -> np.ndarray:
    """Tags of a whole text from those of its windows: at each overlap the cut is where both agree, nearest to its middle."""
    out = np.zeros(length, np.uint8)
    out[: len(tags[0])] = tags[0]
    for k in range(1, len(starts)):
        begin, end = starts[k], starts[k - 1] + len(tags[k - 1])
        middle = (end - begin) // 2
        same = np.flatnonzero(out[begin:end] == tags[k][: end - begin])
        cut = int(same[np.abs(same - middle).argmin()]) if len(same) else middle
        out[begin + cut : begin + len(tags[k])] = tags[k][cut:]
    return out


def runs(tags: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, tag) of the runs of equal tags other than 0."""
    edge = np.flatnonzero(np.diff(tags)) + 1
    edge = np.r_[0, edge, len(tags)]
    return [(int(s), int(e), int(tags[s])) for s, e in zip(edge[:-1], edge[1:], strict=True) if e > s and tags[s]]


def tagged(model: Model, texts: list[str], at_once: int = 2048, window: int = WINDOW, overlap: int = OVERLAP) -> dict[int, np.ndarray]:
    """Tags of every text in which the network finds a span, by its index. All windows of all texts are read, like long ones together."""
    codes = [encoded(t) for t in texts]
    places = [(i, s) for i, c in enumerate(codes) if len(c) for s in window_starts(len(c), window, overlap)]
    places.sort(key=lambda p: -min(window, len(codes[p[0]]) - p[1]))
    kept: dict[int, dict[int, np.ndarray]] = {}
    for k in range(0, len(places), at_once):
        some = places[k : k + at_once]
        pieces = [codes[i][s : s + window] for i, s in some]
        lengths = np.array([len(p) for p in pieces])
        block = np.zeros((len(some), lengths[0]), np.uint8)
        for row, p in zip(block, pieces, strict=True):
            row[: len(p)] = p
        block = np.ascontiguousarray(block.T).astype(np.intp)
        tags = best_tags(model, emissions(model, block), lengths)
        for w in np.flatnonzero(tags.any(0)):
            kept.setdefault(some[w][0], {})[some[w][1]] = tags[: lengths[w], w]
    out = {}
    for i, found in kept.items():
        n = len(codes[i])
        starts = window_starts(n, window, overlap)
        blank = np.zeros(window, np.uint8)
        out[i] = reconciled(n, starts, [found.get(s, blank[: min(window, n - s)]) for s in starts])
    return out


def added_spans(text: str, tags: np.ndarray, base: list[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
    """Spans of the network that fit their kind and touch no base span."""
    out = []
    for s, e, k in runs(tags):
        while s < e and text[s].isspace():
            s += 1
        while e > s and text[e - 1].isspace():
            e -= 1
        if e > s and not any(s < y and x < e for x, _, y in base) and fits(KINDS[k - 1], text, s, e):
            out.append((s, KINDS[k - 1], e))
    return out


# --- training --------------------------------------------------------------------------------------------------------------


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis)
    return top + np.log(np.exp(x - np.expand_dims(top, axis)).sum(axis))


def loss_and_gradient(p: dict[str, np.ndarray], codes: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean negative log likelihood of tag paths [step, window] and its gradient, by forward-backward and back-propagation through time."""
    steps, n = codes.shape
    hidden = p["u"].shape[2]
    real = codes != PAD
    x = [inputs(p, d) for d in range(2)]
    memory, scores = [], np.repeat(np.repeat(p["b"][None, :, None], steps, 0), n, 2)
    for d in range(2):
        order = range(steps) if d == 0 else range(steps - 1, -1, -1)
        h, c, kept = np.zeros((hidden, n), scores.dtype), np.zeros((hidden, n), scores.dtype), {}
        for i in order:
            z = x[d][:, codes[i]] + p["u"][d] @ h
            g = 1 / (1 + np.exp(-z[: 3 * hidden]))
            i_, f_, o_, c_ = g[:hidden], g[hidden : 2 * hidden], g[2 * hidden :], np.tanh(z[3 * hidden :])
            new = f_ * c + i_ * c_
            tc = np.tanh(new)
            kept[i] = (i_, f_, o_, c_, c, tc, h)
            c, h = new, o_ * tc
            scores[i] += p["a"][d] @ h
        memory.append((order, kept))
    scores = np.where(real[:, None], scores, np.where(np.arange(TAGS) == 0, 0, _NEVER).astype(scores.dtype)[None, :, None])
    t = p["t"]
    alpha, beta = np.empty_like(scores), np.zeros_like(scores)
    alpha[0] = scores[0]
    for i in range(1, steps):
        alpha[i] = scores[i] + _lse(alpha[i - 1][:, None] + t[:, :, None], 0)
    for i in range(steps - 2, -1, -1):
        beta[i] = _lse(t[:, :, None] + (scores[i + 1] + beta[i + 1])[None], 1)
    whole = _lse(alpha[-1], 0)
    here = np.take_along_axis(scores, tags[:, None], 1)[:, 0].sum(0) + t[tags[:-1], tags[1:]].sum(0)
    d_scores = np.exp(alpha + beta - whole)
    np.put_along_axis(d_scores, tags[:, None], np.take_along_axis(d_scores, tags[:, None], 1) - 1, 1)
    d_scores = np.where(real[:, None], d_scores, 0) / n
    between = np.exp(alpha[:-1, :, None] + t[None, :, :, None] + (scores[1:] + beta[1:])[:, None] - whole).sum((0, 3))
    seen = np.bincount((tags[:-1] * TAGS + tags[1:]).ravel(), minlength=TAGS * TAGS).reshape(TAGS, TAGS)
    grad = {"t": np.where(_ALLOWED, (between - seen) / n, 0), "b": d_scores.sum((0, 2)), **{k: np.zeros_like(p[k]) for k in ("e", "w", "g", "u", "a")}}
    for d, (order, kept) in enumerate(memory):
        dh, dc, dz_all = np.zeros((hidden, n), scores.dtype), np.zeros((hidden, n), scores.dtype), np.empty((steps, 4 * hidden, n), scores.dtype)
        for i in reversed(order):
            i_, f_, o_, c_, before, tc, h = kept[i]
            dh = dh + p["a"][d].T @ d_scores[i]
            grad["a"][d] += d_scores[i] @ (o_ * tc).T
            dc = dc + dh * o_ * (1 - tc * tc)
            dz = np.concatenate([dc * c_ * i_ * (1 - i_), dc * before * f_ * (1 - f_), dh * tc * o_ * (1 - o_), dc * i_ * (1 - c_ * c_)])
            grad["u"][d] += dz @ h.T
            dz_all[i] = dz
            dh, dc = p["u"][d].T @ dz, dc * f_
        flat = codes.ravel()
        dx = np.stack([np.bincount(flat, dz_all[:, r].ravel(), CLASSES) for r in range(4 * hidden)]).astype(scores.dtype)
        dx[:, PAD] = 0
        grad["w"][d], grad["g"][d] = dx @ p["e"].T, dx.sum(1)
        grad["e"] += p["w"][d].T @ dx
    return float((whole - here).mean()), grad


def train(examples: list[tuple[str, list[tuple[int, str, int]]]], rounds: int = 800, batch: int = 64, rate: float = 0.02, hidden: int = HIDDEN) -> Model | None:
    """Model of labelled pieces of text, by Adam; None without any span."""
    if not any(spans for _, spans in examples):
        return None
    rng = np.random.default_rng(SEED)
    rows = []
    for text, spans in examples:
        tags = np.zeros(len(text), np.int64)
        for s, kind, e in spans:
            tags[s:e] = 1 + KINDS.index(kind)
        rows.append((encoded(text).astype(np.int64), tags))
    start = initial(rng, hidden)
    p = {k: getattr(start, k) for k in NAMES}
    m, v = {k: np.zeros_like(w) for k, w in p.items()}, {k: np.zeros_like(w) for k, w in p.items()}
    order: list[int] = []
    for step in range(1, rounds + 1):
        if len(order) < batch:
            order += rng.permutation(len(rows)).tolist()
        chosen, order = [rows[i] for i in order[:batch]], order[batch:]
        longest = max(2, *(len(c) for c, _ in chosen))
        codes, tags = np.zeros((longest, len(chosen)), np.int64), np.zeros((longest, len(chosen)), np.int64)
        for w, (c, g) in enumerate(chosen):
            codes[: len(c), w], tags[: len(c), w] = c, g
        _, grad = loss_and_gradient(p, codes, tags)
        size = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
        now = rate * min(1, 5 / max(size, 1e-9)) * (1 - 0.9 * step / rounds)
        for k, g in grad.items():
            m[k] += 0.1 * (g - m[k])
            v[k] += 0.01 * (g * g - v[k])
            p[k] = p[k] - np.asarray(now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8), p[k].dtype)
    return Model(*(p[k].astype(np.float32) for k in NAMES))


def rewritten(kind: str, span: str, rng: np.random.Generator, like: str = "") -> str:
    """The same kind of data with other digits and letters, in a notation that the patterns may miss."""
    digit = lambda: str(rng.integers(10))
    pick = lambda *x: x[rng.integers(len(x))]
    word = lambda: pick(*(like.split() or ["mail"])).strip(".,;:!?()[]{}<>|\"'*%$&#") or "mail"
    if kind == "email":
        name = pick(span.split("@")[0], word(), f"{word()}.{word()}", f"{word()}{digit()}{digit()}", f"{word()}_{word()}")
        home = pick(span.split("@")[1].split("."), [word().lower(), pick("com", "org", "net", "info", "de", "fr", "es")])
        at, dot = pick(("@", "."), ("@", "."), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" at ", " dot "), ("(at)", "."), (" [at] ", "."), (" @ ", "."), (" AT ", " DOT "))
        return name + at + dot.join(home)
    if kind == "ip":
        dot = pick(".", ".", "[.]", "(.)", " . ", "-")
        return dot.join(str(rng.integers(256)) for _ in range(4))
    if kind == "card":
        digits, gap = "".join(digit() for _ in range(pick(14, 15, 16, 16, 16, 16, 19))), pick("", "", " ", "-", ".", "/", "_", "  ", " - ")
        return gap.join(digits[i : i + 4] for i in range(0, len(digits), 4))
    a, b, c = ("".join(digit() for _ in range(k)) for k in (3, 3, 4))
    lead, gap = pick("+1 ", "+1 ", "1 ", "", "", "001 ", "+49 ", "0049 ", "tel:"), pick("-", " ", ".", "/")
    return lead + pick(f"({a}) {b}-{c}", f"{a}{gap}{b}{gap}{c}", f"({a}){b}{gap}{c}", f"{a}{gap}{b}{c}")


def examples(pieces: list[tuple[str, list[tuple[int, str, int]]]], copies: int = 6, seed: int = SEED) -> list[tuple[str, list[tuple[int, str, int]]]]:
    """Labelled pieces as they stand, and with every span rewritten `copies` times."""
    rng, out = np.random.default_rng(seed), list(pieces)
    for text, spans in pieces:
        for _ in range(copies if spans else 0):
            new, done, moved = "", 0, []
            for s, kind, e in spans:
                if s < done:
                    continue
                new += text[done:s]
                form = rewritten(kind, text[s:e], rng, text)
                moved.append((len(new), kind, len(new) + len(form)))
                new, done = new + form, e
            out.append((new + text[done:], moved))
    return out


def _shaped(kind: str, found: str) -> bool:
    """What the network learns as a span: numbers of the right length; their check digits and bounds are no matter of its shape."""
    n = len(_NOT_DIGIT.sub("", found))
    return kind == "ip" or (14 <= n <= 19 if kind == "card" else 10 <= n <= 15)


def pieces_of(text: str, rng: np.random.Generator) -> list[tuple[str, list[tuple[int, str, int]]]]:
    """Pieces around matches of the patterns, labelled, and pieces around other digits and anywhere. Matches that only look like phones are left out."""
    spans = base_spans(text, _shaped)
    unclear = [(m.start(), m.end()) for m in _PHONE.finditer(text) if not _valid("phone", m[0])]
    out = []

    def cut(s: int, e: int) -> None:
        s, e = max(0, s - int(rng.integers(12, 40))), min(len(text), e + int(rng.integers(12, 40)))
        inside = [(x - s, k, y - s) for x, k, y in spans if s <= x and y <= e]
        split = [1 for x, _, y in spans if x < e and s < y and not (s <= x and y <= e)]
        clear = all(a[2] <= b[0] for a, b in zip(inside, inside[1:]))  # noqa: B905
        if not split and clear and e - s <= 160 and not any(x < e and s < y for x, y in unclear):
            out.append((text[s:e], inside))

    for s, _, e in spans[:PER_DOCUMENT]:
        cut(s, e)
    marks = [m.start() for m in re.finditer("[0-9@+]+", text) if not any(x <= m.start() < y for x, _, y in spans)]
    for m in rng.permutation(marks)[: PER_DOCUMENT // 2].tolist() if marks else []:
        cut(m, m + 1)
    if text:
        at = int(rng.integers(len(text)))
        cut(at, at + 1)
    return out


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Learn from the base spans of at most about `sample` documents, chosen by a hash of the id; rows without id or text teach nothing."""
    docs = docs.select("doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    n = docs.count()
    few = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(2**20)) < int(2**20 * min(1.0, sample / max(n, 1))))

    def cut(batches):
        for rows in chunks(batches, 4 << 20):
            found = [(i, t, s) for i, text in rows for t, s in pieces_of(text, np.random.default_rng([SEED, i & 0xFFFFFFFF, len(text)]))]
            spans = [[{"start": a, "kind": k, "end": b} for a, k, b in s] for _, _, s in found]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _, _ in found], pa.int64()), pa.array([t for _, t, _ in found], pa.string()), pa.array(spans, _SPANS)], names=["doc_id", "text", "spans"])

    rows = few.selectExpr("CAST(doc_id AS long) AS doc_id", "text").mapInArrow(cut, f"doc_id long, text string, spans {_SQL_SPANS}").collect()
    pieces = sorted((r.doc_id, r.text, [tuple(s) for s in r.spans]) for r in rows)
    return train(examples([(t, s) for _, t, s in pieces]))


_SQL_SPANS = "array<struct<start: long, kind: string, end: long>>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64())]))


def detect(docs: DataFrame, model: Model | None, at_once: int = 4 << 20) -> DataFrame:
    """doc_id, base, spans of every row: spans (start, kind, end; code points, end exclusive) of the patterns, and these with those of the network.

    NULL and empty texts have no spans; repeated rows and NULL ids are treated like any other, other columns are not returned.
    A text of any length is read in windows. Without a model (no span in the sample) `spans` equals `base`.
    """

    def find(batches):
        for rows in chunks(batches, at_once):
            texts = [t or "" for _, t in rows]
            base = [base_spans(t) for t in texts]
            tags = tagged(model, texts) if model else {}
            order = lambda s: (s[0], KINDS.index(s[1]), s[2])
            both = [sorted(b + (added_spans(t, tags[i], b) if i in tags else []), key=order) for i, (t, b) in enumerate(zip(texts, base, strict=True))]
            columns = [pa.array([[{"start": s, "kind": k, "end": e} for s, k, e in x] for x in y], _SPANS) for y in (base, both)]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()), *columns], names=["doc_id", "base", "spans"])

    return docs.selectExpr("CAST(doc_id AS long) AS doc_id", "text").mapInArrow(find, f"doc_id long, base {_SQL_SPANS}, spans {_SQL_SPANS}")
