"""Personal data (11), Merkle manifest (12), conversation repair (13) against brute force, and on awkward tables."""

import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pytest
from cases import CLASHES, LONG

from scoreloom.llm import conversation_repair, merkle, pii
from scoreloom.llm.common import table
from scoreloom.llm.queries_records import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
H = lambda s: hashlib.sha256(s.encode()).hexdigest()


def clashing(df):
    return df.selectExpr("*", *[f"'keep {c}' AS `{c}`" for c in (*CLASHES, "_tree", "_n", "_pos", "leaf", "root", "value", "outer", "base", "spans", "cost", "audit") if c not in df.columns and c != "turn"])


# --- Merkle manifest ---------------------------------------------------------------------------------------------------------


def plain_manifest(rows, fan):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"

    def tree(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([H("".join(out[-1][i : i + fan])) for i in range(0, len(out[-1]), fan)])
        return out

    def path(levels, i):
        for level in levels[:-1]:
            a = i // fan * fan
            yield "".join(level[a:i]), "".join(level[i + 1 : a + fan])
            i //= fan

    groups = {}
    for doc, source, lang, n, text in rows:
        hurt = text if text is None or doc is None or zlib.crc32(str(doc).encode()) % 5 else text.translate(LOWER)
        leaf, altered = (H("".join(map(field, (doc, source, lang, n, t)))) for t in (text, hurt))
        groups.setdefault(source, []).append(((doc is not None, doc or 0), leaf, altered, doc))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = [tree([x[1] for x in sorted(groups[s])]) for s in order]
    top = tree([t[-1][0] for t in trees])
    out = []
    for k, s in enumerate(order):
        for i, (_, leaf, folded, doc) in enumerate(sorted(groups[s])):
            steps = [*path(trees[k], i), *path(top, k)]
            for a, b in steps:
                folded = H(a + folded + b)
            out.append((doc, leaf, trees[k][-1][0], top[-1][0], H("".join(a + b for a, b in steps)), folded, folded == top[-1][0]))
    return sorted(out, key=str)


ROWS = [
    (1, "a", "en", 3, "Abc"), (2, "a", None, None, None), (2, "a", None, None, None), (None, "a", "en", 0, ""), (3, None, "de", 4, "Größe"), (4, "", "de", 1, "X"),
    (5, "é", "fr", len(LONG), LONG), (None, None, None, None, None), (6, "a", "en", 3, "other"), (6, "a", "en", 5, "ANOTHER"), (-7, "a", "x:y", 1, "5:ab"),
]
FIELDS = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize(("fan", "depth"), [(16, 3), (3, 1)])
def test_manifest_against_a_plain_tree(spark, fan, depth):
    rng = random.Random(2)
    rows = ROWS + [(i, rng.choice(["a", "hot", "hot", "hot", f"s{i % 7}"]), "en", i, f"Text {i % 50}") for i in range(10, 150)]
    got = merkle.manifest(clashing(spark.createDataFrame(rows, FIELDS)), merkle.TAMPERED, fan, depth).collect()
    assert sorted(map(tuple, got), key=str) == plain_manifest(rows, fan)


def test_manifest_of_nothing_and_of_one_row(spark):
    assert merkle.manifest(spark.createDataFrame([], FIELDS)).count() == 0
    row = merkle.manifest(spark.createDataFrame(ROWS[:1], FIELDS)).first()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.verified and row.proof_sha256 == H("")


# --- conversation repair -----------------------------------------------------------------------------------------------------

BLANKS = " \t\n\x0b\x0c\r"


def plain_repair(rows):
    """Uniform-cost search over (cost, audit)."""
    groups = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        g = groups.setdefault(conv, [])
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        g += [(turn, "user" if h == 4 else role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    return {c: plain_one(sorted(g, key=lambda r: (r[0] is not None, r[0] or 0, r[1], H(f"{len(r[1])}:{r[1]}{r[2]}")))) for c, g in groups.items()}


def plain_one(g):
    faults, seen = [], set()
    for _, role, text in g:
        said = text.rstrip(BLANKS)
        faults.append("blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else "")
        seen.add((role, text))
    illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(g, g[1:], strict=False))
    turns = [t for t, _, _ in g if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    ahead, roles, heap, done = {0: 2, 1: 2, 2: 3, 3: 2}, {2: "user", 3: "assistant"}, [(0, "", 0, 0, ())], set()
    while True:
        cost, audit, i, q, lines = heapq.heappop(heap)
        if i == len(g) and q in (0, 3):
            break
        if (i, q) in done:
            continue
        done.add((i, q))
        heapq.heappush(heap, (cost + 5, audit + "I", i, ahead[q], (*lines, roles[ahead[q]] + ":")))
        if i < len(g):
            _, role, text = g[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, q, lines))
            if faults[i] in ("", "truncated"):
                more = 5 if faults[i] else 0
                heapq.heappush(heap, (cost + 1 + more, audit + "R", i + 1, ahead[q], (*lines, f"{roles[ahead[q]]}:{text}")))
                to = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}.get((role[:1], q))
                if to:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, to, (*lines, f"{role}:{text}")))
    return gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, H("\n".join(lines))


TURNS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("size", [conversation_repair.SIZE, 4])
def test_repair_against_a_search(spark, size):
    """Ties, NULLs, unknown roles; with blocks of 4 rows also long conversations, whose blocks are joined over several levels."""
    rng = random.Random(1)
    rows = []
    for c in range(30):
        for t in range(rng.choice([1, 2, 3, 8, 30, 90])):
            role = rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None])
            rows.append((c or None, rng.choice([t, t, t, t, None, t + 1]), role, rng.choice(["a.", "b!", "c?\n", "open", "  ", None, "x y.", "", f"q.{t}", f"w!{t}."])))
    got = conversation_repair.repair(clashing(conversation_repair.damaged(spark.createDataFrame(rows, TURNS))), size).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == plain_repair(rows)
    assert len(got) == 30


def test_repair_of_nothing_and_of_dropped_rows(spark):
    assert conversation_repair.repair(spark.createDataFrame([], TURNS)).count() == 0
    gone = spark.createDataFrame([(1, 0, "user", "Hi.")], TURNS).selectExpr("*", "true AS _gone")
    assert tuple(conversation_repair.repair(gone).first()) == (1, 0, 0, 0, 0, 0, 0, "", H(""))
    lone = spark.createDataFrame([(1, None, "assistant", LONG + ".")], TURNS)
    assert tuple(conversation_repair.repair(lone).first()) == (1, 0, 0, 0, 0, 0, 2, "D", H(""))


# --- personal data -----------------------------------------------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20\-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_base(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            double = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits)))
            good = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else 0, "card": 14 <= len(digits) <= 19 and double % 10 == 0, "phone": 10 <= len(digits) <= 15}
            if good[kind]:
                out.append((m.start(), k, m.end()))
    return [(s, pii.KINDS[k], e) for s, k, e in sorted(out)]


def test_base_patterns():
    rng = random.Random(5)
    for n in range(6000):
        text = "".join(rng.choice("0123456789 -" if n % 3 == 0 else "a.b@@1123 -+().%é\n0+@..") for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(text) == plain_base(text), text
    assert pii.base_spans("1" * 60_000 + "." + "x" * 60_000 + "@" * 1000 + "+1" + " " * 60_000) == []


def test_gradient():
    """Back-propagation and forward-backward against differences of the loss."""
    rng = np.random.default_rng(0)
    start = pii.initial(rng, 3)
    p = {k: getattr(start, k).astype(np.float64) for k in pii.NAMES}
    codes, tags = rng.integers(1, pii.CLASSES, (7, 3)), np.zeros((7, 3), np.int64)
    codes[5:, 1] = pii.PAD
    tags[2:5, 0], tags[1:3, 2] = 1, 4
    _, grad = pii.loss_and_gradient(p, codes, tags)
    for k in pii.NAMES:
        flat = p[k].reshape(-1)
        for i in rng.choice(len(flat), min(12, len(flat)), replace=False):
            if k == "t" and flat[i] < -1:
                continue
            old, sides = flat[i], []
            for step in (1e-5, -1e-5):
                flat[i] = old + step
                sides.append(pii.loss_and_gradient(p, codes, tags)[0])
            flat[i] = old
            assert abs((sides[0] - sides[1]) / 2e-5 - grad[k].reshape(-1)[i]) < 1e-6, (k, i)


def plain_tags(model, text):
    """Scores step by step and the best of all paths by the full recursion."""
    codes, n = pii.encoded(text), model.u.shape[2]
    scores = np.tile(model.b.astype(float), (len(codes), 1))
    for d in range(2):
        h = c = np.zeros(n)
        x = pii.inputs({k: getattr(model, k) for k in pii.NAMES}, d)
        for i in range(len(codes)) if d == 0 else reversed(range(len(codes))):
            z = x[:, codes[i]] + model.u[d] @ h
            i_, f_, o_ = (1 / (1 + np.exp(-z[k * n : (k + 1) * n])) for k in range(3))
            c = f_ * c + i_ * np.tanh(z[3 * n :])
            h = o_ * np.tanh(c)
            scores[i] += model.a[d] @ h
    v, back = scores[0], []
    for s in scores[1:]:
        ways = v[:, None] + model.t
        back.append(ways.argmax(0))
        v = ways.max(0) + s
    path = [int(v.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return np.array(path[::-1])


@pytest.fixture(scope="module")
def trained(spark, sf_dir):
    docs = table(spark, "/root/testdata/sf0.1" if "/sf0.0" in sf_dir else sf_dir, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").where("text IS NOT NULL").orderBy("doc_id").limit(5000).collect()]
    cut = lambda some: [p for i, t in some for p in pii.pieces_of(t, np.random.default_rng([4, i]))]
    half = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5], [r for r in rows if not zlib.crc32(str(r[0]).encode()) % 5]
    return pii.train(pii.examples(cut(half[0]))), pii.examples(cut(half[1]), copies=3, seed=3)


def test_held_out_spans(trained):
    """Spans of documents and notations that training has not seen."""
    model, held = trained
    tags = pii.tagged(model, [t for t, _ in held])
    want = {(k, *s) for k, (_, spans) in enumerate(held) for s in spans}
    got = {(k, s, pii.KINDS[c - 1], e) for k, g in tags.items() for s, e, c in pii.runs(g)}
    assert len(want) > 50
    assert len(want & got) > 0.85 * len(want)
    assert len(want & got) > 0.85 * len(got)


def test_batches_of_windows_equal_a_plain_network(trained):
    model, held = trained
    texts = [t for t, _ in held[:60]] + ["", "x"]
    tags = pii.tagged(model, texts, at_once=16)
    for k, text in enumerate(texts):
        want = plain_tags(model, text) if text else np.zeros(0)
        assert (tags.get(k, np.zeros(len(text))) == want).all(), text


def test_windows_are_reconciled(trained):
    """A long text cut into small windows has the spans that it has in one window."""
    model, held = trained
    text = " und so weiter, ".join(t for t, s in held if s)[:3000]
    whole = {x for x in pii.runs(pii.tagged(model, [text], window=4096)[0])}
    parts = {x for x in pii.runs(pii.tagged(model, [text], window=160, overlap=80)[0])}
    assert len(whole & parts) > 0.9 * len(whole | parts)
    assert pii.window_starts(1000, 160, 80)[-1] + 160 >= 1000
    left, right = np.array([0, 0, 2, 2, 2], np.uint8), np.array([2, 2, 2, 0, 0], np.uint8)
    assert pii.reconciled(8, [0, 3], [left, right]).tolist() == [0, 0, 2, 2, 2, 2, 0, 0]


def test_added_spans_fit_their_kind():
    for kind, text, good in (
        ("email", "ann (at) mail (dot) org", True), ("email", "ann at mail dot org", True), ("email", "look at this. and", False), ("ip", "10[.]0[.]0[.]1", True), ("ip", "10[.]0[.]0[.]256", False),
        ("card", "4111.1111.1111.1111", True), ("card", "4111.1111.1111.1112", False), ("phone", "(487) 555-7209", True), ("phone", "(487) 555-72", False),
    ):
        assert pii.fits(kind, text, 0, len(text)) == good, text
    assert not pii.fits("card", "94111.1111.1111.1111", 1, 20)
    base = [(0, "ip", 8)]
    assert pii.added_spans("10.0.0.1 ann (at) mail.org", np.array([2] * 8 + [0] + [1] * 17, np.uint8), base) == [(9, "email", 26)]


def test_awkward_documents(spark, trained):
    rows = [(1, "mail ann.1@mail2.example.com now, 4111 1111 1111 1111"), (1, "mail ann.1@mail2.example.com now, 4111 1111 1111 1111"), (None, "+1 (487) 555-7209"), (2, None), (3, ""), (4, LONG), (5, "é 1.2.3.4")]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    for model in (trained[0], None):
        got = sorted(((r.doc_id, tuple(map(tuple, r.base)), set(map(tuple, r.spans))) for r in pii.detect(df, model).collect()), key=str)
        assert [(i, b) for i, b, _ in got] == [(i, b) for i, b in sorted(((i, tuple(plain_base(t or ""))) for i, t in rows), key=str)]
        assert all(set(b) <= s for _, b, s in got)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pii.fit(empty) is None and pii.detect(empty, None).count() == 0


def test_query_columns(spark, sf_dir):
    got = QUERIES["op11_pii"](spark, sf_dir)
    assert got.columns[:7] == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    texts = {r.doc_id: r.text or "" for r in table(spark, sf_dir, "documents").collect()}
    for r in got.collect():
        want = plain_base(texts[r.doc_id])
        assert r.base_sha256 == H(",".join(f"{k}:{s}:{e}" for s, k, e in want))
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == x for _, x, _ in want) for k in pii.KINDS)
        assert {f"{k}:{s}:{e}" for s, k, e in want} <= set(r.spans.split(","))
