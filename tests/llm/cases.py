"""Small tables with awkward rows, and brute-force versions of the operators."""

import hashlib
import random
import re

LONG = "vero " * 40_000 + "x" * 60_000
PARA = "the quick brown fox jumps over the lazy dog while seven wizards brew potent ale and sing of older times near the river bank tonight"
DOCS = [
    (1, PARA), (2, PARA), (2, PARA), (3, PARA.replace("seven", "eight")), (3, "another text under the same id as before"), (4, ""), (5, None), (None, None),
    (None, "a text without an id, " + PARA), (6, LONG), (7, LONG + " tail"), (8, "été à l'école, ça va? naïve Ünïcödé " * 8), (9, "été à l'école, ça va? naïve Ünïcödé " * 8),
    (10, "1234 5678 !!! ???"), (11, "one"), (12, "one two three"), (13, "One TWO three"), (14, "  \n\t "), (15, "日本語のテキスト " * 5),
]
SCHEMA = "doc_id long, text string"
CLASHES = (
    "key n label rep a b i t w h k x sig sigs place size block n_words spans n_hit items n_shingles is_first component_id n_bytes n_removed n_spans kept_sha256"
    " kept lang_pred score predicted start length sequence_id offset n_tokens n_edits leaf_chars begin upto found kind id ident pos"
).split()


def docs(spark, rows=DOCS, clashes=False):
    df = spark.createDataFrame(rows, SCHEMA)
    if clashes:
        df = df.selectExpr("*", *[f"'keep {c}' AS `{c}`" for c in CLASHES])
    return df


def texts(n=300, seed=3):
    """Documents with copies, near copies and shared passages of a small vocabulary."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    line = lambda k: [rng.choice(words) for _ in range(k)]
    shared = [line(40) for _ in range(4)]
    out = []
    for i in range(n):
        kind = rng.random()
        if out and kind < 0.15:
            t = rng.choice(out)[1]
        elif out and kind < 0.5:
            w = rng.choice(out)[1].split(" ")
            for _ in range(rng.randint(0, max(1, len(w) // 25))):
                w[rng.randrange(len(w))] = rng.choice(words)
            t = " ".join(w)
        else:
            w = line(rng.choice([3, 20, 60, 150, 900]))
            if rng.random() < 0.5:
                at = rng.randrange(len(w))
                w[at:at] = rng.choice(shared)
            t = " ".join(w)
        out.append((i, t))
    return out


def shingles(text, width=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def jaccard_components(rows, percent=85):
    sets = [shingles(t) for _, t in rows]
    comp = list(range(len(rows)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                comp[b] = a
    return {rows[i][0]: (len(sets[i]), rows[root(i)][0]) for i in range(len(rows))}


def repeated_bytes(rows, length=100):
    """doc_id -> (bytes, removed, spans, digest, kept); rows in the order of their ids."""
    seen, out = set(), {}
    for i, t in rows:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            w = raw[s : s + length]
            if w in seen:
                gone[s : s + length] = b"\1" * length
            seen.add(w)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        left = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out[i] = (len(raw), sum(gone), spans, hashlib.sha256(left).hexdigest(), left.decode("utf-8", "ignore"))
    return out


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def contamination(text, items, width=13):
    w, hit, found = words(text), set(), set()
    for i, t in items:
        b = words(t)
        n = min(width, len(b))
        wins = {tuple(b[k : k + n]) for k in range(len(b) - n + 1)} if n else set()
        for k in range(len(w) - n + 1) if n else ():
            if tuple(w[k : k + n]) in wins:
                hit |= set(range(k, k + n))
                found.add(i)
    return len(w), len(hit), sorted(str(i) for i in found if i is not None)
