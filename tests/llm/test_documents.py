"""Language, decontamination, suffix dedup, Jaccard join and packing on awkward tables and against brute force."""

import zlib
from collections import Counter

import cases
import pytest
from pyspark.sql import functions as F

from scoreloom.llm import decontamination, jaccard, language_id, packing, rule_ensemble, suffix_dedup

ITEMS = [(1, cases.PARA), (2, "One two three"), (3, ""), (4, None), (None, "wizards brew potent"), (5, "école ça va naïve")]


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def rows_of(df, *cols):
    return Counter(tuple(tuple(v) if isinstance(v, list) else v for v in r) for r in df.select(*cols).collect())


def kept_columns(out, clashes):
    assert len(set(out.columns)) == len(out.columns)
    r = out.where("doc_id = 1").first()
    for c in clashes:
        assert r[c] == f"keep {c}", c


@pytest.mark.parametrize("limits", [(20_000, 0), (0, 1000), (0, 0)])
def test_contamination(spark, bench, limits):
    """The set in the plan, broadcast hashes and hashes by shuffle."""
    out = decontamination.contamination(cases.docs(spark, clashes=True), bench, set_limit=limits[0], broadcast_limit=limits[1])
    want = Counter((i, n, h, tuple(x)) for i, t in cases.DOCS for n, h, x in [cases.contamination(t, ITEMS)])
    assert rows_of(out, "doc_id", "n_words", "n_hit", "items") == want
    kept_columns(out, ["key", "a", "w", "h", "n", "i", "score"])


def test_contamination_random(spark):
    rows = cases.texts(120)
    items = [(i, " ".join(t.split(" ")[5:40])) for i, t in rows[::9]] + [(900, "zz")]
    out = decontamination.contamination(cases.docs(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    want = Counter((i, n, h, tuple(x)) for i, t in rows for n, h, x in [cases.contamination(t, items)])
    assert rows_of(out, "doc_id", "n_words", "n_hit", "items") == want
    large = decontamination.contamination(cases.docs(spark, rows), spark.createDataFrame(items, "item_id long, text string"), set_limit=0)
    assert rows_of(large, "doc_id", "n_words", "n_hit", "items") == want
    plan = large._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan and "Python" not in plan


def test_contamination_empty(spark, bench):
    assert decontamination.contamination(cases.docs(spark, []), bench).count() == 0
    out = decontamination.contamination(cases.docs(spark), bench.limit(0))
    assert out.agg(F.sum("n_hit")).first()[0] == 0 and out.count() == len(cases.DOCS)


def test_remove_spans_and_documents(spark, bench):
    text = "Before, " + cases.PARA.upper() + "; after"
    df = spark.createDataFrame([(1, text), (2, "clean words only"), (3, None), (4, "pad " * 300 + "one two three.")], cases.SCHEMA)
    cut = {r.doc_id: r.text for r in decontamination.remove_spans(df, bench).collect()}
    assert cut[1] == "Before; after" and cut[2] == "clean words only" and cut[3] is None and cut[4] == "pad " * 299 + "pad."
    assert {r.doc_id for r in decontamination.remove_documents(df, bench).collect()} == {2, 3, 4}


def test_repeats_random(spark):
    rows = cases.texts(200)
    out = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, r.kept) for r in suffix_dedup.repeats(cases.docs(spark, rows).repartition(5)).collect()}
    assert out == cases.repeated_bytes(rows)


def test_repeats_crowded_buckets(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT", 3)
    rows = cases.texts(150, seed=8)
    found = suffix_dedup._find_runs(100, 32), suffix_dedup._refine_runs(100)
    df = cases.docs(spark, rows).select(F.col("doc_id").alias("key"), "text").coalesce(1)
    batches = [b for b in df._jdf and df.toArrow().to_batches()]
    runs = sorted((r for b in found[0](iter(batches)) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)))
    import pyarrow as pa

    names = ["bucket", "ident", "key", "pos"]
    split = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*runs[i : i + 7], strict=True)], names) for i in range(0, len(runs), 7)]
    marks = [r for b in found[1](iter(split)) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    assert {m[1] for m in marks} == {0, 1, 2}
    text = dict(rows)
    opened: dict = {}
    for key, kind, ident, begin, upto in marks:
        if kind:
            opened.setdefault(key, []).append({"kind": kind, "id": ident, "begin": begin, "upto": upto})
    struct = pa.list_(pa.struct([("kind", pa.int8()), ("id", pa.int64()), ("begin", pa.int64()), ("upto", pa.int64())]))
    joined = pa.RecordBatch.from_arrays([pa.array(list(opened)), pa.array([text[k] for k in opened]), pa.array(list(opened.values()), struct)], ["key", "text", "found"])
    pieces = [r for b in suffix_dedup._cut_pieces(100)(iter([joined])) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    pieces.sort(key=lambda r: r[:4])
    kinds = [pa.int64()] * 4 + [pa.binary()]
    again = [pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*pieces[i : i + 11], strict=True), kinds, strict=True)], ["id", "ident", "key", "pos", "piece"]) for i in range(0, len(pieces), 11)]
    marks = [m for m in marks if not m[1]] + [r for b in suffix_dedup._refine_pieces(100)(iter(again)) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    gone = {i: bytearray(len(t.encode())) for i, t in rows}
    for key, _, _, begin, upto in marks:
        gone[key][begin:upto] = b"\1" * (upto - begin)
    assert {i: sum(g) for i, g in gone.items()} == {i: v[1] for i, v in cases.repeated_bytes(rows).items()}


def test_repeats_awkward(spark):
    out = suffix_dedup.repeats(cases.docs(spark, clashes=True))
    distinct = sorted(set(cases.DOCS), key=lambda r: (r[0] is None, r[0] or 0, r[1] or "", r[1] is not None))
    want = cases.repeated_bytes([((i, t), t) for i, t in distinct])
    got = {(r.doc_id, r.text): (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, r.kept) for r in out.collect()}
    assert got == want and out.count() == len(cases.DOCS)
    kept_columns(out, ["key", "a", "id", "found", "pos", "score"])
    assert suffix_dedup.repeats(cases.docs(spark, [])).count() == 0


def test_long_slices(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PART", 700)
    assert suffix_dedup.smallest(suffix_dedup.np.array([5, 3, 3, 9, 1], "u8") << suffix_dedup.np.uint64(8), 3).tolist() == [1, 1, 4]
    rows = [(1, "".join(t for _, t in cases.texts(20, 5))), (2, "ab" * 2000), (3, "a" * 900)]

    class Batch:
        num_rows = 3
        columns = ()

    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], ["key", "text"])
    windows = Counter()
    for part in suffix_dedup.slices(iter([batch]), 100, 700):
        b = suffix_dedup.Bytes(part)
        _, _, own, start, count = suffix_dedup.runs(b, 100, 32)
        for o, s, c in zip(own, start, count, strict=True):
            windows.update((int(b.key[o]), int(s + b.shift[o] + k)) for k in range(c))
    assert windows == Counter((i, s) for i, t in rows for s in range(len(t.encode()) - 99))


@pytest.mark.parametrize("small", [16, 0])
def test_jaccard_random(spark, small, monkeypatch):
    monkeypatch.setattr(jaccard, "SMALL", small)
    monkeypatch.setattr(jaccard, "BLOCK", 7)
    rows = cases.texts(300)
    out = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar(cases.docs(spark, rows).repartition(3)).collect()}
    assert out == cases.jaccard_components(rows)


def test_jaccard_awkward(spark):
    out = jaccard.similar(cases.docs(spark, clashes=True))
    distinct = sorted(set(cases.DOCS), key=lambda r: (r[0] is None, r[0] or 0, r[1] or "", r[1] is not None))
    want = cases.jaccard_components([((i, t), t) for i, t in distinct])
    got = {((r.doc_id, r.text), r.n_shingles, r.component_id) for r in out.collect()}
    assert got == {(k, n, c[0]) for k, (n, c) in want.items()} and out.count() == len(cases.DOCS)
    kept_columns(out, ["key", "a", "n", "label", "rep", "place", "size"])
    assert jaccard.similar(cases.docs(spark, [])).count() == 0
    kept = jaccard.keep_one_each(cases.docs(spark))
    assert kept.where(r"text RLIKE '\\S'").count() == len({c for k, (n, c) in want.items() if n})


def test_signatures_meet():
    """Linked sets share as many signatures as the size of the smaller asks for, whatever is frequent."""
    import numpy as np

    rng = np.random.default_rng(1)
    for n in (3, 6, 7, 12, 40, 70, 130, 600, 900):
        for _ in range(15):
            x = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
            y = x.copy()
            away = int(rng.integers(0, jaccard.losses(len(x), 85) + 1))
            y = np.delete(y, rng.choice(len(y), away, replace=False))
            y = np.unique(np.concatenate([y, rng.integers(0, 2**63, int(rng.integers(0, 1 + len(x) // 20)), dtype=np.uint64)]))
            o = len(np.intersect1d(x, y))
            if 100 * o < 85 * (len(x) + len(y) - o) or (o == len(x) == len(y)):
                continue
            for part in (0, 0.3, 1.0):
                both = np.union1d(x, y)
                often = np.sort(rng.choice(both, int(part * len(both)), replace=False))
                met = len(np.intersect1d(jaccard.signatures(x, often), jaccard.signatures(y, often)))
                assert met >= jaccard.shared(min(len(x), len(y))), (n, part)


def test_packing(spark):
    path = packing.vocabulary()
    rows = [*cases.DOCS, *[(100 + i, t) for i, t in cases.texts(200)], (500, "with <|endoftext|> inside"), (501, "<|endoftext|>")]
    out = packing.pack_documents(cases.docs(spark, rows, clashes=True).repartition(3), with_ids=True).collect()
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(path[0])
    want = Counter((i, tuple([*slow.encode(t or "", add_special_tokens=False).ids, 0])) for i, t in rows)
    by_seq: dict = {}
    for r in out:
        assert len(r.ids) == r.length and zlib.crc32(packing.np.array(r.ids, "<u4")) == r.ids_crc32
        by_seq.setdefault(r.sequence_id, []).append(r)
    for pieces in by_seq.values():
        pieces.sort(key=lambda r: r.offset)
        assert [p.offset for p in pieces] == [sum(p.length for p in pieces[:k]) for k in range(len(pieces))]
        assert sum(p.length for p in pieces) <= 1024 and len(pieces) <= 256
    padded = sum(1024 - n for n in (sum(p.length for p in x) for x in by_seq.values()) if n & (n - 1))
    assert padded == 0
    one = [r for r in out if r.doc_id is not None and r.doc_id >= 100]
    whole: dict = {}
    for r in sorted(one, key=lambda r: (r.doc_id, r.start)):
        assert len(whole.setdefault(r.doc_id, [])) == r.start
        whole[r.doc_id] += r.ids
    assert Counter((i, tuple(v)) for i, v in whole.items()) == Counter({k: n for k, n in want.items() if k[0] is not None and k[0] >= 100})
    assert sum(r.length for r in out) == sum(len(k[1]) * n for k, n in want.items())
    assert packing.pack_documents(cases.docs(spark, [])).count() == 0


def test_packing_limits(spark):
    df = cases.docs(spark, cases.texts(150)).withColumn("free", F.expr("int(pmod(doc_id, 90))"))
    limits = packing.Limits(tokens=512, segments=3, loss_tokens=200)
    out = packing.pack_documents(df, limits, loss_from="free").groupBy("sequence_id").agg(F.sum("length").alias("n"), F.count("*").alias("s"), F.sum("loss_tokens").alias("l"))
    most = out.agg(F.max("n"), F.max("s"), F.max("l")).first()
    assert most[0] <= 512 and most[1] <= 3 and most[2] <= 200


REFERENCE = {"en": "the cat and the dog sat on the mat with a hat", "de": "der hund und die katze sitzen auf der matte mit hut", "fr": "le chat et le chien sont sur le tapis avec un chapeau"}


def test_language_against_brute_force():
    model = language_id.build({k: language_id.normalised(v) for k, v in REFERENCE.items()})
    texts = [t or "" for _, t in cases.DOCS if t is None or len(t) < 5000] + ["Der Hund!", "le chien, le chat", "Привет", "12 34", "a\n", "\nthe dog\n\n", "x" * 700]

    def phrases(text, ref):
        s, n = language_id.normalised(text), 0
        for at in range(0, len(s), language_id.BLOCK):
            block, i = s[at : at + language_id.BLOCK], 0
            while i < len(block):
                k = 1
                while i + k < len(block) and block[i : i + k + 1] in ref:
                    k += 1
                i, n = i + k, n + 1
        return n

    count, size = language_id.Parser(model).phrases(texts)
    assert size.tolist() == [len(language_id.normalised(t)) for t in texts]
    assert count.tolist() == [[phrases(t, language_id.normalised(REFERENCE[k])) for k in model.languages] for t in texts]


def test_language_keeps_every_letter():
    ideographs = "".join(chr(0x4E00 + i) for i in range(3000))
    rare = "ᏣᎳᎩ ᎦᏬᏂᎯᏍᏗ ᎠᏂᏴᏫᏯ"
    model = language_id.build({k: language_id.normalised(v) for k, v in {**REFERENCE, "chr": rare, "zh": ideographs * 3}.items()})
    assert set(model.alphabet) >= set(ideographs) | set(language_id.normalised(rare))
    assert language_id._judge(language_id.Parser(model), [rare, ideographs[2000:2100], "der hund"])[0] == ["chr", "zh", "de"]
    count, _ = language_id.Parser(model).phrases([ideographs[2000:2100]])
    assert count[0, model.languages.index("zh")] == 1


def test_short_reference_is_no_advantage():
    rng = cases.random.Random(11)
    full = {k: " ".join(rng.choices(v.split(), k=4000)) for k, v in REFERENCE.items()}
    texts = [" ".join(rng.choices(v.split(), k=40)) + " unseen words follow" for v in REFERENCE.values()]
    for word in ("ok", "okay", "hello", "goodbye"):
        model = language_id.build({k: language_id.normalised(v) for k, v in {**full, "aa": word}.items()})
        assert language_id._judge(language_id.Parser(model), texts)[0] == list(REFERENCE)
    own = language_id.build({**full, "zz": language_id.normalised("ᏣᎳᎩ")})
    assert language_id._judge(language_id.Parser(own), ["Ꮳ Ꮃ Ꭹ"])[0] == ["zz"]


def test_reference_is_shared_by_documents(spark):
    long = "start " * 20_000 + "end " * 20_000
    rows = [(1, long, "en"), (2, "few words", "en"), *[(i, f"{chr(97 + i) * 9} " * 300, "en") for i in range(3, 20)]]
    text = language_id.sample(spark.createDataFrame(rows, "doc_id long, text string, lang string"), [("en", len(rows))], 24_000, 60)["en"]
    assert 23_000 < len(text) <= 24_000 and "few words" in text and "start start" in text and "end end" in text
    assert all(chr(97 + i) * 9 in text for i in range(3, 20))
    assert language_id.shares([2, 100, 100], 22) == [2, 10, 10] and language_id.shares([], 5) == [] and language_id.shares([3, 3], 10) == [3, 3]


def test_language_awkward(spark):
    model = language_id.fit(spark.createDataFrame([(i, t, k) for i, (k, t) in enumerate(REFERENCE.items())] + [(None, "x", "en"), (9, None, "de"), (10, "y", None), (11, "123", "es")], "doc_id long, text string, lang string"))
    assert model.languages == ["de", "en", "fr"]
    out = language_id.identify(cases.docs(spark, [*cases.DOCS, (20, "der hund und die katze"), (21, "le chien et le chat")], clashes=True), model)
    got = {(r.doc_id, r.text): (r.lang_pred, r.score) for r in out.collect()}
    assert got[5, None] == got[4, ""] == got[10, "1234 5678 !!! ???"] == ("und", 0.0)
    assert got[20, "der hund und die katze"][0] == "de" and got[21, "le chien et le chat"][0] == "fr"
    assert all(0 <= s <= 1 for _, s in got.values()) and out.count() == len(cases.DOCS) + 2
    kept_columns(out, ["key", "a", "kind", "id", "items"])
    nothing = language_id.fit(cases.docs(spark, []).selectExpr("*", "'en' AS lang"))
    assert {r.lang_pred for r in language_id.identify(cases.docs(spark), nothing).collect()} == {"und"}
    assert language_id.identify(cases.docs(spark, []), model).count() == 0


def test_trees_see_the_whole_sample(monkeypatch):
    rows, grow = [], rule_ensemble.grow
    monkeypatch.setattr(rule_ensemble, "grow", lambda x, y, rng: rows.append(len(y)) or grow(x, y, rng, depth=1))
    x = packing.np.random.default_rng(4).normal(size=(6_000, len(rule_ensemble.FEATURES)))
    assert rule_ensemble.fit_rows(x, (x[:, 0] > 0).astype(int)).rules and set(rows) == {6_000}


def test_rules_awkward(spark):
    good = [(i, f"Plain words make a sentence here number {i}. And one more follows.") for i in range(200)]
    bad = [(1000 + i, f"JUNK!! {i}$$$ ### *** " * 5) for i in range(200)]
    labels = spark.createDataFrame([(i, int(i < 1000)) for i, _ in good + bad] + [(None, 1), (3, None), (99999, 1)], "doc_id long, quality int")
    model = rule_ensemble.fit(cases.docs(spark, good + bad), labels)
    assert model.rules and all(len(r.parts) <= rule_ensemble.DEPTH for _, r in model.rules)
    out = rule_ensemble.score(cases.docs(spark, good + bad), model).collect()
    assert all(r.predicted == int(r.doc_id < 1000) for r in out)
    stats = rule_ensemble.statistics(cases.docs(spark, good + bad)).toPandas().set_index("doc_id")
    margin = dict(zip(stats.index, model.margin(stats[[f"_s_{f}" for f in rule_ensemble.FEATURES]].to_numpy()), strict=True))
    assert all(abs(r.score - 1 / (1 + packing.np.exp(-margin[r.doc_id]))) < 1e-9 for r in out)
    odd = rule_ensemble.score(cases.docs(spark, clashes=True), model)
    assert odd.count() == len(cases.DOCS) and odd.where("score IS NULL OR score < 0 OR score > 1 OR predicted IS NULL").count() == 0
    kept_columns(odd, ["key", "a", "w", "x"])
    for y in ([], [1], [0]):
        flat = rule_ensemble.fit(cases.docs(spark), spark.createDataFrame([(1, v) for v in y], "doc_id long, quality int"))
        assert rule_ensemble.score(cases.docs(spark), flat).count() == len(cases.DOCS)


def test_packing_of_tiny_texts_pads_little(spark):
    """Three tokens each: without a segment limit hardly any padding, and no sequence that isn't full or a power of two."""
    docs = spark.range(20_000).selectExpr("id AS doc_id", "concat('ab ', id % 7) AS text")
    limits = packing.Limits(segments=packing.Limits.tokens)
    got = packing.pack_documents(docs.coalesce(2), limits).groupBy("sequence_id").agg({"length": "sum"}).toPandas()["sum(length)"]
    padded = sum(n if n & (n - 1) == 0 else 1024 for n in got)
    assert got.max() <= 1024 and padded - got.sum() < 0.01 * padded


def test_lasso_is_optimal():
    """Slopes of the loss on standardised rules: at most the penalty where a weight is 0, the penalty against its sign elsewhere."""
    np = packing.np
    rng = np.random.default_rng(6)
    a = (rng.random((600, 12)) < rng.uniform(0.1, 0.9, 12)).astype(float)
    y = (rng.random(600) < 1 / (1 + np.exp(-(2 * a[:, 0] - 1.5 * a[:, 3])))).astype(float)
    bias, w = rule_ensemble.lasso(a, y, 0.02, steps=5000)
    spread = a.std(0)
    p = 1 / (1 + np.exp(-(bias + a @ w)))
    slope = ((a - a.mean(0)) / spread).T @ (p - y) / len(y)
    assert abs((p - y).mean()) < 1e-6 and 0 < (abs(w) > 1e-9).sum() < 12
    for g, v in zip(slope, w * spread, strict=True):
        assert abs(g + 0.02 * np.sign(v)) < 1e-4 if abs(v) > 1e-9 else abs(g) <= 0.02 + 1e-4


def test_rules_follow_the_best_cuts():
    """A tree's cuts against a search of all its features and bins; rules of sisters share the rows of their parent."""
    np = packing.np
    x = np.random.default_rng(2).normal(size=(300, 4))
    y = ((x[:, 1] > 0.3) ^ (x[:, 2] > 0)).astype(int)
    rng = np.random.default_rng(9)
    rules = rule_ensemble.grow(x, y, rng, depth=2)
    rng = np.random.default_rng(9)
    rows = rng.integers(0, 300, 300)
    some = rng.choice(4, 2, replace=False)

    def impurity(v):
        return v.mean() * (1 - v.mean()) * len(v)

    def best(rows):
        cuts = [(impurity(y[rows]) - impurity(y[rows][k]) - impurity(y[rows][~k]), -f, t) for f in some
                for t in np.unique(np.quantile(x[rows, f], np.linspace(0, 1, rule_ensemble.BINS + 1)[1:-1])) if 5 <= (k := x[rows, f] <= t).sum() <= len(rows) - 5]
        return max((c[0] for c in cuts), default=0)

    for rule in rules:
        f, upper, t = rule.parts[-1]
        above = rows[rule_ensemble.Rule(rule.parts[:-1]).holds(x[rows])]
        k = x[above, f] <= t
        assert abs(impurity(y[above]) - impurity(y[above][k]) - impurity(y[above][~k]) - best(above)) < 1e-9
        sister = rule_ensemble.Rule((*rule.parts[:-1], (f, not upper, t)))
        assert sister in rules and (rule.holds(x) ^ sister.holds(x) == rule_ensemble.Rule(rule.parts[:-1]).holds(x)).all()


def test_quality_of_empty_tables(spark):
    none, labels = cases.docs(spark, []), spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    model = rule_ensemble.fit(none, labels)
    assert not model.rules and rule_ensemble.score(none, model).count() == 0
    assert rule_ensemble.fit(cases.docs(spark), labels.limit(0)).rules == []
    many = spark.createDataFrame([(1, i % 2) for i in range(100)], "doc_id long, quality int")
    assert rule_ensemble.fit(cases.docs(spark), many, sample=5) == rule_ensemble.fit(cases.docs(spark), many.repartition(3), sample=5)


@pytest.mark.parametrize(("members", "across"), [(20, False), (300, False), (8192, False), (300, True)])
def test_screening_of_near_copies_is_bounded(members, across):
    """Postings of near copies: one row a member, or all pairs of two labels, in little memory however large a posting is."""
    import tracemalloc

    np, pa = packing.np, jaccard.pa
    rows = members if members > 4096 else 12_000 // members * members
    rng = np.random.default_rng(1)
    bits = np.repeat(rng.integers(-(2**62), 2**62, (rows // members, jaccard.WORDS)), members, 0)
    bits[:, 0] ^= 1 << rng.integers(0, 60, rows)
    key = rng.permutation(rows)
    sig, zero = np.repeat(np.arange(rows // members), members), np.zeros(rows, np.int32)
    names = ["sig", "key", "n", "block", "bi", "bj", "label", *jaccard.SKETCH]
    columns = [sig, key, np.full(rows, 200, np.int32), zero, zero, zero, sig if not across else key % 2, *bits.T]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)
    tracemalloc.start()
    found = [r for b in jaccard._screen(85, across)([batch]) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    assert tracemalloc.get_traced_memory()[1] < (250 << 20)
    tracemalloc.stop()
    low = {}
    for s, k in zip(sig.tolist(), key.tolist(), strict=True):
        low.setdefault(s, []).append(k)
    if across:
        assert len(found) == sum(len([k for k in g if k % 2]) * len([k for k in g if not k % 2]) for g in low.values())
    else:
        of = {k: min(g) for g in low.values() for k in g}
        assert len(found) == rows - rows // members and all(a < b and of[a] == of[b] for a, b, *_ in found)
