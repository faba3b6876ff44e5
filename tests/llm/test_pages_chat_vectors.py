"""Main text, token counts, vectors and transcripts on awkward tables and against brute force."""

import random

import cases
import numpy as np
import pytest

from scoreloom.llm import chat_format, html_text, packing, queries_chat, token_counts, vector_search

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header><a href=/>Home</a></header><nav><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></nav>
<div class="cookie-notice">We use cookies</div><!-- <p>no</p> -->
%s
<aside>Side words</aside><div id="comments"><p>Great post!</p></div><form><label>Mail</label><input></form>
<div class="ad">Buy</div><footer>&copy; us</footer><script>var a="</p>";</script></body></html>"""
BODY = "<h1>A &amp; B</h1><p>First   paragraph,\nof <b>some</b> words &eacute;&#233; and more of them here.<br>after break<p>Second one, not closed, with <a href=x>a link</a> inside the text.</p><ul><li>item one is long enough<li>item two as well</ul>"
WANT = "A & B\nFirst paragraph, of some words éé and more of them here.\nafter break\nSecond one, not closed, with a link inside the text.\nitem one is long enough\nitem two as well"


@pytest.mark.parametrize("wrap", ["<article>%s</article>", "<main>%s</main>", "<div class=content>%s</div>", "<div><div id=story>%s</div></div>", "<article><header><a>x</a></header>%s</article>"])
def test_main_text(wrap):
    want = WANT if "header" not in wrap else "x\n" + WANT
    assert html_text.main_text(PAGE % (wrap % BODY)) == want


def test_marked_parts():
    page = PAGE % f'<article><div class="post-header"><h1>Head</h1></div>{BODY}<div class="user-comments">c</div></article><article class="comment">long comment {"words " * 50}</article>'
    assert html_text.main_text(page) == "Head\n" + WANT
    assert html_text.main_text(f'<body><div class="site-header">x</div><h1>T</h1><div id=c>{BODY}</div><ul class=pagination><li>1</ul></body>') == "T\n" + WANT


@pytest.mark.parametrize(
    "wrap",
    ['<div class="content has-sidebar">%s</div>', '<div id="no-sidebar">%s</div>', '<div class="post category-legal tag-popular">%s</div>', '<article class="post category-promotions">%s</article>',
     '<div class="sidebar-layout"><article>%s</article></div>', '<div class="search-page"><main>%s</main></div>', "<form action=/><div>%s</div></form>", '<div class="popular">%s</div>'],
)
def test_marks_are_evidence(wrap):
    assert html_text.main_text(PAGE % (wrap % BODY)) == WANT
    plain = BODY.replace("<h1>", "<h2>").replace("</h1>", "</h2>")
    assert html_text.main_text(PAGE % (wrap % plain)) == WANT


def test_density_decides_inside_main():
    box = "<div class=x7>" + "".join(f"<div class=r><b>user{i}</b><span>now</span><p>Great post!</p></div>" for i in range(8)) + "</div>"
    assert html_text.main_text(PAGE % f"<main><h1>Head</h1><div id=story>{BODY}</div>{box}</main>") == "Head\n" + WANT
    assert html_text.main_text(PAGE % f"<article><section>{BODY}</section>{box}</article>") == WANT


@pytest.mark.parametrize("wrap", ["<article>%s</article><article>%s</article>", "<article>%s</article><section>%s</section>", "<main><section>%s</section><section>%s</section></main>", "<div><div>%s</div><div>%s</div></div>"])
def test_text_in_several_parts(wrap):
    assert html_text.main_text(PAGE % (wrap % (BODY, BODY))) == WANT + "\n" + WANT


@pytest.mark.parametrize("page", [None, "", "   ", "<", "<p", "<!--", "<script>alert(1)", "<div class='", "</p></p>", "<a href=x>", "<nav>only menu</nav>", "&#x110000;&bogus;", "<![CDATA[x]]>"])
def test_broken_pages(page):
    assert isinstance(html_text.main_text(page), str)


def test_page_table(spark):
    deep = "<div>" * 3000 + "deep text" + "</div>" * 3000
    rows = [(1, "u", PAGE % f"<article>{BODY}</article>"), (1, "u", PAGE % f"<article>{BODY}</article>"), (None, None, None), (2, "v", ""), (3, "w", deep), (4, "x", "<p>" + "word " * 100_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'old' AS text", "1 AS n_chars", "'keep' AS key")
    out = html_text.extract(df).collect()
    assert sorted(r.text for r in out) == sorted([WANT, WANT, "", "", "deep text", ("word " * 100_000).strip()])
    assert all(r.n_chars == len(r.text) and r.key == "keep" for r in out)
    assert html_text.extract(df.limit(0)).count() == 0


def test_trees_follow_edits(spark):
    ranks = packing.vocabulary()[1]
    c = token_counts.Counter(ranks)
    rng = random.Random(5)
    bits = [" ", "  ", "\n", "a", "b", "'s", "'", "re", "1", ".", "é", "日", "the ", " of", "\t", "x" * 50]
    for _ in range(400):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 250)))
        d = token_counts.Document(text, *token_counts.leaves(text, c), c)
        for _ in range(5):
            at = rng.randint(0, len(d.text) + 2)
            edit = (at, at + rng.choice([0, 1, 3, 60]), "".join(rng.choice(bits) for _ in range(rng.choice([0, 1, 5]))))
            text = text[: min(at, len(text))] + edit[2] + text[edit[1] :]
            d.apply(edit)
            assert d.text == text and d.tokens == len(c.encode(text)) and d.tree.chars[1] == len(text)
    long = "word and more. " * 20_000
    d = token_counts.Document(long, *token_counts.leaves(long, c), c)
    d.apply((150_000, 150_004, "novel"))
    assert d.tokens == len(c.encode(d.text)) and d.encoded < 1_000


def test_token_table(spark):
    ranks = packing.vocabulary()[1]
    trees = token_counts.build_trees(cases.docs(spark, clashes=True), ranks)
    c = token_counts.Counter(ranks)
    assert sorted((r.text or "", r.n_tokens) for r in trees.collect()) == sorted((t or "", len(c.encode(t or ""))) for _, t in cases.DOCS)
    edits = trees.selectExpr("*", "CASE WHEN doc_id IN (1, 5) THEN array(struct(4 AS start, 9 AS end, 'slow' AS text), struct(0 AS start, 0 AS end, '> ' AS text)) WHEN doc_id = 2 THEN array() END AS edits")
    out = token_counts.recount(edits, ranks).collect()
    for r in out:
        assert r.n_tokens_after == len(c.encode(r.text or "")) == sum(r.leaf_tokens) and r.n_edits == (2 if r.doc_id in (1, 5) else 0)
    assert {r.text for r in out if r.doc_id in (1, 5)} == {"> the slow" + cases.PARA[9:], "> slow"}
    masked = token_counts.recount(token_counts.build_trees(cases.docs(spark, [(1, "mail a.b@c.example or +1 (555) 123-4567 now")]), ranks), ranks, token_counts.redactions).first()
    assert masked.text == "mail <email> or <number> now" and masked.n_tokens_after == len(c.encode(masked.text))
    assert token_counts.recount(trees.limit(0), ranks, token_counts.redactions).count() == 0


def brute_force(rows, every=100, k=10):
    ok = sorted((i, np.array(v, float)) for i, v in rows if i is not None and v is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v))
    out = {}
    for i, q in ok:
        if i % every == 0:
            d = sorted((float(np.sqrt(((v - q) ** 2).sum())), j) for j, v in ok if j != i)[:k]
            out[i] = d
    return out


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def test_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=24).astype("f4").tolist()) for i in range(3000)]
    rows = [(i, rows[7][1]) if i % 3 == 0 else r for i, r in enumerate(rows)]  # a third are the same vector
    bad = [(None, rows[1][1]), (5000, None), (5100, [0.0] * 24), (5200, [float("nan")] * 24), (5300, [float("inf"), *[1.0] * 23]), (5400, [None, *[1.0] * 23]), (5500, [])]
    want = brute_force(rows)
    got: dict = {}
    for r in vector_search.search(vectors(spark, rows + bad).selectExpr("*", "1 AS list", "'x' AS v")).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.score, r.vec_id))
    assert set(got) == set(want)
    hits = sum(len({j for _, _, j in got[q]} & {j for _, j in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    exact = {i: np.array(v, float) for i, v in rows}
    for q, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 11)) and [x[1:] for x in found] == sorted(x[1:] for x in found)
        assert all(s == float(np.sqrt(((exact[j] - exact[q]) ** 2).sum())) for _, s, j in found)
    same = [q for q in want if q % 3 == 0]
    assert all([j for _, _, j in got[q]] == [j for _, j in want[q]] for q in same)


@pytest.mark.parametrize("n", [0, 1, 2, 6])
def test_few_vectors(spark, n):
    rows = [(100 * i, [float(i + 1), 2.0]) for i in range(n)]
    out = vector_search.search(vectors(spark, rows + rows)).collect()
    want = brute_force(rows)
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in out} == {(q, k + 1, j, s) for q, d in want.items() for k, (s, j) in enumerate(d)}
    assert len(out) == sum(map(len, want.values()))


def test_viterbi_is_best():
    import itertools

    rng = np.random.default_rng(3)
    n = len(chat_format.STATES)
    model = chat_format.Model(np.log(rng.dirichlet(np.ones(n))), np.log(rng.dirichlet(np.ones(n), n)), [np.log(rng.dirichlet(np.ones(v), n)) for v in chat_format.FEATURES.values()])
    for size in (1, 2, 4):
        x = np.stack([rng.integers(0, v, size) for v in chat_format.FEATURES.values()], 1)
        e = model.scores(x)
        best = max(model.start[p[0]] + sum(e[i, s] for i, s in enumerate(p)) + sum(model.move[a, b] for a, b in zip(p, p[1:], strict=False)) for p in itertools.product(range(n), repeat=size))
        path, p = chat_format.viterbi(model, x)
        assert abs(p - best) < 1e-9 and len(path) == size


def test_transcripts(spark):
    talk = [(c, t, "user" if t % 2 == 0 else "assistant", f"Is this question {c} {t}?" if t % 2 == 0 else f"It is an answer {c}.\nIt has a second line\n\nand a third.") for c in range(80) for t in range(6)]
    odd = [(None, 0, "user", "no id"), (500, None, "user", "no turn"), (501, 0, None, "no role"), (502, 0, "user", None), (503, 0, "robot", "x"), (504, 0, "user", " "), *talk[:3]]
    long = [(600, t, "user" if t % 2 == 0 else "assistant", f"turn {t}") for t in range(600)]
    df = spark.createDataFrame([*talk, *odd, *long], "conv_id long, turn long, role string, text string")
    raw = queries_chat.transcripts(df).cache()
    assert raw.count() == 80 + 2 + 3 and raw.where("conv_id = 600").agg({"n_turns": "sum"}).first()[0] == 600
    model = chat_format.fit(raw)
    out = chat_format.parse(raw.selectExpr("*", "'x' AS rendered", "'keep' AS key"), model).collect()
    right = sum(a.lstrip("+") == b.lstrip("+") for r in out for a, b in zip(r.roles, r.line_roles, strict=True))
    assert right > 0.9 * sum(len(r.roles) for r in out)
    assert all(r.key == "keep" and r.rendered == chat_format.render([(m.role, m.text) for m in r.messages]) for r in out)
    assert chat_format.parse(raw.limit(0), model).count() == 0
    text = spark.createDataFrame([("User: Hi there?\nBot: Hello.\n\nStill me.\nUser: Bye",), (None,), ("",), (" \n ",)], "text string")
    got = [[(m.role, m.text) for m in r.messages] for r in chat_format.parse(text, model).collect()]
    assert got == [[("user", "Hi there?"), ("assistant", "Hello.\n\nStill me."), ("user", "Bye")], [], [], []]
    assert chat_format.fit(raw.limit(0)).start.shape == (6,)


def test_transcripts_keep_blank_lines(spark):
    """Whole texts go in, blank lines and odd white space too, and come out as one turn; marks in a text are escaped."""
    said = "first\n\n \t\u3000\nsecond <|end|>\n\nthird"
    rows = [(1, 0, "user", "\n\nwhat is it?"), (1, 1, "assistant", said), (2, 0, "user", "\u00a0\n\t"), (3, 0, "user", "word " * 40_000), (3, 1, "assistant", "line\n" * 20_000)]
    rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"Is it {c}?" if t % 2 == 0 else f"It is.\n\nReally {c}.") for c in range(10, 60) for t in range(4)]
    raw = queries_chat.transcripts(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r.conv_id: r for r in raw.collect()}
    assert set(got) == {1, 3, *range(10, 60)}
    first = got[1]
    assert first.text.count("\n") == 2 + 1 + said.count("\n") and first.text.endswith(said[5:]) and first.text.startswith("\n\n")
    assert first.roles == ["+user", "+assistant", "assistant", "assistant"] and len(got[3].roles) == 1 + 20_000
    model = chat_format.fit(raw)
    parsed = {r.conv_id: r for r in chat_format.parse(raw, model).collect()}
    assert all(len(r.line_roles) == len(r.roles) for r in parsed.values())
    turn = next(m.text for m in parsed[1].messages if "second" in m.text)
    assert "\n\n" in turn and parsed[1].rendered.count("<|end|>") == len(parsed[1].messages)


def test_markers():
    kinds = {"User: hi": "user", "### Response: ok": "assistant", "**System:** x": "system", "<|user|> y": "user", "[BOT] z": "assistant", "Anna: hey": "name", "> quoted": "sign", "plain line": "none", "Q: why?": "user", "A good day": "none"}
    assert {k: chat_format.marker(k)[0] for k in kinds} == kinds
    assert "**System:** x"[chat_format.marker("**System:** x")[1] :] == "x"


def test_stray_quotes_and_unclosed_elements():
    """A quote opens a string only behind `=`; elements without an end tag ahead don't take the rest of the page."""
    from scoreloom.llm.html_text import main_text

    words = "The long article has many words, and more sentences follow here. " * 6
    two = f"{words.strip()}\n{words.strip()}"
    for first in (
        f'<p class="x"">{words}</p>', f"<p title=it's>{words}</p>", f"<p><img alt=Bob's>{words}</p>", f"<p><a href=/q?a='x></a>{words}</p>", f"<object data=x><p>{words}</p>",
        f"<select><p>{words}</p>", f"<canvas><p>{words}</p>", f"<audio><video><p>{words}</p>", f"<svg><p>{words}</p>",
    ):
        assert main_text(f"<body><nav><a href=x>menu</a></nav><article>{first}<p>{words}</p></article></body>") == two, first
    closed = f"<article><p>{words}</p><p>x <object><div>fallback</div></object>{words}</p><select><option>one<option>two</select><svg><text>pic</text></svg></article>"
    assert main_text(closed) == f"{words.strip()}\nx {words.strip()}"


def test_hostile_pages_take_little_time():
    import time

    from scoreloom.llm.html_text import main_text

    begun = time.process_time()
    for page in (
        "<div>" * 20_000 + "x" + "</x>" * 20_000, "<b>" * 20_000 + "<hr>" * 20_000, "<li><ul>" * 100 + "<div>" * 20_000 + "<dd>" * 20_000, "<article>" * 10_000 + "a",
        "<object>" * 20_000 + "x", "<p " + 'a="b" ' * 50_000 + ">x", "<a " + "=" * 100_000, "<svg>" * 5_000 + "</svg>", "<div class=menu>" * 5_000 + "<header>" * 5_000,
    ):
        main_text(page)
    assert time.process_time() - begun < 10


def test_densities_against_plain_sums():
    """Counts, densities and sums of random trees, each computed from the whole subtree."""
    import math
    import random

    from scoreloom.llm import html_text

    rng = random.Random(8)

    def page(depth):
        out = []
        for _ in range(rng.randint(0, 4)):
            kind = rng.random()
            if depth and kind < 0.6:
                tag = rng.choice(["div", "a", "span", "section", "b"])
                out.append(f"<{tag}>{page(depth - 1)}</{tag}>")
            else:
                out.append("word " * rng.randint(0, 12))
        return "".join(out)

    def below(n):
        return [n, *(x for c in n.parts if isinstance(c, html_text.Node) and not c.skip for x in below(c))]

    def text(n):
        return "".join(p if isinstance(p, str) else text(p) for p in n.parts if isinstance(p, str) or not p.skip)

    def in_links(n):
        kids = [c for c in n.parts if isinstance(c, html_text.Node)]
        return sum(len(text(c).replace(" ", "")) if c.link else in_links(c) for c in kids)

    for _ in range(150):
        root = html_text.tree("<body>" + page(5) + "</body>")
        html_text._measure(html_text._walk(root))
        size = lambda n: len(text(n).replace(" ", ""))
        share = in_links(root) / max(1, size(root))
        density = {}
        for n in below(root):
            c, t, lc, lt = size(n), max(1, len(below(n)) - 1), in_links(n), sum(x.link for x in below(n)[1:])
            assert (n.chars, n.link_chars, n.tags, n.link_tags) == (c, lc, len(below(n)) - 1, lt)
            density[n] = 0.0
            if c:
                base = math.log(c / max(1, c - lc) * lc + share * c + math.e)
                density[n] = max(0.0, c / t * math.log(max(1.0, c * t / (max(1, lc) * max(1, lt)))) / math.log(base + math.e - 1))
            assert abs(n.density - density[n]) < 1e-9 * (1 + density[n])
        for n in below(root):
            kids = [c for c in n.parts if isinstance(c, html_text.Node)]
            own = size(n) - sum(map(size, kids))
            want = sum(density[c] for c in kids) + density[n] * own / max(1, size(n))
            assert abs(n.total - want) < 1e-9 * (1 + want)
        assert max(below(root), key=lambda n: n.total).total == root.peak.total


def test_vectors_meet_those_of_their_length(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6 if i % 3 else 4).tolist()) for i in range(60)] + [(1000, [1.0, 2.0])]
    got = {}
    for r in vector_search.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=20, k=5).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    by = dict(rows)
    for q in (0, 20, 40):
        far = sorted((float(np.sqrt(((np.array(v) - by[q]) ** 2).sum())), i) for i, v in rows if i != q and len(v) == len(by[q]))[:5]
        assert [(i, round(s, 9)) for _, i, s in sorted(got[q])] == [(i, round(d, 9)) for d, i in far]
    assert 1000 not in got
