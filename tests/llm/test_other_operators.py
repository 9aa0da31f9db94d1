import math
import zlib
from collections import Counter, defaultdict

import brute_path  # noqa: F401
import brute
import numpy as np
import pytest

from pagelake.llm import embedding_dedup, html_extraction, mixing, toxicity
from pagelake.llm.html_extraction import extract_text


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("   ", ""), ("<html><body></body></html>", ""),
    ("<p>one</p><p>two &amp; three&nbsp;four</p>", "one two & three four"),
    ("<body><nav><a href=x>Home</a></nav><article><h1>T</h1><p>Text of <b>so</b>me\n length.<br>More</article><footer>f</footer>", "T Text of some length. More"),
    ("<article><header><h1>T</h1></header><section><p>First part of it</p></section><section><p>Second part, too</p></section></article>", "T First part of it Second part, too"),
    ("<div class='ad banner'>Buy</div><main><p>Kept words here</p><div id=comments><p>me too</p></div></main><aside>x</aside>", "Kept words here"),
    ("<article>a<script>var x='</p>';</script>b<!-- c --><style>p{}</style><form><input>q</form></article>", "ab"),
    ("<article><p>cut <a href='x", "cut"),
    ("<article><p>a < b and 3 > 2 &#" + "9" * 5000 + ";</p></article>", "a < b and 3 > 2 �"),
    ("<![foo bar]><p><![if x]>kept", "kept"),
    ("<p>" * 3000 + "deep" + "<div>" * 3000 + "er", "deep er"),
    ("<nav>" + "<div>" * 3000 + "x</nav><p>Article text</p>", "Article text"),
    # Names that speak of the layout, and forms around a whole page, hide nothing.
    ("<body><div class='content with-sidebar'><p>Article text</p></div>", "Article text"),
    ("<body><div class='has-header no-menu'><article><p>Article text</p></article></div>", "Article text"),
    ("<body><div id=sidebar-layout><p>Article text that is all the page holds</p></div>", "Article text that is all the page holds"),
    ("<body><form action=/page><div><p>Article text</p><input name=q></div></form>", "Article text"),
    ("<body><main><div class='promo-page'><p>Article text</p></div></main>", "Article text"),
    # Inline parts end with their own end tag; links are judged like other inline parts.
    ("<p>Text <span class='ad'><span>buy</span> now cheap</span>goes on</p>", "Text goes on"),
    ("<p>Text <a class='share' href=x>share this</a><a hidden>gone</a><i aria-hidden=true>x</i>goes <a href=y>on</a></p>", "Text goes on"),
    ("<p class=ad><p><span class='ad'>never closed <b>text</b></p>", "never closed text"),
    # Long comments beside a short article.
    ("<body><article><p>Short article text.</p></article><section id=comments>" + f"<article class=comment><p>{'Longer than that. ' * 30}</p></article>" * 9 + "</section>",
     "Short article text."),
    ("<body><div>" + f"<p>{'Dense text without telling names. ' * 9}</p>" * 3 + "<ul>" + "<li><a href=x>a</a>" * 9 + "</ul><div class=ad>Buy</div></div>",
     " ".join([("Dense text without telling names. " * 9).strip()] * 3)),
])
def test_pages(page, want):
    assert extract_text(page) == want


def plain_density(node, page):
    """Density of a tree of ("tag", children), texts as strings, by the formula; and (characters, of links, tags, link tags)."""
    def size(n, linked):
        if isinstance(n, str):
            c = len(n.replace(" ", ""))
            return c, c * linked, 0, 0
        parts = [size(x, linked or n[0] == "a") for x in n[1]]
        c, lc, t, lt = (sum(x) for x in zip(*parts)) if parts else (0, 0, 0, 0)
        return c, lc, t + 1, lt + (n[0] == "a")

    c, lc, t, lt = size(node, False)
    t = max(t - 1, 1)
    if not c:
        return 0.0
    return c / t * math.log(max(c * t / (max(lc, 1) * max(lt, 1)), 1)) / math.log(1 + math.log(c / max(c - lc, 1) * lc + page * c + math.e))


def markup(node):
    return node if isinstance(node, str) else f"<{node[0]}>" + "".join(map(markup, node[1])) + f"</{node[0]}>"


def test_density_equals_the_plain_formula():
    rnd = np.random.default_rng(6)

    def tree(depth):
        def child():
            x = rnd.random()
            if x < 0.4 or not depth:
                return "some words here "[: int(rnd.integers(1, 16))]
            return ("a", ["link text"]) if x < 0.6 else tree(depth - 1)
        return ("div", [child() for _ in range(rnd.integers(1, 6))])

    for _ in range(60):
        page = ("body", [tree(4), tree(3)])
        got = html_extraction.Tree(markup(page))
        sizes = html_extraction.Sizes(got)
        density, total = html_extraction.densities(got, sizes, sizes.doubted(got))
        share = sizes.link_chars[0] / max(sizes.chars[0], 1)
        order = []

        def walk(n):
            if not isinstance(n, str) and n[0] != "a":
                order.append(n)
                for x in n[1]:
                    walk(x)
        walk(page)
        assert np.allclose(density[1:], [plain_density(n, share) for n in order])
        assert np.allclose(total[1:], [sum(plain_density(x, share) for x in n[1] if not isinstance(x, str) and x[0] != "a") for n in order])


def test_density_decides(monkeypatch):
    """With every part that HTML does not rule out the text is another: names alone remove nothing."""
    page = "<body><div class=ad>Buy this now</div><div>" + f"<p>{'Words of the article. ' * 9}</p>" * 4 + "</div><div class=related>More <a href=x>here</a></div>"
    text = extract_text(page)
    assert "Buy" not in text and "here" not in text and text.count("article") == 36
    monkeypatch.setattr(html_extraction, "content_nodes", lambda tree: [not s for s in tree.skip])
    assert "Buy this now" in extract_text(page)


def test_html_table(spark):
    rows = [(1, "u", "<p>x y</p>", 5), (1, "u", "<p>x y</p>", 5), (None, None, None, None)]
    df = spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING, text INT")
    got = sorted((tuple(r) for r in html_extraction.html_extraction(df).collect()), key=repr)
    assert got == sorted([(1, "u", "x y", 3), (1, "u", "x y", 3), (None, None, "", 0)], key=repr)
    assert html_extraction.html_extraction(df.limit(0)).count() == 0


def vectors():
    rnd = np.random.default_rng(4)
    out = list(rnd.standard_normal((150, 16)))
    centre = rnd.standard_normal(16) * 3
    out += [centre + rnd.standard_normal(16) * 0.35 for _ in range(120)]
    out += [centre * 2] * 5 + [out[0] * (1 + 1e-3)]
    step = np.zeros(16)
    for i in range(12):  # a chain whose ends don't link
        v = step.copy()
        v[0], v[1] = math.cos(0.4 * i), math.sin(0.4 * i)
        out.append(v)
    return [v.astype("f4").tolist() for v in out]


def brute_links(rows, cosine=0.9):
    ok = [(d, np.array(v, float)) for d, v in rows if d is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links = [(a, b) for i, (a, x) in enumerate(ok) for b, y in ok[:i] if len(x) == len(y) and x @ y / math.sqrt((x @ x) * (y @ y)) >= cosine]
    comp = brute.components([d for d, _ in rows if d is not None], links)
    n = Counter(x for pair in links for x in pair)
    return sorted((d, n[d], comp[d], comp[d] == d) for d, _ in rows if d is not None)


@pytest.mark.parametrize("tile", [8, 1024])
def test_embeddings(spark, monkeypatch, tile):
    monkeypatch.setattr(embedding_dedup, "TILE", tile)
    rows = list(enumerate(vectors()))
    rows += [(900, None), (901, []), (902, [0.0] * 16), (903, [math.nan] * 16), (904, [None] * 16), (905, [math.inf] * 16), (906, [1.0, 2.0]), (907, [2.0, 4.0])]
    df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<FLOAT>")
    assert sorted(tuple(r) for r in embedding_dedup.embedding_dedup(df).collect()) == brute_links(rows)
    assert embedding_dedup.embedding_dedup(df.limit(0)).count() == 0


def test_passes_grow_with_the_table():
    n = [embedding_dedup.passes_for(k, 0.9, 128) for k in (0, 100, 10_000, 100_000, 1_000_000, 10**9)]
    assert n == sorted(n) and n[0] == 1 and n[-1] < 200


def test_forest_connects_what_windows_link():
    rnd = np.random.default_rng(7)
    x = rnd.standard_normal((300, 3))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for window, done in ((1, 0), (7, 3), (300, 0), (500, 0)):
        links = [(i, j) for j in range(done, 300) for i in range(max(0, j - window), j) if x[i] @ x[j] >= 0.9]
        at, first = embedding_dedup.forest(x, window, 0.9, done)
        want = brute.components(range(300), links)
        assert dict(zip(at.tolist(), first.tolist())) == {i: c for i, c in want.items() if c != i}


def test_neighbours_across_ranges(spark):
    """One pass whose window is longer than a range: pairs on the two sides of a border are found."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rnd = np.random.default_rng(8)
        centre = rnd.standard_normal(16)
        rows = [(i, 4, (centre + rnd.standard_normal(16) * 0.05).astype("<f4").tobytes()) for i in range(60)]
        df = spark.createDataFrame([(i, 16, v) for i, _, v in rows], "rep BIGINT, dims INT, vec BINARY")
        links = [(r.a, r.b) for r in embedding_dedup.window_links(df, 0.9, 1, 20, "<f4").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert set(brute.components(range(60), links).values()) == {0}


def test_repeated_vector_ids_and_clashing_columns(spark):
    rows = [(1, [1.0, 0.0], 5, "k"), (1, [1.0, 0.0], 6, "k"), (2, [1.0, 0.01], 0, None), (None, [1.0, 0.0], 0, "x"), (3, [0.0, 1.0], 0, "x"), (4, [0.0, 2.0], 0, "x")]
    df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>, component_id INT, kept STRING")
    got = sorted((tuple(r) for r in embedding_dedup.embedding_dedup(df).collect()), key=repr)
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (None, 0, None, True), (3, 1, 3, True), (4, 1, 3, False)], key=repr)


def test_mixing_keeps_weights(spark):
    rows = [(i, "a" if i % 3 else ("b" if i % 2 else None)) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, source STRING")
    weights = {"a": 0.5, "b": 0.3, "": 0.2}
    got = mixing.mix_positions(df, block_rows=10, period=100, weights=weights).collect()
    assert len(got) == len(rows) == len({r.mix_order for r in got})
    slots = defaultdict(dict)
    for r in got:
        slots[r.source][r.block] = r.mix_slot
    assert len({s for by in slots.values() for s in by.values()}) == sum(map(len, slots.values()))
    for source, by in slots.items():
        w = weights[source or ""]
        for block, slot in by.items():
            assert math.floor(round(block / w, 9)) <= slot < math.ceil(round((block + 1) / w, 9))
    first_end = min(max(by.values()) for by in slots.values())
    for t in range(first_end):
        for source, by in slots.items():
            assert abs(sum(s <= t for s in by.values()) - weights[source or ""] * (t + 1)) < 1


def test_mixing_repeats_and_empty(spark):
    df = spark.createDataFrame([(1, "t", "a"), (1, "t", "a"), (None, None, None)], "doc_id BIGINT, text STRING, source STRING")
    assert mixing.mix_positions(df).count() == 3
    assert mixing.mixed(df).count() == 3 and mixing.mixed(df).columns == df.columns
    assert mixing.mix_positions(df.limit(0)).count() == 0


def test_toxicity_learns_pairs(spark):
    rnd = np.random.default_rng(2)
    words = [f"plain{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    rows, labels = [], []
    for i in range(3000):
        text = [words[j] for j in rnd.integers(0, 300, 30)]
        insult, group = rnd.random() < 0.5, rnd.random() < 0.5
        text += ["vermin"] * insult + ["neighbours"] * group
        rows.append((i, " ".join(text)))
        labels.append((i, int(insult and group)))
    rows += [(5000, None), (5001, ""), (5001, "")]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    got = toxicity.toxicity(docs, spark.createDataFrame(labels, "doc_id BIGINT, toxic INT")).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    want = dict(labels)
    held = [r for r in got if r.held_out and r.doc_id in want]
    assert held and all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in held)
    assert sum(r.predicted == want[r.doc_id] for r in held) >= 0.97 * len(held)


def toxic_texts(rnd, n, toxic):
    words = [f"plain{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        one, other = rnd.random() < 0.5, rnd.random() < 0.5
        text = [words[j] for j in rnd.integers(0, 300, 30)] + ["vermin"] * one + ["neighbours"] * other
        rows.append((f"d{i}", " ".join(text)))
        labels.append((f"d{i}", int(toxic(one, other))))
    return rows, labels


def test_toxicity_where_only_the_pair_tells(spark):
    """One word or the other, not both: every sum of weights is right half the time."""
    rows, labels = toxic_texts(np.random.default_rng(3), 3000, lambda a, b: a != b)
    docs = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "doc_id STRING, text STRING, toxic STRING, score DOUBLE")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, spark.createDataFrame(labels, "doc_id STRING, toxic INT")).collect()}
    held = [(r.predicted, want) for i, want in labels if (r := got[i]).held_out]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
    y, x = np.array([want for _, want in labels]), np.array([["vermin" in t, "neighbours" in t, 1] for _, t in rows], float)
    linear = (x @ np.linalg.lstsq(x, y, rcond=None)[0] >= 0.5) == y
    assert linear.mean() < 0.6


def test_toxicity_repeated_and_conflicting_labels(spark):
    rows, labels = toxic_texts(np.random.default_rng(4), 600, lambda a, b: a)
    plain = toxicity.toxicity(spark.createDataFrame(rows, "doc_id STRING, text STRING"), spark.createDataFrame(labels, "doc_id STRING, toxic INT"))
    # Repeats change nothing; a document with both labels, one without text row and null labels tell nothing.
    odd = [("d0x", 0), ("d0x", 1), ("gone", 1), ("d1", None), (None, 1)]
    more = spark.createDataFrame([*rows, ("d0x", "vermin"), (None, "vermin"), ("nul", None), ("long", "vermin " * 300_000 + "plainaa")], "doc_id STRING, text STRING")
    other = toxicity.toxicity(more, spark.createDataFrame(labels * 3 + odd, "doc_id STRING, toxic INT")).collect()
    want = {(r.doc_id, r.held_out, r.score) for r in plain.collect()}
    assert want <= {(r.doc_id, r.held_out, r.score) for r in other} and len(other) == len(rows) + 4
    assert {r.doc_id: r.held_out for r in other}[None] is True and {r.doc_id: r.predicted for r in other}["long"] == 1


def plain_logit(model, text):
    """The machine as it is written: weights, and the product of factors of every pair of terms."""
    at = [model.index[t] for w in toxicity.distinct_words(text) for t in toxicity.terms(w) if t in model.index]
    v = model.table[at, 1:-1]
    pairs = sum(v[i] @ v[j] for i in range(len(at)) for j in range(i))
    return model.b + model.table[at, 0].sum() + pairs


def test_toxicity_pair_sum_equals_all_pairs(spark):
    rnd = np.random.default_rng(5)
    texts = [" ".join(f"word{chr(97 + k)}" for k in rnd.integers(0, 26, 12)) for _ in range(40)] + ["", "Alone"]
    buckets = sorted({t for x in texts for w in toxicity.distinct_words(x) for t in toxicity.terms(w)})[::2]
    model = toxicity.Model(0.3, buckets, rnd.normal(size=len(buckets)), rnd.normal(size=(len(buckets), toxicity.FACTORS)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    for r in toxicity.score(docs, model).collect():
        assert math.isclose(r.score, 1 / (1 + math.exp(-max(-30, min(30, plain_logit(model, texts[r.doc_id]))))), rel_tol=1e-9)


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id BIGINT, text STRING")
    got = toxicity.toxicity(docs, spark.createDataFrame([], "doc_id BIGINT, toxic INT")).collect()
    assert [r.score for r in got] == [0.5, 0.5]
