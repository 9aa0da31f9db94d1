"""Fill-in-the-middle, chat formatting and the divergence audit against plain versions."""

import hashlib
import random
import re
import time
from collections import Counter, defaultdict

import brute_path  # noqa: F401
import numpy as np
import pyarrow as pa
import pytest

from pagelake.llm import chat_format as chat
from pagelake.llm import divergence_audit as audit
from pagelake.llm import fill_in_middle as fim

sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
MIXED = ["a", "B", "z", "é", "😀", " ", "\n", "<", "P", ">", "S", "1", "\x00", "{", "`", "@", "["]


# -- fill in the middle ---------------------------------------------------------
def plain_fim(doc_id, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i: i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 20:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


@pytest.mark.parametrize("step", [1, 2, 3, 1 << 20])
def test_cuts_and_rotations(step):
    rnd = random.Random(step)
    for _ in range(1500):
        text = "".join(rnd.choice(MIXED) for _ in range(rnd.randint(0, 30)))
        data, units = text.encode(), re.findall("[A-Za-z]+|[^A-Za-z]", text)
        a, b = sorted((rnd.randint(0, len(units)), rnd.randint(0, len(units))))
        pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
        assert fim.count_units(data, step) == len(units)
        cuts = fim.byte_offsets(data, [a, b], step)
        assert cuts == [len(pre.encode()), len((pre + mid).encode())]
        assert fim.count_chars(data, cuts[0], cuts[1], step) == len(mid)
        view = np.frombuffer(bytearray(data), np.uint8)
        fim.reverse(view, 0, len(view), step)
        assert bytes(view) == data[::-1]
        if not any(s in data for s in fim.SENTINELS):
            for form, want in (("psm", f"<P>{pre}<S>{suf}<M>{mid}"), ("spm", f"<S>{suf}<P>{pre}<M>{mid}")):
                out = fim.transform(data, *cuts, form)
                assert out.decode() == want and fim.restore_text(out, form) == data


def test_fim_table(spark):
    rnd = random.Random(1)
    texts = ["", None, "x", "<P>", "a <S> b", "<<M>", "a" * 50_000 + " é" * 700_000, "<", "><P", "<P" * 9]
    texts += ["".join(rnd.choice(MIXED) for _ in range(rnd.randint(0, 60))) for _ in range(300)]
    rows = [(i, t, "s", 7) for i, t in enumerate(texts)] + [(3, "again", None, 1)] * 2 + [(None, "no id", "s", None)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, form STRING, n INT")
    got = fim.restore(fim.fill_in_middle(docs)).collect()
    assert [(r.doc_id, r.text) for r in got] == [r[:2] for r in rows]
    for r in got:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_fim(r.doc_id, r.text)
        assert r.restored == (r.text or "")
    digests = {r.doc_id: r for r in fim.digests(docs.filter("doc_id <> 3")).collect()}
    assert all(r.output_sha256 == sha(plain_fim(i, texts[i])[4]) and r.restored_sha256 == sha(texts[i] or "") for i, r in digests.items())
    assert {"plain", "psm", "spm"} == {r.form for r in got}
    named = spark.createDataFrame([("k1", "some words here")], "doc_id STRING, text STRING")
    assert fim.fill_in_middle(named).first().output == plain_fim("k1", "some words here")[4]
    assert fim.digests(docs.limit(0)).count() == 0


def test_fim_needs_marks():
    with pytest.raises(ValueError):
        fim.restore_text(b"no marks", "psm")


# -- chat -----------------------------------------------------------------------
PIECES = ["<", "s", ">", "/", "[", "INST", "]", "<s>", "</s>", "[INST]", " [/INST]", "\\", "<<SYS>>", "<</SYS>>", "\n", " ", "é", "😀", "[ROLE]", "x", "y"]


def noise(rnd):
    return "".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 9)))


def test_escape_is_reversible_and_leaves_no_control():
    rnd = random.Random(2)
    for _ in range(20_000):
        text = noise(rnd)
        out = chat.escape(text)
        assert chat.unescape(out) == text and not any(c in out for c in chat.CONTROLS)


def test_located_turns_read_back():
    rnd = random.Random(3)
    for _ in range(3000):
        turns = [(rnd.choice(["user", "assistant", "system", "tool", "", noise(rnd)]), noise(rnd)) for _ in range(rnd.randint(1, 7))]
        f = chat.locate(turns, chat.default_template)
        ends = [*f.starts[1:], len(f.text)]
        assert f.rewritten_at is None and [chat.read_turn(f.text[a:b]) for a, b in zip(f.starts, ends)] == turns
        assert "".join(chat.unescape(f.text[a:b]) for _, a, b in f.loss) == "".join(t for r, t in turns if r == "assistant")


def without_old_thoughts(turns):
    last = len(turns) - 1
    return "".join(f"{r}: {t if i == last else re.sub('<think>.*?</think>', '', t)}\n" for i, (r, t) in enumerate(turns))


def with_footer(turns):
    return "".join(f"{r}: {t}\n" for r, t in turns) + "END"


def twice(turns):
    return "".join(f"{t}|{t}\n" for _, t in turns)


def trimmed(turns):
    return "HEAD\n" + "".join(f"{r}: {t.strip()}\n" for r, t in turns)


def test_templates_that_rewrite_history():
    turns = [("user", "q"), ("assistant", "<think>hm</think>a"), ("user", "more"), ("assistant", " b ")]
    assert chat.locate(turns, without_old_thoughts).rewritten_at == 2
    assert chat.locate(turns[:1] + turns[2:], without_old_thoughts).rewritten_at is None
    assert chat.locate(turns, with_footer).rewritten_at == 1
    assert chat.locate(turns, twice).rewritten_at == 1
    f = chat.locate(turns, trimmed)
    assert [f.text[a:b] for _, a, b in f.loss] == ["<think>hm</think>a", "b"] and f.text[f.starts[2]:].startswith("user: more")
    bad = chat.locate(turns, with_footer)
    assert bad.loss == [] and bad.starts is None and bad.text == with_footer(turns)


def test_chat_table(spark):
    rnd = random.Random(4)
    rows = [(c, t, rnd.choice(["user", "assistant", "system", None, "tool"]), rnd.choice([noise(rnd), None, ""]), "x")
            for c in range(60) for t in range(rnd.randint(1, 6))]
    rows += [(90, 0, "user", "same", "x")] * 2 + [(90, 0, "assistant", "tie", "y"), (None, 1, "user", "no id", "z"), (91, None, "user", "no turn", "")]
    rows += [(92, t, "assistant" if t % 2 else "user", f"{t} [INST]", "") for t in range(1500)]
    table = spark.createDataFrame(rows, "conv_id BIGINT, turn INT, role STRING, text STRING, formatted STRING")
    plain = defaultdict(list)
    for conv, turn, role, text, _ in sorted(rows, key=lambda r: [(x is not None, x) for x in r[1:4]]):
        plain[conv].append((role or "", text or ""))
    formatted = chat.format_conversations(table)
    got = {r.conv_id: r for r in formatted.collect()}
    assert set(got) == set(plain) and all(r.formatted == chat.default_template(plain[c]) and r.n_turns == len(plain[c]) for c, r in got.items())
    told = {r.conv_id: r for r in chat.digests(table).collect()}
    for conv, turns in plain.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        want = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), len(chat.default_template(turns)))
        assert tuple(told[conv])[1:] == want
    assert chat.digests(table.limit(0)).count() == 0
    rewritten = chat.format_conversations(table.filter("conv_id = 92"), lambda turns: "".join(t for _, t in turns) + "END").first()
    assert rewritten.rewritten_at == 1 and rewritten.spans == [] and rewritten.loss == []


# -- divergence audit -------------------------------------------------------------
def plain_audit(rows, min_docs, top):
    docs = [tuple(x or "" for x in r) for r in rows]
    term = lambda t: [x.decode() for x in re.findall(rb"[A-Za-z\x80-\xff]+", t.encode())]
    lowered = lambda t: "".join(c.lower() if c.isascii() else c for c in t)
    df, n = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in docs:
        found = term(lowered(text))
        df[lang].update(set(found))
        n[lang, source].update(found)
    out = []
    for lang in {d[0] for d in docs}:
        kept = sorted(t for t, c in df[lang].items() if c >= min_docs)
        sources = sorted({d[1] for d in docs if d[0] == lang}, key=str.encode)
        p = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c[x] for x in kept) + 5 * len(kept)) for t in kept}
        q = p(sum((n[lang, s] for s in sources), Counter()))
        ps = {s: p(n[lang, s]) for s in sources}
        for s in sources:
            pairs = [(o, sum(abs(ps[s][t] - ps[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, ps[s][t] - q[t]) for t in kept if n[lang, s][t] and ps[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(ranked)]
    return sorted(out)


def audit_rows(rnd, n=260):
    words = ["the", "The", "the,", "a-the", "Été", "été", "É", "x1y", "x", "y", "9", "don't", "n", "汉字", "end.", "\x00q"]
    rows = [(rnd.choice(["en", "fr", None]), rnd.choice(["s1", "s2", "é3", None]) if i % 3 else "hot",
             None if i % 29 == 0 else " ".join(rnd.choices(words[i % 5:], k=rnd.randint(0, 12)) + [f"w{rnd.randint(0, 60)}{rnd.choice(['', '.', ',x'])}"]))
            for i in range(n)]
    return rows + rows[:20] + [("de", "s1", "1 2 3"), ("de", "s2", ""), ("it", "alone", "the the")]


@pytest.mark.parametrize("min_docs, cells, tile", [(1, 1 << 20, 256), (4, 8, 2), (30, 50, 1)])
def test_audit_equals_plain(spark, min_docs, cells, tile):
    rows = audit_rows(random.Random(min_docs))
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "lang STRING, source STRING, text STRING, term STRING, n INT").repartition(5)
    got = sorted(tuple(r) for r in audit.divergence_audit(docs, min_docs, 4, cells, tile).collect())
    assert got == plain_audit(rows, min_docs, 4)


def test_audit_compares_documents_where_bounds_leave_it_open(spark):
    # Term t: 3 documents with one chunk and 3 with another are 4 documents; u the same in 3.
    texts = ["t t, u u,", "t t, u u,", "t u", "t, u,", "v", "v."]
    rows = [("en", "s", x) for x in texts]
    docs = spark.createDataFrame(rows, "lang STRING, source STRING, text STRING")
    assert {r.term for r in audit.kept_terms(audit.normal(docs), 4).collect()} == {"t", "u"}
    rows[3] = ("en", "s", "t,")
    docs = spark.createDataFrame(rows, "lang STRING, source STRING, text STRING")
    assert {(r.term, r.n) for r in audit.kept_terms(audit.normal(docs), 4).collect()} == {("t", 6)}


def test_audit_empty_and_wordless(spark):
    docs = spark.createDataFrame([], "lang STRING, source STRING, text STRING")
    assert audit.divergence_audit(docs).collect() == []
    docs = spark.createDataFrame([("en", "b", None), ("en", "a", "12")], "lang STRING, source STRING, text STRING")
    assert sorted(tuple(r) for r in audit.divergence_audit(docs).collect()) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_audit_shares_are_exact(spark):
    rnd = random.Random(9)
    cases = [(rnd.randint(0, 10**k), rnd.randint(10**k, 10 ** (k + 1)), rnd.randint(1, 10**6)) for k in range(1, 14) for _ in range(20)]
    want = [1 + 10**9 * (n + 5) // (total + 5 * v) for n, total, v in cases]
    assert [int(audit.shares(np.array([n]), np.array([t]), v)[0]) for n, t, v in cases] == want
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i INT, n BIGINT, total BIGINT, v BIGINT")
    assert [r.p for r in df.orderBy("i").select(audit.share("n", "total", "v").alias("p")).collect()] == want


def test_filter_knows_its_chunks(spark):
    made = audit.filter_bits(spark.createDataFrame([(f"é{i}",) for i in range(3000)], "chunk STRING"))
    chunks = [f"é{i}".encode() for i in range(3000)]
    assert audit.possibly_in(chunks, made) == chunks
    assert len(audit.possibly_in([f"no{i}".encode() for i in range(10_000)], made)) < 300
    assert audit.possibly_in([], made) == []
    assert audit.possibly_in(chunks, audit.filter_bits(spark.createDataFrame([], "chunk STRING"))) == []


def test_audit_counts_chunks_without_case_and_what_surrounds_them(spark):
    texts = ["Word, (word) WORD. 12 -- word", "É,x éX É,X;", "a-b \"A-B\" a b", None]
    docs = spark.createDataFrame([("en", "s", x) for x in texts], "lang STRING, source STRING, text STRING")
    counted = {(r.chunk, r.docs, r.n) for r in audit.chunk_counts(audit.normal(docs)).collect()}
    assert counted == {("word", 1, 4), ("É,x", 1, 2), ("éx", 1, 1), ("a-b", 1, 2), ("a", 1, 1), ("b", 1, 1)}


def test_audit_compares_documents_of_chunks_with_several_terms(spark):
    # Term t: 2 documents with t, 2 with t-u, 2 with u-t; 4 documents or 3.
    texts = ["T, t-u", "(t) U-T.", "t-u", "u-t"]
    for texts, want in ((texts, {"t", "u"}), (texts[:2] + ["t-u u-t"], set())):
        docs = spark.createDataFrame([("en", "s", x) for x in texts], "lang STRING, source STRING, text STRING")
        assert {r.term for r in audit.kept_terms(audit.normal(docs), 4).collect()} == want


def test_audit_counts_a_long_text_in_pieces(spark):
    # Above SLICE_BYTES, so in pieces; the short ones around it are counted together.
    texts = ["B-c, x", "b-C (x) É! " * 500_000, None, "x x B-c."]
    assert len(texts[1].encode()) > audit.SLICE_BYTES
    rows = [("en", f"s{i % 2}", x) for i, x in enumerate(texts)]
    docs = spark.createDataFrame(rows, "lang STRING, source STRING, text STRING").coalesce(1)
    counted = {(r.source, r.chunk, r.docs, r.n) for r in audit.chunk_counts(audit.normal(docs)).collect()}
    n = 500_000
    assert counted == {("s0", "b-c", 1, 1), ("s0", "x", 1, 1), ("s1", "b-c", 2, n + 1), ("s1", "x", 2, n + 2), ("s1", "É", 1, n)}
    wanted = audit.filter_bits(spark.createDataFrame([("b-c",)], "chunk STRING"))
    held = {(r.chunk, r.row) for r in audit.holders(audit.normal(docs), wanted).collect() if r.chunk == "b-c"}
    assert len({row for _, row in held}) == 3


def test_audit_counts_chunks_for_less_than_python_words_cost(spark):
    """CPU time of the counting task against splitting and counting the same words one by one; it was above it before."""
    rnd = random.Random(5)
    words = [f"{''.join(rnd.choices('abcdeé', k=rnd.randint(2, 7)))}{rnd.choice(['', '', '.', ','])}" for _ in range(40_000)]
    texts = [" ".join(rnd.choices(words, k=600)) for _ in range(1500)]
    batch = pa.RecordBatch.from_arrays([pa.repeat("en", 1500), pa.array([f"s{i % 20}" for i in range(1500)]), pa.array(texts)], ["lang", "source", "text"])

    class Docs:
        def mapInArrow(self, run, schema):
            self.run = run
            return self

        def repartition(self, *keys):
            return self

        groupBy = agg = repartition

    def plain():
        n, held = Counter(), Counter()
        for text in texts:
            found = text.encode().lower().split()
            n.update(found)
            held.update(set(found))

    def seconds(f):
        began = time.process_time()
        f()
        return time.process_time() - began

    docs = Docs()
    audit.chunk_counts(docs)
    assert min(seconds(lambda: list(docs.run(iter([batch])))) for _ in range(3)) < min(seconds(plain) for _ in range(3))
