import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pagelake.functions.terms import count_terms, english_stop_words, keywords, top_words
from pagelake.functions.text import (
    CHUNK_CHARS, chunks, clean_lines, content_hash, long_words, normalize, tokens, with_bigrams,
)
from pagelake.operators.keywords import frequent_words, ranked_terms, term_counts, with_keywords

BLANKS = "".join(c for c in map(chr, range(0x110000)) if c.isspace())


def random_texts(n, seed=7):
    rnd = random.Random(seed)
    words = ["Alpha", "beta", "été", "Straße", "x", "the", "and", "日本語", "a_b", "42", "don't", "ПРИВЕТ"]
    out = ["", " ", "one", "\n\n", "  a  b  ", f"a{BLANKS}b", *(f"a{b}b {b} c" for b in BLANKS), "​z", "the and"]
    for _ in range(n):
        parts = []
        for _ in range(rnd.randint(1, 40)):
            parts.append(rnd.choice(words))
            parts.append("".join(rnd.choice(BLANKS if rnd.random() < 0.3 else " ") for _ in range(rnd.randint(1, 3))))
        out.append("".join(parts))
    return out


def run(spark, texts, **columns):
    df = spark.createDataFrame(list(enumerate(texts)), "i INT, text STRING")
    return {r.i: r for r in df.select("i", *(c.alias(k) for k, c in columns.items())).collect()}


def python_clean(text):
    lines = (line.strip() for line in text.splitlines())
    pieces = (piece.strip() for line in lines for piece in line.split("  "))
    return "\n".join(p for p in pieces if p)


def python_terms(text, stops):
    words = [w for w in re.findall(r"\w\w+", text.lower()) if w not in stops]
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def python_keywords(text, n, stops):
    out = []
    for i in range(0, len(text), CHUNK_CHARS):
        counts = Counter(python_terms(text[i : i + CHUNK_CHARS], stops))
        if not counts:
            words = [w for w in text.lower().split() if len(w) > 3]
            return [w for w, _ in sorted(Counter(words).items(), key=lambda c: -c[1])][:n]
        out += [t for t, _ in sorted(counts.items(), key=lambda c: (-c[1], c[0].encode()))[:n]]
    return list(dict.fromkeys(out))[:n]


def test_cleaning_and_normalizing_equal_python(spark):
    texts = random_texts(300)
    got = run(spark, texts, clean=clean_lines(F.col("text")), norm=normalize(F.col("text")))
    for i, text in enumerate(texts):
        assert got[i].clean == python_clean(text), repr(text)
        assert got[i].norm == " ".join(text.lower().split()), repr(text)


def test_content_hash(spark):
    edge = "x" * 99_999 + " y"
    texts = ["", " A \n b ", "a b", edge, "é" * 250_001]
    got = run(spark, texts, h=content_hash(F.col("text")))
    assert got[0].h == "d41d8cd98f00b204e9800998ecf8427e"
    assert got[1].h == got[2].h == "0cc9cd4dd26c5137b675a0d819cb9ab0"
    assert got[3].h == "ed5aabd84fea5a86da53b9e2c07f0630"
    hasher = hashlib.md5()
    for i in range(0, 250_001, CHUNK_CHARS):
        hasher.update(("é" * 250_001)[i : i + CHUNK_CHARS].encode())
    assert got[4].h == hasher.hexdigest()


def test_chunks(spark):
    got = run(spark, ["", "abc", "abcd", "abcdefg", "日本語日本"], c=chunks(F.col("text"), 3))
    assert [got[i].c for i in range(5)] == [
        [], ["abc"], ["abc", "d"], ["abc", "def", "g"], ["日本語", "日本"]
    ]


def test_tokens_equal_python(spark):
    stops = set(english_stop_words())
    texts = random_texts(200)
    column = with_bigrams(tokens(F.col("text"), stops))
    got = run(spark, texts, t=column, plain=tokens(F.col("text")))
    for i, text in enumerate(texts):
        assert got[i].t == python_terms(text, stops), repr(text)
        assert got[i].plain == re.findall(r"\w\w+", text.lower())


def test_counts_and_words(spark):
    texts = ["b a b c b a", "", "beta alpha beta alpha gamma tiny abc"]
    got = run(
        spark, texts,
        counts=count_terms(F.split("text", " ")), words=top_words(long_words(F.col("text")), 3),
    )
    assert [tuple(c) for c in got[0].counts] == [(2, "a"), (3, "b"), (1, "c")]
    assert [tuple(c) for c in got[2].words] == [(2, "beta"), (2, "alpha"), (1, "gamma")]
    assert got[1].words == []


def test_keywords_equal_python(spark):
    stops = set(english_stop_words())
    long_text = "first words lead here " * 6000 + "tail " * 3000
    texts = [*random_texts(100), "the and with with from", "this that", long_text]
    got = run(spark, texts, k=keywords(F.col("text")), k3=keywords(F.col("text"), top_n=3))
    for i, text in enumerate(texts):
        assert got[i].k == python_keywords(text, 10, stops), repr(text[:80])
        assert got[i].k3 == python_keywords(text, 3, stops)


def test_keyword_fixtures(spark):
    stops_only = "with from with THAT"
    texts = ["ocean ocean ocean tide tide moon", "zeta alpha", stops_only, ""]
    got = run(spark, texts, k=keywords(F.col("text")))
    assert got[0].k[:3] == ["ocean", "ocean ocean", "tide"]
    assert got[1].k == ["alpha", "zeta", "zeta alpha"]
    assert got[2].k == ["with", "from", "that"]
    assert got[3].k == []


def test_keyword_tables_agree(spark):
    texts = random_texts(50) + ["word " * 30_000 + "other " * 10_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc INT, text STRING")
    counts = term_counts(df, ["doc"]).groupBy("doc").agg(F.sum("tf").alias("n"))
    stops = set(english_stop_words())
    for row in counts.collect():
        pieces = [texts[row.doc][i : i + CHUNK_CHARS] for i in range(0, len(texts[row.doc]), CHUNK_CHARS)]
        assert row.n == sum(len(python_terms(p, stops)) for p in pieces)
    ranked = ranked_terms(df, ["doc"], top_n=5)
    assert ranked.groupBy("doc", "chunk").agg(F.max("rank").alias("m")).filter("m > 5").isEmpty()
    first = {(r.doc): r.term for r in ranked.filter("chunk = 0 and rank = 1").collect()}
    for row in with_keywords(df).collect():
        assert (row.keywords or [None])[0] == first.get(row.doc)


def test_vocabulary_cap(spark):
    text = " ".join(f"w{i:03d}" for i in range(80))
    df = spark.createDataFrame([(1, text)], "doc INT, text STRING")
    assert ranked_terms(df, ["doc"], top_n=60).count() == 50


def test_frequent_words(spark):
    df = spark.createDataFrame([(1, "long word long tiny it is word long")], "doc INT, text STRING")
    rows = [(r["rank"], r.term, r.tf) for r in frequent_words(df, ["doc"], top_n=2).orderBy("rank").collect()]
    assert rows == [(1, "long", 3), (2, "word", 2)]


def test_keywords_stay_in_the_row(spark, plan_of):
    df = spark.createDataFrame([(1, "a")], "doc INT, text STRING")
    plan = plan_of(with_keywords(df))
    assert "Exchange" not in plan and "Python" not in plan


@pytest.mark.parametrize("stops", [(), ("alpha",), ("don't", "beta")])
def test_own_stop_words(spark, stops):
    texts = random_texts(60, seed=3)
    got = run(spark, texts, t=tokens(F.col("text"), stops))
    for i, text in enumerate(texts):
        assert got[i].t == [w for w in re.findall(r"\w\w+", text.lower()) if w not in stops]


def test_term_table_is_summed_up_without_sorting_it(spark, tmp_path, plan_of):
    from pagelake.plans.queries import QUERIES

    rows = [(1, "zebra apple zebra"), (1, "zoo apple"), (2, None), (3, "")]
    spark.createDataFrame(rows, "doc_id BIGINT, text STRING").write.parquet(str(tmp_path / "documents.parquet"))
    df = QUERIES["term_counts"](spark, str(tmp_path))
    # One doc_id twice: both texts count. Terms: zebra 2, apple, zebra apple, apple zebra; zoo, apple, zoo apple.
    assert [tuple(r) for r in df.collect()] == [(1, 0, 7, 8, 2, "zoo apple")]
    below = plan_of(df).split("inline")[0].rsplit("HashAggregate", 1)
    assert len(below) == 2 and "Sort " not in below[1] and "SortAggregate" not in below[1]


def test_ranking_has_no_lambda_per_term(spark, plan_of):
    from pagelake.functions.terms import top_terms

    lists = [["b b", "b", "bb", "b", "a", "b b"], ["z", "y", "x"], ["é", "éa", "é", "é a", "éa"], []]
    df = spark.createDataFrame([(x,) for x in lists], "t ARRAY<STRING>")
    found = df.select(top_terms(F.col("t"), 3).alias("k"))
    want = [sorted(((x.count(t), t) for t in set(x)), key=lambda c: (-c[0], c[1]))[:3] for x in lists]
    assert [[tuple(c) for c in r.k] for r in found.collect()] == want
    # Neighbours are compared by a pattern, and stop words are no part of the words' pattern.
    assert "sequence(" not in plan_of(found)
    assert "(?!" not in plan_of(spark.createDataFrame([("a",)], "text STRING").select(tokens(F.col("text"), ["the"])))
