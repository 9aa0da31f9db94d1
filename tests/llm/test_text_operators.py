"""The text operators against plain restatements, over rows that try to trip them."""

import random

import brute_path  # noqa: F401
import brute
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pagelake.llm import bpe_codec, line_dedup, quality_rules, simhash_dedup, substring_dedup, token_counts

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, llm_k1 STRING, llm_spans INT"
PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def hard_texts():
    rnd = random.Random(3)
    vocabulary = ["".join(rnd.choice("abcdeéñß") for _ in range(rnd.randint(1, 9))) for _ in range(400)]
    prose = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    passage, line = prose(60), "A Line that many documents Repeat, long enough to count"
    base = prose(300)
    near = base.split()
    near[150] = "changed"
    texts = [None, "", " \t\n ", "one", "two words", base, base, " ".join(near), prose(34), prose(35), prose(36)]
    texts += [f"{prose(20)}\n{line if i % 2 else '  ' + line.upper() + ' '}\n{passage} {prose(40)}\n{line}" for i in range(12)]
    texts += ["x " * 400, "\n".join([line] * 30), "### $$$ ***\n" * 40, "a  b \n c　d\x1fe <|endoftext|> f😀 汉字", " ".join([passage] * 3)]
    texts += [" ".join(prose(5000) for _ in range(3)), "z" * 50_000, "word" + " " * 3000 + "word"]
    return texts


@pytest.fixture(scope="module")
def rows():
    return [(i, t) for i, t in enumerate(hard_texts())]


@pytest.fixture(scope="module")
def docs(spark, rows):
    data = [(d, t, "en" if d % 3 else None, f"s{d % 2}", 0, "clash", d) for d, t in rows]
    return spark.createDataFrame(data, SCHEMA).repartition(5).cache()


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_substrings(docs, rows):
    assert got(substring_dedup.digests(docs)) == sorted(brute.substring(rows), key=repr)
    assert got(substring_dedup.digests(docs, buckets=1)) == sorted(brute.substring(rows), key=repr)
    kept = substring_dedup.substring_dedup(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows)


def test_substrings_fold_a_growing_bucket(docs, rows, monkeypatch):
    bucket = substring_dedup._Bucket(35)
    rnd = random.Random(1)
    passage = " ".join(str(rnd.random()) for _ in range(50)).encode()
    import numpy as np

    found = set()
    for i in range(20):
        bucket.add(np.array([5], "<u8").tobytes(), np.array([[i, 0]], "<i8").tobytes(), np.array([7], "<i8").tobytes(), passage)
        out = bucket.count(True)
        if out is not None:
            found |= {(int(k[0]), *map(int, s)) for k, s in zip(*out)}
    assert found == {(i, 7, 57) for i in range(20)}
    assert len(bucket.rows[0][3]) == 1


def test_lines(docs, rows):
    kept = line_dedup.line_dedup(docs)
    assert [c for c in kept.columns if c not in docs.columns] == ["n_lines", "n_dropped"]
    assert got(kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256))) == sorted(brute.lines(rows), key=repr)


def test_lines_across_many_partitions(spark):
    line = "the same line of more than forty code points, everywhere"
    rows = [(i, f"{line}\nown {i}\n{line}") for i in range(300)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        kept = line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"))
        assert got(kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256))) == sorted(brute.lines(rows), key=repr)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_simhash(docs, rows):
    found = simhash_dedup.clusters(docs).select("doc", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component")
    assert got(found) == sorted(brute.simhash_groups(rows), key=repr)
    kept = simhash_dedup.simhash_filter(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {c for _, _, c in brute.simhash_groups(rows)}


@pytest.mark.parametrize("spread", [3, 8])
def test_gray_index_finds_all_links(spark, spread):
    import numpy as np

    rnd = np.random.default_rng(spread)
    codes = set()
    for _ in range(12):  # dense groups around centres
        centre = int(rnd.integers(1 << 63))
        for _ in range(60):
            code = centre
            for b in rnd.integers(0, 64, rnd.integers(0, spread)):
                code ^= 1 << int(b)
            codes.add(code)
    codes = sorted(codes)
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    from pagelake.llm.components import connected_components

    found = {r.node: r.component for r in connected_components(simhash_dedup.links(spark.createDataFrame([(c,) for c in signed], "fp BIGINT"))).collect()}
    want = brute.components(signed, [(signed[i], signed[j]) for i in range(len(codes)) for j in range(i) if (codes[i] ^ codes[j]).bit_count() <= 2])
    assert {c: found.get(c, c) for c in signed} == want


def test_quality(docs, rows):
    found = quality_rules.quality_rules(docs)
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert got(found.select("doc_id", *columns)) == sorted(((d, *brute.quality(t)) for d, t in rows), key=repr)
    assert found.filter("kept AND base_failed").isEmpty()
    kept = quality_rules.quality_filter(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in found.filter("kept").collect()}


def test_thresholds_adapt_to_the_cell(spark):
    table = " | ".join(f"cell{i}" for i in range(60))
    prose = " ".join(f"word{i}" for i in range(60))
    rows = [(i, table if i % 10 < (9 if i < 100 else 1) else prose, "en", "tables" if i < 100 else "prose") for i in range(200)]
    found = quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING"))
    kept = {r.doc_id for r in found.filter("kept").collect()}
    assert kept == {i for i in range(200) if i < 100 or i % 10 >= 1}


def test_token_counts(docs, rows):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    n = {d: len(tok.encode(t or "", add_special_tokens=False).ids) for d, t in rows}
    assert got(token_counts.token_counts(docs, path)) == sorted(((d, len((t or "").encode()), n[d], n[d] > 1024) for d, t in rows), key=repr)


@pytest.mark.parametrize("chunk, overlap", [(200, 8), (333, 64), (2000, 100)])
def test_spliced_chunks(rows, chunk, overlap):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for _, t in rows:
        t = (t or "")[:9000]
        assert token_counts.count_tokens(tok, t, chunk, overlap) == len(tok.encode(t, add_special_tokens=False).ids)
    special = "some words <|endoftext|>" * 300
    assert token_counts.count_tokens(tok, special, chunk, overlap) == len(tok.encode(special, add_special_tokens=False).ids)


def test_codec(docs, rows):
    import numpy as np
    import tiktoken

    ranks = bpe_codec.read_ranks(PATH)
    model = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for d, t in rows:
        ids = model.encode_ordinary(t or "")
        want.append((d, len(ids), brute.sha(np.array(ids, "<u4").tobytes()), brute.sha((t or "").encode())))
    assert got(bpe_codec.digests(docs, PATH, PATTERN)) == sorted(want, key=repr)
    table = bpe_codec.decode_table(ranks)
    ids = model.encode_ordinary("😀 é汉")
    assert "".join(bpe_codec.decode_stream(ids, table)) == "😀 é汉"
    spans = bpe_codec.encode(docs.filter("doc_id < 8"), PATH, PATTERN, offsets_col="spans").select("text", "ids", "spans").collect()
    assert all(len(r.spans) * 4 == len(r.ids) for r in spans)


def test_repeated_rows_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(80))
    rows = [(1, text), (1, text), (None, text), (None, None), (2, "short")]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    assert got(substring_dedup.digests(df)) == sorted(brute.substring(rows), key=repr)
    assert got(line_dedup.line_dedup(df).select("doc_id", "n_lines")) == sorted([(d, 1) for d, _ in rows], key=repr)
    assert simhash_dedup.clusters(df).count() == 5
    assert quality_rules.quality_rules(df.withColumns({"lang": F.lit("en"), "source": F.lit(None).cast("string")})).count() == 5


def test_empty_tables(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert substring_dedup.digests(df).count() == 0
    assert line_dedup.line_dedup(df).count() == 0
    assert simhash_dedup.clusters(df).count() == 0
    assert quality_rules.quality_rules(df).count() == 0
    assert token_counts.token_counts(df, public_tokenizers.path("byte_bpe_50k.json")).count() == 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, df, "").count() == 0


def test_pipeline_stages(spark, docs, rows):
    texts = dict(rows)
    kept = corpus_pipeline.quality(spark, docs, "").cache()
    left = [(r.doc_id, r.text) for r in kept.collect()]
    assert all(texts[d] == t for d, t in left) and not any(brute.quality(t)[-1] for _, t in left)
    lined = corpus_pipeline.lines(spark, kept, "").cache()
    assert lined.columns == docs.columns
    after = [(r.doc_id, r.text) for r in lined.collect()]
    assert sorted((d, brute.sha(t.encode())) for d, t in after) == sorted((d, s) for d, _, _, s in brute.lines(left))
    single = corpus_pipeline.near_duplicates(spark, lined, "").cache()
    assert {r.doc_id for r in single.collect()} == {c for _, _, c in brute.simhash_groups(after)}
    mixed = corpus_pipeline.mix(spark, single, "")
    assert mixed.columns == docs.columns and {r.doc_id for r in mixed.collect()} == {r.doc_id for r in single.collect()}
    assert corpus_pipeline.tokens(spark, mixed, "").columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_the_mix_reaches_the_tokens(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    result = corpus_pipeline.run(spark, str(tmp_path))
    assert result.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "mix_order"]
    got = sorted((r.mix_order, r.doc_id) for r in result.collect())
    stage_of = dict(corpus_pipeline.STAGES)
    kept = docs
    for name in ("quality", "lines", "near_duplicates"):
        kept = stage_of[name](spark, kept, "").cache()
    want = sorted((r.mix_order, r.doc_id) for r in corpus_pipeline.mixing.mix_positions(kept).collect())
    assert got == want and len({o for o, _ in got}) == len(got) > 2


def test_codec_takes_one_worker_a_task(docs, plan_of, monkeypatch):
    assert plan_of(bpe_codec.digests(docs, PATH, PATTERN)).count("MapInArrow") == 1
    apart = bpe_codec.decode(bpe_codec.encode(docs, PATH, PATTERN), PATH, PATTERN)
    monkeypatch.setattr(bpe_codec, "BATCH_BYTES", 3)
    together = bpe_codec.encode(docs, PATH, PATTERN, bytes_col="decoded")
    assert together.columns == apart.columns and got(together) == got(apart)


def test_parts_of_a_batch(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(bpe_codec, "BATCH_BYTES", 4)
    column = pa.array(["x", "abcdefgh", None, "ab", "", "cd", "é", "z"]).slice(1)
    parts = list(bpe_codec.texts_of(column))
    assert [t for _, part in parts for t in part] == ["abcdefgh", "", "ab", "", "cd", "é", "z"]
    assert [i for r, _ in parts for i in r] == list(range(7)) and [len(r) for r, _ in parts] == [1, 4, 2]
