import random

import pytest
from pyspark.sql import functions as F

from pagelake.functions.bloom import bits_for, bloom_words, merge_words, might_hold
from pagelake.operators import dedup
from pagelake.operators.skew import first_per_group, in_ranges, running_total, top_n_per_group


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(1)
    # One hash holds a third of the rows.
    return [
        (f"s{min(rnd.randint(0, 5), 2)}", "hot" if rnd.random() < 0.34 else f"h{rnd.randint(0, 60)}", i)
        for i in range(600)
    ]


def frame(spark, rows):
    return spark.createDataFrame(rows, "site STRING, content_hash STRING, fetch_order BIGINT").repartition(7)


def first_of(rows, key):
    out = {}
    for row in sorted(rows, key=lambda r: r[2]):
        out.setdefault(key(row), row)
    return set(out.values())


def test_first_copy_wins(spark, rows):
    df = frame(spark, rows)
    got = {tuple(r) for r in dedup.drop_duplicates(df).collect()}
    assert got == first_of(rows, lambda r: r[:2])
    overall = {tuple(r) for r in dedup.drop_duplicates(df, scope="global").collect()}
    assert overall == first_of(rows, lambda r: r[1])
    with pytest.raises(ValueError):
        dedup.drop_duplicates(df, scope="planet")


def test_idempotent_and_independent_of_partitions(spark, rows):
    df = frame(spark, rows)
    once = dedup.drop_duplicates(df)
    assert once.exceptAll(dedup.drop_duplicates(once)).isEmpty()
    assert once.exceptAll(dedup.drop_duplicates(df.coalesce(1))).isEmpty()


def test_history(spark, rows):
    df = frame(spark, rows)
    history = df.filter("fetch_order < 100")
    got = {tuple(r) for r in dedup.drop_duplicates(df, history=history).collect()}
    seen = {r[:2] for r in rows if r[2] < 100}
    assert got == {r for r in first_of(rows, lambda r: r[:2]) if r[:2] not in seen}


def test_duplicate_groups(spark, rows):
    got = {(r.content_hash, r.copies, r.first_id) for r in dedup.duplicate_groups(frame(spark, rows), "fetch_order").collect()}
    want = set()
    for h in {r[1] for r in rows}:
        ids = [r[2] for r in rows if r[1] == h]
        if len(ids) > 1:
            want.add((h, len(ids), min(ids)))
    assert got == want


def test_history_is_bounded(spark, rows):
    old, new = [r for r in rows if r[2] < 300], [r for r in rows if r[2] >= 300]
    def as_history(part):
        return frame(spark, part).withColumnRenamed("fetch_order", "seen_at")

    got = dedup.update_history(as_history(old), as_history(new), max_hashes=10)
    for site in {r[0] for r in rows}:
        latest = {}
        for _, h, i in sorted(r for r in rows if r[0] == site):
            latest[h] = max(i, latest.get(h, -1))
        want = sorted(latest.items(), key=lambda x: -x[1])[:10]
        assert {(r.content_hash, r.seen_at) for r in got.filter(F.col("site") == site).collect()} == set(want)


def test_group_limit_runs_before_the_shuffle(spark, rows, plan_of):
    plan = plan_of(dedup.drop_duplicates(frame(spark, rows)))
    assert plan.index("Final") < plan.index("Exchange hashpartitioning(site") < plan.index("Partial")


@pytest.mark.parametrize("inclusive", [True, False])
def test_running_total(spark, rows, inclusive):
    df = frame(spark, rows)
    got = running_total(df, ["site"], ["fetch_order"], F.col("fetch_order") % 3, "total", inclusive)
    for site in {r[0] for r in rows}:
        total, want = 0, {}
        for _, _, i in sorted((r for r in rows if r[0] == site), key=lambda r: r[2]):
            want[i] = total + (i % 3 if inclusive else 0)
            total += i % 3
        assert {r.fetch_order: r.total for r in got.filter(F.col("site") == site).collect()} == want


def test_running_total_of_a_hot_site_in_sparse_time(spark, tmp_path):
    # A third of the rows are one site's, at irregular microseconds over years.
    rnd = random.Random(6)
    rows = [("hot" if i % 3 == 0 else f"s{rnd.randint(0, 400)}", rnd.randint(0, 10**14), i % 5) for i in range(20_000)]
    df = spark.createDataFrame(rows, "site STRING, at BIGINT, v INT").withColumn("ts", F.timestamp_micros("at"))
    ranged = in_ranges(df, ["site"], ["ts", "v"], str(tmp_path / "r"))
    sizes = [r["count"] for r in ranged.groupBy("site", "_part").count().collect()]
    assert max(sizes) <= 2 * len(rows) / ranged.select("_part").distinct().count()
    got = {(r.site, r.at, r.v): r.total for r in running_total(df, ["site"], ["ts", "v"], F.col("v"), "total").collect()}
    totals = {}
    for site, at, v in sorted(rows):
        totals[site] = totals.get(site, 0) + v
        assert got[site, at, v] == totals[site]


def test_history_filter_spares_the_join(spark, rows, tmp_path, plan_of):
    df = frame(spark, rows)
    history = df.filter("fetch_order < 100")
    known = dedup.HistoryFilter(spark, str(tmp_path / "bloom"), bits_for(100))
    for run_id, part in (("a", "fetch_order < 50"), ("b", "fetch_order BETWEEN 50 AND 99"), ("a", "fetch_order < 50")):
        known.add(history.filter(part), run_id)
    with_filter = dedup.drop_duplicates(df, history=history, history_filter=known)
    plain = dedup.drop_duplicates(df, history=history)
    assert {tuple(r) for r in with_filter.collect()} == {tuple(r) for r in plain.collect()}
    plan = plan_of(with_filter)
    anti = plan[plan.index("LeftAnti"):]
    assert "Filter" in anti and "getbit" in anti and "CartesianProduct" not in plan
    # Rows that no run has seen pass by the filter alone; few others meet the history.
    new = spark.range(2000).select(F.lit("s9").alias("site"), F.concat(F.lit("n"), "id").alias("content_hash"), F.col("id").alias("fetch_order"))
    hits = new.withColumn("hit", known.might_hold([F.col("site"), F.col("content_hash")])).filter("hit").count()
    assert hits < 100
    seen = history.withColumn("hit", known.might_hold([F.col("site"), F.col("content_hash")]))
    assert seen.filter("NOT hit").isEmpty()


def test_merged_filters_hold_both(spark):
    a, b = (spark.range(k, k + 300).select(F.col("id").cast("string").alias("h")) for k in (0, 1000))
    bits = bits_for(600)
    both = merge_words(bloom_words(a, ["h"], bits), bloom_words(b, ["h"], bits))
    assert a.union(b).withColumn("hit", might_hold(both, [F.col("h")], bits)).filter("NOT hit").isEmpty()
    empty = bloom_words(a.limit(0), ["h"], bits)
    assert a.withColumn("hit", might_hold(empty, [F.col("h")], bits)).filter("hit").isEmpty()


def test_top_n_and_first(spark, rows):
    df = frame(spark, rows)
    got = top_n_per_group(df, ["site"], [F.desc("fetch_order")], 7, ["content_hash"], slices=3, rank="r")
    for site in {r[0] for r in rows}:
        want = sorted((r[2] for r in rows if r[0] == site), reverse=True)[:7]
        mine = got.filter(F.col("site") == site).orderBy("r").collect()
        assert [r.fetch_order for r in mine] == want and [r.r for r in mine] == list(range(1, 8))
    firsts = first_per_group(df, ["site"], ["fetch_order"])
    assert {tuple(r) for r in firsts.collect()} == first_of(rows, lambda r: r[0])


def test_history_filter_query_hashes_each_text_once(spark, tmp_path, plan_of):
    from pagelake.plans.queries import QUERIES

    docs = [(1, "a b", "en", "s", 3), (2, "A  b", "en", "s", 4), (3, "c", "en", "s", 1), (4, "a b", "en", "t", 3)]
    spark.createDataFrame(docs, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(2, 0, 0), (3, 1, 0)], "doc_id BIGINT, quality INT, toxic INT").write.parquet(str(tmp_path / "labels.parquet"))
    df = QUERIES["dedup_history_filter"](spark, str(tmp_path))
    assert sorted(r.doc_id for r in df.collect()) == [3, 4]
    assert "documents.parquet" not in plan_of(df) and "md5" not in plan_of(df)
