import random
from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from pagelake.operators.dedup import drop_duplicates
from pagelake.operators.features import page_features
from pagelake.plans.queries import QUERIES
from pagelake.sinks.zones import write_zone
from pagelake.sources.datasets import read_zone
from pagelake.streaming import pages as stream
from pagelake.streaming.dedup import drop_seen_within

ROW = "site STRING, url STRING, content_hash STRING, ts TIMESTAMP, fetch_order BIGINT"
T0 = datetime(2025, 1, 1)


def source(spark, path):
    rows = [
        (f"s{i % 2}", f"u{i}", "hot" if i % 3 == 0 else f"h{i % 40}", T0 + timedelta(minutes=i), i) for i in range(300)
    ]
    for k in range(3):
        part = spark.createDataFrame(rows[k * 100 : (k + 1) * 100], ROW)
        part.coalesce(1).write.mode("append").parquet(path)
    return spark.createDataFrame(rows, ROW)


def run(df, out):
    query = (
        df.writeStream.format("parquet").option("path", f"{out}/data").option("checkpointLocation", f"{out}/state")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{out}/data")


@pytest.mark.parametrize("options", [{}, {"salts": 0}])
def test_stream_dedup_equals_batch(spark, tmp_path, options):
    batch = source(spark, str(tmp_path / "in"))
    pages = stream.page_stream(spark, str(tmp_path / "in"), ROW, max_files=1)
    got = run(stream.drop_seen(pages, **options), tmp_path).select("site", "content_hash")
    want = drop_duplicates(batch).select("site", "content_hash")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_a_restarted_stream_remembers(spark, tmp_path):
    source(spark, str(tmp_path / "in"))
    pages = stream.page_stream(spark, str(tmp_path / "in"), ROW, max_bytes=10_000)
    first = run(stream.drop_seen(pages), tmp_path).count()
    source(spark, str(tmp_path / "in"))
    assert run(stream.drop_seen(pages), tmp_path).count() == first


def test_text_stream_to_zone_equals_batch(spark, tmp_path):
    html = "<title>T{0}</title><p>words of page {0} at a.b{0}@c.org</p>"
    rows = [("s", f"http://s/{i}", html.format(i % 7), "http://s", i) for i in range(20)] + [("s", "http://s/x", None, "http://s", 99)]
    schema = "site STRING, url STRING, html STRING, base_url STRING, fetch_order BIGINT"
    batch = spark.createDataFrame(rows, schema)
    batch.repartition(3).write.parquet(str(tmp_path / "in"))
    pages = stream.page_stream(spark, str(tmp_path / "in"), schema, max_files=1)
    records = stream.text_stream(pages, run_ts=T0)
    query = stream.stream_to_zone(records, str(tmp_path), "text_processed", str(tmp_path / "state"), source="site")
    query.awaitTermination()
    fields = "content_hash STRING, keywords ARRAY<STRING>, entities MAP<STRING,ARRAY<STRING>>"
    got = read_zone(spark, str(tmp_path), "text_processed", fields, day="2025-01-01")
    want = page_features(batch, T0)
    def plain(df):
        return sorted(str(tuple(r)) for r in df.select("content_hash", "keywords", F.map_entries("entities")).collect())

    assert plain(got) == plain(want) and len(plain(got)) == 7


def remembered(rows, ttl):
    """The rows that pass: no copy of the text came up within ``ttl`` seconds before them."""
    last, out = {}, []
    for row in sorted(rows, key=lambda r: (r[3], r[4])):
        key = row[0], row[2]
        if key not in last or (row[3] - last[key]).total_seconds() >= ttl:
            out.append(row)
        last[key] = row[3]
    return out


@pytest.mark.parametrize("ttl, lateness", [(600, "0 seconds"), (3600, "0 seconds"), (10**9, "1 day")])
def test_bounded_dedup_over_several_files(spark, tmp_path, ttl, lateness):
    rnd = random.Random(ttl)
    rows = [(f"s{rnd.randint(0, 1)}", f"u{i}", "hot" if i % 3 == 0 else f"h{rnd.randint(0, 30)}" if i % 7 else None,
             T0 + timedelta(minutes=i // 2 + (40 if i > 150 else 0)), i) for i in range(300)]
    for k in range(3):
        part = rows[k * 100: (k + 1) * 100]
        rnd.shuffle(part)
        spark.createDataFrame(part, ROW).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    pages = stream.page_stream(spark, str(tmp_path / "in"), ROW, max_files=1)
    passed = drop_seen_within(pages, ttl, "ts", "fetch_order", lateness=lateness)
    query = passed.writeStream.format("memory").queryName(f"bounded{ttl}").option(
        "checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination()
    got = sorted(r.fetch_order for r in spark.table(f"bounded{ttl}").collect())
    # Rows at the watermark are late: the last minute of a file comes again in the next.
    late = {r[4] for k in (1, 2) for r in rows[k * 100: (k + 1) * 100] if lateness == "0 seconds" and r[3] <= max(x[3] for x in rows[: k * 100])}
    assert got == sorted(r[4] for r in remembered([r for r in rows if r[4] not in late], ttl))
    if ttl == 600:
        assert query.lastProgress["stateOperators"][0]["numRowsTotal"] < 40
        assert sum(s["numRowsRemoved"] for p in query.recentProgress for s in p["stateOperators"]) > 0


def test_bounded_dedup_sends_few_rows_of_a_hot_text(spark, tmp_path):
    rows = [("s", f"u{i}", "hot", T0 + timedelta(seconds=i), i) for i in range(20_000)]
    spark.createDataFrame(rows, ROW).coalesce(1).write.parquet(str(tmp_path / "in"))
    passed = drop_seen_within(stream.page_stream(spark, str(tmp_path / "in"), ROW), 60, "ts", "fetch_order")
    query = passed.writeStream.format("memory").queryName("hot").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert [r.url for r in spark.table("hot").collect()] == ["u0"]


def test_runs_and_retries_share_a_zone(spark, tmp_path):
    source(spark, str(tmp_path / "in"))
    pages = stream.page_stream(spark, str(tmp_path / "in"), ROW, max_files=1)
    root = str(tmp_path / "lake")
    for n, run_id in enumerate(["a", "b", "a"]):
        stream.stream_to_zone(pages, root, "raw", str(tmp_path / f"state{n}"), source="site", event_time="ts", run_id=run_id).awaitTermination()
    write_zone(spark.read.schema(ROW).parquet(str(tmp_path / "in")), root, "raw", F.col("site"), F.col("ts"), run_id="c")
    zone = read_zone(spark, root, "raw", ROW)
    assert {r.run_id: (r.n, r.batches) for r in zone.groupBy("run_id").agg(
        F.count("url").alias("n"), F.countDistinct("batch_id").alias("batches")).collect()} == {"a": (300, 3), "b": (300, 3), "c": (300, 1)}
    assert read_zone(spark, root, "raw", ROW, run_id="b").select("url").distinct().count() == 300


def test_a_batch_that_failed_is_written_once(spark, tmp_path, monkeypatch):
    source(spark, str(tmp_path / "in"))
    pages = stream.page_stream(spark, str(tmp_path / "in"), ROW, max_files=1)
    root, state = str(tmp_path / "lake"), str(tmp_path / "state")

    def failing(batch, *args, batch_id, **more):
        write_zone(batch, *args, batch_id=batch_id, **more)
        if batch_id == 1:
            raise RuntimeError("lost after the write, before the commit")

    with monkeypatch.context() as m:
        m.setattr(stream, "write_zone", failing)
        with pytest.raises(StreamingQueryException):
            stream.stream_to_zone(pages, root, "raw", state, source="site", event_time="ts", run_id="r").awaitTermination()
    stream.stream_to_zone(pages, root, "raw", state, source="site", event_time="ts", run_id="r").awaitTermination()
    zone = read_zone(spark, root, "raw", ROW, run_id="r")
    assert zone.count() == 300 and zone.select("url").distinct().count() == 300


def test_reports_of_two_runs_of_a_day(spark, tmp_path):
    rows = [("s", "u1", "<p>x"), ("s", "u2", None), ("s", "u1", "<p>x"), ("s", "u3", "<p> X"), ("t", "v", "")]
    schema = "site STRING, url STRING, html STRING"
    root = str(tmp_path)
    out = {}
    for run_id, part in (("a", rows), ("b", rows[:2])):
        pages = spark.createDataFrame(part, schema).withColumns({
            "base_url": F.lit(""), "fetch_order": F.monotonically_increasing_id(), "fetched_at": F.lit(T0)})
        pages.write.parquet(f"{root}/in-{run_id}")
        pages = stream.page_stream(spark, f"{root}/in-{run_id}", pages.schema)
        stream.stream_to_zone(stream.attempt_stream(pages, T0), root, stream.ATTEMPTS, f"{root}/s-{run_id}", event_time="ts", run_id=run_id).awaitTermination()
        stream.stream_to_zone(stream.text_stream(pages, 60, T0), root, "text_processed", f"{root}/t-{run_id}", source="site", run_id=run_id).awaitTermination()
    for run_id in ("a", "b", "a"):
        out[run_id] = stream.finish_run(spark, root, T0, run_id)
    assert {(r.site, r.total_pages, r.failed_crawls, r.duplicate_pages) for r in out["a"][0].collect()} == {("s", 3, 1, 2), ("t", 0, 1, 0)}
    assert {(r.site, r.total_pages, r.failed_crawls, r.duplicate_pages) for r in out["b"][0].collect()} == {("s", 1, 1, 0)}
    assert sorted((r.site, r.url, r.last_updated) for r in out["a"][1].collect()) == [("s", "u1", T0), ("s", "u3", T0)]
    stored = read_zone(spark, f"{root}/reports", "summary", "site STRING, total_pages BIGINT")
    assert sorted((r.run_id, r.site) for r in stored.collect()) == [("a", "s"), ("a", "t"), ("b", "s")]


def test_metrics_of_a_stream(spark, tmp_path):
    source(spark, str(tmp_path / "in"))
    pages = stream.page_stream(spark, str(tmp_path / "in"), ROW, max_files=1)
    query = stream.stream_to_zone(stream.drop_seen(pages), str(tmp_path), "raw", str(tmp_path / "state"), source="site", event_time="ts", run_id="r")
    query.awaitTermination()
    rows = stream.batch_metrics(query, "r")
    assert sum(value for _, _, name, value in rows if name == "input_rows") == 300
    assert {r[1] for r in rows} >= {0, 1, 2} and any(name == "state_rows" and value > 0 for _, _, name, value in rows)


def test_bounded_dedup_outlives_files_out_of_order(spark, tmp_path):
    """The second file lies behind the first by more than the memory, with a text of its own."""
    for minutes in (500, 0, 505):
        spark.createDataFrame([("s", f"u{minutes}", f"h{minutes}", T0 + timedelta(minutes=minutes), minutes)], ROW).coalesce(1).write.mode(
            "append").parquet(str(tmp_path / "in"))
    pages = stream.page_stream(spark, str(tmp_path / "in"), ROW, max_files=1)
    got = run(drop_seen_within(pages, 60, "ts", "fetch_order"), tmp_path)
    assert {r.url for r in got.collect()} >= {"u500", "u505"}


def test_document_parts_of_several_files_stay_in_order(spark, tmp_path):
    """Four parts of several files each: the later ids of a part come first."""
    rows = [(i, f"t{i % 40}", "en", f"s{i % 2}", 1) for i in reversed(range(2000))]
    spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT").repartitionByRange(
        8, F.desc("doc_id")).write.parquet(str(tmp_path / "documents.parquet"))
    with_conf = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")
    try:
        got = QUERIES["stream_dedup_bounded"](spark, str(tmp_path))
        runs = QUERIES["stream_runs"](spark, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", with_conf)
    # Every text comes up again after 40 minutes, within the memory of 100.
    assert sorted(r.doc_id for r in got.collect()) == list(range(40))
    assert sorted((r.run_id, r.doc_id) for r in runs.collect()) == sorted(("run-1", i) for i in range(2000))
    batches = {p.name for p in tmp_path.rglob("batch_id=*")} | {f.rsplit("batch_id=", 1)[1].split("/")[0] for f in runs.inputFiles()}
    assert len(batches) <= 4


@pytest.mark.parametrize("buckets", [1, 7])
def test_bounded_dedup_of_many_texts_in_a_bucket(spark, tmp_path, buckets):
    """Texts that share a state keep to their own times; whole numbers beyond 2**53 stay, beside rows without any."""
    rnd, big = random.Random(buckets), 2**53 + 1
    rows = [(rnd.choice(["s0", "s1", None]), f"u{i}", f"h{rnd.randint(0, 40)}" if i % 9 else None,
             T0 + timedelta(minutes=2 * i // 3), i, big + i if i % 2 else None) for i in range(600)]
    schema = f"{ROW}, n BIGINT"
    for k in range(4):
        part = rows[k * 150: (k + 1) * 150]
        rnd.shuffle(part)
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    pages = stream.page_stream(spark, str(tmp_path / "in"), schema, max_files=1)
    passed = drop_seen_within(pages, 1800, "ts", "fetch_order", lateness="1 day", buckets=buckets)
    assert passed.schema == pages.schema
    got = run(passed, tmp_path).collect()
    assert sorted((r.fetch_order, r.n, r.content_hash, r.ts) for r in got) == sorted(
        (r[4], r[5], r[2], r[3]) for r in remembered(rows, 1800))


def test_bounded_dedup_calls_python_by_bucket(spark, tmp_path):
    """As many states as buckets, however many texts; all go when nothing came up for the time."""
    for k, minutes in enumerate((0, 100)):
        spark.range(k * 4000, (k + 1) * 4000).select(
            F.lit("s").alias("site"), F.md5(F.col("id").cast("string")).alias("content_hash"),
            (F.lit(T0) + F.make_dt_interval(mins=F.lit(minutes))).alias("ts"), F.col("id").alias("fetch_order"),
        ).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    pages = stream.page_stream(spark, str(tmp_path / "in"), "site STRING, content_hash STRING, ts TIMESTAMP, fetch_order BIGINT", max_files=1)
    query = drop_seen_within(pages, 60, "ts", "fetch_order", buckets=64).writeStream.format("memory").queryName("buckets").option(
        "checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("buckets").count() == 8000
    assert max(s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]) == 64


def test_a_stream_with_state_leaves_a_file_per_partition(spark, tmp_path):
    """Spark runs such streams without AQE; tasks must not each leave a file in each partition."""
    rows = [(f"s{i % 3}", f"u{i}", f"h{i}", T0 + timedelta(hours=i % 48), i) for i in range(600)]
    spark.createDataFrame(rows, ROW).write.parquet(str(tmp_path / "in"))
    pages = stream.page_stream(spark, str(tmp_path / "in"), ROW)
    passed = drop_seen_within(pages, 60, "ts", "fetch_order")
    stream.stream_to_zone(passed, str(tmp_path), "raw", str(tmp_path / "state"), source="site", event_time="ts", run_id="r").awaitTermination()
    zone = read_zone(spark, str(tmp_path), "raw", ROW)
    assert zone.count() == 600 and len(zone.inputFiles()) == 3 * 2
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        write_zone(spark.read.schema(ROW).parquet(str(tmp_path / "in")).repartition(5), str(tmp_path), "batch", F.col("site"), F.col("ts"))
        assert len(read_zone(spark, str(tmp_path), "batch", ROW).inputFiles()) == 3 * 2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
