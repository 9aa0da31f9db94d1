import gzip
import json
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pagelake import schemas
from pagelake.operators import oplog
from pagelake.session import materialize, new_scratch, scratch_root
from pagelake.sinks import zones
from pagelake.sources import datasets, inventory, logs

PAYLOAD = "title STRING, place STRUCT<city: STRING>, stops ARRAY<INT>, m MAP<STRING,STRING>"
ROWS = [
    ("ferry", ("Turku",), [7, 40, 2], {"a": None, "b": "x"}),
    ('quote " and\nline, comma', (None,), [], {}),
    ("", None, None, None),
    (None, ("é",), [None], {"k": ""}),
]


def payload(spark):
    return spark.createDataFrame(ROWS, PAYLOAD)


@pytest.mark.parametrize("fmt", zones.FORMATS)
def test_round_trip(spark, tmp_path, fmt):
    path = zones.write_dataset(payload(spark), str(tmp_path / "out"), fmt)
    back = datasets.read_dataset(spark, path, fmt, PAYLOAD)
    assert sorted(map(str, back.collect())) == sorted(map(str, payload(spark).collect()))
    if fmt != "parquet":
        assert list(Path(path).glob(f"*.{fmt}.gz"))


def test_unknown_format(spark, tmp_path):
    with pytest.raises(ValueError, match="Unsupported format: xls"):
        zones.write_dataset(payload(spark), str(tmp_path), "xls")
    with pytest.raises(ValueError, match="Unsupported format: xls"):
        datasets.read_dataset(spark, str(tmp_path), "xls")
    with pytest.raises(ValueError, match="Unsupported format: xls"):
        zones.write_processed(payload(spark), str(tmp_path), "s", date(2023, 1, 5), "xls")
    assert not list(tmp_path.iterdir())


def test_format_by_suffix():
    assert [datasets.format_of(p) for p in ("a/x.json.gz", "x.JSON", "x.parquet", "x.csv.gz", "x.html", "noext", "x.gz")] == [
        "json", "json", "parquet", "csv", "text", "text", "text"
    ]


def test_json_array_file_and_raw_text(spark, tmp_path):
    with gzip.open(tmp_path / "a.json.gz", "wt") as f:
        json.dump([{"title": "tram", "place": {"city": "Oslo"}, "stops": [9]}] * 2, f, indent=1)
    back = datasets.read_dataset(spark, str(tmp_path / "a.json.gz"), schema=PAYLOAD, array_files=True)
    assert back.count() == 2 and back.first().place.city == "Oslo"
    (tmp_path / "b.txt").write_text("one\ntwo")
    assert [tuple(r) for r in datasets.read_dataset(spark, str(tmp_path / "b.txt")).collect()] == [("one\ntwo",)]


def test_partition_layout(spark, tmp_path):
    zones.write_raw(payload(spark), str(tmp_path), "harbour", date(2023, 1, 5))
    folder = tmp_path / "raw/source=harbour/year=2023/month=01/day=05"
    assert folder.is_dir() and list(folder.glob("run_id=*/batch_id=0/*.json.gz"))
    zone = datasets.read_zone(spark, str(tmp_path), "raw", PAYLOAD, day="2023-01-05")
    assert zone.select("source", "year", "month", "day").distinct().collect() == [("harbour", "2023", "01", "05")]
    assert zone.count() == 4
    assert datasets.read_zone(spark, str(tmp_path), "raw", PAYLOAD, day="2023-01-06").isEmpty()


def test_partition_filters_prune_directories(spark, tmp_path, plan_of):
    zones.write_processed(payload(spark), str(tmp_path), F.col("title"), datetime(2023, 1, 5), "parquet")
    zone = datasets.read_zone(spark, str(tmp_path), "processed", payload(spark).schema, "parquet", day="2023-01-05")
    assert "PartitionFilters: [isnotnull(year" in plan_of(zone)
    assert zone.count() == 4


def test_append_and_file_size(spark, tmp_path):
    for _ in range(2):
        zones.write_text(payload(spark), str(tmp_path), "s", date(2023, 1, 5), rows_per_file=1)
    assert datasets.read_zone(spark, str(tmp_path), "text_processed", PAYLOAD).count() == 8
    assert len(list((tmp_path / "text_processed").rglob("*.json.gz"))) == 8


def test_empty_write_leaves_no_partition(spark, tmp_path):
    zones.write_raw(payload(spark).filter("false"), str(tmp_path), "s", date(2023, 1, 5))
    assert not list((tmp_path / "raw").glob("source=*"))


def test_inventory(spark, tmp_path):
    for name in ("raw/a/1.json", "raw/a/2.json", "raw/b/3.json"):
        file = tmp_path / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text("{}")
    files = inventory.inventory(spark, str(tmp_path), "raw/a/")
    assert files.columns == ["path", "length", "modificationTime"] and files.count() == 2
    assert inventory.inventory(spark, str(tmp_path), "nothing").count() == 0
    assert inventory.inventory(spark, str(tmp_path / "missing")).count() == 0
    assert inventory.exists(spark, str(tmp_path), "raw/b/3.json")
    assert not inventory.exists(spark, str(tmp_path), "raw/b/4.json")


def test_log_lines(spark, tmp_path):
    (tmp_path / "x.log").write_text(
        "2025-04-28 19:53:03,230 - main - DEBUG - Memory usage: {'rss': 195.7}\n"
        "2025-04-28 19:53:07,940 - main_crawler - ERROR - Error crawling site: a - b\n"
        "Traceback (most recent call last):\n"
        "2025-04-28 19:53:59,102 - main - INFO - Starting news API fetching\n"
    )
    rows = logs.parse_log(logs.read_log_lines(spark, str(tmp_path))).collect()
    assert [r.level for r in rows] == ["DEBUG", "ERROR", None, "INFO"]
    assert rows[1].message == "Error crawling site: a - b" and rows[1].logger == "main_crawler"
    assert rows[0].ts == datetime(2025, 4, 28, 19, 53, 3, 230000)
    parsed = logs.parse_log(logs.read_log_lines(spark, str(tmp_path)))
    assert oplog.at_least(parsed, "INFO").count() == 2 and oplog.at_least(parsed, "DEBUG").count() == 3


def test_scratch(spark):
    root = scratch_root(spark)
    path = new_scratch(spark, "t")
    assert path.startswith(root) and path != new_scratch(spark, "t")
    assert materialize(spark.range(3), path).count() == 3



def test_schemas_are_ddl(spark):
    for name in [n for n in dir(schemas) if n.isupper()]:
        assert spark.createDataFrame([], getattr(schemas, name)).count() == 0


def zone_rows(spark, root):
    zone = datasets.read_zone(spark, root, "zone", f"{PAYLOAD}, at TIMESTAMP, n BIGINT, price DECIMAL(20,4)", fmt=Path(root).name)
    return sorted(map(str, zone.collect()))


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_folders_written_by_tasks_equal_those_of_sparks_writer(spark, tmp_path, monkeypatch, fmt):
    """Odd names, none and empty ones; two writes of a batch, the second with fewer sources; a batch beside them."""
    names = F.array(*map(F.lit, ("a/b", "c=d%", "é ü", "", None, "tab\there", "x:y#'*?[]{}^\\\"")))
    rows = payload(spark).withColumn("source", F.explode(names)).withColumns({
        "at": F.lit(datetime(2023, 1, 5, 23, 59, 59, 123456)), "n": F.when(F.col("title") == "", 2**53 + 1), "price": F.lit("1.2500").cast("decimal(20,4)")})
    day = datetime(2023, 1, 5)
    seen = {}
    for way in ("tasks", "spark"):
        root = str(tmp_path / way / fmt)
        if way == "spark":
            monkeypatch.setattr(zones, "can_hold", lambda *_: False)
        zones.write_zone(rows.withColumn("title", F.lit("old")), root, "zone", F.col("source"), day, fmt, "r", 1)
        zones.write_zone(rows.filter("source <> 'a/b'"), root, "zone", F.col("source"), day, fmt, "r", 1)
        zones.write_zone(rows, root, "zone", F.col("source"), day, fmt, "r", 2, rows_per_file=1)
        seen[way] = zone_rows(spark, root)
        folder = Path(root, "zone")
        files = sorted(str(p.relative_to(folder).parent) for p in folder.rglob("part-*") if p.is_file())
        seen[way, "folders"], seen[way, "endings"] = files, {p.name.split(".", 2)[2] for p in folder.rglob("part-*")}
        if way == "tasks":
            # Every file that Hadoop's local client makes costs it a process, checksum files as well.
            assert not list(folder.rglob(".*"))
    assert seen["tasks"] == seen["spark"] and len(seen["tasks"]) == 4 * 7 + 4 * 6
    assert seen["tasks", "folders"] == seen["spark", "folders"]
    assert seen["tasks", "endings"] == seen["spark", "endings"]


def test_a_write_that_fails_leaves_the_zone_as_it_was(spark, tmp_path):
    rows, root = payload(spark), str(tmp_path / "json")
    zones.write_zone(rows, root, "zone", "s", date(2023, 1, 5), run_id="r")
    before = zone_rows(spark, root)
    with pytest.raises(Exception, match="lost"):
        zones.write_zone(
            rows.withColumn("title", F.when(F.col("title") == "ferry", F.raise_error(F.lit("lost"))).otherwise("new")),
            root, "zone", "s", date(2023, 1, 5), run_id="r")
    assert zone_rows(spark, root) == before and len(before) == 4
    assert not list(Path(root).rglob(".staging*"))


def test_types_of_spark_alone_go_through_its_writer(spark, tmp_path):
    rows = payload(spark).withColumn("span", F.expr("interval '3' day"))
    zones.write_zone(rows, str(tmp_path), "zone", "s", date(2023, 1, 5), "parquet", run_id="r")
    back = spark.read.parquet(str(tmp_path / "zone"))
    assert back.count() == 4 and dict(back.dtypes)["span"] == dict(rows.dtypes)["span"]
