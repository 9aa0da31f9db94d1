"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings that results rely on; all may be set on a live session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # Duplicate state of a stream lives on disk, not on the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Rows here are costly, and a small shuffle may leave many files, so it still uses every core (default 1 MB).
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
}


def build_session(app_name: str = "pagelake", cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benches; on a cluster use the one you are given."""
    n = os.cpu_count() if cores == "*" else int(cores)
    builder = (
        SparkSession.builder.appName(app_name)
        .master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def adaptive(spark: SparkSession) -> Iterator[None]:
    """Plans made inside are adaptive; the session's own setting is put back."""
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the cluster (``spark.checkpoint.dir``).

    Only a local master may fall back to a folder of this machine.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root and context.master.startswith("local["):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="pagelake-"))
        root = context.getCheckpointDir()
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return root.rstrip("/")


def new_scratch(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{scratch_root(spark)}/pagelake/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as a Parquet table and read it back.

    Cuts the lineage as ``checkpoint()`` does, survives lost executors, and
    later readers still prune columns.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class BucketedTable:
    """A Parquet table bucketed by ``keys`` that grows by ``append``, for joins that repeat.

    Each later join on ``keys`` shuffles the other side only, however often the table was appended to. There are as many
    buckets as shuffle partitions, and rows are placed by bucket before a write, so
    that it leaves one file per bucket whatever the input's layout. The catalog entry goes
    at the end of the ``with`` block; the files stay in the scratch folder.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], partition_by: Sequence[str] = ()):
        self.spark, self.path, self.keys, self.partition_by = spark, path, list(keys), list(partition_by)
        self.name = f"pagelake_{uuid.uuid4().hex}"
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.written = False

    def append(self, df: DataFrame, placed: bool = False) -> None:
        """Adds the rows of ``df``; ``placed`` says that its last exchange was by the keys already, as after a window over them."""
        rows = df if placed else df.repartition(self.buckets, *self.keys)
        writer = rows.write.format("parquet").mode("append").bucketBy(self.buckets, *self.keys)
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.option("path", self.path).saveAsTable(self.name)
        self.written = True

    def read(self) -> DataFrame | None:
        """The rows so far; None before the first append."""
        return self.spark.table(self.name) if self.written else None

    def __enter__(self) -> BucketedTable:
        return self

    def __exit__(self, *_: object) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


@contextmanager
def bucketed_table(df: DataFrame, path: str, keys: Sequence[str]) -> Iterator[DataFrame]:
    """``df`` as a ``BucketedTable`` that is written once."""
    with BucketedTable(df.sparkSession, path, keys) as table:
        table.append(df)
        yield table.read()
