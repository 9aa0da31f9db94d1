"""Compare every query with its SQL: ``python tests/oracle_check.py SF_DIR [name ...]``."""

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

import __spark_entry__ as E  # noqa: E402


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def plain(value):
    if isinstance(value, float) and math.isfinite(value):
        return round(value, 6)
    if hasattr(value, "tzinfo") and value.tzinfo is not None:
        return value.replace(tzinfo=None)
    return value


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return [columns[i] for i in order], sorted(
        (tuple(plain(row[i]) for i in order) for row in rows), key=repr
    )


KINDS = {"VARCHAR": "string", "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double",
         "BOOLEAN": "boolean", "TIMESTAMP": "timestamp"}


def compare(spark, con, sf_dir, name):
    """None when equal, else what differs."""
    df = E.queries()[name](spark, sf_dir)
    got = table_of(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(E.oracle_sql()[name])
    want = table_of(rel.columns, rel.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    types = dict(df.dtypes)
    for column, kind in zip(rel.columns, rel.types):
        if KINDS.get(str(kind), str(kind)) != types[column]:
            return f"type of {column}: {types[column]} != {kind}"
    if got[1] != want[1]:
        extra = sorted(set(got[1]) - set(want[1]), key=repr)[:2]
        missing = sorted(set(want[1]) - set(got[1]), key=repr)[:2]
        return f"{len(got[1])} rows against {len(want[1])}; only Spark {extra}; only SQL {missing}"
    return None


if __name__ == "__main__":
    from pagelake.session import build_session

    spark = build_session(cores=8)
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(E.queries())
    con = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            if name in E.oracle_sql():
                problem = compare(spark, con, sf_dir, name)
            else:
                problem = None if E.queries()[name](spark, sf_dir).count() >= 0 else "?"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.1f}s {problem or ''}"[:1500], flush=True)
    print(f"{len(names) - bad} of {len(names)} equal")
