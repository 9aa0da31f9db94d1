"""Duplicate suppression on a stream: bounded state that keeps the order of the pages."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pagelake.operators.dedup import scope_keys

MICROS = 1_000_000
# Fixed value: texts are remembered in this many states.
BUCKETS = 1024


def first_sightings(keys: pd.DataFrame, at: np.ndarray, order: pd.Series, ttl: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that open a sighting, and the time of each one's last copy.

    A sighting is a run of copies of a key in which each follows the one before by less than ``ttl``.
    """
    codes = keys.groupby(list(keys.columns), sort=False, dropna=False).ngroup().to_numpy()
    by = np.lexsort((order.to_numpy(), at, codes))
    code, time = codes[by], at[by]
    opens = np.ones(len(by), bool)
    opens[1:] = (code[1:] != code[:-1]) | (time[1:] - time[:-1] >= ttl)
    starts = np.flatnonzero(opens)
    ends = np.append(starts[1:], len(by))
    return by[starts], time[ends - 1]


def settle(
    rows: pd.DataFrame, order: str, known: pa.Table, keys: list[str], ttl: int
) -> tuple[np.ndarray, pa.Table]:
    """Which sightings pass, and the time of each text's last copy, given what was ``known`` before."""
    old = known.num_rows
    both = pd.concat([known.select(keys).to_pandas(), rows[keys]], ignore_index=True)
    codes = both.groupby(keys, sort=False, dropna=False).ngroup().to_numpy()
    # What is known of a text comes before its rows.
    last = known.column("last").to_numpy()
    at = np.concatenate([last, rows["_at"].to_numpy()])
    end = np.concatenate([last, rows["_last"].to_numpy()])
    new = np.arange(len(both)) >= old
    rank = np.concatenate([np.zeros(old, np.int64), np.argsort(np.argsort(rows[order].to_numpy(), kind="stable"))])
    by = np.lexsort((rank, at, new, codes))
    code = codes[by]
    latest = pd.Series(end[by]).groupby(code, sort=False).cummax().to_numpy()
    passed = np.ones(len(by), bool)
    passed[1:] = (code[1:] != code[:-1]) | (at[by][1:] - latest[:-1] >= ttl)
    ends = np.append(code[1:] != code[:-1], True)
    kept = pa.Table.from_pandas(both.iloc[by[ends]], known.select(keys).schema, preserve_index=False)
    mine = by >= old
    return by[mine][passed[mine]] - old, kept.append_column("last", pa.array(latest[ends], pa.int64()))


def packed(known: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, known.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(known)
    return sink.getvalue().to_pybytes()


def drop_seen_within(
    stream: DataFrame, ttl_seconds: int, event_time: str = "timestamp", order: str = "fetch_order",
    scope: str = "site", lateness: str = "0 seconds", buckets: int = BUCKETS,
) -> DataFrame:
    """Let a page pass unless a copy of its text was seen less than ``ttl_seconds`` before it.

    Time is ``event_time``, copies of one time go by ``order``. Every copy renews the memory of its text, passed or not; a text that
    has not come up for ``ttl_seconds`` is forgotten, and its state goes when its bucket next has rows, or has none to remember, after the watermark (the
    greatest time of earlier batches, less ``lateness``, at first 1970) has passed that point. Rows at or behind the watermark are dropped, as
    Spark does; ``event_time`` and ``order`` are not null, rows without a hash are one text.

    Copies are reduced to sightings inside the tasks that read them, so a text that is copied
    without end sends a row per Arrow batch and sighting to the task that owns it. Texts are dealt to ``buckets`` by their
    keys: a call of Python and a state per bucket instead of per text. A batch rewrites the state of the buckets it has rows for
    and holds the rows of one at a time, so many more texts, or much smaller batches, ask for more buckets. Their number belongs to the checkpoint.
    """
    keys, ttl, columns = scope_keys(scope), ttl_seconds * MICROS, stream.columns
    # Whole numbers travel as text: pandas makes floats of them where a row of the same bucket has none.
    whole = [f.name for f in stream.schema if isinstance(f.dataType, T.IntegralType)]
    timed = stream.withWatermark(event_time, lateness).withColumns({
        "_at": F.unix_micros(event_time), "_last": F.unix_micros(event_time), "_order": F.col(order),
        "_bucket": F.pmod(F.xxhash64(*keys), F.lit(buckets)), **{c: F.col(c).cast("string") for c in whole},
    })
    carried = T.StructType([T.StructField(f.name, T.StringType()) if f.name in whole else f for f in stream.schema])
    nothing = to_arrow_schema(T.StructType([*(carried[k] for k in keys), T.StructField("last", T.LongType())])).empty_table()

    def reduce(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            narrow = batch.select([*keys, "_at", "_order"]).to_pandas()
            rows, last = first_sightings(narrow[keys], narrow["_at"].to_numpy(), narrow["_order"], ttl)
            out = batch.take(pa.array(rows))
            yield out.set_column(out.schema.get_field_index("_last"), "_last", pa.array(last, pa.int64()))

    def merge(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        parts = list(frames)
        rows = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
        known = pa.ipc.open_stream(state.get[0]).read_all() if state.exists else nothing
        passed, known = settle(rows, "_order", known, keys, ttl)
        watermark, last = state.getCurrentWatermarkMs(), known.column("last").to_numpy()
        # Later rows lie behind the watermark no more, so a text that it has passed can't hold one back.
        state.update((packed(known.filter(pa.array(last + ttl > watermark * 1000))),))
        # A row may lie behind the watermark by more than ttl: Spark drops only what the batch before knew to be late.
        state.setTimeoutTimestamp(max(-(-(int(last.max()) + ttl) // 1000), watermark + 1))
        yield rows.iloc[passed][columns]

    seen = timed.mapInArrow(reduce, timed.schema).groupBy("_bucket").applyInPandasWithState(
        merge, carried, "packed BINARY", "append", GroupStateTimeout.EventTimeTimeout
    )
    types = {f.name: f.dataType for f in stream.schema}
    return seen.select(*(F.col(c).cast(types[c]).alias(c) if c in whole else F.col(c) for c in columns))
