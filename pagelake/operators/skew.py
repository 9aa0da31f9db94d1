"""Running totals and top-n that hold when one key owns a third of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from pagelake.session import materialize, new_scratch

# Parts a group is cut in before its rows are ranked.
SALTS = 32


def in_ranges(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], path: str, rows: Observation | None = None
) -> DataFrame:
    """``df`` as a table written by ranges of (keys, order), with the number of each row's range in ``_part``.

    The ranges follow a sample of the rows, so they hold alike numbers of them however the order
    values lie and whatever a key's share. The table fixes them: all who read it see the same ranges.
    ``rows`` counts what is written, as ``rows``.
    """
    ranged = df.repartitionByRange(*keys, *order).withColumn("_part", F.spark_partition_id())
    return materialize(ranged if rows is None else ranged.observe(rows, F.count(F.lit(1)).alias("rows")), path)


def range_offsets(ranged: DataFrame, keys: Sequence[str], value: Column, offset: str = "_offset") -> DataFrame:
    """``keys, _part, offset``: the sum of ``value`` over the earlier ranges of a key.

    The window sees one row per key and range.
    """
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy(*keys, "_part").agg(F.sum(value).alias("_sum"))
    return sums.select(*keys, "_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias(offset))


def total_in_range(
    ranged: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, out: str, inclusive: bool = True
) -> DataFrame:
    """Adds the running sum of ``value`` within (keys, _part)."""
    inside = (
        Window.partitionBy(*keys, "_part").orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    )
    return ranged.withColumn(out, F.coalesce(F.sum(value).over(inside), F.lit(0)))


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    out: str,
    inclusive: bool = True,
    scratch: str | None = None,
) -> DataFrame:
    """``sum(value) over (partition by keys order by order)`` without one task per key.

    Totals run inside (keys, range of the order), and the sum of a key's earlier ranges is added. Any order that tells the rows of a
    key apart will do, dense or sparse; rows of equal order share a range. ``df`` is written to the scratch folder once.
    """
    ranged = in_ranges(df, keys, order, scratch or new_scratch(df.sparkSession, "ranges"))
    return (
        total_in_range(ranged, keys, order, value, out, inclusive)
        .join(range_offsets(ranged, keys, value), [*keys, "_part"])
        .withColumn(out, F.col(out) + F.col("_offset"))
        .drop("_part", "_offset")
    )


def top_n_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int,
    spread: Sequence[str],
    slices: int = SALTS,
    rank: str | None = None,
) -> DataFrame:
    """The first ``n`` rows of every group, ranked in two steps.

    A group is cut to ``n`` rows in each of ``slices`` parts before the parts
    meet, so the last window sees at most ``n * slices`` rows of a group.
    """
    part = F.pmod(F.xxhash64(*spread), F.lit(slices))
    first = Window.partitionBy(*keys, "_part").orderBy(*order)
    last = Window.partitionBy(*keys).orderBy(*order)
    out = rank or "_rank"
    cut = (
        df.withColumn("_part", part)
        .withColumn("_rank_in_part", F.row_number().over(first))
        .filter(F.col("_rank_in_part") <= n)
        .drop("_part", "_rank_in_part")
        .withColumn(out, F.row_number().over(last))
        .filter(F.col(out) <= n)
    )
    return cut if rank else cut.drop(out)


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of every group.

    Catalyst plans ``row_number() = 1`` as a group limit ahead of the shuffle
    (WindowGroupLimit): each task sends one row per group, however many copies
    the group has.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")
