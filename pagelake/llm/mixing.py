"""Mixing sources to target weights by Pfair scheduling, DataFrame functions only.

Every source's rows are cut into blocks. With weight w, block k (from 1) of a source is released
at slot floor((k-1)/w) and due by slot ceil(k/w); each slot takes the released block with the
earliest deadline. The weights are fractions of a whole period, so the schedule repeats: one
period is computed, and block k has the slot of its place in the period, plus a
whole number of periods.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagelake.llm.common import fresh, row_key, written

BLOCK_ROWS = 64
PERIOD = 1000
BUCKETS = 4096

# Over the row (shares: array<struct<source, share>>, period): the source's index for each slot.
EDF = """
aggregate(
  sequence(0, period - 1),
  struct(transform(shares, s -> 0) AS done, cast(array() AS array<int>) AS slots),
  (acc, t) -> transform(array(array_min(transform(shares, (s, i) ->
      if(cast(floor(cast(acc.done[i] AS bigint) * period div s.share) AS bigint) <= t AND acc.done[i] < s.share,
         struct(cast((cast(acc.done[i] + 1 AS bigint) * period + s.share - 1) div s.share AS bigint) AS due, i AS i), NULL)
    )).i), pick -> struct(transform(acc.done, (d, i) -> if(i = pick, d + 1, d)) AS done, concat(acc.slots, array(pick)) AS slots))[0],
  acc -> acc.slots)
"""


def shares(counts: DataFrame, period: int = PERIOD, weights: Mapping[str, float] | None = None) -> DataFrame:
    """(source, share): slots of each source per period, one at least.

    Without ``weights`` a source weighs the square root of its rows; sources that
    ``weights`` does not name weigh what the least named one does. Null is a source of its own.
    """
    if weights is None:
        w = F.sqrt("n")
    else:
        named = F.create_map(*[x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))])
        w = F.coalesce(F.element_at(named, F.coalesce("source", F.lit(""))), F.lit(float(min(weights.values()))))
    weighed = counts.withColumn("w", w)
    total = weighed.agg(F.sum("w")).first()[0] or 1.0
    return weighed.select("source", F.greatest(F.lit(1), F.round(F.col("w") * period / F.lit(total))).cast("int").alias("share"))


def schedule(parts: DataFrame) -> DataFrame:
    """(source, share, period, nth, slot): one period; ``nth`` counts a source's blocks in it from 0.

    The number of sources is bounded by the period; the row that holds their shares is of that size.
    """
    row = parts.agg(F.sort_array(F.collect_list(F.struct(F.col("source").isNull().alias("z"), "source", "share"))).alias("shares"),
                    F.sum("share").cast("int").alias("period"))
    slots = row.filter("period > 0").select("shares", "period", F.expr(EDF).alias("slots"))
    picked = slots.select("shares", "period", F.posexplode("slots").alias("slot", "i")).select(
        F.expr("shares[i].source").alias("source"), F.expr("shares[i].share").alias("share"), "period", "slot")
    nth = Window.partitionBy("source").orderBy("slot")
    return picked.withColumn("nth", F.row_number().over(nth) - 1)


def placed(rows: DataFrame, keys: list[str], block_rows: int = BLOCK_ROWS, period: int = PERIOD,
           weights: Mapping[str, float] | None = None) -> DataFrame:
    """(source, block, mix_slot, mix_order, *keys) for ``rows`` of (source, id, *keys).

    Rows of a source are shuffled by the MD5 of their id. A row's number within its source is its number in one
    of 4096 hash buckets plus the rows of the buckets before, so a source that holds
    a third of all rows is spread over as many tasks.
    """
    rows = rows.withColumn("md", F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")))).withColumn("bucket", F.substring("md", 1, 3))
    counts = written(rows.groupBy("source", "bucket").agg(F.count("*").alias("n")), "mix-counts")
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("source", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    plan = written(schedule(shares(counts.groupBy("source").agg(F.sum("n").alias("n")), period, weights)), "mix-schedule")
    within = Window.partitionBy("source", "bucket").orderBy("md", "id", *keys)
    o = offsets.select(F.col("source").alias("o_source"), F.col("bucket").alias("o_bucket"), "offset")
    numbered = (
        rows.withColumn("rn", F.row_number().over(within))
        .join(o, F.col("source").eqNullSafe(F.col("o_source")) & (F.col("bucket") == F.col("o_bucket")))
        .withColumn("rank", F.col("rn") + F.col("offset") - 1)
        .withColumn("block", F.expr(f"rank div {block_rows}"))
    )
    share = plan.filter("nth = 0").select(F.col("source").alias("s_source"), "share", "period")
    slot = plan.select(F.col("source").alias("p_source"), "nth", "slot")
    return (
        numbered.join(share, F.col("source").eqNullSafe(F.col("s_source")))
        .withColumn("place", F.expr("block % share").cast("int"))
        .join(slot, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("place") == F.col("nth")))
        .withColumn("mix_slot", F.expr("(block div share) * period + slot"))
        .select("source", "id", "block", "mix_slot", F.expr(f"mix_slot * {block_rows} + rank % {block_rows}").alias("mix_order"), *keys)
    )


def mix_positions(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", **how) -> DataFrame:
    """doc_id, source, block, mix_slot, mix_order of every row; no row is dropped or repeated.

    While all sources last, each has had its weight times the slots passed, give or take less than one
    block. When a source ends its slots stay empty. Repeated rows have places of their own; equal
    ids are ordered arbitrarily among themselves.
    """
    rows = docs.select(F.col(source_col).alias("source"), F.col(id_col).alias("id"))
    return placed(rows, [], **how).select(F.col("id").alias("doc_id"), "source", "block", "mix_slot", "mix_order")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          order_col: str | None = None, **how) -> DataFrame:
    """The rows of ``docs`` in mixed order, columns as they are; ``order_col`` adds each row's place.

    Tables lose the order of their rows when they are written and read, so what follows needs the
    place. Places are found on ids and sources alone and meet the texts by row key; rows equal in id,
    source and text share the place of their least.
    """
    docs = docs.drop(order_col) if order_col else docs
    k1, k2, at = fresh(docs, "llm_k1", "llm_k2", order_col or "llm_order")
    a, b = row_key(id_col, source_col, text_col)
    rows = docs.select(F.col(source_col).alias("source"), F.col(id_col).alias("id"), a.alias("k1"), b.alias("k2"))
    places = placed(rows, ["k1", "k2"], **how).groupBy("k1", "k2").agg(F.min("mix_order").alias(at)).select(
        F.col("k1").alias(k1), F.col("k2").alias(k2), at)
    out = docs.withColumns({k1: a, k2: b}).join(places, [k1, k2]).orderBy(at).drop(k1, k2)
    return out if order_col else out.drop(at)
