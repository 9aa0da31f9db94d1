"""A Bloom filter as a small table of words, tested inside the row.

``bloom_words`` makes the table; filters of one size merge by taking the words of both. ``might_hold``
tests a column against it: never false for a value that went in. The table has at most MOST_BITS bits, whatever its
source's size, so attaching it to every task is bounded; more values than it has room for only make it less sharp.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

BITS_PER_VALUE = 12
MOST_BITS = 1 << 24
PROBES = 4


def bits_for(values: int) -> int:
    """A power of two that gives every value BITS_PER_VALUE bits, up to MOST_BITS."""
    bits = 1 << 10
    while bits < min(MOST_BITS, values * BITS_PER_VALUE):
        bits *= 2
    return bits


def _places(key: list[Column], bits: int) -> list[Column]:
    h = F.xxhash64(*key)
    return [(h + F.shiftrightunsigned(h, 32) * i).bitwiseAND(F.lit(bits - 1)) for i in range(PROBES)]


def bloom_words(df: DataFrame, keys: list[str], bits: int) -> DataFrame:
    """``word, bits``: the 64-bit words of the filter that are not zero."""
    at = df.select(F.explode(F.array(*_places([F.col(k) for k in keys], bits))).alias("_at"))
    return _merged(at.select(
        F.shiftright("_at", 6).cast("int").alias("word"), F.expr("shiftleft(1L, cast(_at & 63 AS INT))").alias("bits")
    ))


def _merged(words: DataFrame) -> DataFrame:
    return words.groupBy("word").agg(F.bit_or("bits").alias("bits"))


def merge_words(*tables: DataFrame) -> DataFrame:
    """The filter of everything that went into any of ``tables``, all made with as many bits."""
    return _merged(reduce(DataFrame.unionByName, tables))


def might_hold(words: DataFrame, key: list[Column], bits: int) -> Column:
    """Whether the filter may hold the key: a subquery reads the words once, the row looks four of them up."""
    spark = words.sparkSession
    blank = spark.range(bits // 64).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("bigint").alias("bits"))
    dense = merge_words(words, blank).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda w: w["bits"]).alias("words")
    ).scalar()
    found = [
        F.getbit(F.get(dense, F.shiftright(at, 6).cast("int")), at.bitwiseAND(F.lit(63)).cast("int")) == 1 for at in _places(key, bits)
    ]
    return reduce(lambda a, b: a & b, found)
