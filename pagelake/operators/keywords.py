"""Keyword tables. The ranking itself is a column expression, see ``functions.terms``."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, functions as F

from pagelake.functions.terms import (
    MAX_FEATURES, TOP_N, chunk_terms, count_terms, keywords, ranked_chunks, top_words,
)
from pagelake.functions.text import long_words


def with_keywords(
    df: DataFrame,
    text: str = "text",
    top_n: int = TOP_N,
    max_features: int = MAX_FEATURES,
    stop_words: Iterable[str] | None = None,
) -> DataFrame:
    return df.withColumn("keywords", keywords(F.col(text), top_n, max_features, stop_words))


def term_counts(
    df: DataFrame, keys: Sequence[str], text: str = "text", stop_words: Iterable[str] | None = None, greatest: str | None = None
) -> DataFrame:
    """``keys, chunk, term, tf``: one row per one- or two-word term of a chunk.

    ``greatest`` adds a column with the greatest term of the chunk, by which rows can be grouped: a maximum
    of strings is aggregated by sorting all rows, numbers are not.
    """
    per_chunk = df.select(
        *keys,
        F.posexplode(F.transform(chunk_terms(F.col(text), stop_words), count_terms)).alias("chunk", "_counts"),
    )
    # Terms are in order.
    last = [F.get("_counts", F.size("_counts") - 1)["term"].alias(greatest)] if greatest else []
    return per_chunk.select(*keys, "chunk", *last, F.inline("_counts").alias("tf", "term"))


def ranked_terms(
    df: DataFrame,
    keys: Sequence[str],
    text: str = "text",
    top_n: int = TOP_N,
    max_features: int = MAX_FEATURES,
    stop_words: Iterable[str] | None = None,
) -> DataFrame:
    """``keys, chunk, rank, term, tf``: the leading terms of every chunk."""
    per_chunk = df.select(
        *keys,
        F.posexplode(ranked_chunks(F.col(text), top_n, max_features, stop_words)).alias("chunk", "_top"),
    )
    return per_chunk.select(*keys, "chunk", F.posexplode("_top").alias("_i", "_t")).select(
        *keys, "chunk", (F.col("_i") + 1).alias("rank"), "_t.term", "_t.tf"
    )


def frequent_words(
    df: DataFrame, keys: Sequence[str], text: str = "text", top_n: int = TOP_N
) -> DataFrame:
    """``keys, rank, term, tf``: the most frequent words of more than three characters."""
    words = df.select(*keys, F.posexplode(top_words(long_words(F.col(text)), top_n)).alias("_i", "_t"))
    return words.select(*keys, (F.col("_i") + 1).alias("rank"), "_t.term", "_t.tf")
