"""From raw documents to token ids: rules, line dedup, near-dedup, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next one's ``docs``. The first three return the columns of ``documents``, the mix adds ``mix_order``,
a document's place in the training set, and the last one passes it on: sorted by it, the result is the mix.
Null texts count as having no words and go in the first stage; empty tables pass all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pagelake.llm import bpe_codec, line_dedup, mixing, quality_rules, simhash_dedup
from pagelake.llm.common import written

MIX_ORDER = "mix_order"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.quality_filter(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents repeat stay in one of them only."""
    return line_dedup.line_dedup(docs).select(*[f"`{c}`" for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the least id."""
    return simhash_dedup.simhash_filter(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order in which sources are to be read."""
    return mixing.mixed(docs)


def placed_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same with each document's place, which a table keeps and the order of its rows does not."""
    return mixing.mixed(docs, order_col=MIX_ORDER)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of each document's ids, the digest of the text they decode to, and its place where ``docs`` has one."""
    import public_tokenizers

    also = [c for c in docs.columns if c == MIX_ORDER]
    return bpe_codec.digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, also=also)


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("mix", placed_mix), ("tokens", tokens)]

# Fingerprints and byte-pair merges can't be written in SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{name}")
    return docs
