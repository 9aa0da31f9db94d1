"""Entities by label: patterns inside the row, phrases by joining a gazetteer."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pagelake.functions.bloom import bits_for, bloom_words, might_hold
from pagelake.functions.text import WORD_CHAR

# Label -> pattern; callers may pass their own. The e-mail name may only start at
# the start of a run of its characters, else a long run without @ costs its square.
PATTERNS: dict[str, str] = {
    "EMAIL": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "IP": r"\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b",
    "PHONE": r"\+?\(?[0-9]{3}\)?[ -][0-9]{3}[ -][0-9]{4}\b",
    "URL": r"https?://[^\s<>\"']+",
}

# What every match of a pattern holds. A text without it is not searched, which costs far less.
_HOLDS = {PATTERNS["EMAIL"]: "@", PATTERNS["URL"]: "://"}

ENTITY_MAP = "MAP<STRING,ARRAY<STRING>>"


def pattern_entities(text: Column, patterns: Mapping[str, str] = PATTERNS) -> Column:
    """Map of label to matches in text order; labels without a match are absent."""
    def matches(regex: str) -> Column:
        found = F.regexp_extract_all(text, F.lit(regex), F.lit(0))
        if regex not in _HOLDS:
            return found
        return F.when(F.contains(text, F.lit(_HOLDS[regex])), found).otherwise(F.array().cast("array<string>"))

    pairs = [part for label, regex in patterns.items() for part in (F.lit(label), matches(regex))]
    return F.map_filter(F.create_map(*pairs), lambda _, found: F.size(found) > 0)


def pattern_mentions(
    df: DataFrame, keys: Sequence[str], text: str = "text", patterns: Mapping[str, str] = PATTERNS
) -> DataFrame:
    """``keys, label, source, pos, mention``: one row per match."""
    by_label = df.select(
        *keys, F.explode(pattern_entities(F.col(text), patterns)).alias("label", "_found")
    )
    return by_label.select(
        *keys, "label", F.lit(0).alias("source"), F.posexplode("_found").alias("pos", "mention")
    )


def gazetteer_mentions(
    df: DataFrame,
    gazetteer: DataFrame,
    keys: Sequence[str],
    text: str = "text",
    word_counts: Sequence[int] = (1, 2, 3),
) -> DataFrame:
    """Phrases of ``gazetteer(phrase, label)`` found in the texts, any case.

    Phrases are lower-case words with single spaces, one row per phrase and
    label. Every run of as many words as ``word_counts`` says is tested in the row against a Bloom filter of the phrases, of bounded
    size; only what it may hold leaves the scan and joins the gazetteer. ``text`` and ``keys`` are not null.
    """
    words = F.regexp_extract_all(F.col(text), F.lit(f"[{WORD_CHAR}]+"), F.lit(0))
    bits = bits_for(gazetteer.count())
    known = bloom_words(gazetteer, ["phrase"], bits)

    def run_at(i: Column, n: int) -> Column:
        # Null where fewer than n words are left.
        return F.when(i + n <= F.size("_words"), F.array_join(F.slice("_words", i + 1, F.lit(n)), " "))

    starts = df.select(*keys, words.alias("_words")).select(
        *keys,
        F.posexplode(F.transform("_words", lambda _, i: F.array(*(run_at(i, n) for n in word_counts)))).alias("pos", "_runs"),
    )
    candidates = (
        starts.select(*keys, "pos", F.explode("_runs").alias("mention"))
        .withColumn("phrase", F.lower("mention"))
        .filter(F.col("mention").isNotNull() & might_hold(known, [F.col("phrase")], bits))
    )
    found = candidates.join(gazetteer.select("phrase", "label"), "phrase")
    return found.select(*keys, "label", F.lit(1).alias("source"), "pos", "mention")


def entities_by_label(mentions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, entities``: label to texts, repeats kept, in text order.

    Grouped per text, so a group is as large as one text's mentions.
    """
    per_label = mentions.groupBy(*keys, "label").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("source", "pos", "mention"))),
            lambda m: m["mention"],
        ).alias("_texts")
    )
    return per_label.groupBy(*keys).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("label", "_texts")))).alias("entities")
    )


def tag_entities(
    df: DataFrame,
    keys: Sequence[str],
    text: str = "text",
    patterns: Mapping[str, str] = PATTERNS,
    gazetteer: DataFrame | None = None,
    word_counts: Sequence[int] = (1, 2, 3),
) -> DataFrame:
    """``keys, entities`` of every text, an empty map where nothing matched.

    Without a gazetteer this stays inside the row.
    """
    if gazetteer is None:
        return df.select(*keys, pattern_entities(F.col(text), patterns).alias("entities"))
    mentions = pattern_mentions(df, keys, text, patterns).unionByName(
        gazetteer_mentions(df, gazetteer, keys, text, word_counts)
    )
    empty = F.create_map().cast(ENTITY_MAP)
    return (
        df.select(*keys)
        .join(entities_by_label(mentions, keys), list(keys), "left")
        .withColumn("entities", F.coalesce("entities", empty))
    )
