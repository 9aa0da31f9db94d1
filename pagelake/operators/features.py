"""Text features of pages: entities and keywords of the texts that are not duplicates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from pagelake.functions.terms import keywords
from pagelake.operators.dedup import drop_duplicates
from pagelake.operators.entities import PATTERNS, pattern_entities
from pagelake.operators.pages import assemble


def with_text_features(df: DataFrame, patterns: Mapping[str, str] = PATTERNS) -> DataFrame:
    """Adds ``entities`` and ``keywords`` inside the row."""
    text = F.col("text")
    return df.withColumns({"entities": pattern_entities(text, patterns), "keywords": keywords(text)})


def page_features(
    pages: DataFrame,
    run_ts=None,
    history: DataFrame | None = None,
    patterns: Mapping[str, str] = PATTERNS,
) -> DataFrame:
    """Text records of ``pages(site, url, html, base_url, fetch_order)``.

    Duplicates go before the costly features are computed; their removal is the
    only shuffle of the plan.
    """
    assembled = assemble(pages, run_ts).select(
        "site", "content_hash", "url", "timestamp", "text", "fetch_order"
    )
    return with_text_features(drop_duplicates(assembled, history=history), patterns).drop(
        "text", "fetch_order"
    )
