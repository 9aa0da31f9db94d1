"""Dates: partition columns, timestamp texts, publish times."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
COMPACT = "yyyyMMddHHmmss"
DAY = "yyyy-MM-dd"

# The layouts news sources use once a leading weekday is dropped.
_PUBLISHED_FORMATS = (
    "d MMM yyyy HH:mm:ss z",
    "d MMM yyyy HH:mm:ss xx",
    "d MMM yyyy HH:mm:ss xxx",
    "d MMM yyyy HH:mm z",
    "d MMM yyyy HH:mm xx",
    "d MMM yyyy HH:mm:ss",
)


def date_parts(ts: Column) -> dict[str, Column]:
    """Zero-padded ``year``, ``month``, ``day`` strings for a partition path."""
    return {
        "year": F.date_format(ts, "yyyy"),
        "month": F.date_format(ts, "MM"),
        "day": F.date_format(ts, "dd"),
    }


def published_ts(text: Column) -> Column:
    """Timestamp of an ISO-8601 or RFC-822 text; null when it is neither.

    RFC-822 weekday names are dropped, since feeds get them wrong.
    """
    bare = F.regexp_replace(F.trim(text), r"^[A-Za-z]{3,9},\s*", "")
    return F.coalesce(
        F.try_to_timestamp(text),
        *(F.try_to_timestamp(bare, F.lit(f)) for f in _PUBLISHED_FORMATS),
    )
