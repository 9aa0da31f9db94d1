"""Page, link and text records from fetched pages."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from pagelake.functions.html import parse_html
from pagelake.functions.text import clean_lines
from pagelake.functions.urls import is_followable, same_site, strip_fragment, url_hash
from pagelake.operators.dedup import with_content_hash


def fetched(pages: DataFrame) -> DataFrame:
    """Pages that came back with markup."""
    return pages.filter(F.col("html").isNotNull() & (F.col("html") != ""))


def extract(pages: DataFrame) -> DataFrame:
    """Adds ``text, links, images, metadata, parse_error`` to ``pages(url, html, base_url, ...)``.

    Links are raw here: ``links`` holds every ``a[href]`` in document order
    with its resolved url. No fetched page is dropped: ``parse_error`` tells why one was
    read only in part, and is null otherwise. The explode of one parse keeps it a single
    evaluation while filters on the page's own columns still reach the scan.
    """
    parsed = fetched(pages).select(
        *pages.columns, F.explode(F.array(parse_html(F.col("html"), F.col("url"), F.col("base_url")))).alias("_page")
    )
    return parsed.select(
        *pages.columns,
        clean_lines(F.col("_page.text")).alias("text"),
        F.col("_page.links").alias("links"),
        F.col("_page.images").alias("images"),
        F.col("_page.metadata").alias("metadata"),
        F.col("_page.error").alias("parse_error"),
    )


def site_links(links: Column, base_url: Column, mode: str = "prefix", fragments: bool = True) -> Column:
    """Urls of the followable links that stay on the site, in document order, repeats kept."""
    kept = F.filter(
        links, lambda l: is_followable(l["href"]) & l["url"].isNotNull() & same_site(l["url"], base_url, mode)
    )
    return F.transform(kept, lambda l: l["url"] if fragments else strip_fragment(l["url"]))


def link_table(extracted: DataFrame, mode: str = "prefix", fragments: bool = True) -> DataFrame:
    """``site, src_url, pos, dst_url``: one row per kept link."""
    return extracted.select(
        "site",
        F.col("url").alias("src_url"),
        F.posexplode(site_links(F.col("links"), F.col("base_url"), mode, fragments)).alias("pos", "dst_url"),
    )


def page_counts(extracted: DataFrame, mode: str = "prefix") -> DataFrame:
    """Links, images, metadata entries and characters of every page."""
    return extracted.select(
        "site",
        "url",
        F.size(site_links(F.col("links"), F.col("base_url"), mode)).alias("n_links"),
        F.size("images").alias("n_images"),
        F.size(F.map_keys("metadata")).alias("n_metadata"),
        F.char_length("text").alias("n_chars"),
    )


def stamp(df: DataFrame, run_ts: datetime | Column | None = None, site: str = "site", base_url: str = "base_url") -> DataFrame:
    """Adds ``crawler, timestamp, source_url``, replacing columns of those names."""
    ts = F.current_timestamp() if run_ts is None else run_ts if isinstance(run_ts, Column) else F.lit(run_ts)
    return df.withColumns(
        {"crawler": F.col(site), "timestamp": ts.cast("timestamp"), "source_url": F.col(base_url)}
    )


def with_url_hash(df: DataFrame) -> DataFrame:
    return df.withColumn("hash", url_hash(F.col("url")))


def assemble(pages: DataFrame, run_ts: datetime | Column | None = None) -> DataFrame:
    """Extracted pages with both hashes and provenance; everything a record needs."""
    return (
        extract(pages)
        .transform(with_content_hash)
        .transform(with_url_hash)
        .transform(stamp, run_ts)
    )


def page_records(assembled: DataFrame) -> DataFrame:
    """The raw-zone record: page content and provenance, no text features."""
    return assembled.select(
        "url", "hash", "text", "images", "metadata", "html", "crawler", "timestamp", "source_url"
    )


def text_records(features: DataFrame, *also: str | Column) -> DataFrame:
    """The text-zone record, with columns the caller adds."""
    return features.select("url", "entities", "keywords", "content_hash", "timestamp", *also)
