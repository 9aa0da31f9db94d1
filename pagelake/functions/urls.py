"""URL columns: hash, host, path, link predicates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)"
_ORIGIN = r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^#]*)"


def url_hash(url: Column) -> Column:
    return F.md5(url)


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _HOST, 1))


def origin(url: Column) -> Column:
    """Scheme, host and port."""
    return F.regexp_extract(url, _ORIGIN, 1)


def path(url: Column) -> Column:
    """Path with query, ``/`` when empty."""
    p = F.regexp_extract(url, _PATH, 1)
    return F.when(F.startswith(p, F.lit("/")), p).otherwise(F.concat(F.lit("/"), p))


def strip_fragment(url: Column) -> Column:
    return F.regexp_replace(url, "#.*$", "")


def is_followable(href: Column) -> Column:
    """False for empty links, anchors and ``javascript:`` links (case-sensitive, untrimmed)."""
    return ~(
        (href == "")
        | F.startswith(href, F.lit("#"))
        | F.startswith(href, F.lit("javascript:"))
    )


def same_site(url: Column, base_url: Column, mode: str = "prefix") -> Column:
    """``prefix``: the url starts with the site's url. ``host``: both have one host."""
    if mode == "prefix":
        return F.startswith(url, base_url)
    if mode == "host":
        return host(url) == host(base_url)
    raise ValueError(f"Unsupported mode: {mode}")
