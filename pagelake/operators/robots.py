"""Drop urls that a host's rules disallow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pagelake.functions.urls import host, path


def _regex(rule: Column) -> Column:
    """The rule as a pattern: ``*`` is any text, a ``$`` at the end is the end, all else stands for itself."""
    quoted = F.regexp_replace(F.regexp_replace(rule, r"\$$", ""), r"([^*A-Za-z0-9/_-])", r"\\$1")
    ends = F.when(F.endswith(rule, F.lit("$")), F.lit("$")).otherwise("")
    return F.concat(F.lit("^"), F.regexp_replace(quoted, r"\*+", ".*"), ends)


def _matches(rule: Column, url_path: Column) -> Column:
    """Plain rules are prefixes; only those with wildcards cost a pattern."""
    return F.when(rule["regex"].isNull(), F.startswith(url_path, rule["text"])).otherwise(F.regexp_like(url_path, rule["regex"]))


def robots_filter(urls: DataFrame, rules: DataFrame | None = None, url: str = "url") -> DataFrame:
    """Rows that the rules of their host allow.

    ``rules`` is ``(host, rule, allow)``, or ``(host, disallow)`` where all forbid. The longest rule that matches a
    path decides, of two as long the one that allows; a path that none matches is allowed. ``*`` in a rule is any text
    and ``$`` at its end the end of the path; an empty rule says nothing. Passes everything through without rules.

    A host's rules come from one robots file, so they fit in an array, longest first; the array is attached to the urls by
    a join on the host, which adaptive execution splits where one host owns a large share.
    """
    if rules is None:
        return urls
    if "rule" not in rules.columns:
        rules = rules.select("host", F.col("disallow").alias("rule"), F.lit(False).alias("allow"))
    text = F.col("rule")
    wild = F.contains(text, F.lit("*")) | F.endswith(text, F.lit("$"))
    per_host = (
        rules.filter(F.coalesce(text, F.lit("")) != "")
        .groupBy(F.lower("host").alias("_host"))
        .agg(F.array_sort(F.collect_set(F.struct(
            (-F.char_length(text)).alias("order"), (~F.col("allow")).alias("forbids"), text.alias("text"),
            F.when(wild, _regex(text)).alias("regex"),
        ))).alias("_rules"))
    )
    marked = urls.withColumns({"_host": host(F.col(url)), "_path": path(F.col(url))})
    joined = marked.join(per_host, "_host", "left")
    deciding = F.get(F.filter("_rules", lambda r: _matches(r, F.col("_path"))), F.lit(0))
    return joined.filter(~F.coalesce(deciding["forbids"], F.lit(False))).drop("_host", "_path", "_rules")
