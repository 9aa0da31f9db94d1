"""Term counts and keywords as column expressions: a row never leaves its task.

Equal terms meet by sorting the row's term array, so counting needs neither
explode nor shuffle, and the same expressions run on streams.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import lru_cache

from pyspark.sql import Column, functions as F

from pagelake.functions.text import chunks, long_words, tokens, with_bigrams

TOP_N = 10
# Fixed value: terms a chunk may keep before ranking.
MAX_FEATURES = 50
_NO_TERMS = "array<struct<tf:int,term:string>>"
# A line and its repeats right after it.
_REPEATED = r"(?md)^([^\n]++)(?:\n\1(?![^\n]))++"


@lru_cache(maxsize=None)
def english_stop_words() -> tuple[str, ...]:
    from pyspark.ml.feature import StopWordsRemover

    return tuple(StopWordsRemover.loadDefaultStopWords("english"))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _runs(ordered: Column, same: Callable[[Column, Column], Column]) -> Column:
    """``array<struct<start, size>>`` of the runs of equal elements in a sorted array."""
    n = F.size(ordered)
    starts = F.filter(
        F.sequence(F.lit(0), n - 1),
        lambda i: (i == 0) | ~same(F.get(ordered, i), F.get(ordered, i - 1)),
    )
    return _let(
        starts,
        lambda s: F.zip_with(
            s,
            F.concat(F.slice(s, F.lit(2), F.size(s)), F.array(n)),
            lambda start, end: F.struct(start.alias("start"), (end - start).alias("size")),
        ),
    )


def count_terms(terms: Column) -> Column:
    """``array<struct<tf, term>>`` of a term array, in term order."""
    counted = _let(
        F.sort_array(terms),
        lambda s: F.transform(
            _runs(s, lambda a, b: a == b),
            lambda r: F.struct(r["size"].alias("tf"), F.get(s, r["start"]).alias("term")),
        ),
    )
    return F.when(F.size(terms) > 0, counted).otherwise(F.array().cast(_NO_TERMS))


def _longest(runs: Column, n: int) -> Column:
    """The runs no shorter than the ``n``-th longest: all that can be in a top ``n``."""
    def at_least_nth(r: Column) -> Column:
        nth = F.get(F.sort_array(F.transform(r, lambda x: x["size"]), asc=False), F.lit(n - 1))
        return _let(
            F.coalesce(nth, F.lit(0)), lambda least: F.filter(r, lambda x: x["size"] >= least)
        )

    return _let(runs, at_least_nth)


def _take(ranked: Column, n: int) -> Column:
    """The first ``n`` of an array of structs that start with the negated count."""
    return F.transform(
        F.slice(F.sort_array(ranked), 1, n),
        lambda c: F.struct((-c["tf"]).alias("tf"), c["term"].alias("term")),
    )


def top_terms(terms: Column, n: int) -> Column:
    """The ``n`` most frequent of a term array as ``array<struct<tf, term>>``, ties by term.

    Terms have a character at least and no line break: sorted and joined by line breaks, the runs of equal
    ones are found by one pattern, which costs far less than a lambda per term. Terms that occur once follow in their order.
    """
    def repeated(s: Column) -> Column:
        found = F.regexp_extract_all(F.array_join(s, "\n"), F.lit(_REPEATED), F.lit(0))
        return F.sort_array(F.transform(
            F.transform(found, lambda lines: F.struct(F.char_length(lines).alias("n"), F.substring_index(lines, "\n", 1).alias("term"))),
            lambda r: F.struct((-((r["n"] + 1) / (F.char_length(r["term"]) + 1)).cast("int")).alias("tf"), r["term"].alias("term")),
        ))

    def leading(s: Column) -> Column:
        def with_single(r: Column) -> Column:
            single = F.slice(F.array_except(s, F.transform(r, lambda c: c["term"])), 1, n)
            return F.when(F.size(r) >= n, r).otherwise(
                F.concat(r, F.transform(single, lambda t: F.struct(F.lit(-1).alias("tf"), t.alias("term"))))
            )

        return _let(repeated(s), with_single)

    ranked = F.transform(
        F.slice(_let(F.sort_array(terms), leading), 1, n), lambda c: F.struct((-c["tf"]).alias("tf"), c["term"].alias("term"))
    )
    return F.when(F.size(terms) > 0, ranked).otherwise(F.array().cast(_NO_TERMS))


def top_words(words: Column, n: int) -> Column:
    """As ``top_terms``, but ties by first occurrence."""
    placed = F.transform(words, lambda w, i: F.struct(w.alias("term"), i.alias("pos")))
    ranked = _let(
        F.sort_array(placed),
        lambda s: F.transform(
            _longest(_runs(s, lambda a, b: a["term"] == b["term"]), n),
            lambda r: F.struct(
                (-r["size"]).alias("tf"),
                F.get(s, r["start"])["pos"].alias("pos"),
                F.get(s, r["start"])["term"].alias("term"),
            ),
        ),
    )
    return F.when(F.size(words) > 0, _take(ranked, n)).otherwise(F.array().cast(_NO_TERMS))


def chunk_terms(text: Column, stop_words: Iterable[str] | None = None) -> Column:
    """Per chunk its one- and two-word terms without stop words, in text order."""
    stops = english_stop_words() if stop_words is None else tuple(stop_words)
    # Two transforms, since an expression used twice in a lambda is computed twice.
    return F.transform(F.transform(chunks(text), lambda c: tokens(c, stops)), with_bigrams)


def ranked_chunks(
    text: Column,
    top_n: int = TOP_N,
    max_features: int = MAX_FEATURES,
    stop_words: Iterable[str] | None = None,
) -> Column:
    """Per chunk its leading terms as ``array<struct<tf, term>>``.

    A text in which some chunk has no term falls back, as a whole, to its
    blank-separated words of more than three characters.
    """
    n = min(top_n, max_features)
    return _let(
        chunk_terms(text, stop_words),
        lambda per_chunk: F.when(
            F.exists(per_chunk, lambda t: F.size(t) == 0),
            F.array(top_words(long_words(text), top_n)),
        ).otherwise(F.transform(per_chunk, lambda t: top_terms(t, n))),
    )


def keywords(
    text: Column,
    top_n: int = TOP_N,
    max_features: int = MAX_FEATURES,
    stop_words: Iterable[str] | None = None,
) -> Column:
    """The leading terms chunk by chunk, each once, cut at ``top_n``."""
    leading = F.flatten(ranked_chunks(text, top_n, max_features, stop_words))
    return F.slice(F.array_distinct(F.transform(leading, lambda c: c["term"])), 1, top_n)
