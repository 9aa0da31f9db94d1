"""Text columns: normalising, chunking, hashing, tokens. All JVM-side."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

# Fixed value: texts are hashed and ranked in slices of this many characters.
CHUNK_CHARS = 100_000

# The characters Python's str.split() and str.strip() treat as blank
# (Java's \s is ASCII only), those among them str.splitlines() breaks at, and \w
# without combining marks.
LATIN_BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
OTHER_BLANKS = "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
LINE_BREAKS = "\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
WORD_CHAR = r"\p{L}\p{N}_"


def _one_of(chars: str) -> str:
    """Character class as escapes, since a pattern may not hold raw line breaks."""
    return "[" + "".join(rf"\x{{{ord(c):x}}}" for c in chars) + "]"


def _replace_blanks(text: Column, within: Column, pattern, by: str) -> Column:
    """Replace ``pattern(blank, line_break)`` in ``within``, a variant of ``text``.

    Regex classes of Latin-1 characters are bit tables, other classes are chains
    of range checks at every character. Texts without any character of the range
    the other blanks lie in, most texts, take the fast class.
    """
    latin = pattern(_one_of(LATIN_BLANKS), _one_of("".join(c for c in LINE_BREAKS if c < "\u0100")))
    every = pattern(_one_of(LATIN_BLANKS + OTHER_BLANKS), _one_of(LINE_BREAKS))
    return F.when(text.rlike(r"[\x{1680}-\x{3000}]"), F.regexp_replace(within, every, by)).otherwise(
        F.regexp_replace(within, latin, by)
    )


def clean_lines(text: Column) -> Column:
    """Trim every line, break lines at two spaces, drop blanks, join with newline.

    A run of blanks that holds a line break or two spaces separates two pieces,
    any other run stays, so one replacement and one trim say the whole rule.
    """
    def gap(blank: str, line_break: str) -> str:
        # From the first blank of a run only, so that a long run is scanned once.
        return f"(?={blank})(?<!{blank}){blank}*(?:{line_break}|  ){blank}*+"

    return F.btrim(_replace_blanks(text, text, gap, "\n"), F.lit(LATIN_BLANKS + OTHER_BLANKS))


def normalize(text: Column) -> Column:
    """Lower case, blank runs to one space, trimmed."""
    return F.trim(_replace_blanks(text, F.lower(text), lambda blank, _: f"{blank}+", " "))


def chunks(text: Column, size: int = CHUNK_CHARS) -> Column:
    """Array of consecutive ``size``-character slices; empty for an empty text."""
    n = F.char_length(text)
    last = F.floor((n - 1) / F.lit(size)).cast("int")
    sliced = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.substring(text, i * size + 1, F.lit(size))
    )
    return (
        F.when(n == 0, F.array().cast("array<string>"))
        .when(n <= size, F.array(text))
        .otherwise(sliced)
    )


def content_hash(text: Column) -> Column:
    """md5 over the normalised slices, joined without a separator.

    Texts of one slice, nearly all of them, take the plain branch.
    """
    sliced = F.array_join(F.transform(chunks(text), normalize), "")
    return F.when(F.char_length(text) <= CHUNK_CHARS, F.md5(normalize(text))).otherwise(F.md5(sliced))


def tokens(text: Column, stop_words: Iterable[str] = ()) -> Column:
    """Words of two or more word characters in lower case, without stop words.

    Words are whole runs of word characters, so a stop word goes where it equals one, by a hash set instead of
    the pattern. A stop word with an apostrophe can never equal a token and is left out.
    """
    stops = sorted({w for w in (s.lower() for s in stop_words) if w.replace("_", "a").isalnum()})
    words = F.regexp_extract_all(F.lower(text), F.lit(f"[{WORD_CHAR}][{WORD_CHAR}]+"), F.lit(0))
    return F.filter(words, lambda w: ~w.isin(stops)) if stops else words


def with_bigrams(words: Column) -> Column:
    """The words followed by their neighbouring pairs."""
    n = F.size(words)
    pairs = F.zip_with(
        F.slice(words, F.lit(1), F.greatest(n - 1, F.lit(0))),
        F.slice(words, F.lit(2), F.greatest(n - 1, F.lit(0))),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )
    return F.concat(words, pairs)


def long_words(text: Column, longer_than: int = 3) -> Column:
    """Blank-separated words of more than ``longer_than`` characters."""
    return F.filter(F.split(normalize(text), " "), lambda w: F.char_length(w) > longer_than)
