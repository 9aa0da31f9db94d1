"""One pass over a page's HTML: text, links, images, metadata.

HTML needs a real parser, so this is the one place where rows go through
Python: an Arrow UDF, one batch at a time, one parse per page for all four
results.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from html.entities import html5
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F

from pagelake.schemas import IMAGE, LINK

# Ship this module's code with the UDF, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values of the HTML vocabulary.
VOID_TAGS = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen "
    "link menuitem meta nextid param source spacer track wbr".split()
)
HIDDEN_TAGS = frozenset(("script", "style", "template", "rt", "rp"))
PREFORMATTED_TAGS = frozenset(("pre", "textarea"))
ASCII_BLANK = " \n\t\f\r"
# Links that joining leaves as they are after the page's scheme and host: no dots, parameters, empty segments or characters to strip.
PLAIN_PATH = re.compile(r"(?:/[A-Za-z0-9_~-]+)+/?")

_PAGE_ARROW = pa.struct([
    ("text", pa.string()),
    ("links", pa.list_(pa.struct([("href", pa.string()), ("url", pa.string())]))),
    ("images", pa.list_(pa.struct([("url", pa.string()), ("alt_text", pa.string())]))),
    ("metadata", pa.map_(pa.string(), pa.string())),
    ("error", pa.string()),
])
PAGE_STRUCT = (
    f"STRUCT<text STRING, links ARRAY<STRUCT<{LINK}>>, images ARRAY<STRUCT<{IMAGE}>>, "
    "metadata MAP<STRING,STRING>, error STRING>"
)


class _Page(HTMLParser):
    """Collects what one page shows. End tags close every tag opened inside them."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.texts, self.hrefs, self.images, self.meta = [], [], [], {}
        self._open, self._pending = [], []
        self._n_open, self._n_hidden, self._n_pre = Counter(), 0, 0
        self._title = None  # child counts of the open tags from <title> down
        self._title_seen, self._title_leaf, self._title_plain = False, None, True

    def updatepos(self, i, j):
        """Line numbers are not needed."""
        return j

    # -- text ---------------------------------------------------------------
    def handle_data(self, data):
        self._pending.append(data)

    def handle_charref(self, name):
        digits = (name[1:] if name[:1] in "xX" else name).lstrip("0") or "0"
        # No code point has more than seven digits, and very long numbers don't parse.
        code = int(digits, 16 if name[:1] in "xX" else 10) if len(digits) <= 7 else 0x110000
        if code >= 0x110000:
            self._pending.append("\ufffd")
        elif 0x80 <= code < 0xA0:  # browsers read these as windows-1252
            self._pending.append(bytes([code]).decode("windows-1252", "ignore") or chr(code))
        else:
            self._pending.append(chr(code))

    def handle_entityref(self, name):
        self._pending.append(html5.get(f"{name};", f"&{name}"))

    def _flush(self, shown=True):
        """End the current text node."""
        if not self._pending:
            return
        text = "".join(self._pending)
        self._pending.clear()
        if not text.strip(ASCII_BLANK) and not self._n_pre:
            text = "\n" if "\n" in text else " "
        if self._title:
            self._count_title_child()
            self._title_leaf = text
        if shown and not self._n_hidden:
            self.texts.append(text)

    def handle_comment(self, data):
        self._flush()
        self._pending.append(data)
        self._flush(shown=False)

    def handle_decl(self, decl):
        self._flush()

    handle_pi = handle_decl

    def unknown_decl(self, data):
        self._flush()
        if data[:6].upper() == "CDATA[":
            self._pending.append(data[6:])
            self._flush()

    def parse_html_declaration(self, i):
        """Declarations that follow no rule count as comments, as browsers read them."""
        try:
            return super().parse_html_declaration(i)
        except AssertionError:
            return self.parse_bogus_comment(i)

    # -- tags ---------------------------------------------------------------
    def handle_starttag(self, tag, attrs):
        self._enter(tag, attrs)
        if tag in VOID_TAGS:
            self._leave(tag)

    def handle_startendtag(self, tag, attrs):
        self._enter(tag, attrs)
        self._leave(tag)

    def handle_endtag(self, tag):
        self._flush()
        self._leave(tag)

    def _enter(self, tag, attrs):
        self._flush()
        if self._title:
            self._count_title_child()
            self._title.append(0)
        elif tag == "title" and not self._title_seen:
            self._title, self._title_seen = [0], True
        self._open.append(tag)
        self._count_open(tag, 1)
        if tag not in ("a", "img", "meta"):
            return
        values = {k: v or "" for k, v in attrs}
        if tag == "a" and "href" in values:
            self.hrefs.append(values["href"])
        elif tag == "img" and "src" in values:
            self.images.append((values["src"], values.get("alt", "")))
        elif tag == "meta" and values.get("content"):
            key = values.get("name") or values.get("property")
            if key:
                self.meta[key] = values["content"]

    def _leave(self, tag):
        if not self._n_open[tag]:
            return
        while True:
            closed = self._open.pop()
            self._count_open(closed, -1)
            if self._title:
                self._title.pop()
            if closed == tag:
                return

    def _count_open(self, tag, step):
        self._n_open[tag] += step
        self._n_hidden += step * (tag in HIDDEN_TAGS)
        self._n_pre += step * (tag in PREFORMATTED_TAGS)

    # -- title --------------------------------------------------------------
    def _count_title_child(self):
        self._title[-1] += 1
        self._title_plain = self._title_plain and self._title[-1] == 1

    def finish(self):
        self.close()
        self._flush()
        if self._title_seen:
            # A meta tag named "title" wins over the title tag.
            self.meta.setdefault("title", self._title_leaf if self._title_plain else None)


def _origin(base):
    """Scheme and host that ``urljoin`` puts before a plain path; None where it may do otherwise."""
    try:
        parts = urlsplit(base or "")
    except ValueError:
        return None
    return f"{parts.scheme}://{parts.netloc}" if parts.scheme in ("http", "https") and parts.netloc else None


def _resolve(base, ref, origin=None):
    """``ref`` joined to ``base``; ``origin`` is that of ``base``, which spares the join for plain paths."""
    if origin and PLAIN_PATH.fullmatch(ref):
        return origin + ref
    try:
        return urljoin(base or "", ref)
    except ValueError:
        return None


def _utf8(text):
    """Lone surrogates cannot be stored in a STRING column."""
    return text if text.isascii() else text.encode("utf-8", "replace").decode("utf-8")


def parse_page(html, url, base_url):
    """One page as a dict of the four results; ``error`` says why the parser stopped before the end."""
    page, error = _Page(), None
    try:
        page.feed(html)
        page.finish()
    except (AssertionError, ValueError) as stopped:
        error = f"{type(stopped).__name__}: {stopped}"
        page._flush()
    origin = _origin(url) if page.hrefs else None
    return {
        "text": _utf8("".join(page.texts)),
        "links": [{"href": _utf8(h), "url": _resolve(url, _utf8(h), origin)} for h in page.hrefs],
        "images": [{"url": _resolve(base_url, _utf8(s)), "alt_text": _utf8(a)} for s, a in page.images],
        "metadata": [(_utf8(k), None if v is None else _utf8(v)) for k, v in page.meta.items()],
        "error": error and _utf8(error),
    }


def _parse_batch(html: pa.Array, url: pa.Array, base_url: pa.Array) -> pa.Array:
    rows = (
        None if h is None else parse_page(h, u, b)
        for h, u, b in zip(html.to_pylist(), url.to_pylist(), base_url.to_pylist())
    )
    return pa.array(list(rows), type=_PAGE_ARROW)


def parse_html(html: Column, url: Column, base_url: Column) -> Column:
    """Struct of raw text, links resolved against the page, images resolved
    against the site, and metadata.

    Deterministic, so filters on other columns are pushed below it. Explode it
    from an array of one, as ``extract`` does, to keep the optimizer from copying
    the parse into every use of a field.
    """
    return F.arrow_udf(_parse_batch, PAGE_STRUCT)(html, url, base_url)
