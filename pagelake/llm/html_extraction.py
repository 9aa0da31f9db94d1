"""Main text of web pages by composite text density.

Pruned is only what HTML itself says is no text: scripts, form controls, hidden parts, navigation,
footers. Names of classes and ids, and forms, are doubts: their text counts as link text and
their density little, and density decides whether they stay.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A tag with its attributes; quotes count only after an equals sign.
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))*+)>""")
_ATTR = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""")
_WORD = re.compile(r"[a-z]+")
# References to numbers beyond any code point; so long a number doesn't parse.
_BEYOND = re.compile(r"&#(?:[xX][0-9a-fA-F]{9,}|[0-9]{9,});?")
_SPACE = re.compile(r"\s+")
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "noembed", "noframes", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark",
          "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var"}
# Never part of the text, with all they hold.
NOT_TEXT = {"head", "nav", "aside", "menu", "dialog", "button", "select", "svg", "math", "canvas", "object", "audio", "video", "footer"}
NOT_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "menubar"}
# A name counts this much of its density, unless it is the page's layout; with such a word it tells of other parts.
DOUBT = 0.02
OF_OTHERS = {"with", "without", "has", "have", "no", "not"}
# So many links that hold most of a part's text are a list of links.
LINK_LIST = 3
COMMENTS = {"comment", "comments", "commentlist", "disqus", "reply", "replies", "respond"}
NOT_NAMES = COMMENTS | {"ad", "ads", "adsense", "advert", "adverts", "advertisement", "sponsor", "sponsored", "promo", "promotion", "banner", "nav", "navbar",
                        "navigation", "menu", "breadcrumb", "breadcrumbs", "footer", "sidebar", "cookie", "cookies", "consent", "gdpr", "notice", "popup", "modal",
                        "overlay", "newsletter", "subscribe", "signup", "login", "share", "sharing", "social", "related", "recommended", "widget", "toolbar", "pagination",
                        "pager", "masthead", "topbar", "skip", "header"}
PLAIN = {"html", "body", "main"}
CLOSES_P = {"address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form", "h1",
            "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "main", "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table", "ul"}
CLOSES_SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = {"ul", "ol", "dl", "table", "select", "html", "body", "article", "div", "section", "main"}


class Tree:
    """Block nodes of a page in page order, and its text pieces; inline tags only mark links.

    ``skip`` marks what HTML says is no text, ``doubt`` nodes (1, for reader comments 2) that only a name speaks against.
    """

    def __init__(self, source: str):
        self.tag, self.parent, self.skip, self.doubt = ["#root"], [0], [False], [0]
        self.link_tags = [0]
        self.pieces: list[tuple[int, int, bool, str]] = []  # node, block, in a link, text
        self._build(source)

    def _judged(self, tag: str, raw: str, within: bool) -> tuple[bool, int]:
        """(no text by HTML, doubt by name)."""
        if tag in NOT_TEXT or tag == "header" and not within:
            return True, 0
        doubt = int(tag == "form")
        if not raw.strip() or tag in PLAIN:
            return False, doubt
        names = set()
        for name, value in _ATTR.findall(raw):
            name, value = name.lower(), value.strip("\"'").lower()
            if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
                return True, 0
            if name == "role":
                if value in NOT_ROLES:
                    return True, 0
                doubt |= value == "form"
            if name in ("class", "id"):
                for token in value.split():
                    words = set(_WORD.findall(token))
                    if not words & OF_OTHERS:
                        names |= words
        if names & COMMENTS:
            return False, 2
        if tag == "article":
            return False, doubt
        return False, int(doubt or bool(names & (NOT_NAMES - {"header"} if within else NOT_NAMES)))

    def _build(self, source: str) -> None:
        open_tags: list[tuple[str, int]] = [("#root", 0)]  # block tags only
        opened: Counter[str] = Counter()
        link, block, at, within = 0, 0, 0, 0

        def text(raw: str) -> None:
            if raw:
                self.pieces.append((open_tags[-1][1], block, link > 0, raw))

        def close_to(n: int) -> None:
            nonlocal block, within
            for tag, _ in open_tags[n:]:
                within -= tag in ("article", "main")
                opened[tag] -= 1
            del open_tags[n:]
            block += 1

        def last_open(tags, stop) -> int:
            if not any(opened[t] for t in tags):
                return 0
            for i in range(len(open_tags) - 1, 0, -1):
                if open_tags[i][0] in tags:
                    return i
                if open_tags[i][0] in stop:
                    return 0
            return 0

        while True:
            lt = source.find("<", at)
            if lt < 0:
                text(source[at:])
                return
            text(source[at:lt])
            if source.startswith("<!--", lt):
                end = source.find("-->", lt + 4) if not source.startswith((">", "->"), lt + 4) else source.find(">", lt) - 2
                if end < 0:
                    return
                at = end + 3
                continue
            if source.startswith(("<!", "<?"), lt) or (source.startswith("</", lt) and not source[lt + 2: lt + 3].isalpha()):
                end = source.find(">", lt)
                if end < 0:
                    return
                at = end + 1
                continue
            if not source[lt + 1: lt + 2].isascii() or not (source[lt + 1: lt + 2].isalpha() or source[lt + 1: lt + 2] == "/"):
                text("<")
                at = lt + 1
                continue
            m = _TAG.match(source, lt)
            if not m:  # the page ends inside a tag
                return
            at = m.end()
            closing, tag, raw = m.group(1), m.group(2).lower(), m.group(3)
            if closing:
                if tag == "a":
                    link = 0
                elif tag == "br" or tag in VOID:
                    self.pieces.append((open_tags[-1][1], block, False, " "))
                elif tag not in INLINE and (i := last_open((tag,), ())):
                    close_to(i)
                    link = 0
                continue
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(source, at)
                if not end:
                    return
                close = source.find(">", end.end())
                at = close + 1 if close >= 0 else len(source)
                continue
            if tag in INLINE and not raw.rstrip().endswith("/") and any(self._judged(tag, raw, within > 0)) and (end := inline_end(source, tag, at)):
                at = end  # an inline part that is no text
                continue
            if tag == "a":
                link = 1
                self.link_tags[open_tags[-1][1]] += 1
                continue
            if tag in VOID or tag in INLINE:
                if tag in ("br", "hr", "img", "input"):
                    self.pieces.append((open_tags[-1][1], block, False, " "))
                continue
            if tag in CLOSES_P and (i := last_open(("p",), SCOPES)):
                close_to(i)
            if tag in CLOSES_SAME and (i := last_open(CLOSES_SAME[tag], SCOPES)):
                close_to(i)
            block, link = block + 1, 0
            parent = open_tags[-1][1]
            self.tag.append(tag)
            self.parent.append(parent)
            skip, doubt = self._judged(tag, raw, within > 0)
            self.skip.append(self.skip[parent] or skip)
            self.doubt.append(doubt)
            self.link_tags.append(0)
            open_tags.append((tag, len(self.tag) - 1))
            opened[tag] += 1
            within += tag in ("article", "main")


def inline_end(source: str, tag: str, at: int) -> int:
    """The place behind the end of an inline part that starts before ``at``; 0 if it has none or holds block tags."""
    depth = 1
    while (lt := source.find("<", at)) >= 0:
        m = _TAG.match(source, lt)
        at = m.end() if m else lt + 1
        if not m:
            continue
        name = m.group(2).lower()
        if name == tag:
            depth += -1 if m.group(1) else not m.group(3).rstrip().endswith("/")
            if not depth:
                return at
        elif name not in INLINE and name not in VOID:
            return 0
    return 0


class Sizes:
    """Characters, tags, and of them those of links, per subtree; ``end`` is the node behind it."""

    def __init__(self, tree: Tree):
        n = len(tree.tag)
        self.chars, self.link_chars, self.tags, self.link_tags = [0] * n, [0] * n, [0] * n, list(tree.link_tags)
        self.end = list(range(1, n + 1))
        for node, _, linked, text in tree.pieces:
            if not tree.skip[node]:
                size = len(text) - text.count(" ")
                self.chars[node] += size
                self.link_chars[node] += size * linked
        for i in range(n - 1, 0, -1):
            p = tree.parent[i]
            self.end[p] = max(self.end[p], self.end[i])
            if not tree.skip[i]:
                self.chars[p] += self.chars[i]
                self.link_chars[p] += self.link_chars[i]
                self.tags[p] += self.tags[i] + 1
                self.link_tags[p] += self.link_tags[i]

    def doubted(self, tree: Tree) -> list[bool]:
        """Nodes whose name is believed: it is not the page's layout.

        Beside an article elsewhere a name is believed; without one, while it holds no more than
        half of the page's unlinked text (reader comments: nine tenths).
        """
        articles = [i for i, t in enumerate(tree.tag) if t in ("article", "main") and tree.doubt[i] < 2 and self.chars[i] and not tree.skip[i]]
        plain = self.chars[0] - self.link_chars[0]
        found = [False] * len(tree.tag)
        for i, doubt in enumerate(tree.doubt):
            if doubt and not tree.skip[i] and self.chars[i]:
                share = (self.chars[i] - self.link_chars[i]) * 10
                beside = bool(articles) and (self.end[articles[0]] <= i or articles[-1] >= self.end[i])
                found[i] = beside or share <= plain * (9 if doubt == 2 else 5)
        return found


def densities(tree: Tree, sizes: Sizes, doubted: list[bool]) -> tuple[list[float], list[float]]:
    """(density, sum of the children's densities) per node.

    With C characters, T tags, and of them LC and LT in links, the density of a node is
    C/T log_b(C T / (LC LT)), where the base b grows with the share of link text, of the node and of the page.
    Text under a doubted name counts as link text, and each such name lowers what is below it to a fiftieth.
    """
    n = len(tree.tag)
    weight, named = [1.0] * n, [0] * n  # characters under doubted names that are no link text yet
    for i in range(1, n):
        weight[i] = weight[tree.parent[i]] * (DOUBT if doubted[i] else 1.0)
    for i in range(n - 1, 0, -1):
        if doubted[i]:
            named[i] = sizes.chars[i] - sizes.link_chars[i]
        if not tree.skip[i]:
            named[tree.parent[i]] += named[i]
    page = (sizes.link_chars[0] + named[0]) / max(sizes.chars[0], 1)
    density, total = [0.0] * n, [0.0] * n
    for i in range(n - 1, -1, -1):
        c = sizes.chars[i]
        if c and not tree.skip[i]:
            lc, t, lt = sizes.link_chars[i] + named[i], max(sizes.tags[i] + sizes.link_tags[i], 1), sizes.link_tags[i]
            base = math.log(c / max(c - lc, 1) * lc + page * c + math.e)
            density[i] = weight[i] * c / t * math.log(max(c / max(lc, 1) * t / max(lt, 1), 1.0)) / math.log(base + 1.0)
        if i:
            total[tree.parent[i]] += density[i]
    return density, total


def content_nodes(tree: Tree) -> list[bool]:
    """Per node, whether its own text is content.

    The subtree of the largest density sum is the core, and the least density on the way from the body to it the threshold.
    Every other subtree that reaches the threshold joins, and the root is the node above them all, or the article or
    main part it lies in. Under the root go doubted names and lists of links below the threshold, unless
    they hold the core.
    """
    sizes = Sizes(tree)
    doubted, end = sizes.doubted(tree), sizes.end
    density, total = densities(tree, sizes, doubted)
    top = next((i for i, t in enumerate(tree.tag) if t == "body"), 0)
    best = max(range(top, end[top]), key=lambda i: (total[i], -i))
    path = [best]
    while path[-1] != top and path[-1]:
        path.append(tree.parent[path[-1]])
    least = min(density[i] for i in path)
    on_path = set(path)
    root_from, root_to, i = best, best, top + 1  # first and last node that joined
    while i < end[top]:
        if i in on_path:
            i = i + 1 if i != best else end[i]
            continue
        if density[i] >= least > 0 and not tree.skip[i]:
            root_from, root_to = min(root_from, i), max(root_to, i)
        i = end[i]
    root = best
    while root and not root <= root_from <= root_to < end[root]:
        root = tree.parent[root]
    # A single leaf of a section does not stand for it.
    while root not in (0, top) and tree.tag[root] not in ("article", "main", "section", "div", "td", "body"):
        root = tree.parent[root]
    article = root
    while article and tree.tag[article] not in ("article", "main"):
        article = tree.parent[article]
    root = article or root
    kept = [False] * len(tree.tag)
    i = root
    while i < end[root]:
        links = sizes.link_tags[i] >= LINK_LIST and sizes.link_chars[i] * 2 > sizes.chars[i] and density[i] < least
        if tree.skip[i] or i not in on_path and (links or doubted[i] and density[i] <= least):
            i = end[i]
            continue
        kept[i] = True
        i += 1
    return kept


def extract_text(source: str | None) -> str:
    """Main text of a page; empty for null, empty or textless pages.

    Broken markup ends no page: it is read as far as it goes. Pages of any length and depth are read
    whole, in time that grows with their length.
    """
    if not source:
        return ""
    tree = Tree(source)
    kept = content_nodes(tree)
    blocks: list[tuple[int, list[str]]] = []
    for node, block, _, text in tree.pieces:
        if kept[node]:
            if not blocks or blocks[-1][0] != block:
                blocks.append((block, []))
            blocks[-1][1].append(text)
    found = (_SPACE.sub(" ", entities.unescape(_BEYOND.sub("\ufffd", "".join(parts)))).strip() for _, parts in blocks)
    return " ".join(t for t in found if t)


def html_extraction(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every row; each page is read alone, so nothing is shuffled.

    Repeated rows, null ids and other columns stay as they are or are ignored; null and empty pages have the empty text, an
    empty table an empty result. Of parts with equal density sums the first is the core.
    """
    kinds = {c: pages.schema[c].dataType.simpleString() for c in (id_col, url_col)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = pa.array([extract_text(x) for x in batch.column(2).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), text], ["page_id", "url", "text"])

    return (
        pages.select(id_col, url_col, html_col).mapInArrow(run, f"page_id {kinds[id_col]}, url {kinds[url_col]}, text string")
        .withColumn("n_chars", F.length("text").cast("long"))
    )
