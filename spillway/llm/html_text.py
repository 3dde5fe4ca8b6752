"""Main text of web pages by composite text density.

Every page becomes a small element tree (implied end tags, raw scripts,
malformed markup).  What is not article by its element, role or class name is
left out.  On the rest each node gets a link-adjusted number of characters per
tag, each node the sum of its children's densities; the node with the largest
sum among those at least as dense as the path from the densest region up to
the body is the article.  One Arrow map over pages: no shuffle.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spillway.llm.common import ship

# ---- fixed values: element names of HTML and usual names of page furniture ----
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section
    summary table tbody td tfoot th thead title tr ul""".split())
CLOSES_PARAGRAPH = BLOCKS - frozenset("body caption head html legend summary tbody td tfoot th thead title tr".split())
# An opening tag ends an open element of these names, up to the named containers.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
NEVER_TEXT = frozenset("""head title script style noscript template nav aside footer form button select textarea input
    iframe object svg canvas audio video dialog menu map""".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
FURNITURE = frozenset("""ad ads adslot advert advertisement adverts aside banner breadcrumb breadcrumbs comment comments
    consent cookie cookies disqus disclaimer footer footnav gdpr masthead menu modal nav navbar navigation newsletter
    notice notification notifications overlay pager pagination popup promo promotion recommended related replies reply respond
    share sharing sidebar signup skip social sponsor sponsored subscribe toolbar topbar widget widgets""".split())
NOT_OWN = frozenset("has with no without".split())  # "with-sidebar" names a layout, not a sidebar
# Words that go with those in the name of one piece of furniture ("comment-list"); others make it a name of its own
# ("comment-on-methods", an anchor made from a heading).
COMPANIONS = frozenset("""area articles bar block body bottom box button buttons column container content entries feed footer form frame
    header icons inner item items left link links list module outer panel posts primary region right row secondary section site
    slot small text thread title top unit wrap wrapper zone""".split())
FOREIGN_ARTICLES = frozenset("comment comments reply replies ad ads advert advertisement promo related sponsored".split())
# Elements that an id may name as furniture (others carry ids as anchors), and the names that do it for a section.
NAMED_BY_ID = frozenset("article aside details div dl figure ol section table ul".split())
SECTION_IDS = FOREIGN_ARTICLES | frozenset("disqus newsletter respond sidebar sponsor".split())
HEADINGS = frozenset("h1 h2".split())
# --------------------------------------------------------------------------------

_NAME = re.compile(r"[a-z0-9]+")
ANY_BLOCK = "#block"


def _names(value: str | None) -> list[list[str]]:
    spaced = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "-", value or "")
    return [parts for name in spaced.lower().split() if (parts := _NAME.findall(name))]


def _whole(parts: list[str], own: frozenset) -> bool:
    """Whether a name is all furniture: one of the words, with companions or numbers at most."""
    return not own.isdisjoint(parts) and all(p in FURNITURE or p in COMPANIONS or p.isdigit() for p in parts)


def is_furniture(tag: str, attrs: dict, in_article: bool) -> bool:
    """Whether an element is page furniture by its name, role, class or id.

    Inside an article only whole names count, and anywhere for ids: they may be anchors made from headings.
    """
    if tag in ("html", "body", "main"):
        return False
    if tag in NEVER_TEXT or (tag == "header" and not in_article):
        return True
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or (attrs.get("role") or "").strip().lower() in ROLES:
        return True
    own = FOREIGN_ARTICLES if tag == "article" else FURNITURE
    if tag in NAMED_BY_ID and any(_whole(parts, SECTION_IDS if tag == "section" else own) for parts in _names(attrs.get("id"))):
        return True
    for parts in _names(attrs.get("class")):
        if in_article:
            if _whole(parts, own):
                return True
        elif parts[0] in own:
            return True
        elif NOT_OWN.isdisjoint(parts[:-1]) and (parts[-1] in own or (tag != "article" and parts[-1] == "header")):
            return True
    return False


class Tree(HTMLParser):
    """A page as parallel lists: tag, parent, furniture; `parts` are (node, text) in page order.

    `own` is what an element says of itself, `off`, known when the page has ended, whether it is left out.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tags, self.parents, self.own, self.articles = ["html"], [-1], [False], [False]
        self.off: list[bool] = []
        self.parts: list[tuple[int, str | None]] = []
        self.open = [0]
        self.endless: set[str] = set()  # kinds of markup whose end is nowhere in the rest of the page
        self.places: dict[str, list[int]] = {}  # of open elements by name, and of open blocks: an end tag is found at once

    def read(self, page: str) -> None:
        """Parse a whole page.  Behind the last ">" nothing can be markup, so nothing is searched for there."""
        last = page.rfind(">") + 1
        self.feed(page[:last])
        self.close()
        if self.cdata_elem is None and last < len(page):
            self.handle_data(unescape(page[last:]))
        self._settle()

    # Markup that never ends is searched for its end once, not at each of its beginnings.
    def parse_comment(self, i, report=1):
        return self._once("<!--", super().parse_comment, i, report)

    def parse_html_declaration(self, i):
        try:
            return self._once(self.rawdata[i:i + 12].lower(), super().parse_html_declaration, i)
        except AssertionError:  # a section of an unknown kind
            return self.parse_bogus_comment(i)

    def _once(self, kind, parse, i, *more):
        if kind in self.endless:
            return -1
        found = parse(i, *more)
        if found < 0:
            self.endless.add(kind)
        return found

    def _settle(self) -> None:
        """Which elements are left out, once all are known."""
        self.off = self._inherited(self.own)
        # What holds the article is no furniture; that goes for any article where all would be left out, and for main.
        free = any(t in ("article", "main") and not o for t, o in zip(self.tags, self.off, strict=True))
        holds = [t == "main" or (t == "article" and not free and not o) for t, o in zip(self.tags, self.own, strict=True)]
        for i in range(len(holds) - 1, 0, -1):
            if holds[i]:
                holds[self.parents[i]] = True
        self.off = self._inherited([o and not h for o, h in zip(self.own, holds, strict=True)])

    def _inherited(self, own: list[bool]) -> list[bool]:
        off = list(own)
        for i in range(1, len(off)):
            off[i] = off[i] or off[self.parents[i]]
        return off

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body"):
            if tag == "body" and "body" not in self.tags:
                self._close_to(1)
                self._push(tag, dict(attrs))
            return
        if tag in CLOSES_PARAGRAPH:
            self._end({"p"}, barrier={"article", "aside", "body", "div", "section", "td", "th", "li", "blockquote", "main"})
        if tag in IMPLIED:
            self._end(*IMPLIED[tag])
        if tag in VOID:
            if tag in ("br", "hr"):
                self.parts.append((self.open[-1], None if tag == "hr" else " "))
            return
        self._push(tag, dict(attrs))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # a slash does not close an element of HTML

    def _last(self, names) -> int:
        """Place of the innermost open element with one of the names; 0 if there is none."""
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=0)

    def handle_endtag(self, tag):
        at = self._last((tag,))
        if at and (tag in BLOCKS or at > self._last((ANY_BLOCK,))):  # an inline end tag ends nothing outside its block
            self._close_to(at)

    def handle_data(self, data):
        self.parts.append((self.open[-1], data))

    def _push(self, tag, attrs):
        up = self.open[-1]
        inside = self.articles[up]
        self.tags.append(tag)
        self.parents.append(up)
        self.own.append(is_furniture(tag, attrs, inside))
        self.articles.append(inside or tag in ("article", "main"))
        self.open.append(len(self.tags) - 1)
        for name in (tag, ANY_BLOCK) if tag in BLOCKS else (tag,):
            self.places.setdefault(name, []).append(len(self.open) - 1)
        if tag in BLOCKS:
            self.parts.append((self.open[-1], None))

    def _close_to(self, i):
        gone = [self.tags[n] for n in self.open[i:]]
        if any(tag in BLOCKS for tag in gone):
            self.parts.append((self.open[i - 1], None))
        for tag in gone:
            self.places[tag].pop()
            if tag in BLOCKS:
                self.places[ANY_BLOCK].pop()
        del self.open[i:]

    def _end(self, names, barrier):
        while (at := self._last(names)) > self._last(barrier - names):
            self._close_to(at)
            if names == {"p"} or "tr" not in names:
                return


def densities(tree: Tree) -> tuple[list[float], list[float]]:
    """Composite density of every node, and the sum of its children's."""
    n = len(tree.tags)
    chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    for node, text in tree.parts:
        if text and not tree.off[node]:
            chars[node] += len("".join(text.split()))
    in_link = [False] * n
    for i in range(1, n):
        in_link[i] = tree.tags[i] == "a" or in_link[tree.parents[i]]
    for i in range(n - 1, 0, -1):
        if tree.off[i]:
            continue
        if in_link[i]:
            link_chars[i] = chars[i]
        up = tree.parents[i]
        chars[up] += chars[i]
        tags[up] += tags[i] + 1
        link_chars[up] += link_chars[i]
        link_tags[up] += link_tags[i] + (tree.tags[i] == "a")
    all_chars, all_links = max(chars[0], 1), link_chars[0]
    density, sums = [0.0] * n, [0.0] * n
    for i in range(n):
        if chars[i] and not tree.off[i]:
            c, t, lc, lt = chars[i], max(tags[i], 1), max(link_chars[i], 1), max(link_tags[i], 1)
            base = math.log(c * lc / max(c - link_chars[i], 1) + all_links * c / all_chars + math.e)
            density[i] = c / t * max(0.0, math.log(c / lc * t / lt)) / math.log(base)
    for i in range(1, n):
        sums[tree.parents[i]] += density[i]
    return density, sums


def article_node(tree: Tree) -> int:
    """The root of the main text."""
    density, sums = densities(tree)
    live = [i for i in range(len(tree.tags)) if not tree.off[i]]
    best = max(live, key=lambda i: (sums[i], -i))
    threshold = min(density[i] for i in _up_to_body(tree, best))
    best = max((i for i in live if density[i] >= threshold), key=lambda i: (sums[i], -i))
    # An article keeps together: up to the enclosing article or main element.
    path = _up_to_body(tree, best)
    for name in ("article", "main"):
        for i in path:
            if tree.tags[i] == name:
                return i
    # Without one: up to the last node with sections beside the path, and to what also holds the heading.
    on = set(path)
    wide = {tree.parents[i] for i in live if i not in on and density[i] >= threshold}
    path = path[max((k for k, i in enumerate(path) if i in wide), default=0):]
    has = _holds_heading(tree)
    return next((i for i in path if has[i] and tree.tags[i] not in ("html", "body")), path[0])


def _up_to_body(tree: Tree, i: int) -> list[int]:
    path = [i]
    while tree.tags[i] != "body" and tree.parents[i] >= 0:
        i = tree.parents[i]
        path.append(i)
    return path


def _holds_heading(tree: Tree) -> list[bool]:
    has = [t in HEADINGS and not o for t, o in zip(tree.tags, tree.off, strict=True)]
    for i in range(len(has) - 1, 0, -1):
        if has[i]:
            has[tree.parents[i]] = True
    return has


def main_text(html: str) -> str:
    """The article's blocks in page order, white space collapsed, joined by \\n."""
    tree = Tree()
    tree.read(html)
    root = article_node(tree)
    inside = [False] * len(tree.tags)
    for i in range(root, len(tree.tags)):
        inside[i] = i == root or (tree.parents[i] >= root and inside[tree.parents[i]])
    blocks, now = [], []
    for node, text in tree.parts:
        if text is None:
            blocks.append("".join(now))
            now = []
        elif inside[node] and not tree.off[node]:
            now.append(text)
    blocks.append("".join(now))
    return "\n".join(b for b in (" ".join(x.split()) for x in blocks) if b)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(h.as_py() or "") for h in batch.column(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())],
                                         names=[*batch.schema.names[:-1], "text"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text: one row per page.

    Null and empty pages, and pages without an article, have the empty text; of
    several articles side by side the one with the densest text is the main one;
    pages are parsed whole; broken markup is read as far as it goes; repeated
    rows stay rows; an empty table gives no rows; other columns are not read.
    """
    ship(pages.sparkSession)
    slim = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    return slim.mapInArrow(_extract, T.StructType([slim.schema["page_id"], slim.schema["url"],
                                                   T.StructField("text", T.StringType())]))
