"""Main text of web pages: streaming parser events, text-to-tag ratio per line, Gaussian smoothing, threshold clustering.

Method. The standard library's streaming parser sends its events to a small builder, which closes elements that HTML closes
by itself and cuts the page into lines: a line is a block's run of text between block tags, with white space turned into
one space. Each line has a ratio, its characters of text outside links over its tags. The ratios are smoothed with a
Gaussian kernel in page order; lines whose smoothed ratio reaches the threshold, the deviation of the smoothed ratios, form
the content cluster. The cluster's lines vote, by their characters, for the content region: the article element that holds
the most of them, or else, walking down from the page's body, the element that still holds most of the cluster. The text is
every line of that region, however short, but for what is a menu, header, footer, sidebar, notice, advert, form, script,
style or reader comment, which an element says by its name, its role, or a class or id from the lists below; in a region
that is not an article, lists made of links go too.

Scale. One pass without a shuffle; a page is parsed on its own, and a batch holds at most ``BATCH_ROWS`` pages.

Defined cases: null html counts as empty; a page without text gives ``""`` and 0; unclosed, misnested and cut markup is
read as the parser reads it; repeated rows give repeated rows; other columns are ignored; an empty table gives an empty
result. A page header's headings stay only where the header lies inside the content region.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._text import small_batches

# Element names of HTML by what they do to a page's text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
DROPPED = frozenset(
    "aside audio button canvas datalist dialog fieldset footer form head iframe input map menu nav noscript object option script search select style svg template textarea title video".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre search section table ul".split()
)
#: Start tags that end an open element of the same list, up to the element that holds them.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tr", "td", "th", "thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"tr", "td", "th", "thead", "tbody", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
#: Roles, and words of a class or id, of what is not main text.
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
HINTS = frozenset(
    """ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion sidebar sidebars aside menu menus nav navbar
    navigation breadcrumb breadcrumbs pagination pager footer masthead topbar toolbar cookie cookies consent gdpr notice notices banner alert popup modal
    overlay disclaimer newsletter subscribe subscription signup login share sharing social related recommended recommendations comment comments commentlist disqus
    discussion reply replies respond skip hidden widget widgets""".split()
)
ARTICLE_HINTS = frozenset("article content main post entry story".split())
WHOLE = frozenset("html body main article".split())
_NOT = re.compile(r"^(has|with|no|without|is|not)[-_]", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

SIGMA = 2.0
#: Lines of a region of links: the share of link characters from which a list is a menu.
LINKS = 0.6


def _hints(value: str | None) -> set[str]:
    """The words of the classes of an attribute; a class such as ``with-sidebar`` is about another element."""
    return {w.lower() for c in (value or "").split() if not _NOT.match(c) for w in _WORDS.findall(c)}


class Lines(HTMLParser):
    """Elements (parent, name, dropped, article) and lines (element, text, tags, link characters) of a page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parent, self.name, self.dropped, self.article = [-1], ["#page"], [False], [False]
        self.open = [0]
        self.lines: list[tuple[int, str, int, int]] = []
        self._text: list[str] = []
        self._tags, self._links, self._in_link = 0, 0, 0

    # -- lines
    def _cut(self) -> None:
        if self._text:
            text = " ".join("".join(self._text).split())
            if text:
                block = next(e for e in reversed(self.open) if self.name[e] not in INLINE)
                self.lines.append((block, text, self._tags, min(self._links, len(text))))
                self._tags = 0
            self._text, self._links = [], 0

    def handle_data(self, data: str) -> None:
        if self.dropped[self.open[-1]]:
            return
        self._text.append(data)
        if self._in_link:
            self._links += len(data)

    # -- elements
    def _push(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        up = self.open[-1]
        a = dict(attrs)
        role = (a.get("role") or "").strip().lower()
        words = _hints(a.get("class")) | _hints(a.get("id"))
        inside = any(self.article[e] for e in self.open)
        gone = self.dropped[up] or tag in DROPPED or role in ROLES or "hidden" in a or (a.get("aria-hidden") or "").lower() == "true"
        gone = gone or bool(_HIDDEN.search(a.get("style") or "")) or (tag not in WHOLE and bool(words & HINTS))
        gone = gone or (tag == "article" and bool(words & {"comment", "comments", "reply", "related", "promo", "ad", "sponsored"}))
        if not inside:
            gone = gone or tag == "header" or (tag not in WHOLE and "header" in words and not words & ARTICLE_HINTS)
        self.parent.append(up)
        self.name.append(tag)
        self.dropped.append(gone)
        self.article.append(not gone and (tag in ("article", "main") or role in ("article", "main") or (a.get("itemprop") or "").lower() == "articlebody"))
        self.open.append(len(self.name) - 1)
        self._in_link += tag == "a"

    def _pop(self, k: int) -> None:
        """Close all open elements from place ``k`` on."""
        if any(self.name[e] not in INLINE or self.dropped[e] for e in self.open[k:]):
            self._cut()
        for e in self.open[k:]:
            self._in_link -= self.name[e] == "a"
        del self.open[k:]

    def _close(self, names, until) -> None:
        """Close the outermost open element of ``names`` above the nearest one of ``until``."""
        at = None
        for k in range(len(self.open) - 1, 0, -1):
            n = self.name[self.open[k]]
            if n in until:
                break
            if n in names:
                at = k
        if at is not None:
            self._pop(at)

    def handle_starttag(self, tag, attrs) -> None:
        self._tags += 1
        if tag in VOID:
            if tag in ("br", "hr"):
                self._cut()
            return
        if tag in CLOSES_P:
            self._close({"p"}, {"article", "div", "section", "main", "body", "td", "th", "li", "blockquote", "button", "object"})
        if tag in SIBLINGS:
            self._close(*SIBLINGS[tag])
        if tag == "a" and self._in_link:
            self._close({"a"}, {"body"})
        if tag == "body":
            self._close({"head"}, set())
        elif tag in ("html",) and len(self.open) > 1:
            return
        if tag not in INLINE:
            self._cut()
        self._push(tag, attrs)

    def handle_startendtag(self, tag, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("svg", "path", "iframe", "object"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag) -> None:
        self._tags += 1
        if tag == "br":
            self._cut()
        for k in range(len(self.open) - 1, 0, -1):
            n = self.name[self.open[k]]
            if n == tag:
                self._pop(k)
                return
            if tag in INLINE and n not in INLINE:
                return
            if n in ("table", "td", "th") and tag not in ("table", "tr", "tbody", "thead", "tfoot", "body", "html", "div", "article", "section", "main", "td", "th"):
                return

    def unknown_decl(self, data) -> None:
        """Marked sections hold no text."""

    def close(self) -> None:
        super().close()
        self._cut()


def smoothed(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Values under a Gaussian kernel cut at three deviations; at the ends the kernel is that of the values there are."""
    if not len(values):
        return values
    r = math.ceil(3 * sigma)
    kernel = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    total = np.convolve(values, kernel)[r : r + len(values)]
    return total / np.convolve(np.ones(len(values)), kernel)[r : r + len(values)]


def content_cluster(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Which lines belong to the content cluster: those whose smoothed ratio reaches the deviation of all of them."""
    s = smoothed(ratios, sigma)
    return s >= s.std() if len(s) else np.zeros(0, bool)


def _held(page: Lines, weight: np.ndarray) -> list[float]:
    """The characters that each element's lines hold, with those of the elements in it."""
    held = [0.0] * len(page.name)
    for (e, *_), w in zip(page.lines, weight.tolist(), strict=True):
        held[e] += w
    for e in range(len(held) - 1, 0, -1):  # parents come before their children
        held[page.parent[e]] += held[e]
    return held


def region(page: Lines, weight: np.ndarray) -> tuple[int, bool]:
    """The element that is the content region, and whether it is an article."""
    held = _held(page, weight)
    articles = [e for e in range(len(held)) if page.article[e] and held[e]]
    if articles:
        top = max(articles, key=lambda e: (held[e], -e))
        for e in articles:  # an article in a main part, unless the part's own heading stands beside it; not one card of many
            if e > top and held[e] >= 0.9 * held[top] and not any(page.name[x] == "h1" and page.parent[x] == top for x in range(top, len(held))):
                top = e
        return top, True
    children: dict[int, list[int]] = {}
    for e in range(1, len(held)):
        children.setdefault(page.parent[e], []).append(e)
    headed = {page.parent[e] for e in range(len(held)) if page.name[e] in HEADINGS and not page.dropped[e]}
    at = 0
    while best := max(children.get(at, []), key=lambda e: held[e], default=None):
        if held[best] < 0.7 * held[at] or page.name[best] in ("p", "pre", "li", "td", "tr", "tbody", "ul", "ol", "blockquote", *HEADINGS, *INLINE):
            break
        if at in headed and page.name[at] not in ("body", "#page", "html"):  # its heading stands beside the text
            break
        at = best
    return at, False


def main_text(html: str | None, sigma: float = SIGMA) -> str:
    """The main text of one page."""
    page = Lines()
    html = html or ""
    at = html.rfind("<!--")
    if at > html.rfind("-->") and "</" not in html[at:]:  # a comment without an end hides the rest
        html = html[:at]
    page.feed(html)
    page.close()
    if not page.lines:
        return ""
    size = np.array([len(t) for _, t, _, _ in page.lines], float)
    links = np.array([k for *_, k in page.lines], float)
    ratios = (size - links) / np.array([max(1, n) for _, _, n, _ in page.lines])
    chosen = content_cluster(ratios, sigma)
    allowed = np.array([not page.dropped[e] for e, *_ in page.lines])
    weight = np.where(allowed & chosen, size - links, 0)
    if not weight.any():
        weight = np.where(allowed, size, 0)
    top, article = region(page, weight)

    within = [False] * len(page.name)
    within[top] = True
    for e in range(top + 1, len(within)):
        within[e] = within[page.parent[e]] and not page.dropped[e]
    if not article:
        lists = [e for e in range(len(within)) if within[e] and page.name[e] in ("ul", "ol", "table")]
        every, linked = _held(page, size), _held(page, links)
        gone = {e for e in lists if every[e] and linked[e] >= LINKS * every[e]}
        for e in range(top + 1, len(within)):
            within[e] = within[e] and e not in gone and within[page.parent[e]]
    return " ".join(t for (e, t, _, _), ok in zip(page.lines, allowed.tolist(), strict=True) if ok and within[e])


def html_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", sigma: float = SIGMA) -> DataFrame:
    """One row per row of ``pages``: ``page_id, url, text, n_chars``."""
    small_batches(pages.sparkSession)
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"), F.col(f"`{html_col}`").cast("string").alias("html"))

    def run(batches):
        for b in batches:
            text = [main_text(h, sigma) for h in b.column("html").to_pylist()]
            cols = [b.column("page_id"), b.column("url"), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=["page_id", "url", "text", "n_chars"])

    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("page_id", "url")}
    return rows.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
