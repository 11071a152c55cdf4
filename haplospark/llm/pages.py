"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one per block element. Lines of menus, headers, footers,
sidebars, notices, adverts, forms and comments count for nothing, and so does the text of
links; where a page marks its article, so does everything outside. Lengths are then summed
over sliding windows of lines. A surge is a window that reaches the threshold, a dive the
next one that falls to nothing; the lines between are the text. With a marked article any
length is a surge. Without one it takes ``SURGE`` characters, or any length where no window of
the page has as many; other lines of an element in which a window surged belong to it, however
short, also behind a gap.

An element is furniture by its kind, or by a word of its class, id or role: one of ``MARKS``, or
one put together of these and of ``PLACES`` only. Other compounds, such as ``related-work``,
say nothing. Paragraphs and headings go by class and role, as their ids are anchors.

Defined cases: null, empty and text-free pages have an empty text; unclosed elements end
with their parents, a dropped one at the latest where an article starts, a dropped paragraph or
heading at the next block; a page without any markup is one block; null or repeated ids each
give a row.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haplospark.llm.common import map_batches

WINDOW = 3
SURGE = 80

# Element names of the HTML standard, and words that name page furniture.
RAW = {"script", "style", "template", "noscript", "iframe", "svg", "textarea", "title", "canvas"}
FURNITURE = {"nav", "footer", "aside", "form", "header", "menu", "dialog", "button", "select", "fieldset"}
MAIN = {"article", "main"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "center", "dd", "details", "div", "dl", "dt",
    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr",
    "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "summary",
    "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
MARKS = {
    "ad", "ads", "advert", "adverts", "advertisement", "adsense", "sponsor", "sponsored", "promo",
    "promotion", "banner", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert", "popup",
    "modal", "overlay", "newsletter", "subscribe", "nav", "navbar", "navigation", "menu", "breadcrumb",
    "breadcrumbs", "sidebar", "aside", "widget", "related", "recommended", "share", "sharing", "social",
    "header", "masthead", "footer", "comment", "comments", "disqus", "replies", "form", "login", "search",
    "pagination", "pager", "toolbar", "complementary", "contentinfo", "skip",
}
#: Words that say where furniture stands, or of what form it is.
PLACES = {
    "area", "bar", "bottom", "box", "container", "global", "inner", "inline", "item", "left", "link", "links", "list",
    "main", "outer", "page", "post", "posts", "primary", "reader", "right", "secondary", "section", "site", "slot",
    "text", "thread", "top", "unit", "user", "wrap", "wrapper",
}
KEPT = {"html", "body", "article", "main"}
LEAVES = {"p", "h1", "h2", "h3", "h4", "h5", "h6"}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*+)"
    r"(?P<attributes>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>",
    re.DOTALL,
)
_NAMED = re.compile(r"(?:^|(?<=\s))(class|id|role)\s*=\s*(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++))", re.IGNORECASE)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none", re.IGNORECASE)
_PARTS = re.compile(r"[A-Za-z]+|\d+")


def _is_furniture(name: str, attributes: str, in_main: bool) -> bool:
    if name in FURNITURE:
        return not (name == "header" and in_main)
    if not attributes or name in KEPT:
        return False
    if _HIDDEN.search(attributes):
        return True
    for kind, *values in _NAMED.findall(attributes):
        if kind.lower() == "id" and name in LEAVES:
            continue
        for word in "".join(values).split():
            parts = [part.lower() for part in _PARTS.findall(word)]
            if MARKS.intersection(parts) and all(p in MARKS or p in PLACES or p.isdigit() for p in parts):
                return True
    return False


class _Lines:
    """Collects blocks as (text, length that counts, element around it, inside a marked article)."""

    def __init__(self):
        self.lines: list[tuple[str, int, int, bool]] = []
        self.parts: list[str] = []
        self.linked = self.links = self.mains = self.elements = 0
        self.open: list[tuple[str, int]] = [("", 0)]

    def enter(self, name: str) -> None:
        """An element that holds blocks begins."""
        self.elements += 1
        self.open.append((name, self.elements))

    def leave(self, name: str) -> None:
        """It ends, and with it what was left open inside."""
        for at in range(len(self.open) - 1, max(len(self.open) - 100, 0), -1):
            if self.open[at][0] == name:
                del self.open[at:]
                return

    def add(self, text: str) -> None:
        text = entities.unescape(text)
        self.parts.append(text)
        if self.links:
            self.linked += len("".join(text.split()))

    def end_block(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append((text, max(len(text) - self.linked, 0), self.open[-1][1], self.mains > 0))
        self.parts, self.linked, self.links = [], 0, 0

    def gap(self) -> None:
        """Empty lines, wide enough that window sums fall to nothing."""
        self.end_block()
        self.lines.extend([("", 0, -1, False)] * WINDOW)


def page_lines(html: str) -> tuple[list[tuple[str, int, int]], bool]:
    """Lines of a page, and whether it marks its article; if so, others are empty."""
    out, marked = _Lines(), False
    dropped, depth, nested, at = "", 0, 0, 0
    while tag := _TAG.search(html, at):
        if not dropped and tag.start() > at:
            out.add(html[at : tag.start()])
        at, name, closing = tag.end(), (tag["name"] or "").lower(), bool(tag["end"])
        attributes = tag["attributes"] or ""
        if not name:
            continue
        if name in RAW and not closing:
            end = re.compile(rf"</{name}\b", re.IGNORECASE).search(html, at)
            if end or name in ("script", "style"):
                at = end.start() if end else len(html)
            continue
        if dropped in LEAVES and name in BLOCKS and not (closing and name == dropped):
            dropped = ""  # a paragraph ends where another block starts or its parent ends
        if dropped:
            if name == dropped:
                depth += -1 if closing else 1
                if depth:
                    continue
                dropped = ""
                if not out.mains:
                    out.gap()
                continue
            if name not in MAIN:
                continue
            if closing and not nested and out.mains:
                dropped = ""  # ended by its parent
            elif not closing and not marked:
                dropped = ""  # never closed: the article starts here
            else:
                nested = max(nested + (-1 if closing else 1), 0)
                continue
        if closing:
            if name == "a":
                out.links = max(out.links - 1, 0)
            elif name in MAIN:
                out.gap()
                out.mains = max(out.mains - 1, 0)
            elif name in BLOCKS:
                out.end_block()
                if name not in LEAVES:
                    out.leave(name)
        elif name in MAIN and not _is_furniture("div", attributes, False):
            out.gap()
            out.mains, marked = out.mains + 1, True
        elif name in MAIN or _is_furniture(name, attributes, out.mains > 0):
            if name in VOID:
                continue
            if out.mains:
                out.end_block()
            else:
                out.gap()
            dropped, depth, nested = name, 1, 0
        elif name == "br":
            out.add(" ")
        elif name == "a":
            out.links += 1
        elif name in BLOCKS:
            out.end_block()
            if name not in LEAVES and name not in VOID:
                out.enter(name)
    if not dropped:
        out.add(html[at:])
    out.end_block()
    return [(t, size, where) if inside or not marked else ("", 0, -1) for t, size, where, inside in out.lines], marked


def text_between(lines: list[tuple[str, int, int]], surge: int, window: int = WINDOW) -> list[str]:
    """Texts of the lines from each surge of the window sums to the next dive.

    Lines of an element in which a window surged are a surge of their own.
    """
    sizes = [size for _, size, _ in lines] + [0] * window
    sums = [sum(sizes[at : at + window]) for at in range(len(lines))]
    least = surge if max(sums, default=0) >= surge else 1
    surged = {where for (_, size, where), total in zip(lines, sums, strict=True) if size and total >= least}
    inside, kept = False, []
    for (text, size, where), total in zip(lines, sums, strict=True):
        if not inside and size and (total >= least or where in surged):
            inside = True
        if inside and not total:
            inside = False
        if inside and text:
            kept.append(text)
    return kept


def main_text(html: str) -> str:
    """The main text of a page, one line per block."""
    lines, marked = page_lines(html)
    return "\n".join(text_between(lines, 1 if marked else SURGE))


def _extracted(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = [main_text(page.as_py() or "") for page in batch.column("_html")]
    return pa.RecordBatch.from_arrays(
        [*batch.columns[:-1], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
        [*batch.schema.names[:-1], "text", "n_chars"],
    )


def extract_pages(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, its main text and the text's code points."""
    narrow = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.col("html").alias("_html"))
    return map_batches(narrow, _extracted, "page_id bigint, url string, text string, n_chars bigint")
