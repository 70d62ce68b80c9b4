"""Main text of web pages by line-block distribution.

Markup is stripped into lines: every block element begins a new one; what separates two blocks is no
line. What is not text (scripts, styles, comments of the markup) or not article (menus, page headers,
footers, sidebars, notices, adverts, forms, reader comments, told by element, role, class or id)
leaves one empty line, however many follow each other; repeated line breaks leave one each. The
length of each line is summed over a sliding window of ``WINDOW`` lines. Text begins at a surge
(the window's sum rises above the threshold) or with the filled lines right before it, and ends at a
dive (the window is empty again); what lies between is kept, in page order.

Where a page marks its article (``article`` or ``main``), lines outside of it count as empty and any
text is a surge. Elsewhere the threshold is ``SURGE`` characters, less on pages with little text (a share
of the highest sum), so long blocks don't raise it; lines that are mostly links count as empty, so
short loose lines after a menu or at the end of a page don't make a surge.

A class, id or role tells such a part by its whole name or its head word (``cookie-banner``, ``ad-slot``; not
``related-work``), unless the name is about a layout (``has-sidebar``). Where a part so told holds ``main``, text begins
there. Where it holds ``article`` and no ``article`` stands elsewhere, the page is read again with text beginning there,
except in lists of other texts (comments, related pages, adverts); the longer text counts. If there is no text at
all, the page is read once more without that exception.

Character references are decoded, white space inside a block becomes one space, blocks are joined by
one space. Tags that are cut off at the end of a page are markup; elements that are never closed end
with the page, or where the article begins. NULL and empty pages have an empty text. NULL ids and
URLs and repeated rows are passed like others; an empty table gives no rows.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import per_batch, texts_of

WINDOW, SURGE, SHARE, LINKS = 3, 60, 0.15, 0.5

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|iframe|svg|select|textarea|object|title)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>"
    r"|<[!?][^>]*>"
    r"|<[/!?a-z][^<>]*\Z",
    re.S | re.I,
)
HINTS = re.compile(r"""\b(?:class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
ARTICLE = frozenset(["article", "main"])
#: Elements that are no article, wherever they stand.
ASIDE = frozenset("head nav footer aside form menu dialog button".split())
#: Words of a class, id or role that mark such a part; also as the head of a hyphenated name.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus"
    " footer masthead menu modal nav navbar navigation newsletter notice notices popup promo related search share sharing sidebar"
    " social sponsor sponsored subscribe toolbar widget".split()
)
#: The same, but only as a whole name: an article may have a header of its own.
WHOLE_MARKS = frozenset(["header", "contentinfo", "complementary", "alert"])
#: Words after the head that only say what holds the part, like numbers.
HOLDERS = frozenset(
    "area articles bar block box button buttons container form icons inner item items link links list posts section slot stories unit wrap wrapper".split()
)
#: Words of names that are about a page's layout or state.
LAYOUT = frozenset("column columns content disabled enabled for has have hide layout no not template with without".split())
#: Marks of parts whose articles are texts other than the page's own.
LISTS = frozenset(
    "ad ads advert adverts advertisement advertising comment comments disqus popular promo related sponsor sponsored widget".split()
)


def _mark_of(name: str) -> str:
    """The mark that a class, id or role has for its head word, or nothing."""
    if name in MARKS or name in WHOLE_MARKS:
        return name
    words = [w for w in re.split(r"[-_]+", name) if w]
    if not LAYOUT.isdisjoint(words):
        return ""
    while words and (words[-1] in HOLDERS or words[-1][0].isdigit()):
        words.pop()
    return words[-1] if words and words[-1] in MARKS else ""


def _aside(tag: str, attributes: str, in_article: bool) -> str:
    """The tag or mark that tells that an element is no article, or nothing."""
    if tag in ASIDE or (tag == "header" and not in_article):
        return f"<{tag}>"
    if tag in ARTICLE or tag in ("html", "body") or "=" not in attributes:
        return ""
    marks = [_mark_of(name) for found in HINTS.finditer(attributes) for name in (found[1] or found[2] or found[3] or "").lower().split()]
    return next((m for m in marks if m in LISTS), "") or next(filter(None, marks), "")


def lines_of(html: str, shut: frozenset[str] = MARKS | WHOLE_MARKS) -> tuple[list[tuple[str, int, bool]], bool, bool]:
    """``(text, letters inside links, in an article)`` of each line, whether the page marks an article, and whether
    the only ``article`` elements stand in parts told by a mark in ``shut``, which stay out."""
    lines: list[tuple[str, int, bool]] = []
    parts: list[str] = []
    linked = at = 0
    open_tags: list[str] = []
    counts: dict[str, int] = {}
    skip_from = -1  # depth of the outermost element that is no article
    skip_mark = ""
    in_article = in_link = 0
    marked = found = shut_in = False

    def end_line():
        nonlocal linked
        if text := " ".join(unescape("".join(parts)).split()):
            lines.append((text, linked, in_article > 0))
        parts.clear()
        linked = 0
        return text

    def end_with_gap():
        end_line()
        if lines and lines[-1][0]:
            lines.append(("", 0, in_article > 0))

    def text_until(stop: int):
        nonlocal linked
        if stop > at and skip_from < 0:
            parts.append(html[at:stop])
            if in_link:
                linked += len("".join(html[at:stop].split()))

    def close(depth: int):
        nonlocal skip_from, in_article, in_link
        while len(open_tags) > depth:
            gone = open_tags.pop()
            counts[gone] -= 1
            if skip_from < 0 or len(open_tags) < skip_from:
                in_article -= gone in ARTICLE
                in_link -= gone == "a"
        if skip_from >= 0 and len(open_tags) <= skip_from:
            skip_from = -1

    for token in TOKEN.finditer(html):
        text_until(token.start())
        at = token.end()
        tag = (token[3] or "").lower()
        if not tag:
            if token[1] and skip_from < 0:
                end_with_gap()
            continue
        if token[2]:
            if counts.get(tag):
                depth = len(open_tags) - 1
                while open_tags[depth] != tag:
                    depth -= 1
                if skip_from < 0 and tag not in INLINE:
                    end_line()
                close(depth)
            elif tag not in INLINE and skip_from < 0:
                end_line()
            continue
        if skip_from >= 0 and tag in ARTICLE and not in_article and open_tags[skip_from] in ("head", "header", "nav"):
            close(skip_from)  # a menu that was never closed ends where the article begins
        elif skip_from >= 0 and tag in ARTICLE and skip_mark[0] != "<" and (tag == "main" or not counts.get("article")):
            if tag == "main" or skip_mark not in shut:
                in_link += open_tags[skip_from:].count("a")
                in_article += sum(t in ARTICLE for t in open_tags[skip_from:])
                skip_from = -1
            else:
                shut_in = True
        if skip_from < 0 and tag not in INLINE and not end_line() and tag == "br":
            lines.append(("", 0, in_article > 0))
        if tag in VOID or token[4].endswith("/"):
            continue
        aside = _aside(tag, token[4], in_article > 0) if skip_from < 0 else ""
        open_tags.append(tag)
        counts[tag] = counts.get(tag, 0) + 1
        if aside:
            end_with_gap()
            skip_from, skip_mark = len(open_tags) - 1, aside
        elif skip_from < 0:
            if tag in ARTICLE:
                in_article += 1
                marked = True
                found |= tag == "article"
            in_link += tag == "a"
    text_until(len(html))
    end_line()
    return lines, marked, shut_in and not found


def between_surges_and_dives(lengths: list[int], marked: bool, window: int = WINDOW) -> list[bool]:
    """Which lines lie between a surge and the dive after it."""
    n = len(lengths)
    sums = [sum(lengths[i : i + window]) for i in range(n)]
    threshold = 0 if marked else min(SURGE, SHARE * max(sums, default=0))
    kept, inside = [False] * n, False
    for i in range(n):
        if not inside and lengths[i] and sums[i] > threshold:
            inside = True
            before = i - 1
            while before >= 0 and lengths[before] and not kept[before]:
                kept[before] = True
                before -= 1
        elif inside and not sums[i]:
            inside = False
        kept[i] = inside
    return kept


def main_text(html: str) -> str:
    lines, marked, shut_in = lines_of(html)
    text = _text_of(lines, marked)
    if shut_in:
        lines, marked, _ = lines_of(html, LISTS)
        text = max(text, _text_of(lines, marked), key=len)
    if shut_in and not text:
        lines, marked, _ = lines_of(html, frozenset())
        text = _text_of(lines, marked)
    return text


def _text_of(lines: list[tuple[str, int, bool]], marked: bool) -> str:
    lengths = []
    for text, linked, in_article in lines:
        counted = len(text)
        if marked and not in_article or not marked and linked > LINKS * len("".join(text.split())):
            counted = 0
        lengths.append(counted)
    kept = between_surges_and_dives(lengths, marked)
    return " ".join(text for (text, _, _), length, keep in zip(lines, lengths, kept, strict=True) if keep and length)


def extract(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    kinds = dict(pages.dtypes)
    schema = f"page_id {kinds[id_col]}, url {kinds[url]}, text string, n_chars long"

    def make():
        def work(batch):
            texts = [main_text(h) for h in texts_of(batch.column("html"))]
            return {"text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())}

        return work

    return pages.select(F.col(id_col).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html")).mapInArrow(per_batch(make, schema), schema)
