"""Main-text extraction from HTML by tag-path ratios.

A page is cut into blocks: stretches of text between block-level tags. Each
block has a root-to-leaf path of its open block elements. For every path the
text length, the punctuation and the linked text of its blocks are aggregated
and divided by the number of blocks (text ratio, punctuation ratio). The two
ratios are smoothed over neighbouring blocks of the page, fused as a product,
damped by the share of linked text, and paths at or above a threshold are
content. Elements whose role rules content out (menus, scripts, hidden ones)
never score; neither do those whose class or id names such a role (adverts,
comments, sidebars) or forms, unless they hold the page's text: see ``_resolve``.

A content path below an article container brings in the container's other
blocks too (headings, short list items), as they belong to the same text.

Defined cases: null or empty html gives empty text; a page without a content
path falls back to its best-scoring path among the blocks barred by a name or a
form, or empty text if no block outside menus and the like has text;
unclosed elements are closed as in HTML (a new paragraph or list item closes
the one before it); every input row gives one result row; other columns are
ignored. Work on a page is linear in its length.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from barframe.llm.common import chunks, python_batches, read

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|iframe|svg|math|select|title)\b[^>]*(?<!/)>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S | re.I)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|itemprop|aria-label)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?", re.I)

# Fixed values of HTML: elements without an end tag, elements that flow inside
# a block, and elements that a following start tag closes.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
          "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time",
          "tt", "u", "var", "wbr", "img"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead", "tbody"}}
STOPS = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "thead": {"table"}, "tbody": {"table"}}
LISTS = {"address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figure", "footer", "form",
         "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"}

#: Elements and roles that can't be article text, whatever they hold.
NO_CONTENT = {"nav", "aside", "footer", "button", "head", "dialog", "menu", "object", "audio", "video", "canvas",
              "fieldset", "input", "select", "option", "datalist", "map", "applet"}
#: Names of such a role in a class or id, tested token by token.
NO_CONTENT_NAME = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner\w*|nav\w*|menu\w*|breadcrumb\w*|sidebar\w*|side|"
    r"footer\w*|foot|masthead|topbar|header|cookie\w*|consent|notice\w*|gdpr|popup|modal|overlay|newsletter\w*|subscri\w*|"
    r"signup|login|share\w*|sharing|social\w*|comment(?!ar)\w*|respond|replies|reply|disqus\w*|related\w*|recommend\w*|"
    r"pagination|pager|widget\w*|toolbar|search\w*|tags|toc|skip\w*|alert|paywall|hidden|sr-only)(?=$|[\s_-])", re.I)
#: Tokens that say what a page or its parts do or have, not what the element is.
MODIFIER = re.compile(r"(?:with|without|has|have|no)[_-].*|.*[_-](?:open|opened|closed|enabled|disabled)", re.I)
#: The end of a token that says where the element is or which of several.
PLACE = re.compile(r"(?:[_-]+(?:left|right|top|bottom|primary|secondary|first|last|\d+))+$", re.I)
#: A heading block of the text itself.
HEADING = re.compile(r"(?:entry|post|article|page|content|story|single)[_-]+header(?:[_-].*)?", re.I)
NO_CONTENT_ROLE = {"navigation", "banner", "complementary", "contentinfo", "search", "form", "alert", "dialog", "menu", "menubar"}
CONTAINERS = {"article", "main", "section", "div", "td", "blockquote"}
ROOTS = {"html", "body"}
PUNCTUATION = re.compile(r"[.,;:!?\"'()’“”。，、！？¿¡]")
SPACE = re.compile(r"\s+")

#: Weights of the smoothing window over neighbouring blocks, and the least
#: share of the best path's score that makes a path content.
SMOOTH = np.array([0.25, 0.5, 0.25])
THRESHOLD = 0.1
CHUNK = 4 << 20


class _Element:
    __slots__ = ("tag", "path", "barred", "key", "soft", "outer")

    def __init__(self, tag: str, name: str, parent: "_Element | None", barred: bool, key: int, soft: tuple = ()):
        self.tag, self.barred, self.key = tag, barred or bool(parent and parent.barred), key
        self.path = f"{parent.path if parent else ''}/{tag}{name}"
        # bars by name or form, own and inherited; those outside the innermost article
        self.soft = (parent.soft if parent else ()) + soft
        self.outer = len(parent.soft) if parent and tag in ("article", "main") else parent.outer if parent else 0


def _name_bars(value: str) -> tuple:
    """(role word, whether the token is only about it) for each class or id token that names a role."""
    found = []
    for token in value.split():
        m = NO_CONTENT_NAME.search(token)
        if m and not HEADING.fullmatch(token):
            word = m[0].strip("_-").lower()
            if word == token.lower() or not MODIFIER.fullmatch(token):
                # the last word of a token says what the element is; "widget" is also used for any part of a page
                last = NO_CONTENT_NAME.search(re.split(r"[_-]+", PLACE.sub("", token))[-1])
                found.append((word, bool(last) and (word == token.lower() or not word.startswith("widget"))))
    return tuple(found)


def _attributes(tag: str, rest: str) -> tuple[str, bool, tuple]:
    """(class part of the path, whether the element can't hold content, bars by name or form)."""
    name, barred, soft = "", tag in NO_CONTENT, (("form", False),) if tag == "form" else ()
    if rest and not rest.isspace():
        for m in ATTRIBUTE.finditer(rest):
            what, value = m[1].lower(), (m[2] or m[3] or m[4] or "")
            if what == "class" and value:
                name = "." + ".".join(value.split())
            if what in ("class", "id") and tag not in ROOTS and tag != "article":
                soft += _name_bars(value)
            elif what == "role":
                if value.lower() == "form":
                    soft += (("form", False),)
                else:
                    barred |= value.lower() in NO_CONTENT_ROLE
            elif what == "hidden":
                barred = True
            elif what == "aria-hidden":
                barred |= value.lower() == "true"
    return name, barred, soft


def _resolve(found: list[tuple]) -> list[tuple[str, int, str, int, bool, bool]]:
    """Blocks with their bars settled: (path, key, text, linked, barred, soft); soft if only names or forms bar it.

    A bar that isn't a role of its own ("widget-area", a form) doesn't hold if
    elements barred by that word have most of the page's text. Bars outside an
    article or main element don't hold in it, if the page has none that is free."""
    total, by_word = 0, {}
    for _, _, text, _, hard, soft, _ in found:
        if not hard:
            total += len(text)
            for word in {w for w, whole in soft if not whole}:
                by_word[word] = by_word.get(word, 0) + len(text)
    most = {w for w, n in by_word.items() if 2 * n > total}
    held = [[whole or w not in most for w, whole in soft] for _, _, _, _, _, soft, _ in found]
    article = [bool(re.search(r"/(?:article|main)\b", b[0])) for b in found]
    free = any(a and not b[4] and not any(h) for a, b, h in zip(article, found, held))
    out = []
    for (path, key, text, linked, hard, soft, outer), inside, h in zip(found, article, held):
        named = any(h if free or not inside else h[outer:])
        out.append((path, key, text, linked, hard or named, named and not hard))
    return out


def blocks(page: str) -> list[tuple[str, int, str, int, bool, bool]]:
    """(path, key of the parent element, text, linked characters, barred, barred by name or form only) of each block, in page order."""
    stack = [_Element("", "", None, False, 0)]
    out, piece, linked, in_link, barred_inline = [], [], 0, 0, []
    keys = 0

    def flush() -> None:
        nonlocal linked
        text = SPACE.sub(" ", entities.unescape("".join(piece))).strip()
        if text:
            top = stack[-1]
            parent = stack[-2] if len(stack) > 1 else top
            out.append((top.path, parent.key, text, linked, top.barred, top.soft, top.outer))
        piece.clear()
        linked = 0

    def say(text: str) -> None:
        nonlocal linked
        if text and not barred_inline:
            piece.append(text)
            if in_link:
                linked += len(text.strip())

    at = 0
    for m in TOKEN.finditer(page):
        say(page[at:m.start()])
        at = m.end()
        if not m["tag"]:
            if page.startswith("<![CDATA[", m.start()):
                say(page[m.start() + 9:m.end()].removesuffix("]]>"))
            continue
        tag = m["tag"].lower()
        if tag == "br":
            piece.append(" ")
            continue
        if tag in INLINE:
            if tag == "a":
                in_link = 0 if m["end"] else 1
            if m["end"]:
                if barred_inline and barred_inline[-1] == tag:
                    barred_inline.pop()
            elif tag not in VOID and not m["rest"].endswith("/") and m["rest"]:
                if barred_inline or any(_attributes(tag, m["rest"])[1:]):
                    barred_inline.append(tag)
            elif barred_inline and tag not in VOID:
                barred_inline.append(tag)
            continue
        flush()
        in_link, barred_inline = 0, []
        if m["end"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if tag == "p" and stack[i].tag in LISTS:
                    break
        else:
            if tag in LISTS and stack[-1].tag == "p":
                stack.pop()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in STOPS.get(tag, ()):
                    break
                if stack[i].tag in CLOSES.get(tag, ()):
                    del stack[i:]
                    break
                if stack[i].tag in LISTS and tag not in STOPS:
                    break
            if tag not in VOID and not m["rest"].endswith("/"):
                keys += 1
                name, barred, soft = _attributes(tag, m["rest"])
                # a page header has no content; the header of an article may hold its heading
                barred |= tag == "header" and not any(e.tag in ("article", "main") for e in stack)
                stack.append(_Element(tag, name, stack[-1], barred, keys, soft))
    say(page[at:])
    flush()
    return _resolve(out)


def extract(page: str | None) -> str:
    """Main text of a page: its content blocks in page order, joined by one space."""
    found = blocks(page.replace("\x00", "")) if page else []
    if not found:
        return ""
    text = _content(found, [b[4] for b in found])
    if not text and any(b[5] for b in found):
        text = _content(found, [b[4] and not b[5] for b in found])
    return text


def _content(found: list[tuple], barred: list[bool]) -> str:
    index: dict[str, int] = {}
    path = np.array([index.setdefault(b[0], len(index)) for b in found])
    chars = np.array([len(b[2]) for b in found], float)
    marks = np.array([len(PUNCTUATION.findall(b[2])) for b in found], float)
    linked = np.minimum(np.array([b[3] for b in found], float), chars)
    barred = np.array(barred)
    per = np.maximum(np.bincount(path), 1)
    text_ratio = (np.bincount(path, chars) / per)[path]
    mark_ratio = ((np.bincount(path, marks) + 1) / per)[path]
    open_share = (1 - np.bincount(path, linked) / np.maximum(np.bincount(path, chars), 1))[path]
    free = ~barred
    smooth = np.zeros((2, len(found)))
    for row, x in zip(smooth, (text_ratio, mark_ratio)):
        y = x[free]
        if len(y):
            row[free] = np.convolve(np.concatenate((y[:1], y, y[-1:])), SMOOTH, "valid")
    block_score = smooth[0] * smooth[1] * open_share ** 2 * free
    path_score = np.bincount(path, block_score) / per
    if not path_score.max() > 0:
        return ""
    content = path_score >= THRESHOLD * path_score.max()
    chosen = content[path] & free
    # the containers of the content bring in their other blocks
    holder = np.array([b[1] for b in found])
    parent_path = [b[0].rpartition("/")[0] for b in found]
    holds = {h for h, p, c in zip(holder, parent_path, chosen)
             if c and p.rpartition("/")[2].partition(".")[0] in CONTAINERS}
    chosen |= np.array([h in holds for h in holder]) & free
    main = [p for p, c in zip(parent_path, chosen) if c and re.search(r"/(article|main)\b", p)]
    if main:  # with an article element, content lies in one
        chosen &= np.array([bool(re.search(r"/(article|main)\b", b[0])) for b in found])
        if len(main) and any(content[path] & free & chosen):
            chosen |= np.array([bool(re.search(r"/article\b", b[0])) for b in found]) & free & (open_share > 0.5)
    return " ".join(b[2] for b, c in zip(found, chosen) if c)


def _extract_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "html", CHUNK):
        texts = [extract(p) for p in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"])


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of (page_id, url, html)."""
    python_batches(pages)
    return pages.select("page_id", "url", "html").mapInArrow(_extract_batches, "page_id bigint, url string, text string, n_chars bigint")


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_pages(read(spark, sf_dir, "pages", "page_id", "url", "html"))
