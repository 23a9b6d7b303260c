"""Operator 2: main text of web pages by line-block distribution.

``blocks`` strips the markup of a whole page: one line per block of text, in
page order.  Text in scripts, styles, menus, headers, footers, sidebars,
forms, adverts, notices and reader comments is left out, and each such
element leaves ``WINDOW`` empty lines, unless it stands in a container that has
text before it (an advert between two paragraphs parts nothing), as does every
text outside the article element when the page has one.  A class or id hides an
element only by a whole token of marking words (``sidebar``, ``cookie-notice``,
``site-footer``), not by one that mentions a mark (``has-sidebar``).  ``main_text`` then works on line lengths only:

* the block length of a line is the sum of the text lengths of the lines in a
  window of ``WINDOW`` lines that starts there (links count nothing);
* a surge point is a line whose block length rises above the threshold and does
  not fall to zero at once; a dive point is where the block length gets to zero;
* the lines between surge and dive points are kept, of the region with most
  text and of those with at least ``SHARE`` of it.

Inside an article element there are no other regions than its own, so short
paragraphs between long ones, or at its ends, stay.  Of several article elements
the one with most text is the page's; the others (teasers, readers' comments) go,
also where they stand inside it.  What a main element holds beside them stays.

Defined results: null and empty pages have an empty text; a page cut off in
the middle counts as closed at its end; unknown tags are ignored; references
that HTML does not define stay as they are; repeated rows give repeated rows.
"""
from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

WINDOW = 3
THRESHOLD = 40   # characters of a window at a surge point outside an article element
SHARE = 0.2

# Fixed lists: elements of HTML by their part in a page.
RAW = ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "template", "noscript", "svg", "math")
DROPPED = ("nav", "header", "footer", "aside", "form", "button", "select", "option", "menu", "dialog", "head", "object", "label",
           "input", "fieldset", "datalist", "canvas", "audio", "video", "map")
INLINE = ("a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd",
          "mark", "meter", "output", "picture", "progress", "q", "rp", "rt", "ruby", "s", "samp", "small", "source", "span", "strike", "strong",
          "sub", "sup", "time", "tt", "u", "var", "wbr", "center", "embed", "track", "param")
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr", "keygen")
MARKS = frozenset((
    "ad ads advert adverts advertisement advertising banner promo promoted promotion sponsor sponsored cookie cookies consent "
    "gdpr notice notices popup modal overlay newsletter subscribe subscription signup login sidebar side widget widgets nav navbar navigation "
    "menu menus breadcrumb breadcrumbs pager pagination footer header masthead topbar toolbar share sharing social related recommended "
    "comment comments commentlist respond reply replies disqus outbrain taboola skip teaser teasers").split())
# words that may stand beside a mark in a token and change nothing
BESIDE = frozenset((
    "site page main global primary secondary top bottom left right upper lower mobile desktop sticky fixed box area slot block bar list items item "
    "links link unit container wrapper wrap inner outer section panel form buttons button icons media user users reader readers visitor visitors guest guests thread threads count area hint box boxes bars posts articles stories post article to the by").split())
ROLES = ("navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "form", "menu", "menubar", "alert")
MAIN = ("article", "main")

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z](?:[^>\"']|\"[^\"]*\"|'[^']*')*(?:>|\Z)|</?[a-zA-Z][^>]*(?:>|\Z)", re.S)
NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)")
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""")
BLANK = re.compile(r"\s+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")  # cookieBanner is a cookie banner
# a start tag of these closes an open element of the same or the listed kind
CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}


def _marked(value: str) -> bool:
    """Whether a whole token of a class or id consists of marks, words beside them and numbers."""
    for token in CAMEL.sub("-", value).lower().split():
        parts = [x for x in re.split(r"[_-]+", token) if x]
        if any(x in MARKS for x in parts) and all(x in MARKS or x in BESIDE or x.isdigit() for x in parts):
            return True
    return False


def _heads(page: str, at: int) -> bool:
    """Whether the header element whose content begins at ``at`` holds a first-level heading."""
    end = re.compile(r"</header\b", re.I).search(page, at)
    return bool(re.compile(r"<h1(?=[\s>/])", re.I).search(page, at, end.start() if end else len(page)))


def _hidden(name: str, tag: str) -> bool:
    """Whether an element with these attributes is not part of an article."""
    if name in DROPPED:
        return True
    if " " not in tag and "\n" not in tag and "\t" not in tag:
        return False
    for key, *values in ATTRIBUTE.findall(tag):
        value = next((v for v in values if v), "")
        key = key.lower()
        if (key in ("class", "id") and _marked(value)) or (key == "role" and value.lower() in ROLES) or (
                key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I)) or (key == "aria-hidden" and value.lower() == "true"):
            return True
    return bool(re.search(r"\shidden(?=[\s>/])", tag)) and name != "body"


def blocks(page: str) -> list[tuple[str, int, int]]:
    """(text, characters outside links, place) per line; empty lines stand for breaks.

    ``place`` is the number of the innermost article element, -1 in a main element outside articles, else 0.
    """
    lines: list[tuple[str, int, int]] = []
    articles: list[int] = []
    numbered = 0
    parts: list[str] = []
    plain = 0
    stack: list[tuple[str, bool, bool]] = []  # name, hidden, main
    texts: list[bool] = [False]  # whether the page, and each open element, has a line of its own or of a child
    hidden = main = links = 0

    def flush() -> None:
        nonlocal plain
        text = BLANK.sub(" ", html.unescape("".join(parts))).strip()
        parts.clear()
        if text:
            lines.append((text, plain and min(plain, len(text)), articles[-1] if articles else -1 if main else 0))
            at = len(stack)
            while at and stack[at - 1][0] in INLINE:
                at -= 1
            texts[at] = texts[max(at - 1, 0)] = True
        plain = 0

    def gap() -> None:
        lines.extend([("", 0, 0)] * WINDOW)

    def close(to: int) -> None:
        nonlocal hidden, main, links
        while len(stack) > to:
            name, was_hidden, was_main = stack.pop()
            texts.pop()
            hidden -= was_hidden
            links -= name == "a"
            if was_main:
                main -= 1
                if name == "article":
                    articles.pop()
            if (was_hidden and not hidden and not main and not texts[-1]) or was_main:
                gap()

    at = 0
    while at < len(page):
        match = TAG.search(page, at)
        piece = page[at:match.start() if match else len(page)]
        if piece and not hidden:
            parts.append(piece)
            if not links:
                plain += len(piece.strip())
        if not match:
            break
        tag, at = match.group(), match.end()
        got = NAME.match(tag)
        if not got:
            continue
        name = got.group(1).lower()
        if tag.startswith("</"):
            if name not in INLINE:
                flush()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    close(k)
                    break
                if stack[k][0] in (*MAIN, "body", "td", "th") and name not in (*MAIN, "body", "html", "table", "tr", "div", "section"):
                    break
            continue
        if name in RAW:
            if name not in ("textarea", "title") and tag.endswith("/>"):
                continue
            end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name == "br":
            if not hidden:
                parts.append(" ")
            continue
        if name not in INLINE:
            flush()
        if name in VOID:
            continue
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in CLOSES.get(name, ()):
                close(k)
                break
            if stack[k][0] not in INLINE:
                break
        if tag.endswith("/>") and name not in INLINE and name not in MAIN:
            continue
        is_main = name in MAIN and not hidden
        is_hidden = name not in ("html", "body", *MAIN) and not (name == "header" and main and _heads(page, at)) and _hidden(name, tag)
        if (is_hidden and not hidden and not main and not texts[-1]) or is_main:
            gap()
        stack.append((name, is_hidden, is_main))
        texts.append(False)
        hidden += is_hidden
        main += is_main
        if is_main and name == "article":
            numbered += 1
            articles.append(numbered)
        links += name == "a"
    flush()
    return lines


def main_text(page: str | None) -> str:
    """The text between surge and dive points of a whole page."""
    if not page:
        return ""
    lines = blocks(page)
    article = any(place for _, _, place in lines)
    text_of: Counter = Counter()
    for text, _, place in lines:
        text_of[place] += len(text) if place > 0 else 0
    own = max(text_of, key=lambda place: (text_of[place], -place), default=0)  # of several articles the one with most text
    sizes = [(len(t) if place and place in (own, -1) else 0) if article else plain for t, plain, place in lines]
    threshold = 0 if article else THRESHOLD
    sums = [sum(sizes[i:i + WINDOW]) for i in range(len(sizes))]
    regions: list[tuple[int, int, int]] = []
    i = 0
    while i < len(lines):
        surge = sums[i] > threshold and sizes[i] > 0 and (article or i + 1 >= len(sums) or sums[i + 1] > 0 or sizes[i] > threshold)
        if not surge:
            i += 1
            continue
        dive = i
        while dive < len(lines) and sums[dive] > 0:
            dive += 1
        regions.append((i, dive, sum(sizes[i:dive])))
        i = dive
    if not regions:
        return ""
    least = 0 if article else SHARE * max(r[2] for r in regions)
    return "\n\n".join(lines[k][0] for a, b, size in regions if size >= least for k in range(a, b) if sizes[k] > 0 or (not article and lines[k][0]))


def extract(df: DataFrame, html_col: str = "html", keys: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The key columns, text and n_chars (code points) for every row."""
    rows = df.select(*[F.col(f"`{k}`").alias(f"__{i}") for i, k in enumerate(keys)], F.col(f"`{html_col}`").alias("__html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                texts = [main_text(p.as_py()) for p in part.column(len(keys))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(len(keys))] + [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    names=[f"__{i}" for i in range(len(keys))] + ["text", "n_chars"])

    schema = StructType([StructField(f"__{i}", df.schema[k].dataType) for i, k in enumerate(keys)] + [
        StructField("text", StringType()), StructField("n_chars", LongType())])
    out = rows.mapInArrow(run, schema)
    return out.select(*[F.col(f"__{i}").alias(k) for i, k in enumerate(keys)], "text", "n_chars")
