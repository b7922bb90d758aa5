"""Main text of web pages by the distribution of text over line blocks.

Markup is stripped to lines: one line for each block of text, blank lines for the
ends of containers around it, no line at all for furniture (elements that by name,
role or class are menus, forms, adverts, comments and the like). Sums of text
lengths over sliding windows of lines rise at a surge, where text begins after a
quiet stretch, and fall to nothing at a dive; the text between the surge and the
dive around the heaviest window is the main text. Where the page marks an article,
only lines inside it weigh anything.

One map-only pass; a task holds one page at a time.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import release

WINDOW = 3                  # lines in a block
BORDER = 2                  # blank lines for the begin or end of a container
BESIDE = 2 * BORDER         # blank lines between two neighbouring containers
SHARE = 0.25                # of the heaviest window: what a neighbouring stretch must reach

# HTML element names by what they do, and words of class names.
RAW = "script style noscript template iframe object svg math canvas textarea select title head".split()
VOID = "area base br col embed hr img input link meta param source track wbr".split()
BLOCK = ("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
         "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary "
         "table tbody td tfoot th thead tr ul").split()
CONTAINER = "article aside blockquote body div dl main ol section table ul".split()
CLOSED_BY_BLOCK = ("p",)
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
            "th": ("td", "th"), "option": ("option",)}
FURNITURE = "nav aside footer form button dialog menu fieldset".split()
ROLES = "navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split()
REMARKS = "comment comments commentlist disqus replies respond reactions".split()
CLASSES = ("ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs consent cookie cookies footer "
           "gdpr login masthead menu modal nav navbar navigation newsletter notice notices overlay pager pagination "
           "popup promo promotion promoted recommended related share sharing sidebar signup social sponsor sponsored "
           "subscribe toolbar widget widgets").split()

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
                  r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_WORD = re.compile(r"[a-z]+")
_END_OF = {n: re.compile(rf"</{n}(?=[\s/>])[^>]*>|\Z" if n != "head" else r"</head(?=[\s/>])[^>]*>|<body\b|\Z", re.I)
           for n in RAW}
_RAW, _VOID, _BLOCK, _CONTAINER = set(RAW), set(VOID), set(BLOCK), set(CONTAINER)
_FURNITURE, _ROLES, _REMARKS, _CLASSES = set(FURNITURE), set(ROLES), set(REMARKS), set(CLASSES)


def _kind(name: str, attributes: str, in_article: bool) -> str:
    """'' for content, else the sort of furniture an element is: 'remarks',
    'soft' (an article may still stand inside) or 'hard'."""
    if name in ("html", "body"):
        return ""
    words: set[str] = set()
    for key, *value in _ATTRIBUTE.findall(attributes):
        key, text = key.lower(), "".join(value).lower()
        if key == "role" and text in _ROLES and not (text == "banner" and in_article):
            return "hard"
        if (key == "aria-hidden" and text == "true") or (key == "style" and _HIDDEN.search(text)):
            return "hard"
        if key in ("class", "id"):
            words.update(_WORD.findall(text))
    if words & _REMARKS:
        return "remarks"
    if name in ("article", "main"):
        return ""
    if name == "form":
        return "soft"
    if name in _FURNITURE or (name == "header" and not in_article):
        return "hard"
    if words & _CLASSES or ("header" in words and not in_article):
        return "soft"
    return ""


class _Lines:
    """The lines of a page: texts, weights, blank lines before each."""

    def __init__(self) -> None:
        self.texts: list[str] = []
        self.weights: list[int] = []
        self.inside: list[bool] = []            # in a marked article
        self.blanks: list[int] = []
        self.blank = 0
        self.parts: list[str] = []
        self.linked = 0

    def text(self, raw: str, in_link: bool) -> None:
        self.parts.append(raw)
        if in_link:
            self.linked += len(raw)

    def end(self, in_article: bool) -> None:
        if self.parts:
            raw = "".join(self.parts)
            line = " ".join(entities.unescape(raw).split())
            if line:
                self.texts.append(line)
                self.weights.append(0 if 2 * self.linked > len(raw) else len(line))
                self.inside.append(in_article)
                self.blanks.append(self.blank)
                self.blank = 0
            self.parts, self.linked = [], 0


def _lines(page: str) -> _Lines:
    out = _Lines()
    names: list[str] = []                       # open elements
    open_count = dict.fromkeys(("article", "main", "a", "p", *SIBLINGS), 0)
    furniture, sort = 0, ""                     # size of the stack outside the furniture we are in
    at, breaks = 0, 0

    def article():
        return open_count["article"] + open_count["main"] > 0

    def close(to: int):
        nonlocal furniture, sort
        for n in names[to:]:
            if n in open_count:
                open_count[n] -= 1
        del names[to:]
        if sort and to < furniture:
            furniture, sort = 0, ""

    while True:
        tag = _TAG.search(page, at)
        if not sort and (tag.start() if tag else len(page)) > at:
            raw = page[at:tag.start() if tag else len(page)]
            if breaks and not raw.isspace():
                if breaks > 1:
                    out.end(article())
                breaks = 0
            out.text(raw, open_count["a"] > 0)
        if not tag:
            break
        at = tag.end()
        name = (tag.group(2) or "").lower()
        if not name:
            continue
        if name == "br":
            breaks += 1
            if not sort:
                out.text(" ", False)
            continue
        closing = bool(tag.group(1))
        if name in _RAW and not closing:
            at = _END_OF[name].search(page, at)
            at = at.start() if at.group().lower() == "<body" else at.end()
            continue
        was_out, in_article = not sort, article()
        if name in _BLOCK:
            breaks = 0
            if was_out:
                out.end(in_article)
        if closing:
            for i in range(len(names) - 1, -1, -1):
                if names[i] == name:
                    close(i)
                    break
                if names[i] in ("td", "th", "table") and name not in ("table", "tr", "td", "th", "tbody"):
                    break
        elif name not in _VOID:
            if name in _BLOCK and names and names[-1] in CLOSED_BY_BLOCK:
                close(len(names) - 1)
            if name in SIBLINGS and names and names[-1] in SIBLINGS[name]:
                close(len(names) - 1)
            kind = _kind(name, tag.group(3) or "", article())
            if sort == "soft" and kind == "" and name in ("article", "main"):
                furniture, sort = 0, ""
            if kind and not sort:
                furniture, sort = len(names) + 1, kind
            if name == "a" and names and names[-1] == "a":
                close(len(names) - 1)
            names.append(name)
            if name in open_count:
                open_count[name] += 1
        if name in _CONTAINER and was_out and not sort:
            out.blank += BORDER
    out.end(article())
    return out


def _stretch(weights: np.ndarray) -> list[tuple[int, int, int]]:
    """(first line, end, heaviest block) of each stretch from surge to dive: lines
    with text, less than a window of blank lines apart."""
    full = np.flatnonzero(weights > 0)
    if not len(full):
        return []
    run = np.concatenate([[0], np.cumsum(weights)])
    block = run[np.minimum(np.arange(len(weights)) + WINDOW, len(weights))] - run[:-1]
    cut = np.flatnonzero(np.diff(full) > WINDOW) + 1
    return [(int(x[0]), int(x[-1]) + 1, int(block[max(x[0] - WINDOW + 1, 0):x[-1] + 1].max()))
            for x in np.split(full, cut)]


def main_text(page: str) -> str:
    """The main text: blocks with single spaces, two newlines between them."""
    lines = _lines(page)
    if not lines.texts:
        return ""
    own, inside = np.array(lines.weights), np.array(lines.inside)
    marked = bool(inside.any())
    if marked:
        own = np.where(inside, np.array([len(t) for t in lines.texts]), 0)
    elif not own.any():
        return ""
    place = np.cumsum(np.array(lines.blanks) + 1) - 1
    weights = np.zeros(int(place[-1]) + 1, np.int64)
    weights[place] = own
    found = _stretch(weights)
    best = max(range(len(found)), key=lambda i: (found[i][2], -i))
    low = high = best
    if marked:                                  # nothing but the article weighs anything
        low, high = 0, len(found) - 1
    else:
        heavy = SHARE * found[best][2]
        while low and found[low][0] - found[low - 1][1] <= BESIDE and found[low - 1][2] >= heavy:
            low -= 1
        while high + 1 < len(found) and found[high + 1][0] - found[high][1] <= BESIDE and found[high + 1][2] >= heavy:
            high += 1
    surge, dive = found[low][0], found[high][1]
    return "\n\n".join(t for t, p, w in zip(lines.texts, place.tolist(), own.tolist())
                       if surge <= p < dive and (w or not marked))


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, urls, pages = batch.columns
        for i in range(0, batch.num_rows, 200):
            texts = [main_text(p.as_py() or "") for p in pages.slice(i, 200)]
            yield pa.RecordBatch.from_arrays(
                [ids.slice(i, 200), urls.slice(i, 200), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])
        release()


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every row of ``pages (page_id, url,
    html)``. A null or empty page, and one without text, gives the empty text;
    null or repeated ids are rows like any other; other columns are ignored."""
    chosen = pages.select("page_id", "url", "html")
    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:2]]
    return chosen.mapInArrow(_pages, ", ".join([*types, "text string", "n_chars long"]))
