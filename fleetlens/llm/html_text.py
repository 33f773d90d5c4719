"""Main text of web pages from flat text blocks.

A page is cut into blocks at block-level tags.  Each block has word counts and link densities of itself, its
two neighbours, and what encloses it (main-content elements, navigation, forms, names of its class or id).  A
decision tree, grown on the small labelled table below, tells content from the rest.

Null and empty pages give an empty text.  Rows are independent: no shuffle, repeated rows give repeated
results, a null page_id or url passes through.
"""

from __future__ import annotations

import re
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fleetlens.llm.tables import map_chunks

SCHEMA = "page_id long, url string, text string, n_chars long, n_blocks long"

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+)(?:>|\Z)", re.DOTALL)
_LABEL = re.compile(r"""(?:^|[\s"'/])(class|id|role|aria-label|hidden|style)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""",
                    re.IGNORECASE)
_SPACE = re.compile(r"[\s\x00]+")
_WORD = re.compile(r"\S+")
_PARTS = re.compile(r"[a-z]+|[A-Z][a-z]*|[0-9]+")

#: Elements whose content is never text.
RAW = frozenset(("script", "style", "template", "noscript", "svg", "math", "iframe", "object", "textarea", "title",
                 "canvas", "audio", "video", "select", "option", "datalist"))
#: Elements that do not end a block.
INLINE = frozenset((
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i",
    "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong",
    "sub", "sup", "time", "tt", "u", "var", "wbr", "nobr", "picture", "source"))
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
                  "track", "wbr", "frame"))
#: Elements that stand for something beside the article, and names of classes and ids that say the same.
ASIDE = frozenset(("nav", "aside", "footer", "form", "menu", "dialog", "button", "fieldset", "figcaption", "head"))
ASIDE_NAMES = frozenset((
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs",
    "comment", "comments", "consent", "cookie", "cookies", "copyright", "disqus", "footer", "form", "gdpr", "legal",
    "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "pager",
    "pagination", "popup", "promo", "promoted", "recommended", "related", "reply", "replies", "search", "share",
    "sharing", "sidebar", "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "tags", "toolbar", "widget",
    "header", "alert", "contentinfo", "complementary", "respond", "responses", "discussion"))
MAIN = frozenset(("article", "main"))
MAIN_NAMES = frozenset(("article", "content", "main", "post", "story", "entry", "body", "text"))

FEATURES = ("words", "link_density", "words_before", "links_before", "words_after", "links_after",
            "aside", "main", "heading")

#: Labelled blocks: the features in this order, then 1 for content.  ``main`` is 1 inside a main element, 0
#: outside it, 0.5 on a page without one.  Fixed values.
LABELLED = """
25 0.00 18 0.00 30 0.00 0 1 0 1
60 0.05 25 0.00 41 0.00 0 1 0 1
1 0.00 40 0.00 33 0.00 0 1 0 1
2 0.00 0 0.00 55 0.00 0 1 1 1
8 0.00 3 0.00 48 0.00 0 1 1 1
4 0.00 6 1.00 1 0.00 0 1 1 1
12 0.00 6 1.00 9 0.00 0 1 1 1
3 0.33 22 0.00 25 0.00 0 1 0 1
1 0.00 1 0.00 1 0.00 0 1 0 1
5 0.00 12 0.00 10 0.00 0 1 0 1
90 0.00 12 0.00 0 0.00 0 1 0 1
14 0.14 50 0.02 44 0.00 0 1 0 1
6 1.00 30 0.00 28 0.00 0 1 0 1
2 1.00 45 0.00 60 0.00 0 1 0 1
7 0.00 1 1.00 8 0.00 0 1 0 1
180 0.00 70 0.00 2 0.00 0 1 0 1
1 1.00 1 1.00 1 1.00 1 0 0 0
2 1.00 3 1.00 1 1.00 1 0 0 0
9 0.00 1 1.00 8 0.00 1 0 0 0
12 0.00 2 1.00 6 0.00 1 0 0 0
7 0.00 40 0.00 0 0.00 1 0 0 0
20 0.10 40 0.00 0 0.00 1 0 0 0
30 0.00 35 0.00 25 0.00 1 1 0 0
6 0.00 33 0.00 50 0.00 1 1 0 0
45 0.02 5 0.00 9 0.00 1 1 0 0
1 0.00 44 0.00 2 1.00 1 1 0 0
3 1.00 60 0.00 3 1.00 1 1 0 0
2 0.00 20 0.00 30 0.00 1 1 1 0
25 0.00 12 0.00 18 0.00 1 0 0 0
60 0.00 4 0.00 0 0.00 1 0 0 0
5 0.00 0 0.00 12 0.00 0 0 0 0
22 0.00 30 0.00 7 0.00 0 0 0 0
14 0.00 2 1.00 5 0.00 0 0 0 0
3 0.00 0 0.00 2 1.00 0 0 1 0
2 1.00 55 0.00 2 1.00 0 0 0 0
40 0.05 8 0.00 3 0.00 0 0 0 0
25 0.00 18 0.00 30 0.00 0 0.5 0 1
60 0.05 25 0.00 41 0.00 0 0.5 0 1
40 0.10 2 0.00 3 1.00 0 0.5 0 1
18 0.00 6 1.00 22 0.00 0 0.5 0 1
12 0.08 40 0.00 30 0.00 0 0.5 0 1
3 0.00 30 0.00 28 0.00 0 0.5 0 1
6 0.00 22 0.00 60 0.00 0 0.5 0 1
5 0.00 1 1.00 40 0.00 0 0.5 1 1
7 0.00 0 0.00 35 0.00 0 0.5 1 1
4 0.00 33 0.00 30 0.00 0 0.5 1 1
120 0.00 0 0.00 0 0.00 0 0.5 0 1
3 0.00 1 1.00 2 1.00 0 0.5 0 0
2 0.00 0 0.00 1 1.00 0 0.5 0 0
6 1.00 4 1.00 5 1.00 0 0.5 0 0
1 1.00 1 1.00 1 1.00 0 0.5 0 0
10 0.80 3 1.00 6 0.50 0 0.5 0 0
9 0.90 40 0.00 5 1.00 0 0.5 0 0
5 0.00 4 1.00 6 1.00 0 0.5 0 0
2 0.00 3 0.00 2 0.00 0 0.5 0 0
25 0.90 3 1.00 12 1.00 0 0.5 0 0
1 0.00 1 1.00 30 0.00 1 0.5 0 0
12 0.00 30 0.00 9 0.00 1 0.5 0 0
30 0.05 40 0.00 4 0.00 1 0.5 0 0
50 0.00 6 0.00 3 0.00 1 0.5 0 0
8 0.00 2 0.00 40 0.00 1 0.5 1 0
20 0.00 30 0.00 4 1.00 0 1 0 1
9 0.00 25 0.00 2 1.00 0 1 0 1
4 1.00 12 0.00 5 1.00 0 1 0 1
5 1.00 4 1.00 40 0.00 0 1 0 1
70 0.00 30 0.00 25 0.00 0 0 0 0
110 0.00 60 0.00 45 0.00 0 0 0 0
35 0.00 90 0.00 20 0.00 0 0 0 0
6 0.00 40 0.00 80 0.00 0 0 1 0
90 0.00 70 0.00 4 0.00 0 0.5 0 1
28 0.00 50 0.00 3 1.00 0 0.5 0 1
24 0.00 60 0.00 6 0.00 0 0.5 0 1
14 0.00 45 0.00 0 0.00 0 0.5 0 1
20 0.00 0 0.00 0 0.00 0 0.5 0 1
2 0.00 0 0.00 0 0.00 0 0.5 0 1
120 0.00 40 0.00 60 0.00 1 0.5 0 0
80 0.00 30 0.00 70 0.00 1 1 0 0
8 0.00 2 1.00 2 1.00 0 1 0 1
2 0.00 3 1.00 2 1.00 0 1 0 1
30 0.00 1 1.00 3 1.00 0 1 0 1
1 1.00 2 1.00 1 1.00 0 1 0 1
3 1.00 2 1.00 9 0.00 0 1 0 1
2 0.00 14 0.00 3 1.00 0 1 0 1
3 0.00 2 1.00 1 0.00 0 1 1 1
2 0.00 1 0.00 4 1.00 0 1 0 1
9 0.00 3 1.00 9 1.00 0 0 0 0
2 0.00 2 1.00 2 1.00 0 0 0 0
4 0.00 1 0.00 1 0.00 0 0 0 0
"""


def grow_tree(rows: np.ndarray, labels: np.ndarray, depth: int = 6) -> tuple:
    """A binary tree by Gini impurity; ties go to the earlier feature and the lower threshold.

    A leaf is ``(label,)``; an inner node is ``(feature, threshold, left, right)``, left being <= threshold.
    """
    share = labels.mean()
    if depth == 0 or share in (0.0, 1.0):
        return (int(share >= 0.5),)
    best = None
    for feature in range(rows.shape[1]):
        values = np.unique(rows[:, feature])
        for threshold in (values[:-1] + values[1:]) / 2:
            left = rows[:, feature] <= threshold
            p, q = labels[left].mean(), labels[~left].mean()
            impurity = left.sum() * p * (1 - p) + (~left).sum() * q * (1 - q)
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, feature, float(threshold), left)
    if best is None:
        return (int(share >= 0.5),)
    _, feature, threshold, left = best
    return (feature, threshold, grow_tree(rows[left], labels[left], depth - 1),
            grow_tree(rows[~left], labels[~left], depth - 1))


@lru_cache(maxsize=1)
def _tree() -> tuple:
    table = np.array([[float(x) for x in line.split()] for line in LABELLED.strip().splitlines()])
    return grow_tree(table[:, :-1], table[:, -1])


def is_content(features: tuple) -> bool:
    node = _tree()
    while len(node) > 1:
        node = node[2] if features[node[0]] <= node[1] else node[3]
    return bool(node[0])


def _names(attributes: str) -> tuple[set[str], bool]:
    """Words of class, id and role, and whether the element is hidden."""
    words, hidden = set(), False
    for name, value in _LABEL.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden":
            hidden = True
        elif name == "style":
            hidden |= "display:none" in value.replace(" ", "").lower()
        else:
            words |= {part.lower() for part in _PARTS.findall(value)}
            words |= {part for part in re.split(r"[^a-z0-9]+", value.lower()) if part}
    return words, hidden


def blocks_of(page: str) -> list[tuple[str, int, int, bool, bool, bool]]:
    """Text, words, linked words, beside the article, inside it, heading: for each block in page order."""
    out: list[tuple[str, int, int, bool, bool, bool]] = []
    parts: list[str] = []
    links: list[str] = []
    stack: list[tuple[str, bool, bool, bool]] = []  # tag, aside, main, hidden
    heading = in_link = False
    at = 0

    def flush() -> None:
        nonlocal heading
        text = _SPACE.sub(" ", unescape("".join(parts))).strip()
        if text:
            aside = any(x[1] for x in stack)
            main = any(x[2] for x in stack)
            linked = len(_WORD.findall(unescape("".join(links))))
            out.append((text, len(_WORD.findall(text)), linked, aside, main, heading))
        parts.clear()
        links.clear()

    while True:
        tag = _TAG.search(page, at)
        text = page[at:tag.start() if tag else len(page)]
        if text and not any(x[3] for x in stack):
            parts.append(text)
            if in_link:
                links.append(text)
        if tag is None:
            break
        at = tag.end()
        name = (tag[2] or "").lower()
        if not name:
            if tag[0].startswith("<![CDATA["):
                parts.append(tag[0][9:].removesuffix("]]>").replace("&", "&amp;").replace("<", "&lt;"))
            continue
        closing = tag[1] == "/"
        if name in RAW:
            if not closing and not tag[3].rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.IGNORECASE).search(page, at)
                at = end.end() if end else len(page)
            continue
        if name == "a":
            in_link = not closing
            if not closing:
                links.append(" ")
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name in INLINE and name not in ("label",):
            words, hidden = _names(tag[3]) if not closing and tag[3] else (set(), False)
            if not hidden:
                continue
        flush()
        in_link = False
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
            heading = False
        elif name not in VOID and not tag[3].rstrip().endswith("/"):
            words, hidden = _names(tag[3])
            if name in ("p", "li", "dt", "dd", "td", "th", "tr") and stack and stack[-1][0] == name:
                stack.pop()
            inside = any(x[2] for x in stack)
            aside = (name in ASIDE or (name == "header" and not inside)
                     or (name not in MAIN and name not in ("body", "html") and bool(words & ASIDE_NAMES)))
            main = name in MAIN or "main" in words or (name in ("div", "section") and bool(words & MAIN_NAMES))
            stack.append((name, aside, main and not aside, hidden))
            heading = len(name) == 2 and name[0] == "h" and name[1].isdigit()
    flush()
    return out


def main_text(page: str | None) -> tuple[str, int]:
    """The content blocks of a page joined by line ends, and how many they are."""
    blocks = blocks_of(page or "")
    any_main = any(main and not aside for _, _, _, aside, main, _ in blocks)
    density = [linked / words for _, words, linked, _, _, _ in blocks]
    kept = []
    for i, (text, words, _, aside, main, heading) in enumerate(blocks):
        before = (blocks[i - 1][1], density[i - 1]) if i else (0, 0.0)
        after = (blocks[i + 1][1], density[i + 1]) if i + 1 < len(blocks) else (0, 0.0)
        if is_content((words, density[i], *before, *after, aside, main if any_main else 0.5, heading)):
            kept.append(text)
    return "\n".join(kept), len(kept)


def _extract(batch: pa.RecordBatch) -> pa.RecordBatch:
    made = [main_text(page) for page in batch.column("html").to_pylist()]
    return pa.RecordBatch.from_arrays(
        [batch.column("page_id"), batch.column("url"), pa.array([x[0] for x in made], pa.string()),
         pa.array([len(x[0]) for x in made], pa.int64()), pa.array([x[1] for x in made], pa.int64())],
        names=["page_id", "url", "text", "n_chars", "n_blocks"])


def extract_text(pages: DataFrame) -> DataFrame:
    """One row per page row with its main text."""
    return map_chunks(pages.selectExpr("cast(page_id as long) page_id", "url", "html"), "html", _extract, SCHEMA)
