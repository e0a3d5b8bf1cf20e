"""Main text of HTML pages by tag-path ratios.

A page is read as a list of text nodes with their root-to-leaf tag paths. Per
path, the length of text and its punctuation are set against the number of
nodes, and link text counts against it. Both ratios are smoothed over the
neighbouring nodes in page order and fused as their product. What the page
itself says about its parts enters as a factor: 0 below menus, headers, footers
and the like (by tag, role or class), and more than 1 inside an article or main
element. A path is content when its weighted ratio reaches a share of the
deviation of the page's unweighted ones. Selected nodes are joined by blocks; a
block that is mostly selected, such as a paragraph with links, is taken whole,
and a heading goes with what follows it.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from statistics import median
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SMOOTHING = 1
SHARE_OF_DEVIATION = 0.5
CONTENT_WEIGHT, CONTENT_LINK_WEIGHT = 12.0, 3.0  # inside an article or main element; the first keeps short items of its lists

#: Elements of HTML by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea".split())
FOREIGN = frozenset("svg math".split())  # below them tags may close themselves
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big button canvas cite code data del dfn em font i iframe ins kbd label mark math noscript object option q s samp select small span "
    "strike strong sub sup svg time tt u var".split()
)
BOILERPLATE = frozenset("head title nav header footer aside form menu dialog".split())
UNSEEN = frozenset("template iframe".split())  # browsers never show what is in them
CONTENT = frozenset("article main".split())
WHOLE = frozenset("html body main article".split())  # never a part by their names
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "optgroup": {"option", "optgroup"}}
SCOPES = frozenset("table ul ol dl article main section div body html td th select datalist".split())
#: Whole tokens of class, id and role, and whole labels, that name parts other than the article.
PART_WORDS = frozenset(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments consent contentinfo cookie cookies disqus footer gdpr menu modal "
    "nav navbar navigation newsletter notice notices popup promo promoted related reply replies search share sharing sidebar social sponsor sponsored subscribe widget".split()
)
#: Words that turn a name of several words into one that says a part is absent or elsewhere.
NEGATIONS = frozenset("no not non has have with without free hide hidden off disabled".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)>|<[!?/][^>]*+>",
    re.DOTALL,
)
_NAMING = re.compile(r"\b(class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*>", re.IGNORECASE) for name in sorted(RAW)}
_PUNCTUATION = re.compile(r"[.,;:!?。，、；：！？]")


class Node(NamedTuple):
    text: str
    path: int  # number of the root-to-leaf tag path
    block: int
    kind: str  # 'content', 'other' or 'plain'
    link: bool
    part: int  # number of the innermost element around it that is a part by its name, or 0
    heading: bool


class _Open(NamedTuple):
    name: str
    path: int
    kind: str
    link: bool
    part: int
    heading: bool
    foreign: bool


class _Stack(list):
    """Open elements, with the number of each name, so that a search for one that is not open ends at once."""

    def __init__(self) -> None:
        super().__init__([_Open("", 0, "plain", False, 0, False, False)])
        self.open: Counter[str] = Counter()

    def push(self, element: _Open) -> None:
        self.append(element)
        self.open[element.name] += 1

    def close(self, names, stop) -> None:
        """End the innermost element of the names, and all within it, unless one of stop comes first."""
        if not any(self.open[name] for name in names):
            return
        for at in range(len(self) - 1, 0, -1):
            if self[at].name in names:
                self.open.subtract(element.name for element in self[at:])
                del self[at:]
                return
            if self[at].name in stop:
                return


def _is_part(name: str) -> bool:
    """Whether a class, id or role names a part, by itself or by one of its words ("site-footer", "relatedPosts")."""
    if name.lower() in PART_WORDS:
        return True
    words = {w.lower() for w in _NAME_WORDS.findall(name)}
    return bool(words & PART_WORDS) and not words & NEGATIONS


def _named_part(attrs: str) -> tuple[str, bool]:
    names = [(k.lower(), a or b or c) for k, a, b, c in _NAMING.findall(attrs)] if attrs else []
    shown = "".join(f".{v.lower().split()[0]}" for k, v in names if k == "class" and v.split())
    part = any(v.strip().lower() in PART_WORDS if k == "aria-label" else any(map(_is_part, v.split())) for k, v in names)
    return shown, part


def nodes(page: str) -> list[Node]:
    """The text nodes of a page in order; nodes of one block have one number. Elements left open end with their parent.

    Time is in proportion to the page: paths are numbers, a search for an
    element that is not open does not walk the open ones, and where no tag can
    end any more the rest is text.
    """
    stack, out = _Stack(), []
    paths: dict[tuple[int, str], int] = {}
    outer = [0]  # of each part the next one around it
    block, at, size, last = 0, 0, len(page), page.rfind(">") + 1
    lower, ends = None, {}  # where the last end tag of an unseen element is

    def text(part: str) -> None:
        if part:
            top = stack[-1]
            out.append(Node(html.unescape(part), top.path, block, top.kind, top.link, top.part, top.heading))

    while at < size:
        found = _TOKEN.search(page, at, last) if at < last else None
        if found is None:
            text(page[at:].partition("<!--")[0])
            break
        text(page[at : found.start()])
        at = found.end()
        if found.group().startswith("<!--") and not found.group().endswith("-->"):
            break  # a comment that never ends
        name = (found["name"] or found["name2"] or "").lower()
        if not name:
            continue
        foreign = stack[-1].foreign and name not in CLOSES_P and name not in SCOPES
        inline = foreign or name in INLINE
        if found["end"] or found["end2"]:
            if not inline and name not in VOID:
                block += 1
            stack.close((name,), SCOPES - {name} if inline or name == "p" else ())
            continue
        attrs = found["attrs"] or found["attrs2"] or ""
        if name in RAW:
            if not attrs.endswith("/"):
                end = _RAW_END[name].search(page, at, last)
                at = end.end() if end else size
            continue
        if name in UNSEEN:
            if name not in ends:
                lower = lower or page.lower()
                ends[name] = lower.rfind(f"</{name}")
            if ends[name] < at:  # no end tag follows; the start tag says nothing
                continue
        if name in VOID:
            if name == "hr":
                block += 1
            continue
        if name in CLOSES_P:
            if stack[-1].foreign:
                stack.close(FOREIGN, SCOPES)
            stack.close(("p",), SCOPES)
        if name in SIBLINGS:
            stack.close(SIBLINGS[name], SCOPES - SIBLINGS[name])
        if not inline:
            block += 1
        if attrs.endswith("/") and inline:
            continue
        shown, part = _named_part(attrs)
        parent = stack[-1]
        kind, inside = parent.kind, parent.part
        if name in UNSEEN or name in BOILERPLATE and not (name == "header" and kind == "content"):
            kind = "other"
        elif name in CONTENT and kind != "other":
            kind = "content"
        if part and kind != "other" and name not in WHOLE:
            outer.append(inside)
            inside = len(outer) - 1
        path = paths.setdefault((parent.path, name + shown), len(paths) + 1)
        stack.push(_Open(name, path, kind, parent.link or name == "a", inside, parent.heading or name in HEADINGS, parent.foreign or name in FOREIGN))
    return _without_parts(out, outer)


def _without_parts(found: list[Node], outer: list[int]) -> list[Node]:
    """Parts by name become 'other', whatever their size, but for one that all content of the page is in.

    Content is text in an article or main element, or with punctuation, that is
    no link. Where nothing but parts holds content, all of them are left to the
    ratios.
    """
    total, within = 0, [0] * len(outer)  # content in each part, with the parts in it
    for n in found:
        if n.kind != "other" and not n.link and n.text.strip() and (n.kind == "content" or _PUNCTUATION.search(n.text)):
            total += 1
            within[n.part] += 1
    for part in range(len(outer) - 1, 0, -1):  # a part comes after the one around it
        within[outer[part]] += within[part] if outer[part] else 0
    dropped = [False] * len(outer)
    for part in range(1, len(outer)):
        dropped[part] = dropped[outer[part]] or within[part] < total
    left = [n._replace(kind="other") if n.part and dropped[n.part] else n for n in found]
    return left if total == 0 or any(n.kind != "other" and not n.link and n.text.strip() for n in left) else found


def _smooth(values: np.ndarray) -> np.ndarray:
    width = 2 * SMOOTHING + 1
    padded = np.concatenate((values[:1].repeat(SMOOTHING), values, values[-1:].repeat(SMOOTHING)))
    return np.convolve(padded, np.full(width, 1 / width), "valid")


def content_paths(found: list[Node]) -> set[int]:
    """Paths whose fused ratio, weighted by kind, says content."""
    filled = [n for n in found if n.text.strip() and n.kind != "other"]
    if not filled:
        return set()
    length, marks, count = defaultdict(float), defaultdict(float), defaultdict(int)
    for n in filled:
        weight = 0.2 if n.link else 1.0
        length[n.path] += weight * len(n.text.strip())
        marks[n.path] += weight * len(_PUNCTUATION.findall(n.text))
        count[n.path] += 1
    by_length = _smooth(np.array([length[n.path] / count[n.path] for n in filled]))
    by_marks = _smooth(np.array([marks[n.path] / count[n.path] for n in filled]))
    fused = np.sqrt(by_length * (1 + by_marks))
    threshold = SHARE_OF_DEVIATION * fused.std()
    sums: dict[int, list[float]] = defaultdict(list)
    for n, value in zip(filled, fused, strict=True):
        sums[n.path].append(float(value) * (1.0 if n.kind != "content" else CONTENT_LINK_WEIGHT if n.link else CONTENT_WEIGHT))
    return {path for path, values in sums.items() if median(values) >= threshold}


def main_text(page: str | None) -> str:
    """The content of a page: blocks joined by an empty line, white space inside a block as one blank."""
    found = nodes(page or "")
    chosen = content_paths(found)
    kept = [n for n in found if n.kind != "other"]
    balance: dict[int, int] = defaultdict(int)
    for n in kept:
        balance[n.block] += len(n.text.strip()) * (1 if n.path in chosen else -1)
    follows = False
    for n in reversed(kept):
        if not n.heading:
            follows = balance[n.block] > 0 if n.text.strip() else follows
        elif follows and not n.link:
            chosen.add(n.path)
            balance[n.block] = max(1, balance[n.block])
    blocks: dict[int, list[str]] = defaultdict(list)
    for n in kept:
        if n.path in chosen or balance[n.block] > 0:
            blocks[n.block].append(n.text)
    texts = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n\n".join(t for t in texts if t)


def _extracted(batches):
    for batch in batches:
        texts = [main_text(page) for page in batch.column(2).to_pylist()]
        columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])


def extract_text(pages: DataFrame) -> DataFrame:
    """One row per row of pages: (page_id, url, text, n_chars).

    Null and empty pages give empty texts. Null ids and urls and repeated rows
    stay; other columns are ignored; an empty table gives an empty result.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")
