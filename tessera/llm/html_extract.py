"""Main text of web pages by tag-path ratios.

Text blocks are grouped by their root-to-leaf tag path (tags with their classes). For each path the text length and
the punctuation per block are taken over the page and fused: their geometric mean, times the share of text outside links.
Values are smoothed along the page among the blocks of one container, and paths under a threshold go, wherever they stand.
The element that holds most of what the other paths gain bounds the article.

Names only weigh: a menu, a form, an advert or reader comments have their paths' values lowered, an article's are raised.
A name does not weigh on an element that holds most of the page's values.

Everything is linear in the page: elements stand in lists, parents before children, and sums are made once, bottom up.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import small_batches

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_TAG_END = re.compile(r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>")
_ATTR = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？؟।]")
_LONG_REFERENCE = re.compile(r"&#(?:[xX]([0-9a-fA-F]{8,})|([0-9]{8,}));?")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_PART = re.compile(r"[a-z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg math object textarea title select option datalist canvas audio video".split())
#: Of these, what swallows the rest of a page if it is not closed; others are then passed over.
SWALLOWS = frozenset("script style textarea title".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split()
)
CLOSES_SAME = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that hold a text of their own and lie side by side in a container.
LEAVES = HEADINGS | frozenset("p li dt dd td th pre blockquote figcaption caption summary tr tbody thead tfoot".split())
NO_CONTENT_TAGS = frozenset("nav header footer aside button dialog menu form fieldset legend head".split())
#: Of these, what never wraps a page.
SURE_TAGS = frozenset("nav footer aside button dialog menu legend head".split())
NO_CONTENT_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
#: Class names and ids, and their first and last parts, that name what is no article.
NO_CONTENT_NAMES = frozenset(
    """ad ads advert adverts advertisement advertising adbox adslot sponsor sponsored promo promotion banner
    nav navbar navigation menu submenu breadcrumb breadcrumbs pagination pager toc toolbar topbar
    header masthead footer colophon sidebar sidenav aside rail widget widgets
    cookie cookies consent gdpr alert popup modal overlay toast disclaimer
    newsletter subscribe subscription signup login signin register paywall
    share sharing recommended recommendations trending popular
    searchbox form copyright hidden""".split()
)
READERS_NAMES = frozenset("comment comments commentlist disqus reply replies respond feedback".split())
#: Names of menus and boxes and of parts of articles alike.
AMBIGUOUS_NAMES = frozenset("discussion follow legal notice notices related search skip social".split())
HEADER_NAMES = frozenset("header masthead".split())

#: Parts of names that tell a state of a page, not what an element is.
STATES = frozenset("has with without no is open closed enabled disabled on off".split())

#: What each judgement of a name does to the values below it.
WEIGHTS = {"readers": 0.1, "none": 0.1, "header": 0.1}
LANDMARK_WEIGHT = 2.0
#: Of all values: what articles and mains hold at least for their values alone to say what a name may weigh on.
LANDMARK_SHARE = 0.03
#: Of the mean value of a page's characters: what a path must reach.
LEVEL = 0.2
#: What the mean counts at most, about the value of 500 characters and ten marks: beside a huge text short titles stay.
LEVEL_MEAN = 4.6
#: Of all gains: what the element that bounds the article holds at least.
SHARE = 0.6
#: Blocks on either side that a smoothed value is made of.
RADIUS = 2
#: A path of prose: characters and punctuation marks a block.
PROSE = (40, 0.5)

TEXT, OPEN, CLOSE = 0, 1, 2


def _reference(m: re.Match) -> str:
    digits = (m[1] or m[2]).lstrip("0") or "0"
    return html.unescape(f"&#{'x' if m[1] else ''}{digits};") if len(digits) <= 7 else "�"


def unescape(text: str) -> str:
    """Character references decoded; a number of any length (which int() would refuse) is no character."""
    if "&" not in text:
        return text
    return html.unescape(_LONG_REFERENCE.sub(_reference, text) if "&#" in text else text)


def tokens(page: str) -> Iterator[tuple[int, str, str]]:
    """(TEXT, text, ''), (OPEN, tag, attributes) and (CLOSE, tag, '') in order; linear whatever the markup.

    A tag that never ends is none, and after a tag whose quotes never close, quotes no longer hide a '>'.
    """
    at, size, last, quotes = 0, len(page), page.rfind(">"), True
    no_end: set[str] = set()
    while at < size:
        lt = page.find("<", at)
        if lt < 0:
            yield TEXT, page[at:], ""
            return
        begin = page[lt + 1 : lt + 2]
        if not (begin.isalpha() and begin.isascii()) and begin not in ("/", "!", "?"):
            yield TEXT, page[at : lt + 1], ""
            at = lt + 1
            continue
        if lt > at:
            yield TEXT, page[at:lt], ""
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = end + 3 if end >= 0 else size
            continue
        if lt > last:
            return
        if begin in "!?" or not (name := _NAME.match(page, lt + 1 + (begin == "/"))):
            at = page.find(">", lt) + 1
            continue
        tag = name[0].lower()
        if begin == "/":
            at = page.find(">", name.end()) + 1
            yield CLOSE, tag, ""
            continue
        if page.startswith(">", name.end()):
            at = name.end() + 1
        else:
            end = _TAG_END.match(page, name.end()) if quotes else None
            if end is None:
                quotes = False
            at = end.end() if end else page.find(">", name.end()) + 1
        attrs = page[name.end() : at - 1]
        if tag not in RAW:
            yield OPEN, tag, attrs
            continue
        if attrs.endswith("/") and tag in ("svg", "math"):
            continue
        stop = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(page, at) if tag not in no_end else None
        if stop:
            at = stop.end()
        elif tag in SWALLOWS:
            return
        else:
            no_end.add(tag)


@lru_cache(maxsize=4096)
def naming(names: str) -> str:
    """What class names and ids say of an element: readers, header, none (no content), doubtful or nothing."""
    said = set()
    for token in names.lower().split():
        parts = _PART.findall(token)
        if not parts or not STATES.isdisjoint(parts):
            continue
        ends = {parts[0], parts[-1]}
        if ends & READERS_NAMES:
            return "readers"
        if ends & HEADER_NAMES:
            said.add("header")
        elif ends & NO_CONTENT_NAMES:
            said.add("none")
        elif (NO_CONTENT_NAMES | AMBIGUOUS_NAMES | READERS_NAMES) & set(parts):
            said.add("doubtful")
    return next((x for x in ("none", "header", "doubtful") if x in said), "")


@dataclass(slots=True)
class Block:
    at: int
    linked: int
    text: str


class Tree:
    """The elements of a page in lists, parents before their children, and its text blocks in order."""

    def __init__(self, page: str):
        self.tag, self.parent, self.path, self.said, self.landmark = [""], [-1], [0], [""], [False]
        self.blocks: list[Block] = []
        self._paths: dict[tuple[int, str], int] = {}
        self._kinds: dict[tuple[str, str], tuple[str, str, bool]] = {}
        self._read(page)

    @staticmethod
    def _kind(tag: str, raw: str) -> tuple[str, str, bool]:
        """What an element's names say, its label in paths, and whether it is an article; pages repeat few of them."""
        attrs = {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(raw)} if raw and not raw.isspace() else {}
        names, role = attrs.get("class", ""), attrs.get("role", "").lower()
        # The id of a heading or a paragraph is the place that links lead to.
        ident = "" if tag in LEAVES else attrs.get("id", "")
        said = "" if tag in ("html", "body", "main") else naming(f"{names} {ident}")
        if tag in HEADINGS and said == "doubtful":
            said = ""
        if said != "readers":
            if tag == "header" or role == "banner":
                said = "header"
            elif tag in NO_CONTENT_TAGS or role in NO_CONTENT_ROLES or "hidden" in attrs or attrs.get("aria-hidden") == "true" or _HIDDEN.search(attrs.get("style", "")):
                said = "none"
        label = tag + "".join(sorted(f".{c}" for c in names.split())) + (f"#{ident}" if ident else "")
        return said, label, tag in ("article", "main") or role in ("main", "article")

    def _push(self, tag: str, raw: str, parent: int) -> int:
        kind = self._kinds.get((tag, raw))
        if kind is None:
            kind = self._kinds[tag, raw] = self._kind(tag, raw)
        said, label, landmark = kind
        self.tag.append(tag)
        self.parent.append(parent)
        self.path.append(self._paths.setdefault((self.path[parent], label), len(self._paths) + 1))
        self.said.append(said)
        self.landmark.append(landmark)
        return len(self.tag) - 1

    def _read(self, page: str) -> None:
        # Of the open tags: (tag, element or -1 for an inline one); where each tag is open; where blocks are.
        stack: list[tuple[str, int]] = [("", 0)]
        open_at: dict[str, list[int]] = {}
        block_at = [0]
        muted: list[int] = []
        # Of the open block, if any: its element, its texts so far and their characters in links.
        at, linked = -1, 0
        parts: list[str] = []

        def close() -> None:
            nonlocal at, linked
            if at >= 0:
                text = " ".join("".join(parts).split())
                if text:
                    self.blocks.append(Block(at, linked, text))
                at, linked = -1, 0
                parts.clear()

        def pop_to(k: int) -> None:
            while len(stack) > k:
                tag, _ = stack.pop()
                open_at[tag].pop()
                if block_at[-1] == len(stack):
                    block_at.pop()
                if muted and muted[-1] == len(stack):
                    muted.pop()

        def last(tag: str) -> int:
            return open_at[tag][-1] if open_at.get(tag) else -1

        for kind, value, raw in tokens(page):
            if kind == TEXT:
                text = unescape(value)
                if muted or (at < 0 and text.isspace()):
                    continue
                if at < 0:
                    at = stack[block_at[-1]][1]
                parts.append(text)
                if open_at.get("a"):
                    linked += len(text.strip())
                continue
            tag, inline = value, value in INLINE
            if kind == CLOSE:
                k = last(tag)
                if not inline:
                    close()
                if k > 0 and not (inline and k < block_at[-1]):
                    pop_to(k)
                continue
            if tag == "br":
                if at >= 0:
                    parts.append(" ")
                continue
            if tag in CLOSES_P and stack[block_at[-1]][0] == "p":
                pop_to(block_at[-1])
            elif tag in CLOSES_SAME:
                same, bounds = CLOSES_SAME[tag]
                k = max(map(last, same))
                if k > max(map(last, bounds)):
                    # All that the first of them holds goes: a cell with its row.
                    pop_to(min(x for x in map(last, same) if x > max(map(last, bounds))))
            if not inline:
                close()
            if tag in VOID:
                continue
            if inline:
                if _HIDDEN.search(raw):
                    muted.append(len(stack))
                stack.append((tag, -1))
            else:
                element = self._push(tag, raw, stack[block_at[-1]][1])
                block_at.append(len(stack))
                stack.append((tag, element))
            open_at.setdefault(tag, []).append(len(stack) - 1)
        close()

    def below(self, per_block) -> list[float]:
        """For every element the sum of a value of the blocks in it."""
        sums = [0.0] * len(self.tag)
        for b, x in zip(self.blocks, per_block, strict=True):
            sums[b.at] += x
        for e in range(len(sums) - 1, 0, -1):
            sums[self.parent[e]] += sums[e]
        return sums


@dataclass(slots=True)
class PathSums:
    blocks: int = 0
    chars: int = 0
    marks: int = 0
    linked: int = 0

    def fused(self) -> float:
        """Geometric mean of text length and punctuation per block, times the share of text outside links."""
        return math.sqrt(math.log1p(self.chars / self.blocks) * (1 + math.log1p(self.marks / self.blocks))) * (1 - self.linked / self.chars)

    def is_prose(self) -> bool:
        return self.chars >= PROSE[0] * self.blocks and self.marks >= PROSE[1] * self.blocks and 2 * self.linked < self.chars


def path_ratios(tree: Tree) -> dict[int, PathSums]:
    sums: dict[int, PathSums] = {}
    for b in tree.blocks:
        s = sums.setdefault(tree.path[b.at], PathSums())
        s.blocks += 1
        s.chars += len(b.text)
        s.marks += len(_PUNCTUATION.findall(b.text))
        s.linked += min(b.linked, len(b.text))
    return sums


def name_weights(tree: Tree, ratios: dict[int, PathSums], values: list[float]) -> tuple[list[float], list[float]]:
    """Of every element the weight of all names from the root to it, and the same without headers' names.

    Readers' texts may be most of a page: their names weigh as soon as prose stands outside of them. Any other name
    does not weigh on an element that holds over half of the values (of the articles', if the page has any). A doubtful
    name weighs as much as the element's text stands in links.
    """
    n = len(tree.tag)
    if not any(tree.said) and not any(tree.landmark):
        return [1.0] * n, [1.0] * n
    fused = [v * len(b.text) for v, b in zip(values, tree.blocks, strict=True)]
    readers = [0] * n  # how many elements named so, from the root on
    for e in range(1, n):
        readers[e] = readers[tree.parent[e]] + (tree.said[e] == "readers")
    held = tree.below([g * (readers[b.at] == 0) for g, b in zip(fused, tree.blocks, strict=True)])
    named = [False] * n
    for e in range(1, n):
        doubted = tree.tag[e] not in SURE_TAGS and 2 * held[e] > held[0]
        named[e] = named[tree.parent[e]] or (tree.said[e] in ("none", "header") and not doubted)
    least = min((readers[b.at] for b in tree.blocks if not named[b.at] and ratios[tree.path[b.at]].is_prose()), default=n)
    silent = [False] * n
    for e in range(1, n):
        silent[e] = silent[tree.parent[e]] or (tree.said[e] == "readers" and readers[e] > least)
    marked = [False] * n
    for e in range(1, n):
        marked[e] = marked[tree.parent[e]] or tree.landmark[e]
    gain = [0.0 if silent[b.at] else g * (LANDMARK_WEIGHT if marked[b.at] else 1.0) for g, b in zip(fused, tree.blocks, strict=True)]
    # What counts is the text of articles that no name touches; if they have too little, of all articles; then all text.
    for counts in ([marked[b.at] and not named[b.at] for b in tree.blocks], [marked[b.at] for b in tree.blocks]):
        some = [g * c for g, c in zip(gain, counts, strict=True)]
        if sum(some) > LANDMARK_SHARE * sum(gain):
            gain = some
            break
    held = tree.below(gain)
    linked, chars = tree.below([min(b.linked, len(b.text)) for b in tree.blocks]), tree.below([len(b.text) for b in tree.blocks])
    weight, bare = [1.0] * n, [1.0] * n
    for e in range(1, n):
        up, said = tree.parent[e], tree.said[e]
        factor = WEIGHTS[said] if said in WEIGHTS and (silent[e] if said == "readers" else 2 * held[e] <= held[0]) else 1.0
        if said == "doubtful":
            factor = 1 - linked[e] / max(chars[e], 1)
        if marked[e] and not marked[up] and weight[up] * factor >= 1:
            factor *= LANDMARK_WEIGHT
        weight[e] = weight[up] * factor
        bare[e] = bare[up] * (1.0 if said == "header" else factor)
    return weight, bare


def smoothed(tree: Tree, values: list[float], weight: list[float]) -> list[float]:
    """Values averaged by a Gaussian along the page, among blocks of one container and one weight."""
    kernel = [math.exp(-d * d / 2) for d in range(RADIUS + 1)]
    homes: dict[tuple[int, float], int] = {}
    home = [homes.setdefault((tree.parent[b.at] if tree.tag[b.at] in LEAVES else b.at, weight[b.at]), len(homes)) for b in tree.blocks]
    out = []
    for i, v in enumerate(values):
        total, of = v, 1.0
        for j in range(max(0, i - RADIUS), min(len(values), i + RADIUS + 1)):
            if home[j] == home[i] and j != i:
                total += kernel[abs(i - j)] * values[j]
                of += kernel[abs(i - j)]
        out.append(total / of)
    return out


def _path_means(tree: Tree, values: list[float]) -> list[float]:
    """For each block its path's mean value, a character counting once."""
    sums: dict[int, list[float]] = {}
    for b, v in zip(tree.blocks, values, strict=True):
        s = sums.setdefault(tree.path[b.at], [0.0, 0.0])
        s[0] += v * len(b.text)
        s[1] += len(b.text)
    return [sums[tree.path[b.at]][0] / sums[tree.path[b.at]][1] for b in tree.blocks]


def _content_root(tree: Tree, gain: list[float]) -> int:
    """The innermost element, from the root on, that holds a SHARE of all gains and is no text of its own."""
    held = tree.below(gain)
    own = [0.0] * len(tree.tag)
    for b, g in zip(tree.blocks, gain, strict=True):
        own[b.at] += g
    top = list(range(len(tree.tag)))  # of every element the child that holds most, or itself
    for e in range(1, len(tree.tag)):
        if tree.tag[e] not in LEAVES and (tree.landmark[e] or 2 * own[e] < held[e]):
            up = tree.parent[e]
            if top[up] == up or held[e] > held[top[up]]:
                top[up] = e
    here = 0
    while top[here] != here and held[top[here]] >= SHARE * held[0]:
        here = top[here]
    return here


def main_text(page: str | None) -> str:
    """The article of a page; empty if there is none."""
    tree = Tree(page or "")
    if not tree.blocks:
        return ""
    ratios = path_ratios(tree)
    of_path = {path: sums.fused() for path, sums in ratios.items()}
    fused = [of_path[tree.path[b.at]] for b in tree.blocks]
    weight, bare = name_weights(tree, ratios, fused)
    plain = _path_means(tree, smoothed(tree, fused, weight))
    values = [v * weight[b.at] for v, b in zip(plain, tree.blocks, strict=True)]
    # The level is that of blocks on which no name weighs, if there are any.
    sizes = [len(b.text) if weight[b.at] >= 1 else 0 for b in tree.blocks]
    sizes = sizes if any(sizes) else [len(b.text) for b in tree.blocks]
    level = LEVEL * min(sum(v * s for v, s in zip(values, sizes, strict=True)) / sum(sizes), LEVEL_MEAN)
    chosen = [v >= level and v > 0 for v in values]
    root = _content_root(tree, [v * len(b.text) * c for v, b, c in zip(values, tree.blocks, chosen, strict=True)])
    inside = [e == root for e in range(len(tree.tag))]
    for e in range(1, len(inside)):
        inside[e] = inside[e] or inside[tree.parent[e]]
    out = []
    for b, v, c in zip(tree.blocks, plain, chosen, strict=True):
        # A heading in the article's own header is a title.
        title = tree.tag[b.at] in HEADINGS and tree.tag[root] not in ("", "html", "body") and v * bare[b.at] >= level
        if inside[b.at] and (c or title):
            out.append(b.text)
    return " ".join(out) if any(chosen) else ""


@F.pandas_udf(T.StringType())
def main_text_udf(pages: pd.Series) -> pd.Series:
    return pd.Series([main_text(p) for p in pages], dtype=object)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row of pages.

    A null or empty html, and a page without an article, give the empty string; pages of any length, depth and markup take
    time in proportion to their length. Null ids and urls stay null; repeated rows give equal rows; an empty table gives none.
    Other columns are not read.
    """
    small_batches(pages.sparkSession)
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), main_text_udf(F.col(html_col)).alias("text"))
    return rows.withColumn("n_chars", F.length("text").cast("long"))


def op1_html(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
