"""Main text of web pages: flat blocks classified by a decision tree.

A page becomes a flat list of text blocks.  A block is described by its number of
words and its link density, by the same of the blocks before and after it, by
whether it is a heading, and by the nearest enclosing element that says what it
holds.  A decision tree, grown from the small labelled table below, keeps the
blocks of the article.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>", re.DOTALL
)
_ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_UNFINISHED = re.compile(r"<[a-zA-Z/!?][^<>]*\Z")
_PARTS = re.compile(r"[a-z]+|[^a-z\s_-]+")

# Elements by how they are laid out, and names that tell what an element holds.
UNSEEN = frozenset("script style template noscript title textarea svg iframe object select datalist option canvas audio video".split())
#: Of these, nothing but their own end tag is markup inside.
RAW = frozenset("script style title textarea iframe".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
SPACES = frozenset("br wbr img input".split())
CONTAINERS = BLOCKS - frozenset("hr h1 h2 h3 h4 h5 h6 pre body html head".split())
#: Elements whose end tag may be left out: a start tag of the first kind ends an open one of the second,
#: unless an element of the third kind was opened in between.
LEFT_OUT = {
    "li": (frozenset(["li"]), frozenset("ul ol menu".split())),
    "dd": (frozenset("dd dt".split()), frozenset(["dl"])),
    "dt": (frozenset("dd dt".split()), frozenset(["dl"])),
    "td": (frozenset("td th".split()), frozenset("table tr".split())),
    "th": (frozenset("td th".split()), frozenset("table tr".split())),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
AROUND = frozenset("nav footer aside form menu dialog header button".split())
MAIN = frozenset("article main".split())
AROUND_NAMES = frozenset(
    "ad ads adbox advert adverts advertisement banner breadcrumb breadcrumbs byline comment comments consent contentinfo cookie "
    "cookies copyright dialog disqus footer form header login masthead menu modal nav navbar navigation newsletter notice "
    "overlay pager pagination popup promo related reply replies respond search share sharing sidebar signup skip social "
    "sponsor sponsored subscribe tags toolbar widget".split()
)
#: Of these, what is long may still be the article: a page's wrapper can have such a name.
LOOSE_NAMES = frozenset(
    "banner byline copyright footer form header menu nav navbar navigation related search share sharing sidebar social tags toolbar widget".split()
)
#: Of these, an article inside is one of theirs.
AROUND_ARTICLES = frozenset("comment comments disqus related replies reply respond".split())
MAIN_NAMES = frozenset("article articlebody entry main post story".split())
#: Words of a class or id that say nothing of what is held; with others than these and the names, as in
#: ``has-sidebar`` or ``comments-open``, a class tells of something else and gives no hint.
NEUTRAL = frozenset(
    "area bar block body bottom box container content first global group home inner item items last link links list outer page "
    "panel posts articles primary row secondary section site text title top unit wrap wrapper".split()
)
#: What a class or id of a loose name says is weaker than what an element or an ARIA role says.
WEAK = -0.5

#: A small labelled table: words, link density, the same of the block before and after, the nearest
#: telling element (1 article, -1 something around it, -0.5 that by its class or id only, 0 none), heading,
#: and whether it is main text.
LABELLED = """
120 0.00  80 0.00  90 0.00  0 0 1
 60 0.05  90 0.00  40 0.10  0 0 1
 35 0.00  60 0.00  70 0.00  0 0 1
 12 0.00  60 0.00  80 0.00  0 0 1
  4 0.00  70 0.00  90 0.00  0 0 1
 25 0.10  80 0.00  15 0.00  0 0 1
 45 0.20  10 1.00  60 0.00  0 0 1
  6 0.00   5 1.00  80 0.00  0 1 1
  9 0.00   3 1.00  50 0.00  0 1 1
 80 0.00  60 0.00   6 0.00  0 0 1
 45 0.00  70 0.00   3 1.00  0 0 1
150 0.00   5 1.00   4 0.00  0 0 1
 50 0.00   0 0.00   0 0.00  0 0 1
 70 0.10   2 1.00   8 0.20  0 0 1
 30 0.00   7 0.00  45 0.00  0 0 1
 28 0.00  35 0.00   5 0.00  0 0 1
 20 0.00   2 1.00  20 0.00  0 0 1
 19 0.00  20 0.00   1 1.00  0 0 1
 17 0.00  18 0.00  19 0.00  0 0 1
 16 0.00  30 0.00   4 0.00  0 0 1
 18 0.05   3 1.00  25 0.00  0 0 1
 95 0.00   1 1.00  95 0.00  0 0 1
 80 0.05   2 1.00  70 0.00  0 0 1
 40 0.00   3 1.00  80 0.00  0 0 1
 60 0.00   1 1.00 120 0.00  0 0 1
 25 0.00   1 1.00  75 0.00  0 0 1
  4 0.00   1 1.00  80 0.00  0 1 1
  3 0.00  60 0.00  70 0.00  0 0 1
  3 0.00  18 0.00  20 0.00  0 0 1
  2 0.00  40 0.00  30 0.00  0 0 1
  5 0.00  25 0.00  90 0.00  0 0 1
 14 0.00  40 0.00  35 0.00  0 0 1
  3 0.00  40 0.00   2 1.00  0 1 0
  4 0.00   3 1.00   2 1.00  0 1 0
  1 1.00   1 1.00   1 1.00  0 0 0
  2 1.00   1 1.00   1 1.00  0 0 0
  8 0.90   6 1.00   7 0.80  0 0 0
 30 0.80  20 0.90  25 0.90  0 0 0
 15 0.60   5 0.50  10 0.70  0 0 0
  5 0.00   2 1.00   3 1.00  0 0 0
  9 0.00   3 1.00   0 0.00  0 0 0
  8 0.00   2 1.00   6 0.00  0 0 0
  1 1.00   1 1.00  90 0.00  0 0 0
  5 1.00  80 0.00   6 1.00  0 0 0
  7 0.00  90 0.00   0 0.00  0 0 0
 11 0.00  60 0.00   1 1.00  0 0 0
 22 0.70  80 0.00  40 0.00  0 0 0
  7 0.00   0 0.00   4 1.00  0 0 0
 10 0.30   8 0.50   0 0.00  0 0 0
  6 0.00   5 0.00   0 0.00  0 0 0
120 0.00  80 0.00  90 0.00  1 0 1
 40 0.10   8 0.00  20 0.00  1 0 1
  2 0.00  30 0.00  60 0.00  1 0 1
  1 0.00   9 0.00   0 0.00  1 0 1
  5 0.00   1 1.00   9 0.00  1 0 1
  3 0.00   4 0.00   3 1.00  1 0 1
  8 0.00   4 0.00   3 0.00  1 0 1
 20 0.50  40 0.00  30 0.00  1 0 1
 10 0.00   6 1.00  50 0.00  1 1 1
  3 0.00  60 0.00  40 0.00  1 1 1
  2 0.00   1 1.00  80 0.00  1 1 1
 11 0.00   8 0.00  70 0.00  1 1 1
 14 0.00   6 0.00  68 0.00  1 1 1
 10 0.00  10 0.00  70 0.00  1 0 1
 12 0.00   5 0.00  67 0.00  1 0 1
  6 0.00   2 1.00  90 0.00  1 1 1
  3 0.00   1 1.00  70 0.00  1 0 1
 50 0.00   1 1.00  90 0.00  1 0 1
  3 0.00  40 0.00   4 0.00  1 0 1
 12 0.00  30 0.00   3 0.00  1 0 1
  4 0.00   2 0.00   2 0.00  1 0 1
 28 0.00   9 0.00   2 0.00  1 0 1
  9 0.00   1 1.00   3 0.00  1 0 1
 16 0.00   6 0.00   0 0.00  1 0 1
  7 0.00   1 1.00   5 0.00  1 0 1
  5 0.00   1 0.00  12 0.00  1 0 1
 26 0.00   8 0.00   1 0.00  1 0 1
  9 0.30   2 0.00   7 0.00  1 0 1
 11 0.00   2 0.00  60 0.00  1 0 1
  2 0.00   8 0.00   9 0.00  1 0 1
  1 0.00   2 0.00   9 0.00  1 0 1
 10 0.00   4 0.00   2 0.00  1 0 1
  8 0.00  60 0.00   2 0.00  1 0 1
 12 0.00  70 0.00   2 0.00  1 0 1
  6 0.00   3 1.00   2 0.00  1 0 1
 20 0.00   3 1.00   2 0.00  1 0 1
 13 0.00  12 0.00   2 0.00  1 0 1
  5 0.00  15 0.00   1 1.00  1 0 1
 11 0.00   9 0.00   0 0.00  1 0 1
  3 0.00   5 0.00  12 0.00  1 0 1
  9 0.00  20 0.00  11 0.00  1 0 1
  4 0.00  90 0.00  10 0.00  1 0 1
  2 0.00  70 0.00  60 0.00  1 0 1
  7 0.00   7 0.00  70 0.00  1 0 1
  1 0.00   1 0.00   1 0.00  1 0 1
 30 0.20   1 0.00   1 0.00  1 0 1
  8 0.00   0 0.00   6 0.00  1 0 1
  2 1.00  90 0.00   3 1.00  1 0 0
  6 1.00   5 1.00   4 1.00  1 0 0
 90 0.00  70 0.00  60 0.00 -1 0 0
 75 0.00  90 0.00   4 0.00 -1 0 0
 55 0.00   1 1.00  80 0.00 -1 0 0
 40 0.00  10 0.00  30 0.00 -1 0 0
 12 0.00  60 0.00  80 0.00 -1 0 0
  9 0.00   1 1.00  10 0.00 -1 0 0
  5 0.20  30 0.00   0 0.00 -1 0 0
  1 1.00   1 1.00   1 1.00 -1 0 0
  8 0.00   1 1.00   9 0.00 -1 0 0
  6 0.00   5 1.00  80 0.00 -1 1 0
  3 0.00  70 0.00  60 0.00 -1 1 0
150 0.00  80 0.00  90 0.00 -1 0 0
110 0.00   3 1.00   5 0.00 -1 0 0
 70 0.05  90 0.00  20 0.00 -1 0 0
 65 0.00   0 0.00   0 0.00 -1 0 0
 80 0.00   0 0.00  60 0.00 -1 0 0
120 0.00  60 0.00   0 0.00 -1 0 0
 20 0.00   0 0.00 120 0.00 -1 0 0
 30 0.00  60 0.00   0 0.00 -1 0 0
120 0.00  80 0.00  90 0.00 -0.5 0 1
100 0.00   3 1.00   5 0.00 -0.5 0 1
 70 0.05  90 0.00  20 0.00 -0.5 0 1
 65 0.00   0 0.00   0 0.00 -0.5 0 1
 55 0.00   1 1.00  80 0.00 -0.5 0 0
 40 0.00  10 0.00  30 0.00 -0.5 0 0
 23 0.00  60 0.00  80 0.00 -0.5 0 0
 12 0.00  60 0.00  80 0.00 -0.5 0 0
  9 0.00   1 1.00  10 0.00 -0.5 0 0
  8 0.00   1 1.00   9 0.00 -0.5 0 0
  1 1.00   1 1.00   1 1.00 -0.5 0 0
 80 0.70  20 0.90  25 0.90 -0.5 0 0
 90 0.60  70 0.00  60 0.00 -0.5 0 0
  6 0.00   5 1.00  80 0.00 -0.5 1 0
  3 0.00  70 0.00  60 0.00 -0.5 1 0
"""

DEPTH = 9


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = DEPTH) -> tuple:
    """A tree of (feature, threshold, at most, more) by Gini impurity; leaves are (label,)."""
    share = labels.mean()
    if depth == 0 or share in (0.0, 1.0):
        return (bool(share >= 0.5),)
    best = None
    for feature in range(rows.shape[1]):
        values = np.unique(rows[:, feature])
        for threshold in (values[:-1] + values[1:]) / 2:
            low = rows[:, feature] <= threshold
            impurity = sum(part.sum() * (p := labels[part].mean()) * (1 - p) for part in (low, ~low))
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, feature, float(threshold), low)
    if best is None:
        return (bool(share >= 0.5),)
    _, feature, threshold, low = best
    return (feature, threshold, grow(rows[low], labels[low], depth - 1), grow(rows[~low], labels[~low], depth - 1))


@cache
def labelled_tree() -> tuple:
    table = np.array([line.split() for line in LABELLED.strip().splitlines()], float)
    return grow(table[:, :-1], table[:, -1])


def decide(tree: tuple, features: tuple) -> bool:
    while len(tree) > 1:
        tree = tree[2] if features[tree[0]] <= tree[1] else tree[3]
    return tree[0]


@cache
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}(?:[\s/][^>]*)?>", re.IGNORECASE)


def _names(value: str) -> set[str]:
    """Names in a class, id or role of which the whole token says what is held."""
    names: set[str] = set()
    for token in value.lower().split():
        parts = set(_PARTS.findall(token))
        known = parts & (AROUND_NAMES | MAIN_NAMES)
        if all(x in known or x in NEUTRAL or x.isdigit() for x in parts):
            names |= known
    return names


def _role(tag: str, attributes: str, inside: float) -> float | None:
    """1 for an element that holds the article, -1 for one that holds something else, ``WEAK`` if only
    a class or id says so, -2 if whatever it holds is no article, None if it doesn't say."""
    if tag == "main":
        return 1
    if inside == -2:
        return None
    named: set[str] = set()
    aria: set[str] = set()
    if attributes:
        for m in _ATTRIBUTE.finditer(attributes):
            (aria if m[1].lower() == "role" else named).update(_names(m[2] or m[3] or m[4] or ""))
    if named & AROUND_ARTICLES:
        return -2
    if tag == "article":
        return 1
    if aria & AROUND_NAMES or tag in AROUND and not (tag == "header" and inside == 1):
        return -1
    around = named & AROUND_NAMES
    if inside == 1:
        around -= {"header"}  # an article's own, as the element
    if around - LOOSE_NAMES and not (named & MAIN_NAMES):
        return -1
    if around:
        return None if inside == -1 else WEAK
    return 1 if (named | aria) & MAIN_NAMES else None


def blocks(html: str) -> list[tuple[str, int, int, float, int]]:
    """Text blocks in page order: text, words, words in links, nearest telling element, heading."""
    found: list[tuple[str, int, int, float, int]] = []
    parts: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, float]] = []
    inside, heading, in_link, at, pos = 0, 0, False, 0, 0
    unseen, opened, within = "", Counter(), Counter()  # the hidden element, tags open around it and inside it

    def close() -> None:
        if parts:
            words = unescape("".join(parts)).split()
            if words:
                found.append((" ".join(words), len(words), len(unescape("".join(linked)).split()), max(inside, -1), heading))
            parts.clear()
        linked.clear()

    def leave(tags: frozenset[str], barriers: frozenset[str]) -> None:
        """End the innermost open element of ``tags``, with what is open in it, unless a barrier is nearer."""
        nonlocal inside
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in tags:
                inside = stack[k][1]
                del stack[k:]
                return
            if stack[k][0] in barriers:
                return

    def text(upto: int) -> None:
        if upto > at and not unseen:
            parts.append(html[at:upto])
            if in_link:
                linked.append(html[at:upto])

    while m := _TOKEN.search(html, pos):
        pos = m.end()
        tag = m[2].lower() if m[2] else ""
        ends = bool(m[1])
        starts = tag != "" and not ends and not m[3].endswith("/")
        if starts and tag in RAW:
            text(m.start())
            end = _raw_end(tag).search(html, pos)
            at = pos = end.end() if end else len(html)
            continue
        if unseen:
            if starts and not (tag == unseen == "option"):
                within[tag] += 1
            elif ends and within[tag]:
                within[tag] -= 1
            elif ends and (tag == unseen or opened[tag]):
                at = pos if tag == unseen else m.start()
                unseen = ""
                within.clear()
            if unseen or at == pos:
                continue
        text(m.start())
        at = pos
        if not tag:
            continue
        if tag in UNSEEN:
            if starts:
                unseen = tag
            continue
        if not ends:
            opened[tag] += 1
        elif opened[tag]:
            opened[tag] -= 1
        if tag == "a":
            in_link = not ends
            linked.append(" ")
        elif tag in SPACES:
            parts.append(" ")
        elif tag in BLOCKS or tag == "button":
            if ends or "".join(linked).strip():  # a link that has had its text goes no further than its block
                in_link = False
            close()
            heading = int(tag in HEADINGS and not ends)
            if not ends and stack and stack[-1][0] == "p" and tag != "button":
                inside = stack.pop()[1]
            if tag in CONTAINERS or tag == "button":
                if not ends:
                    if tag in LEFT_OUT:
                        leave(*LEFT_OUT[tag])
                    role = _role(tag, m[3], inside)
                    stack.append((tag, inside))
                    inside = inside if role is None else role
                else:
                    leave(frozenset([tag]), frozenset())
    rest = _UNFINISHED.search(html, at)
    text(rest.start() if rest else len(html))
    close()
    return found


def main_text(html: str | None, tree: tuple | None = None) -> str:
    """The article's blocks, joined by an empty line; empty for null, empty or text-free pages."""
    tree = tree or labelled_tree()
    found = blocks(html or "")
    kept = []
    nothing = ("", 0, 0, 0, 0)
    for k, (text, words, links, inside, heading) in enumerate(found):
        before = found[k - 1] if k else nothing
        after = found[k + 1] if k + 1 < len(found) else nothing
        features = (
            words, links / words, before[1], before[2] / max(before[1], 1),
            after[1], after[2] / max(after[1], 1), inside, heading,
        )
        if decide(tree, features):
            kept.append(text)
    return "\n\n".join(kept)


def extract(pages: DataFrame, keep: list[str], html_col: str = "html") -> DataFrame:
    """The columns ``keep`` with ``text``, the main text of the whole page; a row per row, whatever repeats."""
    kinds = {f.name: f.dataType.simpleString() for f in pages.select(*keep).schema}
    tree = labelled_tree()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                texts = [main_text(x.as_py(), tree) for x in part.column(len(keep))]
                yield pa.record_batch([*part.columns[:-1], pa.array(texts, pa.string())], [*keep, "text"])

    schema = ", ".join([*(f"`{c}` {t}" for c, t in kinds.items()), "text string"])
    return pages.select(*keep, pages[html_col].alias("__html")).mapInArrow(apply, schema)
