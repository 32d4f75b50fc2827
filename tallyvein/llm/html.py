"""Main text of web pages by minimum-cut labelling.

A page becomes a row of text blocks. A linear classifier over each block's words, links and surrounding
elements gives the cost of calling it content or boilerplate; these costs are the terminal capacities of
a graph in which consecutive blocks, and consecutive blocks of one parent, are joined by smoothness edges.
The minimum cut is the labelling of least total cost, found by maximum flow.
"""

from __future__ import annotations

import html as references
import re
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|title|textarea|template|noscript|iframe|select|button)\b[^>]*+(?:(?<=/)>|>.*?(?:</(?P=raw)\s*+>|\Z))"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*+)(?P<attributes>(?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[a-z][^>]*+(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|style|aria-hidden|aria-label)\b(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?", re.I)
_NAME = re.compile(r"[a-z]+")
#: A closing line on rights: a short block that dates a copyright or reserves all rights.
_RIGHTS = re.compile(r"(?:©|\(c\)|\bcopyright\b)[\s©]*(?:\(c\)\s*)?(?:19|20)\d\d\b|\ball rights reserved\b", re.I)
RIGHTS_WORDS = 25

_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements whose start ends an open one of the same kind in the same parent.
_IMPLIED = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_EMPTY = frozenset(["hr"])

#: The classifier: evidence for content (positive) of the elements around a block, counted once each.
ELEMENTS = {"article": 30, "main": 30, "nav": -70, "footer": -70, "aside": -70, "form": -70, "menu": -70, "dialog": -70, "fieldset": -40, "header": -70}
#: Of words in class, id and role.
WORDS = {
    **dict.fromkeys("article content entry main post story".split(), 10),
    **dict.fromkeys("comment comments commentlist disqus reply replies respond discussion".split(), -80),
    **dict.fromkeys("ad ads adv advert advertisement advertising adbox adslot sponsor sponsored promo promotion banner".split(), -80),
    **dict.fromkeys(
        "breadcrumb breadcrumbs byline complementary consent contentinfo cookie cookies copyright dialog footer gdpr header login masthead menu modal"
        " nav navbar navigation newsletter notice pagination popup related search share sharing sidebar signup social subscribe tags toolbar widget".split(), -70
    ),
}
#: Words that make the rest of a class say what a layout has or lacks, not what the element is.
LAYOUT = frozenset("with without no not has hide show is".split())
HIDDEN, RIGHTS = -80, -70
LINKED, WORDY = -25, 10
ADJACENT, SIBLING = 6, 4


class Block:
    __slots__ = ("text", "linked", "parent", "evidence")

    def __init__(self, text: str, linked: float, parent: int, evidence: int):
        self.text, self.linked, self.parent, self.evidence = text, linked, parent, evidence

    def score(self) -> int:
        """Cost of boilerplate less cost of content."""
        words = 1 + self.text.count(" ")
        # Inside an element that says it is content, a line on rights is the author's.
        rights = RIGHTS if self.evidence <= 0 and words <= RIGHTS_WORDS and _RIGHTS.search(self.text) else 0
        return self.evidence + round(LINKED * self.linked) + min(WORDY, 1 + words) + rights


def _named(tag: str, value: str) -> set[str]:
    """The words of a class, id or role that tell what the element is.

    Each name between spaces is read by itself. Names that begin with a word of ``LAYOUT`` describe the
    page around. Reasons against count in names of at most two words, or as the last word of a longer
    one, which otherwise is a title made into a name; on an article or main element only as a whole name.
    """
    found = set()
    for name in value.split():
        words = _NAME.findall(name)
        if not words or words[0] in LAYOUT:
            continue
        told = words if len(words) <= 2 else words[-1:]
        if tag in ("article", "main") and len(words) > 1:
            told = []
        found.update(w for w in told if WORDS.get(w, 0) < 0)
        found.update(w for w in words if WORDS.get(w, 0) > 0)
    return found


def _evidence(tag: str, attributes: str, inside: frozenset) -> frozenset:
    """The kinds of evidence that hold inside an element."""
    found = set()
    if tag in ELEMENTS and not (tag == "header" and ("article" in inside or "main" in inside)):
        found.add(tag)
    if attributes:
        for name, a, b, c in _ATTRIBUTE.findall(attributes):
            value, name = (a or b or c).lower(), name.lower()
            if name in ("class", "id", "role"):
                # The page as a whole says nothing about its parts.
                if tag not in ("html", "body"):
                    found.update(_named(tag, value))
            elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                found.add("hidden")
    return inside | found if found else inside


def _weight(kinds: frozenset) -> int:
    """Content words count once, and the strongest reason against counts once."""
    values = [HIDDEN if k == "hidden" else ELEMENTS.get(k) or WORDS[k] for k in kinds]
    return max((v for v in values if v > 0), default=0) + min((v for v in values if v < 0), default=0)


def blocks(page: str) -> list[Block]:
    """Text blocks in page order, references decoded and white space made single spaces."""
    out: list[Block] = []
    stack: list[tuple[str, int, frozenset]] = [("", 0, frozenset())]
    weights: dict[frozenset, int] = {frozenset(): 0}
    parts: list[str] = []
    linked, link, number, at = 0, 0, 0, 0

    def flush() -> None:
        nonlocal linked
        if parts:
            raw = "".join(parts)
            text = " ".join((references.unescape(raw) if "&" in raw else raw).split())
            if text:
                kinds = stack[-1][2]
                if kinds not in weights:
                    weights[kinds] = _weight(kinds)
                # Siblings are blocks below one parent: of a leaf element, the element around it.
                parent = stack[-2][1] if len(stack) > 1 and stack[-1][0] in _LEAVES else stack[-1][1]
                out.append(Block(text, min(1.0, linked / max(1, len(raw))), parent, weights[kinds]))
            parts.clear()
        linked = 0

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            piece = page[at : m.start()]
            parts.append(piece)
            if link:
                linked += len(piece)
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag not in _BLOCKS:
            if tag == "a":
                link = 0 if m["end"] else 1
            elif tag in ("br", "img", "input"):
                parts.append(" ")
            continue
        flush()
        link = 0
        if m["end"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
            continue
        if tag in _EMPTY:
            continue
        if tag in _IMPLIED:
            while len(stack) > 1 and stack[-1][0] in _IMPLIED[tag]:
                stack.pop()
        elif stack[-1][0] == "p":
            stack.pop()
        number += 1
        stack.append((tag, number, _evidence(tag, m["attributes"], stack[-1][2])))
    if at < len(page):
        parts.append(page[at:])
    flush()
    return out


_LEAVES = frozenset("p li dt dd td th h1 h2 h3 h4 h5 h6 pre figcaption caption summary legend".split())


def minimum_cut(scores: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Labels of least cost: a negative score costs when kept, a positive one when left, an edge when cut.

    ``edges`` are (node, node, capacity), in both directions. Of equal cuts the one that keeps least.
    """
    left = list(scores)  # positive: what the source can still send; negative: what the sink can still take
    around: list[list[int]] = [[] for _ in scores]  # arc e leads to ends[e], its reverse is e ^ 1
    ends: list[int] = []
    room: list[int] = []
    for a, b, capacity in edges:
        around[a].append(len(ends))
        around[b].append(len(ends) + 1)
        ends += (b, a)
        room += (capacity, capacity)
    while True:
        sources = [i for i, s in enumerate(left) if s > 0]
        level = [-1] * len(left)
        for i in sources:
            level[i] = 0
        queue, reached = deque(sources), False
        while queue:
            i = queue.popleft()
            for e in around[i]:
                j = ends[e]
                if level[j] < 0 and room[e] > 0:
                    level[j] = level[i] + 1
                    reached = reached or left[j] < 0
                    queue.append(j)
        if not reached:
            return [depth >= 0 for depth in level]
        # A blocking flow: paths only go down the levels, and an arc found useless is not tried again.
        tried = [0] * len(left)
        for source in sources:
            path, i = [], source
            while left[source] > 0:
                if left[i] < 0:
                    flow = min(left[source], -left[i], min(room[e] for e in path))
                    left[source] -= flow
                    left[i] += flow
                    for e in path:
                        room[e] -= flow
                        room[e ^ 1] += flow
                    path, i = [], source
                    continue
                arcs = around[i]
                while tried[i] < len(arcs) and not (room[arcs[tried[i]]] > 0 and level[ends[arcs[tried[i]]]] == level[i] + 1):
                    tried[i] += 1
                if tried[i] < len(arcs):
                    path.append(arcs[tried[i]])
                    i = ends[path[-1]]
                elif path:
                    i = ends[path.pop() ^ 1]
                    tried[i] += 1
                else:
                    break


def smoothness(found: list[Block]) -> list[tuple[int, int, int]]:
    edges, before = [], {}
    for i, b in enumerate(found):
        if i:
            edges.append((i - 1, i, ADJACENT))
        if b.parent in before:
            edges.append((before[b.parent], i, SIBLING))
        before[b.parent] = i
    return edges


def main_blocks(page: str) -> list[str]:
    found = blocks(page)
    kept = minimum_cut([b.score() for b in found], smoothness(found))
    return [b.text for b, keep in zip(found, kept) if keep]


def extract_main(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id_col, *keep, text, n_blocks) of every row: the blocks labelled content, joined by line feeds.

    Null and empty pages, and those without content, have an empty text. Broken markup is read as far as
    it goes and never fails. Rows are independent: repeated rows give equal rows, ids may be null, other
    columns are not looked at.
    """
    columns = pages.select(F.col(id_col), *keep, F.col(html_col).cast("string").alias("_html"))
    n = len(columns.columns) - 1

    def run(batches):
        for batch in batches:
            texts, counts = [], []
            for page in batch.column(n):
                main = main_blocks(page.as_py() or "")
                texts.append("\n".join(main))
                counts.append(len(main))
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(texts, pa.string()), pa.array(counts, pa.int64())], [*batch.schema.names[:n], "text", "n_blocks"])

    schema = StructType([*columns.schema[:n], StructField("text", StringType()), StructField("n_blocks", LongType())])
    return columns.mapInArrow(run, schema)
