"""The main text of web pages, by a minimum cut between content and boilerplate.

A page becomes a list of blocks: runs of text between the tags that begin or end a block.
Each block has a cost for being called content and one for being called boilerplate, in
thousandths of a logarithm of odds; they are the capacities of its edges to the two
terminals. Blocks that follow each other, and blocks that are next of kin below one element,
are joined by edges as well, which cost when the two are called differently. The maximum
flow between the terminals finds the labels of least total cost.

The costs add what elements and their names say (``<nav>``, ``class="comments"``,
``<article>``) and what the text is like: share of links, number and length of words, last
sign, commas, kind of element. The latter is learned: blocks of a sample of pages that their
elements place for sure count as examples, and each trait of a block adds the logarithm of
how much more often it occurs in content. So it decides where the elements say nothing.
"""

from __future__ import annotations

import html as references
import math
import re
from collections import deque
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.llm.batches import opened, shared

# Elements that begin and end a block, those whose content is no text, those
# that only hold boilerplate, and those that close by themselves.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr "
    "html legend li main menu nav ol option p pre search section summary table tbody td tfoot "
    "th thead tr ul".split()
)
SILENT = "script|style|title|textarea|template|iframe|noscript|noframes|svg|math|select|button|object|audio|video|canvas"
BOILERPLATE = frozenset("nav footer aside form menu dialog search head".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {
    "li": ("li",), "p": ("p",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
}
# Names (of classes, ids and roles) of boilerplate and of content.
BAD_NAMES = frozenset(
    "ad ads adsbygoogle advert advertisement advertising alert banner breadcrumb breadcrumbs "
    "comment comments commentlist complementary consent contentinfo cookie cookies copyright "
    "dialog disqus disclaimer footer gdpr legal login masthead menu modal nav navbar navigation "
    "newsletter notice notices notification outbrain overlay pager pagination paywall popup "
    "promo promoted promotion recommended related replies reply respond responses search share "
    "sharing sidebar signup skip social sponsor sponsored subscribe subscription taboola "
    "tagcloud teaser toolbar topbar warning widget widgets".split()
)
GOOD_NAMES = frozenset("article articlebody content entry main post story".split())
PAGE_WIDE = frozenset(("html", "body", "main", "article"))

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({SILENT})\b[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*>"
    r"""|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>"']++|"[^"]*"|'[^']*')*+|[^>]*)>""",
    re.DOTALL | re.IGNORECASE,
)
NAMED = re.compile(r"""\b(class|id|role|style)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)|\b(hidden)\b""", re.IGNORECASE)
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

# Fixed values, in thousandths: what the elements say, and what different labels of two
# neighbours cost.
SURE, DECLARED, NAMED_CONTENT, HEADLINE = 12_000, 4_000, 1_500, 1_000
NEXT, KIN = 700, 900
MOST_LEARNED = 3_000

#: Pages whose blocks the traits are learned from, on average.
SAMPLE_PAGES = 4_000


class Block:
    """Text of one block, and what its surroundings say."""

    __slots__ = ("parts", "linked", "tag", "parent", "bad", "declared", "named")

    def __init__(self, tag, parent, bad, declared, named):
        self.parts, self.linked = [], 0
        self.tag, self.parent, self.bad, self.declared, self.named = tag, parent, bad, declared, named

    @property
    def text(self) -> str:
        return " ".join("".join(self.parts).split())


def names_in(attributes: str) -> set[str]:
    found = set()
    for kind, value, hidden in NAMED.findall(attributes):
        if hidden:
            found.add("advert")
        elif kind.lower() == "style":
            if "display:none" in value.replace(" ", "").lower():
                found.add("advert")
        else:
            found.update(part.lower() for part in PARTS.findall(value))
    return found


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page that have text, in order. Damaged markup is read as far as it
    goes: what is never closed ends with the element around it."""
    # An open element: name, number, boilerplate, declared as content, named like content.
    stack = [("", 0, False, False, False)]
    blocks: list[Block] = []
    current: Block | None = None
    links, number, position = 0, 0, 0

    def add(raw: str) -> None:
        nonlocal current
        if current is None:
            if not raw.strip():
                return
            held = next((e for e in reversed(stack) if e[0] in BLOCKS), stack[0])
            around = held if held[0] not in ("p", "li", "h1", "h2", "h3", "h4", "h5", "h6") else next(
                (e for e in reversed(stack) if e[1] < held[1] and (e[0] in BLOCKS or not e[0])), stack[0]
            )
            top = stack[-1]
            current = Block(held[0], around[1], top[2], top[3], top[4])
            blocks.append(current)
        text = references.unescape(raw) if "&" in raw else raw
        current.parts.append(text)
        if links:
            current.linked += len(text)

    for token in TOKEN.finditer(page):
        start = token.start()
        if start > position:
            add(page[position:start])
        position = token.end()
        name = token.group(3)
        if name is None:
            continue
        name = name.lower()
        if token.group(2):
            if name == "a":
                links = max(links - 1, 0)
            if name in BLOCKS:
                current = None
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == name:
                    del stack[depth:]
                    break
                # An inline element does not end the block that it stands in.
                if name not in BLOCKS and stack[depth][0] in BLOCKS:
                    break
            continue
        if name == "br":
            if current is not None:
                current.parts.append(" ")
            continue
        if name in BLOCKS:
            current, links = None, 0
        if name in VOID:
            continue
        for closed in (CLOSES.get(name, ()), ("p",) if name in BLOCKS else ()):
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] in closed:
                    del stack[depth:]
                    break
                if stack[depth][0] in BLOCKS:
                    break
        if name == "a":
            links += 1
        attributes = token.group(4)
        _, _, bad, declared, named = stack[-1]
        if name in ("article", "main"):
            declared = True
        elif name in BOILERPLATE or (name == "header" and not declared):
            bad = True
        if "=" in attributes or "hidden" in attributes:
            if name not in PAGE_WIDE:
                names = names_in(attributes)
                good = not names.isdisjoint(GOOD_NAMES)
                if not names.isdisjoint(BAD_NAMES) or ("header" in names and not declared and not good):
                    bad = True
                named = named or good
        number += 1
        stack.append((name, number, bad, declared, named))
    if position < len(page):
        add(page[position:])
    return [block for block in blocks if block.text]


def traits(block: Block, text: str) -> list[tuple[str, int]]:
    """What the text of a block is like, each trait in a few steps."""
    words = text.count(" ") + 1
    size = len(text)
    share = min(block.linked / size, 1.0)
    kind = 0 if block.tag == "p" else 1 if block.tag == "li" else 2 if block.tag[:1] == "h" else 3
    return [
        ("links", int(share * 4)),
        ("words", min(int(math.log2(words)), 8)),
        ("word_length", min(int(size / words), 12)),
        ("end", 0 if text[-1] in ".!?…" else 1 if text[-1] in ":;,»\"”" else 2),
        ("commas", min(int(8 * text.count(",") / words), 4)),
        ("kind", kind),
    ]


def placed(block: Block) -> bool | None:
    """Content, boilerplate, or not sure, from the elements around a block alone."""
    if block.bad:
        return False
    return True if block.declared or block.named else None


def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many blocks of content and of boilerplate have each trait."""
    counts: dict[tuple[str, int], list[int]] = {}
    for batch in batches:
        for page in batch.column(0).to_pylist():
            for block in blocks_of(page or ""):
                is_content = placed(block)
                if is_content is not None:
                    for trait in traits(block, block.text):
                        counts.setdefault(trait, [0, 0])[is_content] += 1
    rows = [(*trait, *both) for trait, both in counts.items()]
    if rows:
        columns = [pa.array(c) for c in zip(*rows, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, ["trait", "step", "boilerplate", "content"])


def train(pages: DataFrame, sample: int = SAMPLE_PAGES) -> dict[tuple[str, int], float]:
    """Logarithm of how much more often each trait occurs in content than in boilerplate,
    from pages drawn by a hash, ``sample`` of them on average. Only counts of traits, of which
    there are some dozens, leave the tasks. Without examples no trait says anything."""
    total = pages.count()
    if not total:
        return {}
    drawn = pages
    if total > sample:
        share = int(sample / total * 2**32)
        drawn = pages.where(F.crc32(F.coalesce(F.col("html"), F.lit("")).cast("binary")) < share)
    counted = (
        drawn.select("html")
        .mapInArrow(examples, "trait string, step bigint, boilerplate bigint, content bigint")
        .groupBy("trait", "step")
        .agg(F.sum("boilerplate").alias("boilerplate"), F.sum("content").alias("content"))
        .collect()
    )
    whole: dict[str, list[int]] = {}
    for row in counted:
        both = whole.setdefault(row.trait, [0, 0])
        both[0] += row.boilerplate
        both[1] += row.content
    return {
        (r.trait, r.step): math.log((r.content + 1) / (whole[r.trait][1] + 10))
        - math.log((r.boilerplate + 1) / (whole[r.trait][0] + 10))
        for r in counted
    }


def leaning(block: Block, text: str, declared: bool, odds: Mapping[tuple[str, int], float]) -> int:
    """Cost of calling a block boilerplate less that of calling it content."""
    # Traits go together, so each counts by a half.
    learned = sum(odds.get(trait, 0.0) for trait in traits(block, text)) * 500
    cost = int(max(-MOST_LEARNED, min(MOST_LEARNED, learned)))
    if not odds:
        cost += 800 if text.count(" ") > 8 else -800
    if block.bad:
        cost -= SURE
    if block.declared:
        cost += DECLARED
    elif declared:
        cost -= DECLARED
    if block.named:
        cost += NAMED_CONTENT
    if block.tag == "h1":
        cost += HEADLINE
    return cost


def cut(costs: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes are on the side of the source in a minimum cut. A node with positive cost
    has an edge of that capacity from the source, with negative cost one to the sink; the
    given edges hold in both directions.

    A node whose terminal edge outweighs all its other edges stays on its side, and its
    edges become part of its neighbours' costs; the flow is sent through what is left."""
    n = len(costs)
    near: list[dict[int, int]] = [{} for _ in range(n)]
    for a, b, weight in edges:
        near[a][b] = near[a].get(b, 0) + weight
        near[b][a] = near[b].get(a, 0) + weight
    left, side = list(costs), [None] * n
    waiting = deque(range(n))
    while waiting:
        node = waiting.popleft()
        if side[node] is None and abs(left[node]) >= sum(near[node].values()):
            side[node] = left[node] > 0
            for other, weight in near[node].items():
                left[other] += weight if side[node] else -weight
                del near[other][node]
                if side[other] is None:
                    waiting.append(other)
            near[node] = {}
    rest = [i for i in range(n) if side[i] is None]
    if rest:
        reached = source_side({i: left[i] for i in rest}, near)
        for i in rest:
            side[i] = i in reached
    return side


def source_side(costs: dict[int, int], near: list[dict[int, int]]) -> set[int]:
    """Nodes that the source still reaches after a maximum flow, sent by Dinic's method along
    shortest ways."""
    source, sink = -1, -2
    spare: dict[int, dict[int, int]] = {source: {}, sink: {}}
    for node, cost in costs.items():
        spare[node] = dict(near[node])
    for node, cost in costs.items():
        if cost > 0:
            spare[source][node], spare[node][source] = cost, 0
        else:
            spare[node][sink], spare[sink][node] = -cost, 0
    while True:
        level = {source: 0}
        queue = deque([source])
        while queue:
            node = queue.popleft()
            for other, room in spare[node].items():
                if room > 0 and other not in level:
                    level[other] = level[node] + 1
                    queue.append(other)
        if sink not in level:
            return set(level) - {source}
        ahead = {node: iter(list(rooms)) for node, rooms in spare.items()}
        way = [source]
        while way:
            node = way[-1]
            if node == sink:
                pairs = list(zip(way, way[1:], strict=False))
                sent = min(spare[a][b] for a, b in pairs)
                for a, b in pairs:
                    spare[a][b] -= sent
                    spare[b][a] += sent
                full = next(k for k, (a, b) in enumerate(pairs) if not spare[a][b])
                del way[full + 1 :]
                continue
            for other in ahead[node]:
                if spare[node][other] > 0 and level.get(other) == level[node] + 1:
                    way.append(other)
                    break
            else:
                way.pop()
                if way:
                    level[node] = -1


def main_text(page: str, odds: Mapping[tuple[str, int], float]) -> str:
    """Blocks called content, one to a line."""
    blocks = blocks_of(page)
    if not blocks:
        return ""
    texts = [block.text for block in blocks]
    declared = any(block.declared and not block.bad for block in blocks)
    costs = [leaning(b, t, declared, odds) for b, t in zip(blocks, texts, strict=True)]
    edges = [(i, i + 1, NEXT) for i in range(len(blocks) - 1)]
    last: dict[int, int] = {}
    for i, block in enumerate(blocks):
        if block.parent in last:
            edges.append((last[block.parent], i, KIN))
        last[block.parent] = i
    labels = cut(costs, edges)
    return "\n".join(text for text, content in zip(texts, labels, strict=True) if content)


def extracted(pages: DataFrame, odds: Mapping[tuple[str, int], float]) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` (code points) of every page.

    A null or empty page has the empty text, as has one without any content. Repeated rows
    give a row each; null ids and addresses stay; other columns are not looked at."""
    sent = shared(pages.sparkSession, dict(odds))
    kept = pages.select("page_id", "url", "html")
    schema = T.StructType([
        *kept.schema.fields[:2],
        T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType()),
    ])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = opened(sent)
        for batch in batches:
            texts = [main_text(page or "", known) for page in batch.column(2).to_pylist()]
            sizes = np.array([len(text) for text in texts], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(sizes)],
                ["page_id", "url", "text", "n_chars"],
            )

    return kept.mapInArrow(extract, schema)
