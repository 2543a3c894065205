"""Near-duplicates by DartMinHash signatures of weighted word shingles.

A text is a weighted set: its shingles of five words, each with the number of times it
occurs. Darts fall on the plane (shingle weight, rank) of every shingle, at places that
depend on the shingle alone. A text throws the darts of the regions below its own weights
and below a rank at which it expects enough of them, deals them to the coordinates of the
signature, and keeps the earliest of each. Two texts share a coordinate with a chance of
their weighted Jaccard similarity. Regions double in size along both axes, so a text looks
at a few regions per shingle and throws few darts that it cannot use.

Texts that share a band of coordinates meet in a bucket and are compared by their signatures;
texts connected by such pairs form groups. Within a group, pairs alike by signature are
compared by the exact similarity of the two texts, but for those that verified links already
connect, and texts connected by verified links form classes. Of a bucket or group too large
for one task, all are compared with one leader by a join, and those not linked with it meet
all others in blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.batches import in_pieces, mixed, passing, stored, texts_of, words_of

SHINGLE = 5
SIMILARITY = 0.8
COORDINATES, BANDS, ROWS = 96, 32, 6
#: Coordinates of 96 that two texts must share to be compared exactly. At a similarity of
#: 0.8 fewer are shared once in a million pairs.
LEAST_SHARED = 58
#: Rows of a bucket that one task compares; of larger ones see ``in_blocks``.
BUCKET_ROWS = 1_000
#: Bytes of text of a group that one task compares.
GROUP_BYTES = 16 * 1024 * 1024
#: Pairs whose links are looked up at once.
PAIRS_AT_ONCE = 4_096
#: Sides of a bucket: rows that meet all others, or rows of the rest that meet rows of all.
EITHER, REST, ALL = 0, 1, 2
#: Rank of the first region; the ones that follow double in size.
FIRST_RANK = 2.0**-10
PIECE_BYTES = 2 * 1024 * 1024
#: Shingles whose regions are looked at at once.
AT_ONCE = 100_000

SIGNATURES_DDL = (
    "doc_id bigint, text_hash bigint, node binary, bands array<bigint>, sketch binary"
)

LINKS_DDL = "center binary, node binary"

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
ODD = np.array(
    [0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3,
     0x1D8E4E27C47D124F], np.uint64,
)
UNIT = 2.0**-53


def shingles_of(column: pa.Array, width: int = SHINGLE):
    """Distinct shingles of all texts: (text number, hash, times), ordered by text and hash,
    and the words. A text with fewer words, but not none, has one shingle of them all."""
    words = words_of(column)
    codes = np.array([xxhash.xxh64_intdigest(t) for t in words.terms.to_pylist()], np.uint64)
    hashed = codes[words.codes] if len(words.codes) else np.zeros(0, np.uint64)
    firsts = words.firsts
    total = np.zeros(len(hashed), np.uint64)
    left = np.repeat(firsts[1:], words.counts) - np.arange(len(hashed))
    for k in range(width):
        part = np.zeros(len(hashed), np.uint64)
        part[: max(len(hashed) - k, 0)] = hashed[k:] * ODD[k % len(ODD)] + np.uint64(k + 1)
        part[left <= k] = 0
        total = mixed(total + part) if k else part
    used = (left >= width) | (left == np.repeat(words.counts, words.counts))
    owner = np.repeat(np.arange(len(words.counts)), words.counts)[used]
    total = mixed(total[used])
    order = np.lexsort((total, owner))
    owner, total = owner[order], total[order]
    new = np.ones(len(total), bool)
    new[1:] = (total[1:] != total[:-1]) | (owner[1:] != owner[:-1])
    heads = np.flatnonzero(new)
    times = np.diff(np.append(heads, len(total)))
    return owner[heads], total[heads], times, words


def _counts_below(area: float) -> np.ndarray:
    """Distribution function of the number of darts in a region of an area (Poisson)."""
    most = int(area + 12 * math.sqrt(area) + 30)
    log = -area + np.cumsum(np.log(area / np.arange(1, most + 1)))
    return np.minimum(np.cumsum(np.concatenate([[math.exp(-area)], np.exp(log)])), 1.0)


TABLES: dict[float, np.ndarray] = {}


def _regions(element, weight, slot, limit, best, names, coordinates):
    """Throw the darts of all regions of some shingles; ``limit`` is each one's rank limit,
    ``slot`` the first place of its text in ``best`` and ``names``."""
    levels = 1 + np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64)
    ranks = 1 + np.maximum(np.ceil(np.log2(limit / FIRST_RANK)), 0).astype(np.int64)
    for a in range(int(levels.max(initial=0))):
        low_w, high_w = (0.0, 1.0) if a == 0 else (2.0 ** (a - 1), 2.0**a)
        for b in range(int(ranks[levels > a].max(initial=0))):
            low_r, high_r = (0.0, FIRST_RANK) if b == 0 else (
                FIRST_RANK * 2.0 ** (b - 1), FIRST_RANK * 2.0**b)
            there = np.flatnonzero((levels > a) & (ranks > b))
            if not len(there):
                continue
            area = (high_w - low_w) * (high_r - low_r)
            if area not in TABLES:
                TABLES[area] = _counts_below(area)
            cell = mixed(element[there] ^ mixed(np.array([1 + a * 64 + b], np.uint64) * GOLDEN))
            chance = (cell >> np.uint64(11)).astype(np.float64) * UNIT
            some = np.flatnonzero(chance > TABLES[area][0])
            if not len(some):
                continue
            number = np.searchsorted(TABLES[area], chance[some], side="left")
            there, cell = there[some], cell[some]
            owner = np.repeat(there, number)
            nth = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
            dart = mixed(np.repeat(cell, number) + (nth + 1).astype(np.uint64) * GOLDEN)
            high = (dart >> np.uint64(11)).astype(np.float64) * UNIT
            again = mixed(dart ^ GOLDEN)
            rank = low_r + (high_r - low_r) * ((again >> np.uint64(11)).astype(np.float64) * UNIT)
            hit = (low_w + (high_w - low_w) * high < weight[owner]) & (rank <= limit[owner])
            owner, dart, rank = owner[hit], dart[hit], rank[hit]
            place = slot[owner] + (mixed(dart + GOLDEN) % np.uint64(coordinates)).astype(np.int64)
            np.minimum.at(best, place, rank)
            won = rank == best[place]
            names[place[won]] = dart[won]


def signatures(owner, element, weight, number: int, coordinates: int = COORDINATES) -> np.ndarray:
    """The dart kept at each coordinate by each of ``number`` texts; texts without shingles
    keep 0 everywhere."""
    best = np.full(number * coordinates, np.inf)
    names = np.zeros(number * coordinates, np.uint64)
    total = np.bincount(owner, weights=weight, minlength=number)
    wanted = coordinates * math.log(coordinates) + 2 * coordinates
    limits = np.divide(wanted, total, out=np.zeros(number), where=total > 0)
    todo = total > 0
    while todo.any():
        rows = np.flatnonzero(todo[owner])
        for first in range(0, len(rows), AT_ONCE):
            part = rows[first : first + AT_ONCE]
            _regions(element[part], weight[part].astype(float), owner[part] * coordinates,
                     limits[owner[part]], best, names, coordinates)
        # A text with an empty coordinate throws again, up to twice the rank.
        todo &= ~np.isfinite(best.reshape(number, coordinates)).all(axis=1)
        limits = np.where(todo, limits * 2, limits)
    return names.reshape(number, coordinates)


def _rows_of_bands(coordinates: int, bands: int, rows: int) -> np.ndarray:
    """Coordinates of each band: shuffles of all coordinates, cut one after the other, so
    that each is used equally often and none twice in a band."""
    random = np.random.default_rng(17)
    per_shuffle = coordinates // rows
    shuffles = [random.permutation(coordinates) for _ in range(-(-bands // per_shuffle))]
    cut = [s[: per_shuffle * rows].reshape(per_shuffle, rows) for s in shuffles]
    return np.concatenate(cut)[:bands]


def bands_of(kept: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One hash per band of coordinates, as signed 64-bit numbers."""
    parts = kept[:, _rows_of_bands(kept.shape[1], bands, rows)]
    total = np.zeros(parts.shape[:2], np.uint64)
    for k in range(parts.shape[2]):
        total = mixed(total * ODD[0] + parts[:, :, k])
    total = mixed(total + np.arange(1, bands + 1, dtype=np.uint64) * GOLDEN)
    return total.view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in in_pieces(batches, "text", PIECE_BYTES):
        texts = table.column("text").combine_chunks()
        owner, element, times, words = shingles_of(texts)
        darts = signatures(owner, element, times, len(table))
        kept = bands_of(darts)
        sketch = (darts & np.uint64(0xFFFF)).astype("<u2")  # equal by chance once in 65,536
        data, offsets = texts_of(texts)
        codes, firsts = words.codes, words.firsts
        hashes = np.array(
            [xxhash.xxh64_intdigest(t) for t in words.terms.to_pylist()], np.uint64
        )
        hashes = hashes[codes] if len(codes) else np.zeros(0, np.uint64)
        nodes, bands = [], []
        for row in range(len(table)):
            if words.counts[row]:
                own = hashes[firsts[row] : firsts[row + 1]].tobytes()
                bands.append(kept[row])
            else:  # alike only if equal
                own = b"\x00" + bytes(data[offsets[row] : offsets[row + 1]])
                bands.append(np.zeros(0, np.int64))
            nodes.append(xxhash.xxh3_128_digest(own))
        yield pa.RecordBatch.from_arrays(
            [table.column("doc_id").combine_chunks(), table.column("text_hash").combine_chunks(),
             pa.array(nodes, pa.binary()), pa.array(bands, pa.list_(pa.int64())),
             pa.array([x.tobytes() for x in sketch], pa.binary())],
            names=["doc_id", "text_hash", "node", "bands", "sketch"],
        )


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, a hash of the text, ``node`` (equal for equal words, or equal texts without
    words) and the band hashes of every document; a stored table. Null texts count as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    chosen = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"),
        F.xxhash64(text).alias("text_hash"),
    )
    return stored(chosen.mapInArrow(_sign, SIGNATURES_DDL), "signatures")


# --- links -------------------------------------------------------------------------


def _jaccard(one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two texts, given their distinct shingles and times."""
    e, t = one
    known, weight = other
    at = np.minimum(np.searchsorted(known, e), max(len(known) - 1, 0))
    same = known[at] == e if len(known) else np.zeros(len(e), bool)
    both = np.minimum(t[same], weight[at[same]]).sum()
    either = t.sum() + weight.sum() - both
    return both / either if either else 0.0


def _similarity(most: float):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            centers = batch.column("center").to_pylist()
            fresh = [i for i, c in enumerate(centers) if c not in known
                     and (i == 0 or centers[i - 1] != c)]
            known = {c: known[c] for c in set(centers) & known.keys()}
            for i in fresh:
                if centers[i] not in known:
                    one = batch.column("center_text").slice(i, 1)
                    _, element, times, _ = shingles_of(one)
                    known[centers[i]] = (element, times)
            owner, element, times, _ = shingles_of(batch.column("text"))
            cuts = np.searchsorted(owner, np.arange(len(batch) + 1))
            found = np.zeros(len(batch))
            for row, center in enumerate(centers):
                own = element[cuts[row] : cuts[row + 1]], times[cuts[row] : cuts[row + 1]]
                found[row] = _jaccard(own, known[center])
            keep = pa.array(found >= most - 1e-12)
            yield pa.RecordBatch.from_arrays(
                [batch.column("center").filter(keep), batch.column("node").filter(keep),
                 pa.array(found).filter(keep)],
                names=["center", "node", "similarity"],
            )

    return compare


def verified(pairs: DataFrame, texts: DataFrame, most: float = SIMILARITY) -> DataFrame:
    """The pairs (center, node) whose exact weighted Jaccard similarity is ``most`` or more.

    ``texts`` has one text per node. A node's text travels once to its pairs and with each
    pair to the center; a center with many pairs is split by the skew handling of joins.
    """
    with_node = pairs.join(texts, "node")
    centers = texts.select(F.col("node").alias("center"), F.col("text").alias("center_text"))
    both = with_node.join(centers, "center").select("center", "node", "text", "center_text")
    return both.mapInArrow(_similarity(most), "center binary, node binary, similarity double")


def _sketches(column: pa.Array) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, "<u2").reshape(len(column), -1)


def _components(rows: int, heads: list[bytes]) -> np.ndarray:
    """A number for each row; rows of the same head are linked already."""
    numbers: dict[bytes, int] = {}
    return np.fromiter((numbers.setdefault(h, len(numbers)) for h in heads), np.int64, rows)


def _meeting(sides: np.ndarray, component: np.ndarray):
    """Each row and the later or opposite ones that are not linked with it. ``component`` is
    read anew for each row, so links found meanwhile spare comparisons."""
    right = np.flatnonzero(sides != REST)
    for i in np.flatnonzero(sides != ALL).tolist():
        others = right[right > i] if sides[i] == EITHER else right
        others = others[component[others] != component[i]]
        if len(others):
            yield i, others


def _alike_sketches(least: int):
    """Links of rows that share ``least`` places, as few as connect what is alike."""

    def links(heads, sides, sketches, texts) -> Iterator[tuple[int, int]]:
        component = _components(len(sides), heads)
        for i, others in _meeting(sides, component):
            alike = others[(sketches[others] == sketches[i]).sum(axis=1) >= least]
            for j in alike.tolist():
                if component[j] != component[i]:
                    component[component == component[j]] = component[i]
                    yield i, j

    return links


def _alike_texts(least: int, most: float):
    """Links of rows whose exact similarity is ``most``, as few as connect them. Pairs that
    share ``least`` places are tried, those that share more before others; a pair is left
    out only if verified links connect it already."""

    def links(heads, sides, sketches, texts) -> Iterator[tuple[int, int]]:
        component = _components(len(sides), heads)
        firsts, seconds, counts = [], [], []
        for i, others in _meeting(sides, component):
            shared = (sketches[others] == sketches[i]).sum(axis=1)
            others, shared = others[shared >= least], shared[shared >= least]
            firsts.append(np.full(len(others), i))
            seconds.append(others)
            counts.append(shared)
        if not firsts:
            return
        order = np.argsort(-np.concatenate(counts), kind="stable")
        left, right = np.concatenate(firsts)[order], np.concatenate(seconds)[order]
        owner, element, times, _ = shingles_of(texts)
        cuts = np.searchsorted(owner, np.arange(len(sides) + 1)).tolist()
        sets = [(element[a:b], times[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        totals = np.bincount(owner, weights=times, minlength=len(sides))
        for first in range(0, len(left), PAIRS_AT_ONCE):
            i, j = left[first : first + PAIRS_AT_ONCE], right[first : first + PAIRS_AT_ONCE]
            able = component[i] != component[j]
            # Unlike by their lengths alone.
            least_total = (most - 1e-9) * np.maximum(totals[i], totals[j])
            able &= np.minimum(totals[i], totals[j]) >= least_total
            for x, y in zip(i[able].tolist(), j[able].tolist(), strict=True):
                if component[x] != component[y] and _jaccard(sets[x], sets[y]) >= most - 1e-12:
                    component[component == component[y]] = component[x]
                    yield x, y

    return links


def _in_buckets(links):
    """The links of each bucket; rows come ordered by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if not len(batch):
                continue
            table = pa.Table.from_batches([batch])
            if rest is not None:
                table = pa.concat_tables([rest, table]).combine_chunks()
            buckets = table.column("bucket").to_numpy()
            heads = np.flatnonzero(np.diff(buckets, prepend=buckets[0] - 1))
            rest = table.slice(int(heads[-1]))
            yield pairs_in(table, heads)
        if rest is not None:
            yield pairs_in(rest, np.array([0, len(rest)]))

    def pairs_in(table: pa.Table, cuts: np.ndarray) -> pa.RecordBatch:
        centers: list[bytes] = []
        others: list[bytes] = []
        if len(cuts) > 1:
            nodes, heads = table.column("node").to_pylist(), table.column("head").to_pylist()
            sides, sketches = table.column("side").to_numpy(), _sketches(table.column("sketch"))
            texts = table.column("text") if "text" in table.column_names else None
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                own = texts.slice(a, b - a).combine_chunks() if texts is not None else None
                for i, j in links(heads[a:b], sides[a:b], sketches[a:b], own):
                    centers.append(nodes[a + i])
                    others.append(nodes[a + j])
        return pa.RecordBatch.from_arrays(
            [pa.array(centers, pa.binary()), pa.array(others, pa.binary())],
            names=["center", "node"],
        )

    return run


def _beside_center(least: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared = _sketches(batch.column("sketch")) == _sketches(batch.column("center_sketch"))
            columns = [batch.column(c) for c in ("bucket", "node", "center")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(shared.sum(axis=1) >= least)],
                names=["bucket", "node", "center", "alike"],
            )

    return compare


def in_blocks(large: DataFrame, beside: DataFrame) -> DataFrame:
    """New buckets (bucket, node, head, side) for the members of large ones that the leader
    has been compared with.

    ``large`` has (bucket, node, center, parts), ``beside`` the (bucket, node) that are linked
    with the leader ``center`` and need no comparison with each other. All others, the rest,
    meet every member: blocks of the rest and blocks of all members are paired, so that no
    pair is left out and each bucket has about half of a task's rows from both.
    """
    linked = beside.select("bucket", "node", F.lit(True).alias("linked"))
    marked = stored(large.join(linked, ["bucket", "node"], "left").select(
        "bucket", "node", "parts",
        (F.coalesce("linked", F.lit(False)) | (F.col("node") == F.col("center"))).alias("linked"),
        "center",
    ), "beside-leaders")
    share = F.count(F.when(~F.col("linked"), 1)) / F.count(F.lit(1))
    of_rest = marked.groupBy("bucket").agg(
        F.ceil(share * F.first("parts")).cast("int").alias("rest_parts")
    ).where("rest_parts > 0")
    dealt = marked.join(of_rest, "bucket")
    number = F.xxhash64("node")
    head = F.when(F.col("linked"), F.col("center")).otherwise(F.col("node")).alias("head")
    every = dealt.select(
        "bucket", "node", head, F.lit(ALL).alias("side"),
        F.explode(F.expr("sequence(0, rest_parts - 1)")).alias("i"),
        F.pmod(number, F.col("parts")).cast("int").alias("j"),
    )
    rest = dealt.where("not linked").select(
        "bucket", "node", head, F.lit(REST).alias("side"),
        F.pmod(number, F.col("rest_parts")).cast("int").alias("i"),
        F.explode(F.expr("sequence(0, parts - 1)")).alias("j"),
    )
    return every.unionByName(rest).select(
        F.xxhash64("bucket", "i", "j").alias("bucket"), "node", "head", "side"
    )


def _ordered(rows: DataFrame) -> DataFrame:
    return rows.repartition("bucket").sortWithinPartitions("bucket", F.xxhash64("bucket", "node"))


def candidates(nodes: DataFrame, least: int = LEAST_SHARED, most: int = BUCKET_ROWS) -> DataFrame:
    """Pairs (center, node) that connect all nodes that share a band and by their sketches
    are alike, directly or through others; each pair once.

    ``nodes`` has (node, bands, sketch). Buckets of one row meet nobody. Buckets of up to
    ``most`` rows are compared in one task each, larger ones by ``in_blocks``.
    """
    rows = nodes.select("node", F.explode("bands").alias("bucket"))
    counts = stored(
        rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1"), "buckets"
    )
    sketches = nodes.select("node", "sketch")
    compare = _in_buckets(_alike_sketches(least))
    small = rows.join(counts.where(F.col("rows") <= most), "bucket", "left_semi").select(
        "bucket", "node", F.col("node").alias("head"), F.lit(EITHER).alias("side")
    )
    found = _ordered(small.join(sketches, "node")).mapInArrow(compare, LINKS_DDL)
    large = counts.where(F.col("rows") > most)
    if not large.isEmpty():
        parts = F.ceil(2 * F.col("rows") / most).cast("int").alias("parts")
        members = rows.join(large.select("bucket", parts), "bucket")
        order = F.struct(F.xxhash64("bucket", "node").alias("order"), "node")
        leaders = members.groupBy("bucket").agg(F.min(order)["node"].alias("center"))
        members = stored(members.join(leaders, "bucket"), "large-buckets")
        beside = members.where("node <> center").join(sketches, "node").join(
            sketches.select(F.col("node").alias("center"), F.col("sketch").alias("center_sketch")),
            "center",
        ).select("bucket", "node", "sketch", "center", "center_sketch")
        alike = stored(beside.mapInArrow(
            _beside_center(least), "bucket bigint, node binary, center binary, alike boolean"
        ).where("alike"), "alike")
        blocks = in_blocks(members, alike).join(sketches, "node")
        found = found.unionByName(alike.select("center", "node")).unionByName(
            _ordered(blocks).mapInArrow(compare, LINKS_DDL)
        )
    return stored(found.distinct(), "pairs")


def links_of(
    groups: DataFrame, nodes: DataFrame, texts: DataFrame, most: float = SIMILARITY,
    least: int = LEAST_SHARED, rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Verified links (center, node) within groups (node, label) of nodes alike by sketch.

    All pairs of a group that share ``least`` places are compared exactly, unless verified
    links connect them. A group of up to ``rows`` rows and ``GROUP_BYTES`` of text is compared
    in one task; of a larger one all are compared with one leader and what is not linked
    with it by ``in_blocks``.
    """
    bucket = F.xxhash64("label").alias("bucket")
    full = stored(
        groups.join(texts, "node").join(nodes.select("node", "sketch"), "node"), "grouped"
    )
    parts = F.greatest(
        F.ceil(2 * F.count(F.lit(1)) / rows),
        F.ceil(2 * F.sum(F.octet_length("text")) / GROUP_BYTES),
    ).cast("int").alias("parts")
    large = stored(full.groupBy("label").agg(parts).where("parts > 2"), "large-groups")
    compare = _in_buckets(_alike_texts(least, most))
    small = full.join(large, "label", "left_anti").select(
        bucket, "node", F.col("node").alias("head"), F.lit(EITHER).alias("side"), "sketch", "text"
    )
    found = _ordered(small).mapInArrow(compare, LINKS_DDL)
    if not large.isEmpty():
        members = stored(groups.join(large, "label").select(
            bucket, "node", F.col("label").alias("center"), "parts"
        ), "large-members")
        pairs = members.where("node <> center").select("center", "node")
        led = stored(verified(pairs, full.select("node", "text"), most).select("center", "node"), "led")
        beside = led.select(F.xxhash64("center").alias("bucket"), "node")
        blocks = in_blocks(members, beside).join(full.select("node", "sketch", "text"), "node")
        found = found.unionByName(led).unionByName(
            _ordered(blocks).mapInArrow(compare, LINKS_DDL)
        )
    return stored(found, "links")


# --- classes -----------------------------------------------------------------------


def classes_of(links: DataFrame) -> DataFrame:
    """(node, label): connected nodes get the label of their least node.

    Large and small stars by turns: every node hands its greater neighbours, then its
    smaller ones, to the least among them. The number of rounds grows with the logarithm
    of the longest chain.
    """
    edges = links.select(
        F.greatest("center", "node").alias("u"), F.least("center", "node").alias("v")
    ).where("u <> v").distinct()
    edges = stored(edges, "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(least, "u").select(
            F.col("v").alias("u"), F.col("m").alias("v")
        ).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(
            F.col("v").alias("u"), F.col("m").alias("v")
        ).unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        edges = stored(small, "edges")
        state = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))


def labelled(
    docs: DataFrame, most: float = SIMILARITY, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """One row per document: doc_id, text_hash and the ``label`` of its class, which no other
    class has, whatever the ids are; a stored table."""
    with passing(docs.sparkSession):
        members = signed(docs)
        # One document for each node, to take the text from.
        nodes = stored(
            members.where("size(bands) > 0").groupBy("node").agg(
                F.min(F.struct("doc_id", "text_hash")).alias("from"),
                F.first("bands").alias("bands"), F.first("sketch").alias("sketch"),
            ), "nodes",
        )
        text = F.coalesce(docs["text"], F.lit(""))
        pairs = candidates(nodes, most=bucket_rows)
        used = pairs.select("node").unionByName(pairs.select(F.col("center").alias("node"))).distinct()
        wanted = nodes.join(used, "node").select(
            "node", F.col("from.doc_id").alias("from_id"), F.col("from.text_hash").alias("from_hash")
        )
        rows = docs.select(
            docs["doc_id"].alias("id"), text.alias("text"), F.xxhash64(text).alias("hash")
        )
        same = (F.col("hash") == F.col("from_hash")) & F.col("id").eqNullSafe(F.col("from_id"))
        texts = rows.join(wanted, same).select("node", "text").dropDuplicates(["node"])
        alike = classes_of(pairs)
        groups = alike.unionByName(alike.select(F.col("label").alias("node"), "label").distinct())
        links = links_of(groups, nodes, texts, most, rows=bucket_rows)
        labels = classes_of(links)
        named = members.join(labels, "node", "left").select(
            "doc_id", "text_hash", F.coalesce("label", "node").alias("label")
        )
        return stored(named, "labelled", lasting=True)


def near_duplicates(
    docs: DataFrame, most: float = SIMILARITY, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """One row per document: doc_id, text_hash, ``class_id`` and ``class_size``.

    Documents belong together if a chain of texts, each at least ``most`` similar to the
    next, leads from one to the other. The class is named by its least doc_id. Texts with
    equal words are equal; texts without words belong together only if they are equal, and
    null texts count as empty. Repeated rows are members each. Null ids are members, and a
    class of null ids only has a null name. An empty table gives no rows.
    """
    named = labelled(docs, most, bucket_rows)
    sizes = named.groupBy("label").agg(
        F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size")
    )
    return named.join(sizes, "label").select("doc_id", "text_hash", "class_id", "class_size")


def deduplicated(docs: DataFrame, most: float = SIMILARITY) -> DataFrame:
    """The documents, in their own columns, one of each class: that with the least doc_id,
    of these the one with the least text hash, of equal rows one. Nulls come last."""
    found = labelled(docs, most)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    chosen = found.groupBy("label").agg(F.min(order).alias("first"))
    chosen = chosen.select(
        F.col("first.doc_id").alias("kept_id"), F.col("first.text_hash").alias("kept_hash")
    )
    # Rows collapse by the keys of the join that follows, so that texts move only once.
    keys = ["kept_null", "kept_id", "kept_hash"]
    held = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record"),
        F.col("doc_id").isNull().alias("kept_null"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("kept_id"),
        F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("kept_hash"),
    ).dropDuplicates(keys)
    wanted = chosen.select(
        F.col("kept_id").isNull().alias("kept_null"),
        F.coalesce("kept_id", F.lit(0)).alias("kept_id"), "kept_hash",
    )
    return held.join(wanted, keys, "left_semi").select("record.*")
