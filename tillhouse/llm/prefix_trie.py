"""Trie of conversations that share their first turns, and totals of its subtrees.

A node is a sequence of first turns, named by its depth and 128 bits: the exclusive or of
digests of (position, role, text) of its turns. That running value needs no text of earlier
turns, and it is taken in slices of a conversation, so that no window holds a long one.

Totals over subtrees come from a centroid decomposition of the forest of parent edges. Each
round finds in every component the deepest node with at least half of the component below
it, sums what lies below, adds the sum to the nodes between this centroid and the top of
the component, and splits there: the subtrees of the centroid and the part above it are
components of at most half the size. So the rounds are the logarithm of the number of nodes,
however deep a conversation is. The number of nodes below a node, by which centroids are
chosen, is counted once from the conversations: each of them owns the nodes of which it is
the smallest member, which are the last ones on its way.

Components of more than ``SMALL`` nodes are split by joins of all of them at once, the
largest dealt over many tasks by a salt; smaller ones are taken to one task each, which
goes on splitting them in the same way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillhouse.llm.batches import passing, stored

# How conversations are rebuilt, turns of a slice, nodes of a component that
# one task takes in a join and to the end, and ids whose text is put together at once.
FAMILY = 20
HEADS = 4
SLICE = 1024
PER_TASK = 50_000
SMALL = 2_000
IDS = 4096

WORD = r"[^\x20\x09-\x0D]+"


def in_order(turns: DataFrame) -> DataFrame:
    """Turns with their position ``at`` in the conversation, from 0.

    By ``turn`` (null first), then role and text. Turns are counted within slices of
    ``turn`` and slices by their sizes."""
    # Turns without a number are a slice before all others.
    piece = F.coalesce(F.floor(F.col("turn") / SLICE), F.lit(-(2**62)))
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv"), piece.alias("piece"), "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    within = Window.partitionBy("conv", "piece").orderBy(
        F.asc_nulls_first("turn"), "role", "text"
    )
    before = Window.partitionBy("conv").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("conv", "piece").agg(F.count("*").alias("n"))
    starts = sizes.select(
        "conv", "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    counted = rows.withColumn("nth", F.row_number().over(within) - 1)
    return counted.join(starts, ["conv", "piece"]).select(
        "conv", (F.col("start") + F.col("nth")).alias("at"), "role", "text"
    )


def kept_turns(conv: Column) -> Column:
    """How many first turns a conversation takes from the first of its family."""
    return (F.crc32(conv.cast("string").cast("binary")) % HEADS).cast("int")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with the first turns of the first one of their family:
    all of them (``conv``, ``size``), and their turns."""
    ordered = stored(
        in_order(turns).select(
            "conv", "at", F.xxhash64("role", "text").alias("d1"),
            F.xxhash64("text", "role", F.lit(1)).alias("d2"),
            F.size(F.regexp_extract_all("text", F.lit(f"({WORD})"))).cast("bigint").alias("words"),
        ),
        "trie-turns",
    )
    digests = ["d1", "d2", "words"]
    sizes = ordered.groupBy("conv").agg(F.count("*").alias("own"))
    first = F.col("conv") - F.col("conv") % FAMILY
    convs = sizes.withColumns({"first": first, "h": kept_turns(F.col("conv"))})
    lead = ordered.where(F.col("at") < HEADS - 1).select(
        F.col("conv").alias("first"), "at", *digests
    )
    leads = sizes.select(F.col("conv").alias("first"), F.col("own").alias("leading"))
    known = stored(
        convs.join(leads, "first", "left").select(
            "conv", "first", "h", F.least("h", F.coalesce("leading", F.lit(0))).alias("taken"), "own"
        ),
        "trie-convs",
    )
    heads = known.join(lead, "first").where("at < taken").select("conv", "at", *digests)
    tails = ordered.join(known, "conv").where("at >= h").select(
        "conv", (F.col("at") - F.col("h") + F.col("taken")).alias("at"), *digests
    )
    size = F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))
    return known.select("conv", size.alias("size")), heads.unionByName(tails)


def ways(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes on the way of every conversation, the root among them: ``conv``, ``depth``,
    the node (``a``, ``b``) and the words of its last turn."""
    bits = {
        "a": F.xxhash64("at", "d1", "d2"), "b": F.xxhash64("d2", F.lit(7), "at", "d1"),
        "piece": F.floor(F.col("at") / SLICE),
    }
    rows = turns.withColumns(bits)
    within = Window.partitionBy("conv", "piece").orderBy("at").rowsBetween(
        Window.unboundedPreceding, 0
    )
    before = Window.partitionBy("conv").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    whole = rows.groupBy("conv", "piece").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    carried = whole.select(
        "conv", "piece",
        *[F.coalesce(F.bit_xor(x).over(before), F.lit(0)).alias(f"{x}0") for x in ("a", "b")],
    )
    running = rows.select(
        "conv", "piece", "at", "words",
        *[F.bit_xor(x).over(within).alias(f"{x}1") for x in ("a", "b")],
    )
    nodes = running.join(carried, ["conv", "piece"]).select(
        "conv", (F.col("at") + 1).alias("depth"),
        *[F.col(f"{x}0").bitwiseXOR(F.col(f"{x}1")).alias(x) for x in ("a", "b")], "words",
    )
    zero = F.lit(0).cast("bigint")
    roots = convs.select(
        "conv", zero.alias("depth"), zero.alias("a"), zero.alias("b"), zero.alias("words")
    )
    return nodes.unionByName(roots)


NODE = ["depth", "a", "b"]


def nodes_of(convs: DataFrame, steps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes of the trie, each with its smallest member ``conv`` and its number of
    members, and the steps that belong to the smallest members, with the step after."""
    first = steps.groupBy(*NODE).agg(
        F.min("conv").alias("least"), F.count("*").alias("n_convs"), F.max("words").alias("words")
    )
    first = stored(first, "trie-first")
    members = stored(steps.drop("words").join(first, NODE).join(convs, "conv"), "trie-members")
    owned = members.where("conv = least")
    # What a conversation owns are its last nodes; ``owns`` is the depth of the first.
    owners = owned.groupBy("conv").agg(F.min("depth").alias("owns"))
    share = F.when(F.col("conv") == F.col("least"), F.col("size") - F.col("depth") + 1).otherwise(
        F.coalesce(F.col("size") - F.col("owns") + 1, F.lit(0))
    )
    below = members.join(owners, "conv", "left").groupBy(*NODE).agg(F.sum(share).alias("size"))
    upper = members.select(
        "conv", (F.col("depth") + 1).alias("depth"), F.col("a").alias("parent_a"),
        F.col("b").alias("parent_b"), F.col("least").alias("parent_conv"),
    )
    placed = owned.drop("size").join(upper, ["conv", "depth"], "left")
    children = placed.where("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("parent_a").alias("a"),
        F.col("parent_b").alias("b"),
    ).agg(F.count("*").alias("n_children"))
    nodes = placed.join(below, NODE).join(children, NODE, "left").select(
        "conv", *NODE, "parent_a", "parent_b", "parent_conv", "n_convs", "words", "size",
        F.coalesce("n_children", F.lit(0)).alias("n_children"),
    )
    after = members.select(
        "conv", (F.col("depth") - 1).alias("depth"), F.col("a").alias("next_a"),
        F.col("b").alias("next_b"),
    )
    chains = members.select("conv", *NODE).join(after, ["conv", "depth"], "left")
    return stored(nodes, "trie-nodes"), stored(chains, "trie-chains")


def salt(size: str = "whole") -> Column:
    """How many tasks share a component."""
    return (F.floor(F.col(size) / PER_TASK) + 1).cast("int")


COMPONENT = ["top_depth", "top_a", "top_b"]
PARENT = ["parent_a", "parent_b"]


def split(live: DataFrame, chains: DataFrame) -> DataFrame:
    """One round: every node with the centroid of its component (``z_depth``, ``z_a``,
    ``z_b``, ``z_conv``), whether it lies ``below`` it, and the top of the part below that
    it falls into."""
    middle = (
        live.where("2 * size >= whole")
        .groupBy(*COMPONENT, "whole")
        .agg(F.min(F.struct("size", "depth", "a", "b", "conv")).alias("z"))
    )
    dealt = middle.withColumn("deal", F.explode(F.sequence(F.lit(0), salt() - 1))).select(
        *COMPONENT, "deal", F.col("z.size").alias("z_size"),
        F.col("z.depth").alias("z_depth"), F.col("z.a").alias("z_a"), F.col("z.b").alias("z_b"),
        F.col("z.conv").alias("z_conv"),
    )
    keyed = live.withColumn("deal", F.pmod(F.xxhash64(*NODE), salt()).cast("int"))
    met = keyed.join(dealt, [*COMPONENT, "deal"]).drop("deal")
    # What the way of the node's smallest member has at the depth of the centroid.
    there = chains.select(
        "conv", F.col("depth").alias("z_depth"), F.col("a").alias("at_a"),
        F.col("b").alias("at_b"), "next_a", "next_b",
    )
    below = (
        (F.col("depth") >= F.col("z_depth"))
        & F.col("at_a").eqNullSafe(F.col("z_a")) & F.col("at_b").eqNullSafe(F.col("z_b"))
    )
    return met.join(there, ["conv", "z_depth"], "left").withColumn("below", below).drop("at_a", "at_b")


def subtree_totals(nodes: DataFrame, chains: DataFrame, weights: list[str]) -> DataFrame:
    """Sums of the weights (long) over the subtree of every node, as ``total_<weight>``.

    ``nodes`` has ``conv`` (smallest member), ``depth``, ``a``, ``b``, ``parent_a``,
    ``parent_b``, ``size`` (nodes in the subtree) and the weights, ``chains`` the steps of the
    conversations with the step after. Both are stored."""
    totals = [f"total_{w}" for w in weights]
    sums = [f"sum_{w}" for w in weights]
    carried = ["conv", *NODE, *PARENT, "size", *weights]
    zero = F.lit(0).cast("bigint")
    whole = nodes.where("depth = 0").select("size").first()
    live = nodes.select(
        *carried, *[zero.alias(name) for name in (*COMPONENT, *totals)],
        F.lit(whole[0] if whole else 0).cast("bigint").alias("whole"),
    )
    done = [finished(live.where(F.col("whole") <= SMALL), weights)]
    large = live.where(F.col("whole") > SMALL)
    centroid = "depth = z_depth AND a = z_a AND b = z_b"
    while not large.isEmpty():
        judged = stored(split(large, chains), "trie-split")
        below = stored(
            judged.where("below")
            .groupBy(*COMPONENT, "z_depth", "z_a", "z_b", "z_conv", "z_size")
            .agg(*[F.sum(w).alias(s) for w, s in zip(weights, sums, strict=True)]),
            "trie-sums",
        )
        # The way from the centroid to the top of its component, and the centroid itself.
        way = (
            chains.select(F.col("conv").alias("z_conv"), *NODE)
            .join(below.select("z_conv", "z_depth", "top_depth", "z_size", *sums), "z_conv")
            .where("depth BETWEEN top_depth AND z_depth")
            .select(*NODE, F.col("z_size").alias("gone"), *sums)
        )
        upper = judged.where(f"NOT below OR ({centroid})").join(way, NODE, "left").select(
            *carried, *COMPONENT, "z_size", "whole", "below", F.coalesce("gone", zero).alias("gone"),
            *[(F.col(t) + F.coalesce(s, zero)).alias(t) for t, s in zip(totals, sums, strict=True)],
        )
        upper = stored(upper, "trie-upper")
        done.append(upper.where("below").select(*NODE, *totals))
        rest = upper.where("NOT below").withColumns(
            {"size": F.col("size") - F.col("gone"), "whole": F.col("whole") - F.col("z_size")}
        ).drop("z_size", "below", "gone")
        lower = judged.where(f"below AND NOT ({centroid})").select(
            *carried, (F.col("z_depth") + 1).alias("top_depth"), F.col("next_a").alias("top_a"),
            F.col("next_b").alias("top_b"), *totals,
        )
        tops = lower.where("depth = top_depth").select(*COMPONENT, F.col("size").alias("whole"))
        live = stored(rest.unionByName(lower.join(tops, COMPONENT)), "trie-live")
        done.append(finished(live.where(F.col("whole") <= SMALL), weights))
        large = live.where(F.col("whole") > SMALL)
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    return found


def finished(small: DataFrame, weights: list[str]) -> DataFrame:
    """Totals of the nodes of small components, each split to the end in one task."""
    totals = [f"total_{w}" for w in weights]
    columns = [*COMPONENT, *NODE, *PARENT, *weights, *totals]
    schema = ", ".join(f"{name} bigint" for name in (*NODE, *totals))

    def split_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_components(batches):
            found = component_totals(rows, len(weights))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (*rows[3:6], *found)], [*NODE, *totals]
            )

    return (
        small.select(*columns)
        .repartition(*COMPONENT)
        .sortWithinPartitions(*COMPONENT, "depth")
        .mapInArrow(split_all, schema)
    )


def whole_components(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The columns of the rows, cut where a component begins; the last one of a batch is
    held until the next batch."""
    held: list[np.ndarray] | None = None
    for batch in batches:
        if not len(batch):
            continue
        columns = [
            c.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns
        ]
        if held is not None:
            columns = [np.concatenate(both) for both in zip(held, columns, strict=True)]
        same = np.all([c == c[-1] for c in columns[:3]], axis=0)
        last = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
        if last:
            yield [c[:last] for c in columns]
        held = [c[last:] for c in columns]
    if held is not None:
        yield held


def component_totals(rows: list[np.ndarray], n_weights: int) -> list[np.ndarray]:
    """Subtree sums of the nodes of components that follow each other, by centroids, on top
    of what the nodes have got already. Nodes come by depth within a component."""
    tops = list(zip(*[c.tolist() for c in rows[:3]], strict=True))
    names = list(zip(*[c.tolist() for c in rows[3:6]], strict=True))
    above = [(d - 1, a, b) for d, a, b in zip(*[c.tolist() for c in (rows[3], *rows[6:8])], strict=True)]
    weights = list(zip(*[c.tolist() for c in rows[8 : 8 + n_weights]], strict=True))
    found = [list(t) for t in zip(*[c.tolist() for c in rows[8 + n_weights :]], strict=True)]
    spot = {(top, name): i for i, (top, name) in enumerate(zip(tops, names, strict=True))}
    parents = [spot.get((top, name), -1) for top, name in zip(tops, above, strict=True)]
    components: dict[tuple, list[int]] = {}
    for i, top in enumerate(tops):
        components.setdefault(top, []).append(i)
    waiting = list(components.values())
    size, part = [0] * len(tops), [-1] * len(tops)
    while waiting:
        nodes = waiting.pop()
        top = nodes[0]
        for i in nodes:
            size[i] = 1
        for i in reversed(nodes[1:]):
            size[parents[i]] += size[i]
        centroid = min((i for i in nodes if 2 * size[i] >= len(nodes)), key=size.__getitem__)
        # The part that a node falls into: the centroid's child above it, or what is above.
        parts: dict[int, list[int]] = {}
        total = [0] * n_weights
        for i in nodes:
            up = -1 if i == top else part[parents[i]]
            part[i] = -2 if i == centroid else i if up == -2 else up
            if part[i] != -1:
                total = [t + w for t, w in zip(total, weights[i], strict=True)]
            if i != centroid:
                parts.setdefault(part[i], []).append(i)
        node = centroid
        while True:
            found[node] = [t + more for t, more in zip(found[node], total, strict=True)]
            if node == top:
                break
            node = parents[node]
        waiting.extend(parts.values())
    return [np.array(c, np.int64) for c in zip(*found, strict=True)]


def digests_of_ends(steps: DataFrame, convs: DataFrame) -> DataFrame:
    """SHA-256 of the ids of the conversations that end at a node, ascending, with commas.

    A digest is taken over one text in order, so one task reads the ids of a node; they
    reach it as texts of many ids, put together in parallel, and one text is held at once."""
    ends = steps.join(convs.select("conv", F.col("size").alias("depth")), ["conv", "depth"])
    part = F.floor(F.col("conv") / IDS).alias("part")
    texts = ends.groupBy(*NODE, part).agg(
        F.concat_ws(",", F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")))
        .alias("ids")
    )
    return (
        texts.repartition(*NODE)
        .sortWithinPartitions(*NODE, "part")
        .select(*NODE, "ids")
        .mapInArrow(in_digests, "depth bigint, a bigint, b bigint, ends_sha256 string")
    )


def in_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of the texts of each node; its rows follow each other."""
    held, digest, rows = None, None, []

    def batch() -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, [*NODE, "ends_sha256"])

    for given in batches:
        for *node, ids in zip(*[c.to_pylist() for c in given.columns], strict=True):
            if node == held:
                digest.update(b",")
            else:
                if held is not None:
                    rows.append((*held, digest.hexdigest()))
                held, digest = node, hashlib.sha256()
            digest.update(ids.encode())
        if rows:
            yield batch()
            rows = []
    if held is not None:
        rows.append((*held, digest.hexdigest()))
        yield batch()


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``. Rows without a
    ``conv_id`` belong to no conversation and are left out; null roles and texts are empty;
    turns of one number are ordered by role and text, and repeated rows are turns of their
    own; other columns are not looked at. An empty table has no node, not even the root.
    """
    with passing(conversations.sparkSession):
        return _trie(conversations)


def _trie(conversations: DataFrame) -> DataFrame:
    convs, turns = rebuilt(conversations.select("conv_id", "turn", "role", "text"))
    steps = stored(ways(convs, turns), "trie-steps")
    nodes, chains = nodes_of(convs, steps)
    weighed = nodes.withColumns(
        {
            "leaves": (F.col("n_children") == 0).cast("bigint"),
            "saved": (F.col("n_convs") - 1) * F.col("words"),
        }
    )
    totals = subtree_totals(weighed, chains, ["leaves", "saved"])
    ends = digests_of_ends(steps, convs)
    rows = nodes.join(totals, NODE).join(ends, NODE, "left")
    nothing = hashlib.sha256(b"").hexdigest()
    result = rows.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"),
        "n_convs", "n_children", F.col("total_leaves").alias("n_leaves"),
        F.col("total_saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )
    return stored(result, "trie-result", lasting=True)
