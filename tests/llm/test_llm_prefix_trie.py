"""The trie of conversations against brute force."""

import hashlib
import re
import zlib

import pytest
from llm_cases import rows_of

from tillhouse.llm import prefix_trie, queries

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
           "ends_sha256")
TURNS = "conv_id bigint, turn bigint, role string, text string"


def brute(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    nodes = {}
    for conv in sorted(turns):
        head = zlib.crc32(str(conv).encode()) % 4
        first = sorted(turns.get(conv - conv % 20, []))[:head]
        way = [t[2:] for t in (*first, *sorted(turns[conv])[head:])]
        for depth in range(len(way) + 1):
            node = nodes.setdefault(tuple(way[:depth]), {"conv": conv, "n": 0, "ends": [], "children": set()})
            node["n"] += 1
            if depth == len(way):
                node["ends"].append(conv)
            if depth:
                nodes[tuple(way[: depth - 1])]["children"].add(tuple(way[:depth]))
    result = []
    for way in sorted(nodes, key=len, reverse=True):
        node = nodes[way]
        below = [nodes[child] for child in node["children"]]
        node["leaves"] = sum(b["leaves"] for b in below) if below else 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", way[-1][1])) if way else 0
        node["saved"] = sum(b["saved"] for b in below) + (node["n"] - 1) * words
        ends = ",".join(map(str, sorted(node["ends"])))
        result.append((
            node["conv"], len(way), nodes[way[:-1]]["conv"] if way else None, node["n"], len(below),
            node["leaves"], node["saved"], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(result, key=repr)


def made():
    """Copies, forks at every depth, one long conversation, and awkward rows."""
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"say {t if c % 3 else t * (c % 5)} to all")
            for c in range(90) for t in range(c % 7)]
    rows += [(200 + c, t, "user", "the same words") for c in range(30) for t in range(4)]
    rows += [(399, t, "user", f"turn {t}") for t in range(60)]
    rows += [(400, None, "user", "first"), (400, None, None, None), (400, 3, "user", "x"),
             (400, 3, "user", "x"), (401, 5, "user", None), (None, 1, "user", "nobody"),
             (402, 0, "user", "  spaced \t out\n"), (2**53 + 1, 0, "user", "large")]
    return rows


@pytest.mark.parametrize("small, slice_", [(0, 3), (10, 1024), (2000, 7)])
def test_trie_against_brute_force(spark, monkeypatch, small, slice_):
    monkeypatch.setattr(prefix_trie, "SMALL", small)
    monkeypatch.setattr(prefix_trie, "SLICE", slice_)
    monkeypatch.setattr(prefix_trie, "PER_TASK", 40)
    rows = made() if small else made()[:120]
    found = prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS))
    assert rows_of(found, *COLUMNS) == brute(rows)


def test_components_fall_apart_in_one_task():
    import numpy as np

    # A way of nodes 0..6 with two more children of node 3, all in one component.
    depth = [0, 1, 2, 3, 4, 4, 4, 5, 6]
    name = [0, 1, 2, 3, 4, 5, 6, 7, 8]
    above = [0, 0, 1, 2, 3, 3, 3, 4, 7]
    zeros = [0] * 9
    rows = [np.array(c) for c in (zeros, zeros, zeros, depth, name, zeros, above, zeros, [1] * 9, zeros)]
    assert prefix_trie.component_totals(rows, 1)[0].tolist() == [9, 8, 7, 6, 3, 1, 1, 2, 1]


def test_empty_table_and_extra_columns(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], TURNS)).count() == 0
    rows = [(1, 0, "user", "a"), (2, 0, "user", "a")]
    clashing = spark.createDataFrame(rows, TURNS).selectExpr("*", "1 as depth", "2 as size", "3 as conv")
    assert rows_of(prefix_trie.prefix_trie(clashing), *COLUMNS) == brute(rows)


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in queries.table(spark, folder, "conversations").select(
        "conv_id", "turn", "role", "text").collect()]
    assert rows_of(queries.op12_prefix_trie(spark, folder), *COLUMNS) == brute(rows)
