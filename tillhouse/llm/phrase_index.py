"""Benchmark decontamination by a positional inverted index.

The index is dealt by document: every task turns its documents into segments, and a
segment holds, for each term in it, the ascending positions of that term. Nothing is
shuffled to build it. A search sends only the postings of the searched terms of one
segment to one task, begins there with the positions of each phrase's rarest term, and
keeps those at which the next rarest terms stand at their own distance.

Segments are bounded in bytes, so no task holds more than a segment, whatever terms or
documents are frequent. The searched items are taken in blocks of bounded size.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.batches import in_pieces, opened, passing, shared, stored, words_of

SEGMENT_BYTES = 16 * 1024 * 1024
BLOCK_BYTES = 4 * 1024 * 1024
WINDOW = 10
#: Candidate positions that are intersected at once.
AT_ONCE = 2_000_000

INDEX = pa.schema(
    [
        ("segment", pa.int64()),
        ("term", pa.binary()),
        ("steps", pa.binary()),
        ("doc_ids", pa.list_(pa.string())),
        ("doc_hashes", pa.list_(pa.int64())),
        ("doc_words", pa.list_(pa.int64())),
    ]
)
INDEX_DDL = (
    "segment bigint, term binary, steps binary, doc_ids array<string>, "
    "doc_hashes array<bigint>, doc_words array<bigint>"
)
FOUND_DDL = (
    "segment bigint, ordinal bigint, doc_id string, text_hash bigint, n_words bigint, "
    "runs array<struct<first:bigint,last:bigint>>, items array<string>"
)


def _segments(most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def build(batches):
        number = TaskContext.get().partitionId() << 32
        for piece in in_pieces(batches, "text", most):
            words = words_of(piece.column("text"))
            # One position without a term between documents: no phrase reaches over it.
            spots = np.arange(len(words.codes), dtype=np.int64)
            spots += np.repeat(np.arange(len(piece)), words.counts)
            ordered = np.sort((words.codes.astype(np.int64) << 32) | spots)
            places = (ordered & 0xFFFFFFFF).astype(np.int32)
            held = np.bincount(words.codes, minlength=len(words.terms))
            heads = np.concatenate([[0], np.cumsum(held)])
            steps = np.diff(places, prepend=np.int32(0))
            steps[heads[:-1]] = places[heads[:-1]]
            postings = pa.Array.from_buffers(
                pa.binary(), len(held),
                [None, pa.py_buffer((heads * 4).astype(np.int32)), pa.py_buffer(steps)],
            )
            empty = [pa.nulls(len(held), field.type) for field in list(INDEX)[3:]]
            terms = [pa.array(np.full(len(held), number)), words.terms.cast(pa.binary())]
            rows = pa.Table.from_arrays([*terms, postings, *empty], schema=INDEX)
            yield from rows.to_batches(max_chunksize=50_000)
            documents = {
                "segment": [number], "term": [None], "steps": [None],
                "doc_ids": [piece.column("doc_id").to_pylist()],
                "doc_hashes": [piece.column("text_hash").to_pylist()],
                "doc_words": [words.counts.tolist()],
            }
            yield pa.RecordBatch.from_pydict(documents, schema=INDEX)
            number += 1

    return build


def build_index(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    segment_bytes: int = SEGMENT_BYTES,
) -> DataFrame:
    """Index all words of all documents; returns the stored index.

    A row with a term holds its positions in the segment, as int32 steps from the one
    before. A row without a term holds the segment's documents and their numbers of words.
    Null and empty texts are documents without words; repeated rows are documents of their
    own; ids are kept as text, so that any kind of id is exact and a null id stays null; other
    columns are not read.
    """
    chosen = docs.select(
        F.col(id_column).cast("string").alias("doc_id"), F.col(text_column).alias("text"),
        F.xxhash64(F.col(text_column)).alias("text_hash"),
    )
    return stored(chosen.mapInArrow(_segments(segment_bytes), INDEX_DDL), "phrase-index")


class Phrases:
    """Sequences of terms to be found, each with the items that contain it."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        words = words_of(pa.array([text for _, text in items], pa.string()))
        self.terms = words.terms.to_pylist()
        by_sequence: dict[tuple[int, ...], dict[str, None]] = {}
        for (item, _), first, count in zip(items, words.firsts, words.counts, strict=False):
            codes = words.codes[first : first + count].tolist()
            for at in range(max(count - window + 1, min(count, 1))):
                by_sequence.setdefault(tuple(codes[at : at + window]), {})[item] = None
        self.items = [list(names) for names in by_sequence.values()]
        self.lengths = np.array([len(s) for s in by_sequence], np.int64)
        self.codes = np.full((len(by_sequence), window), -1, np.int64)
        for row, sequence in enumerate(by_sequence):
            self.codes[row, : len(sequence)] = sequence


def _postings(rows: pd.DataFrame, numbers: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys (term number << 32 | position) of a segment, and each term's count."""
    counts = np.zeros(len(numbers), np.int64)
    parts = []
    for term, steps in zip(rows["term"], rows["steps"], strict=True):
        number = numbers[bytes(term)]
        places = np.cumsum(np.frombuffer(steps, np.int32), dtype=np.int64)
        counts[number] = len(places)
        parts.append((number << 32) | places)
    return np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.int64), counts


def _holds(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    at = np.searchsorted(keys, wanted)
    return keys[np.minimum(at, len(keys) - 1)] == wanted


def exact_places(
    phrases: Phrases, keys: np.ndarray, counts: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Phrases and the positions at which they begin, by intersection from the rarest term."""
    used = phrases.codes >= 0
    held = np.where(used, counts[phrases.codes], np.iinfo(np.int64).max)
    able = np.flatnonzero((held > 0).all(axis=1) & (phrases.lengths > 0))
    order = np.argsort(held[able], axis=1, kind="stable")
    begins = np.searchsorted(keys, np.arange(len(counts) + 1, dtype=np.int64) << 32)
    rarest = held[able, order[:, 0]]
    found, places = [], []
    cuts = np.flatnonzero(np.diff(np.cumsum(rarest) // AT_ONCE)) + 1
    for block in np.split(np.arange(len(able)), cuts):
        if not len(block):
            continue
        rows, size = able[block], rarest[block]
        code = phrases.codes[rows, order[block, 0]]
        within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        spots = keys[np.repeat(begins[code], size) + within] & 0xFFFFFFFF
        spots -= np.repeat(order[block, 0], size)
        which = np.repeat(np.arange(len(block)), size)
        which, spots = which[spots >= 0], spots[spots >= 0]
        for rank in range(1, phrases.codes.shape[1]):
            shift = order[block[which], rank]
            code = phrases.codes[rows[which], shift]
            keep = (code < 0) | _holds(keys, (code << 32) | (spots + shift))
            which, spots = which[keep], spots[keep]
        found.append(rows[which])
        places.append(spots)
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(places)


def near_places(
    phrases: Phrases, keys: np.ndarray, counts: np.ndarray, span: int
) -> tuple[np.ndarray, np.ndarray]:
    """Phrases and positions from which ``span`` words hold all the phrase's terms, in any
    order. From each place of the rarest term, every start that covers it is tried."""
    used = phrases.codes >= 0
    held = np.where(used, counts[phrases.codes], np.iinfo(np.int64).max)
    able = np.flatnonzero((held > 0).all(axis=1) & (phrases.lengths > 0))
    found, places = [], []
    for row in able:
        codes = np.unique(phrases.codes[row][used[row]])
        codes = codes[np.argsort(counts[codes], kind="stable")]
        low = np.searchsorted(keys, codes[0] << 32)
        spots = keys[low : low + counts[codes[0]]] & 0xFFFFFFFF
        starts = np.unique(spots[:, None] - np.arange(span)[None, :])
        starts = starts[starts >= 0]
        for code in codes[1:]:
            at = np.searchsorted(keys, (code << 32) | starts)
            following = keys[np.minimum(at, len(keys) - 1)] - ((code << 32) | starts)
            starts = starts[(at < len(keys)) & (following >= 0) & (following < span)]
        # Keep the starts that begin with one of the terms: the smallest spans.
        begins = np.zeros(len(starts), bool)
        for code in codes:
            begins |= _holds(keys, (code << 32) | starts) if len(starts) else False
        found.append(np.full(int(begins.sum()), row))
        places.append(starts[begins])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(places)


def _merged(first: np.ndarray, last: np.ndarray) -> list[dict[str, int]]:
    """Runs of positions that lie in any of the spans; spans are ordered by ``first``."""
    reach = np.maximum.accumulate(last)
    heads = np.flatnonzero(np.concatenate([[True], first[1:] > reach[:-1] + 1]))
    tails = np.concatenate([heads[1:] - 1, [len(first) - 1]])
    return [
        {"first": int(a), "last": int(b)}
        for a, b in zip(first[heads], reach[tails], strict=True)
    ]


def _search(sent: Broadcast, span: int | None):
    def find(rows: pd.DataFrame) -> pd.DataFrame:
        phrases = opened(sent)
        numbers = {term: number for number, term in enumerate(phrases.terms)}
        table = rows[rows["term"].isna()].iloc[0]
        ids, sizes = table["doc_ids"], np.asarray(table["doc_words"], np.int64)
        keys, counts = _postings(rows[rows["term"].notna()], numbers)
        begins = np.concatenate([[0], np.cumsum(sizes + 1)])
        spans: dict[int, list[dict[str, int]]] = {}
        items: dict[int, set[str]] = {}
        if len(keys):
            if span is None:
                which, spots = exact_places(phrases, keys, counts)
                width = phrases.lengths[which]
            else:
                which, spots = near_places(phrases, keys, counts, span)
                width = np.full(len(which), span)
            owner = np.searchsorted(begins, spots, side="right") - 1
            last = np.minimum(spots - begins[owner] + width, sizes[owner]) - 1
            if span is not None:
                kept = _inside(phrases, which, spots, begins[owner] + last, keys)
                which, spots, owner, last = which[kept], spots[kept], owner[kept], last[kept]
            order = np.argsort(spots, kind="stable")
            which, owner = which[order], owner[order]
            first, last = spots[order] - begins[owner], last[order]
            heads = np.flatnonzero(np.diff(owner, prepend=-1))
            for a, b in zip(heads, [*heads[1:], len(owner)], strict=False):
                spans[int(owner[a])] = _merged(first[a:b], last[a:b])
                named = {name for row in np.unique(which[a:b]) for name in phrases.items[row]}
                items[int(owner[a])] = named
        return pd.DataFrame(
            {
                "segment": np.full(len(sizes), rows["segment"].iloc[0]),
                "ordinal": np.arange(len(sizes)),
                "doc_id": pd.Series(list(ids), dtype=object),
                "text_hash": np.asarray(table["doc_hashes"], np.int64),
                "n_words": sizes,
                "runs": [spans.get(i, []) for i in range(len(sizes))],
                "items": [sorted(items.get(i, ())) for i in range(len(sizes))],
            }
        )

    return find


def _inside(phrases, which, first, last, keys) -> np.ndarray:
    """Whether the spans, cut at the ends of their documents, still hold all the terms."""
    keep = np.ones(len(which), bool)
    for column in range(phrases.codes.shape[1]):
        code = phrases.codes[which, column]
        at = np.searchsorted(keys, (code << 32) | first)
        there = keys[np.minimum(at, len(keys) - 1)]
        keep &= (code < 0) | ((there >= ((code << 32) | first)) & (there <= ((code << 32) | last)))
    return keep


def blocks_of(items: DataFrame, most: int) -> Iterator[list[tuple[str, str]]]:
    """All items with a text, in blocks of about ``most`` bytes that the driver may hold."""
    chosen = items.select(
        F.col("item_id").cast("string").alias("item"), F.col("text").alias("text")
    ).where("text is not null")
    size = chosen.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    number = max(1, math.ceil(size / most))
    dealt = F.pmod(F.xxhash64("item", "text"), F.lit(number))
    for block in range(number):
        yield [tuple(row) for row in chosen.where(dealt == block).distinct().collect()]


def find_items(
    index: DataFrame, items: DataFrame, window: int = WINDOW, span: int | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Where windows of the items' words occur in the indexed documents.

    A window is ``window`` consecutive words of an item, or all its words if it has fewer,
    but not none. Without ``span`` a window occurs where its words follow one another;
    with it, where ``span`` consecutive words of a document hold all its words in any order.

    Returns for each indexed document its runs of words that lie in an occurrence (word
    numbers, both ends included) and the items found, sorted as text; ``doc_id`` is text. Items without an id
    or text are not searched, repeated items count once, an empty table finds nothing.
    """
    spark = index.sparkSession
    found, blocks = None, 0
    for block in blocks_of(items.where("item_id is not null"), block_bytes):
        phrases = Phrases(block, window)
        sent = shared(spark, phrases)
        # At most ``block_bytes`` of terms, so the broadcast has a bound of its own.
        rows = pd.DataFrame({"term": pd.Series(phrases.terms, dtype=object)})
        terms = F.broadcast(spark.createDataFrame(rows, "term binary"))
        wanted = index.where("term is not null").join(terms, "term", "left_semi")
        wanted = wanted.select(index.columns).unionByName(index.where("term is null"))
        part = wanted.groupBy("segment").applyInPandas(_search(sent, span), FOUND_DDL)
        found = part if found is None else found.unionByName(part)
        blocks += 1
    if blocks == 1:
        return found
    together = found.groupBy("segment", "ordinal").agg(
        F.first("doc_id").alias("doc_id"), F.first("text_hash").alias("text_hash"),
        F.first("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("runs"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    # Spans ordered by their first word: one that overlaps the run before widens it.
    run = "struct(x.first as first, x.last as last)"
    widened = (
        "aggregate(spans, cast(array() as array<struct<first:bigint,last:bigint>>), (runs, x) -> "
        "if(size(runs) > 0 and x.first <= element_at(runs, -1).last + 1, "
        "concat(slice(runs, 1, size(runs) - 1), array(struct(element_at(runs, -1).first as first, "
        f"greatest(element_at(runs, -1).last, x.last) as last))), concat(runs, array({run}))))"
    )
    return together.select(
        "segment", "ordinal", "doc_id", "text_hash", "n_words", F.expr(widened).alias("runs"),
        "items",
    )


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents, in their own columns, that share no window with an item.

    Decided by row: documents of one doc_id with different texts are told apart by a hash
    of the text, null ids and texts included. Null and empty texts share nothing and stay.
    """
    with passing(docs.sparkSession):
        hit = find_items(build_index(docs), items).where(F.size("runs") > 0)
        hit = hit.select(F.col("doc_id").alias("hit_id"), "text_hash").distinct()
        hit = stored(hit, "hits", lasting=True)
    same = docs["doc_id"].cast("string").eqNullSafe(hit["hit_id"])
    same &= F.xxhash64(docs["text"]) == hit["text_hash"]
    return docs.join(hit, same, "left_anti")
