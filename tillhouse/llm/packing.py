"""Packing of tokenised documents into sequences of one length.

The plan is made from a histogram: piece lengths are rounded up to multiples of a step,
all combinations of up to three rounded lengths that fill the window are enumerated, and
non-negative least squares finds how often each is to be used so that the histogram is
met. Repeat counts are rounded to whole numbers the histogram can afford, and the pieces
that remain are packed greedily, the longest first. The histogram, and with it the plan,
has a fixed size whatever the number of documents; pieces meet their place in the plan by
their rank among the pieces of their length.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillhouse.llm.batches import in_pieces, opened, shared, stored, texts_of

WINDOW = 4096
STEP = 16
DEPTH = 3
END_ID = 2
#: Texts that are tokenised at once, and words whose ids a worker remembers, at most.
PIECE_BYTES = 8 * 1024 * 1024
REMEMBERED = 1_000_000
#: Pieces that are ranked in one group, about.
RANKED_AT_ONCE = 50_000

PIECES_DDL = (
    "doc_id bigint, start bigint, length bigint, ids binary, ids_crc32 bigint, "
    "doc_tokens bigint"
)


# --- tokens ------------------------------------------------------------------------

LATIN = 0x280
LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 0


def _classes() -> np.ndarray:
    kinds = np.zeros(LATIN, np.uint8)
    for code in range(LATIN):
        character = chr(code)
        if character.isspace() and code not in range(0x1C, 0x20):
            kinds[code] = SPACE
        elif character.isalpha():
            kinds[code] = LETTER
        elif _number(character):
            kinds[code] = NUMBER
    return kinds


def _number(character: str) -> bool:
    return unicodedata.category(character).startswith("N")


def _lower() -> tuple[np.ndarray, np.ndarray]:
    """Lower-case forms, and the few capitals whose form is not one Latin character."""
    low = [chr(code).lower() for code in range(LATIN)]
    odd = np.array([len(x) > 1 or ord(x) >= LATIN for x in low])
    return np.array([ord(x[0]) for x in low], np.uint32), odd


KINDS = _classes()
LOWER, ODD = _lower()
BYTE_KINDS = np.concatenate([KINDS[:128], np.zeros(128, np.uint8)])
BYTE_LOWER = np.concatenate([LOWER[:128], np.arange(128, 256)]).astype(np.uint8)
APOSTROPHE = ord("'")


class Tokens:
    """Ids of texts by a lower-casing word tokenizer.

    Each word is tokenised once and remembered. Words are cut here with arrays, by the
    rule of the tokenizer: runs of letters, single digits, runs of other characters, and
    the English endings after an apostrophe. Texts with characters beyond Latin go to the
    tokenizer as a whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.tokenizer.encode_special_tokens = True  # their names in a text are plain text
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.flat = np.zeros(0, np.uint32)
        self.ends = np.zeros(1, np.int64)

    def plain(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _learn(self, words: list[bytes]) -> None:
        ids, sizes = [], []
        for first in range(0, len(words), 2_000):
            part = words[first : first + 2_000]
            joined = self.tokenizer.encode(
                " ".join([w.decode() for w in part]), add_special_tokens=False
            )
            sizes.append(np.bincount(np.array(joined.word_ids), minlength=len(part)))
            ids.append(np.array(joined.ids, np.uint32))
        before = len(self.known)
        self.known.update(zip(words, range(before, before + len(words)), strict=True))
        self.flat = np.concatenate([self.flat, *ids])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(np.concatenate(sizes))])

    def _numbers(self, terms: list[bytes]) -> np.ndarray:
        """Where the ids of each term are kept; terms not met before are learned."""
        if len(self.known) + len(terms) > REMEMBERED and self.known:
            self._forget()
        found = np.fromiter(map(self.known.get, terms, repeat(-1)), np.int64, len(terms))
        new = np.flatnonzero(found < 0)
        if len(new):
            found[new] = np.arange(len(self.known), len(self.known) + len(new))
            self._learn([terms[i] for i in new.tolist()])
        return found

    def of(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the number of each text's ids."""
        data, offsets = texts_of(column)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        # Latin characters take one byte, or two of which the first is C2 to C9.
        wide = np.concatenate([[0], np.cumsum((data >= 0xCA) | (data == 0))])
        simple = np.diff(wide[offsets]) == 0
        if simple.all():
            return self._latin(data, offsets)
        ids, counts = [], np.zeros(len(simple), np.int64)
        runs = np.flatnonzero(np.diff(simple, prepend=~simple[:1]))
        for a, b in zip(runs, [*runs[1:], len(simple)], strict=True):
            if simple[a]:
                part = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                found, counts[a:b] = self._latin(*part)
                ids.append(found)
            else:
                for row in range(a, b):
                    found = self.plain(bytes(data[offsets[row] : offsets[row + 1]]).decode())
                    ids.append(found)
                    counts[row] = len(found)
        return np.concatenate(ids), counts

    def _latin(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        kinds, low = BYTE_KINDS[data], BYTE_LOWER[data]
        cut = np.ones(len(data), bool)
        two = np.flatnonzero(data >= 0xC0)
        if len(two):
            codes = ((data[two] & 0x1F).astype(np.int32) << 6) | (data[two + 1] & 0x3F)
            if ODD[codes].any():
                ids = [self.plain(bytes(data[a:b]).decode())
                       for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                return np.concatenate(ids), np.array([len(x) for x in ids], np.int64)
            kinds[two] = kinds[two + 1] = KINDS[codes]
            codes = LOWER[codes]
            low[two], low[two + 1] = 0xC0 | (codes >> 6), 0x80 | (codes & 0x3F)
        cut[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == NUMBER)
        cut[two + 1] = False
        heads = np.zeros(len(data), bool)
        heads[offsets[:-1][np.diff(offsets) > 0]] = True
        cut |= heads
        self._endings(low, kinds, cut, heads)
        kept = kinds != SPACE
        first = np.flatnonzero(cut & kept)
        counts = np.diff(np.searchsorted(first, offsets))
        letters = low[kept]
        bounds = np.empty(len(first) + 1, np.int32)
        bounds[:-1] = first - np.searchsorted(np.flatnonzero(~kept), first)
        bounds[-1] = len(letters)
        words = pa.Array.from_buffers(
            pa.binary(), len(first), [None, pa.py_buffer(bounds), pa.py_buffer(letters)]
        ).dictionary_encode()
        numbers = self._numbers(words.dictionary.to_pylist())
        numbers = numbers[words.indices.to_numpy(zero_copy_only=False)]
        taken = (self.ends[1:] - self.ends[:-1])[numbers]
        ends = np.concatenate([[0], np.cumsum(taken)])
        index = np.arange(ends[-1]) + np.repeat(self.ends[numbers] - ends[:-1], taken)
        return self.flat[index], np.diff(ends[np.concatenate([[0], np.cumsum(counts)])])

    @staticmethod
    def _endings(
        codes: np.ndarray, kinds: np.ndarray, cut: np.ndarray, heads: np.ndarray
    ) -> None:
        """Cut 's 't 'm 'd 're 've 'll off where an apostrophe stands alone."""
        mark = np.flatnonzero(codes[:-1] == APOSTROPHE)
        mark = mark[cut[mark]]
        mark = mark[(kinds[mark + 1] == LETTER) & ~heads[mark + 1]]
        if not len(mark):
            return
        one = codes[mark + 1]
        short = np.isin(one, [ord(c) for c in "stmd"])
        inside = np.minimum(mark + 2, len(codes) - 1)
        two = np.where((mark + 2 < len(codes)) & ~cut[inside], codes[inside], 0)
        long = np.zeros(len(mark), bool)
        for ending in ("re", "ve", "ll"):
            long |= (one == ord(ending[0])) & (two == ord(ending[1]))
        for chosen, size in ((short, 2), (long & ~short, 3)):
            at = mark[chosen]
            cut[at + 1] = False
            after = at + size
            after = after[after < len(codes)]
            cut[after] |= kinds[after] == LETTER


def _cut(path: str, window: int, piece_bytes: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(path)
        for table in in_pieces(batches, "text", piece_bytes):
            ids, counts = tokens.of(table.column("text"))
            whole = np.insert(ids, np.cumsum(counts), END_ID).astype("<u4")
            counts = counts + 1
            each = -(-counts // window)
            owner = np.repeat(np.arange(len(counts)), each)
            start = (np.arange(len(owner)) - np.repeat(np.cumsum(each) - each, each)) * window
            length = np.minimum(counts[owner] - start, window)
            ends = np.concatenate([[0], np.cumsum(length)])
            raw = whole.tobytes()
            found = pa.Array.from_buffers(
                pa.binary(), len(owner), [None, pa.py_buffer((ends * 4).astype(np.int32)),
                                          pa.py_buffer(raw)],
            )
            sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends, ends[1:], strict=False)]
            doc_id = table.column("doc_id").combine_chunks().take(pa.array(owner))
            if isinstance(doc_id, pa.ChunkedArray):
                doc_id = doc_id.combine_chunks()
            rows = pa.Table.from_arrays(
                [doc_id, pa.array(start, pa.int64()), pa.array(length, pa.int64()), found,
                 pa.array(sums, pa.int64()), pa.array(counts[owner], pa.int64())],
                names=["doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens"],
            )
            yield from rows.to_batches(max_chunksize=1000)

    return cut


def pieces(
    docs: DataFrame, tokenizer: str, window: int = WINDOW, piece_bytes: int = PIECE_BYTES
) -> DataFrame:
    """Every document as ids with an end id, cut every ``window`` ids; a stored table.

    Null and empty texts are one piece that holds the end id alone. Repeated rows are
    documents of their own; null ids stay null.
    """
    chosen = docs.select(F.col("doc_id").cast("bigint"), F.col("text"))
    return stored(chosen.mapInArrow(_cut(tokenizer, window, piece_bytes), PIECES_DDL), "pieces")


# --- plan --------------------------------------------------------------------------


def combinations(bins: int, depth: int) -> np.ndarray:
    """All ascending combinations of up to ``depth`` lengths, of 1 to ``bins`` steps, that
    fill ``bins`` steps exactly; unused places are 0."""
    found = []

    def extend(chosen: tuple[int, ...], left: int) -> None:
        if left == 0:
            found.append(chosen + (0,) * (depth - len(chosen)))
            return
        if len(chosen) == depth:
            return
        least = chosen[-1] if chosen else 1
        if len(chosen) == depth - 1:
            if left >= least:
                extend((*chosen, left), 0)
            return
        for size in range(least, left + 1):
            if left - size == 0 or left - size >= size:
                extend((*chosen, size), left - size)

    extend((), bins)
    return np.array(found, np.int64)


def nonnegative_least_squares(
    columns: np.ndarray, target: np.ndarray, rows: int, rounds: int = 400
) -> np.ndarray:
    """Repeat counts x >= 0 that bring the uses of each length near ``target``.

    Accelerated projected gradient on the weighted residual. ``columns`` lists the lengths
    of each combination, 0 for none. A length that is asked for often weighs less, so that
    the relative error counts.
    """
    weight = 1.0 / np.sqrt(np.maximum(target, 1.0))

    def uses(x: np.ndarray) -> np.ndarray:
        out = np.zeros(rows + 1)
        for part in columns.T:
            out += np.bincount(part, weights=x, minlength=rows + 1)
        out[0] = 0
        return out

    def back(residual: np.ndarray) -> np.ndarray:
        return residual[columns].sum(axis=1)

    square = np.ones(len(columns))
    for _ in range(30):
        square = back(weight**2 * uses(square))
        norm = float(np.linalg.norm(square)) or 1.0
        square /= norm
    x = np.zeros(len(columns))
    momentum, ahead = 1.0, x
    for _ in range(rounds):
        residual = weight**2 * (uses(ahead) - target)
        residual[0] = 0
        new = np.maximum(ahead - back(residual) / (1.05 * norm), 0)
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead = new + (momentum - 1) / following * (new - x)
        x, momentum = new, following
    return x


@dataclass
class Plan:
    """How often each combination of rounded lengths is used: rows of ``lengths`` (padded
    with 0) and their ``repeats``."""

    lengths: np.ndarray
    repeats: np.ndarray


def plan(histogram: np.ndarray, depth: int = DEPTH) -> Plan:
    """Combinations that use every piece of the histogram (index: rounded length) once."""
    bins = len(histogram) - 1
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    found = combinations(bins, depth)
    wanted = nonnegative_least_squares(found, left.astype(float), bins)
    repeats = np.zeros(len(found), np.int64)
    for row in np.argsort(-wanted, kind="stable"):
        count = round(float(wanted[row]))
        if count <= 0:
            break
        sizes, times = np.unique(found[row][found[row] > 0], return_counts=True)
        count = min(count, int((left[sizes] // times).min()))
        repeats[row] = count
        left[sizes] -= count * times
    lengths = [tuple(x) for x in found[repeats > 0].tolist()]
    counts = repeats[repeats > 0].tolist()
    # The rest: the longest piece first, filled with the longest that still fit, and the
    # same filling repeated as often as there are pieces for it.
    while left.any():
        room, filling = bins, []
        free = left.copy()
        while room and (fits := np.flatnonzero(free[1 : room + 1])).size:
            size = int(fits[-1]) + 1
            times = min(int(free[size]), room // size)
            filling += [size] * times
            free[size] -= times
            room -= size * times
        sizes, times = np.unique(filling, return_counts=True)
        count = int((left[sizes] // times).min())
        left[sizes] -= count * times
        lengths.append(tuple(filling))
        counts.append(count)
    widest = max((len(x) for x in lengths), default=1)
    table = np.zeros((len(lengths), widest), np.int64)
    for row, sizes in enumerate(lengths):
        table[row, : len(sizes)] = sizes
    return Plan(table, np.array(counts, np.int64))


def places(chosen: Plan) -> pd.DataFrame:
    """Which ranks of each rounded length go to which sequences: pieces of rank ``low`` and
    on go to place ``place`` of the sequences from ``sequence`` on."""
    rows, used = [], {}
    first = 0
    for sizes, count in zip(chosen.lengths.tolist(), chosen.repeats.tolist(), strict=True):
        for place, size in enumerate(sizes):
            if size:
                low = used.get(size, 0)
                rows.append((size, low, low + count, first, place))
                used[size] = low + count
        first += count
    return pd.DataFrame(rows, columns=["size", "low", "high", "sequence", "place"])


# --- layout ------------------------------------------------------------------------


def _placed(sent):
    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        by_size = {size: part.sort_values("low") for size, part in opened(sent).groupby("size")}
        for frame in frames:
            frame["sequence_id"] = frame["rank"]
            frame["place"] = 0
            for size, part in frame.groupby("size"):
                if size == 0:
                    continue
                table = by_size[size]
                at = np.searchsorted(table["low"].to_numpy(), part["rank"], side="right") - 1
                row = table.iloc[at]
                frame.loc[part.index, "sequence_id"] = (
                    row["sequence"].to_numpy() + part["rank"].to_numpy() - row["low"].to_numpy()
                )
                frame.loc[part.index, "place"] = row["place"].to_numpy()
            yield frame

    return place


def packed(cut: DataFrame, window: int = WINDOW, step: int = STEP, depth: int = DEPTH) -> DataFrame:
    """The sequence and offset of each piece, beside the piece's own columns but its ids.

    Whole windows are sequences of their own. Offsets follow the true lengths, so what
    rounding leaves is at the end of a sequence. An empty table gives no rows.
    """
    spark = cut.sparkSession
    bins = window // step
    size = F.when(F.col("length") == window, F.lit(0)).otherwise(
        F.ceil(F.col("length") / step).cast("bigint")
    )
    keyed = cut.drop("ids").withColumns({"size": size})
    counted = keyed.groupBy("size").count().collect()
    total = sum(row["count"] for row in counted)
    groups = max(1, total // RANKED_AT_ONCE)
    histogram = np.zeros(bins + 1, np.int64)
    whole = 0
    for row in counted:
        if row["size"]:
            histogram[row["size"]] = row["count"]
        else:
            whole = row["count"]
    table = places(plan(histogram, depth)) if histogram.any() else places(
        Plan(np.zeros((0, 1), np.int64), np.zeros(0, np.int64))
    )
    table["sequence"] += whole
    sent = shared(spark, table)
    # Ranks within each length without a group larger than a part of the table: pieces are
    # dealt by content, counted, and ranked within (length, deal).
    content = F.xxhash64("doc_id", "start", "ids_crc32", "doc_tokens", F.monotonically_increasing_id())
    keyed = stored(keyed.withColumn("deal", F.pmod(content, F.lit(groups))), "piece-sizes")
    deals = keyed.groupBy("size", "deal").count()
    before = Window.partitionBy("size").orderBy("deal").rowsBetween(
        Window.unboundedPreceding, -1
    )
    deals = deals.select(
        "size", "deal", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before")
    )
    within = Window.partitionBy("size", "deal").orderBy("doc_id", "start", "ids_crc32")
    ranked = (
        keyed.withColumn("within", F.row_number().over(within) - 1)
        .join(deals, ["size", "deal"])
        .withColumn("rank", (F.col("before") + F.col("within")).cast("bigint"))
        .drop("before", "within", "deal")
    )
    columns = ", ".join(f"{name} {kind}" for name, kind in ranked.dtypes)
    placed = ranked.mapInPandas(_placed(sent), f"{columns}, sequence_id bigint, place bigint")
    inside = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
        F.coalesce(F.sum("length").over(inside), F.lit(0)).alias("offset"),
    )


def sequences(cut: DataFrame, layout: DataFrame) -> DataFrame:
    """The packed ids: one row per sequence with the ids of its pieces in order, and where
    each document begins."""
    keys = ["doc_id", "start", "ids_crc32", "doc_tokens"]
    same = None
    left, right = cut.alias("cut"), layout.distinct().alias("layout")
    for key in keys:
        equal = F.col(f"cut.{key}").eqNullSafe(F.col(f"layout.{key}"))
        same = equal if same is None else same & equal
    part = F.struct("layout.offset", "cut.doc_id", "cut.ids")
    joined = left.dropDuplicates(keys).join(right, same).select(
        "layout.sequence_id", part.alias("part")
    )
    ordered = joined.groupBy("sequence_id").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    return ordered.select(
        "sequence_id",
        F.expr("aggregate(parts, cast('' as binary), (x, p) -> concat(x, p.ids))").alias("ids"),
        F.col("parts.doc_id").alias("doc_ids"), F.col("parts.offset").alias("offsets"),
    )
