"""Language of a text by error-correcting output codes.

Every language gets a codeword; binary classifiers on character n-grams predict its bits,
and a text belongs to the language whose codeword costs the least logistic loss over all
bits, each weighted by how well its classifier does on texts of that language that it was
not fitted to. A text for which two codewords cost nearly the same is flagged as ambiguous.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.llm.batches import in_pieces, opened, shared, texts_of

#: Training documents of one language, at most; their whole texts are read by executors,
#: and the driver gets one row of counts for each.
SAMPLE_PER_LANGUAGE = 300
#: Hashed features of the pairs and of the triples of characters.
PAIRS, TRIPLES = 2048, 6144
FEATURES = PAIRS + TRIPLES
PIECE_BYTES = 2 * 1024 * 1024
#: Training texts that a step of the descent multiplies at once.
ROWS_AT_ONCE = 128
#: All dichotomies are used as bits up to so many languages; beyond, a random code.
EXHAUSTIVE_UP_TO = 6
#: A text is ambiguous if the best two languages are nearer than this in probability.
MARGIN = 0.1
UNKNOWN = "und"


def _folded() -> np.ndarray:
    """Letters in lower case and bytes beyond ASCII as they are, all else a space."""
    table = np.full(256, ord(" "), np.uint8)
    for byte in range(256):
        if byte >= 128 or chr(byte).isalpha():
            table[byte] = ord(chr(byte).lower()) if byte < 128 else byte
    return table


FOLDED = _folded()


def counts_of(column: pa.Array) -> np.ndarray:
    """One row per text with its counts of hashed pairs and triples of bytes."""
    data, offsets = texts_of(column)
    number = len(offsets) - 1
    if not len(data):
        return np.zeros((number, FEATURES), np.float32)
    folded = FOLDED[data].astype(np.int32)
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(data))
    row = np.repeat(np.arange(number, dtype=np.int32) * FEATURES, np.diff(offsets))
    second = np.append(folded[1:], 0)
    third = np.append(folded[2:], [0, 0])[: len(folded)]
    # A run of separators counts as one.
    spread = (folded == 32) & (second == 32)
    pairs = (folded * 2477 + second * 9176 + ((folded * second) >> 3)) % PAIRS
    triples = (folded * 31_337 + second * 7_919 + third * 104_729 + folded * third) % TRIPLES
    two, three = (left > 1) & ~spread, (left > 2) & ~spread
    cells = np.concatenate([(row + pairs)[two], (row + PAIRS + triples)[three]])
    counted = np.bincount(cells, minlength=number * FEATURES)
    return counted.reshape(number, FEATURES).astype(np.float32)


def scaled(counts: np.ndarray) -> np.ndarray:
    """Square roots of the shares, so that long and short texts compare."""
    shares = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    return np.sqrt(shares, out=shares)


@dataclass
class Code:
    """Languages, their codewords of -1 and 1, one linear classifier per bit, and how far
    each bit is trusted for each language (1 on average over the bits of a language)."""

    languages: list[str]
    words: np.ndarray
    weights: np.ndarray
    biases: np.ndarray
    trust: np.ndarray

    def margins(self, counts: np.ndarray) -> np.ndarray:
        return scaled(counts) @ self.weights + self.biases

    def losses(self, counts: np.ndarray) -> np.ndarray:
        """Cost of each language: the mean of the bits' logistic losses, weighted by trust."""
        cost = np.logaddexp(0.0, -self.margins(counts)[:, None, :] * self.words[None, :, :])
        return (cost * self.trust[None, :, :]).mean(axis=2)

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        cost = -self.losses(counts) * max(1, self.words.shape[1])
        cost -= cost.max(axis=1, keepdims=True)
        odds = np.exp(cost)
        return odds / odds.sum(axis=1, keepdims=True)


def codewords(number: int, seed: int = 5) -> np.ndarray:
    """Codewords far apart: every split of up to six languages, else the best of some
    random codes of ten bits per doubling of the languages."""
    if number <= 1:
        return np.ones((number, 1))
    if number <= EXHAUSTIVE_UP_TO:
        splits = range(1, 2 ** (number - 1))
        return np.array([
            [1.0 if not row or not (split >> (row - 1)) & 1 else -1.0 for split in splits]
            for row in range(number)
        ])
    bits = math.ceil(10 * math.log2(number))
    random = np.random.default_rng(seed)
    best, widest = None, -1.0
    for _ in range(50):
        words = random.choice([-1.0, 1.0], (number, bits))
        apart = (bits - words @ words.T) / 2 + np.eye(number) * bits
        if apart.min() > widest:
            best, widest = words, apart.min()
    return best


def learned(counts: np.ndarray, names: list[str], rounds: int = 150) -> Code:
    """Classifiers fitted to all texts, their bits weighted by what classifiers fitted to
    the rest get right on every fifth text."""
    code = fitted(counts, names, rounds)
    apart = np.arange(len(names)) % 5 == 4
    rest = [name for name, out in zip(names, apart, strict=True) if not out]
    if len(code.languages) > 1 and sorted(set(rest)) == code.languages:
        judge = fitted(counts[~apart], rest, rounds // 3)
        number = np.array([code.languages.index(name) for name in names], np.int64)[apart]
        right = judge.margins(counts[apart]) * code.words[number] > 0
        for row in range(len(code.languages)):
            of_row = right[number == row]
            # One text right and one wrong are added, so that few texts say little.
            code.trust[row] = (of_row.sum(axis=0) + 1) / (len(of_row) + 2)
        code.trust /= code.trust.mean(axis=1, keepdims=True)
    return code


def fitted(counts: np.ndarray, names: list[str], rounds: int = 150) -> Code:
    """Classifiers of all bits by gradient descent on the logistic loss; each language
    weighs the same, and all bits are trusted alike."""
    languages = sorted(set(names))
    words = codewords(len(languages))
    shares = scaled(counts)
    center = shares.mean(axis=0, keepdims=True) if len(shares) else np.zeros((1, FEATURES))
    shares -= center
    number = np.array([languages.index(name) for name in names], np.int64)
    wanted = words[number] if len(names) else np.zeros((0, words.shape[1]))
    weight = 1.0 / np.maximum(np.bincount(number, minlength=len(languages)), 1)[number]
    weight = (weight / max(len(languages), 1))[:, None]
    weights = np.zeros((FEATURES, words.shape[1]))
    biases = np.zeros(words.shape[1])
    momentum = np.zeros_like(weights)
    # Texts are multiplied in parts, as each product copies them in double precision.
    parts = [slice(a, a + ROWS_AT_ONCE) for a in range(0, len(shares), ROWS_AT_ONCE)]
    for _ in range(rounds if len(languages) > 1 else 0):
        margin = wanted * (np.concatenate([shares[p] @ weights for p in parts]) + biases)
        slope = -weight * wanted / (1 + np.exp(np.clip(margin, -30, 30)))
        momentum = 0.9 * momentum + 1e-4 * weights
        for part in parts:
            momentum += shares[part].T @ slope[part]
        weights -= 8.0 * momentum
        biases -= 2.0 * slope.sum(axis=0)
    if len(languages) == 1:
        biases[:] = 5.0
    return Code(languages, words, weights, biases - (center @ weights)[0], np.ones(words.shape))


def remainder(doc_id: str, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``."""
    return F.crc32(F.col(doc_id).cast("string")) % of


def training_rows(labelled: DataFrame, most: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """Up to ``most`` documents of each language, those with the smallest hashes. Only
    documents in the lowest part of the hashes are ranked, so that a language with a third
    of all rows is not sorted in one task."""
    spark = labelled.sparkSession
    hashed = F.xxhash64("doc_id", "lang").alias("hash")
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not sizes:
        return labelled.select("lang", "text").limit(0)
    rows = [(lang, int(-(2**63) + min(1.0, (2 * most + 50) / n) * (2**64 - 2**11)))
            for lang, n in sizes.items()]
    limits = F.broadcast(spark.createDataFrame(rows, "lang string, most bigint"))
    chosen = labelled.select("doc_id", "lang", "text", hashed).join(limits, "lang")
    chosen = chosen.where(F.col("hash") <= F.col("most"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("hash", "doc_id"))
    ranked = chosen.select("lang", "hash", "doc_id", "text", rank.alias("rank"))
    return ranked.where(F.col("rank") <= most).select("lang", "text")


def train(labelled: DataFrame, most: int = SAMPLE_PER_LANGUAGE) -> Code:
    """Learn from documents (doc_id, text, lang) whose language is not null. The driver
    holds one row of counts for each sampled document, whatever its length; rows travel
    without their zeros."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in in_pieces(batches, "text", PIECE_BYTES):
            for part in table.to_batches(max_chunksize=200):
                found = counts_of(part.column("text"))
                cells = [np.flatnonzero(row).astype("<u4") for row in found]
                times = [row[at].tobytes() for row, at in zip(found, cells, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("lang"), pa.array([x.tobytes() for x in cells], pa.binary()),
                     pa.array(times, pa.binary())],
                    names=["lang", "cells", "times"],
                )

    known = labelled.where("lang is not null and text is not null")
    sample = training_rows(known, most)
    rows = sample.mapInArrow(count, "lang string, cells binary, times binary").collect()
    rows.sort(key=lambda r: (r["lang"], bytes(r["cells"]), bytes(r["times"])))
    counts = np.zeros((len(rows), FEATURES), np.float32)
    for number, row in enumerate(rows):
        counts[number, np.frombuffer(row["cells"], "<u4")] = np.frombuffer(row["times"], np.float32)
    return learned(counts, [r["lang"] for r in rows])


def identify(docs: DataFrame, code: Code, margin: float = MARGIN) -> DataFrame:
    """The row of each document as ``record``, with ``lang_pred``, ``score`` and ``ambiguous``.

    ``und`` with score 0 if the text is null, has no letter, or no language was learned.
    The score is the probability of the chosen language; of languages that cost the same
    the first by name is chosen. Repeated rows are judged one by one. Columns of any name
    stay as they are within the record.
    """
    sent = shared(docs.sparkSession, code)
    # Numbered, since a name may clash with those of this function or hold a dot.
    places = {f"c{i}": F.col(f"`{name}`") for i, name in enumerate(docs.columns)}
    numbered, text = list(places), f"c{docs.columns.index('text')}"

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = opened(sent)
        for table in in_pieces(batches, text, PIECE_BYTES):
            for part in table.to_batches(max_chunksize=200):
                names = np.full(len(part), UNKNOWN, object)
                score, near = np.zeros(len(part)), np.zeros(len(part), bool)
                able = part.column("has_letter").to_numpy(zero_copy_only=False)
                if learned.languages and able.any():
                    chance = learned.probabilities(counts_of(part.column(text)))
                    best = chance.argmax(axis=1)
                    ordered = np.sort(chance, axis=1)
                    names = np.where(able, np.array(learned.languages, object)[best], names)
                    score = np.where(able, ordered[:, -1], 0.0)
                    if len(learned.languages) > 1:
                        near = able & (ordered[:, -1] - ordered[:, -2] < margin)
                yield pa.RecordBatch.from_arrays(
                    [*part.select(numbered).columns, pa.array(names, pa.string()),
                     pa.array(score), pa.array(near)],
                    names=[*numbered, "lang_pred", "score", "ambiguous"],
                )

    kept = docs.select(*[column.alias(name) for name, column in places.items()])
    marked = kept.withColumn("has_letter", F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)))
    found = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
             T.StructField("ambiguous", T.BooleanType())]
    judged = marked.mapInArrow(judge, T.StructType([*kept.schema.fields, *found]))
    record = F.struct(*[F.col(c).alias(name) for c, name in zip(places, docs.columns, strict=True)])
    return judged.select(record.alias("record"), "lang_pred", "score", "ambiguous")


def recognised(docs: DataFrame, code: Code) -> DataFrame:
    """Documents, in their own columns, of one of the learned languages: texts without a
    letter, null texts and texts between two languages go."""
    found = identify(docs, code).where((F.col("lang_pred") != UNKNOWN) & ~F.col("ambiguous"))
    return found.select("record.*")
