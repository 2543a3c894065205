"""Quality of a text by compression.

Two zstandard dictionaries, one trained on good and one on bad texts, compress a text. The
difference of the two sizes over their sum says which kind it is more like, and a logistic
curve fitted to other labelled texts turns that into a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.batches import opened, shared

#: Labelled documents of one class that are learned from, at most: those with the smallest
#: hashes. Three quarters of them make the dictionaries, the others fit the curve.
SAMPLE_PER_CLASS = 1600
#: Characters of the pieces that a dictionary is trained on, bytes of these pieces that the
#: driver holds for one class, and bytes of a dictionary.
PIECE = 500
TRAINING_BYTES = 8 * 1024 * 1024
DICTIONARY_BYTES = 500_000
LEVEL = 3


@dataclass
class Model:
    """Dictionaries of both kinds and the curve from size difference to probability."""

    good: bytes
    bad: bytes
    slope: float = 0.0
    offset: float = 0.0
    level: int = LEVEL

    def chance(self, difference: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * difference + self.offset, -40, 40)))


class Sizes:
    """Compressors under both dictionaries, made once per worker."""

    def __init__(self, model: Model):
        self.by = []
        for content in (model.good, model.bad):
            options = {"write_checksum": False, "write_content_size": False}
            if content:
                trained = zstandard.ZstdCompressionDict(content)
                trained.precompute_compress(level=model.level)
                options |= {"dict_data": trained, "write_dict_id": False}
            else:
                options |= {"level": model.level}
            self.by.append(zstandard.ZstdCompressor(**options))

    def difference(self, text: str | None) -> float:
        """Bytes that the good dictionary saves over the bad one, per byte of text."""
        raw = (text or "").encode()
        good, bad = (len(x.compress(raw)) for x in self.by)
        return (bad - good) / max(len(raw), 1)


def dictionary(pieces: list[bytes], most: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary; the pieces themselves if they are too few to train on."""
    try:
        return zstandard.train_dictionary(most, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-most:]


def curve(differences: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve, by Newton steps with a little ridge. With
    labels of one kind only, the curve is the share of that kind, smoothed."""
    share = (labels.sum() + 1) / (len(labels) + 2)
    slope, offset = 0.0, float(np.log(share / (1 - share)))
    if len(set(labels.tolist())) < 2:
        return slope, offset
    spread = float(np.std(differences)) or 1.0
    rows = np.stack([differences / spread, np.ones(len(differences))])
    at = np.array([0.0, offset])
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(at @ rows, -30, 30)))
        gradient = rows @ (labels - chance) - 0.01 * at * [1, 0]
        hessian = (rows * (chance * (1 - chance))) @ rows.T + np.diag([0.01, 1e-9])
        at = at + np.clip(np.linalg.solve(hessian, gradient), -2, 2)
    return float(at[0] / spread), float(at[1])


def sample(labels: DataFrame, most: int) -> DataFrame:
    """Up to ``most`` ids of each quality, those with the smallest hashes; ids with both
    labels, without id or without label are left out."""
    by_id = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(
        F.min("quality").alias("quality"), F.max("quality").alias("other")
    )
    known = by_id.where("quality = other").select(
        "doc_id", "quality", F.xxhash64("doc_id", F.lit("quality")).alias("hash")
    )
    parts = [
        known.where(F.col("quality") == kind).orderBy("hash", "doc_id").limit(most)
        for kind in (0, 1)
    ]
    return parts[0].unionByName(parts[1])


def train(
    docs: DataFrame, labels: DataFrame, most: int = SAMPLE_PER_CLASS, level: int = LEVEL
) -> Model:
    """Learn from the documents (doc_id, text) that ``labels`` (doc_id, quality 0 or 1) name.

    At most ``most`` documents of each class are read, in whole; the driver holds pieces of
    them of ``TRAINING_BYTES`` a class. Documents with null text or without label teach
    nothing; without any label every score is one half.
    """
    spark = docs.sparkSession
    chosen = F.broadcast(sample(labels, most))  # at most 2 * most ids
    rows = docs.where("text is not null").select("doc_id", "text").join(chosen, "doc_id")
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(4))
    rows = rows.select("doc_id", "text", "quality", part.alias("part"))
    pieces = rows.where("part > 0").select(
        "quality",
        F.explode(F.expr(
            f"transform(sequence(0, cast((char_length(text) - 1) / {PIECE} as int)), "
            f"i -> struct(i as number, substring(text, i * {PIECE} + 1, {PIECE}) as text))"
        )).alias("piece"),
        F.xxhash64("doc_id", "piece.number", F.lit("piece")).alias("hash"),
    ).where("piece.text <> ''")
    contents = []
    for kind in (1, 0):
        held = (
            pieces.where(F.col("quality") == kind).orderBy("hash", "piece.text")
            .limit(TRAINING_BYTES // (4 * PIECE)).select("piece.text").collect()
        )
        contents.append(dictionary([row["text"].encode() for row in held]))
    model = Model(*contents, level=level)
    sent = shared(spark, model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(opened(sent))
        for batch in batches:
            found = [sizes.difference(x.as_py()) for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.float64()), batch.column("quality")], ["d", "quality"]
            )

    fitted = rows.where("part = 0").select("text", "quality").mapInArrow(
        measure, "d double, quality int"
    ).collect()
    fitted.sort()
    model.slope, model.offset = curve(
        np.array([r["d"] for r in fitted]), np.array([r["quality"] for r in fitted], float)
    )
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``difference`` and ``score`` beside the columns of the frame, which has a text.

    Null and empty texts compress alike under both dictionaries and get the score of a
    difference of 0. Repeated rows are scored one by one.
    """
    sent = shared(docs.sparkSession, model)
    kept = [c for c in docs.columns if c not in ("difference", "score", "text")]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = opened(sent)
        sizes = Sizes(learned)
        for batch in batches:
            found = np.array([sizes.difference(x.as_py()) for x in batch.column("text")])
            found = found.reshape(len(batch))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(found, pa.float64()),
                 pa.array(learned.chance(found), pa.float64())],
                names=[*kept, "difference", "score"],
            )

    columns = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*kept).schema)
    return docs.select(*kept, "text").mapInArrow(measure, f"{columns}difference double, score double")
