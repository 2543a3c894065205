"""Texts of Arrow batches as arrays of bytes and words, and the shared settings and files."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, SparkSession

import tillhouse
from tillhouse.session import prepare, working_folder
from tillhouse.sinks.folders import remove

# The most rows and bytes of a batch that a Python worker gets at once.
BATCH_ROWS = 2_000
BATCH_BYTES = 8 * 1024 * 1024

# Functions travel to the executors by value, so that these need no copy of the library.
cloudpickle.register_pickle_by_value(tillhouse)


def ready(spark: SparkSession) -> SparkSession:
    """A session whose Arrow batches are bounded in bytes, whatever the length of texts, and
    that removes the shuffle files of a result or stored table once it is written."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark


def shared(spark: SparkSession, value) -> Broadcast:
    """A broadcast of an object of the library's own classes; ``opened`` reads it."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def opened(sent: Broadcast):
    return cloudpickle.loads(sent.value)


#: Folders of the tables to remove at the end of the block of ``passing`` that is open.
PASSING: ContextVar[list[str] | None] = ContextVar("passing", default=None)


@contextmanager
def passing(spark: SparkSession):
    """Tables stored in this block are removed at its end, but for lasting ones. Only
    lasting tables may be read after it."""
    folders: list[str] = []
    outer = PASSING.set(folders)
    try:
        yield
    finally:
        PASSING.reset(outer)
        for folder in folders:
            remove(spark, folder)


def stored(df: DataFrame, purpose: str, lasting: bool = False) -> DataFrame:
    """The frame written to the shared folder and read again, so that what follows does
    not depend on executors that may be lost."""
    spark = df.sparkSession
    folder = working_folder(spark, purpose)
    if PASSING.get() is not None and not lasting:
        PASSING.get().append(folder)
    df.write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a column, one after the other, and their n + 1 offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(offsets) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def in_pieces(batches: Iterator[pa.RecordBatch], text: str, most: int) -> Iterator[pa.Table]:
    """The rows dealt anew into tables of about ``most`` bytes of text, of one row at least."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        ends = texts_of(batch.column(text))[1][1:]
        first = 0
        while first < len(batch):
            room = most - size + (ends[first - 1] if first else 0)
            last = max(int(np.searchsorted(ends, room, side="right")), first + (not held))
            if last > first:
                held.append(batch.slice(first, last - first))
                size += int(ends[last - 1] - (ends[first - 1] if first else 0))
            if last < len(batch):
                yield pa.Table.from_batches(held)
                held, size = [], 0
            first = last
    if held:
        yield pa.Table.from_batches(held)


@dataclass
class Words:
    """Words of several texts: their code in ``terms``, and how many each text has."""

    codes: np.ndarray
    terms: pa.Array
    counts: np.ndarray

    @property
    def firsts(self) -> np.ndarray:
        """Index of each text's first word, and the number of words at the end."""
        return np.concatenate([[0], np.cumsum(self.counts)])


def word_bytes() -> np.ndarray:
    """For each byte 0 if it separates words, else its lower-case form: words are digits,
    letters A-Z in either case and all characters beyond ASCII."""
    table = np.zeros(256, np.uint8)
    for byte in range(256):
        if byte >= 128 or chr(byte).isalnum():
            table[byte] = ord(chr(byte).lower()) if byte < 128 else byte
    return table


WORD_BYTES = word_bytes()


def words_of(column: pa.Array) -> Words:
    """Lower-cased words of every text; null texts have none."""
    data, offsets = texts_of(column)
    low = WORD_BYTES[data]
    inside = low != 0
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    heads = offsets[:-1][np.diff(offsets) > 0]
    starts[heads] |= inside[heads]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    ends[heads[1:] - 1] |= inside[heads[1:] - 1]
    first = np.flatnonzero(starts)
    lengths = np.flatnonzero(ends) + 1 - first
    counts = np.diff(np.searchsorted(first, offsets))
    ends32 = np.concatenate([[0], np.cumsum(lengths)])
    binary, width = (pa.binary(), np.int32) if ends32[-1] < 2**31 else (pa.large_binary(), np.int64)
    buffers = [None, pa.py_buffer(ends32.astype(width)), pa.py_buffer(low[inside])]
    coded = pa.Array.from_buffers(binary, len(first), buffers).dictionary_encode()
    return Words(coded.indices.to_numpy(zero_copy_only=False), coded.dictionary, counts)


def mixed(values: np.ndarray) -> np.ndarray:
    """The finaliser of the splitmix64 generator: every bit depends on every other."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))
