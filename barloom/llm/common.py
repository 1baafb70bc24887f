"""Tables, Arrow slices and word hashes shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom import scratch

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 1 << 20

# Odd multipliers of the rolling hash and of the word mixers; any odd constants do.
_BASE = np.uint64(0x9E3779B97F4A7C15 | 5)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def durable(df: DataFrame) -> DataFrame:
    """``scratch.durable``, with the shuffle files of the job removed once it has ended.

    The stored copy replaces them, and without this a chain of stored steps would keep the
    shuffles of all its steps on the disks of the executors.
    """
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, "false")
    conf.set(key, "true")
    try:
        return scratch.durable(df)
    finally:
        conf.set(key, before)


def text_slices(
    batches: Iterable[pa.RecordBatch], limit: int = SLICE_BYTES, column: str = "text"
) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that each holds about ``limit`` bytes of text, one row at least.

    The working memory of a task then follows one slice, or one document where that is
    longer, and not the number of rows Spark sends at once.
    """
    for batch in batches:
        sizes = np.diff(string_buffers(batch.column(column))[1])
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, offsets of the rows in them); a null counts as empty."""
    text = pa.types.is_string(column.type) or pa.types.is_large_string(column.type)
    if column.null_count:
        column = column.fill_null("" if text else b"")
    column = column.cast(pa.large_string() if text else pa.large_binary())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64 bits over 64 bits, one to one."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * _MIX[0]
        values = (values ^ (values >> np.uint64(27))) * _MIX[1]
    return values ^ (values >> np.uint64(31))


def _table_of(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(2 * seed + 1) + np.uint64(seed))


class Rolling:
    """Hashes of any byte ranges of a buffer, from one pass of prefix sums modulo 2^64.

    The hash of bytes c0..cn is the sum of T[ci] * B^i, so a range is a difference of two
    prefix sums, shifted back by a power of the inverse of B. T is a table of random
    values, and results are mixed.
    """

    def __init__(self, seed: int):
        self.values = _table_of(seed)
        self.base = np.uint64((int(_BASE) + 16 * seed) % (1 << 64))
        self.inverse = np.uint64(pow(int(self.base), -1, 1 << 64))
        self.powers = np.ones(1, np.uint64)
        self.back = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            for name, base in (("powers", self.base), ("back", self.inverse)):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))

    def prefix(self, data: np.ndarray) -> np.ndarray:
        self._grow(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.powers[: len(data)], out=sums[1:])
        return sums

    def ranges(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Unmixed hashes of the ranges, equal for equal bytes anywhere."""
        return (prefix[ends] - prefix[starts]) * self.back[starts]


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ROLLING = Rolling(1)


def spaces(data: np.ndarray) -> np.ndarray:
    """Whether each byte is one that parts words."""
    return _IS_SPACE[data]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in the bytes; words never cross rows."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~_IS_SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets[:-1]] = True
    first[-1] = True
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | first[:-1]))
    after = np.empty(len(data), bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    return starts, ends


def lowered(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = (ends - starts).astype(np.uint64)
    return mix(_ROLLING.ranges(_ROLLING.prefix(data), starts, ends) + lengths)


def owners(offsets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Row of each start. Rows without bytes own nothing."""
    return np.searchsorted(offsets, starts, "right") - 1


def bounds_of(rows: np.ndarray, n: int) -> np.ndarray:
    """Offsets of the runs of sorted row numbers 0..n-1."""
    return np.searchsorted(rows, np.arange(n + 1))


def salt_of(column: str, salts: int):
    return F.pmod(F.xxhash64(column), F.lit(salts)).cast("int")
