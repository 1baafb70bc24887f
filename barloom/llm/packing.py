"""Packing token pieces into sequences of fixed capacity, with certified bin counts.

Every partition is packed by best-fit decreasing and compared with lower bounds from two
families of dual-feasible functions. A partition that meets its bound is certified. While all
partitions together need more bins than the bound of the whole table, bins with free space are
exchanged: whole bins move to new partitions, where best-fit decreasing runs again; the old
bins stay if it does not save any. A round that saves nothing is followed by one with partitions of twice the size, up
to what a task packs with ease; the exchange ends when such a round saves no bin either, or
nothing is left to move. A bound on the bins of all pieces together follows from the histogram
of their lengths.

Defined results: a null or empty text is one piece holding only the end id. Repeated rows
are packed as often as they occur. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import durable, text_slices

CAPACITY = 1024
PARTITION_PIECES = 8192
LARGEST_PARTITION = 65536
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = f"{PIECES}, sequence_id long, offset long, certified boolean, open boolean"


class ByteBPE:
    """Ids of the tokenizers library with a vocabulary file, computed by tiktoken.

    Strings of the vocabulary's added tokens become the ids of those. tiktoken refuses texts
    with very long runs of white space; they go through the tokenizers library.
    """

    def __init__(self, ranks: str, pattern: str, vocabulary: str):
        import base64

        import tiktoken

        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines)}
        with open(vocabulary, encoding="utf-8") as file:
            added = {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}
        self.fast = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens=added
        )
        self.vocabulary = vocabulary
        self.whole = None

    def encode(self, text: str) -> np.ndarray:
        try:
            return self.fast.encode_to_numpy(text, allowed_special="all")
        except ValueError:
            if self.whole is None:
                from tokenizers import Tokenizer

                self.whole = Tokenizer.from_file(self.vocabulary)
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)


def piece_bounds(n: int, capacity: int) -> list[int]:
    """Cut points of n ids: pieces of the capacity, the first takes the remainder."""
    return [0, *range((n - 1) % capacity + 1, n + 1, capacity)]


def token_pieces(
    docs: DataFrame,
    ranks: str,
    pattern: str,
    vocabulary: str,
    end_id: int = 2,
    capacity: int = CAPACITY,
) -> DataFrame:
    """The pieces of every document; the ids stay in the task, their checksum is kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = ByteBPE(ranks, pattern, vocabulary)
        for part in text_slices(batches):
            rows = []
            pairs = zip(
                part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True
            )
            for doc, text in pairs:
                ids = np.append(tokenizer.encode(text or ""), end_id).astype("<u4")
                cuts = piece_bounds(len(ids), capacity)
                for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    rows.append((doc, k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)]
            yield pa.record_batch(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """Bins that any packing needs, by dual-feasible functions.

    A dual-feasible function keeps the sum of any one bin's items at one bin, so the sum
    over all items bounds the number of bins. Used are the threshold functions (items below
    k vanish, items above capacity - k fill a bin) for all k and the rounding functions
    with 1 to 20 steps.
    """
    return bound_of_counts(np.bincount(lengths, minlength=capacity + 1).astype(np.int64))


def bound_of_counts(counts: np.ndarray) -> int:
    """``lower_bound`` of the histogram of the lengths 0 to capacity."""
    capacity = len(counts) - 1
    if not counts.any():
        return 0
    size = np.arange(capacity + 1)
    total = np.concatenate(([0], np.cumsum(counts * size)))
    number = np.concatenate(([0], np.cumsum(counts)))
    k = np.arange(capacity // 2 + 1)
    whole = number[-1] - number[capacity - k + 1]
    middle = total[capacity - k + 1] - total[k]
    best = int(np.max(whole + -(-middle // capacity)))
    for steps in range(1, 21):
        scaled = (steps + 1) * size
        # in units of 1 / (steps * capacity) of a bin, so that all sums stay whole numbers
        value = np.where(scaled % capacity == 0, steps * size, scaled // capacity * capacity)
        best = max(best, int(-(-np.sum(counts * value) // (steps * capacity))))
    return best


def best_fit_decreasing(
    lengths: np.ndarray, capacity: int = CAPACITY
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of every item and the free space of every bin.

    The bins with the same free space form a stack; a bit mask of the stacks that are not
    empty finds the tightest fit.
    """
    bins = np.zeros(len(lengths), np.int64)
    offsets = np.zeros(len(lengths), np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    free: list[int] = []
    mask = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        fits = mask >> need
        if fits:
            space = need + (fits & -fits).bit_length() - 1
            b = stacks[space].pop()
            if not stacks[space]:
                mask ^= 1 << space
        else:
            space, b = capacity, len(free)
            free.append(capacity)
        bins[i], offsets[i] = b, capacity - space
        free[b] = space - need
        if free[b]:
            if not stacks[free[b]]:
                mask |= 1 << free[b]
            stacks[free[b]].append(b)
    return bins, offsets, np.array(free, np.int64)


def _pack_partition(number: int, capacity: int):
    """Pack one partition of round ``number``; column ``old`` names the bins that moved in."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "piece", "old"], kind="stable", ignore_index=True)
        lengths = pdf["length"].to_numpy()
        bins, offsets, free = best_fit_decreasing(lengths, capacity)
        names = (number << 50) + (int(pdf["part"].iloc[0]) << 20) + np.arange(len(free))
        bound = lower_bound(lengths, capacity)
        used = len(free)
        if number and (kept := pdf["old"].nunique()) <= used:
            used = kept
            codes, kept_names = pd.factorize(pdf["old"])
            bins, offsets, names = codes, pdf["old_offset"].to_numpy(), kept_names
            free = capacity - np.bincount(codes, lengths).astype(np.int64)
        met = used == bound
        certified = met | (free == 0)
        return pdf.assign(
            sequence_id=np.asarray(names)[bins],
            offset=offsets,
            certified=certified[bins],
            open=(free > 0)[bins],
        )[[c.split()[0] for c in PACKED.split(", ")]]

    return run


def pack(
    pieces: DataFrame, capacity: int = CAPACITY, partition_pieces: int = PARTITION_PIECES
) -> DataFrame:
    """Pieces with ``sequence_id``, ``offset``, whether the bin count of the partition they
    ended in is certified (a full bin always is), and ``bound``, below which no packing of all
    pieces gets. ``pieces`` is read several times: pass a stored table."""
    counts = np.zeros(capacity + 1, np.int64)
    for row in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[row["length"]] = row["n"]
    total, bound, closed_bins, bins = int(counts.sum()), bound_of_counts(counts), 0, None
    parts = -(-total // partition_pieces)
    todo = pieces.select(
        "*",
        F.lit(0).cast("long").alias("old"),
        F.lit(0).cast("long").alias("old_offset"),
        F.pmod(F.xxhash64("doc_id", "piece"), F.lit(max(1, parts))).alias("part"),
    )
    done, number, size = None, 0, partition_pieces
    while True:
        packed = durable(
            todo.groupBy("part").applyInPandas(_pack_partition(number, capacity), PACKED)
        )
        first = F.col("offset") == 0  # one piece a bin
        used, moving, rows = packed.agg(
            F.count_if(first), F.count_if(first & F.col("open")), F.count_if("open")
        ).first()
        stuck = bins is not None and used >= bins
        met = closed_bins + used == bound
        if met or parts <= 1 or not moving or (stuck and size >= LARGEST_PARTITION):
            done = packed if done is None else done.unionByName(packed)
            break
        closed = packed.filter(~F.col("open"))
        done = closed if done is None else done.unionByName(closed)
        closed_bins += used - moving
        bins, number = moving, number + 1
        size = min(2 * size, LARGEST_PARTITION) if stuck else size
        parts = -(-rows // size)
        todo = packed.filter("open").select(
            *[c.split()[0] for c in PIECES.split(", ")],
            F.col("sequence_id").alias("old"),
            F.col("offset").alias("old_offset"),
            F.pmod(F.xxhash64("sequence_id", F.lit(number)), F.lit(parts)).alias("part"),
        )
    return done.drop("open").withColumn("bound", F.lit(bound).cast("long"))
