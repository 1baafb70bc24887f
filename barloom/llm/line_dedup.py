"""Near-duplicate lines by a deletion-neighbourhood join; the earliest line stays.

Lines are sequences of words, and the edit distance counts words inserted, deleted or
replaced, at most one; in scripts written without blanks each character is a word. Lines
with fewer than ``LEAST_WORDS`` words only go when an earlier line has the same words. Two
longer lines at distance one have equal first or equal last halves,
so first the hashes of halves are joined, which leaves few lines. Those emit their
variants: the line without word i, once with and once without the number i, on the side
that is not known to be equal. Equal variants that carry the same i differ by a
replacement, a variant that equals a whole line by an insertion. Only the earliest line
of a key is needed, so keys are reduced by minima and no group lists its pairs. The edit
distance of every line that is to go and its earliest neighbour is verified on the words.

A line goes when an earlier line, by (doc_id, line number), lies within the bound, whether
or not that one stays itself.

Defined results: lines without words stay. A null text stays null and an empty one empty; documents that lose all lines stay, empty.
Rows with one identifier are expected to be equal and are one document. Lines with equal
words are at distance zero whatever their spacing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import (
    Rolling,
    durable,
    mix,
    owners,
    string_buffers,
    text_slices,
    word_bounds,
    word_hashes,
)

LEAST_WORDS = 5
LINES = "doc_id long, line int, h long, g long, keys array<long>"
VARIANTS = "key long, kind int, doc_id long, line int"
REPLACED, SHORTENED, WHOLE = 0, 1, 2
_SEQUENCE, _SECOND = Rolling(4), Rolling(5)
_TAGS = mix(np.arange(21, 29, dtype=np.uint64))
#: Thai, Lao and Tibetan; Burmese; Khmer; kana; ideographs.
WITHOUT_BLANKS = (
    (0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x4DBF),
    (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF),
)
_RANGES = "".join(f"{chr(a)}-{chr(b)}" for a, b in WITHOUT_BLANKS)
_split = re.compile(rf"[{_RANGES}]|[^\x20\x09-\x0D{_RANGES}]+").findall


class Sequences:
    """Hashes of runs of words, and of runs with one word left out, from prefix sums."""

    def __init__(self, hashes: np.ndarray, rolling: Rolling = _SEQUENCE):
        rolling._grow(len(hashes) + 1)
        self.rolling = rolling
        self.sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * rolling.powers[: len(hashes)], out=self.sums[1:])

    def run(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (self.sums[b] - self.sums[a]) * self.rolling.back[a]

    def without(self, a: np.ndarray, i: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.run(a, i) + self.rolling.powers[i - a] * self.run(i + 1, b)


def split_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``word_bounds``, with each character of scripts without blanks as a word."""
    starts, ends = word_bounds(data, offsets)
    heads = np.flatnonzero(data >= 0xE0)
    if not len(heads):
        return starts, ends
    sizes = np.where(data[heads] >= 0xF0, 4, 3)
    codes = data[heads].astype(np.int64) & np.where(sizes == 4, 7, 15)
    for k in (1, 2, 3):
        more = sizes > k
        codes[more] = codes[more] << 6 | data[heads[more] + k] & 63
    edges = np.array(WITHOUT_BLANKS) + [0, 1]
    own = np.searchsorted(edges.ravel(), codes, "right") % 2 == 1
    heads, tails = heads[own], heads[own] + sizes[own]
    begin = np.concatenate((starts, heads, np.setdiff1d(tails, ends)))
    end = np.concatenate((ends, tails, np.setdiff1d(heads, starts)))
    return np.unique(begin), np.unique(end)


def line_words(column: pa.Array):
    """(hashes of all words; row, first word and end word of every line)."""
    data, offsets = string_buffers(column)
    starts, ends = split_bounds(data, offsets)
    hashes = word_hashes(data, starts, ends)
    breaks = np.flatnonzero(data == 10)
    # a line starts at each row and behind each line feed
    begins = np.sort(np.concatenate((offsets[:-1], breaks + 1)), kind="stable")
    rows = np.sort(np.concatenate((np.arange(len(column)), owners(offsets, breaks))))
    first = np.searchsorted(starts, begins)
    return hashes, rows, first, np.append(first[1:], len(starts))


def lines_of(docs: DataFrame) -> DataFrame:
    """doc_id, line, two hashes of every line with words, and keys of halves of long ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            hashes, rows, first, stop = line_words(part.column("text"))
            number = np.arange(len(rows)) - np.searchsorted(rows, rows)
            some = stop > first
            rows, number, first, stop = rows[some], number[some], first[some], stop[some]
            words, count = Sequences(hashes), stop - first
            long = count >= LEAST_WORDS
            keys = []
            for half in (count // 2, (count - 1) // 2):
                length = half.astype(np.uint64)
                keys.append(mix(mix(words.run(first, first + half) + length) ^ _TAGS[0]))
                keys.append(mix(mix(words.run(stop - half, stop) + length) ^ _TAGS[1]))
            size = count.astype(np.uint64)
            flat = np.stack(keys, axis=1)[long]
            ends = np.append(0, np.cumsum(4 * long)).astype(np.int32)
            yield pa.record_batch(
                [
                    part.column("doc_id").take(pa.array(rows)),
                    pa.array(number.astype(np.int32)),
                    pa.array(mix(words.run(first, stop) + size).view(np.int64)),
                    pa.array(mix(Sequences(hashes, _SECOND).run(first, stop) + size).view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.ravel().view(np.int64))),
                ],
                ["doc_id", "line", "h", "g", "keys"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, LINES)


def _line_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc_id, line, sides, text of the wanted lines."""
    lists = wanted.groupBy("doc_id").agg(F.collect_list(F.struct("line", "sides")).alias("_lines"))
    schema = "doc_id long, line int, sides int, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            out = []
            columns = [part.column(c).to_pylist() for c in ("doc_id", "text", "_lines")]
            for doc, text, lines in zip(*columns, strict=True):
                own = (text or "").split("\n")
                out += [(doc, x["line"], x["sides"], own[x["line"]]) for x in lines if x["line"] < len(own)]
            columns = list(zip(*out, strict=True)) or [[]] * 4
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.string()]
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                ["doc_id", "line", "sides", "text"],
            )

    texts = docs.select("doc_id", "text").join(lists, "doc_id").mapInArrow(run, schema)
    return texts.dropDuplicates(["doc_id", "line"])


def variants(texts: DataFrame) -> DataFrame:
    """Keys of the lines without one word, on their open sides, and of the whole lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, 1 << 18):
            data, offsets = string_buffers(part.column("text"))
            starts, ends = split_bounds(data, offsets)
            words = Sequences(word_hashes(data, starts, ends))
            first = np.searchsorted(starts, offsets[:-1])
            stop = np.append(first[1:], len(starts))
            count = stop - first
            sides = part.column("sides").to_numpy()
            half = (count - 1) // 2
            begin = np.where(sides & 2, first, first + half)
            end = np.where(sides & 1, stop, stop - half)
            total = end - begin
            row = np.repeat(np.arange(part.num_rows), total)
            i = begin[row] + np.arange(len(row)) - np.repeat(np.cumsum(total) - total, total)
            short = mix(words.without(first[row], i, stop[row]) + (count[row] - 1).astype(np.uint64))
            place = mix((i - first[row]).astype(np.uint64) + _TAGS[2])
            whole = mix(words.run(first, stop) + count.astype(np.uint64))
            keys = np.concatenate((mix(short ^ place), mix(short ^ _TAGS[3]), mix(whole ^ _TAGS[3])))
            kinds = np.repeat([REPLACED, SHORTENED, WHOLE], [len(row), len(row), len(whole)])
            at = pa.array(np.concatenate((row, row, np.arange(part.num_rows))))
            yield pa.record_batch(
                [
                    pa.array(keys.view(np.int64)),
                    pa.array(kinds.astype(np.int32)),
                    part.column("doc_id").take(at),
                    part.column("line").take(at),
                ],
                ["key", "kind", "doc_id", "line"],
            )

    return texts.mapInArrow(run, VARIANTS)


def word_distance_at_most_one(a: list[str], b: list[str]) -> bool:
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) >= len(b)) :] == b[i + (len(b) >= len(a)) :]


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """doc_id, line, near of the pairs whose lines really are within the bound."""
    lines = texts.select("doc_id", "line", "text")
    other = lines.select(
        F.struct("doc_id", "line").alias("near"), F.col("text").alias("other")
    )
    schema = "doc_id long, line int, near_doc long, near_line int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "line", "near_doc", "near_line"]
        for part in batches:
            pairs = zip(part.column("text").to_pylist(), part.column("other").to_pylist(), strict=True)
            keep = [word_distance_at_most_one(_split(a), _split(b)) for a, b in pairs]
            yield part.select(names).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(lines, ["doc_id", "line"]).join(other, "near")
    return joined.select(
        "doc_id", "line", F.col("near.doc_id").alias("near_doc"),
        F.col("near.line").alias("near_line"), "text", "other",
    ).mapInArrow(run, schema)


def dropped_lines(docs: DataFrame) -> DataFrame:
    """doc_id, line of every line that goes; ``docs`` is read twice."""
    lines = durable(lines_of(docs))
    place = F.struct("doc_id", "line")
    kinds = durable(
        lines.groupBy("h", "g").agg(
            F.min(F.struct("doc_id", "line", "keys")).alias("m"), F.max(place).alias("last")
        ).select("h", "g", F.struct("m.doc_id", "m.line").alias("first"), "m.keys", "last")
    )
    halves = kinds.select("first", F.posexplode("keys").alias("side", "key"))
    shared = durable(
        halves.groupBy("key").agg(F.min("first").alias("low"), F.max("first").alias("high"))
        .filter("low != high").select("key")
    )
    # bit 1: first halves met, so the edit is behind; bit 2: last halves met
    wanted = (
        halves.join(shared, "key")
        .groupBy("first")
        .agg(F.bit_or(F.when(F.col("side") % 2 == 0, 1).otherwise(2)).alias("sides"))
        .select("first.*", "sides")
    )
    texts = durable(_line_texts(docs, wanted))
    emitted = durable(variants(texts))
    least = emitted.groupBy("key").agg(
        *[
            F.min(F.when(F.col("kind") == kind, place)).alias(name)
            for kind, name in ((REPLACED, "replaced"), (SHORTENED, "shortened"), (WHOLE, "whole"))
        ],
        F.min(place).alias("low"),
        F.max(place).alias("high"),
    )
    met = least.filter("low != high").select("key", "replaced", "shortened", "whole")
    near = (
        emitted.join(met, "key")
        .select(
            "doc_id",
            "line",
            F.when(F.col("kind") == REPLACED, F.col("replaced"))
            .when(F.col("kind") == SHORTENED, F.col("whole"))
            .otherwise(F.col("shortened"))
            .alias("near"),
        )
        .filter(F.col("near") < place)
        .groupBy("doc_id", "line")
        .agg(F.min("near").alias("near"))
    )
    close = _verified(near, texts).select(place.alias("first"))
    first_goes = close.select("first.*")
    again = kinds.filter("first != last").select("h", "g", "first")
    copies = lines.join(again, ["h", "g"]).filter(place != F.col("first"))
    return copies.select("doc_id", "line").unionByName(first_goes).distinct()


def line_count() -> Column:
    return F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long")


def without_near_lines(docs: DataFrame) -> DataFrame:
    """The documents without the lines that go; ``n_chars`` is counted again."""
    gone = dropped_lines(docs).groupBy("doc_id").agg(F.collect_list("line").alias("_gone"))
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            texts = []
            pairs = zip(part.column("text").to_pylist(), part.column("_gone").to_pylist(), strict=True)
            for text, lines in pairs:
                if text is not None and lines:
                    own = set(lines)
                    text = "\n".join(x for n, x in enumerate(text.split("\n")) if n not in own)
                texts.append(text)
            arrays = {c: part.column(c) for c in columns}
            arrays["text"] = pa.array(texts, pa.string())
            if "n_chars" in arrays:
                counts = [len(t or "") for t in texts]
                arrays["n_chars"] = pa.array(counts, part.column("n_chars").type)
            yield pa.record_batch(list(arrays.values()), columns)

    joined = docs.join(gone, "doc_id", "left").select(*columns, "_gone")
    return joined.mapInArrow(run, docs.schema)
