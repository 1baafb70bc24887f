"""Shortest-pack-first packing over the length histogram.

Documents are tokenised once; their ids are stored with the number of the task and the rank
of the document among those of equal length in that task. Full sequences of long documents
need no packing. What remains of every document has a length below the capacity, and only
the histogram of these lengths is packed: lengths are placed longest first into the pack that
is filled least, where a pack is a pattern of lengths with a count, and placing a length
splits a pattern or changes its count. The work depends on the capacity and not on the number
of documents.

Packs with gaps left are then closed: the shortest ones are taken apart and poured, cut where
needed, into the gaps of the fullest. The one pack that is left is cut at powers of two, which
need no padding, so no sequence is padded. The patterns are joined back by rank: counts per
task and length give every document its rank among all of its length, and the rank names the
pattern, the pack and the place.

Defined results: a null or empty text is the end id alone. Repeated rows are packed as often
as they occur. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import durable, lowered, spaces, string_buffers, text_slices, word_bounds

CAPACITY = 2048
END_ID = 1
SLICE = 2 << 20
AT_ONCE = 8192
# Words whose ids a worker remembers before it starts anew.
REMEMBERED = 1 << 19
# Steps of closing gaps; no table met needs as many, see ``close_gaps``.
STEPS = 1 << 14
# Ranks and numbers of sequences in a task are below 2^44, tasks below 2^19.
RANK_BITS = 44
TOKENS = "doc_id long, task long, fulls long, rest int, local long, width int, ids binary"
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long"
)


# Kinds of bytes: white space, letters, digits, other ASCII, and those that keep a word whole.
# U+00C0 to U+024F, two bytes each, are letters but for two; see ``parts_of``.
_KIND = np.full(256, 3, np.uint8)
_KIND[128:192] = 1
_KIND[192:] = 4
_KIND[0xC3:0xCA] = 1
_KIND[[32, 9, 10, 11, 12, 13]] = 0
_KIND[[ord("'"), ord("<")]] = 4
_KIND[ord("0") : ord("9") + 1] = 2
_KIND[ord("A") : ord("Z") + 1] = 1
_KIND[ord("a") : ord("z") + 1] = 1
# Multiplication and division sign, and the capital that becomes two characters in lower case.
_ODD_PAIRS = ((0xC3, 0x97), (0xC3, 0xB7), (0xC4, 0xB0))


def parts_of(data: np.ndarray, offsets: np.ndarray):
    """(bytes without white space, starts of the parts in ``data``, their lengths, whether each
    is a whole word of any kind).

    A word of ASCII and of letters up to U+024F is cut into runs of letters, single digits and
    runs of signs, with A-Z in lower case; the vocabulary file does the same and never joins
    across them. A word with an apostrophe, a ``<`` or other characters stays as it is.
    """
    a, b = word_bounds(data, offsets)
    if not len(a):
        return data[:0], a, a, a.astype(bool)
    kind = _KIND[data]
    for lead, follower in _ODD_PAIRS:
        kind[np.flatnonzero((data[:-1] == lead) & (data[1:] == follower))] = 4
    whole = np.maximum.reduceat(kind, a) == 4
    inside = ~spaces(data)
    kept = np.zeros(len(data), bool)
    kept[inside] = np.repeat(whole, b - a)
    cut = np.empty(len(data), bool)
    cut[0] = True
    cut[1:] = kind[1:] != kind[:-1]
    cut |= kind == 2
    cut &= inside & ~kept
    cut[a] = True
    starts = np.flatnonzero(cut)
    body = np.where(kept, data, lowered(data))[inside]
    first = starts - np.cumsum(~inside, dtype=np.int64)[starts]
    return body, starts, np.diff(np.append(first, len(body))), kept[starts]


class WordIds:
    """Ids of ``word_bpe_49k.json`` of the tokenizers library.

    A text's ids are those of its parts in order, and every distinct part goes through the
    library once a worker. Parts that are one word to the library go through it joined by
    blanks, and the ids are told apart by the mark that ends a word. They are composed letters
    in lower case and never cut further, so the steps before the merges are left out for them.
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.merges = Tokenizer.from_file(vocabulary)
        self.merges.normalizer = normalizers.Sequence([])
        self.merges.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        tokens = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(tokens.values()) + 1, bool)
        self.ends[[k for token, k in tokens.items() if token.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.starts = np.zeros(1, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _learn(self, words: list[bytes], joined: bool) -> None:
        for k in range(0, len(words), AT_ONCE):
            part = words[k : k + AT_ONCE]
            if joined:
                text = b" ".join(part).decode().lower()
                found = self.merges.encode(text, add_special_tokens=False)
                flat = np.array(found.ids, np.uint32)
                stops = np.flatnonzero(self.ends[flat]) + 1
                if len(stops) != len(part):
                    raise ValueError("the vocabulary file does not end every part as one word")
            else:
                found = self.tokenizer.encode_batch_fast(
                    [w.decode() for w in part], add_special_tokens=False
                )
                lists = [e.ids for e in found]
                flat = np.fromiter(chain.from_iterable(lists), np.uint32)
                stops = np.cumsum([len(x) for x in lists])
            self.known.update(zip(part, range(len(self.known), len(self.known) + len(part))))
            self.starts = np.concatenate((self.starts, self.starts[-1] + stops))
            self.flat = np.concatenate((self.flat, flat))

    def _numbers(self, words: list[bytes], whole: np.ndarray) -> np.ndarray:
        """Number of every word among those known, after the new ones have been learnt."""
        if len(self.known) > REMEMBERED:
            self._forget()
        known = self.known
        new = [(w, odd) for w, odd in zip(words, whole.tolist(), strict=True) if w not in known]
        for kind in (False, True):
            self._learn([w for w, odd in new if odd is kind], joined=not kind)
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of the texts in them)."""
        data, offsets = string_buffers(texts)
        body, starts, sizes, whole = parts_of(data, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        ends = np.concatenate(([0], np.cumsum(sizes)))
        words = pa.Array.from_buffers(
            pa.large_binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(body)]
        ).dictionary_encode()
        index = words.indices.to_numpy()
        odd = np.zeros(len(words.dictionary), bool)
        odd[index[whole]] = True
        numbers = self._numbers(words.dictionary.to_pylist(), odd)[index]
        counts = self.starts[numbers + 1] - self.starts[numbers]
        ends = np.cumsum(counts)
        at = np.arange(ends[-1]) + np.repeat(self.starts[numbers] - ends + counts, counts)
        before = np.concatenate(([0], ends))
        return self.flat[at], before[np.searchsorted(starts, offsets, "left")]


@lru_cache(maxsize=1)
def word_ids(vocabulary: str) -> WordIds:
    """The ids of a vocabulary file, kept with the words they know for the worker's next tasks."""
    return WordIds(vocabulary)


def tokens(
    docs: DataFrame, vocabulary: str, end_id: int = END_ID, capacity: int = CAPACITY
) -> DataFrame:
    """Every document's ids, little-endian in ``width`` bytes each, with its task, the full
    sequences in the task before it, the length left after its own full sequences (``rest``),
    and its rank in the task among equal rests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = word_ids(vocabulary), TaskContext.get().partitionId()
        small = max(encoder.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16
        width = 2 if small else 4
        seen, fulls = np.zeros(capacity, np.int64), 0
        for part in text_slices(batches, SLICE):
            ids, offsets = encoder.encode(part.column("text"))
            rows = part.num_rows
            ids = np.insert(ids, offsets[1:], end_id).astype(f"<u{width}")
            offsets = offsets + np.arange(rows + 1)
            full, rest = np.divmod(np.diff(offsets), capacity)
            order = np.argsort(rest, kind="stable")
            ordered = rest[order]
            local = np.empty(rows, np.int64)
            local[order] = np.arange(rows) - np.searchsorted(ordered, ordered) + seen[ordered]
            seen += np.bincount(rest, minlength=capacity)
            stored = pa.Array.from_buffers(
                pa.large_binary(), rows, [None, pa.py_buffer(offsets * width), pa.py_buffer(ids)]
            )
            yield pa.record_batch(
                [
                    part.column("doc_id").cast(pa.int64()),
                    pa.array(np.full(rows, task, np.int64)),
                    pa.array(fulls + np.cumsum(full) - full),
                    pa.array(rest, pa.int32()),
                    pa.array(local),
                    pa.array(np.full(rows, width, np.int32)),
                    stored.cast(pa.binary()),
                ],
                [c.split()[0] for c in TOKENS.split(", ")],
            )
            fulls += int(full.sum())

    return docs.select("doc_id", "text").mapInArrow(run, TOKENS)


@dataclass
class Pattern:
    """``count`` packs alike. A slot (length, rank, start, take, times) stands for ``m`` =
    count / times documents of one length, from ``rank`` on: pack k * m + i holds ``take`` ids
    from ``start + k * take`` on of document ``rank + i``."""

    count: int
    total: int = 0
    slots: list[tuple[int, int, int, int, int]] = field(default_factory=list)

    def put(self, length: int, rank: int, start: int, take: int, times: int = 1) -> None:
        self.slots.append((length, rank, start, take, times))
        self.total += take

    def split(self, count: int) -> Pattern:
        """Cut off the first ``count`` packs of a pattern whose slots are all of one time."""
        head = Pattern(count, self.total, list(self.slots))
        self.count -= count
        self.slots = [(n, rank + count, s, t, times) for n, rank, s, t, times in self.slots]
        return head


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[Pattern]:
    """Patterns that hold every length of the histogram, placed longest first.

    Always the pack filled least takes the next document, as many of them at once as keep it
    no fuller than the next pattern; what fits nowhere opens packs.
    """
    done: list[Pattern] = []
    heap: list[tuple[int, int, Pattern]] = []
    born = 0

    def push(pattern: Pattern) -> None:
        nonlocal born
        if pattern.total == capacity:
            done.append(pattern)
        else:
            born += 1
            heapq.heappush(heap, (pattern.total, born, pattern))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            if heap and heap[0][0] + length <= capacity:
                total, _, pattern = heapq.heappop(heap)
                level = heap[0][0] if heap else capacity
                most = min(max(level - total, length), capacity - total) // length
                if pattern.count > left:
                    push(pattern.split(pattern.count - left))
                times = min(most, left // pattern.count)
            else:
                times = min(capacity // length, left)
                pattern = Pattern(left // times)
            for _ in range(times):
                pattern.put(length, rank, 0, length)
                rank += pattern.count
                left -= pattern.count
            push(pattern)
    return done + [pattern for _, _, pattern in sorted(heap, key=lambda x: x[:2])]


def close_gaps(patterns: list[Pattern], capacity: int) -> list[Pattern]:
    """Pour the shortest packs into the gaps of the others, the largest gaps of all packs of a
    pattern first, until one pack is not full; that one is cut at powers of two.

    A document that is longer than the gap fills as many packs of the taker as it can at once.
    Counts of any size shrink to nothing in the end, but slowly, as in Euclid's algorithm: after
    ``STEPS`` steps the few packs still open stay as they are, with their padding.
    """
    done: list[Pattern] = []
    open_: dict[int, Pattern] = {}
    least: list[tuple[int, int]] = []
    most: list[tuple[int, int]] = []
    born = 0

    def push(pattern: Pattern) -> None:
        nonlocal born
        if pattern.total == capacity:
            done.append(pattern)
        elif pattern.total:
            born += 1
            open_[born] = pattern
            heapq.heappush(least, (pattern.total, born))
            heapq.heappush(most, (-pattern.count * (capacity - pattern.total), born))

    def pop(heap: list[tuple[int, int]]) -> Pattern:
        while True:
            _, name = heapq.heappop(heap)
            if name in open_:
                return open_.pop(name)

    for pattern in patterns:
        push(pattern)
    steps = 0
    while open_ and (steps := steps + 1) <= STEPS:
        donor = pop(least)
        if not open_:
            if donor.count == 1:
                return done + _powers_of_two(donor)
            push(donor)
            donor = donor.split(max(1, donor.count * (capacity - donor.total) // capacity))
            taker = open_.pop(born)
        else:
            taker = pop(most)
        gap = capacity - taker.total
        if donor.count > taker.count:
            rest, donor = donor, donor.split(taker.count)
            push(rest)
        length, rank, start, take, _ = donor.slots.pop()
        times = min(max(1, take // gap), taker.count // donor.count)
        if taker.count > times * donor.count:
            rest, taker = taker, taker.split(times * donor.count)
            push(rest)
        part = min(gap, take)
        left = take - times * part
        taker.put(length, rank, start + left, part, times)
        donor.total -= times * part
        if left:
            donor.slots.append((length, rank, start, left, 1))
        push(taker)
        push(donor)
    return done + list(open_.values())


def _powers_of_two(pack: Pattern) -> list[Pattern]:
    """One pack's documents, cut where needed, in packs whose sizes are powers of two."""
    parts = []
    while pack.total:
        part = Pattern(1)
        room = 1 << (pack.total.bit_length() - 1)
        while part.total < room:
            length, rank, start, take, _ = pack.slots.pop()
            move = min(take, room - part.total)
            part.put(length, rank, start + take - move, move)
            pack.total -= move
            if move < take:
                pack.slots.append((length, rank, start, take - move, 1))
        parts.append(part)
    return parts


@dataclass(frozen=True)
class Places:
    """Where the rests go: for every length, runs of ranks, and the slots of each run."""

    keys: np.ndarray
    first: np.ndarray
    slots: np.ndarray

    def find(self, rest: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row of ``rest``, piece) of all pieces; a piece is start, length, sequence, offset."""
        at = np.searchsorted(self.keys, (rest << RANK_BITS) + rank, "right") - 1
        counts = np.where(rest > 0, self.first[at + 1] - self.first[at], 0)
        row, nth = _repeated(counts)
        start, take, times, sequence, m, offset = self.slots[self.first[at][row] + nth].T
        slot, k = _repeated(times)
        row = row[slot]
        pieces = np.stack(
            (
                start[slot] + k * take[slot],
                take[slot],
                sequence[slot] + rank[row] + k * m[slot],
                offset[slot],
            ),
            axis=1,
        )
        return row, pieces


def _repeated(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every index as often as its count, and the number of the repeat."""
    row = np.repeat(np.arange(len(counts)), counts)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)


def places(patterns: list[Pattern]) -> Places:
    """The patterns numbered and turned round, from packs with slots to lengths with ranks."""
    by_length = defaultdict(list)
    sequence = 0
    for pattern in patterns:
        offset = 0
        for length, rank, start, take, times in pattern.slots:
            m = pattern.count // times
            row = (start, take, times, sequence - rank, m, offset)
            by_length[length].append((rank, rank + m, row))
            offset += take
        sequence += pattern.count
    keys, first, found = [], [0], []
    for length, slots in sorted(by_length.items()):
        bounds = np.unique([(a, b) for a, b, _ in slots])
        runs: list[list] = [[] for _ in range(len(bounds) - 1)]
        for a, b, row in slots:
            for k in range(np.searchsorted(bounds, a), np.searchsorted(bounds, b)):
                runs[k].append(row)
        for low, run in zip(bounds.tolist(), runs, strict=False):
            keys.append((length << RANK_BITS) + low)
            found += sorted(run)
            first.append(len(found))
    return Places(
        np.array(keys or [0], np.int64),
        np.array(first if keys else [0, 0], np.int64),
        np.array(found, np.int64).reshape(-1, 6),
    )


def ranked(stored: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, dict[int, int]]:
    """Stored tokens with ``rank``, unique among all documents of one rest, and how many
    documents have each rest."""
    counts = durable(stored.groupBy("task", "rest").agg(F.count(F.lit(1)).alias("n")))
    whole = counts.filter("rest > 0").groupBy("rest").agg(F.sum("n").alias("n"))
    histogram = {r["rest"]: r["n"] for r in whole.collect()}
    before = Window.partitionBy("rest").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(
        "task", "rest", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )
    rows = stored.join(base.hint("shuffle_hash"), ["task", "rest"])
    return rows.withColumn("rank", F.col("base") + F.col("local")), histogram


def pack(stored: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of stored tokens and their places."""
    rows, histogram = ranked(stored, capacity)
    found = places(close_gaps(shortest_pack_first(histogram, capacity), capacity))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, SLICE, "ids"):
            data, offsets = string_buffers(part.column("ids"))
            raw = memoryview(data)
            own = {
                c: part.column(c).to_numpy().astype(np.int64)
                for c in ("task", "fulls", "rest", "rank", "width")
            }
            size = np.diff(offsets) // own["width"]
            full = size // capacity
            row, nth = _repeated(full)
            start = nth * capacity
            length = np.full(len(row), capacity)
            # full sequences of one document are numbered below zero, by task
            sequence = -1 - (own["task"][row] << RANK_BITS) - own["fulls"][row] - nth
            rest_row, piece = found.find(own["rest"], own["rank"])
            row = np.concatenate((row, rest_row))
            start = np.concatenate((start, full[rest_row] * capacity + piece[:, 0]))
            length = np.concatenate((length, piece[:, 1]))
            sequence = np.concatenate((sequence, piece[:, 2]))
            offset = np.concatenate((nth * 0, piece[:, 3]))
            width = own["width"][row]
            begin = offsets[row] + start * width
            crc = [
                zlib.crc32(_four_bytes(raw[a:b], w))
                for a, b, w in zip(
                    begin.tolist(), (begin + length * width).tolist(), width.tolist(), strict=True
                )
            ]
            index = pa.array(row)
            yield pa.record_batch(
                [
                    part.column("doc_id").take(index),
                    pa.array(start),
                    pa.array(length),
                    pa.array(crc, pa.int64()),
                    pa.array(size[row]),
                    pa.array(sequence),
                    pa.array(offset),
                ],
                [c.split()[0] for c in PIECES.split(", ")],
            )

    columns = ["doc_id", "task", "fulls", "rest", "rank", "width", "ids"]
    return rows.select(*columns).mapInArrow(run, PIECES)


def _four_bytes(ids: memoryview, width: int) -> bytes | memoryview:
    return ids if width == 4 else np.frombuffer(ids, "<u2").astype("<u4").tobytes()


def packed_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Pieces of all documents; columns as in ``PIECES``."""
    return pack(durable(tokens(docs, vocabulary)))
