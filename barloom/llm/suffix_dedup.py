"""Removal of long byte strings that occur more than once, by sorted suffixes.

Every window of ``WINDOW`` bytes is named by the least hash among the ``GRAM``-byte strings
inside it, and a stretch is a run of windows named by the same string at the same place.
Equal windows have equal names and lie in different stretches, wherever they are, so only
stretches whose name occurs at least twice can hold repeats, and names deal the work to
tasks.
Stretches with equal bytes are counted; what is left to compare, the different stretches
of one name, goes through suffix arrays: in blocks of bounded size, suffixes smaller than
their successors are sorted directly, all others are induced by scanning the buckets, and
neighbours that agree in a whole window repeat. A name with more different stretches than a
block takes is not compared but named again: each of its stretches is cut into shorter ones
by longer strings and another hash, and these are counted and compared in their turn. Near
copies then part where they differ, and at the last level a name is a whole window.

Defined results: a null text is empty; texts shorter than a window lose nothing. Repeated
rows count as further occurrences, so both lose their long strings; rows with one
identifier are expected to be equal. Rows without identifier are told apart by a hash of
their text, put below -2^62, where no identifier may lie. Stretches are told apart by 64-bit
hashes within one name (64 bits more).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import Rolling, durable, mix, string_buffers, text_slices

WINDOW = 200
GRAM = 48
BLOCK_STRETCHES = 2000
BLOCK_BYTES = 400_000
# Lengths of the naming strings of the further levels, in hundredths of a window.
FINER = (56, 84, 96, 100)
STRETCHES = "doc_id long, name long, digest long, start int, windows int, copies long"
SPANS = "doc_id long, start long, stop long"
_BYTES = Rolling(3)
_GRAMS = [Rolling(2), *(Rolling(4 + k) for k in range(len(FINER)))]


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, from block-wise running minima."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def named_stretches(
    data: np.ndarray, offsets: np.ndarray, window: int, gram: int, level: int = 0
):
    """(row, name, digest, start in the row, number of windows) of every stretch."""
    n = len(data) - window + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none.astype(np.uint64), none.astype(np.uint64), none, none
    at = np.arange(len(data) - gram + 1)
    prefix = _GRAMS[level].prefix(data)
    grams = mix(_GRAMS[level].ranges(prefix, at, at + gram))
    names = sliding_minimum(grams, window - gram + 1)
    starts = np.arange(n)
    row = np.searchsorted(offsets, starts, "right") - 1
    inside = starts + window <= offsets[row + 1]
    fresh = np.ones(n, bool)
    # the first string with the least hash is left behind, or a smaller one has come in
    fresh[1:] = (names[1:] != names[:-1]) | (grams[: n - 1] == names[:-1])
    fresh[1:] |= (row[1:] != row[:-1]) | ~inside[:-1]
    heads = np.flatnonzero(fresh & inside)
    # the end of a stretch is the next start that begins another or lies in no window
    breaks = np.append(np.flatnonzero(fresh | ~inside), n)
    count = breaks[np.searchsorted(breaks, heads, "right")] - heads
    whole = _BYTES.ranges(_BYTES.prefix(data), heads, heads + count + window - 1)
    digest = mix(whole + count.astype(np.uint64))
    rows = row[heads]
    return rows, names[heads], digest, heads - offsets[rows], count


def stretches(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            data, offsets = string_buffers(part.column("text"))
            rows, name, digest, start, count = named_stretches(data, offsets, window, gram)
            yield pa.record_batch(
                [
                    part.column("doc_id").take(pa.array(rows)),
                    pa.array(name.view(np.int64)),
                    pa.array(digest.view(np.int64)),
                    pa.array(start.astype(np.int32)),
                    pa.array(count.astype(np.int32)),
                    pa.array(np.ones(len(rows), np.int64)),
                ],
                [c.split()[0] for c in STRETCHES.split(", ")],
            )

    return docs.select("doc_id", "text").mapInArrow(run, STRETCHES)


def identified(docs: DataFrame) -> DataFrame:
    """Documents whose missing identifiers have been replaced by a hash of their text."""
    name = F.lit(-(1 << 62)) - F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(1 << 62)) - 1
    return docs.withColumn("doc_id", F.coalesce(F.col("doc_id").cast("long"), name))


def suffix_array(data: bytes, depth: int) -> np.ndarray:
    """Suffixes in order of their first ``depth`` bytes, in two stages.

    Suffixes smaller than their successor are sorted directly. A suffix larger than its
    successor starts with a byte that is at least the successor's, so its place follows
    from the successor's: buckets of first bytes are scanned upwards, and each suffix
    found puts the one before it at the front part of its own bucket.
    """
    text = np.frombuffer(data, np.uint8)
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    differs = np.flatnonzero(text[1:] != text[:-1])
    following = np.searchsorted(differs, np.arange(n))
    smaller = np.zeros(n, bool)
    known = following < len(differs)
    at = differs[following[known]]
    smaller[known] = text[at] < text[at + 1]
    direct = sorted(np.flatnonzero(smaller).tolist(), key=lambda i: data[i : i + depth])
    direct = np.array(direct, np.int64)
    edges = np.searchsorted(text[direct], np.arange(257)) if len(direct) else np.zeros(257, int)
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[text[-1]].append(np.array([n - 1]))
    out = []
    for c in range(256):
        level = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        bucket = []
        while len(level):
            bucket.append(level)
            before = level[level > 0] - 1
            level = before[(text[before] == c) & ~smaller[before]]
        bucket.append(direct[edges[c] : edges[c + 1]])
        entries = np.concatenate(bucket)
        out.append(entries)
        before = entries[entries > 0] - 1
        before = before[~smaller[before] & (text[before] > c)]
        first = text[before]
        order = np.argsort(first, kind="stable")
        before, first = before[order], first[order]
        cuts = np.flatnonzero(np.diff(first)) + 1
        for group in np.split(before, cuts):
            if len(group):
                waiting[text[group[0]]].append(group)
    return np.concatenate(out)


def same_windows(data: bytes, starts: np.ndarray, window: int) -> np.ndarray:
    """Number of the class of equal windows of each start, through the suffix array."""
    ranks = suffix_array(data, window)
    wanted = np.full(len(data), -1, np.int64)
    wanted[starts] = np.arange(len(starts))
    order = wanted[ranks]
    order = order[order >= 0]
    placed = starts[order]
    text = np.frombuffer(data, np.uint8)
    equal = np.zeros(len(placed), bool)
    reach = np.arange(window)
    for a in range(1, len(placed), 4096):
        b = min(len(placed), a + 4096)
        equal[a:b] = (text[placed[a:b, None] + reach] == text[placed[a - 1 : b - 1, None] + reach]).all(axis=1)
    classes = np.zeros(len(starts), np.int64)
    classes[order] = np.cumsum(~equal)
    return classes


def _compared(window: int):
    """Rows of the stretches of whole names, sorted by name, to their repeated ranges."""

    def flush(rows: list[tuple]) -> pa.RecordBatch:
        data = b"".join(r[4] for r in rows)
        base = np.cumsum([0, *[len(r[4]) for r in rows]])[:-1]
        counts = np.array([len(r[4]) - window + 1 for r in rows])
        owner = np.repeat(np.arange(len(rows)), counts)
        rel = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        classes = same_windows(data, base[owner] + rel, window)
        size = np.bincount(classes)
        copies = np.array([r[3] for r in rows])
        weight = np.bincount(classes, copies[owner] > 1)
        # stretches that occur more than once are repeats anyway
        hit = ((size[classes] > 1) | (weight[classes] > 0)) & (copies[owner] == 1)
        head = hit.copy()
        head[1:] &= ~(hit[:-1] & (owner[1:] == owner[:-1]))
        tail = hit.copy()
        tail[:-1] &= ~(hit[1:] & (owner[1:] == owner[:-1]))
        a, b = np.flatnonzero(head), np.flatnonzero(tail)
        docs = np.array([r[1] for r in rows])[owner[a]]
        place = np.array([r[2] for r in rows], np.int64)[owner[a]]
        return pa.record_batch(
            [pa.array(docs), pa.array(place + rel[a]), pa.array(place + rel[b] + window)],
            ["doc_id", "start", "stop"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, last = 0, (None,) * 3
        names = ["name", "doc_id", "start", "copies", "bytes"]
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in names]
            for row in zip(*columns, strict=True):
                if row[:3] == last:  # cut out of a repeated row
                    continue
                if row[0] != last[0] and size >= BLOCK_BYTES:
                    yield flush(held)
                    held, size = [], 0
                last = row[:3]
                held.append(row)
                size += len(row[4])
        if held:
            yield flush(held)

    return run


CUTS = ("name", "start", "windows", "copies", "large")
DEALT = (
    "name long, doc_id long, start int, copies long, bytes binary, digest long, windows int, "
    "finer boolean"
)


def _dealt(
    field: dict[str, pa.Array], docs: pa.Array, texts: list[bytes], window: int, gram: int, level: int
) -> pa.RecordBatch:
    """Stretches with their bytes; those of large names cut into shorter ones (``finer``) by
    the strings of the next level."""
    large = field["large"].to_numpy(zero_copy_only=False).astype(bool)
    stay, go = np.flatnonzero(~large), np.flatnonzero(large)
    data = np.frombuffer(b"".join([texts[k] for k in go]), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(texts[k]) for k in go], dtype=np.int64)))
    cut, name, digest, start, count = named_stretches(data, offsets, window, gram, level)
    cut = cut.astype(np.int64)
    begin = offsets[cut] + start
    raw = data.tobytes()
    inner = [raw[a:b] for a, b in zip(begin.tolist(), (begin + count + window - 1).tolist(), strict=True)]
    before = field["name"].to_numpy()
    names = mix(before[go][cut].view(np.uint64) ^ mix(name)).view(np.int64)
    places = field["start"].to_numpy()
    both = pa.array(np.concatenate((stay, go[cut])))
    n = len(stay)
    return pa.record_batch(
        [
            pa.array(np.concatenate((before[stay], names))),
            docs.take(both),
            pa.array(np.concatenate((places[stay], places[go][cut] + start)).astype(np.int32)),
            field["copies"].take(both),
            pa.array([texts[k] for k in stay] + inner, pa.binary()),
            pa.array(np.concatenate((np.zeros(n, np.int64), digest.view(np.int64)))),
            pa.array(np.concatenate((np.zeros(n), count)).astype(np.int32)),
            pa.array(np.arange(len(both)) >= n),
        ],
        [c.split()[0] for c in DEALT.split(", ")],
    )


def _cut_out(docs: DataFrame, wanted: DataFrame, window: int, gram: int) -> DataFrame:
    """The wanted stretches of the documents with their bytes, see ``_dealt``."""
    lists = wanted.groupBy("doc_id").agg(F.collect_list(F.struct(*CUTS)).alias("cuts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in text_slices(batches):
            data, offsets = string_buffers(piece.column("text"))
            raw = data.tobytes()
            cuts = piece.column("cuts")
            owner = np.repeat(np.arange(piece.num_rows), np.diff(cuts.offsets.to_numpy()))
            flat = cuts.flatten()
            field = {c: flat.field(c) for c in CUTS}
            begin = field["start"].to_numpy() + offsets[owner]
            end = np.minimum(begin + field["windows"].to_numpy() + window - 1, offsets[owner + 1])
            texts = [raw[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
            ids = piece.column("doc_id").take(pa.array(owner))
            yield _dealt(field, ids, texts, window, gram, 1)

    return docs.select("doc_id", "text").join(lists, "doc_id").mapInArrow(run, DEALT)


def _cut_again(wanted: DataFrame, window: int, gram: int, level: int) -> DataFrame:
    """Stretches that bring their bytes, see ``_dealt``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in text_slices(batches, column="bytes"):
            field = {c: piece.column(c) for c in CUTS}
            texts = piece.column("bytes").to_pylist()
            yield _dealt(field, piece.column("doc_id"), texts, window, gram, level)

    return wanted.select("doc_id", *CUTS, "bytes").mapInArrow(run, DEALT)


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, start, stop: byte ranges that repeated windows cover; ranges may overlap.

    ``copies`` counts the equal stretches a row stands for; all of them have been found
    repeated once there are two. From the second level on stretches bring their bytes along,
    so the texts are read and dealt only once.
    """
    grams = [gram, *(max(gram, window * part // 100) for part in FINER)]
    stop = (F.col("start") + F.col("windows") + F.lit(window - 1)).cast("long")
    span = [F.col("doc_id"), F.col("start").cast("long").alias("start"), stop.alias("stop")]
    found = durable(stretches(docs, window, gram))
    spans = None
    for level in range(len(grams)):
        names = durable(
            found.groupBy("name")
            .agg(
                F.count(F.lit(1)).alias("n"),
                (F.min("digest") != F.max("digest")).alias("differ"),
            )
            .filter("n > 1")
            .select("name", "differ")
        )
        known = durable(found.join(names, "name"))
        own = [F.first("bytes").alias("bytes")] if level else []
        kinds = durable(
            known.filter("differ").groupBy("name", "digest").agg(
                F.count(F.lit(1)).alias("members"),
                F.sum("copies").alias("copies"),
                F.min(F.struct("doc_id", "start", "windows")).alias("at"),
                *own,
            )
        )
        again = known.filter("differ and copies = 1").join(
            kinds.filter("members > 1").select("name", "digest"), ["name", "digest"]
        )
        now = known.filter("not differ and copies = 1").select(*span)
        now = now.unionByName(again.select(*span))
        spans = now if spans is None else spans.unionByName(now)

        large = durable(
            kinds.groupBy("name").agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > BLOCK_STRETCHES).select("name", F.lit(True).alias("large"))
        )
        last = level + 1 == len(grams) or large.isEmpty()
        if last:
            wanted = kinds.withColumn("large", F.lit(False))
        else:
            wanted = kinds.join(large, "name", "left").fillna(False, ["large"])
        wanted = wanted.select("name", "at.*", "copies", "large", *(["bytes"] if level else []))
        finer = grams[min(level + 1, len(grams) - 1)]
        if level:
            cut = _cut_again(wanted, window, finer, min(level + 1, len(grams) - 1))
        else:
            cut = _cut_out(docs, wanted, window, finer)
        cut = cut if last else durable(cut)
        blocks = cut.filter("not finer").select("name", "doc_id", "start", "copies", "bytes")
        blocks = blocks.repartition("name").sortWithinPartitions("name", "doc_id", "start")
        spans = spans.unionByName(durable(blocks.mapInArrow(_compared(window), SPANS)))
        if last:
            break
        found = durable(cut.filter("finer").dropDuplicates(["name", "doc_id", "start"]))
    return spans


def _with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    lists = spans.groupBy("doc_id").agg(F.collect_set(F.struct("start", "stop")).alias("_spans"))
    return docs.join(lists, "doc_id", "left")


def merged(starts: np.ndarray, stops: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint ranges that cover the same bytes, in order."""
    order = np.argsort(starts, kind="stable")
    starts, stops = starts[order], np.minimum(np.maximum.accumulate(stops[order]), n)
    fresh = np.ones(len(starts), bool)
    fresh[1:] = starts[1:] > stops[:-1]
    return starts[fresh], stops[np.roll(fresh, -1)]


def _ranges(piece: pa.RecordBatch):
    """For every row: its bytes and its disjoint spans."""
    data, offsets = string_buffers(piece.column("text"))
    raw = data.tobytes()
    spans = piece.column("_spans").to_pylist()
    for k, own in enumerate(spans):
        text = raw[offsets[k] : offsets[k + 1]]
        if not own:
            yield text, np.zeros(0, np.int64), np.zeros(0, np.int64)
            continue
        pairs = np.array([(s["start"], s["stop"]) for s in own], np.int64)
        yield text, *merged(pairs[:, 0], pairs[:, 1], len(text))


def removal_digests(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    docs = identified(docs.withColumn("_own_id", F.col("doc_id"))).select("doc_id", "text", "_own_id")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in text_slices(batches):
            rows = []
            for text, a, b in _ranges(piece):
                digest, at = hashlib.sha256(), 0
                for start, stop in zip(a.tolist(), b.tolist(), strict=True):
                    digest.update(text[at:start])
                    at = stop
                digest.update(text[at:])
                rows.append((len(text), int((b - a).sum()), len(a), digest.hexdigest()))
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            kinds = [pa.int64()] * 3 + [pa.string()]
            yield pa.record_batch(
                [piece.column("_own_id"), *[pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]],
                schema_names,
            )

    schema_names = [c.split()[0] for c in schema.split(", ")]
    return _with_spans(docs, repeated_spans(docs, window)).mapInArrow(run, schema)


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents with repeated strings removed and ``n_chars`` counted again.

    A character that is cut by the border of a span stays whole.
    """
    columns = docs.columns
    docs = docs.withColumn("_own_id", F.col("doc_id"))
    own = identified(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in text_slices(batches):
            texts = []
            for text, a, b in _ranges(piece):
                out, at = [], 0
                for start, stop in zip(a.tolist(), b.tolist(), strict=True):
                    while start < stop and text[start] & 0xC0 == 0x80:
                        start += 1
                    while stop > start and stop < len(text) and text[stop] & 0xC0 == 0x80:
                        stop -= 1
                    out.append(text[at:start])
                    at = stop
                out.append(text[at:])
                texts.append(b"".join(out).decode())
            arrays = {c: piece.column("_own_id" if c == "doc_id" else c) for c in columns}
            valid = piece.column("text").is_valid().to_pylist()
            arrays["text"] = pa.array(
                [t if v else None for t, v in zip(texts, valid, strict=True)], pa.string()
            )
            if "n_chars" in arrays:
                counts = [len(t) for t in texts]
                arrays["n_chars"] = pa.array(counts, piece.column("n_chars").type)
            yield pa.record_batch(list(arrays.values()), columns)

    spans = repeated_spans(own.select("doc_id", "text"), window)
    found = _with_spans(own, spans).select(*columns, "_own_id", "_spans")
    return found.mapInArrow(run, docs.select(*columns).schema)
