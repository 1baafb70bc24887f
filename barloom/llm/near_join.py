"""Jaccard self-join of word shingles by parity sketches.

A document is its set of word shingles. The sketch has K blocks; a shingle flips one bit
of one block, so the parities of two documents differ in at most as many bits as their
sets differ in elements. A block is very wide and is kept as the XOR of 64-bit hashes of
its set bits; a second, narrow sketch of 512 bits is kept bit by bit, and its Hamming
distance rejects candidates.

Sets of sizes a and b with 100 |A and B| >= percent |A or B| differ in at most
k = (a + b)(100 - percent) / (100 + percent) elements. With K = k + 1 + s blocks at least
s + 1 agree. Each document emits the k + 1 heaviest of its blocks (most shingles that are
not common, most shingles, block number): the heaviest agreeing block outweighs s others
on both sides, so both emit it. K follows from the band of the smaller set; a document
also takes part in the band below when a partner there is possible. Which shingles are
common is counted over all documents; it only orders blocks, so that texts which share a
widespread passage do not meet through it.

Equal sets are joined into classes first. Of the classes that share a block, each is
compared with one hub; classes that are still in different components are compared with
other hubs, and once the pairs between components number at most ``FEW_PAIRS`` for each
row, with each other. That last join carries sizes and narrow sketches, so that it only
puts out pairs which both allow. No link is lost and a group of copies never becomes all
its pairs. Links are verified on the whole texts.

Defined results: A-Z count as a-z. A null text or one without words has an empty set, no
links, and is its own component. Fewer words than a shingle are one shingle. Rows with one
identifier are one document; its smallest row by size counts in case they differ. Rows without
identifier are documents of their own, equal texts among them one document (by a 62-bit hash).
Identifiers are below 2**62. Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import (
    bounds_of,
    durable,
    lowered,
    mix,
    owners,
    string_buffers,
    text_slices,
    word_bounds,
    word_hashes,
)
from barloom.llm.components import components

BAND = 1.3
SLACK = 1 / 3
COMMON_SHARE = 1 / 1000
COMMON_MOST = 1 << 19
COUNTED_SHINGLES = 1 << 20
SKETCH_WORDS = 8
HUB_ROUNDS = 3
HUB_MEMBERS = 128
FEW_PAIRS = 64
# Identifiers are below this number; rows without one get numbers from here on.
NAMELESS = 1 << 62
SKETCH_NAMES = [f"s{i}" for i in range(SKETCH_WORDS)]
SKETCHED = (
    "doc_id long, n long, f1 long, f2 long, "
    + ", ".join(f"{s} long" for s in SKETCH_NAMES)
    + ", keys array<long>"
)
_FACTORS = mix(np.arange(11, 43, dtype=np.uint64))


def shingle_sets(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): the sorted distinct shingle hashes of every row."""
    data, offsets = string_buffers(column)
    data = lowered(data)
    starts, ends = word_bounds(data, offsets)
    rows = owners(offsets, starts)
    hashes = word_hashes(data, starts, ends)
    edges = bounds_of(rows, len(column))
    counts = np.diff(edges)
    size = np.minimum(counts, words)
    total = np.maximum(counts - words + 1, np.minimum(counts, 1))
    owner = np.repeat(np.arange(len(column)), total)
    first = edges[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(total) - total, total)
    mixed = np.zeros(len(owner), np.uint64)
    for k in range(words):
        inside = k < size[owner]
        at = np.where(inside, first + k, 0)
        if len(owner):
            mixed += np.where(inside, hashes[at] * _FACTORS[k], np.uint64(0))
    mixed = mix(mixed + size[owner].astype(np.uint64))
    order = np.lexsort((mixed, owner))
    owner, mixed = owner[order], mixed[order]
    fresh = np.ones(len(owner), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (mixed[1:] != mixed[:-1])
    return mixed[fresh], bounds_of(owner[fresh], len(column))


class Bands:
    """Size bands and the numbers of blocks that make the join complete."""

    def __init__(self, percent: int):
        self.percent = percent
        edges = [1]
        while edges[-1] < 1 << 40:
            edges.append(max(edges[-1] + 1, int(edges[-1] * BAND)))
        self.edges = np.array(edges)

    def of(self, n: int) -> list[int]:
        """The bands a set of n elements takes part in."""
        own = int(np.searchsorted(self.edges, n, "right")) - 1
        below = own - 1
        found = [own]
        while below >= 0 and self.percent * n <= 100 * (int(self.edges[below + 1]) - 1):
            found.append(below)
            below -= 1
        return found

    def blocks(self, band: int) -> tuple[int, int]:
        """(emitted blocks, all blocks) of a band; no blocks when only equal sets link."""
        largest = int(self.edges[band + 1]) - 1
        partner = 100 * largest // self.percent
        k = (largest + partner) * (100 - self.percent) // (100 + self.percent)
        emitted = k + 1 if k else 0
        return emitted, emitted + max(1, int(emitted * SLACK)) if emitted else 0


def _counted(words: int):
    """Shingles that many documents of a stretch of documents have, with their numbers."""

    def flush(held: list[np.ndarray], docs: int) -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        often = counts >= max(3, docs * COMMON_SHARE)
        return pa.record_batch(
            [pa.array(values[often].view(np.int64)), pa.array(counts[often])], ["shingle", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, docs = [], 0, 0
        for part in text_slices(batches):
            hashes, _ = shingle_sets(part.column("text"), words)
            held.append(hashes)
            size, docs = size + len(hashes), docs + part.num_rows
            if size >= COUNTED_SHINGLES:
                yield flush(held, docs)
                held, size, docs = [], 0, 0
        if held:
            yield flush(held, docs)

    return run


def common_shingles(docs: DataFrame, words: int) -> np.ndarray:
    """Hashes of shingles in about a thousandth of all documents or more, sorted.

    At most ``COMMON_MOST`` of them, 4 MB: the most frequent, as they only order blocks.
    """
    found = docs.select("text").mapInArrow(_counted(words), "shingle long, n long")
    summed = found.groupBy("shingle").agg(F.sum("n").alias("n"))
    least = max(3, int(docs.count() * COMMON_SHARE / 2))
    top = summed.filter(F.col("n") >= least).orderBy(F.desc("n"), "shingle").limit(COMMON_MOST)
    rows = top.select("shingle").toPandas()["shingle"].to_numpy(np.int64)
    return np.sort(rows.view(np.uint64))


def among(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_set, values), len(sorted_set) - 1)
    return sorted_set[at] == values


def block_keys(hashes: np.ndarray, common: np.ndarray, bands: Bands) -> np.ndarray:
    """Keys of the heaviest blocks of one set, for each band it takes part in.

    ``common`` marks the shingles that are widespread.
    """
    keys = []
    for band in bands.of(len(hashes)):
        emitted, total = bands.blocks(band)
        if not emitted:
            continue
        block = (hashes % np.uint64(total)).astype(np.int64)
        order = np.argsort(block, kind="stable")
        at = np.flatnonzero(np.diff(block[order], prepend=-1))
        value = np.zeros(total, np.uint64)
        value[block[order][at]] = np.bitwise_xor.reduceat(mix(hashes[order]), at)
        weight = np.bincount(block, minlength=total)
        rare = np.bincount(block[~common], minlength=total)
        heavy = np.lexsort((np.arange(total), -weight, -rare))[:emitted]
        place = mix(heavy.astype(np.uint64) * np.uint64(4096) + np.uint64(band))
        keys.append(mix(value[heavy] ^ place))
    return np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)


def parity_sketch(hashes: np.ndarray) -> np.ndarray:
    bits = SKETCH_WORDS * 64
    counts = np.bincount((hashes >> np.uint64(32)).astype(np.int64) % bits, minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def sketches(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, size and fingerprints of the set, narrow sketch and block keys."""

    shared = docs.sparkSession.sparkContext.broadcast(common_shingles(docs, words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        for part in text_slices(batches):
            hashes, edges = shingle_sets(part.column("text"), words)
            sets = [hashes[a:b] for a, b in pairwise(edges)]
            sums = [(np.sum(mix(s ^ np.uint64(1))), np.sum(mix(s ^ np.uint64(2)))) for s in sets]
            marks = np.array([parity_sketch(s) for s in sets]).reshape(len(sets), -1)
            common = among(hashes, shared.value)
            keys = [
                block_keys(s, common[a:b], bands).view(np.int64)
                for s, (a, b) in zip(sets, pairwise(edges), strict=True)
            ]
            ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
            flat = np.concatenate([*keys, np.zeros(0, np.int64)])
            yield pa.record_batch(
                [
                    part.column("doc_id"),
                    pa.array(np.diff(edges).astype(np.int64)),
                    *[pa.array(np.array([s[k] for s in sums], np.uint64).view(np.int64))
                      for k in range(2)],
                    *[pa.array(np.ascontiguousarray(marks[:, k])) for k in range(SKETCH_WORDS)],
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                ],
                ["doc_id", "n", "f1", "f2", *SKETCH_NAMES, "keys"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, SKETCHED)


def _possible(percent: int) -> Column:
    """Whether sizes and narrow sketches of a pair (prefixes a, b) allow a link."""
    apart = sum((F.bit_count(F.col(f"a.{s}").bitwiseXOR(F.col(f"b.{s}"))) for s in SKETCH_NAMES),
                F.lit(0))
    a, b = F.col("a.n"), F.col("b.n")
    return (
        (100 * F.least(a, b) >= percent * F.greatest(a, b))
        & ((100 + percent) * apart <= (100 - percent) * (a + b))
    )


def verified(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """a, b, linked: candidate pairs decided on whole texts.

    ``a`` is the side that occurs often. Its members are dealt to groups of about
    ``HUB_MEMBERS``, and its text travels once to each group, so neither a hub with very
    many members nor its text gathers in one task.
    """
    pairs = durable(pairs)
    degree = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / HUB_MEMBERS).alias("groups"))
    degree = durable(degree)
    dealt = pairs.join(degree, "a").select(
        "a", F.pmod(F.xxhash64("b"), F.col("groups")).alias("part"), F.col("b").alias("doc_id")
    )
    hubs = degree.select(
        "a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("part"),
        F.col("a").alias("doc_id"),
    )
    wanted = dealt.withColumn("hub", F.lit(1)).unionByName(hubs.withColumn("hub", F.lit(0)))
    smallest = docs.select("doc_id", "text")
    texts = wanted.join(smallest, "doc_id").repartition("a", "part")
    texts = texts.sortWithinPartitions("a", "part", "hub", F.length("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, own = None, np.zeros(0, np.uint64)
        for piece in text_slices(batches):
            hashes, edges = shingle_sets(piece.column("text"), words)
            found = []
            rows = zip(*[piece.column(c).to_pylist() for c in ("a", "part", "hub", "doc_id")],
                       strict=True)
            for k, (a, part, hub, doc) in enumerate(rows):
                here = hashes[edges[k] : edges[k + 1]]
                if hub == 0:
                    if (a, part) != group:
                        group, own = (a, part), here
                    continue
                both = len(np.intersect1d(own, here, assume_unique=True))
                either = len(own) + len(here) - both
                found.append((a, doc, either > 0 and 100 * both >= percent * either))
            columns = list(zip(*found, strict=True)) or [[], [], []]
            kinds = [pa.int64(), pa.int64(), pa.bool_()]
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                ["a", "b", "linked"],
            )

    return texts.mapInArrow(run, "a long, b long, linked boolean")


def near_components(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id of every row; ``docs`` is read several times.

    Rows without identifier take part by a number made from their text, above all
    identifiers; in the result they have none, and neither has a component made of them alone.
    """
    named = docs.select(F.coalesce("doc_id", _stand_in()).alias("doc_id"), "text")
    found = _components_of_named(named, words, percent)
    shown = [F.when(F.col(c) < NAMELESS, F.col(c)).alias(c) for c in ("doc_id", "component_id")]
    return found.select(shown[0], "n_shingles", shown[1])


def _stand_in() -> Column:
    bits = F.xxhash64(F.coalesce("text", F.lit(""))).bitwiseAND(NAMELESS - 1)
    return bits.bitwiseOR(F.lit(NAMELESS))


def _components_of_named(docs: DataFrame, words: int, percent: int) -> DataFrame:
    marked = durable(sketches(docs, words, percent))
    classes = marked.groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("rep"))
    members = durable(
        marked.select("doc_id", "n", "f1", "f2")
        .join(classes, ["n", "f1", "f2"])
        .select("doc_id", "n", F.when(F.col("n") > 0, F.col("rep")).otherwise(F.col("doc_id")).alias("rep"))
    )
    # Rows of one identifier belong together even where their sets differ.
    reps = members.filter("n > 0 and rep = doc_id").select("doc_id").distinct()
    known = durable(marked.filter("n > 0").drop("f1", "f2").join(reps, "doc_id"))
    emitted = known.select(F.col("doc_id").alias("c"), F.explode("keys").alias("key"))
    shared = durable(
        emitted.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high"))
        .filter("low != high").select("key")
    )
    blocks = durable(emitted.join(shared, "key"))
    sizes = known.select("doc_id", "n", *SKETCH_NAMES)
    links, labels = _linked(blocks, sizes, docs, words, percent)
    if links is None:
        return members.select(
            "doc_id", F.col("n").alias("n_shingles"), F.col("rep").alias("component_id")
        )
    joined = members.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    return joined.select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("label", "rep").alias("component_id")
    )


def _filtered(pairs: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    a, b = sizes.alias("a"), sizes.alias("b")
    return (
        pairs.alias("p")
        .join(a, F.col("p.a") == F.col("a.doc_id"))
        .join(b, F.col("p.b") == F.col("b.doc_id"))
        .filter(_possible(percent))
        .select(F.col("p.a").alias("a"), F.col("p.b").alias("b"))
    )


def _linked(blocks, sizes, docs, words, percent):
    """(verified links, component labels), or (None, None) without any candidate."""
    links = tried = labels = None
    open_blocks = blocks.select("key", "c", F.col("c").alias("comp"))
    for number in range(HUB_ROUNDS + 1):
        whole = False
        if number:
            if labels is not None:
                open_blocks = durable(_still_open(blocks, labels))
            whole = number == HUB_ROUNDS or _few_pairs(open_blocks)
        if whole:
            pairs = _between_components(open_blocks, sizes, percent)
        else:
            pairs = _with_hubs(open_blocks, number)
        pairs = pairs.distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        candidates = durable(pairs if whole else _filtered(pairs, sizes, percent))
        if candidates.isEmpty():
            if whole:
                break
            continue
        found = durable(verified(candidates, docs, words, percent))
        new = found.filter("linked").select("a", "b")
        links = new if links is None else links.unionByName(new)
        pairs = found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        pairs = pairs.unionByName(found.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
        tried = pairs if tried is None else tried.unionByName(pairs)
        labels = components(links)
        if whole:
            break
    return links, labels


def _with_hubs(open_blocks: DataFrame, number: int) -> DataFrame:
    """Every class of a block against one hub of another component, another each round."""
    order = F.xxhash64("c", F.lit(number)) if number else F.col("c")
    hubs = open_blocks.groupBy("key").agg(
        F.min(F.struct(order.alias("order"), "c", "comp")).alias("hub")
    )
    joined = open_blocks.join(hubs, "key")
    return joined.filter(F.col("comp") != F.col("hub.comp")).select(
        F.col("hub.c").alias("a"), F.col("c").alias("b")
    )


def _still_open(blocks: DataFrame, labels: DataFrame) -> DataFrame:
    """Classes with their components, in the blocks that hold more than one component."""
    labelled = blocks.join(labels.withColumnRenamed("node", "c"), "c", "left").select(
        "key", "c", F.coalesce("label", "c").alias("comp")
    )
    keys = labelled.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
    return labelled.join(keys.filter("low != high").select("key"), "key")


def _few_pairs(open_blocks: DataFrame) -> bool:
    """Whether comparing all pairs between components is in proportion to the rows."""
    per = open_blocks.groupBy("key", "comp").agg(F.count(F.lit(1)).cast("double").alias("n"))
    of_key = per.groupBy("key").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("squares")
    )
    row = of_key.agg(
        F.sum("n"), F.sum((F.col("n") * F.col("n") - F.col("squares")) / 2)
    ).first()
    return row[0] is None or row[1] <= FEW_PAIRS * row[0]


def _between_components(open_blocks: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    marked = durable(open_blocks.join(sizes.withColumnRenamed("doc_id", "c"), "c"))
    a, b = marked.alias("a"), marked.alias("b")
    both = (F.col("a.key") == F.col("b.key")) & (F.col("a.comp") < F.col("b.comp"))
    return a.join(b, both & _possible(percent)).select(
        F.col("a.c").alias("a"), F.col("b.c").alias("b")
    )
