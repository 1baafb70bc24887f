"""Shortest-pack-first packing: ids against the library, places against the definition."""

import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from barloom.llm import queries as q
from barloom.llm.histogram_packing import (
    WordIds,
    close_gaps,
    pack,
    places,
    shortest_pack_first,
    tokens,
)

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def padding(loads, capacity=2048):
    return sum(capacity - n for n in loads if n & (n - 1))


def check(rows, want, capacity=2048):
    """Rows (doc, start, length, crc, doc_tokens, sequence, offset) cover the ids of ``want``,
    a list of (doc, ids); the loads of the sequences."""
    covered, places_ = defaultdict(list), defaultdict(list)
    for doc, start, length, crc, total, sequence, offset in rows:
        covered[doc, total].append((start, length, crc))
        places_[sequence].append((offset, length))
    expected = defaultdict(list)
    for doc, ids in want:
        expected[doc, len(ids)].append(ids)
    assert covered.keys() == expected.keys()
    for key, pieces in covered.items():
        ids, copies = expected[key][0], len(expected[key])
        assert all(np.array_equal(ids, x) for x in expected[key])
        times = np.zeros(len(ids), int)
        for start, length, crc in pieces:
            assert length > 0 and zlib.crc32(ids[start : start + length].tobytes()) == crc
            times[start : start + length] += 1
        assert (times == copies).all()
    for own in places_.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return [sum(n for _, n in own) for own in places_.values()]


@pytest.mark.parametrize("kind", ["sf", "odd", "empty"])
def test_op13(spark, kind, sf_dir, odd_dir, empty_dir):
    folder = {"sf": sf_dir, "odd": odd_dir, "empty": empty_dir}[kind]
    tokenizer = Tokenizer.from_file(VOCABULARY)
    want = [
        (i, np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], "<u4"))
        for i, t in brute.docs(folder)
    ]
    rows = [tuple(r)[:7] for r in q.op13(spark, folder).collect()]
    assert padding(check(rows, want)) == 0


def test_ids_of_odd_texts():
    texts = [
        None, "", "  ", "áb ́c d e\u0085f", "It's  I'LL\tdon't\x0b\x0cx",
        "<|endoftext|> a<|startoftext|>b <|end of|>", "ΑΣ ΣΑΣ İstanbul ǅ ﬁ", "1234 5.6e7 #$% ½²",
        "漢字かな 한국어 각 \U0001f600\U0001f468‍\U0001f469", "word " * 3000, "x" * 5000,
        "Ünïcödé,ÀB×C÷D İx ŁÓDŹ's ÿ1é2 Ǆ¼ áb ñ̃ \x00\x1f\x7f  é f g",
        "a,b.c;d'e<f>g 12ab34 ''' <<<|>>> ..'s ..s İı ẞ ﻿​퟿",
        "".join(chr(c) for c in range(1, 0x600)), " ".join(chr(c) for c in range(1, 0x600)),
        " ".join("x" + chr(c) + "'y" + chr(c) for c in range(1, 0x600)),
        " ".join("X" + chr(c) + "y" + chr(c) + chr(c) for c in range(1, 0x3000)),
    ]
    tokenizer = Tokenizer.from_file(VOCABULARY)
    encoder = WordIds(VOCABULARY)
    for own in (texts, texts[::-1]):
        ids, offsets = encoder.encode(pa.array(own, pa.string()))
        for k, text in enumerate(own):
            want = tokenizer.encode(text or "", add_special_tokens=False).ids
            assert ids[offsets[k] : offsets[k + 1]].tolist() == want


@pytest.mark.parametrize("seed", range(60))
def test_every_rest_has_its_places(seed):
    rng = np.random.default_rng(seed)
    capacity = int(2 ** rng.integers(2, 7))
    lengths = rng.integers(1, capacity, rng.integers(0, 12))
    histogram = {int(n): int(rng.integers(1, 15)) for n in lengths}
    packed = shortest_pack_first(histogram, capacity)
    assert all(p.total <= capacity for p in packed)
    found = places(close_gaps(packed, capacity))
    loads = defaultdict(list)
    for length, count in histogram.items():
        row, pieces = found.find(np.full(count, length), np.arange(count))
        for d in range(count):
            at = 0
            for start, take, sequence, offset in sorted(pieces[row == d].tolist()):
                assert start == at and take > 0
                at += take
                loads[sequence].append((offset, take))
            assert at == length
    totals = []
    for own in loads.values():
        at = 0
        for offset, take in sorted(own):
            assert offset == at
            at += take
        totals.append(at)
    assert max(totals, default=0) <= capacity and padding(totals, capacity) == 0


def test_longest_first_into_the_shortest_pack():
    packed = shortest_pack_first({6: 2, 4: 1, 3: 3, 1: 1}, 10)
    found = Counter(tuple(s[0] for s in p.slots) for p in packed for _ in range(p.count))
    assert found == Counter({(6, 4): 1, (6, 3): 1, (3, 3, 1): 1})


@pytest.mark.parametrize("scale", [10**3, 10**6, 10**11])
def test_work_does_not_grow_with_counts(scale):
    rng = np.random.default_rng(2)
    histogram = {n: int(scale * rng.random()) + 1 for n in range(1, 2048)}
    closed = close_gaps(shortest_pack_first(histogram, 2048), 2048)
    total = sum(n * c for n, c in histogram.items())
    assert sum(p.count * p.total for p in closed) == total
    lost = sum(p.count * (2048 - p.total) for p in closed if p.total & (p.total - 1))
    assert len(closed) < 40_000 and lost <= total * 1e-6


def test_many_equal_and_long_documents(spark):
    rows = [(n, "word " * 9) for n in range(500)] + [(n, "w " * 5000) for n in range(500, 520)]
    rows += [(None, None)] * 40 + [(600, "w " * 2047)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    tokenizer = Tokenizer.from_file(VOCABULARY)
    want = [
        (i, np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4"))
        for i, t in rows
    ]
    from barloom.llm.common import durable

    got = [tuple(r)[:7] for r in pack(durable(tokens(docs, VOCABULARY))).collect()]
    assert padding(check(got, want)) == 0
    assert len({r[5] for r in got}) <= -(-sum(len(i) for _, i in want) // 2048) + 11
