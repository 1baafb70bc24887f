"""Near-duplicate components on families of texts around the threshold."""

import random
from collections import Counter

import brute
from conftest import DOC_KINDS, NAMES, write

from barloom.llm.common import documents
from barloom.llm.near_join import Bands, near_components


def families(seed, count, size, words):
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(30)]
    texts = []
    for f in range(count):
        base = [f"w{rng.randrange(400)}" for _ in range(words)]
        for _ in range(size):
            own = list(base)
            for _ in range(rng.randrange(0, 4)):
                own[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
            if rng.random() < 0.3:
                own = own + passage
            texts.append(" ".join(own))
    rng.shuffle(texts)
    return [(i, t, "en", "a", len(t)) for i, t in enumerate(texts)]


def test_no_link_is_lost(spark, tmp_path):
    rows = families(1, 12, 14, 70) + [
        (1000 + i, t, n, s, c) for i, t, n, s, c in families(2, 10, 6, 24)
    ]
    write(str(tmp_path), "documents", rows, NAMES, DOC_KINDS)
    docs = documents(spark, str(tmp_path))
    for words, percent in ((4, 85), (5, 80)):
        got = near_components(docs, words, percent).collect()
        want = wanted(str(tmp_path), words, percent)
        assert Counter(map(tuple, got)) == Counter(want)


def wanted(folder, words, percent):
    plain = brute.shingles
    brute.shingles = lambda text: plain(text, words)
    try:
        return brute.near_components(folder, percent)
    finally:
        brute.shingles = plain


def test_blocks_suffice_for_every_pair_of_sizes():
    bands = Bands(85)
    for a in range(1, 400):
        for b in range(a, 100 * a // 85 + 1):
            band = bands.of(a)[0]
            differ = (a + b) * 15 // 185
            assert band in bands.of(b)
            if differ and (a != b or differ > 1):
                assert bands.blocks(band)[0] > differ


def test_rows_without_identifier(spark, tmp_path):
    base = [f"w{i}" for i in range(60)]
    near = [" ".join([*base[:59], f"x{i}"]) for i in range(3)]
    other = [" ".join(f"{a}{i}" for i in range(60)) for a in "uv"]
    other.append(" ".join([*other[1].split()[:59], "y"]))
    rows = [(None, near[0]), (5, near[1]), (None, near[2]), (4, near[0]), (None, other[0]),
            (None, other[1]), (None, other[2]), (None, other[2]), (None, None), (None, ""), (8, "")]
    docs = [(i, t, "en", "a", 0) for i, t in rows]
    write(str(tmp_path), "documents", docs, NAMES, DOC_KINDS)
    got = near_components(documents(spark, str(tmp_path)), 4, 85).collect()
    want = [(5, 57, 4), (4, 57, 4), (None, 57, 4), (None, 57, 4), (8, 0, 8)]
    want += [(None, 57, None)] * 4 + [(None, 0, None)] * 2
    assert Counter(map(tuple, got)) == Counter(want)
