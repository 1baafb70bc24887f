"""Lower bounds against exhaustive packing, and the exchange of bins to its end."""

import numpy as np
import public_tokenizers
import pytest

from barloom.llm import packing
from barloom.llm.common import documents, durable


def fewest(lengths, capacity):
    """Bins of the best packing, by trying everything."""
    best = len(lengths)

    def place(left, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if not left:
            best = len(bins)
            return
        head, *rest = left
        for k in range(len(bins)):
            if bins[k] + head <= capacity and bins[k] not in bins[:k]:
                place(rest, [*bins[:k], bins[k] + head, *bins[k + 1 :]])
        place(rest, [*bins, head])

    place(sorted(lengths, reverse=True), [])
    return best


@pytest.mark.parametrize("seed", range(40))
def test_no_packing_gets_below_the_bound(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.integers(5, 30))
    lengths = rng.integers(1, capacity + 1, rng.integers(1, 10))
    bound = packing.lower_bound(lengths, capacity)
    assert -(-int(lengths.sum()) // capacity) <= bound <= fewest(lengths.tolist(), capacity)


def test_bounds_known_by_hand():
    assert packing.lower_bound(np.array([6, 6, 6]), 10) == 3
    assert packing.lower_bound(np.array([5, 5, 5]), 10) == 2
    assert packing.lower_bound(np.array([4, 4, 4, 4]), 10) == 2
    assert packing.lower_bound(np.zeros(0, int), 10) == 0


def test_exchange_closes_the_gaps_of_small_partitions(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    pieces = durable(packing.token_pieces(docs, ranks, public_tokenizers.PATTERN, vocabulary))
    packed = durable(packing.pack(pieces, partition_pieces=64))
    assert packed.count() == pieces.count()
    bound = packed.first()["bound"]
    loads = packed.groupBy("sequence_id").sum("length").collect()
    assert max(r[1] for r in loads) <= 1024
    assert bound <= len(loads) <= bound + 3
