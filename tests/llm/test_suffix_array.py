"""Two-stage suffix sorting against plain sorting."""

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from barloom.llm.suffix_dedup import merged, same_windows, sliding_minimum, suffix_array


@given(st.binary(max_size=60) | st.text("ab", max_size=80).map(str.encode))
def test_order(data):
    ranks = suffix_array(data, 100).tolist()
    assert ranks == sorted(range(len(data)), key=lambda i: data[i:])


@given(st.text("ab", min_size=4, max_size=60).map(str.encode))
def test_truncated_order_keeps_equal_windows_together(data):
    starts = np.arange(len(data) - 3)
    classes = same_windows(data, starts, 4)
    seen = {}
    for i, c in enumerate(classes.tolist()):
        assert seen.setdefault(c, data[i : i + 4]) == data[i : i + 4]
    assert len(seen) == len({data[i : i + 4] for i in starts})


@given(st.lists(st.integers(0, 2**64 - 1), max_size=40), st.integers(1, 9))
def test_sliding_minimum(values, width):
    got = sliding_minimum(np.array(values, np.uint64), width).tolist()
    assert got == [min(values[i : i + width]) for i in range(len(values) - width + 1)]


@given(st.lists(st.tuples(st.integers(0, 40), st.integers(1, 9)), max_size=8))
def test_merged(pairs):
    a = np.array([p for p, _ in pairs], np.int64)
    covered = {k for p, n in pairs for k in range(p, p + n)}
    starts, stops = merged(a, a + np.array([n for _, n in pairs], np.int64), 60)
    got = [k for p, q in zip(starts.tolist(), stops.tolist(), strict=True) for k in range(p, q)]
    assert sorted(covered) == got
    assert all(q < p for q, p in zip(stops.tolist(), starts[1:].tolist(), strict=False))
