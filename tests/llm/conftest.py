import os
import tempfile

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

SF = "/root/testdata/sf0.001"
LONG = "alpha beta gamma " * 4000
ODD = [
    (1, None, "en", "a", 0),
    (2, "", None, "a", 0),
    (3, " \t\n\x0b\r ", "en", None, 6),
    (4, "one", None, None, 3),
    (5, LONG, "en", "a", len(LONG)),
    (5, LONG, "en", "a", len(LONG)),
    (6, "é 漢字 😀\n\né 漢字 😀", "fr", "b", 12),
    (7, "one two three four five six seven eight nine", "en", "a", 10),
    (8, "one two three four five six seven eight nine", "en", "b", 10),
]
NAMES = ["doc_id", "text", "lang", "source", "n_chars"]


def write(folder, name, rows, names, kinds):
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
    arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
    pq.write_table(pa.table(arrays, names), os.path.join(folder, f"{name}.parquet"))


DOC_KINDS = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()]


@pytest.fixture(scope="session")
def odd_dir():
    """Documents with nulls, empty and long texts, ties, repeated rows and clashing names."""
    folder = tempfile.mkdtemp(prefix="barloom-odd-")
    clash = ["score", "digest", "n_words", "file", "row", "piece", "hash"]
    rows = [(*r, *["x"] * len(clash)) for r in ODD]
    write(folder, "documents", rows, NAMES + clash, DOC_KINDS + [pa.string()] * len(clash))
    return _others(folder)


@pytest.fixture(scope="session")
def empty_dir():
    folder = tempfile.mkdtemp(prefix="barloom-empty-")
    write(folder, "documents", [], NAMES, DOC_KINDS)
    return _others(folder, empty=True)


def _others(folder, empty=False):
    ints, text = pa.int64(), pa.string()
    labels = [] if empty else [(4, 1, 0), (5, 0, None), (None, 1, 0), (7, None, 0)]
    write(folder, "labels", labels, ["doc_id", "quality", "toxic"], [ints] * 3)
    turns = [] if empty else [
        (1, 0, "user", None), (1, 1, "assistant", "### x </turn> \\0 \\"), (2, 0, None, ""),
        (3, 1, "assistant", "b"), (3, 0, "system", "s"), (3, 0, "user", "a\nb"),
        (4, 5, "tool\nname", "t"), (4, 5, "tool\nname", "t"), (None, None, "user", "z"),
    ]
    write(folder, "conversations", turns, ["conv_id", "turn", "role", "text"], [ints, ints, text, text])
    pages = [] if empty else [
        (1, None, "h"), (2, "not a url", None), (3, "http://www.A.example.com:80/x/y/z?q#f", "h"),
        (3, "http://www.A.example.com:80/x/y/z?q#f", "h"), (4, "https://b.example.org", "h"),
        (5, "http://u@a.example.com/x", ""),
    ]
    write(folder, "pages", pages, ["page_id", "url", "html"], [ints, text, text])
    nan, inf = float("nan"), float("inf")
    flat = [0.25 * k for k in range(64)]
    vectors = [] if empty else [
        (1, None), (2, []), (3, flat[:63]), (4, [None, *flat[1:]]), (5, [nan, *flat[1:]]),
        (6, [-inf, *flat[1:]]), (7, flat), (7, flat), (None, flat), (8, [-0.0] * 64),
        (9, [0.0] * 64), (10, [-0.001] * 64), (11, flat[::-1]), (12, [*flat[:60], 3, 4, 5, 6]),
        (13, [-x for x in flat]), (None, [1.5] * 64), (14, [1.5] * 64), (15, [9.0] * 64),
        (16, [7.25] * 63 + [-3]),
    ]
    clash = ["x", "cluster", "n", "component", "entries"]
    rows = [(*r, *["y"] * len(clash)) for r in vectors]
    kinds = [ints, pa.list_(pa.float32()), *[text] * len(clash)]
    write(folder, "embeddings", rows, ["vec_id", "embedding", *clash], kinds)
    return folder


@pytest.fixture(scope="session")
def sf_dir():
    return SF
