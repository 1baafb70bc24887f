"""Exact dedup: further files into one state, nothing new, and digests that collide."""

from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from barloom.llm import exact_dedup as op

NAMES = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def put(folder, name, rows):
    ids, texts = zip(*rows, strict=True)
    pq.write_table(
        pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string())}),
        folder / f"{name}.parquet",
    )


def rows_of(df):
    return Counter(map(tuple, df.select(*NAMES).collect()))


FIRST = [(7, "a  b"), (9, "a b"), (4, None), (5, ""), (11, "only"), (12, "c\td")]
SECOND = [(2, "a\nb"), (9, "a b"), (30, "new"), (31, " "), (1, "c d"), (3, None)]


def test_state_goes_on_with_new_files(spark, tmp_path):
    data, state = tmp_path / "docs", str(tmp_path / "state")
    data.mkdir()
    put(data, "one", FIRST)
    first = rows_of(op.exact_dedup(spark, str(data), state))
    assert first == rows_of(op.exact_dedup(spark, str(data)))
    put(data, "two", SECOND)
    both = rows_of(op.exact_dedup(spark, str(data), state))
    assert both == rows_of(op.exact_dedup(spark, str(data)))
    assert {(i, k, n) for i, k, n, _, _ in both if i in (7, 2)} == {(7, 2, 4), (2, 2, 4)}
    assert both == rows_of(op.exact_dedup(spark, str(data), state))


def test_colliding_digests_are_told_apart(spark, tmp_path, monkeypatch):
    data = tmp_path / "docs"
    data.mkdir()
    put(data, "one", FIRST)
    put(data, "two", SECOND)
    want = Counter(r[:4] for r in rows_of(op.exact_dedup(spark, str(data))).elements())
    monkeypatch.setattr(op, "_digest", lambda: F.unhex(F.substring(F.sha2(F.lit("x"), 256), 1, 64)))
    got = rows_of(op.exact_dedup(spark, str(data)))
    assert Counter(r[:4] for r in got.elements()) == want
