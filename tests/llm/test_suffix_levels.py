"""Repeated passages where one name has many unlike stretches, and rows without identifier."""

import random
from collections import Counter

import brute
import pyarrow as pa
import pytest
from conftest import write

from barloom.llm import queries as q
from barloom.llm import suffix_dedup

NAMES = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def near_copies(n, words=120, seed=1):
    rng = random.Random(seed)
    text = ["".join(rng.choices("abcdefghij", k=rng.randint(3, 9))) for _ in range(words)]
    out = []
    for i in range(n):
        own = list(text)
        own[rng.randrange(words)] = "".join(rng.choices("klmnopqrst", k=8))
        out.append((i, " ".join(own)))
    return out


def folder_of(path, rows):
    write(str(path), "documents", rows, ["doc_id", "text"], [pa.int64(), pa.string()])
    return str(path)


def removed(spark, folder):
    return Counter(map(tuple, q.op5(spark, folder).select(*NAMES).collect()))


@pytest.mark.parametrize("least", [1, 3])
def test_names_are_split_exactly(spark, tmp_path, monkeypatch, least):
    monkeypatch.setattr(suffix_dedup, "BLOCK_STRETCHES", least)
    rows = near_copies(60) + [(100 + i, t[40:400]) for i, t in near_copies(9, seed=2)]
    rows += [(200, rows[3][1] + " " + rows[3][1]), (201, "ab" * 700), (202, "é" * 150)]
    folder = folder_of(tmp_path, rows)
    assert removed(spark, folder) == Counter(brute.long_repeats(folder))


def test_split_names_on_the_tables(spark, sf_dir, odd_dir, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK_STRETCHES", 1)
    for folder in (sf_dir, odd_dir):
        assert removed(spark, folder) == Counter(brute.long_repeats(folder))


def test_rows_stay_near_the_stretches(spark, monkeypatch):
    counts = []
    plain = suffix_dedup.durable

    def counted(df):
        stored = plain(df)
        counts.append(stored.count())
        return stored

    monkeypatch.setattr(suffix_dedup, "durable", counted)
    docs = spark.createDataFrame(near_copies(6000), "doc_id long, text string")
    spans = suffix_dedup.repeated_spans(docs)
    first = counts[0]
    assert max(counts) <= 2 * first and sum(counts[1:]) <= 10 * first
    assert spans.count() <= 5 * first


def test_rows_without_identifier(spark, tmp_path):
    text = near_copies(2)
    rows = [(None, text[0][1]), (None, "x " + text[1][1]), (None, None), (7, text[0][1] + " end")]
    rows += [(None, "alone " * 3)]
    folder = folder_of(tmp_path, rows)
    assert removed(spark, folder) == Counter(brute.long_repeats(folder))
    kept = suffix_dedup.without_repeats(spark.read.parquet(f"{folder}/documents.parquet"))
    assert kept.columns == ["doc_id", "text"] and kept.count() == 5
    assert sorted(r[0] or -1 for r in kept.collect()) == [-1, -1, -1, -1, 7]
