"""Every stage of the pipeline against brute force on what its predecessor kept."""

from collections import Counter

import brute
import corpus_pipeline as cp
import pyarrow.parquet as pq
from conftest import DOC_KINDS, NAMES, write

from barloom.llm.common import documents, durable
from barloom.llm.quality_model import THRESHOLD, fit, score


def stored(folder, name, df):
    path = folder / name
    path.mkdir()
    rows = [tuple(r[c] for c in NAMES) for r in df.collect()]
    write(str(path), "documents", rows, NAMES, DOC_KINDS)
    return str(path)


def texts(path):
    return dict(brute.docs(path))


def test_stages(spark, sf_dir, tmp_path):
    stages = dict(cp.STAGES)
    assert [n for n, _ in cp.STAGES] == [
        "quality_classifier", "line_dedup", "ngram_jaccard_join", "suffix_array_dedup",
        "best_fit_packing",
    ]
    docs = documents(spark, sf_dir)
    first = durable(stages["quality_classifier"](spark, docs, sf_dir))
    assert first.columns == docs.columns
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    good = {r[0] for r in score(docs, model, ["doc_id"]).filter(f"score >= {THRESHOLD}").collect()}
    a = stored(tmp_path, "a", first)
    assert set(texts(a)) == good

    second = durable(stages["line_dedup"](spark, first, sf_dir))
    b = stored(tmp_path, "b", second)
    assert texts(b) == brute.deduplicated_lines(brute.docs(a))
    sizes = pq.read_table(f"{b}/documents.parquet").to_pylist()
    assert all(r["n_chars"] == len(r["text"]) for r in sizes)

    third = durable(stages["ngram_jaccard_join"](spark, second, sf_dir))
    plain = brute.shingles
    brute.shingles = lambda text: plain(text, 5)
    try:
        left = {i for i, _, c in brute.near_components(b, 80) if i == c}
    finally:
        brute.shingles = plain
    c = stored(tmp_path, "c", third)
    assert set(texts(c)) == left

    fourth = durable(stages["suffix_array_dedup"](spark, third, sf_dir))
    d = stored(tmp_path, "d", fourth)
    removed = {r[0]: r for r in brute.long_repeats(c)}
    for doc, text in texts(d).items():
        size = len(texts(c)[doc].encode())
        assert 0 <= len(text.encode()) - (size - removed[doc][2]) <= 6 * removed[doc][3]

    last = stages["best_fit_packing"](spark, fourth, sf_dir).collect()
    assert {r["doc_id"] for r in last} == set(texts(d))
    loads = Counter()
    for r in last:
        loads[r["sequence_id"]] += r["length"]
    assert max(loads.values()) <= 1024


def test_pipeline_on_odd_and_empty_tables(spark, odd_dir, empty_dir):
    assert cp.run(spark, empty_dir).count() == 0
    assert cp.run(spark, odd_dir).columns[0] == "doc_id"
