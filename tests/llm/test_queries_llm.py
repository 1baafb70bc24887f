"""Corpus queries against brute force, on the smallest tables and on odd rows."""

import zlib
from collections import Counter

import brute
import public_tokenizers
import pytest

from barloom.llm import queries as q

ALL = sorted(q.llm_queries())


def got(spark, name, sf_dir, columns):
    query = next(f for k, f in q.llm_queries().items() if k.startswith(f"{name}_"))
    return Counter(map(tuple, query(spark, sf_dir).select(*columns).collect()))


@pytest.fixture(params=["sf", "odd", "empty"])
def any_dir(request, sf_dir, odd_dir, empty_dir):
    return {"sf": sf_dir, "odd": odd_dir, "empty": empty_dir}[request.param]


def test_rules(spark, any_dir):
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    want = Counter((i, *brute.measures(t)) for i, t in brute.docs(any_dir))
    assert got(spark, "op1", any_dir, names) == want
    for row in got(spark, "op1", any_dir, ["n_words", "n_repeat_words", "base_failed", "kept"]):
        assert row[2] == (row[0] < 20 or 100 * row[1] > 30 * row[0])
        assert not (row[2] and row[3])


def test_exact_dedup(spark, any_dir):
    names = ["doc_id", "keep_id", "group_size", "text_sha256"]
    assert got(spark, "op10", any_dir, names) == Counter(brute.exact_groups(any_dir))
    kept = got(spark, "op10", any_dir, ["text_sha256", "kept"])
    assert all(n == 1 for (_, k), n in kept.items() if k)


def test_chat(spark, any_dir):
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256"]
    assert got(spark, "op9", any_dir, names) == Counter(brute.chats(any_dir, q.TRICKY))


def test_sentencepiece(spark, any_dir):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model")
    )
    want = Counter()
    for i, t in brute.docs(any_dir):
        ids = model.encode(t)
        size = len(t.encode())
        text = model.decode(ids) if ids else ""
        want[i, len(ids), brute.sha(",".join(map(str, ids))), brute.sha(text), size, size] += 1
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes", "span_bytes"]
    assert got(spark, "op6", any_dir, names) == want


def test_packing(spark, any_dir):
    import numpy as np
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for i, t in brute.docs(any_dir):
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 2], "<u4")
        head = (len(ids) - 1) % 1024 + 1
        for k, a in enumerate([0, *range(head, len(ids), 1024)]):
            piece = ids[a : head + 1024 * k]
            want[i, k, a, len(piece), zlib.crc32(piece.tobytes())] += 1
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    rows = got(spark, "op3", any_dir, names)
    assert Counter(r[:5] for r in rows.elements()) == want
    ends = Counter()
    for r in sorted(rows, key=lambda r: r[5:]):
        assert ends[r[5]] == r[6]
        ends[r[5]] += r[3]
    assert all(n <= 1024 for n in ends.values())
    if ends:
        assert len(ends) <= -(-sum(ends.values()) // 1024) + 2


def test_line_dedup(spark, any_dir):
    texts = brute.docs(any_dir)
    left = brute.deduplicated_lines(texts)
    names = ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
    want = Counter(
        (i, t.count("\n") + 1, lost(t, left[i]), brute.sha(left[i])) for i, t in texts
    )
    assert got(spark, "op4", any_dir, names) == want


def lost(before, after):
    return before.count("\n") - after.count("\n")


def test_suffix_dedup(spark, any_dir):
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert got(spark, "op5", any_dir, names) == Counter(brute.long_repeats(any_dir))


def test_near_join(spark, any_dir):
    names = ["doc_id", "n_shingles", "component_id"]
    assert got(spark, "op7", any_dir, names) == Counter(brute.near_components(any_dir))


def test_classifier(spark, any_dir):
    rows = got(spark, "op8", any_dir, ["doc_id", "held_out", "score", "predicted"])
    assert Counter(r[0] for r in rows.elements()) == Counter(i for i, _ in brute.docs(any_dir))
    for doc, held, score, predicted in rows:
        assert held == (zlib.crc32(str(doc).encode()) % 5 == 0)
        assert 0 <= score <= 1 and predicted == (score >= 0.3)


def test_classifier_learns(spark):
    sf = "/root/testdata/sf0.01"
    quality = dict(brute.rows(sf, "labels", "doc_id, quality"))
    rows = got(spark, "op8", sf, ["doc_id", "held_out", "predicted"])
    held = [(p, quality[d]) for d, h, p in rows if h and d in quality]
    assert len(held) > 50
    assert sum(p == y for p, y in held) / len(held) >= 0.97


def test_url_filters_rows(spark, any_dir):
    rows = got(spark, "op2", any_dir, ["page_id", "blocked"])
    pages = Counter(i for i, in brute.rows(any_dir, "pages", "page_id"))
    assert Counter(r[0] for r in rows.elements()) == pages
