"""Encoders stay in the worker between tasks and keep giving the same ids."""

import public_tokenizers
import pyarrow as pa

from barloom.llm import histogram_packing, pieces

TEXTS = ["Some words, some more words 12.5", "", "żółć <|x|> don't", "some words"]


def test_words_are_known_to_the_next_task_and_ids_stay(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    kept = histogram_packing.word_ids(path)
    assert histogram_packing.word_ids(path) is kept
    fresh = histogram_packing.WordIds(path)
    for texts in (TEXTS, TEXTS[::-1]):
        want, got = (x.encode(pa.array(texts)) for x in (fresh, kept))
        assert [list(a) for a in want] == [list(a) for a in got]
    # What is remembered is bounded over all tasks of a worker.
    monkeypatch.setattr(histogram_packing, "REMEMBERED", 1)
    kept.encode(pa.array(["entirely different"]))
    assert len(kept.known) <= 2


def test_parts_are_known_to_the_next_task_and_ids_stay():
    path = public_tokenizers.path("piece_bpe_32k.model")
    kept = pieces.encoder_of(path)
    assert pieces.encoder_of(path) is kept
    for text in TEXTS + TEXTS[::-1]:
        want, got = pieces.Encoder(path).encode(text), kept.encode(text)
        assert [list(a) for a in want] == [list(a) for a in got]
        assert list(got[0]) == kept.processor.encode(text)
