"""Own merging of pieces against the sentencepiece library, on several kinds of models."""

import random

import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as proto

from barloom.llm import pieces
from barloom.llm.common import documents
from barloom.llm.pieces import SPACE, Encoder, encode_documents

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def model(change=""):
    found = proto.ModelProto()
    with open(MODEL, "rb") as file:
        found.ParseFromString(file.read())
    if change == "no bytes":
        found.trainer_spec.byte_fallback = False
        kept = [p for p in found.pieces if p.type != proto.ModelProto.SentencePiece.BYTE]
        del found.pieces[:]
        found.pieces.extend(kept)
    found.normalizer_spec.remove_extra_whitespaces = change == "trimmed"
    found.normalizer_spec.add_dummy_prefix = change != "no prefix"
    if change == "crossing":
        found.pieces.add(piece=f"e{SPACE}t", score=-1.5)
    return found


def texts():
    rng = random.Random(3)
    letters = list(" ▁  \t\nabcdefthe漢字日本語é😀\x00\u200bﬁ①ß")
    made = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(1500)]
    runs = [" " * n for n in range(40)] + ["漢字" * 3000, "a" * 5000, " " * 20000, "ab" * 16 + "c"]
    return made + runs + ["<s> </s> <unk> <0x0A>", "the the theme", f"{SPACE}the{SPACE}"]


@pytest.mark.parametrize("change", ["", "no bytes", "trimmed", "no prefix", "crossing"])
def test_ids_equal_the_library(change):
    blob = model(change).SerializeToString()
    own, library = Encoder(blob), sentencepiece.SentencePieceProcessor(model_proto=blob)
    for text in texts():
        ids, starts, ends = own.encode(text)
        assert ids == library.encode(text), text
        if ids and change != "trimmed":
            assert starts[0] == 0 and ends[-1] == len(text.encode())
            assert (starts[1:] == ends[:-1]).all()


def test_spans_are_the_bytes_of_the_pieces():
    own = Encoder(MODEL)
    for text in ["Hello  wörld\n漢字 😀", "the quick", f"a{SPACE}b c"]:
        ids, starts, ends = own.encode(text)
        data = text.encode()
        for i, a, b in zip(ids, starts, ends, strict=True):
            piece = own.processor.id_to_piece(i)
            if not own.processor.is_byte(i):
                want = data[a:b].decode().replace(" ", SPACE)
                assert piece == want or (a == 0 and piece == SPACE + want)


def test_short_and_long_parts_agree():
    own = Encoder(MODEL)
    for text in texts():
        if 1 < len(text) <= pieces.SHORT:
            assert own._merged(text) == own._merged_long(text)


def test_memory_of_parts_is_bounded(monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 10)
    own, other = Encoder(MODEL), Encoder(MODEL)
    words = " ".join(f"w{n % 37}" for n in range(500))
    assert own.encode(words)[0] == other.processor.encode(words)
    assert len(own._known) <= 10


def test_refused_models():
    found = model()
    found.pieces[300].type = proto.ModelProto.SentencePiece.USER_DEFINED
    with pytest.raises(ValueError, match="user-defined"):
        Encoder(found.SerializeToString())


def test_documents_with_spans(spark, odd_dir):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for row in encode_documents(documents(spark, odd_dir), MODEL).collect():
        data = next(
            (r.text or "").encode()
            for r in documents(spark, odd_dir).filter(f"doc_id = {row.doc_id}").collect()
        )
        assert row.ids == (library.encode(data.decode()) if data else [])
        assert b"".join(data[a:b] for a, b in zip(row.starts, row.ends, strict=True)) == data
        assert row.decoded == data.decode()


def test_new_parts_of_many_texts_are_merged_together(monkeypatch):
    own = Encoder(MODEL)
    many = [*texts(), *[f"of\nUnseen{n} wordings.\nEnding{n}x" for n in range(300)], "", " ", "\n"]
    alone, plain = [], Encoder._pieces
    monkeypatch.setattr(Encoder, "_pieces", lambda self, p: alone.append(p) or plain(self, p))
    got = [list(ids) for ids, _, _ in own.encode_all(many)]
    assert got == [list(own.processor.encode(text)) for text in many]
    # What is made of pieces only is never merged by itself, whatever line it ends.
    assert not any("Unseen" in part or "Ending" in part for part in alone)
