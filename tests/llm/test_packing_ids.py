"""Token ids of op3 against the unmodified tokenizers library."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from barloom.llm import packing


def pieces(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = packing.token_pieces(
        docs,
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        public_tokenizers.path("byte_bpe_50k.json"),
    )
    return Counter(map(tuple, found.collect()))


def wanted(texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for i, t in enumerate(texts):
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 2], "<u4")
        head = (len(ids) - 1) % 1024 + 1
        for k, a in enumerate([0, *range(head, len(ids), 1024)]):
            piece = ids[a : head + 1024 * k]
            want[i, k, a, len(piece), zlib.crc32(piece.tobytes())] += 1
    return want


def test_strings_of_added_tokens(spark):
    end = "<|endoftext|>"
    texts = [
        f"foo {end} bar", end, f"{end}{end}x  {end}", f"  {end}  a\n\n{end}\nb", end[:-1],
        f"<|{end}|>", ("alpha beta " * 300 + end) * 3,
    ]
    assert pieces(spark, texts) == wanted(texts)


def test_million_blanks(spark):
    n = 1_000_000
    texts = [" " * n, "a" + " " * n + "b", "\n" * n, "x\n" + " \n\t" * n + "<|endoftext|>\u3000", "ok"]
    assert pieces(spark, texts) == wanted(texts)
