"""The longest-prefix character map on a hand-made double-array trie."""

import struct

import public_tokenizers

from barloom.llm.pieces import CharacterMap, Encoder

LEAF = 0x80000000


def character_map(rules):
    """Blob of a Darts trie over the rules, each node with a block of 256 units of its own."""
    pool, at = b"", {}
    for key, value in rules.items():
        at[key.encode()] = len(pool)
        pool += value.encode() + b"\0"
    prefixes = sorted({k[:n] for k in at for n in range(len(k) + 1)}, key=lambda p: (len(p), p))
    base = {p: 256 * (n + 1) for n, p in enumerate(prefixes)}
    units = [0xFF] * (256 * (len(prefixes) + 1))
    place = {b"": 0}
    for p in prefixes:
        if p:
            place[p] = base[p[:-1]] ^ p[-1]
        # offset shifted by eight, which the bit 9 says; bit 8: a value hangs on the node
        relative = place[p] ^ base[p]
        while relative & 255:
            base[p] ^= relative & 255
            relative = place[p] ^ base[p]
        label = p[-1] if p else 0
        units[place[p]] = (relative >> 8) << 10 | 1 << 9 | (p in at) << 8 | label
        if p in at:
            units[base[p]] = LEAF | at[p]
    return struct.pack(f"<I{len(units)}I", 4 * len(units), *units) + pool


RULES = {"ﬁ": "fi", "①": "1", "e\u0301": "é", "e": "E", "㍿": "株式会社", "\u200b": ""}


def plain(text):
    out, source, at = b"", [], 0
    while text:
        key = max((k for k in RULES if text.startswith(k)), key=len, default=text[0])
        value = RULES.get(key, key).encode()
        out, source = out + value, source + [at] * len(value)
        at, text = at + len(key.encode()), text[len(key) :]
    return out, [*source, at]


def test_longest_prefix_and_alignment():
    found = CharacterMap(character_map(RULES))
    for text in ["ﬁn①", "cafe\u0301 e", "㍿x\u200b", "😀ﬁ漢é", "e", "\u200b", "", "e\u0302", "plain"]:
        out, source = found.normalise(text)
        assert (out, source.tolist()) == plain(text)
    assert found.longest("e\u0301x".encode(), 0) == (3, "é".encode())
    assert found.longest(b"x", 0) == (0, None)


def test_spans_through_the_map():
    encoder = Encoder(public_tokenizers.path("piece_bpe_32k.model"))
    plainly = Encoder(public_tokenizers.path("piece_bpe_32k.model"))
    assert not encoder.map.units
    encoder.map = CharacterMap(character_map(RULES))
    text = "ﬁx cafe\u0301 ①㍿ e"
    normal, source = encoder.map.normalise(text)
    ids, starts, ends = encoder.encode(text)
    same, _, places = plainly.encode(normal.decode())
    assert ids == same
    assert starts[0] == 0 and ends[-1] == len(text.encode())
    assert (starts[1:] == ends[:-1]).all()
    assert ends.tolist() == source[places].tolist()
