"""SentencePiece encoding and decoding with spans of the original bytes.

Normalisation follows the compiled character map of the model: at each position the
longest key of its trie that is a prefix of the rest is replaced by the value stored for
it, otherwise one character is copied. For every normalised byte the position of its
source is recorded, which projects each piece to the bytes it came from.

Pieces are then merged here by the scores of the model, the best pair first and of equal ones
the leftmost; what is no piece becomes its bytes or, in a model without byte pieces, one
unknown piece a run. No piece of the model crosses from a word into the space mark after it,
so a text falls into independent parts, and the pieces of short parts are remembered (at most
``REMEMBERED``); a model that has such a piece gets the text as one part. Long parts, as in
scripts without blanks, fall apart again between characters that no piece has side by side.
Only decoding is left to the library.

Defined results: a null or empty text has no pieces and decodes to the empty text. Models
other than byte-pair ones, with pieces defined by the user or without a space mark among the pieces
are refused with an error.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import re
import struct
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from functools import lru_cache
from itertools import batched, chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from barloom.llm.common import text_slices

SPACE = "▁"
# Parts of at most so many characters are remembered, so many of them in a task.
SHORT = 32
REMEMBERED = 450_000
# Texts whose new parts are merged together, and parts merged side by side.
TOGETHER, ABREAST = 200, 2_000
ENCODED = "doc_id long, ids array<int>, starts array<int>, ends array<int>, decoded string"
DIGESTS = (
    "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, "
    "n_bytes long, span_bytes long"
)


class CharacterMap:
    """Longest-prefix replacement through a double-array trie, with source alignment."""

    def __init__(self, blob: bytes = b""):
        self.units: tuple[int, ...] = ()
        self.pool = b""
        if blob:
            (size,) = struct.unpack_from("<I", blob)
            self.units = struct.unpack_from(f"<{size // 4}I", blob, 4)
            self.pool = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes | None]:
        """(bytes matched, replacement) of the longest key that starts at a position."""
        best: tuple[int, bytes | None] = (0, None)
        if not self.units:
            return best
        node = self._offset(self.units[0])
        for i in range(at, len(data)):
            node ^= data[i]
            unit = self.units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                start = self.units[node] & 0x7FFFFFFF
                best = (i - at + 1, self.pool[start : self.pool.index(b"\0", start)])
        return best

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def normalise(self, text: str) -> tuple[bytes, np.ndarray]:
        """(normalised bytes, source position of each of them and of the end)."""
        data = text.encode()
        if not self.units:
            return data, np.arange(len(data) + 1)
        out, source, at = bytearray(), [], 0
        while at < len(data):
            matched, value = self.longest(data, at)
            if value is None:
                matched = _character_length(data[at])
                value = data[at : at + matched]
            out += value
            source += [at] * len(value)
            at += matched
        return bytes(out), np.array([*source, len(data)])


def _character_length(first: int) -> int:
    return 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4


class Encoder:
    """Encodes texts exactly as the library does with the same byte-pair model."""

    def __init__(self, model: str | bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        given = {"model_proto": model} if isinstance(model, bytes) else {"model_file": model}
        self.processor = sentencepiece.SentencePieceProcessor(**given)
        spec = proto.ModelProto()
        spec.ParseFromString(self.processor.serialized_model_proto())
        norm, trained, kind = spec.normalizer_spec, spec.trainer_spec, proto.ModelProto.SentencePiece
        kinds = [p.type for p in spec.pieces]
        if (
            trained.model_type != trained.BPE
            or trained.treat_whitespace_as_suffix
            or {kind.USER_DEFINED, kind.UNUSED} & {*kinds}
        ):
            raise ValueError("only byte-pair models without user-defined pieces are supported")
        self.map = CharacterMap(norm.precompiled_charsmap)
        self.prefixed = norm.add_dummy_prefix
        self.trimmed = norm.remove_extra_whitespaces
        self.scores, self.ids = {}, {}
        for i, (piece, of) in enumerate(zip(spec.pieces, kinds, strict=True)):
            if of == kind.NORMAL:
                self.scores[piece.piece], self.ids[piece.piece] = -piece.score, i
        if SPACE not in self.ids:
            raise ValueError("the space mark must be a piece of the model")
        self.unknown = kinds.index(kind.UNKNOWN)
        self.bytes = (
            [self.processor.piece_to_id(f"<0x{n:02X}>") for n in range(256)]
            if trained.byte_fallback
            else []
        )
        lengths = [1 if of == kind.BYTE else len(p.piece.encode()) for p, of in zip(spec.pieces, kinds)]
        marks = [p.piece.count(SPACE) for p in spec.pieces]
        self.lengths = np.array(lengths), np.array(lengths) - 2 * np.array(marks)
        self.digits = [str(i) for i in range(len(kinds))]
        crossing = any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in self.scores)
        # Characters that occur in no piece of several, as line ends, stand by themselves.
        joining = re.escape("".join(sorted({c for p in self.scores if len(p) > 1 for c in p} - {SPACE})))
        split = f"{SPACE}*[{joining}]+|{SPACE}+|[^{SPACE}{joining}]" if joining else "."
        self.part = re.compile(".+" if crossing else split, re.DOTALL)
        self.inside = {p[i : i + 2] for p in self.scores for i in range(len(p) - 1)}
        self._known: dict[str, tuple[int, ...]] = {}
        self._number_pairs()

    def _number_pairs(self) -> None:
        """Numbers of all symbols, and of each two that merge the score and the symbol they make.

        Symbols are pieces and characters of pieces; 0 is any other character.
        """
        numbers = {c: 0 for p in self.scores for c in p} | dict.fromkeys(self.scores, 0)
        for i, symbol in enumerate(numbers, 1):
            numbers[symbol] = i
        self.piece_of = np.array([-1, *[self.ids.get(symbol, -1) for symbol in numbers]])
        # One object per id for all remembered parts, which is less memory to hold and to walk.
        self.shared = np.array([*range(len(self.digits))], object)
        self.symbol_of = np.zeros(0x110000, np.int32)
        for symbol, i in numbers.items():
            if len(symbol) == 1:
                self.symbol_of[ord(symbol)] = i
        pairs = sorted(
            (numbers[p[:i]] << 32 | numbers[p[i:]], cost, numbers[p])
            for p, cost in self.scores.items()
            for i in range(1, len(p))
            if p[:i] in numbers and p[i:] in numbers
        )
        # The last one is never found and stands for all pairs that do not merge.
        self.pairs = np.array([*[key for key, _, _ in pairs], np.iinfo(np.int64).max])
        self.costs = np.array([*[cost for _, cost, _ in pairs], np.inf])
        self.made = np.array([*[symbol for _, _, symbol in pairs], 0])

    def encode(self, text: str) -> tuple[list[int], np.ndarray, np.ndarray]:
        """(piece ids, start and end of every piece in the UTF-8 bytes of the text)."""
        return next(self.encode_all([text]))

    def encode_all(
        self, texts: Iterable[str]
    ) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
        """``encode`` of every text. Short parts that are new in a batch are merged together."""
        for batch in batched(texts, TOGETHER):
            known = self._known
            split = [self._split(text) for text in batch]
            every = set(chain.from_iterable(parts for _, parts, *_ in split))
            new = [part for part in every.difference(known) if len(part) <= SHORT]
            if len(known) + len(new) > REMEMBERED:
                known.clear()
                new = [part for part in every if len(part) <= SHORT]
            # What is too much even for an empty memory is merged when its turn comes.
            self._learn(new[:REMEMBERED])
            yield from (self._finished(*found) for found in split)

    def _split(self, text: str) -> tuple[str, list[str], np.ndarray, bool]:
        """(normalised text, its parts, source position of each byte, whether marks are bytes)."""
        none = np.zeros(0, np.int64)
        if not text:
            return "", [], none, False
        normal, source = self.map.normalise(text)
        marked = self.trimmed or SPACE.encode() in normal
        if marked:
            normal, source = self._escaped(normal, source)
        if self.trimmed and not normal:
            return "", [], none, False
        line = (" " * self.prefixed + normal.decode()).replace(" ", SPACE)
        return line, self.part.findall(line), source, marked

    def _finished(
        self, line: str, parts: list[str], source: np.ndarray, marked: bool
    ) -> tuple[list[int], np.ndarray, np.ndarray]:
        if not parts:
            return [], source, source
        head = (len(SPACE.encode()) if marked else 1) if self.prefixed else 0
        found = list(map(self._known.get, parts))
        if None in found:
            found = [ids or self._pieces(part) for part, ids in zip(parts, found, strict=True)]
        ids = list(chain.from_iterable(found))
        sizes = self.lengths[0 if marked else 1][ids]
        if not self.bytes and self.unknown in ids:
            ids, sizes = self._joined(line, marked)
        ends = np.maximum(np.cumsum(sizes) - head, 0)
        starts = np.concatenate(([0], ends[:-1]))
        return ids, source[starts], source[ends]

    def decode(self, ids: list[int]) -> str:
        return self.processor.decode(ids) if ids else ""

    def _costs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cost of merging two symbols, infinite if they make no piece; the symbol they make)."""
        keys = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.pairs, keys)
        at[self.pairs[at] != keys] = -1
        return self.costs[at], self.made[at]

    def _learn(self, parts: list[str]) -> None:
        """Remember the ids of short parts, those of about one length merged side by side."""
        parts.sort(key=len)
        for start in range(0, len(parts), ABREAST):
            self._learn_abreast([p for p in parts[start : start + ABREAST] if p])

    def _learn_abreast(self, parts: list[str]) -> None:
        """In every round each part merges its best pair, of equal ones the leftmost, as in
        ``_merged``. Parts with a symbol that is no piece are left to ``_pieces``."""
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        width = int(lengths.max(initial=0)) + 1
        symbols = np.zeros((len(parts), width), np.int32)
        filled = np.arange(width) < lengths[:, None]
        symbols[filled] = self.symbol_of[np.frombuffer("".join(parts).encode("utf-32-le"), "<u4")]
        done, left = symbols.copy(), lengths.copy()
        rows, columns = np.arange(len(parts)), np.arange(width)
        # Every row ends with a zero, which makes no pair, so a merged pair has two neighbours.
        costs = self._costs(symbols[:, :-1], symbols[:, 1:])[0]
        while rows.size:
            best = costs.argmin(axis=1)
            going = costs[np.arange(rows.size), best] < np.inf
            if not going.all():
                done[rows[~going], :width] = symbols[~going]
                rows, symbols, costs, best = rows[going], symbols[going], costs[going], best[going]
                if not rows.size:
                    break
            every, place = np.arange(rows.size), best[:, None]
            made = self._costs(symbols[every, best], symbols[every, best + 1])[1]
            symbols[every, best] = made
            symbols = symbols[columns[:width] != place + 1].reshape(rows.size, width - 1)
            costs = costs[columns[: width - 1] != place].reshape(rows.size, width - 2)
            width -= 1
            costs[every, best] = self._costs(made, symbols[every, best + 1])[0]
            inner = best > 0
            at, before = every[inner], best[inner] - 1
            costs[at, before] = self._costs(symbols[at, before], made[inner])[0]
            left[rows] -= 1
        ids = self.piece_of[done]
        whole = ((ids >= 0) | (columns >= left[:, None])).all(axis=1)
        shared = self.shared[ids].tolist()
        for part, found, n, fits in zip(parts, shared, left.tolist(), whole.tolist()):
            if fits:
                self._known[part] = tuple(found[:n])

    def _joined(self, line: str, marked: bool) -> tuple[list[int], list[int]]:
        """(ids, bytes of each piece) where neighbouring unknown pieces are one, as in the
        library; their sizes are those of the symbols."""
        ids, sizes = [], []
        for part in self.part.findall(line):
            for symbol in self._merged(part):
                piece = self.ids.get(symbol, self.unknown)
                size = len(symbol.encode()) - (0 if marked else 2 * symbol.count(SPACE))
                if piece == self.unknown and ids and ids[-1] == piece:
                    sizes[-1] += size
                else:
                    ids.append(piece)
                    sizes.append(size)
        return ids, sizes

    def _pieces(self, part: str) -> tuple[int, ...]:
        """Ids of an independent part."""
        ids = []
        if len(part) > SHORT:
            cuts = [i for i in range(1, len(part)) if part[i - 1 : i + 1] not in self.inside]
            if cuts:
                known = self._known
                for a, b in pairwise([0, *cuts, len(part)]):
                    ids += known.get(part[a:b]) or self._pieces(part[a:b])
                return tuple(ids)
        for symbol in self._merged(part):
            known = self.ids.get(symbol)
            if known is not None:
                ids.append(known)
            elif self.bytes:
                ids += [self.bytes[byte] for byte in symbol.encode()]
            else:
                ids.append(self.unknown)
        found = tuple(ids)
        if len(part) <= SHORT:
            if len(self._known) >= REMEMBERED:
                self._known.clear()
            self._known[part] = found
        return found

    def _merged(self, part: str) -> list[str]:
        """Symbols of a part after all merges, each of the best and leftmost pair."""
        if len(part) > SHORT:
            return self._merged_long(part)
        score, never = self.scores.get, float("inf")
        symbols = list(part)
        pairs = [score(a + b, never) for a, b in zip(symbols, symbols[1:])]
        while pairs:
            best = min(pairs)
            if best == never:
                break
            at = pairs.index(best)
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = score(symbols[at - 1] + symbols[at], never)
            if at < len(pairs):
                pairs[at] = score(symbols[at] + symbols[at + 1], never)
        return symbols

    def _merged_long(self, part: str) -> list[str]:
        """The same with a heap of open pairs, for parts of any length."""
        scores, count = self.scores, len(part)
        size, after, before = [1] * count, list(range(1, count + 1)), list(range(-1, count - 1))
        open_pairs = [
            (scores[part[i : i + 2]], i, 2) for i in range(count - 1) if part[i : i + 2] in scores
        ]
        heapq.heapify(open_pairs)
        while open_pairs:
            _, left, length = heapq.heappop(open_pairs)
            right = after[left]
            # A pair is out of date when either side has been merged since.
            if not size[left] or right == count or size[left] + size[right] != length:
                continue
            size[left], size[right] = length, 0
            after[left] = following = after[right]
            if following < count:
                before[following] = left
                wider = length + size[following]
                score = scores.get(part[left : left + wider])
                if score is not None:
                    heapq.heappush(open_pairs, (score, left, wider))
            ahead = before[left]
            if ahead >= 0:
                wider = size[ahead] + length
                score = scores.get(part[ahead : ahead + wider])
                if score is not None:
                    heapq.heappush(open_pairs, (score, ahead, wider))
        return [part[i : i + n] for i, n in enumerate(size) if n]

    def _escaped(self, normal: bytes, source: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Spaces written as marks; with trimming, only one between words and none outside."""
        out, positions = bytearray(), []
        ended = True
        for byte, at in zip(normal, source[:-1].tolist(), strict=True):
            if byte != 32:
                out.append(byte)
                positions.append(at)
                ended = False
            elif not (self.trimmed and ended):
                out += SPACE.encode()
                positions += [at] * 3
                ended = True
        # The library takes marks off the end too, whether they were spaces or not.
        while self.trimmed and out.endswith(SPACE.encode()):
            del out[-3:], positions[-3:]
        return bytes(out), np.array([*positions, source[-1]])


@contextmanager
def uncollected() -> Iterator[None]:
    """No search for cycles in the block: encoding makes none, but many small objects."""
    before = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if before:
            gc.enable()


@lru_cache(maxsize=1)
def encoder_of(model: str) -> Encoder:
    """The encoder of a model file, kept with the parts it knows for the worker's next tasks."""
    return Encoder(model)


def encode_documents(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, piece ids, their byte spans in the text and the decoded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(model)
        for part in text_slices(batches):
            rows = []
            texts = [text or "" for text in part.column("text").to_pylist()]
            with uncollected():
                for ids, starts, ends in encoder.encode_all(texts):
                    rows.append((ids, starts, ends, encoder.decode(ids)))
            ints = pa.list_(pa.int32())
            yield pa.record_batch(
                [
                    part.column("doc_id"),
                    *[pa.array([r[k] for r in rows], ints) for k in range(3)],
                    pa.array([r[3] for r in rows], pa.string()),
                ],
                ["doc_id", "ids", "starts", "ends", "decoded"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, ENCODED)


def encoding_digests(docs: DataFrame, model: str) -> DataFrame:
    """Digests of ``encode_documents``, taken where the arrays are, one row a document.

    ``span_bytes`` adds up the spans; it equals ``n_bytes`` as nothing is lost.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(model)
        for part in text_slices(batches):
            rows = []
            texts = [text or "" for text in part.column("text").to_pylist()]
            with uncollected():
                for text, (ids, starts, ends) in zip(texts, encoder.encode_all(texts), strict=True):
                    digits = ",".join(map(encoder.digits.__getitem__, ids))
                    rows.append(
                        (
                            len(ids),
                            hashlib.sha256(digits.encode()).hexdigest(),
                            hashlib.sha256(encoder.decode(ids).encode()).hexdigest(),
                            len(text.encode()),
                            int((ends - starts).sum()),
                        )
                    )
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
            yield pa.record_batch(
                [
                    part.column("doc_id"),
                    *[pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)],
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes", "span_bytes"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, DIGESTS)
