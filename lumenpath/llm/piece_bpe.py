"""Byte-level BPE through a sentencepiece model that is written directly from a rank file.

Every byte is shown as one printable character, so a vocabulary entry is a piece, its id is
its rank and its score the negative rank: the model merges the pair with the best score, the
leftmost of equals, which is the pair of lowest rank. Normalisation is the identity and white
space is not escaped, so pieces pass through unchanged. A text is split into pre-tokens by the
vocabulary's pattern, each encoded on its own; ids are decoded by the inverse mapping from
pieces to bytes.

Pre-tokens are found unit by unit. No match of the pattern runs from a visible character into
white space, so a text may be cut before any white space that follows a visible character: it
is cut at single spaces at once, and where spaces meet other white space unit by unit. Each
distinct unit is split and encoded once and remembered in flat arrays of bounded size.
"""

from __future__ import annotations

import base64
import re
import struct
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from lumenpath.llm.bpe_automaton import byte_characters
from lumenpath.llm.chunk_table import ENTRY_BYTES, SLICE_CHARS, TABLE_BYTES, key_size
from lumenpath.llm.common import held, map_texts, texts_of
from lumenpath.llm.token_counts import SPACE, SPACES, UNITS

# The split pattern of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Visible bytes as characters cannot spell this.
UNKNOWN = "⁇"
#: A chunk between spaces after which the text must be cut unit by unit.
ODD = re.compile(f"(?s)(?:.*[{SPACE}])?")
# Fixed values of the model format: field numbers and kinds.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
MODEL_TYPE, UNK_ID, BOS_ID, EOS_ID, PAD_ID = 3, 40, 41, 42, 43
NAME, CHARS_MAP, DUMMY_PREFIX, FEWER_SPACES, ESCAPE_SPACES = 1, 2, 3, 4, 5
NORMAL, UNK_KIND, BPE = 1, 2, 2


def varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def field(number: int, value: int | float | str | bytes) -> bytes:
    """One field of a protocol buffer: integers as varints, floats in four bytes, the rest by length."""
    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    data = value.encode() if isinstance(value, str) else value
    return varint(number << 3 | 2) + varint(len(data)) + data


def ranks_of(lines: bytes) -> dict[bytes, int]:
    """A rank file: base64 of the bytes and the rank in each line."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines())}


def serialise(ranks: dict[bytes, int]) -> bytes:
    """The sentencepiece model of a vocabulary whose ranks are 0, 1, ...; the unknown piece comes last."""
    ordered = sorted(ranks, key=ranks.get)
    if [ranks[t] for t in ordered] != list(range(len(ordered))):
        raise ValueError("ranks must be 0, 1, ... without a gap")
    shown = byte_characters()
    pieces = [field(1, "".join(shown[b] for b in t)) + field(2, float(-r)) + field(3, NORMAL) for r, t in enumerate(ordered)]
    pieces.append(field(1, UNKNOWN) + field(2, 0.0) + field(3, UNK_KIND))
    trainer = field(MODEL_TYPE, BPE) + field(UNK_ID, len(ordered)) + b"".join(field(f, -1) for f in (BOS_ID, EOS_ID, PAD_ID))
    normalizer = field(NAME, "identity") + field(CHARS_MAP, b"") + field(DUMMY_PREFIX, 0) + field(FEWER_SPACES, 0) + field(ESCAPE_SPACES, 0)
    return b"".join(field(PIECES, p) for p in pieces) + field(TRAINER, trainer) + field(NORMALIZER, normalizer)


class PieceCodec:
    """Encodes texts and decodes ids by the model; units are encoded once and kept up to ``most`` bytes."""

    def __init__(self, model: bytes, most: int = TABLE_BYTES) -> None:
        import sentencepiece

        self.model, self.most = sentencepiece.SentencePieceProcessor(model_proto=model), most
        shown = byte_characters()
        self.shown = dict(enumerate(shown))
        byte_of = {c: b for b, c in enumerate(shown)}
        pieces = self.model.id_to_piece(list(range(len(self.model) - 1)))
        self.whole = {p: i for i, p in enumerate(pieces)}
        spelled = [bytes(byte_of[c] for c in p) for p in pieces]
        self.bytes = np.frombuffer(b"".join(spelled), dtype=np.uint8)
        self.byte_at = np.concatenate([[0], np.cumsum([len(s) for s in spelled])]).astype(np.int64)
        self.pattern = regex.compile(PATTERN)
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {"": 0}
        self.flat, self.start, self.key_bytes = array("I"), array("q", [0, 0]), 0

    def size(self) -> int:
        return self.key_bytes + ENTRY_BYTES * len(self.at) + 8 * len(self.start) + 4 * len(self.flat)

    def pre_token_ids(self, tokens: list[str]) -> list[list[int]]:
        """Ids of pre-tokens: one that is a piece is its id, as in the library; the model merges the others."""
        said = [t.encode().decode("latin-1").translate(self.shown) for t in tokens]
        rest = [s for s in said if s not in self.whole]
        merged = iter(self.model.encode(rest, out_type=int, num_threads=1) if rest else [])
        return [[self.whole[s]] if s in self.whole else next(merged) for s in said]

    def learn(self, units: list[str]) -> None:
        """Add units and their pre-tokens. A unit of one pre-token is one entry."""
        split = list(map(self.pattern.findall, units))
        lacking = list(dict.fromkeys(t for tokens in split for t in tokens if t not in self.at))
        for token, ids in zip(lacking, self.pre_token_ids(lacking)):
            self.enter(token, ids)
        at, flat, start = self.at, self.flat, self.start
        for unit, tokens in zip(units, split):
            if unit not in at:
                ids = array("I")
                for t in tokens:
                    i = at[t]
                    ids += flat[start[i] : start[i + 1]]
                self.enter(unit, ids)

    def enter(self, key: str, ids) -> None:
        self.at[key] = len(self.start) - 1
        self.flat.extend(ids)
        self.start.append(len(self.flat))
        self.key_bytes += key_size(key)

    def numbers(self, units: list[str]) -> np.ndarray:
        """The entry of every unit."""
        found = list(map(self.at.get, units))
        if None in found:
            self.learn(list(dict.fromkeys(u for u, i in zip(units, found) if i is None)))
            found = list(map(self.at.__getitem__, units))
        return np.array(found, dtype=np.int64)

    def entries(self, slices: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(entries of all slices' units one after the other, how many each slice has)."""
        parts = pc.split_pattern(pa.array(slices, pa.string()), " ")
        offsets, coded = parts.offsets.to_numpy().astype(np.int64), parts.flatten().dictionary_encode()
        chunks, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        first, sizes = offsets[:-1] - offsets[0], np.diff(offsets)
        odd = np.fromiter((ODD.fullmatch(c) is not None for c in chunks), dtype=bool, count=len(chunks))[codes]
        # The first chunk may be empty: the slice begins with a space.
        odd[first] &= np.fromiter((chunks[c] != "" for c in codes[first]), dtype=bool, count=len(first))
        uneven = np.add.reduceat(odd, first, dtype=np.int64) > 0 if len(first) else np.zeros(0, dtype=bool)
        used = np.unique(codes[np.repeat(~uneven, sizes)])
        table = np.zeros(len(chunks), dtype=np.int64)
        table[used] = self.numbers([" " + chunks[c] for c in used.tolist()])
        own = table[codes]
        own[first] = self.numbers([chunks[c] if not u else "" for c, u in zip(codes[first].tolist(), uneven.tolist())])
        if not uneven.any():
            return own, sizes
        cut = np.split(own, first[1:])
        for i in np.flatnonzero(uneven).tolist():
            cut[i] = self.numbers(UNITS.findall(slices[i]))
        return np.concatenate(cut), np.array([len(c) for c in cut], dtype=np.int64)

    def slices(self, text: str):
        """A text in slices of about SLICE_CHARS, cut before white space that follows a visible character."""
        at = 0
        while len(text) - at > SLICE_CHARS:
            end = at + SLICE_CHARS
            while end < len(text) and not (text[end] in SPACES and text[end - 1] not in SPACES):
                end += 1
            yield text[at:end]
            at = end
        yield text[at:] if at else text

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, offsets: text i has the ids from offset i to offset i + 1)."""
        counts, out, held, owner, chars = np.zeros(len(texts), dtype=np.int64), [], [], [], 0

        def flush() -> None:
            if self.size() > self.most:
                self.clear()
            own, units = self.entries(held)
            start = np.frombuffer(self.start, dtype=np.int64)
            low = start[own]
            size = start[own + 1] - low
            ends = np.concatenate([[0], np.cumsum(size)])
            shift = np.repeat(low - ends[:-1], size) + np.arange(ends[-1])
            out.append(np.frombuffer(self.flat, dtype=np.uint32)[shift] if len(self.flat) else np.zeros(0, np.uint32))
            np.add.at(counts, owner, np.diff(ends[np.concatenate([[0], np.cumsum(units)])]))
            held.clear()
            owner.clear()

        for i, text in enumerate(texts):
            for part in self.slices(text):
                held.append(part)
                owner.append(i)
                chars += len(part)
                if chars > SLICE_CHARS:
                    flush()
                    chars = 0
        if held:
            flush()
        return np.concatenate(out) if out else np.zeros(0, np.uint32), np.concatenate([[0], np.cumsum(counts)])

    def decode(self, ids: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all ids one after the other, offsets): run i of the ids between ``cuts`` spells the bytes from offset i to offset i + 1."""
        low = self.byte_at[ids]
        size = self.byte_at[ids.astype(np.int64) + 1] - low
        ends = np.concatenate([[0], np.cumsum(size)])
        return self.bytes[np.repeat(low - ends[:-1], size) + np.arange(ends[-1])], ends[cuts]


def binaries(data: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The bytes of ``data`` between the ``cuts`` as an Arrow column, without a copy."""
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def encode_decode(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids, decoded`` of every whole text.

    ``ids`` are the token ids as little-endian unsigned 32-bit integers, ``decoded`` the bytes
    that they spell again. Special strings are ordinary text. Null and empty texts have no ids
    and decode to nothing; repeated rows are each encoded; a very long text is worked off in
    slices between pre-tokens; an empty table stays empty; extra columns are ignored. A narrow
    map without a shuffle; the rank file is read on the driver and broadcast (under 1 MB).
    """
    with open(vocab_path, "rb") as f:
        lines = docs.sparkSession.sparkContext.broadcast(f.read())

    def start():
        codec = held(f"pieces {vocab_path}", lambda: PieceCodec(serialise(ranks_of(lines.value))))

        def kernel(texts: list[str]) -> list:
            ids, cuts = codec.encode(texts)
            spelled, ends = codec.decode(ids, cuts)
            return [pa.array(np.diff(cuts)), binaries(ids.view(np.uint8), cuts * 4), binaries(spelled, ends)]

        return kernel

    names = [("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())]
    return map_texts(texts_of(docs, id_col, text_col), "doc_id long, n_tokens long, ids binary, decoded binary", names, None, start)
