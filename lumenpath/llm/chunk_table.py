"""Ids of the parts between white space, remembered in flat arrays of bounded size."""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The characters of Unicode's White_Space beyond ASCII.
WIDE_SPACES = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")

#: A worker's table starts anew when it holds so many bytes.
TABLE_BYTES = 64 << 20
#: What an entry takes besides its characters and ids: the string's head, the number and the slot.
ENTRY_BYTES = 150
#: Longer words are not remembered apart from their chunk.
LONG_WORD = 64
#: Texts are worked off in slices of about so many characters, cut at white space.
SLICE_CHARS = 1_000_000
#: So many characters are looked up at once.
PASS_CHARS = 2_500_000


def key_size(key: str) -> int:
    """Bytes of a string's characters, at most four each."""
    return len(key) if key.isascii() else 4 * len(key)


def plain_spaces(text: str) -> str:
    return text if text.isascii() else WIDE_SPACES.sub(" ", text)


class ChunkTable:
    """Encodes texts by their chunks: a chunk's words are encoded once and its ids kept in one flat array.

    ``words(chunk)`` gives a chunk's words, ``encode_word`` a word's ids; ``pieces(text)`` tells
    added tokens from text. What is kept is bounded by bytes, whatever the length of chunks: a
    full table is emptied before the next slices.
    """

    def __init__(self, encode_word: Callable, words: Callable, pieces: Callable, added: dict[str, int], most: int = TABLE_BYTES) -> None:
        self.encode_word, self.words, self.pieces, self.added, self.most = encode_word, words, pieces, added, most
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        self.flat, self.start, self.bytes, self.key_bytes = array("I"), array("q", [0]), 0, 0
        self.enter("", array("I"))
        for content, i in self.added.items():
            self.enter(content, array("I", [i]))

    def enter(self, key: str, ids: array) -> None:
        self.at[key] = len(self.start) - 1
        self.flat.extend(ids)
        self.start.append(len(self.flat))

    def learn(self, chunks: list[str]) -> None:
        """Add chunks. A word has the same ids wherever it stands, so words are entries like chunks."""
        at, flat, start, size = self.at, self.flat, self.start, 0
        for chunk in chunks:
            found = self.words(chunk)
            if len(found) == 1:
                w = found[0]
                i = at.get(w)
                if i is None:
                    at[w] = i = len(start) - 1
                    flat.extend(array("I", self.encode_word(w)))
                    start.append(len(flat))
                    size += key_size(w)
                if w is not chunk:
                    at[chunk] = i
                    size += key_size(chunk)
                continue
            ids = array("I")
            for w in found:
                i = at.get(w)
                if i is not None:
                    ids += flat[start[i] : start[i + 1]]
                    continue
                own = array("I", self.encode_word(w))
                ids += own
                if len(w) <= LONG_WORD:
                    at[w] = len(start) - 1
                    flat.extend(own)
                    start.append(len(flat))
                    size += key_size(w)
            at[chunk] = len(start) - 1
            flat.extend(ids)
            start.append(len(flat))
            size += key_size(chunk)
        self.key_bytes += size
        self.bytes = self.key_bytes + ENTRY_BYTES * len(at) + 8 * len(start) + 4 * len(flat)

    def gather(self, slices: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all slices one after the other, how many each has)."""
        if self.bytes > self.most:
            self.clear()
        parts = pc.ascii_split_whitespace(pa.array(slices, pa.string()))
        coded = parts.flatten().dictionary_encode()
        chunks = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.at.get, chunks))
        if None in found:
            lacking = [k for k, i in enumerate(found) if i is None]
            self.learn([chunks[k] for k in lacking])
            for k in lacking:
                found[k] = self.at[chunks[k]]
        start = np.frombuffer(self.start, dtype=np.int64)
        at = np.array(found, dtype=np.int64)[coded.indices.to_numpy(zero_copy_only=False)]
        low = start[at]
        size = start[at + 1] - low
        ends = np.concatenate([[0], np.cumsum(size)])
        shift = np.repeat(low - ends[:-1], size)
        shift += np.arange(len(shift))
        ids = np.frombuffer(self.flat, dtype=np.uint32)[shift] if len(self.flat) else np.zeros(0, np.uint32)
        return ids, np.diff(ends[parts.offsets.to_numpy()])

    def slices(self, text: str) -> Iterator[str]:
        """A text in slices cut at white space; an added token is a slice of its own."""
        for is_added, piece in self.pieces(text):
            at = 0
            while not is_added and len(piece) - at > SLICE_CHARS:
                end = at + SLICE_CHARS
                while end < len(piece) and not piece[end] in " \t\n":
                    end += 1
                yield plain_spaces(piece[at:end])
                at = end
            yield plain_spaces(piece[at:] if at else piece)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, offsets: text i has the ids from offset i to offset i + 1)."""
        counts, out = np.zeros(len(texts), dtype=np.int64), []
        held: list[str] = []
        owner: list[int] = []
        chars = 0

        def flush() -> None:
            ids, size = self.gather(held)
            out.append(ids)
            np.add.at(counts, owner, size)
            held.clear()
            owner.clear()

        for i, text in enumerate(texts):
            for part in self.slices(text):
                held.append(part)
                owner.append(i)
                chars += len(part)
                if chars > PASS_CHARS:
                    flush()
                    chars = 0
        if held:
            flush()
        return np.concatenate(out) if out else np.zeros(0, np.uint32), np.concatenate([[0], np.cumsum(counts)])
