"""Word shingles of many texts at once, as 64-bit hashes."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import xxhash

from lumenpath.llm.simhash_trie import LOWER
from lumenpath.llm.word_hash import mix, powers

#: Bytes of a pass: what a text's hashing holds in memory at once is a small multiple of it.
PASS_BYTES = 600_000
#: A word beyond so many bytes is hashed before, so that a pass need not hold it whole.
LONG_WORD = 65_536
_LONG = re.compile(rb"[^\x20\x09-\x0d]{%d,}" % LONG_WORD)
_BREAK = re.compile(rb"[\x20\x09-\x0d]")
_IN_WORD = np.array([not (b == 0x20 or 0x09 <= b <= 0x0D) for b in range(256)])
_STEP = np.uint64(0x9E3779B97F4A7C15)


def plain(text: str) -> bytes:
    """UTF-8 with A-Z lower-cased and over-long words replaced by their hash."""
    raw = text.encode().translate(LOWER)
    return _LONG.sub(lambda m: b"%016x" % xxhash.xxh64_intdigest(m[0]), raw) if len(raw) >= LONG_WORD else raw


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, where each begins) of bytes; words are what lies between white space."""
    data = np.frombuffer(raw, dtype=np.uint8)
    inside = _IN_WORD[data]
    change = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    start, end = change[::2], change[1::2]
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], dtype=np.uint64, out=total[1:])
    return mix((total[end] - total[start]) * down[start]), start


def rolled(words: np.ndarray, size: int) -> np.ndarray:
    """The hash of every run of ``size`` words."""
    out = np.zeros(max(0, len(words) - size + 1), dtype=np.uint64)
    for k in range(size):
        out = mix(out * _STEP + words[k : k + len(out)])
    return out


def pieces(raw: bytes) -> Iterator[bytes]:
    """A text in pieces of about PASS_BYTES, cut at white space."""
    at = 0
    while len(raw) - at > PASS_BYTES:
        found = _BREAK.search(raw, at + PASS_BYTES)
        if not found:
            break
        yield raw[at : found.start()]
        at = found.start()
    yield raw[at:]


def shingle_runs(texts: list[str], size: int) -> list[np.ndarray]:
    """The hashes (uint64) of every text's shingles of ``size`` words, in order, repeats included.

    A text of fewer words is one shingle, one without words has none. Long texts are worked
    off in pieces that carry over the last words, so a piece's memory does not grow with the text.
    """
    raws = [plain(t) for t in texts]
    out: list[np.ndarray] = []
    at = 0
    while at < len(raws):
        end, size_now = at, 0
        while end < len(raws) and (end == at or size_now + len(raws[end]) <= PASS_BYTES):
            size_now += len(raws[end]) + 1
            end += 1
        if end == at + 1:
            words = np.concatenate([word_hashes(p)[0] for p in pieces(raws[at])])
            out.append(rolled(words, min(size, max(1, len(words)))))
        else:
            first = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raws[at:end]])])
            words, start = word_hashes(b"\n".join(raws[at:end]) + b"\n")
            cuts = np.searchsorted(start, first)
            runs = rolled(words, size)
            for a, b in zip(cuts.tolist(), cuts[1:].tolist()):
                out.append(runs[a : b - size + 1] if b - a >= size else rolled(words[a:b], max(1, b - a)))
        at = end
    return out


def simhash(run: np.ndarray) -> int:
    """64-bit SimHash of a run of hashes: a bit is set if it is in over half of them. In parts, so that a long run takes no more memory."""
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(run), 8_192):
        ones += np.unpackbits(run[at : at + 8_192].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(run), bitorder="little").view("<u8")[0])
