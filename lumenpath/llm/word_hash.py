"""Vectorised hashes of the words of many texts."""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Bytes of a word: ASCII letters and digits, and every byte of a longer UTF-8 sequence.
IN_WORD = np.array([chr(b).isalnum() if b < 128 else True for b in range(256)])
_POWERS = [np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse modulo 2**64, for i < n."""
    if len(_POWERS[0]) < n:
        m = max(n, 1 << 20)
        for k, base in enumerate((BASE, INVERSE)):
            steps = np.full(m, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS[0][:n], _POWERS[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Words:
    """Byte ranges and hashes of the words of ``texts``: equal words have equal hashes everywhere.

    ``doc`` is each word's text, ``start`` and ``end`` its range in ``data``, ``at`` each text's first byte.
    """

    def __init__(self, texts: list[str], lower: bool = True) -> None:
        raw = [(t.lower() if lower else t).encode("utf-8", "replace") for t in texts]
        self.data = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)
        self.at = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw])]).astype(np.int64)
        inside = IN_WORD[self.data]
        change = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
        self.start, self.end = change[::2], change[1::2]
        up, down = powers(len(self.data) + 1)
        total = np.zeros(len(self.data) + 1, dtype=np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up[:-1], dtype=np.uint64, out=total[1:])
        self.hash = mix((total[self.end] - total[self.start]) * down[self.start])
        self.doc = np.searchsorted(self.at, self.start, "right") - 1


def slices(text: str, chars: int) -> list[str]:
    """A text in parts of about ``chars`` characters, cut before a space or a line's end, so that no word is cut."""
    out, at = [], 0
    while len(text) - at > chars:
        end = at + chars
        while end < len(text) and text[end] not in " \n":
            end += 1
        out.append(text[at:end])
        at = end
    return [*out, text[at:]]
