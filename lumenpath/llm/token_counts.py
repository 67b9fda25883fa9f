"""Token counts of whole texts, with overlap resynchronisation for huge documents.

A text of more than CHUNK_CHARS is cut into overlapping chunks, each encoded by the library
on its own with offsets. Two neighbours are spliced at a token boundary that both encodings
have and that is proven stable: the character before it is no white space and the one at it
is. The vocabulary's split pattern looks back at nothing and at most one character ahead of
white space, and no alternative of it runs from a visible character into white space; so a
match always ends there, and what follows is matched the same whatever came before. If the
overlap has no such boundary (a long run without white space, or of nothing else), it is
widened; if the whole chunk has none, the chunk is encoded anew at twice its length.

Shorter texts need no splicing. They are counted by units, the parts between the same stable
boundaries, whose counts the library gives once and a table of bounded size remembers.
"""

from __future__ import annotations

import json
import os
import re
import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lumenpath.llm.bpe_automaton import pieces
from lumenpath.llm.common import held, map_texts, texts_of

# The characters of Unicode's White_Space.
SPACE = "\t-\r \x85\xa0  -     　"
UNITS = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
SPACES = frozenset(c for c in map(chr, range(0x3001)) if re.match(f"[{SPACE}]", c))
CHUNK_CHARS, OVERLAP_CHARS = 32_768, 512
#: A worker's table of units starts anew when it holds so many bytes.
TABLE_BYTES = 96 << 20


class UnitCounts:
    """The library's counts of units, remembered up to TABLE_BYTES, and its encodings with offsets."""

    def __init__(self, vocab: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok, self.known, self.bytes = Tokenizer.from_str(vocab), {}, 0
        self.tok.no_truncation()
        self.tok.no_padding()
        self.added = [a["content"] for a in json.loads(vocab)["added_tokens"]]

    def ends(self, text: str) -> np.ndarray:
        """Where each token of a text ends, in characters; tokens that share a character share its end."""
        offsets = self.tok.encode(text, add_special_tokens=False).offsets
        return np.array(offsets, dtype=np.int64).reshape(-1, 2)[:, 1]

    def of(self, units: list[str]) -> list[int]:
        if self.bytes > TABLE_BYTES:
            self.known, self.bytes = {}, 0
        got = list(map(self.known.get, units))
        if None in got:
            lacking = list({u for u, n in zip(units, got) if n is None})
            self.known.update(zip(lacking, map(len, self.tok.encode_batch_fast(lacking, add_special_tokens=False))))
            self.bytes += sum(map(sys.getsizeof, lacking)) + 100 * len(lacking)
            got = list(map(self.known.__getitem__, units))
        return got


class Chunk:
    """One chunk of a text, encoded on its own: where it lies and where its tokens end."""

    def __init__(self, counts: UnitCounts, text: str, start: int, end: int) -> None:
        self.start, self.end, self.ends = start, end, counts.ends(text[start:end]) + start

    def until(self, at: int) -> int:
        """How many tokens end at ``at`` or before."""
        return int(np.searchsorted(self.ends, at, "right"))


def splice(left: Chunk, right: Chunk, text: str) -> int | None:
    """The first stable boundary inside the overlap at which both encodings end a token."""
    own = left.ends[(left.ends > right.start) & (left.ends < left.end)]
    return next((p for p in np.intersect1d(own, right.ends).tolist() if text[p] in SPACES and text[p - 1] not in SPACES), None)


def count_spliced(counts: UnitCounts, text: str, size: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> tuple[int, int]:
    """(tokens, chunks used) of a text without added tokens, by chunks of ``size`` spliced in overlaps."""
    n, total, since, used = len(text), 0, 0, 1
    left = Chunk(counts, text, 0, min(n, size))
    while left.end < n:
        width, cut = overlap, None
        while cut is None and left.end - width > since:
            begin = left.end - width
            right = Chunk(counts, text, begin, min(n, begin + max(size, 2 * width)))
            cut = splice(left, right, text)
            width *= 2
        if cut is None:
            left = Chunk(counts, text, since, min(n, since + 2 * (left.end - since)))
        else:
            total += left.until(cut) - left.until(since)
            left, since, used = right, cut, used + 1
    return total + len(left.ends) - left.until(since), used


def token_counts(docs: DataFrame, vocab_path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit, n_chunks`` of every whole text.

    Special strings inside texts become special tokens, as is the library's default. Null and
    empty texts count no tokens; repeated rows are each counted; an empty table stays empty;
    extra columns are ignored. A narrow map without a shuffle.
    """
    with open(vocab_path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def start():
        counts = held(f"counts {vocab_path}", lambda: UnitCounts(spec.value))

        def one(text: str) -> tuple[int, int]:
            n = used = 0
            for is_added, piece in pieces(text, counts.added):
                if is_added:
                    n += 1
                elif len(piece) <= CHUNK_CHARS:
                    n, used = n + sum(counts.of(UNITS.findall(piece))), used + 1
                else:
                    k, c = count_spliced(counts, piece)
                    n, used = n + k, used + c
            return n, used

        def kernel(texts: list[str]) -> list[list]:
            rows = [one(t) for t in texts]
            return [[len(t.encode()) for t in texts], [r[0] for r in rows], [r[0] > limit for r in rows], [r[1] for r in rows]]

        return kernel

    names = [("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_()), ("n_chunks", pa.int32())]
    return map_texts(texts_of(docs, id_col, text_col), "doc_id long, n_bytes long, n_tokens long, over_limit boolean, n_chunks int", names, None, start)
