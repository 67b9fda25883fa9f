"""Benchmark decontamination by SimHash of item-sized windows.

For an item of n words, windows of n words of a document are fingerprinted; a document of
fewer words is one window. A multi-index over blocks of the items' fingerprints returns every
item within RADIUS bits. At a similarity of 0.8 two fingerprints differ in 9.7 bits on
average (standard deviation 2.9), so a radius that misses nothing would make blocks useless;
instead there are FAMILIES fingerprints of independent hashes, and one within RADIUS is
enough: about 0.5 % of pairs at exactly 0.8 have none, and fewer above. Candidates are
verified by the exact weighted Jaccard similarity of their word shingles, weights being the
shingles' counts.

A window can reach a similarity above zero only if it holds a shingle of the item, so
windows without one are not fingerprinted; that loses nothing.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenpath.llm.common import held, keep_texts, texts_of

SHINGLE, SIMILARITY, RADIUS, BLOCKS, FAMILIES, WIDTH = 5, 0.8, 11, 4, 4, 16
#: The items are broadcast; a larger benchmark is worked off in parts of about so many bytes and items. An item takes some 10 KB of the index.
PART_BYTES, PART_ITEMS = 8 << 20, 8_000
#: So many windows are compared at once.
RUN = 4_096
WORD = re.compile(r"\w+")
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)
FAMILY_SEEDS = np.array([0, 0x2545F4914F6CDD1D, 0x9E6C63D0876A9A47, 0xB5026F5AA96619E9], dtype=np.uint64)


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_hashes(word_hash: np.ndarray, k: int) -> np.ndarray:
    n = len(word_hash) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = word_hash[:n] * MULTIPLIERS[0]
    for j in range(1, k):
        out = out + word_hash[j : j + n] * MULTIPLIERS[j]
    return mix(out)


def simhash_windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """SimHash of every run of ``size`` consecutive shingles, by differences of running bit counts."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    run = np.concatenate([np.zeros((1, 64), dtype=np.int32), np.cumsum(bits, axis=0, dtype=np.int32)])
    ones = run[size:] - run[:-size]
    return np.packbits(ones * 2 > size, axis=1, bitorder="little").view("<u8")[:, 0]


def family(hashes: np.ndarray, f: int) -> np.ndarray:
    """Other hashes of the same shingles: each family gives a fingerprint of its own."""
    return mix(hashes ^ FAMILY_SEEDS[f])


def hashes_of(words: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) for w in words], dtype=np.uint64)


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard: sum of the smaller weights over sum of the larger."""
    least = sum(min(n, b[s]) for s, n in a.items() if s in b)
    return least / (sum(a.values()) + sum(b.values()) - least)


def shingles(words: list[str], k: int) -> Counter:
    return Counter(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


class MultiIndex:
    """All fingerprints within RADIUS bits, by BLOCKS blocks.

    If two fingerprints differ in RADIUS bits or fewer, one block differs in no more than
    RADIUS // BLOCKS bits. Each fingerprint is filed in every block under all values so near to
    its own; the places of a value follow one another in one flat array.
    """

    def __init__(self, prints: np.ndarray) -> None:
        self.prints, self.blocks = prints, []
        flips = np.array([sum(1 << i for i in bits) for r in range(RADIUS // BLOCKS + 1) for bits in combinations(range(WIDTH), r)], dtype=np.uint64)
        for b in range(BLOCKS):
            keys = (self.part(prints, b)[:, None] ^ flips).ravel().astype(np.int64)
            order = np.argsort(keys, kind="stable")
            first = np.zeros((1 << WIDTH) + 1, dtype=np.int32)
            np.cumsum(np.bincount(keys, minlength=1 << WIDTH), out=first[1:])
            self.blocks.append((first, (order // len(flips)).astype(np.int32)))

    @staticmethod
    def part(prints: np.ndarray, b: int) -> np.ndarray:
        return prints >> np.uint64(b * WIDTH) & np.uint64((1 << WIDTH) - 1)

    def candidates(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, fingerprint) pairs that share a near block, some of them more than once."""
        queries, found = [], []
        for b, (first, places) in enumerate(self.blocks):
            key = self.part(prints, b).astype(np.int64)
            size = first[key + 1] - first[key]
            query = np.repeat(np.arange(len(prints)), size)
            queries.append(query)
            found.append(places[np.arange(len(query)) + np.repeat(first[key] - (np.cumsum(size) - size), size)])
        return np.concatenate(queries), np.concatenate(found)

    def within(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every (query, fingerprint) pair within RADIUS bits, some of them more than once."""
        query, at = self.candidates(prints)
        near = np.bitwise_count(prints[query] ^ self.prints[at]) <= RADIUS
        return query[near], at[near]


class Index:
    """The items of one benchmark part: shingle filter, multi-indices and the items' words."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        self.items = []
        for item_id, text in items:
            words = words_of(text or "")
            if words:
                self.items.append((item_id, words, min(SHINGLE, len(words))))
        self.size = np.array([len(w) for _, w, _ in self.items], dtype=np.int64)
        self.k = np.array([k for _, _, k in self.items], dtype=np.int64)
        hashed = [shingle_hashes(hashes_of(w), k) for _, w, k in self.items]
        self.filters, self.holders = {}, {}
        for k in np.unique(self.k).tolist():
            own = [i for i in range(len(hashed)) if self.k[i] == k]
            h, size = np.concatenate([hashed[i] for i in own]), np.repeat(self.size[own], [len(hashed[i]) for i in own])
            order = np.lexsort((size, h))
            h, size = h[order], size[order]
            new = np.concatenate([[True], (h[1:] != h[:-1]) | (size[1:] != size[:-1])])
            self.holders[k] = h[new], size[new]
            self.filters[k] = np.zeros(1 << 20, dtype=bool)
            self.filters[k][(h & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        prints = [[simhash_windows(family(h, f), len(h))[0] for h in hashed] for f in range(FAMILIES)]
        self.families = [MultiIndex(np.array(p, dtype=np.uint64)) for p in prints]
        self.prints = self.families[0].prints

    def within(self, fp: int) -> list[int]:
        """Every item within RADIUS bits of a fingerprint of the first family."""
        return np.unique(self.families[0].within(np.array([fp], dtype=np.uint64))[1]).tolist()

    def spots(self, h: np.ndarray, k: int, n: int) -> dict[int, np.ndarray]:
        """Item size -> first words of the windows that hold a shingle of an item of that size, for a document of ``n`` words."""
        keys, sizes = self.holders[k]
        hits = np.flatnonzero(self.filters[k][(h & np.uint64((1 << 20) - 1)).astype(np.int64)])
        low, high = np.searchsorted(keys, h[hits], "left"), np.searchsorted(keys, h[hits], "right")
        known = high > low
        hits, low, count = hits[known], low[known], (high - low)[known]
        at = np.repeat(hits, count)
        size = sizes[np.arange(len(at)) + np.repeat(low - (np.cumsum(count) - count), count)]
        out = {}
        for s in np.unique(size).tolist():
            width, own = min(s, n), at[size == s]
            # Steps up and down of how many shingles call for a window that starts here.
            change = np.zeros(n - width + 2, dtype=np.int64)
            np.add.at(change, np.maximum(0, own + k - width), 1)
            np.add.at(change, np.minimum(own, n - width) + 1, -1)
            out[s] = np.flatnonzero(np.cumsum(change)[:-1] > 0)
        return out

    def matches(self, text: str) -> list[tuple[int, float, int, int]]:
        """(item, best similarity, first word and word count of the best window) of one document."""
        words = words_of(text)
        if not words:
            return []
        hashed, best = hashes_of(words), {}
        for k in self.filters:
            h = shingle_hashes(hashed, k)
            for size, starts in self.spots(h, k, len(words)).items():
                width = min(size, len(words))
                cuts = np.flatnonzero(np.diff(starts, prepend=starts[0]) > 1)
                for run in np.split(starts, cuts):
                    for at in range(0, len(run), RUN):
                        first, last = int(run[at]), int(run[min(at + RUN, len(run)) - 1])
                        self.verify(h[first : last + width - k + 1], first, size, k, words, width, best)
        return [(item, *found) for item, found in sorted(best.items())]

    def verify(self, h: np.ndarray, first: int, size: int, k: int, words: list[str], width: int, best: dict) -> None:
        """Compare the windows over the shingles ``h`` with the items of this size that are near in any family."""
        pairs = []
        for f, index in enumerate(self.families):
            window, item = index.within(simhash_windows(family(h, f), width - k + 1))
            fit = (self.size[item] == size) & (self.k[item] == k)
            pairs.append(window[fit] * len(self.items) + item[fit])
        for pair in np.unique(np.concatenate(pairs)).tolist():
            start, i = first + pair // len(self.items), pair % len(self.items)
            item_id, own, _ = self.items[i]
            s = similarity(shingles(words[start : start + width], k), shingles(own, k))
            if s >= SIMILARITY and s > best.get(item_id, (0.0,))[0]:
                best[item_id] = (s, start, width)


def benchmark_parts(benchmark: DataFrame, item_col: str, text_col: str) -> list[DataFrame]:
    """The benchmark in parts whose size is checked, each small enough to broadcast."""
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(text_col).alias("text"))
    said = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("size"), F.count(F.lit(1)).alias("n")).first()
    n = max(said["size"] // PART_BYTES, said["n"] // PART_ITEMS) + 1
    return [items.where(F.pmod(F.xxhash64("text"), F.lit(n)) == i) for i in range(n)]


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """``doc_id, item_id, similarity, start_word, n_words`` of every item found in a document.

    One row per row of ``docs`` and item whose best window has a similarity of SIMILARITY or
    more; clean documents have none. Items without words match nothing, items of fewer than
    SHINGLE words are one shingle; null and empty documents match nothing; repeated documents
    and repeated items each match; empty tables give an empty result; extra columns are
    ignored. A map over the documents without a shuffle.
    """
    texts, parts = texts_of(docs, id_col, text_col), []
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("similarity", pa.float64()), ("start_word", pa.int64()), ("n_words", pa.int64())])
    for part in benchmark_parts(benchmark, item_col, "text"):
        items = docs.sparkSession.sparkContext.broadcast([tuple(r) for r in part.where("text is not null").collect()])

        def run(batches, items=items, name=uuid.uuid4().hex):
            index = held(f"index {name}", lambda: Index(items.value))
            for batch in batches:
                rows = [(doc.as_py(), *m) for doc, text in zip(batch.column(0), batch.column(1)) for m in index.matches(text.as_py())]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        parts.append(texts.mapInArrow(run, "doc_id long, item_id long, similarity double, start_word long, n_words long"))
    found = parts[0]
    for p in parts[1:]:
        found = found.unionAll(p)
    return found


def keep_clean(docs: DataFrame, benchmark: DataFrame, item_col: str = "item_id") -> DataFrame:
    """The rows of ``docs`` that hold no item; every row is judged by its own text. Nulls and empty tables as in ``contaminated``."""
    for part in benchmark_parts(benchmark, item_col, "text"):
        items = docs.sparkSession.sparkContext.broadcast([tuple(r) for r in part.where("text is not null").collect()])

        def start(items=items, name=uuid.uuid4().hex):
            index = held(f"index {name}", lambda: Index(items.value))
            return lambda texts: [not index.matches(t) for t in texts]

        docs = keep_texts(docs, start)
    return docs
