"""SimHash near-duplicates by a self-join of the binary trie of fingerprints.

Node pairs of the trie are traversed together, the differing bits on the way are summed,
and a pair is dropped as soon as they exceed the budget. The top of the trie is cut into
leaves of bounded size by a histogram of the first CUT_BITS bits, refined where a node holds
more. A leaf is one group of a Spark shuffle; two leaves within the budget meet in the group
of one of them, and the traversal of the pair goes on inside that group.
A group returns a spanning forest of the links it found, not all pairs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenpath.llm.common import map_texts, texts_of
from lumenpath.operators.components import connected_components
from lumenpath.session import checkpoint, small_table

SEED, RADIUS, SHINGLE = 42, 2, 3
CUT_BITS, FINE_BITS, LEAF, BLOCK = 16, 4, 65_536, 200_000
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingle_hashes(text: str, words: int = SHINGLE) -> list[int]:
    """XXH64 of every word shingle of a text, repeats included; of the whole sequence if it has fewer words; none without words."""
    digest, parts = xxhash.xxh64_intdigest, text.encode().translate(LOWER).split()
    flat = b" ".join(parts)
    if len(parts) <= words:
        return [digest(flat, SEED)] if parts else []
    ends, at = [], -1
    for p in parts:
        at += len(p) + 1
        ends.append(at)
    starts = [0, *[e + 1 for e in ends[:-words]]]
    return [digest(flat[s:e], SEED) for s, e in zip(starts, ends[words - 1 :])]


def majority(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The 64-bit SimHash of each run of ``sizes`` hashes; of an empty run, 0."""
    out, full = np.zeros(len(sizes), dtype=np.uint64), np.flatnonzero(sizes)
    if len(full):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
        ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        out[full] = np.packbits(ones * 2 > sizes[full][:, None], axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def fingerprints_of(texts: list[str], words: int = SHINGLE) -> np.ndarray:
    """64-bit SimHash (uint64) of each text over its word shingles, repeats included."""
    hashes = [shingle_hashes(t, words) for t in texts]
    sizes = np.array([len(h) for h in hashes], dtype=np.int64)
    return majority(np.array([x for h in hashes for x in h], dtype=np.uint64), sizes)


def simhashes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp`` (long with the 64 bits) of every whole text; null and empty texts have 0."""
    return map_texts(texts_of(docs, id_col, text_col), "doc_id long, fp long", [("fp", pa.int64())], lambda texts: [fingerprints_of(texts).view(np.int64)])


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


def cut_node(counts: np.ndarray, leaf: int) -> list[tuple[int, int, int]]:
    """Leaves (start, depth, count) of a node whose descendants at the lowest depth have these counts: split while over ``leaf``."""
    bits, total, out, stack = int(len(counts)).bit_length() - 1, np.concatenate([[0], np.cumsum(counts)]), [], [(0, 0)]
    while stack:
        start, depth = stack.pop()
        width = 1 << (bits - depth)
        n = int(total[start + width] - total[start])
        if depth == bits or n <= leaf:
            out.append((start, depth, n))
        else:
            stack += [(start, depth + 1), (start + width // 2, depth + 1)]
    return out


def cut_leaves(fps: DataFrame, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """(first fingerprint, depth) of every leaf, in order; together they cover all fingerprints.

    The first histogram has 2**CUT_BITS counts. Nodes that are still over ``leaf`` are counted
    FINE_BITS deeper, and so on: there are at most n / leaf of them, so the driver gets no more
    than 2**FINE_BITS * n / leaf counts a round.
    """
    done, heavy, depth, step = [], [0], 0, CUT_BITS
    while heavy:
        part = fps
        if depth:
            nodes = small_table(fps.sparkSession, [(h >> (64 - depth),) for h in heavy], {"node": "long"})
            part = fps.join(nodes, F.shiftrightunsigned("fp", 64 - depth) == F.col("node"), "left_semi")
        counts = {h: np.zeros(1 << step, dtype=np.int64) for h in heavy}
        below = 64 - depth - step
        for row in part.groupBy(F.shiftrightunsigned("fp", below).alias("p")).count().collect():
            p = (row["p"] & (1 << 64) - 1) << below & (1 << 64) - 1
            node = p >> (64 - depth) << (64 - depth) if depth else 0
            counts[node][(p ^ node) >> below] = row["count"]
        deeper = []
        for h in heavy:
            for start, d, n in cut_node(counts[h], leaf):
                first = h | start << below
                if n > leaf and below:
                    deeper.append(first)
                else:
                    done.append((first, depth + d))
        heavy, depth, step = deeper, depth + step, FINE_BITS
    done.sort()
    return np.array([s for s, _ in done], dtype=np.uint64), np.array([d for _, d in done], dtype=np.int64)


def leaf_of(leaves: tuple[np.ndarray, np.ndarray], fp: np.ndarray) -> np.ndarray:
    return np.searchsorted(leaves[0], fp, "right") - 1


def near_leaves(leaves: tuple[np.ndarray, np.ndarray], at: int, radius: int) -> np.ndarray:
    """Leaves that differ from leaf ``at`` in at most ``radius`` of the bits that both fix, itself included."""
    start, depth = leaves[0][at], int(leaves[1][at])
    flips = [sum(1 << (63 - b) for b in bits) for r in range(radius + 1) for bits in combinations(range(depth), r)]
    low = start ^ np.array(flips, dtype=np.uint64)
    high = low | np.uint64((1 << (64 - depth)) - 1)
    spans = np.unique(np.stack([leaf_of(leaves, low), leaf_of(leaves, high)], 1), axis=0)
    return np.unique(np.concatenate([np.arange(a, b + 1) for a, b in spans]))


def meeting(leaves: tuple[np.ndarray, np.ndarray], at: int, others: np.ndarray) -> np.ndarray:
    """In which leaf's group the two leaves of each pair (at, other) meet: the same for (other, at).

    It is the deeper leaf, so that what a group is sent stays bounded where one region of
    the trie holds most fingerprints; of equally deep ones a hash decides.
    """
    low, high = np.minimum(at, others), np.maximum(at, others)
    by_hash = np.where(((low * 2654435761 + high * 40503) >> 7) & 1, high, low)
    depth, own = leaves[1][others], leaves[1][at]
    return np.where(depth > own, others, np.where(depth < own, at, by_hash))


class Forest:
    """Union-find over positions."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        for x, y in zip(a.tolist(), b.tolist()):
            x, y = self.root(x), self.root(y)
            if x != y:
                self.up[max(x, y)] = min(x, y)


def traverse(a: np.ndarray, b: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """Spanning links (pairs of fingerprints) within ``radius`` between sorted distinct arrays, or inside ``a``.

    A frontier holds node pairs as ranges of both arrays at one depth. It is worked off in
    blocks, deepest first, so that memory stays bounded.
    """
    inner, b = b is None, a if b is None else b
    ones_a = [None] * 64
    ones_b = ones_a if inner else [None] * 64

    def ones(cache: list, x: np.ndarray, t: int) -> np.ndarray:
        if cache[t] is None:
            cache[t] = np.concatenate([[0], np.cumsum((x >> np.uint64(63 - t)) & np.uint64(1), dtype=np.int64)]).astype(np.int32)
        return cache[t]

    forest = Forest(len(a) + (0 if inner else len(b)))
    shift = 0 if inner else len(a)
    one = lambda *v: np.array([v], dtype=np.int32)
    stack = [(0, one(0, len(a), 0, len(b), 0))] if len(a) and len(b) else []
    while stack:
        t, front = stack.pop()
        if len(front) > BLOCK:
            stack += [(t, front[i : i + BLOCK]) for i in range(0, len(front), BLOCK)]
            continue
        na, nb = front[:, 1] - front[:, 0], front[:, 3] - front[:, 2]
        small = (na.astype(np.int64) * nb <= 4) | (t == 64)
        if small.any():
            s, na, nb = front[small], na[small], nb[small]
            reps = na.astype(np.int64) * nb
            row = np.repeat(np.arange(len(s)), reps)
            k = np.arange(len(row)) - np.repeat(np.cumsum(reps) - reps, reps)
            i, j = s[row, 0] + k // nb[row], s[row, 2] + k % nb[row]
            near = popcount(a[i] ^ b[j]) <= radius
            near &= (i < j) if inner else True
            forest.link(i[near], j[near] + shift)
            front = front[~small]
        if not len(front):
            continue
        oa, ob = ones(ones_a, a, t), ones(ones_b, b, t)
        al, ah, bl, bh, err = front.T
        am, bm = ah - (oa[ah] - oa[al]), bh - (ob[bh] - ob[bl])
        same = (al == bl) & (ah == bh) if inner else np.zeros(len(front), dtype=bool)
        kids = np.concatenate([
            np.stack([al, am, bl, bm, err], 1),
            np.stack([am, ah, bm, bh, err], 1),
            np.stack([al, am, bm, bh, err + 1], 1),
            np.stack([am, ah, bl, bm, err + 1], 1)[~same],
        ])
        stack.append((t + 1, kids[(kids[:, 1] > kids[:, 0]) & (kids[:, 3] > kids[:, 2]) & (kids[:, 4] <= radius)]))
    value = lambda i: int(a[i] if inner or i < shift else b[i - shift])
    return [(value(forest.root(i)), value(i)) for i in range(len(forest.up)) if forest.up[i] != i]


def trie_links(fps: DataFrame, radius: int = RADIUS, leaf: int = LEAF) -> DataFrame:
    """``src, dst`` fingerprints: links within ``radius`` that connect what the full set of links connects.

    ``fps(fp)`` must be distinct. A fingerprint goes to its own leaf and to those near ones
    where the two leaves meet, about 1 + d/2 + d(d-1)/4 groups for d bits of depth, which
    grows with the square of the logarithm of the input over the size of a leaf. Every pair
    within the radius meets in exactly one group, and no group has more than the leaves
    within the radius of one leaf, none of them over ``leaf`` fingerprints.
    """
    cut = fps.sparkSession.sparkContext.broadcast(cut_leaves(fps, leaf))

    def deal(batches):
        leaves, near = cut.value, {}
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            home = leaf_of(leaves, fp.view(np.uint64))
            for h in np.unique(home).tolist():
                if h not in near:
                    others = near_leaves(leaves, h, radius)
                    others = others[others != h]
                    near[h] = np.append(h, others[meeting(leaves, h, others) != h])
                own, groups = fp[home == h], near[h]
                n, m = len(own), len(groups)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(groups, n)), pa.array(np.tile(own, m))], names=["leaf", "fp"])

    def join(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        fp, p = np.sort(group["fp"].to_numpy().view(np.uint64)), int(key[0])
        home = leaf_of(cut.value, fp)
        own, forest = fp[home == p], Forest(len(fp))
        for q in [p, *np.unique(home[home != p]).tolist()]:
            found = np.array(traverse(own, None if q == p else fp[home == q], radius), dtype=np.uint64).reshape(-1, 2)
            at = np.searchsorted(fp, found)
            forest.link(at[:, 0], at[:, 1])
        links = np.array([(forest.root(i), i) for i, up in enumerate(forest.up) if up != i], dtype=np.int64).reshape(-1, 2)
        return pd.DataFrame(fp[links].view(np.int64), columns=["src", "dst"])

    dealt = fps.select("fp").mapInArrow(deal, "leaf long, fp long")
    return dealt.groupBy("leaf").applyInPandas(join, "src long, dst long")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id, n_copies`` of every whole text.

    ``component_id`` is the smallest id reachable over links of at most ``radius`` differing
    bits. Rows with equal fingerprints are one node, so copies are never paired; the result
    has one row per input row, repeated rows included. Null and empty texts share fingerprint
    0; null ids take part but are never a component's name unless it has no other; an empty
    table stays empty; extra columns are ignored.
    """
    prints = checkpoint(simhashes(docs, id_col, text_col))
    nodes = checkpoint(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n_copies")))
    parts = connected_components(trie_links(nodes.select("fp"), radius))
    placed = nodes.join(parts, nodes.fp == parts.node, "left").select("fp", "first", "n_copies", F.coalesce("component", "fp").alias("part"))
    names = placed.groupBy("part").agg(F.min("first").alias("component_id"))
    classes = placed.join(names, "part").select(F.col("fp").alias("node_fp"), "component_id", "n_copies")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return prints.join(classes, prints.fp == classes.node_fp).select("doc_id", hexed.alias("fingerprint"), "component_id", "n_copies")


def keep_first(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one document of each group: the one whose id names the group.

    Rows with a null id cannot be told apart and stay; of rows that repeat an id all stay.
    """
    gone = near_duplicates(docs, radius).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")
