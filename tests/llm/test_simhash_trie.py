import random
import re

import numpy as np
import xxhash

from lumenpath.llm import simhash_trie as st


def brute_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    s = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)]
    h = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in s]
    return sum(1 << j for j in range(64) if 2 * sum(x >> j & 1 for x in h) > len(h))


def classes(values, radius=2):
    up = {v: v for v in values}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in values:
        for b in values:
            if a < b and (a ^ b).bit_count() <= radius:
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {v: root(v) for v in values}


def family(rng, seeds, near):
    out = set()
    for _ in range(seeds):
        v = rng.getrandbits(64)
        for _ in range(near):
            out.add(v)
            v ^= 1 << rng.randrange(64)
    return sorted(out)


def test_fingerprints_equal_the_definition():
    rng = random.Random(1)
    texts = ["", "   ", "One", "one TWO", "a b c", "É É ü  x", *[" ".join(rng.choice(["a", "Bc", "é", "dd\t", "x\n"]) for _ in range(n)) for n in range(3, 60)]]
    assert [int(x) for x in st.fingerprints_of(texts)] == [brute_print(t) for t in texts]


def test_trie_links_with_forced_splits_equal_brute_force(spark):
    values = family(random.Random(3), 60, 8)
    fps = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "fp long")
    for leaf in (4, 50, 10_000):
        links = [(int(np.int64(r.src).view(np.uint64)), int(np.int64(r.dst).view(np.uint64))) for r in st.trie_links(fps, 2, leaf).collect()]
        assert all((a ^ b).bit_count() >= 1 for a, b in links)
        up = {v: v for v in values}

        def root(x):
            while up[x] != x:
                x = up[x]
            return x

        for a, b in links:
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
        want, got = classes(values), {v: root(v) for v in values}
        assert {v: min(k for k in values if want[k] == want[v]) for v in values} == {v: min(k for k in values if got[k] == got[v]) for v in values}


def test_a_crowded_prefix_is_cut_into_bounded_leaves(spark):
    rng = random.Random(9)
    crowd = {(0xBEEF << 48) | rng.getrandbits(24) for _ in range(600)} | {(0xBEEF << 48) | (1 << 50) | rng.getrandbits(24) for _ in range(40)}
    values = sorted(crowd | {rng.getrandbits(64) for _ in range(300)})
    fps = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "fp long")
    leaves = st.cut_leaves(fps, 32)
    assert np.bincount(st.leaf_of(leaves, np.array(values, dtype=np.uint64))).max() <= 32
    assert leaves[1].max() > 40
    for i in range(len(leaves[0])):
        common = np.minimum(leaves[1], leaves[1][i])
        fixed = [(int(s) ^ int(leaves[0][i])) >> (64 - int(c)) if c else 0 for s, c in zip(leaves[0], common)]
        near = [j for j, x in enumerate(fixed) if x.bit_count() <= 2]
        assert st.near_leaves(leaves, i, 2).tolist() == near
        others = np.array([j for j in near if j != i])
        assert all(st.meeting(leaves, int(j), np.array([i]))[0] == m for j, m in zip(others, st.meeting(leaves, i, others)))
    up = {v: v for v in values}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for r in st.trie_links(fps, 2, 32).collect():
        a, b = sorted((root(int(np.int64(r.src).view(np.uint64))), root(int(np.int64(r.dst).view(np.uint64)))))
        up[b] = a
    assert {v: root(v) for v in values} == classes(values)


def test_documents_with_nulls_ties_and_clashing_columns(spark):
    rows = [(1, "a b c d", 9), (2, "A B c  d", 9), (3, None, 9), (4, "", 9), (5, "other words here now", 9), (5, "other words here now", 9), (None, "a b c d", 9)]
    out = st.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, fp int")).collect()
    assert len(out) == 7
    by = {r.doc_id: r for r in out}
    assert by[1].component_id == by[2].component_id == by[None].component_id == 1
    assert by[3].fingerprint == "0" * 16 and by[3].component_id == by[4].component_id == 3
    assert by[5].component_id == 5
    assert st.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
