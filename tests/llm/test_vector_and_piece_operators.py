"""Centroid clustering, byte-level BPE through a written model, and whitening: against the library and plain re-computations."""

import hashlib
import math
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from lumenpath.llm import centroids, piece_bpe, queries, vectors, whitening

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as f:
        ranks = piece_bpe.ranks_of(f.read())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    with open(RANKS, "rb") as f:
        return piece_bpe.PieceCodec(piece_bpe.serialise(piece_bpe.ranks_of(f.read())))


def encoded(codec, texts):
    ids, cuts = codec.encode(texts)
    spelled, ends = codec.decode(ids, cuts)
    return [ids[a:b].tolist() for a, b in zip(cuts, cuts[1:])], [spelled[a:b].tobytes() for a, b in zip(ends, ends[1:])]


def hostile(rng, n):
    parts = ["a", "the", "Straße", "'s", "'ll", "’", " ", "  ", "\n", "\n ", "\t", "\r\n", "\x85", "\xa0", " ", "　", "\x1c", "\x00", "12", "٣", "½", "汉字", "กำ", "हिन्दी", "🙂", "👩‍👩‍👧", "é", "é", "<|endoftext|>", "▁", "Ġ", "<unk>", "⁇", "!!", "()", "_", "﻿", "​", "\U0010ffff", "ﬁ", "İ"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(n)]


def test_ids_equal_the_library_on_hostile_texts(codec, library):
    rng = random.Random(3)
    texts = hostile(rng, 4000) + ["", " ", "  ", " a", "a ", "a  b", "\n a", "word" * 2000, " " * 3000, "\n" * 500 + "x", "é" * 1500]
    got, back = encoded(codec, texts)
    for text, ids, spelled in zip(texts, got, back):
        assert ids == library.encode_ordinary(text), ascii(text)
        assert spelled == text.encode()


def test_every_entry_is_a_piece_of_its_rank(codec, library):
    assert len(codec.model) == library.n_vocab + 1 and codec.model.unk_id() == library.n_vocab
    for i in range(0, library.n_vocab, 7):
        assert codec.bytes[codec.byte_at[i] : codec.byte_at[i + 1]].tobytes() == library.decode_single_token_bytes(i)
        assert codec.model.get_score(i) == -i


def test_slices_and_a_full_table_change_nothing(codec, library, monkeypatch):
    rng = random.Random(5)
    texts = [" ".join(hostile(rng, 60)) for _ in range(20)]
    monkeypatch.setattr(piece_bpe, "SLICE_CHARS", 50)
    small = piece_bpe.PieceCodec(codec.model.serialized_model_proto(), most=10_000)
    for _ in range(3):
        assert encoded(small, texts)[0] == [library.encode_ordinary(t) for t in texts]
        assert small.size() < 400_000


def test_a_gap_in_the_ranks_is_an_error():
    with pytest.raises(ValueError):
        piece_bpe.serialise({b"a": 0, b"b": 2})


def test_op12_over_odd_rows(spark, tmp_path, library):
    long = " ".join(f"word{i % 977}" for i in range(200_000)) + "x" * 300_000
    texts = [None, "", "one", "one", long, "Ein Text\n mit  Lücken "]
    spark.createDataFrame([(i if i else None, t, "en", "s", 1, 3, b"x") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long, n_tokens int, ids binary").write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op12_byte_bpe_encode_decode(spark, str(tmp_path))
    assert out.dtypes == [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        ids = library.encode_ordinary(t or "")
        assert got[i or None].n_tokens == len(ids)
        assert got[i or None].ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert got[i or None].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/none/documents.parquet")
    assert queries.op12_byte_bpe_encode_decode(spark, f"{tmp_path}/none").count() == 0


def embeddings(spark, folder, rows):
    spark.createDataFrame([(i, v, 1, 2, [3]) for i, v in rows], "vec_id long, embedding array<float>, label int, cluster int, x array<int>").write.parquet(f"{folder}/embeddings.parquet")
    return str(folder)


def as_floats(rows):
    return [(i, [float(np.float32(c)) for c in v]) for i, v in rows]


def plain_lloyd(rows, k=16, rounds=3):
    kept = [(i, [math.floor(64 * c) for c in v]) for i, v in rows if v is not None and len(v) == 64 and all(c is not None and math.isfinite(c) for c in v)]
    start = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    cents = [v for _, v in start]
    far = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b))
    nearest = lambda v: min((far(v, c), j) for j, c in enumerate(cents))
    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for j in range(len(cents)):
            mine = [v for (_, v), o in zip(kept, own) if o == j]
            if mine:
                cents[j] = [sum(col) // len(mine) for col in zip(*mine)]
    last = [(i, *nearest(v)[::-1]) for i, v in kept]
    within = {j: sum(d for _, o, d in last if o == j) for j in range(len(cents))}
    return sorted(((i, o, d, within[o], sum(within.values()), hashlib.sha256(",".join(map(str, cents[o])).encode()).hexdigest()) for i, o, d in last), key=str)


def odd_vectors(rng, n):
    near = [[rng.gauss(0, 0.2) for _ in range(64)] for _ in range(9)]
    rows = as_floats([(i, [c + rng.gauss(0, 0.1) for c in near[i % 9]]) for i in range(n)])
    rows += [(n + i, rows[3][1]) for i in range(40)] + [(7, rows[7][1]), (7, rows[8][1]), (None, rows[1][1])]
    bad = [None, [], [0.1] * 63, [0.1] * 65, [0.1] * 63 + [None], [float("nan")] + [0.1] * 63, [float("-inf")] * 64]
    return rows, [(5000 + i, v) for i, v in enumerate(bad)]


def test_op11_equals_plain_lloyd(spark, tmp_path):
    rows, bad = odd_vectors(random.Random(2), 400)
    out = queries.op11_centroid_clustering(spark, embeddings(spark, tmp_path, rows + bad))
    assert out.dtypes == [("vec_id", "bigint"), ("cluster", "int"), ("distance", "bigint"), ("cluster_inertia", "bigint"), ("inertia", "bigint"), ("centroid_sha256", "string")]
    assert sorted((tuple(r) for r in out.collect()), key=str) == plain_lloyd(rows + bad)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, [0.5] * 64)], [(1, [0.5] * 64)] * 3, [(1, [0.5] * 64), (2, [-0.5] * 64)]])
def test_op11_with_few_vectors(spark, tmp_path, rows):
    out = queries.op11_centroid_clustering(spark, embeddings(spark, tmp_path, rows))
    want = [] if all(i is None for i, _ in rows) else plain_lloyd(rows)
    assert sorted((tuple(r) for r in out.collect()), key=str) == want


def test_an_update_compares_as_a_full_round_does():
    rng = np.random.default_rng(4)
    for most in (6, 3_000_000, (1 << 27) - 1):
        x = rng.integers(-most, most, (300, 5))
        before, after = rng.integers(-most, most, (2, 12, 5))
        after[::3] = before[::3]
        own, was = centroids.first_owner(x, before)
        assert (was == [min(sum((int(p) - int(q)) ** 2 for p, q in zip(v, c)) for c in before) for v in x]).all()
        found = centroids.next_owner(x, own, was, after, (after != before).any(1))
        want = centroids.first_owner(x, after)
        assert (found[0] == want[0]).all() and (found[1] == want[1]).all()


def test_components_beyond_exact_integers_are_an_error(spark, tmp_path):
    folder = embeddings(spark, tmp_path, [(1, [0.5] * 63 + [1e9])])
    with pytest.raises(Exception, match="beyond exact integers"):
        queries.op11_centroid_clustering(spark, folder).collect()


def plain_whitening(rows):
    kept = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    once = sorted({tuple(v) for _, v in kept})
    n, sums = len(once), [sum(col) for col in zip(*once)]
    deviation = {v: sum((n * a - s) ** 2 for a, s in zip(v, sums)) for v in {tuple(v) for _, v in kept}}
    centred = np.array([[(n * a - s) / n for a, s in zip(v, sums)] for v in once])
    cov = centred.T @ centred / n
    values, vecs = np.linalg.eigh(cov)
    order = np.argsort(-values)
    return kept, n, sums, deviation, values[order], vecs[:, order], cov


def test_op13_equals_a_plain_whitening(spark, tmp_path):
    rows, bad = odd_vectors(random.Random(6), 300)
    bad = [b for b in bad if b[1] is None or len(b[1]) == 64]
    out = queries.op13_embedding_whitening(spark, embeddings(spark, tmp_path, rows + bad))
    assert out.dtypes == [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"), ("explained", "double"), ("identity_error", "double")]
    got = out.collect()
    kept, n, sums, deviation, values, vecs, cov = plain_whitening(rows + bad)
    assert len(got) == 16 * len(kept) and {r.n for r in got} == {n}
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    want = {}
    for i, v in kept:
        white = np.array([(n * a - s) / n for a, s in zip(v, sums)]) @ vecs[:, :16] / np.sqrt(values[:16])
        for c in range(16):
            want.setdefault((i, c + 1), []).append((deviation[tuple(v)], white[c]))
    signs = {}
    for r in got:
        assert abs(r.explained / (values[r.component - 1] / np.trace(cov)) - 1) < 1e-9
        near = [w for d, w in want[r.vec_id, r.component] if d == r.deviation and abs(abs(w) - abs(r.whitened)) < 1e-8]
        assert near
        if abs(r.whitened) > 1e-3:
            signs.setdefault(r.component, set()).add(any(math.copysign(1, w) == math.copysign(1, r.whitened) for w in near))
    assert all(len(s) == 1 for s in signs.values())


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [0.5, 0.25])] * 3, [(1, [0.0, 1.0]), (2, [1.0, 0.0]), (3, [0.1])], [(1, [float("nan")])]])
def test_op13_with_few_or_uneven_vectors(spark, tmp_path, rows):
    got = queries.op13_embedding_whitening(spark, embeddings(spark, tmp_path, rows)).collect()
    even = [r for r in rows if r[1] and len(r[1]) == 2]
    assert len(got) == 2 * len(even)
    if len(even) == 3:
        assert all(r.whitened is None and r.deviation == 0 and r.n == 1 for r in got)
    if len(even) == 2:
        assert {(r.component, round(abs(r.whitened), 9)) for r in got if r.component == 1} == {(1, 1.0)}
        assert all(r.whitened is None for r in got if r.component == 2)


def test_symmetric_qr_and_merged_moments():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 10, 64):
        a = rng.normal(size=(n, n))
        for m in (a + a.T, np.diag(np.repeat(rng.normal(size=(n + 1) // 2), 2)[:n]), np.zeros((n, n)), a @ a.T * 1e-12):
            values, vecs = whitening.symmetric_qr(m)
            assert np.allclose(values, np.linalg.eigvalsh(m)[::-1], atol=1e-12 * max(1, np.abs(m).max()))
            assert np.allclose(vecs.T @ vecs, np.eye(n), atol=1e-12) and np.allclose(m @ vecs, vecs * values, atol=1e-11 * max(1, np.abs(m).max()))
    x = rng.integers(-50, 50, (500, 7))
    total = whitening.Moments(7)
    for part in np.array_split(x, [0, 3, 3, 100, 499]):
        one = whitening.Moments(7)
        one.add(part)
        total.merge(one)
    assert total.n == 500 and list(total.sums) == x.sum(0).tolist()
    assert np.allclose(total.covariance(), np.cov(x.T, bias=True), rtol=1e-12)


def test_deviations_stay_exact_beyond_a_long():
    made = whitening.Whitener(2, 10**13, np.array([7, -(10**14)], dtype=object), np.ones(2), np.eye(2), 2.0)
    off = made.offsets(np.array([[3, -4]]))
    assert made.deviations(off).to_pylist() == [(3 * 10**13 - 7) ** 2 + (-4 * 10**13 + 10**14) ** 2]
    assert vectors.MOST == 1 << 27
