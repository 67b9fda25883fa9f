import math
import random

import numpy as np

from lumenpath.llm import near_copies, shingles, simhash_trie


def brute(texts):
    sets = [set(near_copies.shingle_set(t or "").tolist()) for t in texts]
    up = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if sets[i] == sets[j] or len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9:
                low, high = sorted((up[i], up[j]))
                up = [low if u == high else u for u in up]
    return set(up)


def test_the_pipeline_drops_near_copies_of_similarity_080(spark):
    import corpus_pipeline

    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(3000)}"
    texts = [None, "", "one two", "ONE  two", "one two three"]
    for _ in range(12):
        base = [word() for _ in range(rng.choice([30, 120, 300]))]
        texts.append(" ".join(base))
        for edits in (0, 1, 2, 4, 8, 30):
            copy = list(base)
            for at in rng.sample(range(len(copy)), min(edits, len(copy) // 3)):
                copy[at] = word()
            texts.append(" ".join(copy))
    body = [word() for _ in range(200)]
    texts += [" ".join([*body[:i], word(), *body[i + 1 :]]) for i in range(60)]  # a large group of near copies
    passage = [word() for _ in range(150)]
    texts += [" ".join([*passage, *[word() for _ in range(60)]]) for _ in range(20)]  # a common passage, similarity below 0.8
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars int")
    got = {r.doc_id for r in corpus_pipeline.keep_one_of_near_copies(spark, docs, "").collect()}
    assert got == brute(texts) and len(got) < len(set(texts)) - 80


def edited(rng, words, share, word):
    """A copy with a run replaced, one cut off, one put in, or single words changed, at about ``share`` of the text."""
    n, kind = max(1, int(share * len(words))), rng.randrange(4)
    at = rng.randrange(len(words) - n + 1)
    if kind == 0:
        return words[:at] + [word() for _ in range(n)] + words[at + n :]
    if kind == 1:
        return words[:at] + words[at + n :]
    if kind == 2:
        return words[:at] + [word() for _ in range(n)] + words[at:]
    spots = set(rng.sample(range(len(words)), max(1, n // 5)))
    return [word() if i in spots else w for i, w in enumerate(words)]


def test_every_similar_pair_shares_a_key_in_front():
    rng, sketch = random.Random(8), np.random.default_rng(2).integers(1, 6, 1 << 16).astype(np.uint32)
    word = lambda: f"w{rng.randrange(10**6)}"
    seen = {False: 0, True: 0}

    def extra(n):
        return near_copies.extra_of(n, 0.8)

    while min(seen.values()) < 400:
        base = [word() for _ in range(rng.choice([8, 20, 60, 150, 290, 330, 800, 3000]))]
        a, b = (near_copies.shingle_set(" ".join(t)) for t in (base, edited(rng, base, rng.choice([0.02, 0.08, 0.15, 0.22]), word)))
        common = len(np.intersect1d(a, b))
        if common < 0.8 * (len(a) + len(b) - common) - 1e-9:
            continue
        (ka, pa), (kb, pb) = near_copies.keys_of(a, sketch), near_copies.keys_of(b, sketch)
        room = min(extra(len(a)), extra(len(b))) - math.ceil(0.8 / 1.8 * (len(a) + len(b)) - 1e-9)
        place = dict(zip(kb.tolist(), pb.tolist()))
        assert any(k in place and i < len(a) + room and place[k] < len(b) + room for k, i in zip(ka.tolist(), pa.tolist()))
        seen[max(len(a), len(b)) > near_copies.SAMPLE] += 1


def test_texts_that_share_half_their_words_are_not_paired(spark, monkeypatch):
    asked, verified = [], near_copies.verified

    def counted(pairs, *rest):
        asked.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(near_copies, "verified", counted)
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(50_000)}"
    passage = [word() for _ in range(100)]
    texts = [" ".join([*passage, *[word() for _ in range(100)]]) for _ in range(2_000)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    assert near_copies.keep_first(docs).count() == 2_000
    assert sum(asked) <= 3 * 2_000


def test_a_group_of_edited_copies_is_not_paired_within_itself(spark, monkeypatch):
    asked, verified = [], near_copies.verified

    def counted(pairs, *rest):
        asked.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(near_copies, "verified", counted)
    rng = random.Random(9)
    base = [f"w{rng.randrange(50_000)}" for _ in range(300)]
    texts = [" ".join(base)]
    for i in range(1_500):
        spots = set(rng.sample(range(300), 1 + i % 5))
        texts.append(" ".join(f"x{rng.randrange(10**6)}" if k in spots else w for k, w in enumerate(base)))
    docs = spark.createDataFrame([(i, t, 3) for i, t in enumerate(texts)], "doc_id long, text string, node int")
    assert [r.doc_id for r in near_copies.keep_first(docs).collect()] == [0]
    assert sum(asked) <= 5 * 1_501


def test_odd_rows(spark):
    long = " ".join(f"word{i}" for i in range(300_000))
    rows = [(1, None), (2, ""), (3, " \n "), (None, "a b c"), (4, "a  b\tc"), (4, "another text of this id"), (5, "x" * 300_000), (6, "x" * 300_000 + " "), (7, long), (8, long + " more"), (9, "a"), (9, "a")]
    docs = spark.createDataFrame([(*r, "k", "p") for r in rows], "doc_id long, text string, key string, part string")
    kept = near_copies.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, (r.text or "")[:9]) for r in kept.collect()) == [(1, ""), (4, "a  b\tc"), (4, "another t"), (5, "x" * 9), (7, "word0 wor"), (9, "a")]
    assert near_copies.keep_first(docs.limit(0)).count() == 0


def test_runs_do_not_depend_on_batches_or_pieces(monkeypatch):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["a", "B", "cc", "\n", "é", "x" * 70]) for _ in range(rng.randrange(60))) for _ in range(40)]
    want = [shingles.shingle_runs([t], 5)[0].tolist() for t in texts]
    assert [r.tolist() for r in shingles.shingle_runs(texts, 5)] == want
    assert all(len(r) == max(len(w) - 4, min(1, len(w))) for r, w in zip(want, (t.lower().split() for t in texts)))
    monkeypatch.setattr(shingles, "PASS_BYTES", 30)
    assert [r.tolist() for r in shingles.shingle_runs(texts, 5)] == want
    run = np.random.default_rng(1).integers(0, 1 << 64, 20_001, dtype=np.uint64)
    assert shingles.simhash(run) == int(simhash_trie.majority(run, np.array([len(run)]))[0]) and shingles.simhash(run[:0]) == 0


def test_pairs_that_share_too_few_keys_are_not_hashed_again(spark):
    """A rare key in common is no candidate yet; near copies are."""
    from pyspark.sql import functions as F

    from lumenpath.session import checkpoint

    rng = random.Random(3)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    line, own = words(8), words(100)
    texts = [" ".join(words(60) + line + words(60)) for _ in range(30)] + [" ".join(own), " ".join(own[:-3])]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    nodes = checkpoint(near_copies.described(docs, 5, 0.8))
    every = nodes.select(F.col("node").alias("src"), F.col("key.doc_id").alias("i")).crossJoin(nodes.select(F.col("node").alias("dst"), F.col("key.doc_id").alias("j"))).where("i < j")
    left = near_copies.likely(every.select("src", "dst"), nodes, 0.8)
    by_node = {r.node: r.key.doc_id for r in nodes.collect()}
    assert {(by_node[r.src], by_node[r.dst]) for r in left.collect()} == {(30, 31)}


def test_the_last_step_shuffles_the_texts_once(spark, tmp_path):
    from pyspark.sql import functions as F

    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *[F.hash("id", F.lit(k)) for k in range(30)]).alias("text"))
    docs.write.parquet(f"{tmp_path}/docs")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = near_copies.keep_first(spark.read.parquet(f"{tmp_path}/docs"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # One for the texts, one for the keys that stay.
    assert plan.count("Exchange hashpartitioning") == 2


def test_many_pairs_a_set_are_joined_in_parts(spark, monkeypatch):
    """More pairs than PAIRS_A_SET for each set are worked off one part after another, with the same links."""
    from lumenpath.session import checkpoint

    rng = random.Random(6)
    base = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    texts = [" ".join([*base[: 200 - 5 * (i % 4)], f"x{i}"]) for i in range(10)] + [" ".join(rng.sample(base, 200)) for _ in range(2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    nodes = checkpoint(near_copies.described(docs, 5, 0.8))
    ids = [r.node for r in nodes.select("node").collect()]
    pairs = checkpoint(spark.createDataFrame([(a, b) for a in ids for b in ids if a < b], "src long, dst long"))
    sizes, alike = [], near_copies.alike

    def counted(part, *rest):
        sizes.append(part.count())
        return alike(part, *rest)

    monkeypatch.setattr(near_copies, "alike", counted)
    got = {tuple(r) for r in near_copies.verified(pairs, nodes, docs, 5, 0.8).collect()}
    node = {r.key.doc_id: r.node for r in nodes.collect()}
    sets = [set(near_copies.shingle_set(t).tolist()) for t in texts]
    near = lambda i, j: len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
    assert got == {tuple(sorted((node[i], node[j]))) for i in range(12) for j in range(i) if near(i, j)} and len(got) == 45
    assert len(sizes) > 1 and max(sizes) < sum(sizes)
