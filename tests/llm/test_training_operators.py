import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lumenpath.llm import bpe_automaton, decontaminate, language_id, quality, sstable, syncmers, token_counts, toxicity, url_rules
from lumenpath.llm.queries import vocabulary

WORD, BYTE = vocabulary("word_bpe_49k.json"), vocabulary("byte_bpe_50k.json")
ODD = ["", " \n", "Hello  world's 12", "ΑΣ Σ ΌΣΟΣ İ ½ x²", "a<|endoftext|>b <|startoftext|>", "é\x1cfoo b\x85c", "x" * 3000, "日本語 テキスト", "á é"]


def texts():
    rng = random.Random(5)
    return ODD + ["".join(rng.choice("abehiln's<|>12 \n\té　") for _ in range(200)) for _ in range(60)]


def frame(spark, given, extra="n_tokens long"):
    rows = [(i, t, 0) for i, t in enumerate(given)] + [(900, None, 0), (901, "same", 0), (901, "same", 0), (None, "no id", 0)]
    return spark.createDataFrame(rows, f"doc_id long, text string, {extra}")


def test_automaton_equals_library(spark):
    tok, given = Tokenizer.from_file(WORD), texts()
    out = bpe_automaton.encode_decode(frame(spark, given), WORD).collect()
    assert len(out) == len(given) + 4
    for r in out:
        text = given[r.doc_id] if r.doc_id is not None and r.doc_id < len(given) else {900: "", 901: "same", None: "no id"}[r.doc_id]
        ids = tok.encode(text, add_special_tokens=False).ids
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.decoded == tok.decode(ids, skip_special_tokens=False)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert bpe_automaton.encode_decode(frame(spark, []).limit(0), WORD).count() == 0


def test_counts_by_spliced_chunks_equal_library(spark):
    tok, given = Tokenizer.from_file(BYTE), texts()
    counts = token_counts.UnitCounts(open(BYTE, encoding="utf-8").read())
    for t in given:
        if "<|" not in t and "\x1c" not in t:
            assert token_counts.count_spliced(counts, t, 30, 4)[0] == len(tok.encode(t, add_special_tokens=False).ids)
    long = "word and more " * 9000
    out = {r.doc_id: r for r in token_counts.token_counts(frame(spark, [*given, long]), BYTE).collect()}
    for i, t in enumerate([*given, long]):
        assert out[i].n_tokens == len(tok.encode(t, add_special_tokens=False).ids) and out[i].n_bytes == len(t.encode())
    assert out[len(given)].n_chunks > 1 and out[900].n_tokens == 0


def test_shards_round_trip_and_lookup(spark, tmp_path):
    tok, given = Tokenizer.from_file(WORD), texts()
    df = frame(spark, given).repartition(3)
    folder = f"file://{tmp_path}"
    manifest = sstable.write_shards(df, WORD, folder, 1)
    rows = sstable.read_shards(manifest, folder).orderBy("start").collect()
    assert len(rows) == len(given) + 4 and rows[0].doc_id is None
    at = 0
    for r in rows:
        text = given[r.doc_id] if r.doc_id is not None and r.doc_id < len(given) else {900: "", 901: "same", None: "no id"}[r.doc_id]
        ids = np.array([*tok.encode(text, add_special_tokens=False).ids, 1], dtype="<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    paths = [r.path for r in manifest.collect()]
    assert len(sstable.lookup(folder, paths, 901)) == 2 and sstable.lookup(folder, paths, 12345) == []
    assert sstable.encode_to_shards(frame(spark, []).limit(0), WORD).count() == 0


def test_edited_texts_and_likeness(spark):
    given = ["one two three four five six seven eight " * 5, "nine ten eleven twelve thirteen " * 7, "", "é" * 9, "a b"]
    rows = [(i, t) for i, t in enumerate(given)] + [(7, None), (8, given[0])]
    out = {r.doc_id: r for r in syncmers.fingerprint_with_edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    order = sorted(((i, t or "") for i, t in rows), reverse=True)
    for k, (i, t) in enumerate(order):
        half, nxt = len(t) // 2, order[(k + 1) % len(order)][1]
        assert out[i].edited_sha256 == hashlib.sha256((t[: len(t) - half] + nxt[:half]).encode()).hexdigest()
        assert out[i].n_chars == len(t) and 0 <= out[i].near_edited <= 1
    assert out[0].fingerprint == out[8].fingerprint and out[2].fingerprint == out[7].fingerprint == ""
    twice = spark.createDataFrame([(1, "x y z w"), (1, "x y z w"), (1, "other")], "doc_id long, text string")
    assert syncmers.fingerprint_with_edits(twice).count() == 3
    assert syncmers.fingerprint_with_edits(twice.limit(0)).count() == 0


def test_syncmers_are_context_free(spark):
    inner = "red green blue black white grey pink brown violet orange"
    df = spark.createDataFrame([(1, inner), (2, "before it " + inner + " and after")], "id long, text string")
    got = {r.id: {a["hash"] for a in r.a} for r in df.select("id", syncmers.anchors(F.col("text")).alias("a")).collect()}
    assert got[1] and got[1] <= got[2]


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randrange(8, 60)))) for i in range(25)] + [(90, None), (91, ""), (92, "two words")]
    docs = []
    for i in range(80):
        words = [rng.choice(vocab) for _ in range(rng.randrange(0, 200))]
        if i % 2:
            item = rng.choice(items[:25])[1].upper().split()
            if i % 4 == 1:
                item[rng.randrange(len(item))] = "changed"
            words[rng.randrange(len(words) + 1) :] += item
        docs.append((i, " ".join(words)))
    docs += [(500, None), (501, ""), (502, "here are Two, words!"), (503, "two")]
    # Documents of fewer words than the item: most of it and nothing else.
    docs += [(600 + i, " ".join(t.split()[: -(-len(t.split()) * 19 // 20)])) for i, t in items[:25]]
    want = set()
    for d, text in docs:
        words = decontaminate.words_of(text or "")
        for item, t in items:
            own = decontaminate.words_of(t or "")
            k, n = min(5, len(own)), min(len(own), len(words))
            for s in range(len(words) - n + 1) if own else ():
                if decontaminate.similarity(decontaminate.shingles(words[s : s + n], k), decontaminate.shingles(own, k)) >= 0.8:
                    want.add((d, item))
    out = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in out} == want and (502, 92) in want
    assert sum(d >= 600 for d, _ in want) > 5
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert decontaminate.contaminated(empty, spark.createDataFrame(items, "item_id long, text string")).count() == 0


def test_multi_index_finds_all_within_radius():
    rng = random.Random(4)
    index = decontaminate.Index([(i, " ".join(f"v{rng.randrange(99)}" for _ in range(30))) for i in range(60)])
    for _ in range(200):
        fp = int(index.prints[rng.randrange(60)]) ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 26)))
        assert sorted(index.within(fp)) == [i for i, p in enumerate(index.prints.tolist()) if (p ^ fp).bit_count() <= decontaminate.RADIUS]


def test_language_id_cases(spark):
    rows = [(i, w * 6, g) for i, (w, g) in enumerate([("the cat and the dog ", "en"), ("der Hund und die Katze ", "de")] * 20)]
    rows += [(100, None, "en"), (101, "123 !?", "de"), (102, "the dog the dog", None)]
    out = {r.doc_id: r for r in language_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(out[i].lang_pred == g for i, _, g in rows[:40]) and out[102].lang_pred == "en"
    assert out[100].lang_pred == out[101].lang_pred == "und" and out[101].score == 0
    assert language_id.identify(spark.createDataFrame([], "doc_id long, text string, lang string")).count() == 0


def test_one_text_scores_alike_alone_and_in_a_batch():
    langs, table = ["a", "b"], np.random.default_rng(0).normal(size=(language_id.FEATURES, 2)).astype(np.float32)
    given = ["first text", "", "zweiter Text ü", "3"]
    assert language_id.score(given, langs, table)[0] == [language_id.score([t], langs, table)[0][0] for t in given]
    x, first = quality.passages(given + ["w " * 200])
    for i, t in enumerate(given + ["w " * 200]):
        assert np.allclose(x[first[i] : first[i + 1]], quality.passages([t])[0])


@pytest.mark.parametrize("op,label", [(toxicity.toxicity, "toxic"), (quality.quality, "quality")])
def test_classifiers_learn_and_take_odd_input(spark, op, label):
    rows = [(i, ("you are an idiot clown " if i % 2 else "a fine day for a walk ") * 5) for i in range(400)] + [(900, None), (901, "")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)] + [(None, 1), (3, None)], f"doc_id long, {label} int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in op(docs, labels).collect()}
    assert len(out) == 402 and sum(out[i].predicted == i % 2 for i in range(400)) >= 396
    assert 0 <= out[900].score <= 1 and out[900].score == out[901].score
    assert op(docs, labels.limit(0)).count() == 402 and op(docs.limit(0), labels).count() == 0


def test_attention_gradients():
    rng = np.random.default_rng(3)
    p = {k: rng.normal(0, 0.3, s) for k, s in quality.Attention.SHAPES.items()}
    x, first, y = rng.normal(size=(9, quality.FEATURES)), np.array([0, 4, 9]), np.array([0.0, 1.0])

    def loss():
        s = quality.Attention(p).forward(x, first)["s"]
        return -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s))

    grads = quality.Attention(p).gradients(x, first, y)
    for k in ("we", "wv", "wu", "wa", "wo"):
        i = tuple(0 for _ in p[k].shape)
        p[k][i] += 1e-5
        up = loss()
        p[k][i] -= 2e-5
        down = loss()
        p[k][i] += 1e-5
        assert abs((up - down) / 2e-5 - grads[k][i]) < 1e-5


def brute_rule(host, path):
    fit = [(len(h) + len(p), h + p, v) for h, p, v in url_rules.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


def test_url_rules_and_mined_rules(spark):
    urls = ["HTTP://Blog.Example.NET/en/1?x", "http://example.net/de/1", "http://x.net", "http://notexample.com/de/", "https://a.example.com/de/2#t", "http://example.org/fr/", "no scheme", None, "", "http://", "http://Ünï.org/FR/?://b"]
    rows = [(i, u, "extra") for i, u in enumerate(urls)] + [(i, f"http://{'spam' if i % 2 else 'good'}.site.com/en/{i}", "extra") for i in range(100, 200)]
    labels = spark.createDataFrame([(i, i % 2 == 0 and 1 or 0, 0) for i in range(100, 200)], "doc_id long, quality int, toxic int")
    out = {r.page_id: r for r in url_rules.judge(spark.createDataFrame(rows, "page_id long, url string, verdict string"), labels).collect()}
    assert len(out) == len(rows)
    assert (out[0].host, out[0].path, out[0].rule, out[0].verdict) == ("blog.example.net", "/en/1", "example.net/en/", "allow")
    for i in range(len(urls)):
        assert (out[i].rule, out[i].verdict if out[i].rule else None) == brute_rule(out[i].host, out[i].path)
    assert (out[6].host, out[6].path, out[7].host, out[7].verdict) == ("", "", "", "allow")
    assert all(out[i].verdict == ("block" if i % 2 else "allow") for i in range(100, 200))
