"""The queries as the driver calls them: columns, types, folds, thresholds and odd rows; plain re-computations beside them."""

import itertools
import os
import random
import re
import struct
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from tokenizers import Tokenizer

from lumenpath.llm import bpe_automaton, decontaminate, language_id, near_copies, quality, queries, syncmers, token_counts, toxicity, url_rules
from lumenpath.llm.common import labelled_sample

CONTRACT = {
    "op1_bpe_encode_decode": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op2_syncmer_fingerprints": "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    "op4_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op5_simhash_near_dedup": "doc_id bigint, fingerprint string, component_id bigint",
    "op6_token_counts": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    "op7_token_id_shards": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op8_quality": "doc_id bigint, held_out boolean, score double, predicted int",
    "op9_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
}
GOOD, BAD = "a fine day for a long walk by the river and the wood ", "you are an idiot clown and a fool and nobody likes you "
SF = "/root/testdata/sf0.1"


def written(spark, folder, docs, labels, pages=()):
    extra = "score double, predicted int, node long, fp long, key string, th string, label int, held_out string"
    rows = [(*r, 0.5, 1, 7, 8, "k", "t", 3, "x") for r in docs]
    spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {extra}").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(*r, "extra") for r in labels], "doc_id long, quality int, toxic int, text string").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta", 0.1), (1, None, 0.2), (None, "", 0.3)], "item_id long, text string, similarity double").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{folder}/embeddings.parquet")
    spark.createDataFrame([(*p, "v", "r") for p in pages], "page_id long, url string, verdict string, rule string").write.parquet(f"{folder}/pages.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    docs = [(i, (BAD if i % 2 else GOOD) * (3 + i % 3) + f"number{i}", "en", "s", 1) for i in range(60)]
    docs += [(60 + i, "der Hund und die Katze gehen in den Wald " * 4 + f"nummer{i}", "de", "s", 1) for i in range(30)]
    docs += [(200, None, None, None, None), (201, "", "en", "s", 0), (202, "123 !?", "en", "s", 6), (None, "no id here", "en", "s", 1), (None, None, None, None, None)]
    docs += [(203, "the same row twice", "en", "s", 1)] * 2 + [(204, "one id", "en", "s", 1), (204, "with two texts", "en", "s", 1)]
    docs += [(205, (GOOD + "alpha beta gamma delta epsilon zeta eta theta ") * 900, "en", "s", 1), (206, "alpha beta gamma delta epsilon zeta eta theta", "en", "s", 1)]
    labels = [(i, i % 2 == 0 and 1 or 0, i % 2) for i in range(60)] + [(None, 1, 1), (3, None, None), (999, 1, 1)]
    return written(spark, tmp_path_factory.mktemp("odd"), docs, labels), len(docs)


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_contract_columns_types_and_rows(spark, odd, name):
    out = queries.queries()[name](spark, odd[0])
    want = [tuple(c.split(" ")) for c in CONTRACT[name].split(", ")]
    assert out.dtypes[: len(want)] == want
    rows = out.collect()
    assert len(rows) == odd[1]
    if "held_out" in out.columns:
        parts, held = (5, 0) if "toxic" in name else (4, 2)
        assert all(r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % parts == held) for r in rows)
    if name in ("op8_quality", "op9_toxicity"):
        cut = 0.7 if name == "op8_quality" else 0.5
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= cut) for r in rows)
        assert len({r.score for r in rows if r.doc_id in (200, 201)}) == 1
    if name == "op4_language_id":
        said = {r.doc_id: r for r in rows}
        assert all((r.lang_pred == "und") == (r.doc_id in (200, 201, 202) or r.doc_id is None and r.score == 0) for r in rows)
        assert said[60].lang_pred == "de" and said[205].lang_pred == "en"
    twins = [tuple(r[1:]) for r in rows if r.doc_id == 203]
    assert len(twins) == 2 and (name == "op7_token_id_shards" or twins[0] == twins[1])


def test_empty_tables(spark, tmp_path):
    folder = written(spark, tmp_path, [], [])
    for name, run in queries.queries().items():
        assert run(spark, folder).count() == 0, name


def test_decontamination_over_odd_rows(spark, odd):
    assert {(r.doc_id, r.item_id) for r in queries.op3_decontamination(spark, odd[0]).collect()} == {(205, 1), (206, 1)}


def test_recall_of_the_index_near_the_threshold():
    rng = random.Random(1)
    vocab = [f"w{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range((20, 40, 90)[i % 3]))) for i in range(300)]
    index, hit, n = decontaminate.Index(items), 0, 0
    found = [set() for _ in range(300)]
    for family in index.families:
        for q, at in zip(*family.candidates(np.random.default_rng(0).integers(0, 1 << 63, 300, dtype=np.uint64))):
            found[q].add(int(at))
    assert np.mean([len(f) for f in found]) / len(items) < 0.05
    for item_id, text in items:
        own = text.split()
        k, copy, misses = decontaminate.shingles(own, 5), list(own), 0
        while misses < 20:
            other = list(copy)
            other[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
            if decontaminate.similarity(decontaminate.shingles(other, 5), k) >= 0.8:
                copy = other
            else:
                misses += 1
        around = [rng.choice(vocab) for _ in range(30)]
        n, hit = n + 1, hit + any(m[0] == item_id for m in index.matches(" ".join([*around, *copy, *around])))
    assert hit >= 0.99 * n


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def chain(values, seed=42):
    """Spark's xxhash64 of several values: each is hashed with the hash before it as seed; nulls are passed over."""
    for v in values:
        if v is not None:
            seed = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else struct.pack("<i" if abs(v) < 1 << 31 and isinstance(v, Small) else "<q", v), seed)
    return signed(seed)


class Small(int):
    """An int column's value, which is hashed in four bytes."""


def plain_links(text):
    words = re.findall("[^ \t\n\x0b\f\r]+", text)
    hashes = [chain([w]) for w in words]
    anchors = []
    for i in range(len(hashes) - syncmers.K + 1):
        own = hashes[i : i + syncmers.K]
        if min(own) in (own[0], own[-1]):
            anchors.append((i, Small(chain(own) >> 32)))
    if not hashes:
        return []
    if not anchors:
        return [chain(hashes) >> 32]
    out = []
    for k, (at, h) in enumerate(anchors):
        before = anchors[k - 1] if k else None
        out.append(chain([h, before[1] if before else None, Small(at - before[0]) if before else None]) >> 32)
    return out


def test_fingerprints_equal_a_plain_recomputation(spark, tmp_path):
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(40)}" for _ in range(n)) for n in (0, 1, 3, 4, 5, 6, 9, 40, 40, 200)]
    folder = written(spark, tmp_path, [(i, t, "en", "s", 1) for i, t in enumerate(texts)], [])
    got = {r.doc_id: r for r in queries.op2_syncmer_fingerprints(spark, folder).collect()}
    shown = lambda found: "".join(f"{x + (1 << 31):08x}" for x in found)

    def like(a, b):
        return len(set(a) & set(b)) / len(set(a) | set(b)) if a or b else 1.0

    for i, text in enumerate(texts):
        after, half = texts[i - 1], len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, changed = plain_links(text), plain_links(edited)
        assert (got[i].fingerprint, got[i].edited_fingerprint) == (shown(own), shown(changed))
        assert got[i].near_edited == pytest.approx(like(own, changed)) and got[i].near_next == pytest.approx(like(own, plain_links(after)))


def test_scripts_without_spaces_and_positions(spark):
    text = "".join(chr(0x4E00 + i * 7 % 900) for i in range(120))
    moved = [(2, text), (1, "前" + text[:90])]
    out = {r.doc_id: r for r in syncmers.fingerprint_with_edits(spark.createDataFrame(moved, "doc_id long, text string")).collect()}
    assert out[2].near_next > 0.5 and out[2].near_edited > 0.2 and len(out[2].fingerprint) > 80
    words = [f"v{i * 37 % 101}" for i in range(100)]
    rows = [(2, " ".join(words)), (1, " ".join(reversed(words)))]
    out = {r.doc_id: r for r in syncmers.fingerprint_with_edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[2].near_next < 0.05  # the same words in another order


def area(rows, label):
    """Area under the ROC curve of the held-out rows."""
    pos, neg = ([r.score for r in rows if r.held_out and label.get(r.doc_id) == y] for y in (1, 0))
    return np.mean([(p > n) + (p == n) / 2 for p in pos for n in neg])


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")
def test_held_out_rows(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    assert area(queries.op8_quality(spark, SF).collect(), {r.doc_id: r.quality for r in labels}) > 0.95
    assert area(queries.op9_toxicity(spark, SF).collect(), {r.doc_id: r.toxic for r in labels}) > 0.95
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in queries.op4_language_id(spark, SF).collect() if r.held_out and langs[r.doc_id]]
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in held]) > 0.97


def test_the_sample_is_bounded_by_rows_and_bytes(spark):
    docs = spark.createDataFrame([(i % 1000, f"text {i} " + "x" * 100) for i in range(3000)] + [(5, "y" * 5000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, float(i % 2)) for i in range(3000)], "label_id long, label double")
    texts = lambda *bounds: [r.text for r in labelled_sample(*bounds)[0].collect()]
    whole = texts(docs, labels, 10_000, 1 << 30, 1000)
    assert len(whole) == 3000 and max(map(len, whole)) < 1000
    assert 200 < len(texts(docs, labels, 300, 1 << 30, 10_000)) < 400
    assert 200 < sum(map(len, texts(docs, labels, 10_000, 33_000, 10_000))) / 110 < 400
    same = spark.createDataFrame([(7, f"v{i}") for i in range(3000)], "doc_id long, text string")
    assert len(texts(same, labels, 100, 1 << 30, 1000)) < 200


def plain_verdicts(pages, labels, support, confidence):
    """All rules by counting every combination of tokens, the same pruning, and the best rule for each page."""
    bad = defaultdict(int)
    for i, q, t in labels:
        bad[i] = max(bad[i], int(t == 1 or q == 0))

    def tokens(url):
        host, path = re.match(r"(?s)[^:]*://([^/?#]*)([^?#]*)", url).groups()
        parts = [p for p in re.split(r"[/._\-]", path.lower()) if p]
        found = ["h:" + x for x in host.split(".")] + ["w:" + x for x in re.split(r"[.\-]", host)] + ["s:" + ".".join(host.split(".")[-2:])]
        return frozenset(found + ["p:" + ("#" if p.isdigit() else p) for p in parts])

    held = {i: tokens(u) for i, u in pages}
    marked = [(held[i], "block" if bad[i] else "allow") for i in held if i in bad]
    n, least = len(marked), max(support, url_rules.MIN_PAGES / len(marked)) * len(marked)
    count, by_class = defaultdict(int), defaultdict(int)
    for own, verdict in marked:
        for size in range(1, len(own) + 1):
            for part in itertools.combinations(sorted(own), size):
                count[part] += 1
                by_class[part, verdict] += 1
    share = {v: sum(x == v for _, x in marked) / n for v in ("block", "allow")}
    rules = {k: c / count[k[0]] for k, c in by_class.items() if c >= least and c / count[k[0]] >= confidence and c / count[k[0]] > min(1.0, share[k[1]] + 0.1)}
    best = {(part, v): r for (part, v), r in rules.items() if not any((part[:j] + part[j + 1 :], v) in rules for j in range(len(part)))}
    out = {}
    for i, own in held.items():
        fit = [(r, by_class[part, v] / n, list(part), v) for (part, v), r in best.items() if own.issuperset(part)]
        out[i] = max(fit)[3] if fit else "allow"
    return out


def test_mined_rules_equal_counting_every_combination(spark, tmp_path):
    rng = random.Random(6)
    pages, labels = [], []
    for i in range(400):
        kind, topic = rng.choice(["spam", "good", "mix"]), rng.choice(["cars", "loans", "news"])
        pages.append((i, f"http://{kind}.com/{topic}/{rng.randrange(9)}"))
        wrong = kind == "spam" or kind == "mix" and topic == "loans"
        if i % 4:
            labels.append((i, int(not wrong if rng.random() < 0.95 else wrong), 0))
    folder = written(spark, tmp_path, [], labels, [*pages, (900, None), (901, "no scheme"), (0, pages[0][1])])
    out = queries.op10_url_filters(spark, folder)
    assert out.dtypes[:5] == [("page_id", "bigint"), ("host", "string"), ("path", "string"), ("rule", "string"), ("verdict", "string")]
    want = plain_verdicts(pages, labels, url_rules.MIN_SUPPORT, url_rules.MIN_CONFIDENCE)
    rows = out.collect()
    assert len(rows) == 403 and {r.verdict for r in rows if r.page_id >= 900} == {"allow"}
    assert all(r.verdict == want[r.page_id] for r in rows if r.page_id < 900)
    assert {v for v in want.values()} == {"allow", "block"}


def test_long_texts_and_words():
    path = queries.vocabulary("word_bpe_49k.json")
    enc, tok, rng = bpe_automaton.Encoder(bpe_automaton.Automaton(bpe_automaton.compile_file(path))), Tokenizer.from_file(path), random.Random(2)
    word = "".join(rng.choice("abcdefghij") for _ in range(100_000))
    long = "several words, and more 12 " * 60_000
    for text in (word, long):
        assert enc.encode(text) == tok.encode(text, add_special_tokens=False).ids


def test_a_full_table_is_emptied_and_right(monkeypatch):
    path = queries.vocabulary("word_bpe_49k.json")
    enc = bpe_automaton.Encoder(bpe_automaton.Automaton(bpe_automaton.compile_file(path)))
    enc.table.most, tok = 20_000, Tokenizer.from_file(path)
    for k in range(20):
        text = " ".join(f"word{i * k}a," for i in range(300))
        assert enc.encode(text) == tok.encode(text, add_special_tokens=False).ids
        assert enc.table.bytes < 400_000


def test_splicing_widens_and_lengthens():
    path = queries.vocabulary("byte_bpe_50k.json")
    counts, tok = token_counts.UnitCounts(open(path, encoding="utf-8").read()), Tokenizer.from_file(path)
    for text in ("ab " * 30 + "x" * 500 + " cd" * 30, " " * 400 + "a", "é€日" * 200, "w " * 300, "a" + "\n\n " * 100 + "b"):
        for size, overlap in ((40, 4), (64, 32)):
            n, used = token_counts.count_spliced(counts, text, size, overlap)
            assert n == len(tok.encode(text, add_special_tokens=False).ids) and used >= 1
    left, right = token_counts.Chunk(counts, "one two three", 0, 8), token_counts.Chunk(counts, "one two three", 5, 13)
    assert token_counts.splice(left, right, "one two three") == 7
    assert token_counts.splice(token_counts.Chunk(counts, "x" * 40, 0, 30), token_counts.Chunk(counts, "x" * 40, 20, 40), "x" * 40) is None


def test_a_long_text_scores_alike_in_slices(monkeypatch):
    rng = random.Random(1)
    text = " ".join(f"w{rng.randrange(500)}" if rng.random() < 0.9 else "Éa,b-c!" for _ in range(20_000))
    at = np.arange(0, 1 << toxicity.BITS, 3)
    model = (at, np.random.default_rng(0).normal(size=len(at)) * 0.01, 0.1)
    params = {k: np.random.default_rng(3).normal(0, 0.3, s) for k, s in quality.Attention.SHAPES.items()}
    table = np.random.default_rng(0).normal(size=(language_id.FEATURES, 3)).astype(np.float32) * 1e-3
    whole = toxicity.score([text], model)[0], quality.Attention(params).forward(*quality.passages([text])), language_id.score([text], ["a", "b", "c"], table)
    monkeypatch.setattr(toxicity, "PASS_CHARS", 5_000)
    monkeypatch.setattr(language_id, "SLICE_CHARS", 7_000)
    monkeypatch.setattr(quality, "SLICE_PASSAGES", 50)
    score, weights = quality.score_long(quality.Attention(params), text)
    assert toxicity.score([text], model)[0] == pytest.approx(whole[0], abs=1e-6)
    assert score == pytest.approx(whole[1]["s"][0], abs=1e-3) and len(weights) == len(whole[1]["a"])
    assert language_id.score([text], ["a", "b", "c"], table)[1] == pytest.approx(whole[2][1], abs=1e-6)


def test_rows_that_share_an_id_are_judged_each_by_its_own_text(spark):
    import corpus_pipeline as p

    words = " ".join(f"w{i}" for i in range(40))
    rows = [(1, words), (5, words), (5, "another text " + GOOD), (5, words), (7, None), (None, words + " end"), (None, "text without id " + GOOD)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars int")
    kept = sorted((str(r.doc_id), r.text or "") for r in p.keep_one_of_near_copies(spark, docs, "").collect())
    assert kept == sorted([("1", words), ("5", "another text " + GOOD), ("7", ""), ("None", "text without id " + GOOD)])
    bad = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta")], "item_id long, text string")
    leak = spark.createDataFrame([(5, "alpha beta gamma delta epsilon zeta", "en", "s", 1), (5, "clean", "en", "s", 1), (None, "x alpha beta gamma delta epsilon zeta y", "en", "s", 1)], docs.schema)
    assert [r.text for r in decontaminate.keep_clean(leak, bad).collect()] == ["clean"]


def test_near_copies_of_an_empty_table_and_of_one_text(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars int"
    assert near_copies.keep_first(spark.createDataFrame([], schema)).count() == 0
    assert near_copies.keep_first(spark.createDataFrame([(i, "same", "en", "s", 1) for i in range(5)], schema)).count() == 1
