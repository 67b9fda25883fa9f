import hashlib
import os
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from lumenpath.llm import decontaminate, language_id, simhash_trie, toxicity
from lumenpath.llm.queries import vocabulary

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")


def fold(doc_id, parts):
    return zlib.crc32(str(doc_id).encode()) % parts


def sure_language(docs):
    """Ids whose language is known, with counts added up one document at a time."""
    langs = sorted({d.lang for d in docs if d.lang is not None and fold(d.doc_id, 4) != 2})
    counts = np.full((language_id.FEATURES, len(langs)), language_id.SMOOTHING)
    for d in docs:
        if d.lang is not None and d.text and fold(d.doc_id, 4) != 2:
            hashed, (span,) = language_id.grams([d.text])
            for h in hashed:
                np.add.at(counts, (h[span[0] : span[1]], langs.index(d.lang)), 1)
    logs, kept = np.log(counts / counts.sum(axis=0)), set()
    for d in docs:
        if any(map(str.isalpha, d.text or "")):
            hashed, (span,) = language_id.grams([d.text])
            total = sum(logs[h[span[0] : span[1]]].sum(axis=0) for h in hashed)
            if 1 / np.exp(total - total.max()).sum() >= 0.5:
                kept.add(d.doc_id)
    return kept


def not_toxic(docs, labels):
    given = {r.doc_id: r.toxic for r in labels if r.toxic is not None and fold(r.doc_id, 5)}
    own = [d for d in sorted(docs, key=lambda d: d.doc_id) if d.doc_id in given]
    model = toxicity.fit([d.text or "" for d in own], np.array([given[d.doc_id] for d in own], dtype=float))
    return {d.doc_id for d in docs if toxicity.score([d.text or ""], model)[0] < 0.5}


def first_of_near_copies(docs, near=None):
    """Ids that name a group: by default groups of five-word shingle sets with a Jaccard similarity of 0.8 or more."""
    sets = {}
    for d in docs:
        words = (d.text or "").encode().translate(simhash_trie.LOWER).split()
        sets[d.doc_id] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    near = near or (lambda a, b: sets[a] == sets[b] or 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]))
    name = {d.doc_id: d.doc_id for d in docs}
    changed = True
    while changed:
        changed = False
        for a in name:
            for b in name:
                if name[b] > name[a] and near(a, b):
                    name[b], changed = name[a], True
    low = {}
    for d in name:
        low[name[d]] = min(d, low.get(name[d], d))
    return set(low.values())


def without_items(docs, items):
    known = []
    for r in items:
        own = decontaminate.words_of(r.text or "")
        k = min(5, len(own))
        known.append((own, k, decontaminate.shingles(own, k)))
    kept = set()
    for d in docs:
        words = decontaminate.words_of(d.text or "")
        grams = {k: set(decontaminate.shingles(words, k)) for k in {k for _, k, _ in known}}
        hit = False
        for own, k, want in known:
            n = min(len(own), len(words))
            if own and not grams[k].isdisjoint(want):
                hit |= any(decontaminate.similarity(decontaminate.shingles(words[s : s + n], k), want) >= 0.8 for s in range(len(words) - n + 1))
        if not hit:
            kept.add(d.doc_id)
    return kept


@needs_tables
def test_every_stage_equals_brute_force(spark):
    import corpus_pipeline as p

    def read(name):
        return spark.read.parquet(f"{SF}/{name}.parquet")

    labels, items = read("labels").collect(), read("benchmark").collect()
    brute = [sure_language, lambda d: not_toxic(d, labels), first_of_near_copies, lambda d: without_items(d, items)]
    docs = read("documents")
    for (name, stage), plain in zip(p.STAGES, brute):
        before, out = docs.collect(), stage(spark, docs, SF)
        rows = out.collect()
        assert out.columns == docs.columns, name
        assert {r.doc_id for r in rows} == plain(before), name
        assert {r.doc_id: r.text for r in rows}.items() <= {r.doc_id: r.text for r in before}.items()
        docs = spark.createDataFrame(rows, docs.schema)
    tok = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    want = {}
    for d in docs.collect():
        ids = tok.encode(d.text or "", add_special_tokens=False).ids
        decoded = tok.decode(ids, skip_special_tokens=False)
        want[d.doc_id] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in p.run(spark, SF).collect()}
    assert got == want and len(got) > 100


@needs_tables
def test_the_operator_keeps_the_first_of_each_group_at_two_bits(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    prints = {d.doc_id: int(simhash_trie.fingerprints_of([d.text or ""])[0]) for d in docs.collect()}
    kept = {r.doc_id for r in simhash_trie.keep_first(docs).collect()}
    assert kept == first_of_near_copies(docs.collect(), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)


@needs_tables
def test_stages_take_nulls_and_an_empty_table(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(10**6, None, None, None, None), (10**6 + 1, "", "en", None, 0)], docs.schema)
    for name, stage in p.STAGES:
        kept = {r.doc_id for r in stage(spark, docs.unionAll(odd), SF).collect()}
        if name == "language_id":
            assert kept.isdisjoint({10**6, 10**6 + 1})
        else:
            assert 10**6 in kept, name
        assert stage(spark, docs.limit(0), SF).count() == 0, name
