"""Toxicity: logistic regression by FTRL-proximal over hashed word n-grams and skip-grams."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenpath.llm.common import PASS_CHARS, fitted, keep_texts, labelled_sample, map_texts, texts_of
from lumenpath.llm.word_hash import Words, mix, slices

BITS = 22
ALPHA, BETA, L1, L2, EPOCHS = 0.5, 1.0, 6.0, 1.0, 5
#: A toxic document counts as so many others, since there are few.
POSITIVE = 6.0
#: A feature is learned if at least so many of the fitted documents have it.
LEAST_DOCS = 4
#: The classifier is fitted on at most about so many labelled documents and bytes of text, none of them longer than FIT_TEXT.
FIT_DOCS, FIT_BYTES, FIT_TEXT = 10_000, 64 << 20, 1 << 20
PAIR = (np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
SKIP = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature) of every word, word pair and pair with one word between; words per text."""
    w = Words(texts)
    docs, feats = [w.doc], [w.hash]
    for step, (a, b) in ((1, PAIR), (2, SKIP)):
        same = w.doc[step:] == w.doc[:-step]
        docs.append(w.doc[step:][same])
        feats.append(mix(w.hash[:-step][same] * a + w.hash[step:][same] * b))
    index = (np.concatenate(feats) >> np.uint64(64 - BITS)).astype(np.int64)
    return np.concatenate(docs), index, np.bincount(w.doc, minlength=len(texts))


def scale(words: np.ndarray) -> np.ndarray:
    """The value of one occurrence: it falls slowly with the length of the text."""
    return 4.0 / np.sqrt(np.maximum(words, 16))


def fit(texts: list[str], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(features, weights, bias): the non-zero weights after EPOCHS passes, each coordinate with its own rate."""
    seen = np.zeros(1 << BITS, dtype=np.int16)
    for keys, _, _ in _counted(texts):
        at, n = np.unique(keys & (1 << BITS) - 1, return_counts=True)
        seen[at] = np.minimum(seen[at] + n, LEAST_DOCS)
    kept = np.flatnonzero(seen >= LEAST_DOCS)
    place = np.full(1 << BITS, -1, dtype=np.int32)
    place[kept] = np.arange(len(kept), dtype=np.int32)
    size, cases = len(kept), []
    for keys, counts, value in _counted(texts):
        at = place[keys & (1 << BITS) - 1]
        known = at >= 0
        doc, at, counts = keys[known] >> BITS, at[known], counts[known]
        cuts = np.searchsorted(doc, np.arange(len(value) + 1))
        for k in range(len(value)):
            own = slice(cuts[k], cuts[k + 1])
            cases.append((np.append(at[own], np.int32(size)), np.append(counts[own] * value[k], 1.0).astype(np.float32)))
    del seen, place
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    penalty = np.full(size + 1, L1)
    penalty[size] = 0.0

    def weights(at: np.ndarray) -> np.ndarray:
        zi, l1 = z[at], penalty[at]
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in order.permutation(len(cases)):
            at, x = cases[i]
            w = weights(at)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -30, 30)))
            g = (p - labels[i]) * (POSITIVE if labels[i] else 1.0) * x
            root = np.sqrt(n[at])
            z[at] += g - (np.sqrt(n[at] + g * g) - root) / ALPHA * w
            n[at] += g * g
    w = weights(np.arange(size + 1))
    some = np.flatnonzero(w[:size])
    return kept[some], w[some], float(w[size])


def _counted(texts: list[str]):
    """(text and feature in one number, count, value of one occurrence) by parts, so that memory stays small."""
    for i in range(0, len(texts), 128):
        doc, index, words = features(texts[i : i + 128])
        keys, counts = np.unique(doc << BITS | index, return_counts=True)
        yield keys, counts, scale(words)


def fit_labelled(docs: DataFrame, labels: DataFrame, parts: int = 5, held: int = 0) -> tuple[np.ndarray, np.ndarray, float]:
    """Fit on a bounded sample of the labelled documents outside the held-out fold. Without labels, no weights."""
    fold = F.pmod(F.crc32(F.col("label_id").cast("string")), F.lit(parts))
    marked = labels.select(F.col("doc_id").cast("long").alias("label_id"), F.col("toxic").cast("int").alias("label")).where(F.col("label").isNotNull() & F.col("label_id").isNotNull() & (fold != held))
    sample, known = labelled_sample(docs, marked.groupBy("label_id").agg(F.max("label").alias("label")), FIT_DOCS, FIT_BYTES, FIT_TEXT)
    return fitted(sample, known, fit) or (np.zeros(0, np.int64), np.zeros(0), 0.0)


def weights_of(model: tuple[np.ndarray, np.ndarray, float]) -> np.ndarray:
    """The weight of every feature, zeros included."""
    table = np.zeros(1 << BITS, dtype=np.float32)
    table[model[0]] = model[1]
    return table


def score(texts: list[str], model: tuple[np.ndarray, np.ndarray, float], table: np.ndarray | None = None) -> np.ndarray:
    table = weights_of(model) if table is None else table
    if len(texts) == 1 and len(texts[0]) > PASS_CHARS:
        total, words = _sum_of_slices(texts[0], table)
    else:
        doc, index, words = features(texts)
        total = np.bincount(doc, weights=table[index], minlength=len(texts))
    return 1 / (1 + np.exp(-np.clip(total * scale(words) + model[2], -30, 30)))


def _sum_of_slices(text: str, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sum of the weights of all features, number of words) of a long text, a slice at a time; the last two words of a slice meet the next."""
    last, total, words = np.zeros(0, dtype=np.uint64), 0.0, 0
    for part in slices(text.lower(), PASS_CHARS):
        own = Words([part], lower=False).hash
        both = np.concatenate([last, own])
        feats = [own]
        for step, (a, b) in ((1, PAIR), (2, SKIP)):
            at = np.arange(max(step, len(last)), len(both))
            feats.append(mix(both[at - step] * a + both[at] * b))
        total += float(table[(np.concatenate(feats) >> np.uint64(64 - BITS)).astype(np.int64)].sum(dtype=np.float64))
        last, words = both[-2:], words + len(own)
    return np.array([total]), np.array([words])


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``doc_id, score, predicted`` of every whole text.

    Rows of ``labels`` that repeat an id count as toxic if one of them does; null labels are
    ignored. Null and empty texts get the bias alone; with no labels every score is 0.5, and
    repeated rows are each scored; an empty table stays empty; extra columns are ignored.
    Only non-zero weights are broadcast (at most 2**BITS); scoring is a map without a shuffle.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(fit_labelled(docs, labels))

    def start():
        table = weights_of(model.value)

        def kernel(texts: list[str]) -> list[list]:
            s = score(texts, model.value, table)
            return [s, (s >= threshold).astype(int)]

        return kernel

    return map_texts(texts_of(docs), "doc_id long, score double, predicted int", [("score", pa.float64()), ("predicted", pa.int32())], None, start)


def keep_harmless(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` scored below ``threshold``; every row is judged by its own text."""
    model = docs.sparkSession.sparkContext.broadcast(fit_labelled(docs, labels))

    def start():
        table = weights_of(model.value)
        return lambda texts: score(texts, model.value, table) < threshold

    return keep_texts(docs, start)
