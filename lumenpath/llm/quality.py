"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of PASSAGE words. Every passage is encoded from its counts
of byte classes and hashed words; a gated attention, learned with the encoder from document
labels alone, weights the passages, and the weighted sum is scored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenpath.llm.common import PASS_CHARS, fitted, labelled_sample, map_texts, texts_of
from lumenpath.llm.word_hash import Words

PASSAGE, WORD_BINS, HIDDEN, GATE = 64, 64, 24, 12
EPOCHS, BATCH, RATE, DECAY = 14, 64, 0.01, 1e-4
#: The classifier is fitted on at most about so many labelled documents and bytes of text, none of them longer than FIT_TEXT.
FIT_DOCS, FIT_BYTES, FIT_TEXT = 6_000, 64 << 20, 1 << 20
#: Texts over PASS_CHARS are scored in parts of so many passages.
SLICE_PASSAGES = 2_000
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def byte_classes() -> tuple[np.ndarray, int]:
    """A class for each byte: upper, lower, digit, beyond ASCII, control, and one for every other ASCII sign."""
    out, extra = np.zeros(256, dtype=np.int64), 5
    for b in range(256):
        c = chr(b)
        if b >= 128:
            out[b] = 3
        elif c.isupper():
            out[b] = 0
        elif c.islower():
            out[b] = 1
        elif c.isdigit():
            out[b] = 2
        elif b < 32 and c != "\n":
            out[b] = 4
        else:
            out[b], extra = extra, extra + 1
    return out, extra


CLASS, CLASSES = byte_classes()
FEATURES = CLASSES + WORD_BINS + 4


def passages(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(features of every passage of every text, first passage of each text); a text without words has one passage."""
    w = Words(texts, lower=False)
    words = np.bincount(w.doc, minlength=len(texts))
    per = np.maximum(1, -(-words // PASSAGE))
    first = np.concatenate([[0], np.cumsum(per)])
    rank = np.arange(len(w.doc)) - (np.cumsum(words) - words)[w.doc]
    own = first[w.doc] + rank // PASSAGE
    n = int(first[-1])
    begin = np.zeros(n, dtype=np.int64)
    begin[first[:-1]] = w.at[:-1]
    heads = np.flatnonzero((rank % PASSAGE == 0) & (rank > 0))
    begin[own[heads]] = w.start[heads]
    of_byte = np.repeat(np.arange(n), np.diff(np.append(begin, len(w.data))))
    hist = np.bincount(of_byte * CLASSES + CLASS[w.data], minlength=n * CLASSES).reshape(n, CLASSES).astype(np.float32)
    size = np.maximum(hist.sum(1, keepdims=True), 1)
    bins = np.bincount(own * WORD_BINS + (w.hash >> np.uint64(58)).astype(np.int64), minlength=n * WORD_BINS).reshape(n, WORD_BINS).astype(np.float32)
    count = np.bincount(own, minlength=n).astype(np.float32)[:, None]
    letters = np.bincount(own, weights=w.end - w.start, minlength=n).astype(np.float32)[:, None]
    pairs = np.unique(own.astype(np.uint64) << np.uint64(40) | w.hash >> np.uint64(24))
    distinct = np.bincount((pairs >> np.uint64(40)).astype(np.int64), minlength=n).astype(np.float32)[:, None]
    some = np.maximum(count, 1)
    extra = [np.minimum(count / PASSAGE, 1), letters / some / 10, distinct / some, np.log1p(hist.sum(1, keepdims=True)) / 10]
    return np.concatenate([np.sqrt(hist / size), np.sqrt(bins / some), *extra], 1), first


class Attention:
    """The network: tanh encoder, gated attention, logistic output. Parameters are plain arrays."""

    SHAPES = {"we": (FEATURES, HIDDEN), "be": (HIDDEN,), "wv": (HIDDEN, GATE), "wu": (HIDDEN, GATE), "wa": (GATE,), "wo": (HIDDEN,), "bo": ()}

    def __init__(self, params: dict[str, np.ndarray]) -> None:
        self.p = params

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Encoded passages, both parts of the gate, and the attention before it is normalised."""
        h = np.tanh(x @ self.p["we"] + self.p["be"])
        v, u = np.tanh(h @ self.p["wv"]), 1 / (1 + np.exp(-(h @ self.p["wu"])))
        return h, v, u, (v * u) @ self.p["wa"]

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        p, bag = self.p, np.repeat(np.arange(len(first) - 1), np.diff(first))
        h, v, u, e = self.encode(x)
        a = np.exp(e - np.maximum.reduceat(e, first[:-1])[bag])
        a /= np.add.reduceat(a, first[:-1])[bag]
        z = np.add.reduceat(a[:, None] * h, first[:-1], axis=0)
        s = 1 / (1 + np.exp(-np.clip(z @ p["wo"] + p["bo"], -30, 30)))
        return {"h": h, "v": v, "u": u, "a": a, "z": z, "s": s, "bag": bag}

    def gradients(self, x: np.ndarray, first: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, f = self.p, self.forward(x, first)
        d = (f["s"] - y) / len(y)
        dz = d[:, None] * p["wo"]
        per = dz[f["bag"]]
        score = (per * f["h"]).sum(1)
        de = f["a"] * (score - np.add.reduceat(f["a"] * score, first[:-1])[f["bag"]])
        dvu = de[:, None] * p["wa"]
        dv, du = dvu * f["u"] * (1 - f["v"] ** 2), dvu * f["v"] * f["u"] * (1 - f["u"])
        dh = (f["a"][:, None] * per + dv @ p["wv"].T + du @ p["wu"].T) * (1 - f["h"] ** 2)
        return {"we": x.T @ dh, "be": dh.sum(0), "wv": f["h"].T @ dv, "wu": f["h"].T @ du, "wa": (f["v"] * f["u"]).T @ de, "wo": f["z"].T @ d, "bo": d.sum()}


def fit(texts: list[str], labels: np.ndarray) -> dict[str, np.ndarray]:
    """Train by Adam on whole bags; the same rows give the same parameters."""
    rng = np.random.default_rng(11)
    p = {k: rng.normal(0, 1 / np.sqrt(s[0]) if s else 0, s) * (len(s) > 1 or k in ("wa", "wo")) for k, s in Attention.SHAPES.items()}
    net, m, v, t = Attention(p), {k: 0.0 for k in p}, {k: 0.0 for k in p}, 0
    made = [passages(texts[i : i + 256]) for i in range(0, len(texts), 256)]
    x = np.concatenate([f for f, _ in made])
    first = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(c) for _, c in made]))])
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = rng.permutation(len(texts))
        for i in range(0, len(order), BATCH):
            some = order[i : i + BATCH]
            rows = np.concatenate([np.arange(first[j], first[j + 1]) for j in some])
            cuts = np.concatenate([[0], np.cumsum(first[some + 1] - first[some])])
            t += 1
            for k, g in net.gradients(x[rows], cuts, labels[some]).items():
                g = g + DECAY * p[k]
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                p[k] = p[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    return p


def fit_labelled(docs: DataFrame, labels: DataFrame, parts: int = 4, held: int = 2) -> dict[str, np.ndarray] | None:
    """Fit on a bounded sample of the labelled documents outside the held-out fold. Without labels, None."""
    fold = F.pmod(F.crc32(F.col("label_id").cast("string")), F.lit(parts))
    marked = labels.select(F.col("doc_id").cast("long").alias("label_id"), F.col("quality").cast("int").alias("label")).where(F.col("label").isNotNull() & F.col("label_id").isNotNull() & (fold != held))
    sample, known = labelled_sample(docs, marked.groupBy("label_id").agg(F.min("label").alias("label")), FIT_DOCS, FIT_BYTES, FIT_TEXT)
    return fitted(sample, known, fit)


def bag_slices(text: str) -> Iterator[str]:
    """A long text in parts of whole passages, SLICE_PASSAGES each."""
    raw, at = text.encode("utf-8", "replace"), 0
    for k, word in enumerate(WORD.finditer(raw)):
        if k and k % (PASSAGE * SLICE_PASSAGES) == 0:
            yield raw[at : word.start()].decode()
            at = word.start()
    yield raw[at:].decode()


def score_long(net: "Attention", text: str) -> tuple[float, np.ndarray]:
    """(score, attention) of one long text: the weighted sum over all passages, a slice at a time."""
    top, total, z, told = -np.inf, 0.0, 0.0, []
    for part in bag_slices(text):
        h, _, _, e = net.encode(passages([part])[0])
        high = max(top, float(e.max()))
        keep, w = np.exp(top - high), np.exp(e - high)
        total, z, top = total * keep + w.sum(), z * keep + w @ h, high
        told.append(e)
    s = 1 / (1 + np.exp(-np.clip(z / total @ net.p["wo"] + net.p["bo"], -30, 30)))
    return float(s), np.exp(np.concatenate(told) - top) / total


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, attention: bool = False) -> DataFrame:
    """``doc_id, score, predicted`` (and ``attention``, each passage's weight) of every whole text.

    A text without words is one passage and scored like any other; null texts are empty; rows
    of ``labels`` that repeat an id have quality 0 if one of them does; without labels every
    score is 0.5. Repeated rows are each scored; an empty table stays empty; extra columns are
    ignored. The parameters (a few thousand numbers) are broadcast; scoring is a map.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit_labelled(docs, labels))

    def kernel(texts: list[str]) -> list[list]:
        if model.value is None:
            return [[0.5] * len(texts), [int(threshold <= 0.5)] * len(texts)] + ([[[]] * len(texts)] if attention else [])
        if len(texts) == 1 and len(texts[0]) > PASS_CHARS:
            s, a = score_long(Attention(model.value), texts[0])
            return [[s], [int(s >= threshold)]] + ([[a]] if attention else [])
        x, first = passages(texts)
        f = Attention(model.value).forward(x, first)
        weights = [np.split(f["a"], first[1:-1])] if attention else []
        return [f["s"], (f["s"] >= threshold).astype(int), *weights]

    names = [("score", pa.float64()), ("predicted", pa.int32())] + ([("attention", pa.list_(pa.float64()))] if attention else [])
    return map_texts(texts_of(docs), "doc_id long, score double, predicted int" + (", attention array<double>" if attention else ""), names, kernel)
