"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenpath.llm.common import PASS_CHARS, bounded_sample, keep_texts, map_texts, texts_of
from lumenpath.session import ship

FEATURES, ORDERS, SMOOTHING = 1 << 14, (1, 2, 3), 0.5
#: The classifier is fitted on at most about so many labelled documents.
FIT_DOCS = 12_000
UNKNOWN = "und"
#: Longer texts are added up in slices; a batch of texts holds no more characters.
SLICE_CHARS = PASS_CHARS
PAD = "\0" * max(ORDERS)


def grams(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashed n-grams starting at each character, for each order; (start, end) of each text among them.

    Texts are padded, so that an n-gram never reaches into the next text.
    """
    low = [t.lower() for t in texts]
    c = np.frombuffer((PAD.join(low) + PAD).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ends = np.cumsum([len(t) + len(PAD) for t in low]) - len(PAD)
    spans = np.stack([ends - [len(t) for t in low], ends], 1)
    n, out, h = len(c) - len(PAD) + 1, [], np.zeros(len(c) - len(PAD) + 1, dtype=np.uint32)
    for j in range(max(ORDERS)):
        h = (h + c[j : j + n] + np.uint32(j + 1)) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        if j + 1 in ORDERS:
            out.append(((h * np.uint32(0x85EBCA6B)) >> np.uint32(32 - 14)).astype(np.int32))
    return out, spans


def of_slices(text: str) -> Iterator[np.ndarray]:
    """The hashed n-grams of one text, SLICE_CHARS starting characters at a time, so that a long text needs no more memory."""
    low, reach = text.lower(), max(ORDERS) - 1
    for at in range(0, len(low), SLICE_CHARS):
        size = min(SLICE_CHARS, len(low) - at)
        for h in grams([low[at : at + size + reach]])[0]:
            yield h[:size]


def fit(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """(languages, log-probability matrix [FEATURES, languages]) from the rows where ``train`` holds.

    Counts are summed by Spark; the driver gets the matrix, whose size is fixed by FEATURES
    and the number of languages. The prior is uniform over languages.
    """
    rows, n = bounded_sample(docs.where(train & F.col(lang_col).isNotNull() & (F.col(text_col) != "")), [id_col, text_col], FIT_DOCS)
    rows = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if text:
                    into = sums.setdefault(lang, np.zeros(FEATURES, dtype=np.int64))
                    for h in of_slices(text):
                        into += np.bincount(h, minlength=FEATURES)
        for lang, v in sums.items():
            at = np.flatnonzero(v)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(v[at])], names=["lang", "feature", "n"])

    got = rows.mapInArrow(count, "lang string, feature long, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(got["lang"].unique())
    if n and not langs:
        raise ValueError(f"no row of {n} with a language is in the sample")
    counts = np.full((FEATURES, len(langs)), SMOOTHING)
    for j, lang in enumerate(langs):
        own = got[got["lang"] == lang]
        counts[own["feature"].to_numpy(), j] += own["n"].to_numpy()
    return langs, np.log(counts / counts.sum(axis=0)).astype(np.float32) if langs else np.zeros((FEATURES, 0), np.float32)


def score(texts: list[str], langs: list[str], table: np.ndarray) -> tuple[list[str], list[float]]:
    """Best language and its posterior probability for each text."""
    if len(texts) == 1 and len(texts[0]) > SLICE_CHARS and langs and any(map(str.isalpha, texts[0])):
        total = sum(table[h].sum(axis=0, dtype=np.float64) for h in of_slices(texts[0]))
        p = np.exp(total - total.max())
        return [langs[int(total.argmax())]], [float(p.max() / p.sum())]
    known = [bool(langs) and any(map(str.isalpha, t)) for t in texts]
    hashed, spans = grams(texts)
    said, sure = [UNKNOWN] * len(texts), [0.0] * len(texts)
    rows = np.flatnonzero(known)
    if len(rows):
        each = table[hashed[0]]
        for h in hashed[1:]:
            each += table[h]
        total = np.add.reduceat(each, spans[rows].ravel(), axis=0, dtype=np.float64)[::2]
        p = np.exp(total - total.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        best = total.argmax(axis=1)
        for r, b, q in zip(rows.tolist(), best.tolist(), p.max(axis=1).tolist()):
            said[r], sure[r] = langs[b], q
    return said, sure


def identify(docs: DataFrame, train: Column | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``doc_id, lang_pred, score`` of every whole text, learned from the rows where ``train`` holds.

    A null text, or one without a letter, is ``und`` with score 0, and so is every text if
    nothing can be learned. Of equally likely languages the first in order is taken. Repeated
    rows are each scored; an empty table stays empty; extra columns are ignored. The matrix
    (FEATURES x languages) is broadcast; scoring is a map without a shuffle.
    """
    ship(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, train if train is not None else F.lit(True), id_col, text_col, lang_col))
    names = [("lang_pred", pa.string()), ("score", pa.float64())]
    return map_texts(texts_of(docs, id_col, text_col), "doc_id long, lang_pred string, score double", names, lambda texts: list(score(texts, *model.value)))


def keep_known(docs: DataFrame, train: Column | None = None, sure: float = 0.5, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose language is known with a probability of ``sure`` or more; every row is judged by its own text."""
    ship(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, train if train is not None else F.lit(True), text_col=text_col, lang_col=lang_col))

    def start():
        def keep(texts: list[str]) -> list[bool]:
            said, p = score(texts, *model.value)
            return [lang != UNKNOWN and q >= sure for lang, q in zip(said, p)]

        return keep

    return keep_texts(docs, start, text_col)
