"""Helpers of the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import pickle
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenpath.session import checkpoint, ship

#: Characters that one vectorised pass handles at once; longer batches are cut between documents.
PASS_CHARS = 600_000


#: Rows of an Arrow batch: texts are long, and a batch lies in memory on both sides.
BATCH_ROWS, BATCH_SETTING = 2_000, "spark.sql.execution.arrow.maxRecordsPerBatch"


def prepare(spark: SparkSession) -> None:
    """Ship the package to the workers, and make Arrow batches smaller unless the session has a size of its own."""
    ship(spark)
    if spark.conf.get(BATCH_SETTING) == "10000":
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))


def release() -> None:
    """Give freed memory back to the system: a worker lives on for other tasks, and what it keeps is missed by them."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
        if trim:
            trim(0)


_HELD: dict[str, object] = {}
_USED: set[str] = set()


def held(name: str, make: Callable[[], object]) -> object:
    """What ``make`` made under this name for an earlier task of this worker, else made now.

    A worker holds one such thing (a vocabulary's table, an index): before another is made, the last one goes.
    """
    _USED.add(name)
    if name not in _HELD:
        _HELD.clear()
        release()
        _HELD[name] = make()
    return _HELD[name]


def task_start(start: Callable | None = None, kernel: Callable | None = None) -> Callable | None:
    """``start()``, or ``kernel`` if there is none, with nothing held that this task does not use."""
    _USED.clear()
    work = start() if start else kernel
    if _HELD.keys() - _USED:
        for name in _HELD.keys() - _USED:
            del _HELD[name]
        release()
    return work


def fold_of(id_col: str, parts: int) -> Column:
    """crc32 of the id's decimal text (null: empty), modulo ``parts``."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(parts))


def texts_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text (null: empty); other columns cannot clash with the operators' own."""
    prepare(df.sparkSession)
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def map_texts(df: DataFrame, schema: str, names: list[str], kernel: Callable[[list[str]], list[list]], start: Callable | None = None, pass_chars: int = PASS_CHARS) -> DataFrame:
    """Apply ``kernel`` to the texts of ``df(doc_id, text)`` by Arrow batches.

    ``start()`` runs once per task and returns the kernel to use, so that heavy state is built on the executor.
    ``kernel`` gets at most about ``pass_chars`` characters (a longer text comes alone) and returns one list per column in ``names``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = task_start(start, kernel)
        out_schema = None
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            at, n = 0, len(texts)
            while at < n:
                part, size, end = [], 0, at
                while end < n and size < pass_chars:
                    t = texts[end].as_py()
                    if part and len(t) > pass_chars:
                        break
                    part.append(t)
                    size += len(t)
                    end += 1
                cols = work(part)
                if out_schema is None:
                    out_schema = pa.schema([("doc_id", pa.int64())] + [(name, kind) for name, kind in names])
                arrays = [ids.slice(at, end - at)] + [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(cols, list(out_schema)[1:])]
                yield pa.RecordBatch.from_arrays(arrays, schema=out_schema)
                at = end
        release()

    return df.mapInArrow(run, schema)


def keep_texts(df: DataFrame, start: Callable, text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all their columns as they are, whose text ``start()`` keeps: it gives a function from texts to booleans.

    Rows are judged where they lie, each by its own text; nothing is shuffled and no key is needed. Null texts are empty.
    """
    prepare(df.sparkSession)
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = task_start(start)
        for batch in batches:
            texts, begin = batch.column(at), 0
            while begin < len(texts):
                part, size, end = [], 0, begin
                while end < len(texts) and size < PASS_CHARS:
                    t = texts[end].as_py() or ""
                    if part and len(t) > PASS_CHARS:
                        break
                    part.append(t)
                    size += len(t)
                    end += 1
                yield batch.slice(begin, end - begin).filter(pa.array(np.asarray(keep(part), dtype=bool)))
                begin = end
        release()

    return df.mapInArrow(run, df.schema)


def below(share: float) -> int:
    """The 64-bit hashes (long) under this are a ``share`` of all: the full range, so that the least share of a very large table is not cut to none."""
    return min(int(share * 2.0**64), (1 << 64) - 1) - (1 << 63)


def bounded_sample(df: DataFrame, keys: list[str], rows: int, size_col: str | None = None, size: int = 0) -> tuple[DataFrame, int]:
    """(at most about ``rows`` rows, and about ``size`` of ``size_col``, chosen by a hash of ``keys``: the same at any partitioning; how many rows ``df`` has).

    Used only to fit classifiers. All rows are kept if they are within the bounds.
    """
    total = F.coalesce(F.sum(size_col), F.lit(0)) if size_col else F.lit(0)
    said = df.agg(F.count(F.lit(1)).alias("n"), total.alias("size")).first()
    share = min(1.0, rows / max(said["n"], 1), size / said["size"] if size_col and said["size"] else 1.0)
    return (df if share == 1.0 else df.where(F.xxhash64(*keys, F.lit("fit")) < below(share))), said["n"]


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int, size: int, longest: int) -> tuple[DataFrame, int]:
    """(``doc_id, th, text, label`` of a bounded sample of the labelled documents, how many of these there are).

    ``labels(label_id, label)`` has distinct ids. The sample is taken of documents that have a
    label, not of labels: distinct pairs of id and text, about ``rows`` of them and ``size``
    bytes of text at most, none longer than ``longest`` bytes. Only ids, hashes and lengths are
    shuffled; the keys of the sample, at most about ``rows``, are broadcast to fetch the texts.
    """
    texts = texts_of(docs).withColumn("th", F.xxhash64("text"))
    known = texts.select("doc_id", "th", F.octet_length("text").alias("size")).where(F.col("size") <= longest)
    marked = checkpoint(known.join(labels, known.doc_id == labels.label_id).select("label_id", "th", "size", "label").distinct())
    picked, n = bounded_sample(marked, ["label_id", "th"], rows, "size", size)
    picked = picked.withColumnRenamed("th", "label_th").drop("size")
    found = texts.join(F.broadcast(picked), (F.col("doc_id") == F.col("label_id")) & (F.col("th") == F.col("label_th")))
    return found.groupBy("doc_id", "th").agg(F.min("text").alias("text"), F.min("label").alias("label")), n


def fitted(sample: DataFrame, known: int, fit: Callable[[list[str], np.ndarray], object]) -> object | None:
    """What ``fit(texts, labels)`` makes of a bounded ``labelled_sample`` of ``known`` rows, in order of id and text hash.

    None if no row is known; a sample that is empty although some are is an error.

    The fit runs in one task, on an executor, so that the driver gets the model and no texts.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task_start()
        texts, labels = [], []
        for pdf in frames:
            texts += pdf["text"].tolist()
            labels += pdf["label"].tolist()
            del pdf
        made = pickle.dumps(fit(texts, np.array(labels, dtype=float))) if texts else None
        del texts, labels
        release()
        if made:
            yield pd.DataFrame({"model": [made]})

    rows = sample.repartition(1).sortWithinPartitions("doc_id", "th").select("text", "label")
    got = rows.mapInPandas(run, "model binary").collect()
    if known and not got:
        raise ValueError(f"no row of {known} labelled ones is in the sample")
    return pickle.loads(got[0]["model"]) if got else None
