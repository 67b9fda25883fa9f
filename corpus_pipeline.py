"""The corpus pipeline: five stages, each taking what its predecessor kept.

Every stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as Parquet and
read again for the next. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from lumenpath.llm import bpe_automaton, decontaminate, language_id, near_copies, toxicity
from lumenpath.llm.common import fold_of
from lumenpath.llm.queries import vocabulary
from lumenpath.session import remove, shared_dir, table, trim_executors

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A document stays if its language is known with at least this probability.
LANGUAGE_SURE = 0.5


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language is unknown: no letter, or no language above LANGUAGE_SURE."""
    return language_id.keep_known(docs, fold_of("doc_id", 4) != 2, LANGUAGE_SURE).select(COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents predicted toxic."""
    return toxicity.keep_harmless(docs, table(spark, sf_dir, "labels")).select(COLUMNS)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near copies: five-word shingles, similarity 0.8."""
    trim_executors(spark)
    return near_copies.keep_first(docs).select(COLUMNS)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark")).select(COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode every document that is left and decode it again: ids and decoded text beside their digests."""
    trim_executors(spark)
    return bpe_automaton.encode_decode(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("language_id", keep_known_language),
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", keep_one_of_near_copies),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("bpe_encode_decode", encode),
]
#: SQL can express none of these stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again; a stage's table goes when the next is whole."""
    docs, folder, before = table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}", None
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs
