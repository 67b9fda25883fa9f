"""The operators as driver queries over whole tables, with production parameters."""

from __future__ import annotations

import importlib.util
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenpath.llm import bpe_automaton, centroids, decontaminate, language_id, piece_bpe, quality, simhash_trie, sstable, syncmers, token_counts, toxicity, url_rules, whitening
from lumenpath.llm.common import fold_of
from lumenpath.session import table


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file: in the folder that LUMENPATH_TOKENIZERS names, else in the installed package."""
    folder = os.environ.get("LUMENPATH_TOKENIZERS")
    if not folder:
        folder = os.path.dirname(importlib.util.find_spec("public_tokenizers").origin)
    return os.path.join(folder, name)


def op1_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = bpe_automaton.encode_decode(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    digest = lambda text: F.sha2(F.encode(text, "UTF-8"), 256)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return said.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), digest(ids).alias("ids_sha256"), digest(F.col("decoded")).alias("decoded_sha256"))


def op2_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprint_with_edits(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = language_id.identify(table(spark, sf_dir, "documents"), fold_of("doc_id", 4) != 2)
    return said.select("doc_id", (fold_of("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_trie.near_duplicates(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), limit=512)


def op7_token_id_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sstable.encode_to_shards(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=1)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.7)
    return said.select("doc_id", (fold_of("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.5)
    return said.select("doc_id", (fold_of("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.described(table(spark, sf_dir, "embeddings"))


def op12_byte_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = piece_bpe.encode_decode(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_multi_50k.tiktoken"))
    return said.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.components_of(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_bpe_encode_decode, op2_syncmer_fingerprints, op3_decontamination, op4_language_id, op5_simhash_near_dedup, op6_token_counts, op7_token_id_shards, op8_quality, op9_toxicity, op10_url_filters, op11_centroid_clustering, op12_byte_bpe_encode_decode, op13_embedding_whitening)}


def oracle_sql() -> dict[str, str]:
    """None of these can be written in SQL that the oracle runs: each needs a vocabulary file, XXH64, a fitted model or mined rules."""
    return {}
