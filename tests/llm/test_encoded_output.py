from pyspark.sql import functions as F

from lumenpath.llm import bpe_automaton, queries

TEXTS = [(1, "Hello, wörld!  Twice\n twice."), (2, ""), (3, None), (4, "日本語 and 123")]


def test_the_pipeline_writes_ids_and_decoded_text(spark):
    import corpus_pipeline

    out = {r.doc_id: r for r in corpus_pipeline.encode(spark, spark.createDataFrame(TEXTS, "doc_id long, text string"), "").collect()}
    assert all(len(out[i].ids) == out[i].n_tokens for i, _ in TEXTS) and out[1].n_tokens > 3 and out[1].decoded


def test_op1_derives_its_digests_from_the_operators_output(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    plain = {r.doc_id: tuple(r) for r in bpe_automaton.encode_decode(docs, queries.vocabulary("word_bpe_49k.json"), full=False).collect()}
    assert {r.doc_id: tuple(r) for r in queries.op1_bpe_encode_decode(spark, str(tmp_path)).collect()} == plain
    real = bpe_automaton.encode_decode
    monkeypatch.setattr(bpe_automaton, "encode_decode", lambda *a, **b: real(*a, **b).withColumn("ids_sha256", F.lit("")).withColumn("decoded_sha256", F.lit("")))
    assert {r.doc_id: tuple(r) for r in queries.op1_bpe_encode_decode(spark, str(tmp_path)).collect()} == plain
