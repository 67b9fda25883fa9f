"""What stages leave in an executor's memory beside the next one's work."""

import corpus_pipeline
from lumenpath.operators.skew import lookup
from lumenpath.session import small_table, trim_executors


def collections(spark) -> int:
    """Full collections of the JVM, which in local mode is the executor too."""
    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    return sum(b.getCollectionCount() for b in beans if "Old" in b.getName() or "MarkSweep" in b.getName())


def test_hot_keys_need_no_python_workers_of_their_own(spark):
    big = spark.range(300).selectExpr("id % 3 AS k", "id")
    small = spark.createDataFrame([(0, "a"), (1, "b"), (5, "c")], "k long, name string").localCheckpoint()
    for hot in ({0: 3, 7: 2}, {1: 4}):
        joined = lookup(big, small, "k", hot=hot)
        # The scan of ``small`` is the only table that was an RDD, once in the join.
        assert joined._jdf.queryExecution().executedPlan().toString().count("ExistingRDD") == small._jdf.queryExecution().executedPlan().toString().count("ExistingRDD")
        want = sorted((i % 3, i, "ab"[i % 3]) for i in range(300) if i % 3 < 2)
        assert sorted((r["k"], r["id"], r["name"]) for r in joined.collect()) == want


def test_a_small_table_has_its_rows_and_kinds(spark):
    rows = [(-(1 << 63), "x", 1), ((1 << 63) - 1, None, 2)]
    made = small_table(spark, rows, {"a key": "bigint", "s": "string", "n": "int"})
    assert made.dtypes == [("a key", "bigint"), ("s", "string"), ("n", "int")]
    assert [tuple(r) for r in made.collect()] == rows
    other = small_table(spark, [(0.5, 1)], {"k": "double", "n": "int"})
    assert other.dtypes == [("k", "double"), ("n", "int")] and [tuple(r) for r in other.collect()] == [(0.5, 1)]


def test_executors_collect_their_garbage(spark):
    before = collections(spark)
    trim_executors(spark)
    assert collections(spark) > before


def test_the_stages_of_most_memory_begin_on_trimmed_executors(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "one two three", "en", "web", 13)], "doc_id long, text string, lang string, source string, n_chars long")
    seen = []
    monkeypatch.setattr(corpus_pipeline, "trim_executors", lambda s: seen.append(s))
    monkeypatch.setattr(corpus_pipeline.near_copies, "keep_first", lambda d: d)
    for stage in (corpus_pipeline.keep_one_of_near_copies, corpus_pipeline.encode):
        assert [r["doc_id"] for r in stage(spark, docs, "").select("doc_id").collect()] == [1]
    assert len(seen) == 2
