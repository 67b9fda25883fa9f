import random

from pyspark.sql import functions as F

from lumenpath.operators import components, skew
from lumenpath.plans import catalog


def test_components_of_all_links_equal_union_find(spark, tmp_path):
    """Links of any quantity and discount join components, and nodes without a link stand alone."""
    links = [(1, 1, 1, 0.0), (2, 1, 10, 0.05), (2, 2, 50, 0.1), (3, 3, 50, 0.1), (4, 3, 49, 0.1), (5, 4, 2, 0.02), (5, 4, 2, 0.02)]
    spark.createDataFrame(links, "l_partkey long, l_suppkey long, l_quantity long, l_discount double").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(i,) for i in range(1, 8)], "p_partkey long").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(i,) for i in range(1, 7)], "s_suppkey long").write.parquet(f"{tmp_path}/supplier.parquet")
    up = {n: n for n in [f"p{i}" for i in range(1, 8)] + [f"s{i}" for i in range(1, 7)]}
    for p, s, *_ in links:
        low, high = sorted((up[f"p{p}"], up[f"s{s}"]))
        up = {n: low if u == high else u for n, u in up.items()}
    got = catalog.queries()["components_whole"](spark, str(tmp_path)).collect()
    assert {r.node: r.component for r in got} == up and len(got) == len(up)


def test_components_are_the_same_joined_at_once_or_in_rounds(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(f"n{rng.randrange(400)}", f"n{rng.randrange(400)}") for _ in range(230)] + [(None, "n1"), ("n2", None), ("é", "z"), ("z", "\U0001f600")]
    rows += [("hub", f"h{i}") for i in range(300)] + [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(60)]
    edges = spark.createDataFrame(rows, "src string, dst string")
    once = {tuple(r) for r in components.connected_components(edges).collect()}
    monkeypatch.setattr(components, "FINISH_EDGES", 0)
    assert {tuple(r) for r in components.connected_components(edges).collect()} == once
    assert components.connected_components(edges.limit(0)).count() == 0


def test_a_hot_key_is_dealt_into_parts(spark):
    big = spark.range(20_000).select((F.col("id") % 7).alias("k"), "id").withColumn("k", F.when(F.col("id") % 3 == 0, 99).otherwise(F.col("k")))
    small = spark.createDataFrame([(k, f"v{k}") for k in [*range(5), 99]], "k long, v string")
    hot = skew.hot_keys(big, "k")
    assert set(hot) == {*range(7), 99} and hot[99] > 60 and sum(hot.values()) <= 2 * skew.HOT_SHARE
    for how in ("inner", "left"):
        got, want = skew.lookup(big, small, "k", how), big.join(small, "k", how)
        assert got.columns == want.columns and sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


def test_edges_of_a_task_are_thinned_to_a_forest_before_they_are_shuffled(spark, monkeypatch):
    monkeypatch.setattr(components, "CHUNK", 1_000)
    edges = spark.range(0, 20_000, 1, 2).select((F.hash("id") % 150).cast("long").alias("a"), (F.hash("id", F.lit(1)) % 150).cast("long").alias("b")).where("a <> b")
    few = components.thinned(edges)
    assert few.count() <= 2 * 300
    assert {tuple(r) for r in components.connected_components(few, "a", "b").collect()} == {tuple(r) for r in components.joined(edges).collect()}
