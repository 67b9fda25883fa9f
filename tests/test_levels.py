import random

import pytest

from lumenpath.operators import dag


def peeled(edges):
    """Level by rounds of peeling; None on a cycle or behind one."""
    edges = {(u, v) for u, v in edges if u is not None and v is not None}, {x for e in edges for x in e if x is not None}
    left, todo = edges
    level, n = {}, 0
    while todo:
        ready = todo - {v for _, v in left}
        if not ready:
            break
        level.update(dict.fromkeys(ready, n))
        todo = todo - ready
        left = {(u, v) for u, v in left if u not in ready}
        n += 1
    return level | dict.fromkeys(todo)


def levels(spark, edges, kind="string"):
    rows = dag.levels(spark.createDataFrame(edges, f"src {kind}, dst {kind}")).collect()
    assert len({r.node for r in rows}) == len(rows)
    return {r.node: r.level for r in rows}


@pytest.mark.parametrize("bound", [200_000, 0])
def test_levels_equal_peeling(spark, monkeypatch, bound):
    monkeypatch.setattr(dag, "CORE_EDGES", bound)
    rng = random.Random(4)
    chains = [(f"c{i}", f"c{i + 1}") for i in range(40)] + [(f"t{i // 2}", f"t{i}") for i in range(1, 40)]
    chains += [("c40", "t3"), ("t39", "x"), ("c7", "x"), ("x", "y"), ("c20", "y")]
    rings = [("r0", "r1"), ("r1", "r2"), ("r2", "r0"), ("r2", "s0"), ("s0", "s1"), ("c5", "s1"), ("s1", "s2"), ("c0", "r1"), ("q", "q"), ("q", "p"), ("p", "o")]
    some = [(f"n{a}", f"n{b}") for a, b in ((rng.randrange(25), rng.randrange(25)) for _ in range(40)) if a < b or rng.random() < 0.1]
    edges = chains + rings + some + some[:5]
    assert levels(spark, edges) == peeled(edges)


@pytest.mark.parametrize("bound", [200_000, 0])
def test_nulls_and_empty_tables(spark, monkeypatch, bound):
    monkeypatch.setattr(dag, "CORE_EDGES", bound)
    assert levels(spark, []) == {}
    edges = [("a", None), (None, "b"), ("b", "c"), (None, None), ("b", "c")]
    assert levels(spark, edges) == {"a": 0, "b": 0, "c": 1}


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    monkeypatch.setattr(dag, "CORE_EDGES", 0)
    rounds, lookup = [], dag.lookup
    monkeypatch.setattr(dag, "lookup", lambda *a: rounds.append(1) or lookup(*a))
    n = 100_000
    chain = spark.range(n).selectExpr("id * 7 % 100003 src", "(id + 1) * 7 % 100003 dst")
    got = {r.node: r.level for r in dag.levels(chain).collect()}
    assert got == {i * 7 % 100003: i for i in range(n + 1)} and len(rounds) <= 25


def test_cyclic_core_is_what_peeling_from_both_ends_leaves(spark, monkeypatch):
    edges = [("a", "b"), ("b", "a"), ("b", "m"), ("m", "c"), ("c", "d"), ("d", "c"), ("in", "a"), ("d", "out"), ("out", "end"), ("x", "y")]
    for bound in (200_000, 0):
        monkeypatch.setattr(dag, "CORE_EDGES", bound)
        core = dag.cyclic_core(spark.createDataFrame([(*e, 1) for e in edges], "src string, dst string, more int"))
        assert {(r.src, r.dst) for r in core.collect()} == set(edges[:6])
        assert not dag.is_acyclic(spark.createDataFrame(edges, "src string, dst string"))
        assert dag.is_acyclic(spark.createDataFrame(edges[6:], "src string, dst string"))
