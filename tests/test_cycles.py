import random

from lumenpath.operators import dag


def reaches(edges, start, goal):
    kids, seen, todo = {}, {start}, [start]
    for u, v in edges:
        kids.setdefault(u, []).append(v)
    while todo:
        for v in kids.get(todo.pop(), ()):
            if v not in seen:
                seen.add(v)
                todo.append(v)
    return goal in seen


def closing(rows):
    """Strongest first, the edges that close a cycle with those kept before."""
    kept, gone = [], set()
    for u, v, _ in sorted(rows, key=lambda r: (r[2], r[0], r[1]), reverse=True):
        if reaches(kept, v, u):
            gone.add((u, v))
        else:
            kept.append((u, v))
    return gone


def frame(spark, rows):
    return spark.createDataFrame(rows, "src string, dst string, strength double")


def broken(spark, rows):
    return {(r.src, r.dst) for r in dag.break_cycles(frame(spark, rows)).collect()}


def test_an_edge_whose_cycle_is_broken_already_stays(spark, monkeypatch):
    # a->b lies on b->a only, and that one closes the stronger b->a, a->c, c->b.
    rows = [("a", "b", 1.0), ("b", "a", 2.0), ("a", "c", 3.0), ("c", "b", 3.5)]
    for bound in (200_000, 2):
        monkeypatch.setattr(dag, "CORE_EDGES", bound)
        assert broken(spark, rows) == {("a", "b"), ("a", "c"), ("c", "b")}


def test_closing_edges_equal_plain_search():
    rng = random.Random(5)
    for n, m in ((3, 8), (12, 60), (40, 160), (200, 500)):
        for _ in range(20):
            edges = list({(rng.randrange(n), rng.randrange(n)) for _ in range(m)})
            rng.shuffle(edges)
            kept, gone = [], []
            for i, (u, v) in enumerate(edges):
                if reaches(kept, v, u):
                    gone.append(i)
                else:
                    kept.append((u, v))
            assert dag.closing_edges(edges) == gone
    ring = [(i, i + 1) for i in range(5_000)] + [(5_000, 0)]
    assert dag.closing_edges(ring) == [5_000] and dag.closing_edges([]) == []


def test_an_edge_between_two_cycles_stays_at_any_size(spark, monkeypatch):
    rows = [("a", "b", 5.0), ("b", "a", 6.0), ("c", "d", 7.0), ("d", "c", 8.0), ("b", "c", 1.0)]
    for bound in (200_000, 3):
        monkeypatch.setattr(dag, "CORE_EDGES", bound)
        assert broken(spark, rows) == {("b", "a"), ("d", "c"), ("b", "c")}


def test_small_graphs_equal_the_rule(spark):
    rng = random.Random(3)
    for n in (2, 4, 6):
        pairs = [(f"n{a}", f"n{b}") for a in range(n) for b in range(n) if a != b and rng.random() < 0.7]
        rows = [(u, v, float(rng.randrange(4))) for u, v in pairs]
        assert broken(spark, rows) == set(pairs) - closing(rows)
    odd = [("a", "a", 1.0), ("a", "b", 1.0), ("a", "b", 3.0), ("b", "a", 2.0)]
    assert broken(spark, odd) == {("b", "a")} and broken(spark, []) == set()


def test_a_large_graph_is_the_same_in_one_task_and_in_halves(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(f"n{rng.randrange(60)}", f"n{rng.randrange(60)}", rng.random()) for _ in range(300)]
    rows += [(f"m{i}", f"m{i + rng.randrange(-3, 40)}", rng.random()) for i in range(3, 10_000)]
    rows = [r for r in {(u, v): (u, v, w) for u, v, w in rows}.values() if r[0] != r[1]]
    whole = broken(spark, rows)
    gone = {r[:2] for r in rows} - whole
    assert len(rows) > 9_500 and gone and dag._tarjan(list(whole)) == {}
    for u, v in random.Random(1).sample(sorted(gone), 40):
        assert reaches(whole, v, u)
    monkeypatch.setattr(dag, "CORE_EDGES", 4_000)
    assert broken(spark, rows) == whole
