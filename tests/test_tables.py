"""Table functions on small inputs: aliases, accounting, plans, quotes, skewed lookups and one-document exports."""

import json
import random
from pathlib import Path
from urllib.parse import unquote, urlparse

import pytest
from pyspark.sql import functions as F

from lumenpath.operators import graph, similarity, skew, windows
from lumenpath.plans import planner, stages, usage
from lumenpath.session import shared_dir
from lumenpath.sources import sinks


def test_alias_chains_and_cycles(spark):
    pairs = [("a", "b"), ("b", "c"), ("c", "d"), ("x", "y"), ("y", "x"), ("z", "x"), ("s", "s")]
    got = {(r.alias, r.canonical) for r in graph.settle_aliases(spark.createDataFrame(pairs, "alias string, canonical string")).collect()}
    assert got == {("a", "d"), ("b", "d"), ("c", "d")}


def test_links_in_export_order(spark):
    rows = [("b", "a", "related"), ("a", "b", "part_of"), ("a", "a", "prerequisite"), ("a", "b", "other"), ("a", "a", "part_of")]
    got = [tuple(r) for r in graph.by_rank(spark.createDataFrame(rows, "src string, dst string, type string")).collect()]
    assert got == [("a", "a", "prerequisite"), ("a", "a", "part_of"), ("a", "b", "part_of"), ("b", "a", "related"), ("a", "b", "other")]


def test_lookup_with_hot_and_null_keys(spark):
    big = spark.createDataFrame([(1 if i % 3 else i, i) for i in range(600)] + [(None, 900)], "k long, v long")
    small = spark.createDataFrame([(i, i * 10) for i in range(0, 600, 2)] + [(1, 10)], "k long, w long")
    assert skew.hot_keys(big, "k") == {1: 4}
    for how in ("inner", "left"):
        key = lambda rows: sorted(map(str, map(tuple, rows)))
        assert key(skew.lookup(big, small, "k", how).select("k", "v", "w").collect()) == key(big.join(small, "k", how).select("k", "v", "w").collect())


def test_accounting(spark):
    prompts = spark.createDataFrame([("a", "x" * 40), ("b", "y" * 8), ("c", "z")], "request_id string, prompt string")
    answers = spark.createDataFrame([("a", "ok", 1, False), ("b", "yes!", 0, True), ("c", None, 2, False)], "request_id string, answer string, retries int, cached boolean")
    calls = usage.estimated_calls(prompts, answers, "merge", "m")
    prices = spark.createDataFrame([("m", 1e6, 2e6)], "model string, price_in double, price_out double")
    (row,) = usage.usage(calls, prices).collect()
    assert (row.calls, row.cached, row.tokens_in, row.tokens_out, row.usd) == (3, 1, 21, 1, 23.0)
    assert usage.usage(calls, prices.limit(0)).first().usd == 0


def test_conflicts_of_many_plans(spark):
    courses = spark.createDataFrame([("A", 6, []), ("B", 6, ["A"]), ("C", 4, ["B", "Z"])], "code string, ects int, prerequisites array<string>")
    plans = spark.createDataFrame([(1, 0, "B", 1), (1, 1, "A", 1), (1, 2, "C", 1), (2, 0, "A", 1), (2, 1, "B", 2), (3, 0, "A", 1), (3, 1, "A", 3)], "plan int, pos int, code string, term int")
    got = [(r.plan, r.type, r.term, r.courses) for r in planner.plan_conflicts(plans, courses, 12).orderBy("plan", "ord").collect()]
    assert got == [
        (1, "credit_overload", 1, ["B", "A", "C"]),
        (1, "prerequisite_order", 1, ["A", "B"]),
        (1, "prerequisite_order", 1, ["B", "C"]),
        (3, "duplicate_course", 3, ["A"]),
    ]
    c = planner.Curriculum(courses.withColumns({"title": F.col("code"), "external": F.array().cast("array<string>")}), None)
    assert planner.best_drop(c, [("B", 1), ("A", 1), ("C", 1)], 12) == {"drop": "B", "left": 0}
    assert planner.best_drop(c, [("A", 1), ("B", 2)], 12) is None
    orders = {r.plan: (r.ordered, r.cyclic) for r in planner.recommended_orders(plans, courses).collect()}
    assert orders[1] == (["A", "B", "C"], []) and orders[2] == (["A", "B"], [])


def test_groups_are_skipped_unless_nothing_is_left(spark):
    rows = spark.createDataFrame([(0, "a"), (1, "b"), (None, "c")], "module int, name string")
    assert {r.name for r in stages.skip_groups(rows, "module", [0]).collect()} == {"b", "c"}
    assert stages.skip_groups(rows.where("module = 0"), "module", [0]).count() == 1


def test_quotes_of_every_length(spark, monkeypatch):
    docs = ["the quick brown fox jumps over it", "a fox", "", None, "unrelated words entirely different from that", "foxy lady"]
    quotes = ["quick brown fox jumps over", "ick brown fo", "brown fox", "fox", "ox", "x", "", None, "not there at all my friend", "fox jumps", "zzz"]
    d = spark.createDataFrame(list(enumerate(docs)), "d long, t string")
    q = spark.createDataFrame(list(enumerate(quotes)), "q long, t string")
    want = {(i, j) for i, x in enumerate(docs) for j, y in enumerate(quotes) if x and y and y in x}
    for most in (20_000, 0):
        monkeypatch.setattr(similarity, "MOST_KEYS", most)
        assert {tuple(r) for r in similarity.verbatim_pairs(d, q, "d", "t", "q", "t").collect()} == want


def test_trigram_pairs_equal_counting(spark):
    rng = random.Random(2)
    words = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "omega", "kappa"]) for _ in range(4)) for _ in range(60)]
    items = [(i, w, f"s{i % 2}") for i, w in enumerate([*words, words[0], words[0], ""])]
    grams = lambda w: {f"  {w}  "[k : k + 3] for k in range(len(w) + 2)} if w else set()
    for cutoff in (0.62, 0.9):
        want = {}
        for i, x, s in items:
            for j, y, r in items:
                if i < j and s == r and x and y:
                    score = len(grams(x) & grams(y)) / len(grams(x) | grams(y))
                    if score >= cutoff:
                        want[i, j] = round(score, 9)
        got = similarity.trigram_pairs(spark.createDataFrame(items, "id long, t string, s string"), "id", "t", "s", cutoff).collect()
        assert {(r.a, r.b): round(r.score, 9) for r in got} == want and len(got) == len(want)


def test_trigram_pairs_of_many_runs_take_less_room_than_the_texts(spark, monkeypatch):
    """Runs of few sets, one size of more sets than a run, null blocks and ids; trigrams are never rows of their own."""
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(4, 9))) for _ in range(3_000)]
    texts = [" ".join(rng.choice(words) for _ in range(500)) for _ in range(60)]
    # Copies with some words changed, and different sets of one size.
    texts += [" ".join(w if rng.random() > 0.04 else rng.choice(words) for w in texts[k % 60].split()) for k in range(60)] + [f"{a}{b}{c}" for a in "xyz" for b in "xyz" for c in "uvw"] + [texts[0]]
    items = [(i, t, f"s{i % 2}") for i, t in enumerate(texts)] + [(None, texts[0], "s0"), (900, texts[0], None), (901, None, "s0")]
    grams = [{f"  {t}  "[k : k + 3] for k in range(len(t) + 2)} for t in texts]
    score = lambda i, j: len(grams[i] & grams[j]) / len(grams[i] | grams[j])
    want = {(i, j): s for i in range(len(texts)) for j in range(i + 2, len(texts), 2) if (s := score(i, j)) >= 0.7}
    frame = spark.createDataFrame(items, "id long, t string, s string")
    folder = Path(unquote(urlparse(shared_dir(spark)).path))
    size = lambda: sum(f.stat().st_size for f in folder.rglob("part-*"))
    before = size()
    got = similarity.trigram_pairs(frame, "id", "t", "s", 0.7).collect()
    assert {(r.a, r.b): r.score for r in got} == want and len(got) == len(want) > 20
    assert size() - before < sum(len(t) for t in texts)
    monkeypatch.setattr(similarity, "RUNS", (7, 7))
    assert {(r.a, r.b): r.score for r in similarity.trigram_pairs(frame, "id", "t", "s", 0.7).collect()} == want


def cut(sizes, target):
    """Batch of each unit: largest first, cut at equal shares."""
    total = sum(sizes.values())
    n = total // max(1, target) + 1
    share, before, out = max(1, -(-total // n)), 0, {}
    for name in sorted(sizes, key=lambda x: (-sizes[x], x)):
        out[name] = min(before // share, n - 1)
        before += sizes[name]
    return out


@pytest.mark.parametrize("sizes", [[10 + i % 7 for i in range(50)], [900, 900, 5, 0, 0, 3] + [1] * 400, [0, 0], [7], []])
def test_batches_are_equal_shares(spark, sizes):
    names = {f"u{i}": n for i, n in enumerate(sizes)}
    units = spark.createDataFrame(list(names.items()), "unit string, chars int").repartition(7)
    got = {r.unit: r.batch for r in windows.balanced_batches(units, "unit", "chars", 100).collect()}
    assert got == cut(names, 100)
    for batch in set(got.values()):
        inside = sorted(names[u] for u in got if got[u] == batch)
        assert sum(inside) - inside[0] <= 100


def test_running_sums_over_many_partitions(spark):
    rng = random.Random(2)
    rows = [(i, rng.randrange(1_000)) for i in range(3_000)]
    got = windows.running_sums(spark.createDataFrame(rows, "id int, n long").repartition(13), [F.asc("id")], "n", "before").collect()
    assert {r.id: r.before for r in got} == {i: sum(n for _, n in rows[:i]) for i, _ in rows}


def test_one_document_of_all_tables(spark):
    tables = {"courses": spark.createDataFrame([("A", 1), ("B", 2)], "code string, n int"), "none": spark.createDataFrame([], "x int"), "links": spark.createDataFrame([("a", ["b"])], "src string, all array<string>")}
    text = "\n".join(r.value for r in sinks.whole_json(tables).collect())
    assert json.loads(text) == {"courses": [{"code": "A", "n": 1}, {"code": "B", "n": 2}], "none": [], "links": [{"src": "a", "all": ["b"]}]}
