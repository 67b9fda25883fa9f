import random

import pytest
from pyspark.sql import functions as F

from lumenpath.functions import text as T
from lumenpath.operators import dag, graph, similarity
from lumenpath.operators.components import connected_components
from lumenpath.plans import planner, quality
from lumenpath.sources import adapters, sinks


def column(spark, f, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.o for r in df.select("i", f(F.col("v")).alias("o")).orderBy("i").collect()]


def test_text_functions(spark):
    assert column(spark, T.slug, ["L1 & L2  Norm!", "", None, "Лекція"]) == ["l1-l2-norm", "", "", ""]
    assert column(spark, T.lesson_slug, ["Bayes' rule (part 2)"]) == ["bayes-rule"]
    assert column(spark, T.name_key, ["The Law of Large Numbers"]) == ["law large numbers"]
    assert column(spark, T.token_set, ["an inverse matrix", "Inverse matrix"]) == [["inverse", "matrix"]] * 2
    assert column(spark, T.fold, ["A hy-\n phen—ated “word”"]) == ["a hyphen ated word"]
    assert column(spark, lambda c: T.normalise(c, True), ["ﬁne ½", None]) == ["fine 1⁄2", ""]
    assert column(spark, T.guess_kind, ["Bayes theorem", "F1 score", "linear regression", "limits"]) == ["principle", "metric", "method", "definition"]
    assert column(spark, T.sql_literal, ["it's", "", None]) == ["'it''s'", "NULL", "NULL"]
    assert column(spark, T.html_text, ["<p>a &amp; b</p><script>x</script>c"]) == ["a & b\n c"]
    assert column(spark, T.trigrams, [None, "the"]) == [[], []]


def test_components_equal_union_find(spark):
    rng = random.Random(0)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(None, 1), (5, 5)]
    up = {}

    def root(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {v: root(v) for v in up}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_links(spark):
    rows = [("a", "b", "related", 0.5, 1), ("b", "a", "related", 0.7, 2), ("a", "b", "prerequisite", 0.4, 3), ("b", "a", "prerequisite", 0.4, 4), ("a", "x", "part_of", 1.0, 5), ("a", "a", "part_of", 1.0, 6), ("z", "b", "part_of", 0.2, 7)]
    links = spark.createDataFrame(rows, "src string, dst string, type string, strength double, ord int")
    nodes, alias = spark.createDataFrame([("a",), ("b",), ("c",)], "slug string"), spark.createDataFrame([("z", "c")], "alias string, canonical string")
    out = graph.antisymmetric_links(graph.strongest_links(graph.canonical_links(graph.valid_links(links), nodes, alias)))
    assert {(r.src, r.dst, r.type, r.strength) for r in out.collect()} == {("a", "b", "related", 0.7), ("a", "b", "prerequisite", 0.4), ("c", "b", "part_of", 0.2)}
    assert {r.slug: r.degree for r in graph.degrees(out, nodes).collect()} == {"a": 2, "b": 3, "c": 1}
    assert [r.slug for r in graph.roots(out).collect()] == ["a"]


def test_merge_groups(spark):
    v = spark.createDataFrame([("a", "b", True, "b"), ("b", "c", True, "b"), ("d", "e", False, "d"), ("a", "q", True, "q")], "slug_a string, slug_b string, same boolean, canonical string")
    nodes = spark.createDataFrame([(x,) for x in "abcde"], "slug string")
    assert {(r.alias, r.canonical) for r in graph.merge_groups(v, nodes).collect()} == {("a", "b"), ("c", "b")}


def test_cycles_and_order(spark):
    edges = spark.createDataFrame([("a", "b", 0.9), ("b", "c", 0.2), ("c", "a", 0.5), ("c", "d", 0.1)], "src string, dst string, strength double")
    assert not dag.is_acyclic(edges)
    assert {(r.src, r.dst) for r in dag.break_cycles(edges).collect()} == {("a", "b"), ("c", "a"), ("c", "d")}
    assert dag.topological_order(["C", "B", "A", "X", "Y"], [("A", "C"), ("X", "Y"), ("Y", "X")]) == (["A", "B", "C"], ["X", "Y"])


def test_candidates(spark):
    names = [("definite-integral", "definite integral"), ("indefinite-integral", "indefinite integral"), ("inverse-matrix", "Inverse matrix"), ("an-inverse-matrix", "an inverse matrix"), ("recall", "recall")]
    c = spark.createDataFrame([(s, n, "", []) for s, n in names], "slug string, name string, definition string, aliases array<string>")
    assert [(r.a, r.b, round(r.score, 3)) for r in similarity.merge_candidates(c).collect()] == [("an-inverse-matrix", "inverse-matrix", 1.0), ("definite-integral", "indefinite-integral", 0.944)]


def test_verbatim_counts_part_words_and_short_quotes(spark):
    d = spark.createDataFrame([(1, "xthe cat sat on the mats now"), (2, "a cat")], "doc_id long, text string")
    q = spark.createDataFrame([(1, "the cat sat on the mat"), (2, "cat"), (3, "!!"), (4, None)], "item_id long, text string")
    assert {tuple(r) for r in similarity.verbatim_pairs(d, q, "doc_id", "text", "item_id", "text").collect()} == {(1, 1), (1, 2), (2, 2)}


@pytest.fixture(scope="module")
def plan(spark):
    courses = [("CALC", "Calculus", 6, [], ["algebra"]), ("LINALG", "Linear Algebra", 3, [], []), ("ML", "Machine Learning", 6, ["CALC", "LINALG"], ["python"]), ("PROB", "Probability", 4, [], [])]
    concepts = [("LINALG", "s1", "an inverse matrix", "method", 0), ("LINALG", "s2", "rank", "definition", 1), ("PROB", "s3", "Inverse matrix", "definition", 0)]
    return planner.Curriculum(spark.createDataFrame(courses, "code string, title string, ects int, prerequisites array<string>, external array<string>"), spark.createDataFrame(concepts, "code string, slug string, name string, kind string, pos int"))


def test_plans(plan):
    v = planner.validate_study_plan(plan, ["ml", "PROB"], ["CALC"], 20)
    assert (v["valid"], v["total_ects"], v["violations"], v["recommended_order"]) == (False, 10, [{"course": "ML", "missing": "LINALG"}], ["ML", "PROB"])
    c = planner.detect_plan_conflicts(plan, [("LINALG", 1), ("ML", 1), ("PROB", 1)], 12)
    assert {x["type"] for x in c["conflicts"]} == {"credit_overload", "prerequisite_order"} and c["ects_by_term"] == {"1": 13}
    s = planner.suggest_substitution(plan, "LINALG", ["inverse matrix"], 1)
    assert (s["covered"], s["residual"], s["waivable"]) == (["an inverse matrix"], ["rank"], True)
    m = planner.compare_courses(plan, "LINALG", "PROB")
    assert m["related"] == [("an inverse matrix", "Inverse matrix")] and m["unique_to_a"] == ["an inverse matrix", "rank"]
    assert planner.what_if_drop(plan, [("ML", 1), ("PROB", 1)], "ml", 12)["ok"]
    with pytest.raises(ValueError, match=r"unknown_course_code: 'NOPE' is not one of the known courses \(CALC, LINALG, ML, PROB\)"):
        planner.validate_study_plan(plan, ["NOPE"])
    for bad in (lambda: planner.validate_study_plan(plan, []), lambda: planner.detect_plan_conflicts(plan, [("ML", 0)])):
        with pytest.raises(ValueError):
            bad()


def test_report(spark):
    concepts = spark.createDataFrame([("a", "long enough definition", ["X"], ["u1"], ["f"]), ("b", "", ["X", "Y"], ["u1", "u2"], ["f"])], "slug string, definition string, courses array<string>, units array<string>, files array<string>")
    links = spark.createDataFrame([("a", "b", "prerequisite", "extracted")], "src string, dst string, type string, origin string")
    occ, units = spark.createDataFrame([("a", "q")], "slug string, quote string"), spark.createDataFrame([("u1",), ("u2",), ("u3",)], "unit_id string")
    r = quality.report(concepts, links, occ, units)
    assert (r["components"], r["cross_course_links"], r["units_covered"], r["unit_coverage"], r["gate_passed"]) == (1, 1, 2, 0.6667, False)


def test_adapters_and_manifest(spark):
    assert adapters.registered() == ["kse", "mit", "syllabus"]
    paths = ["DBS/m2/DBS M2U3 Video 4 Transcript Part 1.pdf", "DBS/OM/OMU1 Notes.docx", "AI/.git/x.md", "AI/mod4/thing.txt", "AI/a.exe"]
    files = spark.createDataFrame([(p, "h", 1) for p in paths], "rel_path string, sha256 string, bytes long")
    got = {r.rel_path: r for r in adapters.manifest(files, "mit").collect()}
    assert set(got) == {paths[0], paths[1], paths[3]}
    a, b, c = got[paths[0]], got[paths[1]], got[paths[3]]
    assert (a.unit_id, a.asset_kind, a.asset_ordinal, a.part_ordinal) == ("DBS-M2U3", "video_transcript", 4, 1)
    assert (b.unit_id, b.asset_kind, c.module_ordinal, c.asset_kind) == ("DBS-OMU1", "notes", 4, "reading")
    k = spark.createDataFrame([("C/Модуль 2/Тема-3 Лекція.pdf", "h", 1)], "rel_path string, sha256 string, bytes long")
    assert [(r.module_ordinal, r.unit_ordinal, r.asset_kind) for r in adapters.manifest(k, "kse").collect()] == [(2, 3, "lesson")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("x", ["a", "b"], True, None)], "k string, l array<string>, f boolean, n string")
    assert sinks.write_csv({"t": df, "none": df.limit(0)}, f"file://{tmp_path}") == ["t"]
    assert spark.read.option("header", True).csv(f"file://{tmp_path}/t").collect()[0].l == "a|b"
