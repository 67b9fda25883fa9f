from pyspark.sql import functions as F

from lumenpath.operators import lessons

SYLLABUS = """Course outline, ignored
Week 1
Topic 2. Limits and Continuity
Lecture 1: Limits, one-sided limits and continuity of functions
Test 1
Week 2
Lecture 2
Deep Learning
• Perceptron; the chain rule
• Using gradient descent
• 2h problem solving
Topic 3. Derivatives
continues lecture two
Lecture 1: Derivatives/Integrals
7 (Week 3)
Power series. Taylor polynomials"""


def files(spark, *rows):
    return spark.createDataFrame(rows, "rel_path string, course_code string, text string")


def test_lessons_carry_week_and_topic_in_force(spark):
    got = lessons.split_lessons(files(spark, ("a", "C", SYLLABUS), ("b", "C", None), ("c", "C", "")), "rel_path", "text").orderBy("lesson").collect()
    assert [(r.lesson, r.kind, r.number, r.week, r.topic) for r in got] == [
        (1, "topic", 0, 1, "Limits and Continuity"),
        (2, "lecture", 1, 1, "Limits and Continuity"),
        (3, "lecture", 2, 2, "Limits and Continuity"),
        (4, "lecture", 1, 2, "Derivatives"),
        (5, "module", 7, 2, "Derivatives"),
    ]
    assert got[1].text == "Limits, one-sided limits and continuity of functions\nTest 1"
    assert got[2].text.endswith("continues lecture two") and got[4].text == "Power series. Taylor polynomials"


def test_names_units_and_links(spark):
    units, mentions = lessons.syllabus_units(files(spark, ("a", "C", SYLLABUS)))
    by = {r.unit_id: (r.module, r.unit, r.title) for r in units.collect()}
    assert by == {"C-TOP00": (1, 0, "Limits and Continuity"), "C-LEC01": (1, 1, "Limits, one-sided limits and continuity of functions"), "C-LEC02": (2, 2, "lecture 2"), "C-LEC01-4": (2, 1, "Derivatives/Integrals"), "C-MOD07": (2, 7, "module 7")}
    names = {}
    for r in mentions.orderBy("unit_id", "pos").collect():
        names.setdefault(r.unit_id, []).append(r.name)
    assert names["C-TOP00"] == ["Limits", "Continuity"]
    assert names["C-LEC01"] == ["Limits", "one-sided limits", "continuity of functions"]
    assert names["C-LEC02"] == ["Deep Learning", "Perceptron", "chain rule", "gradient descent"]
    assert names["C-LEC01-4"] == ["Derivatives", "Integrals"]
    assert names["C-MOD07"] == ["Power series", "Taylor polynomials"]
    links = {(r.src, r.dst, r.type) for r in lessons.structural_links(units, mentions, True).collect()}
    assert ("integrals", "derivatives", "part_of") in links and ("continuity", "limits", "part_of") in links
    assert ("limits", "derivatives", "prerequisite") in links and ("derivatives", "deep-learning", "prerequisite") in links
    assert not any(a == b for a, b, _ in links)
    assert not any(t == "prerequisite" for t in lessons.structural_links(units, mentions).select("type").toPandas()["type"])


def test_fragments_of_nulls_and_schedules(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "2h problem solving 2h; Exam; ab; Building neural networks, Neural Networks")], "id int, t string")
    assert [tuple(r) for r in lessons.fragment_names(df, ["id"], "t").collect()] == [(3, 3, "neural-networks", "neural networks")]
    assert df.select(lessons.is_admin(F.lit("6 class hours (problem solving: 6h)")).alias("x")).first().x
