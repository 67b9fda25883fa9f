import io
import os
import sys
import tarfile
import time
import uuid

import pytest
from pyspark import cloudpickle
from pyspark.sql import Observation
from pyspark.sql import functions as F

from lumenpath.plans import assemble, models
from lumenpath.sources import course_archive

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MENTION = "unit_id string, slug string, name string, kind string, difficulty int, domain string, definition string, aliases array<string>, ord int"
OCC = "unit_id string, slug string, rel_path string, role string, quote string, confidence double, ord int"
LINK = "src string, dst string, type string, strength double, rationale string, origin string, ord int"


def test_build_merges_links_and_rejects(spark):
    m = spark.createDataFrame([
        ("u1", "k-means", "K-means", None, 0, "ml", "short", ["Lloyd", "k means"], 1),
        ("u2", "kmeans", "Kmeans", "method", 4, "", "a longer text", None, 2),
        ("u2", "svm", "", "method", 5, None, None, None, 3),
        ("u2", None, "Trees", "method", 3, None, "", None, 4),
        ("u9", "lost", "Lost", None, None, None, None, None, 5),
        ("u1", "  ", "", None, None, None, None, None, 6),
    ], MENTION)
    o = spark.createDataFrame([
        ("u1", "k-means", "f1", "", "a  quote", 0.0, 1),
        ("u2", "kmeans", "f2", "introduced", "b", 0.9, 2),
        ("u1", "k-means", "f1", "used", "a quote", 0.5, 3),
        ("u1", "k-means", "f2", "used", "outside", 0.5, 4),
        ("u2", "svm", "f2", None, " ", None, 5),
    ], OCC)
    ln = spark.createDataFrame([
        ("k-means", "svm", "prerequisite", 0.0, None, "extracted", 1),
        ("svm", "trees", "prerequisite", 0.9, "", "extracted", 2),
        ("trees", "kmeans", "prerequisite", 0.3, "", "extracted", 3),
        ("trees", "svm", "related", 0.3, "", "extracted", 4),
        ("kmeans", "k-means", "related", 0.3, "", "extracted", 5),
        ("svm", "nowhere", "related", 0.3, "", "extracted", 6),
    ], LINK)
    b = spark.createDataFrame([("svm", "trees", "related", 0.3, "b", "x", 1), ("svm", "unknown", "related", 0.9, "b", "x", 2)], LINK)
    units = spark.createDataFrame([("u1", "A"), ("u2", "B")], "unit_id string, course string")
    files = spark.createDataFrame([("u1", "f1"), ("u2", "f2")], "unit_id string, rel_path string")
    merges = spark.createDataFrame([("kmeans", "k-means"), ("svm", "gone")], "alias string, canonical string")
    g = assemble.build(m, o, ln, units, files, merges, b)
    c = {r.slug: r for r in g.concepts.collect()}
    assert set(c) == {"k-means", "svm", "trees"}
    k = c["k-means"]
    assert (k["name"], k.definition, k.difficulty, k.kind, k.domain, k.courses, k.aliases, k.occurrence_count, k.files) == ("K-means", "a longer text", 4, "definition", "ml", ["A", "B"], ["Kmeans", "Lloyd"], 2, ["f1", "f2"])
    assert c["svm"]["name"] == "Svm" and c["svm"].occurrence_count == 0
    links = {(r.src, r.dst, r.type): (r.strength, r.origin) for r in g.links.collect()}
    assert links == {("k-means", "svm", "prerequisite"): (0.5, "extracted"), ("svm", "trees", "prerequisite"): (0.9, "extracted"), ("svm", "trees", "related"): (0.3, "extracted")}
    assert {r.reason for r in g.rejects.collect()} == {"unknown unit", "file outside unit", "bridge to unknown slug"}
    assert k.degree == 1 and c["svm"].degree == 3
    shown = assemble.explore(g, ["A"], 0, text="MEANS")
    assert [r.slug for r in shown.concepts.where("match").collect()] == ["k-means"] and shown.links.count() == 0
    assert {r.request_id for r in models.name_prompts(g.concepts, 1).collect()} == {"ml#0", "?#0", "?#1"}
    pairs = spark.createDataFrame([("k-means", "svm", 0.9, "name similarity")], "a string, b string, score double, reason string")
    assert models.pair_prompts(pairs, g.concepts).first().prompt.startswith("### PAIR k-means  <>  svm   (name similarity, score 0.9)\n- k-means | K-means")


def test_free_graph_of_a_syllabus(spark):
    files = spark.createDataFrame([("a.txt", "C", "Topic 1. Limits\nLecture 1: Limits, Continuity\nLecture 2: Series, Power series")], "rel_path string, course_code string, text string")
    g = assemble.free(files, sequential=True)
    assert {(r.src, r.dst, r.type) for r in g.links.collect()} == {("continuity", "limits", "part_of"), ("series", "limits", "part_of"), ("power-series", "limits", "part_of"), ("limits", "series", "prerequisite")}
    assert g.rejects.count() == 0 and g.concepts.where("occurrence_count = 0").count() == 0


def test_answers_are_cached_retried_and_counted(spark, tmp_path):
    req = spark.createDataFrame([(1, "good"), (2, "bad"), (3, "fixable")], "request_id int, prompt string")

    def call(p):
        if p.startswith("bad") or p == "fixable":
            raise ValueError("no")
        return p.split("\n")[0].upper()

    cache = f"file://{tmp_path}/cache"
    first = {r.request_id: r for r in models.ask_all(req, call, cache=cache, wait=0).collect()}
    assert (first[1].answer, first[2].error, first[3].answer, first[3].retries) == ("GOOD", "ValueError: no", "FIXABLE", 1)
    again = models.ask_all(req, call, cache=cache, wait=0)
    assert {r.request_id: r.cached for r in again.collect()} == {1: True, 2: False, 3: True}
    assert models.require_most(again).count() == 2
    with pytest.raises(RuntimeError):
        models.require_most(again.where("request_id = 2"))
    said = spark.createDataFrame([("b", 0, "x"), ("b", 1, "u2"), ("c", 0, "y")], "batch string, pos int, unit_id string")
    want = spark.createDataFrame([("b", 0, "u1"), ("b", 1, "u2"), ("c", 0, "u3"), ("c", 1, "u4")], "batch string, pos int, unit_id string")
    assert {tuple(r) for r in models.repair_unit_ids(said, want).select("batch", "pos", "unit_id").collect()} == {("b", 0, "u1"), ("b", 1, "u2"), ("c", 0, "y")}


def counted(folder, fail=None):
    """A model that leaves a file for every call, works a while, and takes its process down at the prompt ``fail``."""
    place = str(folder)
    os.makedirs(place, exist_ok=True)

    def call(p):
        if p == fail:
            time.sleep(1.5)
            os._exit(1)
        with open(os.path.join(place, f"{p}.{uuid.uuid4().hex}"), "w"):
            pass
        time.sleep(0.1)
        return p.upper()

    return call


def test_a_task_that_dies_pays_for_no_answer_twice(spark, tmp_path):
    req = spark.range(12).selectExpr("cast(id as int) request_id", "concat('p', id) prompt").coalesce(1)
    cache, paid = f"{tmp_path}/cache", tmp_path / "paid"
    with pytest.raises(Exception):
        models.ask_all(req, counted(paid, "p5"), cache=cache, wait=0)
    before = sorted(n.split(".")[0] for n in os.listdir(paid))
    assert len(before) > 4 and len(set(before)) == len(before)
    seen = Observation()
    got = models.ask_all(req, counted(paid), cache=cache, wait=0, seen=seen)
    assert {r.request_id: r.answer for r in got.collect()} == {i: f"P{i}" for i in range(12)}
    assert sorted(n.split(".")[0] for n in os.listdir(paid)) == sorted(f"p{i}" for i in range(12))
    n = len(before)
    assert (seen.get["calls"], seen.get["noted"], seen.get["retries"], seen.get["failed"]) == (12 - n, n, 0, 0)
    assert not os.path.exists(f"{cache}-notes") and got.where("cached").count() == n


def test_calls_run_at_once_and_equal_prompts_are_one(spark, tmp_path):
    req = spark.createDataFrame([(i, f"q{i % 30}") for i in range(60)] + [(60, None)], "request_id int, prompt string").coalesce(1)
    paid = tmp_path / "paid"
    for cache in (None, f"{tmp_path}/cache", f"{tmp_path}/cache"):
        rows = {r.request_id: r for r in models.ask_all(req, counted(paid), cache=cache).collect()}
        assert len(rows) == 61 and all(rows[i].answer == f"Q{i % 30}" for i in range(60))
        assert rows[60].answer is None and rows[60].error == "ValueError: no prompt"
    assert len(os.listdir(paid)) == 60


def test_calls_of_a_task_are_under_way_at_once(spark, tmp_path):
    place = str(tmp_path)

    def call(p):
        open(os.path.join(place, p), "w").close()
        until = time.time() + 10
        while len(os.listdir(place)) < 3 and time.time() < until:
            time.sleep(0.05)
        return str(len(os.listdir(place)))

    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        got = models.ask_all(spark.createDataFrame([(i, f"q{i}") for i in range(3)], "request_id int, prompt string"), call, at_once=3)
        assert [r.answer for r in got.collect()] == ["3"] * 3
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def archive(files):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w:gz") as tar:
        for name, text in files.items():
            info = tarfile.TarInfo(name)
            info.size = len(text.encode())
            tar.addfile(info, io.BytesIO(text.encode()))
    return out.getvalue()


def test_course_archive(spark):
    full = archive({
        "course/course.xml": "<course><fullname>Signals</fullname><shortname>SIG</shortname></course>",
        "sections/section_7/section.xml": '<section id="7"><number>2</number><name>Filters</name><summary>&lt;p&gt;All about linear filters&lt;/p&gt;</summary></section>',
        "activities/page_1/module.xml": "<module><sectionid>7</sectionid><sectionnumber>9</sectionnumber></module>",
        "activities/page_1/page.xml": "<activity><page><name>Low pass</name><content>&lt;p&gt;Cuts high &amp;amp; keeps low&lt;/p&gt;&lt;script&gt;x&lt;/script&gt;</content><intro>Low pass</intro><summary>Low pass</summary><name>Low pass</name></page></activity>",
        "activities/page_1/grades.xml": "<a><name>never read this text here</name></a>",
        "activities/url_2/url.xml": "<broken",
        "files.xml": "<files><file><filename>a.pdf</filename><contenthash>ab1</contenthash></file><file><filename>a.pdf</filename><contenthash>ab2</contenthash></file><file><filename>v.mp4</filename><contenthash>ab1</contenthash></file><file><filename>.</filename><contenthash>ab1</contenthash></file></files>",
        "files/ab/ab1": "one",
        "files/ab/ab2": "two",
        "../evil.xml": "<a><name>evil</name></a>",
    })
    rows = [("/x/full.mbz", full), ("/x/shell.mbz", archive({"activities/url_1/url.xml": "<a><name>a link to somewhere else</name></a>"})), ("/x/broken.mbz", b"no tar")]
    texts, files, report = course_archive.unpack(spark.createDataFrame(rows, "path string, content binary"))
    got = {(r.path[3:7], r.section, r.part): r.body for r in texts.collect()}
    assert got[("full", 2, "section_summary")] == "All about linear filters"
    assert got[("full", 2, "page_1")] == "[name] Low pass\n[content] Cuts high & keeps low\n[intro] Low pass\n[summary] Low pass"
    assert {r.name: bytes(r.content) for r in files.collect()} == {"a.pdf": b"one", "a_1.pdf": b"two"}
    rep = {r.path[3:-4]: r for r in report.collect()}
    assert (rep["full"].course, rep["full"].sections, rep["full"].activities, rep["full"].by_type, rep["full"].documents, rep["full"].skipped_media, rep["full"].note) == ("Signals", 1, 2, {"page": 1, "url": 1}, 2, 1, None)
    assert rep["shell"].course == "shell" and rep["shell"].note.startswith("course shell only") and rep["broken"].activities == 0
