import glob
import os
import sys
import uuid

import pytest
from pyspark import cloudpickle

import test_stages
from lumenpath.plans import stages
from lumenpath.sources import changes

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(test_stages)

TEXTS = {"Calculus": "Limits: what a sequence comes near to\n", "Machine_Learning": "Losses: how wrong a model is\n", "Probability_Essentials": "Events: sets of outcomes of a trial\n", "Statistics": "Samples: rows that were drawn\n"}


@pytest.fixture
def root(tmp_path):
    folder = tmp_path / "in" / "set [1]"
    folder.mkdir(parents=True)
    for name, text in TEXTS.items():
        (folder / f"Syllabus_{name}.md").write_text(text)
    return folder


def noted(folder):
    """An extractor that leaves a file with the units of every prompt it is asked."""
    folder.mkdir()
    place, extract = str(folder), test_stages.extract

    def call(prompt):
        with open(os.path.join(place, uuid.uuid4().hex), "w") as f:
            f.write(" ".join(line.split()[2] for line in prompt.splitlines() if line.startswith("# UNIT ")))
        return extract(prompt)

    return call


def asked(folder):
    return sorted(open(f).read() for f in glob.glob(f"{folder}/*"))


def rows(spark, path, *names):
    return sorted(tuple(r) for r in spark.read.parquet(path).select(*names).collect())


def test_only_changed_added_and_deleted_files_are_worked_on(spark, root, tmp_path):
    out, first, second = str(tmp_path / "out"), tmp_path / "first", tmp_path / "second"
    go = lambda call, to: stages.run(spark, str(root.parent), to, "syllabus", {"extract": call}, batch_chars=38, stop_after="graph")
    assert go(noted(first), out)["made"] == stages.STAGES[:6]
    before = set(glob.glob(f"{out}/texts/texts/bucket=*/*.parquet"))
    live = {r.rel_path.split("/")[1]: r.batch for r in stages.Stages(spark, out).live("bundle", "files").join(stages.Stages(spark, out).live("bundle", "batches"), "unit_id").collect()}
    assert len(live) == 4

    (root / "Syllabus_Calculus.md").write_text("Limits: what a sequence comes near to\nSeries: sums without an end\n")
    (root / "Syllabus_Linear_Algebra.md").write_text("Vectors: arrows that add up\n")
    (root / "Syllabus_Probability_Essentials.md").unlink()
    os.utime(root / "Syllabus_Statistics.md", (1, 1))
    assert go(noted(second), out)["made"] == stages.STAGES[:6]
    # Batches without a concerned file are not asked again, keep their number, and their files stay as they are.
    hit = {live["Syllabus_Calculus.md"], live["Syllabus_Probability_Essentials.md"]}
    again = {u.split("-")[0] for line in asked(second) for u in line.split()}
    with_hit = {"CALC": "Syllabus_Calculus.md", "ML": "Syllabus_Machine_Learning.md", "S": "Syllabus_Statistics.md"}
    assert again == {"LINALG"} | {code for code, name in with_hit.items() if live[name] in hit}
    s = stages.Stages(spark, out)
    now = {r.rel_path.split("/")[1]: r.batch for r in s.live("bundle", "files").join(s.live("bundle", "batches"), "unit_id").collect()}
    assert set(now) == {f"Syllabus_{n}.md" for n in ("Calculus", "Linear_Algebra", "Machine_Learning", "Statistics")}
    assert all(now[n] == b for n, b in live.items() if n in now and b not in hit)
    assert min(b for n, b in now.items() if n not in live or live[n] in hit) > max(live.values())
    assert len(before & set(glob.glob(f"{out}/texts/texts/bucket=*/*.parquet"))) >= 2
    gone = spark.read.parquet(f"{out}/texts/texts").where("gone and rel_path is not null").collect()
    assert [(r.rel_path.split("/")[1], r.text) for r in gone] == [("Syllabus_Probability_Essentials.md", None)]
    # The same as from the start.
    whole = str(tmp_path / "whole")
    go(test_stages.extract, whole)
    for table, names in (("graph/concepts", ("slug", "definition", "files")), ("graph/links", ("src", "dst", "type")), ("graph/occurrences", ("slug", "rel_path", "quote")), ("scan/manifest", ("rel_path", "sha256"))):
        assert rows(spark, f"{out}/{table}", *names) == rows(spark, f"{whole}/{table}", *names)

    # A new time alone is looked at once and changes nothing; nothing new, nothing made.
    os.utime(root / "Syllabus_Calculus.md", (2, 2))
    assert go(None, out)["made"] == ["scan"]
    assert go(None, out)["made"] == []


def test_a_run_that_stopped_inside_an_update_makes_the_stage_whole(spark, root, tmp_path):
    out = str(tmp_path / "out")
    go = lambda: stages.run(spark, str(root.parent), out, "syllabus", {}, stop_after="texts")
    go()
    (root / "Syllabus_Calculus.md").write_text("Series: sums without an end\n")
    merge, stages.Stages._merge = stages.Stages._merge, None
    try:
        with pytest.raises(TypeError):
            go()
    finally:
        stages.Stages._merge = merge
    assert go()["made"] == ["texts"]
    texts = {r.rel_path.split("/")[1]: r.text for r in stages.Stages(spark, out).live("texts", "texts").collect()}
    assert len(texts) == 4 and texts["Syllabus_Calculus.md"].strip() == "Series: sums without an end"


def test_a_stage_that_is_made_again_unmarks_the_later_ones_first(spark, root, tmp_path):
    out = str(tmp_path / "out")
    go = lambda **more: stages.run(spark, str(root.parent), out, "syllabus", {}, stop_after="bundle", **more)
    go()
    stages.run(spark, str(root.parent), out, "syllabus", {}, stop_after="texts", force=["texts"])
    assert go()["made"] == ["bundle"]


def test_many_files_are_read_by_a_join(spark, root, monkeypatch):
    wanted = changes.listing(spark, str(root.parent)).where("rel_path like '%Calculus%' or rel_path like '%Statistics%'")
    by_name = sorted(map(tuple, changes.contents(spark, str(root.parent), wanted).collect()))
    monkeypatch.setattr(changes, "FILES_BY_NAME", 1)
    assert len(by_name) == 2 and sorted(map(tuple, changes.contents(spark, str(root.parent), wanted).collect())) == by_name
    assert changes.contents(spark, str(root.parent), wanted.limit(0)).count() == 0
