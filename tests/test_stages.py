import json
import re
import sys

import pytest
from pyspark import cloudpickle

from lumenpath import __main__ as cli
from lumenpath.plans import models, planner, quality, stages
from lumenpath.streaming.ingest import ingest

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def extract(prompt):
    """Every line "term: meaning" of a file is a concept; each one leads to the next."""
    units = []
    for part in re.split(r"(?m)^# UNIT ", prompt)[1:]:
        unit, concepts = part.split("\n", 1)[0].strip(), []
        for section in re.split(r"(?m)^### FILE: ", part)[1:]:
            path, body = section.split("\n", 1)
            for term, meaning in re.findall(r"(?m)^([A-Z][\w -]+): (.+)$", body):
                concepts.append({"slug": "", "name": term, "kind": "definition", "definition": meaning, "difficulty": 2, "domain": "d", "aliases": [], "occurrences": [{"rel_path": path.strip(), "role": "introduced", "quote": f"{term}: {meaning}", "confidence": 0.9}]})
        links = [{"src": a["name"], "dst": b["name"], "type": "prerequisite", "strength": 0.6, "rationale": ""} for a, b in zip(concepts, concepts[1:])]
        units.append({"unit_id": unit, "concepts": concepts, "links": links})
    return json.dumps({"units": units})


def merge(prompt):
    pairs = re.findall(r"(?m)^### PAIR (\S+)  <>  (\S+)", prompt)
    return json.dumps({"verdicts": [{"slug_a": a, "slug_b": b, "same": {a, b} == {"limit-value", "limits-value"}, "canonical": "limits-value", "reason": ""} for a, b in pairs]})


def bridge(prompt):
    return json.dumps({"links": [{"src": "limits-value", "dst": "events", "type": "related", "strength": 0.4, "rationale": "r"}, {"src": "limits-value", "dst": "nowhere", "type": "related", "strength": 0.4, "rationale": ""}]})


CALLS = {"extract": extract, "merge": merge, "bridge": bridge}


@pytest.fixture
def root(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "Syllabus_Calculus.md").write_text("Limits value: what a sequence comes near to\nDerivatives: how fast a value is changing\n")
    (folder / "Syllabus_Probability_Essentials.md").write_text("Events: sets of outcomes of a trial\nLimit value: what a sequence tends to\n")
    (folder / "notes.exe").write_text("no")
    return folder


def test_run_resumes_forces_and_exports(spark, root, tmp_path):
    out = str(tmp_path / "out")
    first = stages.run(spark, str(root), out, "syllabus", CALLS)
    assert first["made"] == stages.STAGES and first["report"]["gate_passed"]
    assert first["report"]["concepts"] == 3 and first["report"]["bridge_links"] == 1 and first["report"]["quote_verbatim_rate"] == 1.0
    links = {(r.src, r.dst, r.type) for r in spark.read.parquet(f"{out}/graph/links").collect()}
    assert links == {("limits-value", "derivatives", "prerequisite"), ("events", "limits-value", "prerequisite"), ("events", "limits-value", "related")}
    assert [r.reason for r in spark.read.parquet(f"{out}/graph/rejects").collect()] == ["bridge to unknown slug"]

    account = {r.kind: r for r in spark.read.parquet(f"{out}/account").collect()}
    assert {k: (r.calls, r.kept, r.noted, r.retries, r.failed) for k, r in account.items()} == {k: (1, 0, 0, 0, 0) for k in ("extract", "merge", "bridge")}
    assert account["bridge"].chars_out == len(bridge("")) and account["bridge"].tokens_out == -(-len(bridge("")) // 4)

    def fails(prompt):
        raise RuntimeError("must not be asked again")

    none = {"extract": fails, "merge": fails, "bridge": fails}
    again = stages.run(spark, str(root), out, "syllabus", none)
    assert again["made"] == [] and again["report"] == first["report"]
    # A forced stage is answered from the kept answers and makes the later ones again.
    forced = stages.run(spark, str(root), out, "syllabus", none, force=["extract"])
    assert forced["made"] == stages.STAGES[3:] and forced["report"] == first["report"]
    whole = spark.read.parquet(f"{out}/account").groupBy("kind").sum("calls", "kept").collect()
    assert {tuple(r) for r in whole} == {("extract", 1, 1), ("merge", 1, 1), ("bridge", 1, 1)}
    with pytest.raises(ValueError, match="unknown stages"):
        stages.run(spark, str(root), out, "syllabus", CALLS, force=["paint"])
    with pytest.raises(ValueError, match="no files"):
        stages.run(spark, str(root), str(tmp_path / "o2"), "syllabus", CALLS, courses=["XX"])

    meta = tmp_path / "meta.json"
    meta.write_text(json.dumps({"courses": {"CALC": {"ects": 6, "internal_prerequisites": [], "provenance": "p"}, "PROB": {"ects": 4, "internal_prerequisites": ["CALC"]}, "OLD": {"ects": 9}}, "more": 1}))
    c = planner.load_curriculum(spark, f"{out}/dataset/csv", str(meta))
    plan = planner.validate_study_plan(c, ["PROB", "CALC"])
    assert plan["valid"] and plan["total_ects"] == 10 and plan["recommended_order"] == ["CALC", "PROB"]
    assert planner.compare_courses(c, "calc", "prob")["counts"] == {"CALC": 2, "PROB": 2}
    meta.write_text(json.dumps({"courses": {"CALC": {"ects": 6}}}))
    with pytest.raises(ValueError, match="PROB"):
        planner.load_curriculum(spark, f"{out}/dataset/csv", str(meta))


def test_gate_stops_before_export_and_failed_batches_stop_the_run(spark, root, tmp_path):
    def invents(prompt):
        said = json.loads(extract(prompt))
        for u in said["units"]:
            for c in u["concepts"]:
                c["occurrences"][0]["quote"] = "words that stand nowhere"
        return json.dumps(said)

    out = str(tmp_path / "bad")
    with pytest.raises(stages.GateFailed, match="verbatim"):
        stages.run(spark, str(root), out, "syllabus", {"extract": invents})
    assert not (tmp_path / "bad" / "dataset").exists()
    loose = stages.run(spark, str(root), out, "syllabus", {"extract": invents}, fail_on_gate=False)
    assert loose["made"] == ["export"] and "FAILED" in quality.summary(loose["report"])
    stopped = stages.run(spark, str(root), str(tmp_path / "s"), "syllabus", {}, stop_after="bundle")
    assert stopped["made"] == stages.STAGES[:3]


def test_command_line(spark, root, tmp_path, capsys):
    out = str(tmp_path / "c")
    for cmd in ("scan", "plan", "free"):
        assert cli.main([cmd, str(root), "--out", out]) == 0
    assert spark.read.parquet(f"{out}/manifest").count() == 2 and spark.read.parquet(f"{out}/batches").count() == 2
    assert cli.main(["report", "--out", out]) == 0
    assert "gate:" in capsys.readouterr().out
    ran = str(tmp_path / "r")
    assert cli.main(["run", str(root), "--out", ran, "--calls", f"{__name__}:CALLS"]) == 0
    assert "3 concepts" in capsys.readouterr().out


def test_batch_size_of_a_context_window():
    assert models.batch_chars(100_000) == 180_000 and models.batch_chars(8_000, 3.0) == 10_800


def test_ingest_takes_each_file_once(spark, root, tmp_path):
    out, progress = str(tmp_path / "texts"), str(tmp_path / "progress")

    def go():
        q = ingest(spark, str(root), out, "syllabus", progress)
        q.awaitTermination(120)
        return sorted((r.course_code, r.status) for r in spark.read.parquet(out).collect())

    assert go() == [("CALC", "ok"), ("PROB", "ok")]
    assert go() == [("CALC", "ok"), ("PROB", "ok")]
    (root / "Syllabus_Linear_Algebra.txt").write_text("Vectors: arrows")
    (root / "Syllabus_Broken.docx").write_text("no archive")
    assert go() == [("BROKEN", "failed"), ("CALC", "ok"), ("LINALG", "ok"), ("PROB", "ok")]
