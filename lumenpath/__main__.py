"""Command line: scan, plan, free, run, archive and report over folders that Spark reads."""

from __future__ import annotations

import argparse
import importlib
import json
import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenpath.functions import text as T
from lumenpath.operators import windows
from lumenpath.plans import assemble, quality, stages
from lumenpath.session import ship
from lumenpath.sources import adapters, course_archive, documents, sinks


def texts(spark: SparkSession, root: str, adapter: str, courses: list[str]) -> DataFrame:
    """Manifest rows with their cleaned text; only files that could be read."""
    found = adapters.scan(spark, root, adapter)
    if courses:
        found = found.where(F.upper("course_code").isin([c.upper() for c in courses]))
        if found.isEmpty():
            raise SystemExit("no files of these courses")
    read = documents.extract(documents.load(spark, root)).where("status = 'ok'")
    return found.join(read.select(adapters.relative(F.col("path"), root).alias("rel_path"), T.clean(F.col("text"), True).alias("text")), "rel_path")


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="lumenpath")
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("scan", "plan", "free", "run"):
        s = sub.add_parser(name)
        s.add_argument("root")
        s.add_argument("--adapter", default="syllabus", choices=adapters.registered())
        s.add_argument("--course", action="append", default=[])
        s.add_argument("--out", required=True)
        s.add_argument("--sequential-links", action="store_true")
        s.add_argument("--batch-chars", type=int, default=160_000)
        if name == "run":
            s.add_argument("--calls", required=True, help="module:name of a dict of callables: extract, merge, duplicates, bridge")
            s.add_argument("--force", action="append", default=[], choices=stages.STAGES)
            s.add_argument("--stop-after", choices=stages.STAGES)
            s.add_argument("--no-gate", action="store_true")
    a = sub.add_parser("archive")
    a.add_argument("root")
    a.add_argument("--out", required=True)
    sub.add_parser("report").add_argument("--out", required=True)
    o = p.parse_args(argv)
    spark = SparkSession.builder.appName("lumenpath").getOrCreate()
    ship(spark)
    if o.cmd == "report":
        print(quality.summary(json.loads(spark.read.text(f"{o.out}/report", wholetext=True).first()["value"])))
    elif o.cmd == "run":
        module, name = o.calls.split(":")
        own = importlib.import_module(module)
        # The executors cannot import the caller's module, so its functions travel whole.
        cloudpickle.register_pickle_by_value(own)
        calls = getattr(own, name)
        try:
            said = stages.run(spark, o.root, o.out, o.adapter, calls, o.course, o.batch_chars, force=o.force, stop_after=o.stop_after, fail_on_gate=not o.no_gate)
        except stages.GateFailed as e:
            raise SystemExit(f"quality gate failed: {e}") from e
        if said["report"]:
            report = json.dumps(said["report"], indent=1)
            spark.createDataFrame([(report,)], "value string").coalesce(1).write.mode("overwrite").text(f"{o.out}/report")
            print(quality.summary(said["report"]))
    elif o.cmd == "archive":
        text, files, report = course_archive.unpack(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(o.root).select("path", "content"))
        for name, df in (("texts", text), ("attachments", files), ("report", report)):
            df.write.mode("overwrite").parquet(f"{o.out}/{name}")
    elif o.cmd == "scan":
        adapters.scan(spark, o.root, o.adapter).write.mode("overwrite").parquet(f"{o.out}/manifest")
    elif o.cmd == "plan":
        units = texts(spark, o.root, o.adapter, o.course).groupBy("unit_id").agg(F.count(F.lit(1)).alias("n_files"), F.sum(F.length("text")).alias("chars"))
        units.join(windows.balanced_batches(units, "unit_id", "chars", o.batch_chars), "unit_id").write.mode("overwrite").parquet(f"{o.out}/batches")
    else:
        files = texts(spark, o.root, o.adapter, o.course).select("rel_path", "course_code", "text")
        g = assemble.free(files, o.sequential_links)
        sinks.write_csv({"concepts": g.concepts, "concept_links": g.links, "concept_occurrences": g.occurrences}, o.out)
        sinks.seed_sql(g.concepts, g.links.withColumn("rationale", F.col("rationale"))).orderBy("section").select("statement").write.mode("overwrite").text(f"{o.out}/seed_sql")
        units = g.occurrences.select("unit_id").distinct()
        report = json.dumps(quality.report(g.concepts, g.links, g.occurrences, units, stages.verified(g.occurrences, files)), indent=1)
        spark.createDataFrame([(report,)], "value string").coalesce(1).write.mode("overwrite").text(f"{o.out}/report")
        print(quality.summary(json.loads(report)))
    return 0


if __name__ == "__main__":
    sys.exit(main())
