"""The whole run in stages. Each stage keeps its tables as Parquet, so a stopped run resumes where it ended."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from lumenpath.functions import text as T
from lumenpath.operators import graph, similarity, windows
from lumenpath.plans import assemble, models, quality, usage
from lumenpath.session import checkpoint, ship
from lumenpath.sources import adapters, changes, documents, sinks

STAGES = ["scan", "texts", "bundle", "extract", "consolidate", "graph", "validate", "export"]
CONCEPT = "slug string, name string, kind string, definition string, difficulty int, domain string, aliases array<string>, occurrences array<struct<rel_path string, role string, quote string, confidence double>>"
LINK = "src string, dst string, type string, strength double, rationale string"
EXTRACTION = f"units array<struct<unit_id string, concepts array<struct<{CONCEPT}>>, links array<struct<{LINK}>>>>"
VERDICTS = "verdicts array<struct<slug_a string, slug_b string, same boolean, canonical string, reason string>>"
BRIDGES = f"links array<struct<{LINK}>>"


def skip_groups(rows: DataFrame, group: str, skipped: Iterable) -> DataFrame:
    """``rows`` without the groups ``skipped``, unless nothing would be left: then all."""
    rest = rows.where(~F.coalesce(F.col(group).isin(list(skipped)), F.lit(False)))
    return rows if rest.isEmpty() else rest


class GateFailed(RuntimeError):
    """The quality gate's rules that failed."""


#: A keyed table is cut into so many folders by a hash of its key; a change rewrites only the folders it touches.
BUCKETS = 256


class Stages:
    """Stage tables under one folder. A stage that is made again makes all later ones again too;
    a keyed stage that is brought up to date makes those again that have no keys."""

    def __init__(self, spark: SparkSession, out: str, force: Iterable[str] = ()) -> None:
        unknown = sorted(set(force) - set(STAGES))
        if unknown:
            raise ValueError(f"unknown stages: {', '.join(unknown)}; known: {', '.join(STAGES)}")
        self.spark, self.out = spark, out.rstrip("/")
        self.made, self.redo_from = [], min([STAGES.index(s) for s in force], default=len(STAGES))

    def _mark(self, stage: str):
        mark = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.out}/{stage}/_FINISHED")
        return mark.getFileSystem(self.spark._jsc.hadoopConfiguration()), mark

    def finished(self, stage: str) -> bool:
        store, mark = self._mark(stage)
        return STAGES.index(stage) < self.redo_from and store.exists(mark)

    def _begin(self, *stages: str) -> None:
        for stage in stages:
            store, mark = self._mark(stage)
            store.delete(mark, False)

    def _end(self, stage: str) -> None:
        store, mark = self._mark(stage)
        store.create(mark, True).close()
        self.made.append(stage)

    def tables(self, stage: str, names: list[str], make: Callable[[], Iterable[DataFrame]]) -> list[DataFrame]:
        """The stage's tables: read if the stage was finished, else made. The mark is set when all are whole."""
        if not self.finished(stage):
            # Later stages lose their marks now, so that a run that stops in between leaves nothing stale.
            self._begin(*STAGES[STAGES.index(stage) :])
            for name, df in zip(names, make()):
                df.write.mode("overwrite").parquet(f"{self.out}/{stage}/{name}")
            self._end(stage)
        return [self.spark.read.parquet(f"{self.out}/{stage}/{name}") for name in names]

    def rewrite(self, stage: str, name: str, rows: DataFrame) -> None:
        """Put ``rows``, which must not be read from it, in the place of a finished stage's table."""
        self._begin(stage)
        rows.write.mode("overwrite").parquet(f"{self.out}/{stage}/{name}")
        self._end(stage)

    def live(self, stage: str, name: str) -> DataFrame:
        """The rows of a keyed table that are not marked as gone."""
        return self.spark.read.parquet(f"{self.out}/{stage}/{name}").where(~F.col("gone")).drop("gone", "bucket")

    def keyed(self, stage: str, keys: dict[str, str], changes: Callable[[], DataFrame], make: Callable[[DataFrame | None], Iterable]) -> list[DataFrame]:
        """The tables ``keys`` (name -> key column) of a stage, brought up to date.

        ``changes()`` names the keys whose rows no longer fit what the stage is made of;
        ``make(those)`` returns each table's rows for its own concerned keys, as
        ``(rows, concerned)``, and ``make(None)`` all rows with None. Only folders that hold a
        concerned key are written. A key without rows leaves a row marked ``gone``.
        """
        if not self.finished(stage):
            # Later stages lose their marks now, so that a run that stops in between leaves nothing stale.
            self._begin(*STAGES[STAGES.index(stage) :])
            for (name, key), (rows, _) in zip(keys.items(), make(None)):
                self._write(f"{self.out}/{stage}/{name}", _bucketed(rows, key).unionByName(_no_row(rows)))
            self._end(stage)
            return [self.live(stage, name) for name in keys]
        those = checkpoint(changes())
        if not those.isEmpty():
            made = [(name, key, checkpoint(_bucketed(rows, key)), checkpoint(concerned)) for (name, key), (rows, concerned) in zip(keys.items(), make(those))]
            # A run that stops from here on finds no mark and makes the stage whole again.
            self._begin(stage, *STAGES[STAGES.index("consolidate") :])
            for name, key, rows, concerned in made:
                self._merge(f"{self.out}/{stage}/{name}", key, rows, concerned)
            self._end(stage)
        return [self.live(stage, name) for name in keys]

    def account(self, kind: str, counts: dict) -> None:
        """Add one row ``kind, calls, kept, ..., tokens_in, tokens_out, at`` to the run's account; tokens are estimated from characters."""
        rows = self.spark.createDataFrame([(kind, *[int(counts[c]) for c in models.ACCOUNT])], f"kind string, {', '.join(f'{c} long' for c in models.ACCOUNT)}")
        tokens = [F.ceil(F.col(f"chars_{way}") / usage.CHARS_PER_TOKEN).alias(f"tokens_{way}") for way in ("in", "out")]
        rows.select("*", *tokens, F.current_timestamp().alias("at")).write.mode("append").parquet(f"{self.out}/account")

    def _merge(self, path: str, key: str, rows: DataFrame, concerned: DataFrame) -> None:
        at = [r["bucket"] for r in concerned.select(_bucket(key)).distinct().collect()]
        old = self.spark.read.parquet(path).where(F.col("bucket").isin(at))
        lost = old.join(concerned, key, "left_semi").join(rows, key, "left_anti").dropDuplicates([key])
        # What is gone keeps its key and, of batches, the number, which is not given again.
        stays = {key, "bucket", "batch"}
        stones = lost.select(*[F.col(c) if c in stays else F.lit(True).alias(c) if c == "gone" else F.lit(None).cast(lost.schema[c].dataType).alias(c) for c in lost.columns])
        self._write(path, old.join(concerned, key, "left_anti").unionByName(rows).unionByName(stones))

    def _write(self, path: str, rows: DataFrame) -> None:
        rows.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int").alias("bucket")


def _bucketed(rows: DataFrame, key: str) -> DataFrame:
    return rows.select("*", F.lit(False).alias("gone"), _bucket(key))


def _no_row(like: DataFrame) -> DataFrame:
    """One row marked as gone, so that a table without rows has its columns."""
    one = like.sparkSession.range(1)
    return one.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in like.schema], F.lit(True).alias("gone"), F.lit(-1).alias("bucket"))


def must_hold(key: str) -> Callable[[str], None]:
    """A check that an answer is a JSON object with a list under ``key``."""

    def check(answer: str) -> None:
        if not isinstance(json.loads(answer).get(key), list):
            raise ValueError(f"no list {key!r}")

    return check


def batch_prompts(units: DataFrame, batches: DataFrame) -> DataFrame:
    """``request_id, prompt``: the bundles of a batch's units in order. Batches have a bounded number of characters."""
    b = batches.join(units, "unit_id").groupBy(F.format_string("b%06d", "batch").alias("request_id")).agg(F.array_sort(F.collect_list(F.struct("unit_id", "bundle"))).alias("u"))
    return b.select("request_id", F.array_join(F.transform("u", lambda x: x["bundle"]), "\n\n").alias("prompt"))


def extracted(answers: DataFrame, batches: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Mentions, occurrences and links of ``answers(request_id, answer)``, with the order they were given in."""
    units = answers.select(F.col("request_id").alias("batch"), F.from_json("answer", EXTRACTION)["units"].alias("u")).select("batch", F.posexplode("u").alias("pos", "u")).select("batch", "pos", "u.unit_id", "u.concepts", "u.links")
    named = batches.select(F.format_string("b%06d", "batch").alias("batch"), "unit_id")
    wanted = named.withColumn("pos", F.row_number().over(Window.partitionBy("batch").orderBy("unit_id")) - 1)
    units = checkpoint(models.repair_unit_ids(units, wanted))
    c = units.select("unit_id", "batch", "pos", F.posexplode("concepts").alias("n", "c"))
    slug = F.coalesce(F.nullif(F.col("c.slug"), F.lit("")), F.col("c.name"))
    ord_of = lambda *more: F.struct("batch", "pos", *more).alias("ord")
    mentions = c.select("unit_id", slug.alias("slug"), "c.name", "c.kind", "c.difficulty", "c.domain", "c.definition", "c.aliases", ord_of("n"))
    occ = c.select("unit_id", slug.alias("slug"), "batch", "pos", "n", F.posexplode("c.occurrences").alias("m", "o")).select("unit_id", "slug", "o.rel_path", "o.role", "o.quote", "o.confidence", ord_of("n", "m"))
    links = units.select("batch", "pos", F.posexplode("links").alias("n", "l")).select("l.*", F.lit("extracted").alias("origin"), ord_of("n"))
    return mentions, occ, links


def asked(prompts: DataFrame, call: Callable[[str], str] | None, schema: str, key: str, cache: str, most: int | None = None, account: Callable[[str, dict], None] = lambda *_: None) -> DataFrame:
    """The items under ``key`` of every good answer with ``request_id`` and position ``n``; nothing without a callable.

    ``account`` gets the name of the cache and the counts of the calls.
    """
    answers = prompts.sparkSession.createDataFrame([], "request_id string, answer string")
    if call:
        seen = Observation()
        answers = models.ask_all(prompts, call, must_hold(key), cache, seen=seen).where("error is null")
        account(cache.rpartition("/")[2], seen.get)
    items: Column = F.from_json("answer", schema)[key]
    return answers.select("request_id", F.posexplode(F.slice(items, 1, most) if most else items).alias("n", "i")).select("request_id", "n", "i.*")


def consolidated(parts: tuple, calls: dict[str, Callable[[str], str]], cache: str, account: Callable[[str, dict], None] = lambda *_: None) -> tuple[DataFrame, DataFrame]:
    """Merges ``alias, canonical`` and bridge links, as the callables for "merge", "duplicates" and "bridge" judge."""
    concepts = assemble.build(*parts).concepts
    pairs = models.pair_prompts(similarity.merge_candidates(concepts), concepts)
    said = asked(pairs, calls.get("merge"), VERDICTS, "verdicts", f"{cache}/merge", account=account)
    said = said.unionByName(asked(models.name_prompts(concepts), calls.get("duplicates"), VERDICTS, "verdicts", f"{cache}/duplicates", account=account))
    merges = checkpoint(graph.merge_groups(said, concepts))
    merged = assemble.build(*parts, merges=merges).concepts if "bridge" in calls else concepts
    found = asked(models.name_prompts(merged, models.BRIDGES_PER_CALL), calls.get("bridge"), BRIDGES, "links", f"{cache}/bridge", models.MAX_BRIDGES, account)
    return merges, found.select("src", "dst", "type", "strength", "rationale", F.lit("bridge").alias("origin"), F.struct(F.col("request_id").alias("batch"), F.lit(0).alias("pos"), "n").alias("ord"))


def verified(occurrences: DataFrame, files: DataFrame) -> DataFrame:
    """``ok`` for every quote: whether its folded words stand in its folded file ``files(rel_path, text)``."""
    folded = files.select("rel_path", T.fold(F.col("text"), True).alias("_t"))
    quote = T.fold(F.col("quote"), True)
    return occurrences.join(folded, "rel_path", "left").select((F.coalesce(F.col("_t").contains(quote), F.lit(False)) & (quote != "")).alias("ok"))


def star(manifest: DataFrame, units: DataFrame, concepts: DataFrame, links: DataFrame, occurrences: DataFrame) -> dict[str, DataFrame]:
    """The seven tables of the export."""
    module = F.concat_ws("-", "course_code", "module_code").alias("module_code")
    place = manifest.select("unit_id", module, "course_code", F.col("unit_ordinal").alias("ordinal")).distinct()
    return {
        "courses": manifest.groupBy("course_code").agg(F.min("course_title").alias("title")),
        "modules": manifest.select(module, "course_code", F.col("module_ordinal").alias("ordinal")).distinct(),
        "units": place.join(units.select("unit_id", "n_files", "chars"), "unit_id"),
        "source_files": manifest.select("rel_path", "filename", "course_code", "unit_id", "asset_kind", "asset_ordinal", "part_ordinal", "bytes", "sha256"),
        "concepts": concepts,
        "concept_links": links,
        "concept_occurrences": occurrences,
    }


def run(spark: SparkSession, root: str, out: str, adapter: str, calls: dict[str, Callable[[str], str]], courses: Iterable[str] = (), batch_chars: int = 160_000, min_chars: int = 1, force: Iterable[str] = (), stop_after: str | None = None, fail_on_gate: bool = True, skip_modules: Iterable[int] = ()) -> dict:
    """Build the graph of the files under ``root`` into ``out``; return the stages made and the report.

    ``calls["extract"]`` answers the prompt of a batch with JSON (EXTRACTION); "merge",
    "duplicates" (VERDICTS) and "bridge" (BRIDGES) may be left out. Good answers are kept, so
    that no prompt is paid for twice, even if its stage is forced. Finished stages are read
    again. Files that were added, changed (by size or time, then by hash) or deleted below
    ``root`` since, or that ``courses`` and ``skip_modules`` now let in or out, are noticed:
    their texts, their units, the batches that held these, and those batches' answers are made
    again, then the stages from "consolidate" on, which look at the whole graph. Other
    settings are not noticed: use a new folder, or force the first stage concerned.
    """
    ship(spark)
    s, ends = Stages(spark, out, force), lambda stage: stop_after == stage
    if stop_after is not None and stop_after not in STAGES:
        raise ValueError(f"unknown stage {stop_after!r}")
    if s.finished("scan"):
        stored = spark.read.parquet(f"{s.out}/scan/manifest")
        files_now = adapters.manifest(changes.listing(spark, root), adapter)
        if not changes.touched(stored, files_now, "rel_path", ["bytes", "modified"]).isEmpty():
            again = checkpoint(changes.rescan(spark, root, adapter, stored))
            s.rewrite("scan", "manifest", again)
    (manifest,) = s.tables("scan", ["manifest"], lambda: [changes.rescan(spark, root, adapter)])
    everything = manifest
    wanted = [c.upper() for c in courses]
    if wanted:
        manifest = manifest.where(F.upper("course_code").isin(wanted))
        if manifest.isEmpty():
            raise ValueError("no files of these courses")
    if skip_modules:
        manifest = skip_groups(manifest, "module_ordinal", skip_modules)
    result = {"made": s.made, "report": None}
    if ends("scan"):
        return result

    def texts(those):
        wanted = None if those is None else everything.join(those, "rel_path", "left_semi")
        read = documents.extract(changes.contents(spark, root, wanted), min_chars)
        named = everything.select("path", "rel_path", "sha256").join(read, "path")
        return [(named.select("rel_path", "sha256", T.clean(F.col("text"), True).alias("text"), "status", "error").withColumn("chars", F.length("text")), those)]

    (text,) = s.keyed("texts", {"texts": "rel_path"}, lambda: changes.touched(s.live("texts", "texts"), everything, "rel_path", ["sha256"]), texts)
    if ends("texts"):
        return result

    order = F.struct("asset_kind", F.coalesce("asset_ordinal", F.lit(0)), F.coalesce("part_ordinal", F.lit(0)), "rel_path")
    good = text.where((F.col("status") == "ok") & (F.col("chars") >= min_chars)).select("rel_path", "text")
    sources = manifest.join(good, "rel_path").withColumn("ord", order)

    def bundle(those):
        mine = sources if those is None else sources.join(those, "unit_id", "left_semi")
        units = windows.bundle_text(mine, "unit_id", "rel_path", "text", "ord").join(manifest.groupBy("unit_id").agg(F.min("course_code").alias("course")), "unit_id")
        units, kept = checkpoint(units), mine.select("unit_id", "rel_path", "sha256", "text")
        if those is None:
            return [(units, None), (windows.balanced_batches(units, "unit_id", "chars", batch_chars), None), (kept, None)]
        # Batches that held a concerned unit are packed again, under numbers never given before.
        before, was = spark.read.parquet(f"{s.out}/bundle/batches"), s.live("bundle", "batches")
        opened = was.join(was.join(those, "unit_id", "left_semi").select("batch").distinct(), "batch", "left_semi")
        loose = checkpoint(opened.select("unit_id").unionAll(those).distinct())
        sizes = s.live("bundle", "units").join(those, "unit_id", "left_anti").select("unit_id", "chars").unionAll(units.select("unit_id", "chars"))
        packed = windows.balanced_batches(checkpoint(sizes.join(loose, "unit_id", "left_semi")), "unit_id", "chars", batch_chars)
        first = before.agg(F.coalesce(F.max("batch"), F.lit(-1))).first()[0] + 1
        return [(units, those), (packed.withColumn("batch", F.col("batch") + first), loose), (kept, those)]

    units, batches, files = s.keyed("bundle", {"units": "unit_id", "batches": "unit_id", "files": "unit_id"}, lambda: changes.touched(s.live("bundle", "files"), sources, "unit_id", ["rel_path", "sha256"]), bundle)
    if ends("bundle"):
        return result

    named = F.format_string("b%06d", "batch").alias("id")

    def extract(those):
        mine = batches if those is None else batches.join(those.select(F.col("id")), named == F.col("id"), "left_semi")
        seen = Observation()
        answers = models.ask_all(batch_prompts(units, mine), calls["extract"], must_hold("units"), f"{s.out}/answers/extract", seen=seen)
        s.account("extract", seen.get)
        found = extracted(models.require_most(answers), mine)
        return [(df.withColumn("id", F.col("ord.batch")), those) for df in found] + [(mine.select(named).distinct(), those)]

    keys = {"mentions": "id", "occurrences": "id", "links": "id", "asked": "id"}
    mentions, occurrences, links = [df.drop("id") for df in s.keyed("extract", keys, lambda: changes.touched(s.live("extract", "asked"), batches.select(named), "id", []), extract)[:3]]
    parts = (mentions, occurrences, links, units.select("unit_id", "course"), files.select("unit_id", "rel_path"))
    if ends("extract"):
        return result
    merges, bridges = s.tables("consolidate", ["merges", "bridges"], lambda: consolidated(parts, calls, f"{s.out}/answers", s.account))
    if ends("consolidate"):
        return result

    def assembled():
        g = assemble.build(*parts, merges=merges, bridges=bridges)
        return [g.concepts, g.links, g.occurrences, g.rejects]

    concepts, final, quotes, _ = s.tables("graph", ["concepts", "links", "occurrences", "rejects"], assembled)
    if ends("graph"):
        return result

    def validate():
        report = quality.report(concepts, final, quotes, units, verified(quotes, files))
        return [spark.createDataFrame([(json.dumps(report),)], "report string")]

    (stored,) = s.tables("validate", ["report"], validate)
    result["report"] = json.loads(stored.first()["report"])
    if fail_on_gate and not result["report"]["gate_passed"]:
        raise GateFailed("; ".join(result["report"]["gate_failures"]))
    if ends("validate"):
        return result

    def export():
        tables = star(manifest, units, concepts, final, quotes)
        sinks.write_csv(tables, f"{s.out}/dataset/csv")
        sinks.write_json(tables, f"{s.out}/dataset/json")
        return [sinks.seed_sql(concepts, final)]

    s.tables("export", ["seed_sql"], export)
    return result
