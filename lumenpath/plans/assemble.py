"""From mentions, occurrences and links to a finished topic graph, step by step as tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenpath.functions import text as T
from lumenpath.operators import dag, graph, lessons
from lumenpath.session import checkpoint

# What absent or empty fields stand for.
DIFFICULTY, KIND, ROLE, CONFIDENCE, STRENGTH, QUOTE_KEY = 3, "definition", "mentioned", 0.7, 0.5, 80


@dataclass
class Graph:
    """``concepts``, ``links``, ``occurrences`` and ``rejects(reason, item)``."""

    concepts: DataFrame
    links: DataFrame
    occurrences: DataFrame
    rejects: DataFrame


def build(mentions: DataFrame, occurrences: DataFrame, links: DataFrame, units: DataFrame, files: DataFrame, merges: DataFrame | None = None, bridges: DataFrame | None = None) -> Graph:
    """Assemble the graph.

    ``mentions(unit_id, slug, name, kind, difficulty, domain, definition, aliases, ord)``,
    ``occurrences(unit_id, slug, rel_path, role, quote, confidence, ord)``,
    ``links(src, dst, type, strength, rationale, origin, ord)``, ``units(unit_id, course)``,
    ``files(unit_id, rel_path)``, ``merges(alias, canonical)`` and ``bridges`` like links.
    ``ord`` decides what comes first. Rows of unknown units, quotes from files outside their
    unit and bridges to unknown slugs become rejects; empty slugs and quotes go silently.
    """
    # Only the named columns: others may clash with the units'.
    mentions = mentions.select("unit_id", "slug", "name", "kind", "difficulty", "domain", "definition", "aliases", "ord")
    occurrences = occurrences.select("unit_id", "slug", "rel_path", "role", "quote", "confidence", "ord")
    known = units.select("unit_id", "course").distinct()
    slugged = mentions.withColumn("slug", T.slug(F.coalesce(F.nullif("slug", F.lit("")), "name"))).where("slug <> ''")
    m = slugged.join(known, "unit_id").select(
        "unit_id", "course", "slug", "ord",
        F.coalesce(F.nullif("name", F.lit("")), F.initcap(F.replace("slug", F.lit("-"), F.lit(" ")))).alias("name"),
        F.trim(T.text_or_empty(F.col("definition"))).alias("definition"),
        T.or_default(F.col("difficulty").cast("int"), DIFFICULTY).alias("difficulty"),
        T.or_default(F.col("kind"), KIND).alias("kind"),
        F.nullif("domain", F.lit("")).alias("domain"),
        F.coalesce("aliases", F.array().cast("array<string>")).alias("aliases"),
    )
    rejects = mentions.join(known, "unit_id", "left_anti").select(F.lit("unknown unit").alias("reason"), F.col("unit_id").alias("item")).distinct()
    named = m.groupBy("slug").agg(F.min_by("name", "ord").alias("first"))
    if merges is not None:
        real = merges.join(named.select(F.col("slug").alias("canonical")), "canonical", "left_semi").join(named.select(F.col("slug").alias("alias")), "alias", "left_semi").where("alias <> canonical")
        resolved = named.join(real, F.col("slug") == F.col("alias"), "left").select("slug", "first", F.coalesce("canonical", "slug").alias("node"))
    else:
        real, resolved = None, named.withColumn("node", F.col("slug"))
    resolved = checkpoint(resolved)
    m = checkpoint(m.join(resolved, "slug"))
    # The canonical concept's own mentions precede those of the absorbed ones.
    pooled = m.withColumn("ord", F.struct((F.col("slug") != F.col("node")).alias("absorbed"), "ord")).drop("slug").withColumnRenamed("node", "slug")
    concepts = checkpoint(graph.rollup_concepts(pooled))
    called = m.select(F.col("node").alias("slug"), "first", F.explode("aliases").alias("alias")).where((F.trim("alias") != "") & (T.name_key(F.col("alias")) != T.name_key(F.col("first")))).select("slug", F.trim("alias").alias("alias"))
    absorbed = resolved.where("slug <> node").select(F.col("node").alias("slug"), F.col("first").alias("alias"))
    aliases = called.unionAll(absorbed).groupBy("slug").agg(F.array_sort(F.collect_set("alias")).alias("aliases"))

    canonical = resolved.select(F.col("slug").alias("_slug"), "node")
    outside = occurrences.join(known, "unit_id", "left_semi").join(files.select("unit_id", "rel_path").distinct(), ["unit_id", "rel_path"], "left_anti")
    rejects = rejects.unionAll(outside.select(F.lit("file outside unit").alias("reason"), F.concat_ws("/", "unit_id", "slug", "rel_path").alias("item")).distinct())
    occ = occurrences.join(known, "unit_id", "left_semi").join(files.select("unit_id", "rel_path").distinct(), ["unit_id", "rel_path"], "left_semi")
    occ = occ.withColumn("_slug", T.slug(F.col("slug"))).drop("slug").join(canonical, "_slug").select(
        F.col("node").alias("slug"), "unit_id", "rel_path", "ord",
        T.or_default(F.col("role"), ROLE).alias("role"), T.squeeze(F.col("quote")).alias("quote"), T.or_default(F.col("confidence"), CONFIDENCE).alias("confidence"),
    )
    occ = graph.keep_first(occ.where("quote <> ''").withColumn("_q", F.substring("quote", 1, QUOTE_KEY)), ["slug", "rel_path", "_q"], ["ord"]).drop("_q", "ord")
    occ = checkpoint(occ)

    nodes = concepts.select("slug")
    tidy = lambda df, late: df.select(
        T.slug(F.col("src")).alias("src"), T.slug(F.col("dst")).alias("dst"), "type",
        T.or_default(F.col("strength"), STRENGTH).alias("strength"), F.trim(T.text_or_empty(F.col("rationale"))).alias("rationale"),
        F.lit("bridge").alias("origin") if late else F.col("origin"), F.struct(F.lit(late).alias("late"), F.col("ord")).alias("ord"),
    )
    clean = graph.canonical_links(graph.valid_links(tidy(links, False)), nodes, real)
    if bridges is not None:
        raw = graph.valid_links(tidy(bridges, True))
        clean = clean.unionByName(graph.canonical_links(raw, nodes, real))
        names = resolved.select("slug").distinct()
        lost = raw.join(names, raw.src == names.slug, "left_anti").unionAll(raw.join(names, raw.dst == names.slug, "left_anti"))
        rejects = rejects.unionAll(lost.select(F.lit("bridge to unknown slug").alias("reason"), F.concat_ws(" ", "src", "dst").alias("item")).distinct())
    kept = checkpoint(graph.antisymmetric_links(graph.strongest_links(clean)))
    order = kept.where("type = 'prerequisite'")
    acyclic = dag.break_cycles(order.select("src", "dst", "strength")).select("src", "dst")
    final = kept.where("type <> 'prerequisite'").unionByName(order.join(acyclic, ["src", "dst"], "left_semi")).drop("ord")
    final = checkpoint(final)

    seen = occ.groupBy(F.col("slug").alias("_s")).agg(F.count(F.lit(1)).alias("occurrence_count"), F.array_sort(F.collect_set("rel_path")).alias("files"))
    none = F.array().cast("array<string>")
    out = concepts.join(aliases, "slug", "left").join(seen, F.col("slug") == F.col("_s"), "left").drop("_s").join(graph.degrees(final, nodes), "slug")
    out = out.withColumns({"aliases": F.coalesce("aliases", none), "files": F.coalesce("files", none), "occurrence_count": F.coalesce("occurrence_count", F.lit(0)), "n_units": F.size("units"), "n_courses": F.size("courses")})
    return Graph(out, final, occ, rejects)


def free(files: DataFrame, sequential: bool = False, compat: bool = False) -> Graph:
    """The graph of syllabi ``files(rel_path, course_code, text)`` by their structure alone."""
    units, found = map(checkpoint, lessons.syllabus_units(files, compat))
    place = units.select("unit_id", F.struct("rel_path", "block").alias("_place"))
    mentions = found.join(place, "unit_id").withColumn("ord", F.struct("_place", "pos")).drop("_place", "pos")
    links = lessons.structural_links(units, found, sequential).withColumn("ord", F.struct("src", "dst"))
    return build(mentions, mentions, links, units, units.select("unit_id", "rel_path"))


def explore(g: Graph, courses: list[str] | None = None, min_degree: int = 0, types: list[str] | None = None, cross_only: bool = False, text: str = "") -> Graph:
    """What the explorer shows: concepts of any of the courses with enough links, links of the types between
    shown concepts, and ``match``: whether name or slug contains the text (others are dimmed, not removed)."""
    c = g.concepts.where(F.col("degree") >= min_degree)
    if courses is not None:
        c = c.where(F.arrays_overlap("courses", F.array(*[F.lit(x) for x in courses])))
    c = c.withColumn("match", F.lower("name").contains(text.lower()) | F.col("slug").contains(text.lower()))
    ends = lambda e: c.select(F.col("slug").alias(e), F.array_sort("courses").alias("_" + e))
    ln = g.links if types is None else g.links.where(F.col("type").isin(types))
    ln = ln.join(ends("src"), "src").join(ends("dst"), "dst")
    if cross_only:
        ln = ln.where("_src <> _dst")
    return Graph(c, ln.drop("_src", "_dst"), g.occurrences.join(c.select("slug"), "slug", "left_semi"), g.rejects)
