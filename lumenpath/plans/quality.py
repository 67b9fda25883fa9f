"""The quality gate: measures over the graph, rules, verdict and summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenpath.operators.components import connected_components
from lumenpath.operators.dag import is_acyclic
from lumenpath.session import checkpoint

# The gate's thresholds and the expected size of a unit.
MIN_QUOTE_RATE, MIN_COVERAGE, PER_UNIT, THIN = 0.90, 0.95, (5, 10), 20


def spread(counts: DataFrame, n: str) -> DataFrame:
    """One row: least, most, upper median and how many lie outside PER_UNIT."""
    # One row for each different count: there are few of them, however many rows are counted.
    kinds = counts.where(F.col(n).isNotNull()).groupBy(F.col(n).alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    placed = kinds.select("n", "rows", F.sum("rows").over(Window.orderBy("n")).alias("upto"), F.sum("rows").over(Window.partitionBy(F.lit(0))).alias("every"))
    upper = F.min(F.when(F.col("upto") > F.floor(F.col("every") / 2), F.col("n")))
    outside = F.coalesce(F.sum(F.when(~F.col("n").between(*PER_UNIT), F.col("rows"))), F.lit(0))
    return placed.agg(F.min("n").alias("min_n"), F.max("n").alias("max_n"), upper.alias("median_n"), outside.alias("out_of_range"))


def component_sizes(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``component, size`` with isolated nodes, largest first."""
    parts = connected_components(links, "src", "dst")
    named = nodes.select("slug").join(parts, F.col("slug") == F.col("node"), "left").select(F.coalesce("component", "slug").alias("component"))
    return named.groupBy("component").agg(F.count(F.lit(1)).alias("size")).orderBy(F.desc("size"), "component")


def coverage(units: DataFrame, covered: DataFrame, unit: str) -> DataFrame:
    """One row ``expected, covered, coverage`` (rounded half to even): units of ``units`` that are also in ``covered``."""
    expected = units.select(unit).distinct()
    seen = expected.join(covered.select(unit).distinct().withColumn("_seen", F.lit(1)), unit, "left")
    counts = seen.agg(F.count(F.lit(1)).alias("expected"), F.count("_seen").alias("covered"))
    return counts.withColumn("coverage", F.bround(F.coalesce(F.try_divide("covered", "expected"), F.lit(0.0)), 4))


def thin(concepts: DataFrame, text: str) -> DataFrame:
    """One row ``thin``: texts of fewer than THIN characters."""
    return concepts.agg(F.count_if(F.char_length(text) < THIN).alias("thin"))


def dangling(links: DataFrame, nodes: DataFrame, end: str, node: str) -> DataFrame:
    """The links whose ``end`` is no node."""
    return links.join(nodes.select(F.col(node).alias(end)), end, "left_anti")


def grouped_links(links: DataFrame, nodes: DataFrame, node: str, group: str) -> DataFrame:
    """``links(src, dst, ...)`` with the groups of both ends, ``src_group`` and ``dst_group``; links with an unknown end are left out."""
    out = links
    for end in ("src", "dst"):
        out = out.join(nodes.select(F.col(node).alias(end), F.col(group).alias(f"{end}_group")), end)
    return out


def gate(quote_rate: float, coverage: float, cyclic: bool, dangling: int, orphans: int) -> list[str]:
    """Rules that failed. The quote rate is compared unrounded, the coverage rounded to four places."""
    failed = []
    if quote_rate < MIN_QUOTE_RATE:
        failed.append(f"quote verbatim rate {quote_rate:.1%} < {MIN_QUOTE_RATE:.0%}")
    if round(coverage, 4) < MIN_COVERAGE:
        failed.append(f"unit coverage {coverage:.1%} < {MIN_COVERAGE:.0%}")
    if cyclic:
        failed.append("prerequisite graph contains a cycle")
    if dangling:
        failed.append(f"{dangling} dangling links")
    if orphans:
        failed.append(f"{orphans} concepts with no source file")
    return failed


def report(concepts: DataFrame, links: DataFrame, occurrences: DataFrame, units: DataFrame, verified: DataFrame | None = None) -> dict:
    """The quality report of ``concepts(slug, definition, courses, units, files)``, ``links(src, dst, type, origin)``,
    ``occurrences(slug, quote)`` and ``units(unit_id)``. ``verified(ok)`` has one row per quote."""
    ends = grouped_links(links, concepts.select("slug", F.array_sort("courses").alias("courses")), "slug", "courses")
    per_unit = concepts.select(F.explode("units").alias("unit_id")).groupBy("unit_id").agg(F.count(F.lit(1)).alias("n"))
    n_expected, n_covered, _ = coverage(units, per_unit, "unit_id").first()
    parts = checkpoint(component_sizes(concepts, links))
    sizes = [r["size"] for r in parts.orderBy(F.desc("size"), "component").limit(10).collect()]
    checks = concepts.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.length("definition") < THIN).alias("thin"), F.count_if(F.size("files") == 0).alias("orphan"), F.count_if(F.size("courses") > 1).alias("multi")).first()
    cross = ends.agg(F.count_if(F.col("src_group") != F.col("dst_group")).alias("cross"), F.count(F.lit(1)).alias("known")).first()
    n_links = links.count()
    q = verified.agg(F.count_if("ok").alias("ok"), F.count(F.lit(1)).alias("n")).first() if verified is not None else None
    rate = q["ok"] / q["n"] if q and q["n"] else 0.0 if q else 1.0
    cover = n_covered / n_expected if n_expected else 0.0
    cyclic = not is_acyclic(links.where("type = 'prerequisite'"))
    failed = gate(rate, cover, cyclic, n_links - cross["known"], checks["orphan"])
    return {
        "concepts": checks["n"],
        "links": n_links,
        "occurrences": occurrences.count(),
        "link_types": {r["type"]: r["count"] for r in links.groupBy("type").count().collect()},
        "bridge_links": links.where("origin = 'bridge'").count(),
        "cross_course_links": cross["cross"],
        "multi_course_concepts": checks["multi"],
        "quote_verbatim_rate": round(rate, 4),
        "unit_coverage": round(cover, 4),
        "units_expected": n_expected,
        "units_covered": n_covered,
        "concepts_per_unit": spread(per_unit, "n").first().asDict(),
        "components": parts.count(),
        "component_sizes": sizes,
        "thin_definitions": checks["thin"],
        "prerequisite_acyclic": not cyclic,
        "gate_failures": failed,
        "gate_passed": not failed,
    }


def summary(r: dict) -> str:
    """The report as a few lines to read."""
    n = r["concepts_per_unit"]
    lines = [
        f"{r['concepts']} concepts, {r['occurrences']} occurrences, {r['links']} links ({r['bridge_links']} bridges, {r['cross_course_links']} across courses)",
        f"per unit: {n['min_n']} to {n['max_n']}, median {n['median_n']}, {n['out_of_range']} units out of range",
        f"units covered: {r['units_covered']} of {r['units_expected']} ({r['unit_coverage']:.1%})",
        f"quotes found word for word: {r['quote_verbatim_rate']:.1%}",
        f"components: {r['components']}, largest {r['component_sizes']}",
        f"prerequisites: {'no cycle' if r['prerequisite_acyclic'] else 'cyclic'}",
        "gate: passed" if r["gate_passed"] else "gate: FAILED: " + "; ".join(r["gate_failures"]),
    ]
    return "\n".join(lines)
