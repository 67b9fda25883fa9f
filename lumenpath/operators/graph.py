"""Assembly of the topic graph: roll-ups, link canonicalisation and counts, all keep-first by an explicit ordinal."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenpath.session import checkpoint

# Fixed values.
LINK_ORDER = {"prerequisite": 0, "part_of": 1, "applies_to": 2, "contrasts_with": 3, "related": 4}
SYMMETRIC = ["contrasts_with", "related"]


def keep_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key by ``order``. Equal rows are interchangeable.

    Ascending column names are an aggregate, combined before the shuffle; other orders take a window.
    """
    if all(isinstance(o, str) for o in order):
        first = df.groupBy(*keys).agg(F.min_by(F.struct(*[c for c in df.columns if c not in keys]), F.struct(*order)).alias("_row"))
        return first.select(*[F.col(c) if c in keys else F.col(f"_row.{c}") for c in df.columns])
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def by_rank(links: DataFrame) -> DataFrame:
    """Links in the order of an export: rank of the type, then source, then destination."""
    rank = F.create_map(*[F.lit(x) for kv in LINK_ORDER.items() for x in kv])
    return links.orderBy(F.element_at(rank, F.col("type")).asc_nulls_last(), "src", "dst")


def first_mode(df: DataFrame, key: str, value: str, ord_col: str, out: str) -> DataFrame:
    """Most common value per key; of equally common ones the value met first."""
    counts = df.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("_n"), F.min(ord_col).alias("_o"))
    return counts.groupBy(key).agg(F.min_by(value, F.struct(-F.col("_n"), F.col("_o"))).alias(out))


def rollup_concepts(mentions: DataFrame) -> DataFrame:
    """One row per slug from ``slug, name, definition, difficulty, kind, domain, course, unit_id, ord``.

    First name, longest definition (first of equals, empty ones ignored), mean difficulty
    rounded half to even, most common kind and domain (first of equals), sorted sets.
    """
    longest = F.min_by("definition", F.when(F.col("definition") != "", F.struct(-F.length("definition"), F.col("ord"))))
    base = mentions.groupBy("slug").agg(
        F.min_by("name", "ord").alias("name"),
        F.coalesce(longest, F.lit("")).alias("definition"),
        F.bround(F.avg(F.col("difficulty").cast("int"))).cast("int").alias("difficulty"),
        F.array_sort(F.collect_set("unit_id")).alias("units"),
        F.array_sort(F.collect_set("course")).alias("courses"),
    )
    return base.join(first_mode(mentions, "slug", "kind", "ord", "kind"), "slug", "left").join(first_mode(mentions, "slug", "domain", "ord", "domain"), "slug", "left")


def valid_links(links: DataFrame) -> DataFrame:
    """Links with both ends, no self-loop and a known type."""
    return links.where((F.coalesce("src", F.lit("")) != "") & (F.coalesce("dst", F.lit("")) != "") & (F.col("src") != F.col("dst")) & F.col("type").isin(list(LINK_ORDER)))


def settle_aliases(aliases: DataFrame) -> DataFrame:
    """``alias, canonical`` with chains followed to their end, by pointer doubling; aliases on a cycle are left out."""
    left = aliases.where("alias <> canonical").groupBy("alias").agg(F.min("canonical").alias("canonical"))
    left = checkpoint(left)
    # Each round doubles the length followed; a chain that is longer than there are aliases is a cycle.
    for _ in range(left.count().bit_length() + 1):
        step = left.select(F.col("alias").alias("_a"), F.col("canonical").alias("_c"))
        after = checkpoint(left.join(step, left.canonical == step["_a"], "left").select("alias", F.coalesce("_c", "canonical").alias("canonical"), F.col("_c").isNotNull().alias("more")))
        left = after.select("alias", "canonical")
        if after.where("more").isEmpty():
            return left
    return left.join(left.select(F.col("alias").alias("_a")), F.col("canonical") == F.col("_a"), "left_anti")


def canonical_links(links: DataFrame, nodes: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """Resolve aliases ``(alias, canonical)``, drop unknown ends and self-loops, sort the ends of symmetric types."""
    out = links
    if aliases is not None:
        settled = settle_aliases(aliases)
        for end in ("src", "dst"):
            a = settled.select(F.col("alias").alias("_a"), F.col("canonical").alias("_c"))
            out = out.join(a, out[end] == a["_a"], "left").withColumn(end, F.coalesce("_c", end)).drop("_a", "_c")
    for end in ("src", "dst"):
        out = out.join(nodes.select(F.col("slug").alias(end)).distinct(), end, "left_semi")
    sym = F.col("type").isin(SYMMETRIC)
    low, high = F.least("src", "dst"), F.greatest("src", "dst")
    return out.where("src <> dst").withColumns({"src": F.when(sym, low).otherwise(F.col("src")), "dst": F.when(sym, high).otherwise(F.col("dst"))})


def strongest_links(links: DataFrame) -> DataFrame:
    """The strongest link per (src, dst, type), first by ``ord`` on ties: extracted links precede bridges there."""
    return keep_first(links, ["src", "dst", "type"], [F.desc("strength"), F.col("ord")])


def antisymmetric_links(links: DataFrame) -> DataFrame:
    """Of a->b and b->a of one asymmetric type keep the stronger, first by ``ord`` on ties. One shuffle, no self-join."""
    w = Window.partitionBy("_a", "_b", "type").orderBy(F.desc("strength"), "ord")
    paired = links.withColumns({"_a": F.least("src", "dst"), "_b": F.greatest("src", "dst")}).withColumns({"_s": F.first("src").over(w), "_d": F.first("dst").over(w)})
    return paired.where(F.col("type").isin(SYMMETRIC) | ((F.col("src") == F.col("_s")) & (F.col("dst") == F.col("_d")))).drop("_a", "_b", "_s", "_d")


def degrees(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """``slug, degree``: links at either end; 0 for isolated nodes."""
    ends = links.select(F.explode(F.array("src", "dst")).alias("slug")).groupBy("slug").agg(F.count(F.lit(1)).alias("degree"))
    return nodes.select("slug").join(ends, "slug", "left").select("slug", F.coalesce("degree", F.lit(0)).alias("degree"))


def roots(links: DataFrame) -> DataFrame:
    """Sources of prerequisite links that no prerequisite link leads to."""
    p = links.where("type = 'prerequisite'")
    return p.select(F.col("src").alias("slug")).distinct().join(p.select(F.col("dst").alias("slug")), "slug", "left_anti")


def merge_groups(verdicts: DataFrame, nodes: DataFrame) -> DataFrame:
    """``alias, canonical`` from verdicts ``slug_a, slug_b, same, canonical``.

    Groups are connected components; the representative is the node named canonical most
    often (a name outside the pair counts for slug_a), then the smallest slug.
    """
    from lumenpath.operators.components import connected_components

    known = nodes.select("slug").distinct()
    v = verdicts.where("same and slug_a <> slug_b")
    for end in ("slug_a", "slug_b"):
        v = v.join(known.select(F.col("slug").alias(end)), end, "left_semi")
    parts = connected_components(v, "slug_a", "slug_b")
    votes = v.select(F.when(F.col("canonical").isin(F.col("slug_a"), F.col("slug_b")), F.col("canonical")).otherwise(F.col("slug_a")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("votes"))
    named = parts.join(votes, "node", "left").groupBy("component").agg(F.min_by("node", F.struct(-F.coalesce("votes", F.lit(0)), F.col("node"))).alias("canonical"))
    return parts.join(named, "component").where("node <> canonical").select(F.col("node").alias("alias"), "canonical")
