"""All queries of the engine by name, each over whole tables, with their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumenpath.functions import text as T
from lumenpath.operators import dag, graph, lessons, similarity, windows
from lumenpath.operators.components import connected_components
from lumenpath.plans import planner, quality, stages, usage
from lumenpath.session import checkpoint, ship, table
from lumenpath.sources import adapters, sinks

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


TYPO = "replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace({0}, '‘', ''''), '’', ''''), '“', '\"'), '”', '\"'), '–', '-'), '—', '-'), '‑', '-'), chr(160), ' '), chr(173), ''), chr(8203), ''), chr(8204), ''), chr(8205), ''), chr(65279), '')"
FOLD = "trim(regexp_replace(lower(regexp_replace(" + TYPO + r", '-\s*\n\s*', '', 'g')), '[^0-9a-z]+', ' ', 'g'))"
SLUG = "regexp_replace(regexp_replace(lower({0}), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"
WORDS = "list_filter(string_split(regexp_replace(lower({0}), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> '')"
NAMES = ", ".join(f"'{w}'" for w in T.NAME_STOPWORDS)
TOKENS = ", ".join(f"'{w}'" for w in T.TOKEN_STOPWORDS)
KEY = "array_to_string(list_filter(" + WORDS + f", lambda w: w NOT IN ({NAMES})), ' ')"
TOKEN_SET = "array_to_string(list_sort(list_distinct(list_filter(" + WORDS + f", lambda w: w NOT IN ({TOKENS})))), ' ')"


# Text functions


@query(f"SELECT doc_id, {SLUG.format('text')} AS slug FROM documents")
def slugify_documents(spark, d):
    return table(spark, d, "documents").select("doc_id", T.slug(F.col("text")).alias("slug"))


@query(f"SELECT p_partkey, {KEY.format('p_name')} AS name_key, {TOKEN_SET.format('p_name')} AS token_key FROM part")
def norm_name_parts(spark, d):
    n = F.col("p_name")
    return table(spark, d, "part").select("p_partkey", T.name_key(n).alias("name_key"), F.array_join(T.token_set(n), " ").alias("token_key"))


@query(f"SELECT doc_id, {FOLD.format('text')} AS folded FROM documents")
def fold_text(spark, d):
    return table(spark, d, "documents").select("doc_id", T.fold(F.col("text")).alias("folded"))


_BOILER = r"(?im)^\s*(?:©\s*20\d\d[^\n]{0,40}|All Rights Reserved|Page \d+ of \d+|Tel:[^\n]*|[a-z0-9.-]+\.(?:edu|com)\s*|MODULE \d+ UNIT \d+|(?:Video|Podcast) \d+ Transcript)\s*$"


@query(
    "SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace("
    + TYPO.format("text")
    + f", '{_BOILER}', '', 'g'), '-\\s*\\n\\s*', '', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g'), '[ \\t]{{2,}}', ' ', 'g'), '^\\s+|\\s+$', '', 'g') AS cleaned FROM documents".replace("{{", "{").replace("}}", "}")
)
def clean_text(spark, d):
    return table(spark, d, "documents").select("doc_id", T.clean(F.col("text")).alias("cleaned"))


def _entities_sql(c: str) -> str:
    for k, v in T.ENTITIES.items():
        c = f"replace({c}, '{k}', '{v.replace(chr(39), chr(39) * 2)}')"
    return c


@query(
    "SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace("
    + _entities_sql("html")
    + r", '(?is)<script[^>]*>.*?</script>', ' ', 'g'), '(?is)<style[^>]*>.*?</style>', ' ', 'g'), '(?i)<br\s*/?>|</p>|</li>|</div>|</h[1-6]>', chr(10), 'g'), '<[^>]+>', ' ', 'g'), '[ \t]{2,}', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g') AS visible FROM pages"
)
def html_clean_pages(spark, d):
    return table(spark, d, "pages").select("page_id", T.html_text(F.col("html")).alias("visible"))


@query("SELECT sha256(text) AS sha, count(*) AS n_docs, min(doc_id) AS first_doc FROM documents GROUP BY 1 HAVING count(*) > 1")
def content_dups(spark, d):
    g = table(spark, d, "documents").groupBy(F.sha2("text", 256).alias("sha"))
    return g.agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("first_doc")).where("n_docs > 1")


@query("SELECT doc_id, sha256(text) AS sha, strlen(text) AS bytes, substring(sha256(source || chr(0) || text), 1, 32) AS cache_key FROM documents")
def manifest_sha(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("sha"), F.octet_length("text").cast("long").alias("bytes"), T.cache_key(F.col("source"), F.col("text")).alias("cache_key"))


_KINDS = [(r"\.html?$", "page"), (r"utm_source", "campaign"), (r"page=", "listing"), (r"#", "anchor"), (r"/$", "folder")]


@query("SELECT page_id, CASE " + " ".join(f"WHEN regexp_matches(lower(url), '{p}') THEN '{k}'" for p, k in _KINDS) + " ELSE 'other' END AS kind FROM pages")
def classify_pages(spark, d):
    out = F.lit("other")
    for p, k in reversed(_KINDS):
        out = F.when(F.lower("url").rlike(p), k).otherwise(out)
    return table(spark, d, "pages").select("page_id", out.alias("kind"))


_PATH = "regexp_replace(url, '^[A-Za-z]+://', '')"
_NUM = "CAST(nullif(regexp_extract(path, '(?i){0}', 1), '') AS INTEGER)"


@query(
    f"WITH p AS (SELECT page_id, {_PATH} AS path FROM pages WHERE url IS NOT NULL), n AS (SELECT *, string_split(path, '/')[1] AS course, string_split(path, '/')[-1] AS file FROM p) SELECT page_id, course AS course_code, "
    + f"coalesce({_NUM.format('(?:module|модуль)[-_ ]?([0-9]+)')}, 0) AS module_ordinal, coalesce({_NUM.format('(?:unit|lesson|тема|заняття)[-_ ]?([0-9]+)')}, 0) AS unit_ordinal, "
    + "CASE " + " ".join(f"WHEN regexp_matches(lower(file), '{p}') THEN '{k}'" for p, k in adapters.BILINGUAL_KINDS) + " ELSE 'reading' END AS asset_kind FROM n"
)
def classify_paths(spark, d):
    """The bilingual adapter's rules on the paths of all pages."""
    said = adapters.get_adapter("kse")(F.regexp_replace("url", "^[A-Za-z]+://", ""))
    return table(spark, d, "pages").where("url is not null").select("page_id", *[said[c].alias(c) for c in ("course_code", "module_ordinal", "unit_ordinal", "asset_kind")])


@query("SELECT p_partkey, CASE " + " ".join(f"WHEN regexp_matches(lower(p_name), '{p}') THEN '{k}'" for p, k in T.KIND_HINTS) + " ELSE 'definition' END AS kind FROM part")
def guess_kind_parts(spark, d):
    return table(spark, d, "part").select("p_partkey", T.guess_kind(F.col("p_name")).alias("kind"))


@query("SELECT p_partkey, CASE WHEN p_name IS NULL OR p_name = '' THEN 'NULL' ELSE '''' || replace(p_name, '''', '''''') || '''' END AS literal, coalesce(nullif(p_size, 0), 3) AS size_or_default FROM part")
def sql_literals(spark, d):
    return table(spark, d, "part").select("p_partkey", T.sql_literal(F.col("p_name")).alias("literal"), T.or_default(F.col("p_size"), 3).alias("size_or_default"))


# Bundles


@query(
    "WITH c AS (SELECT source, length(text) AS n FROM documents WHERE length(text) >= 200) "
    "SELECT source, count(*) AS n_files, CAST(sum(n) AS BIGINT) AS chars FROM c GROUP BY source"
)
def bundle_units(spark, d):
    kept = table(spark, d, "documents").where(F.char_length("text") >= 200).select("source", F.col("doc_id").cast("string").alias("name"), "text", F.col("doc_id").alias("ord"))
    return windows.bundle_text(kept, "source", "name", "text", "ord").select("source", "n_files", "chars")


@query(
    "WITH c AS (SELECT source, sum(length(text)) AS size FROM documents WHERE length(text) >= 200 GROUP BY source), "
    "r AS (SELECT *, sum(size) OVER (ORDER BY size DESC, source NULLS FIRST ROWS UNBOUNDED PRECEDING) - size AS before, sum(size) OVER () AS total FROM c), "
    "n AS (SELECT *, total // 160000 + 1 AS n FROM r) "
    "SELECT source, CAST(least(before // greatest(1, (total + n - 1) // n), n - 1) AS INTEGER) AS batch FROM n"
)
def balanced_batches(spark, d):
    return windows.balanced_batches(bundle_units(spark, d), "source", "chars", 160_000)


@query(
    "WITH r AS (SELECT doc_id, coalesce(length(text), 0) AS size, sum(coalesce(length(text), 0)) OVER (ORDER BY coalesce(length(text), 0) DESC, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) - coalesce(length(text), 0) AS before, sum(coalesce(length(text), 0)) OVER () AS total FROM documents), "
    "n AS (SELECT *, total // 160000 + 1 AS n FROM r) "
    "SELECT doc_id, CAST(least(before // greatest(1, (total + n - 1) // n), n - 1) AS INTEGER) AS batch FROM n"
)
def document_batches(spark, d):
    units = table(spark, d, "documents").select("doc_id", F.char_length("text").alias("chars"))
    return windows.balanced_batches(units, "doc_id", "chars", 160_000)


@query("WITH k AS (SELECT *, bool_or(source <> 'src0') OVER () AS others FROM documents) SELECT doc_id, source FROM k WHERE source <> 'src0' OR NOT others")
def skip_unless_all(spark, d):
    return stages.skip_groups(table(spark, d, "documents").select("doc_id", "source"), "source", ["src0"])


# Evidence and similarity


@query(f"WITH d AS (SELECT doc_id, {FOLD.format('text')} AS body FROM documents), b AS (SELECT item_id, {FOLD.format('text')} AS quote FROM benchmark) SELECT doc_id, item_id FROM d JOIN b ON quote <> '' AND contains(body, quote)")
def verbatim_pairs(spark, d):
    return similarity.verbatim_pairs(table(spark, d, "documents"), table(spark, d, "benchmark"), "doc_id", "text", "item_id", "text")


@query(
    f"WITH d AS (SELECT {FOLD.format('text')} AS body FROM documents), b AS (SELECT item_id, {FOLD.format('text')} AS quote FROM benchmark), "
    "h AS (SELECT item_id, (SELECT count(*) FROM d WHERE b.quote <> '' AND contains(d.body, b.quote)) AS n FROM b) "
    "SELECT count(*) AS quotes, count(*) FILTER (n > 0) AS verified, round_even(count(*) FILTER (n > 0) / count(*), 4) AS rate FROM h"
)
def verbatim_rate(spark, d):
    hits = verbatim_pairs(spark, d).select("item_id").distinct().withColumn("hit", F.lit(1))
    b = table(spark, d, "benchmark").select("item_id").join(hits, "item_id", "left")
    return b.agg(F.count(F.lit(1)).alias("quotes"), F.count("hit").alias("verified")).select("quotes", "verified", F.bround(F.coalesce(F.try_divide("verified", "quotes"), F.lit(0.0)), 4).alias("rate"))


@query(
    f"WITH n AS (SELECT DISTINCT p_name AS id, {KEY.format('p_name')} AS k FROM part), "
    "p AS (SELECT id, '  ' || k || '  ' AS s FROM n WHERE k <> ''), g AS (SELECT DISTINCT id, substring(s, i, 3) AS g FROM (SELECT id, s, unnest(range(1, length(s) - 1)) AS i FROM p)), "
    "c AS (SELECT id, count(*) AS n FROM g GROUP BY id), j AS (SELECT x.id AS a, y.id AS b, count(*) AS i FROM g x JOIN g y ON x.g = y.g AND x.id < y.id GROUP BY 1, 2) "
    "SELECT a, b, i / (ca.n + cb.n - i) AS score FROM j JOIN c ca ON ca.id = a JOIN c cb ON cb.id = b WHERE i / (ca.n + cb.n - i) >= 0.62"
)
def similar_names_trigram(spark, d):
    names = table(spark, d, "part").select(F.col("p_name").alias("name")).distinct()
    return similarity.trigram_pairs(names, "name", "name")


@query(
    f"WITH n AS (SELECT doc_id AS id, source, {KEY.format(FOLD.format('text'))} AS k FROM documents), "
    "p AS (SELECT id, source, '  ' || k || '  ' AS s FROM n WHERE k <> ''), g AS (SELECT DISTINCT id, source, substring(s, i, 3) AS g FROM (SELECT id, source, s, unnest(range(1, length(s) - 1)) AS i FROM p)), "
    "c AS (SELECT id, count(*) AS n FROM g GROUP BY id), j AS (SELECT x.id AS a, y.id AS b, count(*) AS i FROM g x JOIN g y ON x.source = y.source AND x.g = y.g AND x.id < y.id GROUP BY 1, 2) "
    "SELECT a, b, i / (ca.n + cb.n - i) AS score FROM j JOIN c ca ON ca.id = a JOIN c cb ON cb.id = b WHERE i / (ca.n + cb.n - i) >= 0.9"
)
def similar_docs(spark, d):
    """Whole texts; 0.9, because long texts of one language share most of their trigrams (6 % of all pairs of one source reach 0.62)."""
    docs = table(spark, d, "documents").select("doc_id", "source", T.fold(F.col("text")).alias("body"))
    return similarity.trigram_pairs(docs, "doc_id", "body", "source", 0.9)


@query()
def similar_names(spark, d):
    ship(spark)
    return similarity.name_pairs(table(spark, d, "part"), "p_name", 0.7)


@query()
def merge_candidates(spark, d):
    ship(spark)
    c = table(spark, d, "part").groupBy(F.col("p_name").alias("name")).agg(F.min("p_type").alias("definition"))
    return similarity.merge_candidates(c.select(T.slug(F.col("name")).alias("slug"), "name", "definition", F.array().cast("array<string>").alias("aliases")))


# Graph


def _events(spark, d):
    return table(spark, d, "events")


_STEPS = (
    "s AS (SELECT lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS src, event_type AS dst, user_id, event_id FROM events), "
    "e AS (SELECT src, dst, count(*) AS n FROM s WHERE src IS NOT NULL AND src <> dst GROUP BY 1, 2) "
)


@query(f"WITH {_STEPS} SELECT src, dst, n FROM e")
def sequence_links(spark, d):
    return windows.sequence_links(_events(spark, d), "user_id", ["ts", "event_id"], "event_type")


@query(f"WITH {_STEPS}, r AS (SELECT *, row_number() OVER (PARTITION BY least(src, dst), greatest(src, dst) ORDER BY n DESC, src, dst) AS k FROM e) SELECT src, dst, n FROM r WHERE k = 1")
def antisymmetric_links(spark, d):
    links = sequence_links(spark, d).select("src", "dst", F.lit("prerequisite").alias("type"), F.col("n").alias("strength"), F.struct("src", "dst").alias("ord"))
    return graph.antisymmetric_links(links).select("src", "dst", F.col("strength").alias("n"))


@query(
    "WITH l AS (SELECT l_partkey AS src, l_suppkey AS dst, l_returnflag AS type, l_quantity AS strength, l_orderkey, l_linenumber FROM lineitem), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY src, dst, type ORDER BY strength DESC, l_orderkey, l_linenumber) AS k FROM l) "
    "SELECT src, dst, type, strength, l_orderkey, l_linenumber FROM r WHERE k = 1"
)
def link_argmax(spark, d):
    rows = table(spark, d, "lineitem").select(F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst"), F.col("l_returnflag").alias("type"), F.col("l_quantity").alias("strength"), F.struct("l_orderkey", "l_linenumber").alias("ord"))
    return graph.strongest_links(rows).select("src", "dst", "type", "strength", "ord.l_orderkey", "ord.l_linenumber")


@query(f"WITH {_STEPS}, n AS (SELECT DISTINCT event_type AS slug FROM events), x AS (SELECT src AS slug FROM e UNION ALL SELECT dst FROM e) SELECT n.slug, count(x.slug) AS degree FROM n LEFT JOIN x USING (slug) GROUP BY n.slug")
def degree(spark, d):
    return graph.degrees(sequence_links(spark, d), _events(spark, d).select(F.col("event_type").alias("slug")).distinct())


def _copies(spark, d):
    """Links from the first document of each text to its copies."""
    hashed = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("h"))
    return hashed.groupBy("h").agg(F.min("doc_id").alias("first")).join(hashed, "h").where("doc_id <> first").select(F.col("first").alias("src"), F.col("doc_id").alias("dst"))


@query("SELECT doc_id AS node, min(doc_id) OVER (PARTITION BY text) AS component FROM documents")
def components(spark, d):
    """Groups of documents with the same text, by links between copies; a document without a copy is its own."""
    nodes = table(spark, d, "documents").select(F.col("doc_id").alias("id"))
    return nodes.join(connected_components(_copies(spark, d)), F.col("id") == F.col("node"), "left").select(F.col("id").alias("node"), F.coalesce("component", "id").alias("component"))


@query(
    "WITH RECURSIVE l AS (SELECT DISTINCT s_nationkey AS a, 100 + p_size AS b FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey), e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l), "
    "r(node, label) AS (SELECT a, a FROM e UNION SELECT e.b, r.label FROM r JOIN e ON e.a = r.node) SELECT node, min(label) AS component FROM r GROUP BY node"
)
def components_by_nation(spark, d):
    """Nations and part sizes linked by every line of the whole table."""
    li, s, p = table(spark, d, "lineitem").select("l_partkey", "l_suppkey"), table(spark, d, "supplier").select("s_suppkey", "s_nationkey"), table(spark, d, "part").select("p_partkey", "p_size")
    e = li.join(s, F.col("l_suppkey") == F.col("s_suppkey")).join(p, F.col("l_partkey") == F.col("p_partkey")).select(F.col("s_nationkey").alias("src"), (F.col("p_size") + 100).alias("dst")).distinct()
    return connected_components(e)


@query()
def components_whole(spark, d):
    """``node, component`` over every part-supplier link; parts and suppliers without one are components of their own."""
    lines = table(spark, d, "lineitem").select(F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supplier"))
    every = lambda rows, name: rows.unionAll(lines.select(name)).where(F.col(name).isNotNull()).distinct()
    parts = every(table(spark, d, "part").select(F.col("p_partkey").alias("part")), "part")
    suppliers = every(table(spark, d, "supplier").select(F.col("s_suppkey").alias("supplier")), "supplier")
    # A supplier is drawn to its least part, so that all nodes are numbers of parts.
    linked = lines.where("part is not null and supplier is not null")
    first = checkpoint(linked.groupBy("supplier").agg(F.min("part").alias("first")))
    found = connected_components(linked.join(first, "supplier"), "first", "part")
    placed = checkpoint(parts.join(found, F.col("part") == F.col("node"), "left").select("part", F.coalesce("component", "part").alias("at")))
    names = checkpoint(placed.groupBy("at").agg(F.min(F.concat(F.lit("p"), "part")).alias("component")))
    of_parts = placed.join(names, "at").select(F.concat(F.lit("p"), "part").alias("node"), "component")
    drawn = suppliers.join(first, "supplier", "left").join(placed.withColumnRenamed("part", "first"), "first", "left").join(names, "at", "left")
    own = F.concat(F.lit("s"), "supplier")
    return of_parts.unionAll(drawn.select(own.alias("node"), F.coalesce("component", own).alias("component")))


def _precedence(spark, d):
    return sequence_links(spark, d).select("src", "dst", F.col("n").cast("double").alias("strength"))


# Strongest first; ``p`` holds the pairs (x, y) such that the edges kept so far lead from x to y.
_DAG = (
    f"WITH RECURSIVE {_STEPS}, o AS (SELECT src, dst, n, row_number() OVER (ORDER BY n DESC, src DESC, dst DESC) AS k FROM e WHERE src <> dst), "
    "g AS (SELECT 0::BIGINT AS k, NULL::VARCHAR AS src, NULL::VARCHAR AS dst, NULL::BIGINT AS n, true AS stays, []::STRUCT(x VARCHAR, y VARCHAR)[] AS p "
    "UNION ALL SELECT o.k, o.src, o.dst, o.n, NOT list_contains(g.p, {'x': o.dst, 'y': o.src}), CASE WHEN list_contains(g.p, {'x': o.dst, 'y': o.src}) THEN g.p ELSE "
    "list_distinct(g.p || [{'x': o.src, 'y': o.dst}] || [{'x': q.x, 'y': o.dst} FOR q IN g.p IF q.y = o.src] || [{'x': o.src, 'y': q.y} FOR q IN g.p IF q.x = o.dst] "
    "|| flatten([[{'x': q.x, 'y': t.y} FOR t IN g.p IF t.x = o.dst] FOR q IN g.p IF q.y = o.src])) END FROM g JOIN o ON o.k = g.k + 1), "
    "kept AS (SELECT src, dst, n FROM g WHERE stays AND k > 0) "
)


@query(_DAG + "SELECT src, dst, CAST(n AS DOUBLE) AS strength FROM kept")
def prereq_dag(spark, d):
    return dag.break_cycles(_precedence(spark, d))


@query(
    _DAG + ", ends AS (SELECT src AS node FROM kept UNION SELECT dst FROM kept), far(node, level) AS (SELECT node, 0 FROM ends UNION SELECT kept.dst, far.level + 1 FROM far JOIN kept ON kept.src = far.node) "
    "SELECT node, CAST(max(level) AS INTEGER) AS level FROM far GROUP BY node"
)
def topo_order(spark, d):
    return dag.levels(prereq_dag(spark, d))


@query(_DAG + "SELECT DISTINCT src AS slug FROM kept WHERE src NOT IN (SELECT dst FROM kept)")
def dag_roots(spark, d):
    return graph.roots(prereq_dag(spark, d).withColumn("type", F.lit("prerequisite")))


@query(
    "WITH l AS (SELECT l_partkey AS s, l_suppkey AS d, CASE WHEN l_returnflag = 'N' THEN 'related' ELSE 'part_of' END AS type FROM lineitem), m AS (SELECT s - s % 7 AS src, d - d % 7 AS dst, type FROM l), "
    "k AS (SELECT * FROM m WHERE src <> dst AND src IN (SELECT p_partkey FROM part) AND dst IN (SELECT p_partkey FROM part)) "
    "SELECT CASE WHEN type = 'related' THEN least(src, dst) ELSE src END AS src, CASE WHEN type = 'related' THEN greatest(src, dst) ELSE dst END AS dst, type, count(*) AS n FROM k GROUP BY 1, 2, 3"
)
def canonical_links(spark, d):
    """Every part leads through a chain of aliases to the multiple of seven below it; links of a symmetric type have sorted ends."""
    key = F.col("p_partkey")
    parts = table(spark, d, "part").select(key.alias("slug"))
    aliases = table(spark, d, "part").where(key % 7 != 0).select(key.alias("alias"), (key - 1).alias("canonical"))
    links = table(spark, d, "lineitem").select(F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst"), F.when(F.col("l_returnflag") == "N", "related").otherwise("part_of").alias("type"))
    return graph.canonical_links(links, parts, aliases).groupBy("src", "dst", "type").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT p_partkey AS alias, p_partkey - p_partkey % 3 AS canonical FROM part WHERE p_partkey % 3 <> 0 AND p_partkey - p_partkey % 3 IN (SELECT p_partkey FROM part)")
def merge_groups(spark, d):
    """Pairs judged the same make groups; the member named canonical most often stands for its group."""
    parts, key = table(spark, d, "part").select(F.col("p_partkey").alias("slug")), F.col("slug")
    said = parts.where(key % 3 != 0).select(key.alias("slug_a"), (key - key % 3).alias("slug_b"), F.lit(True).alias("same"), (key - key % 3).alias("canonical"))
    return graph.merge_groups(said, parts)


_RANK = "CASE type WHEN 'prerequisite' THEN 0 WHEN 'part_of' THEN 1 WHEN 'applies_to' THEN 2 WHEN 'contrasts_with' THEN 3 ELSE 4 END"


@query(
    "WITH l AS (SELECT DISTINCT p_brand AS src, p_type AS dst, ['prerequisite', 'part_of', 'applies_to', 'contrasts_with', 'related'][1 + p_size % 5] AS type FROM part) "
    f"SELECT src, dst, type, row_number() OVER (ORDER BY {_RANK}, src, dst) - 1 AS place FROM l"
)
def ordered_links(spark, d):
    """Links in the order of an export, numbered: a global sort, numbered inside partitions and shifted by their sizes."""
    kinds = F.array(*[F.lit(k) for k in graph.LINK_ORDER])
    links = table(spark, d, "part").select(F.col("p_brand").alias("src"), F.col("p_type").alias("dst"), F.get(kinds, (F.col("p_size") % 5).cast("int")).alias("type")).distinct()
    placed = checkpoint(graph.by_rank(links).withColumn("at", F.monotonically_increasing_id()))
    part, inside = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    before = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    return placed.withColumn("part", part).join(F.broadcast(before), "part").select("src", "dst", "type", (F.col("base") + inside).alias("place"))


@query(
    "WITH m AS (SELECT p_brand AS brand, p_name, p_type, p_size, p_partkey FROM part), "
    "n AS (SELECT brand, arg_min(p_name, p_partkey) AS first_name, CAST(round_even(avg(p_size), 0) AS INTEGER) AS mean_size FROM m GROUP BY brand), "
    "l AS (SELECT brand, p_name AS longest FROM (SELECT *, row_number() OVER (PARTITION BY brand ORDER BY length(p_name) DESC, p_partkey) AS k FROM m WHERE p_name <> '') WHERE k = 1), "
    "t AS (SELECT brand, p_type AS kind FROM (SELECT brand, p_type, row_number() OVER (PARTITION BY brand ORDER BY count(*) DESC, min(p_partkey)) AS k FROM m GROUP BY brand, p_type) WHERE k = 1), "
    "u AS (SELECT brand, string_agg(DISTINCT p_type, '|' ORDER BY p_type) AS types FROM m GROUP BY brand) "
    "SELECT brand, first_name, longest, mean_size, kind, types FROM n JOIN l USING (brand) JOIN t USING (brand) JOIN u USING (brand)"
)
def concept_rollup(spark, d):
    p = table(spark, d, "part")
    m = p.select(F.col("p_brand").alias("slug"), F.col("p_name").alias("name"), F.col("p_name").alias("definition"), F.col("p_size").alias("difficulty"), F.col("p_type").alias("kind"), F.col("p_type").alias("domain"), F.col("p_brand").alias("course"), F.col("p_type").alias("unit_id"), F.col("p_partkey").alias("ord"))
    r = graph.rollup_concepts(m)
    return r.select(F.col("slug").alias("brand"), F.col("name").alias("first_name"), F.col("definition").alias("longest"), F.col("difficulty").alias("mean_size"), "kind", F.array_join("units", "|").alias("types"))


@query("WITH c AS (SELECT source, count(*) AS n FROM documents GROUP BY 1) SELECT min(n) AS min_n, max(n) AS max_n, list_sort(list(n))[count(*) // 2 + 1] AS median_n, count(*) FILTER (n NOT BETWEEN 5 AND 10) AS out_of_range FROM c")
def units_per_key_stats(spark, d):
    return quality.spread(table(spark, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n")), "n")


@query(
    "WITH e AS (SELECT DISTINCT source FROM documents), c AS (SELECT DISTINCT d.source FROM documents d JOIN labels l USING (doc_id)), "
    "s AS (SELECT (SELECT count(*) FROM e) AS expected, (SELECT count(*) FROM c) AS covered, (SELECT count(*) FROM labels l WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = l.doc_id)) AS dangling, (SELECT count(*) FROM documents WHERE length(text) < 20) AS thin) "
    "SELECT expected, covered, round_even(covered / expected, 4) AS coverage, dangling, thin, (round_even(covered / expected, 4) >= 0.95 AND dangling = 0) AS passed FROM s"
)
def quality_gate(spark, d):
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    covered = docs.select("doc_id", "source").join(labels.select("doc_id"), "doc_id", "left_semi")
    lost = quality.dangling(labels.select("doc_id"), docs, "doc_id", "doc_id").agg(F.count(F.lit(1)).alias("dangling"))
    r = quality.coverage(docs, covered, "source").join(quality.thin(docs, "text"), F.lit(True)).join(lost, F.lit(True))
    return r.select("expected", "covered", "coverage", "dangling", "thin", ((F.col("coverage") >= quality.MIN_COVERAGE) & (F.col("dangling") == 0)).alias("passed"))


@query(
    "SELECT n1.n_name AS src, n2.n_name AS dst, count(*) AS links FROM supplier s JOIN lineitem l ON l.l_suppkey = s.s_suppkey JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey "
    "JOIN nation n1 ON n1.n_nationkey = s.s_nationkey JOIN nation n2 ON n2.n_nationkey = c.c_nationkey WHERE s.s_nationkey <> c.c_nationkey GROUP BY 1, 2"
)
def cross_group_links(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    li = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    links = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(F.concat(F.lit("s"), "l_suppkey").alias("src"), F.concat(F.lit("c"), "o_custkey").alias("dst"))
    nodes = s.select(F.concat(F.lit("s"), "s_suppkey").alias("node"), F.col("s_nationkey").alias("nation"))
    nodes = nodes.unionAll(table(spark, d, "customer").select(F.concat(F.lit("c"), "c_custkey"), F.col("c_nationkey")))
    across = quality.grouped_links(links, nodes, "node", "nation").where("src_group <> dst_group").groupBy("src_group", "dst_group").agg(F.count(F.lit(1)).alias("links"))
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    a, b = n.select(F.col("n_nationkey").alias("src_group"), F.col("n_name").alias("src")), n.select(F.col("n_nationkey").alias("dst_group"), F.col("n_name").alias("dst"))
    return across.join(a, "src_group").join(b, "dst_group").select("src", "dst", "links")


# Lessons


_LINE = "CASE p_partkey % 11 WHEN 0 THEN 'Week ' || p_size WHEN 1 THEN 'Topic ' || p_size || '. ' || p_type WHEN 2 THEN 'Lecture ' || p_size || ': ' || p_name WHEN 3 THEN '• ' || p_name ELSE p_type END"


@query(
    f"WITH l AS (SELECT CAST(p_partkey // 50 AS BIGINT) AS syllabus, p_partkey AS p, {_LINE} AS line, CASE WHEN p_partkey % 11 = 0 THEN CAST(p_size AS INTEGER) END AS wk, CASE WHEN p_partkey % 11 = 1 THEN p_type END AS tp, "
    "CASE WHEN p_partkey % 11 = 2 THEN p_name END AS lec, CAST(p_size AS INTEGER) AS no FROM part), "
    "o AS (SELECT *, count(coalesce(lec, tp)) OVER (PARTITION BY syllabus ORDER BY p) AS n_open FROM l), "
    "w AS (SELECT *, lec IS NOT NULL OR (tp IS NOT NULL AND n_open = 1) AS opens, last_value(wk IGNORE NULLS) OVER r AS week, last_value(tp IGNORE NULLS) OVER r AS topic FROM o WINDOW r AS (PARTITION BY syllabus ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), "
    "s AS (SELECT *, sum(opens::INT) OVER (PARTITION BY syllabus ORDER BY p) AS lesson FROM w) "
    "SELECT syllabus, CAST(lesson AS INTEGER) AS lesson, max(CASE WHEN opens THEN CASE WHEN lec IS NULL THEN 'topic' ELSE 'lecture' END END) AS kind, max(CASE WHEN opens THEN CASE WHEN lec IS NULL THEN 0 ELSE no END END) AS number, "
    "max(CASE WHEN opens THEN coalesce(lec, tp) END) AS title, max(CASE WHEN opens THEN week END) AS week, max(CASE WHEN opens THEN topic END) AS topic, "
    "CAST(sum(CASE WHEN opens THEN length(coalesce(lec, tp)) WHEN wk IS NULL AND tp IS NULL THEN 1 + length(line) ELSE 0 END) AS INTEGER) AS chars FROM s WHERE lesson > 0 GROUP BY 1, 2"
)
def lesson_blocks(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.expr(_LINE).alias("line"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", "line"))), lambda x: x["line"]), "\n")
    docs = p.groupBy(F.floor(F.col("p_partkey") / 50).alias("syllabus")).agg(text.alias("text"))
    return lessons.split_lessons(docs, "syllabus", "text").withColumn("chars", F.length("text")).drop("text")


_ADMIN = "[" + ", ".join(f"'{w}'" for w in lessons.ADMIN_WORDS) + "]"
_BARE_SLUG = SLUG.format(r"regexp_replace(name, '\([^)]*\)', ' ', 'g')")
_CUT = r"regexp_replace(regexp_replace(text, '/([A-Z])', chr(1) || '\1', 'g'), '\.\s+|\.$|;|,| and | or |\n|\s*[●•▪◆▲]\s*', chr(1), 'g')"


@query(
    f"WITH f AS (SELECT item_id, string_split({_CUT}, chr(1)) AS l FROM benchmark), e AS (SELECT item_id, unnest(range(len(l))) AS pos, unnest(l) AS raw FROM f), "
    r"c AS (SELECT item_id, pos, trim(regexp_replace(regexp_replace(trim(raw, ' .;,:()'), '\s+', ' ', 'g'), '(?i)^(?:the|a|an)\s+', '')) AS f FROM e), "
    rf"w AS (SELECT *, list_filter(string_split_regex(regexp_replace(regexp_replace(lower(f), '[()./:,]', ' ', 'g'), '\d+\.?\d*', ' ', 'g'), '\s+'), lambda x: x <> '') AS ws FROM c WHERE length(f) BETWEEN 3 AND 58 AND NOT regexp_matches(f, '{lessons.NOISE}') AND regexp_matches(f, '[A-Za-z]{{3}}')), "
    rf"n AS (SELECT item_id, pos, trim(regexp_replace(f, '{lessons.GERUNDS}', '')) AS name FROM w WHERE NOT (len(ws) > 0 AND list_has_all({_ADMIN}, ws))), "
    rf"s AS (SELECT item_id, pos, name, {_BARE_SLUG} AS slug FROM n WHERE length(name) BETWEEN 3 AND 58) "
    "SELECT item_id, slug, arg_min(name, pos) AS name, CAST(min(pos) AS INTEGER) AS pos FROM s WHERE slug <> '' GROUP BY 1, 2"
)
def topic_fragments(spark, d):
    return lessons.fragment_names(table(spark, d, "benchmark"), ["item_id"], "text")


# Windows


@query(
    "WITH c AS (SELECT conv_id, turn, role, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER w AS session, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER w AS user_turn FROM conversations "
    "WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) SELECT conv_id, turn, role, CAST(session AS BIGINT) AS session, user_turn FROM c"
)
def sessionise_lines(spark, d):
    c = table(spark, d, "conversations").select("conv_id", "turn", "role")
    c = windows.session_ids(c, "conv_id", "turn", F.col("role") == "user", "session")
    return windows.carry_forward(c, "conv_id", "turn", F.when(F.col("role") == "user", F.col("turn")), "user_turn")


@query("SELECT min(doc_id) AS doc_id, source FROM documents GROUP BY source, text")
def keep_first_dedupe(spark, d):
    hashed = table(spark, d, "documents").select("doc_id", "source", F.sha2("text", 256).alias("h"))
    return graph.keep_first(hashed, ["source", "h"], ["doc_id"]).select("doc_id", "source")


@query("SELECT doc_id, source, CAST((row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 45 AS INTEGER) AS slice FROM documents")
def slice_rows(spark, d):
    return windows.slice_rows(table(spark, d, "documents").select("doc_id", "source"), "source", ["doc_id"], 45)


# Planner


@query("SELECT o_custkey AS cust, CAST(month(o_orderdate) AS INTEGER) AS term, count(*) AS n FROM orders GROUP BY 1, 2 HAVING count(*) > 2")
def plan_overload(spark, d):
    plans = table(spark, d, "orders").select(F.col("o_custkey").alias("plan"), F.month("o_orderdate").alias("term"))
    return planner.overloaded_terms(plans, F.lit(1), 2).select(F.col("plan").alias("cust"), "term", F.col("total").alias("n"))


_PLAN = "SELECT o.o_custkey AS cust, l.l_partkey AS part, o.o_orderkey AS pos, l.l_linenumber AS line, o.o_orderdate AS day FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey"


def _plan(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    return o.join(li, F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_custkey").alias("plan"), F.col("l_partkey").alias("code"), F.col("o_orderkey").alias("pos"), F.col("l_linenumber").alias("line"), F.col("o_orderdate").alias("day"))


@query(f"WITH p AS ({_PLAN}), w AS (SELECT *, lag(pos) OVER (PARTITION BY cust, part ORDER BY pos, line) AS before FROM p) SELECT cust, part, pos, before FROM w WHERE before IS NOT NULL")
def plan_duplicates(spark, d):
    return planner.repeated_courses(_plan(spark, d), ["pos", "line"], "pos").select(F.col("plan").alias("cust"), F.col("code").alias("part"), "pos", "before")


@query(f"WITH p AS ({_PLAN}), w AS (SELECT *, lag(day) OVER (PARTITION BY cust, part ORDER BY pos, line) AS earlier FROM p) SELECT cust, part, pos FROM w WHERE earlier >= day")
def plan_order(spark, d):
    again = planner.repeated_courses(_plan(spark, d), ["pos", "line"], "day")
    return again.where("before >= day").select(F.col("plan").alias("cust"), F.col("code").alias("part"), "pos")


@query(
    f"WITH p AS ({_PLAN}), t AS (SELECT cust, part, CAST(month(arg_max(day, (pos, line))) AS INTEGER) AS term FROM p GROUP BY 1, 2) "
    "SELECT a.cust, a.part, a.term, a.part - 1 AS needs, b.term AS needs_term FROM t a JOIN t b ON b.cust = a.cust AND b.part = a.part - 1 WHERE b.term >= a.term"
)
def plan_prerequisites(spark, d):
    """Every part asks for the one numbered before it; parts of a customer's plan that do not come in a later month than what they ask for."""
    placed = _plan(spark, d).groupBy("plan", "code").agg(F.max_by(F.month("day"), F.struct("pos", "line")).alias("term"))
    needs = table(spark, d, "part").select(F.col("p_partkey").alias("code"), (F.col("p_partkey") - 1).alias("needs"))
    return planner.late_prerequisites(placed, needs).select(F.col("plan").alias("cust"), F.col("code").alias("part"), "term", "needs", "needs_term")


@query(
    f"WITH p AS ({_PLAN}), q AS (SELECT cust, part, CAST(month(day) AS INTEGER) AS term, lag(1) OVER (PARTITION BY cust, part ORDER BY pos, line) AS before FROM p), "
    "c AS (SELECT cust, term, 'duplicate_course' AS type FROM q WHERE before IS NOT NULL UNION ALL SELECT cust, term, 'credit_overload' FROM q JOIN part ON p_partkey = part GROUP BY 1, 2 HAVING sum(p_size) > 250) SELECT cust, type, term, count(*) AS n FROM c GROUP BY 1, 2, 3"
)
def plan_conflicts(spark, d):
    """Conflicts in the plans of all customers at once, counted by kind and term; no part asks for another here."""
    plans = _plan(spark, d).select("plan", (F.col("pos") * 10 + F.col("line")).alias("pos"), F.col("code").cast("string").alias("code"), F.month("day").alias("term"))
    courses = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("code"), F.col("p_size").alias("ects"), F.array().cast("array<string>").alias("prerequisites"))
    found = planner.plan_conflicts(plans, courses, 250)
    return found.groupBy(F.col("plan").alias("cust"), "type", "term").agg(F.count(F.lit(1)).alias("n"))


@query(
    "WITH t AS (SELECT o.o_custkey AS cust, l.l_partkey AS part, o.o_orderstatus AS st FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey), done AS (SELECT DISTINCT cust, part FROM t WHERE st = 'F'), "
    "todo AS (SELECT t.cust, t.part FROM t LEFT JOIN done d ON d.cust = t.cust AND d.part = t.part WHERE t.st <> 'F' AND d.part IS NULL) "
    "SELECT cust, CAST(sum(p_size) AS BIGINT) AS total, sum(p_size) > 600 AS over_budget FROM todo JOIN part ON p_partkey = part GROUP BY cust"
)
def validate_plan_budget(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("plan"), F.col("o_orderstatus").alias("st"))
    t = o.join(table(spark, d, "lineitem").select("l_orderkey", F.col("l_partkey").alias("code")), F.col("o_orderkey") == F.col("l_orderkey")).select("plan", "code", "st")
    credits = table(spark, d, "part").select(F.col("p_partkey").alias("code"), F.col("p_size").alias("ects"))
    said = planner.plan_totals(t.where("st <> 'F'"), t.where("st = 'F'"), credits, 600)
    return said.select(F.col("plan").alias("cust"), "total", "over_budget")


@query(
    f"WITH c AS (SELECT p_partkey, p_brand, p_name, {TOKEN_SET.format('p_name')} AS k FROM part), known AS (SELECT DISTINCT k FROM c WHERE p_brand = 'Brand#11' AND k <> ''), "
    "m AS (SELECT c.p_brand AS brand, count(*) AS total, count(known.k) AS covered FROM c LEFT JOIN known ON known.k = c.k GROUP BY 1) SELECT brand, total, covered, total - covered AS residual, total - covered <= 5 AS waivable FROM m"
)
def waiver_coverage(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_brand", F.col("p_name").alias("name"))
    known = p.where("p_brand = 'Brand#11'").select("name")
    c = planner.coverage(p, known, ["p_brand"])
    m = c.groupBy(F.col("p_brand").alias("brand")).agg(F.count(F.lit(1)).alias("total"), F.count_if("covered").alias("covered"))
    return m.select("brand", "total", "covered", (F.col("total") - F.col("covered")).alias("residual"), (F.col("total") - F.col("covered") <= 5).alias("waivable"))


@query("SELECT p_brand AS brand, p_type AS kind, count(*) AS n FROM part GROUP BY 1, 2")
def kind_distribution(spark, d):
    return planner.kind_counts(table(spark, d, "part").select(F.col("p_brand").alias("brand"), F.col("p_type").alias("kind")), "brand")


@query(
    f"WITH c AS (SELECT p_brand, p_name, {TOKEN_SET.format('p_name')} AS k FROM part WHERE p_brand IN ('Brand#12', 'Brand#13')) "
    "SELECT a.p_name AS name_a, b.p_name AS name_b, count(*) AS pairs FROM c a JOIN c b ON a.k = b.k AND a.k <> '' WHERE a.p_brand = 'Brand#12' AND b.p_brand = 'Brand#13' GROUP BY 1, 2"
)
def compare_groups(spark, d):
    p = table(spark, d, "part").select("p_brand", F.col("p_name").alias("name"))
    # Names repeat often: counts of distinct names are joined and multiplied, not the rows.
    side = lambda b: p.where(F.col("p_brand") == b).groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    a, b = side("Brand#12"), side("Brand#13")
    j = planner.related_names(a, b).join(a.select(F.col("name").alias("name_a"), F.col("n").alias("na")), "name_a").join(b.select(F.col("name").alias("name_b"), F.col("n").alias("nb")), "name_b")
    return j.select("name_a", "name_b", (F.col("na") * F.col("nb")).alias("pairs"))


# Export and cost


@query("SELECT n_name, r_name, (SELECT string_agg(m.n_name, '|' ORDER BY m.n_name) FROM nation m WHERE m.n_regionkey = n.n_regionkey) AS neighbours FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey")
def export_star(spark, d):
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    joined = n.groupBy("n_regionkey").agg(F.array_sort(F.collect_list("n_name")).alias("neighbours"))
    return sinks.flat(n.join(joined, "n_regionkey").join(r, F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name", "neighbours"))


@query(
    "WITH p(flag, pin, pout) AS (VALUES ('A', 15.0, 75.0), ('N', 3.0, 15.0)) SELECT l_returnflag AS stage, count(*) AS calls, CAST(sum(l_quantity) AS BIGINT) AS tokens_in, "
    "round(sum(CAST(l_quantity AS DOUBLE)) / 1e6 * coalesce(max(pin), 0) + count(*) / 1e6 * coalesce(max(pout), 0), 4) AS usd FROM lineitem LEFT JOIN p ON flag = l_returnflag GROUP BY 1"
)
def usage_cost(spark, d):
    price = spark.createDataFrame([("A", 15.0, 75.0), ("N", 3.0, 15.0)], "model string, price_in double, price_out double")
    flag = F.col("l_returnflag")
    calls = table(spark, d, "lineitem").select(flag.alias("stage"), flag.alias("model"), F.col("l_quantity").alias("tokens_in"), F.lit(1).alias("tokens_out"), F.lit(False).alias("cached"))
    return usage.usage(calls, price).select("stage", "calls", F.col("tokens_in").cast("long").alias("tokens_in"), "usd")
