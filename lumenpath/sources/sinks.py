"""Exports of the star schema: CSV, JSON, seed SQL and the graph page's payload."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenpath.functions.text import sql_literal
from lumenpath.session import checkpoint


def flat(df: DataFrame, sep: str = "|") -> DataFrame:
    """Arrays joined by ``sep``, booleans as 0/1, nulls as empty text."""
    cols = []
    for name, kind in df.dtypes:
        c = F.col(name)
        c = F.concat_ws(sep, c) if kind.startswith("array") else c.cast("int") if kind == "boolean" else c
        cols.append(F.coalesce(c.cast("string"), F.lit("")).alias(name))
    return df.select(*cols)


def write_csv(tables: dict[str, DataFrame], root: str) -> list[str]:
    """One folder of CSV per table; empty tables are not written. Returns the names written."""
    done = []
    for name, df in tables.items():
        if not df.isEmpty():
            flat(df).write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').option("emptyValue", "").csv(f"{root}/{name}")
            done.append(name)
    return done


def write_json(tables: dict[str, DataFrame], root: str) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").json(f"{root}/{name}.json")


def whole_json(tables: dict[str, DataFrame]) -> DataFrame:
    """``value`` lines that make one JSON document when written as text in order: an object with an array for each table.

    Lines are numbered, so that a sorted write keeps their order at any size.
    """
    out, names = None, list(tables)
    for k, name in enumerate(names):
        df = tables[name]
        head = df.sparkSession.createDataFrame([(k, 0, 0, ("{" if k == 0 else "") + f'"{name}": [')], "part int, step int, at long, value string")
        rows = checkpoint(df.select(F.lit(k).alias("part"), F.lit(1).alias("step"), F.monotonically_increasing_id().alias("at"), F.to_json(F.struct("*")).alias("value")))
        first = rows.agg(F.min("at").alias("first"))
        rows = rows.join(F.broadcast(first)).select("part", "step", "at", F.concat(F.when(F.col("at") == F.col("first"), "").otherwise(", "), F.col("value")).alias("value"))
        tail = df.sparkSession.createDataFrame([(k, 2, 0, "]" + ("}" if k + 1 == len(names) else ","))], "part int, step int, at long, value string")
        part = head.unionAll(rows).unionAll(tail)
        out = part if out is None else out.unionAll(part)
    return out.orderBy("part", "step", "at").select("value")


def seed_sql(concepts: DataFrame, links: DataFrame) -> DataFrame:
    """``section, statement`` rows, in order of section one transaction, that insert concepts, aliases and links, each only where absent."""
    q = sql_literal
    c = concepts.select(F.lit(1).alias("section"), F.concat(F.lit("INSERT INTO concepts (slug, name, kind, definition, difficulty, domain, provenance, confidence) VALUES ("), F.concat_ws(", ", q(F.col("slug")), q(F.col("name")), q(F.col("kind")), q(F.col("definition")), F.col("difficulty").cast("string"), q(F.col("domain")), F.lit("'llm'"), F.lit("0.8")), F.lit(") ON CONFLICT (slug) DO NOTHING;")).alias("statement"))
    al = concepts.select("slug", F.explode("aliases").alias("a")).where("a <> ''")
    a = al.select(F.lit(2).alias("section"), F.concat(F.lit("INSERT INTO concept_aliases (concept_id, alias) SELECT id, "), q(F.col("a")), F.lit(" FROM concepts WHERE slug = "), q(F.col("slug")), F.lit(" ON CONFLICT DO NOTHING;")).alias("statement"))
    ln = links.select(F.lit(3).alias("section"), F.concat(F.lit("INSERT INTO concept_links (src_concept_id, dst_concept_id, type, strength, rationale, provenance) SELECT s.id, d.id, "), F.concat_ws(", ", F.concat(q(F.col("type")), F.lit("::link_type")), F.col("strength").cast("string"), q(F.col("rationale")), q(F.col("origin"))), F.lit(" FROM concepts s, concepts d WHERE s.slug = "), q(F.col("src")), F.lit(" AND d.slug = "), q(F.col("dst")), F.lit(" ON CONFLICT DO NOTHING;")).alias("statement"))
    edge = lambda n, text: concepts.sparkSession.createDataFrame([(n, text)], "section int, statement string")
    return edge(0, "BEGIN;").unionAll(c).unionAll(a).unionAll(ln).unionAll(edge(4, "COMMIT;"))


def graph_payload(concepts: DataFrame, links: DataFrame, occurrences: DataFrame, quote_chars: int = 400) -> DataFrame:
    """``part, json`` rows: nodes, links and each concept's occurrences, safe inside a script element."""
    safe = lambda c: F.replace(c, F.lit("</"), F.lit("<\\/"))
    row = lambda df, part: df.select(F.lit(part).alias("part"), safe(F.to_json(F.struct("*"))).alias("json"))
    occ = occurrences.withColumn("quote", F.substring("quote", 1, quote_chars)).groupBy("slug").agg(F.array_sort(F.collect_list(F.struct("rel_path", "role", "quote"))).alias("occ"))
    return row(concepts, "node").unionAll(row(links, "link")).unionAll(row(occ, "occ"))


PAGE = """<!doctype html><meta charset="utf-8"><title>Topics</title>
<style>body{font:14px sans-serif;margin:2em;max-width:60em}li.dim{opacity:.3}blockquote{color:#555}</style>
<input id="q" placeholder="search"> <label>links at least <input id="d" type="number" value="0" min="0"></label> <select id="c"><option value="">all courses</option></select>
<ul id="list"></ul><script>
const data = __DATA__, $ = id => document.getElementById(id);
[...new Set(data.node.flatMap(n => n.courses))].sort().forEach(c => $("c").add(new Option(c)));
function show() {
  $("list").replaceChildren(...data.node.filter(n => n.degree >= +$("d").value && (!$("c").value || n.courses.includes($("c").value))).map(n => {
    const li = document.createElement("li"), more = document.createElement("div"), q = $("q").value.toLowerCase();
    li.textContent = n.name + " (" + n.degree + ")";
    li.className = q && !n.name.toLowerCase().includes(q) && !n.slug.includes(q) ? "dim" : "";
    li.onclick = () => {
      more.textContent = data.link.filter(l => l.src === n.slug || l.dst === n.slug).map(l => l.src + " " + l.type + " " + l.dst).join("; ");
      data.occ.filter(o => o.slug === n.slug).flatMap(o => o.occ).forEach(o => { const b = document.createElement("blockquote"); b.textContent = o.quote + " (" + o.rel_path + ")"; more.append(b); });
      li.append(more);
    };
    return li;
  }));
}
["q", "d", "c"].forEach(i => $(i).oninput = show); show();
</script>
"""


def write_page(payload: DataFrame, path: str, max_bytes: int = 64 << 20) -> None:
    """The explorer as one HTML file. A page is one local file for a browser, so a payload over ``max_bytes`` is refused."""
    size = payload.agg(F.coalesce(F.sum(F.octet_length("json")), F.lit(0)).alias("n")).first()["n"]
    if size > max_bytes:
        raise ValueError(f"the page would have {size} bytes; filter the graph first")
    parts = {"node": [], "link": [], "occ": []}
    for row in payload.collect():
        parts[row["part"]].append(row["json"])
    data = "{" + ", ".join(f'"{k}": [{", ".join(v)}]' for k, v in parts.items()) + "}"
    with open(path, "w", encoding="utf-8") as f:
        f.write(PAGE.replace("__DATA__", data))
