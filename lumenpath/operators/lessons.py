"""Lessons of a syllabus: segmentation by anchors, topic names, units and the links its structure justifies.

Everything is a Column expression or a window over one document's lines; no model is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenpath.functions import text as T

# Fixed values that results depend on.
ANCHORS = [
    ("session", r"(?i)^\s*Problem\s+Solving\s+Session\s+(\d+)\.?\s*(.*)$"),
    ("materials", r"(?i)^\s*Preparation\s+lecture\s+materials\s+(\d+)\.?\s*(.*)$"),
    ("practice", r"(?i)^\s*Practice\s+session\s+(\d+)\.?\s*(.*)$"),
    ("lecture", r"(?i)^\s*Lecture\s+(\d+)\s*:?\s*(.*)$"),
    ("module", r"(?i)^\s*(\d+)\s*\(Week[^)]*\)\s*()$"),
]
WEEK = r"(?i)^\s*Week\s+(\d+)\b"
TOPIC = r"(?i)^\s*(?:Topic|Block)\s+(\d+)\.?\s*(.*)$"
BULLET = r"^\s*[●•▪◆▲*·-]\s*(.+)$"
SPLIT = r"\.\s+|\.$|;|,| and | or |/(?=[A-Z])|\n|\s*[●•▪◆▲]\s*"
LINE_ENDS = r"\r\n|[\n\r\u000b\u000c\u001c-\u001e\u0085  ]"
NOISE = (
    r"(?i)^(?:test\s*\d*|topic\s+test.*|quiz\s*\d*|homework\s*\d*|exam|preparation\s+for\s+test.*|test\s+preparation.*"
    r"|revision\s+session.*|total\s+recall.*|course\s+wrap-?up.*|introduction\s+lecture.*|introductory\s+lecture.*"
    r"|answering\s+questions.*|khanacademy.*|project|practice\s+session\s*\d*|problem\s+solving"
    r"|\d+h?\s*(?:problem\s+solving|class\s+hours?)?|activity|content|module|topics|briefly|recap|examples?|properties"
    r"|their\s+properties|applications?|some\s+applications.*|and\s+\(?possibly\)?.*)\.?\s*$"
)
# Words that make no topic by themselves.
ADMIN_WORDS = ["h", "hr", "hrs", "hour", "hours", "class", "problem", "solving", "session", "sessions", "week", "weeks", "test", "tests", "homework", "quiz", "quizzes", "exam", "exams", "preparation", "revision", "practice", "lecture", "lectures", "materials", "block", "blocks", "before", "after", "for", "content"]
GERUNDS = r"(?i)^(?:using|usage of|building|finding|preparation for|operations with)\s+"
NAME_CHARS, HEADING_CHARS, QUOTE_CHARS, CONFIDENCE = (3, 58), 45, 300, 0.6


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def split_lessons(docs: DataFrame, key: str, text: str, compat: bool = False) -> DataFrame:
    """``key, lesson, kind, number, title, week, topic, text`` of every lesson, numbered from 1 in a document.

    A week line sets the week, a topic line the topic (its title, else all of it); both are
    consumed. An anchor opens a lesson, and so does a topic line as long as none is open.
    Other lines belong to the open lesson, or are dropped. A lesson keeps the week and topic
    in force when it opened. Null and empty texts have no lessons. ``key`` must be unique.
    """
    lines = docs.select(F.col(key).alias("_k"), F.posexplode(F.split(T.normalise(F.col(text), compat), LINE_ENDS)).alias("_p", "line"))
    lines = lines.withColumn("line", F.regexp_replace("line", r"\s+$", "")).where("line <> ''")
    line, kind, number, title = F.col("line"), F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, pattern in reversed(ANCHORS):
        hit = line.rlike(pattern)
        kind = F.when(hit, name).otherwise(kind)
        number = F.when(hit, F.regexp_extract(line, pattern, 1)).otherwise(number)
        title = F.when(hit, _strip(F.regexp_extract(line, pattern, 2))).otherwise(title)
    is_week = line.rlike(WEEK)
    is_topic = ~is_week & line.rlike(TOPIC)
    plain = ~is_week & ~is_topic
    named = F.coalesce(F.nullif(_strip(F.regexp_extract(line, TOPIC, 2)), F.lit("")), _strip(line))
    seen = lines.select(
        "_k", "_p", "line",
        F.when(is_week, F.regexp_extract(line, WEEK, 1).try_cast("int")).alias("_week"),
        F.when(is_topic, named).alias("_topic"),
        F.when(plain, kind).alias("_kind"),
        F.when(plain, number.try_cast("int")).alias("_number"),
        F.when(plain, title).alias("_title"),
    )
    w = Window.partitionBy("_k").orderBy("_p").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("_k").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    opener = F.coalesce(F.col("_kind"), F.col("_topic")).isNotNull()
    opens = F.col("_kind").isNotNull() | (F.col("_topic").isNotNull() & (F.coalesce(F.count_if(opener).over(before), F.lit(0)) == 0))
    placed = seen.withColumns({"_opens": opens, "week": F.last("_week", True).over(w), "topic": F.last("_topic", True).over(w)})
    placed = placed.withColumn("lesson", F.count_if("_opens").over(w).cast("int")).where("lesson > 0")
    body = F.col("_week").isNull() & F.col("_topic").isNull() & ~F.col("_opens")
    head = lambda c: F.max(F.when(F.col("_opens"), c))
    out = placed.groupBy("_k", "lesson").agg(
        F.coalesce(head(F.col("_kind")), F.lit("topic")).alias("kind"),
        F.coalesce(head(F.col("_number")), F.lit(0)).alias("number"),
        head(F.coalesce("_title", "_topic")).alias("title"),
        head(F.col("week")).alias("week"),
        head(F.col("topic")).alias("topic"),
        F.array_sort(F.collect_list(F.when(body, F.struct("_p", "line")))).alias("_lines"),
    )
    whole = _strip(F.concat_ws("\n", F.col("title"), F.transform("_lines", lambda x: x["line"])))
    return out.select(F.col("_k").alias(key), "lesson", "kind", "number", "title", "week", "topic", whole.alias("text"))


def pieces(text: Column) -> Column:
    """Raw fragments of a lesson: its bullets and the last two short lines above the first one, else all of it."""
    lines = F.split(text, "\n")
    first = F.array_position(F.transform(lines, lambda x: x.rlike(BULLET)), True).cast("int")
    above = F.filter(F.slice(lines, 1, F.greatest(first - 1, F.lit(0))), lambda x: (_strip(x) != "") & (F.length(_strip(x)) <= HEADING_CHARS))
    heads = F.slice(above, F.greatest(F.size(above) - 1, F.lit(1)), F.lit(2))
    bullets = F.transform(F.filter(lines, lambda x: x.rlike(BULLET)), lambda x: F.regexp_extract(x, BULLET, 1))
    chunks = F.when(first > 0, F.concat(F.transform(heads, _strip), bullets)).otherwise(F.array(text))
    return F.flatten(F.transform(chunks, lambda c: F.split(c, SPLIT)))


def clean_fragment(c: Column) -> Column:
    """Punctuation and a leading article off, spaces squeezed, a leading gerund phrase off."""
    f = F.regexp_replace(F.btrim(c, F.lit(" .;,:()")), r"\s+", " ")
    return _strip(F.regexp_replace(f, r"(?i)^(?:the|a|an)\s+", ""))


def is_admin(c: Column) -> Column:
    """Every word that is no number belongs to the vocabulary of schedules."""
    words = F.filter(F.split(F.regexp_replace(F.regexp_replace(F.lower(c), r"[()./:,]", " "), r"\d+\.?\d*", " "), r"\s+"), lambda w: w != "")
    return (F.size(words) > 0) & F.forall(words, lambda w: w.isin(ADMIN_WORDS))


def fragment_names(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys, pos, slug, name``: the names in each text of ``rows``, the first of each slug.

    A name has NAME_CHARS characters, three letters in a row, and is neither noise nor only
    words of a schedule. Null and empty texts have none.
    """
    raw = rows.select(*keys, F.posexplode(pieces(F.col(text))).alias("pos", "_f")).withColumn("_f", clean_fragment(F.col("_f")))
    fits = lambda c: F.length(c).between(*NAME_CHARS)
    raw = raw.where(fits(F.col("_f")) & ~F.col("_f").rlike(NOISE) & F.col("_f").rlike("[A-Za-z]{3}") & ~is_admin(F.col("_f")))
    named = raw.select(*keys, "pos", _strip(F.regexp_replace("_f", GERUNDS, "")).alias("name")).where(fits(F.col("name")))
    named = named.withColumn("slug", T.lesson_slug(F.col("name"))).where("slug <> ''")
    return named.groupBy(*keys, "slug").agg(F.min_by("name", "pos").alias("name"), F.min("pos").alias("pos")).select(*keys, "pos", "slug", "name")


def syllabus_units(files: DataFrame, compat: bool = False) -> tuple[DataFrame, DataFrame]:
    """Units and mentions of ``files(rel_path, course_code, text)``, without a model.

    Units are lessons that name something: ``unit_id, course, module, unit, title, topic,
    rel_path, block``. A unit id that came before gets the block's number in its file as
    suffix. Mentions are ``unit_id, course, slug, name, kind, difficulty, domain, definition,
    rel_path, role, quote, confidence, pos``; the quote is the lesson's first line.
    """
    lessons = split_lessons(files, "rel_path", "text", compat)
    names = fragment_names(lessons, ["rel_path", "lesson"], "text")
    kept = lessons.join(names.select("rel_path", "lesson").distinct(), ["rel_path", "lesson"]).join(files.select("rel_path", "course_code"), "rel_path")
    kept = kept.withColumn("block", F.row_number().over(Window.partitionBy("rel_path").orderBy("lesson")))
    uid = F.concat("course_code", F.lit("-"), F.upper(F.substring("kind", 1, 3)), F.when(F.col("number") < 10, F.lpad(F.col("number").cast("string"), 2, "0")).otherwise(F.col("number").cast("string")))
    kept = kept.withColumn("_uid", uid).withColumn("_n", F.row_number().over(Window.partitionBy("_uid").orderBy("rel_path", "block")))
    ordinal = F.regexp_extract("topic", r"(\d+)", 1).try_cast("int")
    units = kept.select(
        F.when(F.col("_n") > 1, F.concat("_uid", F.lit("-"), "block")).otherwise(F.col("_uid")).alias("unit_id"),
        F.col("course_code").alias("course"),
        F.coalesce(F.nullif(ordinal, F.lit(0)), "week", F.lit(0)).alias("module"),
        F.col("number").alias("unit"),
        F.coalesce(F.nullif(F.col("title"), F.lit("")), F.concat_ws(" ", "kind", F.col("number").cast("string"))).alias("title"),
        "topic", "rel_path", "block", "lesson",
        F.substring(F.substring_index("text", "\n", 1), 1, QUOTE_CHARS).alias("quote"),
    )
    mentions = names.join(units.select("rel_path", "lesson", "unit_id", "course", "quote"), ["rel_path", "lesson"]).select(
        "unit_id", "course", "slug", "name",
        T.guess_kind(F.col("name")).alias("kind"), F.lit(3).alias("difficulty"), F.lower("course").alias("domain"), F.lit("").alias("definition"),
        F.array().cast("array<string>").alias("aliases"),
        "rel_path", F.lit("introduced").alias("role"), "quote", F.lit(CONFIDENCE).alias("confidence"), "pos",
    )
    return units.drop("lesson", "quote"), mentions


def topic_map(units: DataFrame, mentions: DataFrame) -> DataFrame:
    """``unit_id, topic_slug`` where a unit's topic, or its part before "and", is itself a known slug."""
    slugs = mentions.select(F.col("slug").alias("_s")).distinct()
    whole = T.lesson_slug(F.regexp_replace("topic", r"^\d+\.?\s*", ""))
    cand = units.where("topic is not null").select("unit_id", whole.alias("_a")).withColumn("_b", F.substring_index("_a", "-and-", 1))
    a = cand.join(slugs.withColumnRenamed("_s", "_fa"), F.col("_a") == F.col("_fa"), "left")
    b = a.join(slugs.withColumnRenamed("_s", "_fb"), F.col("_b") == F.col("_fb"), "left")
    return b.select("unit_id", F.coalesce("_fa", "_fb").alias("topic_slug")).where("topic_slug is not null")


def structural_links(units: DataFrame, mentions: DataFrame, sequential: bool = False) -> DataFrame:
    """``src, dst, type, strength, rationale, origin``: names under a topic are part of it; with
    ``sequential`` the first name of each lesson leads to the next lesson's of the course."""
    part = mentions.select("unit_id", F.col("slug").alias("src")).join(topic_map(units, mentions), "unit_id").select("src", F.col("topic_slug").alias("dst")).where("src <> dst").distinct()
    link = lambda df, *v: df.select("src", "dst", *[F.lit(x).alias(n) for n, x in zip(("type", "strength", "rationale", "origin"), v)])
    out = link(part, "part_of", 0.7, "taught under this topic heading", "structure")
    if sequential:
        heads = mentions.groupBy("unit_id").agg(F.min_by("slug", "pos").alias("dst")).join(units, "unit_id")
        w = Window.partitionBy("course").orderBy("module", "unit", "rel_path", "block")
        steps = heads.select(F.lag("dst").over(w).alias("src"), "dst").where("src is not null and src <> dst").distinct()
        out = out.unionAll(link(steps, "prerequisite", 0.4, "scheduled before the next lesson", "sequence"))
    return out
