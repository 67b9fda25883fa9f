"""Course backups: tar archives of XML and files, unpacked into text parts, attachments and a report."""

from __future__ import annotations

import html
import io
import tarfile
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenpath.functions import text as T

# Fixed values that results depend on.
TEXT_TAGS = ["name", "intro", "summary", "content", "definition", "concept", "description", "activity", "page_after_submit", "message", "subject", "questiontext", "generalfeedback"]
SKIPPED_XML = ["grades.xml", "grade_history.xml", "roles.xml", "filters.xml", "inforef.xml", "calendar.xml", "completion.xml", "comments.xml"]
SUBSTANTIVE = ["page", "book", "lesson", "resource", "folder", "assign", "quiz", "workshop", "wiki", "scorm"]
DOCUMENTS = ["pdf", "docx", "doc", "pptx", "ppt", "xlsx", "xls", "txt", "md", "rtf", "odt", "csv"]
MIN_PART, MIN_BODY, THIN_COURSE = 3, 20, 3000


def members(archives: DataFrame) -> DataFrame:
    """``path, member, content`` of every file in ``archives(path, content)``; absolute and parent paths are left out.

    One member is one row, so an archive is never held as rows at once. A broken archive gives no rows.
    """

    def run(batches):
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                try:
                    with tarfile.open(fileobj=io.BytesIO(content), mode="r:*") as tar:
                        for m in tar:
                            if m.isfile() and not m.name.startswith("/") and ".." not in m.name.split("/"):
                                name = m.name[2:] if m.name.startswith("./") else m.name
                                yield pd.DataFrame([(path, name, tar.extractfile(m).read())], columns=["path", "member", "content"])
                except (tarfile.TarError, EOFError, OSError):
                    continue

    return archives.select("path", "content").mapInPandas(run, "path string, member string, content binary")


def xml_fields(found: DataFrame) -> DataFrame:
    """``path, member, root_id, record, pos, tag, text``: every element with text; ``record`` numbers the root's children."""

    def run(batches):
        for pdf in batches:
            rows = []
            for path, member, content in zip(pdf["path"], pdf["member"], pdf["content"]):
                try:
                    root = ElementTree.fromstring(content)
                except ElementTree.ParseError:
                    continue
                n = 0
                for record, child in enumerate([root, *root]):
                    for e in [root] if record == 0 else child.iter():
                        if e.text and e.text.strip():
                            rows.append((path, member, root.get("id"), record, n, e.tag, html.unescape(e.text)))
                            n += 1
            yield pd.DataFrame(rows, columns=["path", "member", "root_id", "record", "pos", "tag", "text"])

    raw = found.where(F.col("member").endswith(".xml")).mapInPandas(run, "path string, member string, root_id string, record int, pos int, tag string, text string")
    return raw.withColumn("text", T.html_text(F.col("text"), entities=False))


def _first(tag: str):
    return F.coalesce(F.min_by("text", F.when((F.col("tag") == tag) & (F.col("text") != ""), F.col("pos"))), F.lit(""))


def _number(c):
    return F.coalesce(F.when(c.rlike(r"^\d+$"), c).try_cast("int"), F.lit(0))


def unpack(archives: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(texts, attachments, report) of course backups ``archives(path, content)``.

    Texts: ``path, section, part, title, body`` of activities and section summaries with at
    least MIN_BODY characters; equal parts of an activity count once, in order. Attachments:
    ``path, name, content`` under their real names, with _1, _2 before the ending of a name
    that repeats. Report: one row per archive with a course or activity.
    """
    found = members(archives)
    fields = xml_fields(found)
    course = fields.where("member = 'course/course.xml'").groupBy("path").agg(_first("fullname").alias("full"), _first("shortname").alias("short")).select("path", F.coalesce(F.nullif("full", F.lit("")), "short").alias("course"))
    at = F.split("member", "/")
    sections = fields.where(F.col("member").rlike(r"^sections/section_[^/]*/section\.xml$")).groupBy("path", F.coalesce("root_id", F.substring_index(at[1], "_", -1)).alias("section_id"))
    sections = sections.agg(_number(_first("number")).alias("section"), _first("name").alias("title"), _first("summary").alias("summary"))

    activities = found.where(F.col("member").rlike(r"^activities/[^/]*_[^/]*/")).select("path", at[1].alias("part")).distinct().withColumn("kind", F.regexp_replace("part", "_[^_]*$", ""))
    inside = fields.where(F.col("member").rlike(r"^activities/[^/]*_[^/]*/[^/]*\.xml$")).withColumn("part", at[1]).withColumn("file", at[2])
    module = inside.where("file = 'module.xml'").groupBy("path", "part").agg(_number(_first("sectionnumber")).alias("own"), _first("sectionid").alias("section_id"))
    pieces = inside.where(~F.col("file").isin(SKIPPED_XML) & F.col("tag").isin(TEXT_TAGS) & (F.length("text") >= MIN_PART)).withColumn("line", F.concat(F.lit("["), "tag", F.lit("] "), "text"))
    once = pieces.groupBy("path", "part", "line").agg(F.min(F.struct("file", "pos")).alias("at"))
    bodies = once.groupBy("path", "part").agg(F.array_sort(F.collect_list(F.struct("at", "line"))).alias("l")).select("path", "part", F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias("body"))
    placed = bodies.where(F.length("body") >= MIN_BODY).join(module, ["path", "part"], "left").join(sections.select("path", "section_id", "section", "title"), ["path", "section_id"], "left")
    texts = placed.select("path", F.coalesce("section", "own", F.lit(0)).alias("section"), "part", F.coalesce("title", F.lit("")).alias("title"), "body")
    texts = texts.unionAll(sections.where(F.length("summary") >= MIN_BODY).select("path", "section", F.lit("section_summary"), "title", "summary"))

    listed = fields.where("member = 'files.xml' and record > 0").groupBy("path", "record").agg(_first("filename").alias("name"), _first("contenthash").alias("hash")).where("name not in ('', '.') and hash <> ''")
    blobs = found.where(F.col("member").startswith("files/")).select("path", F.substring_index("member", "/", -1).alias("hash"), "content")
    held = listed.join(blobs, ["path", "hash"])
    is_doc = F.lower(F.substring_index("name", ".", -1)).isin(DOCUMENTS) & F.col("name").contains(".")
    nth = (F.row_number().over(Window.partitionBy("path", "name").orderBy("record")) - 1).cast("string")
    files = held.where(is_doc).withColumn("_n", nth)
    files = files.select("path", F.when(F.col("_n") == "0", F.col("name")).otherwise(F.concat(F.regexp_replace("name", r"\.[^.]*$", ""), F.lit("_"), "_n", F.lit("."), F.substring_index("name", ".", -1))).alias("name"), "content")

    by_kind = activities.groupBy("path", "kind").agg(F.count(F.lit(1)).alias("n")).groupBy("path").agg(F.sum("n").alias("activities"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("kind", "n")))).alias("by_type"))
    n = lambda df, name: df.groupBy("path").agg(F.count(F.lit(1)).alias(name))
    sizes = texts.groupBy("path").agg(F.count(F.lit(1)).alias("texts"), F.sum(F.length("body")).alias("text_chars"))
    r = archives.select("path").join(course, "path", "left").join(by_kind, "path", "left").join(sizes, "path", "left").join(n(sections, "sections"), "path", "left").join(n(files, "documents"), "path", "left").join(n(held.where(~is_doc), "skipped_media"), "path", "left")
    r = r.na.fill(0, ["activities", "texts", "text_chars", "sections", "documents", "skipped_media"])
    bare = ~F.coalesce(F.arrays_overlap(F.map_keys("by_type"), F.array(*[F.lit(k) for k in SUBSTANTIVE])), F.lit(False)) & (F.col("documents") == 0)
    note = F.when(bare, "course shell only: nothing that holds content").when((F.col("text_chars") < THIN_COURSE) & (F.col("documents") == 0), "little text and no documents")
    return texts, files, r.withColumn("course", F.coalesce(F.nullif("course", F.lit("")), F.regexp_extract("path", r"([^/]*?)(?:\.[^./]*)?$", 1))).withColumn("note", note)
