"""Path adapters: what a file's path says about its place in a course, as Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Adapter = Callable[[Column], dict[str, Column]]
_ADAPTERS: dict[str, Adapter] = {}

# Fixed values that results depend on.
EXTENSIONS = ["pdf", "txt", "md", "docx", "xlsx"]
IGNORED = ["_concept_graph", "__pycache__", "node_modules", "venv", ".venv"]
ASSET_KINDS = ["video_transcript", "podcast_transcript", "notes", "lesson", "casebook", "infographic_transcript", "handbook", "reading", "assignment", "quiz", "spreadsheet", "other"]
UNIT_KINDS = [
    (r"podcast.*transcript", "podcast_transcript"),
    (r"(infographic|flowchart).*transcript", "infographic_transcript"),
    (r"transcript", "video_transcript"),
    (r"handbook", "handbook"),
    (r"casebook", "casebook"),
    (r"\bnotes\b", "notes"),
    (r"\blesson\b", "lesson"),
    (r"assignment", "assignment"),
    (r"\bquiz\b|\bassessment\b", "quiz"),
    (r"resource list|glossary|navigation guide|reading", "reading"),
    (r"\.xlsx?$", "spreadsheet"),
]
BILINGUAL_KINDS = [
    (r"transcript|транскрипт", "video_transcript"),
    (r"syllabus|силабус|handbook", "handbook"),
    (r"notes|конспект", "notes"),
    (r"lecture|лекц", "lesson"),
    (r"case|кейс", "casebook"),
    (r"test|quiz|тест", "quiz"),
    (r"assignment|завдання", "assignment"),
    (r"\.xlsx?$", "spreadsheet"),
]
COURSE_TITLES = {
    "AGAI": "Applied Generative AI for Digital Transformation",
    "AI": "Artificial Intelligence: Implications for Business Strategy",
    "DBS": "Digital Business Strategy",
    "NUR": "Neuroscience for Business",
    "SMM": "Strategic Social Media Marketing",
}
COURSE_CODES = {"calculus": "CALC", "linear_algebra": "LINALG", "machine_learning": "ML", "probability_essentials": "PROB"}


def register(name: str) -> Callable[[Adapter], Adapter]:
    def add(f: Adapter) -> Adapter:
        _ADAPTERS[name] = f
        return f

    return add


def get_adapter(name: str) -> Adapter:
    if name not in _ADAPTERS:
        raise KeyError(f"unknown adapter {name!r}; known: {', '.join(sorted(_ADAPTERS))}")
    return _ADAPTERS[name]


def registered() -> list[str]:
    return sorted(_ADAPTERS)


#: File names with one of the extensions, as stores match them.
ENDINGS = "*.{" + ",".join(v for e in EXTENSIONS for v in (e, e.upper(), e.capitalize())) + "}"


def _number(c: Column, pattern: str, group: int = 1) -> Column:
    return F.try_to_number(F.nullif(F.regexp_extract(c, pattern, group), F.lit("")), F.lit("999999999")).cast("int")


def _kind(name: Column, rules: list[tuple[str, str]]) -> Column:
    out = F.lit("reading")
    for pattern, kind in reversed(rules):
        out = F.when(name.rlike(pattern), kind).otherwise(out)
    return out


def _name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def _stem(path: Column) -> Column:
    return F.regexp_replace(_name(path), r"(?<=.)\.[^.]*$", "")


@register("mit")
def unit_coded(path: Column) -> dict[str, Column]:
    """Names with unit codes such as M2U3 or OMU1; else a module number in name or folder."""
    parts, stem, low = F.split(path, "/"), _stem(path), F.lower(_name(path))
    course = F.get(parts, F.lit(0))
    coded = r"(?i)\b(?:M\s?(\d+)|OM)\s?U\s?(\d+)\b"
    has_unit, alone = stem.rlike(coded), _number(stem, r"(?i)\bModule\s+(\d+)\b")
    folder = F.when(F.size(parts) > 2, _number(F.get(parts, F.lit(1)), r"(\d+)$"))
    titles = F.create_map(*[F.lit(x) for kv in COURSE_TITLES.items() for x in kv])
    return {
        "course_code": course,
        "course_title": F.coalesce(F.element_at(titles, course), course),
        "module_ordinal": F.when(has_unit, F.coalesce(_number(stem, coded), F.lit(0))).otherwise(F.coalesce(alone, folder, F.lit(0))),
        "unit_ordinal": F.when(has_unit, _number(stem, coded, 2)).otherwise(0),
        "asset_kind": _kind(low, UNIT_KINDS),
        "asset_ordinal": F.coalesce(_number(stem, r"(?i)\bVideo\s+(\d+)\b"), _number(stem, r"(?i)\bPodcast\s+(\d+)\b")),
        "part_ordinal": _number(stem, r"(?i)\bPart\s+(\d+)\b"),
    }


@register("kse")
def bilingual(path: Column) -> dict[str, Column]:
    """English or Ukrainian words for module, unit and kind."""
    course = F.get(F.split(path, "/"), F.lit(0))
    return {
        "course_code": course,
        "course_title": course,
        "module_ordinal": F.coalesce(_number(path, r"(?iu)(?:module|модуль)[-_ ]?(\d+)"), F.lit(0)),
        "unit_ordinal": F.coalesce(_number(path, r"(?iu)(?:unit|lesson|тема|заняття)[-_ ]?(\d+)"), F.lit(0)),
        "asset_kind": _kind(F.lower(_name(path)), BILINGUAL_KINDS),
        "asset_ordinal": _number(_stem(path), r"(?iu)(?:lecture|video|part|частина)[-_ ]?(\d+)"),
        "part_ordinal": F.lit(None).cast("int"),
    }


@register("syllabus")
def flat_syllabus(path: Column) -> dict[str, Column]:
    """One syllabus per file: the code is looked up, else made of the name's capitals."""
    name = F.regexp_replace(_stem(path), r"(?i)^syllabus[_-]?", "")
    key = F.regexp_replace(F.regexp_replace(F.lower(name), "[^a-z]+", "_"), "^_+|_+$", "")
    codes = F.create_map(*[F.lit(x) for kv in COURSE_CODES.items() for x in kv])
    made = F.nullif(F.substring(F.regexp_replace(F.upper(name), "[^A-Z]", ""), 1, 8), F.lit(""))
    code = F.coalesce(F.element_at(codes, key), made, F.upper(key))
    return {
        "course_code": code,
        "course_title": F.coalesce(F.nullif(F.trim(F.replace(name, F.lit("_"), F.lit(" "))), F.lit("")), code),
        "module_ordinal": F.lit(0),
        "unit_ordinal": F.lit(0),
        "asset_kind": F.lit("handbook"),
        "asset_ordinal": F.lit(None).cast("int"),
        "part_ordinal": F.lit(None).cast("int"),
    }


def manifest(files: DataFrame, adapter: str) -> DataFrame:
    """The manifest of ``files(rel_path, content | sha256, bytes)``: parsed, coded, in order.

    Dot files, ignored folders and other extensions are left out; unknown kinds are "other".
    """
    path = F.col("rel_path")
    seen = files.where(F.lower(path).rlike(r"\.(" + "|".join(EXTENSIONS) + ")$") & ~path.rlike(r"(^|/)[.]") & ~F.exists(F.slice(F.split(path, "/"), 1, F.greatest(F.size(F.split(path, "/")) - 1, F.lit(1))), lambda p: p.isin(IGNORED) | (p.startswith("_") & (p != _name(path)))))
    out = seen.withColumns(get_adapter(adapter)(path)).withColumn("filename", _name(path))
    out = out.withColumn("asset_kind", F.when(F.col("asset_kind").isin(ASSET_KINDS), F.col("asset_kind")).otherwise("other"))
    module = F.when(F.col("module_ordinal") == 0, "OM").otherwise(F.concat(F.lit("M"), F.col("module_ordinal")))
    out = out.withColumn("module_code", module).withColumn("unit_code", F.concat("module_code", F.lit("U"), "unit_ordinal"))
    out = out.withColumn("unit_id", F.concat("course_code", F.lit("-"), "unit_code"))
    return out.orderBy("course_code", F.coalesce("module_ordinal", F.lit(0)), F.coalesce("unit_ordinal", F.lit(0)), F.coalesce("asset_ordinal", F.lit(0)), F.coalesce("part_ordinal", F.lit(0)), "filename", "rel_path")


def relative(path: Column, root: str) -> Column:
    """The part of ``path`` below ``root``, whatever scheme either is written with."""
    bare = lambda c: F.regexp_replace(c, r"^\w+:/*", "/")
    return F.substring(bare(path), F.length(bare(F.lit(root.rstrip("/") + "/"))) + 1, F.length(path))


def scan(spark: SparkSession, root: str, adapter: str) -> DataFrame:
    """Read a folder of files on any store that Spark reads, with hash and size, into a manifest."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", ENDINGS).load(root)
    return manifest(raw.select(relative(F.col("path"), root).alias("rel_path"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes")), adapter)
