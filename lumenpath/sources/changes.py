"""What changed below a folder since it was last read, without reading what did not."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenpath.session import broadcast_if_small
from lumenpath.sources.adapters import ENDINGS, manifest, relative

#: Up to so many files are opened by name; of more, all below the folder are read and joined.
FILES_BY_NAME = 10_000


def _files(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", ENDINGS).load(root)


def listing(spark: SparkSession, root: str) -> DataFrame:
    """``rel_path, path, bytes, modified`` of the files below ``root``; the store is asked, no file is opened."""
    return _files(spark, root).select(relative(F.col("path"), root).alias("rel_path"), "path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def contents(spark: SparkSession, root: str, wanted: DataFrame | None = None) -> DataFrame:
    """``path, content`` of the files ``wanted(path)``, or of all below ``root``."""
    if wanted is None:
        return _files(spark, root).select("path", "content")
    names = [r["path"] for r in wanted.select("path").limit(FILES_BY_NAME + 1).collect()]
    if len(names) > FILES_BY_NAME:
        return _files(spark, root).select("path", "content").join(broadcast_if_small(wanted.select("path"), 1_000_000), "path", "left_semi")
    if not names:
        return spark.createDataFrame([], "path string, content binary")
    # Signs of a pattern in a name stand for themselves.
    exact = ["".join("\\" + c if c in "{}[]*?\\" else c for c in name) for name in names]
    return spark.read.format("binaryFile").load(exact).select("path", "content")


def rescan(spark: SparkSession, root: str, adapter: str, old: DataFrame | None = None) -> DataFrame:
    """The manifest of ``root`` with ``path`` and ``modified``; files of the size and time they have in ``old`` keep the hash they have there."""
    now = manifest(listing(spark, root), adapter)
    if old is None:
        return now.join(contents(spark, root).select("path", F.sha2("content", 256).alias("sha256")), "path")
    known = now.join(old.select("rel_path", "bytes", "modified", "sha256"), ["rel_path", "bytes", "modified"], "left")
    fresh = contents(spark, root, known.where("sha256 is null")).select("path", F.sha2("content", 256).alias("new"))
    return known.join(fresh, "path", "left").withColumn("sha256", F.coalesce("sha256", "new")).drop("new")


def touched(old: DataFrame, new: DataFrame, key: str, content: list[str]) -> DataFrame:
    """The keys whose rows ``(key, *content)`` are not the same in both: added, changed or deleted."""
    a, b = (df.select(key, *content) for df in (old, new))
    return a.subtract(b).unionAll(b.subtract(a)).select(key).distinct()
