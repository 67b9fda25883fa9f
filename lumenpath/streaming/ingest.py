"""Incremental intake: files that appear in a folder are parsed and extracted once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lumenpath.functions import text as T
from lumenpath.session import ship
from lumenpath.sources import adapters, documents

FILES = "path string, modificationTime timestamp, length long, content binary"


def ingest(spark: SparkSession, root: str, out: str, adapter: str, progress: str, min_chars: int = 1, files_per_batch: int = 1000) -> StreamingQuery:
    """Take in all files that are new since the last call, then stop; ``out`` gets the manifest with texts and status.

    ``progress`` is the stream's checkpoint folder, on a store that all executors share. A
    micro-batch overwrites its own partition ``batch``, so a batch that is repeated after a
    failure leaves its rows once.
    """
    ship(spark)
    raw = spark.readStream.format("binaryFile").schema(FILES).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_per_batch).load(root)

    def take(batch: DataFrame, number: int) -> None:
        rel = adapters.relative(F.col("path"), root).alias("rel_path")
        placed = adapters.manifest(batch.select(rel, F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes")), adapter)
        read = documents.extract(batch.select("path", "content"), min_chars).select(rel, T.clean(F.col("text"), True).alias("text"), "status", "error")
        placed.join(read, "rel_path").write.mode("overwrite").parquet(f"{out}/batch={number}")

    return raw.writeStream.foreachBatch(take).option("checkpointLocation", progress).trigger(availableNow=True).start()
