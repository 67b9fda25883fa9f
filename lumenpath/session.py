"""Session helpers shared by every module: table access, checkpointing and size-checked broadcasts."""

from __future__ import annotations

import gc
import os
import tempfile
import time
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Seconds after which the gateway's clean-up, which looks once a second, has told the JVM what Python let go.
GATEWAY_S = 1.2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as named by ``spark.checkpoint.dir``.

    Only where that setting is absent on one machine (tests) a temporary folder is set
    instead; on a cluster its absence is an error, since other executors would not see it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if named is None:
        current = sc._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return current.get()
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="lumenpath-")
        sc.setCheckpointDir(named)
    elif not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(named)
    return named


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder of the shared store, if it is there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def sweep(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files and checkpoints that nothing refers to any more: it does so when the driver collects its garbage."""
    gc.collect()
    # The gateway tells the JVM once a second what Python has let go; before that nothing is garbage there.
    time.sleep(GATEWAY_S)
    spark._jvm.System.gc()


def settled(df: DataFrame) -> DataFrame:
    """A checkpoint of ``df`` once the shuffle files that only made it are let go, so that those of several steps do not lie on disk together."""
    out = checkpoint(df)
    del df
    sweep(out.sparkSession)
    return out


def trim_executors(spark: SparkSession) -> None:
    """Let the executors collect their garbage, once for each core: a heap that an earlier stage has stretched goes back to the system, and Python workers have the room."""
    cores = spark.sparkContext.defaultParallelism
    spark.range(0, cores, 1, cores).select(F.java_method(F.lit("java.lang.System"), F.lit("gc"))).collect()


#: Kinds of columns that ``small_table`` gives to Spark as Arrow.
ARROW_KINDS = {"bigint": pa.int64(), "long": pa.int64(), "int": pa.int32(), "string": pa.string()}


def small_table(spark: SparkSession, rows: list[tuple], columns: dict[str, str]) -> DataFrame:
    """A few ``rows`` of the driver as a table of ``columns`` (name: kind).

    They are given as Arrow where their kinds allow it: a list of rows is turned into a table by
    Python workers of a kind of its own, and these lie on every executor beside the others.
    """
    schema = ", ".join(f"`{name}` {kind}" for name, kind in columns.items())
    if not set(columns.values()) <= ARROW_KINDS.keys():
        return spark.createDataFrame(rows, schema)
    arrays = [pa.array(values, ARROW_KINDS[kind]) for values, kind in zip(zip(*rows), columns.values())]
    return spark.createDataFrame(pa.table(arrays, names=list(columns)), schema)


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast only if ``df``, of narrow rows, has at most ``max_rows`` of them; beyond that Spark picks a shuffle join."""
    n = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n")).first()["n"]
    return F.broadcast(df) if n <= max_rows else df


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers of all executors, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="lumenpath-"), "lumenpath.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(here):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(here)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)
