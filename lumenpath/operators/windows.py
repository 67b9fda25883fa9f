"""Window-like operators: carry-forward, sessions, sequences, slices and balanced batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenpath.session import checkpoint


def carry_forward(df: DataFrame, key: str, order: str, value: Column, out: str) -> DataFrame:
    """The last non-null value up to each row."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.last(value, ignorenulls=True).over(w))


def session_ids(df: DataFrame, key: str, order: str, opens: Column, out: str) -> DataFrame:
    """How many rows up to each one open a session; 0 before the first."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.sum(F.when(opens, 1).otherwise(0)).over(w))


def sequence_links(df: DataFrame, key: str, order: list[str], item: str) -> DataFrame:
    """``src, dst, n`` counts of consecutive different items."""
    w = Window.partitionBy(key).orderBy(*order)
    steps = df.select(F.lag(item).over(w).alias("src"), F.col(item).alias("dst"))
    return steps.where("src is not null and src <> dst").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def slice_rows(df: DataFrame, key: str, order: list[str], size: int, out: str = "slice") -> DataFrame:
    """Number slices of ``size`` consecutive rows within each key, from 0."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn(out, F.floor((F.row_number().over(w) - 1) / size).cast("int"))


def running_sums(df: DataFrame, order: list[Column], value: str, out: str) -> DataFrame:
    """``df`` with the sum of ``value`` (long) over all rows before each one in ``order``, which must leave no ties.

    A range sort, then sums inside its partitions, then one row a partition to carry over; no
    task sees more than a partition.
    """
    placed = checkpoint(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_id", 33)))
    inside = F.sum(value).over(Window.partitionBy("_part").orderBy("_id").rowsBetween(Window.unboundedPreceding, 0)) - F.col(value)
    carried = F.coalesce(F.sum("_sum").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # One row a partition of the sort.
    before = placed.groupBy("_part").agg(F.sum(value).alias("_sum")).select("_part", carried.alias("_carried"))
    return placed.withColumn(out, inside).join(F.broadcast(before), "_part").withColumn(out, F.col(out) + F.col("_carried")).drop("_id", "_part", "_carried")


def balanced_batches(units: DataFrame, unit: str, chars: str, target: int) -> DataFrame:
    """``unit, batch``: units in a row, largest first (ties by name), cut where each batch's equal share of the characters ends.

    There are n = total // max(1, target) + 1 shares of ceil(total / n) characters, at most
    ``target``; a unit belongs to the share it begins in, so a batch exceeds a share by less
    than its last, smallest unit. A unit larger than a share leaves the numbers of those it
    covers unused. Null sizes count as 0; units without a character are in the last batch.
    The rule is the same at every size, unlike filling the emptiest batch, one unit after
    the other.
    """
    rows = units.select(F.col(unit).alias("unit"), F.coalesce(F.col(chars).cast("long"), F.lit(0)).alias("size"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    n = total // max(1, target) + 1
    share = max(1, -(-total // n))
    placed = running_sums(rows, [F.desc("size"), F.asc("unit")], "size", "before")
    return placed.select(F.col("unit").alias(unit), F.least(F.expr(f"before div {share}"), F.lit(n - 1)).cast("int").alias("batch"))


def bundle_text(files: DataFrame, unit: str, name: str, text: str, order: str) -> DataFrame:
    """``unit, n_files, chars, bundle``: one text per unit, a heading and a section per file in order. A bundle is one unit's value, so units must be of bounded size."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.concat(F.lit("### FILE: "), F.col(name), F.lit("\n"), F.col(text)).alias("t"))))
    g = files.groupBy(unit).agg(F.count(F.lit(1)).alias("n_files"), F.sum(F.length(text)).alias("chars"), parts.alias("p"))
    return g.select(unit, "n_files", "chars", F.concat(F.lit("# UNIT "), F.col(unit).cast("string"), F.lit("\n\n"), F.array_join(F.transform("p", lambda x: x["t"]), "\n\n")).alias("bundle"))
