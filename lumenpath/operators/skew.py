"""Joins that keep a hot key from landing in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenpath.session import small_table

#: A key is hot if it has one row in HOT_SHARE, and so many at least; there are at most HOT_SHARE of them.
HOT_SHARE, HOT_ROWS = 1_000, 100


def hot_bound(rows: int) -> int:
    """From how many rows on a key of a table of ``rows`` is hot."""
    return max(HOT_ROWS, rows // HOT_SHARE)


def hot_keys(big: DataFrame, key: str) -> dict:
    """The keys that hold at least one row in HOT_SHARE of ``big``, each with into how many parts to deal its rows.

    There are at most HOT_SHARE of them, and about twice as many parts. Counting combines
    before it shuffles.
    """
    counts = big.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    bound = hot_bound(big.count())
    return {r[0]: -(-r["n"] // bound) for r in counts.where(F.col("n") >= bound).select(key, "n").collect()}


def lookup(big: DataFrame, small: DataFrame, key: str, how: str = "inner", hot: dict | None = None) -> DataFrame:
    """``big`` joined with ``small`` on ``key``, which is unique in ``small``.

    The rows of a hot key are dealt into parts by a hash of their other columns, and the one
    row of ``small`` that has the key is repeated for each part; so no task gets much more
    than one row in HOT_SHARE for a key, and what is repeated is at most about 2 * HOT_SHARE
    rows, shuffled and not broadcast. Null keys match nothing.
    """
    hot = hot_keys(big, key) if hot is None else hot
    if not hot:
        return big.join(small, key, how)
    kind = dict(big.dtypes)[key]
    dealt = F.broadcast(small_table(big.sparkSession, list(hot.items()), {key: kind, "dealt_parts": "int"}))
    others = [c for c in big.columns if c != key]
    part = F.pmod(F.xxhash64(*others) if others else F.monotonically_increasing_id(), F.coalesce("dealt_parts", F.lit(1)))
    left = big.join(dealt, key, "left").withColumn("dealt_part", part.cast("int")).drop("dealt_parts")
    copies = F.sequence(F.lit(0), F.coalesce("dealt_parts", F.lit(1)) - 1)
    right = small.join(dealt, key, "left").withColumn("dealt_part", F.explode(copies)).drop("dealt_parts")
    return left.join(right, [key, "dealt_part"], how).drop("dealt_part")
