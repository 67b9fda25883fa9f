"""Document fingerprints from closed syncmers, in DataFrame functions only.

A text is a sequence of units: words, and single characters where a script has no spaces or
a word is very long. A k-mer is K units; its inner substrings are its single units. It is
chosen as an anchor when the unit with the smallest hash is its first or its last, which
depends on the k-mer alone: the same passage gives the same anchors wherever it stands. Two
anchors that follow each other, with the distance between them, are a link. The fingerprint
is the whole sequence of links, so anchors are matched by what they are and by their relative
positions: a passage matches only where its anchors stand in the same order and as far apart.
Likeness is the share of links that two texts have in common.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenpath.session import checkpoint

K, LONG = 5, 40
# Ranges of scripts written without spaces (South-East Asian, East Asian, and the planes of rarer ideographs).
UNSPACED = r"\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u2E80-\uA4CF\uF900-\uFAFF\x{20000}-\x{3FFFF}"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once for ``use``, so that lambdas inside do not compute it again for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def units(text: Column) -> Column:
    """Words by white space; characters of scripts without spaces, and what follows the first LONG characters of a word, one by one."""
    cut = F.when(text.rlike(f"[{UNSPACED}]|\\S{{{LONG + 1}}}"), F.split(text, f"\\s+|(?<=[{UNSPACED}])|(?<=\\S{{{LONG}}})")).otherwise(F.split(text, r"\s+"))
    return F.array_remove(cut, "")


def unit_hashes(text: Column) -> Column:
    return F.transform(units(text), lambda w: F.xxhash64(w))


def _anchor(h: Column, x: Column, i: Column) -> Column:
    """The 32-bit hash of the k-mer at i if it is a closed syncmer, else null. Reads past the end are null and fail the test."""
    rest = [F.get(h, i + j) for j in range(1, K)]
    chosen = (F.least(*rest) >= x) | (F.least(x, *rest[:-1]) >= rest[-1])
    return F.when(rest[-1].isNotNull() & chosen, F.shiftright(F.xxhash64(x, *rest), 32).cast("int"))


def _anchors(h: Column) -> Column:
    placed = F.transform(h, lambda x, i: F.struct(i.alias("pos"), _anchor(h, x, i).alias("hash")))
    return F.filter(placed, lambda a: a["hash"].isNotNull())


def anchors(text: Column) -> Column:
    """Array of (position in units, hash) of the closed syncmers of a text, in order."""
    return let(unit_hashes(text), _anchors)


def links(text: Column) -> Column:
    """32-bit hashes of each anchor with the one before it and the distance between them, in the order of the text.

    A text without an anchor has the hash of its whole sequence of units; one without units, none.
    """

    def pair(a: Column, x: Column, i: Column) -> Column:
        before = F.get(a, i - 1)
        return F.shiftright(F.xxhash64(x["hash"], before["hash"], x["pos"] - before["pos"]), 32).cast("int")

    def of(h: Column) -> Column:
        whole = F.array(F.shiftright(F.xxhash64(h), 32).cast("int"))
        found = let(_anchors(h), lambda a: F.transform(a, lambda x, i: pair(a, x, i)))
        return F.when(F.size(h) == 0, F.array().cast("array<int>")).otherwise(let(found, lambda f: F.when(F.size(f) == 0, whole).otherwise(f)))

    return let(unit_hashes(text), of)


def fingerprint(found: Column) -> Column:
    """The links as text: 8 hexadecimal digits each, in the order of the text."""
    return F.array_join(F.transform(found, lambda x: F.lower(F.lpad(F.hex(x.cast("long") + F.lit(1 << 31)), 8, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of distinct links in common; two texts without links are alike, one without is unlike any other."""
    both = F.size(F.array_intersect(a, b))
    every = F.size(F.array_distinct(a)) + F.size(F.array_distinct(b)) - both
    return F.when(every == 0, F.lit(1.0)).otherwise(both / every)


def successors(ids: DataFrame) -> DataFrame:
    """``cur, take, nxt`` for distinct rows ``(key struct<doc_id, th>, n_chars)``.

    ``nxt`` is the next key by descending id (ties: ascending text hash; null ids last); the
    first follows the last. Only keys move. The order is global: a range-partitioned sort,
    numbered inside partitions and shifted by the partitions' sizes, so no task sees all rows.
    """
    placed = checkpoint(ids.orderBy(F.col("key.doc_id").desc_nulls_last(), F.col("key.th")).withColumn("at", F.monotonically_increasing_id()))
    part, inside = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    # One row per partition: the only place where a window has no partitions.
    bases = sizes.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"), F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"))
    ranked = placed.withColumn("part", part).join(F.broadcast(bases), "part").select("key", "n_chars", (F.col("base") + inside).alias("rank"), "total")
    cur = ranked.select(F.col("key").alias("cur"), F.floor(F.col("n_chars") / 2).cast("int").alias("take"), F.pmod(F.col("rank") + 1, F.col("total")).alias("next_rank"))
    nxt = ranked.select(F.col("key").alias("nxt"), "rank")
    return cur.join(nxt, cur.next_rank == nxt.rank).select("cur", "take", "nxt")


def fingerprint_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint every whole text, its edited text and the likeness to that and to the next document.

    The edited text has the last floor(n_chars/2) code points replaced by the first as many
    (or all) of the next document by descending id; the last is followed by the first, and a
    single document by itself. Null texts are empty. Rows that repeat both id and text count
    as one in that order and each get its result; rows that repeat an id alone are ordered by
    a hash of the text. An empty table stays empty; extra columns are ignored.

    Texts are shuffled once by key and once more as prefixes only as long as the edit needs.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    key = F.struct(F.col("doc_id"), F.xxhash64("text").alias("th"))
    ids = rows.select(key.alias("key"), F.char_length("text").alias("n_chars")).distinct()
    order = checkpoint(successors(ids))
    base = rows.select(key.alias("key"), "text", links(F.col("text")).alias("own"))
    sent = base.join(order, base.key == order.nxt).select("cur", F.substring(F.col("text"), F.lit(1), F.col("take")).alias("head"), F.col("own").alias("next_own"))
    sent = sent.dropDuplicates(["cur"])
    n = F.char_length("text")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - F.floor(n / 2).cast("int")), F.col("head"))
    joined = base.join(sent, base.key == sent.cur).select("key", n.cast("long").alias("n_chars"), "own", "next_own", edited.alias("edited"))
    scored = joined.select("key", "n_chars", "own", "next_own", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"), links(F.col("edited")).alias("edited_own"))
    return scored.select(
        F.col("key.doc_id").alias("doc_id"),
        "n_chars",
        "edited_sha256",
        fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("edited_own")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited_own")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_own")).alias("near_next"),
    )
