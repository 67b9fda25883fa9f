"""One document of each group of near copies: trie links between SimHashes, then a prefix-filter join of whole shingle sets.

Near copies are texts whose distinct word shingles have a Jaccard similarity of SIMILAR or
more. At 0.8 their 64-bit SimHashes differ in 9.7 bits on average, and a trie that lets so
many differ compares nearly everything with everything; so the trie self-join of
``simhash_trie`` finds the closest pairs, at RADIUS bits, and the rest comes from the sets.

All shingles are put in one order, rare ones first: by a count sketch of the corpus, then by
hash. The order need not be exact for the filter to hold, it only has to be the same
everywhere. Two sets of m and n shingles that are similar enough have at least
c = SIMILAR / (1 + SIMILAR) * (m + n) in common, so they share one among the first m - c + 1
and n - c + 1 of each: of equal sets the first ninth. Only the first fifth of a set are keys,
each with its place, and two texts meet by a key that lies that far in front in both. What many texts share (licences, quotes, templates) comes last in the order: texts with a
passage in common are not compared unless they are alike in nearly all the rest too.

Of the keys of sets of over SAMPLE shingles only those with a hash below SAMPLE / n are
taken, by the same rule everywhere, so a text has about SAMPLE / 4 keys at any length. For
that, sets that may meet such a set have EXTRA * n keys more, and then any pair shares so
many. A pair that shares no more than it must (one text inside another a quarter longer) is
missed once in 300,000, a pair of equal lengths once in 10**12. Below that nothing is missed.

Texts that share a key are first compared with one of them, so a large group of copies is
not paired within itself: with the one of which most keys are shared, which is the original
rather than one of its edited copies; further ROUNDS take any other. What is still in
different groups is compared pair by pair, leaving out pairs within the group that most of a
key's texts belong to. Every link is verified on whole shingle sets.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenpath.llm.common import map_texts, release, task_start, texts_of
from lumenpath.llm.shingles import shingle_runs, simhash
from lumenpath.llm.simhash_trie import trie_links
from lumenpath.llm.word_hash import mix
from lumenpath.operators.components import connected_components
from lumenpath.operators.skew import hot_bound, lookup
from lumenpath.session import broadcast_if_small, checkpoint, remove, settled, shared_dir

WORDS, SIMILAR, RADIUS = 5, 0.8, 2
#: Keys beyond the least that a filter needs, the shingles up to which all keys count, and rounds with one other text, as above.
EXTRA, SAMPLE, ROUNDS = 0.05, 320, 1
#: The count sketch has one counter for so many characters of text, within these bounds (4 MB at 20 bits, 64 MB at most).
SKETCH_CHARS, SKETCH_BITS = 1_000, (16, 24)
#: Parts in which the sketch is merged, and groups of tasks that are merged first.
PIECES, MERGE = 64, 256
#: Up to so many nodes with candidates (a few tens of MB) are broadcast to pick their texts.
NEED = 500_000
#: Pairs for each set in one join with whole sets.
PAIRS_A_SET = 2
#: Texts are hashed in batches of about so many characters.
PASS_CHARS = 400_000


def shingle_set(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes (int64) of the word shingles; a shorter text is one shingle, one without words has none."""
    return np.unique(shingle_runs([text], words)[0].view(np.int64))


def batches_of(column, most: int = PASS_CHARS):
    """(first, texts) of an Arrow column in parts of about ``most`` characters."""
    at = 0
    while at < len(column):
        part, size, end = [], 0, at
        while end < len(column) and size < most:
            part.append(column[end].as_py())
            size += len(part[-1])
            end += 1
        yield at, part
        at = end


def sketch_bits(chars: int) -> int:
    return min(max(math.ceil(math.log2(max(1, chars / SKETCH_CHARS))), SKETCH_BITS[0]), SKETCH_BITS[1])


def bucket(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)


def shingle_sketch(docs: DataFrame, words: int) -> np.ndarray:
    """Counters (uint32) by the first bits of a shingle's hash: in how many texts shingles of the bucket are, copies included.

    Every task adds up its own; counters are merged piece by piece, first within MERGE groups
    of tasks. The driver gets the finished counters, of bounded number.
    """
    rows = texts_of(docs).select("text")
    bits = sketch_bits(rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"])
    piece = (1 << bits) // PIECES

    def run(batches):
        task_start()
        own = np.zeros(1 << bits, dtype=np.uint32)
        for batch in batches:
            for _, texts in batches_of(batch.column(0)):
                found = np.concatenate([np.unique(r) for r in shingle_runs(texts, words)])
                own += np.bincount(bucket(found, bits), minlength=1 << bits).astype(np.uint32)
        release()
        packed = [zlib.compress(own[k * piece : (k + 1) * piece].tobytes(), 1) for k in range(PIECES)]
        group = TaskContext.get().partitionId() % MERGE
        yield pa.RecordBatch.from_pydict({"piece": pa.array(range(PIECES), pa.int32()), "part": pa.array([group] * PIECES, pa.int32()), "counts": pa.array(packed, pa.binary())})

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(piece, dtype=np.uint64)
        for packed in frame["counts"]:
            total += np.frombuffer(zlib.decompress(packed), dtype=np.uint32)
        merged = np.minimum(total, (1 << 32) - 1).astype(np.uint32)
        return pd.DataFrame({"piece": frame["piece"].iloc[:1], "part": [0], "counts": [zlib.compress(merged.tobytes(), 1)]})

    kind = "piece int, part int, counts binary"
    parts = rows.mapInArrow(run, kind).groupBy("piece", "part").applyInPandas(add, kind).groupBy("piece").applyInPandas(add, kind)
    out = np.zeros(1 << bits, dtype=np.uint32)
    for r in parts.collect():
        out[r["piece"] * piece : (r["piece"] + 1) * piece] = np.frombuffer(zlib.decompress(r["counts"]), dtype=np.uint32)
    return out


def extra_of(n: int, similar: float) -> int:
    """How many keys beyond the least a pair with a set of ``n`` shingles must share, and one."""
    return max(1, math.ceil(EXTRA * n)) if n > similar * SAMPLE else 1


def keys_of(shingles: np.ndarray, sketch: np.ndarray, similar: float = SIMILAR) -> tuple[np.ndarray, np.ndarray]:
    """(keys of a set of distinct shingle hashes, rare ones first; their places in the order)."""
    n = len(shingles)
    first = n - math.ceil(similar * n - 1e-9) + extra_of(n, similar)
    counts = sketch[bucket(shingles, len(sketch).bit_length() - 1)]
    keys = shingles[np.lexsort((shingles, counts))[:first]]
    if n <= SAMPLE:
        return keys, np.arange(len(keys))
    # The key's own hash decides, so two texts that share a key agree on it up to their lengths.
    places = np.flatnonzero(mix(keys.view(np.uint64)) < np.uint64(SAMPLE / n * 2.0**64))
    return keys[places], places


def described(docs: DataFrame, words: int, similar: float) -> DataFrame:
    """``key, node, fp, size, keys, places`` of every row: ``node`` tells the shingle set, ``fp`` is its SimHash; keys and their places once a task for each node."""
    sketch = docs.sparkSession.sparkContext.broadcast(shingle_sketch(docs, words))
    key = F.struct(F.col("doc_id"), F.xxhash64("text").alias("th"))

    def run(batches):
        task_start()
        counts, seen = sketch.value, set()
        for batch in batches:
            for at, texts in batches_of(batch.column(1)):
                nodes, fps, sizes, keys, places = [], [], [], [], []
                for found in shingle_runs(texts, words):
                    own = np.unique(found.view(np.int64))
                    node = xxhash.xxh64_intdigest(own.tobytes()) - (1 << 63)
                    nodes.append(node)
                    fps.append(simhash(found))
                    sizes.append(len(own))
                    some, at_place = (None, None) if node in seen else keys_of(own, counts, similar)
                    keys.append(some)
                    places.append(at_place)
                    seen.add(node)
                columns = {
                    "key": batch.column(0).slice(at, len(nodes)),
                    "node": pa.array(nodes, pa.int64()),
                    "fp": pa.array(np.array(fps, dtype=np.uint64).view(np.int64)),
                    "size": pa.array(sizes, pa.int64()),
                    "keys": pa.array(keys, pa.list_(pa.int64())),
                    "places": pa.array(places, pa.list_(pa.int32())),
                }
                yield pa.RecordBatch.from_pydict(columns)
        release()

    rows = texts_of(docs).select(key.alias("key"), "text")
    return rows.mapInArrow(run, "key struct<doc_id: bigint, th: bigint>, node long, fp long, size long, keys array<long>, places array<int>")


def sized(a: str, b: str, similar: float):
    """Sets whose sizes differ too much cannot be similar enough."""
    return F.least(a, b) >= F.greatest(a, b) * similar - 1e-9


def likely(pairs: DataFrame, nodes: DataFrame, similar: float) -> DataFrame:
    """The ``pairs`` whose keys do not rule out that the sets are similar enough.

    Of the two sets' last keys one comes first in the order; all that the other set has in
    common with that set's keys are keys of both. What is not among the keys is at most the
    rest of a set, so so many keys must be shared as are left of the least in common. Sets
    of which only a sample are keys pass.
    """
    side = lambda name, n: nodes.select(F.col("node").alias(name), F.col("size").alias(f"{n}_size"), F.col("keys").alias(n))
    both = lookup(lookup(pairs, side("src", "a"), "src").withColumnRenamed("src", "head"), side("dst", "b"), "dst", hot={})
    least = F.ceil(similar / (1 + similar) * (F.col("a_size") + F.col("b_size")) - 1e-9)
    rest = F.greatest(F.col("a_size") - F.size("a"), F.col("b_size") - F.size("b"))
    sampled = F.greatest("a_size", "b_size") > SAMPLE
    return both.where(sized("a_size", "b_size", similar) & (sampled | (F.size(F.array_intersect("a", "b")) >= least - rest))).select(F.col("head").alias("src"), "dst")


def whole_sets(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """``node, grams`` of the nodes in ``pairs``: their texts are hashed again."""
    need = checkpoint(pairs.select(F.col("src").alias("node")).unionAll(pairs.select("dst")).distinct())
    keys = nodes.join(broadcast_if_small(need, NEED), "node", "left_semi").select("node", F.col("key").alias("need_key"))
    rows = texts_of(docs).withColumn("key", F.struct(F.col("doc_id"), F.xxhash64("text").alias("th")))
    picked = rows.join(broadcast_if_small(checkpoint(keys), NEED), F.col("key") == F.col("need_key")).select(F.col("node").alias("doc_id"), "text")
    sets = map_texts(picked, "doc_id long, grams array<long>", [("grams", pa.list_(pa.int64()))], lambda texts: [[np.unique(r.view(np.int64)) for r in shingle_runs(texts, words)]], pass_chars=PASS_CHARS)
    return sets.groupBy(F.col("doc_id").alias("node")).agg(F.any_value("grams").alias("grams"))


def alike(pairs: DataFrame, sets: DataFrame, similar: float) -> DataFrame:
    """The ``pairs`` whose whole ``sets(node, grams)`` are similar enough."""
    # Stars have few nodes at one end: a side of the join moves the sets of its own end only.
    end = lambda name: sets.join(pairs.select(F.col(name).alias("node")).distinct(), "node", "left_semi")
    side = lambda name, grams: end(name).select(F.col("node").alias(name), F.col("grams").alias(grams))
    both = lookup(lookup(pairs, side("src", "a"), "src").withColumnRenamed("src", "head"), side("dst", "b"), "dst", hot={})
    common = F.size(F.array_intersect("a", "b"))
    return both.where(common >= (F.size("a") + F.size("b") - common) * similar - 1e-9).select(F.col("head").alias("src"), "dst")


def in_parts(pairs: DataFrame, held: int, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``work`` of all ``pairs``, in parts of about PAIRS_A_SET pairs for each of the ``held`` sets that they are joined with.

    Pairs can grow faster than the texts do. A join repeats a set for each pair of it, and
    only one part's sets are on disk at a time.
    """
    parts = max(1, math.ceil(pairs.count() / (PAIRS_A_SET * max(1, held))))
    part = F.pmod(F.xxhash64("src", "dst"), F.lit(parts))
    done = [settled(work(pairs.where(part == k))) for k in range(parts)]
    return reduce(DataFrame.unionAll, done)


def verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, words: int, similar: float) -> DataFrame:
    """The ``pairs`` (``src, dst``) whose shingle sets are similar enough. Only texts of nodes with candidates are hashed again."""
    near = in_parts(pairs, nodes.count(), lambda part: likely(part, nodes, similar))
    sets = settled(whole_sets(near, nodes, docs, words))
    return in_parts(near, sets.count(), lambda part: alike(part, sets, similar))


def placed(rows: DataFrame, links: DataFrame) -> DataFrame:
    """``rows`` with ``part``, the component of their node over ``links``."""
    parts = connected_components(links).withColumnRenamed("component", "found")
    return rows.join(parts, "node", "left").withColumn("part", F.coalesce("found", "node")).drop("found")


def simhash_pairs(nodes: DataFrame, radius: int) -> DataFrame:
    """Node pairs from the trie self-join: the least node of each fingerprint stands for it and is paired with its others."""
    prints = checkpoint(nodes.groupBy("fp").agg(F.min("node").alias("head"), F.max("node").alias("last")))
    linked = trie_links(prints.select("fp"), radius)
    head = lambda name: prints.select(F.col("fp").alias(name), F.col("head").alias(f"{name}_head"))
    between = linked.join(head("src"), "src").join(head("dst"), "dst").select(F.col("src_head").alias("src"), F.col("dst_head").alias("dst"))
    shared = lookup(nodes.select("node", "fp"), prints.where("head <> last").select("fp", "head"), "fp")
    return between.unionAll(shared.where("node <> head").select(F.col("head").alias("src"), F.col("node").alias("dst")))


def each_key(rows: DataFrame) -> DataFrame:
    """A row for each key, with its place."""
    own = [c for c in rows.columns if c != "keys"]
    return rows.select(*own, F.explode("keys").alias("k")).select(*own, "k.key", "k.place")


def shared_keys(nodes: DataFrame) -> tuple[DataFrame, dict]:
    """(``node, size, share, keys`` with the keys that another node has too and their share among all keys, the hot ones of these keys)."""
    both = F.transform("keys", lambda k, i: F.struct(k.alias("key"), F.get("places", i).alias("place")))
    # Most keys are one node's only: what is shuffled of them holds no more than the key, its node and its place.
    flat = each_key(nodes.select("node", both.alias("keys")))
    many = settled(flat.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count(F.lit(1)).alias("n")).where("low <> high").select("key", "n"))
    bound = hot_bound(many.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"])
    hot = {r["key"]: -(-r["n"] // bound) for r in many.where(F.col("n") >= bound).collect()}
    rows = lookup(flat, many.select("key"), "key", hot=hot).groupBy("node").agg(F.collect_list(F.struct("key", "place")).alias("keys"))
    made = rows.join(nodes.select("node", "size", F.size("keys").alias("all")), "node").select("node", "size", (F.size("keys") / F.col("all")).alias("share"), "keys")
    return settled(made), hot


def stars(rows: DataFrame, hot: dict, turn: int, similar: float) -> DataFrame:
    """Pairs of each node of ``rows(node, size, share, part, keys)`` with one other: of the first nodes of its keys, in another part, the one of most keys.

    The first node of a key is the one with the largest ``share``, in later turns that with the
    least hash, so it is the same one for most keys of a group.
    """
    flat = each_key(rows)
    at = F.struct(-F.col("share") if turn == 0 else F.lit(0.0), F.xxhash64("node", F.lit(turn)))
    hub = F.min(F.struct(at.alias("at"), "node", "size", "part")).alias("hub")
    mixed = flat.groupBy("key").agg(hub, F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high").select("key", "hub")
    met = lookup(flat, mixed, "key", hot=hot).where((F.col("part") != F.col("hub.part")) & sized("size", "hub.size", similar))
    counted = met.groupBy("node", F.col("hub.node").alias("other")).agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("node").agg(F.max_by("other", F.struct("n", "other")).alias("src")).select("src", F.col("node").alias("dst"))


def in_front(m: str, i: str, n: str, j: str, similar: float):
    """Whether the places ``i`` and ``j`` of a key in sets of ``m`` and ``n`` shingles lie where a pair that is similar enough shares keys."""
    extra = lambda size: F.when(F.col(size) > similar * SAMPLE, F.greatest(F.lit(1), F.ceil(EXTRA * F.col(size)))).otherwise(1)
    least = F.ceil(similar / (1 + similar) * (F.col(m) + F.col(n)) - 1e-9)
    room = F.least(extra(m), extra(n)) - least
    return (F.col(i) < F.col(m) + room) & (F.col(j) < F.col(n) + room)


def rest_pairs(rows: DataFrame, similar: float) -> DataFrame:
    """Pairs of nodes of ``rows(node, size, part, keys)`` in different parts that share a key which lies in front in both sets.

    In every pair one node is not of the part that most nodes of the key belong to; these are few and are met with all.
    """
    flat = each_key(rows.select("node", "size", "part", "keys"))
    main = flat.groupBy("key", "part").agg(F.count(F.lit(1)).alias("n")).groupBy("key").agg(F.max_by("part", F.struct("n", "part")).alias("main"), F.count(F.lit(1)).alias("parts")).where("parts > 1").select("key", "main")
    few = lookup(flat, main, "key").where("part <> main").select("key", *[F.col(c).alias(f"x_{c}") for c in ("node", "size", "part", "place")])
    met = few.join(flat, "key").where((F.col("x_part") != F.col("part")) & sized("x_size", "size", similar) & in_front("x_size", "x_place", "size", "place", similar))
    return met.select(F.least("x_node", "node").alias("src"), F.greatest("x_node", "node").alias("dst")).distinct()


def links(nodes: DataFrame, docs: DataFrame, words: int, similar: float) -> DataFrame:
    """``src, dst`` nodes: verified links that connect what all pairs of at least ``similar`` connect.

    Candidates are a checkpoint before they are looked at: their plans are long, and finding the
    hot keys of a lookup alone would run them twice. No variable holds a plan that has run, or
    its shuffle files stay.
    """
    full = nodes.where("size > 0")
    rows, hot = shared_keys(full)
    # At first every node is a part of its own.
    pairs = settled(simhash_pairs(full, RADIUS).unionAll(stars(rows.withColumn("part", F.col("node")), hot, 0, similar)).distinct())
    found = None
    for turn in range(1, ROUNDS + 1):
        near = verified(pairs, nodes, docs, words, similar)
        found = near if found is None else checkpoint(found.unionAll(near))
        apart = settled(placed(rows, found))
        pairs = settled(stars(apart, hot, turn, similar) if turn < ROUNDS else rest_pairs(apart, similar))
    del rows, apart
    return found.unionAll(verified(pairs, nodes, docs, words, similar))


def first_keys(docs: DataFrame, words: int, similar: float) -> DataFrame:
    """``near_copy_key`` of the first document of each group of near copies."""
    folder = f"{shared_dir(docs.sparkSession)}/near-copies-{uuid.uuid4().hex}"
    # A written table and no checkpoint, which would hash all texts twice.
    described(docs, words, similar).write.parquet(folder)
    nodes = settled(told_apart(docs.sparkSession.read.parquet(folder)))
    remove(docs.sparkSession, folder)
    groups = placed(nodes.select("node", "best"), links(nodes, docs, words, similar)).groupBy("part").agg(F.min("best").alias("best"))
    return groups.select(F.col("best.key").alias("near_copy_key"))


def told_apart(rows: DataFrame) -> DataFrame:
    """``node, best, key, fp, size, keys, places`` of each node of ``described`` rows; ``best`` sorts first."""
    best = F.struct(F.col("key.doc_id").isNull().alias("none"), F.col("key").alias("key"))
    facts = rows.groupBy("node").agg(F.min(best).alias("best"), F.min("fp").alias("fp"), F.max("size").alias("size"))
    keys = rows.where("keys is not null").groupBy("node").agg(F.any_value(F.struct("keys", "places")).alias("own"))
    return facts.join(keys, "node").select("node", "best", F.col("best.key").alias("key"), "fp", "size", "own.keys", "own.places")


def keep_first(docs: DataFrame, words: int = WORDS, similar: float = SIMILAR) -> DataFrame:
    """``docs`` with one document of each group of near copies: the one with the smallest id (nulls last).

    Documents are linked if the Jaccard similarity of their distinct shingles is at least
    ``similar``; groups are what links connect. Texts with equal shingles are one node, told
    by a 64-bit hash; null and empty texts are one node too. Rows are told apart by id and a
    hash of the text: rows that share an id but not the text are judged each by its own text,
    and of rows that repeat both one stays. Very long texts are hashed in pieces. An empty
    table stays empty; all columns are kept.
    """
    # Only the last join moves texts; all that found the keys has gone from the disk by then.
    kept = settled(first_keys(docs, words, similar))
    # The type is that of ``kept``, nulls allowed: a key that is cast for the join has the texts shuffled once more.
    key = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("th")).cast(kept.schema["near_copy_key"].dataType)
    marked = docs.withColumn("near_copy_key", key).dropDuplicates(["near_copy_key"])
    return marked.join(kept, "near_copy_key", "left_semi").drop("near_copy_key")
