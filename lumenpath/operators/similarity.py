"""Evidence checks and blocked similarity joins."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenpath.functions import text as T
from lumenpath.session import broadcast_if_small, checkpoint, ship

ANCHOR, GRAM = 3, 4
#: Up to so many quotes are looked up in every text at once; more are joined by key.
MOST_KEYS = 20_000
# Cutoffs, and the most concepts that a shared word or domain may have.
MOST_BY_WORD, MOST_BY_DOMAIN = 60, 80
NAME_CUTOFF, TRIGRAM_CUTOFF = 0.86, 0.62
#: The number of each letter of a name key.
GRAM_LETTERS = np.zeros(256, dtype=np.int64)
GRAM_LETTERS[np.frombuffer(b"0123456789abcdefghijklmnopqrstuvwxyz", dtype=np.uint8)] = np.arange(1, 37)
#: Trigrams that are compared first, sets of a matrix, and pairs that are counted at once.
HEAD, BLOCK, PAIRS = 768, 1_024, 16_384
#: A run of sets is one in RUN_SHARE of all, within these bounds; up to so many narrow rows of the plan of runs are broadcast.
RUN_SHARE, RUNS, MEETINGS = 64, (1_024, 32_768), 200_000


def verbatim_pairs(docs: DataFrame, quotes: DataFrame, doc_id: str, doc_text: str, quote_id: str, quote_text: str, max_broadcast: int = 64 << 20) -> DataFrame:
    """Pairs whose folded quote stands in the folded text.

    A quote can begin and end inside a word, so its inner words stand whole in the text: the
    first ANCHOR inner words (or the one, of a quote of three or four words) are an equi-join
    key that finds candidates, and ``contains`` verifies them. Quotes of one or two words have
    a key of their first GRAM characters instead, looked up among the text's runs of so many.
    Only quotes shorter still are compared with every text. Quotes that fold to nothing match
    nothing. Quotes are broadcast only
    up to MOST_KEYS of them and ``max_broadcast`` bytes.
    """
    d = docs.select(F.col(doc_id).alias("did"), T.fold(F.col(doc_text)).alias("body"))
    q = checkpoint(quotes.select(F.col(quote_id).alias("qid"), T.fold(F.col(quote_text)).alias("quote")).where("quote <> ''"))
    qw = F.split("quote", " ")
    size, word = F.size(qw), lambda i: F.get(qw, F.lit(i))
    triple, single, gram = F.xxhash64(*[word(i) for i in range(1, ANCHOR + 1)]), F.xxhash64(F.lit("word"), word(1)), F.xxhash64(F.lit("gram"), F.substring("quote", 1, GRAM))
    kind = F.when(size >= ANCHOR + 2, triple).when(size >= 3, single).when(F.length("quote") >= GRAM, gram)
    keyed = checkpoint(q.select("qid", "quote", kind.alias("key"), F.when(size >= ANCHOR + 2, 3).when(size >= 3, 2).when(F.length("quote") >= GRAM, 1).otherwise(0).alias("way")))
    ways = {r["way"] for r in keyed.select("way").distinct().collect()}
    words = F.split("body", " ")
    keys = []
    if 3 in ways:
        keys.append(F.get(F.transform(F.array(words), lambda w: F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))), F.lit(0)))
    if 2 in ways:
        keys.append(F.transform(words, lambda x: F.xxhash64(F.lit("word"), x)))
    if 1 in ways:
        keys.append(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length("body") - GRAM + 1)), lambda i: F.xxhash64(F.lit("gram"), F.substring("body", i, F.lit(GRAM)))))
    out = []
    if keys:
        known = keyed.where("way > 0")
        said = known.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("quote") + 32), F.lit(0)).alias("size")).first()
        if said["n"] <= MOST_KEYS and said["size"] <= max_broadcast:
            # The quotes come to the text, which is folded once and verified where it lies.
            every = known.agg(F.collect_set("key").alias("every"))
            hits = d.join(F.broadcast(every)).select("did", "body", F.explode(F.array_intersect(F.concat(*keys), "every")).alias("key"))
            out.append(hits.join(F.broadcast(known), "key").where(F.contains("body", "quote")).select("did", "qid").distinct())
        else:
            spots = d.select("did", F.explode(F.array_distinct(F.concat(*keys))).alias("key"))
            cand = spots.join(known.select("qid", "key"), "key").select("did", "qid").distinct()
            out.append(cand.join(d, "did").join(known.select("qid", "quote"), "qid").where(F.contains("body", "quote")).select("did", "qid").distinct())
    if 0 in ways:
        # Fewer characters than GRAM: at most 37 ** GRAM different quotes, whatever their rows.
        tiny = keyed.where("way = 0")
        hits = d.join(F.broadcast(tiny.select("quote").distinct()), F.contains("body", "quote")).select("did", "quote")
        out.append(hits.join(tiny.select("qid", "quote"), "quote").select("did", "qid").distinct())
    found = out[0] if out else d.join(q, F.lit(False)).select("did", "qid")
    for more in out[1:]:
        found = found.unionAll(more)
    return found.select(F.col("did").alias(doc_id), F.col("qid").alias(quote_id))


def gram_codes(keys: list[str]) -> list[np.ndarray]:
    """The distinct trigrams of each name key (0-9a-z words, single spaces), padded by two spaces on each side, as sorted numbers below 37 ** 3; none for an empty key."""
    out = []
    for key in keys:
        c = GRAM_LETTERS[np.frombuffer(f"  {key}  ".encode(), dtype=np.uint8)]
        out.append(np.unique(c[:-2] * 37**2 + c[1:-1] * 37 + c[2:]).astype(np.uint16) if key else np.zeros(0, dtype=np.uint16))
    return out


def packed(codes: np.ndarray) -> bytes:
    """A sorted set of numbers as bytes, equal for equal sets: compressed differences, low bytes first."""
    return zlib.compress(np.diff(codes, prepend=np.uint16(0)).astype("<u2").view(np.uint8).reshape(-1, 2).T.tobytes(), 1)


def unpacked(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(raw), dtype=np.uint8).reshape(2, -1).T.copy().view("<u2")[:, 0], dtype=np.uint16)


def near_sets(left: list[np.ndarray], right: list[np.ndarray] | None, cutoff: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(positions in ``left``, positions in ``right``, Jaccard similarity) of the pairs of sets that reach the cutoff; without ``right``, of the pairs within ``left``.

    Sets are rows of bits, frequent numbers first. What the first HEAD of them have in common
    comes from a product of matrices, block by block where the sizes allow the cutoff, and the
    rest adds at most the smaller rest of the two; pairs that can reach the cutoff are counted
    on all bits.
    """
    inner, sets = right is None, left + (right or [])
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    seen = np.bincount(np.concatenate(sets), minlength=37**3)
    order = np.argsort(-seen, kind="stable")[: max(1, np.count_nonzero(seen > 1))]
    place = np.full(len(seen), -1)
    place[order] = np.arange(len(order))
    width = -(-max(len(order), HEAD) // 64) * 64
    bits = np.zeros((len(sets), width // 64), dtype=np.uint64)
    for at in range(0, len(sets), BLOCK):
        part = sets[at : at + BLOCK]
        row, col = np.repeat(np.arange(len(part)), [len(s) for s in part]), place[np.concatenate(part)]
        flags = np.zeros((len(part), width), dtype=bool)
        flags[row[col >= 0], col[col >= 0]] = True
        bits[at : at + BLOCK] = np.packbits(flags, axis=1).view(np.uint64)
    rest = (sizes - np.bitwise_count(bits[:, : HEAD // 64]).sum(axis=1, dtype=np.int64)).astype(np.float32)
    least = (cutoff / (1 + cutoff) * sizes).astype(np.float32)

    def blocks(start: int, end: int) -> list[np.ndarray]:
        by_size = start + np.argsort(sizes[start:end], kind="stable")
        return [by_size[k : k + BLOCK] for k in range(0, len(by_size), BLOCK)]

    def head(rows: np.ndarray) -> np.ndarray:
        return np.unpackbits(bits[rows, : HEAD // 64].view(np.uint8), axis=1).astype(np.float32)

    ours = blocks(0, len(left))
    theirs = ours if inner else blocks(len(left), len(sets))
    for n, i in enumerate(ours):
        a = head(i)
        for j in theirs[n if inner else 0 :]:
            if sizes[i[-1]] < cutoff * sizes[j[0]] - 1e-9 or sizes[j[-1]] < cutoff * sizes[i[0]] - 1e-9:
                continue
            room = a @ head(j).T
            room += np.minimum(rest[i][:, None], rest[j][None])
            room -= least[i][:, None]
            room -= least[j][None]
            x, y = np.nonzero(room >= -0.01)
            if inner and i is j:
                x, y = x[x < y], y[x < y]
            for k in range(0, len(x), PAIRS):
                p, q = i[x[k : k + PAIRS]], j[y[k : k + PAIRS]]
                common = np.bitwise_count(bits[p] & bits[q]).sum(axis=1, dtype=np.int64)
                score = common / (sizes[p] + sizes[q] - common)
                near = score >= cutoff
                yield p[near], q[near] - (0 if inner else len(left)), score[near]


def trigram_pairs(items: DataFrame, item: str, text: str, block: str | None = None, cutoff: float = TRIGRAM_CUTOFF) -> DataFrame:
    """``a, b, score`` of items (a < b, distinct ids) whose trigram Jaccard reaches the cutoff, by whole sets of trigrams.

    Items with equal sets in a block are one class, compared once. The classes of a block lie
    in runs of bounded number, by size, and two runs meet in one group if their sizes let a
    pair reach the cutoff (``near_sets``). There are at most 37 ** 3 trigrams, so long texts
    share even their rarest with most others and no index of trigrams is selective.
    Work grows with the pairs of similar size, memory with the length of a run; a set is sent
    to each group of its run, a few hundred bytes each time.
    """
    ship(items.sparkSession)
    kind = dict(items.dtypes)
    group = F.col(block) if block else F.lit("")
    named = items.select(F.col(item).alias("id"), group.alias("block"), T.name_key(F.col(text)).alias("k")).where("id is not null and block is not null and k <> ''")

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 1_000):
                some = batch.slice(at, 1_000)
                codes = gram_codes(some.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array([packed(c) for c in codes], pa.binary()), pa.array([len(c) for c in codes], pa.int32())], names=["id", "block", "grams", "size"])

    rows = named.mapInArrow(coded, f"id {kind[item]}, block {kind[block] if block else 'string'}, grams binary, size int")
    rows = checkpoint(rows.withColumn("set", F.xxhash64("grams")))
    sets = checkpoint(rows.groupBy("block", "set").agg(F.any_value("size").alias("size"), F.any_value("grams").alias("grams")))
    # A run holds the sets of a few sizes; one size of more sets than a run is dealt by their hash.
    run = min(max(RUNS[0], sets.count() // RUN_SHARE), RUNS[1])
    by_size = sets.groupBy("block", "size").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("block").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cuts = checkpoint(by_size.select("block", "size", F.floor(before / run).alias("run"), F.ceil(F.col("n") / run).alias("parts"), "n"))
    at = cuts.select("block", "size", "run", "n", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    runs = at.groupBy("block", "run", "part").agg(F.min("size").alias("low"), F.max("size").alias("high"), F.max("n").alias("most"), F.count(F.lit(1)).alias("sizes"))
    a, b = (runs.select("block", *[F.col(c).alias(n + c) for c in ("run", "part", "low", "high", "most", "sizes")]) for n in ("a", "b"))
    ordered = (F.col("arun") < F.col("brun")) | ((F.col("arun") == F.col("brun")) & (F.col("apart") <= F.col("bpart")))
    fit = (F.col("ahigh") >= cutoff * F.col("blow") - 1e-9) & (F.col("bhigh") >= cutoff * F.col("alow") - 1e-9)
    one = (F.col("arun") == F.col("brun")) & (F.col("apart") == F.col("bpart"))
    meet = checkpoint(a.join(b, "block").where(ordered & fit & ~(one & (F.col("amost") == 1) & (F.col("asizes") == 1))).select("block", "arun", "apart", "brun", "bpart", one.alias("one")))
    first = meet.select("block", F.col("arun").alias("run"), F.col("apart").alias("part"), F.lit(0).alias("side"), "arun", "apart", "brun", "bpart")
    second = meet.where(~F.col("one")).select("block", F.col("brun").alias("run"), F.col("bpart").alias("part"), F.lit(1).alias("side"), "arun", "apart", "brun", "bpart")
    placed = sets.join(broadcast_if_small(cuts.select("block", "size", "run", "parts"), MEETINGS), ["block", "size"]).withColumn("part", F.pmod("set", "parts"))
    dealt = placed.select("block", "run", "part", "set", "grams").join(broadcast_if_small(first.unionAll(second), MEETINGS), ["block", "run", "part"])

    def compared(frame: pd.DataFrame) -> pd.DataFrame:
        sides = [frame[frame["side"] == k] for k in (0, 1)]
        left, right = ([unpacked(g) for g in s["grams"]] for s in sides)
        names = [s["set"].to_numpy() for s in sides]
        itself = frame["arun"].iloc[0] == frame["brun"].iloc[0] and frame["apart"].iloc[0] == frame["bpart"].iloc[0]
        found = list(near_sets(left, None if itself else right, cutoff)) if left and (itself or right) else []
        x, y, score = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, dtype=t) for k, t in enumerate((np.int64, np.int64, np.float64)))
        return pd.DataFrame({"block": frame["block"].iloc[0], "aset": names[0][x], "bset": names[0 if itself else 1][y], "score": score})

    near = dealt.groupBy("block", "arun", "apart", "brun", "bpart").applyInPandas(compared, f"block {kind[block] if block else 'string'}, aset long, bset long, score double")
    ids = rows.select("block", "set", "id")
    head, last = ids.withColumnsRenamed({"set": "aset", "id": "x"}), ids.withColumnsRenamed({"set": "bset", "id": "y"})
    across = near.join(head, ["block", "aset"]).join(last, ["block", "bset"]).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "score")
    same = ids.select("block", "set", F.col("id").alias("a")).join(ids.select("block", "set", F.col("id").alias("b")), ["block", "set"]).where("a < b").select("a", "b", F.lit(1.0).alias("score"))
    return across.unionAll(same)


def within_reach(a: str, b: str, cutoff: float) -> Column:
    """Whether two names are of lengths that let their ratio, at most 2 * shorter / (a + b), reach the cutoff."""
    return 2 * F.least(F.length(a), F.length(b)) >= cutoff * (F.length(a) + F.length(b)) - 1e-9


def name_pairs(names: DataFrame, name: str, cutoff: float = NAME_CUTOFF) -> DataFrame:
    """``a, b, score`` of distinct names that share a word of over three letters and whose ratio reaches the cutoff."""
    keyed = names.select(F.col(name).alias("name")).distinct().select("name", T.name_key(F.col("name")).alias("k")).where("k <> ''")
    words = keyed.select("name", "k", F.explode(F.array_distinct(F.filter(F.split("k", " "), lambda w: F.length(w) > 3))).alias("w"))
    a, b = words.select(F.col("name").alias("a"), F.col("k").alias("ka"), "w"), words.select(F.col("name").alias("b"), F.col("k").alias("kb"), "w")
    pairs = a.join(b, "w").where((F.col("a") < F.col("b")) & within_reach("ka", "kb", cutoff)).select("a", "b", "ka", "kb").distinct()
    return pairs.select("a", "b", T.name_ratio(F.col("ka"), F.col("kb")).alias("score")).where(F.col("score") >= cutoff)


def merge_candidates(concepts: DataFrame, cutoff: float = NAME_CUTOFF, jaccard: float = TRIGRAM_CUTOFF, limit: int = 600, most_by_word: int | None = MOST_BY_WORD, most_by_domain: int | None = MOST_BY_DOMAIN) -> DataFrame:
    """``a, b, score, reason`` of concepts ``slug, name, definition, aliases`` (and ``domain``) that may be the same.

    Compared are concepts that share a word of over three letters of name or aliases, or the
    domain; a word of more than ``most_by_word`` concepts and a domain of more than
    ``most_by_domain`` tell too little and are no block (None: no limit). The first rule that
    holds decides: alias match (1.0), name ratio, overlap of definitions. Both definitions
    must have words. The ``limit`` best are returned, ties by slug.
    """
    domain = F.coalesce(F.nullif("domain", F.lit("")), F.lit("?")) if "domain" in concepts.columns else F.lit(None).cast("string")
    c = concepts.select("slug", T.name_key(F.col("name")).alias("k0"), T.name_key(F.substring("definition", 1, 400)).alias("d"), F.transform(F.coalesce("aliases", F.array().cast("array<string>")), lambda x: T.name_key(x)).alias("al"), domain.alias("domain"))
    c = checkpoint(c.withColumn("k", F.when(F.col("k0") == "", F.replace("slug", F.lit("-"), F.lit(" "))).otherwise(F.col("k0"))).drop("k0"))
    words = c.select("slug", F.explode(F.array_distinct(F.filter(F.split(F.array_join(F.array_append("al", F.col("k")), " "), " "), lambda w: F.length(w) > 3))).alias("w"))
    bounded = lambda df, most: df if most is None else df.join(df.groupBy("w").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= most).select("w"), "w", "left_semi")
    blocks = bounded(words, most_by_word).select("slug", F.concat(F.lit("w "), "w").alias("w"))
    blocks = checkpoint(blocks.unionAll(bounded(c.where("domain is not null").select("slug", F.col("domain").alias("w")), most_by_domain).select("slug", F.concat(F.lit("d "), "w"))))
    pairs = blocks.select(F.col("slug").alias("a"), "w").join(blocks.select(F.col("slug").alias("b"), "w"), "w").where("a < b").select("a", "b").distinct()
    both = pairs.join(c.select(F.col("slug").alias("a"), F.col("k").alias("ka"), F.col("d").alias("da"), F.col("al").alias("ala")), "a").join(c.select(F.col("slug").alias("b"), F.col("k").alias("kb"), F.col("d").alias("db"), F.col("al").alias("alb")), "b")
    ga, gb = T.trigrams(F.col("da")), T.trigrams(F.col("db"))
    common = F.size(F.array_intersect(ga, gb))
    jac = F.when((F.col("da") != "") & (F.col("db") != ""), common / (F.size(ga) + F.size(gb) - common)).otherwise(0.0)
    judged = checkpoint(both.select("a", "b", "ka", "kb", jac.alias("jac"), (F.array_contains("ala", F.col("kb")) | F.array_contains("alb", F.col("ka"))).alias("alias")))
    # Only names whose lengths allow the cutoff go to Python.
    near = judged.where(~F.col("alias") & within_reach("ka", "kb", cutoff)).withColumn("ratio", T.name_ratio(F.col("ka"), F.col("kb")))
    scored = near.unionByName(judged.where(F.col("alias") | ~within_reach("ka", "kb", cutoff)).withColumn("ratio", F.lit(0.0)))
    score = F.when(F.col("alias"), 1.0).when(F.col("ratio") >= cutoff, F.col("ratio")).when(F.col("jac") >= jaccard, F.col("jac"))
    reason = F.when(F.col("alias"), "alias match").when(F.col("ratio") >= cutoff, "name similarity").otherwise("definition overlap")
    return scored.select("a", "b", score.alias("score"), reason.alias("reason")).where("score is not null").orderBy(F.desc("score"), "a", "b").limit(limit)
