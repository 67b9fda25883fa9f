"""URL filters from fixed rules and mined association rules, in DataFrame functions only.

Spark's FP-growth mines combinations of URL tokens from labelled pages, each transaction
holding the page's tokens and its class. Rules "tokens -> class" that reach the confidence
and support are pruned (a rule goes if a part of its tokens already says the same) and
matched by an inverted index: each rule is filed under its rarest token, so a URL is compared
only with the rules of its own tokens.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenpath.llm.common import bounded_sample
from lumenpath.session import broadcast_if_small, checkpoint

#: (host, path, verdict). A rule fits its host and all subdomains if the path starts with its own.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
#: The rules are mined from at most about so many labelled pages.
FIT_PAGES = 50_000
MIN_SUPPORT, MIN_CONFIDENCE = 0.002, 0.8
#: A combination is evidence only if so many labelled pages hold it, however few pages there are.
MIN_PAGES = 20
BLOCK, ALLOW = "block", "allow"
CLASS = "\0class="


def host_of(url: Column) -> Column:
    """What follows the first "://" up to "/", "?", "#" or the end, with A-Z lower-cased; else empty."""
    rest = _rest(url)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), upper, upper.lower())


def path_of(url: Column) -> Column:
    """What follows the host up to "?", "#" or the end; else empty."""
    return F.regexp_extract(_rest(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.locate("://", F.coalesce(url, F.lit("")))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest rule that fits, as struct(size, rule, verdict), or null; of equally long rules the last by name."""

    def fits(h: str, p: str) -> Column:
        return ((host == h) | host.endswith("." + h)) & path.startswith(p)

    said = [F.when(fits(h, p), F.struct(F.lit(len(h) + len(p)).alias("size"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))) for h, p, v in rules]
    return F.array_max(F.array(*said)) if said else F.lit(None).cast("struct<size:int,rule:string,verdict:string>")


def tokens(host: Column, path: Column) -> Column:
    """Distinct tokens of a URL, numbers as one: host labels, the last two labels together, and path parts."""
    labels = F.transform(F.split(host, r"[.]"), lambda x: F.concat(F.lit("h:"), x))
    words = F.transform(F.split(host, r"[.\-]"), lambda x: F.concat(F.lit("w:"), x))
    site = F.array(F.concat(F.lit("s:"), F.substring_index(host, ".", -2)))
    parts = F.transform(F.filter(F.split(F.lower(path), r"[/._\-]"), lambda x: x != ""), lambda x: F.concat(F.lit("p:"), F.regexp_replace(x, r"^\d+$", "#")))
    return F.array_distinct(F.concat(labels, words, site, parts))


def mine(pages: DataFrame, labels: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``tokens, verdict, confidence, support`` of the rules kept.

    ``labels`` marks a page by its id: toxic or of low quality is "block", else "allow";
    if an id repeats, one bad mark decides. The share of pages in each class is the least
    confidence that tells something, so a rule must also lift its class above that share.
    Every token of a page takes part. Tokens that stand on the same labelled pages are mined
    as one and named apart again in the rules: a rule with two of them is always redundant.
    """
    bad = F.max(F.when((F.col("toxic") == 1) | (F.col("quality") == 0), 1).otherwise(0))
    marks = labels.where("doc_id is not null and (toxic is not null or quality is not null)").groupBy(F.col("doc_id").alias("mark_id")).agg(bad.alias("bad"))
    urls = pages.where("url is not null").select(F.col("page_id").cast("long").alias("page_id"), "url")
    marked, _ = bounded_sample(urls.join(marks, F.col("page_id") == F.col("mark_id")), ["mark_id"], FIT_PAGES)
    verdict = F.concat(F.lit(CLASS), F.when(F.col("bad") == 1, BLOCK).otherwise(ALLOW))
    baskets = checkpoint(marked.select(F.monotonically_increasing_id().alias("row"), tokens(host_of(F.col("url")), path_of(F.col("url"))).alias("items"), verdict.alias("class")))
    shares = {r["class"]: r["n"] for r in baskets.groupBy("class").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(shares.values())
    empty = baskets.sparkSession.createDataFrame([], "tokens array<string>, verdict string, confidence double, support double")
    if not total:
        return empty
    support = min(1.0, max(min_support, MIN_PAGES / total))
    alike = checkpoint(twins(baskets).where(F.col("n") >= support * total))
    named = alike.select("twins", F.explode("twins").alias("token"))
    kept = baskets.select("row", F.explode("items").alias("token")).join(named, "token").groupBy(F.col("row").alias("kept_row")).agg(F.collect_set(F.element_at("twins", 1)).alias("kept"))
    short = checkpoint(baskets.join(kept, baskets.row == kept.kept_row, "left").select(F.array_append(F.coalesce("kept", F.array().cast("array<string>")), F.col("class")).alias("items")))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(short)
    said = F.element_at("consequent", 1)
    prior = F.create_map(*[F.lit(x) for k, n in shares.items() for x in (k, n / total)])
    found = model.associationRules.where(said.startswith(CLASS) & ~F.exists("antecedent", lambda x: x.startswith(CLASS)))
    found = found.where(F.col("confidence") > F.least(F.lit(1.0), F.element_at(prior, said) + 0.1))
    rules = checkpoint(found.select(F.array_sort("antecedent").alias("tokens"), F.substring(said, len(CLASS) + 1, 10).alias("verdict"), "confidence", "support"))
    # A rule is redundant if the rule of one token fewer already says the same.
    held = rules.select(F.explode("tokens").alias("left_out"), "tokens", "verdict").select(F.array_remove("tokens", F.col("left_out")).alias("part"), F.col("tokens").alias("whole"), F.col("verdict").alias("v"))
    redundant = held.join(rules, (held.part == rules.tokens) & (held.v == rules.verdict), "left_semi").select("whole", "v").distinct()
    rules = rules.join(redundant, (rules.tokens == redundant.whole) & (rules.verdict == redundant.v), "left_anti")
    # Each choice of one twin for each token is a rule of its own.
    members = rules.select(F.monotonically_increasing_id().alias("rule"), "*").select("rule", "verdict", "confidence", "support", F.explode("tokens").alias("token"))
    members = members.join(alike.select(F.element_at("twins", 1).alias("token"), "twins"), "token")
    sets = members.groupBy("rule", "verdict", "confidence", "support").agg(F.collect_list("twins").alias("sets"))
    grown = F.reduce("sets", F.array(F.array().cast("array<string>")), lambda done, more: F.flatten(F.transform(done, lambda d: F.transform(more, lambda t: F.array_append(d, t)))))
    return sets.select(F.explode(grown).alias("tokens"), "verdict", "confidence", "support").select(F.array_sort("tokens").alias("tokens"), "verdict", "confidence", "support")


def twins(baskets: DataFrame) -> DataFrame:
    """``twins, n``: the tokens that stand in the same ``n`` rows of ``baskets(row, items)``, in order; rows are compared by a 128-bit digest."""
    held = baskets.select("row", F.explode("items").alias("token"))
    sums = held.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("row")).alias("x"), F.bit_xor(F.xxhash64("row", F.lit("twin"))).alias("y"))
    return sums.groupBy("n", "x", "y").agg(F.array_sort(F.collect_list("token")).alias("twins")).select("twins", "n")


def judge(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str, str]] = RULES, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``page_id, host, path, rule, verdict, reason`` of every page.

    A fixed rule decides where one fits; else the mined rule of highest confidence (then
    support, then tokens) does; else the page is allowed. ``reason`` is "rule", the mined
    tokens, or "default". Null urls, and those without "://", have empty host and path and no
    tokens; repeated rows are each judged; empty tables give an empty result; extra columns
    are ignored.
    """
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").alias("url"))
    parts = base.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.col("url").isNotNull().alias("has_url"))
    fixed = parts.withColumn("fit", matching_rule(F.col("host"), F.col("path"), rules))
    mined = mine(pages, labels, min_support, min_confidence)
    filed = inverted_index(mined)
    if filed.isEmpty():
        said = fixed.withColumn("best", F.lit(None).cast("struct<confidence:double,support:double,need:array<string>,verdict:string>"))
    else:
        said = apply_mined(fixed, filed)
    verdict = F.coalesce("fit.verdict", "best.verdict", F.lit(ALLOW))
    reason = F.when(F.col("fit").isNotNull(), "rule").when(F.col("best").isNotNull(), F.array_join("best.need", " ")).otherwise("default")
    return said.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), verdict.alias("verdict"), reason.alias("reason"))


def inverted_index(mined: DataFrame) -> DataFrame:
    """``token, need, verdict, confidence, support``: each rule filed under the token that fewest rules hold."""
    held = mined.select(F.explode("tokens").alias("token"), "tokens", "verdict", "confidence", "support")
    spread = held.groupBy("token").agg(F.count(F.lit(1)).alias("n")).withColumnRenamed("token", "t")
    ranked = held.join(spread, held.token == spread.t)
    return checkpoint(ranked.groupBy(F.col("tokens").alias("need"), "verdict").agg(F.min_by("token", F.struct("n", "token")).alias("token"), F.max("confidence").alias("confidence"), F.max("support").alias("support")))


def apply_mined(fixed: DataFrame, filed: DataFrame) -> DataFrame:
    """Add the best mined rule of each row that no fixed rule fits. Rules are broadcast only if they are few."""
    keyed = fixed.withColumn("row", F.monotonically_increasing_id())
    keyed = checkpoint(keyed)
    open_rows = keyed.where("fit is null and has_url").select("row", tokens(F.col("host"), F.col("path")).alias("items"))
    hits = open_rows.select("row", "items", F.explode("items").alias("token")).join(broadcast_if_small(filed, 10_000), "token").where(F.size(F.array_except("need", "items")) == 0)
    best = hits.groupBy("row").agg(F.max(F.struct("confidence", "support", "need", "verdict")).alias("best")).withColumnRenamed("row", "hit_row")
    return keyed.join(best, keyed.row == best.hit_row, "left")
