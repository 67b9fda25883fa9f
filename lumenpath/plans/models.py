"""Model-backed table functions: a callable of the user's answers prompts inside Arrow batches.

No model comes with the engine. Answers are kept in a keyed Parquet table, so that a prompt
is paid for once, and a failed prompt is a row with an error, not a failed job.
"""

from __future__ import annotations

import random
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from lumenpath.functions import text as T
from lumenpath.session import checkpoint, remove, ship

# Rows a call, links a bridge call may return, and the share of a context window for input.
PAIRS_PER_CALL, NAMES_PER_CALL, BRIDGES_PER_CALL, MAX_BRIDGES, INPUT_SHARE = 60, 90, 45, 14, 0.45
CARD_CHARS, INDEX_CHARS, MAX_WAIT = 260, 120, 30.0
#: Calls that one task has under way at a time.
CALLS_AT_ONCE = 8
#: What ``ask_all`` counts over different prompts: those asked, answers kept from the table and found in notes, retries, failures, characters sent and received.
ACCOUNT = ("calls", "kept", "noted", "retries", "failed", "chars_in", "chars_out")


def batch_chars(context_tokens: int, chars_per_token: float = 4.0) -> int:
    """Characters a batch may have for a model's context window."""
    return int(context_tokens * INPUT_SHARE * chars_per_token)


def answer(prompt: str, call: Callable[[str], str], check: Callable[[str], object], tries: int, wait: float) -> tuple[str | None, str | None, int]:
    """(answer, error, retries): an answer that fails the check is asked for again with the error appended."""
    ask, error = prompt, None
    for k in range(tries):
        try:
            said = call(ask)
            check(said)
            return said, None, k
        except Exception as e:  # any failure of the callable or the check is that prompt's error
            error = f"{type(e).__name__}: {e}"[:500]
            ask = f"{prompt}\n\nThe last answer was rejected: {error}"
            if k + 1 < tries and wait:
                time.sleep(min(MAX_WAIT, wait * 2**k) * (0.5 + random.random() / 2))
    return None, error, tries - 1


def ask_all(requests: DataFrame, call: Callable[[str], str], check: Callable[[str], object] = lambda _: None, cache: str | None = None, tries: int = 3, wait: float = 1.0, at_once: int = CALLS_AT_ONCE, seen: Observation | None = None) -> DataFrame:
    """``request_id, answer, error, retries, cached`` for ``requests(request_id, prompt)``.

    ``cache`` is the path of the table of earlier answers; only good ones are added to it.
    A task has up to ``at_once`` calls under way. Each good answer is noted beside the cache
    as soon as it is there, so that neither a second attempt of a lost task nor another run
    after a failed one asks for it again; the notes go once the table holds their answers.
    Equal prompts are one call. A null prompt is an error and no call. ``seen`` is filled
    with the counts of ACCOUNT in the pass that asks.
    """
    ship(requests.sparkSession)
    spark, notes, known = requests.sparkSession, None, None
    keyed = requests.select("request_id", "prompt", T.cache_key(F.col("prompt")).alias("key"))
    if cache:
        path = spark._jvm.org.apache.hadoop.fs.Path(cache)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        notes = f"{fs.makeQualified(path).toString()}-notes"
        known = spark.read.parquet(cache) if fs.exists(path) else None
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    todo = keyed.where("prompt is not null").select("key", "prompt").repartition(tasks, "key").groupBy("key").agg(F.min("prompt").alias("prompt"))
    if known is None:
        todo = todo.withColumn("kept", F.lit(None).cast("string"))
    else:
        todo = todo.join(known.groupBy("key").agg(F.min("answer").alias("kept")), "key", "left")

    def run(batches):
        log = Notes(notes) if notes else None

        def one(key, prompt, kept):
            if kept is not None:
                return key, kept, None, 0, "kept", 0
            said = log.read(key) if log else None
            if said is not None:
                return key, said, None, 0, "noted", 0
            said, error, retries = answer(prompt, call, check, tries, wait)
            if log and error is None:
                log.write(key, said)
            return key, said, error, retries, "asked", len(prompt) * (retries + 1)

        with ThreadPoolExecutor(at_once) as pool:
            for pdf in batches:
                yield pd.DataFrame(list(pool.map(one, pdf["key"], pdf["prompt"], pdf["kept"])), columns=["key", "answer", "error", "retries", "state", "sent"])

    told = todo.mapInPandas(run, "key string, answer string, error string, retries int, state string, sent long")
    if seen is not None:
        asked = F.col("state") == "asked"
        counts = (F.count_if(asked), F.count_if(F.col("state") == "kept"), F.count_if(F.col("state") == "noted"), F.sum("retries"), F.count("error"), F.sum("sent"), F.sum(F.when(asked, F.length("answer"))))
        told = told.observe(seen, *[F.coalesce(c, F.lit(0)).cast("long").alias(name) for name, c in zip(ACCOUNT, counts)])
    told = checkpoint(told)
    if cache:
        told.where("error is null and state <> 'kept'").select("key", "answer").write.mode("append").parquet(cache)
        remove(spark, notes)
    error = F.when(F.col("prompt").isNull(), F.lit("ValueError: no prompt")).otherwise(F.col("error"))
    return keyed.join(told, "key", "left").select("request_id", "answer", error.alias("error"), F.coalesce("retries", F.lit(0)).alias("retries"), F.coalesce(F.col("state") != "asked", F.lit(False)).alias("cached"))


class Notes:
    """Good answers of one question each, as small files named by their key in a shared folder."""

    def __init__(self, folder: str):
        from pyarrow import fs

        # Hadoop writes file:/a for file:///a, and has a name of its own for the S3 scheme.
        uri = folder.replace("file:/", "file:///", 1) if not folder.startswith("file://") else folder
        self.fs, self.folder = fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
        self.fs.create_dir(self.folder, recursive=True)

    def read(self, key: str) -> str | None:
        try:
            with self.fs.open_input_stream(f"{self.folder}/{key}") as f:
                return f.read().decode()
        except FileNotFoundError:
            return None

    def write(self, key: str, said: str) -> None:
        """Whole or not at all: written under a name of its own, then moved."""
        part = f"{self.folder}/{uuid.uuid4().hex}.part"
        with self.fs.open_output_stream(part) as f:
            f.write(said.encode())
        self.fs.move(part, f"{self.folder}/{key}")


def require_most(answers: DataFrame) -> DataFrame:
    """The good answers; an error if there are none, or if more than half of the requests failed."""
    n = answers.agg(F.count(F.lit(1)).alias("all"), F.count("error").alias("bad")).first()
    if n["all"] and (n["bad"] == n["all"] or n["bad"] > n["all"] // 2):
        raise RuntimeError(f"{n['bad']} of {n['all']} batches failed")
    return answers.where("error is null")


def repair_unit_ids(said: DataFrame, wanted: DataFrame) -> DataFrame:
    """``said(batch, pos, unit_id)`` with invented ids replaced by position, only where the counts agree with ``wanted``."""
    size = lambda df, n: df.groupBy("batch").agg(F.count(F.lit(1)).alias(n), F.collect_set("unit_id").alias("_" + n))
    same = size(said, "got").join(size(wanted, "want"), "batch").select("batch", ((F.col("got") == F.col("want")) & (F.size(F.array_except("_got", "_want")) > 0)).alias("_fix"))
    at = wanted.select("batch", "pos", F.col("unit_id").alias("_want"))
    out = said.join(same, "batch", "left").join(at, ["batch", "pos"], "left")
    return out.withColumn("unit_id", F.when(F.col("_fix"), F.col("_want")).otherwise(F.col("unit_id"))).drop("_fix", "_want")


def cards(concepts: DataFrame, chars: int = CARD_CHARS) -> DataFrame:
    """``slug, domain, card``: a concept as two lines for a prompt."""
    al = F.array_join(F.slice(F.array_sort("aliases"), 1, 3), "; ")
    head = F.concat_ws(" | ", F.concat(F.lit("- "), "slug"), "name", F.coalesce("kind", F.lit("?")), F.coalesce("domain", F.lit("?")), F.array_join(F.array_sort("courses"), ","), F.when(al != "", F.concat(F.lit("aliases: "), al)))
    return concepts.select("slug", "domain", F.concat(head, F.lit("\n    "), F.substring("definition", 1, chars)).alias("card"))


def pair_prompts(candidates: DataFrame, concepts: DataFrame, size: int = PAIRS_PER_CALL) -> DataFrame:
    """``request_id, prompt`` over slices of merge candidates ``a, b, score, reason``, best first.

    Candidates are a top-k list (``similarity.merge_candidates``), so they are numbered in one window.
    """
    c = cards(concepts)
    rows = candidates.join(c.select(F.col("slug").alias("a"), F.col("card").alias("ca")), "a").join(c.select(F.col("slug").alias("b"), F.col("card").alias("cb")), "b")
    rows = rows.withColumn("n", F.row_number().over(Window.orderBy(F.desc("score"), "a", "b")) - 1)
    block = F.format_string("### PAIR %s  <>  %s   (%s, score %s)\n%s\n%s", "a", "b", "reason", F.round("score", 3).cast("string"), "ca", "cb")
    return _gather(rows.select(F.floor(F.col("n") / size).cast("string").alias("request_id"), "n", block.alias("line")))


def name_prompts(concepts: DataFrame, size: int = NAMES_PER_CALL) -> DataFrame:
    """``request_id, prompt`` over slices of concept cards by domain: for finding duplicates or bridges (BRIDGES_PER_CALL)."""
    w = Window.partitionBy("domain").orderBy("slug")
    rows = cards(concepts, INDEX_CHARS).withColumn("n", F.row_number().over(w) - 1)
    return _gather(rows.select(F.concat_ws("#", F.coalesce("domain", F.lit("?")), F.floor(F.col("n") / size).cast("string")).alias("request_id"), "n", F.col("card").alias("line")))


def _gather(lines: DataFrame) -> DataFrame:
    return lines.groupBy("request_id").agg(F.array_sort(F.collect_list(F.struct("n", "line"))).alias("l")).select("request_id", F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias("prompt"))
