"""Accounting of model calls: tokens and cost by stage, as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters a token is taken to have.
CHARS_PER_TOKEN = 4.0


def cost(tokens_in, tokens_out, price_in, price_out):
    """Dollars of one or more calls; prices are per million tokens, an unknown model costs nothing."""
    return tokens_in / 1e6 * F.coalesce(price_in, F.lit(0.0)) + tokens_out / 1e6 * F.coalesce(price_out, F.lit(0.0))


def usage(calls: DataFrame, prices: DataFrame) -> DataFrame:
    """``stage, calls, cached, tokens_in, tokens_out, usd`` of ``calls(stage, model, tokens_in, tokens_out, cached)``.

    ``prices(model, price_in, price_out)`` has one row a model; it is small, but joined after the sums all the same.
    """
    sums = calls.groupBy("stage", "model").agg(F.count(F.lit(1)).alias("calls"), F.count_if("cached").alias("cached"), F.sum("tokens_in").alias("tokens_in"), F.sum("tokens_out").alias("tokens_out"))
    paid = sums.join(prices, "model", "left").withColumn("usd", cost(F.col("tokens_in"), F.col("tokens_out"), F.col("price_in"), F.col("price_out")))
    return paid.groupBy("stage").agg(*[F.sum(c).alias(c) for c in ("calls", "cached", "tokens_in", "tokens_out")], F.round(F.sum("usd"), 4).alias("usd"))


def estimated_calls(prompts: DataFrame, answers: DataFrame, stage: str, model: str, chars_per_token: float = CHARS_PER_TOKEN) -> DataFrame:
    """``calls`` rows of one stage, tokens estimated from characters: a retry sends the prompt again, a kept answer sends nothing."""
    both = prompts.select("request_id", "prompt").join(answers.select("request_id", "answer", "retries", "cached"), "request_id")
    sent = F.when(F.col("cached"), 0).otherwise(F.length("prompt") * (F.col("retries") + 1))
    got = F.when(F.col("cached"), 0).otherwise(F.coalesce(F.length("answer"), F.lit(0)))
    return both.select(F.lit(stage).alias("stage"), F.lit(model).alias("model"), F.ceil(sent / chars_per_token).alias("tokens_in"), F.ceil(got / chars_per_token).alias("tokens_out"), "cached")
