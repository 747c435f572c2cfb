"""Scoring a run of model replies, and the blueprint cache."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palisade.functions import scoring as S
from palisade.functions.text import sanitize
from palisade.operators.costs import with_call_cost


def score_run(replies: DataFrame, prices: DataFrame) -> DataFrame:
    """(model, body, judge, latency, ...) to (logic, correctness, cost, final_score).

    `body` and `judge` are the JSON bodies of the reply and of the judge's reply.  The
    structural tags are counted in the raw reply; `clean` is what the judge is shown.
    Replies without content are dropped, as failed calls are.
    """
    parsed = replies.withColumns(
        {"_reply": S.parse_reply(F.col("body")), "_judge": S.parse_reply(F.col("judge"))}
    ).withColumn("_raw", S.reply_content(F.col("_reply")))
    scored = parsed.where(F.col("_raw").isNotNull()).withColumns(
        {
            "logic": S.logic_score(F.col("_raw")),
            "clean": sanitize(F.col("_raw")),
            "correctness": S.judge_rating(S.reply_content(F.col("_judge"))),
            "total_tokens": F.col("_reply.usage.total_tokens"),
        }
    )
    final = S.final_score(F.col("logic"), F.col("correctness"), F.col("cost"), F.col("latency"))
    return (
        with_call_cost(scored, prices)
        .withColumn("final_score", final)
        .drop("body", "judge", "_reply", "_judge", "_raw", "rate")
    )


def cache_lookup(prompts: DataFrame, blueprints: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(hits, misses) by key; each missing key is listed once, to be compiled once.

    A key stored several times is one hit, with the smallest of its blueprints.
    """
    stored = blueprints.groupBy("key").agg(F.min("blueprint").alias("blueprint"))
    hits = prompts.join(stored, "key")
    misses = prompts.join(blueprints.select("key"), "key", "left_anti")
    return hits, misses.groupBy("key").agg(F.min("prompt").alias("prompt"))
