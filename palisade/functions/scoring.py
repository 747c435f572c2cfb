"""Scores of one model run, as column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from palisade.fixed_values import (
    COMPILE_HEAD,
    JUDGE_HEAD,
    JUDGE_MIDDLE,
    LOGIC_TAGS,
    PROMPT_TAIL,
)
from palisade.functions.formatting import rounded

REPLY_SCHEMA = (
    "choices ARRAY<STRUCT<message: STRUCT<content: STRING>>>, "
    "usage STRUCT<total_tokens: BIGINT>"
)


def logic_score(text: Column, tags: list[str] = LOGIC_TAGS) -> Column:
    """How many of the structural tags occur, whatever their case."""
    lowered = F.lower(text)
    score = F.lit(0)
    for tag in tags:
        score = score + F.contains(lowered, F.lit(tag)).cast("int")
    return score


def call_cost(total_tokens: Column, rate: Column) -> Column:
    return F.coalesce(total_tokens, F.lit(0)) / F.lit(1_000_000.0) * rate


def final_score(logic: Column, correctness: Column, cost: Column, latency: Column) -> Column:
    """0.4 logic + 0.4 correctness on 0..100, less penalties for cost and latency."""
    quality = logic / F.lit(6.0) * 100 * 0.4 + correctness * 10 * 0.4
    cost_penalty = F.greatest(F.lit(0.0), (cost - 0.01) * 1000)
    latency_penalty = F.greatest(F.lit(0.0), (latency - 60) * 0.5)
    total = quality - (cost_penalty + latency_penalty)
    return rounded(F.greatest(F.lit(0.0), F.least(F.lit(100.0), total)), 1)


def judge_rating(reply: Column) -> Column:
    """`rating` inside the widest {...} span of a reply; 0 whenever that fails."""
    span = F.regexp_extract(reply, r"(?s)^[^{]*+(\{.*\})", 1)
    rating = F.get_json_object(span, "$.rating").try_cast("double")
    return F.coalesce(rating, F.lit(0.0))


def parse_reply(body: Column) -> Column:
    return F.from_json(body, REPLY_SCHEMA)


def reply_content(reply: Column) -> Column:
    return F.get(reply["choices"], F.lit(0))["message"]["content"]


def blueprint_key(prompt: Column, when: Column) -> Column:
    """Month plus the first ten hex digits of SHA-256: one blueprint a month."""
    return F.concat(
        F.date_format(when, "yyyy-MM"), F.lit("_"), F.substring(F.sha2(prompt, 256), 1, 10)
    )


def compile_prompt(prompt: Column) -> Column:
    return F.concat(F.lit(COMPILE_HEAD), prompt, F.lit(PROMPT_TAIL))


def judge_prompt(blueprint: Column, response: Column) -> Column:
    return F.concat(
        F.lit(JUDGE_HEAD), blueprint, F.lit(JUDGE_MIDDLE), response, F.lit(PROMPT_TAIL)
    )


def run_stamp(when: Column) -> Column:
    return F.date_format(when, "'Run_'yyyyMMdd_HHmmss")
