"""Prices, token costs and their roll-up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palisade.fixed_values import (
    CALL_PRICES,
    DEFAULT_CALL_PRICE,
    DEFAULT_TIER,
    TIER_PRICES,
)
from palisade.functions import scoring as S
from palisade.functions.formatting import cost_label, rounded
from palisade.session import local_table


def call_prices(spark: SparkSession, rows=CALL_PRICES) -> DataFrame:
    return local_table(spark, ["model", "rate"], rows)


def tier_prices(spark: SparkSession, rows=TIER_PRICES) -> DataFrame:
    names = ["tier", "role", "model_name", "model_id", "input_cost", "output_cost"]
    return local_table(spark, names, rows)


def tier_registry(spark: SparkSession, tier: str = DEFAULT_TIER, rows=TIER_PRICES) -> DataFrame:
    """The models of one tier; an unknown tier is an error."""
    wanted = tier.upper()
    if wanted not in {r[0] for r in rows}:
        raise ValueError(f"unknown tier {tier!r}")
    return tier_prices(spark, [r for r in rows if r[0] == wanted])


def with_tier_model(usage: DataFrame, prices: DataFrame) -> DataFrame:
    """Add the model each row's tier (in any case) and role stand for, and `error` where there is
    none: an unknown tier, or a role that the tier has no model for."""
    listed = prices.select(F.col("tier").alias("_tier"), "role", "model_name", "model_id")
    tiers = prices.select(F.col("tier").alias("_tier"), F.lit(True).alias("_known")).distinct()
    asked = usage.withColumn("_tier", F.upper("tier"))
    found = asked.join(tiers, "_tier", "left").join(listed, ["_tier", "role"], "left")

    def quoted(name: str):
        return F.concat(F.lit("'"), F.coalesce(F.col(name).cast("string"), F.lit("")), F.lit("'"))

    error = F.when(F.col("_known").isNull(), F.concat(F.lit("unknown tier "), quoted("tier"))).when(
        F.col("model_id").isNull(), F.concat(F.lit("no model for role "), quoted("role"))
    )
    return found.select(*usage.columns, "model_name", "model_id", error.alias("error"))


def with_call_cost(calls: DataFrame, prices: DataFrame, default: float = DEFAULT_CALL_PRICE) -> DataFrame:
    """Add `cost`: tokens at the model's rate, the default rate for an unknown model.

    Spark broadcasts the price side by its real size.
    """
    rate = F.coalesce("rate", F.lit(default))
    return calls.join(prices, "model", "left").withColumn(
        "cost", S.call_cost(F.col("total_tokens"), rate)
    )


def token_cost(usage: DataFrame, prices: DataFrame) -> DataFrame:
    """Add input, output and total cost, priced by the row's own tier and role."""
    priced = usage.join(prices, ["tier", "role"], "left")
    return priced.withColumns(
        {
            "input_cost_usd": F.col("prompt_tokens") * F.col("input_cost"),
            "output_cost_usd": F.col("completion_tokens") * F.col("output_cost"),
        }
    ).withColumn("total_cost_usd", F.col("input_cost_usd") + F.col("output_cost_usd"))


def cost_rollup(costs: DataFrame) -> DataFrame:
    """Tokens and cost per label and model, and one TOTAL row."""
    sums = costs.groupingSets(
        [["label", "model_name"], []], "label", "model_name"
    ).agg(
        F.grouping_id().alias("_level"),
        F.sum(F.col("prompt_tokens") + F.col("completion_tokens")).alias("tokens"),
        F.sum("total_cost_usd").alias("_cost"),
    )
    total = F.col("_level") == 3
    cost = rounded(F.col("_cost"), 9)
    return sums.select(
        F.when(total, F.lit("TOTAL")).otherwise(F.col("label")).alias("label"),
        F.when(total, F.lit("")).otherwise(F.col("model_name")).alias("model_name"),
        "tokens",
        cost.alias("cost"),
        cost_label(F.col("_cost")).alias("cost_label"),
    )


def embedding_cost(usage: DataFrame, input_cost: float) -> DataFrame:
    """Embedding tokens and their cost per collection."""
    return usage.groupBy("collection").agg(F.sum("tokens").alias("tokens")).withColumn(
        "cost", rounded(F.col("tokens") * F.lit(input_cost), 9)
    )
