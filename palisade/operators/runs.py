"""Exploring a table of model runs (run, model, final_score, cost, latency, ...)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palisade.fixed_values import STRONG_SCORE
from palisade.functions.formatting import dollars, fixed, rounded
from palisade.operators.ordering import best_so_far

SORT_COLUMNS = ["final_score", "cost", "latency", "model", "run"]


def filter_runs(
    runs: DataFrame,
    run_names: list[str] | None = None,
    models: list[str] | None = None,
    low: float | None = None,
    high: float | None = None,
) -> DataFrame:
    """Runs, models and an inclusive score range; None leaves a filter out."""
    if run_names is not None:
        runs = runs.where(F.col("run").isin(run_names))
    if models is not None:
        runs = runs.where(F.col("model").isin(models))
    if low is not None:
        runs = runs.where(F.col("final_score") >= low)
    if high is not None:
        runs = runs.where(F.col("final_score") <= high)
    return runs


def score_points(runs: DataFrame, x: str) -> DataFrame:
    """Points of score against `cost` or `latency`, labelled by run and model."""
    return runs.select("run", "model", F.col(x).alias("x"), F.col("final_score").alias("y"))


def sort_runs(runs: DataFrame, column: str = "final_score", ascending: bool = False) -> DataFrame:
    if column not in SORT_COLUMNS:
        raise ValueError(f"sort by one of {SORT_COLUMNS}")
    return runs.orderBy(F.col(column).asc() if ascending else F.col(column).desc())


def filter_domains(runs: DataFrame) -> DataFrame:
    """What the filters can be set to: distinct runs and models, and the score range."""
    named = [
        runs.select(F.lit(kind).alias("kind"), F.col(kind).alias("value")).distinct()
        for kind in ("run", "model")
    ]
    ends = runs.agg(F.min("final_score").alias("lo"), F.max("final_score").alias("hi")).select(
        F.inline(
            F.array(
                F.struct(F.lit("score_min").alias("kind"), fixed(F.col("lo"), 1).alias("value")),
                F.struct(F.lit("score_max").alias("kind"), fixed(F.col("hi"), 1).alias("value")),
            )
        )
    )
    return named[0].unionByName(named[1]).unionByName(ends)


def summary_cards(runs: DataFrame) -> DataFrame:
    """Rows, runs, mean score, and the best, cheapest and fastest row.

    Ties go to the first (run, model), where an argmax would depend on row order.
    """

    def first_by(key: Column) -> Column:
        return F.min(F.struct(key.alias("key"), "run", "model"))

    cards = runs.agg(
        F.count("*").alias("n_rows"),
        F.countDistinct("run").alias("n_runs"),
        F.avg("final_score").alias("avg_score"),
        first_by(-F.col("final_score")).alias("best"),
        first_by(F.col("cost")).alias("cheapest"),
        first_by(F.col("latency")).alias("fastest"),
    )
    return cards.select(
        "n_rows",
        "n_runs",
        rounded(F.col("avg_score"), 3).alias("avg_score"),
        F.col("best.model").alias("top_model"),
        fixed(-F.col("best.key"), 3).alias("top_score"),
        F.col("cheapest.model").alias("cheapest_model"),
        dollars(F.col("cheapest.key"), 4).alias("lowest_cost"),
        F.col("fastest.model").alias("fastest_model"),
        F.concat(fixed(F.col("fastest.key"), 2), F.lit("s")).alias("lowest_latency"),
    )


def model_ranking(runs: DataFrame) -> DataFrame:
    return (
        runs.groupBy("model")
        .agg(F.avg("final_score").alias("m"))
        .select("model", rounded(F.col("m"), 6).alias("avg_score"))
        .orderBy("avg_score", "model")
    )


def scaled(value: Column, low: Column, high: Column) -> Column:
    """Min-max position; 0.5 where all values are the same."""
    return F.when(high > low, (value - low) / (high - low)).otherwise(F.lit(0.5))


def model_heatmap(runs: DataFrame) -> DataFrame:
    """Mean score, cost and latency per model, each also scaled so that 1 is best.

    The ranges are a one-row aggregate of the per-model table.
    """
    means = runs.groupBy("model").agg(
        F.avg("final_score").alias("score"),
        F.avg("cost").alias("cost"),
        F.avg("latency").alias("latency"),
    )
    names = ("score", "cost", "latency")
    ends = means.agg(
        F.struct(*[F.min(n).alias(n) for n in names]).alias("low"),
        F.struct(*[F.max(n).alias(n) for n in names]).alias("high"),
    )
    ranges = ends.select(F.struct("low", "high").alias("r")).scalar()
    at = means.withColumn("_r", ranges)

    def position(name: str) -> Column:
        return scaled(F.col(name), F.col(f"_r.low.{name}"), F.col(f"_r.high.{name}"))

    return at.select(
        "model",
        rounded(position("score"), 6).alias("score_norm"),
        rounded(1 - position("cost"), 6).alias("cost_norm"),
        rounded(1 - position("latency"), 6).alias("latency_norm"),
        fixed(F.col("score"), 3).alias("score_label"),
        dollars(F.col("cost"), 4).alias("cost_label"),
        F.concat(fixed(F.col("latency"), 2), F.lit("s")).alias("latency_label"),
    )


def composite_score(runs: DataFrame) -> DataFrame:
    """0.6 accuracy + 0.2 scaled 1/latency + 0.2 scaled 1/cost, scaled within a run.

    A cost or latency of zero has no inverse; it takes the full 1.0.  The ranges of a
    run are aggregated and joined back: no window gathers a whole run in one task.
    """
    inverse = runs.withColumns(
        {
            "_lat": F.when(F.col("latency") > 0, 1 / F.col("latency")),
            "_cost": F.when(F.col("cost") > 0, 1 / F.col("cost")),
        }
    )
    ranges = inverse.groupBy("run").agg(
        F.min("_lat").alias("_lat_lo"),
        F.max("_lat").alias("_lat_hi"),
        F.min("_cost").alias("_cost_lo"),
        F.max("_cost").alias("_cost_hi"),
    )

    def part(name: str) -> Column:
        position = scaled(F.col(name), F.col(f"{name}_lo"), F.col(f"{name}_hi"))
        return F.when(F.col(name).isNull(), F.lit(1.0)).otherwise(position)

    score = 0.6 * (F.col("correctness") / 10) + 0.2 * part("_lat") + 0.2 * part("_cost")
    helpers = ["_lat", "_cost", "_lat_lo", "_lat_hi", "_cost_lo", "_cost_hi"]
    return (
        inverse.join(ranges, "run")
        .withColumn("composite", rounded(score, 6))
        .withColumn("strong", F.col("composite") > STRONG_SCORE)
        .drop(*helpers)
    )


def pareto_frontier(runs: DataFrame) -> DataFrame:
    """Rows no other row beats on both cost and score; equal rows stay together.

    A row is on the frontier when it has the best score at its cost and that score
    exceeds every score at a lower cost.  The best score per cost is aggregated first
    (cheap even when most rows share one cost), and only it is ordered.
    """
    runs = runs.where(F.col("cost").isNotNull() & F.col("final_score").isNotNull())
    best = runs.groupBy("cost").agg(F.max("final_score").alias("final_score"))
    front = best_so_far(best, "cost", "final_score")
    return runs.join(front, ["cost", "final_score"], "left_semi").orderBy("cost")
