"""Drift of the mean score from one time window to the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palisade.functions.formatting import rounded


def window_means(scores: DataFrame, window: str = "1 day", lateness: str = "1 day") -> DataFrame:
    """Mean score per model and window; `scores` is (ts, model, score), batch or stream."""
    late = scores.withWatermark("ts", lateness) if scores.isStreaming else scores
    return late.groupBy("model", F.window("ts", window)).agg(F.avg("score").alias("mean_score"))


def score_drift(scores: DataFrame, window: str = "1 day") -> DataFrame:
    """Each window's mean and its change from the model's window before.

    The lag runs over one row per window, not over the scores.
    """
    order = Window.partitionBy("model").orderBy("window.start")
    means = window_means(scores, window)
    change = F.col("mean_score") - F.lag("mean_score").over(order)
    return means.withColumn("_change", change).select(
        "model",
        F.date_format("window.start", "yyyy-MM-dd").alias("day"),
        rounded(F.col("mean_score"), 6).alias("mean_score"),
        rounded(F.col("_change"), 6).alias("drift"),
    )
