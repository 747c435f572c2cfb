"""Redaction telemetry: matches per time window, source and label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def pii_telemetry(
    hits: DataFrame, window: str = "1 day", slide: str | None = None, lateness: str = "1 day"
) -> DataFrame:
    """`hits` is (ts, source, label, n), batch or streaming, one row per text and label.

    The watermark bounds the state to the windows that can still change.
    """
    span = F.window("ts", window, slide) if slide else F.window("ts", window)
    late = hits.withWatermark("ts", lateness) if hits.isStreaming else hits
    return (
        late.groupBy(span, "source", "label")
        .agg(F.count("*").alias("n_texts"), F.sum("n").alias("n_matches"))
        .select(
            F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
            "source",
            "label",
            "n_texts",
            "n_matches",
        )
    )


def to_snapshots(telemetry: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Write each batch's changed windows to its own folder; a replayed batch rewrites it."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        telemetry.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def latest(snapshots: DataFrame) -> DataFrame:
    """The last state of each window from the folders written by `to_snapshots`."""
    values = F.struct("batch_id", "n_texts", "n_matches")
    return (
        snapshots.groupBy("window_start", "source", "label")
        .agg(F.max(values).alias("v"))
        .select("window_start", "source", "label", "v.n_texts", "v.n_matches")
    )
