"""Similarity gate: each input against a table of topics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palisade.fixed_values import DEFAULT_THRESHOLD
from palisade.functions.formatting import fixed
from palisade.operators import kernels as K
from palisade.operators.retrieval import SHIPPED_ROWS, nearest_chunks, ship
from palisade.session import scratch_path


def best_topic(
    inputs: DataFrame,
    topics: DataFrame,
    vector: str = "vector",
    shipped_rows: int = SHIPPED_ROWS,
    segment: str | None = None,
) -> DataFrame:
    """Add `similarity` and `topic` of the most similar topic; ties go to the lower ord.

    `topics` is (ord, topic, vector), in the order of `ord` (nulls last) and then of the name.
    With `segment`, a column of both tables, an input meets the topics of its own segment only, and
    has a null similarity where that is null or has none.
    Normally the topics are shipped with an Arrow function and the inputs stay where they are.
    A topic table too large for that is searched block by block for each different vector, and
    the result is joined back by the vector: ids may repeat or be null.
    """
    topics = topics.where("vector is not null")
    where = F.lit("") if segment is None else F.col(segment)
    listed = topics.select("ord", "topic", "vector", where.alias("segment"))
    sent = ship(listed.where("segment is not null"), shipped_rows)
    if sent is not None:
        if sent.num_rows == 0 and segment is None:
            raise ValueError("the topic table is empty")
        sent = sent.sort_by([("ord", "ascending"), ("topic", "ascending")])
        score = F.arrow_udf(
            K.best_topic_of(sent["segment"].to_pylist(), sent["topic"].to_pylist(), K.matrix(sent["vector"])),
            "similarity double, topic string",
        )
        return (
            inputs.withColumn("_best", score(where, F.col(vector)))
            .withColumn("similarity", F.col("_best.similarity"))
            .withColumn("topic", F.col("_best.topic"))
            .drop("_best")
        )
    spark = inputs.sparkSession
    path = scratch_path(spark, "topics")
    in_order = listed.orderBy(F.asc_nulls_last("ord"), F.asc_nulls_last("topic"))
    in_order.withColumn("chunk_id", F.monotonically_increasing_id()).write.parquet(path)
    numbered = spark.read.parquet(path)
    keyed = inputs.withColumn("_segment", where).withColumn("_vector", F.sha2(F.col(vector).cast("string"), 256))
    asked = (
        keyed.where(F.col(vector).isNotNull())
        .groupBy("_segment", "_vector")
        .agg(F.any_value(vector).alias("vector"))
    )
    found = nearest_chunks(
        asked.select(F.col("_vector").alias("query_id"), F.col("_segment").alias("collection"), "vector"),
        numbered.select("chunk_id", F.col("segment").alias("collection"), "vector"),
        k=1,
        metric="cosine",
        shipped_rows=shipped_rows,
    )
    best = found.join(numbered.select("chunk_id", "topic"), "chunk_id").select(
        F.col("collection").alias("_segment"),
        F.col("query_id").alias("_vector"),
        F.round(1 - F.col("exact"), 12).alias("similarity"),
        "topic",
    )
    return keyed.join(best, ["_segment", "_vector"], "left").drop("_segment", "_vector")


def semantic_verdict(limit: Column) -> Column:
    """The verdict on `similarity` and `topic`; at the limit is blocked, null is skipped."""
    shown = fixed(F.col("similarity"), 2)
    return (
        F.when(F.col("similarity").isNull(), F.lit("SKIP (embeddings unavailable)"))
        .when(
            F.col("similarity") >= limit,
            F.concat(
                F.lit("BLOCKED (similarity: "), shown, F.lit(", topic: '"), F.col("topic"), F.lit("')")
            ),
        )
        .otherwise(F.concat(F.lit("CLEAN (max similarity: "), shown, F.lit(")")))
    )


def semantic_gate(
    inputs: DataFrame,
    topics: DataFrame,
    threshold: float | None = None,
    vector: str = "vector",
) -> DataFrame:
    """Add `similarity`, `topic` and `semantic_check`; at the threshold is blocked.

    An input without a vector is skipped, as when no embedding was available.
    """
    limit = DEFAULT_THRESHOLD if threshold is None else threshold
    return best_topic(inputs, topics, vector).withColumn("semantic_check", semantic_verdict(F.lit(limit)))
