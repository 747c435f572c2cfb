"""Gateways on a stream: stateless, so any trigger gives the batch result."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from palisade.functions.redaction import DEFAULT_REGISTRY, Pattern
from palisade.plans.gateway import policy_gateway, triple_lock
from palisade.sources import schemas
from palisade.sources.readers import policies_at, policy_versions


def stream_gateway(stream: DataFrame, registry: list[Pattern] = DEFAULT_REGISTRY) -> DataFrame:
    return triple_lock(stream, registry)


def to_parquet(gated: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Exactly-once file sink; `trigger` defaults to all that is there, then stop."""
    return (
        gated.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def stream_policies(
    stream: DataFrame,
    policies: str,
    topic_vectors: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    **options,
) -> StreamingQuery:
    """The policy gateway on a stream of texts, under the policies in force when a batch begins.

    `policies` is a folder of versions (`writers.append_policies`).  A batch takes the latest version
    there is, and notes its number before anything else: a batch that is run again takes the same
    one, and writes the same folder `batch_id=...` below `path`.  Rows carry `policy_version`; with
    no version at all it is 0 and every text gets `ERROR (no policy)`.  `options` go to the gateway.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # a folder whose name starts with _ is no part of the table
        note = f"{path}/_versions/batch_id={batch_id}"
        try:
            version = spark.read.schema("version BIGINT").parquet(note).first()[0]
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            version = _latest(spark, policies)
            spark.range(1).select(F.lit(version).cast("long").alias("version")).write.parquet(note)
        rows = policies_at(spark, policies, version) if version else spark.createDataFrame([], schemas.POLICY)
        gated = policy_gateway(batch, rows, topic_vectors, **options)
        marked = gated.withColumn("policy_version", F.lit(version).cast("long"))
        marked.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _latest(spark: SparkSession, policies: str) -> int:
    try:
        return policy_versions(spark, policies).agg(F.max("version")).first()[0] or 0
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
