"""Streaming forms, run to the end of what is there, against the batch SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from palisade.catalog import patterns_sql as P
from palisade.catalog import views as V
from palisade.catalog.gate_queries import POLICY_GATEWAY
from palisade.catalog.registry import query
from palisade.catalog.text_queries import TRIPLE_LOCK
from palisade.functions.redaction import find_hits
from palisade.plans.gateway import display_rows
from palisade.session import scratch_path
from palisade.sources import writers
from palisade.streaming import drift, gateway, telemetry


def _stream(spark, folder, name):
    schema = V.table(spark, folder, name).schema
    # The table's own path as a pattern, which may be one file or a folder of them.
    return spark.readStream.schema(schema).parquet(f"{folder}/[{name[0]}]{name[1:]}.parquet")


@query(TRIPLE_LOCK)
def stream_gateway(spark, folder):
    gated = gateway.stream_gateway(_stream(spark, folder, "documents"), V.REGISTRY)
    shown = display_rows(gated).select(
        "doc_id", "shown_text", "shown_clean", "violations", "safety_status", "faithfulness_score"
    )
    path = scratch_path(spark, "gateway")
    run = gateway.to_parquet(shown, path, scratch_path(spark, "gateway-state"))
    run.awaitTermination()
    return spark.read.parquet(path)


@query(f"""WITH {P.hits_cte('doc_id, source')},
n AS (SELECT count(*) AS n_docs FROM documents),
per_text AS (
{' UNION ALL '.join(f"SELECT doc_id, source, '{p.label}' AS label, len(m_{p.label}) AS n FROM hits WHERE len(m_{p.label}) > 0" for p in V.REGISTRY)})
SELECT strftime(date_trunc('day', e.ts), '%Y-%m-%d %H:%M:%S') AS window_start, t.source, t.label,
       count(*) AS n_texts, CAST(sum(t.n) AS BIGINT) AS n_matches
FROM events e, n JOIN per_text t ON t.doc_id = e.event_id % n.n_docs GROUP BY ALL""")
def pii_telemetry(spark, folder):
    """Events that each send one text.

    The matches per text are written once as a narrow table, so that a micro-batch joins
    counts and never searches the texts again.
    """
    V.events(spark, folder)
    documents = V.texts(spark, folder)
    n_docs = documents.count()
    hits = documents.select("doc_id", "source", find_hits(F.col("text"), V.REGISTRY).alias("h"))
    per_label = F.array(
        *[F.struct(F.lit(p.label).alias("label"), F.size(F.col("h")[p.label]).alias("n")) for p in V.REGISTRY]
    )
    counts = scratch_path(spark, "counts")
    hits.select("doc_id", "source", F.inline(F.filter(per_label, lambda x: x["n"] > 0))).write.parquet(counts)
    per_text = spark.read.parquet(counts)
    sent = _stream(spark, folder, "events").select(
        F.col("ts").cast("timestamp").alias("ts"), (F.col("event_id") % n_docs).alias("doc_id")
    )
    windows = telemetry.pii_telemetry(sent.join(per_text, "doc_id"))
    path = scratch_path(spark, "telemetry")
    run = telemetry.to_snapshots(windows, path, scratch_path(spark, "telemetry-state"))
    run.awaitTermination()
    return telemetry.latest(spark.read.parquet(path))


@query(f"""WITH {V.RUNS},
means AS (SELECT model, date_trunc('day', ts) AS d, avg(final_score) AS m FROM runs GROUP BY ALL),
moved AS (SELECT *, m - lag(m) OVER (PARTITION BY model ORDER BY d) AS c FROM means)
SELECT model, strftime(d, '%Y-%m-%d') AS day, CAST(printf('%.6f', m) AS DOUBLE) AS mean_score,
       CASE WHEN c IS NOT NULL THEN CAST(printf('%.6f', c) AS DOUBLE) END AS drift FROM moved""")
def score_drift(spark, folder):
    scores = V.runs(spark, folder).select("ts", "model", F.col("final_score").alias("score"))
    return drift.score_drift(scores)


@query(POLICY_GATEWAY.replace("SELECT doc_id, policy AS policy_name", "SELECT 2 AS policy_version, doc_id, policy AS policy_name"))
def stream_policy_gateway(spark, folder):
    """The policy gateway on a stream, under the second of two versions of the policy table."""
    versions = scratch_path(spark, "policy-versions")
    lax = [(name, [], [], topics, 2.0, entities) for name, _, _, topics, _, entities in V.POLICIES]
    writers.append_policies(V.policies(spark, lax), versions, 1)
    writers.append_policies(V.policies(spark), versions, 2)
    n = F.col("doc_id")
    named = F.when(n % 11 == 0, F.lit(None)).when(n % 13 == 0, F.lit("gone")).otherwise(F.col("lang"))
    known = V.vectors(spark, folder).select(F.col("chunk_id").alias("doc_id"), "vector")
    texts = _stream(spark, folder, "documents").select("doc_id", "text", named.alias("policy_name"))
    topics = V.topics(spark, folder).select("topic", "vector")
    path = scratch_path(spark, "gated")
    run = gateway.stream_policies(
        texts.join(known, "doc_id", "left"), versions, topics, path, scratch_path(spark, "gated-state")
    )
    run.awaitTermination()
    return spark.read.parquet(path).select(
        "doc_id", "policy_name", "policy_version", "scrubbed", "keyword_check", "semantic_check", "final_verdict", "blocked"
    )
