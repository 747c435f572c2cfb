"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

`python bench.py all` times every named query.  A query is run once to warm up and once
timed, into a sink that discards the rows.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from palisade.catalog import all_queries

HEADLINE = [
    "triple_lock", "redact_coding", "pii_by_source", "circuit_breaker", "scrub_text",
    "mask_entities", "rule_gate", "rule_join", "semantic_gate", "layered_gate",
    "setup_benchmark", "eval_metrics", "p95_latency", "detail_pivot", "score_run",
    "final_score", "summary_cards", "model_heatmap", "composite_score", "pareto_frontier",
    "chunk_pages", "chunk_quality", "retrieve_topk", "rag_prompt", "stale_audit",
    "cost_rollup", "blueprint_cache", "stream_gateway", "pii_telemetry",
]
# What a query reads, for rows per second.
INPUTS = {
    "triple_lock": "documents", "redact_coding": "documents", "pii_by_source": "documents",
    "circuit_breaker": "documents", "scrub_text": "documents", "mask_entities": "documents",
    "rule_gate": "documents", "rule_join": "documents", "layered_gate": "documents",
    "semantic_gate": "embeddings", "retrieve_topk": "embeddings", "chunk_pages": "documents",
    "final_score": "events", "pareto_frontier": "events", "composite_score": "events",
    "setup_benchmark": "labels", "eval_metrics": "labels", "stream_gateway": "documents",
}


def session() -> SparkSession:
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    return spark


def run(build, spark: SparkSession, folder: str) -> float:
    start = time.perf_counter()
    build(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    registered = all_queries()
    wanted = sys.argv[1:] or HEADLINE
    names = list(registered) if wanted == ["all"] else wanted
    spark = session()
    sizes = {t: spark.read.parquet(f"{folder}/{t}.parquet").count() for t in set(INPUTS.values())}
    seconds, rates = {}, {}
    for name in names:
        run(registered[name].build, spark, folder)
        seconds[name] = round(run(registered[name].build, spark, folder), 3)
        if name in INPUTS:
            rates[name] = round(sizes[INPUTS[name]] / seconds[name])
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows_per_sec": rates,
                "sf": folder.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
