"""Sinks: all of them write in parallel and none replaces what is there."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palisade.sources.readers import read_vectors


def write_runs(runs: DataFrame, path: str) -> None:
    """Add one folder of CSVs per run; fails rather than touch a run that is there.  The runs
    that are there are told by their folders, no file is opened."""
    spark = runs.sparkSession
    try:
        stored = spark.read.format("binaryFile").load(path).select(F.col("run").cast("string"))
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    else:
        again = stored.distinct().join(runs.select(F.col("run").cast("string")).distinct(), "run").first()
        if again:
            raise AnalysisException(f"run {again['run']!r} is already in {path}")
    named = runs.select(
        F.col("model").alias("Model"),
        F.col("logic").alias("Logic"),
        F.col("correctness").alias("Correctness"),
        F.col("final_score").alias("Final Score"),
        F.col("cost").alias("Cost"),
        F.col("latency").alias("Latency"),
        "run",
    )
    named.write.mode("append").option("header", True).partitionBy("run").csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("error").option("header", True).csv(path)


def write_lines(lines: DataFrame, path: str) -> None:
    """A text column as lines; meant for reports, which are small and sorted."""
    lines.write.mode("error").text(path)


def write_json_by_document(df: DataFrame, path: str, buckets: int = 64) -> None:
    """The rows of a document together in one of `buckets` folders, whatever their number."""
    bucket = F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int")
    df.withColumn("bucket", bucket).repartition("bucket").write.mode("error").partitionBy("bucket").json(path)


def append_vectors(chunks: DataFrame, path: str) -> int:
    """Append embedded chunks as one load to the collection folders they belong to, and give its
    number.  A chunk whose id is stored already becomes its next version: readers take the latest
    (`readers.read_vectors`).  Loads are appended by one writer at a time."""
    spark = chunks.sparkSession
    try:
        last = spark.read.parquet(path).agg(F.max("load")).first()[0]
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        last = None
    load = 1 if last is None else last + 1
    numbered = chunks.drop("load").withColumn("load", F.lit(load))
    numbered.write.mode("append").partitionBy("load", "collection").parquet(path)
    return load


def compact_vectors(spark: SparkSession, path: str, target: str) -> None:
    """Write the latest version of every chunk to a new store, each in the load it came with, so
    that later loads may be appended there.  Superseded versions are left behind."""
    current = read_vectors(spark, path)
    current.write.mode("error").partitionBy("load", "collection").parquet(target)


def append_policies(policies: DataFrame, path: str, version: int) -> None:
    """Add a version of the policy table, a folder of its own; fails if the version is there."""
    policies.write.mode("error").json(f"{path}/version={version}")


def append_blueprints(blueprints: DataFrame, path: str) -> None:
    blueprints.write.mode("append").parquet(path)
