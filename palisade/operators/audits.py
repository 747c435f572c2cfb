"""Knowledge-base audits: stale, missing and side-by-side answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palisade.fixed_values import ADMIT_PHRASES, TEST_RISKS, TOP_K
from palisade.functions.text import contains_any, cut, strip
from palisade.operators.retrieval import merge_nearest, nearest_chunks
from palisade.session import local_table


def admitted_ignorance(answer: Column, phrases: list[str] = ADMIT_PHRASES) -> Column:
    return contains_any(answer, phrases)


def stale_audit(
    queries: DataFrame,
    chunks: DataFrame,
    injected: DataFrame,
    k: int = TOP_K,
    metric: str = "l2sq",
    base: DataFrame | None = None,
) -> DataFrame:
    """Would an outdated chunk be retrieved?  One row per query.

    `injected` has the columns of `chunks` (chunk_id, collection, vector).  It joins the
    corpus for this search only; the stored table is not changed.  The corpus is searched as it is,
    the injected chunks by themselves, and the two lists of k are merged: so one search of the
    corpus, handed over as `base` (the result of `nearest_chunks`), serves any number of injections.
    """
    if base is None:
        base = nearest_chunks(queries, chunks, k, metric)
    added = nearest_chunks(queries, injected, k, metric)
    top = merge_nearest(
        base.withColumn("injected", F.lit(False)), added.withColumn("injected", F.lit(True)), k
    )
    found = top.groupBy("collection", "query_id").agg(
        F.bool_or("injected").alias("stale_retrieved"),
        F.min(F.when(F.col("injected"), F.col("rank"))).alias("stale_rank"),
    )
    asked = queries.select("query_id", "collection")
    return asked.join(found, ["collection", "query_id"], "left").withColumn(
        "stale_retrieved", F.coalesce("stale_retrieved", F.lit(False))
    )


def with_override(documents: DataFrame, overrides: DataFrame, default: Column, out: str) -> DataFrame:
    """A per-document text where one is given, else the default built from the row."""
    given = overrides.select("doc_id", F.col("text").alias("_given"))
    return (
        documents.join(given, "doc_id", "left")
        .withColumn(out, F.coalesce("_given", default))
        .drop("_given")
    )


def compare_modes(answers: DataFrame, cut_at: int = 120) -> DataFrame:
    """Honest and forced answers to the same question side by side, in one pass."""
    shown = strip(cut(F.col("answer"), cut_at))
    key = ["doc_id", "question_id"]
    of = lambda mode: F.max(F.when(F.col("mode") == mode, shown)).alias(mode)
    both = answers.groupBy(*key).agg(of("honest"), of("forced"))
    return both.where(F.col("honest").isNotNull() & F.col("forced").isNotNull())


def test_risks(spark: SparkSession) -> DataFrame:
    return local_table(spark, ["test", "risk", "mitigation"], TEST_RISKS)


def risk_summary(results: DataFrame, risks: DataFrame) -> DataFrame:
    """Test outcomes with the risk each stands for and how it is mitigated."""
    return (
        results.groupBy("test")
        .agg(
            F.count("*").alias("n_tests"),
            F.count_if(F.col("stale_retrieved")).alias("n_stale"),
            F.count_if(F.col("admitted_ignorance")).alias("n_admitted"),
        )
        .join(risks, "test")
    )
