"""Stress audits of a knowledge base, for all documents in one job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palisade.fixed_values import MISSING_QUESTION, STALE_TEMPLATE, TOP_K
from palisade.operators.audits import admitted_ignorance, with_override
from palisade.operators.retrieval import retrieve_topk


def stale_texts(documents: DataFrame, overrides: DataFrame) -> DataFrame:
    """The outdated text to inject per document: its own, or the template with its title."""
    default = F.format_string(STALE_TEMPLATE, F.col("title"))
    return with_override(documents, overrides, default, "stale_text")


def probe_questions(documents: DataFrame, overrides: DataFrame) -> DataFrame:
    """The out-of-scope question per document: its own, or the common one."""
    return with_override(documents, overrides, F.lit(MISSING_QUESTION), "probe")


def missing_source_audit(
    probes: DataFrame,
    chunks: DataFrame,
    answers: DataFrame,
    k: int = TOP_K,
    metric: str = "l2sq",
    keep: list[str] | None = None,
) -> DataFrame:
    """Did the answer to an out-of-scope question admit ignorance?

    The distance of the best chunk shows how weak the retrieval was.  `probes` is
    (query_id, collection, vector), `answers` is (query_id, collection, answer) and the columns to keep.
    """
    best = (
        retrieve_topk(probes, chunks, k, metric)
        .groupBy("collection", "query_id")
        .agg(F.min("distance").alias("best_distance"), F.count("*").alias("n_retrieved"))
    )
    return (
        answers.select(
            "collection",
            "query_id",
            *(keep or []),
            admitted_ignorance(F.col("answer")).alias("admitted_ignorance"),
        )
        .join(best, ["collection", "query_id"], "left")
    )
