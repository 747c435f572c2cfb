"""Question -> nearest chunks -> grounded prompt -> messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palisade.fixed_values import FORCED_SYSTEM, GROUNDED_SYSTEM, HONEST_SYSTEM, TOP_K
from palisade.operators.retrieval import (
    build_messages,
    rag_prompt,
    retrieve_topk,
    with_chunk_text,
)


def grounded_prompts(
    questions: DataFrame, chunks: DataFrame, k: int = TOP_K, metric: str = "l2sq"
) -> DataFrame:
    """`questions` is (query_id, collection, question, vector); `chunks` adds text and page_num.

    Only ids and vectors are scanned for the search; texts are read for what it found.
    """
    top = with_chunk_text(retrieve_topk(questions, chunks, k, metric), chunks)
    asked = questions.select("query_id", "collection", "question")
    return rag_prompt(top, asked)


def grounded_messages(prompts: DataFrame) -> DataFrame:
    return prompts.withColumn(
        "messages", build_messages(F.lit(GROUNDED_SYSTEM), F.col("prompt"))
    )


def baseline_messages(questions: DataFrame) -> DataFrame:
    """Each question once per mode: the honest and the forced system prompt."""
    modes = F.array(
        F.struct(F.lit("honest").alias("mode"), F.lit(HONEST_SYSTEM).alias("system")),
        F.struct(F.lit("forced").alias("mode"), F.lit(FORCED_SYSTEM).alias("system")),
    )
    return (
        questions.select("doc_id", "question_id", "question", F.inline(modes))
        .withColumn("messages", build_messages(F.col("system"), F.col("question")))
        .drop("system", "question")
    )
