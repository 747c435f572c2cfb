"""Embedding a table of texts with a function the user brings."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palisade.session import scratch_path, settled


def embed_distinct(
    df: DataFrame,
    embed: Callable[[pa.Array], pa.Array],
    text: str = "text",
    out: str = "vector",
    known: DataFrame | None = None,
) -> DataFrame:
    """Add `text_hash` and the vector of each text, calling `embed` once for each different text.

    `embed` takes an Arrow array of texts and gives an array of double lists of the same length.  Texts are
    told apart by their SHA-256; a null one is not embedded and has a null vector.  `known` is
    (text_hash, vector), such as the vector store: texts in it are not embedded again.  What is
    embedded is written to the shared folder first, so that a lost executor or a second use
    of the result does not pay for it again; the rows then meet their vectors by hash, and a text that
    very many rows share is split where the rows are joined, not where it is embedded.
    """
    function = F.arrow_udf(lambda texts: embed(texts), "array<double>")
    keyed = df.withColumn("text_hash", F.sha2(text, 256))
    once = keyed.where(F.col(text).isNotNull()).groupBy("text_hash").agg(F.any_value(text).alias("_text"))
    if known is not None:
        stored = known.groupBy("text_hash").agg(F.any_value("vector").alias(out))
        once = once.join(stored.select("text_hash"), "text_hash", "left_anti")
    vectors = once.select("text_hash", function("_text").alias(out))
    path = scratch_path(df.sparkSession, "embedded")
    vectors.write.parquet(path)
    vectors = df.sparkSession.read.schema(vectors.schema).parquet(path)
    if known is not None:
        vectors = vectors.unionByName(stored.withColumn(out, F.col(out).cast("array<double>")))
    others = [c for c in df.columns if c not in ("text_hash", out)]
    return keyed.select(*others, "text_hash").join(settled(vectors), "text_hash", "left").select(*others, "text_hash", out)
