"""Exact nearest-chunk search, the persisted vector table and grounded prompts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palisade.fixed_values import EMBED_BATCH, TOP_K
from palisade.functions.formatting import fixed, rounded
from palisade.operators import kernels as K
from palisade.operators.ordering import numbered
from palisade.session import settled

# A query matrix is shipped to tasks only up to this many rows and numbers (64 MB).
SHIPPED_ROWS = 4096
MATRIX_CELLS = 8_000_000
# Rows per side of one block when both sides are too large to ship.
BLOCK_ROWS = 20_000


def retrieve_topk(
    queries: DataFrame,
    chunks: DataFrame,
    k: int = TOP_K,
    metric: str = "l2sq",
    shipped_rows: int = SHIPPED_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(collection, query_id, rank, chunk_id, distance): the k nearest chunks of each query,
    the distance rounded to four places.  See `nearest_chunks`."""
    near = nearest_chunks(queries, chunks, k, metric, shipped_rows, block_rows)
    return near.withColumn("distance", rounded(F.col("exact"), 4)).drop("exact")


def nearest_chunks(
    queries: DataFrame,
    chunks: DataFrame,
    k: int = TOP_K,
    metric: str = "l2sq",
    shipped_rows: int = SHIPPED_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(collection, query_id, rank, chunk_id, exact): ranked by the unrounded distance, then by id.

    `queries` is (query_id, collection, vector), `chunks` is (chunk_id, collection,
    vector).  Ids are unique within a collection and may repeat in another; a query only
    sees its own collection, and k rows at most leave a task per query.  Up to `shipped_rows` queries go to the chunks, which are scanned where
    they lie and not shuffled.  Beyond that both sides of a collection are cut into
    blocks by a hash of the id and each pair of blocks is one bounded group.
    """
    asked = queries.select("query_id", "collection", "vector").where("vector is not null")
    corpus = chunks.select("chunk_id", "collection", "vector").where("vector is not null")
    schema = T.StructType(
        [
            T.StructField("collection", asked.schema["collection"].dataType),
            T.StructField("query_id", asked.schema["query_id"].dataType),
            T.StructField("chunk_id", corpus.schema["chunk_id"].dataType),
            T.StructField("exact", T.DoubleType()),
        ]
    )
    sent = ship(asked, shipped_rows)
    if sent is not None:
        scan = K.scan_for_nearest(
            sent["query_id"].combine_chunks(),
            sent["collection"].combine_chunks(),
            K.matrix(sent["vector"]),
            k,
            metric,
        )
        near = corpus.mapInArrow(scan, schema)
    else:
        near = _by_blocks(asked, corpus, k, metric, schema, block_rows)
    return _ranked(near, k).select("collection", "query_id", "rank", "chunk_id", "exact")


def _ranked(near: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("collection", "query_id").orderBy("exact", "chunk_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def merge_nearest(base: DataFrame, added: DataFrame, k: int = TOP_K) -> DataFrame:
    """The k nearest chunks of two results of `nearest_chunks` over different chunks, ranked anew.
    Neither corpus is read: k rows a query of each side are all that can be among the k of both."""
    return _ranked(base.drop("rank").unionByName(added.drop("rank")), k)


def ship(df: DataFrame, rows: int):
    """A small vector table as Arrow, or None when it is too large to send to tasks."""
    sent = df.limit(rows + 1).toArrow()
    numbers = len(sent["vector"].combine_chunks().flatten())
    return sent if sent.num_rows <= rows and numbers <= MATRIX_CELLS else None


def _by_blocks(asked, corpus, k, metric, schema, block_rows) -> DataFrame:
    left, right = tiles(asked, corpus, block_rows)
    keys = ["collection", "_q", "_c"]
    compare = K.compare_blocks(k, metric)
    return left.groupBy(keys).cogroup(right.groupBy(keys)).applyInArrow(compare, schema)


def tiles(asked: DataFrame, corpus: DataFrame, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """Both sides cut into blocks by a hash of the id, each row copied once for every block of the other
    side of its own collection: `_q` and `_c` name a pair of blocks.  A collection's number of
    blocks comes from its own rows, so a small one is never cut, and rows of a collection
    that the other side lacks go."""

    def blocks(df: DataFrame, out: str) -> DataFrame:
        counts = df.groupBy("collection").agg(F.count(F.lit(1)).alias("_n"))
        return counts.select("collection", F.ceil(F.col("_n") / block_rows).cast("int").alias(out))

    plan = settled(blocks(asked, "_nq").join(blocks(corpus, "_nc"), "collection"))

    def copied(df: DataFrame, key: str, own: str, other: str, own_n: str, other_n: str) -> DataFrame:
        cut = df.join(plan, "collection").withColumn(own, F.pmod(F.xxhash64(key), F.col(own_n)).cast("int"))
        every = F.sequence(F.lit(0), F.col(other_n) - 1)
        return cut.withColumn(other, F.explode(every)).drop("_nq", "_nc")

    return (
        copied(asked, "query_id", "_q", "_c", "_nq", "_nc"),
        copied(corpus, "chunk_id", "_c", "_q", "_nc", "_nq"),
    )


def with_chunk_text(top: DataFrame, chunks: DataFrame) -> DataFrame:
    """Attach text, page and whatever else `chunks` holds to the few rows retrieved."""
    return top.join(chunks.drop("vector"), ["collection", "chunk_id"], "left")


def rag_prompt(top: DataFrame, questions: DataFrame) -> DataFrame:
    """One grounded prompt per question from its ranked (rank, page_num, distance, text).

    Questions and what was found for them meet by (collection, query_id).
    """
    key = ["collection", "query_id"]
    block = F.concat(
        F.lit("[Source "),
        F.col("rank").cast("string"),
        F.lit(" — Page "),
        F.col("page_num").cast("string"),
        F.lit(" | Distance: "),
        F.regexp_replace(fixed(F.col("distance"), 4), r"(\.\d+?)0+$", "$1"),
        F.lit("]\n"),
        F.col("text"),
    )
    context = (
        top.select(*key, "rank", block.alias("block"))
        .groupBy(*key)
        .agg(F.array_sort(F.collect_list(F.struct("rank", "block"))).alias("blocks"))
        .select(
            *key,
            F.array_join(F.transform("blocks", lambda b: b["block"]), "\n\n").alias("context"),
        )
    )
    prompt = F.concat(
        F.lit("CONTEXT FROM DOCUMENT:\n"),
        F.coalesce("context", F.lit("")),
        F.lit("\n\nQUESTION:\n"),
        F.col("question"),
        F.lit("\n\nAnswer using only the context above. Cite page numbers."),
    )
    return questions.join(context, key, "left").withColumn("prompt", prompt).drop("context")


def build_messages(system, user):
    """A two-message conversation as an array column."""
    return F.array(
        F.struct(F.lit("system").alias("role"), system.alias("content")),
        F.struct(F.lit("user").alias("role"), user.alias("content")),
    )


def embed_pending(chunks: DataFrame, stored: DataFrame) -> DataFrame:
    """Chunks whose current text is not stored yet: a half-finished load is completed
    and an edited chunk is embedded again."""
    key = ["collection", "chunk_id", "text_hash"]
    hashed = chunks.withColumn("text_hash", F.sha2("text", 256))
    return hashed.join(stored.select(*key), key, "left_anti")


def embed_batches(
    rows: DataFrame, group: str, order: str, size: int = EMBED_BATCH
) -> DataFrame:
    """Number the rows of each group from 0 by `order` and cut them into batches."""
    placed = numbered(rows, [group], [order], "seq")
    return placed.withColumn("batch", F.floor(F.col("seq") / size))
