"""Exact top-k by inner product in three phases with one uniform threshold.

A score is a sum of partial scores, one per block of columns.  Phase 1: every task gathers,
for each query, the best rows of each block's list and scores them in full; the k-th best of all of them is a
safe cutoff.  Phase 2: the cutoff goes back to the tasks; a row whose partial scores, above the
least of their block, are all below an equal part of the cutoff can't reach it, so only
the others are collected, and of these the ones whose upper bound reaches it.  Phase 3: what
remains is scored exactly and the k best of a task leave it.

Rows stay where they are read; queries come in blocks of bounded size, one round each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palisade.llm.vectors import by_length, keep_best, query_blocks, usable

TOP = 5
COLUMN_BLOCKS = 4
SCALE = 256
# Numbers of one block of queries (32 MB), and pairs of a query and a row worked on at a time.
QUERY_CELLS = 4_000_000
PAIRS = 500_000
_EXACT = float(2**53)
_LONG = 2**63 - 1


def quantized(rows: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * rows)


def partial_scores(queries: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """Inner products over each block of columns, exact whole numbers.

    Doubles are exact below 2**53; where a sum could pass that, whole numbers of any size are used.
    """
    dim = queries.shape[1]
    most = np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * max(1, dim)
    if not most < _EXACT:
        whole = np.frompyfunc(int, 1, 1)
        queries, rows = whole(queries), whole(rows)
    edges = np.linspace(0, dim, COLUMN_BLOCKS + 1).astype(int)
    return [queries[:, a:b] @ rows[:, a:b].T for a, b in zip(edges[:-1], edges[1:]) if b > a] or [
        np.zeros((len(queries), len(rows)))
    ]


class Block:
    """The queries of one round, by vector length."""

    def __init__(self, ids: np.ndarray, groups: dict[int, tuple[np.ndarray, np.ndarray]]):
        self.ids, self.groups = ids, groups

    @classmethod
    def of(cls, found: pa.Table) -> Block:
        batch = found.combine_chunks().to_batches()[0]
        return cls(
            np.array(batch.column(0).to_pylist(), np.int64),
            {m.shape[1]: (rows, quantized(m)) for rows, m in by_length(batch, 1)},
        )

    def pieces(self, batch: pa.RecordBatch):
        """(query numbers, partial scores, ids of the rows, own) in pieces of bounded size."""
        ids = np.array(batch.column(0).to_pylist(), np.int64)
        for rows, matrix in by_length(batch, 1):
            if matrix.shape[1] not in self.groups:
                continue
            asked, queries = self.groups[matrix.shape[1]]
            matrix = quantized(matrix)
            step = max(1, PAIRS // max(1, min(len(rows), 1024)))
            for r in range(0, len(rows), 1024):
                for q in range(0, len(asked), step):
                    here = ids[rows[r : r + 1024]]
                    own = self.ids[asked[q : q + step]][:, None] == here[None, :]
                    yield asked[q : q + step], partial_scores(queries[q : q + step], matrix[r : r + 1024]), here, own


def local_lists(block: Block, k: int):
    """Phase 1 of one task: rows (query number, score) of its k best gathered scores."""

    def run(batches):
        best: list[list] = [[] for _ in block.ids]
        for batch in batches:
            for asked, partial, here, own in block.pieces(batch):
                total = sum(partial)
                picked = np.zeros(own.shape, bool)
                for p in partial:
                    if p.shape[1] > k + 1:
                        top = np.argpartition(-p, k, axis=1)[:, : k + 1]
                        np.put_along_axis(picked, top, True, axis=1)
                    else:
                        picked[:] = True
                picked &= ~own
                for row, q in enumerate(asked.tolist()):
                    scores = total[row, picked[row]].tolist()
                    if scores and (len(best[q]) < k or max(scores) > best[q][-1]):
                        best[q] = sorted(best[q] + scores, reverse=True)[:k]
        number = [q for q, scores in enumerate(best) for _ in scores]
        # Rounded down, so that a cutoff beyond exact doubles stays safe.
        flat = [np.nextafter(float(s), -np.inf) if abs(s) >= _EXACT else float(s) for scores in best for s in scores]
        yield pa.RecordBatch.from_arrays([pa.array(number, pa.int32()), pa.array(flat, pa.float64())], names=["q", "score"])

    return run


def sufficient(block: Block, cutoff: np.ndarray, k: int):
    """Phases 2 and 3 of one task: its k best rows per query of those that may reach the cutoff."""

    def run(batches):
        best = None
        for batch in batches:
            parts = [] if best is None else [best]
            for asked, partial, here, own in block.pieces(batch):
                tau = cutoff[asked]
                low = [p.min(axis=1).astype(float) for p in partial]
                # Partial scores count from the least of their block in this piece.
                share = np.where(np.isfinite(tau), tau - sum(low), -np.inf) / len(partial)
                seen = [p - l[:, None] >= s[:, None] for p, l, s in zip(partial, low, np.broadcast_to(share, (len(partial), len(share))))]
                entries = np.logical_or.reduce(seen) & ~own
                q, r = np.nonzero(entries)
                bound = sum(np.where(s[q, r], (p[q, r] - l[q]).astype(float), share[q]) for p, l, s in zip(partial, low, seen))
                reach = bound >= share[q] * len(partial)
                q, r = q[reach], r[reach]
                exact = sum(p[q, r] for p in partial)
                good = exact >= tau[q]
                parts.append((asked[q[good]], exact[good], here[r[good]]))
            if parts:
                best = keep_best(*(np.concatenate(x) for x in zip(*parts)), k)
        if best is not None:
            scores = [max(-_LONG - 1, min(_LONG, int(s))) for s in best[1].tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.ids[best[0]], pa.int64()), pa.array(best[2], pa.int64()), pa.array(scores, pa.int64())],
                names=["query_id", "vec_id", "score"],
            )

    return run


def exact_topk(
    vectors: DataFrame, queries: DataFrame, k: int = TOP, id_col: str = "vec_id", vector: str = "embedding", cells: int = QUERY_CELLS
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest inner products of floor(256 * x).

    Candidates are all rows with another id and a vector of the query's length; ties go to the smaller id.  Vectors
    that are null or hold null or non-finite components, and rows without an id, take no part.
    Repeated rows are candidates each; a repeated query id asks once, with its smallest vector.
    A score no long can hold is reported as the nearest long.  Other columns are not read.
    """
    pick = lambda df: df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector).alias("v")).where(
        F.col("vec_id").isNotNull() & usable("v")
    )
    rows, asked = pick(vectors), pick(queries)
    spark = vectors.sparkSession
    out = spark.createDataFrame([], "query_id long, vec_id long, score long")
    for found in query_blocks(asked, "vec_id", "v", cells):
        block = Block.of(found)
        lists = rows.mapInArrow(local_lists(block, k), "q int, score double")
        ranked = lists.withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score")))).where(f"n <= {k}")
        safe = ranked.groupBy("q").agg(F.min("score").alias("score"), F.count(F.lit(1)).alias("n")).where(f"n = {k}").toArrow()
        cutoff = np.full(len(block.ids), -np.inf)
        cutoff[safe["q"].to_numpy()] = safe["score"].to_numpy()
        out = out.unionByName(rows.mapInArrow(sufficient(block, cutoff, k), "query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
