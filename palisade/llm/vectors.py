"""What the two vector searches share: usable rows, matrices and rounds of query blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: str, zero: bool = True) -> Column:
    """Whether a vector is there and all its components are finite (and, unless `zero`, one is not 0)."""
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    ok = x.isNotNull() & F.coalesce(finite, F.lit(False))
    return ok if zero else ok & F.exists(x, lambda v: v != 0)


def by_length(batch: pa.RecordBatch, at: int):
    """(row numbers, matrix of doubles) for each vector length in a batch."""
    column = batch.column(at)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = np.asarray(column.flatten(), np.float64)
    sizes = np.asarray(column.value_lengths())
    begin = np.cumsum(sizes) - sizes
    for n in np.unique(sizes):
        rows = np.flatnonzero(sizes == n)
        yield rows, flat[begin[rows][:, None] + np.arange(n)[None, :]]


def keep_best(query: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int):
    """The k highest scores of each query, ties to the smaller id."""
    order = np.lexsort((ids, -score, query))
    query, score, ids = query[order], score[order], ids[order]
    starts = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else np.zeros(0, np.int64)
    rank = np.arange(len(query)) - np.repeat(starts, np.diff(np.r_[starts, len(query)]))
    near = rank < k
    return query[near], score[near], ids[near]


def query_blocks(queries: DataFrame, id_col: str, vector: str, cells: int):
    """The queries (id, vector), one row per id, as Arrow tables of at most about `cells`
    numbers.  A block is fetched when its turn comes; ids with several vectors keep the smallest."""
    single = queries.groupBy(id_col).agg(F.min(vector).alias(vector))
    total = single.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size(vector)), F.lit(0))).first()
    blocks = max(1, -(-max(total[0], total[1]) // cells))
    for b in range(blocks):
        part = single if blocks == 1 else single.where(F.pmod(F.xxhash64(id_col), F.lit(blocks)) == b)
        found = part.toArrow()
        if found.num_rows:
            yield found
