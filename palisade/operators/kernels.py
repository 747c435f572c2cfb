"""Numpy kernels that Spark calls once per Arrow batch.

A kernel compares the batch it is given with one bounded matrix and returns at most
k rows per row of that matrix; all partitioning, shuffling and merging is Spark's.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# Rows of a batch compared in one step: keeps the score block small.
STEP = 1024


def matrix(vectors: pa.Array) -> np.ndarray:
    """A list column without nulls as rows of doubles."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = np.asarray(vectors.flatten(), dtype=np.float64)
    return flat.reshape(len(vectors), -1) if len(vectors) else flat.reshape(0, 0)


def unit(rows: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)


def distances(queries: np.ndarray, rows: np.ndarray, metric: str) -> np.ndarray:
    """Distances, rounded far below what is shown so that equal rows tie exactly."""
    if metric == "cosine":
        out = 1.0 - unit(queries) @ unit(rows).T
    elif metric == "ip":
        out = 1.0 - queries @ rows.T
    elif metric == "l2sq":
        lengths = (queries**2).sum(1)[:, None] + (rows**2).sum(1)[None, :]
        out = np.maximum(lengths - 2.0 * (queries @ rows.T), 0.0)
    else:
        raise ValueError(f"unknown metric {metric!r}")
    return np.round(out, 12)


def keep_nearest(query: np.ndarray, dist: np.ndarray, ids: np.ndarray, k: int):
    """The k nearest candidates of each query, ties broken by id."""
    order = np.lexsort((ids, dist, query))
    query, dist, ids = query[order], dist[order], ids[order]
    first = np.r_[True, query[1:] != query[:-1]] if len(query) else np.zeros(0, bool)
    starts = np.flatnonzero(first)
    rank = np.arange(len(query)) - np.repeat(starts, np.diff(np.r_[starts, len(query)]))
    near = rank < k
    return query[near], dist[near], ids[near]


def candidates(queries: np.ndarray, rows: np.ndarray, k: int, metric: str):
    """Per query (query, distance, row) of all rows as near as its k-th, step by step."""
    for start in range(0, len(rows), STEP):
        d = distances(queries, rows[start : start + STEP], metric)
        if d.shape[1] > k:
            near = d <= np.partition(d, k - 1, axis=1)[:, k - 1 : k]
        else:
            near = np.ones_like(d, dtype=bool)
        q, r = np.nonzero(near)
        yield q, d[q, r], r + start


def nearest(parts, k: int, best=None):
    """Merge (query, distance, id) candidates into the k best of each query."""
    for part in parts:
        if best is not None:
            part = tuple(np.concatenate(x) for x in zip(best, part))
        best = keep_nearest(*part, k)
    return best


def scan_for_nearest(query_ids: pa.Array, query_groups: pa.Array, query_rows, k, metric):
    """A `mapInArrow` function over batches of (chunk_id, collection, vector)."""
    members: dict = {}
    for i, group in enumerate(query_groups.to_pylist()):
        members.setdefault(group, []).append(i)
    members = {group: np.array(rows) for group, rows in members.items()}

    def parts(batch):
        groups = batch.column(1).dictionary_encode()
        codes = groups.indices.to_numpy(zero_copy_only=False)
        rows = matrix(batch.column(2))
        for code, group in enumerate(groups.dictionary.to_pylist()):
            if group not in members:
                continue
            chosen, here = members[group], np.flatnonzero(codes == code)
            for q, d, r in candidates(query_rows[chosen], rows[here], k, metric):
                # ids are only unpacked for the few candidates
                yield chosen[q], d, np.array(batch.column(0).take(pa.array(here[r])).to_pylist())

    def scan(batches):
        best = id_type = None
        for batch in batches:
            if batch.num_rows:
                id_type = batch.column(0).type
                best = nearest(parts(batch), k, best)
        if best is not None:
            found = pa.array(best[0], type=pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    query_groups.take(found),
                    query_ids.take(found),
                    pa.array(best[2].tolist(), type=id_type),
                    pa.array(best[1], type=pa.float64()),
                ],
                names=["collection", "query_id", "chunk_id", "exact"],
            )

    return scan


def compare_blocks(k: int, metric: str):
    """A cogroup function over one block of queries and one block of chunks."""

    def compare(asked: pa.Table, corpus: pa.Table) -> pa.Table:
        ids = corpus["chunk_id"].combine_chunks()
        best = None
        if asked.num_rows and corpus.num_rows:
            near = candidates(matrix(asked["vector"]), matrix(corpus["vector"]), k, metric)
            named = ((q, d, np.array(ids.take(pa.array(r)).to_pylist())) for q, d, r in near)
            best = nearest(named, k)
        if best is None:
            best = (np.zeros(0, int), np.zeros(0), np.zeros(0))
        found = pa.array(best[0], type=pa.int64())
        return pa.table(
            {
                "collection": asked["collection"].take(found),
                "query_id": asked["query_id"].take(found),
                "chunk_id": pa.array(best[2].tolist(), type=ids.type),
                "exact": pa.array(best[1], type=pa.float64()),
            }
        )

    return compare


def best_topic_of(segments: list[str], topic_names: list[str], topic_rows: np.ndarray):
    """An Arrow function: (segment, vector) columns -> (similarity, topic) of the segment's
    nearest topic; the rows of a batch meet each segment's matrix once."""
    members: dict = {}
    for i, segment in enumerate(segments):
        members.setdefault(segment, []).append(i)
    names = pa.array(topic_names, type=pa.string())
    topics = {segment: (np.array(rows), unit(topic_rows[rows])) for segment, rows in members.items()}

    def score(asked: pa.Array, vectors: pa.Array) -> pa.Array:
        size = len(vectors)
        similarity = np.zeros(size)
        which = np.zeros(size, dtype=np.int64)
        absent = np.ones(size, dtype=bool)
        present = np.flatnonzero(np.asarray(vectors.is_valid()))
        if len(present):
            rows = unit(matrix(vectors.drop_null()))
            groups = asked.take(pa.array(present)).dictionary_encode()
            codes = np.asarray(groups.indices.fill_null(-1))
            for code, segment in enumerate(groups.dictionary.to_pylist()):
                if segment in topics:
                    numbers, matrix_of = topics[segment]
                    here = codes == code
                    scores = np.round(rows[here] @ matrix_of.T, 12)
                    at = present[here]
                    which[at] = numbers[scores.argmax(axis=1)]
                    similarity[at] = scores.max(axis=1)
                    absent[at] = False
        return pa.StructArray.from_arrays(
            [pa.array(similarity, mask=absent), names.take(pa.array(which, mask=absent))],
            names=["similarity", "topic"],
        )

    return score
