"""Approximate nearest neighbours by cosine: probed lists and an adaptive dimension scan.

Vectors are made unit vectors and rotated at random, which spreads a distance evenly over the
dimensions.  k-means lists are fitted on a bounded sample and hold every row.  A query
scans its nearest list first, which gives it a threshold, then its other lists: distances grow block of
columns by block of columns, and after each block a hypothesis test abandons the candidates whose partial
distance is already too large to end below the threshold.  Survivors are scored on the
original vectors.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palisade.llm.common import materialize
from palisade.llm.vectors import by_length, keep_best, usable

TOP = 5
# Vectors the lists are fitted on, at most about, and lists.
SAMPLE = 16_384
LISTS = 4096
# A query scans this share of the lists, and LEAST_PROBES at least.
PROBE_SHARE = 0.6
LEAST_PROBES = 12
COLUMNS = 8
# Width of the test: a candidate is abandoned when it is this many deviations too far.
EPSILON = 2.1
# Rows and queries of one group, and pairs worked on at a time.
GROUP = 20_000
PAIRS = 500_000


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that no square overflows or vanishes."""
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def rotation(dim: int, seed: int = 13) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))[0]


def fit_lists(sample: np.ndarray, n: int, steps: int = 10, seed: int = 5) -> np.ndarray:
    """Centres of n lists by k-means on directions."""
    r = np.random.default_rng(seed)
    centre = sample[r.choice(len(sample), min(n, len(sample)), replace=False)]
    for _ in range(steps):
        label = (sample @ centre.T).argmax(1)
        total = np.stack([np.bincount(label, column, len(centre)) for column in sample.T], 1)
        length = np.sqrt((total * total).sum(1, keepdims=True))
        centre = np.where(length > 1e-12, total / np.maximum(length, 1e-12), centre)
    return centre


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of row pairs in double precision; rows are scaled by a power of two first, which
    changes no digit of the result."""
    scale = lambda x: x / np.exp2(np.floor(np.log2(np.abs(x).max(1, keepdims=True))))
    a, b = scale(a), scale(b)
    return (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))


def scan(queries: np.ndarray, threshold: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, row) of unit vectors that the tests leave: squared distance by blocks."""
    dim = queries.shape[1]
    q = r = distance = None
    for a in range(0, dim, COLUMNS):
        b = min(dim, a + COLUMNS)
        x, y = queries[:, a:b], rows[:, a:b]
        if q is None:
            d = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)
            limit = threshold * (b / dim) * (1 + EPSILON / math.sqrt(b)) ** 2 if b < dim else threshold + 1e-9
            q, r = np.nonzero(d <= limit[:, None])
            distance = d[q, r]
            continue
        diff = x[q] - y[r]
        distance = distance + (diff * diff).sum(1)
        near = threshold[q]
        limit = near * (b / dim) * (1 + EPSILON / math.sqrt(b)) ** 2 if b < dim else near + 1e-9
        keep = distance <= limit
        q, r, distance = q[keep], r[keep], distance[keep]
    return q, r


def compare(turn: np.ndarray, k: int):
    """A cogroup function: the probing queries of a list and its rows, k best pairs each."""

    def run(asked: pa.Table, held: pa.Table) -> pa.Table:
        parts = []
        if asked.num_rows and held.num_rows:
            table = lambda t: next(by_length(t.select(["v"]).combine_chunks().to_batches()[0], 0))[1]
            left, right = table(asked), table(held)
            rows = unit(right) @ turn
            ids = held["vid"].to_numpy()
            query_ids, threshold = asked["vid"].to_numpy(), asked["threshold"].to_numpy()
            step = max(1, PAIRS // len(rows))
            for a in range(0, len(left), step):
                part = left[a : a + step]
                q, r = scan(unit(part) @ turn, threshold[a : a + step], rows)
                for s in range(0, len(q), PAIRS):
                    x, y = q[s : s + PAIRS], r[s : s + PAIRS]
                    parts.append(keep_best(x + a, cosine(part[x], right[y]), ids[y], k))
        if not parts:
            return pa.table({"vid": pa.array([], pa.int64()), "near": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        q, score, near = keep_best(*(np.concatenate(x) for x in zip(*parts)), k)
        return pa.table({"vid": query_ids[q], "near": near, "score": score})

    return run


def _sized(column: str, counts: dict[int, int]):
    """How many blocks of GROUP each list needs; the map has one entry per list at most."""
    pairs = [x for key, n in counts.items() if n > GROUP for x in (F.lit(key), F.lit(-(-n // GROUP)))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(column)), F.lit(1)) if pairs else F.lit(1)


def _search_length(base: DataFrame, asked: DataFrame, k: int, probe_share: float, least_probes: int, sample: int) -> DataFrame:
    """(vid, near, score) for the distinct vectors of one length."""
    n = base.count()
    share = min(1.0, sample / max(1, n))
    drawn = base.where(F.pmod(F.xxhash64("vid", F.lit(3)), F.lit(1_000_000)) < math.ceil(share * 1e6)).limit(2 * sample)
    found = drawn.select("v").toArrow()
    if not found.num_rows:
        found = base.select("v").limit(1).toArrow()
    matrix = next(by_length(found.combine_chunks().to_batches()[0], 0))[1]
    turn = rotation(matrix.shape[1])
    lists = max(1, min(LISTS, math.isqrt(n), len(matrix)))
    centre = fit_lists(unit(matrix) @ turn, lists)
    probes = min(len(centre), max(least_probes, math.ceil(probe_share * len(centre))))

    def assign(n_lists):
        def run(batches):
            for batch in batches:
                rows = next(by_length(batch, 1), (None, np.zeros((0, len(turn)))))[1]
                if len(rows):
                    near = unit(rows) @ turn @ centre.T
                    if n_lists == 1:
                        chosen = near.argmax(1)[:, None]
                    else:
                        chosen = np.argsort(-near, axis=1, kind="stable")[:, :n_lists]
                    ends = pa.array(np.arange(len(rows) + 1) * chosen.shape[1], pa.int32())
                    lists = pa.ListArray.from_arrays(ends, pa.array(chosen.ravel(), pa.int32()))
                    yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "lists"])

        return run

    kind = base.schema["v"].dataType.simpleString()
    index = materialize(
        base.select("vid", "v").mapInArrow(assign(1), f"vid long, v {kind}, lists array<int>").select("vid", "v", F.col("lists")[0].alias("list")), "lists"
    )
    probing = materialize(asked.select("vid", "v").mapInArrow(assign(probes), f"vid long, v {kind}, lists array<int>"), "probes")
    held = dict(index.groupBy("list").count().collect())

    def search(pairs: DataFrame) -> DataFrame:
        """`pairs` is (vid, v, threshold, list)."""
        asks = dict(pairs.groupBy("list").count().collect())
        upto = lambda n: F.explode(F.sequence(F.lit(0), (n - 1).cast("int")))
        left = pairs.withColumn("qs", F.pmod(F.xxhash64("vid"), _sized("list", asks)).cast("int")).withColumn("rs", upto(_sized("list", held)))
        right = index.withColumn("rs", F.pmod(F.xxhash64("vid"), _sized("list", held)).cast("int")).withColumn("qs", upto(_sized("list", asks)))
        keys = ["list", "qs", "rs"]
        near = left.groupBy(keys).cogroup(right.groupBy(keys)).applyInArrow(compare(turn, k), "vid long, near long, score double")
        return near

    def best(df: DataFrame) -> DataFrame:
        order = Window.partitionBy("vid").orderBy(F.desc("score"), "near")
        return df.withColumn("n", F.row_number().over(order)).where(f"n <= {k}").drop("n")

    home = materialize(
        best(search(probing.select("vid", "v", F.lit(8.0).alias("threshold"), F.col("lists")[0].alias("list")))), "home"
    )
    reached = home.groupBy("vid").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
    # Squared distance of unit vectors at the k-th best cosine so far.
    threshold = F.when(F.col("n") >= k, 2 - 2 * F.col("least")).otherwise(8.0)
    rest = probing.where(F.size("lists") > 1).join(reached, "vid", "left").select(
        "vid", "v", F.coalesce(threshold, F.lit(8.0)).alias("threshold"), F.explode(F.slice("lists", 2, probes)).alias("list")
    )
    return best(home.unionByName(search(rest)))


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = TOP, id_col: str = "vec_id", vector: str = "embedding",
    probe_share: float = PROBE_SHARE, least_probes: int = LEAST_PROBES, sample: int = SAMPLE,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of largest cosine found for each query.

    A query's own rows are those of its id; candidates have vectors of its length.  Ties go to the smaller
    id.  Null, zero or non-finite vectors and rows without an id take no part.  Equal vectors are
    searched once, under their smallest ids (k + 1 of them, all that any result can
    show), so a vector however common is one candidate; repeated rows of an id count once.
    """
    pick = lambda df: df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector).alias("v")).where(
        F.col("vec_id").isNotNull() & usable("v", zero=False)
    )
    # Few rows of each vector pass: the limit is applied in the tasks before the shuffle.
    smallest = Window.partitionBy("v").orderBy("vec_id")
    few = pick(vectors).withColumn("n", F.dense_rank().over(smallest)).where(f"n <= {k + 1}")
    base = materialize(
        few.groupBy("v").agg(F.sort_array(F.collect_set("vec_id")).alias("ids")).select(F.col("ids")[0].alias("vid"), "ids", "v").withColumn("width", F.size("v")),
        "vectors",
    )
    asked = materialize(pick(queries).distinct().join(base.select("vid", "v"), "v"), "asked")
    names = asked.groupBy("vid").agg(F.first("v").alias("v")).withColumn("width", F.size("v"))
    widths = [r[0] for r in names.select("width").distinct().collect()]
    found = vectors.sparkSession.createDataFrame([], "vid long, near long, score double")
    for width in sorted(widths):
        one = _search_length(base.where(F.col("width") == width), names.where(F.col("width") == width), k + 1, probe_share, least_probes, sample)
        found = found.unionByName(one)
    hits = found.join(base.select(F.col("vid").alias("near"), "ids"), "near").select("vid", "score", F.explode("ids").alias("id"))
    hits = hits.join(asked.select(F.col("vec_id").alias("query_id"), "vid").distinct(), "vid").where("id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", F.col("id").alias("vec_id"), "score"
    )
