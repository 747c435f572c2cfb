"""What a task gets, whatever the groups and keys are like, and what is worked out only once."""

import random

import pyarrow as pa
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from palisade.operators import audits as A
from palisade.operators import ordering as O
from palisade.operators import retrieval as R
from palisade.operators.costs import tier_prices, with_tier_model
from palisade.operators.embedding import embed_distinct
from palisade.operators.runs import pareto_frontier
from palisade.sources import writers


def sparse(spark, n):
    """One hot group with ids far apart, some negative, in no order."""
    scattered = F.xxhash64("id").alias("o")
    return spark.range(0, n, 1, 8).select(F.lit("hot").alias("g"), scattered, (F.col("id") % 7).alias("n"))


def test_sparse_ids_of_one_group_spread(spark):
    df = sparse(spark, 1_000_000)
    placed = O.sorted_by_range(df, ["g", "o"], "test")
    sizes = sorted(r["count"] for r in placed.groupBy(F.shiftright("_place", 33)).count().collect())
    assert len(sizes) > 1 and sizes[-1] <= 2 * sizes[len(sizes) // 2]


@pytest.mark.parametrize("width, group_rows", [(16, 0), (4096, 0), (4096, 100_000)])
def test_running_total_of_sparse_ids(spark, width, group_rows):
    rng = random.Random(width)
    rows = [(g, o, rng.randint(-3, 9)) for g in ("a", "b", None) for o in rng.sample(range(-(10**15), 10**15), 700)]
    df = spark.createDataFrame(rows, "g string, o long, n int").repartition(5)
    out = O.running_total(df, "g", "o", "n", "t", width, group_rows)
    assert out.columns == ["g", "o", "n", "t"]
    got = {(r["g"], r["o"]): r["t"] for r in out.collect()}
    for g in ("a", "b", None):
        total = 0
        for _, o, n in sorted((r for r in rows if r[0] == g), key=lambda r: r[1]):
            assert got[g, o] == total
            total += n
    assert O.running_total(df.limit(0), "g", "o", "n", "t").count() == 0


def test_numbers_of_a_run_of_equal_keys(spark):
    df = spark.range(0, 30_000, 1, 8).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1).alias("o"), F.lit(1).alias("g"))
    out = O.numbered(df, ["g"], ["o"], "n", "size").collect()
    assert sorted(r["n"] for r in out) == list(range(30_000)) and {r["size"] for r in out} == {30_000}
    first = sorted((r["n"], r["o"]) for r in out)
    assert [o for _, o in first] == sorted(o for _, o in first)


def test_pareto_within_one_band(spark):
    """All costs within a coarse bucket: none of the finer ones holds most rows."""
    rng = random.Random(4)
    rows = [(i, 1.0 + rng.random() * 0.01, rng.random()) for i in range(3000)]
    df = spark.createDataFrame(rows, "i int, cost double, final_score double")
    assert df.select(O.coarse_bucket(F.col("cost"))).distinct().count() == 1
    fine = df.groupBy(O.fine_bucket(F.col("cost"))).count().agg(F.max("count")).first()[0]
    assert fine < 20
    best, want = -1.0, set()
    for i, _, score in sorted(rows, key=lambda r: r[1]):
        if score > best:
            best = score
            want.add(i)
    assert {r["i"] for r in pareto_frontier(df).collect()} == want


def test_tiles_of_a_small_collection_are_not_cut(spark):
    """Copies of a row are as many as the blocks of the other side of its own collection."""
    corpus = [(i, "big" if i < 950 else "small", [float(i)]) for i in range(1000)] + [(5000, "alone", [1.0])]
    asked = [(f"q{i}", "big" if i % 2 else "small", [0.0]) for i in range(100)] + [("x", "nowhere", [1.0])]
    queries = spark.createDataFrame(asked, "query_id string, collection string, vector array<double>")
    chunks = spark.createDataFrame(corpus, "chunk_id int, collection string, vector array<double>")
    left, right = R.tiles(queries, chunks, 20)
    copies = lambda df, key: {tuple(r) for r in df.groupBy("collection", key).count().select("collection", "count").distinct().collect()}
    assert copies(left, "query_id") == {("big", 48), ("small", 3)}
    assert copies(right, "chunk_id") == {("big", 3), ("small", 3)}
    assert R.tiles(queries.limit(0), chunks, 20)[1].count() == 0


def test_an_audit_reads_the_corpus_once_for_many_injections(spark):
    rng = random.Random(6)
    vec = lambda: [rng.gauss(0, 1) for _ in range(4)]
    chunks = spark.createDataFrame([(i, rng.choice("ab"), vec()) for i in range(200)], "chunk_id long, collection string, vector array<double>")
    asks = spark.createDataFrame([(f"q{i}", rng.choice("ab"), vec()) for i in range(12)], "query_id string, collection string, vector array<double>")
    base = R.nearest_chunks(asks, chunks, 4).persist()
    for n in (0, 1, 60):
        injected = spark.createDataFrame([(1000 + i, rng.choice("ab"), vec()) for i in range(n)], chunks.schema)
        top = R.retrieve_topk(asks, chunks.unionByName(injected), 4).where("chunk_id >= 1000")
        want = {(r["collection"], r["query_id"]): r["r"] for r in top.groupBy("collection", "query_id").agg(F.min("rank").alias("r")).collect()}
        # with a base the corpus itself is not needed
        got = A.stale_audit(asks, None, injected, 4, base=base).collect()
        assert len(got) == 12
        for r in got:
            key = (r["collection"], r["query_id"])
            assert (r["stale_retrieved"], r["stale_rank"]) == (key in want, want.get(key))


def test_each_text_is_embedded_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def embed(texts):
        calls.add(len(texts))
        return pa.array([[float(len(t.as_py())), 1.0] for t in texts], pa.list_(pa.float64()))

    rows = [(i, None if i % 10 == 9 else f"text {i % 4}", "x") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id int, text string, vector_ string").repartition(6)
    out = embed_distinct(df, embed)
    for _ in range(2):
        got = {r["doc_id"]: r for r in out.collect()}
    assert calls.value == 4 and len(got) == 400
    assert all((r["vector"] is None) == (r["text"] is None) for r in got.values())
    assert all(r["vector"] == [6.0, 1.0] for r in got.values() if r["text"])
    known = out.where("doc_id in (0, 1)").select("text_hash", "vector")
    again = embed_distinct(df, embed, known=known).collect()
    assert calls.value == 6 and len(again) == 400 and all(r["vector"] == got[r["doc_id"]]["vector"] for r in again)
    assert embed_distinct(df.limit(0), embed).count() == 0


def test_unknown_tiers_and_roles(spark):
    rows = [("a", "rag"), ("B", "fast"), ("c", "rag"), (None, "rag"), ("b", "chess"), ("b", None)]
    out = with_tier_model(spark.createDataFrame(rows, "tier string, role string"), tier_prices(spark)).collect()
    errors = {(r["tier"], r["role"]): r["error"] for r in out}
    assert errors == {
        ("a", "rag"): None, ("B", "fast"): None, ("c", "rag"): "unknown tier 'c'", (None, "rag"): "unknown tier ''",
        ("b", "chess"): "no model for role 'chess'", ("b", None): "no model for role ''",
    }
    assert all((r["model_id"] is None) == (r["error"] is not None) for r in out)


def test_stored_runs_are_told_by_their_folders(spark, tmp_path):
    run = lambda n: spark.createDataFrame([(n, "m", 1, 2.0, 3.0, 0.1, 4.0)], "run string, model string, logic int, correctness double, final_score double, cost double, latency double")
    path = str(tmp_path / "runs")
    writers.write_runs(run("r1"), path)
    # a broken file shows that none is opened
    (tmp_path / "runs" / "run=r1" / "broken.csv").write_bytes(b"\xff" * 10)
    writers.write_runs(run("r 2"), path)
    for n in ("r1", "r 2"):
        with pytest.raises(AnalysisException):
            writers.write_runs(run(n), path)
