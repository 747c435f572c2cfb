import random

import numpy as np
import pytest

from palisade.operators import audits as A
from palisade.operators import retrieval as R
from palisade.plans import grounded, stress

CHUNK = "chunk_id long, collection string, vector array<double>"
ASK = "query_id string, collection string, vector array<double>"


def world(spark, seed=0, n=300, dims=5, grid=False):
    """A corpus in which one collection holds most rows; `grid` makes many exact ties."""
    rng = random.Random(seed)
    number = (lambda: float(rng.randint(0, 2))) if grid else (lambda: rng.gauss(0, 1))
    vec = lambda: [number() for _ in range(dims)]
    chunks = [(i, rng.choice("aaab"), vec()) for i in range(n)]
    asks = [(f"q{i}", rng.choice("abc"), vec()) for i in range(25)]
    return chunks, asks, spark.createDataFrame(chunks, CHUNK), spark.createDataFrame(asks, ASK)


def distance(a, b, metric):
    a, b = np.array(a), np.array(b)
    if metric == "l2sq":
        return float(((a - b) ** 2).sum())
    if metric == "ip":
        return float(1 - a @ b)
    norms = np.linalg.norm(a) * np.linalg.norm(b)
    return float(1 - (a @ b / norms if norms else 0.0))


def brute(chunks, asks, k, metric):
    out = set()
    for q, group, v in asks:
        near = sorted((round(distance(v, w, metric), 10), c) for c, g, w in chunks if g == group)
        out |= {(q, i, c) for i, (_, c) in enumerate(near[:k], 1)}
    return out


@pytest.mark.parametrize("metric", ["l2sq", "cosine", "ip"])
@pytest.mark.parametrize("grid", [False, True])
def test_topk_both_ways(spark, metric, grid):
    chunks, asks, corpus, queries = world(spark, grid=grid)
    want = brute(chunks, asks, 4, metric)
    for options in ({}, {"shipped_rows": 5, "block_rows": 40}):
        out = R.retrieve_topk(queries, corpus.repartition(3), 4, metric, **options).collect()
        assert {(r["query_id"], r["rank"], r["chunk_id"]) for r in out} == want


def test_distances_of_unit_vectors(spark):
    corpus = spark.createDataFrame([(1, "a", [1.0, 0.0]), (2, "a", [0.0, 1.0]), (3, "a", None)], CHUNK)
    ask = spark.createDataFrame([("q", "a", [1.0, 0.0])], ASK)
    out = R.retrieve_topk(ask, corpus).orderBy("rank").collect()
    assert [(r["chunk_id"], r["distance"]) for r in out] == [(1, 0.0), (2, 2.0)]
    with pytest.raises(Exception, match="unknown metric"):
        R.retrieve_topk(ask, corpus, metric="other").collect()


@pytest.mark.parametrize("shipped", [10, 1])
def test_ids_repeat_between_collections(spark, shipped):
    corpus = spark.createDataFrame(
        [(i, g, [float(i)], f"{g}{i}", i) for g in "ab" for i in range(6)], CHUNK + ", text string, page_num int"
    )
    ask = spark.createDataFrame([("Q1", "a", [0.0], "x"), ("Q1", "b", [5.0], "y")], ASK + ", question string")
    top = R.retrieve_topk(ask, corpus, shipped_rows=shipped)
    near = {(r["collection"], r["rank"]): r["chunk_id"] for r in top.collect()}
    assert near == {("a", r): r - 1 for r in range(1, 5)} | {("b", r): 6 - r for r in range(1, 5)}
    prompts = {r["collection"]: r["prompt"] for r in grounded.grounded_prompts(ask, corpus).collect()}
    assert "a0" in prompts["a"] and "b" not in prompts["a"].split("\n\nQUESTION")[0].split("]\n")[1]
    injected = spark.createDataFrame([(9, "a", [0.0])], CHUNK)
    found = {r["collection"]: r["stale_rank"] for r in A.stale_audit(ask, corpus, injected).collect()}
    assert found == {"a": 2, "b": None}


def test_text_ids(spark):
    corpus = spark.createDataFrame([("b", "x", [1.0]), ("a", "x", [1.0]), ("c", "x", [3.0])], CHUNK.replace("long", "string"))
    ask = spark.createDataFrame([("q", "x", [1.0])], ASK)
    assert [r["chunk_id"] for r in R.retrieve_topk(ask, corpus, 2).orderBy("rank").collect()] == ["a", "b"]


def test_no_question_or_no_chunk(spark):
    _, _, corpus, queries = world(spark)
    assert R.retrieve_topk(queries.limit(0), corpus).count() == 0
    assert R.retrieve_topk(queries, corpus.limit(0)).count() == 0


def test_grounded_prompt(spark):
    corpus = spark.createDataFrame(
        [(1, "a", [1.0, 0.0], "first", 3), (2, "a", [0.5, 0.0], "second", 7)],
        CHUNK + ", text string, page_num int",
    )
    ask = spark.createDataFrame([("q", "a", [1.0, 0.0], "why?"), ("r", "zz", [1.0, 0.0], "who?")], ASK + ", question string")
    out = {r["query_id"]: r["prompt"] for r in grounded.grounded_prompts(ask, corpus).collect()}
    assert out["q"] == (
        "CONTEXT FROM DOCUMENT:\n[Source 1 — Page 3 | Distance: 0.0]\nfirst\n\n"
        "[Source 2 — Page 7 | Distance: 0.25]\nsecond\n\nQUESTION:\nwhy?\n\n"
        "Answer using only the context above. Cite page numbers."
    )
    assert out["r"].startswith("CONTEXT FROM DOCUMENT:\n\n\nQUESTION:\nwho?")
    messages = grounded.grounded_messages(grounded.grounded_prompts(ask, corpus)).first()["messages"]
    assert [m["role"] for m in messages] == ["system", "user"]


def test_stale_audit(spark):
    chunks, asks, corpus, queries = world(spark)
    asked = queries.where("query_id in ('q0', 'q1', 'q2')").dropDuplicates(["collection"])
    injected = asked.selectExpr("cast(-row_number() over (order by query_id) as bigint) as chunk_id", "collection", "vector")
    near = A.stale_audit(asked, corpus, injected).collect()
    assert near and all(r["stale_retrieved"] and r["stale_rank"] == 1 for r in near)
    far = injected.selectExpr("chunk_id", "collection", "transform(vector, x -> x + 100) as vector")
    hot = A.stale_audit(asked.where("collection <> 'c'"), corpus, far).collect()
    assert not any(r["stale_retrieved"] for r in hot) and all(r["stale_rank"] is None for r in hot)


def test_missing_source(spark):
    _, _, corpus, queries = world(spark)
    of = {r["query_id"]: r["collection"] for r in queries.collect()}
    said = [("q0", "It does not contain this."), ("q1", "Yes, 5%."), ("zz", "No information")]
    answers = spark.createDataFrame([(q, of.get(q, "a"), t) for q, t in said], "query_id string, collection string, answer string")
    out = {r["query_id"]: r for r in stress.missing_source_audit(queries, corpus, answers).collect()}
    assert [out[q]["admitted_ignorance"] for q in ("q0", "q1", "zz")] == [True, False, True]
    assert out["zz"]["best_distance"] is None


def test_overrides_and_modes(spark):
    docs = spark.createDataFrame([("a", "Alpha"), ("b", "Beta")], "doc_id string, title string")
    given = spark.createDataFrame([("a", "own words")], "doc_id string, text string")
    stale = {r["doc_id"]: r["stale_text"] for r in stress.stale_texts(docs, given).collect()}
    assert stale["a"] == "own words" and stale["b"].startswith("SUPERSEDED REPORT (2022): Earlier data and projections for Beta. ")
    assert {r["doc_id"]: r["probe"] for r in stress.probe_questions(docs, given).collect()}["a"] == "own words"
    answers = spark.createDataFrame(
        [("a", "Q1", "honest", "x" * 200), ("a", "Q1", "forced", " y ")], "doc_id string, question_id string, mode string, answer string"
    )
    row = A.compare_modes(answers).first()
    assert row["honest"] == "x" * 120 and row["forced"] == "y"
    asked = spark.createDataFrame([("a", "Q1", "why?")], "doc_id string, question_id string, question string")
    modes = grounded.baseline_messages(asked).collect()
    assert {r["mode"] for r in modes} == {"honest", "forced"}
    assert all(r["messages"][1]["content"] == "why?" for r in modes)


def test_pending_and_batches(spark):
    chunks = spark.createDataFrame([("c", f"k{i}", f"text {i}") for i in range(5)], "collection string, chunk_id string, text string")
    stored = R.embed_pending(chunks.where("chunk_id < 'k3'"), chunks.selectExpr("collection", "chunk_id", "'' as text_hash"))
    edited = chunks.selectExpr("collection", "chunk_id", "if(chunk_id = 'k1', 'edited', text) as text")
    assert {r["chunk_id"] for r in R.embed_pending(edited, stored).collect()} == {"k1", "k3", "k4"}
    rows = spark.createDataFrame([("c", i * 3) for i in range(120)], "g string, o long")
    out = {r["o"]: (r["seq"], r["batch"]) for r in R.embed_batches(rows, "g", "o").collect()}
    assert out[0] == (0, 0) and out[150] == (50, 1) and out[357] == (119, 2)
