import json
import random

import pytest
from pyspark.sql import functions as F

from palisade.functions import formatting as N
from palisade.functions import scoring as S
from palisade.operators import costs as C
from palisade.operators import runs as R
from palisade.plans.calibration import cache_lookup, score_run

RUN = "run string, model string, correctness double, final_score double, cost double, latency double"


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_rounding_is_pythons(spark):
    rng = random.Random(0)
    values = [0.25, 0.15, 0.05, 2.675, 1.005, -0.04, 0.0, 1e-9, 99.95] + [rng.uniform(-100, 100) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for places in (0, 1, 4):
        got = df.select("v", N.rounded(F.col("v"), places).alias("r"), N.fixed(F.abs("v"), places).alias("f")).collect()
        assert all(r["r"] == round(r["v"], places) for r in got)
        assert all(r["f"] == f"{abs(r['v']):.{places}f}" for r in got)


def test_final_score(spark):
    f = lambda *a: one(spark, S.final_score(*[F.lit(float(x)) for x in a]))
    assert f(6, 10, 0, 10) == 80.0
    assert f(6, 10, 0, 100) == 60.0
    assert f(0, 0, 1, 1000) == 0.0


def test_logic_and_rating(spark):
    assert one(spark, S.logic_score(F.lit("<CONTEXT> x <context> <task_logic>"))) == 2
    ratings = {'Sure: {"rating": 7}.': 7, "n/a": 0, '{"rating": "high"}': 0, '{"x": 1}': 0, '{"a": {}}\n{"rating": 3}': 0,
               'so {"rating":\n 8.5}': 8.5, None: 0}
    df = spark.createDataFrame([(k,) for k in ratings], "s string")
    assert {r["s"]: r["v"] for r in df.select("s", S.judge_rating(F.col("s")).alias("v")).collect()} == ratings


def body(content, tokens=None, **extra):
    usage = {} if tokens is None else {"usage": {"total_tokens": tokens}}
    return json.dumps({"choices": [{"message": {"content": content}}], **usage, **extra})


def test_score_run(spark):
    rows = [
        ("openai/gpt-4o-mini", body("**<context>** <Constraints>", 2_000_000), body('{"rating": 9}'), 10.0),
        ("unlisted", body("x", 2_000_000), body("?"), 10.0),
        ("unlisted", body("no usage"), body('{"rating": 1}'), 10.0),
        ("unlisted", "not json", body('{"rating": 1}'), 10.0),
        ("unlisted", json.dumps({"choices": []}), body('{"rating": 1}'), 10.0),
    ]
    df = spark.createDataFrame(rows, "model string, body string, judge string, latency double")
    out = {r["clean"]: r for r in score_run(df, C.call_prices(spark)).collect()}
    assert set(out) == {"<context> <Constraints>", "x", "no usage"}
    first = out["<context> <Constraints>"]
    assert (first["logic"], first["correctness"], first["cost"]) == (2, 9.0, 0.3)
    assert out["x"]["cost"] == 0.3 and out["x"]["correctness"] == 0
    assert out["no usage"]["cost"] == 0.0


def test_blueprint_cache(spark):
    df = spark.createDataFrame([("p1", "2024-03-05"), ("p1", "2024-04-01"), ("p2", "2024-03-09"), ("p2", "2024-03-10")], "prompt string, d string")
    prompts = df.withColumn("key", S.blueprint_key(F.col("prompt"), F.col("d").cast("timestamp")))
    keys = [r["key"] for r in prompts.collect()]
    assert keys[0][:8] == "2024-03_" and len(keys[0]) == 18 and keys[0][8:] == keys[1][8:] and keys[0] != keys[1]
    stored = spark.createDataFrame([(keys[0], "b")], "key string, blueprint string")
    hits, misses = cache_lookup(prompts, stored)
    assert hits.count() == 1 and misses.count() == 2


def test_heatmap_of_one_model_is_half(spark):
    df = spark.createDataFrame([("r", "m", 5.0, 1.0, 0.5, 2.0)] * 2, RUN)
    row = R.model_heatmap(df).first()
    assert [row[n] for n in ("score_norm", "cost_norm", "latency_norm")] == [0.5, 0.5, 0.5]
    assert (row["score_label"], row["cost_label"], row["latency_label"]) == ("1.000", "$0.5000", "2.00s")


def test_composite(spark):
    df = spark.createDataFrame(
        [("r", "free", 10.0, 0.0, 0.0, 1.0), ("r", "dear", 10.0, 0.0, 2.0, 2.0), ("r", "cheap", 5.0, 0.0, 1.0, 4.0),
         ("s", "only", 10.0, 0.0, 1.0, 1.0)], RUN)
    out = {r["model"]: (r["composite"], r["strong"]) for r in R.composite_score(df).collect()}
    assert out["free"] == (1.0, True)
    assert out["dear"] == (round(0.6 + 0.2 / 3, 6), False)
    assert out["cheap"] == (0.5, False)
    assert out["only"] == (0.8, False)


def test_cards_filters_and_ranking(spark):
    df = spark.createDataFrame(
        [("r1", "b", 1.0, 9.0, 0.2, 3.0), ("r1", "a", 1.0, 9.0, 0.1, 3.0), ("r2", "c", 1.0, 1.0, 0.1, 5.0)], RUN)
    row = R.summary_cards(df).first()
    assert (row["top_model"], row["cheapest_model"], row["fastest_model"]) == ("a", "a", "a")
    assert (row["n_rows"], row["n_runs"], row["top_score"]) == (3, 2, "9.000")
    assert R.filter_runs(df, ["r1"], ["a", "c"], 9.0, 9.0).count() == 1
    assert R.filter_runs(df).count() == 3
    assert [r["model"] for r in R.model_ranking(df).collect()] == ["c", "a", "b"]
    assert [r["final_score"] for r in R.sort_runs(df, "final_score", True).collect()] == [1.0, 9.0, 9.0]
    with pytest.raises(ValueError):
        R.sort_runs(df, "nothing")
    domains = {(r["kind"], r["value"]) for r in R.filter_domains(df).collect()}
    assert ("score_min", "1.0") in domains and ("run", "r2") in domains and len(domains) == 7
    assert R.score_points(df, "cost").columns == ["run", "model", "x", "y"]


def test_costs(spark):
    calls = spark.createDataFrame([("nobody/knows", 2_000_000), ("qwen/qwen3.6-plus", 10), ("openai/gpt-4o-mini", None)], "model string, total_tokens long")
    out = {r["model"]: r["cost"] for r in C.with_call_cost(calls, C.call_prices(spark)).collect()}
    assert out == {"nobody/knows": 0.3, "qwen/qwen3.6-plus": 0.0, "openai/gpt-4o-mini": 0.0}
    usage = spark.createDataFrame(
        [("one", "B", "rag", 1000, 600), ("two", "A", "rag", 1000, 600)], "label string, tier string, role string, prompt_tokens long, completion_tokens long")
    lines = {r["label"]: r for r in C.cost_rollup(C.token_cost(usage, C.tier_prices(spark))).collect()}
    assert lines["one"]["cost"] == 0.012 and lines["one"]["cost_label"] == "$  0.012000"
    assert lines["two"]["cost_label"] == "FREE"
    assert lines["TOTAL"]["tokens"] == 3200 and lines["TOTAL"]["cost"] == 0.012
    assert C.tier_registry(spark, "b").count() == 4
    with pytest.raises(ValueError):
        C.tier_registry(spark, "C")
