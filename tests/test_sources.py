import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from palisade.fixed_values import DEFAULT_TOPICS
from palisade.operators.retrieval import retrieve_topk
from palisade.operators.scrub import redact
from palisade.plans.gateway import triple_lock
from palisade.sources import readers, schemas, writers
from palisade.streaming import gateway, telemetry

HEADER = "Model,Logic,Correctness,Final Score,Cost,Latency\n"


def test_run_files(spark, tmp_path):
    (tmp_path / "run_20240102_030405.csv").write_text(HEADER + "m,6,9,70.5,0.01,3.5\n")
    (tmp_path / "notes.txt").write_text("not a run\n")
    os.utime(tmp_path / "run_20240102_030405.csv", (1704164645, 1704164645))
    row = readers.load_runs(spark, str(tmp_path)).first()
    assert row["run"] == "Run_20240102_030405" and row["final_score"] == 70.5
    named = readers.load_runs(spark, str(tmp_path), "filename")
    assert named.count() == 1 and named.first()["run"] == "run_20240102_030405"
    empty = readers.load_runs(spark, str(tmp_path / "absent"))
    assert empty.count() == 0 and empty.columns == named.columns


def test_runs_are_never_overwritten(spark, tmp_path):
    rows = [("r1", "m", 1, 2.0, 3.0, 0.1, 4.0), ("r2", "n", 1, 2.0, 3.0, 0.1, 4.0)]
    df = spark.createDataFrame(rows, "run string, model string, logic int, correctness double, final_score double, cost double, latency double")
    path = str(tmp_path / "runs")
    writers.write_runs(df, path)
    assert {r["run"] for r in readers.load_runs(spark, path, "partition").collect()} == {"r1", "r2"}
    with pytest.raises(AnalysisException):
        writers.write_runs(df, path)
    writers.write_runs(df.limit(1).selectExpr("'r3' as run", "model", "logic", "correctness", "final_score", "cost", "latency"), path)
    assert readers.load_runs(spark, path, "partition").count() == 3


def test_run_files_are_read_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Model,Final Score,Cost,Latency\nm,70.5,0.01,3.5\n")
    (tmp_path / "b.csv").write_text("Latency,Cost,Final Score,Correctness,Logic,Model\n3.5,0.01,70.5,9,6,m\n")
    rows = {r["run"]: r for r in readers.load_runs(spark, str(tmp_path), "filename").collect()}
    for name, logic in (("a", None), ("b", 6)):
        r = rows[name]
        assert (r["model"], r["final_score"], r["cost"], r["latency"], r["logic"]) == ("m", 70.5, 0.01, 3.5, logic)


def test_uploads_of_unequal_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Model,Final Score,Cost,Latency\nm,1.5,0,2\n")
    (tmp_path / "b.csv").write_text("Cost,Model,Latency,Final Score,Logic\n0.5,n,3,2,4\n")
    out = readers.union_uploads(spark, {"a": str(tmp_path / "a.csv"), "b": str(tmp_path / "b.csv")}).orderBy("run").collect()
    assert [(r["run"], r["final_score"], r["logic"]) for r in out] == [("a", 1.5, None), ("b", 2.0, "4")]


def test_policy_file(spark, tmp_path):
    path = tmp_path / "policy.json"
    path.write_text(json.dumps({"policy_name": "p", "_comment": "x", "keyword_rules": ["b", "a"], "semantic_threshold": 0.0}, indent=2))
    row = readers.load_policies(spark, str(path)).first()
    assert row["keyword_rules"] == ["b", "a"] and row["pattern_rules"] == []
    assert row["semantic_threshold"] == 0.0 and row["semantic_topics"] == DEFAULT_TOPICS
    rules = readers.policy_rules(readers.load_policies(spark, str(path)))
    assert {(r["kind"], r["ord"], r["rule"]) for r in rules.where("kind = 'keyword'").collect()} == {("keyword", 0, "b"), ("keyword", 1, "a")}
    assert readers.default_policy(spark).first()["semantic_threshold"] == 0.4
    assert readers.load_policies(spark, str(tmp_path / "absent.json")).first()["policy_name"] == "default"
    (tmp_path / "many.json").write_text('[{"policy_name": "a"},\n {"policy_name": "b", "keyword_rules": ["x"]}]')
    (tmp_path / "lines.json").write_text('{"policy_name": "a"}\n{"policy_name": "b", "keyword_rules": ["x"]}\n')
    for name in ("many", "lines"):
        found = readers.load_policies(spark, str(tmp_path / f"{name}.json")).collect()
        assert {r["policy_name"]: r["keyword_rules"] for r in found} == {"a": [], "b": ["x"]}
    (tmp_path / "broken.json").write_text('{"policy_name": "a",\n "keyword_rules": ["x"')
    with pytest.raises(Exception, match="(?i)malformed|json"):
        readers.load_policies(spark, str(tmp_path / "broken.json")).collect()


def test_registry(spark, tmp_path):
    rows = [{"id": d, "title": d.upper(), "questions": [{"id": f"Q{i}", "topic": "t", "text": "?"} for i in range(3)]} for d in "ab"]
    (tmp_path / "r.json").write_text("\n".join(json.dumps(r) for r in rows))
    registry = readers.read_registry(spark, str(tmp_path / "r.json"))
    assert readers.registry_questions(registry).count() == 6
    assert readers.pick_documents(registry, ["b"]).first()["title"] == "B"
    with pytest.raises(ValueError, match="zz"):
        readers.pick_documents(registry, ["a", "zz"])


def test_results_files(spark, tmp_path):
    result = [{"question_id": "Q1", "question": "?", "answer": "!", "retrieved_chunks": [
        {"text": "x", "page_num": 34, "distance": 0.6376}, {"text": "y", "page_num": 3, "distance": 0.7}]}]
    (tmp_path / "r.json").write_text(json.dumps(result, indent=2))
    rows = readers.explode_results(readers.read_retrieval_results(spark, str(tmp_path / "r.json"))).orderBy("rank").collect()
    assert [(r["rank"], r["page_num"], r["distance"]) for r in rows] == [(1, 34, 0.6376), (2, 3, 0.7)]
    stress = [{"test": "stale", "stale_retrieved": False, "answer": "a"}, {"test": "bad_chunk", "answer": "b"}]
    (tmp_path / "s.json").write_text(json.dumps(stress))
    assert [r["stale_retrieved"] for r in readers.read_stress_results(spark, str(tmp_path / "s.json")).collect()] == [False, None]


def test_summary_file(spark, tmp_path):
    (tmp_path / "s.csv").write_text(
        "Setup,Accuracy,Precision,Recall,F1,FalseNegatives,FalsePositives,AvgLatencyMs,P95LatencyMs\nrules,0.7833,0.9583,0.6571,0.7797,12,1,0.0,0.1\n")
    row = readers.read_summary(spark, str(tmp_path / "s.csv")).first()
    assert (row["F1"], row["FalseNegatives"]) == (0.7797, 12)


def test_lines_and_other_sinks(spark, tmp_path):
    (tmp_path / "lines.txt").write_text("  one \n\n\ttwo\n")
    assert [r["line"] for r in readers.read_lines(spark, str(tmp_path / "lines.txt")).collect()] == ["one", "two"]
    df = spark.createDataFrame([("d1", "k", "b"), ("d2", "l", "c")], "doc_id string, key string, blueprint string")
    writers.write_json_by_document(df, str(tmp_path / "json"))
    stored = spark.read.json(str(tmp_path / "json"))
    assert {r["doc_id"] for r in stored.collect()} == {"d1", "d2"} and "bucket" in stored.columns
    writers.append_blueprints(df, str(tmp_path / "bp"))
    writers.append_blueprints(df, str(tmp_path / "bp"))
    assert spark.read.parquet(str(tmp_path / "bp")).count() == 4
    writers.write_csv(df, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 2


TEXT_ROWS = [(i, f"mail u{i}@b.co" if i % 2 else f"card {4111111111111111 + i}") for i in range(40)]


def test_stream_equals_batch(spark, tmp_path):
    df = spark.createDataFrame(TEXT_ROWS, "doc_id int, text string")
    df.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    gateway.to_parquet(gateway.stream_gateway(stream), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    key = lambda rows: sorted(map(str, rows))
    assert key(spark.read.parquet(str(tmp_path / "out")).collect()) == key(triple_lock(df).collect())


def test_telemetry_over_several_batches(spark, tmp_path):
    rows = [(f"2024-01-01 0{h}:15:00", "s", "EMAIL", n) for h, n in [(0, 1), (0, 2), (1, 4), (2, 8), (1, 16)]]
    df = spark.createDataFrame(rows, "ts string, source string, label string, n int").selectExpr("cast(ts as timestamp) ts", "source", "label", "n")
    for row in df.collect():
        spark.createDataFrame([row], df.schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    windows = telemetry.pii_telemetry(stream, "1 hour")
    telemetry.to_snapshots(windows, str(tmp_path / "snap"), str(tmp_path / "st")).awaitTermination()
    got = sorted(map(tuple, telemetry.latest(spark.read.parquet(str(tmp_path / "snap"))).collect()))
    assert got == sorted(map(tuple, telemetry.pii_telemetry(df, "1 hour").collect()))
    assert telemetry.pii_telemetry(df, "2 hours", "1 hour").count() == 4


def test_null_text_passes_through(spark):
    df = spark.createDataFrame([(1, None)], "doc_id int, text string")
    assert redact(df).first()["clean_text"] is None


def test_policies_by_version(spark, tmp_path):
    path = str(tmp_path / "policies")
    make = lambda *rows: spark.createDataFrame([(n, [k], None, None, None, None) for n, k in rows], schemas.POLICY)
    writers.append_policies(make(("a", "one"), ("b", "two")), path, 3)
    writers.append_policies(make(("a", "three")), path, 10)
    words = lambda v: sorted((r["policy_name"], r["keyword_rules"][0]) for r in readers.policies_at(spark, path, v).collect())
    assert words(3) == words(9) == [("a", "one"), ("b", "two")]
    assert words(None) == words(10) == [("a", "three"), ("b", "two")]
    assert words(2) == []
    assert readers.policies_at(spark, path).first()["semantic_threshold"] == 0.4
    with pytest.raises(AnalysisException):
        writers.append_policies(make(("c", "x")), path, 10)


def test_vector_store_versions(spark, tmp_path):
    path, compacted = str(tmp_path / "vectors"), str(tmp_path / "compacted")
    load = lambda *rows: spark.createDataFrame([(c, i, t, [v]) for c, i, t, v in rows], "collection int, chunk_id string, text string, vector array<double>")
    assert writers.append_vectors(load((1, "a", "x", 1.0), (1, "b", "y", 2.0), (2, "a", "z", 3.0)), path) == 1
    assert writers.append_vectors(load((1, "a", "x2", 4.0), (2, "c", "n", 5.0)), path) == 2
    assert writers.append_vectors(load((1, "a", "x", 1.5)).withColumn("load", F.lit(99)), path) == 3
    want = [(1, "a", "x", 1.5, 3), (1, "b", "y", 2.0, 1), (2, "a", "z", 3.0, 1), (2, "c", "n", 5.0, 2)]
    rows = lambda p: sorted((r.collection, r.chunk_id, r.text, r.vector[0], r.load) for r in readers.read_vectors(spark, p).collect())
    assert rows(path) == want
    writers.compact_vectors(spark, path, compacted)
    assert rows(compacted) == want and spark.read.parquet(compacted).count() == 4
    assert writers.append_vectors(load((1, "b", "y2", 9.0)), compacted) == 4
    assert (1, "b", "y2", 9.0, 4) in rows(compacted) and len(rows(compacted)) == 4
    # an edited chunk is found once, and a text edited back is not taken for stored
    asked = spark.createDataFrame([("q", 1, [1.5])], "query_id string, collection int, vector array<double>")
    top = retrieve_topk(asked, readers.read_vectors(spark, path), k=5).collect()
    assert [(r.rank, r.chunk_id, r.distance) for r in top] == [(1, "a", 0.0), (2, "b", 0.25)]
