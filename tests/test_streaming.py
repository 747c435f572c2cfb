"""The policy gateway on a stream against the batch result of each version of the policies."""

import pytest
from pyspark.sql import functions as F

from palisade.plans.gateway import NO_POLICY, policy_gateway
from palisade.sources import readers, schemas, writers
from palisade.streaming import gateway

TEXT = "doc_id int, policy_name string, text string, vector array<double>"


@pytest.fixture
def folders(tmp_path):
    return {n: str(tmp_path / n) for n in ("texts", "policies", "out", "state")}


def topics(spark):
    return spark.createDataFrame([("north", [1.0, 0.0]), ("south", [0.0, 1.0])], "topic string, vector array<double>")


def some_texts(spark, start):
    rows = [(start + i, "abz"[i % 3], f"word{i % 7} x@y.zz", [float(i % 4), 1.0]) for i in range(40)]
    return spark.createDataFrame(rows, TEXT)


def policies(spark, keyword, threshold, entities=()):
    rows = [("a", [keyword], [], ["north"], threshold, list(entities)), ("b", [], ["WORD2"], ["south", "north"], 0.99, [])]
    return spark.createDataFrame(rows, schemas.POLICY)


def run(spark, folders):
    stream = spark.readStream.schema(TEXT).parquet(folders["texts"])
    q = gateway.stream_policies(stream, folders["policies"], topics(spark), folders["out"], folders["state"])
    q.awaitTermination()
    return spark.read.parquet(folders["out"])


def rows(df):
    shown = df.drop("batch_id", "policy_version")
    return sorted(map(repr, shown.select(*sorted(shown.columns)).collect()))


def test_policies_change_between_batches(spark, folders):
    some_texts(spark, 0).write.parquet(folders["texts"])
    writers.append_policies(policies(spark, "word1", 0.2), folders["policies"], 1)
    first = run(spark, folders)
    assert {r.policy_version for r in first.collect()} == {1}
    writers.append_policies(policies(spark, "word4", 0.9, ["EMAIL_ADDRESS"]), folders["policies"], 2)
    some_texts(spark, 100).write.mode("append").parquet(folders["texts"])
    both = run(spark, folders)
    assert both.count() == 80
    for version, start in ((1, 0), (2, 100)):
        want = policy_gateway(some_texts(spark, start), readers.policies_at(spark, folders["policies"], version), topics(spark))
        assert rows(both.where(F.col("policy_version") == version)) == rows(want)
    assert rows(both.where("policy_version = 1")) != rows(both.where("policy_version = 2").withColumn("doc_id", F.col("doc_id") - 100))


def test_a_batch_run_again_keeps_its_version(spark, folders):
    some_texts(spark, 0).write.parquet(folders["texts"])
    writers.append_policies(policies(spark, "word1", 0.2), folders["policies"], 1)
    before = rows(run(spark, folders))
    writers.append_policies(policies(spark, "word4", 0.9), folders["policies"], 2)
    # the checkpoint is lost, so the same files come again as batch 0
    again = run(spark, folders | {"state": folders["state"] + "-new"})
    assert rows(again) == before and {r.policy_version for r in again.collect()} == {1}


def test_no_policies_yet(spark, folders):
    some_texts(spark, 0).write.parquet(folders["texts"])
    out = run(spark, folders).collect()
    assert len(out) == 40 and {(r.final_verdict, r.policy_version) for r in out} == {(NO_POLICY, 0)}
