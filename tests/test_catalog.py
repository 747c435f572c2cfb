"""Every named query against its SQL, and the plans of the ones that matter at scale."""

import re

import pytest
from check_oracle import compare, oracle

import __spark_entry__ as entry_points
from palisade.catalog import all_queries

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle(SMALL)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_agrees_with_its_sql(spark, con, name):
    text, good = compare(spark, con, SMALL, name, all_queries()[name])
    assert good, text


def test_entry_points(spark):
    assert entry_points.entry(spark).count() == 200
    stated = set(entry_points.oracle_sql())
    assert stated <= set(entry_points.queries())
    # Queries over the given tables all have SQL; training-data operators may have none.
    assert {n for n, q in all_queries().items() if q.oracle} == set(all_queries()) <= stated


def plan(spark, name):
    return all_queries()[name].build(spark, SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", ["triple_lock", "redact_coding", "scrub_text", "mask_entities", "rule_gate", "circuit_breaker", "chunk_pages"]
)
def test_texts_never_leave_the_jvm(spark, name):
    assert not re.search("Python|Pandas|InArrow", plan(spark, name))


@pytest.mark.parametrize("name", ["triple_lock", "rule_gate", "scrub_text", "mask_entities"])
def test_gates_shuffle_nothing_of_their_own(spark, name):
    assert not re.search(r"\bExchange", plan(spark, name))


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_no_cartesian_product(spark, name):
    assert "CartesianProduct" not in plan(spark, name)
    assert "BroadcastNestedLoopJoin" not in plan(spark, name)


@pytest.mark.parametrize("name", ["final_score", "pii_by_source"])
def test_columns_are_pruned(spark, name):
    schema = re.search(r"ReadSchema: struct<(.*?)>", plan(spark, name)).group(1)
    wanted = {"final_score": "event_id:bigint,user_id:bigint,value:double,props:string", "pii_by_source": "text:string,source:string"}
    assert schema == wanted[name]
