import random

import pytest
from fixed_inputs import LABELLED_CASES, PUBLISHED
from pyspark.sql import functions as F

from palisade.fixed_values import BENCH_KEYWORDS, RULE_PATTERNS
from palisade.operators import evaluation as E
from palisade.operators.ordering import best_so_far, running_total, value_at_rank
from palisade.operators.runs import pareto_frontier
from palisade.plans.setups import Mask, Rules, Scrub, Setup, Vectors, setup_verdicts, vector_verdicts

VERDICT = "setup string, case_id long, text string, expected boolean, actual boolean, latency_ms double, error string"


@pytest.fixture(scope="module")
def cases(spark):
    rows = [(i, t, e, float(i)) for i, (t, e) in enumerate(LABELLED_CASES)]
    return spark.createDataFrame(rows, "case_id long, text string, expected boolean, latency_ms double")


def test_published_rates_from_their_counts(spark):
    rows = []
    for s, (fn, fp, *_) in enumerate(PUBLISHED):
        actual = [i >= fn for i in range(35)] + [i < fp for i in range(25)]
        rows += [(str(s), i, "t", i < 35, a, float(i), None) for i, a in enumerate(actual)]
    out = E.rounded_metrics(E.eval_metrics(spark.createDataFrame(rows, VERDICT))).orderBy("setup").collect()
    for row, (fn, fp, *rates) in zip(out, PUBLISHED):
        assert (row["fn"], row["fp"]) == (fn, fp)
        assert [row[n] for n in ("accuracy", "precision", "recall", "f1")] == rates
        assert row["tp"] + row["fn"] + row["fp"] + row["tn"] == row["total"] == 60
        assert row["p95_latency_ms"] == 57.0


def test_rule_setup_on_the_labelled_cases(cases):
    """Scrub, keywords and patterns reach the published 12 misses and 1 false alarm."""
    E.checked_cases(cases, 35, 25)
    setups = {
        "rules": Setup(BENCH_KEYWORDS, RULE_PATTERNS, "bench"),
        "custom": Setup(run=lambda text, lowered: F.contains(lowered, F.lit("icarus"))),
    }
    verdicts = setup_verdicts(cases, setups)
    rows = {r["setup"]: r for r in E.rounded_metrics(E.eval_metrics(verdicts)).collect()}
    assert (rows["rules"]["fn"], rows["rules"]["fp"]) == (12, 1)
    assert (rows["rules"]["accuracy"], rows["rules"]["f1"]) == (0.7833, 0.7797)
    assert rows["custom"]["tp"] == sum("icarus" in t.lower() for t, e in LABELLED_CASES if e)
    wide = E.detail_pivot(verdicts, ["rules", "custom"])
    assert wide.count() == 60 and wide.columns == ["case_id", "expected", "rules", "custom", "rules_ms", "custom_ms"]
    top = E.top_misses(verdicts).where("setup = 'rules'").collect()
    assert len(top) == 8 and {r["more"] for r in top} == {5}
    lines = [r["line"] for r in E.report_lines(E.eval_metrics(verdicts), verdicts).where("setup = 'rules'").collect()]
    assert "| rules | 78.3% | 95.8% | 65.7% | 78.0% | 12 | 1 | 30ms | 57ms |" in lines
    assert sum("False Negative" in line for line in lines) == 12


def test_wrong_suite_is_refused(cases):
    with pytest.raises(ValueError):
        E.checked_cases(cases.where("case_id < 59"), 35, 25)


def test_select_and_export(spark):
    rows = [(s, 0, "t", True, True, 0.25, None) for s in "abc"]
    df = spark.createDataFrame(rows, VERDICT)
    assert {r["setup"] for r in E.select_setups(df, None, ["b"]).collect()} == {"a", "c"}
    out = E.summary_export(E.eval_metrics(df)).first()
    assert out["Accuracy"] == "1.0000" and out["AvgLatencyMs"] == "0.2"


def plain_rank(values, fraction):
    return sorted(values)[min(int(len(values) * fraction), len(values) - 1)]


@pytest.mark.parametrize("seed", range(4))
def test_value_at_rank(spark, seed):
    rng = random.Random(seed)
    draws = [
        lambda: rng.uniform(0, 1000), lambda: float(rng.randint(0, 5)), lambda: rng.gauss(0, 1e-6),
        lambda: 10 ** rng.uniform(-300, 300),
    ]
    groups = {g: [draws[(seed + i) % 4]() for _ in range(rng.choice([1, 7, 60, 400]))] for i, g in enumerate("abcd")}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, v double")
    for fraction in (0.0, 0.5, 0.95, 1.0):
        out = {r["g"]: r["q"] for r in value_at_rank(df, "g", "v", fraction, "q").collect()}
        assert out == {g: plain_rank(vs, fraction) for g, vs in groups.items()}


def test_running_total(spark):
    rng = random.Random(1)
    rows = [(g, o, rng.randint(0, 9)) for g in "ab" for o in rng.sample(range(300), 120)]
    df = spark.createDataFrame(rows, "g string, o long, n int")
    for most in (0, 1000):
        total = running_total(df, "g", "o", "n", "t", width=16, group_rows=most)
        out = {(r["g"], r["o"]): r["t"] for r in total.collect()}
        for g, o, _ in rows:
            assert out[(g, o)] == sum(n for g2, o2, n in rows if g2 == g and o2 < o)


def beaten(a, b):
    return b[0] <= a[0] and b[1] >= a[1] and (b[0] < a[0] or b[1] > a[1])


@pytest.mark.parametrize("seed", range(4))
def test_pareto_frontier(spark, seed):
    rng = random.Random(seed)
    n = [5, 60, 200, 200][seed]
    cost = [lambda: rng.choice([0.0, 0.001, 0.02, 1.5]), lambda: rng.uniform(0, 1), lambda: rng.uniform(-1, 1),
            lambda: rng.randint(0, 20) / 7][seed]
    points = [(i, cost(), float(rng.randint(0, 40))) for i in range(n)]
    df = spark.createDataFrame(points, "i int, cost double, final_score double")
    want = {i for i, *a in points if not any(beaten(a, b) for _, *b in points)}
    front = pareto_frontier(df).collect()
    assert {r["i"] for r in front} == want
    assert [r["cost"] for r in front] == sorted(r["cost"] for r in front)


def test_pareto_keeps_duplicates(spark):
    df = spark.createDataFrame([(1.0, 5.0), (1.0, 5.0), (2.0, 5.0), (2.0, 7.0), (3.0, 6.0)], "cost double, final_score double")
    assert [tuple(r) for r in pareto_frontier(df).select("cost", "final_score").collect()] == [(1.0, 5.0), (1.0, 5.0), (2.0, 7.0)]


def test_best_so_far(spark):
    df = spark.createDataFrame([(float(k), float(v)) for k, v in [(1, 3), (2, 3), (3, 4), (4, 1)]], "k double, v double")
    assert sorted(r["k"] for r in best_so_far(df, "k", "v").collect()) == [1.0, 3.0]


def test_setups_share_their_first_steps(spark, cases):
    """Masked, vector and layered set-ups; each text step is one column, computed once."""
    with_vectors = cases.withColumn("vector", F.array((F.col("case_id") % 3).cast("double"), F.lit(1.0)))
    with_vectors = with_vectors.withColumn("vector", F.when(F.col("case_id") != 5, F.col("vector")))
    topics = spark.createDataFrame([(0, "t", [1.0, 0.0])], "ord int, topic string, vector array<double>")
    words = tuple(BENCH_KEYWORDS)
    setups = {
        "rules": [Scrub("bench"), Rules(words, tuple(RULE_PATTERNS))],
        "vectors": [Scrub("bench"), Vectors(0.8)],
        "layered": [Mask(), Rules(words), Vectors(0.8)],
        "masked": [Mask(), Scrub("bench"), Rules(words)],
        "open": [],
    }
    out = setup_verdicts(with_vectors, setups, topics)
    got = {(r["setup"], r["case_id"]): r["actual"] for r in out.collect()}
    assert len(got) == 5 * 60
    near = {i: i != 5 and i % 3 == 2 for i in range(60)}
    assert all(got["vectors", i] == near[i] for i in range(60))
    assert all(got["layered", i] == (got["masked", i] or near[i]) for i in range(60))
    assert not any(got["open", i] for i in range(60))
    rates = {r["setup"]: r for r in E.rounded_metrics(E.eval_metrics(out)).collect()}
    assert (rates["rules"]["fn"], rates["rules"]["fp"]) == (12, 1)
    # two scrubs would show as two copies of a pattern in the plan; a mask is found once for two set-ups
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("luhn_check") == 1 or plan.count("isValidLuhn") <= 1
    with pytest.raises(ValueError):
        setup_verdicts(with_vectors, setups)


def test_threshold_sweep_against_each_threshold_alone(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), rng.choice([True, False, None]), rng.choice([None, 0.2, 0.5, rng.random()])) for _ in range(400)]
    rows.append(("only", True, None))
    df = spark.createDataFrame(rows, "setup string, expected boolean, similarity double")
    limits = [0.0, 0.2, 0.5, 0.5, 0.77, 2.0]
    got = {(r["setup"], r["threshold"]): r for r in E.threshold_sweep(df, limits).collect()}
    assert len(got) == 3 * 5
    for (name, t), r in got.items():
        mine = [(e, s is not None and s >= t) for n, e, s in rows if n == name and e is not None]
        count = lambda *x: sum(y == x for y in mine)
        assert (r["tp"], r["fn"], r["fp"], r["tn"]) == (count(True, True), count(True, False), count(False, True), count(False, False))
    best = {r["setup"]: r for r in E.best_threshold(E.threshold_sweep(df, limits)).collect()}
    assert best["a"]["f1"] == max(r["f1"] for (n, _), r in got.items() if n == "a") and best["only"]["threshold"] == 0.0
    with pytest.raises(ValueError):
        E.threshold_sweep(df, [])


def test_vector_contender_beside_models(spark):
    df = spark.createDataFrame(
        [(0, "t", True, 1.0, 0.38), (1, "t", True, 1.0, 0.3799), (2, "t", False, 1.0, None)],
        "case_id long, text string, expected boolean, latency_ms double, similarity double",
    )
    out = vector_verdicts(df).orderBy("case_id").collect()
    assert [r["actual"] for r in out] == [True, False, False] and [r["error"] is None for r in out] == [True, True, False]
