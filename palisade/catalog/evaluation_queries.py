"""Set-ups and models measured against the labelled cases."""

from __future__ import annotations

from pyspark.sql import functions as F

from palisade.catalog import patterns_sql as P
from palisade.catalog import views as V
from palisade.catalog.registry import query
from palisade.functions.formatting import rounded
from palisade.operators import evaluation as E
from palisade.plans.setups import Custom, Mask, Rules, Scrub, Vectors, reply_verdicts, setup_verdicts, vector_verdicts

_r4 = "CAST(printf('%.4f', {0}) AS DOUBLE) AS {0}"
_RATES = ", ".join(_r4.format(x) for x in ("accuracy", "precision", "recall", "f1", "avg_latency_ms"))


@query(f"WITH {V.CASES} SELECT expected, count(*) AS n FROM cases GROUP BY expected")
def case_balance(spark, folder):
    return E.case_balance(V.cases(spark, folder))


@query(f"""WITH {V.VERDICTS}, {V.counts_cte()}
SELECT setup, total, tp, fn, fp, tn, tp + fp AS blocked, tp + tn AS correct FROM counts""")
def confusion(spark, folder):
    return E.confusion(V.verdicts(spark, folder)).drop("errors", "avg_latency_ms")


@query(f"""WITH {V.VERDICTS}, {V.P95}, {V.counts_cte()}
SELECT m.setup, total, tp, fn, fp, tn, {_RATES}, p95_latency_ms
FROM metrics m LEFT JOIN p95 ON m.setup = p95.setup""")
def eval_metrics(spark, folder):
    return E.rounded_metrics(E.eval_metrics(V.verdicts(spark, folder)))


@query(f"WITH {V.VERDICTS}, {V.P95} SELECT setup, p95_latency_ms FROM p95")
def p95_latency(spark, folder):
    return E.p95_latency(V.verdicts(spark, folder))


@query(f"""WITH {V.MODEL_REPLIES}
SELECT setup, count(*) FILTER (reply IS NULL OR starts_with(reply, 'ERROR')) AS errors
FROM replies GROUP BY setup""")
def error_count(spark, folder):
    replies = reply_verdicts(V.model_replies(spark, folder))
    return E.confusion(replies).select("setup", "errors")


_MISSES = """missed AS (
  SELECT setup, case_id, CASE WHEN expected THEN 'FN' ELSE 'FP' END AS label, substr(text, 1, 80) AS text
  FROM verdicts WHERE expected <> actual)"""


@query(f"WITH {V.VERDICTS}, {_MISSES} SELECT * FROM missed")
def misses(spark, folder):
    return E.misses(V.verdicts(spark, folder))


@query(f"""WITH {V.VERDICTS}, {_MISSES}
SELECT setup, case_id, label, text, CAST(rank AS INTEGER) AS rank, n_misses,
       greatest(n_misses - 8, 0) AS more
FROM (SELECT *, row_number() OVER (PARTITION BY setup ORDER BY case_id) AS rank,
             count(*) OVER (PARTITION BY setup) AS n_misses FROM missed)
WHERE rank <= 8""")
def top_misses(spark, folder):
    return E.top_misses(V.verdicts(spark, folder))


@query(f"WITH {V.CASES} SELECT case_id, expected FROM cases WHERE case_id < 60")
def first_cases(spark, folder):
    return E.first_cases(V.cases(spark, folder), 60).select("case_id", "expected")


@query(f"""WITH {V.VERDICTS}
SELECT setup, case_id, actual FROM verdicts WHERE setup IN ('narrow', 'full', 'regex') AND setup <> 'regex'""")
def select_setups(spark, folder):
    chosen = E.select_setups(V.verdicts(spark, folder), ["narrow", "full", "regex"], ["regex"])
    return chosen.select("setup", "case_id", "actual")


_f = "printf('%.{1}f', {0})"
_SUMMARY = f"""WITH {V.VERDICTS}, {V.P95}, {V.counts_cte()}
SELECT m.setup AS "Setup", printf('%.4f', accuracy) AS "Accuracy", printf('%.4f', precision) AS "Precision",
       printf('%.4f', recall) AS "Recall", printf('%.4f', f1) AS "F1", fn AS "FalseNegatives",
       fp AS "FalsePositives", printf('%.1f', avg_latency_ms) AS "AvgLatencyMs",
       printf('%.1f', p95_latency_ms) AS "P95LatencyMs"
FROM metrics m LEFT JOIN p95 ON m.setup = p95.setup"""


@query(_SUMMARY)
def summary_export(spark, folder):
    return E.summary_export(E.eval_metrics(V.verdicts(spark, folder)))


@query(f"""WITH {V.VERDICTS}
SELECT case_id, expected, {', '.join(f"bool_or(actual) FILTER (setup = '{s}') AS {s}" for s in V.SETUPS)},
       {', '.join(f"printf('%.1f', max(latency_ms) FILTER (setup = '{s}')) AS {s}_ms" for s in V.SETUPS)}
FROM verdicts GROUP BY case_id, expected""")
def detail_pivot(spark, folder):
    return E.detail_pivot(V.verdicts(spark, folder), list(V.SETUPS))


_SHOWN = f"""{V.VERDICTS}, {V.P95}, {V.counts_cte()},
shown AS (
  SELECT m.setup, {', '.join(f"printf('%.1f', {n} * 100) || '%' AS {n}" for n in ('accuracy', 'precision', 'recall', 'f1'))},
         fn, fp, printf('%.0f', avg_latency_ms) || 'ms' AS avg, printf('%.0f', p95_latency_ms) || 'ms' AS p95
  FROM metrics m LEFT JOIN p95 ON m.setup = p95.setup)"""


@query(f"WITH {_SHOWN} SELECT * FROM shown")
def format_metrics(spark, folder):
    return E.format_metrics(E.eval_metrics(V.verdicts(spark, folder)))


@query(f"""WITH {_SHOWN}
SELECT 1 AS section, setup, CAST(0 AS BIGINT) AS line_no,
       '| ' || concat_ws(' | ', setup, accuracy, precision, recall, f1, fn, fp, avg, p95) || ' |' AS line
FROM shown
UNION ALL
SELECT 2, setup, case_id,
       CASE WHEN expected THEN '- 🔴 False Negative: *' ELSE '- 🟡 False Positive: *' END || text || '*'
FROM verdicts WHERE expected <> actual""")
def report_lines(spark, folder):
    verdicts = V.verdicts(spark, folder)
    return E.report_lines(E.eval_metrics(verdicts), verdicts)


# set-ups in the form they are benchmarked in: rules on scrubbed or masked text, vectors, all in turn
_WORDS = tuple(V.SIGNAL_WORDS)
_BENCH = {
    "scrub+rules": [Scrub("bench"), Rules(_WORDS, tuple(V.CODE_PATTERNS))],
    "mask+keywords": [Scrub("bench3"), Rules(_WORDS)],
    "models+few": [Scrub("models"), Rules(_WORDS[:4])],
    "masked rules": [Mask(), Rules(_WORDS)],
    "vectors": [Scrub("bench"), Vectors()],
    "layered": [Mask(), Rules(_WORDS, tuple(V.CODE_PATTERNS)), Vectors()],
    "custom": [Custom(lambda text, lowered: F.length(text) > 2000)],
}


def _bench_sql() -> str:
    from palisade.catalog.gate_queries import _any_pattern

    parts = []
    for name, steps in _BENCH.items():
        text, tests = "text", []
        for step in steps:
            if isinstance(step, Scrub):
                text = P.scrub_sql(step.profile)
            elif isinstance(step, Mask):
                text = P.masked_sql()
            elif isinstance(step, Vectors):
                tests.append(f"coalesce(similarity >= {step.threshold}, FALSE)")
            elif isinstance(step, Custom):
                tests.append("length(s) > 2000")
            else:
                tests += [f"contains(lower(s), '{w}')" for w in step.keywords]
                tests += [_any_pattern("s", step.patterns)] if step.patterns else []
        parts.append(
            f"SELECT '{name}' AS setup, case_id, expected, latency_ms, ({' OR '.join(tests)}) AS actual "
            f"FROM (SELECT *, {text} AS s FROM scored_cases)"
        )
    return V.SCORED_CASES + ",\nverdicts AS (" + "\nUNION ALL\n".join(parts) + ")"


@query(f"""WITH {_bench_sql()}, {V.P95}, {V.counts_cte()}
SELECT m.setup, total, tp, fn, fp, tn, {_RATES}, p95_latency_ms
FROM metrics m LEFT JOIN p95 ON m.setup = p95.setup""")
def setup_benchmark(spark, folder):
    known = V.vectors(spark, folder).select(F.col("chunk_id").alias("case_id"), "vector")
    cases = V.cases(spark, folder).join(known, "case_id", "left")
    return E.rounded_metrics(E.eval_metrics(setup_verdicts(cases, _BENCH, V.topics(spark, folder))))


# models by their replies, and a similarity gate beside them
@query(f"""WITH {V.MODEL_REPLIES}, {V.SCORED_CASES.removeprefix(V.CASES + ',')},
judged AS (
  SELECT setup, case_id, expected, latency_ms, reply IS NULL OR starts_with(reply, 'ERROR') AS failed,
         coalesce(NOT starts_with(reply, 'ERROR') AND contains(upper(reply), 'BLOCKED'), false) AS actual
  FROM replies
  UNION ALL
  SELECT 'embeddings', case_id, expected, latency_ms, similarity IS NULL, coalesce(similarity >= 0.38, false)
  FROM scored_cases), {V.counts_cte('judged')}
SELECT m.setup, total, tp, fn, fp, tn, {_RATES},
       (SELECT count(*) FROM judged j WHERE j.setup = m.setup AND failed) AS errors
FROM metrics m""")
def model_benchmark(spark, folder):
    said = reply_verdicts(V.model_replies(spark, folder))
    verdicts = said.unionByName(vector_verdicts(V.scored_cases(spark, folder)))
    counts = E.with_rates(E.confusion(verdicts))
    rates = ("accuracy", "precision", "recall", "f1", "avg_latency_ms")
    return counts.select(
        "setup", "total", "tp", "fn", "fp", "tn", "errors", *[rounded(F.col(n), 4).alias(n) for n in rates]
    )


_THRESHOLDS = [round(0.05 * i, 2) for i in range(15)]
_SWEEP = f"""WITH {V.SCORED_CASES},
grid(threshold) AS (VALUES {', '.join(f'(CAST({t} AS DOUBLE))' for t in _THRESHOLDS)}),
judged AS (
  SELECT lang, threshold, expected, coalesce(similarity >= threshold, FALSE) AS actual FROM scored_cases, grid),
counts AS (
  SELECT lang, threshold, count(*) AS total, count(*) FILTER (expected AND actual) AS tp,
         count(*) FILTER (expected AND NOT actual) AS fn, count(*) FILTER (NOT expected AND actual) AS fp,
         count(*) FILTER (NOT expected AND NOT actual) AS tn
  FROM judged GROUP BY lang, threshold),
rates AS (
  SELECT *, (tp + tn) / total AS accuracy, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS precision,
         CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS recall
  FROM counts),
swept AS (
  SELECT *, CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM rates)"""
_SWEPT = ", ".join(_r4.format(x) for x in ("accuracy", "precision", "recall", "f1"))


def _swept(spark, folder):
    return E.threshold_sweep(V.scored_cases(spark, folder), _THRESHOLDS, by="lang")


def _shown_sweep(sweep):
    rates = [rounded(F.col(n), 4).alias(n) for n in ("accuracy", "precision", "recall", "f1")]
    return sweep.select("lang", "threshold", "total", "tp", "fn", "fp", "tn", *rates)


@query(f"{_SWEEP} SELECT lang, threshold, total, tp, fn, fp, tn, {_SWEPT} FROM swept")
def threshold_sweep(spark, folder):
    """The similarity gate at fifteen thresholds per language, from one pass."""
    return _shown_sweep(_swept(spark, folder))


@query(f"""{_SWEEP} SELECT lang, threshold, total, tp, fn, fp, tn, {_SWEPT}
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY f1 DESC, threshold) AS rn FROM swept) WHERE rn = 1""")
def best_threshold(spark, folder):
    return _shown_sweep(E.best_threshold(_swept(spark, folder), by="lang"))
