"""Scoring model runs, exploring the run table, and costs."""

from __future__ import annotations

from pyspark.sql import functions as F

from palisade.catalog import views as V
from palisade.catalog.patterns_sql import quoted
from palisade.catalog.registry import query
from palisade.fixed_values import COMPILE_HEAD, JUDGE_HEAD, JUDGE_MIDDLE, PROMPT_TAIL, TIER_PRICES
from palisade.functions import scoring as S
from palisade.functions.formatting import price_label, rounded
from palisade.operators import costs as C
from palisade.operators import runs as R
from palisade.plans.calibration import cache_lookup
from palisade.plans.calibration import score_run as score

_PICKED_RUNS = ["Run_20240102", "Run_20240103", "Run_20240110"]


@query(f"WITH {V.RUNS} SELECT event_id, final_score FROM runs")
def final_score(spark, folder):
    return V.runs(spark, folder).select("event_id", "final_score")


@query(f"""WITH {V.RUNS}
SELECT event_id, run, model, final_score FROM runs
WHERE run IN ('Run_20240102', 'Run_20240103', 'Run_20240110') AND model IN ('click', 'view', 'error')
  AND final_score BETWEEN 10 AND 60""")
def filter_runs(spark, folder):
    kept = R.filter_runs(V.runs(spark, folder), _PICKED_RUNS, ["click", "view", "error"], 10.0, 60.0)
    return kept.select("event_id", "run", "model", "final_score")


@query(f"""WITH {V.RUNS}
SELECT 'cost' AS axis, run, model, cost AS x, final_score AS y FROM runs
UNION ALL SELECT 'latency', run, model, latency, final_score FROM runs""")
def score_points(spark, folder):
    runs = V.runs(spark, folder)
    axes = [R.score_points(runs, x).withColumn("axis", F.lit(x)) for x in ("cost", "latency")]
    return axes[0].unionByName(axes[1])


@query(f"WITH {V.RUNS} SELECT event_id, run, model, final_score FROM runs ORDER BY final_score DESC")
def sort_runs(spark, folder):
    return R.sort_runs(V.runs(spark, folder)).select("event_id", "run", "model", "final_score")


@query(f"""WITH {V.RUNS}
SELECT DISTINCT 'run' AS kind, run AS value FROM runs UNION ALL
SELECT DISTINCT 'model', model FROM runs UNION ALL
SELECT 'score_min', printf('%.1f', min(final_score)) FROM runs UNION ALL
SELECT 'score_max', printf('%.1f', max(final_score)) FROM runs""")
def filter_domains(spark, folder):
    return R.filter_domains(V.runs(spark, folder))


@query(f"""WITH {V.RUNS},
best AS (SELECT * FROM runs ORDER BY final_score DESC, run, model LIMIT 1),
cheapest AS (SELECT * FROM runs ORDER BY cost, run, model LIMIT 1),
fastest AS (SELECT * FROM runs ORDER BY latency, run, model LIMIT 1)
SELECT (SELECT count(*) FROM runs) AS n_rows, (SELECT count(DISTINCT run) FROM runs) AS n_runs,
       CAST(printf('%.3f', (SELECT avg(final_score) FROM runs)) AS DOUBLE) AS avg_score,
       b.model AS top_model, printf('%.3f', b.final_score) AS top_score,
       c.model AS cheapest_model, '$' || printf('%.4f', c.cost) AS lowest_cost,
       f.model AS fastest_model, printf('%.2f', f.latency) || 's' AS lowest_latency
FROM best b, cheapest c, fastest f""")
def summary_cards(spark, folder):
    return R.summary_cards(V.runs(spark, folder))


@query(f"""WITH {V.RUNS}
SELECT model, CAST(printf('%.6f', avg(final_score)) AS DOUBLE) AS avg_score FROM runs GROUP BY model""")
def model_ranking(spark, folder):
    return R.model_ranking(V.runs(spark, folder))


def _norm(value: str, low: str, high: str) -> str:
    return f"CASE WHEN {high} > {low} THEN ({value} - {low}) / ({high} - {low}) ELSE 0.5 END"


def _r6(text: str) -> str:
    return f"CAST(printf('%.6f', CAST({text} AS DOUBLE)) AS DOUBLE)"


@query(f"""WITH {V.RUNS},
means AS (SELECT model, avg(final_score) AS s, avg(cost) AS c, avg(latency) AS l FROM runs GROUP BY model),
ends AS (SELECT min(s) AS s0, max(s) AS s1, min(c) AS c0, max(c) AS c1, min(l) AS l0, max(l) AS l1 FROM means)
SELECT model, {_r6(_norm('s', 's0', 's1'))} AS score_norm,
       {_r6('1 - ' + _norm('c', 'c0', 'c1'))} AS cost_norm,
       {_r6('1 - ' + _norm('l', 'l0', 'l1'))} AS latency_norm,
       printf('%.3f', s) AS score_label, '$' || printf('%.4f', c) AS cost_label,
       printf('%.2f', l) || 's' AS latency_label
FROM means, ends""")
def model_heatmap(spark, folder):
    return R.model_heatmap(V.runs(spark, folder))


@query(f"""WITH {V.RUNS},
inv AS (SELECT *, CASE WHEN latency > 0 THEN 1 / latency END AS li, CASE WHEN cost > 0 THEN 1 / cost END AS ci FROM runs),
ranged AS (
  SELECT *, min(li) OVER w AS l0, max(li) OVER w AS l1, min(ci) OVER w AS c0, max(ci) OVER w AS c1
  FROM inv WINDOW w AS (PARTITION BY run)),
scored AS (
  SELECT event_id, run, model, CAST(0.6 AS DOUBLE) * (correctness / 10)
    + CAST(0.2 AS DOUBLE) * CASE WHEN li IS NULL THEN 1 ELSE {_norm('li', 'l0', 'l1')} END
    + CAST(0.2 AS DOUBLE) * CASE WHEN ci IS NULL THEN 1 ELSE {_norm('ci', 'c0', 'c1')} END AS score
  FROM ranged)
SELECT event_id, run, model, {_r6('score')} AS composite, {_r6('score')} > 0.85 AS strong FROM scored""")
def composite_score(spark, folder):
    return R.composite_score(V.runs(spark, folder)).select(
        "event_id", "run", "model", "composite", "strong"
    )


@query(f"""WITH {V.RUNS},
best AS (SELECT cost, max(final_score) AS s FROM runs GROUP BY cost),
ordered AS (
  SELECT *, max(s) OVER (ORDER BY cost ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM best)
SELECT event_id, run, model, r.cost, r.final_score
FROM runs r JOIN ordered o ON r.cost = o.cost AND r.final_score = o.s WHERE seen IS NULL OR s > seen""")
def pareto_frontier(spark, folder):
    return R.pareto_frontier(V.runs(spark, folder)).select(
        "event_id", "run", "model", "cost", "final_score"
    )


# --- replies ------------------------------------------------------------------------


@query(f"WITH {V.REPLIES} SELECT conv_id, turn, content, coalesce(total_tokens, 0) AS total_tokens FROM replies")
def parse_response(spark, folder):
    reply = S.parse_reply(F.col("body"))
    parsed = V.replies(spark, folder).withColumn("reply", reply)
    return parsed.select(
        "conv_id",
        "turn",
        S.reply_content(F.col("reply")).alias("content"),
        F.coalesce("reply.usage.total_tokens", F.lit(0)).alias("total_tokens"),
    )


@query(f"WITH {V.REPLIES} SELECT conv_id, turn, {V.LOGIC_SQL} AS logic FROM replies")
def logic_score(spark, folder):
    content = S.reply_content(S.parse_reply(F.col("body")))
    return V.replies(spark, folder).select("conv_id", "turn", S.logic_score(content).alias("logic"))


@query(f"WITH {V.REPLIES} SELECT conv_id, turn, CAST(rating AS DOUBLE) AS rating FROM replies")
def judge_rating(spark, folder):
    content = S.reply_content(S.parse_reply(F.col("judge")))
    return V.replies(spark, folder).select("conv_id", "turn", S.judge_rating(content).alias("rating"))


@query(f"""WITH {V.CALLS.split(',' + chr(10) + 'calls')[0]}, {V.REPLIES},
blanks AS MATERIALIZED (SELECT {V.BLANKS} AS b),
scored AS (
  SELECT conv_id, turn, r.model, {V.LOGIC_SQL} AS logic, CAST(rating AS DOUBLE) AS correctness,
         coalesce(total_tokens, 0) / CAST(1000000 AS DOUBLE) * coalesce(p.rate, CAST(0.15 AS DOUBLE)) AS cost,
         latency, trim(replace(translate(content, '┌─┐└┘│┤├┼┴┬║═╔╗╚╝╠╣╦╩╬', ''), '**', ''), b) AS clean
  FROM replies r LEFT JOIN prices p ON r.model = p.model, blanks)
SELECT conv_id, turn, model, logic, correctness, clean,
       CAST(printf('%.9f', cost) AS DOUBLE) AS cost, {V.FINAL_SCORE_SQL} AS final_score FROM scored""")
def score_run(spark, folder):
    out = score(V.replies(spark, folder), C.call_prices(spark))
    return out.select(
        "conv_id", "turn", "model", "logic", "correctness", "clean",
        rounded(F.col("cost"), 9).alias("cost"), "final_score",
    )


_KEY = "strftime(ts, '%Y-%m') || '_' || substr(sha256(prompt), 1, 10)"
_PROMPTS = """prompts AS (
  SELECT e.event_id, e.ts, d.text AS prompt
  FROM events e JOIN documents d ON d.doc_id = e.event_id % (SELECT count(*) FROM documents))"""


def _prompts(spark, folder):
    """Events that each send one of the documents as a prompt."""
    documents = V.table(spark, folder, "documents").select("doc_id", F.col("text").alias("prompt"))
    sent = (F.col("event_id") % documents.count()).alias("doc_id")
    asked = V.events(spark, folder).select("event_id", "ts", sent)
    return asked.join(documents, "doc_id").withColumn(
        "key", S.blueprint_key(F.col("prompt"), F.col("ts"))
    )


@query(f"WITH {_PROMPTS} SELECT event_id, {_KEY} AS key FROM prompts")
def blueprint_key(spark, folder):
    return _prompts(spark, folder).select("event_id", "key")


@query(f"""WITH {_PROMPTS},
keyed AS (SELECT *, {_KEY} AS key FROM prompts),
stored AS (
  SELECT DISTINCT '2024-01_' || substr(sha256(text), 1, 10) AS key FROM documents WHERE lang = 'en')
SELECT 'hit' AS outcome, key, count(*) AS n FROM keyed WHERE key IN (SELECT key FROM stored) GROUP BY key
UNION ALL
SELECT 'miss', key, 1 FROM keyed WHERE key NOT IN (SELECT key FROM stored) GROUP BY key""")
def blueprint_cache(spark, folder):
    stored = (
        V.table(spark, folder, "documents")
        .where(F.col("lang") == "en")
        .select(S.blueprint_key(F.col("text"), F.lit("2024-01-15").cast("timestamp")).alias("key"))
        .distinct()
        .withColumn("blueprint", F.lit("compiled"))
    )
    hits, missed = cache_lookup(_prompts(spark, folder), stored)
    found = hits.groupBy("key").agg(F.count("*").alias("n")).withColumn("outcome", F.lit("hit"))
    return found.unionByName(
        missed.select("key", F.lit(1).cast("bigint").alias("n"), F.lit("miss").alias("outcome"))
    )


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@query(f"""SELECT conv_id, turn, {_quote(COMPILE_HEAD)} || text || chr(10) AS compile_prompt,
  {_quote(JUDGE_HEAD)} || role || {_quote(JUDGE_MIDDLE)} || text || chr(10) AS judge_prompt FROM conversations""")
def prompt_templates(spark, folder):
    return V.table(spark, folder, "conversations").select(
        "conv_id",
        "turn",
        S.compile_prompt(F.col("text")).alias("compile_prompt"),
        S.judge_prompt(F.col("role"), F.col("text")).alias("judge_prompt"),
    )


# --- prices and costs ---------------------------------------------------------------


@query(f"""WITH {V.CALLS}
SELECT event_id, c.model, CAST(printf('%.9f', coalesce(total_tokens, 0) / CAST(1000000 AS DOUBLE)
       * coalesce(rate, CAST(0.15 AS DOUBLE))) AS DOUBLE) AS cost
FROM calls c LEFT JOIN prices p ON c.model = p.model""")
def call_cost(spark, folder):
    priced = C.with_call_cost(V.calls(spark, folder), C.call_prices(spark))
    return priced.select("event_id", "model", rounded(F.col("cost"), 9).alias("cost"))


@query(f"""WITH {V.CALLS}
SELECT c.model, any_value(rate) IS NOT NULL AS listed, coalesce(any_value(rate), CAST(0.15 AS DOUBLE)) AS rate,
       count(*) AS n_calls, CAST(coalesce(sum(total_tokens), 0) AS BIGINT) AS tokens
FROM calls c LEFT JOIN prices p ON c.model = p.model GROUP BY c.model""")
def price_dim(spark, folder):
    """Calls and tokens per model next to the price list, unlisted models included."""
    used = V.calls(spark, folder).groupBy("model").agg(
        F.count("*").alias("n_calls"), F.coalesce(F.sum("total_tokens"), F.lit(0)).alias("tokens")
    )
    return used.join(C.call_prices(spark), "model", "left").select(
        "model", F.col("rate").isNotNull().alias("listed"), F.coalesce("rate", F.lit(0.15)).alias("rate"),
        "n_calls", "tokens",
    )


_TIER_ROWS = ", ".join(f"('{tier}', '{role}', '{name}', '{model}')" for tier, role, name, model, *_ in TIER_PRICES)


@query(f"""WITH tiers(tier, role, name, id) AS (VALUES {_TIER_ROWS}),
asked AS (
  SELECT conv_id, (['A', 'b', 'a', 'Z', NULL])[conv_id % 5 + 1] AS tier,
         (['baseline', 'rag', 'fast', 'chess'])[conv_id % 4 + 1] AS role
  FROM (SELECT DISTINCT conv_id FROM conversations))
SELECT conv_id, a.tier, a.role, t.name AS model_name, t.id AS model_id,
       CASE WHEN a.tier IS NULL OR upper(a.tier) NOT IN ('A', 'B')
            THEN 'unknown tier ' || chr(39) || coalesce(a.tier, '') || chr(39)
            WHEN t.id IS NULL THEN 'no model for role ' || chr(39) || a.role || chr(39) END AS error
FROM asked a LEFT JOIN tiers t ON t.tier = upper(a.tier) AND t.role = a.role""")
def tier_lookup(spark, folder):
    """The model that a conversation's tier and role stand for; some tiers and roles are unknown."""
    n = F.col("conv_id")
    tiers = F.array(*[F.lit(x) for x in ("A", "b", "a", "Z", None)])
    roles = F.array(*[F.lit(x) for x in ("baseline", "rag", "fast", "chess")])
    asked = V.table(spark, folder, "conversations").select("conv_id").distinct().select(
        "conv_id", F.get(tiers, (n % 5).cast("int")).alias("tier"), F.get(roles, (n % 4).cast("int")).alias("role")
    )
    return C.with_tier_model(asked, C.tier_prices(spark))


@query(f"""SELECT conv_id, turn, {quoted(COMPILE_HEAD)} || text || {quoted(PROMPT_TAIL)} AS prompt
FROM conversations WHERE role = 'user'""")
def compile_prompt(spark, folder):
    asked = V.table(spark, folder, "conversations").where("role = 'user'")
    return asked.select("conv_id", "turn", S.compile_prompt(F.col("text")).alias("prompt"))


def _r9(text: str) -> str:
    return f"CAST(printf('%.9f', {text}) AS DOUBLE)"


_PRICE_LABEL = """CASE WHEN p.input_cost = 0 THEN 'FREE'
  ELSE '$' || printf('%.2f', p.input_cost * 1000000) || ' in / $' || printf('%.2f', p.output_cost * 1000000)
       || ' out per 1M tokens' END"""


@query(f"""WITH {V.USAGE}
SELECT t.label, t.tier, t.role, t.model_name, prompt_tokens, completion_tokens,
       {_r9('input_cost_usd')} AS input_cost_usd, {_r9('output_cost_usd')} AS output_cost_usd,
       {_r9('total_cost_usd')} AS total_cost_usd, {_PRICE_LABEL} AS price
FROM token_costs t JOIN tier_prices p ON t.tier = p.tier AND t.role = p.role""")
def token_cost(spark, folder):
    out = C.token_cost(V.usage(spark, folder), C.tier_prices(spark))
    costs = ("input_cost_usd", "output_cost_usd", "total_cost_usd")
    return out.select(
        "label", "tier", "role", "model_name", "prompt_tokens", "completion_tokens",
        *[rounded(F.col(c), 9).alias(c) for c in costs],
        price_label(F.col("input_cost"), F.col("output_cost")).alias("price"),
    )


@query(f"""WITH {V.USAGE},
lines AS (
  SELECT label, model_name, sum(prompt_tokens + completion_tokens) AS tokens, sum(total_cost_usd) AS c
  FROM token_costs GROUP BY label, model_name
  UNION ALL
  SELECT 'TOTAL', '', sum(prompt_tokens + completion_tokens), sum(total_cost_usd) FROM token_costs)
SELECT label, model_name, CAST(tokens AS BIGINT) AS tokens, {_r9('c')} AS cost,
       CASE WHEN c = 0 THEN 'FREE' ELSE '$' || lpad(printf('%.6f', c), 10, ' ') END AS cost_label FROM lines""")
def cost_rollup(spark, folder):
    return C.cost_rollup(C.token_cost(V.usage(spark, folder), C.tier_prices(spark)))


@query(f"""SELECT lang AS collection, CAST(sum(length(text) // 4) AS BIGINT) AS tokens,
       {_r9('sum(length(text) // 4) * CAST(0.00000002 AS DOUBLE)')} AS cost FROM documents GROUP BY lang""")
def embedding_cost(spark, folder):
    used = V.texts(spark, folder).select(
        F.col("lang").alias("collection"), F.floor(F.length("text") / 4).alias("tokens")
    )
    return C.embedding_cost(used, 0.00000002)
