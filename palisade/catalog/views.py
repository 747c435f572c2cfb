"""Views over the given tables, each as a DataFrame and as a SQL common table
expression of the same content."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palisade.fixed_values import CALL_PRICES, DEFAULT_ENTITIES, TIER_PRICES
from palisade.functions import scoring as S
from palisade.functions.redaction import DEFAULT_REGISTRY, with_pattern
from palisade.operators.semantic import best_topic
from palisade.plans.setups import Setup, setup_verdicts
from palisade.sources import schemas

# Words that mark the toxic documents.
SIGNAL_WORDS = [
    "trash", "clown", "idiot", "scum", "worthless", "moron", "pathetic", "loser",
    "disgusting", "stupid",
]
CODE_PATTERNS = [r"\bsrc-\d+\b", r"token = .[0-9a-f]{40}"]
REGISTRY = with_pattern(DEFAULT_REGISTRY, "TOKEN", r"[0-9a-f]{40}")
SIMILARITY_THRESHOLD = 0.30


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(spark, folder) -> DataFrame:
    documents = table(spark, folder, "documents")
    return documents.select("doc_id", "text", "lang", "source", "n_chars")


# --- labelled cases and verdicts -------------------------------------------------


def cases(spark, folder) -> DataFrame:
    labels = table(spark, folder, "labels").select("doc_id", (F.col("toxic") == 1).alias("expected"))
    return texts(spark, folder).join(labels, "doc_id").select(
        F.col("doc_id").alias("case_id"),
        "text",
        "expected",
        (F.col("n_chars") / 100).alias("latency_ms"),
        "source",
        "lang",
    )


SETUPS = {
    "narrow": Setup(SIGNAL_WORDS[:4]),
    "full": Setup(SIGNAL_WORDS),
    "broad": Setup([*SIGNAL_WORDS, "this"]),
    "regex": Setup(patterns=["|".join(SIGNAL_WORDS)]),
}


def verdicts(spark, folder) -> DataFrame:
    return setup_verdicts(cases(spark, folder).drop("source", "lang"), SETUPS)


def scored_cases(spark, folder) -> DataFrame:
    """The cases with the vector of the same id and its similarity to the nearest topic."""
    known = vectors(spark, folder).select(F.col("chunk_id").alias("case_id"), "vector")
    return best_topic(cases(spark, folder).join(known, "case_id", "left"), topics(spark, folder))


CASES = """cases AS (
  SELECT d.doc_id AS case_id, d.text, l.toxic = 1 AS expected,
         d.n_chars / 100.0 AS latency_ms, d.source, d.lang
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


def _any_word(words: list[str]) -> str:
    return " OR ".join(f"contains(lower(text), '{w}')" for w in words)


VERDICTS = CASES + ",\nverdicts AS (" + "\n  UNION ALL\n".join(
    f"""  SELECT '{name}' AS setup, case_id, text, expected, latency_ms, ({test}) AS actual
  FROM cases"""
    for name, test in {
        "narrow": _any_word(SIGNAL_WORDS[:4]),
        "full": _any_word(SIGNAL_WORDS),
        "broad": _any_word([*SIGNAL_WORDS, "this"]),
        "regex": f"regexp_matches(text, '(?i){'|'.join(SIGNAL_WORDS)}')",
    }.items()
) + ")"

P95 = """p95 AS (
  SELECT setup, latency_ms AS p95_latency_ms FROM (
    SELECT setup, latency_ms,
           row_number() OVER (PARTITION BY setup ORDER BY latency_ms) AS rn,
           count(*) OVER (PARTITION BY setup) AS n
    FROM verdicts)
  WHERE rn = least(CAST(floor(n * CAST(0.95 AS DOUBLE)) AS BIGINT) + 1, n))"""


def counts_cte(source: str = "verdicts") -> str:
    return f"""counts AS (
  SELECT setup, count(*) AS total,
         count(*) FILTER (expected AND actual) AS tp,
         count(*) FILTER (expected AND NOT actual) AS fn,
         count(*) FILTER (NOT expected AND actual) AS fp,
         count(*) FILTER (NOT expected AND NOT actual) AS tn,
         avg(latency_ms) AS avg_latency_ms
  FROM {source} GROUP BY setup),
rates AS (
  SELECT *, (tp + tn) / total AS accuracy,
         CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS precision,
         CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS recall
  FROM counts),
metrics AS (
  SELECT *, CASE WHEN precision + recall = 0 THEN 0
                 ELSE 2 * precision * recall / (precision + recall) END AS f1
  FROM rates)"""


# --- replies of gate models to the cases ------------------------------------------


def model_replies(spark, folder) -> DataFrame:
    """Three models' replies to each case, as different in form as real ones are."""
    base = cases(spark, folder)
    wrong = F.col("case_id") % 7
    said = F.when(F.col("expected"), F.lit(" Blocked.\n")).otherwise(F.lit("CLEAN"))
    replies = F.array(
        F.struct(F.lit("steady").alias("setup"), said.alias("reply")),
        F.struct(
            F.lit("hasty").alias("setup"),
            F.when(wrong == 0, F.lit("ERROR: timeout"))
            .when(wrong == 1, F.lit("The input is BLOCKED"))
            .otherwise(said)
            .alias("reply"),
        ),
        F.struct(
            F.lit("vague").alias("setup"),
            F.when(wrong == 2, F.lit("SKIP (no answer)"))
            .when(wrong == 3, F.lit(None).cast("string"))
            .otherwise(F.lit("clean"))
            .alias("reply"),
        ),
    )
    return base.select("case_id", "text", "expected", "latency_ms", F.inline(replies))


MODEL_REPLIES = CASES + """,
said AS (SELECT *, CASE WHEN expected THEN ' Blocked.' || chr(10) ELSE 'CLEAN' END AS s FROM cases),
replies AS (
  SELECT 'steady' AS setup, case_id, text, expected, latency_ms, s AS reply FROM said
  UNION ALL
  SELECT 'hasty', case_id, text, expected, latency_ms,
         CASE case_id % 7 WHEN 0 THEN 'ERROR: timeout' WHEN 1 THEN 'The input is BLOCKED' ELSE s END
  FROM said
  UNION ALL
  SELECT 'vague', case_id, text, expected, latency_ms,
         CASE case_id % 7 WHEN 2 THEN 'SKIP (no answer)' WHEN 3 THEN NULL ELSE 'clean' END
  FROM said)"""


# --- model runs -------------------------------------------------------------------


def events(spark, folder) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, folder, "events").withColumn("k", k)


def runs(spark, folder) -> DataFrame:
    raw = events(spark, folder).select(
        "event_id",
        "ts",
        F.date_format("ts", "'Run_'yyyyMMdd").alias("run"),
        F.col("event_type").alias("model"),
        (F.col("event_id") % 7).cast("int").alias("logic"),
        (F.col("user_id") % 11).cast("double").alias("correctness"),
        (F.col("k") / F.lit(5000.0)).alias("cost"),
        F.col("value").alias("latency"),
    )
    score = S.final_score(F.col("logic"), F.col("correctness"), F.col("cost"), F.col("latency"))
    return raw.withColumn("final_score", score)


FINAL_SCORE_SQL = """CAST(printf('%.1f', greatest(CAST(0 AS DOUBLE), least(CAST(100 AS DOUBLE),
    CAST(logic AS DOUBLE) / CAST(6 AS DOUBLE) * 100 * CAST(0.4 AS DOUBLE)
    + correctness * 10 * CAST(0.4 AS DOUBLE)
    - (greatest(CAST(0 AS DOUBLE), (cost - CAST(0.01 AS DOUBLE)) * 1000)
       + greatest(CAST(0 AS DOUBLE), (latency - 60) * CAST(0.5 AS DOUBLE)))))) AS DOUBLE)"""

RUNS = f"""raw_runs AS (
  SELECT event_id, ts, strftime(ts, 'Run_%Y%m%d') AS run, event_type AS model,
         CAST(event_id % 7 AS INTEGER) AS logic, CAST(user_id % 11 AS DOUBLE) AS correctness,
         CAST(json_extract_string(props, '$.k') AS INTEGER) / CAST(5000 AS DOUBLE) AS cost,
         value AS latency
  FROM events),
runs AS (SELECT *, {FINAL_SCORE_SQL} AS final_score FROM raw_runs)"""


# --- calls, replies and usage -----------------------------------------------------

CALL_MODELS = [model for model, _ in CALL_PRICES] + ["someone/unlisted-model"]


def _model_at(position):
    return F.element_at(F.array(*[F.lit(m) for m in CALL_MODELS]), (position % 11 + 1).cast("int"))


def calls(spark, folder) -> DataFrame:
    return events(spark, folder).select(
        "event_id",
        _model_at(F.col("event_id")).alias("model"),
        F.when(F.col("k") > 0, F.col("k") * 10_000 + F.col("user_id")).alias("total_tokens"),
    )


def _sql_list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


CALLS = f"""prices(model, rate) AS (VALUES {', '.join(f"('{m}', CAST({r} AS DOUBLE))" for m, r in CALL_PRICES)}),
calls AS (
  SELECT event_id, ({_sql_list(CALL_MODELS)})[event_id % 11 + 1] AS model,
         CASE WHEN k > 0 THEN k * 10000 + user_id END AS total_tokens
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events))"""


def _content():
    """Assistant text wrapped in some of the structural tags, with a box and bold marks."""
    n = F.col("conv_id")
    return F.concat(
        F.lit("  ┌─┐**<context>** "),
        F.col("text"),
        F.when(n % 2 == 0, F.lit(" <Task_Logic>")).otherwise(F.lit("")),
        F.when(n % 3 == 0, F.lit("<constraints><OUTPUT_FORMAT>")).otherwise(F.lit("")),
        F.when(n % 5 == 0, F.lit("<thought_process> ")).otherwise(F.lit("\n")),
    )


def replies(spark, folder) -> DataFrame:
    """(conv_id, turn, model, body, judge, latency): JSON bodies as a client stores them."""
    said = table(spark, folder, "conversations").where(F.col("role") == "assistant")

    def body(content, tokens):
        choice = F.struct(F.struct(content.alias("content")).alias("message"))
        return F.to_json(
            F.struct(
                F.array(choice).alias("choices"),
                F.struct(tokens.alias("total_tokens")).alias("usage"),
            )
        )

    rating = (F.col("conv_id") + F.col("turn")) % 12
    verdict = F.when(rating == 11, F.lit("n/a")).otherwise(
        F.concat(F.lit('Sure:\n{"rating": '), rating.cast("string"), F.lit("} done"))
    )
    tokens = F.when(F.col("turn") != 3, F.length("text") * 1000)
    return said.select(
        "conv_id",
        "turn",
        _model_at(F.col("conv_id") + F.col("turn")).alias("model"),
        body(_content(), tokens).alias("body"),
        body(verdict, F.lit(1)).alias("judge"),
        (F.length("text") / 10).alias("latency"),
    )


REPLIES = f"""replies AS (
  SELECT conv_id, turn, ({_sql_list(CALL_MODELS)})[(conv_id + turn) % 11 + 1] AS model,
         '  ┌─┐**<context>** ' || text
           || CASE WHEN conv_id % 2 = 0 THEN ' <Task_Logic>' ELSE '' END
           || CASE WHEN conv_id % 3 = 0 THEN '<constraints><OUTPUT_FORMAT>' ELSE '' END
           || CASE WHEN conv_id % 5 = 0 THEN '<thought_process>' || chr(8195) ELSE chr(10) END AS content,
         CASE WHEN (conv_id + turn) % 12 = 11 THEN 0 ELSE (conv_id + turn) % 12 END AS rating,
         CASE WHEN turn <> 3 THEN length(text) * 1000 END AS total_tokens,
         length(text) / 10.0 AS latency
  FROM conversations WHERE role = 'assistant')"""

LOGIC_SQL = " + ".join(
    f"CAST(contains(lower(content), '{t}') AS INTEGER)"
    for t in ("<context>", "<task_logic>", "<constraints>", "<output_format>", "<thought_process>", "<circuit_breaker>")
)


def usage(spark, folder) -> DataFrame:
    """Tokens per conversation, four characters each, with the role and tier it ran on."""
    conv = table(spark, folder, "conversations")
    size = F.floor(F.length("text") / 4)
    spoken = F.col("role") == "assistant"
    return conv.groupBy("conv_id").agg(
        F.coalesce(F.sum(F.when(~spoken, size)), F.lit(0)).alias("prompt_tokens"),
        F.coalesce(F.sum(F.when(spoken, size)), F.lit(0)).alias("completion_tokens"),
    ).select(
        F.concat(F.lit("call_"), F.col("conv_id").cast("string")).alias("label"),
        F.when(F.col("conv_id") % 2 == 0, F.lit("A")).otherwise(F.lit("B")).alias("tier"),
        F.element_at(
            F.array(F.lit("baseline"), F.lit("rag"), F.lit("fast")),
            (F.col("conv_id") % 3 + 1).cast("int"),
        ).alias("role"),
        "prompt_tokens",
        "completion_tokens",
    )


def _tier_row(row) -> str:
    tier, role, name, model, cost_in, cost_out = row
    return f"('{tier}', '{role}', '{name}', '{model}', CAST({cost_in} AS DOUBLE), CAST({cost_out} AS DOUBLE))"


USAGE = f"""tier_prices(tier, role, model_name, model_id, input_cost, output_cost) AS (
  VALUES {', '.join(_tier_row(r) for r in TIER_PRICES)}),
usage AS (
  SELECT 'call_' || conv_id AS label, CASE WHEN conv_id % 2 = 0 THEN 'A' ELSE 'B' END AS tier,
         (['baseline', 'rag', 'fast'])[conv_id % 3 + 1] AS role,
         coalesce(CAST(sum(length(text) // 4) FILTER (role <> 'assistant') AS BIGINT), 0) AS prompt_tokens,
         coalesce(CAST(sum(length(text) // 4) FILTER (role = 'assistant') AS BIGINT), 0) AS completion_tokens
  FROM conversations GROUP BY conv_id),
token_costs AS (
  SELECT u.*, p.model_name, u.prompt_tokens * p.input_cost AS input_cost_usd,
         u.completion_tokens * p.output_cost AS output_cost_usd,
         u.prompt_tokens * p.input_cost + u.completion_tokens * p.output_cost AS total_cost_usd
  FROM usage u LEFT JOIN tier_prices p ON u.tier = p.tier AND u.role = p.role)"""


# --- vectors ----------------------------------------------------------------------


def vectors(spark, folder) -> DataFrame:
    """The corpus: one chunk per vector, its collection being the label."""
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("chunk_id"),
        F.col("label").alias("collection"),
        F.col("embedding").alias("vector"),
    )


def centroids(spark, folder) -> DataFrame:
    """(collection, vector): the mean vector of each label, averaged before any shuffle."""
    data = table(spark, folder, "embeddings")
    numbers = data.select(F.col("label").alias("collection"), F.posexplode("embedding").alias("i", "x"))
    means = numbers.groupBy("collection", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    listed = F.array_sort(F.collect_list(F.struct("i", "m")))
    return means.groupBy("collection").agg(F.transform(listed, lambda p: p["m"]).alias("vector"))


def topics(spark, folder) -> DataFrame:
    """(ord, topic, vector): each label's mean vector is a topic."""
    return centroids(spark, folder).select(
        F.col("collection").alias("ord"),
        F.concat(F.lit("topic "), F.col("collection").cast("string")).alias("topic"),
        "vector",
    )


def questions(spark, folder) -> DataFrame:
    """(query_id, collection, question, vector): one question per collection, the ids Q1 to Q3
    being used again and again."""
    return centroids(spark, folder).select(
        F.concat(F.lit("Q"), (F.col("collection") % 3 + 1).cast("string")).alias("query_id"),
        "collection",
        F.concat(F.lit("What is typical of "), F.col("collection").cast("string"), F.lit("?")).alias("question"),
        "vector",
    )


def chunk_texts(spark, folder) -> DataFrame:
    """The corpus with text and page: the document of the same id, where there is one."""
    documents = table(spark, folder, "documents").select(
        F.col("doc_id").alias("chunk_id"), "text"
    )
    joined = vectors(spark, folder).join(documents, "chunk_id", "left")
    return joined.withColumn("page_num", (F.col("chunk_id") % 90 + 1).cast("int")).withColumn(
        "text", F.coalesce("text", F.lit("(no text)"))
    )


CENTROIDS = """centroids AS (
  SELECT collection, list(m ORDER BY i) AS vector FROM (
    SELECT collection, i, avg(x) AS m FROM (
      SELECT label AS collection, CAST(unnest(embedding) AS DOUBLE) AS x,
             generate_subscripts(embedding, 1) AS i
      FROM embeddings)
    GROUP BY collection, i)
  GROUP BY collection),
corpus AS (
  SELECT vec_id AS chunk_id, label AS collection, CAST(embedding AS DOUBLE[]) AS vector FROM embeddings)"""

TOPK = CENTROIDS + """,
pairs AS (
  SELECT q.collection, 'Q' || (q.collection % 3 + 1) AS query_id, c.chunk_id,
         round(list_distance(q.vector, c.vector) ** 2, 12) AS exact
  FROM centroids q JOIN corpus c ON q.collection = c.collection),
topk AS (
  SELECT collection, query_id, CAST(rank AS INTEGER) AS rank, chunk_id,
         CAST(printf('%.4f', exact) AS DOUBLE) AS distance
  FROM (SELECT *, row_number() OVER (PARTITION BY collection, query_id ORDER BY exact, chunk_id) AS rank FROM pairs)
  WHERE rank <= 4)"""

BEST_TOPIC = CENTROIDS + """,
scores AS (
  SELECT c.chunk_id, 'topic ' || q.collection AS topic, q.collection AS ord,
         round(list_cosine_similarity(c.vector, q.vector), 12) AS similarity
  FROM corpus c CROSS JOIN centroids q),
best AS (
  SELECT chunk_id, topic, similarity FROM (
    SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY similarity DESC, ord) AS rn FROM scores)
  WHERE rn = 1)"""


SCORED_CASES = CASES + ",\n" + BEST_TOPIC + """,
scored_cases AS (SELECT c.*, b.similarity FROM cases c LEFT JOIN best b ON c.case_id = b.chunk_id)"""


# --- policies ---------------------------------------------------------------------

# (name, keywords, patterns, topics, threshold, entities): one policy a language
POLICIES = [
    ("en", SIGNAL_WORDS[:5], CODE_PATTERNS, ["topic 0", "topic 1", "topic 2", "topic 3"], 0.3, DEFAULT_ENTITIES),
    ("fr", SIGNAL_WORDS[5:], [], ["topic 3", "topic 4", "topic 5"], 0.25, ["EMAIL_ADDRESS", "IP_ADDRESS"]),
    ("de", ["zu klein", "und der"], CODE_PATTERNS[:1], ["topic 8", "topic 7", "topic 6"], 0.2, ["CREDIT_CARD"]),
    ("es", [], [], [], 0.3, []),
]


def policies(spark, rows=POLICIES) -> DataFrame:
    return spark.createDataFrame(rows, schemas.POLICY)


def addressed_texts(spark, folder) -> DataFrame:
    """Texts with the policy they name, some none and some an unknown one, and their vectors."""
    n = F.col("doc_id")
    named = F.when(n % 11 == 0, F.lit(None)).when(n % 13 == 0, F.lit("gone")).otherwise(F.col("lang"))
    known = vectors(spark, folder).select(F.col("chunk_id").alias("doc_id"), "vector")
    return table(spark, folder, "documents").select("doc_id", "text", named.alias("policy_name")).join(known, "doc_id", "left")


# --- pages and chunks -------------------------------------------------------------

# every character Python's strip removes
BLANKS = "' ' || " + " || ".join(
    f"chr({c})"
    for c in [9, 10, 11, 12, 13, 28, 29, 30, 31, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]
)

PAGES = f"""blanks AS MATERIALIZED (SELECT {BLANKS} AS b),
all_pages AS (
  SELECT doc_id, i AS page_num, trim(p, b) AS text FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS p,
           generate_subscripts(string_split(text, chr(10)), 1) AS i
    FROM documents), blanks),
pages_t AS (SELECT * FROM all_pages WHERE length(text) > 0)"""

CHUNKS = PAGES + """,
pieces AS (
  SELECT doc_id, page_num, s AS start, trim(substring(text, s + 1, 500), b) AS text FROM (
    SELECT doc_id, page_num, text, unnest(range(0, length(text), 400)) AS s FROM pages_t), blanks),
chunks AS (
  SELECT doc_id, n AS chunk_no, printf('chunk_%04d', n) AS chunk_id, page_num, start, text FROM (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY page_num, start) - 1 AS n
    FROM pieces WHERE length(text) > 0))"""
