"""Keyword, pattern, reply, similarity and layered gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from palisade.catalog import patterns_sql as P
from palisade.catalog import views as V
from palisade.catalog.registry import query
from palisade.functions import gates as G
from palisade.functions.formatting import rounded
from palisade.functions.vectors import cosine
from palisade.operators.evaluation import gate_summary
from palisade.operators.rules import rule_gate as gate
from palisade.operators.rules import rule_join as join_rules
from palisade.operators.semantic import semantic_gate as similarity_gate
from palisade.plans import gateway
from palisade.session import local_table

WORDS = V.SIGNAL_WORDS
THRESHOLD = V.SIMILARITY_THRESHOLD


def _first_word(text: str, words=WORDS) -> str:
    tests = " ".join(f"WHEN contains(lower({text}), '{w}') THEN '{w}'" for w in words)
    return f"CASE {tests} END"


def _any_pattern(text: str, patterns=tuple(V.CODE_PATTERNS)) -> str:
    return " OR ".join(
        f"regexp_matches({text}, {P.quoted('(?i)' + P.unicode_classes(p))})" for p in patterns
    )


def _verdict(keyword: str, pattern: str) -> str:
    return (
        f"CASE WHEN {keyword} IS NOT NULL THEN 'BLOCKED (keyword: ''' || {keyword} || ''')' "
        f"WHEN {pattern} THEN 'BLOCKED (pattern match)' ELSE 'CLEAN' END"
    )


@query(f"SELECT doc_id, {_first_word('text')} AS keyword FROM documents")
def keyword_gate(spark, folder):
    return gate(V.texts(spark, folder), WORDS, []).select("doc_id", "keyword")


@query(f"SELECT doc_id, {_any_pattern('text')} AS pattern_match FROM documents")
def pattern_gate(spark, folder):
    return gate(V.texts(spark, folder), [], V.CODE_PATTERNS).select("doc_id", "pattern_match")


@query(f"""SELECT doc_id, {_verdict('kw', 'pat')} AS verdict FROM (
  SELECT doc_id, {_first_word('text')} AS kw, {_any_pattern('text')} AS pat FROM documents)""")
def rule_gate(spark, folder):
    return gate(V.texts(spark, folder), WORDS, V.CODE_PATTERNS).select("doc_id", "verdict")


# rules held in a table: one policy per language, its keywords all words of the
# benchmark items in item order, the patterns common to all
@query(f"""WITH words AS (
  SELECT item_id, unnest(string_split(text, ' ')) AS rule,
         generate_subscripts(string_split(text, ' '), 1) - 1 AS pos FROM benchmark),
keywords AS MATERIALIZED (
  SELECT (['en', 'fr', 'de', 'es'])[item_id % 4 + 1] AS policy_name, rule, lower(rule) AS lowered,
         item_id // 4 * 4294967296 + pos AS ord
  FROM words WHERE length(rule) > 0),
texts AS MATERIALIZED (SELECT doc_id, lang, lower(text) AS lowered FROM documents),
first_hit AS (
  SELECT d.doc_id, arg_min(k.rule, k.ord) AS keyword
  FROM texts d JOIN keywords k ON k.policy_name = d.lang AND contains(d.lowered, k.lowered)
  GROUP BY d.doc_id)
SELECT d.doc_id, h.keyword, {_verdict('h.keyword', f"({_any_pattern('d.text')})")} AS verdict
FROM documents d LEFT JOIN first_hit h ON d.doc_id = h.doc_id""")
def rule_join(spark, folder):
    out = join_rules(
        V.texts(spark, folder).withColumnRenamed("lang", "policy_name"), _rules(spark, folder)
    )
    return out.select("doc_id", "keyword", "verdict")


def _rules(spark, folder):
    """(policy_name, kind, ord, rule) from the benchmark items."""
    languages = ("en", "fr", "de", "es")
    item = F.col("item_id")
    keywords = (
        V.table(spark, folder, "benchmark")
        .select("item_id", F.posexplode(F.split("text", " ")).alias("pos", "rule"))
        .select(
            F.element_at(F.array(*[F.lit(x) for x in languages]), (item % 4 + 1).cast("int")).alias("policy_name"),
            F.lit("keyword").alias("kind"),
            (F.floor(item / 4) * F.lit(1 << 32) + F.col("pos")).alias("ord"),
            "rule",
        )
    )
    rows = [(n, "pattern", i, p) for n in languages for i, p in enumerate(V.CODE_PATTERNS)]
    patterns = local_table(spark, ["policy_name", "kind", "ord", "rule"], rows)
    return keywords.unionByName(patterns)


@query("""SELECT doc_id, contains(text, 'Icarus') OR contains(lower(text), 'layoff') AS flagged,
       contains(text, 'Idiot') OR contains(lower(text), 'stupid') AS flagged_words FROM documents""")
def expected_flag(spark, folder):
    text = F.col("text")
    return V.texts(spark, folder).select(
        "doc_id",
        G.expected_flag(text).alias("flagged"),
        G.expected_flag(text, "Idiot", "stupid").alias("flagged_words"),
    )


@query(f"""WITH {V.MODEL_REPLIES}
SELECT setup, case_id,
       CASE WHEN contains(upper(coalesce(reply, '')), 'BLOCKED') THEN 'BLOCKED' ELSE 'CLEAN' END AS verdict
FROM replies""")
def normalize_verdict(spark, folder):
    return V.model_replies(spark, folder).select(
        "setup", "case_id", G.normalize_reply(F.col("reply")).alias("verdict")
    )


@query(f"""WITH {V.MODEL_REPLIES}
SELECT setup, case_id, status, status = 'BLOCKED' AS blocked,
       status <> 'CLEAN' AS blocked_if_closed
FROM (SELECT setup, case_id,
        CASE WHEN reply IS NULL OR starts_with(reply, 'ERROR') THEN 'ERROR'
             WHEN starts_with(reply, 'SKIP') THEN 'SKIP'
             WHEN contains(upper(reply), 'BLOCKED') THEN 'BLOCKED' ELSE 'CLEAN' END AS status
      FROM replies)""")
def verdict_status(spark, folder):
    status = G.verdict_status(F.col("reply"))
    return V.model_replies(spark, folder).select("setup", "case_id", status.alias("status")).select(
        "setup",
        "case_id",
        "status",
        G.counts_as_blocked(F.col("status")).alias("blocked"),
        G.counts_as_blocked(F.col("status"), fail_closed=True).alias("blocked_if_closed"),
    )


@query(f"""WITH scrubbed AS (SELECT doc_id, {P.scrub_sql('lab')} AS s FROM documents),
gated AS (SELECT doc_id, s, {_first_word('s')} AS kw, {_any_pattern('s')} AS pat FROM scrubbed)
SELECT doc_id, verdict, CASE WHEN verdict = 'CLEAN' THEN s END AS handed_on
FROM (SELECT *, {_verdict('kw', 'pat')} AS verdict FROM gated)""")
def secure_gateway(spark, folder):
    out = gateway.secure_gateway(V.texts(spark, folder), WORDS, V.CODE_PATTERNS)
    return out.select("doc_id", "verdict", "handed_on")


@query(f"""WITH {V.CENTROIDS}
SELECT c.chunk_id, CAST(printf('%.4f', list_cosine_similarity(c.vector, q.vector)) AS DOUBLE) AS similarity
FROM corpus c JOIN centroids q ON c.collection = q.collection""")
def cosine_pairs(spark, folder):
    means = V.centroids(spark, folder).withColumnRenamed("vector", "mean")
    paired = V.vectors(spark, folder).join(means, "collection")
    return paired.select(
        "chunk_id", rounded(cosine(F.col("vector"), F.col("mean")), 4).alias("similarity")
    )


SEMANTIC = f"""CASE WHEN similarity IS NULL THEN 'SKIP (embeddings unavailable)'
  WHEN similarity >= {THRESHOLD}
  THEN 'BLOCKED (similarity: ' || printf('%.2f', similarity) || ', topic: ''' || topic || ''')'
  ELSE 'CLEAN (max similarity: ' || printf('%.2f', similarity) || ')' END"""


@query(f"""WITH {V.BEST_TOPIC}
SELECT chunk_id, topic, CAST(printf('%.4f', similarity) AS DOUBLE) AS similarity,
       {SEMANTIC} AS semantic_check FROM best""")
def semantic_gate(spark, folder):
    out = similarity_gate(V.vectors(spark, folder), V.topics(spark, folder), THRESHOLD)
    return out.select(
        "chunk_id", "topic", rounded(F.col("similarity"), 4).alias("similarity"), "semantic_check"
    )


LAYERED = f"""{V.BEST_TOPIC},
masked AS (SELECT doc_id, source, n_chars, {P.masked_sql()} AS scrubbed FROM documents),
ruled AS (SELECT *, {_first_word('scrubbed')} AS kw, {_any_pattern('scrubbed')} AS pat FROM masked),
checked AS (SELECT *, {_verdict('kw', 'pat')} AS keyword_check FROM ruled),
audited AS (
  SELECT c.*, CASE WHEN keyword_check = 'CLEAN' THEN {SEMANTIC} ELSE 'SKIPPED' END AS semantic_check
  FROM checked c LEFT JOIN best b ON c.doc_id = b.chunk_id),
layered AS (
  SELECT *, CASE WHEN keyword_check = 'CLEAN' THEN semantic_check ELSE keyword_check END AS final_verdict
  FROM audited)"""


def _layered(spark, folder):
    vectors = V.vectors(spark, folder).select(F.col("chunk_id").alias("doc_id"), "vector")
    inputs = V.texts(spark, folder).join(vectors, "doc_id", "left")
    return gateway.layered_gate(
        inputs, V.topics(spark, folder), WORDS, V.CODE_PATTERNS, threshold=THRESHOLD
    )


@query(f"""WITH {LAYERED}
SELECT doc_id, scrubbed, keyword_check, semantic_check, final_verdict,
       starts_with(final_verdict, 'BLOCKED') AS blocked FROM layered""")
def layered_gate(spark, folder):
    return _layered(spark, folder).select(
        "doc_id", "scrubbed", "keyword_check", "semantic_check", "final_verdict", "blocked"
    )


@query(f"""WITH {LAYERED}
SELECT source, count(*) FILTER (starts_with(final_verdict, 'BLOCKED')) AS blocked, count(*) AS total,
       CAST(printf('%.4f', avg(n_chars / 100.0)) AS DOUBLE) AS avg_latency_ms
FROM layered GROUP BY source""")
def gateway_summary(spark, folder):
    audited = _layered(spark, folder).withColumn("latency_ms", F.col("n_chars") / 100)
    return gate_summary(audited, "source")


def _by_policy(of_policy, otherwise: str = "NULL") -> str:
    tests = " ".join(f"WHEN '{p[0]}' THEN {of_policy(p)}" for p in V.POLICIES)
    return f"CASE policy {tests} ELSE {otherwise} END"


_TOPIC_ROWS = ", ".join(f"('{p[0]}', {i}, '{t}')" for p in V.POLICIES for i, t in enumerate(p[3]))
POLICY_GATEWAY = f"""WITH {V.CENTROIDS},
chosen AS (
  SELECT doc_id, text, CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 13 = 0 THEN 'gone' ELSE lang END AS policy
  FROM documents),
masked AS (SELECT doc_id, policy, {_by_policy(lambda p: P.masked_sql(p[5]))} AS scrubbed FROM chosen),
ruled AS (
  SELECT *, {_by_policy(lambda p: _first_word('scrubbed', p[1]) if p[1] else 'NULL')} AS kw,
         {_by_policy(lambda p: _any_pattern('scrubbed', p[2]) if p[2] else 'FALSE', 'FALSE')} AS pat
  FROM masked),
checked AS (
  SELECT *, CASE WHEN policy IS NULL OR policy NOT IN ({', '.join(f"'{p[0]}'" for p in V.POLICIES)})
                 THEN 'ERROR (no policy)' ELSE {_verdict('kw', 'pat')} END AS keyword_check,
         {_by_policy(lambda p: f'CAST({p[4]} AS DOUBLE)')} AS threshold
  FROM ruled),
policy_topics(policy, ord, topic) AS (VALUES {_TOPIC_ROWS}),
scores AS (
  SELECT c.doc_id, t.ord, t.topic, round(list_cosine_similarity(v.vector, q.vector), 12) AS similarity
  FROM checked c JOIN corpus v ON c.doc_id = v.chunk_id JOIN policy_topics t ON t.policy = c.policy
  JOIN centroids q ON 'topic ' || q.collection = t.topic),
nearest AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY similarity DESC, ord) = 1),
audited AS (
  SELECT c.*, CASE WHEN keyword_check = 'CLEAN' THEN {SEMANTIC.replace(str(THRESHOLD), 'threshold')} ELSE 'SKIPPED' END AS semantic_check
  FROM checked c LEFT JOIN nearest n ON c.doc_id = n.doc_id),
judged AS (
  SELECT *, CASE WHEN keyword_check = 'CLEAN' THEN semantic_check ELSE keyword_check END AS final_verdict FROM audited)
SELECT doc_id, policy AS policy_name, scrubbed, keyword_check, semantic_check, final_verdict,
       starts_with(final_verdict, 'BLOCKED') AS blocked FROM judged"""


@query(POLICY_GATEWAY)
def policy_gateway(spark, folder):
    """Every text by the policy it names: its own entities, rules, topics and threshold."""
    topics = V.topics(spark, folder).select("topic", "vector")
    out = gateway.policy_gateway(V.addressed_texts(spark, folder), V.policies(spark), topics)
    return out.select(
        "doc_id", "policy_name", "scrubbed", "keyword_check", "semantic_check", "final_verdict", "blocked"
    )
