"""Sources and sinks: data is written to a fresh scratch folder and read back."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from palisade.catalog import views as V
from palisade.catalog.evaluation_queries import _SUMMARY
from palisade.catalog.registry import query
from palisade.fixed_values import DEFAULT_TOPICS
from palisade.functions.formatting import rounded
from palisade.functions.scoring import blueprint_key
from palisade.functions.text import strip
from palisade.operators import embedding, retrieval
from palisade.operators.evaluation import eval_metrics
from palisade.operators.evaluation import summary_export as export
from palisade.operators.runs import filter_runs
from palisade.plans.calibration import cache_lookup
from palisade.session import scratch_path
from palisade.sources import readers, writers


@query(f"""WITH {V.RUNS} SELECT run || CASE WHEN model = 'click' THEN '_click' ELSE '_others' END AS run,
  model, logic, correctness, final_score, cost, latency FROM runs""")
def load_runs(spark, folder):
    path = scratch_path(spark, "runs")
    for kept in (F.col("model") == "click", F.col("model") != "click"):
        named = F.concat_ws("_", "run", F.when(F.col("model") == "click", F.lit("click")).otherwise(F.lit("others")))
        writers.write_runs(V.runs(spark, folder).where(kept).withColumn("run", named), path)
    return readers.load_runs(spark, path, run_from="partition")


@query(f"""WITH {V.RUNS}
SELECT model, logic, correctness, cost, latency, TRUE AS stamped, TRUE AS named FROM runs""")
def load_stamped_runs(spark, folder):
    """Runs without a name of their own: read once with the times of their files, once with the files'
    names; both say whether every name has the form it should have."""
    path = scratch_path(spark, "unnamed-runs")
    names = ("Model", "Logic", "Correctness", "Cost", "Latency")
    V.runs(spark, folder).select(*[F.col(n.lower()).alias(n) for n in names]).write.option("header", True).csv(path)
    by_time, by_name = readers.load_runs(spark, path), readers.load_runs(spark, path, run_from="filename")
    named = by_name.agg(F.bool_and(F.startswith("run", F.lit("part-"))).alias("named")).scalar()
    return by_time.select(
        *[n.lower() for n in names],
        F.rlike("run", F.lit(r"^Run_[0-9]{8}_[0-9]{6}$")).alias("stamped"),
        named.alias("named"),
    )


@query(f"""WITH {V.RUNS}
SELECT run, model, printf('%.1f', final_score) AS final_score FROM runs WHERE final_score BETWEEN 20 AND 50""")
def filtered_export(spark, folder):
    """The filtered view written as CSV and read back as text."""
    path = scratch_path(spark, "export")
    kept = filter_runs(V.runs(spark, folder), low=20.0, high=50.0)
    writers.write_csv(kept.select("run", "model", "final_score"), path)
    return spark.read.schema("run string, model string, final_score string").option("header", True).csv(path)


@query("""SELECT DISTINCT '2024-01_' || substr(sha256(text), 1, 10) AS key FROM documents""")
def blueprint_store(spark, folder):
    """Blueprints compiled in two rounds; the second only compiles what is missing."""
    path = scratch_path(spark, "blueprints")
    day = F.lit("2024-01-15").cast("timestamp")
    prompts = V.texts(spark, folder).select(
        F.col("text").alias("prompt"), blueprint_key(F.col("text"), day).alias("key"), "lang"
    )
    store = spark.createDataFrame([], "key string, blueprint string")
    for asked in (prompts.where(F.col("lang") == "en"), prompts):
        _, missing = cache_lookup(asked, store)
        compiled = missing.select("key", F.concat(F.lit("<context>"), "prompt").alias("blueprint"))
        writers.append_blueprints(compiled, path)
        store = spark.read.parquet(path)
    return store.select("key")


@query(f"""WITH {V.RUNS}
SELECT 'click_upload' AS run, model, final_score, cost, latency, CAST(logic AS VARCHAR) AS logic FROM runs WHERE model = 'click'
UNION ALL
SELECT 'others_upload', model, final_score, cost, latency, NULL FROM runs WHERE model <> 'click'""")
def union_uploads(spark, folder):
    runs = V.runs(spark, folder).select(
        F.col("model").alias("Model"), F.col("final_score").alias("Final Score"),
        F.col("cost").alias("Cost"), F.col("latency").alias("Latency"), F.col("logic").alias("Logic"),
    )
    first, second = scratch_path(spark, "click"), scratch_path(spark, "others")
    writers.write_csv(runs.where(F.col("Model") == "click"), first)
    writers.write_csv(runs.where(F.col("Model") != "click").drop("Logic"), second)
    return readers.union_uploads(spark, {"click_upload": first, "others_upload": second})


@query(f"""WITH {V.PAGES} SELECT text AS line FROM pages_t""")
def text_lines(spark, folder):
    path = scratch_path(spark, "lines")
    writers.write_lines(V.texts(spark, folder).select("text"), path)
    return readers.read_lines(spark, path)


@query(f"""WITH items AS (
  SELECT 'policy_' || item_id AS policy_name, item_id, list_distinct(string_split(text, ' ')) AS words FROM benchmark),
rules AS (
  SELECT policy_name, 'keyword' AS kind, unnest(words) AS rule, item_id FROM items WHERE item_id % 3 <> 0
  UNION ALL
  SELECT policy_name, 'pattern', unnest(['[0-9]+', 'x']), item_id FROM items WHERE item_id % 2 = 0
  UNION ALL
  SELECT policy_name, 'topic', unnest({V._sql_list(DEFAULT_TOPICS)}), item_id FROM items)
SELECT policy_name, kind, rule, CASE WHEN item_id % 2 = 0 THEN CAST(0.6 AS DOUBLE) ELSE CAST(0.4 AS DOUBLE) END AS threshold
FROM rules""")
def policy_rules(spark, folder):
    """One policy file entry per benchmark item, some without keywords, patterns or threshold."""
    n = F.col("item_id")
    policies = V.table(spark, folder, "benchmark").select(
        F.concat(F.lit("policy_"), n.cast("string")).alias("policy_name"),
        F.when(n % 3 != 0, F.array_distinct(F.split("text", " "))).alias("keyword_rules"),
        F.when(n % 2 == 0, F.array(F.lit("[0-9]+"), F.lit("x"))).alias("pattern_rules"),
        F.when(n % 2 == 0, F.lit(0.6)).alias("semantic_threshold"),
    )
    path = scratch_path(spark, "policies")
    policies.write.json(path)
    loaded = readers.load_policies(spark, path)
    thresholds = loaded.select("policy_name", F.col("semantic_threshold").alias("threshold"))
    return readers.policy_rules(loaded).join(thresholds, "policy_name").drop("ord")


@query(f"""WITH {V.PAGES}
SELECT 'doc_' || p.doc_id AS doc_id, d.source AS title, 'Q' || page_num AS question_id, d.lang AS topic, p.text AS question
FROM pages_t p JOIN documents d ON p.doc_id = d.doc_id""")
def registry_questions(spark, folder):
    """A registry document per text, a question per page of it."""
    questions = F.transform(
        F.split("text", "\n"),
        lambda page, i: F.struct(
            F.concat(F.lit("Q"), (i + 1).cast("string")).alias("id"),
            F.col("lang").alias("topic"),
            strip(page).alias("text"),
        ),
    )
    registry = V.texts(spark, folder).select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("id"),
        F.col("source").alias("title"),
        F.filter(questions, lambda q: F.length(q["text"]) > 0).alias("questions"),
    )
    path = scratch_path(spark, "registry")
    registry.write.json(path)
    return readers.registry_questions(readers.read_registry(spark, path))


@query(f"""WITH {V.TOPK}
SELECT CAST(t.collection AS VARCHAR) AS doc_id, t.query_id AS question_id, rank, CAST(t.chunk_id % 90 + 1 AS INTEGER) AS page_num, distance,
       coalesce(d.text, '(no text)') AS text
FROM topk t LEFT JOIN documents d ON t.chunk_id = d.doc_id""")
def explode_results(spark, folder):
    """Retrieval results written as nested JSON per document, then read and unnested."""
    chunks, asked = V.chunk_texts(spark, folder), V.questions(spark, folder)
    top = retrieval.with_chunk_text(retrieval.retrieve_topk(asked, chunks), chunks)
    found = F.array_sort(F.collect_list(F.struct("rank", "text", "page_num", "distance")))
    listed = top.groupBy("collection", "query_id").agg(found.alias("c"))
    results = listed.join(asked, ["collection", "query_id"]).select(
        F.col("collection").cast("string").alias("doc_id"),
        F.col("query_id").alias("question_id"),
        "question",
        F.transform(
            "c", lambda x: F.struct(x["text"].alias("text"), x["page_num"].alias("page_num"), x["distance"].alias("distance"))
        ).alias("retrieved_chunks"),
        F.lit("").alias("answer"),
    )
    path = scratch_path(spark, "results")
    writers.write_json_by_document(results, path)
    return readers.explode_results(readers.read_retrieval_results(spark, path, multi_line=False))


@query(f"""SELECT "Setup", CAST("Accuracy" AS DOUBLE) AS "Accuracy", CAST("Precision" AS DOUBLE) AS "Precision",
  CAST("Recall" AS DOUBLE) AS "Recall", CAST("F1" AS DOUBLE) AS "F1", "FalseNegatives", "FalsePositives",
  CAST("AvgLatencyMs" AS DOUBLE) AS "AvgLatencyMs", CAST("P95LatencyMs" AS DOUBLE) AS "P95LatencyMs"
FROM ({_SUMMARY})""")
def read_summary(spark, folder):
    path = scratch_path(spark, "summary")
    writers.write_csv(export(eval_metrics(V.verdicts(spark, folder))), path)
    return readers.read_summary(spark, path)


def _vector_loads(spark, folder, path):
    """Three loads: half of the chunks, then what was left out, then edited versions of every fifth."""
    chunks = V.chunk_texts(spark, folder)
    half = chunks.where(F.col("chunk_id") % 2 == 0)
    writers.append_vectors(half.withColumn("text_hash", F.sha2("text", 256)), path)
    writers.append_vectors(retrieval.embed_pending(chunks, readers.read_vectors(spark, path)), path)
    mirrored = F.transform("vector", lambda x: -x)
    edited = F.col("chunk_id") % 5 == 0
    changed = chunks.withColumn("text", F.when(edited, F.concat("text", F.lit(" (edited)"))).otherwise(F.col("text")))
    changed = changed.withColumn("vector", F.when(edited, mirrored).otherwise(F.col("vector")))
    writers.append_vectors(retrieval.embed_pending(changed, readers.read_vectors(spark, path)), path)


_STORED = """SELECT vec_id AS chunk_id, label AS collection, vec_id % 5 = 0 AS edited,
  CASE WHEN vec_id % 5 = 0 THEN 3 WHEN vec_id % 2 = 0 THEN 1 ELSE 2 END AS load,
  CASE WHEN vec_id % 5 = 0 THEN list_transform(CAST(embedding AS DOUBLE[]), lambda x: -x)
       ELSE CAST(embedding AS DOUBLE[]) END AS vector FROM embeddings"""


@query(f"""SELECT collection, load, CAST(count(*) AS BIGINT) AS n, CAST(printf('%.6f', sum(vector[1])) AS DOUBLE) AS total
FROM ({_STORED}) GROUP BY collection, load""")
def vector_store(spark, folder):
    """Vectors appended in three loads, each only with what is not stored as it is now; what was
    edited is read in its last version, here from a compacted copy of the store."""
    path, compacted = scratch_path(spark, "vectors"), scratch_path(spark, "vectors-compacted")
    _vector_loads(spark, folder, path)
    writers.compact_vectors(spark, path, compacted)
    loaded = readers.read_vectors(spark, compacted).withColumn("x", F.get("vector", F.lit(0)).cast("double"))
    return loaded.groupBy("collection", "load").agg(
        F.count("*").alias("n"), rounded(F.sum("x"), 6).alias("total")
    )


@query(f"""WITH {V.CENTROIDS},
stored AS ({_STORED}),
pairs AS (
  SELECT q.collection, 'Q' || (q.collection % 3 + 1) AS query_id, s.chunk_id, s.edited, s.load,
         round(list_distance(q.vector, s.vector) ** 2, 12) AS exact
  FROM centroids q JOIN stored s ON q.collection = s.collection)
SELECT collection, query_id, CAST(rank AS INTEGER) AS rank, chunk_id, CAST(printf('%.4f', exact) AS DOUBLE) AS distance, edited, load
FROM (SELECT *, row_number() OVER (PARTITION BY collection, query_id ORDER BY exact, chunk_id) AS rank FROM pairs)
WHERE rank <= 40""")
def retrieve_edited(spark, folder):
    """Retrieval from a store with edited chunks: each chunk once, in its last version."""
    path = scratch_path(spark, "vectors")
    _vector_loads(spark, folder, path)
    stored = readers.read_vectors(spark, path)
    top = retrieval.retrieve_topk(V.questions(spark, folder), stored, k=40)
    marked = stored.withColumn("edited", F.endswith("text", F.lit(" (edited)")))
    return retrieval.with_chunk_text(top, marked).select(
        "collection", "query_id", "rank", "chunk_id", "distance", "edited", "load"
    )


def _letter_shares(texts: pa.Array) -> pa.Array:
    """A plain embedding: the shares of three letters in each text."""
    size = pc.max_element_wise(pc.utf8_length(texts), 1)
    shares = [pc.divide(pc.cast(pc.count_substring(texts, c), pa.float64()), size) for c in "ent"]
    flat = np.stack([np.asarray(s) for s in shares], axis=1).ravel()
    return pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, 3, dtype=np.int32), pa.array(flat))


def _letter(c: str) -> str:
    share = f"(length(text) - length(replace(text, '{c}', ''))) / CAST(greatest(length(text), 1) AS DOUBLE)"
    return f"CAST(printf('%.9f', {share}) AS DOUBLE) AS {c}"


@query(f"SELECT doc_id, sha256(text) AS text_hash, {_letter('e')}, {_letter('n')}, {_letter('t')} FROM documents")
def embed_distinct(spark, folder):
    """Every document with the vector of its text; copies are embedded once, and what an earlier
    load holds not again."""
    documents = V.texts(spark, folder).select("doc_id", "text")
    stored = embedding.embed_distinct(documents.where("doc_id % 3 = 0"), _letter_shares)
    out = embedding.embed_distinct(documents, _letter_shares, known=stored.where("vector is not null"))
    shares = [rounded(F.get("vector", F.lit(i)), 9).alias(c) for i, c in enumerate("ent")]
    return out.select("doc_id", "text_hash", *shares)
