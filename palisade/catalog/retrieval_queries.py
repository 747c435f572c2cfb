"""Pages, chunks, nearest chunks, prompts and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from palisade.catalog import views as V
from palisade.catalog.registry import query
from palisade.fixed_values import (
    ADMIT_PHRASES,
    FORCED_SYSTEM,
    HONEST_SYSTEM,
    MISSING_QUESTION,
    STALE_TEMPLATE,
    TEST_RISKS,
)
from palisade.operators import audits as A
from palisade.operators import chunking as K
from palisade.operators import retrieval as R
from palisade.plans import grounded, stress


def _pages(spark, folder):
    return K.split_pages(V.texts(spark, folder))


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@query(f"WITH {V.PAGES} SELECT doc_id, page_num, text FROM pages_t")
def doc_pages(spark, folder):
    return _pages(spark, folder)


@query(f"WITH {V.CHUNKS} SELECT doc_id, chunk_no, chunk_id, page_num, start, text FROM chunks")
def chunk_pages(spark, folder):
    return K.chunk_pages(_pages(spark, folder))


@query(f"""WITH {V.CHUNKS},
p AS (SELECT doc_id, count(*) AS pages_found, count(*) FILTER (length(text) > 0) AS pages_with_text
      FROM all_pages GROUP BY doc_id),
c AS (SELECT doc_id, count(*) AS chunks FROM chunks GROUP BY doc_id)
SELECT p.doc_id, pages_found, pages_with_text, coalesce(chunks, 0) AS chunks FROM p LEFT JOIN c ON p.doc_id = c.doc_id""")
def chunk_stats(spark, folder):
    return K.chunk_stats(V.texts(spark, folder))


@query(f"""WITH {V.CHUNKS}, n AS (SELECT doc_id, least(10, count(*) - 1) AS shown FROM chunks GROUP BY doc_id)
SELECT c.doc_id, chunk_no, chunk_id, page_num, text FROM chunks c JOIN n ON c.doc_id = n.doc_id AND chunk_no = shown""")
def example_chunk(spark, folder):
    return K.example_chunk(K.chunk_pages(_pages(spark, folder)))


_share = "CAST(printf('%.4f', (length(text) - length({0})) / CAST(length(text) AS DOUBLE)) AS DOUBLE)"


@query(f"""WITH {V.CHUNKS},
q AS (
  SELECT doc_id, chunk_no, {_share.format("replace(text, ' ', '')")} AS space_ratio,
         list_max(list_transform(regexp_split_to_array(text, '[ ' || chr(10) || chr(9) || ']+'), lambda t: length(t))) AS longest_token,
         {_share.format("translate(text, '0123456789', '')")} AS digit_ratio
  FROM chunks)
SELECT doc_id, chunk_no, space_ratio, CAST(longest_token AS INTEGER) AS longest_token, digit_ratio,
       space_ratio < 0.08 OR longest_token > 40 OR digit_ratio > 0.3 AS suspect FROM q""")
def chunk_quality(spark, folder):
    return K.chunk_quality(K.chunk_pages(_pages(spark, folder)))


@query(f"WITH {V.TOPK} SELECT collection, query_id, rank, chunk_id, distance FROM topk")
def retrieve_topk(spark, folder):
    return R.retrieve_topk(V.questions(spark, folder), V.vectors(spark, folder))


PROMPT = V.TOPK + """,
sources AS (
  SELECT t.collection AS c, query_id, rank, '[Source ' || rank || ' — Page ' || (t.chunk_id % 90 + 1) || ' | Distance: '
         || distance || ']' || chr(10) || coalesce(d.text, '(no text)') AS block
  FROM topk t LEFT JOIN documents d ON t.chunk_id = d.doc_id),
prompts AS (
  SELECT 'Q' || (collection % 3 + 1) AS query_id, collection, 'What is typical of ' || collection || '?' AS question,
         'CONTEXT FROM DOCUMENT:' || chr(10) || string_agg(block, chr(10) || chr(10) ORDER BY rank)
         || chr(10) || chr(10) || 'QUESTION:' || chr(10) || 'What is typical of ' || collection || '?'
         || chr(10) || chr(10) || 'Answer using only the context above. Cite page numbers.' AS prompt
  FROM centroids q JOIN sources s ON s.c = q.collection GROUP BY collection)"""


@query(f"WITH {PROMPT} SELECT * FROM prompts")
def rag_prompt(spark, folder):
    return grounded.grounded_prompts(V.questions(spark, folder), V.chunk_texts(spark, folder))


def _user_questions(spark, folder):
    turns = V.table(spark, folder, "conversations").where(F.col("role") == "user")
    return turns.select(
        F.col("conv_id").alias("doc_id"),
        F.concat(F.lit("Q"), F.col("turn").cast("string")).alias("question_id"),
        F.col("text").alias("question"),
    )


@query(f"""WITH modes(mode, system) AS (
  VALUES ('honest', {_quote(HONEST_SYSTEM)}), ('forced', {_quote(FORCED_SYSTEM)})),
asked AS (
  SELECT conv_id AS doc_id, 'Q' || turn AS question_id, text, mode, system
  FROM conversations, modes WHERE role = 'user')
SELECT doc_id, question_id, mode, 0 AS position, 'system' AS role, system AS content FROM asked
UNION ALL SELECT doc_id, question_id, mode, 1, 'user', text FROM asked""")
def build_messages(spark, folder):
    built = grounded.baseline_messages(_user_questions(spark, folder))
    return built.select(
        "doc_id", "question_id", "mode", F.posexplode("messages").alias("position", "m")
    ).select("doc_id", "question_id", "mode", "position", "m.role", "m.content")


@query("""WITH a AS (SELECT conv_id AS doc_id, turn // 2 AS pair, role, text FROM conversations)
SELECT h.doc_id, 'Q' || h.pair AS question_id, trim(substr(h.text, 1, 120), ' ' || chr(10)) AS honest,
       trim(substr(f.text, 1, 120), ' ' || chr(10)) AS forced
FROM a h JOIN a f ON h.doc_id = f.doc_id AND h.pair = f.pair AND h.role = 'user' AND f.role = 'assistant'""")
def compare_modes(spark, folder):
    answers = V.table(spark, folder, "conversations").select(
        F.col("conv_id").alias("doc_id"),
        F.concat(F.lit("Q"), F.floor(F.col("turn") / 2).cast("string")).alias("question_id"),
        F.when(F.col("role") == "user", F.lit("honest"))
        .when(F.col("role") == "assistant", F.lit("forced"))
        .alias("mode"),
        F.col("text").alias("answer"),
    )
    return A.compare_modes(answers)


# --- the persisted vector table -------------------------------------------------------


@query("""SELECT d.lang AS collection, 'doc_' || d.doc_id AS chunk_id, sha256(d.text) AS text_hash
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.doc_id IS NULL OR l.quality = 0""")
def embed_pending(spark, folder):
    """Stored so far: the labelled documents, those of low quality with another text."""
    chunks = V.texts(spark, folder).select(
        F.col("lang").alias("collection"),
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("chunk_id"),
        "doc_id",
        "text",
    )
    labels = V.table(spark, folder, "labels")
    edited = F.when(F.col("quality") == 0, F.concat("text", F.lit(" (draft)"))).otherwise(F.col("text"))
    stored = chunks.join(labels, "doc_id").select(
        "collection", "chunk_id", F.sha2(edited, 256).alias("text_hash")
    )
    return R.embed_pending(chunks, stored).select("collection", "chunk_id", "text_hash")


@query("""SELECT label AS collection, vec_id AS chunk_id, n AS seq, n // 50 AS batch FROM (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS n FROM embeddings)""")
def embed_batches(spark, folder):
    return R.embed_batches(V.vectors(spark, folder).drop("vector"), "collection", "chunk_id")


# --- audits ---------------------------------------------------------------------------

STALE = V.CENTROIDS + """,
injected AS (
  SELECT -1 - collection AS chunk_id, collection,
         list_transform(vector, lambda x: CASE WHEN collection % 2 = 0 THEN x * 2 ELSE -x END) AS vector
  FROM centroids),
all_chunks AS (SELECT * FROM corpus UNION ALL SELECT * FROM injected),
ranked AS (
  SELECT collection, chunk_id, row_number() OVER (PARTITION BY collection ORDER BY exact, chunk_id) AS rank
  FROM (SELECT q.collection, c.chunk_id, round(list_distance(q.vector, c.vector) ** 2, 12) AS exact
        FROM centroids q JOIN all_chunks c ON q.collection = c.collection))"""


def _stale(spark, folder):
    """An outdated chunk per collection, near its question in every second one."""
    moved = F.when(F.col("collection") % 2 == 0, F.lit(2.0)).otherwise(F.lit(-1.0))
    injected = V.centroids(spark, folder).withColumn("_by", moved).select(
        (F.lit(-1).cast("bigint") - F.col("collection")).alias("chunk_id"),
        "collection",
        F.transform("vector", lambda x: (x * F.col("_by")).cast("float")).alias("vector"),
    )
    return A.stale_audit(V.questions(spark, folder), V.vectors(spark, folder), injected)


@query(f"""WITH {STALE}
SELECT 'Q' || (collection % 3 + 1) AS query_id, collection, count(*) FILTER (chunk_id < 0 AND rank <= 4) > 0 AS stale_retrieved,
       coalesce(CAST(min(rank) FILTER (chunk_id < 0 AND rank <= 4) AS INTEGER), 0) AS stale_rank
FROM ranked GROUP BY collection""")
def stale_audit(spark, folder):
    return _stale(spark, folder).withColumn("stale_rank", F.coalesce("stale_rank", F.lit(0)))


_ADMITS = " OR ".join(f"contains(lower(answer), '{p}')" for p in ADMIT_PHRASES)
_ANSWERS = f"""answers AS (
  SELECT conv_id, turn, text || (['', ' It DOES NOT contain this.', ' Insufficient data.'])[conv_id % 3 + 1] AS answer
  FROM conversations WHERE role = 'assistant'),
admitted AS (SELECT conv_id, turn, ({_ADMITS}) AS admitted_ignorance FROM answers)"""


def _answers(spark, folder):
    tails = F.array(F.lit(""), F.lit(" It DOES NOT contain this."), F.lit(" Insufficient data."))
    said = V.table(spark, folder, "conversations").where(F.col("role") == "assistant")
    tail = F.element_at(tails, (F.col("conv_id") % 3 + 1).cast("int"))
    return said.select("conv_id", "turn", F.concat("text", tail).alias("answer"))


@query(f"WITH {_ANSWERS} SELECT * FROM admitted")
def admitted_ignorance(spark, folder):
    return _answers(spark, folder).select(
        "conv_id", "turn", A.admitted_ignorance(F.col("answer")).alias("admitted_ignorance")
    )


@query(f"""WITH {V.TOPK}, {_ANSWERS},
best AS (SELECT collection, query_id, min(distance) AS best_distance, count(*) AS n_retrieved FROM topk GROUP BY ALL)
SELECT a.conv_id, a.turn, a.admitted_ignorance, b.best_distance, b.n_retrieved
FROM admitted a LEFT JOIN best b ON b.collection = a.conv_id % 10 AND b.query_id = 'Q' || (a.conv_id % 10 % 3 + 1)""")
def missing_source_audit(spark, folder):
    collection = F.col("conv_id") % 10
    answers = _answers(spark, folder).withColumns(
        {"collection": collection, "query_id": F.concat(F.lit("Q"), (collection % 3 + 1).cast("string"))}
    )
    return stress.missing_source_audit(
        V.questions(spark, folder), V.vectors(spark, folder), answers, keep=["conv_id", "turn"]
    ).drop("collection", "query_id")


@query(f"""WITH given AS (SELECT doc_id, 'Outdated: label ' || quality AS text FROM labels WHERE toxic = 1)
SELECT d.doc_id, coalesce(g.text, printf({_quote(STALE_TEMPLATE)}, d.source)) AS stale_text,
       coalesce(g.text, {_quote(MISSING_QUESTION)}) AS probe
FROM documents d LEFT JOIN given g ON d.doc_id = g.doc_id""")
def probe_questions(spark, folder):
    documents = V.texts(spark, folder).select("doc_id", F.col("source").alias("title"))
    given = V.table(spark, folder, "labels").where(F.col("toxic") == 1).select(
        "doc_id", F.concat(F.lit("Outdated: label "), F.col("quality").cast("string")).alias("text")
    )
    return stress.probe_questions(stress.stale_texts(documents, given), given).select(
        "doc_id", "stale_text", "probe"
    )


_RISKS = ", ".join(f"({_quote(a)}, {_quote(b)}, {_quote(c)})" for a, b, c in TEST_RISKS)


@query(f"""WITH {STALE}, {_ANSWERS}, risks(test, risk, mitigation) AS (VALUES {_RISKS}),
results AS (
  SELECT 'stale' AS test, count(*) FILTER (chunk_id < 0 AND rank <= 4) > 0 AS stale_retrieved, NULL AS admitted
  FROM ranked GROUP BY collection
  UNION ALL SELECT 'missing_source', NULL, admitted_ignorance FROM admitted
  UNION ALL SELECT 'bad_chunk', NULL, NULL FROM documents)
SELECT r.test, count(*) AS n_tests, count(*) FILTER (stale_retrieved) AS n_stale,
       count(*) FILTER (admitted) AS n_admitted, risk, mitigation
FROM results r JOIN risks k ON r.test = k.test GROUP BY ALL""")
def risk_summary(spark, folder):
    none = F.lit(None).cast("boolean")
    stale = _stale(spark, folder).select(
        F.lit("stale").alias("test"), "stale_retrieved", none.alias("admitted_ignorance")
    )
    missing = admitted_ignorance(spark, folder).select(
        F.lit("missing_source").alias("test"), none.alias("stale_retrieved"), "admitted_ignorance"
    )
    bad = V.texts(spark, folder).select(
        F.lit("bad_chunk").alias("test"), none.alias("stale_retrieved"), none.alias("admitted_ignorance")
    )
    return A.risk_summary(stale.unionByName(missing).unionByName(bad), A.test_risks(spark))
