"""The registered queries of the operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palisade.catalog.registry import Query
from palisade.llm.common import fold, table
from palisade.llm.langid import language_id
from palisade.llm.quality import quality_classifier

QUERIES: dict[str, Query] = {}


def query(sql: str | None = None):
    def add(build):
        QUERIES[build.__name__] = Query(build, sql)
        return build

    return add


def vocabulary(name: str) -> str:
    """Where a public vocabulary file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages learned from two folds of three, predicted for all documents."""
    docs = table(spark, sf_dir, "documents")
    learned = fold("doc_id", 3).isin(0, 2)
    return language_id(docs, learned).select(
        "doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred",
        F.col("lang_score").alias("score"), "n_spans",
    )


@query()
def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE of all documents, encoded and decoded, as digests."""
    from palisade.llm.bpe import bpe_digest

    return bpe_digest(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


@query()
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality learned from three folds of four, scored for all documents."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    learned = fold("doc_id", 4).isin(0, 1, 3)
    return quality_classifier(docs, labels, learned).select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", "predicted"
    )


@query()
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    from palisade.llm.packing import best_fit_packing

    return best_fit_packing(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@query()
def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and attention-model scores of all documents, learned from four folds of five."""
    from palisade.llm.lm import lm_score

    docs = table(spark, sf_dir, "documents")
    return lm_score(docs, vocabulary("byte_bpe_50k.tiktoken"), fold("doc_id", 5) == 1)


@query()
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the 400-byte strings that start twice or more, as digests."""
    from palisade.llm.suffixes import dedup_digest

    return dedup_digest(table(spark, sf_dir, "documents"))


@query()
def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates of all documents on four-word shingles."""
    from palisade.llm.minhash import near_duplicates

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return near_duplicates(docs, width=4).select("doc_id", "n_shingles", "component_id", first.alias("kept"))


TOPK_SQL = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
         CAST(list_inner_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
  FROM usable a JOIN usable b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM scored
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5
"""


@query(TOPK_SQL)
def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact best inner products of the stated queries with all embeddings."""
    from palisade.llm.topk import exact_topk

    vectors = table(spark, sf_dir, "embeddings")
    return exact_topk(vectors, vectors.where("vec_id % 50 = 0"))


@query()
def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approximate nearest cosines of the stated queries among all embeddings."""
    from palisade.llm.ann import nearest

    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 50 = 0"))


@query()
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of all documents, from one encoding of each document."""
    from palisade.llm.token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


@query()
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on their eight leading principal components, with unit variance."""
    from palisade.llm.whitening import whiten

    out = whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return out.select(
        "vec_id", "n", F.col("deviation").cast("long").alias("deviation"), "identity_error",
        F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "part"),
    ).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", F.col("part.whitened").alias("whitened"),
        F.col("part.explained").alias("explained"), "identity_error",
    )


# crc32 of the decimal id, bit by bit
_CRC32 = """xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
    lambda c: CAST(ascii(c) AS BIGINT))),
  lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END) + z)), 4294967295)"""


def _leaf_sql(n_chars: str) -> str:
    values = ["doc_id", "source", "lang", n_chars, "text"]
    texts = [f"CAST({v} AS VARCHAR)" for v in values]
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({t})) || ':' || {t}, '-')" for t in texts) + ")"


MERKLE_SQL = f"""
WITH RECURSIVE marked AS (
  SELECT doc_id, lang, {_leaf_sql('n_chars')} AS leaf,
         CASE WHEN ({_CRC32}) % 7 = 0 THEN {_leaf_sql('n_chars + 1')} ELSE {_leaf_sql('n_chars')} END AS changed
  FROM documents
), leaves AS (
  SELECT *, coalesce('=' || lang, '') AS grp,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY lang) AS n
  FROM marked
), levels AS (
  SELECT grp, 0 AS level, pos, n, leaf AS h FROM leaves
  UNION ALL
  SELECT grp, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM levels WHERE n > 1 GROUP BY grp, level, pos // 2, n
), subroots AS (
  SELECT grp, h AS subroot, row_number() OVER (ORDER BY encode(grp)) - 1 AS pos, count(*) OVER () AS n
  FROM levels WHERE n = 1
), tops AS (
  SELECT 0 AS level, pos, n, subroot AS h FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM tops WHERE n > 1 GROUP BY level, pos // 2, n
), climb AS (
  SELECT l.pos AS row, l.grp, 0 AS level, l.pos, l.n, '' AS proof, l.changed AS h, FALSE AS high FROM leaves l
  UNION ALL
  SELECT c.row, c.grp, CASE WHEN c.n > 1 THEN c.level + 1 ELSE 0 END,
         CASE WHEN c.n > 1 THEN c.pos // 2 ELSE r.pos END,
         CASE WHEN c.n > 1 THEN (c.n + 1) // 2 ELSE r.n END,
         CASE WHEN c.n > 1 THEN c.proof || coalesce(s.h, t.h, '') ELSE c.proof END,
         CASE WHEN c.n = 1 THEN c.h WHEN c.pos % 2 = 0 THEN sha256(c.h || coalesce(s.h, t.h, ''))
              ELSE sha256(coalesce(s.h, t.h, '') || c.h) END,
         c.high OR c.n = 1
  FROM climb c
  LEFT JOIN levels s ON NOT c.high AND c.n > 1 AND s.grp = c.grp AND s.level = c.level AND s.pos = xor(c.pos, 1)
  LEFT JOIN tops t ON c.high AND c.n > 1 AND t.level = c.level AND t.pos = xor(c.pos, 1)
  LEFT JOIN subroots r ON r.grp = c.grp
  WHERE c.n > 1 OR NOT c.high
)
SELECT l.doc_id, l.leaf, r.subroot, t.h AS root, sha256(c.proof) AS proof_sha256, c.h AS folded_root,
       c.h = t.h AS verified
FROM leaves l JOIN climb c ON c.grp = l.grp AND c.row = l.pos AND c.high AND c.n = 1
JOIN subroots r ON r.grp = l.grp JOIN tops t ON t.n = 1
"""


@query(MERKLE_SQL)
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves, roots and proofs of all documents, and what the proofs say of tampered ones."""
    from palisade.llm.merkle import folded, merkle_manifest, proof_digest, row_digest

    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    changed = row_digest([F.col(c) + 1 if c == "n_chars" else F.col(c) for c in fields])
    found = merkle_manifest(
        table(spark, sf_dir, "documents"), fields, carried={"changed": F.when(tampered, changed)}
    )
    again = folded(F.coalesce("changed", "leaf"), F.col("path"))
    return found.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
        again.alias("folded_root"), (again == F.col("root")).alias("verified"),
    )


@query()
def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity with labels of two folds of three, scored for all documents."""
    from palisade.llm.toxicity import toxicity

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    learned = fold("doc_id", 3).isin(0, 2)
    return toxicity(docs, labels, learned).select(
        "doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", "predicted"
    )
