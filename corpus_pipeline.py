"""From raw documents to packed sequences: five stages, each written and read again.

Every stage takes the documents its predecessor kept, all of them, and all but the last return
the columns of `documents`.  Null texts count as empty, tables may be empty, and rows or ids may repeat.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palisade.llm.common import fold, materialize, table
from palisade.llm.langid import UNKNOWN, language_id
from palisade.llm.minhash import near_duplicates
from palisade.llm.packing import best_fit_packing
from palisade.llm.quality import quality_classifier
from palisade.llm.queries import vocabulary
from palisade.llm.suffixes import drop_repeats

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# A text is in a language when at least this share of its letters is in that language's spans.
LANGUAGE_SHARE = 0.35
# And at least this share more than in any other language's, or in foreign scripts.
LANGUAGE_LEAD = 0.2
# And when its n-grams are at most so much less likely (natural log, mean) than the language's own text.
# At sf 0.1 random letters lie at -6.8 and lower, other languages of the script at -5.2 and
# lower, short texts at -3.3 and higher.
LANGUAGE_FIT = -4.0


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9; documents scored below the classifier's threshold go.  Labels of one fold
    of four are never learned from, as in the operator's own query."""
    learned = fold("doc_id", 4).isin(0, 1, 3)
    scored = quality_classifier(docs, table(spark, sf_dir, "labels"), learned)
    return scored.where("predicted = 1").select(*COLUMNS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2, learned from the documents' languages; documents without a letter, without a
    language that holds a fair share of their letters and clearly more than the next, or unlike the
    text of their language, go."""
    found = language_id(docs)
    clear = (
        (F.col("lang_pred") != UNKNOWN)
        & (F.col("lang_score") >= LANGUAGE_SHARE)
        & (F.col("lang_lead") >= LANGUAGE_LEAD)
        & (F.col("lang_fit") >= LANGUAGE_FIT)
    )
    return found.where(clear).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4 on five-word shingles; the first document of each group stays."""
    return near_duplicates(docs).where("kept").select(*COLUMNS)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5 on words; strings of 50 words that start twice or more are taken out of all texts.
    Documents stay, with `n_chars` of what is left."""
    cut = drop_repeats(docs.select(*COLUMNS), unit="words")
    return cut.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10; pieces of at most 2048 tokens in as few sequences as best-fit takes."""
    return best_fit_packing(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality),
    ("language ID", language),
    ("near-dedup", near_dedup),
    ("suffix dedup", suffix_dedup),
    ("packing", packing),
]

# Classifiers, links and subword merges can't be said in SQL; the tests hold the rows against
# the stages' brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the table `documents` of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
