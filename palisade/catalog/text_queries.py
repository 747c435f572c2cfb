"""Redaction, scrubbing and text functions over the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from palisade.catalog import patterns_sql as P
from palisade.catalog import views as V
from palisade.catalog.registry import query
from palisade.functions.text import cut, cut_with_dots, sanitize
from palisade.operators import scrub as O
from palisade.plans.gateway import display_rows, triple_lock as lock

def _labels():
    return F.array_join("patterns_matched", ", ").alias("labels")


@query(f"""WITH {P.hits_cte()}
SELECT doc_id, clean_text, labels, CAST(redacted_count AS INTEGER) AS redacted_count FROM hits""")
def redact_generic(spark, folder):
    out = O.redact(V.texts(spark, folder), registry=V.REGISTRY)
    return out.select("doc_id", "clean_text", _labels(), "redacted_count")


@query(f"WITH {P.coding_cte()} SELECT doc_id, clean_text FROM hits")
def redact_coding(spark, folder):
    return O.redact(V.texts(spark, folder), mode="coding", registry=V.REGISTRY).select(
        "doc_id", "clean_text"
    )


@query(f"""WITH {P.hits_cte()}
SELECT doc_id, source, labels <> '' AS found_pii, labels,
       CAST(redacted_count AS INTEGER) AS redacted_count FROM hits""")
def pii_report(spark, folder):
    return O.report(V.texts(spark, folder), registry=V.REGISTRY).select(
        "doc_id", "source", "found_pii", _labels(), "redacted_count"
    )


@query(P.by_source_sql())
def pii_by_source(spark, folder):
    return O.report_by_source(V.texts(spark, folder), registry=V.REGISTRY)


@query(f"""WITH {P.hits_cte()}
SELECT doc_id, leak, CASE WHEN leak IS NULL THEN clean_text END AS released
FROM (SELECT *, {P.leak_sql()} AS leak FROM hits)""")
def circuit_breaker(spark, folder):
    return O.circuit_breaker(V.texts(spark, folder), registry=V.REGISTRY).select(
        "doc_id", "leak", "released"
    )


@query(f"WITH {P.hits_cte()} SELECT doc_id, {P.high_risk_sql()} AS safety_status FROM hits")
def high_risk_gate(spark, folder):
    found = O.report(V.texts(spark, folder), registry=V.REGISTRY)
    return O.add_high_risk(found).select("doc_id", "safety_status")


_shown = "CASE WHEN length({0}) > 70 THEN substr({0}, 1, 70) || '...' ELSE {0} END"
TRIPLE_LOCK = f"""WITH {P.hits_cte()},
gated AS (SELECT *, {P.high_risk_sql()} AS safety_status FROM hits)
SELECT doc_id, {_shown.format('text')} AS shown_text, {_shown.format('clean_text')} AS shown_clean,
       CASE WHEN labels = '' THEN 'NONE' ELSE labels END AS violations, safety_status,
       CASE WHEN safety_status = 'PASS' THEN CAST(0.98 AS DOUBLE) END AS faithfulness_score
FROM gated"""


@query(TRIPLE_LOCK)
def triple_lock(spark, folder):
    return display_rows(lock(V.texts(spark, folder), V.REGISTRY)).select(
        "doc_id", "shown_text", "shown_clean", "violations", "safety_status", "faithfulness_score"
    )


@query(f"""SELECT doc_id, {P.scrub_sql('lab')} AS lab, {P.scrub_sql('bench5')} AS bench5,
       {P.scrub_sql('models')} AS models FROM documents""")
def scrub_text(spark, folder):
    out = V.texts(spark, folder)
    for profile in ("lab", "bench5", "models"):
        out = O.scrub(out, profile, out=profile)
    return out.select("doc_id", "lab", "bench5", "models")


@query(f"SELECT doc_id, {P.masked_sql()} AS masked FROM documents")
def mask_entities(spark, folder):
    return O.mask_entities(V.texts(spark, folder)).select("doc_id", "masked")


@query(f"""WITH blanks AS MATERIALIZED (SELECT {V.BLANKS} AS b)
SELECT page_id, trim(replace(translate('**┌' || html || '┘' || chr(12288),
       '┌─┐└┘│┤├┼┴┬║═╔╗╚╝╠╣╦╩╬', ''), '**', ''), b) AS clean FROM pages, blanks""")
def sanitize_text(spark, folder):
    boxed = F.concat(F.lit("**┌"), F.col("html"), F.lit("┘　"))
    return V.table(spark, folder, "pages").select("page_id", sanitize(boxed).alias("clean"))


@query(f"""SELECT doc_id, {_shown.format('text')} AS dotted, substr(text, 1, 500) AS cut_500,
       substr(text, 1, 80) AS cut_80 FROM documents""")
def truncate_text(spark, folder):
    text = F.col("text")
    return V.texts(spark, folder).select(
        "doc_id",
        cut_with_dots(text).alias("dotted"),
        cut(text, 500).alias("cut_500"),
        cut(text, 80).alias("cut_80"),
    )
