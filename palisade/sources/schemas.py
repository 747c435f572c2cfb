"""Schemas of the files read: DDL, and types by name where a header tells the order."""

RUN_CSV = {
    "Model": "STRING", "Logic": "INT", "Correctness": "DOUBLE", "Final Score": "DOUBLE",
    "Cost": "DOUBLE", "Latency": "DOUBLE",
}
POLICY = (
    "policy_name STRING, keyword_rules ARRAY<STRING>, pattern_rules ARRAY<STRING>, "
    "semantic_topics ARRAY<STRING>, semantic_threshold DOUBLE, pii_entities ARRAY<STRING>"
)
REGISTRY = (
    "id STRING, title STRING, filename STRING, url STRING, topic STRING, description STRING, "
    "questions ARRAY<STRUCT<id: STRING, topic: STRING, text: STRING>>"
)
RETRIEVAL_RESULT = (
    "doc_id STRING, question_id STRING, question STRING, retrieved_chunks "
    "ARRAY<STRUCT<text: STRING, page_num: INT, distance: DOUBLE>>, answer STRING"
)
STRESS_RESULT = (
    "test STRING, stale_retrieved BOOLEAN, admitted_ignorance BOOLEAN, answer STRING"
)
SUMMARY_CSV = {
    "Setup": "STRING", "Accuracy": "DOUBLE", "Precision": "DOUBLE", "Recall": "DOUBLE", "F1": "DOUBLE",
    "FalseNegatives": "BIGINT", "FalsePositives": "BIGINT", "AvgLatencyMs": "DOUBLE", "P95LatencyMs": "DOUBLE",
}
LABELLED_CASES = "case_id BIGINT, text STRING, expected BOOLEAN"
