"""Gateways over a text table.  Texts stay where they are: one narrow pass, but for the rules of a
policy table, whose lookups are shuffled by their few hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palisade.fixed_values import AUDIT_SCORE, DEFAULT_ENTITIES, DEFAULT_THRESHOLD
from palisade.functions import gates as G
from palisade.functions.redaction import DEFAULT_REGISTRY, Pattern
from palisade.functions.text import cut_with_dots
from palisade.operators.rules import rule_gate, rule_join
from palisade.operators.scrub import add_high_risk, mask_entities, redact, scrub
from palisade.operators.semantic import best_topic, semantic_gate, semantic_verdict
from palisade.session import settled
from palisade.sources.readers import policy_rules


def triple_lock(
    texts: DataFrame,
    registry: list[Pattern] = DEFAULT_REGISTRY,
    score: Column | None = None,
    text: str = "text",
) -> DataFrame:
    """Redact, block high-risk texts, and give the audit score to those that pass."""
    audit = F.lit(AUDIT_SCORE) if score is None else score
    gated = add_high_risk(redact(texts, text, "generic", registry))
    joined = F.array_join("patterns_matched", ", ")
    return gated.withColumns(
        {
            "violations": F.when(joined == "", F.lit("NONE")).otherwise(joined),
            "faithfulness_score": F.when(F.col("safety_status") == "PASS", audit),
        }
    )


def display_rows(gated: DataFrame, text: str = "text", limit: int = 70) -> DataFrame:
    return gated.withColumns(
        {
            "shown_text": cut_with_dots(F.col(text), limit),
            "shown_clean": cut_with_dots(F.col("clean_text"), limit),
        }
    )


def secure_gateway(
    texts: DataFrame, keywords: list[str], patterns: list[str], profile: str = "lab", text: str = "text"
) -> DataFrame:
    """Scrub, then the rule gate on the scrubbed text; what is clean is handed on."""
    gated = rule_gate(scrub(texts, profile, text), keywords, patterns, "scrubbed")
    return gated.withColumn(
        "handed_on", F.when(F.col("verdict") == G.CLEAN, F.col("scrubbed"))
    )


def layered_gate(
    texts: DataFrame,
    topics: DataFrame,
    keywords: list[str],
    patterns: list[str],
    entities: list[str] = DEFAULT_ENTITIES,
    threshold: float | None = None,
    gate_on: str = "masked",
    fail_closed: bool = False,
    text: str = "text",
    vector: str = "vector",
) -> DataFrame:
    """Mask, rule gate, then the similarity gate for texts the rules let through.

    A text the rules block has its vector set to null, so it is never scored and the
    input is read only once.  `gate_on='raw'` runs the rules on the unmasked text.
    """
    if gate_on not in ("masked", "raw"):
        raise ValueError("gate_on must be 'masked' or 'raw'")
    masked = mask_entities(texts, entities, text=text, out="scrubbed")
    ruled = rule_gate(masked, keywords, patterns, "scrubbed" if gate_on == "masked" else text)
    open_ = F.col("verdict") == G.CLEAN
    asked = ruled.withColumn("_asked", F.when(open_, F.col(vector)))
    scored = semantic_gate(asked, topics, threshold, "_asked")
    semantic = F.when(open_, F.col("semantic_check")).otherwise(F.lit("SKIPPED"))
    status = G.verdict_status(F.col("final_verdict"))
    return (
        scored.withColumn("keyword_check", F.col("verdict"))
        .withColumn("semantic_check", semantic)
        .withColumn(
            "final_verdict",
            F.when(open_, F.col("semantic_check")).otherwise(F.col("keyword_check")),
        )
        .withColumn("blocked", G.counts_as_blocked(status, fail_closed))
        .drop("_asked", "verdict", "keyword", "pattern_match")
    )


NO_POLICY = "ERROR (no policy)"


def policy_gateway(
    texts: DataFrame,
    policies: DataFrame,
    topic_vectors: DataFrame,
    gate_on: str = "masked",
    fail_closed: bool = False,
    text: str = "text",
    vector: str = "vector",
) -> DataFrame:
    """The layered gate, each text by the policy it names in `policy_name`.

    `policies` has the columns of a policy file, `topic_vectors` is (topic, vector) with a vector for
    each topic text.  A policy's row is a program: its entities are masked, its keywords and
    patterns run on the masked text (or the raw one), and what they let through meets its own
    topics at its own threshold.  All texts go through one plan, whatever their policies; rows of
    policies of the same name are one policy, with the lowest threshold.  A topic without a vector
    never matches; a policy without topics, or a text without a vector, is skipped by that gate.

    A text whose policy is null or unknown gets `ERROR (no policy)`, no scrubbed text, and counts as
    blocked where the gate fails closed.
    """
    if gate_on not in ("masked", "raw"):
        raise ValueError("gate_on must be 'masked' or 'raw'")
    programs = (
        policies.where("policy_name is not null")
        .groupBy("policy_name")
        .agg(
            F.array_distinct(F.flatten(F.collect_list("pii_entities"))).alias("_entities"),
            F.coalesce(F.min("semantic_threshold"), F.lit(DEFAULT_THRESHOLD)).alias("_threshold"),
        )
    )
    rules = policy_rules(policies)
    topics = (
        rules.where("kind = 'topic'")
        .join(topic_vectors.select(F.col("topic").alias("rule"), "vector"), "rule")
        .select("policy_name", "ord", F.col("rule").alias("topic"), "vector")
    )
    known = texts.join(settled(programs), "policy_name", "left")
    masked = mask_entities(known, F.col("_entities"), text=text, out="scrubbed")
    masked = masked.withColumn("scrubbed", F.when(F.col("_threshold").isNotNull(), F.col("scrubbed")))
    ruled = rule_join(masked, rules.where("kind <> 'topic'"), "scrubbed" if gate_on == "masked" else text)
    has_policy = F.col("_threshold").isNotNull()
    ruled = ruled.withColumn("keyword_check", F.when(has_policy, F.col("verdict")).otherwise(F.lit(NO_POLICY)))
    open_ = F.col("keyword_check") == G.CLEAN
    asked = ruled.withColumn("_asked", F.when(open_, F.col(vector)))
    scored = best_topic(asked, topics, "_asked", segment="policy_name")
    semantic = F.when(open_, semantic_verdict(F.col("_threshold"))).otherwise(F.lit("SKIPPED"))
    status = G.verdict_status(F.col("final_verdict"))
    return (
        scored.withColumn("semantic_check", semantic)
        .withColumn("final_verdict", F.when(open_, F.col("semantic_check")).otherwise(F.col("keyword_check")))
        .withColumn("blocked", G.counts_as_blocked(status, fail_closed))
        .drop("_asked", "_entities", "_threshold", "verdict", "keyword", "pattern_match")
    )
