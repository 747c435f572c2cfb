"""Redaction, scrubbing and masking over a text table; no shuffle in any of them
but the two reports that group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palisade.fixed_values import (
    DEFAULT_ENTITIES,
    DEFAULT_ENTITY_LABEL,
    ENTITY_LABELS,
    HIGH_RISK_LABELS,
    SCRUB_PROFILES,
)
from palisade.functions import redaction as R
from palisade.functions.gates import high_risk


def redact(
    df: DataFrame,
    text: str = "text",
    mode: str = "generic",
    registry: list[R.Pattern] = R.DEFAULT_REGISTRY,
    compat: bool = False,
) -> DataFrame:
    """Add `clean_text`, `found_pii`, `patterns_matched` and `redacted_count`."""
    if mode not in ("generic", "coding"):
        raise ValueError("mode must be 'generic' or 'coding'")
    found = df.withColumn("_hits", R.find_hits(F.col(text), registry, compat))
    hits = F.col("_hits")
    if mode == "generic":
        clean = R.replace_generic(F.col(text), hits, registry, lambda x: f"[REDACTED_{x}]")
    else:
        clean = R.replace_numbered(F.col(text), hits, registry)
    labels = R.labels_matched(hits, registry)
    return (
        found.withColumns(
            {
                "clean_text": clean,
                "patterns_matched": labels,
                "redacted_count": R.count_hits(hits, registry),
            }
        )
        .withColumn("found_pii", F.size("patterns_matched") > 0)
        .drop("_hits")
    )


def report(
    df: DataFrame,
    text: str = "text",
    registry: list[R.Pattern] = R.DEFAULT_REGISTRY,
) -> DataFrame:
    """The redaction report without the rewritten text."""
    return redact(df, text, "generic", registry).drop("clean_text")


def report_by_source(
    df: DataFrame,
    source: str = "source",
    text: str = "text",
    registry: list[R.Pattern] = R.DEFAULT_REGISTRY,
) -> DataFrame:
    """Texts and matches per source and label: partial sums run before the shuffle."""
    hits = df.select(source, R.find_hits(F.col(text), registry).alias("_hits"))
    per_label = F.array(
        *[
            F.struct(F.lit(p.label).alias("label"), F.size(F.col("_hits")[p.label]).alias("n"))
            for p in registry
        ]
    )
    return (
        hits.select(source, F.inline(F.filter(per_label, lambda x: x["n"] > 0)))
        .groupBy(source, "label")
        .agg(F.count("*").alias("n_texts"), F.sum("n").alias("n_matches"))
    )


def circuit_breaker(
    df: DataFrame,
    text: str = "text",
    registry: list[R.Pattern] = R.DEFAULT_REGISTRY,
    compat: bool = False,
) -> DataFrame:
    """Redact, then withhold any text in which a pattern still matches.

    `leak` names the first leaking pattern, or `UNMARKED` when something was found
    but the text carries no redaction mark; `released` is null for such rows.
    """
    out = redact(df, text, "generic", registry, compat)
    clean = F.col("clean_text")
    leaks = [F.when(R.occurs(clean, p), F.lit(p.label)) for p in registry]
    unmarked = F.when(
        F.col("found_pii") & ~F.contains(clean, F.lit("[REDACTED_")), F.lit("UNMARKED")
    )
    return out.withColumn("leak", F.coalesce(*leaks, unmarked)).withColumn(
        "released", F.when(F.col("leak").isNull(), clean)
    )


def add_high_risk(df: DataFrame, risky: list[str] = HIGH_RISK_LABELS) -> DataFrame:
    return df.withColumn("safety_status", high_risk(F.col("patterns_matched"), risky))


def scrub(
    df: DataFrame,
    profile: str | list[tuple] = "lab",
    text: str = "text",
    out: str = "scrubbed",
) -> DataFrame:
    """Add the text with the profile's patterns substituted one after the other.

    `profile` names a built-in list or is one: (label, pattern), or (label, pattern,
    what every match contains), in order.
    """
    steps = SCRUB_PROFILES[profile] if isinstance(profile, str) else profile
    df = df.withColumn(out, F.col(text))
    for step in steps:
        df = df.withColumn(out, R.scrub_step(F.col(out), R.Pattern(*step)))
    return df


def mask_entities(
    df: DataFrame,
    entities: list[str] | Column = DEFAULT_ENTITIES,
    labels: dict[str, str] = ENTITY_LABELS,
    text: str = "text",
    out: str = "masked",
) -> DataFrame:
    """Replace the policy's structured entities by their labels; card numbers and
    IBANs must pass their check digits.  Only the listed entities are looked for: one list
    for all rows, or a column holding each row's own."""
    own = isinstance(entities, Column)
    wanted = [p for name, p in R.ENTITY_PATTERNS.items() if own or name in entities]
    if not wanted:
        return df.withColumn(out, F.col(text))
    none = F.array().cast("array<string>")

    def find(p: R.Pattern) -> Column:
        found = R.find_all(F.col(text), p)
        return F.when(F.array_contains(entities, p.label), found).otherwise(none) if own else found

    found = df.withColumn("_hits", F.struct(*[find(p).alias(p.label) for p in wanted]))
    masked = R.replace_generic(
        F.col(text), F.col("_hits"), wanted, lambda x: labels.get(x, DEFAULT_ENTITY_LABEL)
    )
    return found.withColumn(out, masked).drop("_hits")
