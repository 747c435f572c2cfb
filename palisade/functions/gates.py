"""Keyword, pattern and reply gates as column expressions.

The functions take the lower-cased text as its own column: computed once per row
by the caller, read by every keyword.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from palisade.fixed_values import EXPECTED_FLAG_ANY_CASE, EXPECTED_FLAG_EXACT
from palisade.functions.text import strip

CLEAN = "CLEAN"
BLOCKED = "BLOCKED"


def keyword_hit(lowered: Column, keywords: list[str], whole_word: bool = False) -> Column:
    """First keyword, in list order, contained in the text; null when none is."""
    tests = []
    for kw in keywords:
        if whole_word:
            found = F.rlike(lowered, F.lit(r"(?iU)\b" + re.escape(kw.lower()) + r"\b"))
        else:
            found = F.contains(lowered, F.lit(kw.lower()))
        tests.append(F.when(found, F.lit(kw)))
    return F.coalesce(*tests) if tests else F.lit(None).cast("string")


def pattern_hit(text: Column, patterns: list[str]) -> Column:
    hit = F.lit(False)
    for pattern in patterns:
        hit = hit | F.rlike(text, F.lit("(?iU)" + pattern))
    return hit


def rule_verdict(keyword: Column, pattern: Column) -> Column:
    return (
        F.when(
            keyword.isNotNull(), F.concat(F.lit("BLOCKED (keyword: '"), keyword, F.lit("')"))
        )
        .when(pattern, F.lit("BLOCKED (pattern match)"))
        .otherwise(F.lit(CLEAN))
    )


def is_blocked(verdict: Column) -> Column:
    return F.startswith(verdict, F.lit(BLOCKED))


def high_risk(labels: Column, risky: list[str]) -> Column:
    return F.when(
        F.arrays_overlap(labels, F.array(*[F.lit(x) for x in risky])), F.lit("BLOCK")
    ).otherwise(F.lit("PASS"))


def expected_flag(
    text: Column, exact: str = EXPECTED_FLAG_EXACT, any_case: str = EXPECTED_FLAG_ANY_CASE
) -> Column:
    return F.contains(text, F.lit(exact)) | F.contains(
        F.lower(text), F.lit(any_case)
    )


def normalize_reply(reply: Column) -> Column:
    """A model's reply reduced to BLOCKED or CLEAN."""
    return F.when(
        F.contains(F.upper(strip(reply)), F.lit(BLOCKED)), F.lit(BLOCKED)
    ).otherwise(F.lit(CLEAN))


def verdict_status(verdict: Column) -> Column:
    """BLOCKED, CLEAN, SKIP or ERROR; a missing verdict is an error."""
    return (
        F.when(verdict.isNull() | F.startswith(verdict, F.lit("ERROR")), F.lit("ERROR"))
        .when(F.startswith(verdict, F.lit("SKIP")), F.lit("SKIP"))
        .when(F.contains(F.upper(verdict), F.lit(BLOCKED)), F.lit(BLOCKED))
        .otherwise(F.lit(CLEAN))
    )


def counts_as_blocked(status: Column, fail_closed: bool = False) -> Column:
    """SKIP and ERROR let a text through unless the gate is to fail closed."""
    blocking = [BLOCKED, "SKIP", "ERROR"] if fail_closed else [BLOCKED]
    return status.isin(blocking)
