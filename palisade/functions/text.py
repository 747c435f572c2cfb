"""String helpers with the exact semantics the operators need."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from palisade.fixed_values import BOX_CHARACTERS, STRIP_CHARACTERS


def strip(text: Column) -> Column:
    """Trim every Unicode space, where Spark's own `trim` only knows U+0020."""
    return F.btrim(text, F.lit(STRIP_CHARACTERS))


def sanitize(text: Column) -> Column:
    """Drop box-drawing characters and bold markers, then trim."""
    plain = F.translate(text, BOX_CHARACTERS, "")
    return strip(F.replace(plain, F.lit("**"), F.lit("")))


def cut(text: Column, limit: int) -> Column:
    return F.substring(text, 1, limit)


def cut_with_dots(text: Column, limit: int = 70) -> Column:
    return F.when(
        F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("..."))
    ).otherwise(text)


def contains_any(text: Column, phrases: list[str]) -> Column:
    """Case-blind: does any of a short list of lower-case phrases occur?"""
    lowered = F.lower(text)
    hit = F.lit(False)
    for phrase in phrases:
        hit = hit | F.contains(lowered, F.lit(phrase))
    return hit
