"""Rounding and number formats.

`format_number` with an explicit pattern rounds half-even on the exact binary
value, which is what Python's `round` and `%.nf` do; `round` and `bround` work on
the decimal text and differ (0.15 to one place, for example).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed(value: Column, places: int) -> Column:
    """Text with exactly `places` decimals."""
    pattern = "0" if places == 0 else "0." + "0" * places
    return F.call_function("format_number", value.cast("double"), F.lit(pattern))


def rounded(value: Column, places: int) -> Column:
    # NaN and the infinities have no decimals; adding 0.0 turns -0.0 into 0.0
    number = value.cast("double")
    finite = F.abs(number) < F.lit(float("inf"))
    return F.when(finite, fixed(number, places).cast("double") + F.lit(0.0)).otherwise(number)


def percent(value: Column) -> Column:
    return F.concat(fixed(value * 100, 1), F.lit("%"))


def milliseconds(value: Column) -> Column:
    return F.concat(fixed(value, 0), F.lit("ms"))


def dollars(value: Column, places: int) -> Column:
    return F.concat(F.lit("$"), fixed(value, places))


def cost_label(value: Column) -> Column:
    """`FREE` for nothing, else the amount right-aligned in ten places."""
    return F.when(value == 0, F.lit("FREE")).otherwise(
        F.concat(F.lit("$"), F.lpad(fixed(value, 6), 10, " "))
    )


def price_label(input_cost: Column, output_cost: Column) -> Column:
    per_million = F.concat(
        dollars(input_cost * 1_000_000, 2),
        F.lit(" in / "),
        dollars(output_cost * 1_000_000, 2),
        F.lit(" out per 1M tokens"),
    )
    return F.when(input_cost == 0, F.lit("FREE")).otherwise(per_million)
