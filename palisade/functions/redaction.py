"""Pattern registry, find-all and replace, as JVM expressions.

Redaction finds every match in the *original* text, registry order, and then
replaces each found value literally in the running text.  Finding and replacing
are two columns on purpose: the match lists feed the clean text, the report and
the count, and Spark does not merge projections whose costly column has several
readers, so each pattern is run once per row.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from palisade.fixed_values import ANY_DIGIT, REDACTION_PATTERNS


# Character classes that open an address pattern.  A match of `[class]+@...` can only
# start where a run of the class starts, or where the last match ended; saying so keeps
# a text with a very long run from being tried at each of its characters.
RUN_CLASSES = {r"[\w\.-]", "[a-zA-Z0-9_.+-]"}


class Pattern(NamedTuple):
    label: str
    regex: str
    needs: str | None = None  # a literal, or ANY_DIGIT, that every match contains
    accept: Callable[[Column], Column] | None = None  # extra test on a match

    @property
    def java(self) -> str:
        """The regex as the JVM runs it: Unicode classes, long runs tried only once."""
        run, at, rest = self.regex.partition("+@")
        if at and run in RUN_CLASSES:
            return f"(?U)(?:(?<!{run})|\\G){run}++@{rest}"
        return "(?U)" + self.regex

    @property
    def groups(self) -> int:
        return re.compile(self.regex).groups


DEFAULT_REGISTRY = [Pattern(*row) for row in REDACTION_PATTERNS]


def with_pattern(registry: list[Pattern], label: str, regex: str) -> list[Pattern]:
    """Append a pattern; an existing label keeps its place and gets the new regex."""
    compiled = re.compile(regex)
    if compiled.groups > 1:
        raise ValueError(f"{label}: at most one capture group is supported")
    if compiled.search("") is not None:
        raise ValueError(f"{label}: the pattern matches the empty string")
    added = Pattern(label, regex)
    if any(p.label == label for p in registry):
        return [added if p.label == label else p for p in registry]
    return [*registry, added]


def may_occur(text: Column, pattern: Pattern) -> Column:
    """A cheap test that spares most texts the regex."""
    if pattern.needs is None:
        return F.lit(True)
    if pattern.needs == ANY_DIGIT:
        return F.rlike(text, F.lit("(?U)" + ANY_DIGIT))
    return F.contains(text, F.lit(pattern.needs))


def occurs(text: Column, pattern: Pattern) -> Column:
    return may_occur(text, pattern) & F.rlike(text, F.lit(pattern.java))


def find_all(text: Column, pattern: Pattern, compat: bool = False) -> Column:
    """All matches, left to right; rows without one never reach the extraction.

    `compat` returns the capture group, where the pattern has one.
    """
    group = 1 if compat and pattern.groups == 1 else 0
    found = F.regexp_extract_all(text, F.lit(pattern.java), F.lit(group))
    if pattern.accept:
        found = F.filter(found, pattern.accept)
    return F.when(occurs(text, pattern), found).otherwise(F.array().cast("array<string>"))


def find_hits(text: Column, registry: list[Pattern], compat: bool = False) -> Column:
    """One struct field per label, holding the list of matches."""
    return F.struct(*[find_all(text, p, compat).alias(p.label) for p in registry])


def replace_generic(text: Column, hits: Column, registry: list[Pattern], token) -> Column:
    """Fold `replace` over all hits; `token(label)` gives the replacement text.

    Replacing a value a second time changes nothing, unless it can occur again inside or
    across a mark.  So each value is replaced once, but for lists with such a value.
    """
    marks = [token(p.label) for p in registry]
    bracketed = all(m.startswith("[") and m.endswith("]") for m in marks)

    def again(m: Column) -> Column:
        in_mark = F.contains(F.lit(" ".join(marks)), m)
        return in_mark | F.contains(m, F.lit("[")) | F.contains(m, F.lit("]"))

    def fold(clean: Column, label: str) -> Column:
        mark, found = F.lit(token(label)), hits[label]
        if bracketed:
            found = F.when(F.exists(found, again), found).otherwise(F.array_distinct(found))
        return F.aggregate(found, clean, lambda acc, m: F.replace(acc, m, mark))

    for p in registry:
        text = fold(text, p.label)
    return text


def replace_numbered(text: Column, hits: Column, registry: list[Pattern]) -> Column:
    """As above with `[VAR_LABEL_i]`, i counting the matches of one pattern from 1."""

    def fold(clean: Column, label: str) -> Column:
        head = F.lit(f"[VAR_{label}_")
        numbered = F.transform(
            hits[label],
            lambda m, i: F.struct(
                m.alias("m"), F.concat(head, (i + 1).cast("string"), F.lit("]")).alias("r")
            ),
        )
        return F.aggregate(numbered, clean, lambda acc, x: F.replace(acc, x["m"], x["r"]))

    for p in registry:
        text = fold(text, p.label)
    return text


def labels_matched(hits: Column, registry: list[Pattern]) -> Column:
    marks = [F.when(F.size(hits[p.label]) > 0, F.lit(p.label)) for p in registry]
    return F.array_compact(F.array(*marks))


def count_hits(hits: Column, registry: list[Pattern]) -> Column:
    total = F.lit(0)
    for p in registry:
        total = total + F.size(hits[p.label])
    return total


def scrub_step(text: Column, step: Pattern) -> Column:
    """One substitution on the running text; `[LABEL]` replaces a match."""
    done = F.regexp_replace(text, step.java, f"[{step.label}]")
    return F.when(may_occur(text, step), done).otherwise(text) if step.needs else done


def luhn_ok(match: Column) -> Column:
    return F.call_function("luhn_check", F.regexp_replace(match, r"[^0-9]", ""))


def iban_ok(match: Column) -> Column:
    """ISO 7064 mod 97: country and check digits go last, letters count from 10."""
    moved = F.concat(F.substring(match, 5, 64), F.substring(match, 1, 4))

    def step(acc: Column, ch: Column) -> Column:
        code = F.ascii(ch)
        return F.when(code >= 65, (acc * 100 + code - 55) % 97).otherwise(
            (acc * 10 + code - 48) % 97
        )

    return F.aggregate(F.split(moved, ""), F.lit(0), step) == 1


# Structured entities, most specific first so that a wider match is replaced before
# a narrower one can take a part of it.  Names of people and places need a trained
# model and are not looked for.
ENTITY_PATTERNS = {
    "URL": Pattern("URL", r"https?://[^\s<>\"']+", "://"),
    "EMAIL_ADDRESS": Pattern("EMAIL_ADDRESS", r"[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+(?:\.[a-zA-Z0-9-]+)+", "@"),
    "IBAN_CODE": Pattern("IBAN_CODE", r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", ANY_DIGIT, iban_ok),
    "CREDIT_CARD": Pattern("CREDIT_CARD", r"(?:[0-9]{4}[- ]?){3}[0-9]{4}", ANY_DIGIT, luhn_ok),
    "CRYPTO": Pattern("CRYPTO", r"(?:bc1|[13])[a-km-zA-HJ-NP-Z1-9]{25,39}", None),
    "US_SSN": Pattern("US_SSN", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", ANY_DIGIT),
    "IP_ADDRESS": Pattern("IP_ADDRESS", r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}", ANY_DIGIT),
    "PHONE_NUMBER": Pattern("PHONE_NUMBER", r"\+?[0-9]{0,3}[-. ]?[0-9]{3}[-. ][0-9]{3}[-. ][0-9]{4}", ANY_DIGIT),
}
