"""The SQL side of redaction, scrubbing and masking, built from the fixed patterns."""

from __future__ import annotations

from palisade.catalog.views import REGISTRY
from palisade.fixed_values import (
    DEFAULT_ENTITY_LABEL,
    ENTITY_LABELS,
    HIGH_RISK_LABELS,
    SCRUB_PROFILES,
)
from palisade.functions.redaction import ENTITY_PATTERNS


def unicode_classes(regex: str) -> str:
    r"""Spell out \w, \d and \s, which are ASCII-only in the oracle's dialect."""
    out, inside, i = [], False, 0
    names = {"w": r"\p{L}\p{N}_", "d": r"\p{Nd}", "s": r"\s\p{Z}"}
    while i < len(regex):
        ch = regex[i]
        if ch == "\\":
            known = names.get(regex[i + 1])
            out.append((known if inside else f"[{known}]") if known else regex[i : i + 2])
            i += 2
            continue
        if ch == "[":
            inside = True
        elif ch == "]":
            inside = False
        out.append(ch)
        i += 1
    return "".join(out)


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _all(regex: str) -> str:
    return f"regexp_extract_all(text, {quoted(unicode_classes(regex))})"


def _fold(start: str, list_: str, mark: str) -> str:
    return f"list_reduce(list_prepend({start}, {list_}), lambda a, m: replace(a, m, {quoted(mark)}))"


def _found(columns: str) -> str:
    finds = ", ".join(f"{_all(p.regex)} AS m_{p.label}" for p in REGISTRY)
    return f"found AS (SELECT {columns}, text, {finds} FROM documents)"


def hits_cte(columns: str = "doc_id, source") -> str:
    """found: the match lists; hits: with the report columns and the generic clean text."""
    clean = "text"
    for p in REGISTRY:
        clean = _fold(clean, f"m_{p.label}", f"[REDACTED_{p.label}]")
    marks = " || ".join(
        f"CASE WHEN len(m_{p.label}) > 0 THEN ', {p.label}' ELSE '' END" for p in REGISTRY
    )
    count = " + ".join(f"len(m_{p.label})" for p in REGISTRY)
    return f"""{_found(columns)},
hits AS (
  SELECT *, {clean} AS clean_text, substr({marks}, 3) AS labels, {count} AS redacted_count
  FROM found)"""


def coding_cte() -> str:
    clean = "text"
    for p in REGISTRY:
        pairs = (
            f"list_transform(m_{p.label}, lambda m, i: m || chr(1) || '[VAR_{p.label}_' || i || ']')"
        )
        clean = (
            f"list_reduce(list_prepend({clean}, {pairs}), "
            "lambda a, m: replace(a, split_part(m, chr(1), 1), split_part(m, chr(1), 2)))"
        )
    return f"{_found('doc_id')},\nhits AS (SELECT doc_id, {clean} AS clean_text FROM found)"


def high_risk_sql() -> str:
    any_risk = " OR ".join(f"len(m_{label}) > 0" for label in HIGH_RISK_LABELS)
    return f"CASE WHEN {any_risk} THEN 'BLOCK' ELSE 'PASS' END"


def leak_sql() -> str:
    tests = " ".join(
        f"WHEN regexp_matches(clean_text, {quoted(unicode_classes(p.regex))}) THEN '{p.label}'"
        for p in REGISTRY
    )
    return (
        f"CASE {tests} WHEN labels <> '' AND NOT contains(clean_text, '[REDACTED_') "
        "THEN 'UNMARKED' END"
    )


def by_source_sql() -> str:
    rows = "\n  UNION ALL\n".join(
        f"  SELECT source, '{p.label}' AS label, len(m_{p.label}) AS n FROM found WHERE len(m_{p.label}) > 0"
        for p in REGISTRY
    )
    return f"""WITH {_found('doc_id, source')},
per_label AS (
{rows})
SELECT source, label, count(*) AS n_texts, CAST(sum(n) AS BIGINT) AS n_matches
FROM per_label GROUP BY source, label"""


def scrub_sql(profile: str, text: str = "text") -> str:
    for label, regex, _ in SCRUB_PROFILES[profile]:
        text = f"regexp_replace({text}, {quoted(unicode_classes(regex))}, '[{label}]', 'g')"
    return text


def masked_sql(entities: list[str] | None = None) -> str:
    """The entity mask, of all or some entities; card numbers and IBANs are kept only with valid
    check digits."""
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    doubled = f"CAST(substr({digits}, CAST(length({digits}) - i AS INTEGER), 1) AS INTEGER) * CASE WHEN i % 2 = 1 THEN 2 ELSE 1 END"
    luhn = (
        f"list_sum(list_transform(range(0, length({digits})), lambda i: "
        f"CASE WHEN {doubled} > 9 THEN {doubled} - 9 ELSE {doubled} END)) % 10 = 0"
    )
    moved = "string_split(substr(m, 5) || substr(m, 1, 4), '')"
    iban = (
        f"list_reduce(list_prepend(0, list_transform({moved}, lambda c: ord(c))), lambda a, c: "
        "CASE WHEN c >= 65 THEN (a * 100 + c - 55) % 97 ELSE (a * 10 + c - 48) % 97 END) = 1"
    )
    checks = {"CREDIT_CARD": luhn, "IBAN_CODE": iban}
    masked = "text"
    for name, p in ENTITY_PATTERNS.items():
        if entities is not None and name not in entities:
            continue
        found = _all(p.regex)
        if name in checks:
            found = f"list_filter({found}, lambda m: {checks[name]})"
        masked = _fold(masked, found, ENTITY_LABELS.get(name, DEFAULT_ENTITY_LABEL))
    return masked
