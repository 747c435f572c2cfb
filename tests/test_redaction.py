import random
import re
from functools import reduce

import pytest
from fixed_inputs import BLOCKED_SPECIMENS, SPECIMENS
from pyspark.sql import functions as F

from palisade.fixed_values import REDACTION_PATTERNS, SCRUB_PROFILES
from palisade.functions import redaction as R
from palisade.operators import scrub as S
from palisade.plans.gateway import triple_lock


def redacted(df, **options):
    return [r.asDict() for r in S.redact(df, **options).orderBy("doc_id").collect()]


def plain_redact(text, coding, registry=REDACTION_PATTERNS):
    """The same rules over one text: (label, number, match) triples, replaced in order."""
    hits = [
        (label, i, m.group(0))
        for label, pattern, *_ in registry
        for i, m in enumerate(re.finditer(pattern, text), 1)
    ]
    mark = (lambda x, i: f"[VAR_{x}_{i}]") if coding else (lambda x, i: f"[REDACTED_{x}]")
    clean = reduce(lambda acc, h: acc.replace(h[2], mark(h[0], h[1])), hits, text)
    return clean, list(dict.fromkeys(h[0] for h in hits)), len(hits)


@pytest.mark.parametrize("mode", ["generic", "coding"])
def test_agrees_with_plain_python(texts, mode):
    odd = ["é123.4.5.6 ü@b.co", "a@b.co and a@b.co", "x", "", "1.2.3.4 1.2.3.4", "tel 12345 12345"]
    values = [*SPECIMENS.values(), *odd]
    for row, text in zip(redacted(texts(*values), mode=mode), values):
        want = plain_redact(text, mode == "coding")
        assert (row["clean_text"], row["patterns_matched"], row["redacted_count"]) == want
        assert row["found_pii"] == bool(want[1])


def test_specimens(spark):
    df = spark.createDataFrame(list(SPECIMENS.items()), "doc_id int, text string")
    rows = triple_lock(df).collect()
    assert {r["doc_id"] for r in rows if r["safety_status"] == "BLOCK"} == BLOCKED_SPECIMENS
    assert all((r["faithfulness_score"] is None) == (r["safety_status"] == "BLOCK") for r in rows)
    assert {r["violations"] for r in rows if not r["found_pii"]} == {"NONE"}


def test_key_is_replaced_whole_or_by_group(texts):
    secret = "q" * 32
    df = texts("sk_" + secret)
    assert redacted(df)[0]["clean_text"] == "[REDACTED_API_KEY]"
    assert redacted(df, compat=True)[0]["clean_text"] == f"[REDACTED_API_KEY]_{secret}"


def test_repeated_value(texts):
    df = texts("a@b.co and a@b.co")
    generic, coding = redacted(df)[0], redacted(df, mode="coding")[0]
    assert generic["clean_text"] == "[REDACTED_EMAIL] and [REDACTED_EMAIL]"
    assert coding["clean_text"] == "[VAR_EMAIL_1] and [VAR_EMAIL_1]"
    assert generic["redacted_count"] == coding["redacted_count"] == 2


def test_registry_extension(texts):
    more = R.with_pattern(R.DEFAULT_REGISTRY, "STAFF_ID", r"EMP-[0-9]{5}")
    assert redacted(texts("ask EMP-12345"), registry=more)[0]["clean_text"] != "ask EMP-12345"
    replaced = R.with_pattern(more, "PHONE", r"tel:\d+")
    assert [p.label for p in replaced] == [p.label for p in more]
    out = redacted(texts("ask EMP-12345"), registry=replaced)[0]
    assert out["clean_text"] == "ask [REDACTED_STAFF_ID]"
    with pytest.raises(ValueError):
        R.with_pattern(more, "TWO", r"(a)(b)")
    with pytest.raises(ValueError):
        R.with_pattern(more, "EMPTY", r"a*")
    with pytest.raises(ValueError):
        S.redact(texts("x"), mode="other")


def test_circuit_breaker_never_releases_a_match(texts):
    secret = "q" * 32
    df = texts(*SPECIMENS.values(), "sk_" + secret)
    for compat in (False, True):
        for row in S.circuit_breaker(df, compat=compat).collect():
            if row["released"] is None:
                assert row["leak"]
            else:
                assert not any(re.search(p, row["released"]) for _, p, _ in REDACTION_PATTERNS)


def test_report_by_source(spark):
    rows = [(1, "a", "x@y.zz 1.2.3.4"), (2, "a", "p@q.rr"), (3, "b", "clean")]
    df = spark.createDataFrame(rows, "doc_id int, source string, text string")
    out = {(r["source"], r["label"]): (r["n_texts"], r["n_matches"]) for r in S.report_by_source(df).collect()}
    assert out[("a", "EMAIL")] == (2, 2)
    assert not any(source == "b" for source, _ in out)


def test_scrub_profiles(texts):
    df = texts("My email is john@company.com", "Call me at 555-123-4567 now", "at 10.0.0.1", "sk-" + "a" * 32, None)
    lab = [r["scrubbed"] for r in S.scrub(df).orderBy("doc_id").collect()]
    assert lab == [
        "My email is [EMAIL_REDACTED]",
        "Call me at [PHONE_REDACTED] now",
        "at [IP_ADDRESS_REDACTED]",
        "[API_KEY_REDACTED]",
        None,
    ]
    five = [r["scrubbed"] for r in S.scrub(df, "bench5").orderBy("doc_id").collect()]
    assert five[2] == "at [IP_REDACTED]" and five[3] == "sk-" + "a" * 32
    assert S.scrub(df, "bench3").first()["scrubbed"] == "My email is [EMAIL]"


def test_mask_entities(texts):
    df = texts(
        "card 4111 1111 1111 1111", "card 4111 1111 1111 1112", "iban GB82WEST12345698765432",
        "iban GB83WEST12345698765432", "ssn 123-45-6789", "see https://a.b/c?d mail a@b.co", "nothing",
    )
    out = [r["masked"] for r in S.mask_entities(df).orderBy("doc_id").collect()]
    assert out[0] == "card [CC_REDACTED]" and "1112" in out[1]
    assert out[2] == "iban [IBAN_REDACTED]" and "GB83WEST" in out[3]
    assert out[4] == "ssn [SSN_REDACTED]"
    assert out[5] == "see [PII_REDACTED] mail [EMAIL_REDACTED]"
    assert out[6] == "nothing"
    only = S.mask_entities(df, entities=["EMAIL_ADDRESS", "PERSON"]).where(F.col("doc_id") == 4)
    assert only.first()["masked"] == "ssn 123-45-6789"


def test_addresses_as_python_finds_them(spark, texts):
    rng = random.Random(3)
    values = ["".join(rng.choice("ab.-@+ é_") for _ in range(rng.randint(0, 25))) for _ in range(600)]
    values += ["a@b.c-d@e.f", "x@y.z@w.v", "..@..", "a@b@c.d.e@f.g"]
    for p in [R.DEFAULT_REGISTRY[0], R.Pattern(*SCRUB_PROFILES["lab"][0])]:
        assert p.java != "(?U)" + p.regex
        found = texts(*values).select("doc_id", R.find_all(F.col("text"), p).alias("m")).orderBy("doc_id").collect()
        assert [r["m"] for r in found] == [re.findall(p.regex, v) for v in values]


def test_a_very_long_run_takes_one_pass(texts):
    df = texts("@ " + "a" * 3_000_000, "b" * 3_000_000 + " x@y.zz")
    rows = redacted(df)
    assert rows[0]["redacted_count"] == 0 and rows[1]["patterns_matched"] == ["EMAIL"]
    assert S.scrub(df).where("doc_id = 1").first()["scrubbed"].endswith(" [EMAIL_REDACTED]")


def test_values_that_occur_in_marks_are_replaced_as_often_as_found(texts):
    registry = R.DEFAULT_REGISTRY
    for label, regex in [("SHORT", "RED|ACT"), ("HOOK", r"\w?[\]\[]\w?"), ("FOUR", "IPV4|4"), ("LOW", "[a-c]+")]:
        registry = R.with_pattern(registry, label, regex)
    values = ["RED 1.2.3.4 ACT RED [x] [x] 4", "a@b.co [[ ]] RED", "abc cab abc 1.2.3.4 IPV4 1.2.3.4"]
    for mode in ("generic", "coding"):
        for row, text in zip(redacted(texts(*values), mode=mode, registry=registry), values):
            want = plain_redact(text, mode == "coding", registry)
            assert (row["clean_text"], row["patterns_matched"], row["redacted_count"]) == want


def test_one_value_found_very_often(texts):
    row = redacted(texts("a@b.co " * 40_000))[0]
    assert row["clean_text"] == "[REDACTED_EMAIL] " * 40_000
    assert row["redacted_count"] == 40_000
