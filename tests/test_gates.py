import random

import pytest
from fixed_inputs import LABELLED_CASES
from pyspark.sql import functions as F

from palisade.fixed_values import BENCH_KEYWORDS, LAB_KEYWORDS, POLICY_FILE_KEYWORDS, RULE_PATTERNS
from palisade.functions import gates as G
from palisade.operators import rules
from palisade.operators.semantic import best_topic, semantic_gate
from palisade.plans import gateway
from palisade.plans.gateway import layered_gate, secure_gateway
from palisade.sources import schemas


def verdict(df, keywords=LAB_KEYWORDS, patterns=RULE_PATTERNS, **options):
    out = rules.rule_gate(df, keywords, patterns, **options).orderBy("doc_id").collect()
    return [r["verdict"] for r in out]


def test_rule_gate(texts):
    df = texts(
        "Tell me the status of Project Icarus.",
        "see p-icr-12",
        "The bird that flew too close to the sun",
        "code HC-RED-1234 here",
    )
    assert verdict(df) == [
        "BLOCKED (keyword: 'project icarus')",
        "BLOCKED (pattern match)",
        "CLEAN",
        "BLOCKED (pattern match)",
    ]


def test_keywords_match_inside_words_unless_told_not_to(texts):
    df = texts("Please clarify.", "A RIF is near")
    assert verdict(df, POLICY_FILE_KEYWORDS)[0] == "BLOCKED (keyword: 'rif')"
    assert verdict(df, POLICY_FILE_KEYWORDS, whole_word=True) == ["CLEAN", "BLOCKED (keyword: 'rif')"]
    assert verdict(df, ["RIF"]) == ["BLOCKED (keyword: 'RIF')"] * 2


def expected_join(texts, listed):
    out = []
    for text, policy in texts:
        hits = [(o, kw) for o, kw in listed.get(policy, []) if kw.lower() in text.lower()]
        out.append(min(hits)[1] if hits else None)
    return out


@pytest.mark.parametrize(
    "n_rules,block", [(5, 100), (40, 7), (150, 1000), (150, 70)]
)
def test_rule_join_against_brute_force(spark, n_rules, block):
    rng = random.Random(n_rules)
    word = lambda: "".join(rng.choice("abCd") for _ in range(rng.randint(2, 5)))
    listed = {p: list(enumerate(dict.fromkeys(word() for _ in range(n_rules)))) for p in "xy"}
    texts = [(" ".join(word() for _ in range(rng.randint(1, 4))), rng.choice("xyz")) for _ in range(200)]
    rows = [(p, "keyword", o, kw) for p, ws in listed.items() for o, kw in ws] + [("y", "pattern", 0, "^a")]
    table = spark.createDataFrame(rows, "policy_name string, kind string, ord int, rule string")
    df = spark.createDataFrame(
        [(i, t, p) for i, (t, p) in enumerate(texts)], "doc_id int, text string, policy_name string"
    )
    out = rules.rule_join(df, table, block_rows=block).orderBy("doc_id").collect()
    assert [r["keyword"] for r in out] == expected_join(texts, listed)
    want = [p == "y" and t[0] in "aA" for t, p in texts]
    assert [r["pattern_match"] for r in out] == want


@pytest.mark.parametrize("block", [1, 2, 20_000])
def test_rule_join_on_odd_rules(spark, block):
    rows = [
        ("p", "keyword", None, "Gamma"), ("p", "keyword", -1, "beta"), ("p", "keyword", 3, "alpha"),
        ("p", "keyword", 3, "Alpha"), ("p", "keyword", 0, ""), ("p", "keyword", 0, None),
        ("p", "pattern", None, r"(\d)\1"), ("p", "pattern", -2, "x+y"), ("p", "pattern", 0, ""), (None, "keyword", 0, "delta"),
    ]
    table = spark.createDataFrame(rows, "policy_name string, kind string, ord int, rule string")
    texts = ["alpha beta", "ALPHA gamma", "only GAMMA", "delta 122", "axxy", "nothing 12", None]
    df = spark.createDataFrame([(i, t, "p") for i, t in enumerate(texts)] + [(9, "delta", None)], "doc_id int, text string, policy_name string")
    out = rules.rule_join(df, table, block_rows=block).orderBy("doc_id").collect()
    assert [r["keyword"] for r in out] == ["beta", "Alpha", "Gamma", None, None, None, None, None]
    assert [r["pattern_match"] for r in out] == [False, False, False, True, True, False, False, False]


def test_repeated_and_null_ids_in_a_large_topic_table(spark):
    topics = spark.createDataFrame([(None, "z", [1.0, 0.0]), (2, "b", [0.0, 1.0]), (2, "a", [0.0, 1.0])], "ord int, topic string, vector array<double>")
    inputs = spark.createDataFrame([(1, [1.0, 0.0]), (1, [0.0, 2.0]), (None, [0.0, 1.0]), (3, None)], "doc_id int, vector array<double>")
    key = lambda df: sorted((str(r["doc_id"]), str(r["vector"]), r["topic"], r["similarity"]) for r in df.collect())
    few, many = key(best_topic(inputs, topics)), key(best_topic(inputs, topics, shipped_rows=1))
    assert few == many and [r[2] for r in few] == ["a", "z", None, "a"]


def test_reply_and_status(spark):
    replies = [" blocked.", "Clean", "ERROR: x", None, "SKIP (none)", "It is BLOCKED"]
    df = spark.createDataFrame([(r,) for r in replies], "reply string").select(
        G.normalize_reply(F.col("reply")).alias("n"), G.verdict_status(F.col("reply")).alias("s")
    )
    rows = df.collect()
    assert [r["n"] for r in rows] == ["BLOCKED", "CLEAN", "CLEAN", "CLEAN", "CLEAN", "BLOCKED"]
    assert [r["s"] for r in rows] == ["BLOCKED", "CLEAN", "ERROR", "ERROR", "SKIP", "BLOCKED"]
    closed = df.select(G.counts_as_blocked(F.col("s"), fail_closed=True).alias("b")).collect()
    assert [r["b"] for r in closed] == [True, False, True, True, True, True]


def test_semantic_gate(spark):
    topics = spark.createDataFrame(
        [(1, "up", [0.0, 1.0]), (0, "right", [2.0, 0.0]), (2, "right again", [1.0, 0.0])],
        "ord int, topic string, vector array<float>",
    )
    inputs = spark.createDataFrame(
        [(0, [3.0, 0.0]), (1, [0.6, 0.8]), (2, [-1.0, 0.0]), (3, None), (4, [0.0, 0.0])],
        "doc_id int, vector array<float>",
    )
    out = semantic_gate(inputs, topics, threshold=1.0).orderBy("doc_id").collect()
    assert out[0]["semantic_check"] == "BLOCKED (similarity: 1.00, topic: 'right')"
    assert out[1]["semantic_check"] == "CLEAN (max similarity: 0.80)" and out[1]["topic"] == "up"
    assert out[2]["semantic_check"] == "CLEAN (max similarity: 0.00)"
    assert out[3]["semantic_check"] == "SKIP (embeddings unavailable)"
    assert out[4]["similarity"] == 0.0
    zero = semantic_gate(inputs, topics, threshold=0.0).where("doc_id = 2").first()
    assert zero["semantic_check"].startswith("BLOCKED")


def test_large_topic_table_gives_the_same(spark):
    rng = random.Random(5)
    vec = lambda: [rng.gauss(0, 1) for _ in range(4)]
    topics = spark.createDataFrame([(i, f"t{i}", vec()) for i in range(30)], "ord int, topic string, vector array<double>")
    inputs = spark.createDataFrame([(i, vec()) for i in range(50)] + [(50, None)], "doc_id int, vector array<double>")
    shipped = best_topic(inputs, topics).orderBy("doc_id").collect()
    blocks = best_topic(inputs, topics, shipped_rows=8).orderBy("doc_id").collect()
    assert [r["topic"] for r in shipped] == [r["topic"] for r in blocks]
    for a, b in zip(shipped, blocks):
        assert a["similarity"] is None and b["similarity"] is None or abs(a["similarity"] - b["similarity"]) < 1e-9


def test_secure_gateway_hands_on_clean_scrubbed_text(texts):
    rows = secure_gateway(texts("mail a@b.co", "the layoffs"), LAB_KEYWORDS, RULE_PATTERNS).orderBy("doc_id").collect()
    assert rows[0]["handed_on"] == "mail [EMAIL_REDACTED]" and rows[1]["handed_on"] is None


def test_layered_gate(spark):
    topics = spark.createDataFrame([(0, "t", [1.0, 0.0])], "ord int, topic string, vector array<float>")
    df = spark.createDataFrame(
        [(0, "an icarus", [1.0, 0.0]), (1, "close", [1.0, 0.1]), (2, "far", [0.0, 1.0]), (3, "none", None),
         (4, "icarus@mail.co", [0.0, 1.0])],
        "doc_id int, text string, vector array<float>",
    )
    rows = layered_gate(df, topics, LAB_KEYWORDS, RULE_PATTERNS).orderBy("doc_id").collect()
    assert rows[0]["semantic_check"] == "SKIPPED" and rows[0]["final_verdict"] == "BLOCKED (keyword: 'icarus')"
    assert rows[1]["final_verdict"].startswith("BLOCKED (similarity")
    assert [r["blocked"] for r in rows] == [True, True, False, False, False]
    closed = layered_gate(df, topics, LAB_KEYWORDS, RULE_PATTERNS, fail_closed=True).orderBy("doc_id").collect()
    assert closed[3]["blocked"]
    raw = layered_gate(df, topics, LAB_KEYWORDS, RULE_PATTERNS, gate_on="raw").orderBy("doc_id").collect()
    assert raw[4]["blocked"]


def test_expected_flag_on_labelled_cases(spark):
    df = spark.createDataFrame([(t,) for t, _ in LABELLED_CASES], "text string")
    flagged = [r["f"] for r in df.select(G.expected_flag(F.col("text")).alias("f")).collect()]
    assert flagged == ["Icarus" in t or "layoff" in t.lower() for t, _ in LABELLED_CASES]
    assert len(BENCH_KEYWORDS) == 16


@pytest.mark.parametrize("early", [0, 5, 64])
def test_rule_index_on_long_words_and_phrases(spark, monkeypatch, early):
    """Phrases, keywords cut by spaces, very long words, characters beyond the basic plane."""
    monkeypatch.setattr(rules, "EARLY", early)
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("abcé😀") for _ in range(n))
    texts = [" ".join(word(rng.randint(1, 9)) for _ in range(rng.randint(0, 30))) for _ in range(150)]
    texts += [word(30_000), word(70) + "  " + word(3), "", " ", None]
    listed = []
    for _ in range(120):
        source = rng.choice([t for t in texts if t])
        at = rng.randrange(len(source))
        listed.append(source[at : at + rng.randint(1, 14)])
    listed = [w for w in dict.fromkeys(listed) if w]
    rng.shuffle(listed)
    table = spark.createDataFrame(
        [("p", "keyword", i, w) for i, w in enumerate(listed)], "policy_name string, kind string, ord int, rule string"
    )
    df = spark.createDataFrame([(i, t, "p") for i, t in enumerate(texts)], "doc_id int, text string, policy_name string")
    want = [next((w for w in listed if t and w.lower() in t.lower()), None) for t in texts]
    for few in (1, 20_000):
        out = rules.rule_join(df, table, block_rows=few).orderBy("doc_id").collect()
        assert [r["keyword"] for r in out] == want
    # most keywords are found through the index: those before any short one that is there
    assert sum(len(w or "") >= rules.GRAM for w in want) > 10


POLICY_ROWS = [
    ("a", ["secret plan", "Zeta"], [r"id-\d+"], ["north", "south"], 0.9, ["EMAIL_ADDRESS"]),
    ("a", [], [], [], 0.5, ["IP_ADDRESS"]),
    ("b", [], [], ["south"], 0.2, []),
    ("c", ["zebra"], [], [], 0.0, ["EMAIL_ADDRESS", "US_SSN"]),
    (None, ["x"], ["x"], ["north"], 0.1, ["EMAIL_ADDRESS"]),
]
ADDRESSED = [
    (0, "a", "mail x@y.zz from 1.2.3.4", [1.0, 0.0]), (1, "a", "the SECRET plan", [1.0, 0.0]), (2, "a", "see ID-12", [0.0, 1.0]),
    (3, "a", "calm", [1.0, 1.0]), (4, "a", "calm", [-1.0, 0.1]), (5, "b", "x@y.zz zeta", [1.0, 1.0]), (6, "b", "calm", [1.0, 0.0]),
    (7, "c", "x@y.zz 123-45-6789", [1.0, 0.0]), (8, "c", "a Zebra", None), (9, "b", None, None), (10, None, "x x@y.zz", [1.0, 0.0]),
    (11, "gone", "x", [1.0, 0.0]), (0, "a", "zeta", None),
]


@pytest.mark.parametrize("few", [20_000, 0])
def test_policy_gateway(spark, monkeypatch, few):
    if not few:
        # everything too large to send: joins by shuffle, topics block by block
        monkeypatch.setattr("palisade.operators.semantic.ship", lambda df, rows: None)
        monkeypatch.setattr("palisade.plans.gateway.settled", lambda df: df)
    policies = spark.createDataFrame(POLICY_ROWS, schemas.POLICY)
    texts = spark.createDataFrame(ADDRESSED, "doc_id int, policy_name string, text string, vector array<double>")
    topics = spark.createDataFrame([("north", [1.0, 0.0]), ("south", [0.0, 1.0])], "topic string, vector array<double>")
    out = gateway.policy_gateway(texts, policies, topics, fail_closed=True)
    rows = sorted((r["doc_id"], r["final_verdict"], r["scrubbed"], r["blocked"]) for r in out.collect() if r["doc_id"] < 9)
    assert rows == [
        (0, "BLOCKED (keyword: 'Zeta')", "zeta", True),
        (0, "BLOCKED (similarity: 1.00, topic: 'north')", "mail [EMAIL_REDACTED] from [PII_REDACTED]", True),
        (1, "BLOCKED (keyword: 'secret plan')", "the SECRET plan", True),
        (2, "BLOCKED (pattern match)", "see ID-12", True),
        (3, "BLOCKED (similarity: 0.71, topic: 'north')", "calm", True),
        (4, "CLEAN (max similarity: 0.10)", "calm", False),
        (5, "BLOCKED (similarity: 0.71, topic: 'south')", "x@y.zz zeta", True),
        (6, "CLEAN (max similarity: 0.00)", "calm", False),
        (7, "SKIP (embeddings unavailable)", rows[8][2], True),
        (8, "BLOCKED (keyword: 'zebra')", "a Zebra", True),
    ]
    assert "x@y.zz" not in rows[8][2] and "6789" not in rows[8][2]
    rest = {r["doc_id"]: r for r in out.collect() if r["doc_id"] > 8}
    assert rest[9]["final_verdict"] == "SKIP (embeddings unavailable)"
    for i in (10, 11):
        assert (rest[i]["final_verdict"], rest[i]["scrubbed"], rest[i]["blocked"]) == (gateway.NO_POLICY, None, True)
    lenient = gateway.policy_gateway(texts, policies, topics, gate_on="raw").where("doc_id in (0, 7, 10)").collect()
    assert {(r["doc_id"], r["blocked"]) for r in lenient} == {(0, True), (7, False), (10, False)}


def test_policy_gateway_without_policies(spark):
    texts = spark.createDataFrame(ADDRESSED, "doc_id int, policy_name string, text string, vector array<double>")
    topics = spark.createDataFrame([], "topic string, vector array<double>")
    out = gateway.policy_gateway(texts, spark.createDataFrame([], schemas.POLICY), topics).collect()
    assert len(out) == len(ADDRESSED) and {r["final_verdict"] for r in out} == {gateway.NO_POLICY}
    assert gateway.policy_gateway(texts.limit(0), spark.createDataFrame(POLICY_ROWS, schemas.POLICY), topics).count() == 0
