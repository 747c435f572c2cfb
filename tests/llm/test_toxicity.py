"""The label model against enumeration, voters, and held-out accuracy of the classifier."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from palisade.llm import toxicity as X
from palisade.llm.common import fold, table
from palisade.llm.queries import QUERIES

WORDS = "the cat and dog house window tree river stone bread garden letter music paper silver winter".split()


def clean(r, n=60):
    return " ".join(r.choice(WORDS) + r.choice(["", "er", "ing", "ly"]) for _ in range(n))


def rude(r, n=60):
    words = clean(r, n).split()
    for _ in range(r.randrange(2, 6)):
        # A stem nobody listed, with any ending.
        words[r.randrange(n)] = r.choice(["zorp", "Grubb"]) + r.choice(["", "er", "ing", "ly", "ed", "ness"])
    return " ".join(words) + "."


@pytest.fixture(scope="module")
def corpus(spark):
    r = random.Random(9)
    rows = [(i, rude(r) if i % 6 == 0 else clean(r), "s") for i in range(900)]
    copies = [(2000 + i, rows[6][1], "s") for i in range(150)]
    odd = [(3000, None, "s"), (3001, "", "s"), (3002, " !!! ", "s"), (None, rows[0][1], "s"), (6, rows[6][1], "s")]
    odd += [(3003, clean(r, 200_000), "s"), (3004, "x" * 500_000, "s"), (3005, "IDIOT scum y0u m0r0n", "s")]
    docs = spark.createDataFrame(rows + copies + odd, "doc_id long, text string, score string").repartition(6)
    labels = spark.createDataFrame(
        [(i, int(i % 6 == 0), 1) for i in range(0, 900, 2)] + [(2000 + i, 1, 1) for i in range(150)]
        + [(1, 1, 0), (1, 0, 0), (None, 1, 0), (7, None, 0)],
        "doc_id long, toxic int, quality int",
    )
    return docs, labels


def test_held_out(spark, corpus):
    docs, labels = corpus
    out = X.toxicity(docs, labels, fold("doc_id", 3) != 1).collect()
    assert len(out) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)
    scores = {}
    for r in out:
        scores.setdefault(r.text, set()).add(r.score)
    assert all(len(s) == 1 for s in scores.values())
    right = [r.predicted == int(r.doc_id % 6 == 0) for r in out if r.doc_id is not None and r.doc_id < 900]
    assert np.mean(right) > 0.98
    by_id = {r.doc_id: r for r in out}
    assert not any(by_id[i].predicted for i in (3000, 3001, 3002, 3003, 3004)) and by_id[2005].predicted


def test_without_labels(spark, corpus):
    docs, labels = corpus
    out = {r.doc_id: r for r in X.toxicity(docs, labels.limit(0)).collect()}
    assert len({r.score for r in out.values()}) > 1 and out[3005].score > max(out[3000].score, out[1].score)
    assert X.toxicity(docs.limit(0), labels).count() == 0
    only = X.toxicity(docs, labels.where("toxic = 1")).collect()
    assert all(0 <= r.score <= 1 for r in only)


def test_lists_and_votes():
    lexicon = X.Lexicon([(0, "zorping"), (4, "zorp"), (3, "zor")])
    code, terms, hits, measures = lexicon.read("Zorping zorper, you IDIOT 1d1ot!")
    assert hits == [1, 1, 1, 2, 2, 0, 0, 0]
    assert dict(terms) == {0: 1, 1: 2, 2: 2}
    # both fixed lists, exclamations; whole words hit, three and four letters dense
    assert [i for i in range(X.VOTERS) if code >> i & 1] == [0, 1, 3, 4, 6, 7, 8, 9]
    assert lexicon.read(None)[0] == 0 and lexicon.read("")[2] == [0] * X.LISTS
    text = "a zorping day, zorper! "
    assert lexicon.read(text)[:3] == X.Lexicon(lexicon.terms).read(text)[:3]


def test_sketch_of_copies():
    r = random.Random(2)
    text = clean(r, 300)
    assert X.sketch(text) == X.sketch(text.upper() + "  ") != X.sketch(rude(r))
    assert X.sketch(None) == X.sketch("")


@pytest.fixture
def few_voters(monkeypatch):
    monkeypatch.setattr(X, "VOTERS", 5)


def sampled(n, seed=4):
    """Votes of five voters, the third a near copy of the second, and their labels."""
    r = np.random.default_rng(seed)
    y = r.random(n) < 0.2
    fire = lambda hit, false: np.where(y, r.random(n) < hit, r.random(n) < false)
    v = [fire(0.8, 0.05), fire(0.7, 0.2), None, fire(0.6, 0.1), fire(0.3, 0.3)]
    v[2] = np.where(r.random(n) < 0.95, v[1], ~v[1])
    return sum(x.astype(int) << i for i, x in enumerate(v)), y.astype(int)


def test_label_model(few_voters):
    codes, y = sampled(60_000)
    labels = np.where(np.arange(len(y)) < 6000, y, -1)
    model = X.LabelModel(codes, np.ones(len(codes)), labels)
    # The copy leans on its original or the other way round, and counts once.
    assert model.parent[2] == 1 or model.parent[1] == 2
    assert abs(model.share - 0.2) < 0.03
    post = model.posterior(np.arange(32))
    for code in range(32):
        same = codes == code
        if same.sum() > 400:
            assert abs(post[code] - y[same].mean()) < 0.08
    # All patterns' probabilities add up to one under either label.
    for label in (0, 1):
        total = 0.0
        for v in itertools.product((0, 1), repeat=5):
            p = 1.0
            for j, q in enumerate(model.parent):
                p *= model.table[label, v[j], v[q] if q >= 0 else 0, j]
            total += p
        assert abs(total - 1) < 1e-9


def test_label_model_without_labels(few_voters):
    codes, y = sampled(30_000)
    kinds, n = np.unique(codes, return_counts=True)
    post = X.LabelModel(kinds, n, np.full(len(kinds), -1)).posterior(codes)
    assert post[y == 1].mean() > post[y == 0].mean() + 0.3


def test_query_on_given_labels(spark):
    folder = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in QUERIES["op11_toxicity"].build(spark, folder).collect()}
    assert len(rows) == table(spark, folder, "documents").count()
    held = [(rows[r.doc_id].score, r.toxic) for r in table(spark, folder, "labels").collect() if rows[r.doc_id].held_out]
    high, low = [s for s, t in held if t], [s for s, t in held if not t]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in high for b in low])
    assert auc > 0.97
    assert np.mean([(s >= 0.7) == bool(t) for s, t in held]) > 0.98
