"""The Merkle manifest against a plain tree, and against its SQL."""

import random
from hashlib import sha256

import pytest
from check_oracle import compare, oracle
from pyspark.sql import functions as F

from palisade.llm import merkle
from palisade.llm.queries import QUERIES

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    texts = [None if row[c] is None else str(row[c]) for c in FIELDS]
    return h(*["-" if t is None else f"{len(t.encode())}:{t}" for t in texts])


def tree(hashes, fanout):
    """(root, one proof a leaf: the other children of each run, as (before, after))."""
    proofs, at, level = [[] for _ in hashes], list(range(len(hashes))), list(hashes)
    while len(level) > 1:
        runs = [level[i : i + fanout] for i in range(0, len(level), fanout)]
        for proof, p in zip(proofs, at):
            run, i = runs[p // fanout], p % fanout
            proof.append(("".join(run[:i]), "".join(run[i + 1 :])))
        at, level = [p // fanout for p in at], [h(*run) for run in runs]
    return level[0], proofs


def plain(rows, fanout=2):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    found, subroots = [], []
    for g in names:
        ordered = sorted(groups[g], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        root, proofs = tree([leaf(r) for r in ordered], fanout)
        subroots.append(root)
        found.append((ordered, proofs))
    top, above = tree(subroots, fanout)
    return sorted(
        repr((r["doc_id"], leaf(r), sub, top, p + up))
        for (ordered, proofs), sub, up in zip(found, subroots, above)
        for r, p in zip(ordered, proofs)
    )


def table(spark, rows):
    types = "doc_id long, source string, lang string, n_chars long, text string, leaf string, pos string"
    return spark.createDataFrame([tuple(r[c] for c in FIELDS) + ("clash", "clash") for r in rows], types)


def random_rows(n, langs, seed):
    r = random.Random(seed)
    return [
        {
            "doc_id": r.choice([None, r.randrange(n)]) if r.random() < 0.1 else r.randrange(10 * n),
            "source": r.choice([None, "a", "ü"]),
            "lang": r.choice(langs),
            "n_chars": r.choice([None, r.randrange(99)]),
            "text": r.choice([None, "", "x" * r.randrange(300), "日本\n"]),
        }
        for _ in range(n)
    ]


@pytest.mark.parametrize("n, fanout, block", [(1, 2, 4), (40, 2, 4), (75, 3, 9), (90, 2, 256), (33, 4, 4)])
def test_tree(spark, monkeypatch, n, fanout, block):
    monkeypatch.setattr(merkle, "BLOCK", block)
    rows = random_rows(n, [None, "", "en", "En", "é", "zz"] if n % 2 else ["en"] * 5 + [None, "de"], n)
    rows += rows[:3]
    out = merkle.merkle_manifest(table(spark, rows), FIELDS, fanout=fanout)
    again = out.withColumn("again", merkle.folded(F.col("leaf"), F.col("path"))).collect()
    assert all(r.again == r.root for r in again)
    assert sorted(repr((r.doc_id, r.leaf, r.subroot, r.root, [tuple(p) for p in r.path])) for r in again) == plain(rows, fanout)


def test_no_rows_and_long_text(spark):
    assert merkle.merkle_manifest(table(spark, []), FIELDS).count() == 0
    row = {"doc_id": 7, "source": None, "lang": None, "n_chars": None, "text": "wörd " * 400_000}
    found = merkle.merkle_manifest(table(spark, [row]), FIELDS).first()
    assert found.leaf == found.subroot == found.root == leaf(row) and found.path == []
    with pytest.raises(ValueError):
        merkle.merkle_manifest(table(spark, [row]), FIELDS, carried={"Root": F.lit(1)})


def test_rows_spread_whatever_the_group(spark):
    """One language and one id hold nearly all rows, yet each range holds its share."""
    df = spark.range(0, 4000, 1, 8).select(
        F.when(F.col("id") % 100 == 0, F.col("id")).otherwise(F.lit(5)).alias("doc_id"),
        F.lit("a").alias("source"), F.lit("en").alias("lang"), F.col("id").alias("n_chars"), F.lit("t").alias("text"),
    )
    out = merkle.merkle_manifest(df, FIELDS).select("doc_id", "leaf", "root", "path").collect()
    assert len(out) == 4000 and len({r.root for r in out}) == 1 and {len(r.path) for r in out} == {12}


def test_query_agrees_with_its_sql(spark):
    text, good = compare(spark, oracle("/root/testdata/sf0.001"), "/root/testdata/sf0.001", "op13", QUERIES["op13_merkle_manifest"])
    assert good, text
