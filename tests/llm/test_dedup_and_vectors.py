"""Near-dedup, suffix dedup, top-k, neighbours, components and the pipeline against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from palisade.llm import ann, minhash, suffixes, topk
from palisade.llm.components import components
from palisade.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def noise(r, n):
    return " ".join("".join(r.choice("abcdé") for _ in range(r.randrange(1, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    r = random.Random(5)
    base = [noise(r, 40) for _ in range(4)]
    rows = []
    for i in range(90):
        words = r.choice(base).split()
        for _ in range(r.randrange(0, 6)):
            words[r.randrange(len(words))] = noise(r, 1)
        rows.append((i, " ".join(words) if i % 3 else noise(r, r.randrange(0, 12)) + r.choice(base)[r.randrange(60) :]))
    return rows + [(200, None), (201, ""), (202, "a" * 150), (203, "a b c"), (204, "A b\tc"), (205, "a b"), (206, rows[1][1]), (207, rows[1][1]), (None, rows[2][1])]


def near_brute(rows, width):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set()))
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b) and group[i] != group[j]:
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    low = {}
    for (k, _), g in zip(rows, group):
        if k is not None:
            low[g] = min(low.get(g, k), k)
    return {(k, len(s), low.get(g)) for (k, _), s, g in zip(rows, sets, group)}


@pytest.mark.parametrize("block", [512, 6])
def test_near_duplicates(spark, texts, block):
    df = spark.createDataFrame([(*r, "x", 1) for r in texts], "doc_id long, text string, component_id string, row int")
    got = minhash.near_duplicates(df, width=4, block=block).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == near_brute(texts, 4)
    kept = Counter(r.component_id for r in got if r.kept)
    assert set(kept.values()) == {1} and set(kept) == {r.component_id for r in got}
    assert {r.row for r in got} == {1}


def test_near_duplicates_repeated_ids_and_empty(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "x y z"), (None, None)], "doc_id long, text string")
    got = sorted((r.component_id or 0, r.kept) for r in minhash.near_duplicates(df).collect())
    assert got == [(0, True), (1, False), (1, True), (2, True)]
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_components(spark):
    r = random.Random(9)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(r.randrange(200, 260), r.randrange(200, 260)) for _ in range(30)]
    group = {n: n for pair in links for n in pair}
    for _ in group:
        for a, b in links:
            group[a] = group[b] = min(group[a], group[b])
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got.get(n, n) == g for n, g in group.items())
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def repeat_brute(rows, n):
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(d[i : i + n] for d in data for i in range(len(d) - n + 1))
    out = defaultdict(list)
    for (k, _), d in zip(rows, data):
        gone = bytearray(len(d))
        for i in range(len(d) - n + 1):
            if seen[d[i : i + n]] > 1:
                gone[i : i + n] = b"\1" * n
        kept = bytes(c for c, g in zip(d, gone) if not g)
        spans = sum(g and (not i or not gone[i - 1]) for i, g in enumerate(gone))
        out[k].append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return {k: sorted(v) for k, v in out.items()}


@pytest.mark.parametrize("n, block, entries", [(40, 4096, 500_000), (60, 3, 1000)])
def test_suffix_dedup(spark, texts, monkeypatch, n, block, entries):
    monkeypatch.setattr(suffixes.repeated_spans, "__defaults__", ("bytes", None, None, block, entries))
    rows = texts + [(3, texts[3][1])]  # an id that repeats
    got = defaultdict(list)
    for r in suffixes.dedup_digest(spark.createDataFrame(rows, "doc_id long, text string"), n).collect():
        got[r.doc_id].append(tuple(r)[1:])
    assert {k: sorted(v) for k, v in got.items()} == repeat_brute(rows, n)


def test_grams_of_order_zero_are_anchors(monkeypatch):
    monkeypatch.setattr(suffixes, "mix", lambda x: x & np.uint64(0xFFFFFFFF))
    data = [np.frombuffer(bytes(range(50, 130)), np.uint8)] * 2
    owner, place, _, _ = suffixes.anchors(suffixes.Units("bytes", 40, 8), data)
    # Every string of 40 bytes holds an anchor whose gram lies in it.
    for text in range(2):
        found = set(place[owner == text].tolist())
        assert all(found & set(range(i, i + 33)) for i in range(41))


def test_strings_are_filed_once():
    units, r = suffixes.Units("words", 10, 2), random.Random(3)
    data = [np.array([r.randrange(4) for _ in range(r.randrange(40))], np.uint64) for _ in range(30)]
    owner, place, _, (_, before, after) = suffixes.anchors(units, data)
    starts = [(o, s) for o, p, b, a in zip(owner, place, before, after) for s in range(p - b, p + a - 9)]
    assert sorted(starts) == [(i, s) for i, t in enumerate(data) for s in range(len(t) - 9)]


def test_a_text_that_repeats_itself_brings_a_context_once(spark, texts):
    df = spark.createDataFrame([(i, "spam " * 300 + f"end{i}") for i in range(3)], "row long, text string")
    listed = suffixes._anchor_table(df, suffixes.Units("words", 10, 2)).collect()
    # All but the last string are the same ten words; the spans of those are known from the text.
    assert [(list(x.times), x.begin, x.end) for x in listed] == [([2, 1], [0], [300])] * 3
    got = {r._row: (r.begin, r.end) for r in suffixes.repeated_spans(df.toDF("_row", "text"), "words", 10, 2).collect()}
    assert got == {i: ([0], [300]) for i in range(3)}


def test_drop_repeats(spark):
    passage = " ".join(f"p{i}é" for i in range(12))
    rows = [(1, f"Start one {passage} end one", "b"), (2, f"begin\ttwo {passage.upper()}\nlast", "b"), (3, "alone", "b"), (4, None, "b"), (5, "", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, begin string")
    got = {r.doc_id: r for r in suffixes.drop_repeats(df, "words", 10).collect()}
    plain = spark.createDataFrame([(r[0], (r[1] or "").replace("É", "é") if r[1] else r[1], r[2]) for r in rows], df.schema)
    same = {r.doc_id: r.text for r in suffixes.drop_repeats(plain, "words", 10).collect()}
    assert same == {1: "Start one  end one", 2: "begin\ttwo \nlast", 3: "alone", 4: None, 5: ""}
    assert got[1].begin == "b" and got[3].text == "alone"
    assert suffixes.drop_repeats(df.limit(0), "words", 10).count() == 0
    # Byte spans that cut a character are widened to whole ones.
    cut = spark.createDataFrame([(1, "xé" + "q" * 30 + "é1"), (2, "yé" + "q" * 30 + "è2")], "doc_id long, text string")
    assert {r.text for r in suffixes.drop_repeats(cut, "bytes", 20).collect()} == {"x1", "y2"}


def vectors(spark, extra=()):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(rng.standard_normal((400, 8)))]
    same = [(i, rows[7][1], 0) for i in range(400, 460)]
    odd = [(460, None, 0), (461, [1.0, None], 0), (462, [float("nan")] * 8, 0), (463, [float("inf")] * 8, 0), (450, rows[7][1], 0), (None, rows[3][1], 0),
           (500, [0.0] * 8, 0), (501, [1.0, 2.0], 0), (550, [2.0, 1.0], 0), (551, [], 0)]
    return spark.createDataFrame([*rows, *same, *odd, *extra], "vec_id long, embedding array<double>, rank int")


def test_exact_topk(spark):
    for df in (vectors(spark), vectors(spark, [(600, [2.0**40] * 8, 0), (601, [-(2.0**41)] * 8, 0), (602, [2.0**41 + 1] * 8, 0)])):
        good = [r for r in df.collect() if r.vec_id is not None and r.embedding is not None and all(x is not None and np.isfinite(x) for x in r.embedding)]
        whole = lambda r: [int(np.floor(256 * x)) for x in r.embedding]
        want = set()
        for q in {r.vec_id: r for r in good if r.vec_id % 50 == 0}.values():
            scores = sorted(
                (-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(whole(q), whole(v))))), v.vec_id) for v in good if v.vec_id != q.vec_id and len(v.embedding) == len(q.embedding)
            )[:5]
            want |= {(q.vec_id, n, i, -s) for n, (s, i) in enumerate(scores, 1)}
        got = topk.exact_topk(df, df.where("vec_id % 50 = 0")).collect()
        assert {tuple(r) for r in got} == want and len(got) == len(want)
    few = topk.exact_topk(df, df.where("vec_id % 50 = 0"), cells=50)
    assert {tuple(r) for r in few.collect()} == want
    assert topk.exact_topk(df.limit(0), df.limit(0)).count() == 0


def test_neighbours_exact_when_all_lists_are_probed(spark, monkeypatch):
    monkeypatch.setattr(ann, "GROUP", 40)
    monkeypatch.setattr(ann, "EPSILON", 50.0)
    df = vectors(spark)
    good = {r.vec_id: r.embedding for r in df.collect() if r.vec_id is not None and r.embedding and all(x is not None and np.isfinite(x) for x in r.embedding) and any(r.embedding)}
    want = {}
    for q in good:
        if q % 50 == 0:
            a = np.array(good[q])
            scores = [(-(a @ np.array(v)) / np.linalg.norm(a) / np.linalg.norm(v), i) for i, v in good.items() if i != q and len(v) == len(a)]
            for n, (s, i) in enumerate(sorted((round(s, 12), i) for s, i in scores)[:5], 1):
                want[q, n] = i, -s
    got = {(r.query_id, r.rank): r for r in ann.nearest(df, df.where("vec_id % 50 = 0"), probe_share=1.0).collect()}
    assert set(got) == set(want)
    for key, (i, s) in want.items():
        assert got[key].vec_id == i and abs(got[key].score - s) < 1e-9
    assert ann.nearest(df.limit(0), df.limit(0)).count() == 0


def test_neighbours_recall(spark):
    df = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in df.collect()]
    got = defaultdict(set)
    for r in QUERIES["op3_ann"].build(spark, FOLDER).collect():
        got[r.query_id].add(r.vec_id)
    hits = total = 0
    for q, a in rows:
        if q % 50 == 0:
            near = sorted((-(a @ b) / np.linalg.norm(a) / np.linalg.norm(b), i) for i, b in rows if i != q)[:5]
            hits, total = hits + len(got[q] & {i for _, i in near}), total + len(near)
    assert hits / total >= 0.9


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (10**9, "", "en", "s", 0)], docs.schema)
    docs, out = docs.unionByName(odd), []
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, docs, FOLDER)
        out.append((name, docs, kept))
        docs = kept
    return out


def test_language_stage_decides(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    long = {r.lang: r.text for r in docs.where("length(text) > 600").orderBy("text").collect()}
    r = random.Random(13)
    letters = "abcdefghijklmnopqrstuvwxyz"
    gone = {
        "cyrillic": "привет мир это русский текст " * 4,
        "han": "这是一个中文句子",
        "random": " ".join("".join(r.choice(letters) for _ in range(r.randrange(3, 10))) for _ in range(60)),
        "two languages": long["en"][:300] + " " + long["fr"][:300],
        "three languages": long["en"][:200] + " " + long["fr"][:200] + " " + long["de"][:200],
        "half foreign": long["en"][:300] + " привет мир" * 30,
        "no letter": "12 34 !?",
    }
    stay = {lang: text[:500] for lang, text in long.items()}
    stay |= {f"short {lang}": " ".join(text.split()[5:9]) for lang, text in long.items()}
    stay["a foreign word"] = long["en"][:300] + " привет"
    rows = [(10**9 + i, text, None, name, 0) for i, (name, text) in enumerate({**gone, **stay}.items())]
    both = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    kept = corpus_pipeline.language(spark, both, FOLDER)
    assert {x.source for x in kept.where(f"doc_id >= {10**9}").collect()} == set(stay)
    # What is lost of the documents is little.
    assert kept.where(f"doc_id < {10**9}").count() >= 0.98 * docs.where("text rlike '[a-zA-Z]'").count()


def test_pipeline_stages(spark, stages):
    assert [name for name, _, _ in stages] == ["quality classifier", "language ID", "near-dedup", "suffix dedup", "packing"]
    for _, before, after in stages[:-1]:
        assert after.columns == corpus_pipeline.COLUMNS and after.count() <= before.count()
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    _, before, after = stages[0]
    lost = before.join(after, "doc_id", "left_anti").join(labels, "doc_id").agg(F.avg("quality")).first()[0]
    assert lost is None or lost < 0.2
    _, before, after = stages[2]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    assert {r.doc_id for r in after.collect()} == {c for _, _, c in near_brute(rows, 5)}
    _, before, after = stages[3]
    seen = Counter()
    for r in before.collect():
        w = (r.text or "").encode().lower().split()
        seen.update(tuple(w[i : i + 50]) for i in range(len(w) - 49))
    for r, old in zip(after.orderBy("doc_id").collect(), before.orderBy("doc_id").collect()):
        w = (old.text or "").encode().lower().split()
        gone = {j for i in range(len(w) - 49) if seen[tuple(w[i : i + 50])] > 1 for j in range(i, i + 50)}
        assert (r.text or "").encode().lower().split() == [x for i, x in enumerate(w) if i not in gone]
        assert r.text is None or r.n_chars == len(r.text)


def test_a_users_columns_named_like_helpers_stay(spark):
    """Columns that the operators would use by themselves come back as they went in."""
    from palisade.llm.langid import language_id

    r = random.Random(21)
    passage = noise(r, 60)
    rows = [(i, f"{noise(r, 8)} {passage if i % 2 else noise(r, 60)}", "en", f"u{i}", f"b{i}", f"e{i}", f"l{i}") for i in range(12)]
    names = "doc_id long, text string, lang string, _row string, _begin string, _end string, _lang string"
    df = spark.createDataFrame(rows, names)
    kept = lambda out: {(x["doc_id"], x["_row"], x["_begin"], x["_end"], x["_lang"]) for x in out.collect()}
    want = {(i, row, begin, end, lang) for i, _, _, row, begin, end, lang in rows}
    for out in (suffixes.drop_repeats(df), minhash.near_duplicates(df), language_id(df)):
        assert kept(out) == want
    assert all(passage not in x.text for x in suffixes.drop_repeats(df).collect())


def test_kept_is_the_first_id_of_a_component(spark, monkeypatch):
    """In the query a repeated id is kept wherever it is the component's, and only there."""
    rows = [(1, "a b c d e"), (1, "a b c d e"), (2, "A B C D E"), (3, "other words of its own"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr("palisade.llm.queries.table", lambda *_: df)
    out = Counter((r.doc_id, r.component_id, r.kept) for r in QUERIES["op4_minhash_dedup"].build(spark, "").collect())
    assert out == {(1, 1, True): 2, (2, 1, False): 1, (3, 3, True): 1, (None, None, True): 1}
