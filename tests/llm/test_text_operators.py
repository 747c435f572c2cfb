"""Language ID, quality, BPE, token counts, packing and LM scores on small tables."""

import hashlib
import math
import random
import tracemalloc
import types
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from palisade.llm import bpe, langid, lm, packing, quality, token_counts
from palisade.llm.common import fold
from palisade.llm.queries import vocabulary

tokenizers = pytest.importorskip("tokenizers")
ODD = [None, "", " ", "\n\n", "x", "a<|endoftext|>b", "don't  stop\t12  ", "日本語 é é İ ſ", "\x1c\x01 \x1d", "ab" * 3000]
COLUMNS = "doc_id long, text string, lang string, score string, ids string, text_ string, component_id string"


def library(name):
    return tokenizers.Tokenizer.from_file(vocabulary(name))


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en" if i % 2 else None, "s", "i", "t", "c") for i, t in enumerate(ODD)]
    return spark.createDataFrame([*rows, rows[4], (None, "no id", *rows[0][2:])], COLUMNS)


def random_texts(n=150, seed=1):
    r = random.Random(seed)
    pick = lambda: chr(r.choice([r.randrange(32, 127), r.randrange(1, 3000), 32, 32, 10]))
    return ["".join(pick() for _ in range(80)).encode("utf-8", "ignore").decode() for _ in range(n)]


def test_bpe_equals_library():
    t, s = library("byte_bpe_50k.json"), bpe.segments_of(bpe.read_vocabulary(vocabulary("byte_bpe_50k.json")))
    for text in [x or "" for x in ODD] + random_texts():
        ids = bpe.encode_ids(s, text)
        assert ids.tolist() == t.encode(text, add_special_tokens=False).ids
        assert s.vocabulary.decode(ids.astype(np.int64)).decode() == text


def test_bpe_tables(spark, odd):
    path = vocabulary("byte_bpe_50k.json")
    back = bpe.bpe_decode(bpe.bpe_encode(odd, path), path)
    assert all(r.decoded == (r.text or "") for r in back.collect())
    digest = bpe.bpe_digest(odd, path).collect()
    assert len(digest) == odd.count()
    empty = hashlib.sha256(b"").hexdigest()
    assert {(r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in digest if r.doc_id in (0, 1)} == {(0, empty, empty)}
    assert bpe.bpe_digest(odd.limit(0), path).count() == 0


def test_words_equal_library():
    t = library("word_bpe_49k.json")
    w = packing.word_ids(bpe.read_vocabulary(vocabulary("word_bpe_49k.json")))
    for text in [x or "" for x in ODD] + random_texts(seed=2):
        assert np.frombuffer(w.ids(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


def best_fit(lengths, capacity):
    rooms, used = [], 0
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        used += not fits
        if fits:
            rooms.remove(min(fits))
        rooms.append((min(fits) if fits else capacity) - n)
    return used


def test_plan_is_best_fit():
    r = random.Random(3)
    for _ in range(80):
        capacity = r.choice([7, 30, 64])
        histogram = {n: r.randrange(1, 20) for n in range(1, capacity + 1) if r.random() < 0.4}
        places = {}
        for length, rank, n, first, offset in packing.plan_slots(histogram, capacity):
            for i in range(n):
                places[length, rank + i] = first + i, offset
        assert len(places) == sum(histogram.values())
        filled = {}
        for (length, _), (sequence, offset) in places.items():
            filled.setdefault(sequence, []).append((offset, length))
        for parts in filled.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= capacity
        assert len(filled) == best_fit([n for n, c in histogram.items() for _ in range(c)], capacity)


def test_packing_table(spark, odd):
    path, t = vocabulary("word_bpe_49k.json"), library("word_bpe_49k.json")
    rows = packing.best_fit_packing(odd, path, 64).collect()
    want = Counter()
    for r in odd.collect():
        ids = t.encode(r.text or "", add_special_tokens=False).ids + [0]
        for n, at in enumerate(range(0, len(ids), 64)):
            part = ids[at : at + 64]
            want[r.doc_id, n, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter(tuple(r)[:5] for r in rows) == want
    filled = {}
    for r in rows:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in filled.values():
        assert [o for o, _ in sorted(parts)] == list(np.cumsum([0] + [n for _, n in sorted(parts)])[:-1])
    assert packing.best_fit_packing(odd.limit(0), path).count() == 0


def test_token_counts(spark):
    path = vocabulary("byte_bpe_50k.json")
    t = library("byte_bpe_50k.json")
    texts = ["one two\nthree\n\nfour é日本", "", None, "abc", "\n"]
    spans = [[("a", 0, 5), ("b", 5, None), ("c", 3, 99), ("d", 4, 4), None]] + [None, [], [("all", None, None)], [("n", 0, 1)]]
    df = spark.createDataFrame(
        [(i, x, s, "clash") for i, (x, s) in enumerate(zip(texts, spans))],
        "doc_id long, text string, parts array<struct<section string, start long, end long>>, n_tokens string",
    )
    total = {i: len(t.encode(x or "").ids) for i, x in enumerate(texts)}
    for rule in token_counts.RULES:
        lines = token_counts.token_counts(df, path, rule=rule).groupBy("doc_id").agg(F.sum("n_tokens").alias("n"))
        assert {r.doc_id: round(r.n, 6) for r in lines.collect()} == {i: n for i, n in total.items() if n}
        got = {(r.doc_id, r.section): r for r in token_counts.token_counts(df, path, "parts", rule).collect()}
        assert set(got) == {(0, "a"), (0, "b"), (0, "c"), (0, "d"), (3, "all"), (4, "n")}
        assert round(got[0, "a"].n_tokens + got[0, "b"].n_tokens, 6) == total[0]
        assert got[0, "a"].n_crossing == 1 and got[0, "d"].n_tokens == 0
    with pytest.raises(ValueError):
        token_counts.token_counts(df, path, rule="most")
    assert token_counts.token_counts(df.limit(0), path).count() == 0


def test_plain_words_need_no_split_and_counts_no_decimals():
    """Token counts hold ids alone, and letters between two spaces are one pre-token without a search."""
    t, raw = library("byte_bpe_50k.json"), bpe.read_vocabulary(vocabulary("byte_bpe_50k.json"))
    s, listed = bpe.segments_of(raw), bpe.segments_of(raw, bpe.ListedSegments)
    assert bpe.segments_of(raw, bpe.ListedSegments) is listed
    searched, pattern = [], s.vocabulary.pattern
    s.vocabulary.pattern = types.SimpleNamespace(findall=lambda x: searched.append(x) or pattern.findall(x))
    text = "Plain wordless qzxvk ROBUSTLY it's x9 é été a,b \n c"
    ids = t.encode(text, add_special_tokens=False).ids
    assert bpe.encode_ids(s, text).tolist() == ids
    assert not {" wordless", " qzxvk", " ROBUSTLY", "Plain"} & set(searched) and " it's" in searched
    assert s["qzxvk"] == np.array(t.encode(" qzxvk", add_special_tokens=False).ids, np.int32).tobytes()
    assert ",".join(x for _, x in bpe.encode_text(listed, text) if x) == ",".join(map(str, ids))


ENGLISH = "the cat and the dog were in the house with a big window and the tree".split()
FRENCH = "le chat et les chiens étaient dans la maison avec une grande fenêtre où".split()


def test_language(spark, odd):
    r = random.Random(4)
    say = lambda words, n: " ".join(r.choice(words) for _ in range(n))
    rows = [(i, say(ENGLISH if i % 2 else FRENCH, 30), "en" if i % 2 else "fr") for i in range(60)]
    rows += [(100, say(ENGLISH, 30) + " " + say(FRENCH, 10), None), (101, None, "en"), (102, "123 !?", "fr"), (103, "", None), (104, "привет мир", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("lang_pred", F.lit("x"))
    out = {x.doc_id: x for x in langid.language_id(df, F.col("doc_id") % 3 != 0).collect()}
    assert len(out) == len(rows)
    assert all(out[i].lang_pred == lang for i, _, lang in rows[:60])
    assert out[100].lang_pred == "en" and out[100].n_spans == 2 and 0.6 < out[100].lang_score < 0.9
    assert all((out[i].lang_pred, out[i].lang_score, out[i].n_spans) == ("und", 0.0, 0) for i in (101, 102, 103))
    assert out[104].lang_pred in ("en", "fr")
    unlearned = langid.language_id(df.where("doc_id < 0 or lang is null"))
    assert {x.lang_pred for x in unlearned.collect()} == {"und"}
    assert langid.language_id(df.limit(0)).count() == 0
    assert langid.language_id(odd).count() == odd.count()


def test_language_memory_goes_by_runs_of_words():
    """One Arrow batch of many words takes no more than a few short runs do, with the same rows in place."""
    r = random.Random(8)
    counts, scripts = np.zeros((3, len(langid.ORDERS) * langid.BUCKETS), np.int64), np.zeros((3, langid.OTHER + 1), np.int64)
    counts[np.arange(3), r.sample(range(counts.shape[1]), 3)] = 9
    counts += np.random.default_rng(8).integers(0, 9, counts.shape)
    scripts[:, 0] = 100
    model = langid.Model(["en", "fr", "pt"], counts, scripts)
    few = [None, "", *(" ".join(r.choice(ENGLISH + FRENCH) for _ in range(r.randrange(1, 90))) for _ in range(300))]
    found = langid.predictions(model, pa.array(few)).to_pylist()
    assert found == [langid.predictions(model, pa.array([t], pa.string())).to_pylist()[0] for t in few]
    texts = pa.array([" ".join(ENGLISH * 20)] * 3000)
    tracemalloc.start()
    assert len(langid.predictions(model, texts)) == 3000
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6


def test_viterbi_against_all_paths():
    model = langid.Model.__new__(langid.Model)
    model.langs = ["a", "b", "c"]
    rng = np.random.default_rng(5)
    sizes = np.array([4, 0, 6, 1])
    scores = rng.standard_normal((sizes.sum(), 3)).astype(np.float32) * 3
    labels, at = model.paths(scores, sizes, 2.0), 0
    for n in sizes:
        part = scores[at : at + n]
        value = lambda path: sum(part[i, p] for i, p in enumerate(path)) - 2.0 * sum(x != y for x, y in zip(path, path[1:]))  # noqa: E731, B023
        every = [tuple(np.unravel_index(i, (3,) * n)) for i in range(3**n)] if n else [()]
        assert math.isclose(value(labels[at : at + n].tolist()), max(map(value, every)), abs_tol=1e-4)
        at += n


def test_quality(spark, odd):
    r = random.Random(6)
    good = lambda: " ".join(r.choice(ENGLISH) for _ in range(40))
    bad = lambda: " ".join(r.choice(ENGLISH).upper() + "!!" for _ in range(40))
    docs = spark.createDataFrame(
        [(i, bad() if i % 4 == 0 else good(), 0.5) for i in range(200)] + [(300, None, 0.1), (301, "", 0.1), (None, good(), 0.2), (5, good(), 0.3)],
        "doc_id long, text string, score double",
    )
    labels = spark.createDataFrame(
        [(i, int(i % 4 != 0), 0) for i in range(0, 200, 3)] + [(1, 1, 0), (1, 0, 0), (None, 1, 0), (7, None, 0)],
        "doc_id long, quality int, toxic int",
    )
    out = quality.quality_classifier(docs, labels, fold("doc_id", 4) != 2).collect()
    assert len(out) == docs.count()
    assert all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.7) for x in out)
    held = [x for x in out if x.doc_id is not None and x.doc_id < 200]
    assert np.mean([x.predicted == int(x.doc_id % 4 != 0) for x in held]) > 0.95
    none = quality.quality_classifier(odd, labels.limit(0)).collect()
    assert {x.score for x in none} == {0.5}
    assert quality.quality_classifier(docs.limit(0), labels).count() == 0


def test_words_are_spelled_together_as_alone():
    raw = lm.read_vocabulary(vocabulary("byte_bpe_50k.tiktoken"))
    alone, together = lm.Spelled(raw), lm.Spelled(raw)
    r = random.Random(12)
    words = ["'s", "it's", "a-b,c", "123abc", "\x01\x1c", "<|endoftext|>", "\xa0x\x85", "日本語é", "x" * 70, "'", "qz'll"]
    words += ["".join(chr(r.randrange(33, 127)) for _ in range(r.randrange(1, 12))) for _ in range(2000)]
    words = list(dict.fromkeys(w.encode().lower() for w in words))
    calls, encode = [], together.encoder.encode_ordinary
    together.encoder = types.SimpleNamespace(encode_ordinary=lambda x: calls.append(x) or encode(x))
    got = together.several(words)
    assert [x.tolist() for x in got] == [lm.subwords(alone.encoder, w) for w in words]
    assert len(calls) < 10
    assert [x.tolist() for x in together.several(words[:50])] == [x.tolist() for x in got[:50]]


def test_words_beyond_ascii_are_spelled_together():
    raw = lm.read_vocabulary(vocabulary("byte_bpe_50k.tiktoken"))
    spelled = lm.Spelled(raw)
    r = random.Random(13)
    words = ["".join(r.choice("éèçñüßжщ日本語'1-aZ") for _ in range(r.randrange(1, 9))) for _ in range(1500)]
    words[700:700] = ["\xa0", "a\u3000", "\u2003b\u2003", "\x85\x85"]
    words = [w.encode() for w in words] + [b"\xff", b"a\xed\xa0\x80"]
    want = [lm.subwords(spelled.encoder, w) for w in words]
    calls, encode = [], spelled.encoder.encode_ordinary
    spelled.encoder = types.SimpleNamespace(encode_ordinary=lambda x: calls.append(x) or encode(x))
    assert [x.tolist() for x in spelled.several(words)] == want
    assert len(calls) < 10


def test_texts_are_read_once(spark, monkeypatch):
    monkeypatch.setattr(lm, "CACHE_ENTRIES", 30)  # what is kept of words starts anew
    monkeypatch.setattr(lm, "GROUP_WORDS", 50)
    texts = [" ".join(f"w{i * j % 97}" for j in range(i)) for i in range(60)] + [None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    raw = lm.read_vocabulary(vocabulary("byte_bpe_50k.tiktoken"))
    read = lm.read_texts(df, raw).cache()
    want = Counter(w for t in texts for w in lm.lowered_words(t))
    assert {x.word: x.n for x in lm.words_of(read, raw).select("word", "n").collect()} == want
    rows = lm.windows_of(read)
    seen = np.concatenate(lm._windows(rows.toArrow().to_batches()))
    encoder, at = lm.subword_encoder(raw), 0
    for t in texts:
        ids = [len(lm.word_starts(raw)), *(i for w in lm.lowered_words(t) for i in lm.subwords(encoder, w))]
        ids.append(ids[0])
        n = -(-(len(ids) - 1) // lm.WINDOW)
        got = np.r_[seen[at, :1], seen[at : at + n, 1:].ravel()]
        assert got[: len(ids)].tolist() == ids and (got[len(ids) :] == lm.PAD).all()
        assert (seen[at + 1 : at + n, 0] == seen[at : at + n - 1, -1]).all()
        at += n
    assert at == len(seen) > rows.count()


def test_scores_as_by_a_plain_pass():
    r = np.random.default_rng(5)
    n, classes = 11, lm.CLASSES
    subs = type("Subs", (), {"n_inputs": n, "class_of_input": r.integers(0, classes, n), "end_input": n - 1})
    p = {k: r.standard_normal(x.shape).astype(np.float32) / 2 for k, x in lm.initial(type("S", (), {"n_inputs": n, "n_classes": classes})).items()}
    table, fine = r.standard_normal((n, classes)).astype(np.float32), r.integers(0, 3, n)
    shares = r.standard_normal((3, n)).astype(np.float32)
    scorer = lm.Scorer(p, table, shares, fine, subs)
    sizes = np.array([1, 15, 16, 17, 33, 2100, 1])
    flat = r.integers(0, n, sizes.sum())
    got = scorer.score(flat, sizes)
    at = 0
    for size in sizes:
        before, own = np.r_[n - 1, flat[at : at + size - 1]], flat[at : at + size]
        x = p["embed"][before].astype(float)
        q, k, v = x @ p["query"] / math.sqrt(lm.HEAD_DIM), x @ p["key"], x @ p["value"]
        for i in range(size):
            first = max(0, i // lm.STRIDE - 1) * lm.STRIDE
            a = np.exp(q[i] @ k[first : i + 1].T + p["near"][i - np.arange(first, i + 1)])
            z = (a / a.sum()) @ v[first : i + 1] @ p["out"] + table[before[i]]
            z -= np.log(np.exp(z).sum())
            want = z[subs.class_of_input[own[i]]], np.log(np.exp(z[: lm.OPENING]).sum())
            assert np.allclose([got[0][at + i], got[2][at + i]], want, atol=1e-4)
            assert math.isclose(got[1][at + i], got[0][at + i] + shares[fine[before[i]], own[i]], rel_tol=1e-5, abs_tol=1e-5)
        at += size


def test_exp_far_out_of_range():
    x = np.array([[500, 499, -1e9], [-500, -502, -1e9], [1, 2, 3]], np.float32)
    want = np.exp(x.astype(float) - x.max(1, keepdims=True))
    lm.exp_rows(x, x[:, 0])
    assert np.allclose(x / lm.row_sum(x), want / want.sum(1, keepdims=True), atol=1e-6)


def test_unigram_base_and_model(spark, odd):
    r = random.Random(7)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(r.choice(words[: 5 + i % 50]) for _ in range(r.randrange(0, 60))) for i in range(80)]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(90, None, "x"), (91, "Zebra\x0b w1", "x")], "doc_id long, text string, n_tokens string")
    held_out = fold("doc_id", 5) == 1
    rows = {x.doc_id: x for x in lm.lm_score(df, vocabulary("byte_bpe_50k.tiktoken"), held_out, head_words=20).collect()}
    marks = {x.doc_id: x.h for x in df.select("doc_id", held_out.alias("h")).collect()}
    split = {i: [*(t or "").encode().lower().split(), None] for i, t in [*enumerate(texts), (90, None), (91, "Zebra\x0b w1")]}
    count = Counter(w for i, ws in split.items() if not marks[i] for w in ws)
    total, distinct = sum(count.values()), len(count)
    for i, ws in split.items():
        base = sum(math.log10((count[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in ws)
        x = rows[i]
        assert (x.held_out, x.n_tokens, x.n_known, x.train_tokens) == (marks[i], len(ws), sum(count[w] > 0 for w in ws), total)
        assert math.isclose(x.base_score, base, rel_tol=1e-9) and x.score < 0
    assert lm.lm_score(odd, vocabulary("byte_bpe_50k.tiktoken"), held_out).count() == odd.count()
    assert lm.lm_score(df.limit(0), vocabulary("byte_bpe_50k.tiktoken"), held_out).count() == 0


def test_score_does_not_depend_on_the_head(spark):
    r = random.Random(11)
    words = [f"name{i}" for i in range(50)]
    texts = [" ".join(r.choice(words[: 5 + i]) for _ in range(r.randrange(0, 40))) for i in range(45)] + [None, "never seen", "name1"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    few, all_ = (
        {x.doc_id: x for x in lm.lm_score(df, vocabulary("byte_bpe_50k.tiktoken"), fold("doc_id", 5) == 1, head_words=n).collect()}
        for n in (3, 1000)
    )
    assert len(few) == len(texts)
    for i, x in few.items():
        assert (x.n_tokens, x.n_known) == (all_[i].n_tokens, all_[i].n_known)
        # Runs may average parameters in another order.
        assert math.isclose(x.score, all_[i].score, rel_tol=1e-5) and math.isclose(x.base_score, all_[i].base_score, rel_tol=1e-9)


def test_transitions_of_whole_texts(spark):
    r = random.Random(10)
    words = [f"w{i}" for i in range(40)] + ["Straße", "naïve", "x" * 90]
    say = lambda n: " ".join(r.choice(words) for _ in range(n))
    texts = [None, "", "one", say(31), say(32), say(33), say(900), say(1700) + " only at the very tail", say(5000)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    raw = bpe.read_vocabulary(vocabulary("byte_bpe_50k.tiktoken"))
    ranks, encoder = lm.ranks_of(raw), lm.subword_encoder(raw)
    starts = np.zeros(1 + max(ranks.values()), bool)
    starts[[i for token, i in ranks.items() if token[:1] == b" "]] = True
    counted = lm.count_words(df, raw).cache()
    subs = lm.Subwords(lm.subword_counts(counted, len(starts)), starts)
    same = np.arange(subs.n_inputs)
    row, column, want = same % 89, same % 97, np.zeros((89, 97))
    total = 0
    for text in texts:
        ids = [i for w in lm.lowered_words(text) for i in lm.subwords(encoder, w)]
        at = subs.input_of[[subs.end, *ids, subs.end]]
        np.add.at(want, (row[at[:-1]], column[at[1:]]), 1)
        total += len(at) - 1
    windows = lm.training_windows(df, raw, subs).cache()
    assert (lm.next_counts(counted, windows, subs, row, column, want.shape) == want).all()
    # Each transition is a target of the descent once, and padding never is.
    seen = np.concatenate(lm._windows(windows.toArrow().to_batches()))
    assert (seen[:, 1:] != lm.PAD).sum() == total and (seen[:, 0] != lm.PAD).all()


def test_padding_is_not_learned_from():
    rng = np.random.default_rng(12)
    size = type("Size", (), {"n_inputs": 9, "n_classes": 5})
    p = lm.initial(size)
    p["out"] = rng.standard_normal(p["out"].shape).astype(np.float32)
    table, ids = rng.standard_normal((9, 5)).astype(np.float32), rng.integers(0, 9, (2, lm.WINDOW))
    target = rng.integers(0, 5, ids.shape)
    target[1] = -1
    loss, g = lm.forward_backward(p, table, ids, target)
    alone, h = lm.forward_backward(p, table, ids[:1], target[:1])
    assert math.isclose(loss, alone, rel_tol=1e-5)
    assert all(np.allclose(g[n], h[n], atol=1e-6) for n in g)


def test_rows_are_reduced_as_by_numpy():
    r = np.random.default_rng(2)
    for width in range(1, 36):
        x = r.standard_normal((3, 4, width)).astype(np.float32)
        assert np.array_equal(lm.row_max(x), x.max(-1, keepdims=True))
        assert np.allclose(lm.row_sum(x), x.sum(-1, keepdims=True), atol=1e-5)


def test_attention_gradients():
    rng = np.random.default_rng(8)
    p = {"embed": rng.standard_normal((9, lm.WIDTH)), "query": rng.standard_normal((lm.WIDTH, lm.HEAD_DIM)) / 4,
         "key": rng.standard_normal((lm.WIDTH, lm.HEAD_DIM)) / 4, "value": rng.standard_normal((lm.WIDTH, lm.WIDTH)) / 4,
         "out": rng.standard_normal((lm.WIDTH, 5)) / 4, "near": rng.standard_normal(lm.WINDOW)}
    table, ids = rng.standard_normal((9, 5)), rng.integers(0, 9, (2, lm.WINDOW))
    target = rng.integers(0, 5, ids.shape)
    _, g = lm.forward_backward(p, table, ids, target)
    for name in p:
        at = tuple(rng.integers(0, n) for n in p[name].shape)
        at = (int(ids[0, 0]), *at[1:]) if name == "embed" else at
        step, old = 1e-5, p[name][at]
        p[name][at] = old + step
        up = lm.forward_backward(p, table, ids, target)[0]
        p[name][at] = old - step
        down = lm.forward_backward(p, table, ids, target)[0]
        p[name][at] = old
        assert math.isclose((up - down) / (2 * step), g[name][at], rel_tol=2e-2, abs_tol=2e-6), name
