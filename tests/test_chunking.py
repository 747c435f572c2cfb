import random

import pytest
from pyspark.sql import functions as F

from palisade.functions.text import cut_with_dots, sanitize, strip
from palisade.operators import chunking as K


def plain_chunks(pages, size, overlap):
    cuts = [(p, at, t[at : at + size].strip()) for p, t in pages for at in range(0, len(t), size - overlap)]
    return [(n, *cut) for n, cut in enumerate(cut for cut in cuts if cut[2])]


def ours(spark, pages, size=500, overlap=100):
    df = spark.createDataFrame([("d", p, t) for p, t in pages], "doc_id string, page_num int, text string")
    rows = K.chunk_pages(df, size, overlap).orderBy("chunk_no").collect()
    assert [r["chunk_id"] for r in rows] == [f"chunk_{r['chunk_no']:04d}" for r in rows]
    return [(r["chunk_no"], r["page_num"], r["start"], r["text"]) for r in rows]


@pytest.mark.parametrize("size,overlap", [(500, 100), (10, 3), (4, 0), (5, 4)])
def test_against_plain_python(spark, size, overlap):
    rng = random.Random(size)
    word = lambda: "".join(rng.choice("aé𝄞 \n\t \xa0") for _ in range(rng.randint(0, 4 * size)))
    pages = [(i, rng.choice([word(), word() + " " * size * 3 + "x", "  " + word()])) for i in range(1, 60)]
    assert ours(spark, pages, size, overlap) == plain_chunks(pages, size, overlap)


def test_450_characters_give_two_chunks(spark):
    assert [c[2] for c in ours(spark, [(1, "x" * 450)])] == [0, 400]


def test_many_pages_are_numbered_across_ranges(spark):
    pages = [(p, "ab cd") for p in range(1, 10_000, 3)]
    assert ours(spark, pages, 4, 1) == plain_chunks(pages, 4, 1)


def test_overlap_must_be_less_than_the_size():
    with pytest.raises(ValueError):
        K.cut_page(None, 100, 100)


def test_pages_stats_and_example(spark):
    df = spark.createDataFrame([(1, "first\n \nthird"), (2, "\n".join("p%d" % i for i in range(30))), (3, "")], "doc_id long, text string")
    pages = K.split_pages(df)
    assert [r["page_num"] for r in pages.where("doc_id = 1").collect()] == [1, 3]
    stats = {r["doc_id"]: (r["pages_found"], r["pages_with_text"], r["chunks"]) for r in K.chunk_stats(df).collect()}
    assert stats == {1: (3, 2, 2), 2: (30, 30, 30), 3: (1, 0, 0)}
    example = {r["doc_id"]: r["text"] for r in K.example_chunk(K.chunk_pages(pages)).collect()}
    assert example == {1: "third", 2: "p10"}


def test_quality(spark):
    df = spark.createDataFrame(
        [(1, 0, "plain words of a sentence"), (1, 1, "x" * 60), (1, 2, "12 34 56 78 90")], "doc_id int, chunk_no int, text string"
    )
    rows = K.chunk_quality(df).orderBy("chunk_no").collect()
    assert [r["suspect"] for r in rows] == [False, True, True]
    assert rows[1]["longest_token"] == 60 and rows[2]["digit_ratio"] == round(10 / 14, 4)


def test_text_functions(spark):
    samples = [" \t a b\x1c\x85 ", "┌──┐**bold** 　", "", "x" * 71, "y" * 70]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    rows = df.select(strip(F.col("s")).alias("a"), sanitize(F.col("s")).alias("b"), cut_with_dots(F.col("s")).alias("c")).collect()
    assert [r["a"] for r in rows] == [s.strip() for s in samples]
    assert rows[1]["b"] == "bold"
    assert rows[3]["c"] == "x" * 70 + "..." and rows[4]["c"] == "y" * 70
