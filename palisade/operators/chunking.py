"""Pages, overlapping chunks and their quality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palisade.fixed_values import CHUNK_OVERLAP, CHUNK_SIZE, EXAMPLE_CHUNK
from palisade.functions.formatting import rounded
from palisade.functions.text import strip
from palisade.operators.ordering import running_total


def split_pages(df: DataFrame, separator: str = "\n", doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, page_num, text): pages counted from 1, then blank ones dropped."""
    pieces = F.posexplode(F.split(F.col(text), separator)).alias("_pos", "_piece")
    return (
        df.select(F.col(doc).alias("doc_id"), pieces)
        .select("doc_id", (F.col("_pos") + 1).alias("page_num"), strip(F.col("_piece")).alias("text"))
        .where(F.length("text") > 0)
    )


def cut_page(text, size: int, overlap: int):
    """Array of (start, text): every step, trimmed; blank pieces are left out.

    One pass over the page: each match steps `size - overlap` characters on and looks
    ahead over a whole chunk.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and less than the chunk size")
    step = size - overlap
    spans = F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{1,{size}}})).{{1,{step}}}"), F.lit(1))
    pieces = F.transform(
        spans, lambda span, i: F.struct((i * step).alias("start"), strip(span).alias("text"))
    )
    return F.filter(pieces, lambda p: F.length(p["text"]) > 0)


def count_pieces(text, size: int, overlap: int):
    """How many pieces `cut_page` gives, without cutting most pages.

    Every piece but the last spans more than a step, so it can only be blank where a
    step's worth of spaces follow each other; the last can be where the page ends blank.
    """
    step = size - overlap
    gaps = F.rlike(text, F.lit(rf"(?U)\s{{{step}}}|[\s\x1c-\x1f]$"))
    return F.when(gaps, F.size(cut_page(text, size, overlap))).otherwise(
        F.ceil(F.length(text) / step).cast("int")
    )


def chunk_pages(
    pages: DataFrame, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP
) -> DataFrame:
    """(doc_id, chunk_no, chunk_id, page_num, start, text), numbered through a document.

    Numbers come from the piece counts of the pages before it.  Only the counts are sorted and
    summed, by ranges of pages, so one huge document still spreads over tasks; the pages are
    shuffled once, to meet their first number, and cut after that.
    """
    counted = pages.select(
        "doc_id", "page_num", "text", count_pieces(F.col("text"), size, overlap).alias("_n")
    )
    placed = running_total(counted, "doc_id", "page_num", "_n", "_first").withColumn(
        "_pieces", cut_page(F.col("text"), size, overlap)
    )
    return placed.select(
        "doc_id", "page_num", "_first", F.posexplode("_pieces").alias("_pos", "_piece")
    ).select(
        "doc_id",
        (F.col("_first") + F.col("_pos")).alias("chunk_no"),
        F.format_string("chunk_%04d", F.col("_first") + F.col("_pos")).alias("chunk_id"),
        "page_num",
        F.col("_piece.start").alias("start"),
        F.col("_piece.text").alias("text"),
    )


def chunk_stats(df: DataFrame, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP, separator: str = "\n") -> DataFrame:
    """Per document: pages found, pages with text and chunks, one row in, one row out."""
    pages = F.transform(F.split("text", separator), lambda p: strip(p))
    counted = df.select("doc_id", F.explode(pages).alias("page")).select(
        "doc_id",
        (F.length("page") > 0).cast("int").alias("filled"),
        F.when(F.length("page") > 0, count_pieces(F.col("page"), size, overlap))
        .otherwise(0)
        .alias("n"),
    )
    return counted.groupBy("doc_id").agg(
        F.count("*").alias("pages_found"),
        F.sum("filled").alias("pages_with_text"),
        F.sum("n").alias("chunks"),
    )


def example_chunk(chunks: DataFrame, index: int = EXAMPLE_CHUNK) -> DataFrame:
    """The chunk number min(index, last) of each document."""
    return (
        chunks.where(F.col("chunk_no") <= index)
        .groupBy("doc_id")
        .agg(F.max(F.struct("chunk_no", "chunk_id", "page_num", "text")).alias("c"))
        .select("doc_id", "c.*")
    )


def chunk_quality(chunks: DataFrame) -> DataFrame:
    """Signs of a garbled extraction: few spaces, overlong tokens, many digits."""
    text = F.col("text")
    length = F.length(text)
    tokens = F.split(text, r"[ \n\t]+")
    share = lambda n: rounded(n / length, 4)
    return chunks.select(
        "doc_id",
        "chunk_no",
        share(length - F.length(F.replace(text, F.lit(" "), F.lit("")))).alias("space_ratio"),
        F.array_max(F.transform(tokens, F.length)).alias("longest_token"),
        share(length - F.length(F.translate(text, "0123456789", ""))).alias("digit_ratio"),
    ).withColumn(
        "suspect",
        (F.col("space_ratio") < 0.08) | (F.col("longest_token") > 40) | (F.col("digit_ratio") > 0.3),
    )
