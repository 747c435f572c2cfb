"""What the training-data operators share: tables, scratch tables, words and word caches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palisade.session import scratch_path

# Entries an in-task cache may hold before it starts anew.
CACHE_ENTRIES = 400_000
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared scratch folder and read it back: cuts the lineage, survives a
    lost executor, and lets Spark drop the shuffle files behind it once it is written."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEAN_UP, None)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEAN_UP)
        else:
            spark.conf.set(_CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """`name`, with as many `_` before it as it takes to clash with no column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def fold(doc_id: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; -1 for a null id."""
    id_text = (F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string")
    return F.coalesce(F.pmod(F.crc32(id_text), F.lit(n)), F.lit(-1)).cast("int")


def hashed_share(rows: DataFrame, wanted: int, total: int) -> DataFrame:
    """About `wanted` of `total` rows (doc_id, text), chosen by a hash of both, so that a hot id or a
    hot text brings no more than its share; equal rows count once."""
    share = max(1, min(1_000_000, round(1e6 * wanted / max(1, total))))
    mixed = F.pmod(F.xxhash64("doc_id", "text", F.lit(17)), F.lit(1_000_000))
    return rows.where(mixed < share).dropDuplicates(["doc_id", "text"])


def lowered_words(text: str | None) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` of the text, A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_SYMBOL = np.random.default_rng(29).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE, _powers = 0x9E3779B97F4A7C15, {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first n powers of an odd base modulo 2**64, or of its inverse; kept by the worker."""
    if len(_powers.get(inverse, ())) < n:
        base = pow(_BASE, -1, 2**64) if inverse else _BASE
        out = np.full(max(n, 1 << 16), base, np.uint64)
        out[0] = 1
        _powers[inverse] = np.cumprod(out, dtype=np.uint64)
    return _powers[inverse][:n]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the texts in order, A-Z lower-cased, and how many words
    each text has.  No word is looked at by itself: hashes are differences of prefix sums."""
    raw = np.frombuffer(b"\n".join([*texts, b""]).lower(), np.uint8)
    white = _WHITE[raw]
    begin = np.flatnonzero(~white & np.r_[True, white[:-1]])
    end = np.flatnonzero(white & np.r_[False, ~white[:-1]])
    prefix = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_SYMBOL[raw] * powers(len(raw)), out=prefix[1:])
    hashes = (prefix[end] - prefix[begin]) * powers(len(raw), True)[begin]
    hashes = mix(hashes + (end - begin).astype(np.uint64))
    edges = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return hashes, np.diff(np.searchsorted(begin, edges))


class Emitter:
    """Gathers output rows column by column and hands them out as bounded Arrow batches."""

    def __init__(self, schema: pa.Schema, rows: int = 5000):
        self.schema, self.rows = schema, rows
        self.columns: list[list] = [[] for _ in schema]

    def add(self, *values) -> pa.RecordBatch | None:
        for column, value in zip(self.columns, values):
            column.append(value)
        return self.flush() if len(self.columns[0]) >= self.rows else None

    def flush(self) -> pa.RecordBatch:
        arrays = [pa.array(c, type=f.type) for c, f in zip(self.columns, self.schema)]
        self.columns = [[] for _ in self.schema]
        return pa.RecordBatch.from_arrays(arrays, schema=self.schema)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))
