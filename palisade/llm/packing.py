"""Best-fit packing planned on the histogram of lengths.

Documents become id sequences; only those over the capacity are cut.  Best-fit decreasing is
worked out on counts per length (at most `capacity` of them), which yields ranges "the
documents of this length with ranks a..b take this offset in sequences c..d"; each document
then finds its slot by its rank within its length.  Ranks are counted in blocks of a hash of the id and
carried by prefix sums, so no length, however common, meets in one task.
"""

from __future__ import annotations

import json
import zlib
from array import array
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palisade.llm.bpe import printable_bytes, read_vocabulary
from palisade.llm.common import CACHE_ENTRIES, Emitter, materialize

CAPACITY = 2048
# Rows of one block of ranks.
BLOCK_ROWS = 20_000
END = b"\0\0\0\0"

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
)


class WordIds(dict):
    """word between ASCII white space -> its ids, as little-endian unsigned 32-bit bytes.

    Nothing the tokenizer does reaches across white space, so words are encoded once each.
    Words of ASCII and precomposed Latin letters are split and lower-cased here and their
    parts, the misses of a text together, merged by a rank encoder whose vocabulary writes
    the end of a word as one byte; all others go through the tokenizers library whole.
    """

    # Fixed value: the tokenizer's split pattern.
    parts = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
    # Printable ASCII and U+00C0..U+017E but for the two letters that case mapping or
    # normalisation treats specially.
    plain = regex.compile(r"[\x21-\x7eÀ-įı-ňŊ-ž]+")

    def __init__(self, raw: bytes):
        super().__init__()
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(raw.decode())
        spec = json.loads(raw)
        alphabet, vocab = printable_bytes(), spec["model"]["vocab"]
        suffix = spec["model"]["end_of_word_suffix"]
        self.marks = [a["content"] for a in spec["added_tokens"]]
        self.hints = {m[0] for m in self.marks}
        ranks, self.last = {}, np.zeros(max(vocab.values()) + 1, bool)
        for token, i in vocab.items():
            final = token.endswith(suffix)
            b = bytes(alphabet[c] for c in (token[: -len(suffix)] if final else token))
            # Byte 1 is not in any plain word; its own token is out of the way at the end.
            ranks[b + b"\x01" if final else b] = i
            self.last[i] = final
        self.merger = tiktoken.Encoding(
            "word ends", pat_str="[^\x01]+\x01", mergeable_ranks=ranks, special_tokens={}
        )
        self.known: dict[str, bytes] = {}

    def learn(self, words: set[bytes]) -> None:
        """Encode the words a text has for the first time."""
        if len(self) + len(words) > CACHE_ENTRIES:
            self.clear()
        if len(self.known) > CACHE_ENTRIES:
            self.known.clear()
        split: list[tuple[bytes, list[str]]] = []
        fresh: dict[str, None] = {}
        for word in words:
            text = word.decode("utf-8", "surrogatepass")
            if self.plain.fullmatch(text) and not any(m in text for m in self.marks):
                parts = self.parts.findall(text.lower())
                split.append((word, parts))
                fresh.update((p, None) for p in parts if p not in self.known)
            else:
                ids = self.library.encode(text, add_special_tokens=False).ids
                self[word] = array("I", ids).tobytes()
        if fresh:
            ids = np.array(self.merger.encode_ordinary("\x01".join(fresh) + "\x01"), np.uint32)
            ends = np.flatnonzero(self.last[ids]) + 1
            data, begin = ids.astype("<u4").tobytes(), 0
            for part, end in zip(fresh, ends.tolist()):
                self.known[part] = data[4 * begin : 4 * end]
                begin = end
        for word, parts in split:
            self[word] = b"".join([self.known[p] for p in parts])

    def ids(self, text: str) -> bytes:
        """The ids of a whole text, as little-endian unsigned 32-bit bytes."""
        words = text.encode("utf-8", "surrogatepass").split()
        found = list(map(self.get, words))
        if None in found:
            self.learn({w for w, f in zip(words, found) if f is None})
            found = [self[w] if f is None else f for w, f in zip(words, found)]
        return b"".join(found)


_held: dict[bytes, WordIds] = {}


def word_ids(raw: bytes) -> WordIds:
    key = raw[:64] + zlib.crc32(raw).to_bytes(4, "little")
    if key not in _held:
        _held.clear()
        _held[key] = WordIds(raw)
    return _held[key]


def cut_pieces(
    docs: DataFrame, vocabulary_path: str, capacity: int = CAPACITY, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document's ids with the end id 0."""
    raw = read_vocabulary(vocabulary_path)
    kind = docs.schema[doc_id].dataType
    schema = T.StructType([T.StructField("doc_id", kind), *PIECES.fields[1:]])

    def run(batches):
        words = word_ids(raw)
        for batch in batches:
            out = Emitter(
                pa.schema([("doc_id", batch.column(0).type), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]),
                rows=1 << 30,
            )
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = words.ids(value.as_py() or "") + END
                for n, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at : at + 4 * capacity]
                    out.add(key, n, at // 4, len(part) // 4, zlib.crc32(part))
            yield out.flush()

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


def plan_slots(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing on counts: rows (length, first_rank, n, first_sequence, offset).

    Sequences with equal room form runs of consecutive numbers.  A length takes the runs with
    the least sufficient room first and fills a sequence as often as it fits before the next,
    as best-fit does document by document.  A length leaves at most two runs more than it met, so
    the plan is bounded by the capacity, whatever the number of documents.
    """
    rows, runs, total = [], [], 0  # runs: sorted (room, first_sequence, n)
    for length in sorted(histogram, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} does not fit {capacity}")
        left, rank = histogram[length], 0

        def fill(room, first, n):
            """Put up to `left` documents into the n sequences of a run, each filled up
            before the next; gives back what room is left."""
            nonlocal left, rank
            each = min(room // length, left)
            full = min(n, left // each)
            for k in range(each):
                rows.append((length, rank + k * full, full, first, capacity - room + k * length))
            rank, left = rank + each * full, left - each * full
            if room - each * length:
                insort(runs, (room - each * length, first, full))
            if full < n:
                if 0 < left < each:
                    # The sequence that takes the last few.
                    for k in range(left):
                        rows.append((length, rank + k, 1, first + full, capacity - room + k * length))
                    insort(runs, (room - left * length, first + full, 1))
                    rank, left, full = rank + left, 0, full + 1
                if full < n:
                    insort(runs, (room, first + full, n - full))

        while left and (i := bisect_left(runs, (length,))) < len(runs):
            fill(*runs.pop(i))
        if left:
            need = -(-left // (capacity // length))
            first, total = total, total + need
            fill(capacity, first, need)
    return rows


def best_fit_packing(
    docs: DataFrame, vocabulary_path: str, capacity: int = CAPACITY, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece.

    A null or empty text is the end id alone.  Repeated rows and repeated or null ids are packed each;
    pieces that agree in id, number and content are alike, so any of them may take a slot.  An
    empty table packs nothing.  Other columns of `docs` are not read.
    """
    pieces = materialize(cut_pieces(docs, vocabulary_path, capacity, text, doc_id), "pieces")
    blocks = max(1, -(-pieces.count() // BLOCK_ROWS))
    keyed = pieces.withColumn("_block", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(blocks)))
    counts = keyed.groupBy("length", "_block").agg(F.count(F.lit(1)).alias("n"))
    # At most `capacity` rows reach the driver.
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("n")).collect()}
    slots = sorted(plan_slots(histogram, capacity))
    lengths, firsts, _, sequences, offsets = np.array(slots, np.int64).reshape(-1, 5).T
    # Slots in one ascending order: length, then rank.
    places = lengths.astype(object) * (1 << 48) + firsts if len(slots) else np.zeros(0, object)
    places = places.astype(np.int64)

    @F.arrow_udf("struct<sequence_id:long,offset:long>")
    def slot(length, rank):
        at = np.searchsorted(places, length.to_numpy() * (1 << 48) + rank.to_numpy(), "right") - 1
        sequence = sequences[at] + rank.to_numpy() - firsts[at]
        return pa.StructArray.from_arrays(
            [pa.array(sequence, pa.int64()), pa.array(offsets[at], pa.int64())], ["sequence_id", "offset"]
        )

    before = Window.partitionBy("length").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = counts.select(
        "length", "_block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before")
    )
    within = Window.partitionBy("length", "_block").orderBy("doc_id", "piece", "ids_crc32")
    return (
        keyed.withColumn("_rank", F.row_number().over(within) - 1)
        .join(carried, ["length", "_block"])
        .withColumn("_slot", slot("length", F.col("_rank") + F.col("_before")))
        .select("doc_id", "piece", "start", "length", "ids_crc32", "_slot.sequence_id", "_slot.offset")
    )
