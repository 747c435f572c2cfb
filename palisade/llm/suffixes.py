"""Repeated strings of a threshold length, by hashed minimizers in place of a suffix order.

A string of `threshold` symbols (bytes or words) is repeated when it starts at two places.
Ordering every suffix would move the text hundreds of times over.  So only a few places of each text are
grouped, in three passes that leave whole buckets behind early:

1. Anchors.  Every string of threshold length is filed once, under the first gram of `gram` symbols
   in it with the smallest hash, the same wherever the string stands.  About 2 in `threshold`
   places are anchors.  What a text itself holds twice is settled there.  Buckets with one
   member end here.
2. Contexts.  Members are grouped by all that the strings filed under the anchor cover.
   Equal ones are repeated from end to end and need nothing further.
3. Strings.  Buckets with different contexts are grouped by each of the strings filed under
   the anchor; equal groups are exactly the repeated strings.  A bucket of more members than
   fit a block is worked on in blocks, and what is alone in its block is dealt out again by its
   own string over as many groups as it needs.

Grams, contexts and strings are compared as 64-bit hashes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palisade.llm.common import materialize, mix, powers, word_hashes, unused

BYTES = 400
WORDS = 50
# Members ordered together; entries ordered together in the pass over split buckets.
BLOCK = 4096
ENTRIES = 500_000
# Cut members that leave a task at a time (under 4 MB of symbols).
CUT_ROWS = 4096
# Symbols of text worked on in one step.
STEP = 400_000

_random = np.random.default_rng(20)
_SYMBOL = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
def gram_of(threshold: int) -> int:
    """Length of the first digit: long enough that chance repeats end in the first pass."""
    return max(1, threshold // 6)


class Units:
    """What a text is made of: `symbols` (bytes, or 64-bit codes of lower-cased words)."""

    def __init__(self, kind: str, threshold: int, gram: int):
        self.kind, self.threshold, self.gram = kind, threshold, gram
        self.dtype = np.dtype(np.uint8 if kind == "bytes" else np.uint64)
        self.left = threshold - gram  # symbols before an anchor that its strings can cover

    def __reduce__(self):
        return Units, (self.kind, self.threshold, self.gram)

    def symbols(self, data: bytes) -> np.ndarray:
        if self.kind == "bytes":
            return np.frombuffer(data, np.uint8)
        return word_hashes([data])[0]

    def values(self, symbols: np.ndarray) -> np.ndarray:
        return _SYMBOL[symbols] if self.kind == "bytes" else symbols

    def to_bytes(self, data: bytes, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Spans of symbols as spans of bytes, from the first byte of the first word to the
        last of the last."""
        if self.kind == "bytes" or not len(begin):
            return begin, end
        raw = np.frombuffer(data, np.uint8)
        white = (raw == 32) | ((raw >= 9) & (raw <= 13))
        edge = np.diff(np.r_[True, white, True].astype(np.int8))
        first, last = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        return first[begin], last[end - 1]


def _sliding(values: np.ndarray, width: int, op) -> np.ndarray:
    """op over values[i : i + width] for every i with a whole window, by doubling."""
    done, out = 1, values
    while done * 2 <= width:
        out = op(out[:-done], out[done:])
        done *= 2
    return op(out[: len(values) - width + 1], out[width - done : width - done + len(values) - width + 1])


def anchors(units: Units, texts: list[np.ndarray]):
    """(text, place, gram hash, context) of the anchors of several symbol arrays.

    The context is what the strings filed under the anchor cover: its hash, and how many symbols
    lie before the place and from it on.
    """
    n, g = units.threshold, units.gram
    sizes = np.array([len(t) for t in texts], np.int64)
    start = np.cumsum(sizes) - sizes
    total = int(sizes.sum())
    if total < n:
        return *(np.zeros(0, np.int64) for _ in range(3)), np.zeros((3, 0), np.int64)
    # Prefix sums of a polynomial: the hash of any stretch in two reads.
    prefix = np.zeros(total + 1, np.uint64)
    np.cumsum(units.values(np.concatenate(texts)) * powers(total), out=prefix[1:])
    back = powers(total, True)
    grams = mix((prefix[g:] - prefix[:-g]) * back[: total - g + 1])
    # Half of the hash, then the place: the least of them is the first gram of least hash.
    order = (grams >> np.uint64(32) << np.uint64(32)) | np.arange(len(grams), dtype=np.uint64)
    least = _sliding(order, units.left + 1, np.minimum)  # of the string that starts here
    at = np.arange(len(least))
    owner = np.searchsorted(start, at, "right") - 1
    inside = at + n <= start[owner] + sizes[owner]
    at, owner = at[inside], owner[inside]
    place = (least[inside] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    # The strings of an anchor start one after another.
    new = np.r_[True, (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])][: len(place)]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(place)][: len(first)] - 1
    begin, end, place, owner = at[first], at[last] + n, place[first], owner[first]
    context = (prefix[end] - prefix[begin]) * back[begin]
    context ^= ((place - begin).astype(np.uint64) << np.uint64(32)) + (end - place).astype(np.uint64)
    found = np.stack([mix(context).view(np.int64), place - begin, end - place])
    return owner, place - start[owner], grams[place].view(np.int64), found


_ANCHOR = {"place": "int", "gram": "long", "context": "long", "before": "int", "after": "int", "times": "byte"}


def _anchor_table(texts: DataFrame, units: Units) -> DataFrame:
    """A row per text with anchors, in arrays: its different contexts, each with its first place and
    whether the text holds it once or more (`times` 1 or 2), and the spans (`begin`, `end`) of those
    it holds more than once."""
    kinds = [np.int32, np.int64, np.int64, np.int32, np.int32, np.int8]

    def run(batches):
        for batch in batches:
            found, own = [], []

            def work(rows, parts):
                owner, place, gram, (context, before, after) = anchors(units, parts)
                order = np.lexsort((context, owner))
                new = np.r_[True, (owner[order][1:] != owner[order][:-1]) | (context[order][1:] != context[order][:-1])]
                group = np.cumsum(new[: len(order)]) - 1
                times = np.bincount(group)
                several = np.zeros(len(order), bool)
                several[order] = times[group] > 1
                kept = np.sort(order[new[: len(order)]])
                columns = place, gram, context, before, after, 1 + several
                ends = np.searchsorted(owner, np.arange(len(rows) + 1))
                cut = np.searchsorted(owner[kept], np.arange(len(rows) + 1))
                for i, row in enumerate(rows):
                    if cut[i] < cut[i + 1]:
                        s = kept[cut[i] : cut[i + 1]]
                        found.append((row, *(c[s].astype(k) for c, k in zip(columns, kinds))))
                        s = ends[i] + np.flatnonzero(several[ends[i] : ends[i + 1]])
                        own.append(merged(place[s] - before[s], place[s] + after[s]))

            rows, parts, size = [], [], 0
            for row, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = value.as_py()
                if not text:
                    continue
                symbols = units.symbols(text.encode("utf-8", "surrogatepass"))
                if len(symbols) >= units.threshold:
                    if parts and size + len(symbols) > STEP:
                        work(rows, parts)
                        rows, parts, size = [], [], 0
                    rows.append(row)
                    parts.append(symbols)
                    size += len(symbols)
            if parts:
                work(rows, parts)

            def lists(values, kind):
                ends = pa.array(np.cumsum([0, *map(len, values)]), pa.int32())
                return pa.ListArray.from_arrays(ends, pa.array(np.concatenate([*values, np.zeros(0, kind)]).astype(kind)))

            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([f[0] for f in found], pa.int64()),
                    *(lists([f[i] for f in found], k) for i, k in enumerate(kinds, 1)),
                    *(lists([o[i] for o in own], np.int32) for i in range(2)),
                ],
                names=["row", *_ANCHOR, "begin", "end"],
            )

    kept = ", ".join(f"{name} array<{kind}>" for name, kind in _ANCHOR.items())
    return texts.mapInArrow(run, f"row long, {kept}, begin array<int>, end array<int>")


def string_hashes(units: Units, blobs: list[bytes], left: np.ndarray, size: np.ndarray):
    """Hash of every string filed under an anchor, by the number of symbols it has before it
    (columns 0 .. threshold - gram), and which of them lie within the text."""
    n, width = units.threshold, units.left + units.threshold
    grid = np.zeros((len(blobs), width), units.dtype)
    for i, (blob, a) in enumerate(zip(blobs, left.tolist())):
        part = np.frombuffer(blob, units.dtype)
        grid[i, units.left - a : units.left - a + len(part)] = part
    prefix = np.zeros((len(blobs), width + 1), np.uint64)
    np.cumsum(units.values(grid) * powers(width), axis=1, out=prefix[:, 1:])
    at = units.left - np.arange(units.left + 1)  # where the string starts
    hashes = (prefix[:, at + n] - prefix[:, at]) * powers(width, True)[at]
    offset = np.arange(units.left + 1)
    right = size - left
    return hashes, (offset <= left[:, None]) & (n - offset <= right[:, None])


def repeats_within(hashes: np.ndarray, valid: np.ndarray, bucket: np.ndarray):
    """For every entry whether another of its bucket and column is equal, and whether it is
    the first of its equals."""
    again, first = np.zeros(valid.shape, bool), np.zeros(valid.shape, bool)
    keyed = mix(bucket.view(np.uint64))
    for column in range(hashes.shape[1]):
        rows = np.flatnonzero(valid[:, column])
        if len(rows):
            key = hashes[rows, column] ^ keyed[rows]
            order = np.argsort(key, kind="stable")
            same = key[order][1:] == key[order][:-1]
            again[rows[order[1:][same]], column] = True
            again[rows[order[:-1][same]], column] = True
            first[rows[order[np.r_[True, ~same]]], column] = True
    return again, first


_ENTRY = np.dtype([("hash", "<u8"), ("row", "<i8"), ("place", "<i4"), ("offset", "<i2"), ("wants", "<i2")])
_ORDERED = "gram long, part int, entries binary, row long, begin int, end int"


def _order(buckets: DataFrame, units: Units, block: int, entries: int) -> DataFrame:
    """Pass 3 on rows (gram, members, salt, n, row, place, left, symbols) sorted by bucket."""
    n = units.threshold

    def emit(found, dealt):
        return pa.RecordBatch.from_arrays(
            [
                pa.array([d[0] for d in dealt] + [None] * len(found[0]), pa.int64()),
                pa.array([d[1] for d in dealt] + [None] * len(found[0]), pa.int32()),
                pa.array([d[2] for d in dealt] + [None] * len(found[0]), pa.binary()),
                pa.array([None] * len(dealt) + found[0].tolist(), pa.int64()),
                pa.array([None] * len(dealt) + found[1].tolist(), pa.int32()),
                pa.array([None] * len(dealt) + found[2].tolist(), pa.int32()),
            ],
            names=["gram", "part", "entries", "row", "begin", "end"],
        )

    def work(rows):
        gram, members, salt, count, row, place, left, blobs = (list(c) for c in zip(*rows))
        gram, members, salt = np.array(gram, np.int64), np.array(members), np.array(salt, np.int64)
        row, place, left = np.array(row), np.array(place), np.array(left)
        size = np.array([len(b) for b in blobs]) // units.dtype.itemsize
        alone = np.array(count) == 1
        parts = [
            string_hashes(units, blobs[a : a + 512], left[a : a + 512], size[a : a + 512])
            for a in range(0, len(blobs), 512)
        ]
        hashes, valid = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        again, first = repeats_within(hashes, valid, gram ^ (salt << 40))
        hit = again.any(1) & alone
        most = units.left - again[:, ::-1].argmax(1)
        fewest = again.argmax(1)
        found = row[hit], (place - most)[hit], (place - fewest + n)[hit]
        dealt = []
        split = members > block
        for g in np.unique(gram[split]):
            mine = np.flatnonzero(split & (gram == g))
            # One of each string seen more than once, and all that were seen once.
            r, c = np.nonzero(first[mine])
            r = mine[r]
            e = np.zeros(len(r), _ENTRY)
            e["hash"], e["row"], e["place"], e["offset"] = hashes[r, c] + c.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), row[r], place[r], c
            e["wants"] = alone[r] & ~again[r, c]
            lots = max(1, -(-int(members[mine[0]]) * (units.left + 1) // entries))
            lot = (mix(e["hash"].copy()) % np.uint64(lots)).astype(np.int64)
            order = np.argsort(lot, kind="stable")
            cut = np.searchsorted(lot[order], np.arange(lots + 1))
            dealt += [
                (int(g), p, e[order[cut[p] : cut[p + 1]]].tobytes()) for p in range(lots) if cut[p] < cut[p + 1]
            ]
        return emit(found, dealt)

    def run(batches):
        held, last = [], None
        for batch in batches:
            for values in zip(*(c.to_pylist() for c in batch.columns)):
                bucket = values[0], values[2]
                if bucket != last and len(held) >= 2048:
                    yield work(held)
                    held = []
                last = bucket
                held.append(values)
        if held:
            yield work(held)

    return buckets.mapInArrow(run, _ORDERED)


def _order_dealt(dealt: DataFrame, threshold: int) -> DataFrame:
    """The strings of split buckets, each digit's entries of all blocks together."""

    def work(group: pa.Table) -> pa.Table:
        e = np.concatenate([np.frombuffer(b, _ENTRY) for b in group["entries"].to_pylist()])
        order = np.argsort(e["hash"], kind="stable")
        same = e["hash"][order][1:] == e["hash"][order][:-1]
        again = np.zeros(len(e), bool)
        again[order[1:][same]] = again[order[:-1][same]] = True
        e = e[again & (e["wants"] == 1)]
        # All strings of a member hold its anchor, so together they are one span.
        e = e[np.lexsort((e["offset"], e["place"], e["row"]))]
        new = np.r_[True, (e["row"][1:] != e["row"][:-1]) | (e["place"][1:] != e["place"][:-1])][: len(e)]
        first = np.flatnonzero(new)
        last = np.r_[first[1:], len(e)][: len(first)] - 1
        place = e["place"][first].astype(np.int64)
        return pa.table(
            {
                "row": pa.array(e["row"][first], pa.int64()),
                "begin": pa.array(place - e["offset"][last], pa.int32()),
                "end": pa.array(place - e["offset"][first] + threshold, pa.int32()),
            }
        )

    return dealt.groupBy("gram", "part").applyInArrow(work, "row long, begin int, end int")


def merged(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans in order, with those that overlap or touch made one."""
    if not len(begin):
        return begin, end
    order = np.lexsort((end, begin))
    begin, end = begin[order], np.maximum.accumulate(end[order])
    new = np.r_[True, begin[1:] > end[:-1]]
    return begin[new], end[np.r_[np.flatnonzero(new)[1:] - 1, len(end) - 1]]


def numbered(docs: DataFrame, doc_id: str, out: str = "_row") -> DataFrame:
    """`docs` with a number of its own for each row: the id where ids are unique integers, else
    one given out in a written copy."""
    if dict(docs.dtypes)[doc_id] in ("bigint", "int", "smallint", "tinyint"):
        repeated = docs.groupBy(doc_id).count().where(f"count > 1 or `{doc_id}` is null").limit(1)
        if not repeated.count():
            return docs.withColumn(out, F.col(doc_id).cast("long"))
    return materialize(docs.withColumn(out, F.monotonically_increasing_id()), "numbered")


def repeated_spans(
    rows: DataFrame, unit: str = "bytes", threshold: int | None = None, gram: int | None = None,
    block: int = BLOCK, entries: int = ENTRIES,
) -> DataFrame:
    """(_row, begin array<int>, end array<int>): spans covered by repeated strings, in symbols.

    `rows` is (_row, text), `_row` unique.  Rows without such a string are left out; null texts are
    empty.  Strings are judged on the input and count within a text as between texts.
    """
    threshold = threshold or (BYTES if unit == "bytes" else WORDS)
    units = Units(unit, threshold, gram or gram_of(threshold))
    texts = rows.select(F.col("_row").alias("row"), "text").where("text is not null")
    listed = materialize(_anchor_table(texts, units), "anchors")
    every = listed.select("row", F.explode(F.arrays_zip(*_ANCHOR)).alias("a")).select("row", "a.*")
    # Pass 1: buckets with one member end here.
    # Written first, so that a join with a common gram can be split.
    common = materialize(every.groupBy("gram").agg(F.sum("times").alias("n")).where("n > 1").select("gram"), "common")
    shared = materialize(every.join(common, "gram"), "shared")
    # Pass 2: members equal in all their strings cover; those of one text are known from it.
    contexts = materialize(
        shared.groupBy("gram", "context").agg(
            F.sum("times").alias("n"), F.min(F.struct("row", "place", "before", "after")).alias("first")
        ),
        "contexts",
    )
    own = listed.select("row", F.explode(F.arrays_zip("begin", "end")).alias("a")).select("row", "a.*")
    equal = shared.where("times = 1").join(contexts.where("n > 1").select("gram", "context"), ["gram", "context"])
    whole = own.unionByName(
        equal.select("row", (F.col("place") - F.col("before")).alias("begin"), (F.col("place") + F.col("after")).alias("end"))
    )
    # Pass 3: the strings of buckets with different contexts.
    mixed = materialize(contexts.groupBy("gram").agg(F.count(F.lit(1)).alias("members")).where("members > 1"), "mixed")
    wanted = (
        contexts.join(mixed, "gram")
        .select("first.row", F.struct("gram", "members", "n", "first.place", "first.before", "first.after").alias("w"))
        .groupBy("row")
        .agg(F.collect_list("w").alias("wanted"))
    )

    def cut(batches):
        names = ["gram", "members", "salt", "n", "row", "place", "left", "symbols"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        def emit(out):
            return pa.RecordBatch.from_arrays([pa.array(o, k) for o, k in zip(out, kinds)], names=names)

        for batch in batches:
            out = [[] for _ in names]
            for row, text, asked in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                symbols = units.symbols(text.as_py().encode("utf-8", "surrogatepass"))
                for w in asked.as_py():
                    at = w["place"]
                    a, b = at - w["before"], at + w["after"]
                    blocks = -(-w["members"] // block)
                    salt = (row * 1_000_003 + at * 7_919) % 2_147_483_647 % blocks
                    values = w["gram"], w["members"], salt, w["n"], row, at, w["before"], symbols[a:b].tobytes()
                    for column, value in zip(out, values):
                        column.append(value)
                    if len(out[0]) >= CUT_ROWS:
                        yield emit(out)
                        out = [[] for _ in names]
            yield emit(out)

    cuts = texts.join(wanted, "row").mapInArrow(
        cut, "gram long, members long, salt long, n long, row long, place int, left int, symbols binary"
    )
    dealt_out = cuts.repartition("gram", "salt").sortWithinPartitions("gram", "salt")
    ordered = materialize(_order(dealt_out, units, block, entries), "ordered")
    late = _order_dealt(ordered.where("entries is not null"), units.threshold)
    spans = whole.unionByName(ordered.where("row is not null").select("row", "begin", "end")).unionByName(late)
    # One span a place at most reaches a row's group; equal ones are combined before.
    return spans.groupBy("row").agg(F.collect_set(F.struct("begin", "end")).alias("s")).select(
        F.col("row").alias("_row"), F.col("s.begin").alias("begin"), F.col("s.end").alias("end")
    )


def _spans_of(units: Units, data: bytes, begin, end) -> tuple[np.ndarray, np.ndarray]:
    begin, end = np.array(begin or [], np.int64), np.array(end or [], np.int64)
    size = len(data) if units.kind == "bytes" else len(data.split())
    begin, end = merged(np.maximum(begin, 0), np.minimum(end, size))
    return units.to_bytes(data, begin, end)


def dedup_digest(docs: DataFrame, threshold: int = BYTES, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row; see `repeated_spans`."""
    units = Units("bytes", threshold, gram_of(threshold))
    rows = numbered(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "doc_id")
    spans = repeated_spans(rows, "bytes", threshold)

    def run(batches):
        for batch in batches:
            out = [[] for _ in range(4)]
            begins, ends = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for value, b, e in zip(batch.column(1), begins, ends):
                data = (value.as_py() or "").encode("utf-8", "surrogatepass")
                begin, end = _spans_of(units, data, b, e)
                digest, at = hashlib.sha256(), 0
                for x, y in zip(begin.tolist(), end.tolist()):
                    digest.update(data[at:x])
                    at = y
                digest.update(data[at:])
                for column, v in zip(out, (len(data), int((end - begin).sum()), len(begin), digest.hexdigest())):
                    column.append(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in out[:3]), pa.array(out[3], pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return (
        rows.join(spans, "_row", "left")
        .select("doc_id", "text", "begin", "end")
        .mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    )


def drop_repeats(
    docs: DataFrame, unit: str = "words", threshold: int | None = None, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """`docs` with every repeated string of `threshold` bytes or words taken out of its text.

    All occurrences go.  A span of bytes that begins or ends within a character is
    widened to whole characters.  Null texts stay null, texts without a repeat are untouched;
    all columns and rows stay, whatever the columns' names.
    """
    threshold = threshold or (BYTES if unit == "bytes" else WORDS)
    units = Units(unit, threshold, gram_of(threshold))
    row, begin, end = (unused(docs, n) for n in ("_row", "_begin", "_end"))
    rows = numbered(docs, doc_id, row)
    spans = repeated_spans(rows.select(F.col(row).alias("_row"), F.col(text).alias("text")), unit, units.threshold)
    spans = spans.toDF(row, begin, end)

    @F.arrow_udf("string")
    def keep(texts, begins, ends):
        out = []
        for value, b, e in zip(texts, begins.to_pylist(), ends.to_pylist()):
            t = value.as_py()
            if t and b:
                data, parts, at = t.encode("utf-8", "surrogatepass"), [], 0
                for x, y in zip(*(s.tolist() for s in _spans_of(units, data, b, e))):
                    while x > at and data[x] & 0xC0 == 0x80:
                        x -= 1
                    while y < len(data) and data[y] & 0xC0 == 0x80:
                        y += 1
                    parts.append(data[at:x])
                    at = y
                t = b"".join([*parts, data[at:]]).decode("utf-8", "surrogatepass")
            out.append(t)
        return pa.array(out, pa.string())

    left = F.when(F.col(begin).isNull(), F.col(text)).otherwise(keep(text, begin, end))
    return rows.join(spans, row, "left").withColumn(text, left).select(*docs.columns)
