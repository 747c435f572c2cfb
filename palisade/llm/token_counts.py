"""Token counts of the sections of a text, from one encoding of the whole text.

The text is encoded once; the byte spans of its tokens are joined with the spans of the
sections as sorted intervals.  A token that crosses a border is allocated by a rule:

* `first`: to the sections that hold its first byte;
* `last`: to those that hold its last byte;
* `share`: to every section by the share of its bytes that lie in it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palisade.llm.bpe import encode_ids, read_vocabulary, segments_of

RULES = ("first", "last", "share")


def line_sections(data: bytes) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The lines of a text as byte spans, each with the line break that ends it."""
    raw = np.frombuffer(data, np.uint8)
    end = np.flatnonzero(raw == 10) + 1
    end = end if len(end) and end[-1] == len(raw) or not len(raw) else np.r_[end, len(raw)]
    begin = np.r_[0, end[:-1]] if len(end) else end
    return [str(i) for i in range(len(end))], begin, end


def byte_spans(data: bytes, start: list[int], end: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Spans of characters as spans of bytes, cut at the ends of the text."""
    raw = np.frombuffer(data, np.uint8)
    lead = np.r_[np.flatnonzero(raw & 0xC0 != 0x80), len(raw)]
    at = lambda x: lead[np.clip(np.array(x, np.int64), 0, len(lead) - 1)]
    return at(start), np.maximum(at(start), at(end))


def allocate(bounds: np.ndarray, begin: np.ndarray, end: np.ndarray, rule: str):
    """(allocated, crossing) of each section; `bounds` are the token borders from 0 on."""
    starts, ends = bounds[:-1], bounds[1:]
    if rule == "first":
        count = np.searchsorted(starts, end) - np.searchsorted(starts, begin)
    elif rule == "last":
        count = np.searchsorted(ends, end, "right") - np.searchsorted(ends, begin, "right")
    else:
        before = lambda x: np.interp(x, bounds, np.arange(len(bounds)))
        count = before(end) - before(begin)
    inside = lambda x: (np.searchsorted(starts, x) - np.searchsorted(ends, x, "right")) > 0
    first, last = inside(begin), inside(end)
    one = first & last & (np.searchsorted(ends, begin, "right") == np.searchsorted(ends, end, "right"))
    crossing = first.astype(int) + last - one
    return np.where(end > begin, count, 0), np.where(end > begin, crossing, 0)


def token_counts(
    docs: DataFrame, vocabulary_path: str, sections: str | None = None, rule: str = "first", text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """(doc_id, section, start, end, n_tokens, n_crossing), a row per section of every row.

    `sections` names a column array<struct<section string, start long, end long>> of character
    spans, in any order, overlapping or not; without it the lines of a text are its sections.
    start and end come back in bytes.  `n_tokens` is whole but for the rule `share`; `n_crossing` counts tokens that
    cross the section's borders.  Null or empty texts, and null or empty section lists, give no
    row; a section out of the text is cut at its end; null bounds are the text's.
    """
    if rule not in RULES:
        raise ValueError(f"unknown rule {rule!r}")
    raw = read_vocabulary(vocabulary_path)
    columns = [F.col(doc_id).alias("doc_id"), F.col(text).alias("text")]
    if sections:
        columns.append(F.col(sections).alias("sections"))

    def run(batches):
        segments = segments_of(raw)
        lengths = np.diff(segments.vocabulary.starts)
        for batch in batches:
            own, names, begins, ends, counts, crossings = [], [], [], [], [], []
            for i in range(batch.num_rows):
                value = batch.column(1)[i].as_py()
                if not value:
                    continue
                data = value.encode("utf-8", "surrogatepass")
                if sections:
                    listed = [s for s in batch.column(2)[i].as_py() or [] if s is not None]
                    if not listed:
                        continue
                    name = [s["section"] for s in listed]
                    begin, end = byte_spans(
                        data,
                        [0 if s["start"] is None else s["start"] for s in listed],
                        [len(value) if s["end"] is None else s["end"] for s in listed],
                    )
                else:
                    name, begin, end = line_sections(data)
                bounds = np.r_[0, np.cumsum(lengths[encode_ids(segments, value)])]
                count, crossing = allocate(bounds, begin, end, rule)
                own.append((i, len(name)))
                names += name
                begins.append(begin)
                ends.append(end)
                counts.append(count)
                crossings.append(crossing)
            flat = lambda x, kind: pa.array(np.concatenate([*x, np.zeros(0)]).astype(kind))
            at = np.repeat([i for i, _ in own], [n for _, n in own]) if own else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(at, pa.int64())),
                    pa.array(names, pa.string()),
                    flat(begins, np.int64),
                    flat(ends, np.int64),
                    flat(counts, np.float64 if rule == "share" else np.int64),
                    flat(crossings, np.int64),
                ],
                names=["doc_id", "section", "start", "end", "n_tokens", "n_crossing"],
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    number = "double" if rule == "share" else "long"
    return docs.select(*columns).mapInArrow(
        run, f"doc_id {kind}, section string, start long, end long, n_tokens {number}, n_crossing long"
    )
