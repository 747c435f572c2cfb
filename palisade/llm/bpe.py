"""BPE encoding by backtracking over longest token matches, decoding by an offset table.

A token sequence is the one that merging in rank order gives exactly when each neighbouring
pair of it is compatible: cut at their border, merging would not have joined anything across.
So the encoder takes the longest token that matches, goes on when the pair is compatible,
tries the next shorter match when not, and steps back when none is left; positions that failed
once are marked, so every position is tried once.
"""

from __future__ import annotations

import hashlib
import json
from array import array

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palisade.llm.common import CACHE_ENTRIES

# Fixed value: the pattern that splits text before byte-level merges.
PRETOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def printable_bytes() -> dict[str, int]:
    """character -> byte of the byte-level alphabet: printable Latin-1 stands for itself, the
    other bytes take the characters from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """A byte-level vocabulary: pair tables for the encoder, an offset table for decoding."""

    def __init__(self, raw: bytes):
        spec = json.loads(raw)
        model, alphabet = spec["model"], printable_bytes()
        to_bytes = lambda s: bytes(alphabet[c] for c in s)
        vocab = model["vocab"]
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        size = 1 + max([*vocab.values(), *self.special.values()])
        self.bytes_of: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.bytes_of[i] = to_bytes(token)
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.joined: dict[tuple[int, int], int] = {}
        self.left, self.right = list(range(size)), list(range(size))
        # The order of merging; a token that no merge makes is older than all merges.
        self.rank = [-1] * size
        for n, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            pair, i = (vocab[a], vocab[b]), vocab[a + b]
            if pair not in self.joined:
                self.joined[pair] = i
            if self.rank[i] < 0:
                self.rank[i], self.left[i], self.right[i] = n, *pair
        self.trie = ahocorasick.Automaton()
        self.whole: dict[bytes, int] = {}
        for token, i in vocab.items():
            b = to_bytes(token)
            self.whole[b] = i
            self.trie.add_word(b.decode("latin-1"), (len(b), i))
        self.trie.make_automaton()
        lengths = np.array([len(b) for b in self.bytes_of], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(lengths)])
        self.blob = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.digits = list(map(str, range(size)))
        self.pattern = regex.compile(PRETOKENS)
        self.specials = (
            regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        )
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.known_pairs: dict[tuple[int, int], bool] = {}

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging leaves the border between the tokens a and b alone.

        Walks the border back through the merges that built the two tokens, latest first:
        no pair met there may have a merge of its own that comes before the one undone.
        """
        if (found := self.known_pairs.get((a, b))) is not None:
            return found
        rank, joined = self.rank, self.joined
        x, y, before, ok = a, b, len(rank) * 2, True
        while True:
            merged = joined.get((x, y))
            if merged is not None and rank[merged] < before:
                ok = False
                break
            if rank[x] < 0 and rank[y] < 0:
                break
            # Undo the later of the two merges.  Equal ranks are two copies of one token:
            # merging goes from left to right, so there the right one is undone first, and
            # what crosses the border must come no later than it.
            if rank[x] > rank[y]:
                before, x = rank[x], self.right[x]
            else:
                before, y = rank[y] + 1, self.left[y]
        if len(self.known_pairs) >= CACHE_ENTRIES:
            self.known_pairs.clear()
        self.known_pairs[a, b] = ok
        return ok

    def encode_piece(self, data: bytes) -> tuple[int, ...]:
        """Token ids of one pre-token."""
        single = self.whole.get(data)
        if single is not None:
            return (single,)
        size = len(data)
        # Ends only grow, so the last match of a start is its longest; pop() takes it.
        matches: list[list[tuple[int, int]]] = [[] for _ in data]
        for end, found in self.trie.iter(data.decode("latin-1")):
            matches[end + 1 - found[0]].append(found)
        ids: list[int] = []
        at, last, dead, known = 0, -1, set(), self.known_pairs
        while at < size:
            options = matches[at]
            while options:
                length, i = options.pop()
                if dead and at + length in dead:
                    continue
                if last >= 0:
                    fits = known.get((last, i))
                    if not (self.compatible(last, i) if fits is None else fits):
                        continue
                ids.append(i)
                at, last = at + length, i
                break
            else:
                if not ids:
                    raise ValueError("the vocabulary lacks a single byte")
                dead.add(at)
                at -= len(self.bytes_of[ids.pop()])
                last = ids[-1] if ids else -1
        return tuple(ids)

    def encode_pretokens(self, text: str) -> list[int]:
        out: list[int] = []
        # Plain letters after one space or none are a single pre-token; most segments are such.
        word = text[1:] if text[:1] == " " else text
        for piece in (text,) if word.isascii() and word.isalpha() else self.pattern.findall(text):
            ids = self.pieces.get(piece)
            if ids is None:
                if len(self.pieces) >= CACHE_ENTRIES:
                    self.pieces.clear()
                ids = self.encode_piece(piece.encode("utf-8", "surrogatepass"))
                if len(piece) <= 64:
                    self.pieces[piece] = ids
            out.extend(ids)
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of a token sequence, gathered from the offset table in one step."""
        if not len(ids):
            return b""
        begin = self.starts[ids]
        length = self.starts[ids + 1] - begin
        ends = np.cumsum(length)
        index = np.repeat(begin - (ends - length), length)
        index += np.arange(ends[-1])
        return self.blob[index].tobytes()


class Segments(dict):
    """text between two safe spaces -> ids as int32 bytes."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, segment: str):
        got = self.made(self.vocabulary.encode_pretokens(" " + segment))
        if len(segment) <= 64:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[segment] = got
        return got

    def made(self, ids: list[int]) -> bytes:
        return array("i", ids).tobytes()


class ListedSegments(Segments):
    """text between two safe spaces -> (ids as int32 bytes, ids as decimal text)."""

    def made(self, ids: list[int]) -> tuple[bytes, str]:
        return super().made(ids), ",".join(map(self.vocabulary.digits.__getitem__, ids))


_unsafe = regex.compile(r"\s | \s|^ | $")
_safe = regex.compile(r"(?<=\S) (?=\S)")
_held: dict[tuple[type, bytes], Segments] = {}


def segments_of(raw: bytes, kind: type[Segments] = Segments) -> Segments:
    """The encoder of a vocabulary file's content, kept by the worker between tasks."""
    key = kind, hashlib.md5(raw).digest()
    if key not in _held:
        _held.clear()
        _held[key] = kind(Vocabulary(raw))
    return _held[key]


def encode_plain(segments: Segments, text: str) -> list:
    """Encode a text without special tokens, segment by segment; each as the segments' kind has it.

    A space between two characters that are not white space always starts a pre-token, so
    what lies between two such spaces is encoded the same wherever it stands.
    """
    parts = _safe.split(text) if _unsafe.search(text) else text.split(" ")
    out = [segments.made(segments.vocabulary.encode_pretokens(parts[0]))]
    out.extend(map(segments.__getitem__, parts[1:]))
    return out


def encode_text(segments: Segments, text: str) -> list:
    """Encode a whole text; the strings of special tokens in it become those tokens."""
    specials = segments.vocabulary.specials
    if specials is None or not specials.search(text):
        return encode_plain(segments, text)
    out, at = [], 0
    for m in specials.finditer(text):
        if m.start() > at:
            out.extend(encode_plain(segments, text[at : m.start()]))
        out.append(segments.made([segments.vocabulary.special[m.group()]]))
        at = m.end()
    if at < len(text):
        out.extend(encode_plain(segments, text[at:]))
    return out


def encode_ids(segments: Segments, text: str | None) -> np.ndarray:
    """Token ids of a whole text as int32; a null or empty text has none."""
    if not text:
        return np.zeros(0, np.int32)
    return np.frombuffer(b"".join(encode_text(segments, text)), np.int32)


def read_vocabulary(path: str) -> bytes:
    """The vocabulary file, read on the driver and shipped with the task (about 1.5 MB)."""
    with open(path, "rb") as f:
        return f.read()


def bpe_encode(docs: DataFrame, vocabulary_path: str, text: str = "text") -> DataFrame:
    """Add `ids` (array<int>) to every row.

    Null and empty texts get an empty array; repeated rows are encoded each; all other
    columns stay (an existing `ids` is replaced).
    """
    raw = read_vocabulary(vocabulary_path)

    @F.arrow_udf("array<int>")
    def encode(texts):
        import pyarrow as pa

        segments = segments_of(raw)
        found = [encode_ids(segments, t.as_py()) for t in texts]
        ends = np.cumsum([0, *map(len, found)])
        flat = np.concatenate([*found, np.zeros(0, np.int32)])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))

    return docs.withColumn("ids", encode(text))


def bpe_decode(docs: DataFrame, vocabulary_path: str, ids: str = "ids") -> DataFrame:
    """Add `decoded` (string) from an array of ids; null ids give null, invalid UTF-8 the
    replacement character."""
    raw = read_vocabulary(vocabulary_path)

    @F.arrow_udf("string")
    def decode(arrays):
        import pyarrow as pa

        v = segments_of(raw).vocabulary
        return pa.array(
            [
                None if a is None else v.decode(np.array(a, np.int64)).decode("utf-8", "replace")
                for a in arrays.to_pylist()
            ],
            pa.string(),
        )

    return docs.withColumn("decoded", decode(ids))


def bpe_digest(
    docs: DataFrame, vocabulary_path: str, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every text, encoded and decoded in
    one pass without moving ids or texts; null texts count as empty.  One row per input row.
    """
    raw = read_vocabulary(vocabulary_path)

    def run(batches):
        import pyarrow as pa

        segments = segments_of(raw, ListedSegments)
        v = segments.vocabulary
        for batch in batches:
            count, ids_sha, text_sha = [], [], []
            for value in batch.column(1):
                t = value.as_py() or ""
                made = encode_text(segments, t) if t else []
                ids = np.frombuffer(b"".join([p[0] for p in made]), np.int32)
                listed = ",".join([p[1] for p in made if p[1]])
                count.append(len(ids))
                ids_sha.append(hashlib.sha256(listed.encode()).hexdigest())
                digest = hashlib.sha256()
                # Decoding goes by bounded slices; a slice may end within a character, so the
                # bytes are checked as one text only where they aren't valid as they stand.
                whole = b"".join(v.decode(ids[a : a + 2**20]) for a in range(0, len(ids), 2**20))
                digest.update(whole.decode("utf-8", "replace").encode())
                text_sha.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(count, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[doc_id].dataType),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
    )
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)
