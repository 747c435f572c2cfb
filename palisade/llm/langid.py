"""Language of mixed texts: scripts narrow, words score, a Viterbi path labels spans.

Per language, hashed character n-grams of the training words are counted; a word's score in a language
is the mean log probability of its n-grams there.  Languages in which a word's script was
hardly seen are out for that word.  The path over the words of a text pays a penalty for each
switch of language; its spans are the labels and the language with most letters is the
text's.  Words in a script of no learned language are letters of the text but of no language.
All steps run on arrays of whole batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palisade.llm.common import unused

BUCKETS = 1 << 15  # per n-gram length
ORDERS = (2, 3)
PENALTY = 4.0
WEIGHT = 1.5
# A language uses a script when at least this share of its letters is of it.
SCRIPT_SHARE = 0.002
# Letters handled in one step, over all languages; words in one Viterbi batch.  A worker's memory
# goes by both, not by the size of the batches Spark hands it; results do not depend on them.
STEP_CELLS = 500_000
PATH_WORDS = 200_000
UNKNOWN = "und"

# First and last code point of the main blocks of each script.
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "gurmukhi": [(0xA00, 0xA7F)],
    "gujarati": [(0xA80, 0xAFF)],
    "tamil": [(0xB80, 0xBFF)],
    "telugu": [(0xC00, 0xC7F)],
    "kannada": [(0xC80, 0xCFF)],
    "malayalam": [(0xD00, 0xD7F)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "ethiopic": [(0x1200, 0x137F)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3134F)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
}
OTHER = len(SCRIPTS)

_tables: dict[str, np.ndarray] = {}


def _letter_table() -> np.ndarray:
    """code point -> number of its script, -1 for what is not a letter."""
    if "script" not in _tables:
        script = np.full(0x110000, -1, np.int8)
        letters = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and chr(c).isalpha()]
        script[letters] = OTHER
        for n, spans in enumerate(SCRIPTS.values()):
            for a, b in spans:
                part = script[a : b + 1]
                part[part == OTHER] = n
        # Marks that combine with a letter before them belong to its word.
        _tables["script"] = script
    return _tables["script"]


def words_of(texts: list[str]) -> tuple[np.ndarray, ...]:
    """Letters of the texts as one array, cut into words.

    (code points of the lower-cased letters, first letter of each word, text of each word,
    script of each word).  A word is a run of letters of one script.
    """
    joined = "\n".join(texts).lower() if texts else ""
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    # Lower-casing may change a text's length, so its borders are found after it.
    lengths = [len(t.lower()) + 1 for t in texts]
    script = _letter_table()[code]
    letter = script >= 0
    before = np.r_[np.int8(-1), script[:-1]] if len(script) else script
    first = letter & (script != before)
    owner = np.repeat(np.arange(len(texts)), lengths)[: len(code)]
    kept = np.flatnonzero(letter)
    starts = np.flatnonzero(first)
    number = np.cumsum(first)[kept] - 1  # the word of each letter
    begin = np.searchsorted(number, np.arange(len(starts)))
    return code[kept], begin, owner[starts], script[starts]


def grams(code: np.ndarray, begin: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram length (positions, buckets); a word has its border as a first and a
    last letter, so its beginning and end count."""
    n, words = len(code), len(begin)
    if not n:
        return
    padded = np.zeros(n + 2 * words, np.uint64)
    word = np.zeros(n, np.int64)
    word[begin[1:]] = 1
    word = np.cumsum(word)
    place = np.arange(n) + 2 * word + 1
    padded[place] = code
    edge = np.r_[begin, n] + 2 * np.arange(words + 1)
    last = edge[1:] - 1
    owner = np.repeat(np.arange(words), np.diff(edge))
    for k, order in enumerate(ORDERS):
        mixed = np.zeros(len(padded) - order + 1, np.uint64)
        for j in range(order):
            mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + padded[j : len(padded) - order + 1 + j]
            mixed ^= mixed >> np.uint64(29)
        at = np.arange(len(mixed))
        whole = at + order - 1 <= last[owner[: len(mixed)]]
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        yield owner[: len(mixed)][whole], (mixed[whole] >> np.uint64(49)).astype(np.int64) + k * BUCKETS


assert BUCKETS == 1 << (64 - 49)


class Model:
    """log probabilities (bucket x language) and the scripts each language uses."""

    def __init__(self, langs: list[str], counts: np.ndarray, scripts: np.ndarray):
        self.langs = langs
        table = np.empty((len(ORDERS) * BUCKETS, len(langs)), np.float32)
        for k in range(len(ORDERS)):
            part = counts[:, k * BUCKETS : (k + 1) * BUCKETS].astype(float)
            smooth = 0.5
            p = (part + smooth) / (part.sum(1, keepdims=True) + smooth * BUCKETS)
            table[k * BUCKETS : (k + 1) * BUCKETS] = np.log(p).T
        # What counts is the difference between languages; longer n-grams say more.
        self.mean = table.mean(1)
        self.table = table - self.mean[:, None]
        # Mean log probability of the n-grams a language was learned from.
        self.own = (counts * table.T).sum(1) / np.maximum(1, counts.sum(1))
        share = scripts / np.maximum(1, scripts.sum(1, keepdims=True))
        self.uses = (share >= SCRIPT_SHARE).T  # script x language
        self.common = int(np.argmax(scripts.sum(1)))

    def known_script(self, script: np.ndarray) -> np.ndarray:
        """Whether any learned language is written in a word's script."""
        return self.uses[np.minimum(script, OTHER)].any(1)

    def word_scores(self, code, begin, script) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(score of each word in each language, log probability of its n-grams in each, how many
        n-grams it has)."""
        total = np.zeros((len(begin), len(self.langs)), np.float32)
        level, number = np.zeros(len(begin), np.float32), np.zeros(len(begin))
        for owner, bucket in grams(code, begin):
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            # Every word has n-grams of each length, one letter and two borders at least.
            total += np.add.reduceat(self.table[bucket], first, axis=0)
            level += np.add.reduceat(self.mean[bucket], first)
            number += np.diff(np.r_[first, len(owner)])
        likely = total + level[:, None]
        total *= (WEIGHT * np.sqrt(np.maximum(number, 1)) / np.maximum(number, 1))[:, None].astype(np.float32)
        allowed = self.uses[np.minimum(script, OTHER)]
        none = ~self.known_script(script)
        total[~allowed & ~none[:, None]] -= 20.0
        total[none] = 0  # no language learned is written so: the word says nothing
        return total, likely, number

    def paths(self, scores: np.ndarray, sizes: np.ndarray, penalty: float) -> np.ndarray:
        """The best labels of the words of many texts, one step for all texts at a time."""
        n_lang = len(self.langs)
        order = np.argsort(-sizes, kind="stable")
        start = (np.cumsum(sizes) - sizes)[order]
        length = sizes[order]
        active = len(length) - np.searchsorted(length[::-1], np.arange(int(length[0]) if len(length) else 0), "right")
        back = np.zeros(scores.shape, np.int8 if n_lang < 128 else np.int16)
        own = np.arange(n_lang)
        best = np.zeros((len(length), n_lang), np.float32)
        for t, n in enumerate(active.tolist()):
            at = start[:n] + t
            b = best[:n]
            if t:
                top = b.argmax(1)
                change = b[np.arange(n), top] - penalty
                stay = b >= change[:, None]
                back[at] = np.where(stay, own, top[:, None])
                b = np.where(stay, b, change[:, None])
                b -= b.max(1, keepdims=True)
            best[:n] = b + scores[at]
        labels = np.zeros(len(scores), back.dtype)
        state = best.argmax(1)
        for t in range(len(active) - 1, -1, -1):
            n = int(active[t])
            at = start[:n] + t
            labels[at] = state[:n]
            state[:n] = back[at, state[:n]]
        return labels

    def label(self, texts: list[str | None], penalty: float = PENALTY):
        """(label of each word, letters of each word, whether a learned language is written in its
        script, log probability of its n-grams in each language, how many it has, number of words
        of each text)."""
        parts, sizes = [], np.zeros(len(texts), np.int64)
        room = max(1, STEP_CELLS // max(1, len(self.langs)))
        for a, b in runs_of([len(t or "") for t in texts], room):
            code, begin, owner, script = words_of([t or "" for t in texts[a:b]])
            letters = np.diff(np.r_[begin, len(code)])
            parts.append((*self.word_scores(code, begin, script), letters, self.known_script(script)))
            sizes[a:b] = np.bincount(owner, minlength=b - a)
        none = np.zeros((0, len(self.langs)), np.float32)
        parts.append((none, none, np.zeros(0), np.zeros(0, int), np.zeros(0, bool)))
        scores, likely, grams, letters, known = map(np.concatenate, zip(*parts))
        return self.paths(scores, sizes, penalty), letters, known, likely, grams, sizes


def runs_of(weights: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Cut a list into runs of at most `most` in total (a heavier item is a run of its own)."""
    a, total = 0, 0
    for i, w in enumerate(weights):
        if i > a and total + w > most:
            yield a, i
            a, total = i, 0
        total += w
    if a < len(weights):
        yield a, len(weights)


def text_lengths(texts: pa.Array) -> list[int]:
    """Characters of each text, a null one having none, without making Python strings of them."""
    return pc.fill_null(pc.utf8_length(texts), 0).to_pylist()


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model | None:
    """Count n-grams and scripts per language over all rows with a text and a language.

    What reaches the driver is one array of a fixed number of counts per language.
    """
    width = len(ORDERS) * BUCKETS + OTHER + 1
    source = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where(
        "lang is not null and text is not null"
    )

    def count(batches):
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for a, b in runs_of(text_lengths(batch.column(1)), 500_000):
                names, texts = (batch.column(c).slice(a, b - a).to_pylist() for c in (0, 1))
                code, begin, owner, script = words_of(texts)
                here = {name: i for i, name in enumerate(sorted(set(names)))}
                base = np.array([here[n] for n in names])[owner] * width
                size = len(here) * width
                total = np.zeros(size, np.int64)
                for word, gram in grams(code, begin):
                    total += np.bincount(gram + base[word], minlength=size)
                letters = np.diff(np.r_[begin, len(code)])
                seen = np.bincount(base + (width - OTHER - 1) + script, letters, size)
                total += seen.astype(np.int64)
                for name, i in here.items():
                    held[name] = held.get(name, 0) + total[i * width : (i + 1) * width]
        for name, total in held.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict(
                {"lang": [name] * len(at), "feature": at.astype(np.int32), "n": total[at]},
                schema=pa.schema([("lang", pa.string()), ("feature", pa.int32()), ("n", pa.int64())]),
            )

    summed = (
        source.mapInArrow(count, "lang string, feature int, n long")
        .groupBy("lang", "feature")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    if not summed.num_rows:
        return None
    langs = sorted(set(summed["lang"].to_pylist()))
    counts = np.zeros((len(langs), width), np.int64)
    place = {name: i for i, name in enumerate(langs)}
    codes = np.array([place[x] for x in summed["lang"].to_pylist()])
    counts[codes, summed["feature"].to_numpy()] = summed["n"].to_numpy()
    return Model(langs, counts[:, : -OTHER - 1], counts[:, -OTHER - 1 :])


RESULT = T.StructType(
    [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("lang_score", T.DoubleType()),
        T.StructField("n_spans", T.IntegerType()),
        T.StructField("lang_lead", T.DoubleType()),
        T.StructField("lang_fit", T.DoubleType()),
    ]
)


def predictions(model: Model | None, texts: pa.Array, penalty: float = PENALTY) -> pa.StructArray:
    """A row of RESULT for each text."""
    out = [[] for _ in RESULT]
    # A step of the path is taken by all texts of a run that are long enough, so texts of like length share one.
    lengths = np.array(text_lengths(texts), np.int64)
    order = np.argsort(lengths, kind="stable")
    for a, b in runs_of((lengths[order] // 5).tolist(), PATH_WORDS):
        n = b - a
        if model is None:
            for column, value in zip(out, (UNKNOWN, 0.0, 0, 0.0, 0.0)):
                column.extend([value] * n)
            continue
        labels, letters, known, likely, grams, sizes = model.label(texts.take(pa.array(order[a:b])).to_pylist(), penalty)
        n_lang = len(model.langs)
        owner = np.repeat(np.arange(n), sizes)
        weight = np.bincount(owner * n_lang + labels, letters * known, n * n_lang).reshape(n, n_lang)
        changes = (labels[1:] != labels[:-1]) | (owner[1:] != owner[:-1])
        first = np.r_[np.ones(min(1, len(labels)), bool), changes]
        total = np.bincount(owner, letters, n)
        top, most = weight.argmax(1), weight.max(1)
        rest = weight.copy()
        rest[np.arange(n), top] = 0
        next_most = np.maximum(rest.max(1), total - weight.sum(1))
        told = np.bincount(owner, likely[np.arange(len(owner)), top[owner]], n) / np.maximum(1, np.bincount(owner, grams, n))
        has = total > 0
        whole = np.maximum(1, total)
        out[0].extend(model.langs[t] if h else UNKNOWN for t, h in zip(top.tolist(), has.tolist()))
        out[1].extend((most / whole).tolist())
        out[2].extend(np.bincount(owner[first], minlength=n).tolist())
        out[3].extend(((most - next_most) / whole).tolist())
        out[4].extend(np.where(has, told - model.own[top], 0.0).tolist())
    found = pa.StructArray.from_arrays(
        [pa.array(column, kind) for column, kind in zip(out, (pa.string(), pa.float64(), pa.int32(), pa.float64(), pa.float64()))],
        RESULT.fieldNames(),
    )
    return found.take(pa.array(np.argsort(order)))


def language_id(
    docs: DataFrame,
    trained_on: Column | None = None,
    text: str = "text",
    lang: str = "lang",
    penalty: float = PENALTY,
) -> DataFrame:
    """Add to every row `lang_pred`, `lang_score` (share of the letters in that language's spans),
    `n_spans` (spans of one language each), `lang_lead` (by how much that share exceeds the one of
    the next language, or of the letters in scripts of no language) and `lang_fit` (mean log
    probability of the n-grams in that language less the mean of the text it was learned from).

    Letters in a script of no learned language count in the whole but for no language: a text of
    nothing else has score 0.

    Learned from rows that `trained_on` admits and whose text and language are not null; the
    language of a row takes no part in its own prediction.  A text that is null or has no
    letter, or a table without any language to learn, gets `und`, score, lead and fit 0 and no span.
    Ties go to the smaller language value.  Repeated rows get equal results; existing columns of
    the five names are replaced.
    """
    source = docs if trained_on is None else docs.where(trained_on)
    model = learn(source, text, lang)

    @F.arrow_udf(RESULT)
    def predict(texts):
        return predictions(model, texts, penalty)

    found = unused(docs, "_lang")
    return docs.withColumn(found, predict(text)).withColumns(
        {n: F.col(f"{found}.{n}") for n in RESULT.fieldNames()}
    ).drop(found)
