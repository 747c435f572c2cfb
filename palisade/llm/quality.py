"""Quality by positive-unlabelled learning.

A linear model is fitted to trusted positives (rows labelled 1) and unlabelled text with the
non-negative unbiased risk  prior*E_p[l(+)] + max(0, E_u[l(-)] - prior*E_p[l(-)]); negative
labels are used for one number only, the estimate of the class prior.  Features are hashed
words and word shapes (how a word is written) as shares of the text, and a few
measures of the whole text.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from operator import eq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palisade.llm.common import CACHE_ENTRIES, fold, hashed_share

WORD_BUCKETS = 1 << 14
SHAPE_BUCKETS = 1 << 10
MEASURES = 11
# Each measure is also cut at so many quantiles of the fitted rows.
CUTS = 5
# Documents of each kind, positive and unlabelled, that the model is fitted on, about.
FIT_ROWS = 4000
STEPS = 250
THRESHOLD = 0.7

_LETTERS = re.compile(rb"[a-z\x80-\xff]+")
_CAPITALS = re.compile(rb"[A-Z]+")
_DIGITS = re.compile(rb"[0-9]+")
_ALNUM = re.compile(rb"[0-9A-Za-z\x80-\xff]")
_NOT_CAPITAL = bytes(b for b in range(256) if not 65 <= b <= 90)
_NOT_DIGIT = bytes(b for b in range(256) if not 48 <= b <= 57)
_NOT_MARK = bytes(b for b in range(256) if b >= 128 or chr(b).isalnum() or b in b" \t\n\r\x0b\x0c")


def shape(word: bytes) -> bytes:
    """How a word is written: runs of letters, capitals and digits become one character."""
    return _DIGITS.sub(b"0", _CAPITALS.sub(b"A", _LETTERS.sub(b"a", word)))


def buckets(word: bytes) -> tuple[int, int]:
    """The two feature numbers of a word: its shape's and its lower-cased form's."""
    return (
        zlib.crc32(shape(word)) % SHAPE_BUCKETS,
        SHAPE_BUCKETS + zlib.crc32(word.lower()) % WORD_BUCKETS,
    )


def measures(data: bytes, words: list[bytes]) -> list[float]:
    size, n = len(data) or 1, len(words) or 1
    lines = data.split(b"\n")
    count = Counter(words)
    return [
        np.log1p(len(words)),
        1 - len(set(lines)) / len(lines),
        np.log1p(size / len(lines)),
        len(count) / n,
        size / n / 10,
        len(data.translate(None, _NOT_CAPITAL)) / size,
        len(data.translate(None, _NOT_DIGIT)) / size,
        len(data.translate(None, _NOT_MARK)) / size,
        # The same word again, the commonest word, words without a letter or digit.
        sum(map(eq, words, words[1:])) / n,
        max(count.values(), default=0) / n,
        sum(c for w, c in count.items() if not w.isalnum() and not _ALNUM.search(w)) / n,
    ]


def features(text: str | None) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """(feature numbers, shares, measures) of a text; a null text counts as empty."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    found = np.array([b for w in words for b in buckets(w)], np.int64)
    which, count = np.unique(found, return_counts=True)
    return which, count / max(1, len(words)), measures(data, words)


class Scale:
    """Measures as model inputs: centred, and cut at quantiles of the fitted rows."""

    def __init__(self, rows: np.ndarray):
        self.centre, self.spread = rows.mean(0), rows.std(0) + 1e-6
        self.cuts = np.quantile(rows, np.linspace(0, 1, CUTS + 2)[1:-1], axis=0)

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        centred = np.clip((rows - self.centre) / self.spread, -8, 8)
        above = (rows[:, None, :] > self.cuts[None]).reshape(len(rows), CUTS * MEASURES)
        return np.c_[centred, above, np.ones(len(rows))]


class Model:
    """Weights of words and shapes, and of the scaled measures with the constant last."""

    def __init__(self, weights: np.ndarray, scale: Scale, dense: np.ndarray):
        self.weights, self.scale, self.dense = weights, scale, dense
        self.cache: dict[bytes, float] = {}

    def __getstate__(self):
        return self.weights, self.scale, self.dense

    def __setstate__(self, state):
        self.__init__(*state)

    def of_word(self, word: bytes) -> float:
        if len(self.cache) >= CACHE_ENTRIES:
            self.cache.clear()
        a, b = buckets(word)
        value = self.cache[word] = float(self.weights[a] + self.weights[b])
        return value

    def score(self, text: str | None) -> float:
        data = (text or "").encode("utf-8", "surrogatepass")
        words = data.split()
        known = self.cache.get
        total = 0.0
        for w in words:
            value = known(w)
            total += self.of_word(w) if value is None else value
        m = self.scale(np.array([measures(data, words)]))
        z = total / max(1, len(words)) + float(m[0] @ self.dense)
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def fit(sample: pa.Table, prior: float, steps: int = STEPS) -> Model:
    """Minimise the non-negative risk by Adam over all rows of `sample` (the columns FEATURES); where
    the negative part falls below zero its gradient is reversed, as that estimator asks."""
    size, n_rows = SHAPE_BUCKETS + WORD_BUCKETS, sample.num_rows
    flat = {c: sample[c].combine_chunks() for c in ("which", "share", "measures")}
    positive = np.asarray(sample["positive"], bool)
    measured = np.asarray(flat["measures"].flatten()).reshape(n_rows, MEASURES)
    scaler = Scale(measured)
    dense = scaler(measured)
    index = np.asarray(flat["which"].flatten()).astype(np.int64)
    row = np.repeat(np.arange(n_rows), np.asarray(flat["which"].value_lengths()))
    value = np.asarray(flat["share"].flatten()).astype(float)
    mean = np.bincount(index, value, size) / n_rows
    scale = np.where(mean > 0, 1 / np.sqrt(mean + 1e-3), 0)
    value *= scale[index]
    w, d = np.zeros(size), np.zeros(dense.shape[1])
    d[-1] = np.log(prior / (1 - prior))
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(d), np.zeros_like(d)]
    n_p, n_u = positive.sum(), (~positive).sum()
    for step in range(1, steps + 1):
        z = np.bincount(row, w[index] * value, n_rows) + dense @ d
        s = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        minus = np.logaddexp(0, z)
        negative = minus[~positive].mean() - prior * minus[positive].mean()
        g = np.where(positive, 0, s / n_u)
        if negative >= 0:
            g = g + np.where(positive, prior * (s - 1) / n_p - prior * s / n_p, 0)
        else:
            g = np.where(positive, prior * s / n_p, -s / n_u)
        gw = np.bincount(index, g[row] * value, size) + 1e-5 * w
        gd = dense.T @ g + 1e-5 * d
        for p, grad, m, v in ((w, gw, *state[:2]), (d, gd, *state[2:])):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            p -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Model(w * scale, scaler, d)


FEATURES = "positive boolean, which array<int>, share array<float>, measures array<double>"


def _featurised(docs: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            found = [features(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([f[0].astype(np.int32) for f in found], pa.list_(pa.int32())),
                    pa.array([f[1].astype(np.float32) for f in found], pa.list_(pa.float32())),
                    pa.array([f[2] for f in found], pa.list_(pa.float64())),
                ],
                names=["positive", "which", "share", "measures"],
            )

    return docs.mapInArrow(run, FEATURES)


def quality_classifier(
    docs: DataFrame,
    labels: DataFrame,
    trained_on: Column | None = None,
    prior: float | None = None,
    fit_rows: int = FIT_ROWS,
    threshold: float = THRESHOLD,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """Add `score` (0 to 1) and `predicted` (1 from `threshold` on) to every row of `docs`.

    `labels` is (doc_id, quality); rows with a null id or label are ignored and an id with
    both labels is not trusted.  `trained_on` says which ids of either table may be learned
    from.  The fit reads about `fit_rows` positives and as many unlabelled rows, chosen by hashes of
    id and text, equal rows once; scoring covers every whole text.  Null texts count as empty; repeated rows get
    equal scores; existing `score` and `predicted` columns are replaced.  With no positive
    at all every score is the prior (0.5 if none is given).
    """
    usable = F.lit(True) if trained_on is None else trained_on
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    trusted = (
        labels.select("doc_id", "quality")
        .where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .where(usable)
        .groupBy("doc_id")
        .agg(F.min("quality").alias("least"), F.max("quality").alias("most"))
    )
    counted = trusted.agg(
        F.count_if(F.col("least") == 1), F.count_if(F.col("most") == 0), F.count(F.lit(1))
    ).first()
    n_docs = source.where(usable).count()
    if prior is None:
        known = counted[0] + counted[1]
        prior = float(np.clip(counted[0] / known, 0.02, 0.98)) if known else 0.5
    model = None
    if counted[0] and n_docs:
        # The ids fitted on are few by construction; they are sent to where the texts lie.
        ids = trusted.where(F.col("least") == 1).select("doc_id")
        ids = F.broadcast(ids.orderBy(F.xxhash64("doc_id", F.lit(17)), "doc_id").limit(fit_rows))
        rows = source.join(ids, "doc_id")
        positives = hashed_share(rows, fit_rows, rows.count())
        unlabelled = hashed_share(source.where(usable), fit_rows, n_docs)
        sample = _featurised(
            positives.select(F.lit(True).alias("positive"), "text").unionByName(
                unlabelled.select(F.lit(False).alias("positive"), "text")
            )
        ).toArrow()
        n_positive = pc.sum(sample["positive"]).as_py() or 0
        if 0 < n_positive < sample.num_rows:
            model = fit(sample, prior)

    @F.arrow_udf("double")
    def score(texts):
        if model is None:
            return pa.array([prior] * len(texts), pa.float64())
        return pa.array([model.score(t.as_py()) for t in texts], pa.float64())

    scored = docs.withColumn("score", score(text))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
