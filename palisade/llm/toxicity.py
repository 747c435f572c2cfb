"""Toxicity by weak supervision.

Voters look for words in lists and for ways of writing; each fires or stays silent on a text.  The
lists are a fixed one of English insults, and words and word beginnings mined from labelled
documents.  A generative model of the votes, given the unknown label, has one accuracy a voter and
the strongest correlations as a tree (each voter may lean on one other); it is fitted by
expectation-maximisation to the votes on all documents, labelled ones holding it in place.  A
linear classifier is then trained on the labels' posterior probabilities.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palisade.llm.common import CACHE_ENTRIES, hashed_share, materialize

# Common English insults, in no language-specific form.
INSULTS = (
    "bastard clown coward creep cretin degenerate disgusting dumb filth fool freak garbage idiot "
    "imbecile jerk loser moron pathetic pig rat scum stupid trash vermin worthless"
).split()
# Characters written for letters.
DISGUISE = str.maketrans("0134578", "oieastb")

# Beginnings of words that are mined, in letters; 0 is the whole word.
LENGTHS = (0, 3, 4, 5, 6, 7)
# Mined terms of each length at most, and the evidence a term needs, in standard errors.
LEXICON, EVIDENCE = 300, 4.0
# A mined term occurs in so many toxic texts at least.
SUPPORT = 4
# Longer words are looked up each time and never mined whole.
WORD_CHARS = 32
# Shares of characters from which a text is written in capitals, or in exclamations.
SHOUTING, EXCLAIMING = 0.3, 0.01
# Hits in a hundred words from which a list's second voter fires, with two hits at least.
DENSE = 0.4
# More hits of a term or list than this count as so many.
HITS = 4
# Labelled documents of either kind, and unlabelled ones, that the model is fitted on, about.
FIT_ROWS = 3000
ROUNDS, STEPS = 25, 300
THRESHOLD = 0.7
PRIOR = 0.1

_WORDS = re.compile(r"\w+")
_NOT_CAPITAL = bytes(b for b in range(256) if not 65 <= b <= 90)
# Lists: insults, disguised insults, and the mined terms of each length.
LISTS = 2 + len(LENGTHS)
# Voters: one for each of the two fixed lists, two ways of writing, two for each mined list.
VOTERS = 4 + 2 * len(LENGTHS)
DENSE_INPUTS = 2 * LISTS + 3 + VOTERS + 1


def terms_of(word: str) -> list[tuple[int, str]]:
    """The terms that a lower-cased word stands for: (length or 0, letters)."""
    out = [(n, word[:n]) for n in LENGTHS if n and len(word) >= n]
    return [(0, word), *out] if len(word) <= WORD_CHARS else out


def sketch(text: str | None) -> int:
    """One number that a text shares with most of its near copies: of its three least word hashes."""
    hashes = sorted({zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in _WORDS.findall((text or "").lower())})
    return zlib.crc32(np.array(hashes[:3], "<u4").tobytes())


class Lexicon:
    """Term lists, and what a text has of them."""

    def __init__(self, terms: list[tuple[int, str]]):
        self.terms = terms
        self.number = {t: i for i, t in enumerate(terms)}
        self.insults = set(INSULTS)
        self.cache: dict[str, tuple] = {}

    def __getstate__(self):
        return self.terms

    def __setstate__(self, state):
        self.__init__(state)

    def look_up(self, word: str) -> tuple:
        """(lists with a term of the word, numbers of its mined terms)."""
        lists = [0] if word in self.insults else []
        if not lists and not word.isalpha() and word.translate(DISGUISE) in self.insults:
            lists = [1]
        found = [(2 + LENGTHS.index(n), self.number[n, t]) for n, t in terms_of(word) if (n, t) in self.number]
        hit = (tuple(lists + [f[0] for f in found]), tuple(f[1] for f in found)) if lists or found else ()
        if len(word) <= WORD_CHARS:
            if len(self.cache) >= CACHE_ENTRIES:
                self.cache.clear()
            self.cache[word] = hit
        return hit

    def read(self, text: str | None) -> tuple[int, Counter, list[int], list[float]]:
        """(code of the votes, hits of each mined term, hits of each list, measures) of a whole text."""
        text = text or ""
        words = _WORDS.findall(text.lower())
        hits, terms, known = [0] * LISTS, Counter(), self.cache.get
        for word, times in Counter(words).items():
            hit = known(word)
            if hit is None:
                hit = self.look_up(word)
            if hit:
                for i in hit[0]:
                    hits[i] += times
                for t in hit[1]:
                    terms[t] += times
        size = len(text) or 1
        capitals = len(text.encode("utf-8", "surrogatepass").translate(None, _NOT_CAPITAL)) / size
        exclaims = text.count("!") / size
        n = len(words) or 1
        votes = [hits[0] > 0, hits[1] > 0, capitals >= SHOUTING, exclaims >= EXCLAIMING]
        for h in hits[2:]:
            votes += [h > 0, h > 1 and 100 * h / n >= DENSE]
        code = sum(1 << i for i, v in enumerate(votes) if v)
        return code, terms, hits, [np.log1p(len(words)), capitals, min(1.0, 10 * exclaims)]

    def dense(self, code: int, hits: list[int], measures: list[float]) -> np.ndarray:
        """The classifier's inputs other than single terms."""
        n = np.expm1(measures[0]) or 1
        h = np.array(hits, float)
        votes = (code >> np.arange(VOTERS)) & 1
        return np.r_[np.log1p(np.minimum(h, HITS)), np.minimum(100 * h / n, 5), measures, votes, 1.0]


class LabelModel:
    """P(label, votes) with a tree of dependences among voters, from counted vote patterns."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, labels: np.ndarray, rounds: int = ROUNDS):
        """`labels` is 0, 1, or -1 where unknown."""
        self.parent, self.table, self.share = np.full(VOTERS, -1), None, PRIOR
        votes = self._votes(codes)
        anchored = labels >= 0
        # Labelled documents weigh as much as all others, so that classes keep their meaning.
        weight = counts.astype(float)
        if anchored.any() and not anchored.all():
            weight[anchored] *= weight[~anchored].sum() / weight[anchored].sum()
        known = {0, 1} <= set(labels[anchored].tolist())
        post = np.where(anchored, labels, np.clip(0.05 + 0.4 * votes.sum(1), 0, 0.95)).astype(float)
        if known:
            self._fit(votes[anchored], weight[anchored], post[anchored])
            post = np.where(anchored, post, self.posterior(codes))
        for _ in range(rounds):
            self._fit(votes, weight, post)
            new = np.where(anchored, post, self.posterior(codes))
            moved, post = np.abs(new - post).max(initial=0), new
            if moved < 1e-6:
                break

    @staticmethod
    def _votes(codes: np.ndarray) -> np.ndarray:
        return (np.asarray(codes, np.int64)[:, None] >> np.arange(VOTERS)) & 1

    def _fit(self, votes: np.ndarray, weight: np.ndarray, post: np.ndarray):
        """Shares, tree and tables that fit votes with label probabilities best."""
        by_label = [weight * (1 - post), weight * post]
        totals = np.array([w.sum() for w in by_label]) + 1e-9
        self.share = float(np.clip(totals[1] / totals.sum(), 1e-4, 1 - 1e-4))
        both = np.stack([(votes * w[:, None]).T @ votes for w in by_label])
        one = np.stack([np.diag(b) for b in both])
        # pair[y, a, b, i, j]: weight of label y with vote i = a and vote j = b
        pair = np.empty((2, 2, 2, VOTERS, VOTERS))
        pair[:, 1, 1] = both
        pair[:, 1, 0] = one[:, :, None] - both
        pair[:, 0, 1] = one[:, None, :] - both
        pair[:, 0, 0] = totals[:, None, None] - one[:, :, None] - one[:, None, :] + both
        pair = np.maximum(pair, 0) + 0.5
        p = pair / pair.sum((1, 2), keepdims=True)
        gain = (p * np.log(p / (p.sum(2, keepdims=True) * p.sum(1, keepdims=True)))).sum((1, 2))
        information = np.tensordot(totals / totals.sum(), gain, 1)
        self.parent = self._tree(information)
        # table[y, vote, parent's vote, voter]
        self.table = np.empty((2, 2, 2, VOTERS))
        for j, q in enumerate(self.parent):
            if q < 0:
                alone = np.stack([totals - one[:, j], one[:, j]], 1) + 0.5
                self.table[:, :, :, j] = (alone / alone.sum(1, keepdims=True))[:, :, None]
            else:
                joint = pair[:, :, :, j, q]
                self.table[:, :, :, j] = joint / joint.sum(1, keepdims=True)

    @staticmethod
    def _tree(information: np.ndarray) -> np.ndarray:
        """Each voter's parent in the spanning tree of most conditional information; the root has -1."""
        parent = np.full(VOTERS, -1)
        best, link = information[0].copy(), np.zeros(VOTERS, np.int64)
        inside = np.arange(VOTERS) == 0
        for _ in range(VOTERS - 1):
            j = int(np.argmax(np.where(inside, -np.inf, best)))
            parent[j], inside[j] = link[j], True
            closer = information[j] > best
            best, link = np.where(closer, information[j], best), np.where(closer, j, link)
        return parent

    def posterior(self, codes: np.ndarray) -> np.ndarray:
        """P(toxic) given the votes."""
        votes = self._votes(codes)
        above = np.where(self.parent >= 0, votes[:, self.parent], 0)
        voter = np.arange(VOTERS)
        log = [np.log(self.table[y, votes, above, voter]).sum(1) for y in (0, 1)]
        odds = log[1] - log[0] + np.log(self.share / (1 - self.share))
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


class Model:
    """A linear classifier over term hits and the inputs of `Lexicon.dense`."""

    def __init__(self, lexicon: Lexicon, weights: np.ndarray, centre: np.ndarray, spread: np.ndarray, dense: np.ndarray):
        self.lexicon, self.weights, self.centre, self.spread, self.linear = lexicon, weights, centre, spread, dense

    def score(self, text: str | None) -> float:
        code, terms, hits, measures = self.lexicon.read(text)
        x = np.clip((self.lexicon.dense(code, hits, measures) - self.centre) / self.spread, -8, 8)
        z = float(x @ self.linear) + sum(self.weights[t] * np.log1p(min(n, HITS)) for t, n in terms.items())
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def train(
    lexicon: Lexicon,
    row: np.ndarray,
    term: np.ndarray,
    value: np.ndarray,
    dense: np.ndarray,
    target: np.ndarray,
    weight: np.ndarray,
    steps: int = STEPS,
) -> Model:
    """Logistic regression on label probabilities by Adam over all rows.  Rows (row, term, value)
    are the term inputs."""
    centre, spread = dense.mean(0), dense.std(0) + 1e-3
    centre[-1], spread[-1] = 0, 1
    x = np.clip((dense - centre) / spread, -8, 8)
    w, d = np.zeros(len(lexicon.terms)), np.zeros(x.shape[1])
    share = float(np.clip(target @ weight / weight.sum(), 1e-3, 1 - 1e-3))
    d[-1] = np.log(share / (1 - share))
    weight = weight / weight.sum()
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(d), np.zeros_like(d)]
    for step in range(1, steps + 1):
        z = x @ d + np.bincount(row, w[term] * value, len(target))
        g = weight * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - target)
        gw = np.bincount(term, g[row] * value, len(w)) + 1e-4 * w
        gd = x.T @ g + 1e-4 * np.r_[d[:-1], 0]
        for p, grad, m, v in ((w, gw, *state[:2]), (d, gd, *state[2:])):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            p -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Model(lexicon, w, centre, spread, d)


def mine(sample: DataFrame, n_toxic: int, n_clean: int) -> list[tuple[int, str]]:
    """The terms of each length that tell toxic texts best, from (label, text) rows."""

    def count(batches):
        seen = [Counter(), Counter()]
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = set(_WORDS.findall((text.as_py() or "").lower()))
                seen[label].update({t for w in words for t in terms_of(w)})
            if len(seen[0]) + len(seen[1]) > CACHE_ENTRIES:
                yield from counted(seen)
                seen = [Counter(), Counter()]
        yield from counted(seen)

    def counted(seen):
        for label in (0, 1):
            keys, n = list(seen[label]), list(seen[label].values())
            for at in range(0, len(keys), 50_000):
                part = keys[at : at + 50_000]
                some = pa.array(n[at : at + 50_000], pa.int64())
                none = pa.array([0] * len(part), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([k[0] for k in part], pa.int32()),
                        pa.array([k[1] for k in part], pa.string()),
                        some if label else none,
                        none if label else some,
                    ],
                    names=["length", "term", "toxic", "clean"],
                )

    labelled = sample.where(F.col("label") >= 0).select("label", "text")
    counts = labelled.mapInArrow(count, "length int, term string, toxic long, clean long")
    # Root of the likelihood ratio of a term's counts, against the same rate in both kinds of text.
    a, b = F.col("toxic"), F.col("clean")
    share = n_toxic / (n_toxic + n_clean)
    ratio = a * F.ln(a / ((a + b) * share)) + F.when(b > 0, b * F.ln(b / ((a + b) * (1 - share)))).otherwise(0.0)
    errors = F.when(a > (a + b) * share, F.sqrt(2 * ratio)).otherwise(0.0)
    told = (
        counts.groupBy("length", "term")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where(F.col("toxic") >= SUPPORT)
        .withColumn("errors", errors)
        .where(F.col("errors") >= EVIDENCE)
    )
    out = []
    for length in LENGTHS:
        best = told.where(F.col("length") == length).orderBy(F.desc("errors"), "term").limit(LEXICON)
        out += [(length, r.term) for r in best.select("term").collect()]
    return out


def _vote_counts(docs: DataFrame, lexicon: Lexicon) -> pa.Table:
    """(code, n) of all texts: 2 ** VOTERS rows at most."""

    def votes(batches):
        seen = Counter()
        for batch in batches:
            seen.update(lexicon.read(t.as_py())[0] for t in batch.column(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.int32()), pa.array(list(seen.values()), pa.int64())], names=["code", "n"]
        )

    counts = docs.mapInArrow(votes, "code int, n long")
    return counts.groupBy("code").agg(F.sum("n").alias("n")).toArrow()


def _inputs(sample: DataFrame, lexicon: Lexicon) -> pa.Table:
    """The classifier's inputs of the fitted rows."""

    def run(batches):
        for batch in batches:
            found = [lexicon.read(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([f[0] for f in found], pa.int32()),
                    pa.array([list(f[1]) for f in found], pa.list_(pa.int32())),
                    pa.array([np.log1p(np.minimum(list(f[1].values()), HITS)) for f in found], pa.list_(pa.float32())),
                    pa.array([lexicon.dense(f[0], f[2], f[3]) for f in found], pa.list_(pa.float64())),
                ],
                names=["label", "code", "term", "value", "dense"],
            )

    fields = "label int, code int, term array<int>, value array<float>, dense array<double>"
    return sample.select("label", "text").mapInArrow(run, fields).toArrow()


def _fitted(source: DataFrame, labels: DataFrame, usable: Column, fit_rows: int) -> Model | None:
    trusted = (
        labels.select("doc_id", "toxic")
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
        .where(usable)
        .groupBy("doc_id")
        .agg(F.min("toxic").cast("int").alias("label"), F.max("toxic").alias("most"))
        .where("label = most")
        .select("doc_id", "label")
    )
    total = {r.label: r.n for r in trusted.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_docs = source.count()
    if not n_docs:
        return None
    near = F.arrow_udf(lambda texts: pa.array([sketch(t.as_py()) for t in texts], pa.int64()), "long")
    parts = [hashed_share(source, fit_rows, n_docs).withColumn("label", F.lit(-1))]
    for label in total:
        ids = trusted.where(F.col("label") == label).orderBy(F.xxhash64("doc_id", F.lit(19)), "doc_id").limit(fit_rows)
        rows = source.join(F.broadcast(ids), "doc_id")
        parts.append(hashed_share(rows, fit_rows, rows.count()))
    sample = parts[0]
    for part in parts[1:]:
        sample = sample.unionByName(part)
    # Copies count once, or the words of a text copied often would fill the lists.
    single = sample.withColumn("near", near("text")).dropDuplicates(["label", "near"])
    single = materialize(single.select("label", "text"), "toxicity-sample")
    size = {r.label: r.n for r in single.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    terms = mine(single, size[1], size[0]) if size.get(1) and size.get(0) else []
    lexicon = Lexicon(terms)
    counts = _vote_counts(source.select("text"), lexicon)
    found = _inputs(single, lexicon)
    code, label = np.asarray(found["code"]), np.asarray(found["label"])
    # What a row stands for: the share of its kind that was taken.
    worth = {k: total.get(k, n_docs) / n for k, n in size.items()}
    weight = np.array([worth[x] for x in label.tolist()])
    anchored = label >= 0
    model = LabelModel(
        np.r_[np.asarray(counts["code"]), code[anchored]],
        np.r_[np.asarray(counts["n"]), weight[anchored]],
        np.r_[np.full(counts.num_rows, -1), label[anchored]],
    )
    target = np.where(anchored, label, model.posterior(code))
    term, value = (found[c].combine_chunks() for c in ("term", "value"))
    row = np.repeat(np.arange(len(label)), np.asarray(term.value_lengths()))
    dense = np.asarray(found["dense"].combine_chunks().flatten()).reshape(-1, DENSE_INPUTS)
    return train(
        lexicon, row, np.asarray(term.flatten()).astype(np.int64), np.asarray(value.flatten()).astype(float),
        dense, target, weight,
    )


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    trained_on: Column | None = None,
    fit_rows: int = FIT_ROWS,
    threshold: float = THRESHOLD,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """Add `score` (0 to 1, higher: likelier toxic) and `predicted` (1 from `threshold` on) to every row.

    `labels` is (doc_id, toxic); rows with a null id or label are ignored and an id with both labels
    is not trusted.  `trained_on` says which ids labels may be learned from.  Term lists and
    classifier are fitted on about `fit_rows` documents of each label and as many of all, chosen
    by hashes, copies once; votes are counted on all documents and scores read whole texts.  Null
    texts count as empty; equal texts get equal scores; existing `score` and `predicted` columns are
    replaced.  Without labels of both kinds no terms are mined and the fixed lists vote alone.
    """
    usable = F.lit(True) if trained_on is None else trained_on
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    model = _fitted(source, labels, usable, fit_rows)

    @F.arrow_udf("double")
    def score(texts):
        return pa.array([model.score(t.as_py()) for t in texts], pa.float64())

    value = F.lit(PRIOR) if model is None else score(text)
    return docs.withColumn("score", value).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
