"""Language-model scores: a unigram base exact over all words, and a causal self-attention
model on subword ids, trained and run in numpy inside Spark tasks.

The model predicts the class of the next subword from the last one (a table counted from the
corpus) and from one head of causal attention over a window (trained by gradient descent in
parallel, parameters averaged between rounds), then the subword within its class by counts
that depend on the kind of the last subword.  A common word may also come as a whole: from the
predicted class of its first subword, by its count among the words that begin in that class.
Its probability is the mean of both ways by a fixed weight; a word spelled in subwords pays for
ending where it does, a whole word does not.  Windows tile every training text from its start to its
end, so each transition lies in exactly one: the descent sees them all, and all counts are taken over
all training texts.
"""

from __future__ import annotations

import base64
import functools
import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palisade.llm.bpe import PRETOKENS, read_vocabulary
from palisade.llm.common import CACHE_ENTRIES, lowered_words, materialize

# Commonest words whose counts are sent to every task; the others are joined, with the same results.
HEAD_WORDS = 200_000
# Subword ids the model tells apart in its input, and classes in its output.
INPUTS = 4096
CLASSES = 32
# The first classes are of what begins a word, the last of these of the end of a text.
OPENING = 20
# Classes of the last subword on which the next one's share within its class depends.
FINE = 256
CONTEXTS = 64
WIDTH, HEAD_DIM = 16, 8
# Tokens scored per window, and tokens of a window: each is scored with half a window or more.
STRIDE, WINDOW = 16, 32
# What fills the last window of a text; it is neither counted nor learned from.
PAD = 0xFFFF
# Windows in a row of their table, and words of texts worked on at once.
ROW_WINDOWS = 32
GROUP_WORDS = 40_000
# Windows whose transitions are counted at once.
COUNTED_WINDOWS = 4096
ROUNDS, BATCH, RATE = 1, 64, 0.02
SLICES = 8
# Rows of attention worked on at a time.
STEP_BLOCKS = 128

# Weight of whole words in a word's probability.
WHOLE_WEIGHT = 0.5

LN10 = math.log(10)


def ranks_of(raw: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}


def word_starts(raw: bytes) -> np.ndarray:
    """Whether each subword id begins with a space."""
    ranks = ranks_of(raw)
    starts = np.zeros(1 + max(ranks.values()), bool)
    starts[[i for token, i in ranks.items() if token[:1] == b" "]] = True
    return starts


def subword_encoder(raw: bytes):
    import tiktoken

    ranks = ranks_of(raw)
    return tiktoken.Encoding("subwords", pat_str=PRETOKENS, mergeable_ranks=ranks, special_tokens={})


def subwords(encoder, word: bytes) -> list[int]:
    return encoder.encode_ordinary(" " + word.decode("utf-8", "replace"))


# Longer words count as several: what a task keeps of words is bounded in bytes, too.
KEPT_CHARS = 64
# Words encoded together.
JOINED_WORDS = 10_000
# White space of the pre-tokens that may stand in a word: it would run into the space before the next one.
_INNER_WHITE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def joined(words: list[bytes]) -> str | None:
    """The words with a space before each, if each is spelled there as it is alone."""
    try:
        text = " " + b" ".join(words).decode()
    except UnicodeDecodeError:
        return None
    return text if text.isascii() or not _INNER_WHITE.search(text) else None


class Spelled:
    """The subword ids of words; kept by the worker from task to task."""

    def __init__(self, raw: bytes):
        self.encoder = subword_encoder(raw)
        self.starts = word_starts(raw)

    def together(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in one array, and how many each has.  Words are encoded joined by spaces,
        each of which begins a pre-token and so the first subword of its word; the few for which that does
        not hold are encoded alone."""
        found = [np.zeros(0, np.int32)]
        for at in range(0, len(words), JOINED_WORDS):
            part = words[at : at + JOINED_WORDS]
            whole = joined(part)
            odd = [] if whole is not None else [i for i, word in enumerate(part) if joined([word]) is None]
            edges = [-1, *odd, len(part)]
            for a, b in zip(edges, edges[1:]):
                if b > a + 1:
                    text = joined(part[a + 1 : b]) if odd else whole
                    found.append(np.array(self.encoder.encode_ordinary(text), np.int32))
                if b < len(part):
                    found.append(np.array(subwords(self.encoder, part[b]), np.int32))
        ids = np.concatenate(found)
        return ids, np.diff(np.flatnonzero(self.starts[ids]), append=len(ids))

    def several(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of each word."""
        ids, size = self.together(words)
        ends = np.cumsum(size)
        return [ids[a:b] for a, b in zip((ends - size).tolist(), ends.tolist())]


_spelled: dict[int, Spelled] = {}


def spelled_by(raw: bytes) -> Spelled:
    key = zlib.crc32(raw)
    if key not in _spelled:
        _spelled.clear()
        _spelled[key] = Spelled(raw)
    return _spelled[key]


def grown(array: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """The array with `more` after its first `used` entries, made longer where it takes that."""
    while used + len(more) > len(array):
        array = np.concatenate([array, np.zeros_like(array)])
    array[used : used + len(more)] = more
    return array


class Numbered(dict):
    """word -> its number, by which its model inputs lie in a growing array; None, number 0, is the end of a
    text.  Words met for the first time are numbered at once and spelled together."""

    def __init__(self, spelled: Spelled, input_of: np.ndarray):
        super().__init__()
        self.spelled, self.input_of = spelled, input_of.astype(np.uint16)
        self.reset()

    def reset(self) -> None:
        self.clear()
        self[None] = 0
        self.new, self.size, self.chars = [], 0, 0
        self.begin, self.inputs = np.zeros(1 << 17, np.int64), np.zeros(1 << 18, np.uint16)
        # The id after the vocabulary's last is the end of a text.
        self.learn(np.array([len(self.input_of) - 1]), np.array([1]))
        self.kept = self.size

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number

    def learn(self, ids: np.ndarray, size: np.ndarray) -> None:
        """Take in the ids of the next numbers, `size` of them each."""
        filled = int(self.begin[self.size])
        self.inputs = grown(self.inputs, filled, self.input_of[ids])
        self.begin = grown(self.begin, self.size + 1, filled + np.cumsum(size))
        self.size += len(size)

    def numbers(self, words: list) -> np.ndarray:
        found = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if self.new:
            self.chars += sum(map(len, self.new))
            self.learn(*self.spelled.together(self.new))
            self.new = []
        return found

    def flat(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The inputs of numbered words in one array, and how many each has."""
        begin = self.begin[number]
        size = self.begin[number + 1] - begin
        at = np.repeat(begin - (np.cumsum(size) - size), size)
        at += np.arange(len(at))
        return self.inputs[at], size

    def full(self) -> bool:
        return self.size - self.kept > CACHE_ENTRIES or self.chars > KEPT_CHARS * CACHE_ENTRIES


def word_groups(column):
    """The words of texts, in groups of some GROUP_WORDS words and at least a text."""
    group, held = [], 0
    for value in column:
        group.append(lowered_words(value.as_py()))
        held += len(group[-1]) + 1
        if held > GROUP_WORDS:
            yield group
            group, held = [], 0
    if group:
        yield group


class Subwords:
    """How subword ids enter the model: input number, class, log share within the input."""

    def __init__(self, count: np.ndarray, starts: np.ndarray):
        # The id after the vocabulary's last is the end of a text, and what stands before its start.
        self.end = size = len(count)
        self.count = np.r_[count, 0].astype(float)
        order = np.argsort(-count, kind="stable")
        self.inputs = min(INPUTS, size)
        # Rarer ids share an input, those that start a word one and the others one.
        self.input_of = np.r_[np.where(starts, self.inputs, self.inputs + 1), self.inputs + 2]
        self.input_of[order[: self.inputs]] = np.arange(self.inputs)
        self.end_input = self.inputs + 2
        self.n_inputs = self.inputs + 3
        # Inputs that follow the end of a word.
        self.opens = np.ones(self.n_inputs, bool)
        self.opens[: self.inputs] = starts[order[: self.inputs]]
        self.opens[self.inputs + 1] = False

    def set_classes(self, class_of_input: np.ndarray, n_classes: int) -> None:
        self.class_of_input, self.n_classes = class_of_input, n_classes
        weight = self.count + 0.5
        weight[self.end] = 1.0
        of_input = np.bincount(self.input_of, weight, self.n_inputs)
        # Rarer ids share one input: the share of an id in it.
        self.within = np.log(weight / of_input[self.input_of])
        of_class = np.bincount(class_of_input, of_input, n_classes)
        self.in_class = of_input / of_class[class_of_input]


def cluster(context: np.ndarray, weight: np.ndarray, n: int, steps: int = 12) -> np.ndarray:
    """k-means on what stands before a subword, as roots of shares; commonest rows start."""
    rows = np.sqrt((context + 0.02) / (context + 0.02).sum(1, keepdims=True))
    start = np.argsort(-weight, kind="stable")[:n]
    centre = rows[start].copy()
    label = np.zeros(len(rows), np.int64)
    for _ in range(steps):
        label = (rows @ centre.T).argmax(1)
        mass = np.bincount(label, weight + 1e-6, len(centre))
        total = np.stack([np.bincount(label, (weight + 1e-6) * col, len(centre)) for col in rows.T], 1)
        seen = mass > 0
        centre[seen] = total[seen]
        centre /= np.linalg.norm(centre, axis=1, keepdims=True) + 1e-12
    return label


def initial(subs: Subwords, seed: int = 3) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    normal = lambda *shape: (r.standard_normal(shape) * 0.3).astype(np.float32)
    return {
        "embed": normal(subs.n_inputs, WIDTH),
        "query": normal(WIDTH, HEAD_DIM),
        "key": normal(WIDTH, HEAD_DIM),
        "value": normal(WIDTH, WIDTH),
        "out": np.zeros((WIDTH, subs.n_classes), np.float32),
        "near": np.zeros(WINDOW, np.float32),
    }


_distance = np.arange(WINDOW)[:, None] - np.arange(WINDOW)[None, :]


def row_max(x: np.ndarray) -> np.ndarray:
    """x.max(-1, keepdims=True) by halving: numpy is slow along a short last axis."""
    while (n := x.shape[-1]) > 1:
        half = np.maximum(x[..., : n // 2], x[..., n // 2 : n // 2 * 2])
        if n % 2:
            np.maximum(half[..., :1], x[..., -1:], out=half[..., :1])
        x = half
    return x


def row_sum(x: np.ndarray) -> np.ndarray:
    """x.sum(-1, keepdims=True) as a product with ones, likewise."""
    n = x.shape[-1]
    return (x.reshape(-1, n) @ np.ones(n, x.dtype)).reshape(*x.shape[:-1], 1)


# Between these, exp neither overflows nor vanishes in float32, nor do sums and quotients of a row.
EXP_RANGE = 40


def exp_rows(x: np.ndarray, least: np.ndarray) -> None:
    """exp(x) in place, up to a factor by row; `least` has an entry of every row or more.  Only where some are out
    of range, each row is divided by its largest first."""
    if not (x.max() < EXP_RANGE and least.min() > -EXP_RANGE):
        x -= row_max(x)
    np.exp(x, out=x)


@functools.lru_cache(1)
def cells_of(rows: int) -> np.ndarray:
    """The number of each entry of an array of that many rows of WIDTH."""
    return np.arange(rows * WIDTH).reshape(rows, WIDTH)


def over_rows(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """x.T @ y of two tall arrays, in runs of rows: the library is slow on one tall product."""
    runs = math.gcd(len(x), 8)
    return (x.reshape(runs, -1, x.shape[1]).transpose(0, 2, 1) @ y.reshape(runs, -1, y.shape[1])).sum(0)


def forward_backward(p, table, ids, target):
    """Loss and gradients of one batch of windows (ids, target class: batch x WINDOW), over the
    places with a target; the others have a negative one."""
    shape, flat, goal = ids.shape, ids.ravel(), target.ravel()
    scale = np.float32(1 / math.sqrt(HEAD_DIM))
    joint = np.concatenate([p["query"] * scale, p["key"], p["value"]], 1)
    x = np.take(p["embed"], flat, 0)
    qkv = (x @ joint).reshape(*shape, -1)
    q, k, v = qkv[:, :, :HEAD_DIM], qkv[:, :, HEAD_DIM : 2 * HEAD_DIM], qkv[:, :, 2 * HEAD_DIM :]
    causal = _distance >= 0
    a = q @ k.transpose(0, 2, 1)
    a += np.where(causal, p["near"][np.maximum(_distance, 0)], np.float32(-1e9))
    exp_rows(a, a.reshape(len(a), -1)[:, :: WINDOW + 1])  # a place looks at itself
    # Attention stays undivided by its sums: what it is multiplied with is narrower and is divided instead.
    part = 1 / row_sum(a).reshape(-1, 1)
    o = (a @ v).reshape(len(flat), -1)
    o *= part
    prob = o @ p["out"]
    prob += np.take(table, flat, 0)
    exp_rows(prob, prob)
    whole = 1 / row_sum(prob)
    real, place = goal >= 0, np.arange(len(flat))
    n = max(1, int(real.sum()))
    loss = -np.log(prob[place, goal] * whole[:, 0] + 1e-30)[real].sum() / n
    share = (real / n).astype(prob.dtype)
    prob *= whole * share[:, None]
    prob[place, goal] -= share
    g = {"out": over_rows(o, prob)}
    do = prob @ p["out"].T
    do *= part
    ds = do.reshape(*shape, -1) @ v.transpose(0, 2, 1)
    ds -= np.einsum("ij,ij->i", do, o).reshape(*shape, 1)
    ds *= a
    g["near"] = np.bincount(_distance[causal], ds.sum(0)[causal], WINDOW).astype(np.float32)
    d = np.empty_like(qkv)
    np.matmul(ds, k, out=d[:, :, :HEAD_DIM])
    np.matmul(ds.transpose(0, 2, 1), q, out=d[:, :, HEAD_DIM : 2 * HEAD_DIM])
    np.matmul(a.transpose(0, 2, 1), do.reshape(*shape, -1), out=d[:, :, 2 * HEAD_DIM :])
    d = d.reshape(len(flat), -1)
    g["query"], g["key"], g["value"] = np.split(over_rows(x, d), [HEAD_DIM, 2 * HEAD_DIM], 1)
    g["query"] = g["query"] * scale
    g["embed"] = np.zeros_like(p["embed"])
    cell = np.take(cells_of(len(p["embed"])), flat, 0)
    np.add.at(g["embed"].reshape(-1), cell.ravel(), (d @ joint.T).ravel())
    return loss, g


def descend(p, table, windows: np.ndarray, subs: Subwords, rate: float) -> float:
    """Adam over the windows of one task, in place; gives back the mean loss."""
    # What fills a window counts as the end of a text, never looked back at.
    input_of = np.full(PAD + 1, subs.end_input)
    input_of[: len(subs.input_of)] = subs.input_of
    class_of = np.full(PAD + 1, -1)
    class_of[: len(subs.input_of)] = subs.class_of_input[subs.input_of]
    # All parameters as one array, and views of it.
    every = np.concatenate([x.ravel() for x in p.values()])
    ends = np.cumsum([x.size for x in p.values()])[:-1]
    p.update({n: part.reshape(x.shape) for (n, x), part in zip(p.items(), np.split(every, ends))})
    first, second, move, grad = (np.zeros_like(every) for _ in range(4))
    losses = []
    for step, at in enumerate(range(0, len(windows), BATCH), 1):
        rows = windows[at : at + BATCH]
        loss, found = forward_backward(p, table, np.take(input_of, rows[:, :-1]), np.take(class_of, rows[:, 1:]))
        losses.append(loss)
        np.concatenate([found[n].ravel() for n in p], out=grad)
        # The means of gradients and of their squares, both short of a factor that goes to the rate.
        first *= 0.9
        first += grad
        second *= 0.98
        np.multiply(grad, grad, out=move)
        second += move
        np.sqrt(second, out=move)
        root = math.sqrt(0.02 / (1 - 0.98**step))
        move += 1e-7 / root
        np.divide(first, move, out=move)
        move *= rate * 0.1 / (1 - 0.9**step) / root
        every -= move
    return float(np.mean(losses)) if losses else 0.0


class Scorer:
    """The trained model as tables by input number, for batched masked attention."""

    def __init__(self, p, table, shares, fine, subs: Subwords):
        e = p["embed"]
        # log share of an input in its class after each kind of input, and the kinds.
        self.shares, self.fine = shares.ravel(), (fine * subs.n_inputs).astype(np.int32)
        self.query = (e @ p["query"] / math.sqrt(HEAD_DIM)).astype(np.float32)
        self.key = (e @ p["key"]).astype(np.float32)
        self.value = (e @ p["value"]).astype(np.float32)
        self.out, self.table = p["out"], table
        self.class_of_input = subs.class_of_input
        # Scores are kept where exp can't overflow, whatever was learned.
        most = np.linalg.norm(self.query, axis=1).max() * np.linalg.norm(self.key, axis=1).max()
        near = np.clip(p["near"], -20, 20)
        self.query *= np.float32(min(1.0, 40 / max(most, 1e-6)))
        place = np.arange(STRIDE)
        ahead = place[:, None] - place[None, :]
        own = np.where(ahead >= 0, near[np.maximum(ahead, 0)], -np.inf)
        self.bias = np.concatenate([near[ahead + STRIDE], own], 1).astype(np.float32)
        self.end_input = subs.end_input
        self.halves = np.zeros((self.out.shape[1], 2), np.float32)
        self.halves[:OPENING, 0] = self.halves[OPENING:, 1] = 1

    def score(self, flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log probabilities of the class of each input, of the input itself, and of a new word at its place; the
        inputs of texts lie one after the other, `sizes` of each, and an end stands before each.

        What stands before a text's inputs is cut into blocks of STRIDE; a block attends to itself and the block
        before, so each input is predicted once, from STRIDE or more inputs where there are as many.
        """
        blocks, first = -(-sizes // STRIDE), np.cumsum(sizes) - sizes
        offset = np.cumsum(blocks) - blocks
        total = int(blocks.sum())
        before = np.empty(len(flat), np.int64)
        before[1:] = flat[:-1]
        before[first] = self.end_input
        place = np.repeat(offset * STRIDE - first, sizes)
        place += np.arange(len(flat))
        # One more block in front, for the first to look back at.
        ids, target = np.zeros((total + 1) * STRIDE, np.int64), np.zeros(total * STRIDE, np.int64)
        ids[place + STRIDE] = before
        target[place] = self.class_of_input[flat]
        opening = np.zeros(total, bool)
        opening[offset] = True
        got, begins = np.empty(total * STRIDE, np.float32), np.empty(total * STRIDE, np.float32)
        rows = np.arange(STEP_BLOCKS * STRIDE)
        for a in range(0, total, STEP_BLOCKS):
            b = min(total, a + STEP_BLOCKS)
            seen = ids[a * STRIDE : (b + 1) * STRIDE]
            query = np.take(self.query, seen[STRIDE:], 0).reshape(b - a, STRIDE, -1)
            key, value = (_with_block_before(np.take(x, seen, 0)) for x in (self.key, self.value))
            s = query @ key.transpose(0, 2, 1)
            s += self.bias
            np.exp(s, out=s)
            s[opening[a:b], :, :STRIDE] = 0  # the block before belongs to another text
            o = (s @ value).reshape(-1, WIDTH)
            o /= row_sum(s).reshape(-1, 1)
            z = o @ self.out
            z += np.take(self.table, seen[STRIDE:], 0)
            chosen = z[rows[: len(z)], target[a * STRIDE : b * STRIDE]]
            np.exp(z, out=z)
            halves = z @ self.halves
            every = np.log(halves[:, 0] + halves[:, 1])
            np.subtract(chosen, every, out=got[a * STRIDE : b * STRIDE])
            np.subtract(np.log(halves[:, 0]), every, out=begins[a * STRIDE : b * STRIDE])
        got = got[place].astype(np.float64)
        return got, got + self.shares[self.fine[before] + flat], begins[place].astype(np.float64)


def _with_block_before(rows: np.ndarray) -> np.ndarray:
    """For each block of STRIDE rows but the first, its rows after those of the block before; a view."""
    step, within = rows.strides
    shape = len(rows) // STRIDE - 1, 2 * STRIDE, rows.shape[1]
    return np.lib.stride_tricks.as_strided(rows, shape, (STRIDE * step, step, within), writeable=False)


def read_texts(docs: DataFrame, raw: bytes) -> DataFrame:
    """All texts, read once, as rows of two kinds.  (ids): each text as subword ids between two ends, cut into
    runs of WINDOW + 1 of which each begins with the last of the one before; the last run is filled with
    PAD, and a row holds up to ROW_WINDOWS runs.  (word, n): its words, counted in the tasks."""
    names = ["word", "n", "ids"]

    def cut(number, counts, numbered):
        ids, size = numbered.flat(number)
        length = np.add.reduceat(size, np.cumsum(counts) - counts)
        n = -(-(length - 1) // WINDOW)
        ends, stop = np.cumsum(n), np.cumsum(length)
        begin = np.repeat(stop - length - WINDOW * (ends - n), n) + WINDOW * np.arange(ends[-1])
        ids = np.concatenate([ids, np.full(WINDOW, PAD, np.uint16)])
        out = np.lib.stride_tricks.sliding_window_view(ids, WINDOW + 1)[begin]
        last = out[ends - 1]
        last[begin[ends - 1][:, None] + np.arange(WINDOW + 1) >= stop[:, None]] = PAD
        out[ends - 1] = last
        places = np.r_[np.arange(0, len(out), ROW_WINDOWS), len(out)].astype(np.int32) * np.int32(2 * (WINDOW + 1))
        column = [None, pa.py_buffer(places), pa.py_buffer(out.astype("<u2", copy=False).tobytes())]
        column = pa.Array.from_buffers(pa.binary(), len(places) - 1, column)
        none = pa.nulls(len(column), pa.binary()), pa.nulls(len(column), pa.int64())
        return pa.RecordBatch.from_arrays([*none, column], names=names)

    def counted(numbered, seen):
        words = list(numbered)[1:]
        columns = [pa.array(words, pa.binary()), pa.array(seen[1 : len(numbered)].copy()), pa.nulls(len(words), pa.binary())]
        numbered.reset()
        seen[:] = 0
        return pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches):
        spelled = spelled_by(raw)
        numbered, seen = Numbered(spelled, np.arange(len(spelled.starts) + 1)), np.zeros(1 << 17, np.int64)
        for batch in batches:
            for group in word_groups(batch.column(0)):
                words = []
                for listed in group:
                    words += (None, *listed, None)
                number = numbered.numbers(words)
                while len(seen) < len(numbered):
                    seen = np.concatenate([seen, np.zeros_like(seen)])
                np.add.at(seen, number, 1)
                yield cut(number, np.array([len(listed) + 2 for listed in group]), numbered)
                if numbered.full():
                    yield counted(numbered, seen)
        yield counted(numbered, seen)

    return docs.select("text").mapInArrow(run, "word binary, n long, ids binary")


def words_of(read: DataFrame, raw: bytes) -> DataFrame:
    """(word, n, ids): all words of texts that were read, and the subword ids of each as int32 bytes."""

    def encode(batches):
        spelled = spelled_by(raw)
        for batch in batches:
            ids = [x.tobytes() for x in spelled.several(batch.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.binary())], names=["word", "n", "ids"])

    counted = read.where(F.col("word").isNotNull()).groupBy("word").agg(F.sum("n").alias("n"))
    return counted.mapInArrow(encode, "word binary, n long, ids binary")


def windows_of(read: DataFrame) -> DataFrame:
    return read.where(F.col("ids").isNotNull()).select("ids")


def count_words(docs: DataFrame, raw: bytes) -> DataFrame:
    """(word, n, ids): all words of all texts and the subword ids of each."""
    return words_of(read_texts(docs, raw), raw)


def _flat(batch):
    """The ids of a batch of words in one array, the count of each, and where words end."""
    column = batch.column(1)
    edges = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1] // 4
    ids = np.frombuffer(column.buffers()[2], np.int32)[edges[0] : edges[-1]]
    last = np.zeros(len(ids), bool)
    last[edges[1:] - edges[0] - 1] = True
    return ids, np.repeat(batch.column(0).to_numpy(), np.diff(edges)), last


def summed_cells(source: DataFrame, cells, size: int) -> np.ndarray:
    """Sums per cell over a whole table; `cells` turns a batch into pairs of cells and weights and `size`
    bounds what reaches the driver."""

    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            if batch.num_rows:
                for at, weight in cells(batch):
                    np.add.at(total, at, weight)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["cell", "n"])

    got = source.mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size)
    out[got["cell"].to_numpy()] = got["n"].to_numpy()
    return out


def subword_counts(words: DataFrame, size: int) -> np.ndarray:
    def cells(batch):
        ids, n, _ = _flat(batch)
        yield ids.astype(np.int64), n

    return summed_cells(words.select("n", "ids"), cells, size)


def next_counts(words: DataFrame, windows: DataFrame, subs: Subwords, row, column, shape) -> np.ndarray:
    """How often `column[next]` comes after `row[last]` in all training texts: within words from
    the counts of all words, between words (the end of a text included) from the windows."""
    size = shape[0] * shape[1]
    begins, adds = (row * shape[1])[subs.input_of].astype(np.int64), column[subs.input_of].astype(np.int64)
    # Between words only; all else goes to a last cell.
    to = np.full(PAD + 1, size)
    to[: len(adds)] = np.where(subs.opens[subs.input_of], adds, size)
    after = np.zeros(PAD + 1, np.int64)
    after[: len(begins)] = begins

    def inside(batch):
        ids, n, last = _flat(batch)
        inner = np.flatnonzero(~last[:-1])
        yield begins[ids[inner]] + adds[ids[inner + 1]], n[inner]

    def between(batch):
        ids = _windows([batch])[0]
        for at in range(0, len(ids), COUNTED_WINDOWS):
            part = ids[at : at + COUNTED_WINDOWS]
            cell = np.take(after, part[:, :-1]) + np.take(to, part[:, 1:])
            yield np.minimum(cell, size, out=cell).ravel(), 1

    found = summed_cells(words.select("n", "ids"), inside, size)
    return (found + summed_cells(windows, between, size + 1)[:size]).reshape(shape)


def training_windows(docs: DataFrame, raw: bytes, subs: Subwords) -> DataFrame:
    """(ids): the runs of all texts, as `read_texts` cuts them; `subs` gives the model's inputs for them."""
    return windows_of(read_texts(docs, raw))


def _windows(batches) -> list[np.ndarray]:
    parts = (b"".join(batch.column(0).to_pylist()) for batch in batches)
    return [np.frombuffer(p, "<u2").reshape(-1, WINDOW + 1) for p in parts if p]


def next_classes(pairs: np.ndarray, firm: float = 20.0) -> np.ndarray:
    """log share of each class after each input, drawn towards the share over all inputs."""
    share = (pairs.sum(0) + 0.5) / (pairs.sum() + 0.5 * pairs.shape[1])
    return np.log((pairs + firm * share) / (pairs.sum(1, keepdims=True) + firm)).astype(np.float32)


def next_shares(after: np.ndarray, subs: Subwords, firm: float = 20.0) -> np.ndarray:
    """log share of each input in its class after each kind of input, drawn towards its share
    in the class as such."""
    classes = subs.class_of_input
    total = np.stack([np.bincount(classes, row, subs.n_classes) for row in after])
    return np.log((after + firm * subs.in_class) / (total[:, classes] + firm)).astype(np.float32)


def _average(parts: DataFrame, keys: list[str]) -> DataFrame:
    def mean(group: pa.Table) -> pa.Table:
        weight = group["weight"].to_numpy()
        rows = np.stack([np.frombuffer(b, np.float32) for b in group["part"].to_pylist()])
        total = (rows * weight[:, None]).sum(0) / weight.sum()
        return pa.table(
            {
                "slice": group["slice"][:1],
                "lot": group["lot"][:1],
                "weight": [float(weight.sum())],
                "part": [total.astype(np.float32).tobytes()],
            }
        )

    return parts.groupBy(*keys).applyInArrow(mean, "slice int, lot int, weight double, part binary")


def train(windows: DataFrame, subs: Subwords, table: np.ndarray) -> dict[str, np.ndarray]:
    """Rounds of descent in parallel over all windows, parameters averaged by transitions seen."""
    p = initial(subs)
    names, shapes = list(p), [x.shape for x in p.values()]
    ends = np.cumsum([x.size for x in p.values()])
    for turn in range(ROUNDS):
        start, rate = p, RATE / (1 + turn)

        def run(batches):
            found = _windows(batches)
            if not found:
                return
            rows = np.concatenate(found)
            rows = rows[np.random.default_rng(turn).permutation(len(rows))]
            own = {n: x.copy() for n, x in start.items()}
            descend(own, table, rows, subs, rate)
            flat = np.concatenate([x.ravel() for x in own.values()]).astype(np.float32)
            lot = zlib.crc32(rows[0].tobytes()) % 64
            cut = np.array_split(flat, SLICES)
            yield pa.RecordBatch.from_pydict(
                {
                    "slice": pa.array(range(SLICES), pa.int32()),
                    "lot": pa.array([lot] * SLICES, pa.int32()),
                    "weight": [float((rows[:, 1:] != PAD).sum())] * SLICES,
                    "part": [c.tobytes() for c in cut],
                }
            )

        parts = windows.mapInArrow(run, "slice int, lot int, weight double, part binary")
        means = _average(_average(parts, ["slice", "lot"]), ["slice"]).collect()
        if not means:
            break
        flat = np.frombuffer(b"".join(bytes(r["part"]) for r in sorted(means, key=lambda r: r["slice"])), np.float32)
        p = {n: x.reshape(s).copy() for n, s, x in zip(names, shapes, np.split(flat, ends[:-1]))}
    return p


def build_scorer(words: DataFrame, windows: DataFrame, subs: Subwords) -> Scorer:
    """Classes, tables and the trained attention.  What is counted on is of a fixed size."""
    inputs = subs.n_inputs
    same = np.arange(inputs)
    frequent = min(CONTEXTS - 1, subs.inputs)
    context = np.minimum(same, frequent)
    # Subwords alike in what stands before them share a class; kinds go by what stands after.
    before = next_counts(words, windows, subs, context, same, (CONTEXTS, inputs)).T
    opens, inner = np.flatnonzero(subs.opens), np.flatnonzero(~subs.opens)
    classes = np.zeros(inputs, np.int64)
    classes[opens] = cluster(before[opens], before[opens].sum(1), OPENING - 1)
    classes[inner] = OPENING + cluster(before[inner], before[inner].sum(1), CLASSES - OPENING)
    classes[subs.end_input] = OPENING - 1
    subs.set_classes(classes, CLASSES)
    pairs = next_counts(words, windows, subs, same, classes, (inputs, CLASSES))
    table = next_classes(pairs)
    kinds = cluster(pairs, pairs.sum(1), FINE)
    after = next_counts(words, windows, subs, kinds, same, (FINE, inputs))
    return Scorer(train(windows, subs, table), table, next_shares(after, subs), kinds, subs)


SCORED = T.StructType(
    [
        T.StructField("row", T.LongType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("held_out", T.BooleanType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("head_known", T.LongType()),
        T.StructField("head_score", T.DoubleType()),
        T.StructField("score", T.DoubleType()),
        # Each occurrence of a word outside the head, with the log terms of its two ways: as a whole
        # but for log(n), and in subwords.
        T.StructField(
            "rare",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("word", T.BinaryType()),
                        T.StructField("whole", T.DoubleType()),
                        T.StructField("spelled", T.DoubleType()),
                    ]
                )
            ),
        ),
    ]
)


def lm_score(
    docs: DataFrame,
    vocabulary_path: str,
    held_out: Column,
    text: str = "text",
    doc_id: str = "doc_id",
    head_words: int = HEAD_WORDS,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Learns from the rows for which `held_out` is false or null.  Tokens are lower-cased words and one
    end; null and empty texts are the end alone.  Repeated rows are learned from and scored
    each; other columns are not read.  With nothing to learn from every class is as likely.
    """
    raw = read_vocabulary(vocabulary_path)
    kind = docs.schema[doc_id].dataType
    source = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text).alias("text")
    )
    training = source.where(~F.col("held_out"))
    read = materialize(read_texts(training, raw), "read")
    words = materialize(words_of(read, raw), "words")
    n_train = training.count()
    sums = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    n_tokens, n_distinct = sums[0] + n_train, sums[1] + (1 if n_train else 0)
    denominator = n_tokens + 0.5 * (n_distinct + 1)

    starts = word_starts(raw)
    subs = Subwords(subword_counts(words, len(starts)), starts)
    scorer = build_scorer(words, windows_of(read), subs)

    # Words by the class of their first subword, the only one that begins with a space.
    first_classes = scorer.class_of_input[subs.input_of[: len(starts)]][starts]
    mass = np.bincount(first_classes, subs.count[: len(starts)][starts], CLASSES)

    # The commonest words, a bounded number of them, go to the tasks with their counts and ids.  Only words that come as
    # often as the last of them are ordered.
    levels = words.groupBy("n").count().orderBy(F.desc("n")).limit(head_words).toArrow()
    above = int((np.cumsum(levels["count"].to_numpy()) < head_words).sum())
    least = levels["n"][min(above, len(levels) - 1)].as_py() if len(levels) else 1
    head = words.where(F.col("n") >= least).orderBy(F.desc("n"), "word").limit(head_words).toArrow().combine_chunks()
    ids = head["ids"].to_pylist()
    known = (
        head["word"].to_pylist(),
        head["n"].to_numpy(),
        np.frombuffer(b"".join(ids), np.int32),
        np.array([len(x) // 4 for x in ids], np.int64),
    )
    shipped = docs.sparkSession.sparkContext.broadcast((known, scorer, subs.input_of.astype(np.uint16), subs.within, mass))
    end_score = math.log10((n_train + 0.5) / denominator)

    def run(batches):
        (known, counts, known_ids, known_sizes), scorer, input_of, within, mass = shipped.value

        class Priced(Numbered):
            """By number, too: the log share of the word's subwords within inputs, its base score and its log
            share in the class of its first subword; for a word outside the head, whose count is
            joined later, -inf and that of a word seen once."""

            def reset(self):
                self.prices = np.zeros((1 << 17, 3))
                super().reset()
                self.prices[0] = 0.0, end_score, 0.0
                if known:
                    self.update(zip(known, range(1, len(known) + 1)))
                    self.learn(known_ids, known_sizes)
                    self.kept = self.size

            def learn(self, ids, size):
                begin = np.cumsum(size) - size
                n = counts.astype(float) if ids is known_ids else np.zeros(len(size))
                base = np.full(len(size), -math.inf)
                np.log10((n + 0.5) / denominator, out=base, where=n > 0)
                first = mass[scorer.class_of_input[input_of[ids[begin]]]]
                whole = np.log(np.maximum(n, 1) / np.maximum(1, first))
                share = np.add.reduceat(within[ids], begin)
                self.prices = grown(self.prices, self.size, np.stack([share, base, whole], 1))
                super().learn(ids, size)

        numbered = Priced(spelled_by(raw), input_of)
        mix = math.log(WHOLE_WEIGHT), math.log(1 - WHOLE_WEIGHT)

        def take(group):
            """Score some texts: the sum of the mixed log probabilities of each one's words of the head, and
            both terms of each other word in order."""
            words = []
            for listed in group:
                words += listed
                words.append(None)
            number = numbered.numbers(words)
            tokens = np.array([len(listed) + 1 for listed in group])
            ends = np.cumsum(tokens)
            text = ends - tokens
            share, base, whole = np.take(numbered.prices, number, 0).T
            common = base > -math.inf
            flat, size = numbered.flat(number)
            begin = np.cumsum(size) - size
            first, each, begins = scorer.score(flat, np.add.reduceat(size, text))
            opened = begins[begin]
            closed = np.r_[opened[1:], 0.0]
            closed[ends - 1] = 0.0  # the end of a text needs no further end
            spelled = mix[1] + np.add.reduceat(each, begin) + share - opened + closed
            whole = mix[0] + first[begin] - opened + whole
            mixed = np.where(common, np.logaddexp(whole, spelled), 0.0)
            base = np.where(common, base, 0.0)
            columns[0].append(tokens)
            columns[1].append(np.add.reduceat(common, text, dtype=np.int64) - (n_train == 0))
            columns[2].append(np.array([base[a:b].sum() for a, b in zip(text.tolist(), ends.tolist())]))
            columns[3].append(np.add.reduceat(mixed, text) / LN10)
            others = np.flatnonzero(~common)
            rare.extend([words[i] for i in others.tolist()])
            terms[0].append(whole[others])
            terms[1].append(spelled[others])
            rare_ends.append(len(rare) - len(others) + np.cumsum(np.add.reduceat(~common, text, dtype=np.int64)))
            if numbered.full():
                numbered.reset()

        for batch in batches:
            columns, terms, rare, rare_ends = [[] for _ in range(4)], ([], []), [], [np.zeros(1, np.int64)]
            for group in word_groups(batch.column(3)):
                take(group)
            if not batch.num_rows:
                continue
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    *(pa.array(np.concatenate(c)) for c in columns),
                    pa.ListArray.from_arrays(
                        pa.array(np.concatenate(rare_ends), pa.int32()),
                        pa.StructArray.from_arrays(
                            [pa.array(rare, pa.binary()), *(pa.array(np.concatenate(t)) for t in terms)],
                            ["word", "whole", "spelled"],
                        ),
                    ),
                ],
                names=SCORED.fieldNames(),
            )

    schema = T.StructType([SCORED[0], T.StructField("doc_id", kind), *SCORED.fields[2:]])
    numbered = source.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text")
    scored = materialize(numbered.mapInArrow(run, schema), "scored")
    rare = scored.select("row", F.inline("rare"))
    share = F.log10((F.coalesce("n", F.lit(0)) + 0.5) / F.lit(denominator))
    # log(exp(whole) + exp(spelled)) for a word that was counted; any other is only spelled.
    whole = F.col("whole") + F.log("n")
    mixed = F.greatest(whole, F.col("spelled")) + F.log1p(F.exp(-F.abs(whole - F.col("spelled"))))
    joined = (
        rare.join(words.select("word", "n"), "word", "left")
        .groupBy("row")
        .agg(
            F.count("n").alias("rare_known"),
            F.sum(share).alias("rare_base"),
            F.sum(F.coalesce(mixed, F.col("spelled")) / LN10).alias("rare_score"),
        )
    )
    return scored.join(joined, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("head_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(n_tokens).cast("long").alias("train_tokens"),
        (F.col("head_score") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("rare_score", F.lit(0.0))).alias("score"),
    )
