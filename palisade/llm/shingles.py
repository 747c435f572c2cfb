"""Word shingles of whole texts as sets of 64-bit hashes, and their MinHash signatures."""

from __future__ import annotations

import numpy as np

from palisade.llm.common import mix, word_hashes

PERMUTATIONS = 64
_random = np.random.default_rng(11)
_MULTIPLY = _random.integers(0, 2**31, PERMUTATIONS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _random.integers(0, 2**32, PERMUTATIONS, dtype=np.uint32)
_PLACE = _random.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """For each text the distinct hashes of its runs of `width` lower-cased words, ascending.

    With fewer words the whole sequence is one shingle; without a word the set is empty.
    """
    code, words = word_hashes([(t or "").encode("utf-8", "surrogatepass") for t in texts])
    out, at = [], 0
    total = np.zeros(max(0, len(code) - width + 1), np.uint64)
    for k in range(width if len(total) else 0):
        total += code[k : len(code) - width + 1 + k] * _PLACE[k]
    total = mix(total + np.uint64(width))
    for n in words.tolist():
        if n >= width:
            out.append(np.unique(total[at : at + n - width + 1]))
        elif n:
            # A short sequence differs from any longer one: its length takes part.
            short = (code[at : at + n] * _PLACE[:n]).sum(dtype=np.uint64) + np.uint64(n)
            out.append(mix(np.array([short], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash signatures (texts x PERMUTATIONS); every set has a member at least."""
    flat = np.concatenate(sets)
    high, low = (flat >> np.uint64(32)).astype(np.uint32), flat.astype(np.uint32)
    sizes = np.array([len(s) for s in sets])
    begin = np.cumsum(sizes) - sizes
    out = np.empty((len(sets), PERMUTATIONS), np.uint32)
    for p in range(PERMUTATIONS):
        mixed = (high ^ _ADD[p]) * _MULTIPLY[p] + low
        mixed ^= mixed >> np.uint32(15)
        out[:, p] = np.minimum.reduceat(mixed * _MULTIPLY[p - 1], begin)
    return out
