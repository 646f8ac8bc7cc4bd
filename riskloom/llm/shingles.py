"""Word shingles of a text as 64-bit hashes, and what derives from them."""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np

from riskloom.llm.fingerprints import mix
from riskloom.llm.texts import segments

#: Words of a shingle, and characters hashed at once.
WORDS, BLOCK = 5, 1 << 18
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)


@lru_cache(maxsize=2)
def _powers(base: int) -> np.ndarray:
    out = np.full(BLOCK, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(text: str) -> np.ndarray:
    """A hash of each word: each run of letters and digits, in lower case."""
    found = [_block_words(part) for part in segments(text.lower(), BLOCK)]
    return np.concatenate(found)


def _block_words(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    inside = np.zeros(len(codes) + 2, np.int8)
    inside[1:-1] = _letters()[codes]
    change = np.diff(inside)
    starts, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    if not len(starts):
        return np.zeros(0, np.uint64)
    powers, inverse = _powers(_BASE), _powers(_INVERSE)
    if len(codes) > BLOCK:
        times = -(-len(codes) // BLOCK)
        powers, inverse = (_longer(p, times, base) for p, base in ((powers, _BASE), (inverse, _INVERSE)))
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes.astype(np.uint64) * powers[:len(codes)], out=sums[1:])
    # A word's own polynomial, whatever its place: the sum over it, shifted back.
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def _longer(powers: np.ndarray, times: int, base: int) -> np.ndarray:
    steps = [np.uint64(pow(base, BLOCK * i, 1 << 64)) for i in range(times)]
    return np.concatenate([powers * step for step in steps])


def shingle_hashes(words: np.ndarray, size: int = WORDS) -> np.ndarray:
    """The distinct shingles, ascending. Fewer words than a shingle form one; no words form none."""
    if not len(words):
        return words
    size = min(size, len(words))
    total = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):
        total = total * np.uint64(_BASE) + words[i:i + len(total)]
    return np.unique(mix(total))


def sequence_digest(words: np.ndarray) -> bytes:
    """128 bits that stand for the whole sequence of words."""
    return hashlib.blake2b(words.tobytes(), digest_size=16).digest()


@lru_cache(maxsize=4)
def _functions(number: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(1)
    return (rng.integers(0, 1 << 63, number, dtype=np.uint64),
            rng.integers(0, 1 << 63, number, dtype=np.uint64) * np.uint64(2) + np.uint64(1))


def sampled_tokens(shingles: np.ndarray, number: int) -> np.ndarray:
    """``number`` shared samples of the set: for each hash function the smallest value (32 bits)."""
    flips, factors = _functions(number)
    least = np.full(number, (1 << 32) - 1, np.uint64)
    for start in range(0, len(shingles), 4096):
        values = ((shingles[start:start + 4096, None] ^ flips) * factors) >> np.uint64(32)
        least = np.minimum(least, values.min(axis=0))
    return least.astype("<u4")
