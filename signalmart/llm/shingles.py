"""Word shingles of whole texts as sets of 64-bit hashes, in numpy.

Words are runs of bytes other than space and 0x09-0x0D, after lower-casing
A-Z; a shingle is five consecutive words, a shorter text is one shingle of
all its words, and a text without words has the empty set. Word hashes come
from prefix sums of byte values weighted by powers of an odd number, so a
whole stretch of text is hashed without a loop over its words."""

from __future__ import annotations

import hashlib

import numpy as np

WORDS_PER_SHINGLE = 5
SEGMENT = 1 << 20
U = np.uint64

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 2 ** 63, 256, dtype=U)
_lower = np.arange(256)
_lower[65:91] += 32
_BYTE = _BYTE[_lower]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_STEP = U(0xD6E8FEB86659FD93)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, U(base), U)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP = _powers(_BASE, SEGMENT + 1)
_DOWN = _powers(pow(_BASE, -1, 2 ** 64), SEGMENT + 1)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> U(33))
    h = h * U(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U(33))
    h = h * U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U(33))


def _segment_words(raw: np.ndarray) -> np.ndarray:
    space = _SPACE[raw]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    bounds = np.concatenate(([0] if not space[0] else [], edge, [len(raw)] if not space[-1] else [])).astype(np.int64)
    starts, stops = bounds[0::2], bounds[1::2]
    total = np.zeros(len(raw) + 1, U)
    np.cumsum(_BYTE[raw] * _UP[:len(raw)], out=total[1:])
    return mix((total[stops] - total[starts]) * _DOWN[starts] + (stops - starts).astype(U))


def word_hashes(raw: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word of one text, in order. Long texts are
    hashed a segment at a time; a segment ends after white space where there
    is any, and a word longer than a segment counts by its pieces' hashes."""
    out, at = [], 0
    while at < len(raw):
        stop = min(at + SEGMENT, len(raw))
        if stop < len(raw):
            gaps = np.flatnonzero(_SPACE[raw[at:stop]])
            if len(gaps):
                stop = at + int(gaps[-1]) + 1
            else:  # one word fills the segment
                rest = np.flatnonzero(_SPACE[raw[stop:]])
                end = stop + int(rest[0]) if len(rest) else len(raw)
                out.append(np.array([_long_word(raw[at:end])], U))
                at = end
                continue
        out.append(_segment_words(raw[at:stop]))
        at = stop
    return np.concatenate(out) if out else np.zeros(0, U)


def _long_word(raw: np.ndarray) -> int:
    lower = _lower.astype(np.uint8)[raw].tobytes()
    return int.from_bytes(hashlib.blake2b(lower, digest_size=8).digest(), "little")


def shingle_set(raw: np.ndarray) -> np.ndarray:
    """The sorted distinct shingle hashes of one text."""
    words = word_hashes(raw)
    n = len(words)
    if n == 0:
        return words
    size = min(n, WORDS_PER_SHINGLE)
    total = words[:n - size + 1].copy()
    for k in range(1, size):
        total *= _STEP
        total += words[k:n - size + 1 + k]
    return np.unique(mix(total + U(size)))


def set_key(shingles: np.ndarray) -> bytes:
    """A 128-bit key of a set."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def overlap_counts(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Sizes of the intersection and the union of two sorted sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both, len(a) + len(b) - both
