"""Periodic runs of words: stretches that repeat a block of words at least four
times over ("a b a b a b a b"), by an online DP over diagonals.

A run of period q is a stretch in which words q apart are identical, that no
neighbouring word extends, whose smallest period is q and that is at least
``max(LEAST, 4 * q)`` words long. On the diagonal of lag q (word i against word
i - q) it is one unbroken series of matches.

``online_runs`` reads a text's words in order and keeps, for each lag, the
length of the match that ends at the present word. Every earlier occurrence of
the word lengthens the match of its lag by one; a lag that the word does not
match ends there, and its run is emitted at once if it is long enough.

Frequent words have far too many earlier occurrences for that, so ``occurrences``
first leaves out those that belong to no run. Lags are taken in scales
a <= q <= 1.5 a, and at a scale an occurrence counts only if the 3 a words up to
it occurred there too. This loses nothing: a run holds at least 3 q >= 3 a
matches. And as 3 a >= 2 q, such a string of words inside a run of smallest
period q has the smallest period q itself, so its nearest earlier occurrence is
q back. A word therefore has one earlier occurrence per scale, found by sorting
names of word strings (prefix doubling), and the work is n log n whatever the
text: a million equal words are a million matches of lag 1.

Defined results: null, empty and blank texts have no words and no runs; words
are split at ASCII white space (space, tab to carriage return) and compared
byte by byte; a text longer than a batch is handled whole. Rows are independent,
so ties, repeated rows, null ids and an empty table need no rule.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from signalmart.llm.common import text_groups, utf8_parts

#: Words of the shortest run, and repetitions of its period.
LEAST, REPEATS = 6, 4
#: Text handled at a time.
GROUP_BYTES, GROUP_ROWS = 4 << 20, 20_000

RUNS = "struct<n_words: bigint, runs: array<struct<start: bigint, length: bigint, period: bigint>>, collapsed: string>"

_WORD = np.ones(256, bool)
_WORD[[9, 10, 11, 12, 13, 32]] = False


def split_words(raw: np.ndarray, ends: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The words of some rows as one binary array, and the number of the first
    word of each row (rows + 1 of them). ``ends``: row offsets into ``raw``."""
    at = ends[0]
    text = raw[at:ends[-1]]
    inside = _WORD[text]
    first = np.zeros(len(text) + 1, bool)
    first[ends - at] = True  # words never go on across rows
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:-1]
    starts = np.flatnonzero(begins)
    letters = np.concatenate(([0], np.cumsum(inside)))
    offsets = np.append(letters[starts], letters[-1]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [
        None, pa.py_buffer(offsets), pa.py_buffer(text[inside])])
    return words, np.searchsorted(starts, ends - at)


def _repeated(keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places whose key stands at another place too, and small names of
    their keys."""
    _, name, count = np.unique(keys, return_inverse=True, return_counts=True)
    keep = count[name] > 1
    return places[keep], name[keep]


def gram_of(a: int) -> int:
    """Words that must match at the scale that begins with lag ``a``."""
    return 3 * a


def occurrences(codes: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int]]:
    """(word, lag, gram) in order of words: the earlier occurrences that can
    belong to a run. ``codes``: a number for each word; ``bounds``: first word
    of each text."""
    n = len(codes)
    sizes = np.diff(bounds)
    stop = np.repeat(bounds[1:], sizes)  # where each word's text ends
    text = np.repeat(np.arange(len(sizes)), sizes)
    places, name = _repeated(text * (int(codes.max(initial=0)) + 1) + codes, np.arange(n))
    names = np.full(n + 1, -1, np.int64)
    names[places] = name
    width, a, found = 1, 1, []
    longest = int(sizes.max(initial=0))

    def pairs(gap: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of strings of ``gap + width`` words, made of two named ones."""
        p = places[places + gap + width <= stop[places]]
        p = p[names[p + gap] >= 0]
        return names[p] * (n + 1) + names[p + gap], p

    while len(places) and REPEATS * a <= longest:
        gram, b = gram_of(a), a * 3 // 2
        while 2 * width <= gram:
            keys, p = pairs(width)
            places, name = _repeated(keys, p)
            names[:] = -1
            names[places] = name
            width *= 2
        keys, p = pairs(gram - width)
        order = np.argsort(keys, kind="stable")
        keys, p = keys[order], p[order]
        lag = p[1:] - p[:-1]
        near = np.flatnonzero((keys[1:] == keys[:-1]) & (lag >= a) & (lag <= b))
        found.append(np.stack([p[near + 1] + gram - 1, lag[near], np.full(len(near), gram)]))
        a = b + 1
    if not found:
        return []
    every = np.concatenate(found, axis=1)
    return list(zip(*every[:, np.argsort(every[0], kind="stable")].tolist()))


def online_runs(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs, from the earlier occurrences in
    order of words."""
    runs = []
    active: dict[int, tuple[int, int]] = {}  # lag -> (words matched, gram) up to the word before
    now: dict[int, tuple[int, int]] = {}     # and up to the present one
    at = -2

    def end(lag: int, matched: int, gram: int, last: int) -> None:
        length = matched + gram - 1 + lag
        if length >= max(LEAST, REPEATS * lag):
            runs.append((last + 1 - length, length, lag))

    for word, lag, gram in found:
        if word != at:
            for d, m in active.items():
                if d not in now:
                    end(d, *m, at - 1)
            active, now = now, {}
            if word != at + 1:  # words in between match nothing
                for d, m in active.items():
                    end(d, *m, at)
                active = {}
            at = word
        now[lag] = (active[lag][0] + 1 if lag in active else 1, gram)
    for d, m in active.items():
        if d not in now:
            end(d, *m, at - 1)
    for d, m in now.items():
        end(d, *m, at)
    return sorted(runs, key=lambda r: (r[0], r[2]))


def _group(raw: np.ndarray, ends: np.ndarray) -> pa.StructArray:
    """The result struct of some rows."""
    words, bounds = split_words(raw, ends)
    codes = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    runs = np.array(online_runs(occurrences(codes, bounds)), np.int64).reshape(-1, 3)
    # words of a run behind its first period go
    steps = np.zeros(len(words) + 1, np.int64)
    np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
    np.add.at(steps, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(steps)[:-1] == 0)
    rows = pa.LargeListArray.from_arrays(pa.array(np.searchsorted(kept, bounds), pa.int64()),
                                         words.take(pa.array(kept)))
    texts = pc.binary_join(rows, pa.scalar(b" ", pa.large_binary()))
    row = np.searchsorted(bounds, runs[:, 0], side="right") - 1
    lists = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(row, np.arange(len(bounds))), pa.int32()),
        pa.StructArray.from_arrays([pa.array(runs[:, 0] - bounds[row]), pa.array(runs[:, 1]), pa.array(runs[:, 2])],
                                   names=["start", "length", "period"]))
    return pa.StructArray.from_arrays([pa.array(np.diff(bounds)), lists, texts.cast(pa.binary()).view(pa.string())],
                                      names=["n_words", "runs", "collapsed"])


def runs_of(texts: Column) -> Column:
    """``n_words``, ``runs`` (by start, then period) and ``collapsed``, the
    words that stay when every run keeps its first period, joined by one
    space."""
    @F.arrow_udf(RUNS)
    def run(column: pa.Array) -> pa.Array:
        raw, ends = utf8_parts(column)
        parts = [_group(raw, ends[a:b + 1]) for a, b in text_groups(ends, GROUP_BYTES, GROUP_ROWS)]
        return pa.concat_arrays(parts) if parts else _group(raw, ends)

    return run(texts)


def strongest(runs: Column) -> Column:
    """The run of the greatest exact length / period; of equal ones the first
    (least start, then period). Null without runs."""
    def better(best: Column, r: Column) -> Column:
        more = best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
        return F.when(more, r).otherwise(best)

    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    return F.aggregate(runs, none, better)
