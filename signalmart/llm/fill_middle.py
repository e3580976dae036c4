"""Fill-in-middle: a text is cut in prefix, middle and suffix, and written with
the middle last, so that a model learns to fill a gap from both sides.

    psm    <P>prefix<S>suffix<M>middle
    spm    <S>suffix<P>prefix<M>middle
    plain  the text itself

Texts lie in memory as UTF-8, cuts are asked for in lines or code points and
reported in code points. A sparse exception index converts between the two
(``ExceptionIndex``): it records only the multibyte characters, where each
begins and how many bytes it takes beyond one, summed up. Between exceptions
bytes and code points differ by a constant, so a binary search for the last
exception before a cut and one subtraction convert it, and ASCII text, which
has no exceptions, is pure arithmetic. A batch of texts shares one index.

Defined results: null text counts as the empty text; empty texts and those that
hold a sentinel stay plain, with null lengths (``restored`` could not tell them
apart otherwise); a null id counts as '' in the draws. Lines end with their
line feed, the last one may lack it; other line ends are ordinary characters.
A text is never split over rows or cut short, however long. Rows are independent
of each other: ties and repeated rows give equal results, an empty table none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from signalmart.llm.common import text_groups, utf8_parts

#: FIXED VALUES: the sentinels in front of prefix, suffix and middle.
SENTINELS = PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Percentages of texts that are rearranged, and of these that put the suffix first.
RATE, SPM_RATE = 100, 50
UNITS = ("lines", "chars")
#: Text handled at a time.
GROUP_BYTES, GROUP_ROWS = 8 << 20, 20_000

CUT = "struct<n: bigint, form: string, prefix_chars: bigint, middle_chars: bigint, output: string>"


class ExceptionIndex:
    """Converts places in UTF-8 bytes to places in code points and back. Places
    lie between characters, from 0 to the length."""

    def __init__(self, raw: np.ndarray):
        heads = np.flatnonzero(raw >= 0xC0)
        more = 1 + (raw[heads] >= 0xE0).astype(np.int64) + (raw[heads] >= 0xF0)
        #: byte behind each multibyte character's first one, and excess bytes up to its end
        self.behind = heads + 1
        self.excess = np.concatenate(([0], np.cumsum(more)))
        #: the same place in code points
        self.points = self.behind - self.excess[:-1]

    def to_points(self, places: np.ndarray) -> np.ndarray:
        return places - self.excess[np.searchsorted(self.behind, places, side="right")]

    def to_bytes(self, points: np.ndarray) -> np.ndarray:
        return points + self.excess[np.searchsorted(self.points, points, side="right")]


def draws(doc_id: Column, seed: int, count: int = 4) -> list[Column]:
    """Unsigned 32-bit numbers from the id: the first groups of eight digits of
    the SHA-256 of ``seed:id``."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digits = F.sha2(key.cast("binary"), 256)
    return [F.conv(F.substring(digits, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(count)]


def _has(raw: np.ndarray, ends: np.ndarray, mark: bytes) -> np.ndarray:
    """Which rows hold the mark."""
    n = len(raw) - len(mark) + 1
    hit = np.ones(max(n, 0), bool)
    for k, byte in enumerate(mark):
        hit &= raw[k:k + n] == byte
    places = np.flatnonzero(hit)
    row = np.searchsorted(ends, places, side="right") - 1
    out = np.zeros(len(ends) - 1, bool)
    out[row[places + len(mark) <= ends[row + 1]]] = True
    return out


def _group(raw: np.ndarray, ends: np.ndarray, h: list[np.ndarray], unit: str, rate: int, spm_rate: int) -> pa.StructArray:
    """The result struct of some rows. ``ends``: row offsets into ``raw``."""
    at, raw = ends[0], raw[ends[0]:ends[-1]]
    ends = ends - at
    rows = len(ends) - 1
    first, last = ends[:-1], ends[1:]
    index = ExceptionIndex(raw)
    base = index.to_points(ends)
    if unit == "lines":
        feeds = np.flatnonzero(raw == 10) + 1
        before = np.searchsorted(feeds, ends, side="right")  # line feeds in front of each row's end
        full = np.diff(before)
        open_end = (last > first) & ~np.isin(last, feeds)
        n = full + open_end

        def place(k: np.ndarray) -> np.ndarray:
            """The byte behind unit k of each row."""
            inside = np.append(feeds, 0)[np.minimum(before[:-1] + np.maximum(k, 1) - 1, len(feeds))]
            return np.where(k == 0, first, np.where(k > full, last, inside))
    else:
        n = np.diff(base)

        def place(k: np.ndarray) -> np.ndarray:
            return index.to_bytes(base[:-1] + k)

    u, v = (h[k].astype(np.int64) % (n + 1) for k in (0, 1))
    cut = [first, place(np.minimum(u, v)), place(np.maximum(u, v)), last]
    marked = np.zeros(rows, bool)
    for mark in SENTINELS:
        marked |= _has(raw, ends, mark.encode())
    plain = (first == last) | marked | (h[2] % 100 >= rate)
    spm = h[3] % 100 < spm_rate
    points = [index.to_points(c) for c in cut]

    data, out = memoryview(raw), []
    p, s, m = (x.encode() for x in SENTINELS)
    for i, (a, b, c, d) in enumerate(zip(*(x.tolist() for x in cut))):
        if plain[i]:
            out.append(bytes(data[a:d]))
        elif spm[i]:
            out.append(b"".join((s, data[c:d], p, data[a:b], m, data[b:c])))
        else:
            out.append(b"".join((p, data[a:b], s, data[c:d], m, data[b:c])))
    return pa.StructArray.from_arrays([
        pa.array(n, pa.int64()),
        pa.array(np.where(plain, "plain", np.where(spm, "spm", "psm")).tolist(), pa.string()),
        pa.array(points[1] - points[0], pa.int64(), mask=plain),
        pa.array(points[2] - points[1], pa.int64(), mask=plain),
        pa.array(out, pa.binary()).view(pa.string())],
        names=["n", "form", "prefix_chars", "middle_chars", "output"])


def rearranged(text: Column, doc_id: Column, seed: int = 7, unit: str = "lines", rate: int = RATE,
               spm_rate: int = SPM_RATE) -> Column:
    """``n`` (units of the text), ``form``, ``prefix_chars``, ``middle_chars``
    (code points) and ``output``. The cuts, whether a text is rearranged and in
    which form follow from the id and the seed alone."""
    if unit not in UNITS:
        raise ValueError(f"unit is one of {UNITS}")

    @F.arrow_udf(CUT)
    def run(texts: pa.Array, a: pa.Array, b: pa.Array, c: pa.Array, d: pa.Array) -> pa.Array:
        raw, ends = utf8_parts(texts)
        h = [np.asarray(x.fill_null(0)) for x in (a, b, c, d)]
        parts = [_group(raw, ends[i:j + 1], [x[i:j] for x in h], unit, rate, spm_rate)
                 for i, j in text_groups(ends, GROUP_BYTES, GROUP_ROWS)]
        return pa.concat_arrays(parts) if parts else _group(raw, ends, h, unit, rate, spm_rate)

    return run(text, *draws(doc_id, seed))


def restored(output: Column, form: Column) -> Column:
    """The text from its output and form, in SQL functions. Rearranged texts
    hold no sentinel of their own, so the three found are the ones put in."""
    part = F.split(output, "<[PSM]>", -1)
    return (F.when(form == "psm", F.concat(F.get(part, F.lit(1)), F.get(part, F.lit(3)), F.get(part, F.lit(2))))
            .when(form == "spm", F.concat(F.get(part, F.lit(2)), F.get(part, F.lit(3)), F.get(part, F.lit(1))))
            .otherwise(output))
