"""SentencePiece encoding and decoding with a batched numpy Viterbi.

A text becomes words (a run of blanks, written as the piece alphabet's blank
mark, and what follows it); no piece crosses a word's start, so words are
encoded on their own and each distinct word of a batch once. Words of equal
length advance together, one character position at a time: the substrings
that end there are hashed, the hashes probe the sorted keys of all pieces,
and a vectorised maximum over the candidates' scores picks the piece whose
start is stored as backpointer.

What a candidate scores depends on the model's kind. For a unigram model it
is the best score up to its start plus its own. The public vocabularies at
hand are byte-pair models, which do not maximise a sum: a piece may follow
another only if merging their two texts in the order of the ranks gives
exactly these two pieces, and a segmentation is the model's own if and only
if each neighbouring pair is so. There a candidate scores 1 if it may follow
the best last piece at its start and 0 if not, and one candidate scores 1 at
each position.

Characters without a piece become their UTF-8 bytes' pieces. Decoding joins
the pieces, turns blank marks to blanks and drops the blank put in front.

Defined results: null or empty text has no pieces and decodes to the empty
text. A text that itself holds the blank mark decodes with a blank there, as
the format prescribes; ``exact`` says whether decoding gave the text back.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from signalmart.llm.common import text_groups, utf8_parts

MARK = "▁"
_RAW = re.compile("[\udc80-\udcff]")
_MEMO = 300_000
#: Bytes of text whose new words are encoded together.
TOGETHER = 1 << 22
_SIEVE = _SLOTS = 1 << 20
U = np.uint64
#: Words longer than this are cut where no piece can reach across.
_LONG = 32
#: Words of more characters are encoded by themselves, their candidates in blocks.
_ALONE, _LONG_BLOCK = 1_000, 1 << 16
_STEP = np.uint64(0x9E3779B97F4A7C15)

ENCODED = "struct<ids: array<int>, exact: boolean, decoded_sha256: string>"


def read_model(path: str) -> dict:
    """Pieces, scores and kind of a model file (bounded: the vocabulary)."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    kind = "bpe" if all(sp.get_score(i) == int(sp.get_score(i)) for i in range(n)) else "unigram"
    special = [i for i in range(n) if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)]
    return {"pieces": [sp.id_to_piece(i) for i in range(n)], "scores": [sp.get_score(i) for i in range(n)],
            "bytes": {int(sp.id_to_piece(i)[3:5], 16): i for i in range(n) if sp.is_byte(i)},
            "special": special, "kind": kind, "unknown": sp.unk_id()}


def _merge(text: str, rank: dict[str, float], without: str) -> list[str]:
    """Byte-pair merging of a short text, never to the piece ``without``: the
    best pair first, the leftmost of equal ones."""
    symbols = list(text)
    while len(symbols) > 1:
        best = min(((rank[a + b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:]))
                    if a + b in rank and a + b != without), default=None)
        if best is None:
            break
        i = best[1]
        symbols[i:i + 2] = [symbols[i] + symbols[i + 1]]
    return symbols


@dataclass
class Encoder:
    """The tables of a model, built from read_model()."""
    model: dict

    def __post_init__(self):
        m = self.model
        normal = [i for i in range(len(m["pieces"])) if i not in set(m["special"]) | set(m["bytes"].values())]
        self.text = {i: m["pieces"][i] for i in normal}
        self.blank = next((i for i in normal if m["pieces"][i] == MARK), -1)
        self.runs = {p: i for i, p in self.text.items() if set(p) == {MARK}}
        inner = {i: p for i, p in self.text.items() if set(p) != {MARK} or p == MARK}
        self.rank = {p: -m["scores"][i] for i, p in self.text.items()}
        # raw bytes from 0x80 up are shown as surrogates until decode() joins them
        self.shown = [self.text.get(i, "") for i in range(len(m["pieces"]))]
        for b, i in m["bytes"].items():
            self.shown[i] = chr(b) if b < 128 else chr(0xDC00 + b)
        self.longest = max((len(p) for p in inner.values()), default=1)
        self.touching = {p[k:k + 2] for p in inner.values() for k in range(len(p) - 1)}
        # a word ends before a sign too, unless a piece reaches from its last letter to a sign
        letters = {a for a, b in self.touching if re.match(r"\w", a) and not re.match(rf"[\w{MARK}]", b)}
        stop = f"(?<![{re.escape(''.join(sorted(letters)))}])" if letters else ""
        self.words = re.compile(f"{MARK}*\\w+{stop}(?=[^\\w{MARK}])|{MARK}*[^{MARK}]+|{MARK}+")
        keys = {}
        for i, p in inner.items():
            keys[self._hash_text(p)] = i
        order = sorted(keys)
        self.keys = np.array(order, np.uint64)
        self.ids = np.array([keys[k] for k in order], np.int64)
        self.maybe = np.zeros(_SIEVE, bool)  # spares most probes that find nothing
        self.maybe[self.keys % np.uint64(_SIEVE)] = True
        self.score = np.array(m["scores"], float)
        if m["kind"] == "bpe":
            self._pair_tables(inner)
        self._forget()
        self.run_memo: dict[int, list[int]] = {}
        self.pair_memo: dict[int, bool] = {}
        self.lists = None

    def _forget(self) -> None:
        """Empty the memo: word -> place of its pieces in ``store``."""
        self.memo: dict[str, int] = {}
        self.store, self.used = np.zeros(1 << 16, np.int32), 0
        self.starts, self.counts = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def _remember(self, words: list[str], flat: np.ndarray, count: np.ndarray) -> None:
        n, k = len(words), len(self.memo)
        while self.used + len(flat) > len(self.store):
            self.store = np.concatenate([self.store, np.zeros_like(self.store)])
        while k + n > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.counts = np.concatenate([self.counts, np.zeros_like(self.counts)])
        self.store[self.used:self.used + len(flat)] = flat
        self.starts[k:k + n] = self.used + np.cumsum(count) - count
        self.counts[k:k + n] = count
        self.used += len(flat)
        self.memo.update(zip(words, range(k, k + n)))

    @staticmethod
    def _hash_text(p: str) -> int:
        h = 0
        for c in p:
            h = (h * int(_STEP) + ord(c) + 1) & (2 ** 64 - 1)
        return h

    def _pair_tables(self, inner):
        """For the pair test: of each piece its last merge (left, right), and
        the pieces that two neighbours can merge to. Pieces are renumbered by
        rank, single characters first."""
        m = self.model
        number = {p: i for i, p in inner.items()}
        order = sorted(inner, key=lambda i: (len(inner[i]) > 1, -m["scores"][i], i))
        self.level = np.full(len(m["pieces"]) + 1, -1, np.int64)
        self.level[order] = np.arange(len(order))
        self.left = np.arange(len(order), dtype=np.int64)
        self.right = np.arange(len(order), dtype=np.int64)
        pairs: dict[tuple[int, int], int] = {}
        whole = np.zeros(len(order), bool)
        for level, i in enumerate(order):
            p = inner[i]
            if len(p) == 1:
                whole[level] = True
                continue
            halves = [(p[:k], p[k:]) for k in range(1, len(p)) if p[:k] in number and p[k:] in number]
            for a, b in halves:
                pairs[int(self.level[number[a]]), int(self.level[number[b]])] = level
            # the two symbols that are left before the last merge
            last = _merge(p, self.rank, p)
            if len(last) == 2 and all(x in number for x in last):
                whole[level] = True
                self.left[level] = self.level[number[last[0]]]
                self.right[level] = self.level[number[last[1]]]
        self.whole = whole
        width = len(order)
        found = sorted((a * width + b, c) for (a, b), c in pairs.items())
        self.pair_keys = np.array([k for k, _ in found], np.int64)
        self.pair_level = np.array([c for _, c in found], np.int64)
        self.width = width
        self.met, self.apart = np.full(_SLOTS, -1, np.int64), np.zeros(_SLOTS, bool)

    def _follows(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether piece b may follow piece a; pairs met before are looked up
        in a table of fixed size."""
        key = a * self.width + b
        slot = ((key.view(U) * _STEP) >> U(65 - _SLOTS.bit_length())).astype(np.int64)
        out = self.apart[slot]
        new = np.flatnonzero(self.met[slot] != key)
        if len(new):
            keys, first, back = np.unique(key[new], return_index=True, return_inverse=True)
            found = self._merges_apart(a[new][first], b[new][first])
            out[new] = found[back]
            spot, one = np.unique(slot[new][first], return_index=True)  # one pair a slot
            self.met[spot], self.apart[spot] = keys[one], found[one]
        return out

    def _merges_apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the texts of pieces a and b (levels) leaves just a
        and b. The merges that built them are undone from the latest on: none
        may be later than a merge across the border would have been."""
        a, b = a.copy(), b.copy()
        limit = np.full(len(a), np.iinfo(np.int64).max)
        out = np.ones(len(a), bool)
        live = np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            at = np.searchsorted(self.pair_keys, x * self.width + y)
            at[at == len(self.pair_keys)] = 0
            joint = np.where(self.pair_keys[at] == x * self.width + y, self.pair_level[at], np.iinfo(np.int64).max) \
                if len(self.pair_keys) else np.full(len(live), np.iinfo(np.int64).max)
            clash = joint < limit[live]
            out[live[clash]] = False
            live, x, y = live[~clash], x[~clash], y[~clash]
            # undo the later of the two last merges; a tie is undone on the
            # right first, for the left one was merged first
            x_last = np.where(self.left[x] != x, x, -1)
            y_last = np.where(self.left[y] != y, y, -1)
            none = (x_last < 0) & (y_last < 0)
            live, x, y, x_last, y_last = (v[~none] for v in (live, x, y, x_last, y_last))
            in_x = x_last > y_last
            limit[live] = np.where(in_x, x_last, y_last + 1)
            a[live] = np.where(in_x, self.right[x], x)
            b[live] = np.where(in_x, y, self.left[y])
        return out

    def _equal_length(self, words: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
        """Encode words of one length together."""
        n = len(words)
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(n, size).astype(np.uint64)
        bpe = self.model["kind"] == "bpe"
        best = np.full((n, size + 1), -np.inf)
        best[:, 0] = 0
        piece = np.full((n, size + 1), -1, np.int64)  # last piece; -1: none has the character
        back = np.zeros((n, size + 1), np.int64)
        for stop in range(1, size + 1):
            h, factor = np.zeros(n, np.uint64), np.ones(1, np.uint64)
            top = np.full(n, -1.0 if bpe else -np.inf)
            lone = np.ones(n, bool)
            for length in range(1, min(stop, self.longest) + 1):
                start = stop - length
                h = h + (chars[:, start] + np.uint64(1)) * factor
                factor = factor * _STEP
                hit = np.flatnonzero(self.maybe[h & np.uint64(_SIEVE - 1)])
                at = np.searchsorted(self.keys, h[hit])
                at[at == len(self.keys)] = 0
                sure = self.keys[at] == h[hit]
                hit, at = hit[sure], at[sure]
                if not len(hit):
                    continue
                ids = self.ids[at]
                if bpe:
                    level = self.level[ids]
                    score = self.whole[level].astype(float)
                    if start:
                        before = piece[hit, start]
                        known = before >= 0  # after a character without a piece anything may follow
                        test = known & (score > 0)
                        score[test] = self._follows(self.level[before[test]], level[test])
                else:
                    score = best[hit, start] + self.score[ids]
                better = score > top[hit]
                rows = hit[better]
                top[rows] = score[better]
                piece[rows, stop] = ids[better]
                back[rows, stop] = start
                if length == 1:
                    lone[hit] = False
            # no piece for the character itself and none that ends here
            alone = piece[:, stop] < 0
            back[alone, stop] = stop - 1
            best[:, stop] = 0 if bpe else np.where(alone, best[:, stop - 1] + self.score.min() - 10, top)
        return self._trace(words, size, piece, back)

    def _candidates(self, chars: np.ndarray, first: int, last: int):
        """(stop, length, id) of the pieces that end behind characters ``first``
        to ``last`` of a word, by stop, then length."""
        stops = np.arange(first + 1, last + 1)
        h, factor, found = np.zeros(len(stops), np.uint64), np.ones(1, np.uint64), []
        for length in range(1, min(last, self.longest) + 1):
            inside = stops >= length
            h[inside] += (chars[stops[inside] - length] + np.uint64(1)) * factor
            factor = factor * _STEP
            hit = np.flatnonzero(inside & self.maybe[h & np.uint64(_SIEVE - 1)])
            at = np.searchsorted(self.keys, h[hit])
            at[at == len(self.keys)] = 0
            sure = self.keys[at] == h[hit]
            hit, at = hit[sure], at[sure]
            found.append(np.stack([stops[hit], np.full(len(hit), length), self.ids[at]]))
        every = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
        return every[:, np.lexsort((every[1], every[0]))]

    def _apart(self, a: int, b: int) -> bool:
        """``_merges_apart`` of one pair, with what was found kept."""
        key = a * self.width + b
        known = self.pair_memo.get(key)
        if known is None:
            if len(self.pair_memo) >= _MEMO:
                self.pair_memo.clear()
            limit, known = np.iinfo(np.int64).max, True
            left, right, pairs, width = self.lists
            while True:
                joint = pairs.get(a * width + b)
                if joint is not None and joint < limit:
                    known = False
                    break
                x, y = (a if left[a] != a else -1), (b if left[b] != b else -1)
                if x < 0 and y < 0:
                    break
                if x > y:
                    limit, a = x, right[a]
                else:
                    limit, b = y + 1, left[b]
            self.pair_memo[key] = known
        return known

    def _long(self, word: str) -> tuple[np.ndarray, np.ndarray]:
        """Encode one long word: the pieces that may stand in it are looked up
        for all its characters together, and only these are gone through in
        order, by the rules of ``_equal_length``."""
        size = len(word)
        chars = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64)
        bpe = self.model["kind"] == "bpe"
        if bpe and self.lists is None:
            self.lists = (self.left.tolist(), self.right.tolist(),
                          dict(zip(self.pair_keys.tolist(), self.pair_level.tolist())), self.width)
        level, whole = (self.level.tolist(), self.whole) if bpe else (None, None)
        score, unknown = self.score, float(self.score.min()) - 10
        piece, back, best = [-1] * (size + 1), [0] * (size + 1), [0.0] * (size + 1)
        for first in range(0, size, _LONG_BLOCK):
            last = min(first + _LONG_BLOCK, size)
            done = first
            for stop, length, i in self._candidates(chars, first, last).T.tolist():
                while done < stop:  # the characters before that end no piece
                    done += 1
                    back[done], best[done] = done - 1, 0.0 if bpe else best[done - 1] + unknown
                    top = -1.0 if bpe else -np.inf
                start = stop - length
                if bpe:
                    value = float(whole[level[i]])
                    if value and start and piece[start] >= 0:
                        value = float(self._apart(level[piece[start]], level[i]))
                else:
                    value = best[start] + score[i]
                if value > top:
                    top, piece[stop], back[stop] = value, i, start
                    best[stop] = 0.0 if bpe else value
            while done < last:
                done += 1
                back[done], best[done] = done - 1, 0.0 if bpe else best[done - 1] + unknown
        return self._trace([word], size, np.array([piece], np.int64), np.array([back], np.int64))

    def _trace(self, words, size, piece, back) -> tuple[np.ndarray, np.ndarray]:
        """Follow the backpointers of all words at once, last piece first:
        the words' ids one after the other, and how many each has."""
        n = len(words)
        rows, stop = np.arange(n), np.full(n, size)
        last, count = np.full((n, size), -2, np.int64), np.zeros(n, np.int64)
        for column in range(size - 1, -1, -1):
            last[rows, column] = piece[rows, stop]
            count[rows] += 1
            stop = back[rows, stop]
            rows, stop = rows[stop > 0], stop[stop > 0]
            if not len(rows):
                break
        odd = np.flatnonzero((last == -1).any(axis=1))
        if not len(odd):
            return last[last > -2], count
        spelled = {}  # a character without a piece becomes its bytes' pieces
        for row in odd.tolist():
            ids, at = [], 0
            for p in last[row, size - count[row]:].tolist():
                ids += [p] if p >= 0 else self._bytes(words[row][at])
                at += len(self.text[p]) if p >= 0 else 1
            spelled[row] = ids
        plain = np.ones(n, bool)
        plain[odd] = False
        whole = last[plain]
        whole = whole[whole > -2]
        own = count[plain]
        count[odd] = [len(x) for x in spelled.values()]
        starts = np.cumsum(count) - count
        flat = np.empty(int(count.sum()), np.int64)
        flat[np.repeat(starts[plain] - np.cumsum(own) + own, own) + np.arange(len(whole))] = whole
        for row, ids in spelled.items():
            flat[starts[row]:starts[row] + len(ids)] = ids
        return flat, count

    def _bytes(self, text: str) -> list[int]:
        return [self.model["bytes"].get(b, self.model["unknown"]) for b in text.encode("utf-8", "replace")]

    def _blanks(self, n: int) -> list[int]:
        """Pieces of n blank marks with nothing to join on the right: equal
        ranks, so pairs merge from the left and each result at once tries its
        left neighbour."""
        if n not in self.run_memo:
            if self.model["kind"] == "bpe":
                done: list[int] = []
                left = n
                while left:
                    run, left = 1, left - 1
                    while True:
                        if done and MARK * (done[-1] + run) in self.runs and run > 1:
                            run += done.pop()
                        elif left and MARK * (run + 1) in self.runs:
                            run, left = run + 1, left - 1
                        else:
                            break
                    done.append(run)
            else:
                top = max((len(p) for p in self.runs), default=1)
                done = [top] * (n // top) + ([n % top] if n % top else [])
            self.run_memo[n] = [self.runs.get(MARK * d, self.blank) for d in done]
        return self.run_memo[n]

    def _cut(self, word: str) -> list[str]:
        """A long word in parts between which no piece reaches."""
        if len(word) <= _LONG:
            return [word]
        at = [k for k in range(1, len(word)) if word[k - 1:k + 1] not in self.touching]
        return [word[a:b] for a, b in zip([0, *at], [*at, len(word)])]

    def learn(self, words) -> None:
        """Encode words that are not in the memo yet."""
        plain: dict[int, list[str]] = {}
        split: dict[str, tuple[int, list[str]]] = {}
        for word in words:
            if len(word) <= _LONG and word[1:2] != MARK and word != MARK:
                plain.setdefault(len(word), []).append(word)
                continue
            bare = word.lstrip(MARK)
            marks = len(word) - len(bare)
            split[word] = marks, self._cut((MARK if marks else "") + bare) if bare else []
        done: dict[str, list[int]] = {}
        parts: dict[int, set[str]] = {}
        for part in chain.from_iterable(own for _, own in split.values()):
            parts.setdefault(len(part), set()).add(part)
        for size, group in parts.items():
            for some, flat, count in self._batches(sorted(group), size):
                ends = np.cumsum(count)
                done.update((w, flat[e - c:e].tolist()) for w, e, c in zip(some, ends, count))
        for size, group in plain.items():
            for some, flat, count in self._batches(group, size):
                self._remember(some, flat, count)
        for word, (marks, own) in split.items():
            ids = list(chain.from_iterable(done[p] for p in own))
            if marks > 1 or not own:  # blanks before the word's own
                lone = not ids or ids[0] == self.blank
                ids = self._blanks(marks) + ids[1:] if lone else self._blanks(marks - 1) + ids
            self._remember([word], np.array(ids, np.int64), np.array([len(ids)]))

    def _batches(self, group: list[str], size: int):
        if size > _ALONE:
            for word in group:
                yield [word], *self._long(word)
            return
        step = max(1, 200_000 // size)
        for k in range(0, len(group), step):
            yield group[k:k + step], *self._equal_length(group[k:k + step], size)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; the texts' new words are encoded together. A very
        long text is taken in parts that begin with a word's blanks."""
        if any(len(text) > TOGETHER for text in texts):
            return [np.concatenate([x for part in self._parts(MARK + text.replace(" ", MARK))
                                    for x in self._encode([part])] or [np.zeros(0, np.int32)]) if text
                    else np.zeros(0, np.int32) for text in texts]
        return self._encode([MARK + text.replace(" ", MARK) if text else "" for text in texts])

    @staticmethod
    def _parts(text: str):
        at = 0
        while at < len(text):
            stop = len(text)
            if stop - at > TOGETHER:
                found = re.compile(f"(?<=[^{MARK}]){MARK}").search(text, at + TOGETHER // 2)
                stop = found.start() if found else stop
            yield text[at:stop]
            at = stop

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.memo) > _MEMO:
            self._forget()
        split = [self.words.findall(text) for text in texts]
        self.learn({w for words in split for w in words if w not in self.memo})
        out = []
        for words in split:
            at = np.fromiter(map(self.memo.__getitem__, words), np.int64, len(words))
            count = self.counts[at]
            ends = np.cumsum(count)
            place = np.repeat(self.starts[at] - ends + count, count)
            out.append(self.store[place + np.arange(len(place))])
        return out

    def decode(self, ids) -> str:
        text = "".join(map(self.shown.__getitem__, ids)).replace(MARK, " ")
        if not text.isprintable() and _RAW.search(text):
            text = text.encode("utf-8", "surrogateescape").decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


_ENCODERS: dict[int, Encoder] = {}


def _encoder(model: dict) -> Encoder:
    """One encoder per Python worker and model."""
    key = hash((len(model["pieces"]), model["kind"], tuple(model["pieces"][:64]), tuple(model["pieces"][-64:])))
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(model)
    return _ENCODERS[key]


def encoded(text: Column, model: dict) -> Column:
    """Of each text its ids, the SHA-256 of what they decode to, and exact
    (that is the text). One pass: a second Python operator over the ids would
    hold another worker and another copy of them."""
    @F.arrow_udf(ENCODED)
    def run(column: pa.Array) -> pa.Array:
        coder = _encoder(model)
        lists, exact, digests = [], [], []
        for a, b in text_groups(utf8_parts(column)[1], TOGETHER):
            texts = [column[i].as_py() or "" for i in range(a, b)]
            ids = coder.encode(texts)
            lists += ids
            for x, text in zip(ids, texts):
                back = coder.decode(x.tolist())
                exact.append(back == text)
                digests.append(hashlib.sha256(back.encode("utf-8")).hexdigest())
        ends = np.cumsum([0] + [len(x) for x in lists]).astype(np.int32)
        flat = np.concatenate(lists) if lists else np.zeros(0, np.int32)
        return pa.StructArray.from_arrays(
            [pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32())), pa.array(exact, pa.bool_()),
             pa.array(digests, pa.string())], names=["ids", "exact", "decoded_sha256"])

    return run(text)


def decoded(ids: Column, model: dict) -> Column:
    """The text of each array of ids (null: the empty text)."""
    @F.arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        coder = _encoder(model)
        ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy())])
        flat = column.flatten().to_numpy()
        return pa.array([coder.decode(flat[a:b].tolist()) for a, b in zip(ends, ends[1:])], pa.string())

    return run(ids)
