"""Elias-Fano sequences, and an n-gram trie of any order laid out in them.

A rising sequence keeps the low bits of each value packed and the high bits in unary, about 2 + log2(universe / n) bits a
value. Each level lies in a memory map; nothing is unpacked to be searched.
"""

from __future__ import annotations

import mmap
from dataclasses import dataclass

import numpy as np

U64 = np.uint64
#: Fixed-point steps of a quantised log10.
STEPS = 4096


def _bits(n: int) -> np.uint64:
    return U64((1 << n) - 1)


_ONES, _TOPS = U64(0x0101010101010101), U64(0x8080808080808080)
#: Place of the nth set bit (from 0) of a byte, at 256 * n + byte.
_IN_BYTE = np.array([([i for i in range(8) if byte >> i & 1] + [0] * 8)[n] for n in range(8) for byte in range(256)], dtype=np.uint8)


def _select(words: np.ndarray, nth: np.ndarray) -> np.ndarray:
    """Place of the nth set bit (from 1) of each 64-bit word: by the set bits up to each of its bytes, side by side in one number."""
    k = (nth - 1).astype(U64)
    sums = words - ((words >> U64(1)) & U64(0x5555555555555555))
    sums = (sums & U64(0x3333333333333333)) + ((sums >> U64(2)) & U64(0x3333333333333333))
    sums = ((sums + (sums >> U64(4))) & U64(0x0F0F0F0F0F0F0F0F)) * _ONES
    before = ((k * _ONES) | _TOPS) - sums  # the top bit of a byte stays where its sum does not exceed k
    place = np.bitwise_count(before & _TOPS).astype(U64) << U64(3)
    rank = k - (((sums << U64(8)) >> place) & U64(0xFF))
    byte = (words >> place) & U64(0xFF)
    return (place + _IN_BYTE[((rank << U64(8)) | byte).astype(np.int64)]).astype(np.int64)


def _blocks(n: int) -> list[slice]:
    """Places in blocks, so that what is worked out for each stays small."""
    return [slice(lo, min(n, lo + (1 << 17))) for lo in range(0, n, 1 << 17)]


@dataclass
class EliasFano:
    """`n` rising values. low: packed low bits; high: unary high bits; ones: set bits of `high` before each of its words."""

    n: int
    width: int
    low: np.ndarray
    high: np.ndarray
    ones: np.ndarray

    @classmethod
    def build(cls, values: np.ndarray, universe: int) -> EliasFano:
        """`values`: unsigned, rising (equal neighbours allowed), below `universe`."""
        n = len(values)
        width = max(0, (universe // max(n, 1)).bit_length() - 1)
        low = np.zeros((n * width >> 6) + 2, dtype=U64)
        high = np.zeros((((int(values[-1]) >> width) + n - 1 if n else 0) >> 6) + 2, dtype=U64)
        for at in _blocks(n):
            part = values[at].astype(U64)
            at = np.arange(at.start, at.stop, dtype=np.int64)
            if width:
                bits, bit = part & _bits(width), at * width
                word, off = bit >> 6, (bit & 63).astype(U64)
                np.bitwise_or.at(low, word, bits << off)
                over = (bit & 63) + width > 64
                np.bitwise_or.at(low, word[over] + 1, bits[over] >> (U64(64) - off[over]))
            place = (part >> U64(width)).astype(np.int64) + at
            np.bitwise_or.at(high, place >> 6, U64(1) << (place & 63).astype(U64))
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high), dtype=np.int64)]).astype(np.uint32)
        return cls(n, width, low, high, ones)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), dtype=U64)
        bit = i * self.width
        word, off = bit >> 6, (bit & 63).astype(U64)
        value = self.low[word] >> off
        over = (bit & 63) + self.width > 64
        value[over] |= self.low[word[over] + 1] << (U64(64) - off[over])
        return value & _bits(self.width)

    def get(self, i: np.ndarray) -> np.ndarray:
        """Values by place."""
        word = np.searchsorted(self.ones, i, side="right") - 1
        place = (word << 6) + _select(self.high[word], i - self.ones[word].astype(np.int64) + 1)
        return ((place - i).astype(U64) << U64(self.width)) | self._low(i)

    def _bucket(self, top: np.ndarray) -> np.ndarray:
        """How many values have high bits less than `top`: the set bits before the zero that ends the bucket before."""
        words = len(self.high)
        zeros = (np.arange(words + 1) << 6) - self.ones.astype(np.int64)
        known = np.minimum(top, int(zeros[-1]))
        word = np.clip(np.searchsorted(zeros, known, side="left") - 1, 0, words - 1)
        place = (word << 6) + _select(~self.high[word], known - zeros[word])
        out = np.where(known > 0, place - known + 1, 0)
        return np.minimum(np.where(top > int(zeros[-1]), self.n, out), self.n)

    def _buckets(self, top: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the first value with high bits `top` and of the one after the last: the set bits behind the zero that ends
        the bucket before are counted where they lie."""
        lo = self._bucket(top)
        place = lo + top
        word, off = np.minimum(place >> 6, len(self.high) - 1), (place & 63).astype(U64)
        zeros = ~(self.high[word] >> off) & (~U64(0) >> off)
        run = np.bitwise_count((zeros & -zeros) - U64(1)).astype(np.int64)
        on = np.flatnonzero((zeros == 0) | (place >> 6 != word))  # a bucket that goes on into the next word
        stop = np.minimum(lo + run, self.n)
        stop[on] = self._bucket(top[on] + 1)
        return lo, stop

    def find(self, x: np.ndarray, begin: np.ndarray | int = 0, end: np.ndarray | None = None) -> np.ndarray:
        """Place of each value, -1 where there is none; among the places from `begin` to before `end` if given. Values of the
        sequence within a bucket are distinct."""
        out = np.full(len(x), -1, dtype=np.int64)
        if not self.n:
            return out
        for at in _blocks(len(x)):
            out[at] = self._find(x[at], begin if np.isscalar(begin) else begin[at], None if end is None else end[at])
        return out

    def _find(self, x: np.ndarray, begin: np.ndarray | int, end: np.ndarray | None) -> np.ndarray:
        out = np.full(len(x), -1, dtype=np.int64)
        limit = int(self.high.size) * 64
        top = np.minimum(x >> U64(self.width), U64(limit)).astype(np.int64)
        lo, hi = self._buckets(top)
        lo, hi = np.maximum(lo, begin), hi if end is None else np.minimum(hi, end)
        left = np.flatnonzero(lo < hi)
        lo, hi, want = lo[left], hi[left], x[left] & _bits(self.width)
        while len(left):
            mid = (lo + hi) >> 1
            low = self._low(mid)
            same, less = low == want, low < want
            out[left[same]] = mid[same]
            lo, hi = np.where(less, mid + 1, lo), np.where(less, hi, mid)
            go = np.flatnonzero((lo < hi) & ~same)
            left, lo, hi, want = left[go], lo[go], hi[go], want[go]
        return out

    def arrays(self) -> list[np.ndarray]:
        return [self.low, self.high, self.ones]


def _mapped(parts: list[np.ndarray]) -> list[np.ndarray]:
    """The arrays, moved into one memory map."""
    sizes = [-(-a.nbytes // 8) * 8 for a in parts]
    room = mmap.mmap(-1, max(8, sum(sizes)))
    views, at = [], 0
    for a, size in zip(parts, sizes):
        view = np.frombuffer(room, dtype=a.dtype, count=len(a), offset=at)
        view[:] = a
        views.append(view)
        at += size
    return views


@dataclass
class Level:
    """The n-grams of one order, by the n-gram they lengthen (their context) and their last word.

    pointer: where the successors of each context start. words: the last words, each run of successors on top of the last
    word of the run before, so that all of them rise; what a run stands on is the value before it. code: quantised log10 of
    each n-gram's discounted probability. total, weight: what follows each context, and the quantised log10 of the share that
    it leaves to its own last words.
    """

    words: EliasFano
    pointer: EliasFano
    code: np.ndarray
    total: np.ndarray
    weight: np.ndarray


class Trie:
    """N-grams by their first words: rising keys of these, the vocabulary of the others, and a level for each order."""

    def __init__(self, roots: np.ndarray, words: np.ndarray, discount: float):
        """`roots`, `words`: distinct keys, rising."""
        self.size, self.discount, self.levels = max(1, len(words)), discount, []
        self.roots, self.words = EliasFano.build(roots, 1 << 64), EliasFano.build(words, 1 << 64)
        for level in (self.roots, self.words):
            level.low, level.high, level.ones = _mapped(level.arrays())

    def grow(self, keys: np.ndarray, count: np.ndarray) -> None:
        """One level more: counts of n-grams, each named by the place of its context times the size of the vocabulary and
        the place of its word; in any order, and in parts."""
        before = self.levels[-1].words.n if self.levels else self.roots.n
        order = np.argsort(keys)
        keys = keys[order]
        new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
        count = np.add.reduceat(count[order].astype(np.int64), new) if len(new) else np.zeros(0, dtype=np.int64)
        keys = keys[new]
        del order, new
        context, word = (keys // U64(self.size)).astype(np.int32), (keys % U64(self.size)).astype(np.int32)
        del keys
        many, total = np.bincount(context, minlength=before), np.bincount(context, count, before)
        code = np.empty(len(word), dtype=np.uint16)
        for at in _blocks(len(word)):
            code[at] = quantised((count[at] - self.discount) / total[context[at]])
        del count
        weight = np.zeros(before, dtype=np.uint16)
        weight[many > 0] = quantised(self.discount * many[many > 0] / total[many > 0])
        starts = np.concatenate([[0], np.cumsum(many)])
        # Each run of successors stands on the last value of the run before, and one more.
        top = np.cumsum(word[starts[1:][many > 0] - 1].astype(np.int64) + 1)
        stands = np.zeros(before, dtype=np.int64)
        stands[many > 0] = np.concatenate([[0], top[:-1]]) if len(top) else 0
        values = stands[context]
        values += word
        del context, word, stands
        rising = EliasFano.build(values, int(top[-1]) + 1 if len(top) else 1)
        del values
        level = Level(rising, EliasFano.build(starts, len(code) + 1), code, total.astype(U64), weight)
        parts = _mapped([*level.words.arrays(), *level.pointer.arrays(), code, level.total, weight])
        for i, part in enumerate((level.words, level.pointer)):
            part.low, part.high, part.ones = parts[3 * i : 3 * i + 3]
        level.code, level.total, level.weight = parts[6:]
        self.levels.append(level)

    def contexts(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(count, number of successors) of each first word, by its place; 0 for -1."""
        count, many = np.zeros(len(place), dtype=np.int64), np.zeros(len(place), dtype=np.int64)
        known = np.flatnonzero(place >= 0)
        at, level = place[known], self.levels[0]
        count[known] = level.total[at]
        many[known] = (level.pointer.get(at + 1) - level.pointer.get(at)).astype(np.int64)
        return count, many

    def find(self, nth: int, context: np.ndarray, many: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Places in the nth level of words (by place, -1 if unknown) after contexts (the same), `many` words after each: the
        search stays between the pointers of the context. -1 where the context or the word after it was never seen."""
        level, out = self.levels[nth], np.full(len(word), -1, dtype=np.int64)
        begin, end, stands = np.zeros((3, len(context)), dtype=np.int64)
        known = np.flatnonzero((context >= 0) & (many > 0))
        if not level.words.n or not len(known):
            return out
        at = context[known].astype(np.int64)
        begin[known], end[known] = level.pointer.get(at), level.pointer.get(at + 1)
        later = known[begin[known] > 0]
        stands[later] = level.words.get(begin[later] - 1).astype(np.int64) + 1
        of = np.repeat(np.arange(len(context), dtype=np.int32), many)
        asked = np.flatnonzero((word >= 0) & (begin < end)[of])
        of = of[asked]
        out[asked] = level.words.find((word[asked] + stands[of]).astype(U64), begin[of], end[of])
        return out


def quantised(chance: np.ndarray) -> np.ndarray:
    """Codes from 1 for chances over 1e-15."""
    return np.minimum(np.rint(-np.log10(chance) * STEPS) + 1, (1 << 16) - 1).astype(np.uint16)


def chances(codes: np.ndarray) -> np.ndarray:
    """What quantised codes stand for; 0 for code 0."""
    return np.where(codes > 0, 10.0 ** ((1 - codes.astype(np.float64)) / STEPS), 0.0)
