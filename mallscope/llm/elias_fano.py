"""Elias-Fano sequences and an n-gram trie built of them, in numpy.

A task builds the trie of one shard, maps it from a file and answers sorted
batches of n-grams with vectorised searches.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np

_ONE = np.uint64(1)
SUCCESSOR_BITS = 40     # of a word's hash, kept to tell successors of one context apart


def _pack(low: np.ndarray, width: int) -> np.ndarray:
    """``width`` low bits of each value, one after the other, as bytes."""
    if not width:
        return np.zeros(8, dtype=np.uint8)
    shifts = np.arange(width, dtype=np.uint64)
    parts = [np.packbits(((low[i:i + (1 << 16), None] >> shifts) & _ONE).astype(np.uint8).ravel(), bitorder="little")
             for i in range(0, len(low), 1 << 16)]
    return np.concatenate([*parts, np.zeros(8, dtype=np.uint8)])


class EliasFano:
    """An ascending sequence of unsigned 64-bit integers.

    The low bits are packed; the high parts are a bit vector with a one per
    value, a zero per step, and a directory of every 64th one.
    """

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray, sample: np.ndarray):
        self.n, self.width, self.high, self.sample = n, np.uint64(width), high, sample
        # a 64-bit word at each byte
        self.low = np.ndarray((max(1, low.nbytes - 7),), dtype="<u8", buffer=low, strides=(1,))
        self.mask = np.uint64((1 << width) - 1)

    @staticmethod
    def arrays(values: np.ndarray) -> tuple[int, int, np.ndarray, np.ndarray, np.ndarray]:
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        width = max(0, (top // max(n, 1)).bit_length() - 1)
        width = min(57, width)
        step = (values >> np.uint64(width)).astype(np.int64)
        ones = step + np.arange(n)
        words = np.zeros((int(ones[-1]) // 64 if n else 0) + 2, dtype=np.uint64)
        bits = np.zeros(len(words) * 64, dtype=np.uint8)
        bits[ones] = 1
        words = np.packbits(bits, bitorder="little").view("<u8")
        low = values & np.uint64((1 << width) - 1)
        return n, width, _pack(low, width), words, ones[::64].astype(np.int64)

    def at(self, i: np.ndarray) -> np.ndarray:
        """Values by position."""
        p = self.sample[i >> 6]
        left = (i & 63).astype(np.uint8)
        word = p >> 6
        bits = self.high[word] >> (p & 63).astype(np.uint64) << (p & 63).astype(np.uint64)
        ones = np.bitwise_count(bits)
        more = np.flatnonzero(ones <= left)
        while len(more):
            left[more] -= ones[more]
            word[more] += 1
            bits[more] = self.high[word[more]]
            ones[more] = np.bitwise_count(bits[more])
            more = more[ones[more] <= left[more]]
        place = np.zeros(len(i), dtype=np.uint64)
        for half in (32, 16, 8, 4, 2, 1):       # the left-th one of the word
            lower = bits & np.uint64((1 << half) - 1)
            count = np.bitwise_count(lower)
            up = count <= left
            left = np.where(up, left - count, left)
            bits = np.where(up, bits >> np.uint64(half), lower)
            place += up * np.uint64(half)
        step = (word.astype(np.uint64) << np.uint64(6)) + place - i.astype(np.uint64)
        at = i.astype(np.uint64) * self.width
        low = (self.low[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7))) & self.mask
        return (step << self.width) | low

    def successor(self, begin: np.ndarray, end: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first position in [begin, end) whose value is ``target`` or
        more (``end`` if none), and whether it is the target."""
        step = 1 << 14      # what one round of the search touches stays in the cache
        if len(begin) > step:
            parts = [self.successor(begin[i:i + step], end[i:i + step], target[i:i + step])
                     for i in range(0, len(begin), step)]
            return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        lo, hi = begin.copy(), end.copy()
        equal = np.zeros(len(lo), dtype=bool)
        active = np.flatnonzero(lo < hi)
        while len(active):
            mid = (lo[active] + hi[active]) >> 1
            value = self.at(mid)
            less = value < target[active]
            lo[active[less]] = mid[less] + 1
            stay = ~less
            hi[active[stay]] = mid[stay]
            same = value == target[active]
            equal[active[same]] = True
            # a match needs no further steps: values of a range differ
            lo[active[same]] = mid[same]
            active = active[(lo[active] < hi[active]) & ~same]
        return lo, equal


def quantise(p: np.ndarray) -> np.ndarray:
    """Probabilities in (0, 1] as codes 1 to 255, even steps of the logarithm,
    rounded down; 0 stands for none."""
    with np.errstate(divide="ignore"):
        code = np.floor(np.log2(p) / STEP) + 255
    return np.where(p > 0, np.clip(code, 1, 255), 0).astype(np.uint8)


STEP = 0.125
PROBABILITY = np.concatenate([[0.0], 2.0 ** (STEP * (np.arange(1, 256) - 255))])


class NgramTrie:
    """Contexts, their successors and the successors of those.

    Level 1 holds the keys of first words with exact counts; level 2 their
    successors with the quantised discounted probability of the second word
    and the quantised weight left to the shorter context; level 3 likewise
    the third words' probabilities. A level is one Elias-Fano sequence: the
    values of each context are raised by the last value of the context
    before it, so that a search looks for the context's base plus the word.
    Pointers from level to level are Elias-Fano sequences too. All arrays lie
    in one memory-mapped file that is already unlinked.
    """

    def __init__(self, context: np.ndarray, count1: np.ndarray, parent2: np.ndarray, word2: np.ndarray,
                 count2: np.ndarray, parent3: np.ndarray, word3: np.ndarray, count3: np.ndarray, discount: float):
        """``context`` ascending; (parent2, word2) ascending, parent2 a place in
        ``context``; (parent3, word3) likewise over level 2. Counts over 0."""
        size2 = np.bincount(parent2, minlength=len(context))
        size3 = np.bincount(parent3, minlength=len(word2))
        parts: dict[str, np.ndarray] = {}
        self.meta: dict[str, tuple[int, int]] = {}

        def sequence(name, values):
            n, width, *arrays = EliasFano.arrays(values)
            self.meta[name] = (n, width)
            parts.update(zip((f"{name}.low", f"{name}.high", f"{name}.sample"), arrays, strict=True))

        sequence("context", context)
        for name, sizes, parent, word in (("2", size2, parent2, word2), ("3", size3, parent3, word3)):
            pointer = np.concatenate([[0], np.cumsum(sizes)])
            sequence(f"pointer{name}", pointer)
            full = np.flatnonzero(sizes)
            last = np.zeros(len(sizes), dtype=np.uint64)
            last[full] = word[pointer[full + 1] - 1].astype(np.uint64) + _ONE
            base = np.cumsum(last) - last
            sequence(f"word{name}", base[parent] + word.astype(np.uint64) + _ONE)
        # where each leading 16 bits of a context key begin
        parts["top"] = np.searchsorted(context >> np.uint64(48), np.arange(65537, dtype=np.uint64)).astype(np.int64)
        parts["count1"] = count1.astype(np.int64)
        parts["size2"] = size2.astype(np.int64)
        parts["p2"] = quantise((count2 - discount) / count1[parent2])
        parts["weight2"] = quantise(np.minimum(1, discount * np.maximum(size3, 1) / count2))
        parts["p3"] = quantise((count3 - discount) / count2[parent3]) if len(count3) else np.zeros(0, np.uint8)
        self._map(parts)

    def _map(self, parts: dict[str, np.ndarray]) -> None:
        fd, path = tempfile.mkstemp()
        places, at = {}, 0
        with os.fdopen(fd, "wb") as f:
            for name, a in parts.items():
                places[name] = (at, a.dtype, len(a))
                raw = a.tobytes() + bytes(-a.nbytes % 8)
                f.write(raw)
                at += len(raw)
            f.write(bytes(8))
        mapped = np.memmap(path, dtype=np.uint8, mode="r").view(np.ndarray)
        os.unlink(path)
        arrays = {name: mapped[a:a + n * t.itemsize].view(t) for name, (a, t, n) in places.items()}
        self.bytes = at
        self.levels = {name: EliasFano(n, width, mapped[places[f"{name}.low"][0]:][:places[f"{name}.low"][2]],
                                       arrays[f"{name}.high"], arrays[f"{name}.sample"])
                       for name, (n, width) in self.meta.items()}
        for name in ("top", "count1", "size2", "p2", "weight2", "p3"):
            setattr(self, name, arrays[name])

    def find_contexts(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lead = (keys >> np.uint64(48)).astype(np.int64)
        return self.levels["context"].successor(self.top[lead], self.top[lead + 1], keys)

    def find_words(self, level: str, parent: np.ndarray, sizes: np.ndarray,
                   word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of words, ``sizes`` of them under each node of the level
        above, and whether they are there."""
        pointer, values = self.levels[f"pointer{level}"], self.levels[f"word{level}"]
        begin = pointer.at(parent).astype(np.int64)
        end = pointer.at(parent + 1).astype(np.int64)
        base = np.zeros(len(parent), dtype=np.uint64)
        later = np.flatnonzero((begin > 0) & (begin < end))
        base[later] = values.at(begin[later] - 1)
        return values.successor(np.repeat(begin, sizes), np.repeat(end, sizes),
                                np.repeat(base, sizes) + word.astype(np.uint64) + _ONE)
