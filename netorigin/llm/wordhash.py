"""64-bit word hashes and hashes of word runs, in numpy."""

from __future__ import annotations

import re

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LIMIT = 100_000
FACTOR = np.uint64(0x9E3779B97F4A7C15)


class Hashes(dict):
    """word -> hash; remembers up to `LIMIT` words."""

    def __missing__(self, word: str) -> int:
        h = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        if len(self) < LIMIT:
            self[word] = h
        return h

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


KNOWN = Hashes()  # one a Python worker


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def runs(codes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of `n` codes, in order; empty when there are fewer."""
    if len(codes) < n:
        return codes[:0]
    out = codes[:len(codes) - n + 1].copy()
    for i in range(1, n):
        out = mix(out) + codes[i:len(codes) - n + 1 + i] * FACTOR
    return mix(out)
