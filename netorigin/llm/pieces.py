"""A bounded cache of encoded pieces of text, kept in flat arrays."""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain, repeat

import numpy as np

LIMIT = 1_000_000


class Pieces:
    """piece -> number, and the ids of all numbered pieces in one row."""

    def __init__(self, limit: int = LIMIT):
        self.limit = limit
        self.number: dict[str, int] = {}
        self.ids = np.zeros(0, dtype=np.int32)
        self.ends = np.zeros(1, dtype=np.int64)
        self.older: tuple[dict[str, int], np.ndarray, np.ndarray] = ({}, self.ids, self.ends)

    def missing(self, split: list[list[str]]) -> list[str]:
        new = set().union(*split).difference(self.number)
        if len(self.number) > self.limit:
            self.__init__(self.limit)
            new = set().union(*split)
        return sorted(new)

    def add(self, pieces: list[str], lengths: np.ndarray, ids: np.ndarray) -> None:
        at = len(self.number)
        self.number.update(zip(pieces, range(at, at + len(pieces)), strict=True))
        self.ids = np.concatenate([self.ids, ids.astype(np.int32)])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(lengths)])

    def gather(self, split: list[list[str]]) -> tuple[list[list[int]], list[np.ndarray]]:
        """Per text the numbers of its pieces and its ids."""
        numbers = [[*map(self.number.__getitem__, ps)] for ps in split]
        out = []
        for n in numbers:
            k = np.array(n, dtype=np.int64)
            size = self.ends[k + 1] - self.ends[k]
            stop = np.cumsum(size)
            out.append(self.ids[np.repeat(self.ends[k] - stop + size, size) + np.arange(stop[-1] if len(k) else 0)])
        return numbers, out

    def ids_of(self, split: list[list[str]], encode: Callable[[list[str]], list[list[int]]]) -> list[np.ndarray]:
        """Per text the ids of its pieces; `encode` gives those of pieces that are not numbered yet.  All texts are looked up at once.

        Half of the limit is for a younger generation; when it is full it becomes the older one, from which pieces that occur again are taken back.
        """
        if len(self.number) > self.limit // 2:
            older = (self.number, self.ids, self.ends)
            self.__init__(self.limit)
            self.older = older
        words = [*chain.from_iterable(split)]
        k = np.fromiter(map(self.number.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        if len(unknown := np.flatnonzero(k < 0)):
            new = sorted({words[i] for i in unknown.tolist()})
            known, ids, ends = self.older
            again = [known.get(w, -1) for w in new]
            fresh = iter(encode([w for w, i in zip(new, again, strict=True) if i < 0]))
            got = [next(fresh) if i < 0 else ids[ends[i]:ends[i + 1]].tolist() for i in again]
            self.add(new, np.fromiter(map(len, got), dtype=np.int64, count=len(got)), np.fromiter(chain.from_iterable(got), dtype=np.int64))
            k[unknown] = [self.number[words[i]] for i in unknown.tolist()]
        size = self.ends[k + 1] - self.ends[k]
        stop = np.cumsum(size)
        ids = self.ids[np.repeat(self.ends[k] - stop + size, size) + np.arange(stop[-1] if len(k) else 0)]
        edge = np.append(0, stop)[np.cumsum([0, *map(len, split)])].tolist()
        return [ids[a:b] for a, b in zip(edge[:-1], edge[1:], strict=True)]
