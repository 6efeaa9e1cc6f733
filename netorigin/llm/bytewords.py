r"""Words `[^\x20\x09-\x0D]+` of whole texts and their 64-bit hashes, straight from the bytes of an Arrow column."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from netorigin.llm.wordhash import FACTOR, mix

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
BASE = 0xD6E8FEB86659FD93  # odd, so it has an inverse
STEP = 1 << 18  # about the bytes that are hashed at once
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    """The first `n` powers of `BASE` and of its inverse."""
    if len(_powers[0]) < n:
        for k, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            step = np.full(n, base, dtype=np.uint64)
            step[0] = 1
            _powers[k] = np.cumprod(step)
    return _powers


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column in a row, and the text bounds in them; a null text has none."""
    column = column.fill_null("").cast(pa.large_string())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, bounds, data = column.buffers()
    edges = np.frombuffer(bounds, dtype=np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return raw[edges[0]:edges[-1]], edges - edges[0]


class Words:
    """Words of the texts of a column: byte bounds, hashes, and the number of the text each is in."""

    def __init__(self, column: pa.Array, lower: bool = False):
        """`lower` takes A-Z as a-z; other letters stay."""
        self.data, self.edges = text_bytes(column)
        if lower:
            self.data = self.data | np.where((self.data >= 65) & (self.data <= 90), np.uint8(32), np.uint8(0))
        inside = ~SPACE[self.data]
        before, after = np.append(False, inside)[:-1], np.append(inside, False)[1:]
        before[self.edges[:-1][self.edges[:-1] < len(inside)]] = False
        after[self.edges[1:][self.edges[1:] > 0] - 1] = False
        self.starts, self.ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.starts, self.edges)  # number of the first word of each text, and the number of all
        self.whose = np.repeat(np.arange(len(self.edges) - 1, dtype=np.int32), np.diff(self.first))
        self.inside = inside

    def hashes(self) -> np.ndarray:
        """A polynomial of each word's bytes, taken from running sums, with its length mixed in."""
        out = np.empty(len(self.starts), dtype=np.uint64)
        at = 0
        while at < len(out):
            low = self.starts[at]
            to = max(at + 1, int(np.searchsorted(self.starts, low + STEP)))
            high = self.ends[to - 1]
            power, inverse = powers(int(high - low))
            run = np.append(np.uint64(0), np.cumsum((self.data[low:high].astype(np.uint64) + np.uint64(1)) * power[:high - low]))
            s, e = self.starts[at:to] - low, self.ends[at:to] - low
            out[at:to] = mix((run[e] - run[s]) * inverse[s] ^ (e - s).astype(np.uint64) * FACTOR)
            at = to
        return out

    def plain(self) -> np.ndarray:
        """Whether a text is its words joined by one space each."""
        gaps = np.append(0, np.cumsum(~self.inside))[self.edges]
        spaces = np.append(0, np.cumsum(self.data == 0x20))[self.edges]
        return (np.diff(gaps) == np.maximum(np.diff(self.first) - 1, 0)) & (np.diff(spaces) == np.diff(gaps))

    def of(self, text: int) -> list[bytes]:
        raw, lo = self.data[self.edges[text]:self.edges[text + 1]].tobytes(), int(self.edges[text])
        a, b = self.first[text], self.first[text + 1]
        return [raw[s - lo:e - lo] for s, e in zip(self.starts[a:b].tolist(), self.ends[a:b].tolist(), strict=True)]


def words_by_block(column: pa.Array, size: int = 1_000_000, lower: bool = False) -> Iterator[tuple[int, Words]]:
    """(first row, words) of runs of rows with about `size` bytes of text each."""
    lengths = np.asarray(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    ends = np.cumsum(lengths)
    while at < len(lengths):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, side="right")))
        yield at, Words(column.slice(at, to - at), lower)
        at = to
