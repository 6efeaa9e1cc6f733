"""Packing of documents into fixed token windows by sum-of-squares online placement.

Each task packs the documents it scans: nothing is shuffled, a lost task is packed again from its input split.  A level
array counts the partly filled windows of every fill level; a piece goes to the level that makes the sum of the squared
counts smallest, ties to the fullest window.  Documents of a window or more give whole windows first and place the rest.
When a task ends, the windows that are still open are emptied into each other, cutting pieces, and the last one is cut at
powers of two, so no id of padding is left.  Open windows are the only state: the rule keeps their count about
the square root of the documents seen, and their ids are a few bytes each.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netorigin.llm.columns import blocks
from netorigin.llm.pieces import Pieces

CAPACITY = 2048
END_ID = 1
SCHEMA = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids array<int>"
CACHED = 2_000_000  # chunks remembered in a worker, and a quarter as many parts of chunks
PLAIN = re.compile(r"[!-&(-~À-ÖØ-öø-ÿ]+")  # each is its own canonical form; an apostrophe may begin a contraction
PART = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
SHOWN = {b: 256 + i for i, b in enumerate([*range(33), *range(127, 161), 173])}  # byte-level models show these bytes as characters from 256 on
FLUSH_IDS = 500_000
CHUNK = re.compile(r"[^\x20\x09-\x0D]+")


@lru_cache(maxsize=1)
def encoder_of(path: str, remembered: int) -> Encoder:
    """One encoder a Python worker, so its cache lives on from task to task."""
    return Encoder(path, remembered)


class Encoder:
    """Ids of whole texts by the tokenizer file, special tokens written in a text included, as the library has them.

    The tokenizer drops white space before it merges, so a text's ids are those of its space-free chunks in a row; each
    distinct chunk is encoded once while it stays in the cache.
    """

    def __init__(self, path: str, remembered: int = CACHED):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.remembered = remembered
        self.pieces = Pieces(remembered)
        self.parts: dict[str, list[int]] = {}

    def encode(self, chunks: list[str]) -> list[list[int]]:
        return [self.by_parts(c) if PLAIN.fullmatch(c) and "<|" not in c else self.tokenizer.encode(c, add_special_tokens=False).ids for c in chunks]

    def by_parts(self, chunk: str) -> list[int]:
        """A chunk of common characters is lower-cased and cut as the tokenizer does it, so that a word is merged once whatever signs follow it."""
        if len(self.parts) > self.remembered // 4:
            self.parts.clear()
        out: list[int] = []
        for p in PART.findall(chunk.lower()):
            ids = self.parts.get(p)
            if ids is None:
                shown = p if p.isascii() else p.encode().decode("latin-1").translate(SHOWN)
                ids = self.parts[p] = [t.id for t in self.model.tokenize(shown)]
            out += ids
        return out

    def __call__(self, texts: list[str | None], end: int = END_ID) -> list[np.ndarray]:
        return [np.append(ids, end).astype("<u4") for ids in self.pieces.ids_of([chunks(t or "") for t in texts], self.encode)]


def chunks(text: str) -> list[str]:
    """Space-free chunks.  Python also splits at the four separators below space, which are no white space for the tokenizer; other white space is the same.

    The tokenizer lower-cases, so chunks differ less when plain text is lower-cased first; its special tokens are looked for before that.
    """
    if "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text:
        return CHUNK.findall(text)
    return text.lower().split() if text.isascii() and "<|" not in text else text.split()


class Packer:
    """Windows of `capacity` ids; `piece` = (doc, start, ids, doc length); closed windows are lists of pieces."""

    def __init__(self, capacity: int = CAPACITY):
        self.capacity = capacity
        self.levels = np.zeros(capacity + 1, dtype=np.int64)  # partly filled windows of each level
        self.open: dict[int, list[list[tuple]]] = {}

    def _level(self, size: int) -> int:
        """The level, 0 for a new window, that `size` ids join at the smallest sum of squares."""
        room = self.capacity - size
        n = self.levels
        cost = 2 * n[size:room + size + 1] + 1  # the count of the level reached rises
        cost[room] = 0  # a full window is partly filled no more
        cost -= 2 * n[:room + 1] - 1  # the count of the level left falls
        cost[1:][n[1:room + 1] == 0] = np.iinfo(np.int64).max
        cost[0] = 2 * n[size] + 1 if size < self.capacity else 0
        return room - int(np.argmin(cost[::-1]))

    def add(self, doc, ids: np.ndarray) -> Iterator[list[tuple]]:
        whole, total = len(ids) // self.capacity * self.capacity, len(ids)
        for at in range(0, whole, self.capacity):
            yield [(doc, at, ids[at:at + self.capacity], total)]
        if whole == total:
            return
        piece = (doc, whole, ids[whole:].copy(), total)
        size = total - whole
        level = self._level(size)
        window = [] if not level else self.open[level].pop()
        self.levels[level] -= level > 0
        window.append(piece)
        if level + size == self.capacity:
            yield window
        else:
            self.levels[level + size] += 1
            self.open.setdefault(level + size, []).append(window)

    def finish(self) -> Iterator[list[tuple]]:
        """Fill the fullest windows with pieces of the emptiest, cutting where one ends; the remainder by powers of two."""
        rest = [(level, w) for level in sorted(self.open) for w in self.open[level]]
        spare: list[tuple] = []
        while rest:
            level, window = rest.pop()
            while level < self.capacity and (spare or rest):
                if not spare:
                    spare = rest.pop(0)[1]
                doc, at, ids, total = spare.pop()
                take = min(len(ids), self.capacity - level)
                window.append((doc, at, ids[:take], total))
                level += take
                if take < len(ids):
                    spare.append((doc, at + take, ids[take:], total))
            if level == self.capacity:
                yield window
            else:
                spare = window[::-1]
        left = sum(len(p[2]) for p in spare)
        while left:
            size, window = min(1 << (left.bit_length() - 1), self.capacity), []
            left -= size
            while size:
                doc, at, ids, total = spare.pop()
                take = min(len(ids), size)
                window.append((doc, at, ids[:take], total))
                size -= take
                if take < len(ids):
                    spare.append((doc, at + take, ids[take:], total))
            yield window
        self.open, self.levels[:] = {}, 0


def pack(docs: DataFrame, tokenizer: str, text: str = "text", doc: str = "doc_id", capacity: int = CAPACITY, keep_ids: bool = True,
         remembered: int = CACHED) -> DataFrame:
    """One row per piece: its document, place and ids, and its place in a window.

    A null or empty text is the end id alone.  Rows are packed one by one, so repeated ids or texts are packed as often
    as they occur; a null id stays null.  Other columns are not carried.  `sequence_id` is unique over the table: the
    task's number above 33 bits of its own count.  `keep_ids=False` leaves the id arrays out.  `remembered` bounds the chunks that a worker
    keeps (some 200 bytes each); it changes no result.
    """
    def run(batches):
        encoder, packer = encoder_of(tokenizer, remembered), Packer(capacity)
        base, count, held, rows = TaskContext.get().partitionId() << 33, 0, 0, []

        def flush():
            nonlocal held
            held = 0
            cols = list(zip(*rows, strict=True)) or [[]] * 8
            rows.clear()
            kinds = [pa.int64()] * 7 + [pa.list_(pa.int32())]
            return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(cols, kinds, strict=True)],
                                              names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])

        def lay(window):
            nonlocal count, held
            at = 0
            for d, start, ids, total in window:
                rows.append((d, start, len(ids), zlib.crc32(ids.tobytes()), total, base + count, at, ids.astype(np.int32) if keep_ids else None))
                at += len(ids)
            count += 1
            held += at if keep_ids else 0

        for b in batches:
            for names, texts in blocks(b):
                for d, ids in zip(names, encoder(texts), strict=True):
                    for w in packer.add(d, ids):
                        lay(w)
                    if len(rows) > 5_000 or held > FLUSH_IDS:
                        yield flush()
        for w in packer.finish():
            lay(w)
            if len(rows) > 5_000 or held > FLUSH_IDS:
                yield flush()
        yield flush()

    out = docs.select(F.col(doc).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, SCHEMA)
    return out if keep_ids else out.drop("ids")
