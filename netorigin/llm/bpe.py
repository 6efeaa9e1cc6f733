"""Byte-level BPE encoding and decoding on padded numpy matrices.

Distinct pieces of a batch are bucketed by length, each bucket is a matrix of token ids with one piece per row.  In every
round each row merges its leftmost pair of least rank; pair ranks come from an open-addressing hash table, and only the
two pairs beside a merge are looked up anew.  Finished rows leave, and when merging has emptied half the columns the matrix is
compacted to the left.  Nothing is shuffled.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netorigin.llm.columns import blocks
from netorigin.llm.pieces import Pieces

NONE = np.int32(2**31 - 1)
CELLS = 1 << 20  # ids in one matrix


class PairTable:
    """(left id, right id) -> id of their joined bytes, by linear probing of a power-of-two table."""

    def __init__(self, ranks: dict[bytes, int]):
        keys, values = [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    values.append(rank)
        self.bits = max(4, (4 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = np.full(1 << self.bits, NONE, dtype=np.int32)
        k, v = np.array(keys, dtype=np.int64), np.array(values, dtype=np.int32)
        at = self._home(k)
        while len(k):
            free = self.keys[at] == -1
            self.keys[at[free]] = k[free]  # of several for one cell the last stays
            mine = self.keys[at] == k
            self.values[at[mine]] = v[mine]
            k, v, at = k[~mine], v[~mine], (at[~mine] + 1) & ((1 << self.bits) - 1)

    def _home(self, k: np.ndarray) -> np.ndarray:
        return ((k.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Joined ids, `NONE` where the bytes are no token or a side is missing (-1)."""
        k = left.astype(np.int64) << 32 | right.astype(np.int64)
        out = np.full(k.shape, NONE, dtype=np.int32)
        todo = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        flat, k = out.ravel(), k.ravel()[todo]
        at = self._home(k)
        while len(k):
            seen = self.keys[at]
            hit = seen == k
            flat[todo[hit]] = self.values[at[hit]]
            more = ~hit & (seen != -1)
            todo, k, at = todo[more], k[more], (at[more] + 1) & ((1 << self.bits) - 1)
        return flat.reshape(left.shape)


@lru_cache(maxsize=1)
def codec_of(path: str, pattern: str) -> Codec:
    """One codec a Python worker, so its cache lives on from task to task."""
    return Codec(path, pattern)


class Codec:
    """Encoder and decoder of one rank file and split pattern."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.find = regex.compile(pattern).findall
        self.pairs = PairTable(self.ranks)
        self.single = np.array([self.ranks[bytes([i])] for i in range(256)], dtype=np.int32)
        size = max(self.ranks.values()) + 1
        table = [b""] * size
        for token, rank in self.ranks.items():
            table[rank] = token
        self.lengths = np.array([len(t) for t in table], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.pool = np.frombuffer(b"".join(table), dtype=np.uint8)
        self.pieces = Pieces()
        self.decimals: list[str] = []

    def merge(self, rows: list[bytes]) -> list[np.ndarray]:
        """Ids of each row after all merges; the rows share one padded matrix."""
        n, width = len(rows), max(map(len, rows))
        lens = np.array([len(r) for r in rows])
        ids = np.full((n, width + 1), -1, dtype=np.int32)
        mask = np.arange(width + 1) < lens[:, None]
        ids[mask] = self.single[np.frombuffer(b"".join(rows), dtype=np.uint8)]
        out: list[np.ndarray] = [ids[0, :0]] * n
        names = np.arange(n)
        while len(names):
            width = ids.shape[1] - 1
            here = np.arange(width + 1, dtype=np.int32)
            after = np.broadcast_to(np.minimum(here + 1, width), ids.shape).copy()
            before = np.broadcast_to(np.maximum(here - 1, 0), ids.shape).copy()
            rank = np.full(ids.shape, NONE, dtype=np.int32)
            rank[:, :-1] = self.pairs(ids[:, :-1], ids[:, 1:])
            live = np.arange(len(names))
            for _ in range(max(1, width // 2)):
                at = rank[live].argmin(1)
                best = rank[live, at]
                go = best < NONE
                live, at, best = live[go], at[go], best[go]
                if not len(live):
                    break
                gone = after[live, at]
                then = after[live, gone]
                ids[live, at], ids[live, gone] = best, -1
                after[live, at], before[live, then] = then, at
                rank[live, gone] = NONE
                rank[live, at] = self.pairs(best, ids[live, then])
                prev = before[live, at]
                inner = at > 0
                rank[live[inner], prev[inner]] = self.pairs(ids[live[inner], prev[inner]], best[inner])
            done = np.ones(len(names), dtype=bool)
            done[live] = False
            for i in np.flatnonzero(done):
                out[names[i]] = ids[i][ids[i] >= 0]
            ids, names = ids[~done], names[~done]
            if len(names):  # compact to the left
                order = np.argsort(ids < 0, axis=1, kind="stable")
                ids = np.take_along_axis(ids, order, 1)[:, :int((ids >= 0).sum(1).max()) + 1]
        return out

    def learn(self, pieces: list[str]) -> None:
        """Put the ids of new pieces into the cache, bucketed by their length in bytes."""
        raw = [p.encode("utf-8", "surrogatepass") for p in pieces]
        got = [self.ranks.get(r) for r in raw]
        buckets: dict[int, list[int]] = {}
        for i, g in enumerate(got):
            if g is None:
                buckets.setdefault((len(raw[i]) - 1).bit_length(), []).append(i)
        found = [None if g is None else [g] for g in got]
        for bits, rows in buckets.items():
            step = max(1, CELLS >> bits)
            for at in range(0, len(rows), step):
                part = rows[at:at + step]
                for i, ids in zip(part, self.merge([raw[i] for i in part]), strict=True):
                    found[i] = ids.tolist()
        self.pieces.add(pieces, np.array([len(f) for f in found], dtype=np.int64), np.array([x for f in found for x in f], dtype=np.int64))
        self.decimals += [",".join(map(str, f)) for f in found]

    def encode(self, texts: list[str]) -> list[tuple[str, np.ndarray]]:
        """Per text the decimal ids joined by commas, and the ids."""
        split = [self.find(t) for t in texts]
        new = self.pieces.missing(split)
        if not self.pieces.number:
            self.decimals = []
        if new:
            self.learn(new)
        numbers, ids = self.pieces.gather(split)
        return [(",".join(map(self.decimals.__getitem__, n)), i) for n, i in zip(numbers, ids, strict=True)]

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of a row of ids: one gather from the pool of all tokens."""
        n = self.lengths[ids]
        ends = np.cumsum(n)
        if not len(ids):
            return b""
        return self.pool[np.repeat(self.starts[ids] - ends + n, n) + np.arange(ends[-1])].tobytes()


def encode(docs: DataFrame, ranks: str, pattern: str, text: str = "text", doc: str = "doc_id", digests_only: bool = False) -> DataFrame:
    """Per row: doc_id, n_tokens, ids, ids_sha256, decoded_sha256 (of the decoded ids).

    A null or empty text has no ids.  Every row is encoded, so repeated rows give repeated results; other columns are not
    carried.  `digests_only=True` leaves the ids out.
    """
    schema = "doc_id bigint, n_tokens bigint, ids array<int>, ids_sha256 string, decoded_sha256 string"

    def run(batches):
        codec = codec_of(ranks, pattern)
        for b in batches:
            for names, texts in blocks(b):
                got = codec.encode([t or "" for t in texts])
                yield pa.RecordBatch.from_arrays([
                    pa.array(names, pa.int64()),
                    pa.array([len(i) for _, i in got], pa.int64()),
                    pa.array([None if digests_only else i for _, i in got], pa.list_(pa.int32())),
                    pa.array([hashlib.sha256(s.encode()).hexdigest() for s, _ in got], pa.string()),
                    pa.array([hashlib.sha256(codec.decode(i)).hexdigest() for _, i in got], pa.string()),
                ], names=["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"])

    out = docs.select(F.col(doc).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)
    return out.drop("ids") if digests_only else out


def decode(rows: DataFrame, ranks: str, pattern: str, ids: str = "ids") -> DataFrame:
    """`rows` with the bytes of the id array in `decoded`; a null array gives null, ids are kept."""
    @F.pandas_udf("binary")
    def run(column):
        codec = codec_of(ranks, pattern)
        return column.map(lambda x: None if x is None else codec.decode(np.asarray(x, dtype=np.int64)))

    return rows.withColumn("decoded", run(F.col(ids)))
