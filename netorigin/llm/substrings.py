"""Substring dedup: windows of 13 words that start in an earlier document are removed.

A suffix of a text is known by the 64-bit hash of its first 13 words, the depth that matters.  Suffixes are dealt by a prefix of variable length, up to the first
word that is not frequent: no such prefix has more suffixes than that word has places, at most one in `FREQUENT / 2`.  Prefixes are dealt to memory-sized
groups; a group sorts its suffixes and reads the repeats off equal neighbours, as the leaves below a node of depth 13 would lie.  Two windows are taken for equal when
their hashes and their groups are; the words are not compared.  Consecutive repeated windows make up the maximal repeats, which are given as spans.

Documents are dealt to batches by a hash of their id and text.  A batch sends each distinct window once with the least document id that has it, so a window that
is common in the corpus costs a group one entry a batch.  The group tells a batch the windows that a smaller id of another batch has: they go wherever they are
in the batch.  The others are settled in the batch, where the least id keeps a window.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netorigin.llm.bytewords import Words, words_by_block
from netorigin.llm.columns import parts
from netorigin.llm.wordhash import mix, runs
from netorigin.operators.lineage import cut

WINDOW = 13
BATCH_BYTES = 6_000_000
GROUP_WINDOWS = 1_000_000
FREQUENT = 8_192  # a word with more than one in so many places is frequent; at most so many words are
LAST = np.iinfo(np.int64).max  # stands for a null id, which owns nothing


def planes(x: np.ndarray) -> bytes:
    """Numbers byte by byte from the lowest: high bytes that are nearly all zero compress away."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(8, -1).T).view("<u8").ravel()


def pack_sorted(x: np.ndarray) -> bytes:
    """Ascending numbers as differences."""
    return planes(np.diff(x, prepend=np.uint64(0)))


def unpack_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(from_planes(raw), dtype=np.uint64)


def frequent_words(docs: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """Hashes of frequent words, and the number of words.

    A task reports the words that are frequent in it; a word frequent in all of the corpus is frequent in some task, and what the other
    tasks leave out is less than the share looked for, so every word with twice the share is found.  At most `FREQUENT` pass.
    """
    def run(batches):
        codes, counts, total = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0
        for b in batches:
            for _, words in words_by_block(b.column("text")):
                c = words.hashes()
                total += len(c)
                u, n = np.unique(c, return_counts=True)
                codes, inverse = np.unique(np.concatenate([codes, u]), return_inverse=True)
                counts = np.bincount(inverse, weights=np.concatenate([counts, n]), minlength=len(codes)).astype(np.int64)
        often = counts * FREQUENT > total
        yield pa.RecordBatch.from_arrays([pa.array([None, *codes[often].view(np.int64).tolist()], pa.int64()),
                                          pa.array([total, *counts[often].tolist()], pa.int64())], names=["word", "n"])

    got = cut(docs.select(F.lit(0).alias("k"), F.col(text).alias("text")).mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")))
    total = got.agg(F.sum(F.when(F.col("word").isNull(), F.col("n")))).first()[0] or 0
    words = got.filter(F.col("word").isNotNull() & (F.col("n") * FREQUENT > total)).select("word").collect()
    return np.sort(np.array([r[0] for r in words], dtype=np.int64).view(np.uint64)), total


def prefix_group(codes: np.ndarray, frequent: np.ndarray, groups: int) -> np.ndarray:
    """Group of the suffix at every place that has a whole window: by its words up to the first that is not frequent."""
    n = len(codes) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    at = np.searchsorted(frequent, codes)
    common = np.append(frequent, np.uint64(0))[at] == codes if len(frequent) else np.zeros(len(codes), dtype=bool)
    stop = np.where(common, len(codes), np.arange(len(codes)))
    stop = np.minimum.accumulate(stop[::-1])[::-1][:n]
    depth = np.minimum(stop - np.arange(n), WINDOW - 1)
    prefix = codes[:n].copy()
    go = np.flatnonzero(depth)
    for d in range(1, WINDOW):
        prefix[go] = mix(prefix[go]) + codes[go + d]
        go = go[depth[go] > d]
        if not len(go):
            break
    return (mix(prefix) % np.uint64(groups)).astype(np.int64)


def windows_of(words: Words, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows: hash, number of the text, and whether the window at each place lies in one text (the others are left out)."""
    inside = words.whose[WINDOW - 1:] == words.whose[:max(0, len(codes) - WINDOW + 1)]
    return runs(codes, WINDOW)[inside], words.whose[:len(inside)][inside], inside


def least_of_equals(h: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For every entry the least id among those with its hash."""
    if not len(h):
        return ids
    order = np.argsort(h, kind="stable")
    s = h[order]
    start = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
    out = np.empty(len(h), dtype=np.int64)
    out[order] = np.repeat(np.minimum.reduceat(ids[order], start), np.diff(np.append(start, len(s))))
    return out


def find_repeats(docs: DataFrame, text: str = "text", doc: str = "doc_id", digests_only: bool = False) -> DataFrame:
    """(row, doc_id, found): the whole input row as a struct (empty for digests), its id, and n_words, n_removed, removed_spans, kept_text, kept_sha256 as a struct.

    `removed_spans` are the removed word ranges (start, length) in order; `kept_text` has the words kept, joined by a space.  Null texts have no words.  Only a smaller id owns
    a window, so rows that repeat an id do not touch each other; null ids own nothing.  Rows that repeat id and text are one batch's.
    """
    frequent, total = frequent_words(docs, text)
    size = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    count, groups = max(parts(docs), size // BATCH_BYTES + 1), max(parts(docs), total // GROUP_WINDOWS + 1)
    key = F.pmod(F.xxhash64(F.col(doc).cast("bigint"), F.col(text)), F.lit(count))
    d = docs.select(F.struct(*([F.lit(0).alias("none")] if digests_only else [F.col(f"`{c}`") for c in docs.columns])).alias("row"),
                    F.col(doc).cast("bigint").alias("doc_id"), F.col(text).alias("text"), key.alias("batch"))

    def known(t: pa.Table) -> tuple[Words, np.ndarray, np.ndarray]:
        words = Words(t.column("text"))
        return words, words.hashes(), np.asarray(pc.fill_null(t.column("doc_id"), LAST).to_numpy(), dtype=np.int64)

    def cuts(x: np.ndarray, *cols: np.ndarray):
        """The distinct values of ascending `x`, and the columns cut where it changes."""
        at = np.flatnonzero(np.append(True, x[1:] != x[:-1])) if len(x) else np.zeros(0, dtype=np.int64)
        return x[at], *(np.split(c, at[1:]) if len(at) else [] for c in cols)

    def send(t: pa.Table) -> pa.Table:
        words, codes, ids = known(t)
        h, whose, inside = windows_of(words, codes)
        g = prefix_group(codes, frequent, groups)[inside]
        order = np.argsort(h, kind="stable")
        order = order[np.argsort((g[order]).astype(np.uint16 if groups < 1 << 16 else np.int64), kind="stable")]
        h, g, ids = h[order], g[order], ids[whose[order]]
        first = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (g[1:] != g[:-1]))) if len(h) else np.zeros(0, dtype=np.int64)
        least = np.minimum.reduceat(ids, first) if len(h) else ids
        which, suffixes, owners = cuts(g[first], h[first], least.astype(np.uint64))
        return pa.table({"group": pa.array(which, pa.int64()), "batch": pa.array([t.column("batch")[0].as_py()] * len(which), pa.int64()),
                         "suffixes": pa.array([pack_sorted(x) for x in suffixes], pa.binary()), "owners": pa.array([planes(x) for x in owners], pa.binary())})

    def deep_nodes(t: pa.Table) -> pa.Table:
        """The suffixes of one group in order; where neighbours agree, the batches without the least id are told."""
        lists = [unpack_sorted(x) for x in t.column("suffixes").to_pylist()]
        owner = np.concatenate([from_planes(x) for x in t.column("owners").to_pylist()]).astype(np.int64)
        batch = np.repeat(np.asarray(t.column("batch").to_numpy(), dtype=np.int64), [len(x) for x in lists])
        h = np.concatenate(lists)
        late = owner > least_of_equals(h, owner)
        h, batch = h[late], batch[late]
        order = np.lexsort((h, batch))
        which, repeats = cuts(batch[order], h[order])
        return pa.table({"batch": pa.array(which, pa.int64()), "repeats": pa.array([pack_sorted(x) for x in repeats], pa.binary())})

    def remove(mine: pa.Table, told: pa.Table) -> pa.Table:
        words, codes, ids = known(mine)
        h, whose, inside = windows_of(words, codes)
        theirs = np.sort(np.concatenate([np.zeros(0, np.uint64), *(unpack_sorted(x) for x in told.column("repeats").to_pylist())]))
        at = np.minimum(np.searchsorted(theirs, h), max(0, len(theirs) - 1))
        gone = (theirs[at] == h) if len(theirs) else np.zeros(len(h), dtype=bool)
        gone |= ids[whose] > least_of_equals(h, ids[whose])
        start = np.flatnonzero(inside)[gone]
        step = np.zeros(len(codes) + 1, dtype=np.int64)
        np.add.at(step, start, 1)
        np.add.at(step, start + WINDOW, -1)
        lost = np.cumsum(step[:-1]) > 0
        n_words = np.diff(words.first)
        n_lost = np.diff(np.append(0, np.cumsum(lost))[words.first])
        plain, spans, kept = words.plain(), [], []
        for i, (a, b) in enumerate(zip(words.first[:-1], words.first[1:], strict=True)):
            if not n_lost[i]:
                spans.append([])
                kept.append(words.data[words.edges[i]:words.edges[i + 1]].tobytes() if plain[i] else b" ".join(words.of(i)))
                continue
            flags = lost[a:b]
            turn = np.flatnonzero(np.diff(flags, prepend=False, append=False))
            spans.append([{"start": s, "length": e - s} for s, e in turn.reshape(-1, 2).tolist()])
            kept.append(b" ".join([x for x, f in zip(words.of(i), flags.tolist(), strict=True) if not f]))
        sha = [hashlib.sha256(k).hexdigest() for k in kept]
        cols = [pa.array(n_words, pa.int64()), pa.array(n_lost, pa.int64()), pa.array(spans, found[2].type),
                pa.array([None] * len(kept) if digests_only else [k.decode() for k in kept], pa.string()), pa.array(sha, pa.string())]
        row = mine.column("row").combine_chunks()
        return pa.table({"row": row, "doc_id": mine.column("doc_id"), "found": pa.StructArray.from_arrays(cols, fields=found)})

    span = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))
    found = [pa.field("n_words", pa.int64()), pa.field("n_removed", pa.int64()), pa.field("removed_spans", span), pa.field("kept_text", pa.string()), pa.field("kept_sha256", pa.string())]
    sent = d.groupBy("batch").applyInArrow(send, "group bigint, batch bigint, suffixes binary, owners binary")
    told = sent.groupBy("group").applyInArrow(deep_nodes, "batch bigint, repeats binary")
    kind = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                         T.StructField("removed_spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("length", T.IntegerType())]))),
                         T.StructField("kept_text", T.StringType()), T.StructField("kept_sha256", T.StringType())])
    out = T.StructType([d.schema["row"], T.StructField("doc_id", T.LongType()), T.StructField("found", kind)])
    return d.groupBy("batch").cogroup(told.groupBy("batch")).applyInArrow(remove, out)


def drop_repeats(docs: DataFrame, text: str = "text", doc: str = "doc_id", digests_only: bool = False) -> DataFrame:
    """All columns of `docs`, then n_words, n_removed, kept_text and kept_sha256 of `find_repeats`; input columns of these names give way.

    `digests_only` returns doc_id, n_words, n_removed, kept_sha256.
    """
    d = find_repeats(docs, text, doc, digests_only)
    if digests_only:
        return d.select("doc_id", "found.n_words", "found.n_removed", "found.kept_sha256")
    added = ["n_words", "n_removed", "kept_text", "kept_sha256"]
    return d.select(*[F.col(f"row.`{c}`") for c in docs.columns if c not in added], *[F.col(f"found.{c}") for c in added])
