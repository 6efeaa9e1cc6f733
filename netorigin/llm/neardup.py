"""Near-duplicate classes by Order MinHash.

A text's five-word shingles are labelled with their occurrence number.  Each of `SKETCHES` hash functions takes the
`TAKEN` least labelled shingles and keeps them in text order, so a sketch depends on what a text says and in which order.  Runs of
sketches are bucket keys.  Texts of one bucket are linked to one member each, so a bucket of n texts gives n - 1
candidates; coarse and fine buckets with different members keep small neighbourhoods together.  A candidate counts
when its shingle sets have a likeness of `SIMILARITY` or more and a banded alignment finds as much of the word order
alike.  Texts with the same words are one node from the start.  Classes are the connected components of the links.

A coarse bucket that still holds several classes (texts of one template, texts that share a common passage) is settled
exactly: its members are dealt to blocks, every two blocks meet in one task, and there each member is compared with each
member of another class.  So no two texts of different classes that share a coarse bucket stay uncompared.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netorigin.llm.columns import blocks
from netorigin.llm.wordhash import KNOWN, WORD, mix, runs
from netorigin.operators.lineage import cut

SHINGLE, SIMILARITY = 5, 0.8
SKETCHES, TAKEN = 24, 2
COARSE, FINE = 2, 4  # sketches in a bucket key
BLOCK, BLOCK_BYTES = 512, 2_000_000  # most nodes and about the most bytes of codes in a block of a mixed bucket
DENSE = 24  # a shingle of more texts of a task is counted by matrix product, others pair by pair
CELLS = 1_000_000  # numbers in a matrix of sketches


def _seeds() -> tuple[np.ndarray, np.ndarray]:
    s = mix(np.arange(1, 2 * SKETCHES + 1, dtype=np.uint64))
    return s[:SKETCHES] | np.uint64(1), s[SKETCHES:]


def order_minhash(codes: np.ndarray) -> np.ndarray:
    """`SKETCHES` sketches of a row of word hashes; a text shorter than a shingle is one shingle, no words give none."""
    h = runs(codes, min(SHINGLE, len(codes)) or 1)
    if not len(h):
        return h
    order = np.argsort(h, kind="stable")
    s = h[order]
    first = np.concatenate([[True], s[1:] != s[:-1]])
    at = np.arange(len(s))
    occurrence = np.empty(len(s), dtype=np.uint64)
    occurrence[order] = at - np.maximum.accumulate(np.where(first, at, 0))
    x = mix(h + occurrence * np.uint64(0xD1B54A32D192ED03))
    a, b = _seeds()
    out = np.empty(SKETCHES, dtype=np.uint64)
    step = max(1, CELLS // len(x))
    for i in range(0, SKETCHES, step):
        v = mix(x[None, :] * a[i:i + step, None] + b[i:i + step, None])
        rows, picks = np.arange(len(v)), []
        for _ in range(min(TAKEN, len(x))):
            p = v.argmin(1)
            picks.append(p)
            v[rows, p] = np.uint64(2**64 - 1)
        sk = np.zeros(len(v), dtype=np.uint64)
        for p in np.sort(np.array(picks), axis=0):
            sk = mix(sk + h[p])
        out[i:i + step] = sk
    return out


def bucket_keys(sketches: np.ndarray, size: int) -> np.ndarray:
    """One 64-bit key for each run of `size` sketches; the run's number and the size are part of the key."""
    if not len(sketches):
        return sketches
    rows = sketches.reshape(-1, size)
    key = np.arange(len(rows), dtype=np.uint64) + np.uint64(1000 * size)
    for c in rows.T:
        key = mix(key + c)
    return key


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard likeness of the shingle sets of two rows of word codes."""
    x, y = (np.unique(runs(c.astype(np.uint64), min(SHINGLE, len(c)) or 1)) for c in (a, b))
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / max(1, len(x) + len(y) - both)


def edits(a: np.ndarray, b: np.ndarray, most: int) -> int:
    """Edit distance of two rows of codes, or `most` + 1 if it is larger: alignment in a band that doubles until it suffices."""
    n = min(len(a), len(b))
    head = int(np.argmin(np.append(a[:n] == b[:n], False)))
    a, b = a[head:], b[head:]
    n = min(len(a), len(b))
    tail = int(np.argmin(np.append((a[::-1][:n] == b[::-1][:n]), False)))
    a, b = a[:len(a) - tail], b[:len(b) - tail]
    if abs(len(a) - len(b)) > most:
        return most + 1
    if not len(a) or not len(b):
        return max(len(a), len(b))
    band = max(8, abs(len(a) - len(b)))
    while True:
        band = min(band, most)
        d = _banded(a.astype(np.int64), b.astype(np.int64), band)
        if d <= band or band == most:
            return min(d, most + 1)
        band *= 2


def _banded(a: np.ndarray, b: np.ndarray, t: int) -> int:
    """Edit distance by cells within `t` of the diagonal; right if it is `t` or less."""
    far = len(a) + len(b) + 1
    o = np.arange(2 * t + 1)
    wide = np.full(len(b) + 2 * t + len(a) + 2, -1, dtype=np.int64)
    wide[t:t + len(b)] = b
    row = np.where((o >= t) & (o - t <= len(b)), o - t, far)
    for i in range(1, len(a) + 1):
        # cell o of row i is column i + o - t; it meets b[i + o - t - 1]
        cur = row + (wide[i - 1:i + 2 * t] != a[i - 1])
        np.minimum(cur[:-1], row[1:] + 1, out=cur[:-1])
        if i <= t:
            cur[:t - i] = far
            cur[t - i] = i
        over = len(b) - i + t + 1
        if over <= 2 * t:
            cur[max(over, 0):] = far
        row = np.minimum.accumulate(cur - o) + o
        if over <= 2 * t:
            row[max(over, 0):] = far
    at = len(b) - len(a) + t
    return int(row[at]) if 0 <= at <= 2 * t else far


def alike(a: bytes, b: bytes) -> bool:
    x, y = np.frombuffer(a, dtype="<u2"), np.frombuffer(b, dtype="<u2")
    return sized(len(x), len(y)) and likeness(x, y) >= SIMILARITY and aligned(x, y)


def sized(m: int, n: int) -> bool:
    return min(m, n) >= SIMILARITY * max(m, n)


def aligned(x: np.ndarray, y: np.ndarray) -> bool:
    most = int((1 - SIMILARITY) * max(len(x), len(y)) + 1e-9)
    return edits(x, y, most) <= most


def common(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of the number of elements that each two of the sets have in common; the diagonal is not filled."""
    n = len(sets)
    out = np.zeros(n * n, dtype=np.int64)
    owner = np.repeat(np.arange(n), [len(x) for x in sets])
    order = np.argsort(values := np.concatenate(sets), kind="stable")
    values, owner = values[order], owner[order]
    at = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, dtype=np.int64)
    size = np.diff(np.append(at, len(values)))
    for c in range(2, min(DENSE, n) + 1):
        rows = owner[at[size == c][:, None] + np.arange(c)]  # owners ascend
        for i, j in combinations(range(c), 2):
            np.add.at(out, rows[:, i] * n + rows[:, j], 1)
    out = out.reshape(n, n)
    out += out.T
    often = np.flatnonzero(size > DENSE)
    for i in range(0, len(often), 2048):
        some = often[i:i + 2048]
        m = np.zeros((n, len(some)), dtype=np.float32)
        for k, s in enumerate(some):
            m[owner[at[s]:at[s] + size[s]], k] = 1
        out += (m @ m.T).astype(np.int64)  # whole numbers under 2048
    return out


def sketched(docs: DataFrame, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """(doc_id, th, uid, node, codes, keys): one row per document; `node` is the same for the same words.

    `codes` are 16-bit word codes, enough to align by; `keys` has the coarse bucket keys first.
    """
    def run(batches):
        for b in batches:
            rows = []
            for _, texts in blocks(b.select(["uid", "text"])):
                for t in texts:
                    words = WORD.findall(t or "")
                    c = KNOWN.of(words)
                    sk = order_minhash(c)
                    rows.append((hashlib.md5(" ".join(words).encode("utf-8", "surrogatepass")).digest(), (c >> np.uint64(48)).astype("<u2").tobytes(),
                                 np.concatenate([bucket_keys(sk, COARSE), bucket_keys(sk, FINE)]).view(np.int64)))
            node, codes, keys = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("th"), b.column("uid"), pa.array(node, pa.binary()), pa.array(codes, pa.binary()),
                                              pa.array(keys, pa.list_(pa.int64()))],
                                             names=["doc_id", "th", "uid", "node", "codes", "keys"])

    return docs.select(F.col(doc).cast("bigint").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("th"),
                       F.monotonically_increasing_id().alias("uid"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id bigint, th bigint, uid bigint, node binary, codes binary, keys array<bigint>")


def candidates(table: DataFrame) -> DataFrame:
    """Distinct (a, b) of nodes that share a bucket; b is the bucket's least or greatest node."""
    one = table.groupBy("node").agg(F.min("keys").alias("keys"))  # copies have the same keys
    rows = one.select("node", F.explode("keys").alias("key"))
    hubs = (rows.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low <> high"))
    met = rows.join(hubs, "key").select("node", F.explode(F.array("low", "high")).alias("hub")).filter("node <> hub")
    return met.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()


def confirmed(table: DataFrame, pairs: DataFrame) -> DataFrame:
    """The (a, b) of `pairs` that the shingle likeness and the banded alignment confirm."""
    def run(batches):
        for b in batches:
            ok = [alike(x, y) for x, y in zip(b.column("ca").to_pylist(), b.column("cb").to_pylist(), strict=True)]
            yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    one = table.groupBy("node").agg(F.min("codes").alias("codes"))  # copies have the same codes
    both = (pairs.join(one.select(F.col("node").alias("a"), F.col("codes").alias("ca")), "a")
            .join(one.select(F.col("node").alias("b"), F.col("codes").alias("cb")), "b"))
    return both.select("a", "b", "ca", "cb").mapInArrow(run, "a binary, b binary")


def links(table: DataFrame) -> DataFrame:
    """Confirmed candidates."""
    return confirmed(table, candidates(table))


def mixed_members(table: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, i, j, node, label): the members of the coarse buckets that hold several classes, dealt to tasks (i, j).

    The members of a bucket's largest class and the others are dealt to blocks of at most about `BLOCK`.  Task (i, j) holds two
    blocks; all two blocks meet but those of the largest class among themselves.  Buckets of up to three nodes are left
    out: there every pair has met.
    """
    one = table.groupBy("node").agg(F.min(F.slice("keys", 1, SKETCHES // COARSE)).alias("keys"), F.min(F.length("codes")).alias("bytes"))
    rows = one.join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("label"), F.explode("keys").alias("key"), "bytes")
    sizes = rows.groupBy("key", "label").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))

    def blocks_of(n, size):
        return F.ceil(F.greatest(n / BLOCK, size / BLOCK_BYTES))

    mixed = (sizes.groupBy("key").agg(F.max(F.struct("n", "label", "bytes")).alias("top"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
             .filter("top.n < n and n > 3")
             .select("key", F.col("top.label").alias("top"), (blocks_of(F.col("n"), F.col("bytes")) == 1).alias("small"),
                     blocks_of(F.col("n") - F.col("top.n"), F.col("bytes") - F.col("top.bytes")).alias("others"),
                     blocks_of(F.col("top.n"), F.col("top.bytes")).alias("tops")))
    members = rows.join(mixed, "key")
    is_top, salt = F.col("label") == F.col("top"), F.xxhash64("node")
    block = F.when(F.col("small"), F.lit(0)).when(is_top, F.col("others") + F.pmod(salt, "tops")).otherwise(F.pmod(salt, "others"))
    last = F.when(F.col("small"), F.lit(0)).when(is_top, F.col("others") - 1).otherwise(F.col("others") + F.col("tops") - 1)
    return (members.select("key", "node", "label", block.cast("int").alias("block"), F.explode(F.sequence(F.lit(0), last.cast("int"))).alias("other"))
            .select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "label"))


def unmet(nodes: list[bytes], labels: list[bytes], texts: list[bytes]) -> list[tuple[bytes, bytes]]:
    """Links (a, b) that make every two alike nodes of different classes one class; all pairs of different classes are compared."""
    codes = [np.frombuffer(t, dtype="<u2") for t in texts]
    sets = [np.unique(runs(c.astype(np.uint64), min(SHINGLE, len(c)) or 1)) for c in codes]
    of = {x: i for i, x in enumerate(sorted(set(labels)))}
    cls = np.array([of[x] for x in labels])
    n = np.array([len(x) for x in sets])
    both = common(sets)
    near = both / np.maximum(1, n[:, None] + n[None, :] - both) >= SIMILARITY
    out = []
    for i, j in zip(*np.nonzero(np.triu(near & (cls[:, None] != cls[None, :]), 1)), strict=True):
        if cls[i] != cls[j] and sized(len(codes[i]), len(codes[j])) and aligned(codes[i], codes[j]):
            cls[cls == cls[j]] = cls[i]
            out.append((min(nodes[i], nodes[j]), max(nodes[i], nodes[j])))
    return out


def mixed_links(table: DataFrame, labels: DataFrame) -> DataFrame:
    """Confirmed (a, b) of nodes of different classes that share a coarse bucket, enough to join all classes that are to be joined."""
    def run(t: pa.Table) -> pa.Table:
        got = unmet(*(t.column(c).to_pylist() for c in ("node", "label", "codes"))) if len(set(t.column("label").to_pylist())) > 1 else []
        return pa.table({"a": pa.array([a for a, _ in got], pa.binary()), "b": pa.array([b for _, b in got], pa.binary())})

    one = table.groupBy("node").agg(F.min("codes").alias("codes"))
    return mixed_members(table, labels).join(one, "node").groupBy("key", "i", "j").applyInArrow(run, "a binary, b binary").distinct()


def joined_classes(table: DataFrame, labels: DataFrame) -> DataFrame:
    """`labels` after the classes that `mixed_links` links have become one."""
    def label(of):
        return labels.select(F.col("node").alias(of), F.col("label").alias("l" + of))

    new = cut(mixed_links(table, labels))
    if new.isEmpty():
        return labels
    edges = (new.join(label("a"), "a", "left").join(label("b"), "b", "left")
             .select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")))
    over = components(edges).withColumnRenamed("label", "top")
    named = labels.select("node", F.col("label").alias("was")).union(
        edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(labels, "node", "left_anti").select("node", F.col("node").alias("was")))
    return named.join(over.withColumnRenamed("node", "was"), "was", "left").select("node", F.coalesce("top", "was").alias("label"))


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of all nodes in `edges` (a, b): the least node of the component.

    Every round takes the least label around a node and then the label's own label, so paths halve; each round is
    checkpointed and the loop ends when no label moves.
    """
    both = cut(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a")).distinct())
    labels = cut(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m")).select("node", F.least("node", "m").alias("label")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "v"), "v").groupBy(F.col("u").alias("node")).agg(F.min("label").alias("m"))
        nearer = labels.join(near, "node", "left").select("node", F.col("label").alias("was"), F.least("label", "m").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        moved = cut(nearer.join(jump, "label", "left").select("node", "was", F.least("label", "next").alias("label")))
        labels = moved.select("node", "label")
        if moved.filter("was <> label").isEmpty():
            return labels


def classes(docs: DataFrame, text: str = "text", doc: str = "doc_id", keep_row: bool = False) -> DataFrame:
    """doc_id, class_id (least id of the class), kept (true for one row of each class), one row per document.

    Null and empty texts have no words and are copies of each other.  Null ids sort last; a class of them alone has a
    null class_id.  Repeated rows are copies, one of them is kept.  `keep_row` adds the row key (th, uid).
    """
    table = cut(sketched(docs, text, doc))
    labels = joined_classes(table, components(cut(links(table))))
    rows = table.select("doc_id", "th", "uid", "node").join(labels, "node", "left").select(
        "doc_id", "th", "uid", F.coalesce("label", "node").alias("label"))
    best = F.struct(F.col("doc_id").isNull().alias("o"), F.col("doc_id"), F.col("uid"))
    heads = rows.groupBy("label").agg(F.min(best).alias("head"))
    out = rows.join(heads, "label").select("doc_id", F.col("head.doc_id").alias("class_id"), (F.col("uid") == F.col("head.uid")).alias("kept"), "th", "uid")
    return out if keep_row else out.drop("th", "uid")


def keep_one(docs: DataFrame, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """The rows of `docs` without all but one document of each class; columns as they came."""
    kept = cut(classes(docs, text, doc, keep_row=True).filter("kept").select(F.col("doc_id").alias("_id"), F.col("th").alias("_th")))
    rows = docs.select(F.struct(*docs.columns).alias("_d"))
    th = F.xxhash64(F.coalesce(F.col("_d." + text), F.lit("")))
    same = F.col("_d." + doc).cast("bigint").eqNullSafe(F.col("_id")) & (th == F.col("_th"))
    out = rows.join(kept, same, "left_semi")
    repeated = docs.groupBy(F.col(doc), F.xxhash64(F.coalesce(F.col(text), F.lit("")))).count().filter("count > 1")
    if not repeated.isEmpty():  # rows alike in id and text pass the semi join together
        out = out.withColumn("_k", th).withColumn("_i", F.col("_d." + doc)).dropDuplicates(["_i", "_k"])
    return out.select("_d.*")
