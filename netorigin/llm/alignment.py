"""Alignment of the tokens of two tokenizers by lockstep merging.

A text's tokens of A and of B are given by the byte offsets where they end.  All texts of a block lie one behind the other on one byte line, cut into
lanes of `LANE` bytes, so a long text is many lanes.  One state vector holds a pointer into A's ends and one into B's ends for every lane.  A step compares
the two ends of all lanes at once: equal ends are a link and a cut, and both pointers move; else the pointer with the smaller end moves.  Finished
lanes leave the vector.

Two linked tokens end together, so one's bytes are a suffix of the other's.  A vocabulary thus allows no more linked id pairs than its tokens have
bytes, whatever the corpus: the table of pair counts is bounded by the two vocabulary files (about half a million rows for the given ones), and it alone is
sent to the tasks.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netorigin.llm.columns import blocks
from netorigin.llm.pieces import Pieces
from netorigin.operators.lineage import cut

LANE = 1024
CHARS = 1_000_000
CACHED = 200_000  # pieces each tokenizer remembers in a worker
COMPACT = 16  # steps between two compactions
SPACED = re.compile(r" *[^ ]+| +")


class Side:
    """Ids of texts by one tokenizer, with a cache of pieces; `lengths` has the bytes of every id."""

    lengths: np.ndarray

    def __init__(self):
        self.pieces = Pieces(CACHED)
        self.odd: set[str] = set()  # pieces whose token bytes differ from the piece

    def split(self, text: str) -> list[str]:
        raise NotImplementedError

    def encode(self, pieces: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def bytes_of(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def __call__(self, texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
        """Ids of each text after a space, and whether its token bytes are those of the spaced text."""
        split = [self.split(" " + t) for t in texts]
        new = self.pieces.missing(split)
        if not self.pieces.number:
            self.odd.clear()
        for at in range(0, len(new), 5_000):
            part = new[at:at + 5_000]
            got = self.encode(part)
            self.odd.update(p for p, ids in zip(part, got, strict=True) if self.bytes_of(ids) != p.encode("utf-8", "surrogatepass"))
            self.pieces.add(part, np.array([len(g) for g in got], dtype=np.int64), np.array([x for g in got for x in g], dtype=np.int64))
        same = np.array([not self.odd or self.odd.isdisjoint(ps) for ps in split], dtype=bool)
        return self.pieces.gather(split)[1], same


class ByteLevel(Side):
    """A `tokenizers` file of byte-level BPE; each match of its pattern is encoded separately, as the library does."""

    def __init__(self, path: str, pattern: str):
        import regex
        from tokenizers import Tokenizer

        super().__init__()
        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        self.split = regex.compile(pattern).findall
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes shown as their own character; the others follow from 256
        shown = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}
        size = self.model.get_vocab_size()
        names = [self.model.id_to_token(i) or "" for i in range(size)]
        self.tokens = [bytes(shown[c] for c in t) if all(c in shown for c in t) else t.encode() for t in names]
        self.lengths = np.array([len(t) for t in self.tokens], dtype=np.int64)

    def encode(self, pieces):
        return [self.model.encode(p, add_special_tokens=False).ids for p in pieces]


class SpacePieces(Side):
    """A `sentencepiece` file of BPE whose pieces have their space marks in front only, so nothing merges across the start of a run of spaces."""

    MARK = "▁"

    def __init__(self, path: str):
        import sentencepiece

        super().__init__()
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        names = [self.model.id_to_piece(i) for i in range(n)]
        if any(self.MARK in t.lstrip(self.MARK) for t in names):
            raise ValueError("a piece holds a space mark behind other characters: texts cannot be cut at spaces")
        self.tokens = [bytes([int(t[3:5], 16)]) if self.model.is_byte(i) else t.replace(self.MARK, " ").encode() for i, t in enumerate(names)]
        self.lengths = np.array([len(t) for t in self.tokens], dtype=np.int64)
        self.space = self.model.piece_to_id(self.MARK)
        self.split = SPACED.findall

    def encode(self, pieces):
        got = self.model.encode([p[1:] for p in pieces], num_threads=1)  # the library adds the first space
        return [ids if p != " " else [self.space] for p, ids in zip(pieces, got, strict=True)]


@lru_cache(maxsize=1)
def sides(a: str, pattern: str, b: str) -> tuple[ByteLevel, SpacePieces]:
    """Both tokenizers, once a Python worker."""
    return ByteLevel(a, pattern), SpacePieces(b)


def lockstep(a: np.ndarray, b: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the equal values of the ascending ends `a` and `b`, pair by pair; texts lie at (start, stop] on the line."""
    n = -(-(stops - starts) // LANE)
    text = np.repeat(np.arange(len(n)), n)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    lo = starts[text] + nth * LANE
    hi = np.minimum(lo + LANE, stops[text])
    i, i_end, j, j_end = (np.searchsorted(x, y, side="right") for x in (a, b) for y in (lo, hi))
    in_a, in_b = np.zeros(len(a), dtype=bool), np.zeros(len(b), dtype=bool)
    step = 0
    while True:
        if step % COMPACT == 0:
            on = (i < i_end) & (j < j_end)
            i, i_end, j, j_end = i[on], i_end[on], j[on], j_end[on]
            if not len(i):
                break
        # a lane that ended since the last compaction stands still at its last end
        live = (i < i_end) & (j < j_end)
        x, y = a[np.minimum(i, len(a) - 1)], b[np.minimum(j, len(b) - 1)]
        both = (x == y) & live
        in_a[i[both]] = True
        in_b[j[both]] = True
        i, j = i + ((x <= y) & live), j + ((y <= x) & live)
        step += 1
    return np.flatnonzero(in_a), np.flatnonzero(in_b)


def group_text(ids_a, ids_b, cuts_a, cuts_b, texts) -> list[bytes]:
    """Per text `a1,a2|b1;a3|b2,b3`: the groups' ids in order.  `texts` has, per text, the numbers of tokens of A and of B."""
    def groups(n, cuts):
        g = np.zeros(n, dtype=np.int64)
        g[cuts[cuts + 1 < n] + 1] = 1
        return np.cumsum(g)

    ga, gb = groups(len(ids_a), cuts_a), groups(len(ids_b), cuts_b)
    before_b = np.append(-1, cuts_b)[ga] + 1  # tokens of B in earlier groups
    upto_a = cuts_a[gb] + 1  # tokens of A in this and earlier groups
    code = np.empty(len(ids_a) + len(ids_b), dtype=np.int64)
    end_a, end_b = np.zeros(len(ids_a), dtype=np.int64), np.zeros(len(ids_b), dtype=np.int64)
    end_a[cuts_a], end_b[cuts_b] = 1, 2
    last = np.cumsum(texts.sum(1))
    code[np.arange(len(ids_a)) + before_b] = ids_a * 3 + end_a
    code[np.arange(len(ids_b)) + upto_a] = ids_b * 3 + end_b
    words = [*map(numbered(int(code.max(initial=0)) // 3 + 1).__getitem__, code.tolist())]
    return [b"".join(words[e - n:e])[:-1] for e, n in zip(last.tolist(), texts.sum(1).tolist(), strict=True)]


TEXTS: list[bytes] = []


def numbered(ids: int) -> list[bytes]:
    """Decimal texts of all ids below `ids`, each followed by a comma, a bar, a semicolon; grown as needed, so as long as a vocabulary."""
    TEXTS.extend(b"%d%s" % (i, mark) for i in range(len(TEXTS) // 3, ids) for mark in (b",", b"|", b";"))
    return TEXTS


def aligned(docs: DataFrame, a: str, pattern: str, b: str, text: str = "text", doc: str = "doc_id", keep_groups: bool = False) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, groups_sha256, pairs (per link A id times B's vocabulary plus B id), groups where kept; one row per row of `docs`.

    Texts that are null, empty, or not given back byte by byte by both tokenizers have no tokens.
    """
    def run(batches):
        left, right = sides(a, pattern, b)
        width = len(right.tokens)
        for batch in batches:
            for names, texts in blocks(batch, CHARS):
                ids_a, same_a = left(["" if t is None else t for t in texts])
                ids_b, same_b = right(["" if t is None else t for t in texts])
                good = same_a & same_b & np.array([bool(t) for t in texts], dtype=bool)
                none = np.zeros(0, dtype=np.int32)
                ids_a, ids_b = ([x if ok else none for x, ok in zip(ids, good, strict=True)] for ids in (ids_a, ids_b))
                texts_n = np.array([[len(x), len(y)] for x, y in zip(ids_a, ids_b, strict=True)], dtype=np.int64)
                xa, xb = np.concatenate([none, *ids_a]).astype(np.int64), np.concatenate([none, *ids_b]).astype(np.int64)
                ends_a, ends_b = np.cumsum(left.lengths[xa]), np.cumsum(right.lengths[xb])
                stops = np.append(0, ends_a)[np.cumsum(texts_n[:, 0])]
                cuts_a, cuts_b = lockstep(ends_a, ends_b, np.append(0, stops[:-1]), stops)
                lines = group_text(xa, xb, cuts_a, cuts_b, texts_n)
                key = xa[cuts_a] * width + xb[cuts_b]
                edge = np.append(0, np.searchsorted(cuts_a, np.cumsum(texts_n[:, 0])))
                sha = [hashlib.sha256(x).hexdigest() if n else "" for x, n in zip(lines, texts_n[:, 0].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(names, pa.int64()), *(pa.array(texts_n[:, k]) for k in (0, 1)), pa.array(np.diff(edge)), pa.array(sha, pa.string()),
                    pa.array([key[s:e].astype("<u4").tobytes() for s, e in zip(edge[:-1], edge[1:], strict=True)], pa.binary()),
                    pa.array([x.decode() if keep_groups else None for x in lines], pa.string())],
                    names=["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "groups"])

    return docs.select(F.col(doc).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, pairs binary, groups string")


def pair_counts(rows: DataFrame, width: int) -> DataFrame:
    """(a, b, n): how many links of all documents hold ids a and b; every task adds its own up first."""
    def run(batches):
        keys, counts = np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
        for batch in batches:
            k, n = np.unique(np.frombuffer(b"".join(batch.column("pairs").to_pylist()), dtype="<u4"), return_counts=True)
            keys, inverse = np.unique(np.concatenate([keys, k]), return_inverse=True)
            counts = np.bincount(inverse, weights=np.concatenate([counts, n]), minlength=len(keys)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(counts)], names=["pair", "n"])

    return (rows.select("pairs").mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
            .select(F.expr(f"pair div {width}").cast("int").alias("a"), F.expr(f"pair % {width}").cast("int").alias("b"), "n"))


def align(docs: DataFrame, a: str, pattern: str, b: str, text: str = "text", doc: str = "doc_id", keep_groups: bool = False) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 (and groups where kept), one row per row of `docs`.

    `a` is a byte-level `tokenizers` file with its split pattern, `b` a `sentencepiece` file.  Repeated rows are aligned and counted as often as they
    occur, a null id stays null, other columns are not carried, an empty table gives an empty table.
    """
    right = SpacePieces(b)
    width = len(right.tokens)
    if ByteLevel(a, pattern).model.get_vocab_size() * width >= 1 << 32:
        raise ValueError("the vocabularies are too large for pairs of 32 bits")
    rows = cut(aligned(docs, a, pattern, b, text, doc, keep_groups))
    table = pair_counts(rows, width).toArrow()
    ta, tb, tn = (np.asarray(table.column(c).to_numpy(), dtype=np.int64) for c in ("a", "b", "n"))
    most = np.zeros(width, dtype=np.int64)
    np.maximum.at(most, tb, tn)
    order = np.argsort(ta * width + tb)
    sent = docs.sparkSession.sparkContext.broadcast(((ta * width + tb)[order].astype(np.uint32), tn[order], (tn == most[tb])[order]))

    def run(batches):
        keys, counts, best = sent.value
        for batch in batches:
            pairs = batch.column("pairs").to_pylist()
            at = np.searchsorted(keys, np.frombuffer(b"".join(pairs), dtype="<u4"))
            edge = np.cumsum([0, *(len(p) // 4 for p in pairs)])
            total, good = (np.append(0, np.cumsum(x[at]))[edge] for x in (counts, best.astype(np.int64)))
            yield pa.RecordBatch.from_arrays([
                *(batch.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups")), pa.array(np.diff(edge)), pa.array(np.diff(good)), pa.array(np.diff(total)),
                batch.column("groups_sha256"), batch.column("groups")],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"])

    out = rows.mapInArrow(run, "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string, groups string")
    return out if keep_groups else out.drop("groups")
