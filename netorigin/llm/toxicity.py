"""Toxicity: cumulative-link (ordinal logistic) regression on sparse word features.

P(grade > j | x) = sigmoid(w.x - t_j), one weight vector for all thresholds t_0 < t_1.  The fit is proximal gradient
descent on a bounded sample, so most weights are exactly zero; the weights travel with the scoring function.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netorigin.llm.columns import blocks

SAMPLE = 6_000  # labelled rows at most in the fit: those of least hash of their id
MIN_DOCS = 5
WORD = re.compile(r"[^\W\d_]+")
BEGINNINGS = range(4, 10)  # letters; words are inflected at the end
SPACE = 1 << 22
LIMIT = 300_000


class Features(dict):
    """word -> numbers of its features (the word and its beginnings) among `only`, or all; remembers up to `LIMIT` words."""

    def __init__(self, only: set[int] | None = None):
        self.only = only

    def __missing__(self, word: str) -> tuple[int, ...]:
        names = [word + "$", *(word[:n] for n in BEGINNINGS if n <= len(word))]
        got = tuple(x for x in (zlib.crc32(n.encode()) % SPACE for n in names) if self.only is None or x in self.only)
        if len(self) < LIMIT:
            self[word] = got
        return got

    def of(self, text: str | None) -> set[int]:
        return set().union(*map(self.__getitem__, set(WORD.findall((text or "").lower()))))


@dataclass(frozen=True)
class Model:
    weights: dict[int, float]
    thresholds: tuple[float, ...]

    def scores(self, texts: list[str | None]) -> np.ndarray:
        known = Features(set(self.weights))
        return np.array([sum(map(self.weights.__getitem__, known.of(t))) for t in texts], dtype=float)

    def above(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > j) per row and threshold."""
        return 1 / (1 + np.exp(np.clip(np.array(self.thresholds) - scores[:, None], -500, 500)))


def grades(labels: DataFrame) -> DataFrame:
    """(doc_id, grade): 0 not toxic, 1 toxic in a text of good quality, 2 toxic in one of poor quality.

    Rows without an id or a toxicity label are no labels; of several labels of an id the gravest counts; unknown quality
    is taken as good.
    """
    g = F.when(F.col("toxic") == 0, 0).when(F.coalesce("quality", F.lit(1)) == 0, 2).otherwise(1)
    return labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max(g).alias("grade"))


def fit(docs: DataFrame, graded: DataFrame, text: str = "text", doc: str = "doc_id", sample: int = SAMPLE,
        l1: float = 0.002, l2: float = 1e-3, rounds: int = 200) -> Model:
    """Model of at most `sample` labelled documents, those of the least hashes of their ids; of rows that repeat an id the one of the least text hash.

    Without documents of some grade its threshold stays beyond reach.  Only the feature numbers of the sampled documents reach the driver.
    """
    picked = graded.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def features(batches):
        known = Features()
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("grade"), pa.array([sorted(known.of(t)) for t in b.column("text").to_pylist()], pa.list_(pa.int32()))],
                                             names=["doc_id", "grade", "f"])

    found = docs.select(F.col(doc).cast("bigint").alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(picked.withColumn("doc_id", F.col("doc_id").cast("bigint"))), "doc_id")
    one = found.groupBy("doc_id", "grade").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    rows = one.select("doc_id", "grade", "text").mapInArrow(features, "doc_id bigint, grade int, f array<int>").toPandas().sort_values("doc_id", ignore_index=True)
    top = 2
    none = np.zeros(0, dtype=np.int64)
    at = np.concatenate([none, *(np.full(len(f), i) for i, f in enumerate(rows.f))])
    ids = np.concatenate([none, *(np.asarray(f, dtype=np.int64) for f in rows.f)])
    often = np.flatnonzero(np.bincount(ids, minlength=SPACE) >= MIN_DOCS)
    if not len(often):
        return Model({}, (10.0, 20.0))
    vocab = np.full(SPACE, -1, dtype=np.int64)
    vocab[often] = np.arange(len(often))
    at, ids = at[vocab[ids] >= 0], vocab[ids[vocab[ids] >= 0]]
    y = rows.grade.to_numpy()
    over = (y[:, None] > np.arange(top)).astype(float)
    n, m = len(y), len(often)
    share = np.clip(over.mean(0), 1e-4, 1 - 1e-4)
    theta = np.log((1 - share) / share)
    theta[1:] = np.maximum(theta[1:], theta[:-1] + 0.1)
    def total(v):  # X v, one number a document
        return np.bincount(at, weights=v[ids], minlength=n)

    def back(r):  # X' r, one number a word
        return np.bincount(ids, weights=r[at], minlength=m)

    x = np.ones(m)
    for _ in range(30):
        x = back(total(x))
        x /= np.linalg.norm(x)
    rate = 1 / (top / 4 * (np.linalg.norm(total(x)) ** 2 / n + 1))  # below the inverse curvature
    def descend(w, theta, l1, l2, free):
        """Accelerated proximal gradient over the words in `free`."""
        v, z, tt = w.copy(), theta.copy(), 1.0
        for _ in range(rounds):
            r = 1 / (1 + np.exp(np.clip(z - total(v)[:, None], -500, 500))) - over
            nxt = np.where(free, v - rate * (back(r.sum(1)) / n + l2 * v), 0)
            nxt = np.sign(nxt) * np.maximum(np.abs(nxt) - rate * l1, 0)
            th = z + rate * r.sum(0) / n
            th[1:] = np.maximum(th[1:], th[:-1] + 0.05)
            t2 = (1 + np.sqrt(1 + 4 * tt * tt)) / 2
            v, z = nxt + (tt - 1) / t2 * (nxt - w), th + (tt - 1) / t2 * (th - theta)
            w, theta, tt = nxt, th, t2
        return w, theta

    w, theta = descend(np.zeros(m), theta, l1, 0.0, np.ones(m, dtype=bool))  # picks the words
    w, theta = descend(w, theta, 0.0, l2, w != 0)  # fits them without the pull to zero
    return Model({int(often[i]): float(w[i]) for i in np.flatnonzero(w)}, tuple(map(float, theta)))


def score(docs: DataFrame, model: Model, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """doc_id, severity (expected grade, 0 to 2), grade (most likely at least), toxic (severity of 0.5 or more).

    A null or empty text has no features: its severity is that of the thresholds alone.  Each row is scored alone.
    """
    def run(batches):
        for b in batches:
            for names, texts in blocks(b):
                above = model.above(model.scores(texts))
                severity = above.sum(1)
                yield pa.RecordBatch.from_arrays([
                    pa.array(names, pa.int64()), pa.array(severity, pa.float64()), pa.array((above >= 0.5).sum(1), pa.int32()),
                    pa.array(above[:, 0] >= 0.5, pa.bool_())], names=["doc_id", "severity", "grade", "toxic"])

    return docs.select(F.col(doc).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id bigint, severity double, grade int, toxic boolean")
