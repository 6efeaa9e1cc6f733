"""Centroid clustering with equal-average equal-variance nearest-centroid search.

Vectors become whole numbers.  The centroids are sorted by the sum of their components (their mean, times the dimension).  A vector starts at
its own sum and looks outward, the nearer sum first.  Two inequalities hold for a vector x, a centroid c and k components, V being the root of the
summed squared deviations from the mean:

    |x - c|^2 >= (sum x - sum c)^2 / k                        ends a side, since all further sums differ more
    |x - c|^2 >= (sum x - sum c)^2 / k + (V x - V c)^2        rejects one centroid

What neither rejects gets its exact whole-number distance, so the result is that of a full search.  All vectors of a block take their steps
together; finished ones leave the block.

Only the centroids and, a round, one row of sums per centroid and component pass the driver: `count` times the dimension numbers, however many vectors
there are.  The vectors are never shuffled: a lost task reads its input split again.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CENTROIDS, ROUNDS, DIMENSION, SCALE, SEED = 40, 5, 64, 256, 2
BLOCK = 16_384
LARGEST = 2.0**96  # a scaled component from here on makes a vector void
PLAIN = 1 << 19  # below it, distances and their sums over a block are whole numbers that float64 and int64 hold exactly, up to 512 components


def valid(vector: Column, dimension: int = DIMENSION, scale: int = SCALE) -> Column:
    """Whether a vector has `dimension` components, all there, finite and less than `LARGEST` after scaling."""
    x = vector.cast("array<double>")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(LARGEST / scale)))
    return F.coalesce((F.size(x) == dimension) & fine, F.lit(False))


def whole(rows: list | np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x): float64 where all are small enough for exact sums of products, else Python integers."""
    x = np.floor(np.asarray(rows, dtype=np.float64) * scale)
    if x.size and np.abs(x).max() >= PLAIN:
        return np.array([[int(v) for v in r] for r in x.tolist()], dtype=object)
    return x


@dataclass
class Search:
    """Centroids in ascending order of their sums, with their numbers, norms and deviations."""

    rows: np.ndarray
    number: np.ndarray
    sums: np.ndarray
    deviation: np.ndarray

    @classmethod
    def of(cls, centroids: list[list[int]]) -> Search:
        big = any(abs(v) >= PLAIN for c in centroids for v in c)
        c = np.array(centroids, dtype=object if big else np.float64)
        s = c.sum(1)
        order = np.argsort(s, kind="stable")
        return cls(c[order], order, s[order], deviations(c[order]))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and exact squared distance of the nearest centroid of every row; of several the smallest number."""
        exact = object if x.dtype == object or self.rows.dtype == object else np.float64
        x, c, cs = x.astype(exact), self.rows.astype(exact), self.sums.astype(exact)
        n, k, dim = len(x), len(c), x.shape[1]
        best, which = np.empty(n, dtype=exact), np.empty(n, dtype=np.int64)
        row = np.arange(n)
        s, dev = x.sum(1), deviations(x)
        right = np.searchsorted(cs, s)
        start = np.where(right == k, k - 1, right)  # the first candidate gives a bound
        best[:] = squared(x, c[start])
        which[:] = self.number[start]
        low, high = start - 1, start + 1
        far = np.inf
        while len(row):
            gap_low = np.where(low >= 0, np.abs(s[row] - cs[np.maximum(low, 0)]), far)
            gap_high = np.where(high < k, np.abs(cs[np.minimum(high, k - 1)] - s[row]), far)
            take_low = gap_low <= gap_high
            gap = np.where(take_low, gap_low, gap_high)
            on = (gap != far) & (gap * gap <= best[row] * dim)  # else every centroid left is farther
            if not on.all():
                row, low, high, take_low, gap = row[on], low[on], high[on], take_low[on], gap[on]
                if not len(row):
                    break
            at = np.where(take_low, low, high)
            low, high = low - take_low, high + ~take_low
            near = gap.astype(np.float64)
            bound = near * near / dim + (dev[row] - self.deviation[at]) ** 2
            look = np.flatnonzero(bound * (1 - 1e-9) - 1e-6 <= best[row].astype(np.float64) * (1 + 1e-12))  # rounding never rejects a centroid
            if len(look):
                r, a = row[look], at[look]
                d, number = squared(x[r], c[a]), self.number[a]
                closer = (d < best[r]) | ((d == best[r]) & (number < which[r]))
                r = r[closer]
                best[r], which[r] = d[closer], number[closer]
        return which, best


def deviations(x: np.ndarray) -> np.ndarray:
    """Root of the summed squared deviations from the mean of each row."""
    if not x.size:
        return np.zeros(len(x))
    f = x.astype(np.float64)
    f = f - f.mean(1, keepdims=True)
    return np.sqrt(np.einsum("ij,ij->i", f, f))


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = x - c
    return (d * d).sum(1) if d.dtype == object else np.einsum("ij,ij->i", d, d)


def first_centroids(vectors: DataFrame, count: int = CENTROIDS, seed: int = SEED, scale: int = SCALE) -> list[list[int]]:
    """The `count` vectors of least sha256 of `seed:id`; a null id comes last, rows of one id are ordered by their components."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    got = vectors.orderBy(key.asc_nulls_last(), "x").limit(count).select("x").collect()
    return [[math.floor(v) for v in r] for r in whole([g["x"] for g in got], scale)] if got else []


def blocks_of(batch: pa.RecordBatch, dimension: int, scale: int):
    """(first row, whole-number matrix) of the vectors of a batch, by blocks."""
    lists = batch.column("x")
    for at in range(0, batch.num_rows, BLOCK):
        part = lists.slice(at, BLOCK)
        yield at, whole(part.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension), scale)


def moved(vectors: DataFrame, centroids: list[list[int]], dimension: int = DIMENSION, scale: int = SCALE) -> list[list[int]]:
    """The centroids after a round: floor of the mean of their vectors; one without vectors stays."""
    search = Search.of(centroids)

    def run(batches):
        sums, n = np.zeros((len(centroids), dimension), dtype=object), np.zeros(len(centroids), dtype=np.int64)
        for b in batches:
            for _, x in blocks_of(b, dimension, scale):
                which, _ = search.nearest(x)
                n += np.bincount(which, minlength=len(n))
                for c in np.unique(which):
                    sums[c] += np.array([int(v) for v in x[which == c].sum(0)], dtype=object)
        for c in np.flatnonzero(n):
            yield pa.RecordBatch.from_arrays([
                pa.array([int(c)] * dimension, pa.int32()), pa.array(range(dimension), pa.int32()), pa.array([int(n[c])] * dimension, pa.int64()),
                pa.array(sums[c].tolist(), pa.decimal128(38, 0))], names=["cluster", "place", "n", "total"])

    got = (vectors.select("x").mapInArrow(run, "cluster int, place int, n bigint, total decimal(38,0)")
           .groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect())
    out = [list(c) for c in centroids]
    for r in got:
        out[r["cluster"]][r["place"]] = int(r["total"]) // r["n"]
    return out


def cluster(embeddings: DataFrame, count: int = CENTROIDS, rounds: int = ROUNDS, dimension: int = DIMENSION, scale: int = SCALE, seed: int = SEED,
            vec: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256 of every kept vector; other columns are not carried.

    Kept are vectors with `dimension` components, none null, not a number or infinite (nor 2^96 or more after scaling).  Fewer than `count` kept
    vectors give fewer centroids, none give an empty table.  Repeated rows count as often as they occur; equal centroids take their vectors by the
    smaller number, the other keeps its place.  A null id is an id like others, but comes last among the first centroids.  A distance or sum beyond 64 bits is null.
    """
    kept = embeddings.select(F.col(vec).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("x")).filter(valid(F.col("x"), dimension, scale))
    shape = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    centroids = first_centroids(kept, count, seed, scale)
    if not centroids:
        return embeddings.sparkSession.createDataFrame([], shape)
    for _ in range(rounds):
        after = moved(kept, centroids, dimension, scale)
        if after == centroids:  # each further round would give the same
            break
        centroids = after
    search = Search.of(centroids)

    def long(values) -> pa.Array:
        return pa.array([v if v < 1 << 63 else None for v in map(int, values)], pa.int64())

    def totals(batches):
        for b in batches:
            sums = np.zeros(len(centroids), dtype=object)
            for _, x in blocks_of(b, dimension, scale):
                which, d = search.nearest(x)
                for c in np.unique(which):
                    sums[c] += int(d[which == c].astype(np.int64 if d.dtype != object else object).sum())
            yield pa.RecordBatch.from_arrays([pa.array(range(len(sums)), pa.int32()), pa.array([min(v, 1 << 100) for v in sums], pa.decimal128(38, 0))], names=["cluster", "d"])

    # a sum past 64 bits is null in the end, so no more than 2^100 of it is carried
    sums = {r["cluster"]: int(r["d"]) for r in kept.select("x").mapInArrow(totals, "cluster int, d decimal(38,0)")
            .groupBy("cluster").agg(F.sum("d").alias("d")).collect()}
    inertia, each = sum(sums.values()), [sums.get(c, 0) for c in range(len(centroids))]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]

    def run(batches):
        for b in batches:
            for at, x in blocks_of(b, dimension, scale):
                which, d = search.nearest(x)
                yield pa.RecordBatch.from_arrays([
                    b.column("vec_id").slice(at, len(x)), pa.array(which, pa.int32()), long(d), long(each[c] for c in which), long([inertia] * len(x)),
                    pa.array([digests[c] for c in which], pa.string())], names=["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"])

    return kept.mapInArrow(run, shape)
