"""Column helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` over `value`, which is evaluated once per row however often `body` names it."""
    return F.transform(F.array(value), body)[0]


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    r"""Array of the words `[^\x20\x09-\x0D]+`; null and blank texts give an empty array."""
    return F.array_remove(F.split(text_or_empty(text), r"[\x20\x09-\x0D]+"), "")


def grams(items: Column, n: int) -> Column:
    """64-bit hashes of all runs of `n` consecutive items; empty when there are fewer.

    Runs of length a and b at neighbouring places give one of a + b, so a run costs log n hashes, not n.
    """
    def grow(a: Column, have: int, acc: Column | None, got: int, left: int) -> Column:
        # acc: hashes of runs of length `got`; a: of length `have`
        if left & have:
            acc, got, left = (a, have, left - have) if acc is None else (joined(acc, a, got), got + have, left - have)
        if not left:
            return acc
        return let(joined(a, a, have), lambda d: let(acc, lambda k: grow(d, 2 * have, k, got, left)) if acc is not None
                   else grow(d, 2 * have, None, 0, left))

    def joined(x: Column, y: Column, gap: int) -> Column:
        return F.transform(x, lambda h, i: F.xxhash64(h, F.get(y, i + gap)))

    return let(items, lambda a: F.when(F.size(a) < n, F.array().cast("array<bigint>")).otherwise(
        let(F.transform(a, lambda x: F.xxhash64(x)), lambda one: let(
            grow(one, 1, None, 0, n), lambda h: F.slice(h, F.lit(1), F.size(h) - (n - 1))))))


def ordered_buckets(df: DataFrame, key: str, count: int) -> list[int]:
    """At most `count` - 1 lower bounds that cut the values of the long column `key` into buckets of about equal size.

    An approximate quantile summary (mergeable, a few kilobytes a task) finds them; the driver sees the bounds alone.
    """
    q = [i / count for i in range(1, count)]
    got = df.agg(F.percentile_approx(F.col(key).cast("bigint"), q, 100 * count).alias("q")).first()["q"] if q else []
    return sorted(set(got or []))


def bucket_of(key: Column, bounds: list[int]) -> Column:
    """Ordinal of the bucket that holds `key`: how many bounds are at or below it.  Null keys come last."""
    if not bounds:
        return F.when(key.isNull(), F.lit(1)).otherwise(F.lit(0)).cast("int")
    table = F.lit(bounds).cast("array<bigint>")
    steps = F.lit([1 << i for i in reversed(range(len(bounds).bit_length()))])
    found = F.aggregate(steps, F.lit(0), lambda lo, s: F.when(
        (lo + s <= len(bounds)) & (F.get(table, lo + s - 1) <= key), lo + s).otherwise(lo))
    return F.when(key.isNull(), F.lit(len(bounds) + 1)).otherwise(found).cast("int")


def parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def blocks(batch, chars: int = 4_000_000) -> Iterator[tuple[list, list]]:
    """Runs of rows of a two-column Arrow batch (key, text) with about `chars` bytes of text each, as Python lists."""
    names, texts = batch.column(0), batch.column(1)
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    at = size = 0
    for i, n in enumerate(sizes):
        if size and size + n > chars:
            yield names.slice(at, i - at).to_pylist(), texts.slice(at, i - at).to_pylist()
            at, size = i, 0
        size += n
    if at < len(sizes):
        yield names.slice(at).to_pylist(), texts.slice(at).to_pylist()
