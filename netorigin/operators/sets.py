"""Set operations on ASN lists and whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_lists(*lists: DataFrame, key: str = "asn") -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), [l.select(key) for l in lists]).distinct()


def difference(a: DataFrame, b: DataFrame, key: str = "asn") -> DataFrame:
    return a.select(key).distinct().join(b.select(key).distinct(), key, "left_anti")


def intersection(a: DataFrame, b: DataFrame, key: str = "asn") -> DataFrame:
    return a.select(key).distinct().join(b.select(key).distinct(), key, "left_semi")


def without(left: DataFrame, right: DataFrame, key: str = "asn") -> DataFrame:
    """Rows of `left` without a match.  The right side is reduced to its keys first."""
    return left.join(right.select(key).distinct(), key, "left_anti")


def within(left: DataFrame, right: DataFrame, key: str = "asn") -> DataFrame:
    return left.join(right.select(key).distinct(), key, "left_semi")


def table_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that the two tables do not hold equally often: side, n and the row.

    Rows count +1 in A and -1 in B in one aggregation with map-side combine; equal
    tables cancel out.
    """
    cols = a.columns
    one = lambda df, n: df.select(*cols, F.lit(n).cast("bigint").alias("_n"))
    d = one(a, 1).unionByName(one(b, -1)).groupBy(*cols).agg(F.sum("_n").alias("_n")).filter("_n <> 0")
    return d.select(F.when(F.col("_n") > 0, "only_a").otherwise("only_b").alias("side"), F.abs("_n").alias("n"), *cols)
