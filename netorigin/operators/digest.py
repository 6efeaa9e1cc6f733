"""An order-free digest of a table: how many rows, and a 128-bit sum over the rows.

Each row becomes its JSON text, with nulls and the names of the columns, and two 64-bit hashes of it.  The sums of both over all rows do not depend on order,
partitioning or grouping, a partial sum per task is all that is shuffled, and copies count.  Equal tables have equal digests; two tables that differ agree by
chance in 1 of 2^128.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_text(columns: list[str]) -> Column:
    """A row as text: equal for equal rows, different for different ones."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(columns)]), {"ignoreNullFields": "false"})


def table_digest(df: DataFrame) -> DataFrame:
    """(n, digest): the number of rows and 32 hexadecimal digits; an empty table has 0 and zeros.  The order of columns plays no part."""
    text = df.select(row_text(df.columns).alias("t"))
    half = lambda seed: F.sum(F.xxhash64(F.lit(seed), "t").cast("decimal(38,0)"))
    sums = text.agg(F.count("*").alias("n"), half(1).alias("a"), half(2).alias("b"))
    two64 = "cast('18446744073709551616' as decimal(38,0))"
    digits = lambda c: F.lpad(F.lower(F.conv(F.expr(f"cast(pmod(coalesce({c}, 0), {two64}) as decimal(20,0))").cast("string"), 10, 16)), 16, "0")
    return sums.select("n", F.concat(digits("a"), digits("b")).alias("digest"))


def same_digest(a: DataFrame, b: DataFrame) -> DataFrame:
    """(rows_a, rows_b, same) of two tables; one row, no row of either table is joined or moved."""
    both = table_digest(a).select(F.lit("a").alias("side"), "n", "digest").unionByName(table_digest(b).select(F.lit("b").alias("side"), "n", "digest"))
    of = lambda side, c: F.max(F.when(F.col("side") == side, F.col(c)))
    return both.agg(of("a", "n").alias("rows_a"), of("b", "n").alias("rows_b"), ((of("a", "n") == of("b", "n")) & (of("a", "digest") == of("b", "digest"))).alias("same"))
