"""Brute-force models on small address lines, and conversions."""

from pyspark.sql import functions as F

from netorigin.functions.space import V4, V6

RANGE = "range_start bigint, range_end bigint"


def ranges(spark, rows, extra=""):
    return spark.createDataFrame(rows, RANGE + extra)


def half(x):
    return x - (1 << 63)


def addr6(x):
    return (half(x >> 64), half(x & ((1 << 64) - 1)))


def ranges6(spark, rows, extra=""):
    return spark.createDataFrame([(addr6(a), addr6(b), *r) for a, b, *r in rows], f"range_start {V6.ddl}, range_end {V6.ddl}" + extra)


def back(df, space, *cols):
    """Rows with integer endpoints, sorted."""
    h = df.select(space.hex(F.col("range_start")).alias("s"), space.hex(F.col("range_end")).alias("e"), *cols).collect()
    return sorted((int(r[0], 16), int(r[1], 16), *r[2:]) for r in h)


def covered(rows):
    out = set()
    for a, b, *_ in rows:
        out.update(range(a, b + 1))
    return out


def runs(points):
    out = []
    for p in sorted(points):
        if out and out[-1][1] == p - 1:
            out[-1][1] = p
        else:
            out.append([p, p])
    return [tuple(r) for r in out]


def build(spark, space, rows, extra="", base=0):
    if space is V4:
        return ranges(spark, [(base + a, base + b, *r) for a, b, *r in rows], extra)
    return ranges6(spark, [(base + a, base + b, *r) for a, b, *r in rows], extra)
