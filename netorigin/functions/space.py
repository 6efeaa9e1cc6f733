"""The two address spaces the range operators run on.

An IPv4 address is a BIGINT.  An IPv6 address does not fit any Spark integer or
decimal, so it is a struct<hi,lo> of two BIGINT halves.  Each half is stored
biased (unsigned value minus 2^63), which makes the struct's field-by-field
ordering equal to the numeric ordering of the 128-bit address.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LONG_MIN = -(1 << 63)
LONG_MAX = (1 << 63) - 1
# `2**64` as a decimal column: wide enough for every span below 2^126.
TWO64 = "cast('18446744073709551616' as decimal(38,0))"


class V4:
    """IPv4: BIGINT positions, /16 buckets."""

    name, version, bits, hex_width = "ipv4", 4, 32, 8
    max_value = (1 << 32) - 1
    ddl = "bigint"

    @staticmethod
    def max() -> Column:
        return F.lit(V4.max_value).cast("bigint")

    @staticmethod
    def succ(c: Column) -> Column:
        # 2^32 is a legal end sentinel inside a sweep; it is never written out.
        return c + F.lit(1).cast("bigint")

    @staticmethod
    def pred(c: Column) -> Column:
        return c - F.lit(1).cast("bigint")

    @staticmethod
    def size(start: Column, end: Column) -> Column:
        return end - start + F.lit(1).cast("bigint")

    @staticmethod
    def bucketed(positions: DataFrame, pos: str, bucket: str) -> DataFrame:
        """`positions`, distinct by `pos`, with the bucket of each.

        A /16 block holds at most 65,536 distinct addresses and there are at
        most 65,537 blocks, so neither a window partition nor the table of
        bucket carries can grow with the data.
        """
        return positions.withColumn(bucket, F.shiftright(pos, 16))

    @staticmethod
    def hex(c: Column) -> Column:
        return F.lpad(F.lower(F.hex(c)), 8, "0")

    @staticmethod
    def from_hex(c: Column) -> Column:
        return F.conv(c, 16, 10).cast("bigint")

    @staticmethod
    def mask(addr: Column, length: Column) -> Column:
        return addr - addr % F.pow(F.lit(2.0), F.lit(32) - length).cast("bigint")

    @staticmethod
    def last(net: Column, length: Column) -> Column:
        """Last address of the prefix net/length."""
        return net + F.pow(F.lit(2.0), F.lit(32) - length).cast("bigint") - F.lit(1).cast("bigint")

    @staticmethod
    def midpoint(a: Column, b: Column) -> Column:
        return a + F.floor((b - a) / 2).cast("bigint")


def unbias(c: Column) -> Column:
    return c.bitwiseXOR(F.lit(LONG_MIN))


def v6(hi: Column, lo: Column) -> Column:
    """Build an address from two halves given as unbiased 64-bit patterns."""
    return F.struct(unbias(hi).alias("hi"), unbias(lo).alias("lo"))


class V6:
    """IPv6: struct<hi,lo> positions, buckets by range partitioning."""

    name, version, bits, hex_width = "ipv6", 6, 128, 32
    max_value = (1 << 128) - 1
    ddl = "struct<hi:bigint,lo:bigint>"

    @staticmethod
    def max() -> Column:
        return F.struct(F.lit(LONG_MAX).alias("hi"), F.lit(LONG_MAX).alias("lo"))

    @staticmethod
    def succ(c: Column) -> Column:
        """Next address; null after the last one (ANSI mode forbids wrapping)."""
        hi, lo = c["hi"], c["lo"]
        one = F.lit(1).cast("bigint")
        return (
            F.when(lo < LONG_MAX, F.struct(hi.alias("hi"), (lo + one).alias("lo")))
            .when(hi < LONG_MAX, F.struct((hi + one).alias("hi"), F.lit(LONG_MIN).alias("lo")))
        )

    @staticmethod
    def pred(c: Column) -> Column:
        hi, lo = c["hi"], c["lo"]
        one = F.lit(1).cast("bigint")
        return (
            F.when(lo > LONG_MIN, F.struct(hi.alias("hi"), (lo - one).alias("lo")))
            .when(hi > LONG_MIN, F.struct((hi - one).alias("hi"), F.lit(LONG_MAX).alias("lo")))
        )

    @staticmethod
    def size(start: Column, end: Column) -> Column:
        """Exact DECIMAL(38,0) size; valid for spans below 2^126 (2000::/3 is 2^125)."""
        d = "decimal(38,0)"
        hi = (end["hi"].cast("decimal(20,0)") - start["hi"].cast("decimal(20,0)")).cast(d)
        lo = (end["lo"].cast("decimal(20,0)") - start["lo"].cast("decimal(20,0)")).cast(d)
        return ((hi * F.expr(TWO64)).cast(d) + lo + F.lit(1).cast(d)).cast(d)

    @staticmethod
    def bucketed(positions: DataFrame, pos: str, bucket: str) -> DataFrame:
        """`positions`, distinct by `pos`, range-partitioned; the partition is the bucket.

        Spark's range partitioner balances the rows, so a bucket is as large as any
        shuffle partition of the session and there are as many.  The number holds for
        this shuffle only: callers write the result before they use it.
        """
        return positions.repartitionByRange(F.col(pos)).withColumn(bucket, F.spark_partition_id().cast("bigint"))

    @staticmethod
    def hex(c: Column) -> Column:
        half = lambda h: F.lpad(F.lower(F.hex(unbias(h))), 16, "0")
        return F.concat(half(c["hi"]), half(c["lo"]))

    @staticmethod
    def from_hex(c: Column) -> Column:
        half = lambda s: F.conv(s, 16, -10).cast("bigint")
        return v6(half(F.substring(c, 1, 16)), half(F.substring(c, 17, 16)))

    @staticmethod
    def _halves(length: Column):
        """Network masks of the two halves for a prefix length 0..128."""
        top = F.least(F.greatest(length, F.lit(0)), F.lit(64))
        low = F.least(F.greatest(length - 64, F.lit(0)), F.lit(64))
        return tuple(
            F.when(n == 0, F.lit(0).cast("bigint")).otherwise(
                F.call_function("shiftleft", F.lit(-1).cast("bigint"), F.lit(64) - n)
            )
            for n in (top.cast("int"), low.cast("int"))
        )

    @staticmethod
    def mask(addr: Column, length: Column) -> Column:
        mh, ml = V6._halves(length)
        return v6(unbias(addr["hi"]).bitwiseAND(mh), unbias(addr["lo"]).bitwiseAND(ml))

    @staticmethod
    def last(net: Column, length: Column) -> Column:
        mh, ml = V6._halves(length)
        return v6(
            unbias(net["hi"]).bitwiseOR(F.bitwise_not(mh)),
            unbias(net["lo"]).bitwiseOR(F.bitwise_not(ml)),
        )

    @staticmethod
    def midpoint(a: Column, b: Column) -> Column:
        """An interior address: the middle of the high halves, or of the low
        halves when both ends share the high one."""
        half = lambda x, y: F.floor((x.cast("decimal(20,0)") + y.cast("decimal(20,0)")) / 2).cast("bigint")
        return F.when(
            a["hi"] == b["hi"], F.struct(a["hi"].alias("hi"), half(a["lo"], b["lo"]).alias("lo"))
        ).otherwise(
            F.greatest(a, F.least(b, F.struct(half(a["hi"], b["hi"]).alias("hi"), F.lit(0).cast("bigint").alias("lo"))))
        )


def space_of(version: int):
    return V4 if version == 4 else V6
