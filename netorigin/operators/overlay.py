"""Overlay layers restricted to space that first-party evidence justifies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netorigin.functions.space import V4
from netorigin.operators.ranges import intersect_ranges, merge_ranges, subtract_ranges


def justified_space(base: DataFrame, asns: DataFrame, manual: DataFrame, space=V4) -> DataFrame:
    """Ranges of listed ASNs together with hand-listed netblocks, merged."""
    own = base.join(asns.select("asn").distinct(), "asn", "left_semi").select("range_start", "range_end")
    return merge_ranges(own.unionByName(manual.select("range_start", "range_end")), space)


def whitelist(published: DataFrame, justified: DataFrame, space=V4) -> DataFrame:
    return merge_ranges(intersect_ranges(published, justified, space), space)


def blacklist(published: DataFrame, feeds: DataFrame, justified: DataFrame, space=V4) -> DataFrame:
    strip = subtract_ranges(feeds, justified, space)
    return merge_ranges(subtract_ranges(published, strip, space), space)


def accounting(published: DataFrame, kept: DataFrame, method: str, space=V4) -> DataFrame:
    size = F.coalesce(F.sum(space.size(F.col("range_start"), F.col("range_end"))), F.lit(0).cast("bigint"))
    p = published.agg(F.count("*").alias("published_ranges"), size.alias("published_addresses"))
    k = kept.agg(F.count("*").alias("kept_ranges"), size.alias("kept_addresses"))
    one = lambda d: d.withColumn("method", F.lit(method))
    return one(p).join(one(k), "method").withColumn(
        "dropped_addresses", F.col("published_addresses") - F.col("kept_addresses"))
