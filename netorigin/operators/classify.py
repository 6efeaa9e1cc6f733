"""Lookup of addresses: special blocks, three layers, and the second verdict ladder.

The ladder here is written apart from the one in profile.py on purpose: a
defect in either shows up as a disagreement between the two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netorigin.functions.addr import special_verdict
from netorigin.functions.space import V4
from netorigin.operators.joins import resolve_points
from netorigin.operators.project import effective_segments


def second_ladder(flags: Column, has_base: Column, in_vpn: Column, in_dc: Column) -> Column:
    """struct(verdict, rule) from the raw evidence word."""
    bit = lambda n: F.getbit(flags, F.lit(n)) == 1
    cat = flags % 16
    tier1 = F.shiftright(flags, 4) % 16 == 1
    v = lambda verdict, rule: F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))
    return (
        F.when(in_vpn, v("vpn", "x4b_vpn"))
        .when(bit(9), v("vpn", "asn_vpn_provider"))
        .when(bit(11), v("enterprise_gateway", "asn_enterprise_gw"))
        .when(in_dc, v("hosting", "x4b_dc"))
        .when(bit(8) | bit(13) | bit(12) | (cat == 2), v("hosting", "asn_category"))
        .when(bit(10), v("mobile", "asn_mobile"))
        .when((cat == 1) & ~tier1, v("residential_isp", "asn_category"))
        .when(cat == 3, v("business", "asn_category"))
        .when(cat == 4, v("education", "asn_category"))
        .when(cat == 5, v("government", "asn_category"))
        .when(cat == 1, v("unknown", "isp_transit_ambiguous"))
        .when(has_base, v("unknown", "no_category"))
        .otherwise(v("unknown", "unrouted"))
    )


def verdict_of(addr: Column, space=V4) -> Column:
    """struct(verdict, rule) of a row joined with a segment; specials come first."""
    return F.coalesce(
        special_verdict(addr, space),
        second_ladder(F.coalesce(F.col("flags"), F.lit(0)), F.col("asn").isNotNull(),
                      F.coalesce(F.col("vpn_range"), F.lit(False)), F.coalesce(F.col("datacenter_range"), F.lit(False))))


def lookup_table(base: DataFrame, vpn: DataFrame, dc: DataFrame, space=V4) -> DataFrame:
    """The three layers as one disjoint table, so an address is matched once."""
    return effective_segments(base, vpn, dc, space)


def lookup(addresses: DataFrame, table: DataFrame, space=V4, addr: str = "ip") -> DataFrame:
    """One row per distinct address: verdict, rule, asn.  Every address gets a verdict."""
    hit = resolve_points(addresses, table, space, ["asn", "flags", "vpn_range", "datacenter_range"], addr)
    distinct = addresses.select(addr).distinct()
    v = distinct.join(hit, addr, "left").withColumn("v", verdict_of(F.col(addr), space))
    special = special_verdict(F.col(addr), space).isNotNull()
    return v.select(addr, "v.verdict", "v.rule", F.when(~special, F.col("asn")).alias("asn"))


def classify_points(points: DataFrame, table: DataFrame, space=V4, addr: str = "ip") -> DataFrame:
    """Verdict columns on every point row."""
    return points.join(lookup(points, table, space, addr), addr)


def stored_verdicts(points: DataFrame, index, addr: str = "ip") -> DataFrame:
    """points + verdict, rule, asn from a stored index of the lookup table; batch or stream.  Every non-null address gets a verdict."""
    hit = index.lookup(points, addr, how="left").withColumn("v", verdict_of(F.col(addr), index.space))
    special = special_verdict(F.col(addr), index.space).isNotNull()
    return hit.select(*points.columns, "v.verdict", "v.rule", F.when(~special, F.col("asn")).alias("asn"))
