"""Base layer + overlays -> effective intervals, the product rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netorigin.functions import vocab
from netorigin.functions.space import V4
from netorigin.operators.profile import profile, with_evidence
from netorigin.operators.ranges import coalesce_equal, sweep


def effective_segments(base: DataFrame, vpn: DataFrame, dc: DataFrame, space=V4) -> DataFrame:
    """Elementary segments of the three layers with asn and flags of the base row."""
    return sweep(space, {"base": base, "vpn": vpn, "dc": dc}, {"base": ["asn", "flags"]}).select(
        "range_start", "range_end", "asn", F.coalesce("flags", F.lit(0)).alias("flags"),
        F.col("in_vpn").alias("vpn_range"), F.col("in_dc").alias("datacenter_range"))


def attach_org(df: DataFrame, names: DataFrame) -> DataFrame:
    """Organisation name per ASN; null for a missing ASN or name.

    The name table has one row per ASN (a few MB); whether it is broadcast is
    left to Spark's own size check, and AQE splits a hot ASN otherwise.
    """
    return df.join(names.select("asn", F.col("name").alias("as_org")), "asn", "left")


def intervals(base: DataFrame, vpn: DataFrame, dc: DataFrame, names: DataFrame, space=V4) -> DataFrame:
    """Product rows.  The payload is a function of (asn, flags, vpn, dc) and the
    name, so segments are joined on those four columns first and only the joined
    rows are named and classified.

    Two ASNs with one name and equal flags stay apart because the ASN is part of
    the payload; flags that decode equally are equal, so nothing else can differ.
    """
    seg = coalesce_equal(effective_segments(base, vpn, dc, space), space,
                         ["asn", "flags", "vpn_range", "datacenter_range"])
    rows = profile(with_evidence(attach_org(seg, names)))
    return rows.select(F.lit(space.version).alias("ip_version"), "range_start", "range_end", *vocab.PAYLOAD_FIELDS)


def to_wire(df: DataFrame, space=V4) -> DataFrame:
    """Replace the endpoints by fixed-width hex text."""
    return df.select(
        "ip_version", space.hex(F.col("range_start")).alias("start_hex"), space.hex(F.col("range_end")).alias("end_hex"),
        *vocab.PAYLOAD_FIELDS)
