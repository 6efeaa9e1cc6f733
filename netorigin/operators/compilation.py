"""Evidence flags per ASN, flag stamping, gap fill and the category table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netorigin.functions import flags as fl
from netorigin.functions import vocab
from netorigin.functions.space import V4
from netorigin.operators.ranges import gaps, sanitize

# Which curated list sets which signal bit.
LIST_SIGNAL = {"bad_asn": "bad_asn", "vpn_provider": "vpn_provider", "mobile_carrier": "mobile_carrier",
               "enterprise_gateway": "enterprise_gw", "cdn": "cdn", "hosting_extra": "hosting_extra"}


def list_bits(lists: DataFrame) -> DataFrame:
    """lists(list, asn) -> one row per ASN: OR of the signal bits, and the eyeball mark."""
    bit = F.lit(0)
    for name, sig in LIST_SIGNAL.items():
        bit = F.when(F.col("list") == name, F.lit(1 << vocab.SIGNAL_BITS[sig])).otherwise(bit)
    return lists.groupBy("asn").agg(F.bit_or(bit).alias("bits"), F.max(F.col("list") == "eyeball_confirm").alias("eyeball"))


def asn_flags(meta: DataFrame, lists: DataFrame, corrections: DataFrame) -> DataFrame:
    """meta(asn, category, network_role), lists(list, asn), corrections(asn, category,
    network_role) -> (asn, flags), only nonzero words.

    Order of authority: metadata, then the eyeball list, then corrections (`none`
    clears); the six membership bits are added on top.
    """
    m = meta.select("asn", fl.code_of(F.col("category"), vocab.CATEGORY_CODES).alias("mc"),
                    fl.code_of(F.col("network_role"), vocab.ROLE_CODES).alias("mr"))
    c = corrections.select("asn", F.col("category").alias("cc"), F.col("network_role").alias("cr"))
    j = m.join(list_bits(lists), "asn", "full").join(c, "asn", "full")
    eyeball = F.coalesce("eyeball", F.lit(False))
    cat = F.when(eyeball, F.lit(vocab.CATEGORY_CODES["isp"])).otherwise(F.coalesce("mc", F.lit(0)))
    role = F.when(eyeball, F.lit(vocab.ROLE_CODES["access_provider"])).otherwise(F.coalesce("mr", F.lit(0)))
    cat = F.when(F.col("cc").isNotNull(), fl.code_of(F.col("cc"), vocab.CATEGORY_CODES)).otherwise(cat)
    role = F.when(F.col("cr").isNotNull(), fl.code_of(F.col("cr"), vocab.ROLE_CODES)).otherwise(role)
    word = cat.bitwiseOR(F.shiftleft(role, 4)).bitwiseOR(F.coalesce("bits", F.lit(0)))
    return j.select("asn", word.cast("int").alias("flags")).filter("flags <> 0")


def stamp(base: DataFrame, flags: DataFrame) -> DataFrame:
    """Attach flags to base rows; an ASN without flags gets 0."""
    return base.join(flags, "asn", "left").select(
        "range_start", "range_end", "asn", F.coalesce("flags", F.lit(0)).alias("flags"))


def missing_listed(lists: DataFrame, *bases: DataFrame) -> DataFrame:
    """Listed ASNs (the eyeball list left out) that originate nothing in any family."""
    asns = lists.filter(F.col("list").isin(vocab.PACKET_LISTS)).select("asn").distinct()
    for b in bases:
        asns = asns.join(b.select("asn").distinct(), "asn", "left_anti")
    return asns


def first_missing(asns: DataFrame, n: int | None = None) -> DataFrame:
    """The report of the missing ASNs in order: all of them, or the lowest `n` that a caller asks for."""
    ordered = asns.orderBy("asn")
    return ordered if n is None else ordered.limit(n)


def gap_fill(base: DataFrame, missing: DataFrame, candidates: DataFrame, flags: DataFrame, space=V4) -> DataFrame:
    """Give missing ASNs their candidate ranges, only where the base leaves space.

    candidates(range_start, range_end, asn).  Candidates are clipped against the
    original base; two that collide are settled by the sanitizer.
    """
    c = candidates.join(missing.select("asn"), "asn", "left_semi").select("range_start", "range_end", "asn")
    added = stamp(gaps(c, base.select("range_start", "range_end"), space), flags)
    return sanitize(base.select("range_start", "range_end", "asn", "flags").unionByName(added), space, "asn")


def only_routed(rows: DataFrame, *bases: DataFrame) -> DataFrame:
    """Rows whose ASN originates something in either family."""
    routed = bases[0].select("asn")
    for b in bases[1:]:
        routed = routed.unionByName(b.select("asn"))
    return rows.join(routed.distinct(), "asn", "left_semi")


def asn_categories(meta: DataFrame, flags: DataFrame, names: DataFrame, countries: DataFrame, *bases: DataFrame) -> DataFrame:
    """Metadata ASNs that are routed or carry a name, a country or flags."""
    routed = bases[0].select("asn")
    for b in bases[1:]:
        routed = routed.unionByName(b.select("asn"))
    j = (
        meta.select("asn")
        .join(flags, "asn", "left")
        .join(names.select("asn", F.col("name").alias("org")), "asn", "left")
        .join(countries.select("asn", F.col("cc").alias("country")), "asn", "left")
        .join(routed.distinct().withColumn("routed", F.lit(True)), "asn", "left")
    )
    f = F.coalesce("flags", F.lit(0))
    return j.filter(
        F.col("routed").isNotNull() | F.col("org").isNotNull() | F.col("country").isNotNull() | (f != 0)
    ).select("asn", "org", "country", fl.category(f).alias("category"), fl.role(f).alias("network_role"),
             fl.flag_names(f).alias("flags"))
