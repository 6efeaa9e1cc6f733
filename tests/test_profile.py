"""Contract cases of the verdict ladder and of the sweep."""

from helpers import back, ranges
from pyspark.sql import functions as F

from netorigin.functions import vocab
from netorigin.functions.space import V4
from netorigin.operators import classify, profile, project

# id, asn, flags, vpn_range, datacenter_range, verdict, sources
CASES = [
    ("no-category", 123, 0, 0, 0, "unknown", "asn_no_category"), ("unrouted", None, 0, 0, 0, "unknown", "unrouted"),
    ("isp-access", 123, 65, 0, 0, "residential_isp", "asn_category"), ("isp-major-transit", 123, 33, 0, 0, "residential_isp", "asn_category"),
    ("isp-midsize-transit", 123, 49, 0, 0, "residential_isp", "asn_category"), ("isp-tier1", 123, 17, 0, 0, "unknown", "isp_transit_ambiguous"),
    ("isp-null-role", 123, 1, 0, 0, "residential_isp", "asn_category"), ("hosting-content-network", 123, 82, 0, 0, "hosting", "asn_category"),
    ("business-stub", 123, 99, 0, 0, "business", "asn_category"), ("hosting-category", 123, 2, 0, 0, "hosting", "asn_category"),
    ("business", 123, 3, 0, 0, "business", "asn_category"), ("education", 123, 4, 0, 0, "education", "asn_category"),
    ("government", 123, 5, 0, 0, "government", "asn_category"), ("mobile", 123, 1024, 0, 0, "mobile", "asn_mobile_carrier"),
    ("hosting-beats-mobile", 123, 1026, 0, 0, "hosting", "asn_category"), ("bad-asn", 123, 256, 0, 0, "hosting", "asn_bad_asn"),
    ("cdn", 123, 4096, 0, 0, "hosting", "asn_cdn"), ("extra-hosting", 123, 8192, 0, 0, "hosting", "asn_hosting_extra"),
    ("all-hosting-sources", 123, 12546, 0, 0, "hosting", "asn_bad_asn|asn_hosting_extra|asn_cdn|asn_category"),
    ("vpn-asn", 123, 512, 0, 0, "vpn", "asn_vpn_provider"), ("gateway", 123, 2048, 0, 0, "enterprise_gateway", "asn_enterprise_gw"),
    ("gateway-beats-dc", 123, 2048, 0, 1, "enterprise_gateway", "asn_enterprise_gw"), ("vpn-asn-beats-gateway", 123, 2560, 0, 0, "vpn", "asn_vpn_provider"),
    ("vpn-range-beats-vpn-asn", 123, 512, 1, 0, "vpn", "x4b_vpn"), ("vpn-range-beats-dc", 123, 0, 1, 1, "vpn", "x4b_vpn"),
    ("dc-beats-category-source", 123, 2, 0, 1, "hosting", "x4b_dc"), ("overlay-only-vpn", None, 0, 1, 0, "vpn", "x4b_vpn"),
    ("overlay-only-dc", None, 0, 0, 1, "hosting", "x4b_dc"), ("asn-zero-is-present", 0, 0, 0, 0, "unknown", "asn_no_category"),
]
INVALID = [("reserved-category", 123, 6), ("reserved-role", 123, 112), ("reserved-bit14", 123, 16384), ("reserved-bit15", 123, 32768),
           ("missing-asn-with-flags", None, 65)]


def test_contract_cases(spark):
    rows = [(i, a, f, bool(v), bool(d), w, s) for i, a, f, v, d, w, s in CASES]
    df = spark.createDataFrame(rows, "id string, asn bigint, flags int, vpn_range boolean, datacenter_range boolean, verdict string, sources string")
    p = profile.profile(profile.with_evidence(df)).withColumn("second", classify.second_ladder(
        F.col("flags"), F.col("asn").isNotNull(), F.col("vpn_range"), F.col("datacenter_range"))["verdict"])
    p = p.withColumn("violation", profile.profile_violation(F.col("flags")))
    for r in p.collect():
        assert (r.core_verdict, "|".join(r.core_sources), r.second, r.violation) == (r.verdict, r.sources, r.verdict, None), r.id


def test_invalid_inputs(spark):
    df = profile.with_evidence(spark.createDataFrame(INVALID, "id string, asn bigint, flags int"), vpn=F.lit(False), dc=F.lit(False))
    assert all(r.v is not None for r in df.select(profile.profile_violation(F.col("flags")).alias("v")).collect())


S = 16777216
EXPECTED = [
    (0, 4, 100, "Access A", False, False, "residential_isp", "asn_category"), (5, 7, 100, "Access A", False, True, "hosting", "x4b_dc"),
    (8, 9, 100, "Access A", True, True, "vpn", "x4b_vpn"), (10, 12, 200, "Host B", True, True, "vpn", "x4b_vpn"),
    (13, 15, 200, "Host B", False, True, "hosting", "x4b_dc"), (16, 19, 200, "Host B", False, False, "hosting", "asn_category"),
    (20, 29, 300, "Gateway C", False, False, "enterprise_gateway", "asn_enterprise_gw"), (35, 39, None, None, False, True, "hosting", "x4b_dc"),
    (40, 40, None, None, True, True, "vpn", "x4b_vpn"), (41, 41, None, None, True, False, "vpn", "x4b_vpn"),
]


def layers(spark):
    base = ranges(spark, [(S, S + 9, 100, 65), (S + 10, S + 19, 200, 98), (S + 20, S + 29, 300, 2115)], ", asn bigint, flags int")
    vpn, dc = ranges(spark, [(S + 8, S + 12), (S + 40, S + 41)]), ranges(spark, [(S + 5, S + 15), (S + 35, S + 40)])
    names = spark.createDataFrame([(100, "Access A"), (200, "Host B"), (300, "Gateway C")], "asn bigint, name string")
    return base, vpn, dc, names


def test_ten_intervals(spark):
    iv = project.intervals(*layers(spark))
    got = back(iv, V4, "asn", "as_org", "vpn_range", "datacenter_range", "core_verdict", F.array_join("core_sources", "|"))
    assert got == [(S + a, S + b, *r) for a, b, *r in EXPECTED]
    assert sum(b - a + 1 for a, b, *_ in got) == 37
    assert iv.columns[3:] == vocab.PAYLOAD_FIELDS


def test_lookup_hits_and_misses(spark):
    base, vpn, dc, _ = layers(spark)
    ips = spark.createDataFrame([(S + x,) for x in range(-1, 43)] + [(0,), (167772161,)], "ip bigint")
    got = {r.ip - S: (r.verdict, r.asn) for r in classify.lookup(ips, classify.lookup_table(base, vpn, dc)).collect()}
    want = {x: (v, n) for a, b, n, _, _, _, v, _ in EXPECTED for x in range(a, b + 1)}
    for miss in (30, 31, 32, 33, 34, 42):
        want[miss] = ("unknown", None)
    want[-1] = want[-S] = want[167772161 - S] = ("private", None)
    assert got == want
