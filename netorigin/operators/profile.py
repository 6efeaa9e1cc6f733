"""Verdict profile: the frozen ladder that explains each interval, and its input check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netorigin.functions import flags as fl
from netorigin.functions import vocab

# Rungs below the hosting rung that rest on the category alone.
BY_CATEGORY = {"business": "business", "education_research": "education", "government_admin": "government"}


def _rungs():
    """(condition, verdict, sources) in order; the first true condition decides."""
    c = F.col
    hosting = [("bad_asn", "asn_bad_asn"), ("hosting_extra", "asn_hosting_extra"), ("cdn", "asn_cdn")]
    is_hosting = F.coalesce(c("category") == "hosting", F.lit(False))
    reasons = F.array_compact(F.array(
        *[F.when(c(s), F.lit(src)) for s, src in hosting], F.when(is_hosting, F.lit("asn_category"))))
    one = lambda s: F.array(F.lit(s))
    yield c("vpn_range"), "vpn", one("x4b_vpn")
    yield c("vpn_provider"), "vpn", one("asn_vpn_provider")
    yield c("enterprise_gw"), "enterprise_gateway", one("asn_enterprise_gw")
    yield c("datacenter_range"), "hosting", one("x4b_dc")
    yield c("bad_asn") | c("hosting_extra") | c("cdn") | is_hosting, "hosting", reasons
    yield c("mobile_carrier"), "mobile", one("asn_mobile_carrier")
    yield ((c("category") == "isp") & ~c("network_role").eqNullSafe("tier1_transit"), "residential_isp",
           one("asn_category"))
    for cat, verdict in BY_CATEGORY.items():
        yield c("category") == cat, verdict, one("asn_category")
    yield c("category") == "isp", "unknown", one("isp_transit_ambiguous")
    yield c("asn").isNotNull(), "unknown", one("asn_no_category")
    yield F.lit(True), "unknown", one("unrouted")


def profile(df: DataFrame) -> DataFrame:
    """Add core_verdict and core_sources to rows with the evidence columns."""
    verdict = sources = None
    for cond, v, s in _rungs():
        verdict = F.when(cond, F.lit(v)) if verdict is None else verdict.when(cond, F.lit(v))
        sources = F.when(cond, s) if sources is None else sources.when(cond, s)
    return df.withColumns({"core_verdict": verdict, "core_sources": sources})


def with_evidence(df: DataFrame, flags: str = "flags", vpn: Column | None = None, dc: Column | None = None) -> DataFrame:
    """Decode the evidence word and attach the two range signals."""
    f = F.coalesce(F.col(flags), F.lit(0))
    cols = fl.decode(f)
    if vpn is not None:
        cols["vpn_range"] = vpn
    if dc is not None:
        cols["datacenter_range"] = dc
    return df.withColumns(cols)


def profile_violation(flags: Column | None = None) -> Column:
    """Why a row is not a valid ladder input, or null.

    With `flags` the word itself is checked too.
    """
    c = F.col
    signals = vocab.ASN_SIGNALS + vocab.RANGE_SIGNALS
    out = F.when(F.lit(False), F.lit(""))
    if flags is not None:
        word = fl.violation(flags)
        out = out.when(word.isNotNull(), word)
    out = (
        out.when((c("asn") < 0) | (c("asn") > vocab.ASN_MAX), F.lit("bad_asn"))
        .when(c("category").isNotNull() & ~c("category").isin(list(vocab.CATEGORY_CODES)), F.lit("unknown_category"))
        .when(c("network_role").isNotNull() & ~c("network_role").isin(list(vocab.ROLE_CODES)), F.lit("unknown_role"))
        .when(fl.any_of([c(s).isNull() for s in signals]), F.lit("missing_signal"))
    )
    asn_level = c("category").isNotNull() | c("network_role").isNotNull() | fl.any_of([c(s) for s in vocab.ASN_SIGNALS])
    if flags is not None:
        asn_level = asn_level | (flags != 0)
    return out.when(c("asn").isNull() & asn_level, F.lit("evidence_without_asn"))
