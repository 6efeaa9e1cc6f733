"""Per-network measures: eyeballs, prefix footprint, route validation, one merged record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netorigin.functions import text as tx
from netorigin.functions.space import V4, V6
from netorigin.operators.forest import covering_chain
from netorigin.operators.joins import merge_sources
from netorigin.operators.lineage import cut
from netorigin.operators.ranges import union_size
from netorigin.operators.scan import scan


def global_rank(df: DataFrame, desc: str, tie: str, name: str) -> DataFrame:
    """1-based position by (desc descending, tie ascending) over the whole table.

    A row number without PARTITION BY would be one task; here it is the prefix
    scan over the pair (-desc, tie).  (desc, tie) must be unique.
    """
    key = F.struct((-F.col(desc)).cast("bigint").alias("hi"), F.col(tie).cast("bigint").alias("lo"))
    s = scan(df.withColumns({"pos": key, "one": F.lit(1).cast("bigint")}), V6, sums=("one",))
    return s.withColumnRenamed("run_one", name).drop("pos", "one")


def eyeball_totals(eyeballs: DataFrame) -> DataFrame:
    """eyeballs(asn, users, pct) per economy -> one row per ASN with its rank."""
    t = eyeballs.groupBy("asn").agg(F.sum(F.coalesce("users", F.lit(0))).cast("bigint").alias("eyeball_users"),
                                    F.round(F.sum(F.coalesce(F.col("pct").cast("decimal(20,10)"), F.lit(0))), 4).cast("double").alias("eyeball_pct_internet"))
    return global_rank(t, "eyeball_users", "asn", "eyeball_rank")


def roa_counts(vrps: DataFrame) -> DataFrame:
    return vrps.groupBy("asn").agg(F.count("*").alias("rpki_roas"))


def prefix_footprint(p4: DataFrame, p6: DataFrame | None = None) -> DataFrame:
    """(net, len, asn) per family -> counts and covered addresses per ASN.

    Counts are plain; address space counts overlaps once.  The IPv6 size is text.
    """
    def one(p: DataFrame, space, fam: str, out: str) -> DataFrame:
        r = p.select("asn", F.col("net").alias("range_start"), space.last(F.col("net"), F.col("len")).alias("range_end"))
        size = union_size(r, space, ("asn",)).withColumnRenamed("addresses", out)
        return p.groupBy("asn").agg(F.count("*").alias(f"prefixes_{fam}")).join(size, "asn")

    a = one(p4, V4, "v4", "ipv4_addresses")
    zero = F.lit(0).cast("bigint")
    if p6 is None:
        return a.select("asn", "prefixes_v4", zero.alias("prefixes_v6"), "ipv4_addresses", F.lit("0").alias("ipv6_addresses"))
    b = one(p6, V6, "v6", "ipv6_addresses")
    return a.join(b, "asn", "full").select(
        "asn", F.coalesce("prefixes_v4", zero).alias("prefixes_v4"), F.coalesce("prefixes_v6", zero).alias("prefixes_v6"),
        F.coalesce("ipv4_addresses", zero).alias("ipv4_addresses"),
        F.coalesce(F.col("ipv6_addresses").cast("string"), F.lit("0")).alias("ipv6_addresses"))


def route_states(routes: DataFrame, vrps: DataFrame, space=V4) -> DataFrame:
    """Validation state of each distinct route(net, len, asn): valid | invalid | notfound.

    A route's chain of covering prefixes says whether it is covered at all.  Stored prefixes collapse to one row per
    (net, len, asn) with the widest permitted length, and meet the chains of that ASN's routes only.
    """
    r = routes.select("net", F.col("len").cast("int").alias("len"), F.col("asn").cast("bigint").alias("asn")).distinct()
    v = vrps.select("net", F.col("len").cast("int").alias("len"), F.col("asn").cast("bigint").alias("asn"), "maxlen").groupBy("net", "len", "asn").agg(F.max("maxlen").alias("maxlen"))
    chain = cut(covering_chain(r, v, space))
    named = r.withColumnsRenamed({"net": "route_net", "len": "route_len"})
    covered = chain.select("route_net", "route_len").distinct().withColumn("covered", F.lit(True))
    fits = (named.join(chain, ["route_net", "route_len"]).join(v, ["net", "len", "asn"]).filter(F.col("maxlen") >= F.col("route_len"))
            .select("route_net", "route_len", "asn").distinct().withColumn("ok", F.lit(True)))
    return (named.join(covered, ["route_net", "route_len"], "left").join(fits, ["route_net", "route_len", "asn"], "left")
            .select(F.col("route_net").alias("net"), F.col("route_len").alias("len"), "asn", F.when(F.col("ok"), F.lit("valid")).when(F.col("covered"), F.lit("invalid")).otherwise(F.lit("notfound")).alias("state")))


def route_validation(states: DataFrame) -> DataFrame:
    """Counts per ASN and the summary status."""
    n = lambda s: F.count_if(F.col("state") == s).alias(f"rov_{s}")
    return states.groupBy("asn").agg(n("valid"), n("invalid"), n("notfound")).withColumn(
        "rpki_rov_status",
        F.when(F.col("rov_invalid") > 0, "has_invalids")
        .when((F.col("rov_valid") > 0) & (F.col("rov_notfound") == 0), "all_valid")
        .when(F.col("rov_valid") > 0, "partial").otherwise("unknown"))


def announced(base4: DataFrame, base6: DataFrame | None = None) -> DataFrame:
    """Announced IPv4 ranges, addresses, and whether IPv6 is announced, per ASN."""
    a = base4.groupBy("asn").agg(F.count("*").alias("ranges"), F.sum(V4.size(F.col("range_start"), F.col("range_end"))).alias("addresses"))
    if base6 is None:
        return a.withColumn("has_v6", F.lit(False))
    six = base6.select("asn").distinct().withColumn("six", F.lit(True))
    zero = F.lit(0).cast("bigint")
    return a.join(six, "asn", "full").select(
        "asn", F.coalesce("ranges", zero).alias("ranges"), F.coalesce("addresses", zero).alias("addresses"),
        F.coalesce("six", F.lit(False)).alias("has_v6"))


def neighbour_counts(neighbours: DataFrame, samples: int = 5) -> DataFrame:
    """neighbours(asn, neighbour, side, position) -> counts by side and the first few samples.

    Samples are cut to five per (asn, side) before anything is gathered.
    """
    side = F.col("side")
    counts = neighbours.groupBy("asn").agg(*[F.count_if(side == s).alias(f"{s}_count") for s in ("left", "right", "uncertain")])
    w = Window.partitionBy("asn", "side").orderBy("position")
    top = neighbours.filter(side.isin("left", "right")).withColumn("r", F.row_number().over(w)).filter(F.col("r") <= samples)
    pick = lambda s: F.transform(F.array_sort(F.collect_list(F.when(side == s, F.struct("r", "neighbour")))), lambda x: x["neighbour"])
    return counts.join(top.groupBy("asn").agg(pick("left").alias("sample_left"), pick("right").alias("sample_right")), "asn", "left")


# What each source contributes and how it is named in provenance.
SOURCE_FIELDS = {
    "rir": ("registry delegations", ["rir", "country", "allocated", "status", "org_hash"]),
    "rank": ("AS rank", ["rir", "country", "asn_name", "asrank", "cone_asns", "degree_total"]),
    "eyeball": ("eyeball estimates", ["eyeball_users", "eyeball_pct_internet", "eyeball_rank"]),
    "rpki": ("validated payloads", ["rpki_roas"]),
    "prefixes": ("prefix table", ["prefixes_v4", "prefixes_v6", "ipv4_addresses", "ipv6_addresses"]),
    "rov": ("route validation", ["rov_valid", "rov_invalid", "rov_notfound", "rpki_rov_status"]),
}


def quant_records(tables: dict[str, DataFrame], as_of: str, urls: dict[str, str] | None = None) -> DataFrame:
    """Merged record per ASN: (asn, quant struct, sources array).

    `tables` maps rir, rank, eyeball, rpki, prefixes, rov to per-ASN tables; any
    may lack an ASN.  The registry file beats the ranking for rir and country;
    provenance lists only the sources that have the ASN.  Bogon ASNs are left out.
    """
    urls = urls or {}
    m = merge_sources(tables).filter(~tx.bogon_asn(F.col("asn")))
    f = lambda s, c: F.col(f"{s}.{c}")
    fields: list[Column] = [
        F.coalesce(tx.canonical_registry(f("rir", "rir")), tx.canonical_registry(f("rank", "rir"))).alias("rir"),
        F.coalesce(f("rir", "country"), f("rank", "country")).alias("country"),
    ]
    for s, df in tables.items():
        fields += [f(s, c).alias(c) for c in df.columns if c not in ("asn", "rir", "country")]
    prov = F.array_compact(F.array(*[
        F.when(F.col(s).isNotNull(), F.struct(
            F.array(*[F.lit(x) for x in SOURCE_FIELDS[s][1]]).alias("fields"), F.lit(SOURCE_FIELDS[s][0]).alias("source"),
            F.lit(urls.get(s, "")).alias("url"), F.lit(as_of).alias("as_of")))
        for s in tables]))
    return m.select("asn", F.struct(F.col("asn"), *fields).alias("quant"), prov.alias("sources"))
