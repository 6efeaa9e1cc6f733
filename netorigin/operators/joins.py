"""Address joins and per-ASN merges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netorigin.operators.forest import covering_chain, flatten, most_specific
from netorigin.operators.lineage import cut
from netorigin.operators.ranges import coalesce_equal
from netorigin.operators.scan import scan

# An IPv4 table has at most 2^17 - 1 distinct prefixes of length 0..16.
BOUNDED_LEN = 16


def resolve_points(addresses: DataFrame, intervals: DataFrame, space, payload: list[str],
                   addr: str = "ip") -> DataFrame:
    """Distinct addresses -> the interval that contains them (predecessor, then
    containment).  Addresses in a gap give no row.

    Copies of an address collapse before the shuffle, so a hot address costs one
    row here however often it occurs.  `intervals` must be disjoint.
    """
    cols = ["range_end", *payload]
    starts = intervals.select(F.col("range_start").alias("pos"), F.lit(True).alias("starts"), *cols)
    asked = addresses.select(F.col(addr).alias("pos"), F.lit(True).alias("asked")).filter("pos is not null")
    # Disjoint intervals start once per position, so a maximum per column is the value.
    ev = starts.unionByName(asked, allowMissingColumns=True).groupBy("pos").agg(
        F.max("asked").alias("asked"), F.max("starts").alias("starts"), *[F.max(c).alias(c) for c in cols])
    ev = ev.select("pos", "asked", F.when(F.col("starts"), F.struct(F.col("pos").alias("range_start"), *cols)).alias("iv"))
    return scan(ev, space, lasts=("iv",)).filter("asked and last_iv.range_end >= pos").select(
        F.col("pos").alias(addr), "last_iv.*")


def point_in_interval(points: DataFrame, intervals: DataFrame, space, payload: list[str],
                      addr: str = "ip", how: str = "inner") -> DataFrame:
    """Attach the containing interval to every point row.

    The lookup result has one row per address, so AQE may split a hot address on
    the point side and replicate that single row.
    """
    return points.join(resolve_points(points, intervals, space, payload, addr), addr, how)


def observed_lengths(prefixes: DataFrame) -> list[int]:
    """Prefix lengths that occur: at most 33 or 129 values on the driver."""
    return sorted(r[0] for r in prefixes.select(F.col("len").cast("int")).distinct().collect())


def _probe(df: DataFrame, addr: str, space, lengths: list[int], max_len: Column | None = None) -> DataFrame:
    ls = F.array(*[F.lit(l) for l in lengths])
    if max_len is not None:
        ls = F.filter(ls, lambda l: l <= max_len)
    return df.withColumn("len", F.explode(ls)).withColumn("net", space.mask(F.col(addr), F.col("len")))


def lpm_distinct(addresses: DataFrame, prefixes: DataFrame, space, payload: list[str], addr: str = "ip") -> DataFrame:
    """Longest-prefix match for distinct addresses: in IPv4 one equi-join per probe length, in IPv6 along the line (forest.py).

    Short IPv4 prefixes, each of which may cover a large share of the addresses,
    are few by arithmetic and are broadcast; a longer prefix holds at most 2^15
    addresses, so no shuffled key can grow with the data.
    """
    if space.version == 6:  # long IPv6 prefixes may each cover any share of the addresses
        return most_specific(addresses, prefixes, space, payload, addr)
    lengths = observed_lengths(prefixes) or [0]
    # One number per prefix, longer prefixes above shorter ones: the best of an address is a plain maximum, one narrow row an address.
    key = (F.col("len").cast("bigint") * F.lit(1 << 32).cast("bigint") + F.col("net")).alias("_key")
    body = prefixes.select(F.col("net"), F.col("len").cast("int").alias("len"), *payload, key)
    found = []
    short = F.col("len") <= BOUNDED_LEN
    for ls, part in (([l for l in lengths if l <= BOUNDED_LEN], F.broadcast(body.filter(short).select("net", "len", "_key"))),
                     ([l for l in lengths if l > BOUNDED_LEN], body.filter(~short).select("net", "len", "_key"))):
        if ls:
            found.append(_probe(addresses, addr, space, ls).join(part, ["net", "len"]).select(addr, "_key"))
    best = cut(reduce(lambda a, b: a.unionByName(b), found).groupBy(addr).agg(F.max("_key").alias("_key")))
    edge = (BOUNDED_LEN + 1) << 32
    rows = [best.filter(F.col("_key") < edge).join(F.broadcast(body.filter(short)), "_key"), best.filter(F.col("_key") >= edge).join(body.filter(~short), "_key")]
    return rows[0].unionByName(rows[1]).select(addr, "net", "len", *payload)


def longest_prefix_match(points: DataFrame, prefixes: DataFrame, space, payload: list[str], addr: str = "ip",
                         how: str = "inner") -> DataFrame:
    distinct = points.select(addr).distinct()
    return points.join(lpm_distinct(distinct, prefixes, space, payload, addr), addr, how)


def flatten_prefixes(prefixes: DataFrame, space, payload: list[str], merge: bool = True) -> DataFrame:
    """Nested prefixes -> disjoint ranges, the most specific prefix winning; touching ranges with an equal payload are then joined."""
    out = flatten(prefixes.select("net", "len", *payload), space, payload)
    if not merge:
        return out
    return coalesce_equal(out.select("range_start", "range_end", *payload), space, payload)


def covering_prefixes(routes: DataFrame, vrps: DataFrame, space) -> DataFrame:
    """Every stored prefix that covers a route.  routes(net,len,...), vrps(net,len,...): the route's columns with route_net and
    route_len, net and len, and the other stored columns as vrp_<column>."""
    r = routes.withColumnsRenamed({"net": "route_net", "len": "route_len"}).withColumn("route_len", F.col("route_len").cast("int"))
    v = vrps.withColumn("len", F.col("len").cast("int"))
    return r.join(covering_chain(routes, v, space), ["route_net", "route_len"]).join(
        v.withColumnsRenamed({c: f"vrp_{c}" for c in v.columns if c not in ("net", "len")}), ["net", "len"])


def merge_sources(tables: dict[str, DataFrame], key: str = "asn") -> DataFrame:
    """Full outer merge of per-ASN tables; each table becomes a nullable struct.

    Every table is reduced to (key, struct) and tagged, and one aggregation on
    the key replaces a chain of outer joins: one shuffle instead of five.
    """
    parts = [
        df.select(key, F.struct(*[c for c in df.columns if c != key]).alias(name)) for name, df in tables.items()
    ]
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return u.groupBy(key).agg(*[F.first(n, ignorenulls=True).alias(n) for n in tables])


def precedence_merge(override: DataFrame, derived: DataFrame, value: str, key: str = "asn") -> DataFrame:
    """override(key,value) beats derived(key,value,source)."""
    o = override.select(key, F.col(value).alias("_o"))
    d = derived.select(key, F.col(value).alias("_d"), F.col("source").alias("_s"))
    return o.join(d, key, "full").select(
        key, F.coalesce("_o", "_d").alias(value),
        F.when(F.col("_o").isNotNull(), F.lit("override")).otherwise(F.col("_s")).alias("source"))


def precedence_merge_veto(override: DataFrame, derived: DataFrame, value: str = "cc", key: str = "asn") -> DataFrame:
    """As precedence_merge, but an override row with a null value removes the key."""
    o = override.select(key, F.col(value).alias("_o"), F.lit(True).alias("_has"))
    d = derived.select(key, F.col(value).alias("_d"), F.col("source").alias("_s"))
    has = F.coalesce("_has", F.lit(False))
    return o.join(d, key, "full").select(
        key, F.when(has, F.col("_o")).otherwise(F.col("_d")).alias(value),
        F.when(has, F.lit("override")).otherwise(F.col("_s")).alias("source")).filter(F.col(value).isNotNull())


def adjacent_in_paths(pairs: DataFrame, links: DataFrame, a: str = "a_asn", b: str = "b_asn") -> DataFrame:
    """Flag pairs that are neighbours in some path, in either direction."""
    und = links.select(
        F.least("upstream", "origin").alias("_lo"), F.greatest("upstream", "origin").alias("_hi")).distinct()
    return pairs.withColumns({"_lo": F.least(a, b), "_hi": F.greatest(a, b)}).join(
        und.withColumn("_adj", F.lit(True)), ["_lo", "_hi"], "left"
    ).withColumn("adjacent", F.coalesce("_adj", F.lit(False))).drop("_adj", "_lo", "_hi")


def oldest_input(sources: DataFrame, files: DataFrame) -> DataFrame:
    """source_id -> earliest fetched_at over its files; null when unknown.

    One source may own most of the files, so files are reduced before the join.
    """
    f = files.groupBy("source_id").agg(F.min("fetched_at").alias("fetched_at"))
    return sources.select("source_id").join(f, "source_id", "left")
