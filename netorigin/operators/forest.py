"""Nested prefixes as a forest, read along the address line.

Prefixes are nested or disjoint, so the prefixes open at an address are a chain, and a prefix's place in it is its depth.  One scan adds up openings and closings
and gives the depth everywhere.  A second scan, keyed by depth, carries the latest prefix that opened at that depth: at an address of depth d, the latest opening
at each depth 1..d is the whole chain, the one at d the most specific.  The carry of a bucket is one prefix per depth, so summaries of buckets merge in any
grouping, and the work is linear in the bounds and in the answer, whatever lengths occur.  No prefix is a shuffle key by itself: rows are keyed by (depth, bucket).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netorigin.operators.lineage import cut
from netorigin.operators.scan import scan


def depths(prefixes: DataFrame, space, payload: list[str] | None = None, asked: DataFrame | None = None, nexts: bool = False) -> DataFrame:
    """One row per bound: pos, opens (the prefixes that start there, shortest first, as (len, payload)), run_delta (depth after them), and next_pos on request.

    `asked` (net, len) adds its networks as positions, with their distinct lengths as `lens`.  At most one prefix a length starts at an address, so the arrays are
    bounded by the address width.
    """
    entry = F.struct(F.col("len").cast("int").alias("len"), *(payload or []))
    nothing = F.lit(None)
    kind = prefixes.select(entry.alias("e")).schema["e"].dataType
    parts = [prefixes.select(F.col("net").alias("pos"), entry.alias("open"), F.lit(0).alias("closed"), nothing.cast("int").alias("want")),
             prefixes.select(space.succ(space.last(F.col("net"), F.col("len"))).alias("pos"), nothing.cast(kind).alias("open"), F.lit(1).alias("closed"), nothing.cast("int").alias("want"))]
    if asked is not None:
        parts.append(asked.select(F.col("net").alias("pos"), nothing.cast(kind).alias("open"), F.lit(0).alias("closed"), F.col("len").cast("int").alias("want")))
    ev = parts[0]
    for p in parts[1:]:
        ev = ev.unionByName(p)
    ev = ev.filter("pos is not null").groupBy("pos").agg(F.sort_array(F.collect_list("open")).alias("opens"), F.sum("closed").alias("closed"), F.collect_set("want").alias("lens"))
    return scan(ev.select("pos", "opens", "lens", (F.size("opens") - F.col("closed")).alias("delta")), space, sums=("delta",), nexts=nexts)


def opened(lines: DataFrame, payload: list[str] | None = None) -> Column:
    """Array of (depth, open) of the prefixes that start at a bound; `open` is (net, len, payload)."""
    before = F.col("run_delta") - F.size("opens")
    return F.transform("opens", lambda e, i: F.struct((before + i + 1).cast("bigint").alias("depth"), F.struct(
        F.col("pos").alias("net"), e["len"].alias("len"), *[e[c].alias(c) for c in payload or []]).alias("open")))


def topmost(lines: DataFrame, payload: list[str], keep: dict[str, Column], space) -> DataFrame:
    """`lines` of `depths` that lie in some prefix: pos, the columns `keep`, and last_open, the most specific prefix (net, len, payload) there."""
    own = opened(lines, payload)
    kind = lines.select(own.alias("o")).schema["o"].dataType
    carried = F.array(F.struct(F.col("run_delta").cast("bigint").alias("depth"), F.lit(None).cast(kind.elementType["open"].dataType).alias("open")))
    rows = lines.withColumn("e", F.explode(F.when(F.size("opens") > 0, own).when(F.col("run_delta") > 0, carried))).select(
        "pos", "e.depth", "e.open", F.when(F.col("e.depth") == F.col("run_delta"), F.struct(*[c.alias(n) for n, c in keep.items()])).alias("top"))
    return scan(rows, space, keys=("depth",), lasts=("open",)).filter("top is not null").select("pos", "top.*", "last_open")


def flatten(prefixes: DataFrame, space, payload: list[str]) -> DataFrame:
    """range_start, range_end, payload, net, len: the stretches between neighbouring bounds with the most specific prefix that covers each.

    Of several prefixes with the same net and length the greatest payload stands.
    """
    s = depths(prefixes, space, payload, nexts=True)
    return topmost(s, payload, {"last": F.coalesce(space.pred(F.col("next_pos")), space.max())}, space).select(
        F.col("pos").alias("range_start"), F.col("last").alias("range_end"), *[F.col(f"last_open.{c}") for c in [*payload, "net", "len"]])


def most_specific(addresses: DataFrame, prefixes: DataFrame, space, payload: list[str], addr: str = "ip") -> DataFrame:
    """Each distinct non-null address in some prefix, with net, len and payload of the longest one; of several equal prefixes the greatest payload."""
    asked = addresses.select(F.col(addr).alias("net"), F.lit(space.bits).alias("len"))
    s = depths(prefixes, space, payload, asked=asked)
    return topmost(s, payload, {"asked": F.size("lens") > 0}, space).filter("asked").select(F.col("pos").alias(addr), "last_open.*")


def covering_chain(routes: DataFrame, stored: DataFrame, space) -> DataFrame:
    """(route_net, route_len, net, len): every stored prefix that covers a route, itself included; one row a pair, whatever copies the inputs hold."""
    s = cut(depths(stored.select("net", "len").distinct(), space, asked=routes.select("net", "len")))
    upto = lambda n: (F.col("run_delta") - F.size("opens") + F.size(F.filter("opens", lambda e: e["len"] <= n))).cast("bigint")
    wanted = s.filter(F.size("lens") > 0).withColumn("route_len", F.explode("lens")).select(
        F.col("pos").alias("route_net"), "route_len", upto(F.col("route_len")).alias("depths")).filter("depths > 0")
    opens = s.select("pos", F.explode(opened(s)).alias("e")).select("pos", "e.depth", "e.open", F.lit(False).alias("asked"))
    kind = opens.schema["open"].dataType
    # the longest length asked at an address has the longest chain; shorter ones have its beginning
    chains = wanted.groupBy("route_net").agg(F.max("depths").alias("depths")).select(
        F.col("route_net").alias("pos"), F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("depths"))).alias("depth"), F.lit(None).cast(kind).alias("open"), F.lit(True).alias("asked"))
    rows = opens.unionByName(chains).groupBy("depth", "pos").agg(F.max("open").alias("open"), F.max("asked").alias("asked"))
    found = scan(rows, space, keys=("depth",), lasts=("open",)).filter("asked").select(F.col("pos").alias("route_net"), "depth", "last_open.net", "last_open.len")
    return wanted.join(found, "route_net").filter("depth <= depths").select("route_net", "route_len", "net", "len")


def parents(prefixes: DataFrame, space) -> DataFrame:
    """(net, len, parent_net, parent_len, depth) of each distinct prefix; roots have depth 1 and null parents."""
    chain = covering_chain(prefixes, prefixes, space)
    strict = F.col("len") < F.col("route_len")
    return chain.groupBy(F.col("route_net").alias("net0"), F.col("route_len").alias("len0")).agg(
        F.max(F.when(strict, F.struct("len", "net"))).alias("p"), F.count("*").alias("depth")).select(
        F.col("net0").alias("net"), F.col("len0").alias("len"), F.col("p.net").alias("parent_net"), F.col("p.len").alias("parent_len"), "depth")
