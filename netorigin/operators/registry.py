"""Registry delegations: expansion, conflicts, holder clusters, sibling candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netorigin.functions import vocab
from netorigin.operators.lineage import cut
from netorigin.operators.ranges import explode_span


def expand_blocks(delegations: DataFrame) -> DataFrame:
    """[start, start+count) -> one row per ASN; other columns are kept."""
    return explode_span(delegations, F.col("start"), F.col("start") + F.col("count") - 1, "asn").drop("start", "count")


def registry_rows(delegations: DataFrame, in_order: bool = False) -> DataFrame:
    """One row per ASN with rir, cc, registered, status, holder and the conflict mark.

    delegations(rir, cc, start, count, date, status, opaque_id, ordinal).  Within a
    registry the last delegation wins; an ASN of two registries is a conflict.  With `in_order` the only shuffle deals by ASN ranges.
    """
    expanded = expand_blocks(delegations)
    if in_order:
        expanded = expanded.repartitionByRange("asn")
    holder = F.when(F.col("opaque_id").isNotNull(), F.concat_ws(":", "rir", "opaque_id"))
    row = F.struct("rir", "cc", F.col("date").alias("registered"), "status", holder.alias("holder"))
    return expanded.groupBy("asn").agg(
        F.max_by(row, F.struct("ordinal", "rir", "opaque_id", "status")).alias("r"), (F.min("rir") != F.max("rir")).alias("conflict")
    ).select("asn", "r.*", "conflict")


def clean_registry(rows: DataFrame) -> DataFrame:
    return rows.filter("not conflict").drop("conflict")


def cluster_kind(size: Column) -> Column:
    return F.when(size <= 1, "single").when(size <= vocab.POOL_ABOVE, "siblings").otherwise("pool")


def delegated(registry: DataFrame) -> DataFrame:
    return registry.filter(F.col("status").isin(vocab.DELEGATED))


def cluster_sizes(registry: DataFrame) -> DataFrame:
    """holder -> kind, size; nothing is collected."""
    return delegated(registry).filter("holder is not null").groupBy("holder").agg(F.count("*").alias("size")).withColumn(
        "kind", cluster_kind(F.col("size")))


def cluster_members(registry: DataFrame) -> DataFrame:
    """Long form: (asn, holder, kind, size)."""
    return delegated(registry).filter("holder is not null").select("asn", "holder").join(cluster_sizes(registry), "holder")


def member_parts(registry: DataFrame) -> DataFrame:
    """(holder, part, kind, size, asns): the members of every cluster in parts of 65,536 ASN numbers; `size` is that of the cluster.

    Members are shuffled once; sizes are added up from the parts, of which no row grows with a cluster.
    """
    m = delegated(registry).filter("holder is not null").select("asn", "holder", F.shiftright("asn", 16).alias("part"))
    parts = cut(m.groupBy("holder", "part").agg(F.sort_array(F.collect_set("asn")).alias("asns"), F.count("*").alias("n")))
    sizes = parts.groupBy("holder").agg(F.sum("n").alias("size"))
    return parts.join(sizes, "holder").select("holder", "part", cluster_kind(F.col("size")).alias("kind"), "size", "asns")


def _bounded(parts: DataFrame) -> DataFrame:
    return parts.filter("kind <> 'pool'").groupBy("holder", "kind", "size").agg(F.sort_array(F.flatten(F.collect_list("asns"))).alias("asns"))


def holder_clusters(registry: DataFrame) -> DataFrame:
    """Clusters with all their ASNs, sorted: (holder, part, kind, size, asns).

    Singles and siblings hold at most the pool threshold of ASNs: one row each, without a part.  A pool may hold any number: one row for every part of
    65,536 ASN numbers.
    """
    p = member_parts(registry)
    none = F.lit(None).cast("bigint").alias("part")
    return _bounded(p).select("holder", none, "kind", "size", "asns").unionByName(p.filter("kind = 'pool'").select("holder", "part", "kind", "size", "asns"))


def holder_heads(registry: DataFrame, parts: DataFrame | None = None) -> DataFrame:
    """One row per holder: (holder, kind, size, asns); that of a pool has no array, its members are the rows of `pool_parts`.  `parts`: the member_parts of the registry, if at hand."""
    p = member_parts(registry) if parts is None else parts
    pools = p.filter("kind = 'pool'").select("holder", "kind", "size").distinct().withColumn("asns", F.lit(None).cast("array<bigint>"))
    return _bounded(p).unionByName(pools)


def pool_parts(registry: DataFrame, parts: DataFrame | None = None) -> DataFrame:
    """(holder, part, size, asns): the members of pools in parts of 65,536 ASN numbers, so that no row grows with a pool; `size` is that of the pool."""
    p = member_parts(registry) if parts is None else parts
    return p.filter("kind = 'pool'").select("holder", "part", "size", "asns")


def registry_stats(rows: DataFrame) -> DataFrame:
    """(stat, value) over registry_rows output, conflicts included as one stat."""
    clean = clean_registry(rows)
    is_del = F.col("status").isin(vocab.DELEGATED)
    pair = lambda name, v: F.struct(F.lit(name).alias("stat"), v.cast("bigint").alias("value"))
    head = rows.agg(F.array(
        pair("asns_total", F.count_if(~F.col("conflict"))), pair("delegated", F.count_if(is_del & ~F.col("conflict"))),
        pair("conflicts", F.count_if("conflict"))).alias("a"))
    kinds = cluster_sizes(clean)
    k = lambda name: F.col("kind") == name
    total = lambda name: F.coalesce(F.sum(F.when(k(name), F.col("size"))), F.lit(0))
    cl = kinds.agg(F.array(
        pair("holders", F.count("*")), pair("sibling_clusters", F.count_if(k("siblings"))),
        pair("asns_in_sibling_clusters", total("siblings")), pair("pool_clusters", F.count_if(k("pool"))),
        pair("asns_in_pools", total("pool")),
        pair("largest_sibling_cluster", F.max(F.when(k("siblings"), F.col("size"))))).alias("a"))
    by_status = clean.groupBy(F.concat(F.lit("status:"), "status").alias("stat")).agg(F.count("*").alias("value"))
    by_rir = delegated(clean).groupBy(F.concat(F.lit("rir:"), "rir").alias("stat")).agg(F.count("*").alias("value"))
    flat = head.unionByName(cl).select(F.explode("a").alias("e")).select("e.*")
    return flat.unionByName(by_status).unionByName(by_rir)


def sibling_candidates(listed: DataFrame, registry: DataFrame) -> DataFrame:
    """Unlisted members of sibling-sized clusters that hold a listed ASN.

    The listed members of a cluster (at most 250) are gathered once per holder
    and handed to its other members; no member pairs are formed.
    """
    m = cluster_members(registry).filter("kind = 'siblings'").select("asn", "holder")
    l = listed.select("asn").distinct()
    via = m.join(l, "asn", "left_semi").groupBy("holder").agg(F.sort_array(F.collect_set("asn")).alias("via"))
    return m.join(l, "asn", "left_anti").join(via, "holder").select("asn", "via", "holder")


def name_reach(items: DataFrame, registry: DataFrame) -> DataFrame:
    """How far item links carry through sibling clusters: (stat, value double).

    items(asn, qid).  A cluster with exactly one distinct item passes it to its
    unnamed members; disagreeing clusters are counted; pools never take part.
    """
    dele = delegated(registry).select("asn")
    named = items.select("asn", "qid")
    direct = named.join(dele, "asn", "left_semi")
    m = cluster_members(registry).filter("kind = 'siblings'").select("asn", "holder").join(named, "asn", "left")
    per = m.groupBy("holder").agg(F.min("qid").alias("lo"), F.max("qid").alias("hi"),
                                  F.count_if(F.col("qid").isNull()).alias("unnamed"))
    one = lambda df, *aggs: df.agg(*aggs).withColumn("k", F.lit(1))
    t = (
        one(named, F.count("*").alias("item_asns"), F.count_distinct("qid").alias("items"))
        .join(one(dele, F.count("*").alias("delegated_asns")), "k")
        .join(one(direct, F.count("*").alias("direct")), "k")
        .join(one(per, F.coalesce(F.sum(F.when(F.col("lo") == F.col("hi"), F.col("unnamed"))), F.lit(0)).alias("inherited"),
                  F.count_if(F.col("lo") != F.col("hi")).alias("disagreeing")), "k")
    )
    pct = lambda a: F.when(F.col("delegated_asns") > 0, F.round(100.0 * a / F.col("delegated_asns"), 2))
    after = F.col("direct") + F.col("inherited")
    stats = {
        "item_asns": F.col("item_asns"), "items": F.col("items"), "delegated_asns": F.col("delegated_asns"),
        "direct_in_delegated": F.col("direct"), "not_in_registry": F.col("item_asns") - F.col("direct"),
        "inherited_via_siblings": F.col("inherited"), "named_after_propagation": after,
        "multiplier": F.when(F.col("direct") > 0, F.round(after / F.col("direct"), 2)),
        "clusters_with_disagreeing_items": F.col("disagreeing"),
        "pct_named_direct": pct(F.col("direct")), "pct_named_after": pct(after),
    }
    return t.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("stat"), v.cast("double").alias("value")) for k, v in stats.items()])).alias("e")).select("e.*")
