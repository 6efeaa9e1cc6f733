"""Routing-table entries -> origin decision per prefix -> disjoint origin ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netorigin.functions import vocab
from netorigin.functions.addr import block, inside_any
from netorigin.functions.space import V4
from netorigin.operators.joins import flatten_prefixes

AS_SET = -1  # stands for an origin erased by aggregation


def prefix_reject_reason(net: Column, length: Column, space=V4, bounds: tuple[int, int] | None = None) -> Column:
    """First reason to refuse a prefix, or null."""
    lo, hi = bounds or vocab.PREFIX_BOUNDS[space.version]
    out = F.when(length == 0, F.lit("default_route"))
    if space.version == 6:
        a, b = block(*vocab.V6_GLOBAL, space)
        out = out.when((length < vocab.V6_GLOBAL[1]) | (net < a) | (net > b), F.lit("v6_not_global_unicast"))
    name = lambda what: F.lit(f"v{space.version}_{what}")
    out = out.when(length < lo, name("too_short")).when(length > hi, name("too_specific"))
    blocks = vocab.V4_MARTIANS if space.version == 4 else vocab.V6_MARTIANS
    return out.when(inside_any(net, length, blocks, space), name("martian"))


def origin_reject_reason(asn: Column) -> Column:
    return (
        F.when(asn == 0, F.lit("origin_as0"))
        .when(asn == 23456, F.lit("origin_as_trans"))
        .when(asn.between(64496, 64511) | asn.between(65536, 65551), F.lit("origin_documentation_asn"))
        .when(asn.between(64512, 65534) | asn.between(4200000000, 4294967294), F.lit("origin_private_asn"))
        .when((asn == 65535) | (asn == 4294967295) | asn.between(65552, 131071), F.lit("origin_reserved_asn"))
    )


def prefix_acceptable(net: Column, length: Column, space=V4, bounds: tuple[int, int] | None = None) -> Column:
    """No reject reason, as one plain condition: it is pushed to the scan and costs
    far less there than a test for a null reason."""
    lo, hi = bounds or vocab.PREFIX_BOUNDS[space.version]
    ok = (length > 0) & (length >= lo) & (length <= hi)
    if space.version == 6:
        a, b = block(*vocab.V6_GLOBAL, space)
        ok = ok & (length >= vocab.V6_GLOBAL[1]) & (net >= a) & (net <= b)
    return ok & ~inside_any(net, length, vocab.V4_MARTIANS if space.version == 4 else vocab.V6_MARTIANS, space)


def origin_acceptable(asn: Column) -> Column:
    return ~((asn == 0) | (asn == 23456) | asn.between(64496, 131071) | (asn >= 4200000000))


def path_origin(segments: Column, peer_as: Column) -> Column:
    """struct(origin, upstream, empty) of an AS path given as array<struct<type,asns>>.

    Type 2 is a sequence, type 1 a set; other types are ignored.  A set of several
    different members contributes one AS_SET element.  The fold keeps the last
    element and the nearest earlier one that differs from it.
    """
    hop = lambda a, is_set: F.struct(a.cast("bigint").alias("asn"), is_set.alias("multi"))
    def hops(s: Column) -> Column:
        same = F.size(F.array_distinct(s["asns"])) == 1
        return (
            F.when(s["type"] == 2, F.transform(s["asns"], lambda a: hop(a, F.lit(False))))
            .when((s["type"] == 1) & same, F.array(hop(s["asns"][0], F.lit(False))))
            .when((s["type"] == 1) & (F.size(s["asns"]) > 1), F.array(hop(F.lit(AS_SET), F.lit(True))))
            .otherwise(F.array().cast("array<struct<asn:bigint,multi:boolean>>"))
        )
    path = F.flatten(F.transform(segments, hops))
    null = F.lit(None).cast("bigint")
    start = F.struct(null.alias("last"), null.alias("prev"))
    step = lambda acc, h: F.struct(
        h["asn"].alias("last"),
        F.when(acc["last"].isNotNull() & (h["multi"] | (acc["last"] != h["asn"])), acc["last"]).otherwise(acc["prev"]).alias("prev"))
    end = F.aggregate(path, start, step)
    empty = F.size(path) == 0
    return F.struct(F.when(empty, peer_as).otherwise(end["last"]).alias("origin"), end["prev"].alias("upstream"),
                    empty.alias("empty"))


def latest_peers(entries: DataFrame, peers: DataFrame) -> DataFrame:
    """Resolve peer indexes through the latest peer table of each collector that is
    not newer than the entry: entries(collector, gen, idx, ...), peers(collector, gen, idx, peer_as).

    No entry is lost: `violation` is `no_peer_table` where the collector has no table
    that old, `no_such_peer` where the table lacks the index, else null."""
    gens = peers.groupBy("collector").agg(F.array_sort(F.collect_set("gen")).alias("gens"))
    seen = entries.join(gens, "collector", "left").withColumn(
        "table_gen", F.array_max(F.filter("gens", lambda g: g <= F.col("gen")))).drop("gens")
    known = peers.withColumnRenamed("gen", "table_gen").withColumn("_known", F.lit(True))
    violation = (F.when(F.col("table_gen").isNull(), "no_peer_table")
                 .when(F.col("_known").isNull(), "no_such_peer"))
    return seen.join(known, ["collector", "table_gen", "idx"], "left").withColumn("violation", violation).drop("table_gen", "_known")


def usable_entries(entries: DataFrame, space=V4) -> DataFrame:
    """entries(net, len, origin, peer_as, ...) with the two reject reasons; the
    AS_SET sentinel passes, it is counted as seen but never elected."""
    return entries.withColumns({
        "prefix_reason": prefix_reject_reason(F.col("net"), F.col("len"), space),
        "origin_reason": F.when(F.col("origin") != AS_SET, origin_reject_reason(F.col("origin"))),
    })


def votes(entries: DataFrame) -> DataFrame:
    """Distinct peer ASes per (prefix, origin), exact."""
    return entries.groupBy("net", "len", "origin").agg(F.count_distinct("peer_as").alias("vis"))


def total_visibility(entries: DataFrame) -> DataFrame:
    """Distinct peer ASes per prefix over all origins."""
    return entries.groupBy("net", "len").agg(F.count_distinct("peer_as").alias("total_vis"))


def ingest_counters(entries: DataFrame, space=V4, record: tuple[str, ...] = ("collector", "net", "len")) -> DataFrame:
    """(counter, n): records, entries, and what each rule took.

    `record` names the columns that identify a routing-table record.  A refused
    prefix counts once a record, the rules on origins count entries.  A null origin
    is an entry without a path; `empty_path` is counted where entries carry `empty`.
    """
    e = usable_entries(entries, space)
    kind = (
        F.when(F.col("prefix_reason").isNotNull(), F.col("prefix_reason"))
        .when(F.col("origin").isNull(), F.lit("no_as_path"))
        .when(F.col("origin_reason").isNotNull(), F.col("origin_reason"))
        .when(F.col("origin") == AS_SET, F.lit("as_set"))
        .otherwise(F.lit("used"))
    )
    whole = F.col("prefix_reason").isNotNull()
    empty = F.count_if(F.col("empty") & ~whole) if "empty" in entries.columns else None
    per = e.groupBy(*record, whole.alias("whole"), kind.alias("counter")).agg(
        F.count("*").alias("n"), *([empty.alias("empty")] if empty is not None else []))
    taken = per.groupBy("counter", "whole").agg(F.sum("n").alias("n"), F.count("*").alias("records")).select(
        "counter", F.when(F.col("whole"), F.col("records")).otherwise(F.col("n")).alias("n"))
    pair = lambda name, v: F.struct(F.lit(name).alias("counter"), F.coalesce(v, F.lit(0)).cast("bigint").alias("n"))
    extra = ["empty"] if empty is not None else []
    rows = per.groupBy(*record).agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in extra])
    totals = rows.agg(F.array(pair("records", F.count("*")), pair("entries", F.sum("n")),
                              *[pair("empty_path", F.sum(c)) for c in extra]).alias("a"))
    return taken.unionByName(totals.select(F.explode("a").alias("e")).select("e.*"))


def winners(v: DataFrame) -> DataFrame:
    """Most votes, ties to the lowest ASN; an aggregate, so no prefix is gathered in a task."""
    best = F.max_by(F.struct("origin", "vis"), F.struct(F.col("vis"), (-F.col("origin")).alias("low")))
    return v.filter(F.col("origin") != AS_SET).groupBy("net", "len").agg(best.alias("w")).select("net", "len", "w.*")


def prefix_decisions(entries: DataFrame, space=V4, min_peers: int = vocab.MIN_PEERS) -> DataFrame:
    """One row per acceptable prefix: winner, votes, flags and the drop reason.

    Entries collapse to (prefix, origin, peer) first.  Origins with equal votes
    collapse next, so the tie test and the counts are plain aggregates and a
    prefix with very many origins is still combined map-side.
    """
    e = entries.filter(prefix_acceptable(F.col("net"), F.col("len"), space))
    # The AS_SET sentinel is seen but never elected.
    ok = (F.col("origin") == AS_SET) | origin_acceptable(F.col("origin"))
    triples = e.select("net", "len", F.when(ok, F.col("origin")).alias("origin"),
                       F.when(ok, F.col("peer_as")).alias("peer_as")).distinct()
    per_origin = triples.groupBy("net", "len", "origin").agg(F.count("peer_as").alias("vis"))
    real = F.col("origin").isNotNull() & (F.col("origin") != AS_SET)
    per_level = per_origin.groupBy("net", "len", F.when(real, F.col("vis")).alias("vis")).agg(
        F.count_if(real).alias("n"), F.min(F.when(real, F.col("origin"))).alias("low"),
        F.max(F.col("origin") == AS_SET).alias("has_set"))
    # Plain columns, not a struct: fixed-width buffers keep this a hash aggregate.
    d = per_level.groupBy("net", "len").agg(
        F.max("vis").alias("top"), F.max_by("low", "vis").alias("low"), F.max_by("n", "vis").alias("ties"),
        F.sum(F.when(F.col("vis") >= min_peers, F.col("n")).otherwise(0)).alias("above"),
        F.coalesce(F.max("has_set"), F.lit(False)).alias("has_set"))
    # Counting non-null peers (instead of filtering them) lets both branches share
    # the shuffle of the distinct triples.
    total = triples.select("net", "len", "peer_as").distinct().groupBy("net", "len").agg(F.count("peer_as").alias("total_vis"))
    reason = (
        F.when(F.col("top").isNull() & ~F.col("has_set"), F.lit("no_usable_origin"))
        .when(F.col("top").isNull(), F.lit("as_set_only"))
        .when(F.col("top") < min_peers, F.lit("below_min_peers"))
    )
    kept = F.col("reason").isNull()
    return (
        d.join(total, ["net", "len"])
        .withColumn("reason", reason)
        .select("net", "len", F.col("low").alias("origin"), F.coalesce("top", F.lit(0)).alias("origin_vis"),
                "total_vis", (kept & (F.col("above") > 1)).alias("moas"), (kept & (F.col("ties") > 1)).alias("tie"),
                (kept & (2 * F.col("top") < F.col("total_vis"))).alias("minority"), "reason")
    )


def candidate_votes(entries: DataFrame, space=V4) -> DataFrame:
    """All candidates of all acceptable prefixes in long form (net, len, asn, vis)."""
    e = entries.filter(prefix_acceptable(F.col("net"), F.col("len"), space) & (F.col("origin") != AS_SET)
                       & origin_acceptable(F.col("origin")))
    return votes(e).withColumnRenamed("origin", "asn")


def resolve_counters(decisions: DataFrame, peers: DataFrame, min_peers: int = vocab.MIN_PEERS) -> DataFrame:
    """(counter, n): the fate of every prefix, the distinct peer ASes of `peers`(peer_as), and the floor in force."""
    c = lambda name, n: F.struct(F.lit(name).alias("counter"), n.cast("bigint").alias("n"))
    r = F.col("reason")
    one = decisions.agg(F.array(
        c("prefixes", F.count("*")), c("kept", F.count_if(r.isNull())), c("below_min_peers", F.count_if(r == "below_min_peers")),
        c("as_set_only", F.count_if(r == "as_set_only")), c("no_usable_origin", F.count_if(r == "no_usable_origin")),
        c("moas", F.count_if("moas")), c("ties", F.count_if("tie")), c("minority_winner", F.count_if("minority")),
        c("min_peers", F.lit(min_peers))).alias("a"))
    seen = peers.agg(F.count_distinct("peer_as").alias("n")).select(F.lit("peer_ases").alias("counter"), "n")
    return one.select(F.explode("a").alias("e")).select("e.*").unionByName(seen)


def links(entries: DataFrame, space=V4) -> DataFrame:
    """Distinct (upstream, origin) pairs of entries whose prefix and origin are accepted."""
    ok = prefix_acceptable(F.col("net"), F.col("len"), space) & origin_acceptable(F.col("origin"))
    return entries.filter((F.col("upstream") > 0) & (F.col("origin") > 0) & ok).select("upstream", "origin").distinct()


def range_totals(ranges: DataFrame, space=V4) -> DataFrame:
    """Ranges and addresses of one family; IPv6 in /48 equivalents."""
    size = space.size(F.col("range_start"), F.col("range_end"))
    total = F.coalesce(F.sum(size), F.lit(0))
    if space.version == 6:
        total = total.cast("double") / float(1 << 80)
    return ranges.agg(F.lit(space.name).alias("family"), F.count("*").alias("n"), total.alias("addresses"))


def origin_ranges(decisions: DataFrame, space=V4) -> DataFrame:
    """Kept prefixes -> disjoint ranges (range_start, range_end, asn)."""
    kept = decisions.filter("reason is null").select("net", "len", F.col("origin").alias("asn"))
    return flatten_prefixes(kept, space, ["asn"])


def sort_prefixes(prefixes: DataFrame) -> DataFrame:
    return prefixes.orderBy("net", "len")


def pick_dumps(catalogue: DataFrame, slot: Column, rules: dict = vocab.COLLECTOR_RULES) -> DataFrame:
    """One dump per collector: the requested slot, else the newest older one inside
    the window.  catalogue(collector, slot timestamp, path, bytes)."""
    age = (F.unix_timestamp(slot) - F.unix_timestamp("slot")) / 3600.0
    fit = catalogue.filter((age >= 0) & (age <= rules["max_fallback_hours"]))
    return fit.groupBy("collector").agg(F.max_by(F.struct("slot", "path", "bytes"), "slot").alias("d")).select(
        "collector", "d.*", (F.col("d.slot") != slot).alias("fallback"),
        (F.col("d.bytes") < rules["min_bytes"]).alias("too_small"))


def dump_gate(picked: DataFrame, rules: dict = vocab.COLLECTOR_RULES) -> DataFrame:
    return picked.agg(
        F.count("*").alias("collectors"), F.count_if("fallback").alias("fallbacks"), F.count_if("too_small").alias("small"),
        ((F.count("*") >= rules["at_least"]) & (F.count_if("too_small") == 0)).alias("ok"))


def top_per_class(df: DataFrame, cls: str, size: str, n: int, tie: str) -> DataFrame:
    """The n largest rows of each class.  `rank <= literal` lets Spark cut every
    partition to n rows per class before the shuffle."""
    w = Window.partitionBy(cls).orderBy(F.col(size).desc(), F.col(tie))
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
