"""Range algebra, sweep, lookups and prefix matching."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netorigin.functions.space import V4, V6, v6
from netorigin.operators import classify, compilation, joins, overlay, profile, project, ranges
from netorigin.plans.catalog import query
from netorigin.plans.tables import (CATEGORY, DC, FLAGS, INTERVALS, ROLE, SEGMENTS, SOURCES_TEXT, STAMPED, VERDICT,
                                    VPN, hex128, merged, pow2, ranges6, u128)

PAIR = "range_start, range_end"


def vpn(t) -> DataFrame:
    return ranges.merge_ranges(t.vpn_raw, V4)


def dc(t) -> DataFrame:
    return ranges.merge_ranges(t.dc_raw, V4)


def flags(t) -> DataFrame:
    return compilation.asn_flags(t.asn_meta, t.asn_lists, t.corrections)


def stamped(t) -> DataFrame:
    return compilation.stamp(t.base, flags(t))


def segments(t) -> DataFrame:
    return project.effective_segments(stamped(t), vpn(t), dc(t))


def hexed(df: DataFrame, *rest: str) -> DataFrame:
    return df.select(V6.hex(F.col("range_start")).alias("start_hex"), V6.hex(F.col("range_end")).alias("end_hex"), *rest)


HEXED = f"select {hex128('range_start')} as start_hex, {hex128('range_end')} as end_hex"

query("rng1_merge", f"select {PAIR} from ({merged('select * from @vpn_raw union all select * from @dc_raw')})")(
    lambda t: ranges.merge_ranges(t.vpn_raw.union(t.dc_raw), V4))
query("rng1_merge_by_key", f"select asn, {PAIR} from ({merged('select * from @base_raw', 'asn')})")(
    lambda t: ranges.merge_ranges(t.base_raw, V4, ("asn",)))
query("rng1_merge_v6", f"{HEXED} from ({merged('select * from ' + ranges6('vpn6'))})")(
    lambda t: hexed(ranges.merge_ranges(t.six("vpn6"), V6)))
query("rng2_intersect", f"""select greatest(b.range_start, v.range_start) as range_start, least(b.range_end, v.range_end) as range_end
    from @base b join {VPN} v on b.range_start <= v.range_end and v.range_start <= b.range_end""")(
    lambda t: ranges.intersect_ranges(t.base, vpn(t), V4))

_CUT = f"""(with b as (select range_start as p from @base union select range_end + 1 from @base
    union select range_start from {VPN} union select range_end + 1 from {VPN}),
    s as (select p as range_start, lead(p) over (order by p) - 1 as range_end from b)
    select s.range_start, s.range_end, b.asn, coalesce(b.range_end >= s.range_start, false) as in_a,
    coalesce(v.range_end >= s.range_start, false) as in_b from s asof left join @base b on s.range_start >= b.range_start
    asof left join {VPN} v on s.range_start >= v.range_start where s.range_end is not null)"""
query("rng3_subtract", f"select {PAIR}, asn from {_CUT} where in_a and not in_b")(
    lambda t: ranges.subtract_ranges(t.base, vpn(t), V4, ["asn"]))
_COVER = f"({merged('select range_start, range_end from @base')})"
_FREE = f"""(select range_end + 1 as range_start, coalesce(lead(range_start) over (order by range_start) - 1, 4294967295) as range_end from {_COVER}
    union all select 0, min(range_start) - 1 from {_COVER})"""
_WANTED = """select c_custkey as id, 16777216 + (c_custkey * 9001) % 4261412864 as range_start,
    16777216 + (c_custkey * 9001) % 4261412864 + (c_nationkey + 1) * 640 as range_end from @customer"""
query("rng4_gaps", f"""select greatest(c.range_start, f.range_start) as range_start, least(c.range_end, f.range_end) as range_end, c.id
    from ({_WANTED}) c join {_FREE} f on c.range_start <= f.range_end and f.range_start <= c.range_end""")(
    lambda t: ranges.gaps(t.sql(_WANTED), t.base.select("range_start", "range_end"), V4))
query("rng5_union_size", f"""select asn, cast(sum(range_end - range_start + 1) as bigint) as addresses from ({merged('select * from @base_raw', 'asn')}) group by asn""")(
    lambda t: ranges.union_size(t.base_raw, V4, ("asn",)))
_SANE = """(select *, case when range_start > coalesce(top, -1) then 'keep' when range_end > top then 'clip' else 'drop' end as action from (
    select *, max(range_end) over (order by range_start, range_end desc, asn rows between unbounded preceding and 1 preceding) as top from @base_raw))"""
query("rng6_sanitize", f"select greatest(range_start, coalesce(top, -1) + 1) as range_start, range_end, asn from {_SANE} where action <> 'drop'")(
    lambda t: ranges.sanitize(t.base_raw, V4, "asn"))
query("rng6_repairs", f"""select count(*) filter (action <> 'keep') as repairs, count(*) filter (action = 'clip') as clipped,
    count(*) filter (action = 'drop') as dropped, count(*) filter (action <> 'keep') <= 1000 as ok from {_SANE}""")(
    lambda t: ranges.sanitize_counts(t.base_raw, V4, "asn"))
query("rng7_structure", """select violation, cast(n as bigint) as n from (
    select 'inverted' as violation, count(*) filter (range_end < range_start) as n from @base_raw
    union all select 'out_of_bound', count(*) filter (range_end > 4294967295) from @base_raw
    union all select 'overlap', count(*) filter (range_start <= top) from (select *, max(range_end) over (order by range_start, range_end desc
    rows between unbounded preceding and 1 preceding) as top from @base_raw))""")(
    lambda t: ranges.structure_violations(t.base_raw, V4))
query("rng8_overlay_share", f"""select asn, cast(sum(n) as bigint) as addresses, cast(sum(case when in_b then n else 0 end) as bigint) as inside,
    round(sum(case when in_b then n else 0 end) / sum(n) * 100, 1) as pct from (select *, range_end - range_start + 1 as n from {_CUT} where in_a) group by asn""")(
    lambda t: ranges.overlay_share(t.base, vpn(t), V4))
query("rng9_pieces", """select bucket, greatest(range_start, bucket * 65536) as range_start, least(range_end, bucket * 65536 + 65535) as range_end
    from (select *, unnest(range(range_start >> 16, (range_end >> 16) + 1)) as bucket from @vpn_raw)""")(
    lambda t: ranges.bucket_pieces(t.vpn_raw))

# ---------------------------------------------------------------- sweep and product rows
query("win5_sweep", f"select {PAIR}, asn, flags, vpn_range, datacenter_range from {SEGMENTS}")(segments)
_SEG6 = f"""(with a as (select * from {ranges6('base6', ', asn')}), v as ({merged('select * from ' + ranges6('vpn6'))}),
    b as (select range_start as p from a union select range_end + 1 from a union select range_start from v union select range_end + 1 from v),
    s as (select p as range_start, lead(p) over (order by p) - 1 as range_end from b)
    select s.range_start, s.range_end, case when a.range_end >= s.range_start then asn end as asn, coalesce(v.range_end >= s.range_start, false) as vpn_range
    from s asof left join a on s.range_start >= a.range_start asof left join v on s.range_start >= v.range_start where s.range_end is not null)"""


@query("win5_sweep_v6", f"{HEXED}, asn, vpn_range from {_SEG6} where asn is not null or vpn_range")
def _(t):
    s = ranges.sweep(V6, {"base": t.six("base6"), "vpn": ranges.merge_ranges(t.six("vpn6"), V6)}, {"base": ["asn"]})
    return hexed(s, "asn", F.col("in_vpn").alias("vpn_range"))


query("win6_coalesce", f"select {PAIR}, asn, flags, vpn_range, datacenter_range from {INTERVALS}")(
    lambda t: ranges.coalesce_equal(segments(t), V4, ["asn", "flags", "vpn_range", "datacenter_range"]))


def intervals(t) -> DataFrame:
    return project.intervals(stamped(t), vpn(t), dc(t), t.names)


_ROWS = f"""(select 4 as ip_version, {PAIR}, i.asn, n.name as as_org, {CATEGORY} as category, {ROLE} as network_role, flags & 256 <> 0 as bad_asn,
    flags & 512 <> 0 as vpn_provider, flags & 1024 <> 0 as mobile_carrier, flags & 2048 <> 0 as enterprise_gw, flags & 4096 <> 0 as cdn,
    flags & 8192 <> 0 as hosting_extra, vpn_range, datacenter_range, {VERDICT} as core_verdict, {SOURCES_TEXT} as core_sources
    from {INTERVALS} i left join @names n on i.asn = n.asn)""".replace("asn is not null then 'asn_no_category'", "i.asn is not null then 'asn_no_category'")
query("project_intervals", f"select * from {_ROWS}")(
    lambda t: intervals(t).withColumn("core_sources", F.array_join("core_sources", "|")))
query("cls1_profile", f"select asn, flags, vpn_range, datacenter_range, {VERDICT} as core_verdict, {SOURCES_TEXT} as core_sources from {SEGMENTS}")(
    lambda t: profile.profile(profile.with_evidence(segments(t))).select(
        "asn", "flags", "vpn_range", "datacenter_range", "core_verdict", F.array_join("core_sources", "|").alias("core_sources")))
_BADFLAGS = "select o_orderkey as id, case when o_custkey % 4 = 0 then null else 200000 + o_custkey end as asn, cast(o_orderkey * 37 % 65536 as int) as flags from @orders"


@query("cls2_profile_check", f"""select id, case when flags & 49152 <> 0 then 'reserved_bits' when flags & 15 > 5 then 'reserved_category'
    when (flags >> 4) & 15 > 6 then 'reserved_role' when asn is null and flags <> 0 then 'evidence_without_asn' end as violation from ({_BADFLAGS})""")
def _(t):
    e = profile.with_evidence(t.sql(_BADFLAGS), vpn=F.lit(False), dc=F.lit(False))
    return e.select("id", profile.profile_violation(F.col("flags")).alias("violation"))


_RULE = """case when vpn_range then 'x4b_vpn' when flags & 512 <> 0 then 'asn_vpn_provider' when flags & 2048 <> 0 then 'asn_enterprise_gw'
    when datacenter_range then 'x4b_dc' when flags & 256 <> 0 or flags & 8192 <> 0 or flags & 4096 <> 0 or flags & 15 = 2 then 'asn_category'
    when flags & 1024 <> 0 then 'asn_mobile' when flags & 15 = 1 and (flags >> 4) & 15 <> 1 then 'asn_category'
    when flags & 15 in (3, 4, 5) then 'asn_category' when flags & 15 = 1 then 'isp_transit_ambiguous'
    when asn is not null then 'no_category' else 'unrouted' end"""
query("cls3_second_ladder", f"select {PAIR}, {VERDICT} as verdict, {_RULE} as rule from {SEGMENTS}")(
    lambda t: segments(t).select("range_start", "range_end", classify.second_ladder(
        F.col("flags"), F.col("asn").isNotNull(), F.col("vpn_range"), F.col("datacenter_range")).alias("v")).select(
        "range_start", "range_end", "v.*"))
query("cls1_cls3_agree", "select cast(0 as bigint) as disagreements, count(*) as segments from " + SEGMENTS)(
    lambda t: profile.profile(profile.with_evidence(segments(t))).withColumn("v", classify.second_ladder(
        F.col("flags"), F.col("asn").isNotNull(), F.col("vpn_range"), F.col("datacenter_range"))).agg(
        F.count_if(F.col("v.verdict") != F.col("core_verdict")).alias("disagreements"), F.count("*").alias("segments")))
query("cls4_build_flags", f"select asn, flags from {FLAGS}")(flags)
query("flt6_stamp", f"select {PAIR}, asn, flags from {STAMPED}")(stamped)
query("flt7_attach_org", f"select {PAIR}, asn, name as as_org from @base left join @names using (asn)")(
    lambda t: project.attach_org(t.base, t.names).select("range_start", "range_end", "asn", "as_org"))
query("flt8_only_routed", "select asn, category from @asn_meta where asn in (select asn from @base union select asn from @base_b)")(
    lambda t: compilation.only_routed(t.asn_meta, t.base, t.base_b).select("asn", "category"))

# ---------------------------------------------------------------- lookups
query("join1_point_in_interval", """select event_id, ip, b.range_start, b.range_end, b.asn from @ips i asof join @base b on i.ip >= b.range_start
    where b.range_end >= ip""")(
    lambda t: joins.point_in_interval(t.ips.select("event_id", "ip"), t.base, V4, ["asn"]))
query("join1_point_in_interval_v6", f"""select event_id, {hex128('range_start')} as start_hex, asn from (select event_id, {u128('hi', 'lo')} as ip from @ips6) i
    asof join {ranges6('base6', ', asn')} b on i.ip >= b.range_start where b.range_end >= i.ip""")(
    lambda t: joins.point_in_interval(t.ips6.select("event_id", v6(F.col("hi"), F.col("lo")).alias("ip")), t.six("base6"), V6, ["asn"]).select(
        "event_id", V6.hex(F.col("range_start")).alias("start_hex"), "asn"))
_PREFIXES = "(select net, len, min(origin) as asn from @rib group by net, len)"


def prefixes(t) -> DataFrame:
    return t.rib.groupBy("net", "len").agg(F.min("origin").alias("asn"))


query("join2_longest_prefix", f"""select event_id, max(len) as len, arg_max(asn, len) as asn from (select i.event_id, p.len, p.asn from
    (select *, unnest(range(8, 25)) as l from @ips) i join {_PREFIXES} p on p.len = l and p.net = ip - ip % {pow2('32 - l')}) group by event_id""")(
    lambda t: joins.longest_prefix_match(t.ips.select("event_id", "ip"), prefixes(t), V4, ["asn"]).select("event_id", "len", "asn"))
query("join3_covering_prefixes", f"""select r.net as route_net, r.len as route_len, r.origin, v.net, v.len, v.asn as vrp_asn, v.maxlen as vrp_maxlen
    from (select *, unnest(range(8, len + 1)) as l from (select distinct net, len, origin from @rib)) r
    join @vrps v on v.len = l and v.net = r.net - r.net % {pow2('32 - l')}""")(
    lambda t: joins.covering_prefixes(t.rib.select("net", "len", "origin").distinct(), t.vrps, V4).select(
        "route_net", "route_len", "origin", "net", "len", "vrp_asn", "vrp_maxlen"))
_FLAT = f"""(with p as {_PREFIXES}, b as (select net as s from p union select net + {pow2('32 - len')} from p),
    s as (select s as range_start, lead(s) over (order by s) - 1 as range_end from b),
    m as (select range_start, range_end, arg_max(asn, p.len) as asn from (select *, unnest(range(8, 25)) as l from s where range_end is not null) s
    join p on p.len = l and p.net = range_start - range_start % {pow2('32 - l')} group by all)
    select min(range_start) as range_start, max(range_end) as range_end, asn from (select *, sum(h) over (order by range_start) as g from (
    select *, case when lag(range_end) over w + 1 = range_start and lag(asn) over w = asn then 0 else 1 end as h from m window w as (order by range_start)))
    group by g, asn)"""
query("win4_flatten", f"select {PAIR}, asn from {_FLAT}")(lambda t: joins.flatten_prefixes(prefixes(t), V4, ["asn"]))
_P6 = f"(select hi::uhugeint * 18446744073709551616 as net, len, min(asn) as asn from @rib6 group by hi, len)"
_FLAT6 = f"""(with p as {_P6}, b as (select net as s from p union select net + (1::uhugeint << (128 - len)::uhugeint) from p),
    s as (select s as range_start, lead(s) over (order by s) - 1 as range_end from b),
    m as (select range_start, range_end, arg_max(asn, p.len) as asn from (select *, unnest(range(16, 49)) as l from s where range_end is not null) s
    join p on p.len = l and p.net = range_start - range_start % (1::uhugeint << (128 - l)::uhugeint) group by all)
    select min(range_start) as range_start, max(range_end) as range_end, asn from (select *, sum(h) over (order by range_start) as g from (
    select *, case when lag(range_end) over w + 1 = range_start and lag(asn) over w = asn then 0 else 1 end as h from m window w as (order by range_start)))
    group by g, asn)"""


def prefixes6(t) -> DataFrame:
    return t.rib6.groupBy("hi", "len").agg(F.min("asn").alias("asn")).select(
        v6(F.col("hi"), F.lit(0).cast("bigint")).alias("net"), "len", "asn")


query("win4_flatten_v6", f"{HEXED}, asn from {_FLAT6}")(lambda t: hexed(joins.flatten_prefixes(prefixes6(t), V6, ["asn"]), "asn"))
query("join2_longest_prefix_v6", f"""select event_id, max(len) as len, arg_max(asn, len) as asn from (select i.event_id, p.len, p.asn from
    (select *, unnest(range(16, 49)) as l from (select event_id, {u128('hi', 'lo')} as ip from @ips6)) i join {_P6} p on p.len = l and p.net = ip - ip % (1::uhugeint << (128 - l)::uhugeint)) group by event_id""")(
    lambda t: joins.longest_prefix_match(t.ips6.select("event_id", v6(F.col("hi"), F.col("lo")).alias("ip")), prefixes6(t), V6, ["asn"]).select("event_id", "len", "asn"))
_SPECIAL = """case when ip < 16777216 then 'private:special_reserved' when ip between 167772160 and 184549375 then 'private:special_rfc1918'
    when ip between 1681915904 and 1686110207 then 'cgnat:special_cgnat' when ip between 2130706432 and 2147483647 then 'private:special_loopback'
    when ip between 2851995648 and 2852061183 then 'private:special_link_local' when ip between 2886729728 and 2887778303 then 'private:special_rfc1918'
    when ip between 3232235520 and 3232301055 then 'private:special_rfc1918' when ip between 3758096384 and 4026531839 then 'private:special_multicast'
    when ip >= 4026531840 then 'private:special_reserved' end"""
_LOOKUP = f"""(select event_id, ip, coalesce(split_part(sp, ':', 1), {VERDICT}) as verdict, coalesce(split_part(sp, ':', 2), {_RULE}) as rule,
    case when sp is null then asn end as asn from (select i.event_id, i.ip, {_SPECIAL.replace('ip', 'i.ip')} as sp,
    case when s.range_end >= i.ip then s.asn end as asn, case when s.range_end >= i.ip then s.flags else 0 end as flags,
    coalesce(s.range_end >= i.ip and s.vpn_range, false) as vpn_range, coalesce(s.range_end >= i.ip and s.datacenter_range, false) as datacenter_range
    from @ips i asof left join {SEGMENTS} s on i.ip >= s.range_start))"""
query("cls11_lookup", f"select event_id, ip, verdict, rule, asn from {_LOOKUP}")(
    lambda t: classify.classify_points(t.ips.select("event_id", "ip"), segments(t)).select("event_id", "ip", "verdict", "rule", "asn"))


def verdict_counts(t) -> DataFrame:
    """Flagship: base + overlays + flags -> segments; events -> verdict counts.

    Events are counted per address first, so the event table is shuffled once, in
    partial counts, and never joined.
    """
    per_ip = t.ips.groupBy("ip").agg(F.count("*").alias("n"))
    v = per_ip.join(classify.lookup(per_ip, segments(t)), "ip")
    return v.groupBy("verdict", "rule").agg(F.sum("n").alias("events"), F.count("*").alias("addresses"))


query("verdict_counts", f"select verdict, rule, count(*) as events, count(distinct ip) as addresses from {_LOOKUP} group by 1, 2")(verdict_counts)

# ---------------------------------------------------------------- overlays restricted to justified space
_LISTED = "(select distinct asn from @asn_lists where list in ('hosting_extra', 'cdn'))"
_MANUAL = "(select 16777216 + s_suppkey * 70001 as range_start, 16777216 + s_suppkey * 70001 + s_nationkey * 100 as range_end from @supplier)"
_JUST = "(" + merged(f"select range_start, range_end from @base where asn in (select asn from {_LISTED}) union all select * from {_MANUAL}") + ")"


def justified(t) -> DataFrame:
    listed = t.asn_lists.filter("list in ('hosting_extra', 'cdn')")
    return overlay.justified_space(t.base, listed, t.sql(f"select * from {_MANUAL}"))


def _minus(a: str, b: str) -> str:
    return f"""(with c as (select range_start as p from {a} union select range_end + 1 from {a} union select range_start from {b} union select range_end + 1 from {b}),
        s as (select p as range_start, lead(p) over (order by p) - 1 as range_end from c)
        select s.range_start, s.range_end from s asof join {a} a on s.range_start >= a.range_start asof left join {b} b on s.range_start >= b.range_start
        where s.range_end is not null and a.range_end >= s.range_start and not coalesce(b.range_end >= s.range_start, false))"""


_WHITE = "(" + merged(f"""select greatest(a.range_start, b.range_start) as range_start, least(a.range_end, b.range_end) as range_end
    from {VPN} a join {_JUST} b on a.range_start <= b.range_end and b.range_start <= a.range_end""") + ")"
_BLACK = "(" + merged(f"select * from {_minus(DC, _minus(VPN, _JUST))}") + ")"
query("cls6_justified", f"select {PAIR} from {_JUST}")(justified)
query("cls7_whitelist", f"select {PAIR} from {_WHITE}")(lambda t: overlay.whitelist(vpn(t), justified(t)))
query("cls8_blacklist", f"select {PAIR} from {_BLACK}")(lambda t: overlay.blacklist(dc(t), vpn(t), justified(t)))
_SUMS = lambda s: f"(select count(*) as n, cast(coalesce(sum(range_end - range_start + 1), 0) as bigint) as a from {s})"
query("cls7_accounting", f"""select 'whitelist' as method, p.n as published_ranges, p.a as published_addresses, k.n as kept_ranges, k.a as kept_addresses,
    p.a - k.a as dropped_addresses from {_SUMS(VPN)} p, {_SUMS(_WHITE)} k""")(
    lambda t: overlay.accounting(vpn(t), overlay.whitelist(vpn(t), justified(t)), "whitelist"))

# ---------------------------------------------------------------- gap fill
_MISSING = "(select distinct asn from @asn_lists where list <> 'eyeball_confirm' and list <> 'bad_asn' and asn not in (select asn from @base))"
_CAND = "(select 200000 + s_suppkey * 17 as asn, 16777216 + s_suppkey * 90001 as range_start, 16777216 + s_suppkey * 90001 + 40000 + s_nationkey * 1000 as range_end from @supplier)"
_FILLED = f"""(select greatest(c.range_start, f.range_start) as range_start, least(c.range_end, f.range_end) as range_end, c.asn, coalesce(g.flags, 0) as flags
    from {_CAND} c join {_FREE} f on c.range_start <= f.range_end and f.range_start <= c.range_end left join {FLAGS} g on g.asn = c.asn
    where c.asn in (select asn from {_MISSING}) union all select {PAIR}, asn, flags from {STAMPED})"""
query("cls5_gap_fill", f"""select greatest(range_start, coalesce(top, -1) + 1) as range_start, range_end, asn, flags from (
    select *, max(range_end) over (order by range_start, range_end desc, asn rows between unbounded preceding and 1 preceding) as top from {_FILLED})
    where top is null or range_end > top""")(
    lambda t: compilation.gap_fill(stamped(t), compilation.missing_listed(t.asn_lists, t.base), t.sql(f"select * from {_CAND}"), flags(t)))
query("win12_first_missing", f"select asn from {_MISSING} order by asn")(
    lambda t: compilation.first_missing(compilation.missing_listed(t.asn_lists, t.base)))
query("cls12_categories", f"""select m.asn, n.name as org, c.cc as country, {CATEGORY.replace('flags', 'coalesce(f.flags, 0)')} as category,
    {ROLE.replace('flags', 'coalesce(f.flags, 0)')} as network_role, concat_ws('|', case when f.flags & 256 <> 0 then 'bad_asn' end,
    case when f.flags & 512 <> 0 then 'vpn_provider' end, case when f.flags & 1024 <> 0 then 'mobile_carrier' end,
    case when f.flags & 2048 <> 0 then 'enterprise_gw' end, case when f.flags & 4096 <> 0 then 'cdn' end,
    case when f.flags & 8192 <> 0 then 'hosting_extra' end) as flags from @asn_meta m left join {FLAGS} f on f.asn = m.asn
    left join @names n on n.asn = m.asn left join @countries c on c.asn = m.asn
    where m.asn in (select asn from @base) or n.name is not null or c.cc is not null or f.flags is not null""")(
    lambda t: compilation.asn_categories(t.asn_meta, flags(t), t.names, t.countries, t.base))
