"""Routing-table votes, prefix decisions, dump selection and table comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from netorigin.functions import addr, vocab
from netorigin.functions.space import V6, v6
from netorigin.operators import backbone, compare, joins
from netorigin.operators.lineage import cut
from netorigin.plans.catalog import query
from netorigin.plans.tables import HI6, pow2

_MART = "(" + " or ".join("(len >= {} and net between {} and {})".format(l, *addr.v4_block(n, l)) for n, l in vocab.V4_MARTIANS) + ")"
PREASON = f"case when len = 0 then 'default_route' when len < 8 then 'v4_too_short' when len > 24 then 'v4_too_specific' when {_MART} then 'v4_martian' end"
OREASON = """case when origin = 0 then 'origin_as0' when origin = 23456 then 'origin_as_trans' when origin between 64496 and 64511 or origin between 65536 and 65551 then 'origin_documentation_asn'
    when origin between 64512 and 65534 or origin between 4200000000 and 4294967294 then 'origin_private_asn'
    when origin = 65535 or origin = 4294967295 or origin between 65552 and 131071 then 'origin_reserved_asn' end"""

_WIDE = f"select net, cast(4 + len as int) as len from (select distinct net - net % {pow2('28 - len')} as net, len from @rib)"
query("flt1_prefix_reject", f"select net, len, {PREASON} as reason from ({_WIDE})")(
    lambda t: t.sql(_WIDE).withColumn("reason", backbone.prefix_reject_reason(F.col("net"), F.col("len"))))
_SIX = f"select o_orderkey as id, {HI6} + case o_custkey % 5 when 0 then -287948901175001088 when 1 then 2305843009213693952 when 2 then 65536 * o_custkey else o_custkey end as hi, cast(o_custkey % 70 as int) as len from @orders"


@query("flt1_prefix_reject_v6", f"""select id, case when len = 0 then 'default_route' when len < 3 or not (net between 2305843009213693952 and 4611686018427387903) then 'v6_not_global_unicast'
    when len < 16 then 'v6_too_short' when len > 48 then 'v6_too_specific' when len >= 32 and net between 2306124484190404608 and 2306124488485371903
    then 'v6_martian' end as reason from (select id, len, case when len = 0 then 0 when len >= 64 then hi else hi - hi % cast(power(2, 64 - greatest(least(len, 64), 2)) as bigint) end as net from ({_SIX}))""")
def _(t):
    net = V6.mask(v6(F.col("hi"), F.lit(0).cast("bigint")), F.col("len"))
    return t.sql(_SIX).withColumn("net", net).select("id", backbone.prefix_reject_reason(F.col("net"), F.col("len"), V6).alias("reason"))


_ORI = "select o_orderkey as id, case o_orderkey % 4 when 0 then o_custkey * 90 when 1 then o_custkey * 2863311 when 2 then 23456 else 0 end as origin from @orders"
query("flt2_origin_reject", f"select id, {OREASON} as reason from ({_ORI})")(
    lambda t: t.sql(_ORI).select("id", backbone.origin_reject_reason(F.col("origin")).alias("reason")))
_PATHS = """select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linenumber as t, 1000 + l_suppkey % 40 as peer, 3000 + l_partkey % 7 as a, 3000 + l_orderkey % 7 as b,
    4000 + l_suppkey % 5 as c, 4000 + l_partkey % 5 as d from @lineitem"""


@query("flt3_path_origin", f"""select t, peer, origin, upstream, empty, count(*) as n from (select t, peer, t = 7 as empty,
    case t when 1 then case when c = d then c else -1 end when 2 then b when 3 then a when 4 then a when 5 then c when 6 then b else peer end as origin,
    case t when 1 then a when 2 then case when b = a then peer else a end when 3 then peer when 4 then peer when 5 then a when 6 then -1 end as upstream
    from ({_PATHS})) group by all""")
def _(t):
    seg = lambda typ, *c: f"named_struct('type', {typ}, 'asns', array({', '.join(c)}))"
    head = seg(2, "peer", "a", "a")
    rest = [f"array({head}, {seg(1, 'c', 'd')})", f"array({head}, {seg(2, 'b')})", f"array({head}, {seg(3, 'b')})",
            f"array({head}, named_struct('type', 1, 'asns', cast(array() as array<bigint>)))", f"array({head}, {seg(1, 'c')})",
            f"array({head}, {seg(1, 'c', 'c + 1')}, {seg(2, 'b')})"]
    case = "case t " + " ".join(f"when {i + 1} then {r}" for i, r in enumerate(rest)) + f" else slice(array({head}), 1, 0) end"
    p = t.sql(f"select t, peer, {case} as segments from ({_PATHS})")
    return p.select("t", "peer", backbone.path_origin(F.col("segments"), F.col("peer")).alias("o")).groupBy(
        "t", "peer", "o.origin", "o.upstream", "o.empty").agg(F.count("*").alias("n"))


_PEERS = """select o_custkey % 7 + 1 as collector, case o_orderkey % 3 when 0 then 0 when 1 then 4 else 7 end as gen, o_orderkey % 20 as idx,
    min(1000 + o_custkey) as peer_as from @orders group by 1, 2, 3"""
_ENTR = "select l_linenumber as collector, l_orderkey % 10 as gen, l_suppkey % 20 as idx from @lineitem"
query("src13_peer_tables", f"""with p as ({_PEERS}), e as ({_ENTR}), g as (select distinct collector, gen from p)
    select x.collector, p.peer_as, case when x.tg is null then 'no_peer_table' when p.idx is null then 'no_such_peer' end as violation, count(*) as n
    from (select e.collector, e.idx, (select max(gen) from g where g.collector = e.collector and g.gen <= e.gen) as tg from e) x
    left join p on p.collector = x.collector and p.gen = x.tg and p.idx = x.idx group by all""")(
    lambda t: backbone.latest_peers(t.sql(_ENTR), t.sql(_PEERS)).groupBy("collector", "peer_as", "violation").agg(F.count("*").alias("n")))
query("agg1_votes", "select net, len, origin, count(distinct peer_as) as vis from @rib group by all")(lambda t: backbone.votes(t.rib))
query("agg2_total_visibility", "select net, len, count(distinct peer_as) as total_vis from @rib group by all")(lambda t: backbone.total_visibility(t.rib))
query("agg3_ingest_counters", f"""with k as (select collector, net, len, p is not null as whole, case when p is not null then p when origin is null then 'no_as_path'
    when origin <> -1 and o is not null then o when origin = -1 then 'as_set' else 'used' end as counter from (select *, {PREASON} as p, {OREASON} as o from @rib))
    select counter, case when whole then count(distinct (collector, net, len)) else count(*) end as n from k group by counter, whole
    union all select 'records', count(distinct (collector, net, len)) from k union all select 'entries', count(*) from k""")(
    lambda t: backbone.ingest_counters(t.rib))
query("win1_winner", """select net, len, origin, vis from (select *, row_number() over (partition by net, len order by vis desc, origin) as r from (
    select net, len, origin, count(distinct peer_as) as vis from @rib where origin <> -1 group by all)) where r = 1""")(
    lambda t: backbone.winners(backbone.votes(t.rib)))
_E = f"(select net, len, case when origin = -1 or {OREASON} is null then origin end as origin, case when origin = -1 or {OREASON} is null then peer_as end as peer_as from @rib where {PREASON} is null)"
_V = f"(select net, len, origin, count(distinct peer_as) as vis from {_E} where origin is not null group by all)"
DECISION = f"""(select p.net, p.len, w.origin, coalesce(w.vis, 0) as origin_vis, p.total_vis, reason is null and above > 1 as moas, reason is null and ties > 1 as tie,
    reason is null and 2 * w.vis < p.total_vis as minority, reason from (select p.*, v.has_set, v.real, v.top, v.above, v.ties, case when coalesce(v.real, 0) = 0 and not coalesce(v.has_set, false) then 'no_usable_origin'
    when v.real = 0 then 'as_set_only' when v.top < 2 then 'below_min_peers' end as reason from
    (select net, len, count(distinct peer_as) as total_vis from {_E} group by all) p left join
    (select net, len, bool_or(origin = -1) as has_set, count(*) filter (origin <> -1) as real, max(vis) filter (origin <> -1) as top,
    count(*) filter (origin <> -1 and vis >= 2) as above, count(*) filter (origin <> -1 and vis = m) as ties from
    (select *, max(case when origin <> -1 then vis end) over (partition by net, len) as m from {_V}) group by net, len) v on p.net = v.net and p.len = v.len) p
    left join (select net, len, origin, vis from (select *, row_number() over (partition by net, len order by vis desc, origin) as r from {_V} where origin <> -1) where r = 1) w
    on w.net = p.net and w.len = p.len)"""


def decisions(t):
    return backbone.prefix_decisions(t.rib)


query("win2_prefix_decision", f"select net, len, origin, origin_vis, total_vis, moas, tie, minority, reason from {DECISION}")(decisions)
query("agg4_resolve_counters", f"""select * from (select unnest(['prefixes', 'kept', 'below_min_peers', 'as_set_only', 'no_usable_origin', 'moas', 'ties', 'minority_winner']) as counter,
    unnest([count(*), count(*) filter (reason is null), count(*) filter (reason = 'below_min_peers'), count(*) filter (reason = 'as_set_only'),
    count(*) filter (reason = 'no_usable_origin'), count(*) filter (moas), count(*) filter (tie), count(*) filter (minority)]) as n from {DECISION})
    union all select 'min_peers', 2 union all select 'peer_ases', count(distinct peer_as) from @rib""")(
    lambda t: backbone.resolve_counters(decisions(t), t.rib))
query("agg5_links", f"select distinct upstream, origin from @rib where upstream > 0 and origin > 0 and ({PREASON}) is null and ({OREASON}) is null")(lambda t: backbone.links(t.rib))
query("agg6_range_totals", "select 'ipv4' as family, count(*) as n, cast(sum(range_end - range_start + 1) as bigint) as addresses from @base")(
    lambda t: backbone.range_totals(t.base))
query("win10_sorted_prefixes", "select distinct net, len from @rib order by net, len")(lambda t: backbone.sort_prefixes(t.rib.select("net", "len").distinct()))
_CATA = """select concat('c', cast(user_id % 12 as string)) as collector, date_trunc('hour', ts) as slot, max(event_id) as path, cast(floor(sum(value) * 400000) as bigint) as bytes
    from @events group by 1, 2"""
_SLOT = "timestamp '2024-01-20 10:00:00'"
query("win11_pick_dumps", f"""select collector, path, bytes, slot <> {_SLOT} as fallback, bytes < 5000000 as too_small from (select *, row_number() over (partition by collector order by slot desc) as r
    from ({_CATA}) where slot <= {_SLOT} and slot >= {_SLOT} - interval 36 hour) where r = 1""")(
    lambda t: backbone.pick_dumps(t.sql(_CATA), F.expr(_SLOT)).select("collector", "path", "bytes", "fallback", "too_small"))
query("win11_dump_gate", f"""select count(*) as collectors, count(*) filter (slot <> {_SLOT}) as fallbacks, count(*) filter (bytes < 5000000) as small,
    count(*) >= 7 and count(*) filter (bytes < 5000000) = 0 as ok from (select *, row_number() over (partition by collector order by slot desc) as r
    from ({_CATA}) where slot <= {_SLOT} and slot >= {_SLOT} - interval 36 hour) where r = 1""")(
    lambda t: backbone.dump_gate(backbone.pick_dumps(t.sql(_CATA), F.expr(_SLOT))))
_FLAT = f"""(with p as (select net, len, origin as asn from {DECISION} where reason is null), b as (select net as s from p union select net + {pow2('32 - len')} from p),
    s as (select s as range_start, lead(s) over (order by s) - 1 as range_end from b),
    m as (select range_start, range_end, arg_max(asn, p.len) as asn from (select *, unnest(range(8, 25)) as l from s where range_end is not null) s
    join p on p.len = l and p.net = range_start - range_start % {pow2('32 - l')} group by all)
    select min(range_start) as range_start, max(range_end) as range_end, asn from (select *, sum(h) over (order by range_start) as g from (
    select *, case when lag(range_end) over w + 1 = range_start and lag(asn) over w = asn then 0 else 1 end as h from m window w as (order by range_start)))
    group by g, asn)"""
query("backbone_origin_ranges", f"select range_start, range_end, asn from {_FLAT}")(lambda t: backbone.origin_ranges(decisions(t)))

# ---------------------------------------------------------------- comparison
A, B = "@base", "@base_b"


def _align(a: str, b: str) -> str:
    return f"""(with c as (select range_start as p from {a} union select range_end + 1 from {a} union select range_start from {b} union select range_end + 1 from {b}),
        s as (select p as range_start, lead(p) over (order by p) - 1 as range_end from c)
        select * from (select s.range_start, s.range_end, coalesce(a.range_end >= s.range_start, false) as in_a, coalesce(b.range_end >= s.range_start, false) as in_b,
        case when a.range_end >= s.range_start then a.asn end as a_asn, case when a.range_end >= s.range_start then a.range_start end as a_start,
        case when b.range_end >= s.range_start then b.asn end as b_asn from s asof left join {a} a on s.range_start >= a.range_start
        asof left join {b} b on s.range_start >= b.range_start where s.range_end is not null) where in_a or in_b)"""


SEG = _align(A, B)
CLASSED = f"(select *, range_end - range_start + 1 as size, case when in_a and not in_b then 'only_a' when not in_a then 'only_b' when a_asn = b_asn then 'same' else 'differ' end as class from {SEG})"
COLS = "range_start, range_end, in_a, in_b, a_asn, a_start, b_asn"


def segs(t):
    return compare.align(t.base, t.base_b)


def classed(t):
    return compare.simple_class(segs(t))


query("win7_align", f"select {COLS} from {SEG}")(segs)
query("win8_top_disagreements", f"select class, range_start, range_end, size, r as rank from (select *, row_number() over (partition by class order by size desc, range_start) as r from {CLASSED} where class <> 'same') where r <= 40")(
    lambda t: compare.largest(classed(t)).select("class", "range_start", "range_end", "size", F.col("rank").cast("bigint").alias("rank")))
query("agg15_class_totals", f"select class, count(*) as segments, cast(sum(size) as bigint) as addresses from {CLASSED} group by class")(
    lambda t: compare.class_totals(classed(t)))
query("agg15_agreement", f"""select a_covered, b_covered, both_covered, round(same / both_covered, 4) as agreement, round(both_covered / a_covered, 4) as b_covers_of_a,
    round(both_covered / b_covered, 4) as a_covers_of_b from (select cast(sum(size) filter (in_a) as bigint) as a_covered, cast(sum(size) filter (in_b) as bigint) as b_covered,
    cast(sum(size) filter (in_a and in_b) as bigint) as both_covered, cast(sum(size) filter (a_asn = b_asn) as bigint) as same from {CLASSED})""")(
    lambda t: compare.agreement(segs(t)))
query("agg26_only_a_split", f"""select case when touched then 'partly_routed' when a_asn in (select asn from {B}) then 'asn_elsewhere' else 'asn_absent' end as kind,
    count(*) as segments, cast(sum(size) as bigint) as addresses from (select *, bool_or(in_b) over (partition by a_start) as touched from {CLASSED} where in_a) where not in_b group by 1""")(
    lambda t: compare.only_a_split(segs(t), t.base_b))
query("agg27_only_a_by_size", f"select concat('~/', cast(32 - cast(ceil(log2(size)) as integer) as string)) as bucket, count(*) as n from {CLASSED} where class = 'only_a' group by 1")(
    lambda t: compare.only_a_by_size(segs(t)))
query("join10_adjacency", f"""select a_asn, b_asn, bool_or(l.upstream is not null) as adjacent from (select distinct 3000 + s_suppkey % 30 as a_asn, 200000 + s_nationkey as b_asn from @supplier) p
    left join (select distinct upstream, origin from @rib where upstream > 0 and origin > 0 and ({PREASON}) is null and ({OREASON}) is null) l on (l.upstream = a_asn and l.origin = b_asn) or (l.upstream = b_asn and l.origin = a_asn) group by all""")(
    lambda t: joins.adjacent_in_paths(t.sql("select distinct 3000 + s_suppkey % 30 as a_asn, 200000 + s_nationkey as b_asn from @supplier"), backbone.links(t.rib)))
_A50 = "(select range_start, range_end, 200000 + asn % 50 as asn from @base)"
_LPM = lambda where: f"""(select range_start, max(len) as len, arg_max(net, len) as net from (select s.range_start, d.len, d.net from (select *, unnest(range(8, 25)) as l from df) s
    join dec d on d.len = l and d.net = range_start - range_start % {pow2('32 - l')} where {where}) group by range_start)"""
_CLS9 = f"""(with dec as (select * from {DECISION}), fb as {_FLAT.replace(DECISION, 'dec')}, seg as {_align(_A50, 'fb')}, df as (select * from seg where in_a and in_b and a_asn <> b_asn),
    lk as (select distinct upstream as u, origin as o from @rib where upstream > 0 and origin > 0 and ({PREASON}) is null and ({OREASON}) is null),
    k as {_LPM('d.reason is null')}, x as {_LPM('d.reason is not null')}, v as (select net, len, origin as asn from {_V} where origin <> -1)
    select seg.range_start, seg.range_end, seg.a_asn, seg.b_asn, case when in_a and not in_b then 'only_a' when not in_a then 'only_b' when a_asn = b_asn then 'same'
    when exists (select 1 from v where v.net = k.net and v.len = k.len and v.asn = a_asn) then 'moas'
    when exists (select 1 from v where v.net = x.net and v.len = x.len and v.asn = a_asn) then 'below_floor'
    when exists (select 1 from lk where (u = a_asn and o = b_asn) or (u = b_asn and o = a_asn)) then 'adjacent' else 'unrelated' end as class, k.len as b_len
    from seg left join k on k.range_start = seg.range_start left join x on x.range_start = seg.range_start)"""


def cls9(t):
    d = cut(decisions(t))
    b = backbone.origin_ranges(d)
    seg = cut(compare.align(t.sql(f"select * from {_A50}"), b))
    return compare.classify_segments(seg, d, backbone.candidate_votes(t.rib), backbone.links(t.rib))


query("cls9_disagreement", f"select range_start, range_end, a_asn, b_asn, class from {_CLS9}")(
    lambda t: cls9(t).select("range_start", "range_end", "a_asn", "b_asn", "class"))
query("agg27_differ_by_length", f"select b_len, cast(sum(range_end - range_start + 1) as bigint) as addresses from {_CLS9} where class not in ('only_a', 'only_b', 'same') group by 1")(
    lambda t: compare.differ_by_length(cls9(t)))
