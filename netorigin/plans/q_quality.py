"""Data-quality gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from netorigin.functions import addr, vocab
from netorigin.functions.space import v6
from netorigin.operators import classify, entities, gates, sampling
from netorigin.plans import q_ranges as qr
from netorigin.plans.catalog import query
from netorigin.plans.tables import DC, INTERVALS, VPN, ip_text

_COUNTS = """select o_orderpriority as feed, case when o_orderstatus = 'F' then 'origin' when o_orderstatus = 'O' then 'cidr' else 'metadata' end as kind, count(*) as good,
    count(*) filter (where o_custkey % 97 = 0) as bad from @orders group by 1, 2"""
query("dq1_parse_budget", f"select *, case kind when 'origin' then bad <= good // 1000 when 'cidr' then bad <= 20 else good >= 90000 end as ok from ({_COUNTS})")(
    lambda t: gates.parse_budget(t.sql(_COUNTS)))
query("dq2_curation_conflicts", "select distinct asn from @asn_lists where list = 'eyeball_confirm' and asn in (select asn from @asn_lists where list in ('vpn_provider', 'hosting_extra', 'enterprise_gateway', 'cdn'))")(
    lambda t: gates.curation_conflicts(t.asn_lists))
_TOV = "select 200000 + c_custkey as asn, case c_nationkey % 4 when 0 then 'crimea' when 1 then 'abkhazia' when 2 then 'northern_cyprus' else null end as territory from @customer"
_TCC = "select 200000 + c_custkey as asn, case c_custkey % 3 when 0 then 'UA' when 1 then 'GE' else 'TR' end as cc from @customer"
query("dq3_territory", f"""select asn, territory, state, cc from (select *, case territory when 'crimea' then 'UA' when 'abkhazia' then 'GE' else 'CY' end as state from ({_TOV}) where territory is not null)
    join ({_TCC}) using (asn) where cc <> state""")(
    lambda t: entities.territory_violations(t.sql(_TOV), t.sql(_TCC)))
_REFL = "(select distinct asn from @asn_lists where list in ('hosting_extra', 'bad_asn'))"
_HOST = "(select asn from @asn_meta where category = 'hosting')"
query("dq4_reference_coverage", f"""select h as hosting_asns, r as reference_asns, c as coverage, c >= 0.6 as coverage_ok, h >= 10000 as hosting_ok from (
    select (select count(*) from {_HOST}) as h, (select count(*) from {_REFL}) as r, round((select count(*) from {_REFL} where asn in {_HOST})::double / (select count(*) from {_REFL}), 4) as c)""")(
    lambda t: gates.reference_coverage(t.asn_meta, t.sql(f"select * from {_REFL}")))
query("dq4_uncovered", f"select asn from {_REFL} where asn not in {_HOST}")(lambda t: gates.uncovered_reference(t.asn_meta, t.sql(f"select * from {_REFL}")))

# ---------------------------------------------------------------- drift over metrics of order years
_Y = "(select max(yr) as y from @metric_rows)"
_NOW = f"select metric, value from @metric_rows where yr = (select y from {_Y}) and metric <> 'status:P'"
_HIST = f"""select metric, case when yr = (select y from {_Y}) - 1 then 'previous' else 'pin' end as kind, concat('v', cast(yr as string), '.01.01') as label, value,
    concat(cast(yr as string), '-01-01T00:00:00Z') as at from @metric_rows where yr < (select y from {_Y})"""
_ACK = "select distinct metric, 'ok' as reason from @metric_rows where metric like 'prio:1%' or metric like 'status:O%'"
_REV = f"select metric, value as rvalue, concat(cast(yr - 2 as string), '-06-01T00:00:00Z') as reviewed_at from @metric_rows where yr = (select y from {_Y}) and metric like 'status:F'"


def state(t):
    return gates.metric_state(t.sql(_NOW), t.sql(_HIST))


_STATE = f"""(select metric, coalesce(n.value, 0) as now, coalesce(p.value, 0) as prev, a.v as v1, a.label as l1, b.v as v2, b.label as l2 from ({_NOW}) n
    full join (select metric, value from ({_HIST}) where kind = 'previous') p using (metric)
    full join (select metric, value as v, label from (select *, row_number() over (partition by metric order by label desc) as r from ({_HIST}) where kind = 'pin') where r = 1) a using (metric)
    full join (select metric, value as v, label from (select *, row_number() over (partition by metric order by label desc) as r from ({_HIST}) where kind = 'pin') where r = 2) b using (metric))"""


def _drift(warn, drop, rise, band):
    return f"""(select metric, now, prev, d as drift, case when first = 'pass' and slide then 'warn' else first end as status, case when first = 'recovery' then near end as baseline, slide,
        case when slide then best end as slide_from, ieff as review_in_effect from (select *, coalesce((now - best) / best < -{drop}, false) as slide,
        case when d is null then 'skipped' when abs(d) <= {warn} then 'pass' when abs(d) <= case when d < 0 then {drop} else {rise} end then 'warn'
        when nearoff <= {band} then 'recovery' when ack then 'acked' else 'fail' end as first from (
        select *, least(o1, o2) as nearoff, case when o1 is null then l2 when o2 is null then l1 when o1 < o2 or (o1 = o2 and l1 < l2) then l1 else l2 end as near from (
        select *, case when v1 > 0 and abs((v1 - best) / best) <= {band} then abs((now - v1) / v1) end as o1, case when v2 > 0 and abs((v2 - best) / best) <= {band} then abs((now - v2) / v2) end as o2,
        (now - prev) / nullif(prev, 0) as d from (select s.metric, s.now, s.prev, case when r.rvalue is null then v1 else r.rvalue end as v1, case when r.rvalue is null then l1 else 'reviewed ' || substr(reviewed_at, 1, 10) end as l1,
        case when r.rvalue is null then v2 end as v2, case when r.rvalue is null then l2 end as l2, greatest(case when r.rvalue is null then v1 else r.rvalue end, case when r.rvalue is null then v2 end) as best,
        r.rvalue is not null as ieff, s.metric in (select metric from ({_ACK})) as ack from {_STATE} s left join ({_REV}) r on r.metric = s.metric)))))"""


for _n, _p in (("dq5_dq8_drift_hosting", vocab.HOSTING_POLICY), ("dq10_drift_layers", vocab.LAYER_POLICY)):
    query(_n, f"select metric, now, prev, round(drift, 6) as drift, status, baseline, slide, slide_from, review_in_effect from {_drift(*_p)}")(
        lambda t, p=_p: gates.drift(state(t), p, t.sql(_ACK), t.sql(_REV).withColumn("rvalue", F.col("rvalue").cast("bigint"))).select(
            "metric", "now", "prev", F.round("drift", 6).alias("drift"), "status", "baseline", "slide", "slide_from", "review_in_effect"))
query("dq9_ledger", f"""select count(*) as metrics, bool_and(status in ('pass', 'skipped')) as clean, count(*) filter (status = 'fail') as failed from {_drift(*vocab.HOSTING_POLICY)}""")(
    lambda t: gates.run_ledger(gates.drift(state(t), vocab.HOSTING_POLICY, t.sql(_ACK), t.sql(_REV)), "b1")[1].drop("build_id"))
query("dq9_events", f"select metric, status, slide from {_drift(*vocab.HOSTING_POLICY)} where status in ('warn', 'recovery', 'acked', 'fail')")(
    lambda t: gates.run_ledger(gates.drift(state(t), vocab.HOSTING_POLICY, t.sql(_ACK), t.sql(_REV)), "b1")[0].select("metric", "status", "slide"))
_PRIO = "(select concat('prio:', o_orderpriority) as metric, count(*) as n, min(o_orderpriority) < '2' or min(o_orderpriority) between '3' and '4' as again from @orders group by o_orderpriority)"
_DAYS = ("2024-01-10T00:00:00Z", "2024-01-11T00:00:00Z", "2024-01-21T00:00:00Z")


@query("dq9_fold", f"""select '{_DAYS[0]}' as build_at, metric, n // 2 as now, 'acked' as status, true as slide, case when again then n // 2 end as rvalue from {_PRIO}
    union all select '{_DAYS[1]}', metric, n // 2, case when again then 'pass' else 'warn' end, not again, case when again then n // 2 end from {_PRIO}
    union all select '{_DAYS[2]}', metric, n // 2, 'pass', false, null from {_PRIO}""")
def _(t):
    """Three builds: every metric halves and is acked, some are named as new references; then nothing moves, and the named ones pass where the others slide; then
    newer pins retire the reviews."""
    n = t.sql(f"select * from {_PRIO}")
    half = F.floor(F.col("n") / 2).cast("bigint")
    state = lambda prev, pin, at: n.select("metric", half.alias("now"), prev.cast("bigint").alias("prev"), F.array(F.struct(
        F.lit(at[:10]).alias("label"), pin.cast("bigint").alias("value"), F.lit(at).alias("at"))).alias("pins"))
    acks, quiet = n.select("metric", F.lit("half the orders are gone for good").alias("reason")), n.select("metric", F.lit(None).cast("string").alias("reason")).limit(0)
    named, none = n.filter("again").select("metric"), n.select("metric").limit(0)
    old, new = "2024-01-07T00:00:00Z", "2024-01-14T00:00:00Z"
    first = n.select("metric", F.lit(None).cast("bigint").alias("rvalue"), F.lit(None).cast("string").alias("reviewed_at")).limit(0)
    return gates.ledger_fold([(_DAYS[0], state(F.col("n"), F.col("n"), old), acks, named), (_DAYS[1], state(half, F.col("n"), old), quiet, none),
                              (_DAYS[2], state(half, half, new), quiet, none)], vocab.HOSTING_POLICY, first)


query("dq22_forecast", f"""with s as (select metric, now, coalesce(greatest(v1, v2), 0) as best from {_STATE}), h as (select *, case when best > 0 then best else now end as healthy from s),
    d as (select *, case when now > 0 then (healthy - now) / now when best > 0 then 0 end as x from h), n as (select *, case when now > 0 then (healthy - now) / now end as y from d)
    select metric, problem from (select metric, unnest(list_filter([case when y > 0.2 and best = 0 then 'healthy_value_would_fail' end, case when y > 0.2 and best > 0 then 'only_pins_would_rescue' end,
    case when now < 100 then 'below_floor' end, case when (now - best) / nullif(best, 0) < -0.1 then 'sliding' end, 'stale'], lambda p: p is not null)) as problem from n)""")(
    lambda t: gates.forecast(state(t), vocab.HOSTING_POLICY, t.sql("select distinct metric, 100 as floor from @metric_rows"), 60.0))

# ---------------------------------------------------------------- lookups and exports
_EXPECT = "select 200000 + s_suppkey * 7 as asn, case when s_nationkey % 3 = 0 then '^CUSTOMER' when s_nationkey % 3 = 1 then '0$' else '^Customer' end as pattern from @supplier"
query("dq11_sentinels", f"select e.asn, e.pattern, n.name as found from ({_EXPECT}) e left join @names n on n.asn = e.asn where not coalesce(regexp_matches(n.name, e.pattern), false)")(
    lambda t: gates.sentinel_violations(t.names, t.sql(_EXPECT), "name"))
query("dq12_refind", "select count(*) as mismatches from @base where false")(
    lambda t: gates.refind_mismatches(sampling.every_nth(t.base, vocab.REFIND_SAMPLES), t.base).agg(F.count("*").alias("mismatches")))
_PANEL = "select distinct 16777216 + p_partkey * 5003 as ip, case when p_size % 2 = 0 then 'vpn' else 'hosting' end as want_verdict, cast(null as string) as want_rule, cast(null as bigint) as want_asn from @part"
query("dq13_panel", f"select p.ip, p.want_verdict, 'vpn' as verdict from ({_PANEL}) p where want_verdict <> 'vpn'")(
    lambda t: gates.panel_failures(t.sql(_PANEL), classify.lookup(t.sql(_PANEL), qr.segments(t))).select("ip", "want_verdict", "verdict"))
query("dq14_interval_invariants", """select violation, n::bigint as n from (select 'inverted' as violation, count(*) filter (range_end < range_start) as n from @base union all
    select 'overlap', count(*) filter (range_start <= l) from (select *, lag(range_end) over (order by range_start) as l from @base) union all
    select 'not_coalesced', count(*) filter (l + 1 = range_start and p = asn % 3) from (select *, lag(range_end) over (order by range_start) as l, lag(asn % 3) over (order by range_start) as p from @base))""")(
    lambda t: gates.interval_violations(t.base.withColumn("p", F.col("asn") % 3), ["p"]))
query("dq14_product_rows", "select violation, 0::bigint as n from (select unnest(['inverted', 'overlap', 'not_coalesced']) as violation)")(
    lambda t: gates.interval_violations(qr.intervals(t), vocab.PAYLOAD_FIELDS))
query("dq16_address_text", f"""select event_id, case event_id % 5 when 1 then 'leading_zero' when 2 then 'wrong_address' when 3 then 'not_lowercase' end as reason from @any_ips where event_id % 5 in (1, 2, 3)""")(
    lambda t: gates.address_text_violations(t.sql(f"""select event_id, 4 as ip_version, case event_id % 5 when 1 then concat('0', {ip_text('ip')}) when 2 then {ip_text('(ip + 1) % 4294967296')}
        when 3 then concat({ip_text('ip')}, 'A') else {ip_text('ip')} end as text, ip as v4, cast(null as struct<hi:bigint,lo:bigint>) as v6 from @any_ips""")).select("event_id", "reason"))
_SIDES = """(with w as (select *, lag(range_end) over (order by range_start) as pe, lead(range_start) over (order by range_start) as ns from {0})
    select 'hit' as kind, 3 * count(*) as probes, 0::bigint as failures from w union all
    select 'miss', count(*) filter (coalesce(pe < range_start - 1, true) and range_start > 0) + count(*) filter (coalesce(ns > range_end + 1, true) and range_end < 4294967295), 0 from w)"""
query("dq17_probe_sweep", f"select * from {_SIDES.format('@base')}")(lambda t: gates.probe_sweep(t.base))
query("dq18_tiling", f"""with r as (select * from {VPN}), l as (select *, unnest(range(0, 33)) as k from r), b as (select range_start, range_end, k, (1::bigint << k) as blk from l),
    c as (select *, (range_start + blk - 1) // blk as lo, (range_end + 1) // blk as hi from b)
    select (select count(*) from r) as records, (select (count(*) filter (lo < hi and lo % 2 = 1) + count(*) filter (lo < hi and hi % 2 = 1 and not (lo % 2 = 1 and lo = hi - 1))) from c) as pieces,
    (select sum(range_end - range_start + 1)::bigint from r) as covered, 0::bigint as broken, 0::bigint as overlaps""")(
    lambda t: (lambda v: gates.tiling(addr.cidr_pieces(v), v))(qr.vpn(t)))
query("dq19_collisions", "select count(*) filter (s_hi = 0 and (s_lo >= 0 and s_lo <= 4294967295)) as compatible, count(*) filter (s_hi = 0 and s_lo <= 281474976710655 and e_lo >= 281470681743360) as mapped from (select 0 as s_hi, p_partkey * 140737488000 as s_lo, p_partkey * 140737488000 + 5000 as e_lo from @part)")(
    lambda t: gates.mapped_collisions(_six(t)))


def _six(t):
    d = t.sql("select p_partkey * 140737488000 as s, p_partkey * 140737488000 + 5000 as e from @part")
    z = F.lit(0).cast("bigint")
    return d.select(v6(z, F.col("s")).alias("range_start"), v6(z, F.col("e")).alias("range_end"))


query("dq20_vocabulary", f"""with i as (select {qr.VERDICT} as core_verdict, {qr.CATEGORY} as category, {qr.ROLE} as network_role from {INTERVALS}),
    w as (select 'core_verdict' as field, unnest([{', '.join(f"'{v}'" for v in vocab.VERDICTS)}]) as value union all select 'category', unnest([{', '.join(f"'{v}'" for v in vocab.CATEGORY_CODES)}])
    union all select 'network_role', unnest([{', '.join(f"'{v}'" for v in vocab.ROLE_CODES)}]))
    select count(*) as missing, 0::bigint as unknown from w where not exists (select 1 from i where (field = 'core_verdict' and core_verdict = value) or (field = 'category' and category = value) or (field = 'network_role' and network_role = value))""")(
    lambda t: gates.vocabulary_coverage(qr.intervals(t)).agg(F.count_if(F.col("problem") == "missing").alias("missing"), F.count_if(F.col("problem") == "unknown").alias("unknown")))
_SNAP = "select case when o_orderstatus = 'F' then 'ipv4' else 'ipv6' end as family, min(cast(year(o_orderdate) as string)) as build_ts, count(*) + max(case when o_orderstatus = 'F' then 1 else 0 end) as row_count from @orders group by 1"
_SROW = "select case when o_orderstatus = 'F' then 'ipv4' else 'ipv6' end as family from @orders"
query("dq21_snapshots", f"select concat('row_count:', family) as violation from (select s.family, row_count, (select count(*) from ({_SROW}) r where r.family = s.family) as n from ({_SNAP}) s) where row_count <> n union all select 'build_ts_differs' from ({_SNAP}) having min(build_ts) <> max(build_ts)")(
    lambda t: gates.snapshot_violations(t.sql(_SNAP), t.sql(_SROW)))
query("agg14_layer_counts", f"select 'base' as metric, count(*) as value from @base union all select 'vpn', count(*) from {VPN} union all select 'dc', count(*) from {DC} union all select 'names', count(*) from @names")(
    lambda t: gates.layer_counts({"base": t.base, "vpn": qr.vpn(t), "dc": qr.dc(t), "names": t.names}))
