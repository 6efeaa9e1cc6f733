"""Registry, per-network measures, names, countries, evaluation and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from netorigin.functions import vocab
from netorigin.functions.space import v6
from netorigin.operators import entities, evaluate, joins, quant, registry, sampling, sets
from netorigin.plans.catalog import query
from netorigin.plans.q_ranges import dc
from netorigin.plans.tables import DC, merged, pow2

# ---------------------------------------------------------------- registry
_EXP = "(select *, start + unnest(range(0, count)) as asn from @delegation_blocks)"
_REG = f"""(select asn, rir, cc, date as registered, status, case when opaque_id is not null then concat(rir, ':', opaque_id) end as holder, conflict from (
    select *, row_number() over (partition by asn order by ordinal desc, rir desc, opaque_id desc, status desc) as r, min(rir) over (partition by asn) <> max(rir) over (partition by asn) as conflict from {_EXP}) where r = 1)"""
_OK = f"(select * from {_REG} where not conflict)"
_DEL = f"(select * from {_OK} where status in ('allocated', 'assigned'))"
_SIZES = f"(select holder, count(*) as size, case when count(*) <= 1 then 'single' when count(*) <= 250 then 'siblings' else 'pool' end as kind from {_DEL} where holder is not null group by holder)"
_MEM = f"(select d.asn, d.holder, kind, size from {_DEL} d join {_SIZES} s on s.holder = d.holder)"


def rows(t):
    return registry.registry_rows(t.delegation_blocks)


def reg(t):
    return registry.clean_registry(rows(t))


query("set3_expand_blocks", f"select asn, rir, status, ordinal from {_EXP}")(
    lambda t: registry.expand_blocks(t.delegation_blocks).select("asn", "rir", "status", "ordinal"))
query("agg23_registry_rows", f"select asn, rir, cc, registered, status, holder, conflict from {_REG}")(rows)
_TEXT = lambda c: F.array_join(F.array_sort(F.transform(c, lambda a: a.cast("string"))), ",")
_PARTED = f"(select asn, holder, case when kind = 'pool' then asn >> 16 end as part, kind, size from {_MEM})"
query("agg11_holder_clusters", f"""select holder, part, kind, size, list_aggregate(list_sort(list(cast(asn as string))), 'string_agg', ',') as asns
    from {_PARTED} group by holder, part, kind, size""")(
    lambda t: registry.holder_clusters(reg(t)).withColumn("asns", _TEXT("asns")))
query("agg11_pool_parts", f"""select holder, part, size, list_aggregate(list_sort(list(cast(asn as string))), 'string_agg', ',') as asns from (select *, asn >> 16 as part from {_MEM} where kind = 'pool')
    group by holder, part, size""")(
    lambda t: registry.pool_parts(reg(t)).withColumn("asns", _TEXT("asns")))
query("agg12_registry_stats", f"""select 'asns_total' as stat, count(*) as value from {_OK} union all select 'delegated', count(*) from {_DEL}
    union all select 'conflicts', count(*) from {_REG} where conflict union all select concat('status:', status), count(*) from {_OK} group by status
    union all select concat('rir:', rir), count(*) from {_DEL} group by rir union all select 'holders', count(*) from {_SIZES}
    union all select 'sibling_clusters', count(*) from {_SIZES} where kind = 'siblings' union all select 'asns_in_sibling_clusters', coalesce(sum(size), 0)::bigint from {_SIZES} where kind = 'siblings'
    union all select 'pool_clusters', count(*) from {_SIZES} where kind = 'pool' union all select 'asns_in_pools', coalesce(sum(size), 0)::bigint from {_SIZES} where kind = 'pool'
    union all select 'largest_sibling_cluster', max(size) from {_SIZES} where kind = 'siblings'""")(lambda t: registry.registry_stats(rows(t)))
_LISTED = "(select distinct 300000 + s_suppkey * 37 as asn from @supplier)"
query("cls14_sibling_candidates", f"""select m.asn, m.holder, v.via from {_MEM} m join (select holder, string_agg(cast(asn as string), ',' order by asn) as via from {_MEM}
    where kind = 'siblings' and asn in (select asn from {_LISTED}) group by holder) v on v.holder = m.holder where m.kind = 'siblings' and m.asn not in (select asn from {_LISTED})""")(
    lambda t: registry.sibling_candidates(t.sql(f"select * from {_LISTED}"), reg(t)).withColumn("via", F.array_join(F.transform("via", lambda a: a.cast("string")), ",")))
_ITEMS = "(select asn, qid from (select 300000 + c_custkey * 16 as asn, concat('Q', cast(c_nationkey as string)) as qid from @customer))"
query("agg24_name_reach", f"""with m as (select * from {_MEM} where kind = 'siblings'), per as (select holder, min(qid) as lo, max(qid) as hi, count(*) filter (qid is null) as unnamed
    from m left join {_ITEMS} i on i.asn = m.asn group by holder), t as (select (select count(*) from {_ITEMS}) as ia, (select count(distinct qid) from {_ITEMS}) as it,
    (select count(*) from {_DEL}) as d, (select count(*) from {_ITEMS} where asn in (select asn from {_DEL})) as dir,
    (select coalesce(sum(unnamed), 0) from per where lo = hi) as inh, (select count(*) from per where lo <> hi) as dis)
    select unnest(['item_asns', 'items', 'delegated_asns', 'direct_in_delegated', 'not_in_registry', 'inherited_via_siblings', 'named_after_propagation', 'multiplier',
    'clusters_with_disagreeing_items', 'pct_named_direct', 'pct_named_after']) as stat, unnest([ia::double, it, d, dir, ia - dir, inh, dir + inh, round((dir + inh) / dir, 2), dis,
    round(100.0::double * dir / d, 2), round(100.0::double * (dir + inh) / d, 2)]) as value from t""")(
    lambda t: registry.name_reach(t.sql(f"select * from {_ITEMS}"), reg(t)))

# ---------------------------------------------------------------- measures
query("agg7_win3_eyeballs", """select *, row_number() over (order by eyeball_users desc, asn) as eyeball_rank from (
    select asn, cast(sum(users) as bigint) as eyeball_users from @eyeballs group by asn)""")(
    lambda t: quant.eyeball_totals(t.eyeballs).select("asn", "eyeball_users", "eyeball_rank"))
query("agg7_eyeball_pct", "select asn, round(sum(cast(pct as decimal(20,10)))::double, 4) as pct from @eyeballs group by asn")(
    lambda t: quant.eyeball_totals(t.eyeballs.withColumn("pct", F.col("pct").cast("decimal(20,10)"))).select("asn", F.col("eyeball_pct_internet").cast("double").alias("pct")))
query("agg8_roa_counts", "select asn, count(*) as rpki_roas from @vrps group by asn")(lambda t: quant.roa_counts(t.vrps))
_P4 = "(select distinct net, len, origin as asn from @rib)"
_R4 = f"select asn, net as range_start, net + {pow2('32 - len')} - 1 as range_end from {_P4}"
query("agg9_prefix_footprint", f"""select asn, prefixes_v4, cast(0 as bigint) as prefixes_v6, ipv4_addresses, '0' as ipv6_addresses from (select asn, count(*) as prefixes_v4 from {_P4} group by asn)
    join (select asn, cast(sum(range_end - range_start + 1) as bigint) as ipv4_addresses from ({merged(_R4, 'asn')}) group by asn) using (asn)""")(
    lambda t: quant.prefix_footprint(t.rib.select("net", "len", F.col("origin").alias("asn")).distinct()))
_R6 = "select asn, hi::uhugeint * 18446744073709551616 as range_start, hi::uhugeint * 18446744073709551616 + (1::uhugeint << (128 - len)::uhugeint) - 1 as range_end from @rib6"
query("agg9_prefix_footprint_v6", f"""select asn, coalesce(prefixes_v4, 0) as prefixes_v4, coalesce(prefixes_v6, 0) as prefixes_v6, coalesce(ipv4_addresses, 0) as ipv4_addresses, coalesce(cast(a as varchar), '0') as ipv6_addresses
    from (select asn, count(*) as prefixes_v4 from {_P4} group by asn) full join (select asn, cast(sum(range_end - range_start + 1) as bigint) as ipv4_addresses from ({merged(_R4, 'asn')}) group by asn) using (asn)
    full join (select asn, count(*) as prefixes_v6 from @rib6 group by asn) using (asn) full join (select asn, sum((range_end - range_start + 1)::hugeint) as a from ({merged(_R6, 'asn')}) group by asn) using (asn)""")(
    lambda t: quant.prefix_footprint(t.rib.select("net", "len", F.col("origin").alias("asn")).distinct(),
                                     t.rib6.select(v6(F.col("hi"), F.lit(0).cast("bigint")).alias("net"), "len", "asn")))
_ROUTES = "(select distinct net, len, origin as asn from @rib)"
_STATE = f"""(select net, len, asn, case when bool_or(vasn = asn and maxlen >= len) then 'valid' when bool_or(vasn is not null) then 'invalid' else 'notfound' end as state from (
    select r.net, r.len, r.asn, v.asn as vasn, v.maxlen from (select *, unnest(range(8, len + 1)) as l from {_ROUTES}) r
    left join @vrps v on v.len = l and v.net = r.net - r.net % {pow2('32 - l')}) group by all)"""


def routes(t):
    return t.rib.select("net", "len", F.col("origin").alias("asn"))


query("cls10_route_states", f"select net, len, asn, state from {_STATE}")(lambda t: quant.route_states(routes(t), t.vrps))
query("agg10_route_validation", f"""select *, case when rov_invalid > 0 then 'has_invalids' when rov_valid > 0 and rov_notfound = 0 then 'all_valid' when rov_valid > 0 then 'partial' else 'unknown' end as rpki_rov_status
    from (select asn, count(*) filter (state = 'valid') as rov_valid, count(*) filter (state = 'invalid') as rov_invalid, count(*) filter (state = 'notfound') as rov_notfound from {_STATE} group by asn)""")(
    lambda t: quant.route_validation(quant.route_states(routes(t), t.vrps)))
query("agg25_announced", "select asn, count(*) as ranges, sum(range_end - range_start + 1)::bigint as addresses, asn in (select asn from @base6) as has_v6 from @base group by asn")(
    lambda t: quant.announced(t.base, t.base6))
_NB = "select 200000 + o_custkey as asn, o_orderkey as position, 3000 + o_orderkey % 97 as neighbour, case o_orderstatus when 'F' then 'left' when 'O' then 'right' else 'uncertain' end as side from @orders"
query("agg28_neighbours", f"""select asn, count(*) filter (side = 'left') as left_count, count(*) filter (side = 'right') as right_count, count(*) filter (side = 'uncertain') as uncertain_count,
    string_agg(case when r <= 5 and side = 'left' then cast(neighbour as string) end, ',' order by r) as sample_left, string_agg(case when r <= 5 and side = 'right' then cast(neighbour as string) end, ',' order by r) as sample_right
    from (select *, row_number() over (partition by asn, side order by position) as r from ({_NB})) group by asn""")(
    lambda t: quant.neighbour_counts(t.sql(_NB)).select("asn", "left_count", "right_count", "uncertain_count", *[
        F.nullif(F.array_join(F.transform(c, lambda a: a.cast("string")), ","), F.lit("")).alias(c) for c in ("sample_left", "sample_right")]))
_RIRT = "select 200000 + c_custkey as asn, case when c_nationkey % 3 = 0 then 'ripencc' when c_nationkey % 3 = 1 then 'arin' else null end as rir, case when c_acctbal > 0 then concat('C', cast(c_nationkey as string)) end as country, '2024-01-01' as allocated, 'assigned' as status from @customer where c_nationkey <> 4"
_RANKT = "select 200000 + s_suppkey as asn, 'JPNIC' as rir, concat('R', cast(s_nationkey as string)) as country, s_suppkey as asrank from @supplier"


def per_asn(t):
    return {"rir": t.sql(_RIRT), "rank": t.sql(_RANKT), "rpki": quant.roa_counts(t.vrps)}


_J4 = f"({_RIRT}) a full join ({_RANKT}) b using (asn) full join (select asn, count(*) as rpki_roas from @vrps group by asn) c using (asn)"
query("join4_merge_sources", f"select asn, a.status, b.asrank, c.rpki_roas from {_J4}")(
    lambda t: joins.merge_sources(per_asn(t)).select("asn", "rir.status", "rank.asrank", "rpki.rpki_roas"))
query("cls20_quant_record", f"""select asn, coalesce(case a.rir when 'ripencc' then 'RIPE' when 'arin' then 'ARIN' end, case when b.rir = 'JPNIC' then 'APNIC' end) as rir,
    coalesce(a.country, b.country) as country, a.allocated, b.asrank, c.rpki_roas, concat_ws(',', case when a.status is not null then 'registry delegations' end,
    case when b.asrank is not null then 'AS rank' end, case when c.rpki_roas is not null then 'validated payloads' end) as sources from {_J4}""")(
    lambda t: quant.quant_records(per_asn(t), "2024-01-01").select("asn", "quant.rir", "quant.country", "quant.allocated", "quant.asrank", "quant.rpki_roas",
                                                                  F.array_join(F.transform("sources", lambda s: s["source"]), ",").alias("sources")))

# ---------------------------------------------------------------- precedence merges and set operations
_OVR = "select 200000 + s_suppkey * 3 as asn, case when s_nationkey % 4 = 0 then null else concat('O', cast(s_nationkey as string)) end as cc from @supplier"
_DRV = "select asn, cc, concat('wikidata:Q', cast(asn as string), ':P17') as source from @countries"
query("join5_precedence", f"select asn, coalesce(o.cc, d.cc) as cc, case when o.cc is not null then 'override' else d.source end as source from ({_OVR}) o full join ({_DRV}) d using (asn)")(
    lambda t: joins.precedence_merge(t.sql(_OVR), t.sql(_DRV), "cc"))
_VETO = f"(select asn, case when o.has then o.cc else d.cc end as cc, case when o.has then 'override' else d.source end as source from (select *, true as has from ({_OVR})) o full join ({_DRV}) d using (asn))"


def veto(t):
    return joins.precedence_merge_veto(t.sql(_OVR), t.sql(_DRV))


query("join6_precedence_veto", f"select * from {_VETO} where cc is not null")(veto)
query("agg13_source_counts", f"select split_part(source, ':', 1) as source, count(*) as n from {_VETO} where cc is not null group by 1 union all select 'total', count(*) from {_VETO} where cc is not null")(
    lambda t: entities.source_counts(veto(t)))
query("join8_without", "select asn, name from @names where asn not in (select asn from @asn_lists)")(lambda t: sets.without(t.names, t.asn_lists))
query("join9_within", "select asn, name from @names where asn in (select asn from @asn_lists)")(lambda t: sets.within(t.names, t.asn_lists))
_SRC = "select distinct concat('s', cast(user_id % 150 as string)) as source_id from @events"
_FILES = "select concat('s', cast(user_id % 90 as string)) as source_id, cast(cast(ts as date) as string) as fetched_at from @events"
query("join11_oldest_input", f"select s.source_id, min(fetched_at) as fetched_at from ({_SRC}) s left join ({_FILES}) f on f.source_id = s.source_id group by 1")(
    lambda t: joins.oldest_input(t.sql(_SRC), t.sql(_FILES)))
query("set1_union_lists", "select asn from @asn_lists union select asn from @countries")(lambda t: sets.union_lists(t.asn_lists, t.countries))
query("set2_difference", "select asn from @names except select asn from @asn_lists")(lambda t: sets.difference(t.names, t.asn_lists))
query("set2_intersection", "select asn from @names intersect select asn from @asn_lists")(lambda t: sets.intersection(t.names, t.asn_lists))
_TA, _TB = "select l_orderkey, l_linenumber, l_quantity from @lineitem", "select l_orderkey, case when l_suppkey % 10 = 0 then 9 else l_linenumber end as l_linenumber, l_quantity from @lineitem"
query("set4_table_difference", f"""select 'only_a' as side, count(*) as n, l_orderkey, l_linenumber, l_quantity from ({_TA} except all {_TB}) group by all
    union all select 'only_b' as side, count(*) as n, l_orderkey, l_linenumber, l_quantity from ({_TB} except all {_TA}) group by all""")(
    lambda t: sets.table_difference(t.sql(_TA), t.sql(_TB)))
query("dq23_reproducible", "select count(*) as differences from @base where false")(
    lambda t: sets.table_difference(t.base, t.base.repartition(7, "asn")).agg(F.count("*").alias("differences")))

# ---------------------------------------------------------------- claims
_BIND = """select concat('http://www.wikidata.org/entity/Q', cast(o_orderkey % 4000 as string)) as item, case when o_custkey % 40 = 0 then '12-15' else concat('AS', cast(o_orderkey % 5003 as string)) end as asn,
    case when o_custkey % 17 = 0 then 'http://wikiba.se/ontology#DeprecatedRank' when o_custkey % 5 = 0 then 'http://wikiba.se/ontology#PreferredRank' else 'http://wikiba.se/ontology#NormalRank' end as rank,
    case when o_custkey % 13 = 0 then '2020' end as ended, case when o_orderkey % 4000 % 7 = 0 then null else concat('Net  ', cast(o_orderkey % 4000 as string), ' ') end as en,
    cast(null as string) as mul, case o_custkey % 4 when 0 then '' when 1 then 'r|https://www.arin.net/|' when 2 then 'r|https://a.example/|' else 'r|https://bgp.tools/| s||' end as refs,
    case when o_custkey % 3 = 0 then 'P159' else 'P17' end as via, case o_custkey % 6 when 0 then 'ZZ' when 1 then ' us' when 2 then 'DE' when 3 then 'UKR' else substr(concat('RU', 'UA', 'CN', 'CY'), cast(o_custkey % 4 * 2 + 1 as int), 2) end as cc,
    concat('http://www.wikidata.org/entity/', case o_orderkey % 5 when 0 then 'Q8646' when 1 then 'Q7835' when 2 then 'Q23681' when 3 then 'Q999' else 'Q23334' end) as region from @orders"""
_NRSN = "case when rank like '%DeprecatedRank' then 'deprecated' when ended is not null then 'ended' when asn like '%-%' or asn = 'AS0' then 'bad_asn' when refs like '%arin%' then 'restricted_refs_only' end"
_NCL = f"(select split_part(item, '/', 5) as qid, case when asn like '%-%' or asn = 'AS0' then null else cast(substr(asn, 3) as bigint) end as asn, nullif(trim(regexp_replace(en, ' +', ' ', 'g')), '') as label, {_NRSN} as reason from ({_BIND}))"
query("flt5_name_claims", f"select coalesce(reason, 'admitted') as counter, count(*) as n from {_NCL} group by 1")(
    lambda t: entities.claim_counters(entities.name_claims(t.sql(_BIND))))
_NAMES = f"(select asn, case when min(qid) <> max(qid) then 'conflict' when max(label) is null then 'no_label' else 'ok' end as status, min(qid) as q, max(label) as l from {_NCL} where reason is null group by asn)"
query("agg20_names_per_asn", f"select asn, status, case when status = 'ok' then q end as qid, case when status = 'ok' then l end as name from {_NAMES}")(
    lambda t: entities.names_per_asn(entities.name_claims(t.sql(_BIND))))
_CC = "upper(trim(cc))"
_CRSN = f"""case when rank like '%DeprecatedRank' then 'deprecated' when ended is not null then 'ended' when not regexp_full_match({_CC}, '[A-Z]{{2}}') or {_CC} = 'ZZ' then 'bad_code'
    when refs like '%arin%' then 'restricted_refs_only' end"""
_CCL = f"(select split_part(item, '/', 5) as qid, via, {_CC} as cc, rank like '%PreferredRank' as preferred, {_CRSN} as reason from ({_BIND}))"
query("flt4_country_claims", f"select coalesce(reason, 'admitted') as counter, count(*) as n from {_CCL} group by 1")(
    lambda t: entities.claim_counters(entities.country_claims(t.sql(_BIND))))
_CITEM = f"""(select qid, coalesce(a, b) as cc, case when a is not null then 'P17' when b is not null then 'P159' end as via, ha and a is null as ambiguous_p17, a is null and hb and b is null as ambiguous_p159 from (
    select qid, max(cc) filter (via = 'P17') as a, max(cc) filter (via = 'P159') as b, bool_or(via = 'P17') as ha, bool_or(via = 'P159') as hb from (
    select qid, via, case when coalesce(pl, nl) = coalesce(ph, nh) then coalesce(pl, nl) end as cc from (select qid, via, min(cc) filter (preferred) as pl, max(cc) filter (preferred) as ph,
    min(cc) filter (not preferred) as nl, max(cc) filter (not preferred) as nh from {_CCL} where reason is null group by qid, via)) group by qid))"""


def citems(t):
    return entities.country_per_item(entities.country_claims(t.sql(_BIND)))


query("agg21_country_per_item", f"select * from {_CITEM}")(citems)
_HIT = f"(select split_part(item, '/', 5) as qid, case region when 'http://www.wikidata.org/entity/Q8646' then 'HK' when 'http://www.wikidata.org/entity/Q7835' then 'UA' when 'http://www.wikidata.org/entity/Q23681' then 'CY' when 'http://www.wikidata.org/entity/Q23334' then 'GE' end as code from ({_BIND}) where o is null)".replace(" where o is null", "")
_REF = f"""(select qid, case when o = 'territory' then state when o = 'sar' then lo when o = 'unchanged' then cc end as cc, case when o = 'territory' then 'territory' when o = 'sar' then 'region' when o = 'unchanged' then via end as via, o as outcome from (
    select *, case when state is not null and state = shi and (cc is null or cc = state or cc = case state when 'CY' then 'TR' else 'RU' end) then 'territory' when state is not null then 'ambiguous_territory'
    when lo = hi and (cc is null or cc = 'CN') then 'sar' else 'unchanged' end as o from (select qid, cc, via, state, shi, lo, hi from {_CITEM} full join
    (select qid, min(code) filter (code <> 'HK') as state, max(code) filter (code <> 'HK') as shi, min(code) as lo, max(code) as hi from {_HIT} where code is not null group by qid) using (qid))))"""


def refined(t):
    b = t.sql(_BIND).withColumn("via", F.lit("region"))
    return entities.refine_regions(citems(t), entities.region_hits(b))


query("agg22_refine_regions", f"select qid, cc, via, outcome from {_REF}")(refined)
query("join7_countries_for_asns", f"select n.asn, c.cc, n.q as qid, c.via from {_NAMES} n join {_REF} c on c.qid = n.q where n.status = 'ok' and c.cc is not null")(
    lambda t: entities.countries_for_asns(entities.admitted_names(entities.name_claims(t.sql(_BIND))), refined(t)))

# ---------------------------------------------------------------- drafts and candidates
_DOS = """select 200000 + c_custkey as asn, case c_nationkey % 6 when 0 then null else concat(c_name, ' — AS', cast(200000 + c_custkey as string)) end as display_name,
    case when c_nationkey % 12 = 0 then null else 'Legal Co' end as legal_name, case c_nationkey % 5 when 0 then 'https://www.op.example/x' when 1 then 'https://ripe.net/a' else null end as website,
    case when c_custkey % 3 = 0 then concat('Q', cast(c_custkey as string)) end as qid, case when c_nationkey % 4 = 0 then null when c_nationkey % 4 = 1 then 'de' else 'ZZ' end as hq_country,
    'Bonn, NRW' as hq_city, c_custkey % 2 as ev, c_custkey as ordinal from @customer"""
_EV = "case ev when 0 then array(named_struct('url', 'https://docs.op.example/y', 'claim', concat('Runs AS', cast(asn as string), ' from Bonn.'))) else array(named_struct('url', 'https://other.example/', 'claim', 'x')) end"


def dossiers(t):
    return t.sql(f"select *, {_EV} as evidence from ({_DOS})")


_NM = "coalesce(case when display_name is null then null else split_part(display_name, ' — AS', 1) end, legal_name)"
query("cls15_draft_names", f"""select asn, case when basis is not null then name end as name, basis, case basis when 'evidence_names_asn' then 'https://docs.op.example/y' when 'operator_website' then website
    when 'wikidata_item' then concat('https://www.wikidata.org/wiki/', qid) end as url, case when name is null then 'no_name' when basis is null then 'no_admissible_source' end as reason from (
    select *, case when name is null then null when ev = 0 and website like '%op.example%' then 'evidence_names_asn' when website like '%op.example%' then 'operator_website' when qid is not null then 'wikidata_item' end as basis
    from (select *, {_NM} as name from ({_DOS})))""")(
    lambda t: entities.draft_names(dossiers(t)).select("asn", "name", "basis", "url", "reason"))
query("cls16_draft_countries", f"""select asn, case when basis is not null then 'DE' end as cc, basis, reason, basis is not null and coalesce(country, '') <> 'DE' as review from (
    select *, case when reason is null then case when ev = 0 and website like '%op.example%' then 'evidence_names_country' when qid is not null then 'wikidata_item' when website like '%op.example%' then 'operator_website' end end as basis from (
    select *, case when hq_country is null then 'no_hq_country' when hq_country = 'ZZ' then 'bad_code' end as reason from ({_DOS}))) left join (select asn, country from @asn_meta) using (asn)""".replace(
    "basis, reason, basis", "basis, coalesce(reason, case when basis is null then 'no_admissible_source' end) as reason, basis"))(
    lambda t: entities.draft_countries(dossiers(t), t.asn_meta.select("asn", "country")).select("asn", "cc", "basis", "reason", "review"))
_DUP = "select 200000 + o_custkey as asn, concat('n', cast(o_orderkey as string)) as name, o_orderkey as ordinal from @orders"
query("win16_latest", f"select asn, arg_max(name, ordinal) as name from ({_DUP}) group by asn")(lambda t: sampling.latest_by(t.sql(_DUP), "asn", "ordinal"))
_META2 = "select asn, concat(description, case asn % 7 when 0 then ' Mobile' when 1 then ' vpn' when 2 then ' CDN and mobile' else '' end) as description, country, category, network_role from @asn_meta"
_LINE = """concat('AS', asn, '  # ', description, ' (', coalesce(country, ''), ') cat=', coalesce(category, '-'), ' role=', coalesce(network_role, '-'), ' — src: metadata description match')"""
query("cls13_keyword_candidates", f"select s as file, asn, {_LINE} as line from (select *, unnest(case asn % 7 when 0 then ['mobile_carrier'] when 1 then ['vpn_provider'] when 2 then ['cdn', 'mobile_carrier'] else [] end) as s from ({_META2}))")(
    lambda t: entities.keyword_candidates(t.sql(_META2)))
query("cls13_hosting_gap", """select 'hosting_extra' as file, l.asn, concat('AS', l.asn, '  # ', coalesce(description, 'NOT IN as-metadata'), ' (', coalesce(country, '?'), ') cat=', coalesce(category, '-'), ' — src: ',
    case when dc then 'datacenter list' else 'bad-asn list' end) as line from (select asn, bool_or(list = 'hosting_extra') as dc from @asn_lists where list in ('hosting_extra', 'bad_asn') group by asn) l
    left join @asn_meta m on m.asn = l.asn where category is distinct from 'hosting'""")(
    lambda t: entities.hosting_gap(t.asn_meta, t.asn_lists.filter("list = 'hosting_extra'"), t.asn_lists.filter("list = 'bad_asn'")))
query("cls13_seed", "select 'vpn_provider' as file, c_custkey as asn, concat('AS', c_custkey, '  # ', c_name, ' — src: u') as line from @customer")(
    lambda t: entities.seed_candidates(t.sql("select concat('AS', cast(c_custkey as string), ' # ', c_name) as value from @customer union all select c_name as value from @customer"), "u"))

# ---------------------------------------------------------------- evaluation
def arrays(df):
    cols = [c for c in ("labels", "acceptable") if c in df.columns]
    return df.withColumns({c: F.split(c, ",") for c in cols})


def scored(t, subset="all", preds="preds"):
    return evaluate.scored_rows(arrays(t.gold), arrays(getattr(t, preds)), subset)


def _scored(preds="@preds", where="true"):
    return f"""(select *, len(list_filter(labels, lambda x: not list_contains(pred, x))) = 0 and len(list_filter(pred, lambda x: not list_contains(allowed, x))) = 0 as exact from (
        select g.asn, string_split(g.labels, ',') as labels, list_concat(string_split(g.labels, ','), string_split(g.acceptable, ',')) as allowed, g.provenance,
        string_split(p.labels, ',') as pred, p.confidence from @gold g join {preds} p on p.asn = g.asn where {where}))"""


def _labels(s):
    return f"""(select label, tp + fn as support, tp, fp, fn, p as precision, r as recall, case when p + r > 0 then round(2 * p * r / (p + r), 3) end as f1 from (
        select *, case when tp + fp > 0 then round(tp / (tp + fp), 3) end as p, case when tp + fn > 0 then round(tp / (tp + fn), 3) end as r from (
        select label, count(*) filter (k = 'tp') as tp, count(*) filter (k = 'fp') as fp, count(*) filter (k = 'fn') as fn from (
        select l as label, case when list_contains(pred, l) then 'tp' else 'fn' end as k from (select *, unnest(labels) as l from {s})
        union all select l, 'fp' from (select *, unnest(pred) as l from {s}) where not list_contains(allowed, l)) group by label)))"""


def _summary(s):
    return f"""(select unnest(['n', 'exact_match', 'macro_precision', 'macro_recall']) as metric, unnest([n::double, e, mp, mr]) as value from
        (select count(*) as n, round(count(*) filter (exact) / count(*), 3) as e from {s}), (select round(avg(precision), 3) as mp, round(avg(recall), 3) as mr from {_labels(s)}))"""


query("agg16_label_scores", f"select * from {_labels(_scored())}")(lambda t: evaluate.label_scores(scored(t)))
query("agg16_summary", f"select * from {_summary(_scored())}")(lambda t: evaluate.summary_scores(scored(t)))
query("agg17_calibration", f"select case when confidence >= 0.9 then '0.9-1.0' when confidence >= 0.7 then '0.7-0.9' else '0.0-0.7' end as bucket, count(*) as n, round(count(*) filter (exact) / count(*), 3) as exact_match from {_scored()} group by 1")(
    lambda t: evaluate.calibration(scored(t)))
_IND = "provenance <> 'weak'"
query("agg18_arm_delta", f"select metric, a.value as a, b.value as b from {_summary(_scored(where=_IND))} a join {_summary(_scored('@preds_b', _IND))} b using (metric)")(
    lambda t: evaluate.arm_delta(arrays(t.gold), arrays(t.preds), arrays(t.preds_b)))
query("cls21_misses", f"select asn, confidence, provenance from {_scored()} where not exact")(lambda t: evaluate.misses(scored(t)).select("asn", "confidence", "provenance"))
_GR = """select c_custkey % 400 as asn, case c_nationkey % 3 when 0 then 'cdn' when 1 then 'business' else 'hosting_provider,cdn' end as labels, case when c_nationkey % 2 = 0 then 'business,cdn' else 'hosting_provider' end as acceptable,
    concat('src', cast(c_nationkey % 4 as string)) as source, case c_nationkey % 5 when 0 then 'independent' when 1 then 'pinned' else 'weak' end as provenance from @customer"""
query("agg19_merge_gold", f"""select asn, array_to_string(list_sort(l), ',') as labels, array_to_string(list_sort(list_filter(a, lambda x: not list_contains(l, x))), ',') as acceptable, source,
    case p when 2 then 'independent' when 1 then 'pinned' else 'weak' end as provenance from (select asn, list_distinct(flatten(list(string_split(labels, ',')))) as l,
    list_distinct(flatten(list(string_split(acceptable, ',')))) as a, string_agg(distinct source, ' + ' order by source) as source, max(case provenance when 'independent' then 2 when 'pinned' then 1 else 0 end) as p
    from ({_GR}) group by asn)""")(
    lambda t: evaluate.merge_gold(arrays(t.sql(_GR))).withColumns({c: F.array_join(c, ",") for c in ("labels", "acceptable")}))
query("cls17_gold_from_lists", "select asn, list, count(*) as n from (select asn, list from @asn_lists where list <> 'bad_asn') group by all")(
    lambda t: evaluate.gold_from_lists(t.asn_lists).groupBy("asn", F.regexp_extract("source", "lists/(.*)", 1).alias("list")).agg(F.count("*").alias("n")))
_PIN = "select asn, 'business' as labels, 'cdn' as acceptable, case when asn % 2 = 0 then 'CUSTOMER' else 'nomatch' end as guard, 'pin' as source from (select 200000 + s_suppkey as asn from @supplier)"
query("cls17_gold_from_pins", f"select p.asn, 'pinned: pin' as source from ({_PIN}) p join @asn_meta m on m.asn = p.asn where regexp_matches(description, '(?i)' || guard)")(
    lambda t: evaluate.gold_from_pins(arrays(t.sql(_PIN)), t.asn_meta).select("asn", "source"))
_POOL = """(select asn, case category when 'education_research' then 'education' when 'government_admin' then 'government' when 'business' then 'business' when 'isp' then 'access' end as class from @asn_meta
    where category <> 'hosting' and (category <> 'isp' or network_role = 'access_provider') union select asn, 'bad_asn' from @asn_lists where list = 'bad_asn' union select asn, 'x4b_vpn' from @asn_lists where list = 'vpn_provider')"""
query("win14_class_sample", f"""select asn, class from (select *, row_number() over (partition by class order by md5(concat(asn, '|42')), asn) as r from {_POOL} where asn in (select asn from @base))
    where r <= case class when 'bad_asn' then 22 when 'x4b_vpn' then 12 when 'education' then 8 when 'government' then 8 else 10 end""")(
    lambda t: evaluate.gold_from_samples(evaluate.gold_pool(t.asn_meta, t.asn_lists.filter("list = 'bad_asn'"), t.asn_lists.filter("list = 'vpn_provider'")), t.base).select(
        "asn", F.col("source").alias("class")))
query("win15_stratified_limit", """with c as (select provenance, count(*) as size, least(count(*), greatest(1, floor(count(*) * 100.0::double / sum(count(*)) over () + 0.5))) as q from @gold group by provenance),
    u as (select provenance, unnest(range(1, q::bigint + 1)) as k from c), o as (select *, row_number() over (order by case when k = 1 then 0 else 1 end, k, provenance) as o from u),
    f as (select provenance, count(*) as q from o where o <= 100 or k = 1 group by provenance)
    select asn, g.provenance from (select *, row_number() over (partition by provenance order by md5(concat(asn, '|42')), asn) as r from @gold) g join f on f.provenance = g.provenance where r <= f.q""")(
    lambda t: sampling.stratified_limit(t.gold, 100).select("asn", "provenance"))
query("win13_every_nth", "select range_start, asn from (select *, row_number() over (order by range_start) as r, count(*) over () as n from @base) where (r - 1) % greatest(1, n // 2000) = 0")(
    lambda t: sampling.every_nth(t.base, vocab.REFIND_SAMPLES).select("range_start", "asn"))
query("win13_seeded_sample", "select range_start from @base order by md5(concat(range_start, '|20260918')), range_start limit 400")(
    lambda t: sampling.seeded_sample(t.base.select("range_start"), "range_start", 400, 20260918))
query("win9_probe_targets", "select asn, least(range_start + 1, range_end) as ip from (select *, row_number() over (partition by asn order by range_end - range_start desc, range_start) as r from @base) where r <= 5")(
    lambda t: sampling.probe_targets(t.base))
_PR = """select doc_id - case when doc_id % 50 = 0 then 1 else 0 end as asn, case doc_id % 6 when 0 then 'cdn,alien' when 1 then 'hosting_provider' else 'cdn' end as labels,
    case doc_id % 5 when 0 then 'cdn' when 1 then 'hosting_extra' when 2 then 'correction' when 3 then 'wrong' else null end as action, doc_id % 3 = 0 as has_correction,
    case when doc_id % 9 = 0 then 'bogus' else 'isp' end as correction_category, case when doc_id % 11 = 0 then null else (doc_id % 120) / 100.0 end as confidence, text as evidence, false as needs_review from @documents"""
_WANT = "select doc_id as asn from @labels"
query("cls18_check_predictions", f"""select asn, action, md5(evidence) as evidence, needs_review, reject from (select coalesce(p.asn, w.asn) as asn, coalesce(substring(evidence, 1, 300), '') as evidence,
    case when broken then 'none' else coalesce(action, 'none') end as action, coalesce(broken, false) as needs_review,
    case when p.asn is null then 'missing' when w.asn is null then 'foreign' when n > 1 then 'duplicate' when labels like '%alien%' then 'unknown_label' when action = 'wrong' then 'unknown_action'
    when confidence is null then 'confidence_not_a_number' when confidence > 1 then 'confidence_out_of_range' when has_correction and correction_category = 'bogus' then 'unknown_correction_category' end as reject
    from (select *, count(*) over (partition by asn) as n, case coalesce(action, 'none') when 'cdn' then not list_contains(string_split(labels, ','), 'cdn') when 'hosting_extra' then not list_contains(string_split(labels, ','), 'hosting_provider')
    when 'correction' then not has_correction else false end as broken from ({_PR})) p full join (select distinct asn from ({_WANT})) w on w.asn = p.asn)""")(
    lambda t: evaluate.check_predictions(arrays(t.sql(_PR)), t.sql(_WANT)).select("asn", "action", F.md5("evidence").alias("evidence"), "needs_review", "reject"))
_SHARE = f"""(with c as (select range_start as p from @base union select range_end + 1 from @base union select range_start from {DC} union select range_end + 1 from {DC}),
    s as (select p as range_start, lead(p) over (order by p) - 1 as range_end from c)
    select b.asn, round(sum(case when d.range_end >= s.range_start then s.range_end - s.range_start + 1 else 0 end) / sum(s.range_end - s.range_start + 1) * 100, 1) as pct
    from s asof join @base b on s.range_start >= b.range_start asof left join {DC} d on s.range_start >= d.range_start where s.range_end is not null and b.range_end >= s.range_start group by b.asn)"""
query("cls19_packets", f"""select m.asn, m.description, m.country, m.category, m.network_role, coalesce(r.n, 0) as announced_ipv4_ranges, coalesce(r.a, 0)::bigint as announced_ipv4_addresses,
    m.asn in (select asn from @base6) as announces_ipv6, coalesce(s.pct, 0.0) as pct_in_dc_overlay, coalesce(l.bad, false) as in_bad_asn_list, coalesce(l.vpn, false) as in_x4b_vpn_asns,
    coalesce(l.dc, false) as in_x4b_dc_asns, coalesce(l.names, '') as existing_flags from @asn_meta m left join (select asn, count(*) as n, sum(range_end - range_start + 1) as a from @base group by asn) r on r.asn = m.asn
    left join {_SHARE} s on s.asn = m.asn left join (select asn, bool_or(list = 'bad_asn') as bad, bool_or(list = 'vpn_provider') as vpn, bool_or(list = 'hosting_extra') as dc,
    string_agg(distinct case when list not in ('bad_asn', 'eyeball_confirm') then list end, ',' order by case when list not in ('bad_asn', 'eyeball_confirm') then list end) as names from @asn_lists group by asn) l on l.asn = m.asn""")(
    lambda t: evaluate.packets(t.asn_meta, t.asn_meta, t.base, t.base6, dc(t), t.asn_lists, t.asn_lists.filter("list = 'vpn_provider'"),
                               t.asn_lists.filter("list = 'hosting_extra'")).withColumn("existing_flags", F.array_join("existing_flags", ",")))
query("flt9_external_fields", """select c_custkey as asn, concat('{', array_to_string(list_filter([case when c_nationkey % 3 = 0 then '"holder":"' || c_name || '"' end,
    case when c_nationkey % 2 = 0 then '"bgp_neighbours":{"left":' || c_nationkey || ',"right":1,"uncertain":0}' end, case c_nationkey % 4 when 1 then '"peeringdb":{"name":"' || c_name || '"}' when 2 then '"peeringdb":{"present":false}' end,
    case when c_nationkey % 5 = 0 then '"rdap":{"name":"x"}' end], lambda x: x is not null), ','), '}') as packet from @customer""")(
    lambda t: evaluate.external_fields(t.sql("""select c_custkey as asn, case when c_nationkey % 3 = 0 then c_name end as holder, case when c_nationkey % 2 = 0 then c_nationkey end as left, 1 as right, 0 as uncertain,
        case c_nationkey % 4 when 1 then true when 2 then false end as pdb_present, c_name as pdb_name, cast(null as string) as pdb_website,
        case when c_nationkey % 5 = 0 then map('name', 'x') else cast(map() as map<string,string>) end as rdap, cast(map() as map<string,string>) as rdns, cast(null as string) as site from @customer""")))
