"""Sources, sinks, streaming and the whole build."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netorigin.functions.space import V4, V6, v6
from netorigin.operators import backbone, classify, digest, gates, index, metrics, project, quant, ranges, registry, sets
from netorigin.operators.lineage import cut, shared_folder
from netorigin.plans import q_ranges as qr, q_networks as qn, q_routing as qt
from netorigin.plans.build import build_intervals
from netorigin.plans.catalog import ORACLES, query
from netorigin.plans.tables import FLAGS, HI6, SEGMENTS, hex128, ip_text, merged, ranges6, u128
from netorigin.functions import addr
from netorigin.sources import parse, sinks
from netorigin.streaming import lookup as stream_lookup, resume


def fresh_folder(t, name: str) -> str:
    """A fresh folder below the shared one."""
    return f"{shared_folder(t.spark)}/{name}-{uuid.uuid4()}"


S = lambda c: f"cast({c} as string)"

# ---------------------------------------------------------------- sources: lines built from the given tables
_RAW = "select *, case when o_orderkey % 50 = 0 then range_end - 5000 else range_end end as e, case when o_orderkey % 70 = 0 then 0 else asn end as a from (select o_orderkey, 16777216 + o_orderkey * 1024 as range_start, 16777216 + o_orderkey * 1024 + o_custkey % 1500 as range_end, 200000 + o_custkey as asn from @orders)"
query("src1_origin_ranges", f"select range_start, e as range_end, a as asn, e < range_start or a <= 0 as bad from ({_RAW})")(
    lambda t: parse.origin_ranges(t.sql(f"select concat({S('range_start')}, ',', {S('e')}, ',', {S('a')}, ',\"Name, with comma\"') as value from ({_RAW})")))
query("src1_good_bad", f"select count(*) filter (not (e < range_start or a <= 0)) as good, count(*) filter (e < range_start or a <= 0) as bad from ({_RAW})")(
    lambda t: parse.good_bad(parse.origin_ranges(t.sql(f"select concat({S('range_start')}, ',', {S('e')}, ',', {S('a')}, ',x') as value from ({_RAW})"))))
query("src1_origin_ranges_v6", "select lpad(lower(hex(x)), 32, '0') as start_hex, asn from (select (o_orderkey::uhugeint * 10000000000000000000::uhugeint + o_custkey::uhugeint) * 1000000000::uhugeint + 7::uhugeint as x, 1 + o_custkey as asn from @orders)")(
    lambda t: parse.origin_ranges_v6(t.sql(f"""select concat(x, ',', x, ',', {S('1 + o_custkey')}, ',n') as value from (select *, concat({S('o_orderkey')}, lpad({S('o_custkey')}, 19, '0'), '000000007') as x from @orders)""")).select(
        V6.hex(F.col("range_start")).alias("start_hex"), "asn"))
_CI = f"select event_id, ip - ip % 256 as net from @any_ips"
query("src2_cidr_list", f"select case when event_id % 6 = 5 then null else net end as range_start, case when event_id % 6 = 5 then null else net + 255 end as range_end, event_id % 6 = 5 as bad from ({_CI}) where event_id % 6 not in (0, 1, 4)")(
    lambda t: parse.cidr_list(t.sql(f"""select case event_id % 6 when 0 then '# note' when 1 then '   ' when 2 then concat({ip_text('net')}, '/24 # why') when 3 then concat({ip_text('net')}, '/24') when 4 then '2001:db8::/32' else 'junk/99' end as value from ({_CI})""")))
query("src3_asn_csv", "select distinct c_custkey as asn from @customer where c_custkey > 0")(
    lambda t: parse.first_column_asns(t.sql(f"select 'ASN,Entity' as value from @region union all select concat({S('c_custkey')}, ',\"', c_name, ', x\"') as value from @customer union all select 'bad,' as value from @region"), "ASN,Entity"))
query("src4_as_lines", "select c_custkey as asn from @customer")(
    lambda t: parse.as_lines(t.sql(f"select concat('AS', {S('c_custkey')}, ' # ', c_name) as value from @customer union all select concat(' AS', {S('c_custkey')}) as value from @customer")))
query("src5_as_metadata", "select 200000 + c_custkey as asn, case when c_nationkey % 4 = 0 then 'H' else c_name end as description, concat('C', c_nationkey) as country from @customer")(
    lambda t: parse.as_metadata(t.sql(f"""select c_custkey as ordinal, concat('[{{"asn":', {S('200000 + c_custkey')}, ',"description":"old"}},{{"asn":', {S('200000 + c_custkey')}, ',"handle":"H"',
        case when c_nationkey % 4 = 0 then '' else concat(',"description":"', c_name, '"') end, ',"countryCode":"C', {S('c_nationkey')}, '","extra":1}}]') as value from @customer""")).select("asn", "description", "country"))
query("src6_sparql", "select concat('Q', c_custkey) as item, case when c_nationkey % 3 = 0 then null else 'AS5' end as asn from @customer")(
    lambda t: parse.sparql_bindings(t.sql(f"""select concat('{{"results":{{"bindings":[{{"item":{{"value":"Q', {S('c_custkey')}, '"}}', case when c_nationkey % 3 = 0 then '' else ',"asn":{{"value":"AS5"}}' end, '}}]}}}}') as value from @customer""")).select("item", "asn"))
_DL = """select o_orderkey, case when o_orderkey % 90 = 1 then 'lacnic' else 'arin' end as rir, case when o_orderkey % 7 = 0 then 'ZZ' else 'US' end as cc, case when o_orderkey % 80 = 2 then '0' else '2' end as n,
    case when o_orderkey % 60 = 3 then 'odd' else 'assigned' end as st from @orders"""
_DLT = f"select concat(rir, '|', cc, '|asn|', {S('o_orderkey')}, '|', n, '|20240102|', st, '|h1') as value, o_orderkey as ordinal from ({_DL}) union all select 'arin|*|asn|*|9|summary' as value, -1 as ordinal from @region union all select '2.3|arin|1|2' as value, -2 as ordinal from @region"
query("src7_delegations", f"""select o_orderkey as start, nullif(cc, 'ZZ') as cc, '2024-01-02' as date, case when rir <> 'arin' then 'foreign_registry' when n = '0' then 'bad_start_or_count' when st = 'odd' then 'unknown_status' end as violation from ({_DL})""")(
    lambda t: parse.delegations(t.sql(_DLT), "arin").select("start", "cc", "date", "violation"))
query("src8_delegations_lenient", f"select o_orderkey as start, greatest(cast(n as bigint), 1) as count, st as status from ({_DL})")(
    lambda t: parse.delegations(t.sql(_DLT), strict=False).select("start", "count", "status"))
query("src9_as_rank", "select 200000 + c_custkey as asn, c_custkey as asrank, case when c_nationkey % 5 = 0 then null else c_name end as asn_name, c_nationkey::bigint as cone_asns from @customer")(
    lambda t: parse.as_rank(t.sql(f"""select concat('{{"data":{{"asns":{{"edges":[{{"node":{{"asn":"', {S('200000 + c_custkey')}, '","rank":', {S('c_custkey')}, ',"asnName":"', case when c_nationkey % 5 = 0 then '' else c_name end,
        '","cone":{{"numberAsns":', {S('c_nationkey')}, '}}}}}}]}}}}}}') as value from @customer""")).select("asn", "asrank", "asn_name", "cone_asns"))
query("src10_eyeballs", "select c_custkey as asn, concat('C', c_nationkey) as economy, c_custkey * 3 as users from @customer")(
    lambda t: parse.eyeballs(t.sql(f"""select concat('{{"Data":[{{"AS":"', {S('c_custkey')}, '","CC":"C', {S('c_nationkey')}, '","Users":', {S('c_custkey * 3')}, ',"Percent of Internet":0.5}}]}}') as value from @customer""")).select("asn", "economy", "users"))
query("src11_vrps", "select asn, net as net4, len, maxlen from @vrps")(
    lambda t: parse.vrps(t.sql(f"select concat('AS', {S('asn')}, ',', {ip_text('net + 1')}, '/', {S('len')}, ',', {S('maxlen')}, ',ta,0') as value from @vrps union all select 'ASN,IP Prefix,Max Length,Trust Anchor' as value from @region")).select("asn", "net4", "len", "maxlen"))
query("src12_prefix_to_as", "select net as net4, len, unnest(case when origin % 3 = 0 then [origin, 7] else [origin] end) as asn from @rib where origin > 0")(
    lambda t: parse.prefix_to_as(t.sql(f"select concat({ip_text('net')}, chr(9), {S('len')}, chr(9), case when origin < 0 then '0' when origin % 3 = 0 then concat({S('origin')}, '_7') else {S('origin')} end) as value from @rib")).select("net4", "len", "asn"))
_FLN = "select c_custkey, case c_nationkey % 5 when 0 then 'no source' when 1 then 'src: x' else 'https://a.example/' end as c from @customer"
query("src14_flag_list", f"select 'cdn' as list, c_custkey as asn, case when c = 'no source' then 'no_source' end as violation, c_custkey = 5 as duplicate from ({_FLN}) union all select 'cdn', 5, null, true from @region where r_regionkey = 0 union all select 'cdn', null, 'malformed', false from @region")(
    lambda t: parse.flag_list(t.sql(f"select concat('AS', {S('c_custkey')}, '  # ', c) as value from ({_FLN}) union all select 'AS5 # src: again' as value from @region where r_regionkey = 0 union all select 'ASx' as value from @region union all select '# c' as value from @region"), "cdn").select(
        "list", "asn", "violation", "duplicate"))
query("src15_name_list", "select c_custkey as asn, c_name as name, case c_nationkey % 5 when 0 then 'no_source' when 1 then 'restricted_source' end as violation from @customer")(
    lambda t: parse.name_list(t.sql(f"select concat('AS', {S('c_custkey')}, '  ', c_name, '  # src: ', case c_nationkey % 5 when 0 then 'none' when 1 then 'https://stat.ripe.net/x' else 'https://a.example/ (2024)' end) as value from @customer")).select("asn", "name", "violation"))
query("src16_country_list", """select c_custkey as asn, case c_nationkey % 6 when 0 then null when 1 then 'DE' when 2 then 'EU' when 3 then 'UA' when 4 then 'RU' else 'FR' end as cc,
    case c_nationkey % 6 when 3 then 'crimea' when 4 then 'crimea' when 5 then 'atlantis' end as territory, case c_nationkey % 6 when 2 then 'bad_country' when 4 then 'wrong_state' when 5 then 'unknown_territory' end as violation from @customer""")(
    lambda t: parse.country_list(t.sql(f"""select concat('AS', {S('c_custkey')}, ' ', case c_nationkey % 6 when 0 then '--' when 1 then 'DE' when 2 then 'EU' when 3 then 'UA' when 4 then 'RU' else 'FR' end, ' # src: https://a.example/',
        case c_nationkey % 6 when 3 then ' territory: crimea' when 4 then ' territory: crimea' when 5 then ' territory: atlantis' else '' end) as value from @customer""")).select("asn", "cc", "territory", "violation"))
query("src17_corrections", "select c_custkey as asn, case c_nationkey % 4 when 0 then 'missing_field' when 1 then 'bad_category' when 2 then 'bad_role' end as violation from @customer")(
    lambda t: parse.check_corrections(t.sql("""select c_custkey as asn, case when c_nationkey % 4 = 1 then 'x' else 'isp' end as category, case when c_nationkey % 4 = 2 then 'x' else 'none' end as network_role,
        case when c_nationkey % 4 = 0 then ' ' else 'r' end as reason, 'u' as source_url, 'd' as date from @customer""")).select("asn", "violation"))
query("src18_interval_records", f"select range_start as start4, range_end as end4, asn, case when range_start % 5 = 0 then 'unknown_field' when range_start % 5 = 1 then 'bad_hex' end as violation from {qr._ROWS}")(
    lambda t: _records(t))


def _records(t):
    w = sinks.interval_json(project.to_wire(qr.intervals(t))).withColumn("s", V4.from_hex(F.col("start_hex")))
    v = F.when(F.col("s") % 5 == 0, F.regexp_replace("value", r"\}$", ',"more":1}')).when(
        F.col("s") % 5 == 1, F.regexp_replace("value", '"end_hex":"', '"end_hex":"0')).otherwise(F.col("value"))
    r = parse.interval_records(w.select(v.alias("value")))
    # A bad hex end has no number; give the row its end back from the text for the comparison.
    end = F.coalesce("end4", V4.from_hex(F.substring("end_hex", 2, 8)))
    return r.select("start4", end.alias("end4"), "asn", "violation")


query("src19_dossiers", "select 200000 + c_custkey as asn, c_name as display_name, concat('Q', c_custkey) as qid, 1 as claims from @customer")(
    lambda t: parse.dossiers(t.sql(f"""select c_custkey as ordinal, concat('{{"asn":', {S('200000 + c_custkey')}, ',"org":{{"display_name":"', c_name, '"}},"evidence":[{{"url":"u","claim":"c"}}],"external_ids":{{"wikidata_qid":"Q', {S('c_custkey')}, '"}}}}') as value from @customer""")).select(
        "asn", "display_name", "qid", F.size("evidence").alias("claims")))
query("src20_predictions", "select doc_id as asn, 'cdn' as labels, quality::double as confidence from @labels")(
    lambda t: parse.predictions(t.sql(f"""select concat('{{"asn":', {S('doc_id')}, ',"labels":["cdn"],"confidence":', {S('quality')}, '}}') as value from @labels union all select '{{"asn":7,"labels":["c' as value from @region""")).select(
        "asn", F.array_join("labels", ",").alias("labels"), "confidence"))
query("src21_metric_history", f"""with m as (select 'v' || yr || '.01.01' as label, metric, value, yr from @metric_rows), l as (select max(yr) as y from m)
    select metric, case when yr = y then 'previous' else 'pin' end as kind, case when yr = y then 'latest' else label end as label, value from m, l where yr >= y - 2""")(
    lambda t: parse.metric_history(t.sql("""select case when yr = (select max(yr) from @metric_rows) then 'latest' else concat('v', cast(yr as string), '.01.01') end as label,
        concat('{"build_id":"b","stats":', to_json(map_from_entries(collect_list(struct(metric, value)))), '}') as value from @metric_rows group by yr""")).select("metric", "kind", "label", "value"))
query("src22_cached_evidence", "select c_custkey as asn, case when c_nationkey % 2 = 0 then c_name end as holder, case when c_nationkey % 3 = 0 then false end as pdb_present from @customer")(
    lambda t: parse.cached_evidence(t.sql(f"""select concat('{{"asn":', {S('c_custkey')}, case when c_nationkey % 2 = 0 then concat(',"ripestat_overview":{{"holder":"', c_name, '"}}') else '' end,
        case when c_nationkey % 3 = 0 then ',"peeringdb":{{"present":false}}' else '' end, ',"errors":{{}}}}') as value from @customer""")).select("asn", "holder", "pdb_present"))

# ---------------------------------------------------------------- sinks: the text they write
_Q = lambda c: f"coalesce('\"' || {c} || '\"', 'null')"
query("snk1_interval_json", f"""select '{{"ip_version":4,"start_hex":"' || lpad(lower(hex(range_start)), 8, '0') || '","end_hex":"' || lpad(lower(hex(range_end)), 8, '0') || '","asn":' || coalesce(asn::varchar, 'null') || ',"as_org":' || {_Q('as_org')}
    || ',"category":' || {_Q('category')} || ',"network_role":' || {_Q('network_role')} || ',"bad_asn":' || bad_asn || ',"vpn_provider":' || vpn_provider || ',"mobile_carrier":' || mobile_carrier || ',"enterprise_gw":' || enterprise_gw
    || ',"cdn":' || cdn || ',"hosting_extra":' || hosting_extra || ',"vpn_range":' || vpn_range || ',"datacenter_range":' || datacenter_range || ',"core_verdict":"' || core_verdict || '","core_sources":["' || replace(core_sources, '|', '","') || '"]}}' as value from {qr._ROWS}""")(
    lambda t: sinks.interval_json(project.to_wire(qr.intervals(t))).select("value"))
_B = lambda c: f"{c}::int::varchar"
query("snk2_range_csv", f"""select concat_ws(',', '4', {ip_text('range_start')}, {ip_text('range_end')}, coalesce(asn::varchar, ''), coalesce(as_org, ''), coalesce(category, ''), coalesce(network_role, ''), {_B('bad_asn')}, {_B('vpn_provider')},
    {_B('mobile_carrier')}, {_B('enterprise_gw')}, {_B('cdn')}, {_B('hosting_extra')}, {_B('vpn_range')}, {_B('datacenter_range')}, core_verdict, core_sources) as value from {qr._ROWS}""")(
    lambda t: sinks.csv_lines(project.to_wire(qr.intervals(t))))
query("snk3_category_csv", "select concat_ws(',', asn::varchar, coalesce(name, ''), coalesce(cc, ''), '', '', '') as value from @names full join @countries using (asn)")(
    lambda t: sinks.category_lines(t.names.withColumnRenamed("name", "org").join(t.countries.withColumnRenamed("cc", "country"), "asn", "full").withColumns(
        {c: F.lit(None).cast("string") for c in ("category", "network_role", "flags")})))
query("snk4_decision_tsv", f"""select d.net, d.len, concat_ws(chr(9), {ip_text('d.net')} || '/' || d.len, coalesce(d.origin::varchar, ''), d.origin_vis::varchar, d.total_vis::varchar, case when d.moas then '1' else '0' end,
    coalesce(c.c, ''), coalesce(d.reason, '')) as value from {qt.DECISION} d left join (select net, len, string_agg(origin || ':' || vis, ',' order by vis desc, origin) as c from {qt._V} where origin <> -1 group by all) c on c.net = d.net and c.len = d.len""")(
    lambda t: sinks.decision_lines(qt.decisions(t), backbone.candidate_votes(t.rib)))
query("snk5_origin_csv", "select range_start || ',' || range_end || ',' || asn || ',' as value from @base")(lambda t: sinks.origin_lines(t.base).select("value"))
_J = lambda c: f"coalesce('\"' || {c} || '\"', 'null')"
query("snk6_registry_json", f"""select '{{"asn":' || asn || ',"rir":"' || rir || '","cc":' || {_J('cc')} || ',"registered":"' || registered || '","status":"' || status || '","holder":' || {_J('holder')} || '}}' as value from {qn._OK}""")(
    lambda t: sinks.registry_json(qn.reg(t)).select("value"))
query("snk6_holder_json", f"""select '{{"holder":"' || holder || '",' || case when kind = 'pool' then '"part":' || part || ',' else '' end || '"kind":"' || kind || '","size":' || size || ',"asns":[' || asns || ']}}' as value
    from (select holder, part, kind, size, string_agg(asn, ',' order by asn) as asns from {qn._PARTED} group by holder, part, kind, size)""")(
    lambda t: sinks.holder_json(registry.holder_clusters(qn.reg(t))).select("value"))


@query("snk6_written_registry", f"""select 'asn-registry' as part, count(*) as lines from {qn._OK} union all select 'holders', count(distinct holder) from {qn._MEM}
    union all select 'pools', count(*) from (select distinct holder, asn >> 16 from {qn._MEM} where kind = 'pool')""")
def _(t):
    """The three line files of the registry, written and read again."""
    path = fresh_folder(t, "registry")
    sinks.write_registry_rows(registry.clean_registry(registry.registry_rows(t.delegation_blocks, in_order=True)), path)
    reg = sinks.read_registry_rows(t.spark, path)
    parts = registry.member_parts(reg)
    sinks.write_clusters(registry.holder_heads(reg, parts), registry.pool_parts(reg, parts), path)
    count = lambda name: t.spark.read.text(f"{path}/{name}").agg(F.lit(name).alias("part"), F.count("*").alias("lines"))
    return count("asn-registry").union(count("holders")).union(count("pools"))


_WITH6 = f"""with a as ({qn._RIRT}), b as ({qn._RANKT}), e as (select asn, eyeball_users, eyeball_rank from ({ORACLES['agg7_win3_eyeballs']})), c as (select asn, count(*) as rpki_roas from @vrps group by asn),
    p as ({ORACLES['agg9_prefix_footprint_v6']}), v as ({ORACLES['agg10_route_validation']}),
    m as (select asn, coalesce(case a.rir when 'ripencc' then 'RIPE' when 'arin' then 'ARIN' end, case when b.rir = 'JPNIC' then 'APNIC' end) as rir, coalesce(a.country, b.country) as country, allocated, status, asrank,
    eyeball_users, eyeball_rank, rpki_roas, prefixes_v4, prefixes_v6, ipv4_addresses, ipv6_addresses, rov_valid, rov_invalid, rov_notfound, rpki_rov_status,
    a.asn is not null as ha, b.asn is not null as hb, e.asn is not null as he, c.asn is not null as hc, p.asn is not null as hp, v.asn is not null as hv
    from a full join b using (asn) full join e using (asn) full join c using (asn) full join p using (asn) full join v using (asn)
    where not (asn <= 0 or asn = 23456 or asn between 64496 and 131071 or asn >= 4200000000))"""
_FIELDS6 = ["rir", "country", "allocated", "status", "asrank", "eyeball_users", "eyeball_rank", "rpki_roas", "prefixes_v4", "prefixes_v6", "ipv4_addresses", "ipv6_addresses",
            "rov_valid", "rov_invalid", "rov_notfound", "rpki_rov_status"]


def six_sources(t) -> DataFrame:
    """Quantities of every ASN from all six sources."""
    footprint = quant.prefix_footprint(t.rib.select("net", "len", F.col("origin").alias("asn")).distinct(), t.rib6.select(v6(F.col("hi"), F.lit(0).cast("bigint")).alias("net"), "len", "asn"))
    return quant.quant_records({
        "rir": t.sql(qn._RIRT), "rank": t.sql(qn._RANKT), "eyeball": quant.eyeball_totals(t.eyeballs).drop("eyeball_pct_internet"), "rpki": quant.roa_counts(t.vrps),
        "prefixes": footprint, "rov": quant.route_validation(quant.route_states(qn.routes(t), t.vrps))}, "2024-01-01", {"rpki": "u"})


_NAMED6 = {"ha": "registry delegations", "hb": "AS rank", "he": "eyeball estimates", "hc": "validated payloads", "hp": "prefix table", "hv": "route validation"}
query("cls20_six_sources", f"""{_WITH6} select asn, {', '.join(_FIELDS6)}, concat_ws(',', {', '.join(f"case when {k} then '{v}' end" for k, v in _NAMED6.items())}) as sources from m""")(
    lambda t: six_sources(t).select("asn", *[f"quant.{c}" for c in _FIELDS6], F.array_join(F.transform("sources", lambda s: s["source"]), ",").alias("sources")))
_LISTS6 = {k: quant.SOURCE_FIELDS[s][1] for k, s in zip(_NAMED6, quant.SOURCE_FIELDS, strict=True)}
_PROV6 = ", ".join(f"""case when {k} then {{'fields': {_LISTS6[k]}, 'source': '{v}', 'url': '{'u' if k == 'hc' else ''}', 'as_of': '2024-01-01'}} end""" for k, v in _NAMED6.items())
query("snk7_quant_json", f"""{_WITH6} select asn, cast(to_json({{'asn': asn, 'quant': {{'asn': asn, {', '.join(f"'{c}': {c}" for c in _FIELDS6)}}}, 'sources': [x for x in [{_PROV6}] if x is not null]}}) as varchar) as value from m""")(
    lambda t: sinks.quant_json(six_sources(t)))


query("snk8_draft_lines", "select c_custkey + 200000 as asn, format('AS{}  {}  # src: {} ({})', c_custkey + 200000, c_name, 'https://a.example/', '2024-01-01') as value from @customer")(
    lambda t: sinks.draft_lines(t.sql("select c_custkey + 200000 as asn, c_name as name, 'https://a.example/' as url from @customer"), "name", "2024-01-01"))
query("snk8_sibling_lines", f"""select m.asn, 'AS' || m.asn || '  # sibling of ' || v.via || ' (holder ' || m.holder || ', ' || coalesce(r.cc, '??') || ', registered ' || coalesce(r.registered, '?') || ') - src: u' as value from {qn._MEM} m
    join (select holder, string_agg('AS' || asn, ',' order by asn) as via from {qn._MEM} where kind = 'siblings' and asn in (select asn from {qn._LISTED}) group by holder) v on v.holder = m.holder join {qn._OK} r on r.asn = m.asn
    where m.kind = 'siblings' and m.asn not in (select asn from {qn._LISTED})""")(
    lambda t: sinks.sibling_lines(registry.sibling_candidates(t.sql(f"select * from {qn._LISTED}"), qn.reg(t)), qn.reg(t), "u"))
query("snk9_segment_tsv", f"""select concat_ws(chr(9), class, {ip_text('range_start')}, {ip_text('range_end')}, size::varchar, coalesce(a_asn, 0)::varchar, coalesce(b_asn, 0)::varchar) as value from {qt.CLASSED} where class <> 'same'""")(
    lambda t: sinks.segment_lines(qt.classed(t)).select("value"))


@query("snk10_lookup_table", "select bucket, greatest(range_start, bucket * 65536) as range_start, least(range_end, bucket * 65536 + 65535) as range_end, asn, 4 as family from (select *, unnest(range(range_start >> 16, (range_end >> 16) + 1)) as bucket from @base)")
def _(t):
    path = fresh_folder(t, "lookup") + "/table"
    sinks.write_lookup(t.base, path)
    return sinks.read_lookup(t.spark, path)


@query("dq15_export_equal", "select count(*) as differences from @base where false")
def _(t):
    """Write the product rows as JSON lines, read them back, compare field by field."""
    wire = cut(project.to_wire(qr.intervals(t)))
    path = fresh_folder(t, "spool") + "/intervals"
    sinks.write_interval_json(wire, path)
    back = parse.interval_records(t.spark.read.text(path))
    same = back.filter("violation is null").select(F.col("ip_version").cast("int").alias("ip_version"), *wire.columns[1:])
    return sets.table_difference(wire, same).agg(F.count("*").alias("differences"))


# ---------------------------------------------------------------- streaming
@query("stm1_stream_lookup", f"select event_id, ip, verdict, rule, asn from {qr._LOOKUP}")
def _(t):
    schema = t.events.schema
    stream = t.spark.readStream.schema(schema).parquet(f"{t.folder}/events.parque[t]").select(
        "event_id", (16777216 + (F.col("event_id") * 7919) % 4000000000).alias("ip"))
    out = fresh_folder(t, "stream")
    v = stream_lookup.stream_verdicts(stream, cut(qr.segments(t)))
    q = v.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/ckpt").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return t.spark.read.parquet(f"{out}/rows")


def stored(t, table: DataFrame, space, payload: list[str]) -> index.StoredIndex:
    """An index of `table`, written to a fresh folder and opened again."""
    path = fresh_folder(t, "index")
    index.write_index(table, space, payload, path)
    return index.StoredIndex.open(t.spark, path, space)


LAYERS = ["asn", "flags", "vpn_range", "datacenter_range"]


@query("join1_stored_index", """select event_id, ip, case when b.range_end >= ip then b.range_start end as range_start, case when b.range_end >= ip then b.range_end end as range_end,
    case when b.range_end >= ip then b.asn end as asn from @ips i asof left join @base b on i.ip >= b.range_start""")
def _(t):
    return stored(t, t.base, V4, ["asn"]).lookup(t.ips.select("event_id", "ip"), how="left")


@query("join1_stored_index_v6", f"""select event_id, {hex128('range_start')} as start_hex, {hex128('range_end')} as end_hex, asn from (select event_id, {u128('hi', 'lo')} as ip from @ips6) i
    asof join {ranges6('base6', ', asn')} b on i.ip >= b.range_start where b.range_end >= i.ip""")
def _(t):
    points = t.ips6.select("event_id", v6(F.col("hi"), F.col("lo")).alias("ip"))
    return stored(t, t.six("base6"), V6, ["asn"]).lookup(points).select("event_id", V6.hex(F.col("range_start")).alias("start_hex"), V6.hex(F.col("range_end")).alias("end_hex"), "asn")


query("cls11_stored_lookup", f"select event_id, ip, verdict, rule, asn from {qr._LOOKUP}")(
    lambda t: classify.stored_verdicts(t.ips.select("event_id", "ip"), stored(t, qr.segments(t), V4, LAYERS)))


def streamed(t, points: DataFrame, ix: index.StoredIndex) -> DataFrame:
    """Verdicts of a stream of the events, drained into a table that is read back."""
    out = fresh_folder(t, "stream")
    q = classify.stored_verdicts(points, ix).writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/ckpt").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return t.spark.read.parquet(f"{out}/rows")


def event_stream(t) -> DataFrame:
    return t.spark.readStream.schema(t.events.schema).parquet(f"{t.folder}/events.parque[t]")


query("stm1_stored_index", f"select event_id, ip, verdict, rule, asn from {qr._LOOKUP}")(
    lambda t: streamed(t, event_stream(t).select("event_id", (16777216 + (F.col("event_id") * 7919) % 4000000000).alias("ip")), stored(t, qr.segments(t), V4, LAYERS)))


@query("stm1_stored_index_v6", f"""select event_id, {hex128('ip')} as ip_hex, 'unknown' as verdict, case when asn is null then 'unrouted' else 'no_category' end as rule, asn from (
    select event_id, ip, case when b.range_end >= ip then asn end as asn from (select event_id, {u128('hi', 'lo')} as ip from @ips6) i asof left join {ranges6('base6', ', asn')} b on i.ip >= b.range_start)""")
def _(t):
    base = t.six("base6").select("range_start", "range_end", "asn", F.lit(0).alias("flags"), F.lit(False).alias("vpn_range"), F.lit(False).alias("datacenter_range"))
    points = event_stream(t).select("event_id", v6(F.lit(HI6) + F.col("event_id") * 104729, F.col("event_id") * 31).alias("ip"))
    return streamed(t, points, stored(t, base, V6, LAYERS)).select("event_id", V6.hex(F.col("ip")).alias("ip_hex"), "verdict", "rule", "asn")


@query("stm2_resumable", "select doc_id as asn, count(*) as n from @documents group by 1")
def _(t):
    """Two runs over the same growing input: the second finds nothing left to do."""
    out = fresh_folder(t, "resume")
    src = t.spark.readStream.schema(t.documents.schema).parquet(f"{t.folder}/documents.parque[t]").select(F.col("doc_id").alias("asn"))
    for _ in range(2):
        q = src.writeStream.foreachBatch(resume.process_batch(lambda b: b.select("asn"), f"{out}/done")).option(
            "checkpointLocation", f"{out}/ckpt").trigger(availableNow=True).start()
        q.awaitTermination()
    return t.spark.read.parquet(f"{out}/done").groupBy("asn").agg(F.count("*").alias("n"))


@query("stm2_resumed_batches", "select doc_id as asn, count(distinct doc_id) as n from @documents group by 1")
def _(t):
    """The input comes in six files, each key in two of them, a file a batch, and the run is broken off and begun again: every key is done once."""
    source, out = fresh_folder(t, "packets"), fresh_folder(t, "resumed")
    keys = t.documents.select(F.col("doc_id").alias("asn"))
    for k in range(2):
        keys.repartition(3, F.xxhash64("asn", F.lit(k))).write.mode("append").parquet(source)
    stream = t.spark.readStream.schema(keys.schema).option("maxFilesPerTrigger", 1).parquet(source)
    for _ in range(2):
        q = stream.writeStream.foreachBatch(resume.process_batch(lambda b: b.select("asn"), f"{out}/done")).option(
            "checkpointLocation", f"{out}/ckpt").trigger(availableNow=True).start()
        q.awaitTermination()
    return t.spark.read.parquet(f"{out}/done").groupBy("asn").agg(F.count("*").alias("n"))


_SANEB = """(select greatest(range_start, coalesce(top, -1) + 1) as range_start, range_end, asn from (select *, max(range_end) over (order by range_start, range_end desc, asn rows between unbounded preceding and 1 preceding) as top from @base_raw)
    where top is null or range_end > top)"""


def build(t) -> DataFrame:
    return build_intervals(t.base_raw, t.vpn_raw, t.dc_raw, t.asn_meta, t.asn_lists, t.corrections, t.names)


# The same SQL with the sanitized raw table in place of the derived base.
_SEG = SEGMENTS.replace("@base", "sane").replace("(with b as", f"(with sane as {_SANEB}, b as", 1)
query("full_build", f"select core_verdict, count(*) as intervals, cast(sum(n) as bigint) as addresses from (select {qr.VERDICT} as core_verdict, range_end - range_start + 1 as n from {qr.INTERVALS.replace(SEGMENTS, _SEG)}) group by 1")(
    lambda t: build(t).groupBy("core_verdict").agg(F.count("*").alias("intervals"), F.sum(F.col("range_end") - F.col("range_start") + 1).alias("addresses")))

# ---------------------------------------------------------------- two builds, 128-bit covers and their proof
_TWO = f"(select count(*) as n from {qr.INTERVALS})"


@query("dq23_two_builds", f"select 'again' as build, n as rows_a, n as rows_b, true as same from {_TWO} union all select 'one_flag', n, n, false from {_TWO} union all select 'one_row_less', n, n - 1, false from {_TWO}")
def _(t):
    """The product built twice, the second time from reversed and redistributed inputs; then with one flag changed, and with one row gone."""
    first = cut(qr.intervals(t))
    mixed = ranges.merge_ranges(t.vpn_raw.repartition(5), V4), ranges.merge_ranges(t.dc_raw.orderBy(F.col("range_start").desc()), V4)
    second = cut(project.intervals(qr.stamped(t).repartition(7), *mixed, t.names))
    least = first.agg(F.min("range_start").alias("at"))
    changed = second.join(F.broadcast(least), F.col("range_start") == F.col("at"), "left").withColumn("vpn_range", F.col("vpn_range") != F.col("at").isNotNull()).drop("at")
    fewer = second.join(F.broadcast(least), F.col("range_start") == F.col("at"), "left_anti")
    rows = [digest.same_digest(first, other).select(F.lit(name).alias("build"), "rows_a", "rows_b", "same") for name, other in (("again", second), ("one_flag", changed), ("one_row_less", fewer))]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


_R6 = f"({merged('select * from ' + ranges6('vpn6'))})"
_COVER6 = f"""(with l as (select range_start, range_end, k::uhugeint as k, 1::uhugeint << k::uhugeint as blk from (select *, unnest(range(0, 96)) as k from {_R6})),
    b as (select *, (range_start + blk - 1) // blk as lo, (range_end + 1) // blk as hi from l),
    x as (select *, lo % 2 = 1 as odd_lo, hi % 2 = 1 as odd_hi from b where lo < hi)
    select range_start, range_end, lo * blk as net, cast(128 - k as integer) as len from x where odd_lo
    union all select range_start, range_end, (hi - 1) * blk, cast(128 - k as integer) from x where odd_hi and not (odd_lo and lo = hi - 1))"""
_HEX6 = f"{hex128('range_start')} as start_hex, {hex128('range_end')} as end_hex, {hex128('net')} as net_hex, len"


def cover6(t) -> DataFrame:
    return addr.cidr_cover_v6(ranges.merge_ranges(t.six("vpn6"), V6))


query("addr12_cidr_cover_v6", f"select {_HEX6} from {_COVER6}")(
    lambda t: cover6(t).select(V6.hex(F.col("range_start")).alias("start_hex"), V6.hex(F.col("range_end")).alias("end_hex"), V6.hex(F.col("net")).alias("net_hex"), "len"))



def tiled6(t) -> tuple[DataFrame, DataFrame]:
    """(pieces, records): the merged ranges, computed once, and their cover."""
    records = cut(ranges.merge_ranges(t.six("vpn6"), V6))
    return addr.cidr_cover_v6(records), records


_SIZE6 = "cast((range_end - range_start + 1)::varchar as decimal(38,0))"
_BLK6 = "cast((1::uhugeint << (128 - len)::uhugeint)::varchar as decimal(38,0))"
query("dq18_exact_tiling_v6", f"""select (select count(*) from {_R6}) as records, count(*) as pieces, cast(sum({_BLK6}) as decimal(38,0)) as covered, cast(0 as bigint) as uncovered,
    cast(0 as bigint) as outside, cast(0 as bigint) as overlaps, cast(0 as bigint) as orphans from {_COVER6}""")(
    lambda t: gates.exact_tiling(*tiled6(t), V6))
# Faults: no /117 pieces, a copy of every /121 in half its size, every record that begins at an even hextet gone.
_BAD6 = f"""(select * from {_COVER6} where len <> 117 union all select range_start, range_end, net, 122 from {_COVER6} where len = 121)"""
_KEPT6 = f"(select * from {_R6} where (range_start >> 64::uhugeint) % 2 = 1)"
query("dq18_broken_tiling_v6", f"""with p as {_BAD6}, per as (select range_start, range_end, count(*) as pieces, sum({_BLK6}) as covered from p group by 1, 2)
    select (select count(*) from {_KEPT6}) as records, cast(sum(pieces) as bigint) as pieces, cast(sum(covered) as decimal(38,0)) as covered,
    (select count(*) from {_KEPT6} r left join per using (range_start, range_end) where covered is null or covered <> {_SIZE6}) as uncovered, cast(0 as bigint) as outside,
    (select count(*) from {_COVER6} where len = 121) as overlaps,
    cast(sum(case when (range_start >> 64::uhugeint) % 2 = 1 then 0 else pieces end) as bigint) as orphans from per""")(
    lambda t: _broken(*tiled6(t)))


def _broken(pieces: DataFrame, records: DataFrame) -> DataFrame:
    n = F.col("len")
    lens = F.when(n == 117, F.array().cast("array<int>")).when(n == 121, F.array(n, F.lit(122))).otherwise(F.array(n))
    return gates.exact_tiling(pieces.withColumn("len", F.explode(lens)), records.filter((F.col("range_start")["hi"] % 2) != 0), V6)


# ---------------------------------------------------------------- the whole product over both families, gaps filled
_WANTED = """(select distinct asn from @asn_lists where list in ('bad_asn', 'vpn_provider', 'mobile_carrier', 'enterprise_gateway', 'cdn', 'hosting_extra') and list <> 'bad_asn'
    and asn not in (select asn from @base_raw) and asn not in (select asn from @base6))"""


def _filled(base: str, candidates: str) -> str:
    """SQL: `base` and what it leaves free of the candidates of missing ASNs; candidates are disjoint."""
    return f"""(with c as (select range_start as p from {base} union select range_end + 1 from {base} union select range_start from {candidates} union select range_end + 1 from {candidates}),
        s as (select p as range_start, lead(p) over (order by p) - 1 as range_end from c)
        select s.range_start, s.range_end, a.asn from s asof join {candidates} a on s.range_start >= a.range_start asof left join {base} b on s.range_start >= b.range_start
        where s.range_end is not null and a.range_end >= s.range_start and not coalesce(b.range_end >= s.range_start, false) union all select range_start, range_end, asn from {base})"""


_C4 = f"(select * from {qr._CAND} where asn in {_WANTED})"
_C6 = f"(select * from {ranges6('cand6', ', asn')} where asn in {_WANTED})"
_FOUR = SEGMENTS.replace("@base", "filled").replace("(with b as", f"(with sane as {_SANEB}, filled as {_filled('sane', _C4)}, b as", 1)
_SIX = f"""(with base as {ranges6('base6', ', asn')}, vpn as {_R6}, filled as {_filled('base', _C6)},
    b as (select range_start as p from filled union select range_end + 1 from filled union select range_start from vpn union select range_end + 1 from vpn),
    s as (select p as range_start, lead(p) over (order by p) - 1 as range_end from b)
    select * from (select s.range_start, s.range_end, case when f.range_end >= s.range_start then f.asn end as asn, case when f.range_end >= s.range_start then coalesce(g.flags, 0) else 0 end as flags,
    coalesce(v.range_end >= s.range_start, false) as vpn_range, false as datacenter_range from s asof left join filled f on s.range_start >= f.range_start
    left join {FLAGS} g on g.asn = f.asn asof left join vpn v on s.range_start >= v.range_start) where range_end is not null and (asn is not null or vpn_range))"""


def _tally(version: int, segments: str) -> str:
    return f"""select {version} as ip_version, core_verdict, count(*) as intervals, cast(sum(n) as varchar) as addresses from (
        select {qr.VERDICT} as core_verdict, cast((range_end - range_start + 1)::varchar as decimal(38,0)) as n from {qr.INTERVALS.replace(SEGMENTS, segments)}) group by 2"""


@query("full_build_both", f"{_tally(4, _FOUR)} union all {_tally(6, _SIX)}")
def _(t):
    """Both families from raw layers: an ASN that originates something in one family is missing in neither; what is missing gets its candidate ranges."""
    shared = (t.asn_meta, t.asn_lists, t.corrections, t.names)
    base6, vpn6 = t.six("base6"), t.six("vpn6")
    four = build_intervals(t.base_raw, t.vpn_raw, t.dc_raw, *shared, candidates=t.sql(f"select * from {qr._CAND}"), elsewhere=(base6,))
    six = build_intervals(base6, vpn6, vpn6.limit(0), *shared, candidates=t.six("cand6"), space=V6, elsewhere=(t.base_raw,))

    def tally(rows: DataFrame, space) -> DataFrame:
        size = space.size(F.col("range_start"), F.col("range_end")).cast("decimal(38,0)")
        return rows.groupBy("ip_version", "core_verdict").agg(F.count("*").alias("intervals"), F.sum(size).cast("decimal(38,0)").cast("string").alias("addresses"))

    return tally(four, V4).unionByName(tally(six, V6))


# ---------------------------------------------------------------- gates that find what is broken
@query("dq12_refind_broken", "select count(*) * 3 as mismatches from @base where range_end >= range_start + 512 and ((range_start - 16777216) // 1024) % 11 = 3")
def _(t):
    """Rows looked up in a table in which every eleventh one begins an address late: its start is in a gap, its middle and end come back to another start."""
    wide = t.base.filter("range_end >= range_start + 512")
    nth = F.floor((F.col("range_start") - 16777216) / 1024)
    late = wide.withColumn("range_start", F.when(nth % 11 == 3, F.col("range_start") + 1).otherwise(F.col("range_start")))
    return gates.refind_mismatches(wide, late).agg(F.count("*").alias("mismatches"))


@query("dq15_export_changed", "select 'only_a' as side, count(*) as n from @base where asn % 13 = 5 union all select 'only_b', count(*) from @base where asn % 13 = 5")
def _(t):
    """A written and read table whose ASNs changed in some rows: each is found on both sides."""
    path = fresh_folder(t, "export") + "/base"
    t.base.withColumn("asn", F.when(F.col("asn") % 13 == 5, F.col("asn") + 1000000).otherwise(F.col("asn"))).write.parquet(path)
    return sets.table_difference(t.base, t.spark.read.parquet(path)).groupBy("side").agg(F.sum("n").alias("n"))


@query("dq14_broken_rows", """select unnest(['inverted', 'overlap', 'not_coalesced']) as violation, unnest([(select count(*) from @base where asn % 17 = 2)::bigint,
    (select count(*) from @base where asn % 17 = 4)::bigint, 0::bigint]) as n""")
def _(t):
    """Some rows turned round, some copied: the first are inverted, the copies overlap."""
    b = t.base.withColumn("range_end", F.when(F.col("asn") % 17 == 2, F.col("range_start") - 1).otherwise(F.least(F.col("range_end"), F.col("range_start") + 500)))
    return gates.interval_violations(b.unionByName(b.filter("asn % 17 = 4")), ["asn"])


@query("agg14_build_stats", f"""select metric, cast(value as varchar) as value from (
    select 'base_ipv4' as metric, count(*)::hugeint as value from @base union all select 'base_ipv4.addresses', sum(range_end - range_start + 1) from @base
    union all select 'vpn_ipv4', count(*) from {qr.VPN} union all select 'vpn_ipv4.addresses', sum(range_end - range_start + 1) from {qr.VPN}
    union all select 'dc_ipv4', count(*) from {qr.DC} union all select 'dc_ipv4.addresses', sum(range_end - range_start + 1) from {qr.DC}
    union all select 'base_ipv6', count(*) from @base6 union all select 'base_ipv6.addresses', sum((range_end - range_start + 1)::varchar::decimal(38,0))::varchar::hugeint from {ranges6('base6')}
    union all select 'records_ipv4', count(*) from {qr.INTERVALS} union all select 'records_ipv4.routed', count(asn) from {qr.INTERVALS}
    union all select 'records_ipv4.vpn', count(*) filter (vpn_range) from {qr.INTERVALS} union all select 'org_names', count(*) from @names
    union all select 'org_names.named', count(name) from @names union all select 'countries', count(*) from @countries union all select 'countries.known', count(cc) from @countries)""")
def _(t):
    """Layers, product, names and countries of a build, counted by the writes themselves."""
    m, path = metrics.BuildMetrics(t.spark), fresh_folder(t, "build")
    size = lambda space: F.sum(space.size(F.col("range_start"), F.col("range_end")))
    for name, df, space in (("base_ipv4", t.base, V4), ("vpn_ipv4", qr.vpn(t), V4), ("dc_ipv4", qr.dc(t), V4), ("base_ipv6", t.six("base6"), V6)):
        m.write(name, df, path, addresses=size(space))
    m.write("records_ipv4", qr.intervals(t), path, routed=F.count("asn"), vpn=F.count_if("vpn_range"))
    m.write("org_names", t.names, path, named=F.count("name"))
    m.write("countries", t.countries, path, known=F.count("cc"))
    return m.rows()
