"""Scalar functions: addresses, evidence word, text, dates, arrays."""

from __future__ import annotations

from pyspark.sql import functions as F

from netorigin.functions import addr, flags, text as tx, vocab
from netorigin.functions.space import V4, V6, v6
from netorigin.operators import entities
from netorigin.operators.ranges import merge_ranges
from netorigin.plans.catalog import query
from netorigin.plans.tables import CATS, ROLES, code, hex128, ip_text, merged, pow2, u128

RES = ", ".join(f"'{h}'" for h in vocab.RESTRICTED_HOSTS)

# ---------------------------------------------------------------- addresses
_CIDR = f"select event_id, ip, event_id % 35 as len, concat({ip_text('ip')}, case when event_id % 7 = 0 then '' else concat('/', cast(event_id % 35 as string)) end) as text from @any_ips"


@query("addr1_cidr_to_range", f"""select event_id, case when ok then ip - ip % {pow2('32 - l')} end as range_start,
    case when ok then ip - ip % {pow2('32 - l')} + {pow2('32 - l')} - 1 end as range_end from (select *, l <= 32 as ok from (
    select event_id, ip, case when event_id % 7 = 0 then 32 else event_id % 35 end as l from @any_ips))""".replace("power(2, 32 - l)", "power(2, 32 - least(l, 32))"))
def _(t):
    return t.sql(_CIDR).select("event_id", addr.cidr_to_range(F.col("text")).alias("r")).select(
        "event_id", F.col("r.start4").alias("range_start"), F.col("r.end4").alias("range_end"))


_V4TEXT = f"select event_id, ip, concat({ip_text('ip')}, case event_id % 5 when 1 then '.1' when 2 then 'x' else '' end) as text from @any_ips"
query("addr2_v4_to_int", "select event_id, case when event_id % 5 in (1, 2) then null else ip end as n from @any_ips")(
    lambda t: t.sql(_V4TEXT).select("event_id", addr.v4_to_int(F.col("text")).alias("n")))
query("addr3_int_to_v4", f"select event_id, {ip_text('ip')} as text from @any_ips")(
    lambda t: t.any_ips.select("event_id", addr.int_to_v4(F.col("ip")).alias("text")))
_H16 = lambda x: f"lpad(lower(hex({x})), 4, '0')"
_T6 = f"""select o_orderkey as id, case when o_orderkey % 3 = 0 then concat('2400:', lower(hex(o_orderkey % 65536)), '::', lower(hex(o_custkey % 65536)))
    when o_orderkey % 3 = 1 then concat('::FFFF:', {ip_text('o_orderkey * 7919 % 4294967296')}) else concat('1:2:3:', lower(hex(o_custkey % 65536)), ':5:6:7:8:9') end as text from @orders"""
query("addr4_parse_v6", f"""select o_orderkey as id, case when o_orderkey % 3 = 0 then concat('2400', {_H16('o_orderkey % 65536')}, repeat('0', 20), {_H16('o_custkey % 65536')})
    when o_orderkey % 3 = 1 then concat(repeat('0', 20), 'ffff', lpad(lower(hex(o_orderkey * 7919 % 4294967296)), 8, '0')) end as hex,
    case when o_orderkey % 3 = 1 then o_orderkey * 7919 % 4294967296 end as mapped from @orders""")(
    lambda t: t.sql(_T6).withColumn("a", addr.v6_to_pair(F.col("text"))).select(
        "id", V6.hex(F.col("a")).alias("hex"), addr.mapped_v4(F.col("a")).alias("mapped")))
query("addr5_v6_text", """select o_orderkey as id, concat('2400', case when o_orderkey % 50 = 0 then '' else concat(':', lower(hex(o_orderkey % 50))) end,
    '::', case when o_custkey % 3 = 0 then '' else lower(hex(o_custkey % 3)) end) as text from @orders""")(
    lambda t: t.sql("select o_orderkey as id, 2594073385365405696 + (o_orderkey % 50) * 4294967296 as hi, o_custkey % 3 as lo from @orders").select(
        "id", addr.int_to_v6(F.col("hi"), F.col("lo")).alias("text")))
query("addr6_fixed_hex", "select event_id, lpad(lower(hex(ip)), 8, '0') as h from @any_ips")(
    lambda t: t.any_ips.select("event_id", addr.fixed_hex(F.col("ip"), V4).alias("h")))
query("addr7_parse_hex", "select event_id, case event_id % 4 when 1 then null when 2 then null else ip end as n from @any_ips")(
    lambda t: t.sql("select event_id, cast(case event_id % 4 when 2 then 6 else 4 end as int) as v, case event_id % 4 when 1 then concat('0', lpad(lower(hex(ip)), 8, '0')) "
                    "else lpad(lower(hex(ip)), 8, '0') end as h from @any_ips").select(
        "event_id", addr.parse_fixed_hex(F.col("h"), F.col("v"))["v4"].alias("n")))
query("addr8_prefix_range", f"select distinct net, len, net + {pow2('32 - len')} - 1 as range_end from @rib")(
    lambda t: t.rib.select("net", "len").distinct().withColumn("range_end", V4.last(F.col("net"), F.col("len"))))
query("addr9_mask", f"select event_id, ip - ip % {pow2('32 - event_id % 33')} as net from @any_ips")(
    lambda t: t.any_ips.select("event_id", V4.mask(F.col("ip"), F.col("event_id") % 33).alias("net")))
query("addr9_mask_v6", f"""select event_id, {hex128('x - x % (1::uhugeint << (128 - (16 + event_id % 112))::uhugeint)')} as net from (
    select event_id, {u128('hi', 'lo')} as x from @ips6)""")(
    lambda t: t.ips6.select("event_id", V6.hex(V6.mask(v6(F.col("hi"), F.col("lo")), (16 + F.col("event_id") % 112).cast("int"))).alias("net")))
query("addr10_sizes", "select asn, sum(range_end - range_start + 1)::bigint as addresses from @base group by asn")(
    lambda t: t.base.groupBy("asn").agg(F.sum(V4.size(F.col("range_start"), F.col("range_end"))).alias("addresses")))
query("addr11_overlaps", """select l_linenumber, count(*) filter (l_orderkey <= l_partkey + 500 and l_partkey <= l_orderkey + 300) as n from @lineitem group by 1""")(
    lambda t: t.lineitem.groupBy("l_linenumber").agg(F.count_if(addr.overlaps(
        F.col("l_orderkey"), F.col("l_orderkey") + 300, F.col("l_partkey"), F.col("l_partkey") + 500)).alias("n")))
query("addr12_cidr_pieces", f"""with r as ({merged('select * from @vpn_raw')}), l as (select *, unnest(range(0, 33)) as k from r),
    b as (select range_start, range_end, k, (1::bigint << k) as blk from l), c as (select *, (range_start + blk - 1) // blk as lo, (range_end + 1) // blk as hi from b)
    select range_start, range_end, lo * blk as net, cast(32 - k as integer) as len from c where lo < hi and lo % 2 = 1
    union all select range_start, range_end, (hi - 1) * blk as net, cast(32 - k as integer) as len from c where lo < hi and hi % 2 = 1 and not (lo % 2 = 1 and lo = hi - 1)""")(
    lambda t: addr.cidr_pieces(_vpn(t)))


def _vpn(t):
    return merge_ranges(t.vpn_raw, V4)


_MART = "(" + " or ".join("(len >= {} and net between {} and {})".format(l, *addr.v4_block(n, l)) for n, l in vocab.V4_MARTIANS) + ")"
query("addr13_inside_block", f"select distinct net, len, {_MART} as martian from @rib")(
    lambda t: t.rib.select("net", "len").distinct().withColumn("martian", addr.inside_any(F.col("net"), F.col("len"), vocab.V4_MARTIANS, V4)))
_SP = "case " + " ".join("when ip between {} and {} then '{}'".format(*addr.v4_block(n, l), f"{v}:{r}") for n, l, v, r in vocab.V4_SPECIALS) + " end"
query("addr14_special", f"select event_id, {_SP} as special from @any_ips")(
    lambda t: t.any_ips.select("event_id", addr.special_verdict(F.col("ip"), V4).alias("s")).select(
        "event_id", F.when(F.col("s").isNotNull(), F.concat_ws(":", "s.verdict", "s.rule")).alias("special")))
query("addr15_not_contactable", f"select event_id, ({_SP}) is not null as blocked from @any_ips")(
    lambda t: t.sql(f"select event_id, case when event_id % 2 = 0 then {ip_text('ip')} else concat('::ffff:', {ip_text('ip')}) end as text from @any_ips").select(
        "event_id", addr.not_contactable(F.col("text")).alias("blocked")))
query("addr16_neighbours", "select range_start, range_start + 1 as succ, range_end - 1 as pred, range_start + (range_end - range_start) // 2 as mid from @base")(
    lambda t: t.base.select("range_start", V4.succ(F.col("range_start")).alias("succ"), V4.pred(F.col("range_end")).alias("pred"),
                            V4.midpoint(F.col("range_start"), F.col("range_end")).alias("mid")))
query("addr16_neighbours_v6", f"""select {hex128('range_start')} as start_hex, {hex128('range_end + 1')} as succ, {hex128('range_start - 1')} as pred from (
    select {u128('s_hi', 's_lo')} as range_start, {u128('e_hi', 'e_lo')} as range_end from @base6)""")(
    lambda t: t.six("base6").select(V6.hex(F.col("range_start")).alias("start_hex"), V6.hex(V6.succ(F.col("range_end"))).alias("succ"),
                                    V6.hex(V6.pred(F.col("range_start"))).alias("pred")))
query("addr17_length_bucket", """select range_start, concat('~/', cast(32 - cast(ceil(log2(range_end - range_start + 1)) as integer) as string)) as bucket from @base""")(
    lambda t: t.base.select("range_start", addr.length_bucket(F.col("range_start"), F.col("range_end"), V4).alias("bucket")))

# ---------------------------------------------------------------- evidence word
query("bit1_encode", f"select asn, cast({code('category', CATS)} + 16 * {code('network_role', ROLES)} + case when asn % 2 = 0 then 256 else 0 end + case when asn % 3 = 0 then 4096 else 0 end as integer) as flags from @asn_meta")(
    lambda t: t.asn_meta.select("asn", flags.encode(F.col("category"), F.col("network_role"), {
        "bad_asn": F.col("asn") % 2 == 0, "cdn": F.col("asn") % 3 == 0}).alias("flags")))
_FW = "select o_orderkey as id, cast(o_orderkey * 37 % 65536 as int) as flags from @orders"
query("bit2_decode", f"""select id, flags & 256 <> 0 as bad_asn, flags & 512 <> 0 as vpn_provider, flags & 8192 <> 0 as hosting_extra,
    case flags & 15 {' '.join(f"when {i + 1} then '{c}'" for i, c in enumerate(CATS))} end as category,
    case (flags >> 4) & 15 {' '.join(f"when {i + 1} then '{c}'" for i, c in enumerate(ROLES))} end as network_role,
    case when flags & 49152 <> 0 then 'reserved_bits' when flags & 15 > 5 then 'reserved_category' when (flags >> 4) & 15 > 6 then 'reserved_role' end as violation
    from ({_FW})""")(
    lambda t: t.sql(_FW).withColumns(flags.decode(F.col("flags"))).withColumn("violation", flags.violation(F.col("flags"))).select(
        "id", "bad_asn", "vpn_provider", "hosting_extra", "category", "network_role", "violation"))
query("bit3_flag_names", f"""select id, concat_ws('|', {', '.join(f"case when flags & {1 << vocab.SIGNAL_BITS[s]} <> 0 then '{s}' end" for s in vocab.ASN_SIGNALS)}) as names from ({_FW})""")(
    lambda t: t.sql(_FW).select("id", flags.flag_names(F.col("flags")).alias("names")))

# ---------------------------------------------------------------- text
query("str1_parse_asn", "select c_custkey as id, case when c_nationkey % 6 in (3, 4) or c_custkey = 0 then null else c_custkey end as asn from @customer")(
    lambda t: t.sql("""select c_custkey as id, case c_nationkey % 6 when 0 then concat('AS', cast(c_custkey as string)) when 1 then concat(' ', cast(c_custkey as string), ' ')
        when 2 then concat('as', cast(c_custkey as string)) when 3 then concat(cast(c_custkey as string), '-9') when 4 then '99999999999999999999999999999999999999999999'
        else cast(c_custkey as string) end as text from @customer""").select("id", tx.parse_asn(F.col("text")).alias("asn")))
query("str2_clean_label", r"""select doc_id, md5(nullif(trim(regexp_replace(regexp_replace(nfc_normalize(text), '\p{Cc}', ' ', 'g'), ' {2,}', ' ', 'g'), ' '), '')) as label from @documents""")(
    lambda t: t.documents.select("doc_id", F.md5(tx.clean_label(F.col("text"))).alias("label")))
_HOST = r"lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1))"
query("str3_restricted_host", f"select id, len(list_filter([{RES}], lambda h: host = h or ends_with(host, '.' || h))) > 0 as restricted from (select id, {_HOST} as host from @urls)")(
    lambda t: t.urls.select("id", tx.restricted_url(F.col("url")).alias("restricted")))
query("str4_registrable_domain", rf"""select id, array_to_string(l[greatest(len(l) - n, 0) + 1:], '.') as domain from (
    select id, l, case when len(l) >= 3 and l[-2] in ({', '.join(f"'{g}'" for g in vocab.GENERIC_SECOND_LEVEL)}) then 3 else 2 end as n from (
    select id, string_split(regexp_replace({_HOST}, '^www\.', ''), '.') as l from @urls))""")(
    lambda t: t.urls.select("id", tx.registrable_domain(F.col("url")).alias("domain")))
query("str5_clean_name", "select c_custkey as id, case when c_nationkey % 7 = 6 then null else c_name end as name from @customer")(
    lambda t: t.sql("""select c_custkey as id, case c_nationkey % 7 when 0 then concat(c_name, ' — AS', cast(c_custkey as string)) when 1 then concat(c_name, ' / AS12')
        when 2 then concat('AS7, ', c_name) when 3 then concat(c_name, '  AS9 (AS5)') when 4 then concat(c_name, ' (AS77)') when 5 then concat(c_name, ' ( )')
        else '(AS1)' end as text from @customer""").select("id", tx.clean_name(F.col("text")).alias("name")))
query("str6_truncate_utf8", """select doc_id, list_max(list_transform(range(0, 97), lambda n: case when strlen(substring(text, 1, n)) <= 96 then n else 0 end)) as chars,
    md5(substring(text, 1, list_max(list_transform(range(0, 97), lambda n: case when strlen(substring(text, 1, n)) <= 96 then n else 0 end)))) as h
    from @documents where strlen(text) > 96 union all select doc_id, length(text) as chars, md5(text) as h from @documents where strlen(text) <= 96""")(
    lambda t: t.documents.select("doc_id", tx.truncate_utf8(F.col("text")).alias("x")).select("doc_id", F.length("x").cast("bigint").alias("chars"), F.md5("x").alias("h")))


def _claims(t):
    return t.sql("""select c_custkey as id, case c_nationkey % 4 when 0 then 'DE' when 1 then 'US' when 2 then 'BR' else 'QQ' end as cc,
        case when c_nationkey % 2 = 0 then 'Bonn, NRW' else 'X' end as city, concat(c_name, case c_custkey % 6 when 0 then ' is a German carrier' when 1 then ', Germanys best'
        when 2 then ' of Bonn.' when 3 then ' in Bonner Str' when 4 then ' US-based host' else ' serves São Paulo, Brazil' end) as claim from @customer""")


query("str7_claim_country", """select c_custkey as id, case c_nationkey % 4 when 0 then c_custkey % 6 in (0, 2) when 1 then c_custkey % 6 = 4
    when 2 then c_custkey % 6 in (5, 2) else false end as hit from @customer""")(
    lambda t: _claims(t).select("id", entities.claim_names_country(F.col("claim"), F.col("cc"), F.col("city")).alias("hit")))
_SQ = lambda e: f"nullif(trim(regexp_replace({e}, '\\s+', ' ', 'g')), '')"
query("str8_page_text", "select page_id, " + _SQ(r"regexp_extract(html, '(?is)<title[^>]*>\s*(.{1,300}?)\s*</title>', 1)") + " as title, "
      + _SQ(r"""coalesce(nullif(regexp_extract(html, '(?is)<meta[^>]+name=["'']description["''][^>]+content=["''](.{1,300}?)["'']', 1), ''),
      nullif(regexp_extract(html, '(?is)<meta[^>]+content=["''](.{1,300}?)["''][^>]+name=["'']description["'']', 1), ''))""") + " as description from @pages")(
    lambda t: t.pages.select("page_id", tx.page_title(F.col("html")).alias("title"), tx.page_description(F.col("html")).alias("description")))


@query("str9_extract_json", "select event_id, case when event_id % 4 = 3 then null else props end as j from @events")
def _(t):
    fence = "concat(repeat(chr(96), 3), 'json', chr(10), props, chr(10), repeat(chr(96), 3))"
    return t.sql(f"select event_id, case event_id % 4 when 0 then props when 1 then concat('Sure: ', {fence}, ' done') when 2 then concat('It is ', props, ' ok') "
                 "else concat('none ', event_type) end as text from @events").select("event_id", tx.extract_json(F.col("text")).alias("j"))


_SWEEPTEXT = "select doc_id, concat(text, case doc_id % 9 when 0 then ' Mobile operator' when 1 then ' CDN77 edge' when 2 then ' my VPN.' when 3 then ' zscaler inc' else '' end) as text from @documents"
query("str10_sweeps", "select doc_id, " + ", ".join(f"regexp_matches(text, '{p}') as {s}" for s, p in vocab.SWEEPS.items()) + f" from ({_SWEEPTEXT})")(
    lambda t: t.sql(_SWEEPTEXT).select("doc_id", *[tx.matches_sweep(F.col("text"), s).alias(s) for s in vocab.SWEEPS]))

# ---------------------------------------------------------------- dates
_DATE8 = """select o_orderkey as id, cast(o_orderdate as date) as d, case o_orderkey % 5 when 0 then '00000000' when 1 then '19700101' when 2 then '2024-1'
    else cast(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) as string) end as text from @orders"""
query("dt1_registry_date", f"select id, case when id % 5 in (0, 1, 2) then null else cast(d as string) end as registered from ({_DATE8})")(
    lambda t: t.sql(_DATE8).select("id", tx.registry_date(F.col("text")).alias("registered")))
query("dt2_complete_slot", """select event_id, strftime(date_trunc('hour', ts - interval 3 hour) - interval 1 hour * (hour(ts - interval 3 hour) % 2), '%Y%m%d.%H%M') as slot from @events""")(
    lambda t: t.events.select("event_id", tx.complete_slot(F.col("ts")).alias("slot")))
query("dt3_sunday_tags", """select d, array_to_string(list_transform(range(0, 8), lambda i: strftime(d - cast(dayofweek(d) + 7 * i as integer), 'v%Y.%m.%d')), ',') as tags
    from (select distinct cast(o_orderdate as date) as d from @orders)""")(
    lambda t: t.orders.select(F.to_date("o_orderdate").alias("d")).distinct().select("d", F.array_join(tx.sunday_tags(F.col("d")), ",").alias("tags")))
_BUILD = "select event_id, ts, case event_id % 3 when 0 then 'not a time' else concat(cast(cast(ts as date) as string), 'T00:00:00Z') end as build_id from @events"
query("dt4_age", """select event_id, case event_id % 3 when 0 then null else round((epoch(date_trunc('second', ts)) - epoch(date_trunc('day', ts))) / 3600.0, 4) end as hours from @events""")(
    lambda t: t.sql(_BUILD).select("event_id", F.round(tx.age_hours(F.col("build_id"), F.col("ts")), 4).alias("hours")))

# ---------------------------------------------------------------- arrays and JSON
query("arr1_country", "select c_custkey as id, case c_nationkey % 5 when 3 then 'C7' when 4 then 'DE' else null end as cc from @customer")(
    lambda t: t.sql("select c_custkey as id, case c_nationkey % 5 when 0 then '' when 1 then '*' when 2 then ' ZZ ' when 3 then 'C7' else 'DE ' end as text from @customer").select(
        "id", tx.registry_country(F.col("text")).alias("cc")))
query("arr2_registry", """select c_custkey as id, case c_nationkey % 6 when 0 then 'RIPE' when 1 then 'ARIN' when 2 then 'APNIC' when 3 then 'LACNIC' when 4 then 'RIPE' else null end as rir from @customer""")(
    lambda t: t.sql("select c_custkey as id, case c_nationkey % 6 when 0 then 'ripencc' when 1 then 'ARIN' when 2 then 'JPNIC' when 3 then 'lacnic' when 4 then 'Ripe' else 'nobody' end as tok from @customer").select(
        "id", tx.canonical_registry(F.col("tok")).alias("rir")))
query("arr3_bogon", "select o_orderkey as id, a <= 0 or a = 23456 or a between 64496 and 131071 or a >= 4200000000 as bogon from (select o_orderkey, o_orderkey * 286331 % 4294967296 as a from @orders)")(
    lambda t: t.sql("select o_orderkey as id, o_orderkey * 286331 % 4294967296 as a from @orders").select("id", tx.bogon_asn(F.col("a")).alias("bogon")))
_REFS = """select o_orderkey as id, case o_orderkey % 6 when 0 then '' when 1 then 'r1|https://www.ripe.net/x|' when 2 then 'r1|https://www.ripe.net/x| r2|https://op.example/|'
    when 3 then 'r1|https://op.example/| r1|https://bgp.tools/as1|' when 4 then 'r1||http://www.wikidata.org/entity/Q726801' else 'r1||' end as refs from @orders"""
query("arr4_admissible", "select o_orderkey as id, o_orderkey % 6 in (0, 2, 5) as ok from @orders")(
    lambda t: t.sql(_REFS).select("id", tx.admissible(F.col("refs")).alias("ok")))
query("arr5_canonical_json", """select c_custkey as id, concat('{"a":"', c_custkey, '","b":{"x":"', c_nationkey, '","y":"', c_mktsegment, '"},"c":"', c_name, '"}') as j from @customer""")(
    lambda t: t.customer.select(F.col("c_custkey").alias("id"), tx.canonical_json({
        "c": F.col("c_name"), "b": {"y": F.col("c_mktsegment"), "x": F.col("c_nationkey")}, "a": F.col("c_custkey")}).alias("j")))


@query("sql_functions", f"select event_id, ip as n, {ip_text('ip')} as text, {_SP} as special, ip - ip % 65536 as s, ip - ip % 65536 + 65535 as e from @any_ips")
def _(t):
    addr.register_sql(t.spark)
    return t.sql(f"""select event_id, ip_to_long(x) as n, long_to_ip(ip) as text, special_verdict(ip) as special, cidr_start(concat(x, '/16')) as s,
        cidr_end(concat(x, '/16')) as e from (select *, {ip_text('ip')} as x from @any_ips)""")
