"""Input tables of the registered queries.

Routing-shaped tables are derived from the given tables by plain SQL that Spark
and DuckDB read alike.  `@name` refers to a given or a derived table.  Every
derived table reads its source whole: what a query should miss is a null or lies
elsewhere.  `%` only maps ids into address space.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netorigin.functions.space import v6

GIVEN = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
         "pages", "benchmark", "labels", "conversations"]


def ip_text(n: str) -> str:
    octet = lambda d: f"cast(cast(floor(({n}) / {d}) as bigint) % 256 as string)"
    return f"concat({octet(16777216)}, '.', {octet(65536)}, '.', {octet(256)}, '.', {octet(1)})"


def pow2(n: str) -> str:
    return f"cast(power(2, {n}) as bigint)"


HI6 = 2594073385365405696  # 2400::/16, high half

DERIVED = {
    # One row per 1024-address block: disjoint at any scale, many blocks touch.
    "base": """select 16777216 + k * 1024 as range_start, max(16777216 + k * 1024 + w) as range_end, min(asn) as asn
        from (select o_orderkey % 4177920 as k, case when o_orderkey % 3 = 0 then 1023 else o_custkey % 1024 end as w,
        200000 + o_custkey as asn from @orders) group by k""",
    # A second routing table: some blocks carry another origin, some lie elsewhere.
    "base_b": """select 16777216 + k * 1024 as range_start, max(16777216 + k * 1024 + w) as range_end, min(asn) as asn
        from (select (l_orderkey + case when l_returnflag = 'N' then 2088960 else 0 end) % 4177920 as k, l_partkey % 1024 as w,
        case when l_linenumber % 2 = 0 then 200000 + l_suppkey else 200000 + o_custkey end as asn
        from @lineitem join @orders on l_orderkey = o_orderkey) group by k""",
    "base_raw": """select 16777216 + (o_orderkey * 1024 + o_custkey % 700) % 4261412864 as range_start,
        16777216 + (o_orderkey * 1024 + o_custkey % 700) % 4261412864 + o_custkey % 1500 as range_end,
        200000 + o_custkey as asn from @orders""",
    "vpn_raw": """select 16777216 + (p_partkey * 5003) % 4261412864 as range_start,
        16777216 + (p_partkey * 5003) % 4261412864 + p_size * 200 as range_end from @part""",
    "dc_raw": """select 16777216 + (c_custkey * 9001) % 4261412864 as range_start,
        16777216 + (c_custkey * 9001) % 4261412864 + (c_nationkey + 1) * 640 as range_end from @customer""",
    "asn_meta": """select 200000 + c_custkey as asn, case c_mktsegment when 'HOUSEHOLD' then 'isp' when 'BUILDING' then 'hosting'
        when 'FURNITURE' then 'business' when 'MACHINERY' then 'education_research' else
        case when c_acctbal < 0 then 'government_admin' else null end end as category,
        case c_nationkey % 7 when 1 then 'tier1_transit' when 2 then 'major_transit' when 3 then 'midsize_transit'
        when 4 then 'access_provider' when 5 then 'content_network' when 6 then 'stub' else null end as network_role,
        c_name as description, case when c_nationkey % 5 = 0 then null else concat('C', cast(c_nationkey as string)) end as country
        from @customer""",
    "asn_lists": """select case s_nationkey % 7 when 0 then 'bad_asn' when 1 then 'vpn_provider' when 2 then 'mobile_carrier'
        when 3 then 'enterprise_gateway' when 4 then 'cdn' when 5 then 'hosting_extra' else 'eyeball_confirm' end as list,
        200000 + s_suppkey * 17 as asn from @supplier
        union all select case cast(floor(abs(s_acctbal)) as bigint) % 4 when 0 then 'vpn_provider' when 1 then 'hosting_extra'
        when 2 then 'cdn' else 'mobile_carrier' end as list, 200000 + s_suppkey * 17 as asn from @supplier""",
    "corrections": """select cast(200000 + n_nationkey * 31 as bigint) as asn, case n_regionkey when 0 then 'none' when 1 then 'hosting'
        when 2 then 'isp' else null end as category, case n_regionkey when 3 then 'stub' when 4 then 'none' else null end as network_role
        from @nation""",
    "names": """select 200000 + c_custkey as asn, case when c_acctbal > 0 then c_name end as name from @customer""",
    "countries": """select 200000 + c_custkey as asn, case when c_acctbal < 5000 then concat('C', cast(c_nationkey as string)) end as cc from @customer""",
    "ips": """select event_id, user_id, ts, 16777216 + (event_id * 7919) % 4000000000 as ip from @events""",
    "any_ips": """select event_id, (event_id * 2654435761) % 4294967296 as ip from @events""",
    "rib": f"""select l_linenumber as collector, 1000 + l_suppkey % 40 as peer_as, cast(8 + l_partkey % 17 as int) as len,
        x - x % {pow2('24 - l_partkey % 17')} as net, case l_partkey % 50 when 7 then 64512 when 8 then -1 else
        200000 + l_partkey % 50 end as origin, case when l_quantity > 25 then 3000 + l_suppkey % 30 else 0 end as upstream
        from (select *, ((l_orderkey % 4000) * 1048576 + 16777216) % 4294967296 as x from @lineitem)""",
    "vrps": f"""select 200000 + p_partkey % 50 as asn, cast(8 + p_partkey % 17 as int) as len,
        x - x % {pow2('24 - p_partkey % 17')} as net, cast(least(8 + p_partkey % 17 + p_size % 8, 32) as int) as maxlen
        from (select *, ((p_partkey * 7 % 4000) * 1048576 + 16777216) % 4294967296 as x from @part)""",
    "delegation_blocks": """select 300000 + o_orderkey * 8 as start, 1 + o_custkey % 6 as count, concat('h', cast(o_custkey % 200 as string)) as opaque_id,
        case o_orderstatus when 'F' then 'allocated' when 'O' then 'assigned' else 'reserved' end as status,
        case when o_custkey % 2 = 0 then 'arin' else 'apnic' end as rir,
        case when o_custkey % 9 = 0 then null else concat('C', cast(o_custkey % 25 as string)) end as cc,
        '20240101' as date, o_orderkey as ordinal from @orders
        union all select case when l_returnflag = 'R' then 300000 + l_orderkey * 8 + 2 else 2000000000 + l_orderkey * 16 + l_linenumber * 2 end as start,
        2 as count, 'x1' as opaque_id, case when l_returnflag = 'R' then 'allocated' else 'reserved' end as status,
        case when l_suppkey % 2 = 0 then 'arin' else 'lacnic' end as rir, 'ZZ' as cc, '00000000' as date,
        1000000000000 + l_orderkey * 10 + l_linenumber as ordinal from @lineitem""",
    "eyeballs": """select 200000 + c_custkey % 300 as asn, c_nationkey as economy, cast(floor(abs(c_acctbal) * 1000) as bigint) as users,
        c_acctbal / 1000000.0 as pct from @customer""",
    "gold": """select l.doc_id as asn, case l.quality when 1 then case when l.toxic = 1 then 'hosting_provider,vpn_provider' else 'hosting_provider' end
        else 'business' end as labels, case when d.lang = 'en' then 'cdn' else 'cloud_provider,cdn' end as acceptable,
        case d.lang when 'en' then 'independent' when 'fr' then 'pinned' else 'weak' end as provenance
        from @labels l join @documents d on l.doc_id = d.doc_id""",
    "preds": """select doc_id as asn, case when n_chars > 2000 then case when n_chars % 3 = 0 then 'hosting_provider,cdn' else 'hosting_provider' end
        when n_chars % 4 = 0 then 'business,education' else 'business' end as labels, ((doc_id * 37) % 101) / cast(100 as double) as confidence
        from @documents""",
    "preds_b": """select doc_id as asn, case when n_chars > 1000 then 'hosting_provider' else 'business' end as labels,
        ((doc_id * 53) % 101) / cast(100 as double) as confidence from @documents""",
    # 128-bit addresses as two 64-bit patterns.
    "base6": f"""select {HI6} + k * 65536 as s_hi, cast(0 as bigint) as s_lo, max({HI6} + k * 65536 + w) as e_hi, cast(-1 as bigint) as e_lo,
        min(asn) as asn from (select o_orderkey as k, case when o_orderkey % 3 = 0 then 65535 else o_custkey % 65536 end as w,
        200000 + o_custkey as asn from @orders) group by k""",
    "vpn6": f"""select {HI6} + p_partkey * 300007 as s_hi, cast(p_size as bigint) as s_lo, {HI6} + p_partkey * 300007 + p_size * 6000 as e_hi,
        p_partkey as e_lo from @part""",
    "rib6": f"""select cast(16 + p % 33 as int) as len, x - x % {pow2('48 - p % 33')} as hi, 200000 + p % 50 as asn from
        (select min(l_partkey) as p, x from (select {HI6} + (l_orderkey % 5000) * 65536 * 64 as x, l_partkey from @lineitem) group by x)""",
    "cand6": f"""select {HI6} + s_suppkey * 688128 as s_hi, cast(0 as bigint) as s_lo, {HI6} + s_suppkey * 688128 + 200000 as e_hi, cast(-1 as bigint) as e_lo,
        200000 + s_suppkey * 17 as asn from @supplier""",
    "ips6": f"""select event_id, {HI6} + (event_id * 104729) as hi, event_id * 31 as lo from @events""",
    "urls": """select page_id as id, url from @pages union all select 1000000 + s_suppkey as id, concat('https://', case s_nationkey % 8
        when 0 then 'www.ripe.net' when 1 then 'stat.ripe.net' when 2 then 'peeringdb.com' when 3 then 'notripe.net'
        when 4 then 'www.shop.co.uk' when 5 then 'a.b.example.com.au' when 6 then 'radar.cloudflare.com' else 'Localhost' end,
        '/x?q=', cast(s_suppkey as string)) as url from @supplier""",
    # Six measures per build; builds are order years.
    "metric_rows": """select m as metric, y as yr, n as value from (select concat('prio:', o_orderpriority) as m, year(o_orderdate) as y,
        count(*) as n from @orders group by 1, 2 union all select concat('status:', o_orderstatus) as m, year(o_orderdate) as y,
        cast(floor(count(*) * (100 + 7 * (year(o_orderdate) % 5)) / cast(100 as double)) as bigint) as n from @orders group by 1, 2)""",
}


def expand(sql: str, table) -> str:
    """Replace @name; `table` maps a given table to its text."""
    def put(m):
        n = m.group(1)
        return table(n) if n in GIVEN else f"({expand(DERIVED[n], table)})"

    return re.sub(r"@([a-z_0-9]+)", put, sql)


def duck(sql: str) -> str:
    """Text for the SQL check, where given tables are views of their own name."""
    return expand(sql, lambda n: n)


class Tables:
    """Given and derived tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def given(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def sql(self, text: str) -> DataFrame:
        used: dict[str, DataFrame] = {}

        def table(n: str) -> str:
            used.setdefault(n, self.given(n))
            return "{" + n + "}"

        return self.spark.sql(expand(text.replace("{", "{{").replace("}", "}}"), table), **used)

    def __getattr__(self, name: str) -> DataFrame:
        if name in GIVEN:
            return self.given(name)
        if name in DERIVED:
            return self.sql(DERIVED[name])
        raise AttributeError(name)

    def six(self, name: str) -> DataFrame:
        """A derived IPv6 range table with struct endpoints."""
        df = getattr(self, name)
        rest = [c for c in df.columns if c not in ("s_hi", "s_lo", "e_hi", "e_lo")]
        return df.select(v6(F.col("s_hi"), F.col("s_lo")).alias("range_start"), v6(F.col("e_hi"), F.col("e_lo")).alias("range_end"), *rest)


# ---------------------------------------------------------------- shared pieces of SQL

def merged(src: str, keys: str = "") -> str:
    """Union of overlapping and adjacent ranges, by a running maximum."""
    part = f"partition by {keys}" if keys else ""
    k = f"{keys}, " if keys else ""
    return f"""select {k}min(range_start) as range_start, max(range_end) as range_end from (
        select *, sum(f) over ({part} order by range_start, range_end) as g from (
        select *, case when range_start <= max(range_end) over ({part} order by range_start, range_end
        rows between unbounded preceding and 1 preceding) + 1 then 0 else 1 end as f from ({src}))) group by {k}g"""


VPN = f"({merged('select * from @vpn_raw')})"
DC = f"({merged('select * from @dc_raw')})"


def bits(name: str) -> str:
    return {"bad_asn": 256, "vpn_provider": 512, "mobile_carrier": 1024, "enterprise_gateway": 2048, "cdn": 4096,
            "hosting_extra": 8192}[name]


def code(col: str, names: list[str]) -> str:
    return "case " + " ".join(f"when {col} = '{n}' then {i + 1}" for i, n in enumerate(names)) + " else 0 end"


CATS = ["isp", "hosting", "business", "education_research", "government_admin"]
ROLES = ["tier1_transit", "major_transit", "midsize_transit", "access_provider", "content_network", "stub"]

FLAGS = f"""(select asn, cast(c + r * 16 + b as integer) as flags from (
    select asn, case when cc is not null then {code('cc', CATS)} when eye then 1 else coalesce({code('mc', CATS)}, 0) end as c,
    case when cr is not null then {code('cr', ROLES)} when eye then 4 else coalesce({code('mr', ROLES)}, 0) end as r, coalesce(b, 0) as b
    from (select asn, m.category as mc, m.network_role as mr, coalesce(l.eye, false) as eye, l.b, c.category as cc, c.network_role as cr
    from @asn_meta m full join (select asn, bool_or(list = 'eyeball_confirm') as eye,
    sum(distinct case list {' '.join(f"when '{n}' then {bits(n)}" for n in ("bad_asn", "vpn_provider", "mobile_carrier", "enterprise_gateway", "cdn", "hosting_extra"))}
    else 0 end) as b from @asn_lists group by asn) l using (asn) full join @corrections c using (asn))) where c + r * 16 + b <> 0)"""

STAMPED = f"(select range_start, range_end, asn, coalesce(flags, 0) as flags from @base left join {FLAGS} using (asn))"

SEGMENTS = f"""(with b as (select range_start as p from @base union select range_end + 1 from @base
    union select range_start from {VPN} union select range_end + 1 from {VPN}
    union select range_start from {DC} union select range_end + 1 from {DC}),
    s as (select p as range_start, lead(p) over (order by p) - 1 as range_end from b)
    select * from (select s.range_start, s.range_end, case when b.range_end >= s.range_start then b.asn end as asn,
    case when b.range_end >= s.range_start then b.flags else 0 end as flags,
    coalesce(v.range_end >= s.range_start, false) as vpn_range, coalesce(d.range_end >= s.range_start, false) as datacenter_range
    from s asof left join {STAMPED} b on s.range_start >= b.range_start
    asof left join {VPN} v on s.range_start >= v.range_start
    asof left join {DC} d on s.range_start >= d.range_start)
    where range_end is not null and (asn is not null or vpn_range or datacenter_range))"""

CATEGORY = "case flags & 15 " + " ".join(f"when {i + 1} then '{c}'" for i, c in enumerate(CATS)) + " end"
ROLE = "case (flags >> 4) & 15 " + " ".join(f"when {i + 1} then '{c}'" for i, c in enumerate(ROLES)) + " end"
VERDICT = """case when vpn_range then 'vpn' when flags & 512 <> 0 then 'vpn' when flags & 2048 <> 0 then 'enterprise_gateway'
    when datacenter_range then 'hosting' when flags & 256 <> 0 or flags & 8192 <> 0 or flags & 4096 <> 0 or flags & 15 = 2 then 'hosting'
    when flags & 1024 <> 0 then 'mobile' when flags & 15 = 1 and (flags >> 4) & 15 <> 1 then 'residential_isp' when flags & 15 = 3 then 'business'
    when flags & 15 = 4 then 'education' when flags & 15 = 5 then 'government' else 'unknown' end"""
SOURCES_TEXT = """case when vpn_range then 'x4b_vpn' when flags & 512 <> 0 then 'asn_vpn_provider' when flags & 2048 <> 0 then 'asn_enterprise_gw'
    when datacenter_range then 'x4b_dc' when flags & 256 <> 0 or flags & 8192 <> 0 or flags & 4096 <> 0 or flags & 15 = 2 then
    concat_ws('|', case when flags & 256 <> 0 then 'asn_bad_asn' end, case when flags & 8192 <> 0 then 'asn_hosting_extra' end,
    case when flags & 4096 <> 0 then 'asn_cdn' end, case when flags & 15 = 2 then 'asn_category' end)
    when flags & 1024 <> 0 then 'asn_mobile_carrier' when flags & 15 = 1 and (flags >> 4) & 15 <> 1 then 'asn_category'
    when flags & 15 in (3, 4, 5) then 'asn_category' when flags & 15 = 1 then 'isp_transit_ambiguous'
    when asn is not null then 'asn_no_category' else 'unrouted' end"""

INTERVALS = f"""(select min(range_start) as range_start, max(range_end) as range_end, asn, flags, vpn_range, datacenter_range from (
    select *, sum(h) over (order by range_start) as g from (select *, case when lag(range_end) over w + 1 = range_start
    and lag(asn) over w is not distinct from asn and lag(flags) over w = flags and lag(vpn_range) over w = vpn_range
    and lag(datacenter_range) over w = datacenter_range then 0 else 1 end as h from {SEGMENTS} window w as (order by range_start)))
    group by g, asn, flags, vpn_range, datacenter_range)"""


def u128(hi: str, lo: str) -> str:
    return (f"({hi}::uhugeint * 18446744073709551616 + (case when {lo} < 0 then {lo}::hugeint + 18446744073709551616 else {lo}::hugeint end)::uhugeint)")


def hex128(x: str) -> str:
    return f"lpad(lower(hex({x})), 32, '0')"


def ranges6(name: str, extra: str = "") -> str:
    return f"(select {u128('s_hi', 's_lo')} as range_start, {u128('e_hi', 'e_lo')} as range_end{extra} from @{name})"
