"""Address text, prefixes and special blocks as column expressions."""

from __future__ import annotations

import ipaddress

from pyspark.sql import Column
from pyspark.sql import functions as F

from netorigin.functions import vocab
from netorigin.functions.space import LONG_MIN, V4, V6, unbias, v6

OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
V4_TEXT = rf"^{OCTET}(?:\.{OCTET}){{3}}$"


def _b(n: int) -> Column:
    return F.lit(n).cast("bigint")


def let(value: Column, body) -> Column:
    """body(value) with `value` evaluated once.

    A Python-built expression repeats its operand at every use; chained rules would
    grow exponentially.  A one-element transform names the operand instead.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def v4_to_int(text: Column) -> Column:
    """Dotted decimal -> BIGINT; null unless exactly four octets without leading zeros."""
    p = F.split(text, r"\.")
    val = sum((p[i].cast("bigint") * _b(1 << (24 - 8 * i)) for i in range(1, 4)), p[0].cast("bigint") * _b(1 << 24))
    return F.when(text.rlike(V4_TEXT), val)


def int_to_v4(n: Column) -> Column:
    octet = lambda s: F.shiftright(n, s).bitwiseAND(F.lit(255)).cast("string")
    return F.when(n.between(0, V4.max_value), F.concat_ws(".", octet(24), octet(16), octet(8), octet(0)))


def v6_to_pair(text: Column) -> Column:
    """IPv6 text -> struct<hi,lo>; null for anything malformed.

    A trailing dotted quad is rewritten as two groups first, then `::` is
    expanded by counting the groups on both sides.
    """
    groups = lambda s: F.filter(F.split(s, ":"), lambda g: g != "")

    def plain(t: Column) -> Column:
        """Rewrite the dotted quad, if any."""
        n = lambda: v4_to_int(F.regexp_extract(t, r":(\d+\.\d+\.\d+\.\d+)$", 1))
        return F.when(~F.contains(t, F.lit(".")), t).otherwise(let(n(), lambda v: F.concat(
            F.regexp_replace(t, r"\d+\.\d+\.\d+\.\d+$", ""),
            F.lower(F.hex(F.shiftright(v, 16))), F.lit(":"), F.lower(F.hex(v.bitwiseAND(F.lit(65535)))))))

    def sides(t: Column) -> Column:
        halves = F.split(t, "::")
        return F.struct(t.alias("t"), F.size(halves).alias("n"), groups(halves[0]).alias("l"),
                        groups(F.coalesce(F.try_element_at(halves, F.lit(2)), F.lit(""))).alias("r"))

    def full(p: Column) -> Column:
        fill = F.lit(8) - F.size(p["l"]) - F.size(p["r"])
        ok = (
            p["t"].rlike(r"^[0-9a-f:]+$") & ~p["t"].rlike(r":::|^:[^:]|[^:]:$")
            & (F.when(p["n"] == 2, fill >= 1).when(p["n"] == 1, fill == 0).otherwise(F.lit(False)))
            & F.forall(F.concat(p["l"], p["r"]), lambda g: F.length(g) <= 4))
        zeros = F.array_repeat(F.lit("0"), F.greatest(fill, F.lit(0)).cast("int"))
        return F.when(ok, F.array_join(F.transform(F.concat(p["l"], zeros, p["r"]), lambda g: F.lpad(g, 4, "0")), ""))

    hex32 = let(let(let(F.lower(text), plain), sides), full)
    return let(hex32, lambda h: F.when(h.isNotNull(), V6.from_hex(h)))


def mapped_v4(addr: Column) -> Column:
    """The IPv4 address inside ::ffff:0:0/96, else null."""
    lo = addr["lo"].bitwiseXOR(_b(LONG_MIN))
    return F.when((addr["hi"] == LONG_MIN) & (F.shiftrightunsigned(lo, 32) == 0xFFFF), lo.bitwiseAND(_b(V4.max_value)))


def v6_text(addr: Column) -> Column:
    """RFC 5952 text: the leftmost longest run of two or more zero groups becomes `::`."""
    def groups(h: Column) -> Column:
        # Colons on both ends, so that a run is always `:0:...:0:`.
        return F.concat(F.lit(":"), F.concat_ws(":", *[
            F.regexp_replace(F.substring(h, 1 + 4 * i, 4), "^0{1,3}", "") for i in range(8)]), F.lit(":"))

    def shorten(g: Column) -> Column:
        # The longest run that occurs is tested last and wins, at its leftmost place.
        out = g
        for n in range(2, 9):
            run = ":" + "0:" * n
            at = F.instr(g, run)
            out = F.when(at > 0, F.concat(F.substr(g, F.lit(1), at - 1), F.lit("::"), F.substr(g, at + len(run)))).otherwise(out)
        return F.regexp_replace(F.regexp_replace(out, "^:(?!:)", ""), "(?<!:):$", "")

    return let(let(let(addr, V6.hex), groups), shorten)


def int_to_v6(hi: Column, lo: Column) -> Column:
    return v6_text(v6(hi, lo))


def fixed_hex(value: Column, space) -> Column:
    """Fixed-width lowercase hex; an address outside the family is an error."""
    if space.version == 4:
        return F.when(value.between(0, V4.max_value), V4.hex(value)).otherwise(
            F.raise_error(F.concat(F.lit("address out of range: "), value.cast("string"))))
    return V6.hex(value)


def parse_fixed_hex(text: Column, version: Column) -> Column:
    """struct(v4, v6) of a fixed-width hex endpoint; the family comes from
    `version` alone, and a wrong width or upper case gives null."""
    ok4 = (version == 4) & text.rlike("^[0-9a-f]{8}$")
    ok6 = (version == 6) & text.rlike("^[0-9a-f]{32}$")
    return F.struct(F.when(ok4, V4.from_hex(F.when(ok4, text))).alias("v4"),
                    F.when(ok6, V6.from_hex(F.when(ok6, text))).alias("v6"))


def cidr_to_range(text: Column) -> Column:
    """`net/len` or a bare address -> struct(family, len, start4, end4, start6, end6), null
    for garbage.  Host bits are masked off."""
    def split(t: Column) -> Column:
        p = F.split(t, "/")
        is6 = F.contains(t, F.lit(":"))
        bits = F.when(is6, F.lit(128)).otherwise(F.lit(32))
        digits = F.try_element_at(p, F.lit(2))
        length = F.when(F.size(p) == 1, bits).when((F.size(p) == 2) & digits.rlike(r"^\d{1,3}$"), digits.try_cast("int"))
        return F.struct(p[0].alias("addr"), is6.alias("is6"), F.when(length <= bits, length).alias("len"))

    def parse(p: Column) -> Column:
        return F.struct(p["len"].alias("len"), F.when(~p["is6"], v4_to_int(p["addr"])).alias("a4"),
                        F.when(p["is6"], v6_to_pair(p["addr"])).alias("a6"))

    def bounds(p: Column) -> Column:
        n4, n6 = V4.mask(p["a4"], p["len"]), V6.mask(p["a6"], p["len"])
        ok4, ok6 = p["a4"].isNotNull(), p["a6"].isNotNull()
        return F.when(p["len"].isNotNull() & (ok4 | ok6), F.struct(
            F.when(ok4, F.lit(4)).otherwise(F.lit(6)).alias("family"), p["len"].alias("len"),
            F.when(ok4, n4).alias("start4"), F.when(ok4, V4.last(n4, p["len"])).alias("end4"),
            F.when(ok6, n6).alias("start6"), F.when(ok6, V6.last(n6, p["len"])).alias("end6")))

    return let(let(let(F.trim(text), split), parse), bounds)


def overlaps(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    return (s1 <= e2) & (s2 <= e1)


def v4_block(net: str, length: int) -> tuple[int, int]:
    n = ipaddress.ip_network(f"{net}/{length}")
    return int(n.network_address), int(n.broadcast_address)


def v6_block(net: str, length: int) -> tuple[Column, Column]:
    n = ipaddress.ip_network(f"{net}/{length}")

    def lit(v: int) -> Column:
        half = lambda x: F.expr(f"cast('{x - (1 << 63)}' as bigint)")
        return F.struct(half(v >> 64).alias("hi"), half(v & ((1 << 64) - 1)).alias("lo"))

    return lit(int(n.network_address)), lit(int(n.broadcast_address))


def block(net: str, length: int, space) -> tuple[Column, Column]:
    if space.version == 4:
        a, b = v4_block(net, length)
        return _b(a), _b(b)
    return v6_block(net, length)


def inside_any(net: Column, length: Column, blocks, space) -> Column:
    """The prefix lies inside one of the blocks (at most as long, and containing it).

    Blocks of one length become one membership test on the leading bits, which
    keeps the expression, and its generated code, small.  IPv6 blocks are at most
    /64, so the high half decides.
    """
    by_len: dict[int, list[int]] = {}
    for b, l in blocks:
        lead = int(ipaddress.ip_network(f"{b}/{l}").network_address) >> (space.bits - l)
        by_len.setdefault(l, []).append(lead)
    hit = F.lit(False)
    for l, leads in sorted(by_len.items()):
        bits = F.shiftright(net, 32 - l) if space.version == 4 else F.shiftrightunsigned(unbias(net["hi"]), 64 - l)
        hit = hit | ((length >= l) & bits.isin(leads))
    return hit


def special_verdict(addr: Column, space) -> Column:
    """struct(verdict, rule) for special-purpose addresses, null elsewhere."""
    out = F.lit(None)
    blocks = vocab.V4_SPECIALS if space.version == 4 else vocab.V6_SPECIALS
    for net, length, verdict, rule in blocks:
        lo, hi = block(net, length, space)
        out = F.when((addr >= lo) & (addr <= hi),
                     F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(out)
    return out


def not_contactable(text: Column) -> Column:
    """Private, loopback, link-local, this-host, CGNAT, multicast or reserved, or unparseable.
    A mapped IPv4 address is unwrapped first."""
    def unwrap(a6: Column) -> Column:
        return F.struct(a6.alias("a6"), F.coalesce(v4_to_int(text), mapped_v4(a6)).alias("a4"))

    def blocked(a: Column) -> Column:
        hit = F.lit(False)
        for net, length in (("10.0.0.0", 8), ("172.16.0.0", 12), ("192.168.0.0", 16), ("127.0.0.0", 8),
                            ("169.254.0.0", 16), ("0.0.0.0", 8), ("100.64.0.0", 10), ("224.0.0.0", 3)):
            hit = hit | a["a4"].between(*v4_block(net, length))
        return F.when(a["a4"].isNotNull(), hit).when(a["a6"].isNotNull(), special_verdict(a["a6"], V6).isNotNull()).otherwise(F.lit(True))

    return let(let(v6_to_pair(F.when(F.contains(text, F.lit(":")), text)), unwrap), blocked)


def length_bucket(start: Column, end: Column, space) -> Column:
    """`~/n`: the prefix length whose block is the smallest one not below the range size."""
    size = space.size(start, end)
    if space.version == 4:
        halvings = sum((F.when(size > (1 << k), 1).otherwise(0) for k in range(0, 33)), F.lit(0))
        return F.concat(F.lit("~/"), (F.lit(32) - halvings).cast("string"))
    halvings = F.ceil(F.log2(size.cast("double"))).cast("int")
    return F.concat(F.lit("~/"), (F.lit(128) - halvings).cast("string"))


def cidr_pieces(df, start: str = "range_start", end: str = "range_end"):
    """Exact minimal prefix decomposition of IPv4 ranges: one row per (net, len).

    At level k (blocks of 2^k) the range is [ceil(start/2^k), floor((end+1)/2^k)) in
    block numbers; an odd lower bound or an odd upper bound is a block that no
    larger block can hold.  At most two blocks per level, 33 levels.
    """
    def at(level: Column) -> Column:
        blk = F.pow(F.lit(2.0), level).cast("bigint")
        lo = F.floor((F.col(start) + blk - 1) / blk).cast("bigint")
        hi = F.floor((F.col(end) + 1) / blk).cast("bigint")
        piece = lambda number: F.struct((number * blk).alias("net"), (F.lit(32) - level).alias("len"))
        top = level == 32
        left = F.when((lo < hi) & ((lo % 2 == 1) | top), piece(lo))
        right = F.when((lo < hi) & (hi % 2 == 1) & ~top & ~((lo % 2 == 1) & (lo == hi - 1)), piece(hi - 1))
        return F.array(left, right)

    levels = F.sequence(F.lit(0), F.lit(32))
    pieces = F.filter(F.flatten(F.transform(levels, at)), lambda p: p.isNotNull())
    rest = [c for c in df.columns if c not in (start, end)]
    return df.select(F.col(start), F.col(end), *rest, F.explode(pieces).alias("p")).select(
        start, end, *rest, "p.net", "p.len")


def cidr_cover_v6(df, start: str = "range_start", end: str = "range_end"):
    """Exact minimal prefix decomposition of IPv6 ranges: one row per (net, len).  A null bound or an end before its start gives no row.

    Let a be the address before the range, b the one after it, and d the highest bit in which they differ.  The blocks are, for every bit k below d, the one
    right of a's path where a has 0 at k, and the one left of b's path where b has 1 at k.  A range that begins the space has no a, and all bits of b count; one that
    ends it has no b; the whole space is one block.  All of it is bit work on the two halves; nothing needs more than 64 bits.
    """
    s, e = F.col(start), F.col(end)
    before, after = V6.pred(s), V6.succ(e)
    rest = [c for c in df.columns if c not in (start, end)]
    shl = lambda x, n: F.call_function("shiftleft", x, n)
    shr = lambda x, n: F.call_function("shiftrightunsigned", x, n)
    # Both paths as plain halves, and one row per bit and side: nothing of it is evaluated again for every bit.
    d = df.filter(s.isNotNull() & e.isNotNull() & (s <= e)).select(s, e, *rest, *[
        unbias(x[half]).alias(f"_{name}_{half}") for name, x in (("a", before), ("b", after)) for half in ("hi", "lo")])
    c = lambda name: F.col(f"_{name}")
    d = d.withColumns({"_d_hi": c("a_hi").bitwiseXOR(c("b_hi")), "_d_lo": c("a_lo").bitwiseXOR(c("b_lo")), "_n": F.explode(F.sequence(F.lit(0), F.lit(255)))})
    k, left = F.shiftright(c("n"), 1), c("n").bitwiseAND(F.lit(1)) == 0
    low, j = k < 64, k.bitwiseAND(F.lit(63))
    bit = shl(_b(1), j)
    hi, lo = F.when(left, c("a_hi")).otherwise(c("b_hi")), F.when(left, c("a_lo")).otherwise(c("b_lo"))
    half = F.when(low, lo).otherwise(hi)
    open_end = c("a_hi").isNull() | c("b_hi").isNull()
    # some higher bit differs, or one side is beyond the space
    higher = lambda x: shr(shr(x, j), F.lit(1)) != 0
    below = open_end | F.when(low, (c("d_hi") != 0) | higher(c("d_lo"))).otherwise(higher(c("d_hi")))
    whole = c("a_hi").isNull() & c("b_hi").isNull() & (c("n") == 0)
    d = d.filter(whole | (hi.isNotNull() & below & ((half.bitwiseAND(bit) != 0) != left)))
    path = half.bitwiseAND(shl(shl(_b(-1), j), F.lit(1))).bitwiseOR(F.when(left, bit).otherwise(_b(0)))
    net = v6(F.when(whole, _b(0)).when(low, hi).otherwise(path), F.when(whole | ~low, _b(0)).otherwise(path))
    return d.select(start, end, *rest, net.alias("net"), F.when(whole, 0).otherwise(F.lit(128) - k).cast("int").alias("len"))


def register_sql(spark) -> None:
    """Address helpers for SQL users: plain SQL functions, no Python at run time."""
    octets = " + ".join(f"cast(split(t, '[.]')[{i}] as bigint) * {1 << (24 - 8 * i)}" for i in range(4))
    regex = V4_TEXT.replace("\\", "\\\\")
    spark.sql(f"create or replace temporary function ip_to_long(t string) returns bigint return "
              f"case when t rlike '{regex}' then {octets} end")
    spark.sql("create or replace temporary function long_to_ip(n bigint) returns string return "
              "concat_ws('.', n div 16777216, (n div 65536) % 256, (n div 256) % 256, n % 256)")
    spark.sql("create or replace temporary function cidr_start(t string) returns bigint return "
              "ip_to_long(split(t, '/')[0]) - ip_to_long(split(t, '/')[0]) % "
              "cast(power(2, 32 - coalesce(cast(try_element_at(split(t, '/'), 2) as int), 32)) as bigint)")
    spark.sql("create or replace temporary function cidr_end(t string) returns bigint return "
              "cidr_start(t) + cast(power(2, 32 - coalesce(cast(try_element_at(split(t, '/'), 2) as int), 32)) as bigint) - 1")
    cases = " ".join("when n between {} and {} then '{}'".format(*v4_block(net, l), f"{v}:{r}")
                     for net, l, v, r in vocab.V4_SPECIALS)
    spark.sql(f"create or replace temporary function special_verdict(n bigint) returns string return case {cases} end")
    hexed = "concat(lpad(lower(hex(hi)), 16, '0'), lpad(lower(hex(lo)), 16, '0'))"
    groups = ", ".join(f"regexp_replace(substr({hexed}, {1 + 4 * i}, 4), '^0{{1,3}}', '')" for i in range(8))
    spark.sql(
        "create or replace temporary function ip6_text(hi bigint, lo bigint) returns string return "
        f"(select regexp_replace(regexp_replace(case {_run_cases()} else g end, '^:(?!:)', ''), '(?<!:):$', '') "
        f"from (select concat(':', concat_ws(':', {groups}), ':') as g))")


def _run_cases() -> str:
    out = []
    for n in range(8, 1, -1):
        run = ":" + "0:" * n
        out.append(f"when instr(g, '{run}') > 0 then concat(substr(g, 1, instr(g, '{run}') - 1), '::', "
                   f"substr(g, instr(g, '{run}') + {len(run)}))")
    return " ".join(out)
