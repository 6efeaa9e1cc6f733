"""Scalar functions against the standard library."""

import ipaddress
import random

from helpers import addr6
from pyspark.sql import functions as F

from netorigin.functions import addr, flags, text as tx
from netorigin.functions.space import V4, V6


def v6_values():
    r = random.Random(1)
    out = [0, 1, (1 << 64) - 1, 1 << 64, (1 << 128) - 1, 1 << 127, 0xFFFF00000000 | 5]
    for _ in range(300):
        g = [r.choice([0, 0, 0, r.randrange(65536)]) for _ in range(8)]
        out.append(int("".join(f"{x:04x}" for x in g), 16))
    return out


def canonical(v):
    """RFC 5952 text, never dotted."""
    g = [(v >> (112 - 16 * i)) & 0xFFFF for i in range(8)]
    best = (0, 0)
    for i in range(8):
        j = i
        while j < 8 and g[j] == 0:
            j += 1
        if j - i >= 2 and j - i > best[1]:
            best = (i, j - i)
    h = [f"{x:x}" for x in g]
    if not best[1]:
        return ":".join(h)
    return ":".join(h[: best[0]]) + "::" + ":".join(h[best[0] + best[1]:])


def test_v6_text_round_trip(spark):
    vals = v6_values()
    addr.register_sql(spark)
    df = spark.createDataFrame([(addr6(v), ipaddress.IPv6Address(v).exploded, i) for i, v in enumerate(vals)], f"a {V6.ddl}, long string, i int")
    rows = df.select("i", addr.v6_text(F.col("a")).alias("t"), V6.hex(F.col("a")).alias("h"), V6.hex(addr.v6_to_pair(F.col("long"))).alias("p"),
                     V6.hex(addr.v6_to_pair(addr.v6_text(F.col("a")))).alias("q")).collect()
    for r in rows:
        want = f"{vals[r.i]:032x}"
        assert (r.t, r.h, r.p, r.q) == (canonical(vals[r.i]), want, want, want)
    sql = spark.sql("select ip6_text(2594073385365405696, 1) as a, ip6_text(0, 0) as b, ip6_text(281474976710657, 0) as c").first()
    assert tuple(sql) == ("2400::1", "::", "1:0:0:1::")


def test_v6_text_rejects(spark):
    bad = ["", ":", ":::", "1::2::3", "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8:9", "12345::", "g::", "1:2:3:4:5:6:7::8:9", ":1:2:3:4:5:6:7", "::1.2.3.400", "1.2.3.4"]
    df = spark.createDataFrame([(b,) for b in bad], "t string").select("t", addr.v6_to_pair(F.col("t")).alias("a"))
    assert [r.t for r in df.filter("a is not null").collect()] == []


def test_v6_arithmetic(spark):
    vals = v6_values()
    df = spark.createDataFrame([(addr6(v), i) for i, v in enumerate(vals)], f"a {V6.ddl}, i int")
    top = (1 << 128) - 1
    for r in df.select("i", V6.hex(V6.succ(F.col("a"))).alias("s"), V6.hex(V6.pred(F.col("a"))).alias("p"),
                       *[V6.hex(V6.mask(F.col("a"), F.lit(n))).alias(f"m{n}") for n in (0, 1, 48, 64, 65, 127, 128)]).collect():
        v = vals[r.i]
        assert r.s == (None if v == top else f"{v + 1:032x}")
        assert r.p == (None if v == 0 else f"{v - 1:032x}")
        for n in (0, 1, 48, 64, 65, 127, 128):
            assert r[f"m{n}"] == f"{(v >> (128 - n) << (128 - n)):032x}"
    sizes = spark.createDataFrame([(addr6(0x2000 << 112), addr6((0x4000 << 112) - 1))], f"a {V6.ddl}, b {V6.ddl}").select(V6.size(F.col("a"), F.col("b")))
    assert int(sizes.first()[0]) == 1 << 125


def test_cidr_pieces_are_minimal(spark):
    r = random.Random(2)
    rows = [(0, (1 << 32) - 1), (0, 0), (1, (1 << 32) - 2)]
    for _ in range(150):
        a = r.randrange(1 << 32)
        rows.append((a, min((1 << 32) - 1, a + r.randrange(1 << r.randrange(1, 31)))))
    df = addr.cidr_pieces(spark.createDataFrame(rows, "range_start bigint, range_end bigint"))
    got = {}
    for x in df.collect():
        got.setdefault((x.range_start, x.range_end), []).append((x.net, x.len))
    for a, b in rows:
        want = [(int(n.network_address), n.prefixlen) for n in ipaddress.summarize_address_range(ipaddress.IPv4Address(a), ipaddress.IPv4Address(b))]
        assert sorted(got[(a, b)]) == want


def test_cidr_to_range(spark):
    df = spark.createDataFrame([(t,) for t in ["10.1.2.3/8", "1.2.3.4", "2001:db8::1/32", "::1", "1.2.3.4/33", "x", "1.2.3/8", "01.2.3.4", "::/129"]], "t string")
    got = {r.t: r.r for r in df.select("t", addr.cidr_to_range(F.col("t")).alias("r")).collect()}
    assert (got["10.1.2.3/8"].start4, got["10.1.2.3/8"].end4) == (167772160, 184549375)
    assert got["1.2.3.4"].len == 32 and got["::1"].len == 128 and got["2001:db8::1/32"].family == 6
    assert all(got[t] is None for t in ("1.2.3.4/33", "x", "1.2.3/8", "01.2.3.4", "::/129"))


def test_contactable(spark):
    t = {"8.8.8.8": False, "10.0.0.1": True, "::ffff:127.0.0.1": True, "::1": True, "2606:4700::1": False, "fe80::1": True, "100.64.0.1": True, "junk": True, "255.0.0.1": True}
    df = spark.createDataFrame([(k,) for k in t], "t string").select("t", addr.not_contactable(F.col("t")).alias("b"))
    assert {r.t: r.b for r in df.collect()} == t


def test_truncate_utf8(spark):
    texts = ["é" * 60, "a" + "é" * 60, "€" * 40, "ab" + "😀" * 30, "x" * 96, "x" * 97, "", "日" * 32, "a" * 95 + "é"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", tx.truncate_utf8(F.col("t")).alias("x"))
    for r in df.collect():
        assert r.x == texts[r.i].encode()[:96].decode(errors="ignore")


def test_extract_json_and_clean(spark):
    rows = [('{"a":1}',), ('x ```json\n{"b":2}\n``` y',), ('so {"c":{"d":3}} end',), ("none",), ('{"a":',)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").select(tx.extract_json(F.col("t"))).collect()]
    assert got == ['{"a":1}', '{"b":2}', '{"c":{"d":3}}', None, None]
    names = [("Lumen Technologies (CenturyLink) — AS209", "Lumen Technologies (CenturyLink)"), ("Verizon (UUNET / AS701)", "Verizon (UUNET)"), ("AS1, Foo", "Foo"), ("Bar (AS9)", "Bar"), ("AS5", "AS5")]
    for r in spark.createDataFrame(names, "t string, w string").select("w", tx.clean_name(F.col("t")).alias("g")).collect():
        assert r.g == r.w
    assert spark.createDataFrame([("é\x07 x  ",)], "t string").select(tx.clean_label(F.col("t"))).first()[0] == "é x"


def test_flag_word(spark):
    df = spark.range(0, 65536, 7).select(F.col("id").cast("int").alias("f"))
    ok = df.filter(flags.violation(F.col("f")).isNull())
    again = flags.encode(flags.category(F.col("f")), flags.role(F.col("f")), {s: flags.signal(F.col("f"), s) for s in ("bad_asn", "vpn_provider", "mobile_carrier", "enterprise_gw", "cdn", "hosting_extra")})
    assert ok.count() > 0 and ok.filter(again != F.col("f")).count() == 0
