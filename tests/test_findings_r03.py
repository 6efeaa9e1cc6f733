"""Round 3: tables that grow, and clusters with all their members."""

import gzip
import ipaddress
import json

import pytest
from helpers import build
from pyspark.sql import functions as F

from netorigin.functions import addr
from netorigin.functions.space import V4, V6
from netorigin.operators import gates, index, joins, registry
from netorigin.plans import catalog, q_io
from netorigin.sources import parse, sinks


def tiled(spark, space, records, pieces):
    """Records as number pairs, pieces as (record, net, len)."""
    r = build(spark, space, records)
    p = build(spark, space, [(*records[k], n, l) for k, n, l in pieces], ", n bigint, len int")
    net = F.col("n") if space is V4 else F.struct(F.lit(-(1 << 63)).alias("hi"), (F.col("n") + F.lit(-(1 << 63))).alias("lo"))
    return p.select("range_start", "range_end", net.alias("net"), "len"), r


def model(space, records, pieces):
    last = lambda n, l: n + (1 << (space.bits - l)) - 1
    known = set(records)
    per = {}
    for k, n, l in set(pieces):
        per.setdefault(records[k], []).append((n, last(n, l)))
    inside = {r: [x for x in v if r[0] <= x[0] and x[1] <= r[1]] for r, v in per.items()}
    size = {r: sum(b - a + 1 for a, b in v) for r, v in inside.items()}
    reach, over, places = -1, 0, {}
    for _, n, l in pieces:
        places.setdefault(n, []).append(last(n, l))
    for n in sorted(places):
        over += len(places[n]) - 1 + (reach >= n)
        reach = max(reach, *places[n])
    return (len(known), sum(map(len, per.values())), sum(size.values()), sum(size.get(r, 0) != r[1] - r[0] + 1 for r in known),
            sum(len(per[r]) - len(inside[r]) for r in per), over, 0)


@pytest.mark.parametrize("space", [V4, V6])
def test_exact_tiling_faults(spark, space):
    w = space.bits
    records = [(0, 7), (16, 31), (64, 127), (256, 300), (512, 575)]
    pieces = [(0, 0, w - 2), (0, 4, w - 2),  # whole
              (1, 16, w - 3), (1, 16, w - 3), (1, 24, w - 3), (1, 16, w - 2),  # a copy, and a half of one
              (2, 64, w - 5), (2, 96, w - 4), (2, 128, w - 7),  # a hole, and one piece outside
              (3, 256, w - 6), (3, 128, w - 6),  # reaches into the third record's stray piece
              (4, 512, w - 6), (4, 528, w - 4)]
    p, r = tiled(spark, space, records, pieces)
    assert tuple(int(x) for x in gates.exact_tiling(p, r, space).collect()[0]) == model(space, records, pieces)


def test_exact_tiling_lines_up_records_only(spark, monkeypatch):
    """Pieces of records that lie apart are not laid along one line, whatever is wrong inside them."""
    seen = []
    monkeypatch.setattr(gates, "scan", lambda df, *a, _scan=gates.scan, **k: seen.append(df.count()) or _scan(df, *a, **k))
    r = build(spark, V6, [(i << 70, (i << 70) + (1 << 66) + 1000) for i in range(1, 20)])
    p = addr.cidr_cover_v6(r)
    p = p.unionByName(p.filter("len = 123").withColumn("len", F.lit(124)))
    got = gates.exact_tiling(p, r, V6).collect()[0]
    assert (got.records, got.uncovered, got.overlaps, got.pieces) == (19, 19, 19, p.count())
    assert seen == [19]


def test_cover_v6_against_ipaddress(spark):
    top = (1 << 128) - 1
    rows = [(0, 0), (0, top), (1, top), (0, top - 1), (1, top - 1), (5, (1 << 64) + 3), ((1 << 64) - 1, 1 << 64), (3 << 63, 5 << 63), (top, top), ((1 << 127) - 1, 1 << 127), (1 << 63, (1 << 64) - 1)]
    got = addr.cidr_cover_v6(build(spark, V6, rows)).select(V6.hex(F.col("range_start")).alias("s"), V6.hex(F.col("range_end")).alias("e"), V6.hex(F.col("net")).alias("n"), "len").collect()
    want = {(s, e, int(n.network_address), n.prefixlen) for s, e in rows for n in ipaddress.summarize_address_range(ipaddress.IPv6Address(s), ipaddress.IPv6Address(e))}
    assert len(got) == len(want) and {(int(g.s, 16), int(g.e, 16), int(g.n, 16), g.len) for g in got} == want


def deals(spark, *rows):
    return spark.createDataFrame([(s, n, h, "allocated", "arin", "US", "20240101", s) for s, n, h in rows],
                                 "start bigint, count bigint, opaque_id string, status string, rir string, cc string, date string, ordinal bigint")


def test_holder_clusters_hold_every_member(spark):
    """Pools too, in parts; a sibling cluster over two blocks of numbers is one row."""
    reg = registry.clean_registry(registry.registry_rows(deals(spark, (10, 1, "one"), (65530, 3, "two"), (65536, 2, "two"), (131000, 400, "pool"))))
    got = {(r.holder, r.part): (r.kind, r["size"], r.asns) for r in registry.holder_clusters(reg).collect()}
    assert got == {("arin:one", None): ("single", 1, [10]), ("arin:two", None): ("siblings", 5, [65530, 65531, 65532, 65536, 65537]),
                   ("arin:pool", 1): ("pool", 400, list(range(131000, 131072))), ("arin:pool", 2): ("pool", 400, list(range(131072, 131400)))}


def test_holder_lines_hold_every_member(spark):
    reg = registry.clean_registry(registry.registry_rows(deals(spark, (10, 1, "one"), (1000, 300, "pool"))))
    lines = sorted((json.loads(r.value) for r in sinks.holder_json(registry.holder_clusters(reg)).collect()), key=lambda x: x["holder"])
    assert lines == [{"holder": "arin:one", "kind": "single", "size": 1, "asns": [10]},
                     {"holder": "arin:pool", "part": 0, "kind": "pool", "size": 300, "asns": list(range(1000, 1300))}]


def test_registry_rows_in_order_and_written(spark, tmp_path):
    blocks = deals(spark, *[(s * 7 % 1000 * 10, 3, f"h{s % 4}" if s % 5 else None) for s in range(200)])
    plain, dealt = registry.registry_rows(blocks), registry.registry_rows(blocks, in_order=True)
    assert sorted(dealt.collect()) == sorted(plain.collect())
    assert dealt._jdf.queryExecution().executedPlan().toString().count("hashpartitioning") == 0
    sinks.write_registry_rows(registry.clean_registry(dealt), str(tmp_path))
    assert sorted(sinks.read_registry_rows(spark, str(tmp_path)).collect(), key=str) == sorted(registry.clean_registry(plain).collect(), key=str)
    lines = [x for f in sorted(tmp_path.glob("asn-registry/part-*")) for x in gzip.open(f, "rt").read().splitlines()]
    numbers = [json.loads(x)["asn"] for x in lines]
    assert numbers == sorted(numbers) and len(numbers) == plain.count()


def test_decimal_addresses_by_plain_numbers(spark):
    """No decimals and no loops over arrays for each row."""
    top = (1 << 128) - 1
    numbers = [0, 1, 7, (1 << 32) - 1, 1 << 32, (1 << 64) - 1, 1 << 64, 10**27, 10**36 - 1, 10**38 + 12345678901234567890, top, top + 1, 10**39 - 1]
    rows = parse.origin_ranges_v6(spark.createDataFrame([(f"{n},{n},{k + 1},name",) for k, n in enumerate(numbers)], "value string"))
    got = {r.asn: (r.h, r.bad) for r in rows.select("asn", V6.hex(F.col("range_start")).alias("h"), "bad").collect()}
    assert got == {k + 1: (f"{n:032x}" if n <= top else None, n == 0 or n > top) for k, n in enumerate(numbers)}
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" not in plan and "decimal" not in plan


def test_longest_prefix_keeps_one_number_an_address(spark):
    pfx = [(0, 0, 1), (10 << 24, 8, 2), (10 << 24, 16, 3), (10 << 24, 17, 4), ((10 << 24) + 256, 24, 5), ((10 << 24) + 257, 32, None), (255 << 24, 8, 6)]
    prefixes = spark.createDataFrame(pfx, "net bigint, len int, asn bigint")
    points = [(i, ip) for i, ip in enumerate([0, 10 << 24, (10 << 24) + 256, (10 << 24) + 257, (10 << 24) + (1 << 15), (10 << 24) + (1 << 16), (1 << 32) - 1, 10 << 24])]
    df = joins.longest_prefix_match(spark.createDataFrame(points, "id int, ip bigint"), prefixes, V4, ["asn"])
    want = {i: max((l, n, a) for n, l, a in pfx if ip >> (32 - l) == n >> (32 - l)) for i, ip in points}
    assert {r.id: (r.len, r.net, r.asn) for r in df.collect()} == want
    assert "max_by" not in df._jdf.queryExecution().analyzed().toString()


@pytest.mark.parametrize("limit", [0, 20, 500_000])
def test_stored_index_shuffles_only_lengths_with_many_cells(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(index, "BROADCAST_CELLS", limit)
    rows = [(i * 100, i * 100 + 40, i) for i in range(400)]
    index.write_index(build(spark, V4, rows, ", asn int"), V4, ["asn"], str(tmp_path / "x"), cell_rows=8)
    ix = index.StoredIndex.open(spark, str(tmp_path / "x"), V4)
    points = [(i, i * 37) for i in range(1200)]
    got = ix.lookup(spark.createDataFrame(points, "id int, ip bigint"), how="left").collect()
    assert {r.id: r.asn for r in got} == {i: ip // 100 if ip % 100 <= 40 and ip < 40_000 else None for i, ip in points} and len(got) == 1200
    sizes = {r["len"]: r["count"] for r in ix.cells.groupBy("len").count().collect()}
    assert sum(sizes[n] for n in ix.few) <= limit and (limit < 500_000 or ix.few == ix.lengths)


def test_export_rows_are_made_once(spark, monkeypatch):
    made = []
    monkeypatch.setattr(q_io, "cut", lambda df, _cut=q_io.cut: made.append(df.columns) or _cut(df))
    assert catalog.callables()["dq15_export_equal"](spark, "/root/testdata/sf0.001").collect()[0].differences == 0
    assert any("start_hex" in c for c in made)
