"""The stored index and the prefix forest against brute force, in both families."""

import random

import pytest
from pyspark.sql import functions as F

from netorigin.functions.space import V4, V6
from netorigin.operators import classify, forest, index, joins, quant

BITS = {4: 32, 6: 128}
SPACES = {4: V4, 6: V6}
DDL = {4: "bigint", 6: "struct<hi:bigint,lo:bigint>"}


def put(v, n):
    return n if v == 4 else ((n >> 64) - (1 << 63), (n & (1 << 64) - 1) - (1 << 63))


def got(v, x):
    return x if v == 4 or x is None else ((x[0] + (1 << 63)) << 64) + x[1] + (1 << 63)


def disjoint(rng, bits, n):
    """Disjoint ranges: dense runs of single addresses, neighbours, wide ones, both ends of the space."""
    top = (1 << bits) - 1
    cuts = {0, top, *(rng.randrange(top) for _ in range(n)), *(rng.randrange(top >> 8) for _ in range(n // 4))}
    at = rng.randrange(top >> 2)
    cuts |= {at + k for k in range(n)}
    cuts = sorted(cuts)
    return [(a, rng.choice([a, b - 1, (a + b) // 2])) for a, b in zip(cuts, cuts[1:]) if rng.random() < 0.8 and b > a] + [(top, top)]


@pytest.mark.parametrize("version", [4, 6])
@pytest.mark.parametrize("rows", [8, 64])
def test_index(spark, tmp_path, version, rows):
    rng, bits, space = random.Random(version), BITS[version], SPACES[version]
    made = disjoint(rng, bits, 300)
    df = spark.createDataFrame([(put(version, a), put(version, b), f"p{i}") for i, (a, b) in enumerate(made)], f"range_start {DDL[version]}, range_end {DDL[version]}, name string")
    index.write_index(df, space, ["name"], str(tmp_path / "i"), cell_rows=rows, block_rows=100)
    ix = index.StoredIndex.open(spark, str(tmp_path / "i"), space)
    assert ix.payload == ["range_start", "range_end", "name"]
    cells = [(got(version, r.net), r.len, r.n) for r in ix.cells.collect()]
    spans = sorted((n, n + (1 << bits - k) - 1) for n, k, _ in cells)
    assert spans[0][0] == 0 and spans[-1][1] == (1 << bits) - 1 and all(a[1] + 1 == b[0] for a, b in zip(spans, spans[1:]))
    assert all(n == sum(a <= e and s <= b for a, b in made) for (s, e), n in zip(spans, [n for *_, n in sorted(cells)]))
    assert max(sum(s <= a <= e for a, _ in made) for s, e in spans) <= rows
    asked = [x for a, b in made for x in (a, b, (a + b) // 2, max(a - 1, 0), min(b + 1, (1 << bits) - 1))] + [rng.randrange(1 << bits) for _ in range(200)]
    asked += [asked[0]] * 50
    points = spark.createDataFrame([(i, put(version, x)) for i, x in enumerate(asked)] + [(-1, None)], f"id int, ip {DDL[version]}")
    want = {i: next((k for k, (a, b) in enumerate(made) if a <= x <= b), None) for i, x in enumerate(asked)}
    for cells_limit in (index.BROADCAST_CELLS, 0):  # the directory broadcast, and joined by shuffle
        index.BROADCAST_CELLS, was = cells_limit, index.BROADCAST_CELLS
        try:
            hit = {r.id: r.name for r in ix.lookup(points, how="left").collect()}
            inner = {r.id: r.name for r in ix.lookup(points).collect()}
        finally:
            index.BROADCAST_CELLS = was
        assert hit == {i: None if k is None else f"p{k}" for i, k in want.items()}
        assert inner == {i: n for i, n in hit.items() if n is not None}
    one = points.filter(F.col("id") == 7)
    few = ix.lookup_few(one)
    assert [r.name for r in few.collect()] == [f"p{want[7]}"]
    blocks = ix.rows.select("block").distinct().count()
    assert blocks > 1 and "(block" in few._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: ", 1)[1]


@pytest.mark.parametrize("version", [4, 6])
def test_empty_index(spark, tmp_path, version):
    shape = f"range_start {DDL[version]}, range_end {DDL[version]}, asn bigint, flags int, vpn_range boolean, datacenter_range boolean"
    index.write_index(spark.createDataFrame([(None, None, 1, 0, False, False)], shape), SPACES[version], ["asn", "flags", "vpn_range", "datacenter_range"], str(tmp_path / "i"))
    ix = index.StoredIndex.open(spark, str(tmp_path / "i"), SPACES[version])
    points = spark.createDataFrame([(1, put(version, 1 << 27)), (2, None)], f"id int, ip {DDL[version]}")
    assert ix.lookup(points).count() == 0 and ix.lookup_few(points).count() == 0
    assert [(r.id, r.asn) for r in classify.stored_verdicts(points, ix).collect()] == [(1, None)]


def nested(rng, bits, n):
    """Prefixes nested deeply, side by side, equal in net, whole space and single addresses among them."""
    out = {(0, 0), ((1 << bits) - 1, bits)} if rng.random() < 0.5 else set()
    base = rng.randrange(1 << bits)
    for _ in range(n):
        length = rng.randrange(bits + 1)
        near = base ^ rng.randrange(1 << max(1, bits - rng.randrange(bits)))
        out.add((near >> (bits - length) << (bits - length), length))
        if rng.random() < 0.3:
            out.add((near >> (bits - length) << (bits - length), min(bits, length + rng.randrange(4))))
    return sorted(out)


def covers(p, q, bits):
    return p[1] <= q[1] and q[0] >> (bits - p[1]) == p[0] >> (bits - p[1])


@pytest.mark.parametrize("version,seed", [(4, 1), (4, 2), (6, 3)])
def test_forest(spark, version, seed):
    rng, bits, space = random.Random(seed), BITS[version], SPACES[version]
    stored, routes = nested(rng, bits, 60), nested(rng, bits, 20)
    routes = sorted({*routes, *rng.sample(stored, 20), *((n, min(bits, k + 1)) for n, k in rng.sample(stored, 10))})
    frame = lambda ps: spark.createDataFrame([(put(version, n), k, i % 7) for i, (n, k) in enumerate(ps)], f"net {DDL[version]}, len int, asn bigint")
    s, r = frame(stored), frame(routes)
    chain = {(got(version, x.route_net), x.route_len, got(version, x.net), x.len) for x in forest.covering_chain(r.union(r), s.union(s), space).collect()}
    assert chain == {(*q, *p) for q in routes for p in stored if covers(p, q, bits)}
    up = {(got(version, x.net), x.len): (got(version, x.parent_net), x.parent_len, x.depth) for x in forest.parents(s, space).collect()}
    for q in stored:
        over = [p for p in stored if covers(p, q, bits) and p != q]
        best = max(over, key=lambda p: p[1], default=(None, None))
        assert up[q] == (*best, len(over) + 1)
    asked = [n for n, _ in stored] + [n + (1 << bits - k) - 1 for n, k in stored] + [rng.randrange(1 << bits) for _ in range(50)]
    at = spark.createDataFrame([(put(version, x),) for x in [*asked, *asked]] + [(None,)], f"ip {DDL[version]}")
    best = {got(version, x.ip): (got(version, x.net), x.len) for x in forest.most_specific(at, s, space, ["asn"]).collect()}
    assert best == {x: max((p for p in stored if p[0] <= x < p[0] + (1 << bits - p[1])), key=lambda p: p[1])
                    for x in asked if any(p[0] <= x < p[0] + (1 << bits - p[1]) for p in stored)}
    flat = [(got(version, x.range_start), got(version, x.range_end), (got(version, x.net), x.len)) for x in forest.flatten(s, space, ["asn"]).collect()]
    bounds = sorted({n for n, _ in stored} | {n + (1 << bits - k) for n, k in stored})
    want = []
    for a, b in zip(bounds, bounds[1:]):
        over = [p for p in stored if p[0] <= a < p[0] + (1 << bits - p[1])]
        if over:
            want.append((a, b - 1, max(over, key=lambda p: p[1])))
    assert sorted(flat) == want


def test_route_states_by_chain(spark):
    rng = random.Random(5)
    stored, routes = [p for p in nested(rng, 32, 60) if p[1] > 4], nested(rng, 32, 40)
    v = [(n, k, rng.randrange(5), min(32, k + rng.randrange(6))) for n, k in stored for _ in range(rng.choice([1, 3]))]
    r = [(n, k, rng.randrange(5)) for n, k in routes + rng.sample(stored, 20)]
    states = quant.route_states(spark.createDataFrame(r + r, "net bigint, len int, asn bigint"), spark.createDataFrame(v, "net bigint, len int, asn bigint, maxlen int"))
    want = {}
    for n, k, a in r:
        over = [x for x in v if covers(x[:2], (n, k), 32)]
        want[n, k, a] = "valid" if any(x[2] == a and x[3] >= k for x in over) else "invalid" if over else "notfound"
    assert {(x.net, x.len, x.asn): x.state for x in states.collect()} == want and len(set(want.values())) == 3


def test_empty_forest(spark):
    none = spark.createDataFrame([], "net bigint, len int, asn bigint")
    one = spark.createDataFrame([(0, 8, 1)], "net bigint, len int, asn bigint")
    assert forest.flatten(none, V4, ["asn"]).collect() == [] and forest.covering_chain(one, none, V4).collect() == [] and forest.covering_chain(none, one, V4).collect() == []
    assert joins.covering_prefixes(one, one, V4).count() == 1
