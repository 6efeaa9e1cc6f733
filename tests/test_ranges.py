"""Range algebra against brute force, across bucket bounds, in both families."""

import random

import pytest
from helpers import addr6, back, build, covered, ranges, runs
from pyspark.sql import functions as F

from netorigin.functions.space import V4, V6
from netorigin.operators import joins, ranges as rg

# Lines that straddle a /16 bound and the bound between the two 64-bit halves.
PLACES = [(V4, 65536 - 300), (V6, (1 << 64) - 300)]


@pytest.fixture(params=PLACES, ids=["v4", "v6"])
def place(request, spark):
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")  # several IPv6 buckets
    yield request.param
    spark.conf.unset(name)


def rand(seed, n, span=600, width=40):
    r = random.Random(seed)
    return [(s, s + r.randrange(width)) for s in (r.randrange(span) for _ in range(n))]


def disjoint(seed, n):
    return runs(covered(rand(seed, n, width=12)))


def shift(rows, base):
    return sorted((a + base, b + base, *r) for a, b, *r in rows)


def test_merge(spark, place):
    space, base = place
    rows = rand(1, 40) + rand(1, 5)
    got = back(rg.merge_ranges(build(spark, space, rows, base=base), space), space)
    assert got == shift(runs(covered(rows)), base)


def test_merge_by_key(spark):
    rows = [(a, b, k) for k in (1, 2) for a, b in rand(k, 20)]
    got = back(rg.merge_ranges(ranges(spark, rows, ", asn bigint"), V4, ("asn",)), V4, "asn")
    want = sorted((a, b, k) for k in (1, 2) for a, b in runs(covered([r for r in rows if r[2] == k])))
    assert got == want


def test_intersect_subtract(spark, place):
    space, base = place
    a, b = disjoint(3, 25), disjoint(4, 25)
    A, B = build(spark, space, a, base=base), build(spark, space, b, base=base)
    both = sorted((max(x, u), min(y, v)) for x, y in a for u, v in b if x <= v and u <= y)
    assert back(rg.intersect_ranges(A, B, space), space) == shift(both, base)
    minus = sorted(r for x, y in a for r in runs(set(range(x, y + 1)) - covered(b)))
    assert back(rg.subtract_ranges(A, B, space), space) == shift(minus, base)


def test_subtract_does_not_bridge(spark):
    a, b = ranges(spark, [(0, 9), (10, 19)]), ranges(spark, [(3, 4)])
    assert back(rg.subtract_ranges(a, b, V4), V4) == [(0, 2), (5, 9), (10, 19)]


def test_gaps(spark, place):
    space, base = place
    cand = [(a, b, i) for i, (a, b) in enumerate(rand(5, 15, width=80))]
    cover = disjoint(6, 20)
    got = back(rg.gaps(build(spark, space, cand, ", id bigint", base), build(spark, space, cover, base=base), space), space, "id")
    want = [(x, y, i) for a, b, i in cand for x, y in runs(set(range(a, b + 1)) - covered(cover))]
    assert got == shift(want, base)


def test_range_join_matches_pairs(spark, place):
    space, base = place
    left = [(a, b, i) for i, (a, b) in enumerate(rand(7, 30))]
    right = [(a, b, i) for i, (a, b) in enumerate(disjoint(8, 30))]
    j = rg.range_join(build(spark, space, left, ", id bigint", base), build(spark, space, right, ", rid bigint", base), space)
    want = sorted((i, k) for a, b, i in left for c, d, k in right if a <= d and c <= b)
    assert sorted((r.id, r.r_rid) for r in j.select("id", "r_rid").collect()) == want


def test_sanitize(spark, place):
    space, base = place
    rows = [(a, b, i) for i, (a, b) in enumerate(rand(9, 40))] + [(5, 9, 100), (5, 9, 99)]
    want, top, fixed = [], -1, 0
    for a, b, i in sorted(rows, key=lambda r: (r[0], -r[1], r[2])):
        if a <= top:
            fixed += 1
            if b <= top:
                continue
            a = top + 1
        top = b
        want.append((a, b, i))
    df = build(spark, space, rows, ", asn bigint", base)
    assert back(rg.sanitize(df, space, "asn"), space, "asn") == shift(want, base)
    assert rg.sanitize_counts(df, space, "asn").first().repairs == fixed


def test_coalesce_is_null_safe_and_never_bridges(spark, place):
    space, base = place
    rows = [(0, 9, 1), (10, 350, 1), (352, 353, 1), (354, 360, None), (361, 370, None), (371, 372, 2)]
    got = back(rg.coalesce_equal(build(spark, space, rows, ", asn bigint", base), space, ["asn"]), space, "asn")
    assert got == [(a + base, b + base, n) for a, b, n in [(0, 350, 1), (352, 353, 1), (354, 370, None), (371, 372, 2)]]


def test_family_maximum(spark):
    top = (1 << 128) - 1
    b = build(spark, V6, [(top - 5, top, 7)], ", asn bigint")
    o = build(spark, V6, [(top - 2, top)])
    s = rg.sweep(V6, {"b": b, "o": o}, {"b": ["asn"]})
    assert back(s, V6, "asn", "in_o") == [(top - 5, top - 3, 7, False), (top - 2, top, 7, True)]
    assert back(rg.merge_ranges(b.select("range_start", "range_end").union(o), V6), V6) == [(top - 5, top)]
    v4 = (1 << 32) - 1
    s4 = rg.sweep(V4, {"b": ranges(spark, [(0, 0, 1), (v4, v4, 2)], ", asn bigint")}, {"b": ["asn"]})
    assert back(s4, V4, "asn") == [(0, 0, 1), (v4, v4, 2)]


def test_hot_position_collapses(spark):
    """A third of all rows on one range is one event row after map-side aggregation."""
    rows = [(1000, 2000)] * 5000 + rand(11, 50)
    assert back(rg.merge_ranges(ranges(spark, rows), V4), V4) == runs(covered(rows))


def test_points(spark, place):
    space, base = place
    iv = [(a, b, i) for i, (a, b) in enumerate(disjoint(12, 20))]
    pts = list(range(-5, 640, 3)) * 2
    if space is V4:
        p = spark.createDataFrame([(base + x,) for x in pts], "ip bigint")
    else:
        p = spark.createDataFrame([(addr6(base + x),) for x in pts], f"ip {V6.ddl}")
    j = joins.point_in_interval(p, build(spark, space, iv, ", id bigint", base), space, ["id"])
    got = sorted((int(r[0], 16) - base, r[1]) for r in j.select(space.hex(F.col("ip")), "id").collect())
    assert got == sorted((x, i) for x in pts for a, b, i in iv if a <= x <= b)


def test_nested_prefixes(spark, place):
    space, _ = place
    r, net = random.Random(13), (1 << 24 if space is V4 else 0x2400 << 112)
    bits, low = (32, 20) if space is V4 else (128, 116)
    pfx = {}
    for i in range(40):
        l = r.randrange(low, bits - 3)
        n = (net + r.randrange(1 << (bits - low))) >> (bits - l) << (bits - l)
        pfx[(n, l)] = i % 5
    lo, hi = min(n for n, _ in pfx), max(n + (1 << (bits - l)) for n, l in pfx)
    hi = min(hi, lo + 9000)
    t = f"net {'bigint' if space is V4 else V6.ddl}, len int, asn bigint"
    df = spark.createDataFrame([((n if space is V4 else addr6(n)), l, a) for (n, l), a in pfx.items()], t)
    got = {}
    for a, b, asn in back(joins.flatten_prefixes(df, space, ["asn"]), space, "asn"):
        for x in range(a, b + 1):
            got[x] = asn
    for x in range(lo, hi):
        best = max(((l, a) for (n, l), a in pfx.items() if n <= x < n + (1 << (bits - l))), default=(0, None))
        assert got.get(x) == best[1], x


def test_plans_have_no_pairwise_join(spark):
    a = ranges(spark, [(0, 9, 1)], ", asn bigint")
    p = spark.createDataFrame([(5,)], "ip bigint")
    for df in (rg.intersect_ranges(a, a, V4), rg.gaps(a, a, V4), joins.point_in_interval(p, a, V4, ["asn"]), rg.range_join(a, a, V4)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
