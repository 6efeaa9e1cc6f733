"""Routing, gates, entities, parsers, sinks, samples and streaming on literal tables."""

import gzip
import json

from pyspark.sql import functions as F

from netorigin.functions.space import V4
from netorigin.operators import backbone, compare, entities, evaluate, gates, registry, sampling, sets
from netorigin.sources import parse, read, sinks
from netorigin.streaming import lookup as sl, resume
from test_profile import S, layers
from netorigin.operators import classify, project


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


# ---------------------------------------------------------------- routing
def test_path_origin(spark):
    cases = [("[(2,[1,2,3])]", 3, 2), ("[(2,[1,2,2])]", 2, 1), ("[(2,[1,2]),(1,[5])]", 5, 2), ("[(2,[1,2]),(1,[5,6])]", -1, 2),
             ("[(2,[1,2]),(1,[5,5])]", 5, 2), ("[(2,[1,2]),(3,[9])]", 2, 1), ("[]", 77, None), ("[(2,[1]),(1,[4,5]),(2,[6])]", 6, -1)]
    data = [(i, [(t, list(a)) for t, a in eval(c)], o, u) for i, (c, o, u) in enumerate(cases)]
    df = spark.createDataFrame(data, "i int, seg array<struct<type:int,asns:array<bigint>>>, o bigint, u bigint")
    for r in df.select("i", "o", "u", backbone.path_origin(F.col("seg"), F.lit(77).cast("bigint")).alias("g")).collect():
        assert (r.g.origin, r.g.upstream) == (r.o, r.u), cases[r.i]


def test_prefix_decisions(spark):
    n = lambda i: 16777216 + i * 65536
    e = [(n(0), 16, 300, p) for p in (1, 2, 3)] + [(n(0), 16, 400, p) for p in (4, 5)] + [(n(0), 16, 300, 1)]
    e += [(n(1), 16, 500, 1)] + [(n(2), 16, -1, p) for p in (1, 2)] + [(n(3), 16, 64512, 1)] + [(n(4), 16, 9, p) for p in (1, 2)] + [(n(4), 16, 8, p) for p in (3, 4)]
    e += [(167772160, 16, 300, 1), (0, 0, 300, 1), (n(5), 25, 300, 1)]
    d = backbone.prefix_decisions(spark.createDataFrame(e, "net bigint, len int, origin bigint, peer_as bigint"))
    got = {(r.net, r.len): (r.origin, r.origin_vis, r.total_vis, r.moas, r.tie, r.minority, r.reason) for r in d.collect()}
    assert got == {
        (n(0), 16): (300, 3, 5, True, False, False, None), (n(1), 16): (500, 1, 1, False, False, False, "below_min_peers"),
        (n(2), 16): (None, 0, 2, False, False, False, "as_set_only"), (n(3), 16): (None, 0, 0, False, False, False, "no_usable_origin"),
        (n(4), 16): (8, 2, 4, True, True, False, None)}


def test_compare_with_itself(spark):
    base = layers(spark)[0]
    a = compare.agreement(compare.align(base, base)).first()
    assert (a.agreement, a.b_covers_of_a, a.a_covers_of_b, a.both_covered) == (1.0, 1.0, 1.0, 30)


# ---------------------------------------------------------------- gates
def drift(spark, now, prev, pins=(), policy=(0.05, 0.10, 0.20, 0.05), ack=None, reviewed=None):
    n = spark.createDataFrame([("m", now)], "metric string, value bigint")
    h = [("m", "previous", "latest", prev, None)] if prev is not None else []
    h += [("m", "pin", f"v2026.08.{23 - i:02d}", v, at) for i, (v, at) in enumerate(pins)]
    h = spark.createDataFrame(h, "metric string, kind string, label string, value bigint, at string")
    acks = spark.createDataFrame([("m", ack)], "metric string, reason string") if ack else None
    rev = spark.createDataFrame([("m", *reviewed)], "metric string, rvalue bigint, reviewed_at string") if reviewed else None
    return gates.drift(gates.metric_state(n, h), policy, acks, rev).first()


def test_drift_statuses(spark):
    at = "2026-08-23T00:00:00Z"
    assert drift(spark, 100, None).status == "skipped"
    assert drift(spark, 105, 100).status == "pass" and drift(spark, 95, 100).status == "pass"
    assert drift(spark, 94, 100).status == "warn" and drift(spark, 89, 100).status == "fail"
    assert drift(spark, 120, 100).status == "warn" and drift(spark, 121, 100).status == "fail"
    assert drift(spark, None, 100).status == "fail"  # a vanished metric reads as zero
    assert drift(spark, 89, 100, ack="known").status == "acked" and drift(spark, 89, 100, ack="  ").status == "fail"
    # Snap back to the pinned level passes; a drop to a degraded pin does not.
    assert drift(spark, 12400, 9000, [(12393, at)]).status == "recovery"
    r = drift(spark, 11150, 12400, [(11300, at), (12393, at)])
    assert r.status == "fail" and r.slide
    # No previous build: the newest pin stands in.
    r = drift(spark, 100, None, [(101, at), (90, at)])
    assert r.status == "pass" and r.prev == 101 and r.prev_label.startswith("pin ")
    # Slow slide warns although the night was quiet.
    r = drift(spark, 8800, 9000, [(10000, at)])
    assert r.status == "warn" and r.slide and r.slide_from == 10000


def test_reviewed_baseline(spark):
    old, new = "2026-08-01T00:00:00Z", "2026-09-10T00:00:00Z"
    r = drift(spark, 8800, 8800, [(10000, old)], reviewed=(8800, "2026-09-01T00:00:00Z"))
    assert r.status == "pass" and not r.slide and r.review_in_effect
    r = drift(spark, 8800, 8800, [(8810, new), (10000, old)], reviewed=(8800, "2026-09-01T00:00:00Z"))
    assert r.status == "pass" and r.review_in_effect  # an older pin is still consulted
    r = drift(spark, 8800, 8800, [(8810, new)], reviewed=(8800, "2026-09-01T00:00:00Z"))
    assert not r.review_in_effect
    r = drift(spark, 8800, 8800, [(10000, None)], reviewed=(8800, "2026-09-01T00:00:00Z"))
    assert r.status == "pass"  # an undated pin counts as older


def test_ledger_and_forecast(spark):
    st = gates.metric_state(spark.createDataFrame([("a", 100), ("b", 50)], "metric string, value bigint"), spark.createDataFrame(
        [("a", "previous", "l", 100, None), ("b", "previous", "l", 100, None)], "metric string, kind string, label string, value bigint, at string"))
    d = gates.drift(st, (0.05, 0.1, 0.2, 0.05), spark.createDataFrame([("b", "ok")], "metric string, reason string"))
    ev, clean = gates.run_ledger(d, "b1", spark.createDataFrame([("b",)], "metric string"))
    assert rows(ev, "metric", "status", "reanchored") == [("b", "acked", True)] and clean.first().clean is False
    f = gates.forecast(st, (0.05, 0.1, 0.2, 0.05), spark.createDataFrame([("a", 200)], "metric string, floor int"), 10.0)
    assert rows(f, "metric", "problem") == [("a", "below_floor")]


def test_table_difference(spark):
    a, b = spark.createDataFrame([(1,), (1,), (2,)], "x int"), spark.createDataFrame([(1,), (3,)], "x int")
    assert rows(sets.table_difference(a, b), "side", "n", "x") == [("only_a", 1, 1), ("only_a", 1, 2), ("only_b", 1, 3)]


# ---------------------------------------------------------------- entities and registry
def test_regions(spark):
    items = spark.createDataFrame([("a", "RU", "P17"), ("b", "DE", "P17"), ("c", "CN", "P17"), ("d", "FR", "P17")], "qid string, cc string, via string")
    hits = spark.createDataFrame([("a", "UA"), ("b", "UA"), ("c", "HK"), ("d", "HK"), ("e", "GE"), ("f", "UA"), ("f", "GE")], "qid string, code string")
    got = {r.qid: (r.cc, r.via) for r in entities.refine_regions(items, hits).collect()}
    assert got == {"a": ("UA", "territory"), "b": (None, None), "c": ("HK", "region"), "d": ("FR", "P17"), "e": ("GE", "territory"), "f": (None, None)}


def test_country_precedence(spark):
    c = [("a", "P17", "DE", False), ("a", "P17", "FR", True), ("b", "P17", "DE", False), ("b", "P17", "FR", False), ("b", "P159", "IT", False), ("c", "P159", "US", False)]
    df = spark.createDataFrame([(*x, None) for x in c], "qid string, via string, cc string, preferred boolean, reason string")
    assert rows(entities.country_per_item(df), "qid", "cc", "via", "ambiguous_p17") == [("a", "FR", "P17", False), ("b", "IT", "P159", True), ("c", "US", "P159", False)]


def test_pool_never_gives_siblings(spark):
    reg = spark.createDataFrame([(i, "arin", None, None, "assigned", "h:pool") for i in range(251)] + [(1000 + i, "arin", None, None, "assigned", "h:sib") for i in range(3)],
                                "asn bigint, rir string, cc string, registered string, status string, holder string")
    listed = spark.createDataFrame([(5,), (1000,)], "asn bigint")
    assert rows(registry.sibling_candidates(listed, reg), "asn", "via") == [(1001, [1000]), (1002, [1000])]
    assert {(r.holder, r.kind, r["size"]) for r in registry.cluster_sizes(reg).collect()} == {("h:pool", "pool", 251), ("h:sib", "siblings", 3)}


# ---------------------------------------------------------------- sampling and evaluation
def test_stratified_limit_keeps_every_class(spark):
    g = spark.createDataFrame([(i, "a") for i in range(90)] + [(100 + i, "b") for i in range(9)] + [(200, "c")], "asn bigint, provenance string")
    n = {r[0]: r[1] for r in sampling.stratified_limit(g, 10).groupBy("provenance").count().collect()}
    assert n == {"a": 8, "b": 1, "c": 1}
    assert sampling.stratified_limit(g, 2).count() == 3  # fewer than the classes: one each is kept
    assert rows(sampling.stratified_limit(g, 10), "asn") == rows(sampling.stratified_limit(g.repartition(7), 10), "asn")


def test_scores(spark):
    g = spark.createDataFrame([(1, ["cdn"], ["hosting_provider"], "independent"), (2, ["business"], [], "weak"), (3, ["cdn", "vpn_provider"], [], "pinned"), (4, ["cdn"], [], "pinned")],
                              "asn bigint, labels array<string>, acceptable array<string>, provenance string")
    p = spark.createDataFrame([(1, ["cdn", "hosting_provider"], 0.95), (2, ["cdn"], 0.9), (3, ["cdn"], 0.5)], "asn bigint, labels array<string>, confidence double")
    s = evaluate.scored_rows(g, p)
    assert rows(evaluate.label_scores(s), "label", "tp", "fp", "fn") == [("business", 0, 0, 1), ("cdn", 2, 1, 0), ("vpn_provider", 0, 0, 1)]
    assert rows(evaluate.calibration(s), "bucket", "n", "exact_match") == [("0.0-0.7", 1, 0.0), ("0.9-1.0", 2, 0.5)]
    assert [r.asn for r in evaluate.misses(s).collect()] == [2, 3]


# ---------------------------------------------------------------- sources and sinks
def test_readers(spark, tmp_path):
    def put(name, text):
        p = tmp_path / name
        p.write_bytes(gzip.compress(text.encode()) if name.endswith(".gz") else text.encode())
        return str(p)

    f = put("o.csv", '16777216,16777471,13335,"CLOUD, INC"\n5,1,7,x\n0,0,1,x\n1,2,0,x\n')
    assert rows(parse.good_rows(read.origin_ranges(spark, f)), "range_start", "range_end", "asn") == [(16777216, 16777471, 13335)]
    f = put("p.tsv.gz", "1.0.0.0\t24\t13335_7\n2001:db8::\t32\t5,0\n")
    assert rows(read.prefix_to_as(spark, f), "family", "net4", "len", "asn") == [(4, 16777216, 24, 7), (4, 16777216, 24, 13335), (6, None, 32, 5)]
    f = put("d.txt", "2|arin|20240101|3|x|y|+0000\narin|*|asn|*|3|summary\narin|US|asn|100|2|19700101|assigned|h1\narin|ZZ|ipv4|1|2|3|assigned\nripencc|DE|asn|7|1|20200102|assigned|\n")
    assert rows(read.delegations(spark, f, "arin"), "start", "count", "cc", "date", "violation") == [(7, 1, "DE", "2020-01-02", "foreign_registry"), (100, 2, "US", None, None)]
    f = put("as.json", json.dumps([{"asn": 1, "handle": "A"}, {"asn": 1, "description": "B", "countryCode": "US"}, {"asn": 2, "handle": "C"}]))
    assert rows(read.as_metadata(spark, f), "asn", "description", "country") == [(1, "B", "US"), (2, "C", None)]
    big = put("v6.csv", f"{(1 << 128) - 2},{(1 << 128) - 1},9,x\n{1 << 64},{(1 << 64) + 5},8,x\n{1 << 128},{1 << 128},1,x\n")
    from netorigin.functions.space import V6
    got = rows(parse.good_rows(read.origin_ranges(spark, big, 6)), V6.hex(F.col("range_start")), V6.hex(F.col("range_end")), "asn")
    assert got == [("0" * 15 + "1" + "0" * 16, "0" * 15 + "1" + "0" * 15 + "5", 8), ("f" * 31 + "e", "f" * 32, 9)]
    for m, stats in (("latest", 5), ("v2026.08.23", 4), ("v2026.08.16", 3), ("v2026.08.09", 2)):
        (tmp_path / "m").mkdir(exist_ok=True)
        (tmp_path / "m" / f"{m}.json").write_text(json.dumps({"build_id": m, "stats": {"x": stats}}))
    assert rows(read.metric_history(spark, str(tmp_path / "m")), "kind", "label", "value") == [("pin", "v2026.08.16", 3), ("pin", "v2026.08.23", 4), ("previous", "latest", 5)]


def test_sinks_round_trip(spark, tmp_path):
    base, vpn, dc, names = layers(spark)
    names = names.withColumn("name", F.when(F.col("asn") == 200, 'Quo"ted, Inc').otherwise(F.col("name")))
    wire = project.to_wire(project.intervals(base, vpn, dc, names))
    sinks.write_interval_json(wire, str(tmp_path / "j"))
    back = read.interval_records(spark, str(tmp_path / "j"))
    assert back.filter("violation is not null").count() == 0 and back.count() == 10
    sinks.write_csv(wire, str(tmp_path / "c"))
    text = [l for l in spark.read.text(str(tmp_path / "c")).collect()]
    lines = sorted({l.value for l in text} - {",".join(sinks.CSV_HEADER)})
    assert lines == sorted(r.value for r in sinks.csv_lines(wire).collect())
    assert '4,1.0.0.10,1.0.0.12,200,"Quo""ted, Inc",hosting,stub,0,0,0,0,0,0,1,1,vpn,x4b_vpn' in lines
    sinks.write_lookup(base, str(tmp_path / "l"))
    assert sinks.read_lookup(spark, str(tmp_path / "l")).count() == 3
    # Tampered records are refused.
    good = sinks.interval_json(wire).first().value
    bad = [good.replace('"ip_version":4', '"ip_version":5'), good.replace("true", "null", 1) if "true" in good else good.replace("false", "null", 1), good[:-1] + ',"x":1}', good.replace('"start_hex":"0', '"start_hex":"A'), "{"]
    assert all(r.violation for r in parse.interval_records(spark.createDataFrame([(b,) for b in bad], "value string")).collect())


# ---------------------------------------------------------------- streaming
def test_stream_equals_batch(spark, tmp_path):
    base, vpn, dc, _ = layers(spark)
    table = classify.lookup_table(base, vpn, dc)
    ips = spark.createDataFrame([(S + x,) for x in range(-2, 60)] * 2, "ip bigint")
    ips.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("ip bigint").parquet(str(tmp_path / "in"))
    q = sl.stream_verdicts(stream, table).writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    want = classify.classify_points(ips, table)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, got.select("ip", "verdict", "rule", "asn").collect())) == sorted(map(key, want.select("ip", "verdict", "rule", "asn").collect()))


def test_resume_is_idempotent(spark, tmp_path):
    run = resume.process_batch(lambda b: b, str(tmp_path / "done"))
    batch = lambda *a: spark.createDataFrame([(x,) for x in a], "asn bigint")
    run(batch(1, 2, 2), 0)
    run(batch(2, 3), 1)
    run(batch(2, 3), 1)  # a replay after a failure
    assert rows(spark.read.parquet(str(tmp_path / "done")), "asn", "batch") == [(1, 0), (2, 0), (3, 1)]
