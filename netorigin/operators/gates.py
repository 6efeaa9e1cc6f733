"""Data-quality gates: each returns a status or violation table; nothing raises here."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netorigin.functions import vocab
from netorigin.functions.addr import int_to_v4, overlaps, v4_to_int, v6_block, v6_text, v6_to_pair
from netorigin.functions.space import V4
from netorigin.operators.lineage import cut
from netorigin.operators.joins import resolve_points
from netorigin.operators.scan import scan


def parse_budget(counts: DataFrame) -> DataFrame:
    """counts(feed, kind, good, bad) -> ok; kind: origin | cidr | metadata."""
    ok = (
        F.when(F.col("kind") == "origin", F.col("bad") <= F.floor(F.col("good") / 1000))
        .when(F.col("kind") == "cidr", F.col("bad") <= vocab.CIDR_ERROR_LIMIT)
        .when(F.col("kind") == "metadata", F.col("good") >= vocab.METADATA_FLOOR))
    return counts.withColumn("ok", ok)


def curation_conflicts(lists: DataFrame) -> DataFrame:
    """ASNs in the eyeball list and in an infrastructure list."""
    e = F.max(F.col("list") == "eyeball_confirm")
    i = F.max(F.col("list").isin(vocab.INFRA_LISTS))
    return lists.groupBy("asn").agg(e.alias("e"), i.alias("i")).filter("e and i").select("asn")


def reference_coverage(meta: DataFrame, reference: DataFrame, floor: float = vocab.COVERAGE_FLOOR,
                       hosting_floor: int = vocab.HOSTING_FLOOR) -> DataFrame:
    """Share of the reference ASNs that metadata calls hosting, with both floors."""
    h = meta.filter("category = 'hosting'").select("asn").distinct().withColumn("h", F.lit(True))
    r = reference.select("asn").distinct().withColumn("r", F.lit(True))
    t = h.join(r, "asn", "full").agg(
        F.count_if("h").alias("hosting_asns"), F.count_if("r").alias("reference_asns"),
        F.count_if(F.col("h") & F.col("r")).alias("covered"))
    cov = F.when(F.col("reference_asns") > 0, F.round(F.col("covered") / F.col("reference_asns"), 4)).otherwise(F.lit(0.0))
    return t.select("hosting_asns", "reference_asns", cov.alias("coverage"), (cov >= floor).alias("coverage_ok"),
                    (F.col("hosting_asns") >= hosting_floor).alias("hosting_ok"))


def uncovered_reference(meta: DataFrame, reference: DataFrame) -> DataFrame:
    h = meta.filter("category = 'hosting'").select("asn").distinct()
    return reference.select("asn").distinct().join(h, "asn", "left_anti")


# ---------------------------------------------------------------- drift

def metric_state(now: DataFrame, history: DataFrame) -> DataFrame:
    """One row per metric: now, prev and the newest pins.

    now(metric, value); history(metric, kind, label, value, at) with kind
    `previous` or `pin`.  A metric known to any side takes part, so one that
    vanished reads as 0.  Pin labels sort like their dates.
    """
    n = now.select("metric", F.col("value").alias("now"))
    prev = history.filter("kind = 'previous'").groupBy("metric").agg(F.max("value").alias("prev"))
    w = Window.partitionBy("metric").orderBy(F.col("label").desc())
    newest = history.filter("kind = 'pin'").withColumn("r", F.row_number().over(w)).filter(F.col("r") <= vocab.PINS_CONSULTED)
    pins = newest.groupBy("metric").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("r", "label", "value", "at"))),
        lambda p: F.struct(p["label"].alias("label"), p["value"].alias("value"), p["at"].alias("at"))).alias("pins"))
    return n.join(prev, "metric", "full").join(pins, "metric", "full").select(
        "metric", F.coalesce("now", F.lit(0)).cast("bigint").alias("now"), F.coalesce("prev", F.lit(0)).cast("bigint").alias("prev"),
        F.filter(F.coalesce("pins", F.array().cast("array<struct<label:string,value:bigint,at:string>>")),
                 lambda p: p["value"] > 0).alias("pins"))


def _policy(pol: tuple[float, float, float, float]) -> dict[str, Column]:
    return dict(zip(("warn", "drop", "rise", "band"), (F.lit(x) for x in pol)))


def drift(state: DataFrame, policy: tuple[float, float, float, float], acks: DataFrame | None = None,
          reviewed: DataFrame | None = None) -> DataFrame:
    """Gate status per metric from metric_state rows.

    acks(metric, reason); reviewed(metric, rvalue, reviewed_at).  Output: metric,
    now, prev, prev_label, drift, status (skipped | pass | warn | recovery | acked |
    fail), baseline, slide, slide_from, review_in_effect.

    A metric's pins are a short array (two pins), so the rules are array
    expressions on one row per metric.
    """
    p = _policy(policy)
    s = state
    if reviewed is not None:
        s = s.join(reviewed.select("metric", "rvalue", "reviewed_at"), "metric", "left")
    else:
        s = s.withColumns({"rvalue": F.lit(None).cast("bigint"), "reviewed_at": F.lit(None).cast("string")})
    if acks is not None:
        s = s.join(acks.select("metric", F.nullif(F.trim("reason"), F.lit("")).alias("ack")), "metric", "left")
    else:
        s = s.withColumn("ack", F.lit(None).cast("string"))

    since = F.try_to_timestamp("reviewed_at")
    usable = F.coalesce(F.col("rvalue") > 0, F.lit(False)) & since.isNotNull()
    # A pin without a date cannot prove that it postdates the review.
    newer = F.filter("pins", lambda b: F.coalesce(F.try_to_timestamp(b["at"]) > since, F.lit(False)))
    stand_in = F.array(F.struct(F.concat(F.lit("reviewed "), F.substring("reviewed_at", 1, 10)).alias("label"),
                                F.col("rvalue").alias("value"), F.col("reviewed_at").alias("at")))
    s = s.withColumns({"_newer": newer, "_usable": usable})
    s = s.withColumns({
        "_in_effect": F.col("_usable") & ((F.size("_newer") == 0) | (F.size("_newer") < F.size("pins"))),
        "_pins": F.when(~F.col("_usable"), F.col("pins")).when(F.size("_newer") == 0, stand_in).otherwise(F.col("_newer"))})
    s = s.withColumn("_best", F.array_max(F.transform("_pins", lambda b: b["value"])))
    lend = (F.col("prev") == 0) & (F.size("_pins") > 0)
    s = s.withColumn("_lend", lend)
    s = s.withColumns({
        "_prev": F.when(F.col("_lend"), F.col("_pins")[0]["value"]).otherwise(F.col("prev")),
        "prev_label": F.when(F.col("_lend"), F.concat(F.lit("pin "), F.col("_pins")[0]["label"])).otherwise(F.lit("previous build")),
        "_rest": F.when(F.col("_lend"), F.slice("_pins", F.lit(2), F.size("_pins"))).otherwise(F.col("_pins"))})
    s = s.withColumn("drift", F.when(F.col("_prev") > 0, (F.col("now") - F.col("_prev")) / F.col("_prev")))
    d = F.col("drift")
    line = F.when(d < 0, p["drop"]).otherwise(p["rise"])
    off = lambda v, ref: F.abs((v - ref) / ref)
    healthy = F.filter("_rest", lambda b: off(b["value"], F.col("_best")) <= p["band"])
    near = F.array_min(F.transform(healthy, lambda b: F.struct(
        off(F.col("now"), b["value"]).alias("off"), b["label"].alias("label"), b["value"].alias("value"))))
    s = s.withColumn("_near", near)
    rescued = F.coalesce(F.col("_near.off") <= p["band"], F.lit(False))
    first = (
        F.when(d.isNull(), "skipped").when(F.abs(d) <= p["warn"], "pass").when(F.abs(d) <= line, "warn")
        .when(rescued, "recovery").when(F.col("ack").isNotNull(), "acked").otherwise("fail"))
    slide = F.coalesce(d.isNotNull() & ((F.col("now") - F.col("_best")) / F.col("_best") < -p["drop"]), F.lit(False))
    s = s.withColumns({"_first": first, "slide": slide})
    return s.select(
        "metric", "now", F.col("_prev").alias("prev"), F.when(d.isNotNull(), F.col("prev_label")).alias("prev_label"), "drift",
        F.when(F.col("slide") & (F.col("_first") == "pass"), "warn").otherwise(F.col("_first")).alias("status"),
        F.when(F.col("_first") == "recovery", F.col("_near.label")).alias("baseline"), "slide",
        F.when(F.col("slide"), F.col("_best")).alias("slide_from"), F.col("_in_effect").alias("review_in_effect"))


def run_ledger(results: DataFrame, build_id: str, reanchor: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(events, summary): every non-clean outcome, and whether a pin may be cut.

    A metric that was acked and named in `reanchor` gets its value recorded as a
    reviewed baseline.
    """
    ev = results.filter(F.col("status").isin("warn", "recovery", "acked", "fail")).select(
        F.lit(build_id).alias("build_id"), "metric", "status", "now", "prev", "drift", "slide")
    if reanchor is not None:
        r = reanchor.select("metric").distinct().withColumn("_r", F.lit(True))
        ev = ev.join(r, "metric", "left").withColumn(
            "reanchored", F.coalesce("_r", F.lit(False)) & (F.col("status") == "acked")).drop("_r")
    else:
        ev = ev.withColumn("reanchored", F.lit(False))
    clean = results.agg(F.lit(build_id).alias("build_id"), F.count("*").alias("metrics"),
                        F.coalesce(F.bool_and(F.col("status").isin("pass", "skipped")), F.lit(True)).alias("clean"),
                        F.count_if(F.col("status") == "fail").alias("failed"))
    return ev, clean


def carried_reviews(results: DataFrame, reviewed: DataFrame, build_at: str, reanchor: DataFrame) -> DataFrame:
    """(metric, rvalue, reviewed_at) for the next build.

    A review that was in effect is carried, one that newer pins have replaced is retired.  An acked metric that `reanchor` names gets the value just
    accepted, in place of an older review; an ack alone changes nothing.
    """
    new = results.filter("status = 'acked'").join(reanchor.select("metric").distinct(), "metric", "left_semi").select(
        "metric", F.col("now").alias("rvalue"), F.lit(build_at).alias("reviewed_at"))
    kept = reviewed.select("metric", "rvalue", "reviewed_at").join(results.filter("review_in_effect").select("metric"), "metric", "left_semi")
    return kept.join(new, "metric", "left_anti").unionByName(new)


def ledger_fold(builds: list[tuple[str, DataFrame, DataFrame, DataFrame]], policy: tuple[float, float, float, float], reviewed: DataFrame) -> DataFrame:
    """Builds in order, each (time, state, acks, reanchor) -> (build_at, metric, now, status, slide, rvalue): every outcome, and the review that stands after it.

    Each build is judged with the reviews that the ones before it left.  The state handed on is one row a metric, checkpointed, so the plan of the last build
    does not hold those of the others.
    """
    out = []
    for at, state, acks, reanchor in builds:
        results = cut(drift(state, policy, acks, reviewed))
        reviewed = cut(carried_reviews(results, reviewed, at, reanchor))
        out.append(results.select(F.lit(at).alias("build_at"), "metric", "now", "status", "slide").join(reviewed.select("metric", "rvalue"), "metric", "left"))
    return reduce(lambda a, b: a.unionByName(b), out)


def forecast(state: DataFrame, policy: tuple[float, float, float, float], floors: DataFrame, build_age_hours: float) -> DataFrame:
    """Would a healthy value pass tonight?  (metric, problem).

    floors(metric, floor).  The healthy value is the best pin (else the published
    one); it is tried with and without the pins.
    """
    best = F.greatest(F.array_max(F.transform("pins", lambda b: b["value"])), F.lit(0))
    pub = state.withColumns({"published": F.col("now"), "best": F.coalesce(best, F.lit(0))})
    healthy = F.when(F.col("best") > 0, F.col("best")).otherwise(F.col("published"))
    none = F.array().cast("array<struct<label:string,value:bigint,at:string>>")
    tonight = pub.select("metric", healthy.cast("bigint").alias("now"), F.col("published").alias("prev"), "pins")
    with_pins = drift(tonight, policy).select("metric", (F.col("status") == "fail").alias("f"))
    without = drift(tonight.withColumn("pins", none), policy).select("metric", (F.col("status") == "fail").alias("g"))
    sliding = drift(pub.select("metric", "now", F.col("now").alias("prev"), "pins"), policy).select("metric", "slide")
    j = pub.select("metric", "published").join(with_pins, "metric").join(without, "metric").join(sliding, "metric").join(floors, "metric", "left")
    problems = F.array_compact(F.array(
        F.when(F.col("f"), F.lit("healthy_value_would_fail")),
        F.when(~F.col("f") & F.col("g"), F.lit("only_pins_would_rescue")),
        F.when(F.col("published") < F.col("floor"), F.lit("below_floor")),
        F.when(F.col("slide"), F.lit("sliding")),
        F.when(F.lit(build_age_hours > vocab.STALE_HOURS), F.lit("stale"))))
    return j.select("metric", F.explode(problems).alias("problem"))


# ---------------------------------------------------------------- lookups

def sentinel_violations(table: DataFrame, expected: DataFrame, value: str) -> DataFrame:
    """expected(asn, pattern): the known ASN is absent or its value does not match."""
    j = expected.join(table.select("asn", F.col(value).alias("_v")), "asn", "left")
    return j.filter(~F.coalesce(F.rlike(F.col("_v"), F.col("pattern")), F.lit(False))).select("asn", "pattern", F.col("_v").alias("found"))


def refind_probes(rows: DataFrame, space=V4) -> DataFrame:
    """Start, end and midpoint of each row: (ip, want_start)."""
    s, e = F.col("range_start"), F.col("range_end")
    return rows.select(F.explode(F.array(s, e, space.midpoint(s, e))).alias("ip"), s.alias("want_start"))


def refind_mismatches(rows: DataFrame, table: DataFrame, space=V4) -> DataFrame:
    """Probes that do not come back to exactly their own row."""
    probes = refind_probes(rows, space)
    hit = resolve_points(probes, table, space, [])
    return probes.join(hit, "ip", "left").filter(~F.col("want_start").eqNullSafe(F.col("range_start"))).select("ip", "want_start")


def panel_failures(panel: DataFrame, verdicts: DataFrame) -> DataFrame:
    """panel(ip, want_verdict, want_rule?, want_asn?) against lookup output."""
    differs = lambda want, got: F.col(want).isNotNull() & ~F.col(want).eqNullSafe(F.col(got))
    j = panel.join(verdicts, "ip", "left")
    return j.filter(differs("want_verdict", "verdict") | differs("want_rule", "rule") | differs("want_asn", "asn"))


def interval_violations(intervals: DataFrame, payload: list[str], space=V4) -> DataFrame:
    """(violation, n): inverted, overlapping, or touching neighbours with equal payload."""
    d = intervals.groupBy(F.col("range_start").alias("pos")).agg(
        F.max_by(F.struct("range_end", F.struct(*payload).alias("pl")), "range_end").alias("row"), F.count("*").alias("n"))
    s = scan(d.withColumn("range_end", F.col("row.range_end")), space, prevs=("row",), maxes=("range_end",))
    touching = F.coalesce(space.succ(F.col("prev_row.range_end")) == F.col("pos"), F.lit(False)) & F.col("prev_row.pl").eqNullSafe(F.col("row.pl"))
    overlap = F.coalesce(F.col("top_range_end") >= F.col("pos"), F.lit(False))
    t = s.agg(F.count_if(F.col("range_end") < F.col("pos")).alias("a"),
              F.coalesce(F.sum(F.col("n") - 1 + F.when(overlap, 1).otherwise(0)), F.lit(0)).cast("bigint").alias("b"),
              F.count_if(touching).alias("c"))
    return t.select(F.explode(F.array(*[F.struct(F.lit(n).alias("violation"), F.col(c).alias("n")) for n, c in
                                        (("inverted", "a"), ("overlap", "b"), ("not_coalesced", "c"))])).alias("e")).select("e.*")


def address_text_violations(rows: DataFrame) -> DataFrame:
    """rows(ip_version, text, v4, v6): text that does not parse to its number, is not
    lowercase, holds a dotted quad in IPv6 or a leading zero in an octet."""
    four = F.col("ip_version") == 4
    wrong = F.when(four, ~v4_to_int(F.col("text")).eqNullSafe(F.col("v4"))).otherwise(~v6_to_pair(F.col("text")).eqNullSafe(F.col("v6")))
    canonical = F.when(four, int_to_v4(F.col("v4"))).otherwise(v6_text(F.col("v6")))
    reason = (
        F.when(F.col("text") != F.lower("text"), "not_lowercase").when(~four & F.col("text").contains("."), "dotted_ipv6")
        .when(four & F.col("text").rlike(r"(^|\.)0\d"), "leading_zero").when(wrong, "wrong_address")
        .when(F.col("text") != canonical, "not_canonical"))
    return rows.withColumn("reason", reason).filter("reason is not null")


def probe_sweep(intervals: DataFrame, space=V4) -> DataFrame:
    """Both ends and an interior address must hit their row; both sides of every gap
    must miss.  (kind, probes, failures) over all intervals."""
    s = scan(intervals.select(F.col("range_start").alias("pos"), "range_end"), space, prevs=("range_end",), nexts=True)
    before, after = space.pred(F.col("pos")), space.succ(F.col("range_end"))
    p = lambda ip, kind, want: F.struct(ip.alias("ip"), F.lit(kind).alias("kind"), want.alias("want"))
    none = F.when(F.lit(False), F.col("pos"))
    gap_before = F.coalesce(F.col("prev_range_end") < before, F.lit(True)) & (before.isNotNull())
    if space.version == 4:
        gap_before = gap_before & (F.col("pos") > 0)
    gap_after = F.coalesce(F.col("next_pos") > after, F.lit(True)) & after.isNotNull() & (F.col("range_end") < space.max())
    probes = s.select(F.explode(F.array_compact(F.array(
        p(F.col("pos"), "hit", F.col("pos")), p(F.col("range_end"), "hit", F.col("pos")),
        p(space.midpoint(F.col("pos"), F.col("range_end")), "hit", F.col("pos")),
        F.when(gap_before, p(before, "miss", none)), F.when(gap_after, p(after, "miss", none))))).alias("e")).select("e.*")
    got = resolve_points(probes, intervals, space, [])
    j = probes.join(got, "ip", "left")
    return j.groupBy("kind").agg(F.count("*").alias("probes"), F.count_if(~F.col("want").eqNullSafe(F.col("range_start"))).alias("failures"))


def tiling(pieces: DataFrame, intervals: DataFrame) -> DataFrame:
    """IPv4 prefixes of each record must cover it exactly: (records, pieces, covered, violations).

    pieces(range_start, range_end, net, len).  Pieces inside the record, distinct
    in start, and adding up to its size cover it exactly once they are disjoint;
    disjointness is checked along the whole line.
    """
    last = V4.last(F.col("net"), F.col("len"))
    p = pieces.withColumn("last", last)
    per = p.groupBy("range_start", "range_end").agg(
        F.sum(F.col("last") - F.col("net") + 1).alias("covered"), F.min("net").alias("lo"), F.max("last").alias("hi"),
        F.count("*").alias("pieces"))
    j = intervals.select("range_start", "range_end").join(per, ["range_start", "range_end"], "left")
    bad = ~F.coalesce((F.col("covered") == F.col("range_end") - F.col("range_start") + 1) & (F.col("lo") == F.col("range_start"))
                      & (F.col("hi") == F.col("range_end")), F.lit(False))
    line = scan(p.groupBy(F.col("net").alias("pos")).agg(F.max("last").alias("last"), F.count("*").alias("n")), V4, maxes=("last",))
    over = line.agg(F.coalesce(F.sum(F.col("n") - 1 + F.when(F.coalesce(F.col("top_last") >= F.col("pos"), F.lit(False)), 1).otherwise(0)),
                               F.lit(0)).cast("bigint").alias("overlaps")).withColumn("k", F.lit(1))
    t = j.agg(F.count("*").alias("records"), F.sum("pieces").alias("pieces"), F.sum("covered").alias("covered"),
              F.count_if(bad).alias("broken")).withColumn("k", F.lit(1))
    return t.join(over, "k").drop("k")


def exact_tiling(pieces: DataFrame, records: DataFrame, space) -> DataFrame:
    """Do the prefixes of each record cover it exactly once?  One row: records, pieces, covered, uncovered, outside, overlaps, orphans.

    pieces(range_start, range_end, net, len) name their record by its bounds; `records` are distinct ranges.  `uncovered` counts records with a missing piece,
    `outside` pieces that leave their record, `overlaps` pieces that begin inside or on another one of the whole table, `orphans` pieces without a
    record.  All sizes are exact, in IPv6 as decimals.  Every piece is dealt out once, to its record; where records or their pieces reach into each other, their
    pieces are looked at along the line as well, so a fault anywhere is found.
    """
    keys = ["range_start", "range_end"]
    zero = F.lit(0).cast("bigint")
    # The pieces of one record along its own line.
    own = Window.partitionBy(*keys).orderBy("net", "len")
    before = lambda c: F.lag(c).over(own)
    p = pieces.select(*keys, "net", "len").withColumns({"again": before(F.struct("net", "len")), "last": space.last(F.col("net"), F.col("len"))})
    p = p.withColumn("reach", F.max("last").over(own.rowsBetween(Window.unboundedPreceding, -1)))
    place = F.col("again").isNotNull() & F.col("again.net").eqNullSafe(F.col("net"))
    first = ~(place & F.col("again.len").eqNullSafe(F.col("len")))
    inside = (F.col("net") >= F.col("range_start")) & (F.col("last") <= F.col("range_end"))
    per = cut(p.groupBy(*keys).agg(
        F.sum(F.when(first & inside, space.size(F.col("net"), F.col("last")))).alias("covered"), F.count_if(first & ~inside).alias("outside"),
        F.count_if(first).alias("pieces"), F.count_if(place | F.coalesce(F.col("reach") >= F.col("net"), F.lit(False))).alias("overlaps"),
        F.min("net").alias("pos"), F.max("last").alias("end")))
    # Pieces of two records can only meet where the stretches of both do; there all pieces are laid along one line.
    line = scan(per.groupBy("pos").agg(F.max("end").alias("end"), F.count("*").alias("n")), space, maxes=("end",), nexts=True)
    meets = (F.col("n") > 1) | F.coalesce(F.col("top_end") >= F.col("pos"), F.lit(False)) | F.coalesce(F.col("next_pos") <= F.col("end"), F.lit(False))
    crowded = cut(line.filter(meets).select("pos"))
    apart = F.col("pos").eqNullSafe(F.col("_pos"))
    over = per.join(crowded.withColumnRenamed("pos", "_pos"), apart, "left_anti").select(F.col("overlaps").alias("k"))
    if not crowded.isEmpty():
        near = per.join(crowded.withColumnRenamed("pos", "_pos"), apart, "left_semi").select(*[F.col(c).alias(f"_{c}") for c in keys])
        q = pieces.join(near, F.col("range_start").eqNullSafe(F.col("_range_start")) & F.col("range_end").eqNullSafe(F.col("_range_end")), "left_semi").select(
            F.col("net").alias("pos"), space.last(F.col("net"), F.col("len")).alias("reach"))
        q = scan(q.groupBy("pos").agg(F.max("reach").alias("reach"), F.count("*").alias("n")), space, maxes=("reach",))
        over = over.unionByName(q.select((F.col("n") - 1 + F.when(F.coalesce(F.col("top_reach") >= F.col("pos"), F.lit(False)), 1).otherwise(0)).alias("k")))
    over = over.agg(F.coalesce(F.sum("k"), zero).cast("bigint").alias("overlaps"))
    r = records.select("range_start", "range_end", F.lit(True).alias("known"))
    j = r.join(per.drop("overlaps", "pos", "end"), keys, "full")
    short = F.col("known") & ~F.coalesce(F.col("covered") == space.size(F.col("range_start"), F.col("range_end")), F.lit(False))
    total = j.agg(F.count("known").alias("records"), F.coalesce(F.sum("pieces"), zero).alias("pieces"), F.coalesce(F.sum("covered").cast("decimal(38,0)"), zero).cast("decimal(38,0)").alias("covered"),
                  F.count_if(short).alias("uncovered"), F.coalesce(F.sum("outside"), zero).alias("outside"),
                  F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("pieces"))), zero).alias("orphans"))
    return total.join(F.broadcast(over)).select("records", "pieces", "covered", "uncovered", "outside", "overlaps", "orphans")


def mapped_collisions(intervals6: DataFrame) -> DataFrame:
    """IPv6 rows that touch ::/96 or ::ffff:0:0/96; both counts must be 0."""
    s, e = F.col("range_start"), F.col("range_end")
    return intervals6.agg(F.count_if(overlaps(s, e, *v6_block("::", 96))).alias("compatible"),
                          F.count_if(overlaps(s, e, *v6_block("::ffff:0:0", 96))).alias("mapped"))


def vocabulary_coverage(intervals: DataFrame) -> DataFrame:
    """(field, value, problem): declared values that never occur and values that are not declared."""
    fields = {"core_verdict": vocab.VERDICTS, "category": list(vocab.CATEGORY_CODES), "network_role": list(vocab.ROLE_CODES)}
    seen = intervals.select(F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields])).alias("e")).select("e.*").filter(
        "value is not null").groupBy("field", "value").agg(F.count("*").alias("n"))
    spark = intervals.sparkSession
    want = spark.createDataFrame([(f, v, True) for f, vs in fields.items() for v in vs], "field string, value string, declared boolean")
    return seen.join(want, ["field", "value"], "full").select(
        "field", "value", F.when(F.col("n").isNull(), "missing").when(F.col("declared").isNull(), "unknown").alias("problem")
    ).filter("problem is not null")


def snapshot_violations(snapshots: DataFrame, rows: DataFrame) -> DataFrame:
    """snapshots(family, build_ts, row_count) against rows(family): differing build
    timestamps and counts that do not match."""
    n = rows.groupBy("family").agg(F.count("*").alias("actual"))
    ts = snapshots.agg((F.min("build_ts") != F.max("build_ts")).alias("mixed"))
    counts = snapshots.join(n, "family", "full").filter(~F.col("row_count").eqNullSafe(F.col("actual"))).select(
        F.concat(F.lit("row_count:"), "family").alias("violation"))
    return counts.unionByName(ts.filter("mixed").select(F.lit("build_ts_differs").alias("violation")))


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """(metric, value) rows of a build, one per layer."""
    return reduce(lambda a, b: a.unionByName(b), [
        df.agg(F.lit(name).alias("metric"), F.count("*").alias("value")) for name, df in layers.items()])
