"""Gold rows, prediction contract and classifier scores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netorigin.functions import vocab
from netorigin.functions.space import V4
from netorigin.operators.quant import announced
from netorigin.operators.ranges import overlay_share
from netorigin.operators.sampling import per_class_sample


def scored_rows(gold: DataFrame, preds: DataFrame, subset: str = "all") -> DataFrame:
    """gold(asn, labels, acceptable, provenance) with preds(asn, labels, confidence);
    an ASN without a prediction is left out."""
    g = gold if subset == "all" else gold.filter("provenance <> 'weak'")
    allowed = F.array_union("labels", "acceptable")
    exact = (F.size(F.array_except("labels", "pred")) == 0) & (F.size(F.array_except(F.col("pred"), allowed)) == 0)
    p = preds.select("asn", F.col("labels").alias("pred"), "confidence")
    return g.join(p, "asn").withColumns({"allowed": allowed, "exact": exact})


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, F.round(a / b, 3))


def label_scores(scored: DataFrame) -> DataFrame:
    """Per label: support, tp, fp, fn, precision, recall, f1.

    Each row gives one event per gold label and per wrong label; the vocabulary
    has 15 labels, so the groups are few and combine map-side.
    """
    ev = F.concat(
        F.transform("labels", lambda l: F.struct(l.alias("label"), F.when(F.array_contains(F.col("pred"), l), "tp").otherwise("fn").alias("kind"))),
        F.transform(F.array_except("pred", "allowed"), lambda l: F.struct(l.alias("label"), F.lit("fp").alias("kind"))))
    n = lambda k: F.count_if(F.col("kind") == k)
    t = scored.select(F.explode(ev).alias("e")).select("e.*").groupBy("label").agg(
        n("tp").alias("tp"), n("fp").alias("fp"), n("fn").alias("fn"))
    t = t.withColumns({"precision": _ratio(F.col("tp"), F.col("tp") + F.col("fp")),
                       "recall": _ratio(F.col("tp"), F.col("tp") + F.col("fn"))})
    p, r = F.col("precision"), F.col("recall")
    return t.select("label", (F.col("tp") + F.col("fn")).alias("support"), "tp", "fp", "fn", "precision", "recall",
                    F.when(p + r > 0, F.round(2 * p * r / (p + r), 3)).alias("f1"))


def summary_scores(scored: DataFrame) -> DataFrame:
    """n, exact match share, macro precision and recall, as (metric, value)."""
    head = scored.agg(F.count("*").alias("n"), F.count_if("exact").alias("exact")).withColumn("k", F.lit(1))
    macro = label_scores(scored).agg(F.round(F.avg("precision"), 3).alias("mp"), F.round(F.avg("recall"), 3).alias("mr")).withColumn("k", F.lit(1))
    m = head.join(macro, "k")
    pair = lambda name, v: F.struct(F.lit(name).alias("metric"), v.cast("double").alias("value"))
    return m.select(F.explode(F.array(
        pair("n", F.col("n")), pair("exact_match", _ratio(F.col("exact"), F.col("n"))),
        pair("macro_precision", F.col("mp")), pair("macro_recall", F.col("mr")))).alias("e")).select("e.*")


def calibration(scored: DataFrame) -> DataFrame:
    """Exact-match share by confidence: [0.9,1], [0.7,0.9), [0,0.7)."""
    c = F.col("confidence")
    b = F.when(c >= 0.9, "0.9-1.0").when(c >= 0.7, "0.7-0.9").otherwise("0.0-0.7")
    return scored.groupBy(b.alias("bucket")).agg(F.count("*").alias("n"), _ratio(F.count_if("exact"), F.count("*")).alias("exact_match"))


def arm_delta(gold: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """Summary scores of two prediction sets on the same independent gold."""
    one = lambda p, name: summary_scores(scored_rows(gold, p, "independent")).withColumnRenamed("value", name)
    return one(a, "a").join(one(b, "b"), "metric")


def misses(scored: DataFrame) -> DataFrame:
    return scored.filter("not exact").orderBy(F.col("confidence").desc(), "asn")


def merge_gold(rows: DataFrame) -> DataFrame:
    """One row per ASN: labels and acceptable extras united, sources joined, strongest provenance.

    Labels come from a closed vocabulary of 15 and sources from a short list, so
    the gathered sets are bounded for any number of rows.
    """
    strength = F.lit(None).cast("int")
    for name, s in vocab.PROVENANCE_STRENGTH.items():
        strength = F.when(F.col("provenance") == name, F.lit(s)).otherwise(strength)
    lab = rows.select("asn", F.explode("labels").alias("v")).groupBy("asn").agg(F.array_sort(F.collect_set("v")).alias("labels"))
    acc = rows.select("asn", F.explode("acceptable").alias("v")).groupBy("asn").agg(F.array_sort(F.collect_set("v")).alias("acc"))
    src = rows.groupBy("asn").agg(F.array_join(F.array_sort(F.collect_set("source")), " + ").alias("source"),
                                  F.max_by("provenance", strength).alias("provenance"))
    empty = F.array().cast("array<string>")
    return src.join(lab, "asn", "left").join(acc, "asn", "left").select(
        "asn", F.coalesce("labels", empty).alias("labels"),
        F.array_except(F.coalesce("acc", empty), F.coalesce("labels", empty)).alias("acceptable"), "source", "provenance")


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def _gold(df: DataFrame, labels: Column, acceptable: Column, source: Column, provenance: Column) -> DataFrame:
    return df.select("asn", labels.alias("labels"), acceptable.alias("acceptable"), source.alias("source"), provenance.alias("provenance"))


def gold_from_lists(lists: DataFrame) -> DataFrame:
    lab, acc = F.lit(None), F.lit(None)
    for name, (l, a) in vocab.LIST_GOLD.items():
        lab = F.when(F.col("list") == name, _strings(l)).otherwise(lab)
        acc = F.when(F.col("list") == name, _strings(a)).otherwise(acc)
    return _gold(lists.filter(F.col("list").isin(list(vocab.LIST_GOLD))), lab, acc,
                 F.concat(F.lit("lists/"), "list"), F.lit("independent"))


def gold_from_pins(pins: DataFrame, meta: DataFrame) -> DataFrame:
    """pins(asn, labels, acceptable, guard, source): kept only if the live description matches the guard."""
    j = pins.join(meta.select("asn", "description"), "asn", "left").filter(
        F.rlike(F.coalesce("description", F.lit("")), F.concat(F.lit("(?i)"), "guard")))
    return _gold(j, F.col("labels"), F.col("acceptable"), F.concat(F.lit("pinned: "), "source"), F.lit("pinned"))


def gold_pool(meta: DataFrame, bad_asns: DataFrame, vpn_asns: DataFrame) -> DataFrame:
    """(asn, class) candidates of the sampled classes."""
    cat, role = F.col("category"), F.col("network_role")
    cls = F.when(cat == "education_research", "education").when(cat == "government_admin", "government").when(
        cat == "business", "business").when((cat == "isp") & (role == "access_provider"), "access")
    m = meta.select("asn", cls.alias("class")).filter("class is not null")
    return m.unionByName(bad_asns.select("asn", F.lit("bad_asn").alias("class"))).unionByName(
        vpn_asns.select("asn", F.lit("x4b_vpn").alias("class")))


def gold_from_samples(pool: DataFrame, routed: DataFrame) -> DataFrame:
    """Capped, seeded sample per class among routed ASNs."""
    caps = {k: v[3] for k, v in vocab.SAMPLE_GOLD.items()}
    s = per_class_sample(pool.distinct().join(routed.select("asn").distinct(), "asn", "left_semi"), "class", caps, "asn")
    lab, acc, prov = F.lit(None), F.lit(None), F.lit(None)
    for name, (l, a, p, _) in vocab.SAMPLE_GOLD.items():
        hit = F.col("class") == name
        lab, acc = F.when(hit, _strings(l)).otherwise(lab), F.when(hit, _strings(a)).otherwise(acc)
        prov = F.when(hit, F.lit(p)).otherwise(prov)
    return _gold(s, lab, acc, F.col("class"), prov)


def gold(lists, pins, meta, bad_asns, vpn_asns, routed) -> DataFrame:
    rows = [gold_from_lists(lists), gold_from_pins(pins, meta), gold_from_samples(gold_pool(meta, bad_asns, vpn_asns), routed)]
    return merge_gold(reduce(lambda a, b: a.unionByName(b), rows)).join(routed.select("asn").distinct(), "asn", "left_semi")


def check_predictions(preds: DataFrame, expected: DataFrame) -> DataFrame:
    """preds(asn, labels, action, correction_category, has_correction, confidence,
    evidence, needs_review) against the expected ASNs: adds `reject`, and repairs
    an action that its labels do not support."""
    p = preds.withColumn("_seen", F.lit(True))
    n = preds.groupBy("asn").agg(F.count("*").alias("_n"))
    j = p.join(n, "asn", "left").join(expected.select("asn").distinct().withColumn("_want", F.lit(True)), "asn", "full")
    action = F.coalesce("action", F.lit("none"))
    labels = F.coalesce("labels", F.array().cast("array<string>"))
    c = F.col("confidence")
    reject = (
        F.when(F.col("_seen").isNull(), "missing").when(F.col("_want").isNull(), "foreign").when(F.col("_n") > 1, "duplicate")
        .when(F.size(F.array_except(labels, _strings(vocab.LABELS))) > 0, "unknown_label")
        .when(~action.isin(vocab.ACTIONS), "unknown_action").when(c.isNull(), "confidence_not_a_number")
        .when((c < 0) | (c > 1), "confidence_out_of_range")
        .when(F.coalesce("has_correction", F.lit(False)) & ~F.coalesce(
            F.col("correction_category").isin(vocab.CORRECTION_CATEGORIES), F.lit(False)), "unknown_correction_category"))
    need = F.lit(None).cast("string")
    for a, l in vocab.ACTION_LABEL.items():
        need = F.when(action == a, F.lit(l)).otherwise(need)
    broken = (need.isNotNull() & ~F.array_contains(labels, need)) | (
        (action == "correction") & ~F.coalesce("has_correction", F.lit(False)))
    broken = F.coalesce(broken, F.lit(False))
    return j.select(
        "asn", labels.alias("labels"), F.when(broken, F.lit("none")).otherwise(action).alias("action"),
        F.round(c, 3).alias("confidence"), F.substring(F.coalesce("evidence", F.lit("")), 1, 300).alias("evidence"),
        (F.coalesce("needs_review", F.lit(False)) | broken).alias("needs_review"), reject.alias("reject"))


def packets(asns: DataFrame, meta: DataFrame, base4: DataFrame, base6: DataFrame | None, dc: DataFrame, lists: DataFrame,
            vpn_asns: DataFrame, dc_asns: DataFrame) -> DataFrame:
    """Evidence packet per ASN: the local fields."""
    zero = F.lit(0).cast("bigint")
    mark = lambda df, name: df.select("asn").distinct().withColumn(name, F.lit(True))
    named = lists.filter(F.col("list").isin(vocab.PACKET_LISTS)).groupBy("asn").agg(F.array_sort(F.collect_set("list")).alias("existing_flags"))
    bad = mark(lists.filter("list = 'bad_asn'"), "in_bad_asn_list")
    share = overlay_share(base4, dc, V4).select("asn", "pct")
    f = F.lit(False)
    return (
        asns.select("asn").distinct()
        .join(meta.select("asn", "description", "country", "category", "network_role"), "asn", "left")
        .join(announced(base4, base6), "asn", "left").join(share, "asn", "left").join(bad, "asn", "left")
        .join(mark(vpn_asns, "in_x4b_vpn_asns"), "asn", "left").join(mark(dc_asns, "in_x4b_dc_asns"), "asn", "left")
        .join(named, "asn", "left")
        .select("asn", "description", "country", "category", "network_role",
                F.coalesce("ranges", zero).alias("announced_ipv4_ranges"),
                F.coalesce("addresses", zero).alias("announced_ipv4_addresses"),
                F.coalesce("has_v6", f).alias("announces_ipv6"), F.coalesce("pct", F.lit(0.0)).alias("pct_in_dc_overlay"),
                F.coalesce("in_bad_asn_list", f).alias("in_bad_asn_list"), F.coalesce("in_x4b_vpn_asns", f).alias("in_x4b_vpn_asns"),
                F.coalesce("in_x4b_dc_asns", f).alias("in_x4b_dc_asns"),
                F.coalesce("existing_flags", F.array().cast("array<string>")).alias("existing_flags")))


def external_fields(evidence: DataFrame) -> DataFrame:
    """Flatten cached external sections; a dead section is left out of the JSON,
    `present: false` is kept.  evidence(asn, holder, left, right, uncertain, pdb_present,
    pdb_name, pdb_website, rdap, rdns, site)."""
    def obj(**kv):
        return F.struct(*[v.alias(k) for k, v in kv.items()])

    c = F.col
    neighbours = F.when(c("left").isNotNull(), obj(left=c("left"), right=c("right"), uncertain=c("uncertain")))
    pdb = F.when(c("pdb_present"), obj(present=F.lit(None).cast("boolean"), name=c("pdb_name"), website=c("pdb_website"))).when(
        ~c("pdb_present"), obj(present=F.lit(False), name=F.lit(None).cast("string"), website=F.lit(None).cast("string")))
    keep = lambda m: F.when(F.size(m) > 0, m)
    return evidence.select("asn", F.to_json(obj(
        holder=c("holder"), bgp_neighbours=neighbours, peeringdb=pdb, rdap=keep(c("rdap")), rdns_samples=keep(c("rdns")),
        website=c("site"))).alias("packet"))
