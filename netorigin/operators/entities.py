"""Names and countries of networks from public item claims and curated lists."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netorigin.functions import text as tx
from netorigin.functions import vocab


def item_id(uri: Column) -> Column:
    return F.element_at(F.split(uri, "/"), -1)


def name_claims(bindings: DataFrame) -> DataFrame:
    """bindings(item, asn, rank, ended, en, mul, refs) -> claims with the drop reason (null = admitted)."""
    asn = tx.parse_asn(F.col("asn"))
    return bindings.select(
        item_id(F.col("item")).alias("qid"), asn.alias("asn"),
        tx.clean_label(F.coalesce("en", "mul")).alias("label"),
        F.when(F.coalesce("rank", F.lit("")).endswith("DeprecatedRank"), "deprecated")
        .when(F.col("ended").isNotNull(), "ended").when(asn.isNull(), "bad_asn")
        .when(~tx.admissible(F.col("refs")), "restricted_refs_only").alias("reason"))


def names_per_asn(claims: DataFrame) -> DataFrame:
    """Admitted claims -> (asn, qid, name, status): ok | conflict | no_label."""
    g = claims.filter("reason is null").groupBy("asn").agg(
        F.min("qid").alias("qid"), F.max("qid").alias("hi"), F.max("label").alias("name"))
    status = F.when(F.col("qid") != F.col("hi"), "conflict").when(F.col("name").isNull(), "no_label").otherwise("ok")
    return g.select("asn", status.alias("status"), F.when(status == "ok", F.col("qid")).alias("qid"),
                    F.when(status == "ok", F.col("name")).alias("name"))


def admitted_names(claims: DataFrame) -> DataFrame:
    return names_per_asn(claims).filter("status = 'ok'").drop("status")


def claim_counters(claims: DataFrame) -> DataFrame:
    """Statements per outcome of a claim table with a `reason` column."""
    return claims.groupBy(F.coalesce("reason", F.lit("admitted")).alias("counter")).agg(F.count("*").alias("n"))


def country_claims(bindings: DataFrame) -> DataFrame:
    """bindings(item, via, cc, rank, ended, refs) -> claims with the drop reason; region rows are left out."""
    cc = F.upper(F.trim(F.coalesce("cc", F.lit(""))))
    rank = F.coalesce("rank", F.lit(""))
    return bindings.filter("via <> 'region'").select(
        item_id(F.col("item")).alias("qid"), "via", cc.alias("cc"), rank.endswith("PreferredRank").alias("preferred"),
        F.when(rank.endswith("DeprecatedRank"), "deprecated").when(F.col("ended").isNotNull(), "ended")
        .when(~cc.rlike("^[A-Z]{2}$") | cc.isin(vocab.NOT_COUNTRIES), "bad_code")
        .when(~tx.admissible(F.col("refs")), "restricted_refs_only")
        .when(~F.col("via").isin("P17", "P159"), "unknown_property").alias("reason"))


def country_per_item(claims: DataFrame) -> DataFrame:
    """(qid, cc, via, ambiguous[]): preferred rank beats normal; one distinct code decides,
    P17 first, then P159; a property with several codes is ambiguous."""
    c = claims.filter("reason is null")
    pref, norm = F.col("preferred"), ~F.col("preferred")
    v = F.col("cc")
    g = c.groupBy("qid", "via").agg(
        F.min(F.when(pref, v)).alias("p_lo"), F.max(F.when(pref, v)).alias("p_hi"),
        F.min(F.when(norm, v)).alias("n_lo"), F.max(F.when(norm, v)).alias("n_hi"))
    lo, hi = F.coalesce("p_lo", "n_lo"), F.coalesce("p_hi", "n_hi")
    one = g.select("qid", "via", F.when(lo == hi, lo).alias("cc"))
    got = lambda via: F.max(F.when(F.col("via") == via, F.col("cc")))
    has = lambda via: F.coalesce(F.max(F.col("via") == via), F.lit(False))
    q = one.groupBy("qid").agg(got("P17").alias("a"), got("P159").alias("b"), has("P17").alias("ha"), has("P159").alias("hb"))
    return q.select(
        "qid", F.coalesce("a", "b").alias("cc"),
        F.when(F.col("a").isNotNull(), "P17").when(F.col("b").isNotNull(), "P159").alias("via"),
        (F.col("ha") & F.col("a").isNull()).alias("ambiguous_p17"),
        (F.col("a").isNull() & F.col("hb") & F.col("b").isNull()).alias("ambiguous_p159"))


def region_hits(bindings: DataFrame) -> DataFrame:
    """Region rows -> (qid, code); unknown regions are dropped."""
    code = F.lit(None).cast("string")
    region = item_id(F.col("region"))
    for k, v in vocab.REGION_ITEMS.items():
        code = F.when(region == k, F.lit(v)).otherwise(code)
    return bindings.filter("via = 'region'").select(item_id(F.col("item")).alias("qid"), code.alias("code")).filter(
        "code is not null")


def refine_regions(items: DataFrame, hits: DataFrame) -> DataFrame:
    """Apply region hits to item countries: (qid, cc, via, outcome).

    One territory state wins over no value, itself or its de facto controller;
    any other combination removes the value.  A special administrative region
    wins only over no value or CN.
    """
    sar = F.col("code").isin(vocab.SAR_CODES)
    h = hits.groupBy("qid").agg(
        F.min(F.when(~sar, F.col("code"))).alias("state"), F.max(F.when(~sar, F.col("code"))).alias("state_hi"),
        F.min("code").alias("lo"), F.max("code").alias("hi"))
    j = items.select("qid", "cc", "via").join(h, "qid", "full")
    controller = F.lit(None).cast("string")
    for s, c in vocab.DE_FACTO_CONTROLLER.items():
        controller = F.when(F.col("state") == s, F.lit(c)).otherwise(controller)
    allowed = F.col("cc").isNull() | (F.col("cc") == F.col("state")) | F.col("cc").eqNullSafe(controller)
    outcome = (
        F.when(F.col("state").isNotNull() & (F.col("state") == F.col("state_hi")) & allowed, "territory")
        .when(F.col("state").isNotNull(), "ambiguous_territory")
        .when((F.col("lo") == F.col("hi")) & (F.col("cc").isNull() | (F.col("cc") == "CN")), "sar")
        .otherwise("unchanged"))
    return j.select(
        "qid",
        F.when(outcome == "territory", F.col("state")).when(outcome == "sar", F.col("lo"))
        .when(outcome == "unchanged", F.col("cc")).alias("cc"),
        F.when(outcome == "territory", F.lit("territory")).when(outcome == "sar", F.lit("region"))
        .when(outcome == "unchanged", F.col("via")).alias("via"),
        outcome.alias("outcome"))


def countries_for_asns(names: DataFrame, items: DataFrame) -> DataFrame:
    """names(asn, qid) x items(qid, cc, via) -> (asn, cc, qid, via)."""
    return names.select("asn", "qid").join(items.filter("cc is not null").select("qid", "cc", "via"), "qid").select(
        "asn", "cc", "qid", "via")


def source_counts(merged: DataFrame) -> DataFrame:
    """Rows per kind of source, and in total."""
    kind = F.split("source", ":")[0]
    return merged.select(F.explode(F.array(kind, F.lit("total"))).alias("source")).groupBy("source").agg(F.count("*").alias("n"))


def territory_violations(overrides: DataFrame, merged: DataFrame) -> DataFrame:
    """Tagged ASNs whose published country is not the recognised state."""
    state = F.lit(None).cast("string")
    for k, v in vocab.TERRITORY_STATES.items():
        state = F.when(F.col("territory") == k, F.lit(v)).otherwise(state)
    return overrides.filter("territory is not null").select("asn", "territory", state.alias("state")).join(
        merged.select("asn", "cc"), "asn").filter(F.col("state").isNull() | (F.col("cc") != F.col("state")))


def _first(arr: Column, pred) -> Column:
    return F.try_element_at(F.filter(arr, pred), F.lit(1))


WIKIDATA_PAGE = "https://www.wikidata.org/wiki/"


def _first_party(evidence: Column, website: Column, refuse_restricted: bool):
    site = tx.registrable_domain(website)

    def keep(e: Column) -> Column:
        d = tx.registrable_domain(e["url"])
        ok = d.isNotNull() & (d.eqNullSafe(site) | d.isin(vocab.REFERENCE_DOMAINS))
        return ok & ~tx.restricted_url(e["url"]) if refuse_restricted else ok

    return F.filter(F.coalesce(evidence, F.array().cast("array<struct<url:string,claim:string>>")), keep)


def _latest(dossiers: DataFrame) -> DataFrame:
    """Latest drafted row per ASN, by file ordinal."""
    rest = [c for c in dossiers.columns if c not in ("asn", "ordinal")]
    return dossiers.groupBy("asn").agg(F.max_by(F.struct(*rest), "ordinal").alias("d")).select("asn", "d.*")


def draft_names(dossiers: DataFrame) -> DataFrame:
    """dossiers(asn, display_name, legal_name, website, evidence[], qid, ordinal) ->
    (asn, name, url, basis, reason, ordinal); reason is set where nothing is drafted."""
    d = dossiers.withColumn("name", F.coalesce(tx.clean_name(F.col("display_name")), tx.clean_name(F.col("legal_name"))))
    named = _first(_first_party(F.col("evidence"), F.col("website"), False),
                   lambda e: F.coalesce(F.array_contains(F.regexp_extract_all(e["claim"], F.lit(r"\bAS(\d+)\b"), 1), F.col("asn").cast("string")), F.lit(False)))
    site_ok = F.coalesce(F.col("website").startswith("http"), F.lit(False)) & ~tx.restricted_url(F.col("website"))
    item_ok = F.coalesce(F.col("qid").rlike(r"^Q\d+$"), F.lit(False))
    d = d.withColumn("e", named)
    basis = F.when(F.col("name").isNull() | F.col("asn").isNull(), F.lit(None)).when(F.col("e").isNotNull(), "evidence_names_asn").when(
        site_ok, "operator_website").when(item_ok, "wikidata_item")
    return d.select(
        "asn", F.when(basis.isNotNull(), F.col("name")).alias("name"),
        F.when(basis == "evidence_names_asn", F.col("e.url")).when(basis == "operator_website", F.col("website"))
        .when(basis == "wikidata_item", F.concat(F.lit(WIKIDATA_PAGE), "qid")).alias("url"),
        basis.alias("basis"),
        F.when(F.col("asn").isNull(), "bad_asn").when(F.col("name").isNull(), "no_name")
        .when(basis.isNull(), "no_admissible_source").alias("reason"), "ordinal")


MARK = "\x01"


def claim_names_country(claim: Column, cc: Column, city: Column) -> Column:
    """The claim holds a name of the country or the first part of the city as whole words.

    The names of countries are fixed patterns; the city is text to replace, not a pattern, so nothing is compiled per row.
    """
    out = F.lit(False)
    for code, words in vocab.COUNTRY_ALIASES.items():
        alt = "|".join(re.escape(w) for w in words)
        out = F.when(cc == code, claim.rlike(rf"(?<![\p{{IsAlphabetic}}\p{{IsDigit}}])(?:{alt})(?![\p{{IsAlphabetic}}\p{{IsDigit}}])")).otherwise(out)
    # A literal replacement marks the town; whether a mark stands alone is one constant pattern.
    town = F.when(F.length(F.trim(city)) >= 3, F.trim(F.split(city, ",")[0]))
    marked = F.replace(F.translate(claim, MARK, " "), town, F.lit(MARK))
    in_town = F.when(town != "", marked.rlike(rf"(?<![\p{{IsAlphabetic}}\p{{IsDigit}}]){MARK}(?![\p{{IsAlphabetic}}\p{{IsDigit}}])"))
    return F.coalesce(out, F.lit(False)) | F.coalesce(in_town, F.lit(False))


def draft_countries(dossiers: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """dossiers(asn, hq_country, hq_city, website, evidence[], qid, ordinal) ->
    (asn, cc, url, basis, reason, review, ordinal).  `review` is set where the
    registry (asn, country) names another country."""
    cc = F.upper(F.trim(F.coalesce("hq_country", F.lit(""))))
    d = dossiers.withColumn("cc", cc)
    bad = F.when(F.col("asn").isNull(), "bad_asn").when(F.col("cc") == "", "no_hq_country").when(
        ~F.col("cc").rlike("^[A-Z]{2}$") | F.col("cc").isin(vocab.NOT_COUNTRIES), "bad_code")
    d = d.withColumns({"bad": bad, "e": _first(
        _first_party(F.col("evidence"), F.col("website"), True),
        lambda e: claim_names_country(e["claim"], F.col("cc"), F.col("hq_city")))})
    site_ok = F.coalesce(F.col("website").startswith("http"), F.lit(False)) & ~tx.restricted_url(F.col("website"))
    item_ok = F.coalesce(F.col("qid").rlike(r"^Q\d+$"), F.lit(False))
    basis = F.when(F.col("bad").isNotNull(), F.lit(None)).when(F.col("e").isNotNull(), "evidence_names_country").when(
        item_ok, "wikidata_item").when(site_ok, "operator_website")
    out = d.select(
        "asn", F.when(basis.isNotNull(), F.col("cc")).alias("cc"),
        F.when(basis == "evidence_names_country", F.col("e.url")).when(basis == "operator_website", F.col("website"))
        .when(basis == "wikidata_item", F.concat(F.lit(WIKIDATA_PAGE), "qid")).alias("url"),
        basis.alias("basis"),
        F.coalesce("bad", F.when(basis.isNull(), "no_admissible_source")).alias("reason"), "ordinal")
    if registry is None:
        return out.withColumn("review", F.lit(False))
    r = registry.select("asn", F.col("country").alias("_reg"))
    return out.join(r, "asn", "left").withColumn(
        "review", F.col("cc").isNotNull() & ~F.col("_reg").eqNullSafe(F.col("cc"))).drop("_reg")


def latest_drafts(drafts: DataFrame) -> DataFrame:
    """Later files win per ASN, among rows that drafted something."""
    return _latest(drafts.filter("reason is null"))


def keyword_candidates(meta: DataFrame) -> DataFrame:
    """meta(asn, description, country, category, network_role) -> (file, asn, line) per keyword sweep."""
    dash = lambda c: F.coalesce(c, F.lit("-"))
    hits = F.array_compact(F.array(*[
        F.when(tx.matches_sweep(F.col("description"), s), F.lit(s)) for s in vocab.SWEEPS]))
    return meta.select(
        F.explode(hits).alias("file"), "asn",
        F.concat(F.lit("AS"), F.col("asn").cast("string"), F.lit("  # "), F.coalesce("description", F.lit("")), F.lit(" ("),
                 F.coalesce("country", F.lit("")), F.lit(") cat="), dash(F.col("category")), F.lit(" role="),
                 dash(F.col("network_role")), F.lit(" — src: metadata description match")).alias("line"))


def hosting_gap(meta: DataFrame, dc_asns: DataFrame, bad_asns: DataFrame) -> DataFrame:
    """Listed datacenter or bad ASNs whose metadata category is not hosting."""
    listed = dc_asns.select("asn", F.lit(True).alias("dc")).unionByName(bad_asns.select("asn", F.lit(False).alias("dc")))
    l = listed.groupBy("asn").agg(F.max("dc").alias("dc"))
    j = l.join(meta.select("asn", "description", "country", "category"), "asn", "left")
    return j.filter(~F.col("category").eqNullSafe("hosting")).select(
        F.lit("hosting_extra").alias("file"), "asn",
        F.concat(F.lit("AS"), F.col("asn").cast("string"), F.lit("  # "), F.coalesce("description", F.lit("NOT IN as-metadata")),
                 F.lit(" ("), F.coalesce("country", F.lit("?")), F.lit(") cat="), F.coalesce("category", F.lit("-")),
                 F.lit(" — src: "), F.when(F.col("dc"), "datacenter list").otherwise("bad-asn list")).alias("line"))


def seed_candidates(lines: DataFrame, source_url: str) -> DataFrame:
    """`AS<n> # text` lines -> vpn_provider seed lines."""
    p = r"^AS(\d+)\s*#?\s*(.*)$"
    n = F.regexp_extract("value", p, 1)
    return lines.filter(F.col("value").rlike(p) & n.try_cast("bigint").isNotNull()).select(
        F.lit("vpn_provider").alias("file"), n.try_cast("bigint").alias("asn"),
        F.concat(F.lit("AS"), n, F.lit("  # "), F.trim(F.regexp_extract("value", p, 2)), F.lit(" — src: "), F.lit(source_url)).alias("line"))
