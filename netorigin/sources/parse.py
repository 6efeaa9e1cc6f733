"""Line and document parsers: DataFrame(value string) -> typed rows.

Readers (read.py) supply `value`; keeping the rules on a column makes them work
the same over files, tables and streams.  Malformed input is returned as rows
(with a reason or in a bad count), never dropped silently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netorigin.functions import text as tx
from netorigin.functions import vocab
from netorigin.functions.flags import any_of
from netorigin.functions.addr import cidr_to_range, parse_fixed_hex, v4_to_int, v6_to_pair
from netorigin.functions.space import V4, V6, v6
from netorigin.operators.sampling import latest_by

def _content(lines: DataFrame) -> DataFrame:
    """Drop blank and `#` lines; `line` is the trimmed text."""
    return lines.withColumn("line", F.trim("value")).filter((F.col("line") != "") & ~F.col("line").startswith("#"))


def origin_ranges(lines: DataFrame) -> DataFrame:
    """IPv4 `start,end,asn,name` -> range_start, range_end, asn, bad.  The name is never read."""
    p = F.split("value", ",", 4)
    num = lambda i: F.coalesce(F.try_element_at(p, F.lit(i)).try_cast("bigint"), F.lit(0).cast("bigint"))
    s, e, a = num(1), num(2), num(3)
    bad = (e < s) | (e > V4.max_value) | ((s == 0) & (e == 0)) | (a <= 0)
    return lines.select(s.alias("range_start"), e.alias("range_end"), a.alias("asn"), bad.alias("bad"))


def origin_ranges_v6(lines: DataFrame) -> DataFrame:
    """The same with 128-bit decimal numbers: up to 39 digits, null above 2^128-1."""
    p = F.split("value", ",", 4)
    text = lambda i: F.coalesce(F.try_element_at(p, F.lit(i)), F.lit(""))
    digits = lambda i: F.lpad(F.when(text(i).rlike(r"^\d{1,39}$"), text(i)), 39, "0")
    a = F.coalesce(text(3).try_cast("bigint"), F.lit(0).cast("bigint"))
    rows = _decimal_to_pair(_decimal_to_pair(lines.select(digits(1).alias("_s"), digits(2).alias("_e"), a.alias("asn")), "_s"), "_e")
    s, e = F.col("_s"), F.col("_e")
    zero = V6.from_hex(F.lit("0" * 32))
    bad = s.isNull() | e.isNull() | F.coalesce(e < s, F.lit(True)) | ((s == zero) & (e == zero)) | (F.col("asn") <= 0)
    return rows.select(s.alias("range_start"), e.alias("range_end"), "asn", bad.alias("bad"))


def _decimal_to_pair(df: DataFrame, name: str) -> DataFrame:
    """Replace the column `name` of 39 decimal digits by the address, null above 2^128-1.

    Horner over groups of nine digits on four limbs of 32 bits: every partial value stays below 2^32 * 10^9 + 2^32 < 2^63.  Each limb is a column of its
    own, so none is evaluated twice.
    """
    limb = [f"_{i}{name}" for i in range(4)]
    group = lambda at, n: F.substring(name, at, n).cast("bigint")
    d = df.withColumns({limb[0]: group(1, 3), **{x: F.lit(0).cast("bigint") for x in limb[1:]}})
    for at in (4, 13, 22, 31):
        carry = group(at, 9)
        for i, x in enumerate(limb):
            d = d.withColumn(x, F.col(x) * F.lit(1_000_000_000).cast("bigint") + carry)
            carry = F.shiftright(x, 32)
        if at < 31:
            d = d.withColumns({x: F.col(x).bitwiseAND(F.lit(0xFFFFFFFF)) for x in limb})
    low = lambda i: F.col(limb[i]).bitwiseAND(F.lit(0xFFFFFFFF))
    pair = v6(F.shiftleft(low(3), 32).bitwiseOR(low(2)), F.shiftleft(low(1), 32).bitwiseOR(low(0)))
    return d.withColumn(name, F.when(F.col(limb[3]) <= 0xFFFFFFFF, pair)).drop(*limb)


def good_bad(parsed: DataFrame) -> DataFrame:
    return parsed.agg(F.count_if(~F.col("bad")).alias("good"), F.count_if("bad").alias("bad"))


def good_rows(parsed: DataFrame) -> DataFrame:
    return parsed.filter("not bad").drop("bad")


def cidr_list(lines: DataFrame) -> DataFrame:
    """First token of each line; IPv4 only, bad where it does not parse."""
    token = F.regexp_extract("line", r"^([^\s#]+)", 1)
    r = _content(lines).select(cidr_to_range(token).alias("r"))
    return r.filter("r is null or r.family = 4").select(
        F.col("r.start4").alias("range_start"), F.col("r.end4").alias("range_end"), F.col("r").isNull().alias("bad"))


def first_column_asns(lines: DataFrame, header: str) -> DataFrame:
    """ASN CSV: header line skipped by content, first column, positive only."""
    n = F.regexp_extract(F.split("value", ",", 2)[0], r"^\s*(\d+)", 1)
    return lines.filter(F.col("value") != header).select(
        F.when(n != "", n).try_cast("bigint").alias("asn")).filter("asn > 0").distinct()


def as_lines(lines: DataFrame) -> DataFrame:
    """`AS<n> # text` -> asn set; other lines are skipped."""
    n = F.regexp_extract("value", r"^AS(\d+)\b", 1)
    return lines.select(F.when(n != "", n).try_cast("bigint").alias("asn")).filter("asn is not null").distinct()


AS_RECORD = "asn bigint, handle string, description string, countryCode string, category string, networkRole string"


def as_metadata_records(records: DataFrame) -> DataFrame:
    """Metadata records with an `ordinal` -> one per ASN, the last one wins."""
    return latest_by(records.filter("asn is not null").select(
        "asn", F.coalesce("description", "handle").alias("description"), F.col("countryCode").alias("country"),
        "category", F.col("networkRole").alias("network_role"), "ordinal"), "asn", "ordinal")


def as_metadata(docs: DataFrame) -> DataFrame:
    """JSON arrays in documents(value, ordinal)."""
    array = "array<struct<" + AS_RECORD.replace(" bigint", ":bigint").replace(" string", ":string").replace(", ", ",") + ">>"
    r = docs.select("ordinal", F.posexplode(F.from_json("value", array)).alias("i", "r"))
    return as_metadata_records(r.select("r.*", F.struct("ordinal", "i").alias("ordinal")))


V = "struct<value:string>"
BINDINGS = ("struct<results:struct<bindings:array<struct<item:{v},asn:{v},rank:{v},`end`:{v},en:{v},mul:{v},refs:{v},"
            "via:{v},cc:{v},region:{v}>>>>").format(v=V)


def sparql_bindings(docs: DataFrame) -> DataFrame:
    """SPARQL JSON -> binding rows; a document without results.bindings is an error."""
    b = F.from_json("value", BINDINGS)["results"]["bindings"]
    checked = F.when(b.isNotNull(), b).otherwise(F.raise_error(F.lit("no results.bindings in SPARQL response")))
    r = docs.select(F.explode(checked).alias("b"))
    names = ["item", "asn", "rank", "en", "mul", "refs", "via", "cc", "region"]
    return r.select(*[F.col(f"b.{n}.value").alias(n) for n in names], F.col("b.end.value").alias("ended"))


def delegations(lines: DataFrame, rir: str | None = None, strict: bool = True) -> DataFrame:
    """Registry delegation lines -> rows with a `violation` (always null when lenient).

    lines(value[, ordinal]).  Version, summary, comment and non-asn lines are skipped.
    """
    f = F.split("value", r"\|", -1)
    at = lambda i: F.coalesce(F.try_element_at(f, F.lit(i)), F.lit(""))
    rows = lines.filter((F.col("value") != "") & ~F.col("value").startswith("#")).filter(
        ~((at(2) == "*") & (at(4) == "*")) & ~at(1).rlike(r"^\d+(\.\d+)?$") & (at(3) == "asn"))
    start = F.when(at(4).rlike(r"^\d+$"), at(4)).try_cast("bigint")
    count = F.when(at(5).rlike(r"^\d+$"), at(5)).try_cast("bigint")
    status = F.trim(at(7))
    ordinal = F.col("ordinal") if "ordinal" in lines.columns else F.monotonically_increasing_id()
    v = F.lit(None).cast("string")
    if strict:
        v = (
            F.when(F.lit(rir is not None) & (at(1) != (rir or "")), "foreign_registry")
            .when(start.isNull() | count.isNull() | (count <= 0), "bad_start_or_count")
            .when(~status.isin(vocab.STATUSES), "unknown_status"))
    out = rows.select(
        at(1).alias("rir"), tx.registry_country(at(2)).alias("cc"), start.alias("start"),
        (count if strict else F.greatest(F.coalesce(count, F.lit(1).cast("bigint")), F.lit(1).cast("bigint"))).alias("count"),
        tx.registry_date(at(6)).alias("date"), status.alias("status"), F.nullif(F.trim(at(8)), F.lit("")).alias("opaque_id"),
        ordinal.alias("ordinal"), v.alias("violation"))
    return out if strict else out.filter("start is not null")


AS_RANK = ("struct<data:struct<asns:struct<edges:array<struct<node:struct<asn:string,asnName:string,`rank`:bigint,source:string,"
           "country:struct<iso:string>,organization:struct<orgId:string>,"
           "cone:struct<numberAsns:bigint,numberPrefixes:bigint,numberAddresses:bigint>,"
           "asnDegree:struct<total:bigint,customer:bigint,peer:bigint,provider:bigint>>>>>>>")


def as_rank(docs: DataFrame) -> DataFrame:
    n = docs.select(F.explode(F.from_json("value", AS_RANK)["data"]["asns"]["edges"]).alias("e")).select("e.node.*")
    nn = lambda c: F.nullif(F.col(c), F.lit(""))
    return n.select(
        F.col("asn").try_cast("bigint").alias("asn"), F.col("rank").alias("asrank"), nn("asnName").alias("asn_name"),
        nn("source").alias("rir"), nn("country.iso").alias("country"), nn("organization.orgId").alias("org_id"),
        F.col("cone.numberAsns").alias("cone_asns"), F.col("cone.numberPrefixes").alias("cone_prefixes"),
        F.col("cone.numberAddresses").alias("cone_addresses"), F.col("asnDegree.total").alias("degree_total"),
        F.col("asnDegree.customer").alias("degree_customer"), F.col("asnDegree.peer").alias("degree_peer"),
        F.col("asnDegree.provider").alias("degree_provider")).filter("asn is not null")


EYEBALLS = "struct<Data:array<struct<AS:string,CC:string,Users:bigint,`Percent of Internet`:double>>>"


def eyeballs(docs: DataFrame) -> DataFrame:
    d = docs.select(F.explode(F.from_json("value", EYEBALLS)["Data"]).alias("e")).select("e.*")
    return d.select(F.col("AS").try_cast("bigint").alias("asn"), F.col("CC").alias("economy"), F.col("Users").alias("users"),
                    F.col("Percent of Internet").alias("pct")).filter("asn is not null")


def vrps(lines: DataFrame) -> DataFrame:
    """`AS<n>,prefix,maxlen,...` -> asn, family, net4, net6, len, maxlen; other lines are skipped."""
    p = r"^AS(\d+),([^,]+),(\d+),"
    g = lambda i: F.regexp_extract("value", p, i)
    r = lines.filter(F.col("value").rlike(p)).select(g(1).try_cast("bigint").alias("asn"), cidr_to_range(g(2)).alias("r"),
                                                     g(3).try_cast("int").alias("maxlen"))
    return r.filter("r is not null").select("asn", F.col("r.family").alias("family"), F.col("r.start4").alias("net4"),
                                            F.col("r.start6").alias("net6"), F.col("r.len").alias("len"), "maxlen")


def prefix_to_as(lines: DataFrame) -> DataFrame:
    """`prefix<TAB>len<TAB>asfield` -> one row per origin; zero origins dropped."""
    f = F.split("value", "\t")
    at = lambda i: F.try_element_at(f, F.lit(i))
    r = lines.filter(at(3).isNotNull()).select(
        at(1).alias("prefix"), at(2).try_cast("int").alias("len"), F.explode(F.split(F.trim(at(3)), "[,_]")).alias("a"))
    is6 = F.col("prefix").contains(":")
    n = F.coalesce(F.col("a").try_cast("bigint"), F.lit(0).cast("bigint"))
    return r.select(
        F.when(is6, 6).otherwise(4).alias("family"), v4_to_int(F.when(~is6, F.col("prefix"))).alias("net4"),
        v6_to_pair(F.when(is6, F.col("prefix"))).alias("net6"), "len", n.alias("asn")).filter("asn <> 0")


def flag_list(lines: DataFrame, name: str) -> DataFrame:
    """Curated `AS<n> # comment` lines -> (list, asn, comment, violation, duplicate)."""
    p = r"^AS(\d+)\s*#\s*(.+)$"
    l = _content(lines)
    asn, comment = F.regexp_extract("line", p, 1), F.regexp_extract("line", p, 2)
    v = F.when(~F.col("line").rlike(p), "malformed").when(~comment.rlike(r"(?i)https?://|\bsrc:"), "no_source")
    rows = l.select(F.lit(name).alias("list"), F.when(asn != "", asn).try_cast("bigint").alias("asn"), comment.alias("comment"), _sized(asn, v))
    return _mark_duplicates(rows)


def _sized(digits, violation):
    """The violation, or `malformed` for a number that no ASN column can hold."""
    return F.when((digits != "") & digits.try_cast("bigint").isNull(), "malformed").otherwise(violation).alias("violation")


def _mark_duplicates(rows: DataFrame) -> DataFrame:
    n = rows.filter("asn is not null").groupBy("asn").agg((F.count("*") > 1).alias("duplicate"))
    return rows.join(n, "asn", "left").withColumn("duplicate", F.coalesce("duplicate", F.lit(False)))


URL = r"https?://\S+"


def name_list(lines: DataFrame) -> DataFrame:
    """Curated `AS<n> name # src: url` -> (asn, name, src, violation, duplicate)."""
    p = r"^AS(\d+)\s+(.+?)\s+#\s*(.+)$"
    l = _content(lines)
    g = lambda i: F.regexp_extract("line", p, i)
    url = F.nullif(F.regexp_extract(g(3), URL, 0), F.lit(""))
    name = F.trim(g(2))
    v = (
        F.when(~F.col("line").rlike(p), "malformed").when(name.contains("�"), "invalid_utf8")
        .when(F.length(name) > vocab.NAME_MAX_CHARS, "too_long").when(url.isNull(), "no_source")
        .when(tx.restricted_url(url), "restricted_source"))
    rows = l.select(F.nullif(g(1), F.lit("")).try_cast("bigint").alias("asn"), tx.clean_label(name).alias("name"), url.alias("src"), _sized(g(1), v))
    return _mark_duplicates(rows)


def country_list(lines: DataFrame) -> DataFrame:
    """Curated `AS<n> CC # src: url` -> (asn, cc, territory, src, violation, duplicate); `--` gives a null cc."""
    p = r"^AS(\d+)\s+(\S+)\s+#\s*(.+)$"
    l = _content(lines)
    g = lambda i: F.regexp_extract("line", p, i)
    cc = F.when(g(2) != "--", g(2))
    tagged = g(3).rlike(r"\bterritory:")
    terr = F.nullif(F.regexp_extract(g(3), r"\bterritory:\s*([a-z_]+)", 1), F.lit(""))
    state = F.lit(None).cast("string")
    for k, s in vocab.TERRITORY_STATES.items():
        state = F.when(terr == k, F.lit(s)).otherwise(state)
    url = F.nullif(F.regexp_extract(g(3), URL, 0), F.lit(""))
    v = (
        F.when(~F.col("line").rlike(p), "malformed")
        .when(cc.isNotNull() & (~cc.rlike("^[A-Z]{2}$") | cc.isin(vocab.NOT_COUNTRIES)), "bad_country")
        .when(tagged & state.isNull(), "unknown_territory").when(tagged & ~cc.eqNullSafe(state), "wrong_state")
        .when(url.isNull(), "no_source").when(tx.restricted_url(url), "restricted_source"))
    rows = l.select(F.nullif(g(1), F.lit("")).try_cast("bigint").alias("asn"), cc.alias("cc"), terr.alias("territory"), url.alias("src"), _sized(g(1), v))
    return _mark_duplicates(rows)


def check_corrections(rows: DataFrame) -> DataFrame:
    """corrections(asn, category, network_role, reason, source_url, date) + violation."""
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    return rows.withColumn(
        "violation",
        F.when(F.col("asn").isNull(), "bad_asn").when(blank("reason") | blank("source_url") | blank("date"), "missing_field")
        .when(~F.col("category").isin(*vocab.CATEGORY_CODES, "none"), "bad_category")
        .when(~F.col("network_role").isin(*vocab.ROLE_CODES, "none"), "bad_role"))


_WIRE = {
    "ip_version": "bigint", "start_hex": "string", "end_hex": "string", "asn": "bigint", "as_org": "string", "category": "string",
    "network_role": "string", **{s: "boolean" for s in vocab.ASN_SIGNALS + vocab.RANGE_SIGNALS}, "core_verdict": "string",
    "core_sources": "array<string>"}
WIRE_SCHEMA = ",".join(f"{k} {v}" for k, v in _WIRE.items())


def interval_records(lines: DataFrame) -> DataFrame:
    """Effective-interval JSON lines -> record columns, numeric endpoints and a `violation`."""
    r = lines.select("value", F.from_json("value", WIRE_SCHEMA).alias("r"), F.json_object_keys("value").alias("keys"))
    c = lambda n: F.col(f"r.{n}")
    s, e = parse_fixed_hex(c("start_hex"), c("ip_version")), parse_fixed_hex(c("end_hex"), c("ip_version"))
    r = r.withColumns({"s": s, "e": e})
    four = c("ip_version") == 4
    ordered = F.when(four, F.col("s.v4") <= F.col("e.v4")).otherwise(F.col("s.v6") <= F.col("e.v6"))
    signals = vocab.ASN_SIGNALS + vocab.RANGE_SIGNALS
    org = F.octet_length(c("as_org"))
    v = (
        F.when(F.col("keys").isNull(), "not_json").when(F.size(F.array_except("keys", F.array(*[F.lit(k) for k in _WIRE]))) > 0, "unknown_field")
        .when(F.size("keys") < len(_WIRE), "missing_field").when(~c("ip_version").isin(4, 6) | c("ip_version").isNull(), "bad_ip_version")
        .when(ordered.isNull(), "bad_hex").when(~ordered, "inverted")
        .when(any_of([c(x).isNull() for x in signals]), "missing_signal")
        .when(~c("core_verdict").isin(vocab.VERDICTS) | c("core_verdict").isNull(), "bad_verdict")
        .when((F.size(F.array_except(c("core_sources"), F.array(*[F.lit(x) for x in vocab.SOURCES]))) > 0)
              | F.coalesce(F.size(c("core_sources")) == 0, F.lit(True)), "bad_sources")
        .when(~c("category").isin(list(vocab.CATEGORY_CODES)), "bad_category").when(~c("network_role").isin(list(vocab.ROLE_CODES)), "bad_role")
        .when((c("asn") < 0) | (c("asn") > vocab.ASN_MAX), "bad_asn").when((org < 1) | (org > vocab.ORG_MAX_BYTES), "bad_org")
        .when(c("asn").isNull() & (c("as_org").isNotNull() | c("category").isNotNull() | c("network_role").isNotNull()
                                   | any_of([c(x) for x in vocab.ASN_SIGNALS])), "evidence_without_asn"))
    return r.select("r.*", F.col("s.v4").alias("start4"), F.col("e.v4").alias("end4"), F.col("s.v6").alias("start6"),
                    F.col("e.v6").alias("end6"), v.alias("violation"))


DOSSIER = ("asn bigint, org struct<display_name:string,legal_name:string,website:string,hq_country:string,hq_city:string>, "
           "evidence array<struct<url:string,claim:string>>, external_ids struct<wikidata_qid:string>")


def dossiers(lines: DataFrame) -> DataFrame:
    """Dossier JSON lines(value, ordinal) -> flat rows; choosing the latest is left to the drafts."""
    r = lines.filter(F.trim("value") != "").select("ordinal", F.from_json("value", DOSSIER).alias("d")).select("ordinal", "d.*")
    return r.select("asn", "org.*", "evidence", F.col("external_ids.wikidata_qid").alias("qid"), "ordinal")


PREDICTION = ("asn bigint, labels array<string>, action string, correction struct<category:string>, confidence double, "
              "evidence string, needs_review boolean")


def predictions(lines: DataFrame) -> DataFrame:
    """Prediction JSON lines; a torn line is dropped."""
    r = lines.select(F.from_json("value", PREDICTION + ", _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"}).alias("p")).select("p.*")
    return r.filter("_corrupt is null and asn is not null").select(
        "asn", "labels", "action", F.col("correction.category").alias("correction_category"),
        F.col("correction").isNotNull().alias("has_correction"), "confidence", "evidence", "needs_review")


def metric_history(manifests: DataFrame) -> DataFrame:
    """Build manifests(value, label) -> (metric, kind, label, value, at).

    Label `latest` is the previous build; of the tags vYYYY.MM.DD the newest two are pins.
    """
    m = manifests.select("label", F.from_json("value", "build_id string, stats map<string,bigint>").alias("m")).select(
        "label", F.col("m.build_id").alias("at"), F.col("m.stats").alias("stats")).filter("stats is not null")
    pin = F.col("label").rlike(r"^v\d{4}\.\d{2}\.\d{2}$")
    tagged = m.filter((F.col("label") == "latest") | pin).withColumn("kind", F.when(pin, "pin").otherwise("previous"))
    w = Window.partitionBy("kind").orderBy(F.col("label").desc())
    kept = tagged.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= vocab.PINS_CONSULTED)
    return kept.select(F.explode("stats").alias("metric", "value"), "kind", "label", "at").select("metric", "kind", "label", "value", "at")


EVIDENCE = ("asn bigint, ripestat_overview struct<holder:string>, ripestat_neighbours struct<left_count:bigint,right_count:bigint,"
            "uncertain_count:bigint>, peeringdb struct<present:boolean,name:string,website:string>, rdap map<string,string>, "
            "rdns map<string,string>, website struct<url:string,title:string,meta_description:string>")


def cached_evidence(docs: DataFrame) -> DataFrame:
    """One JSON document per ASN, any section may be missing."""
    d = docs.select(F.from_json("value", EVIDENCE).alias("d")).select("d.*")
    return d.select(
        "asn", F.col("ripestat_overview.holder").alias("holder"), F.col("ripestat_neighbours.left_count").alias("left"),
        F.col("ripestat_neighbours.right_count").alias("right"), F.col("ripestat_neighbours.uncertain_count").alias("uncertain"),
        F.when(F.col("peeringdb").isNotNull(), F.coalesce("peeringdb.present", F.lit(False))).alias("pdb_present"),
        F.col("peeringdb.name").alias("pdb_name"), F.col("peeringdb.website").alias("pdb_website"), "rdap", "rdns",
        F.col("website").alias("site")).filter("asn is not null")
