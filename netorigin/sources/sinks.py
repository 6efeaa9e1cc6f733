"""Sinks.  Each has a pure line or row builder and a writer; no sink sorts on one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netorigin.functions import vocab
from netorigin.functions.addr import int_to_v4, v6_text
from netorigin.functions.space import V4, V6
from netorigin.operators.ranges import bucket_pieces


def ordered_write(df: DataFrame, order: list[str]):
    """Range-partitioned and sorted files: read in name order they are globally sorted."""
    return df.repartitionByRange(*order).sortWithinPartitions(*order).write


def interval_json(wire: DataFrame) -> DataFrame:
    """Interval JSON lines with a fixed key order: (ip_version, start_hex, value)."""
    keys = ["ip_version", "start_hex", "end_hex", *vocab.PAYLOAD_FIELDS]
    return wire.select("ip_version", "start_hex", F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}).alias("value"))


def write_interval_json(wire: DataFrame, path: str) -> None:
    j = interval_json(wire).repartitionByRange("ip_version", "start_hex").sortWithinPartitions("ip_version", "start_hex")
    j.select("value").write.text(path)


def csv_field(c: Column) -> Column:
    """RFC 4180: quoted only when it holds a quote, comma, CR or LF; null is empty."""
    t = F.coalesce(c.cast("string"), F.lit(""))
    return F.when(t.rlike('["\\r\\n,]'), F.concat(F.lit('"'), F.replace(t, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(t)


CSV_HEADER = ["ip_version", "start_ip", "end_ip", *vocab.PAYLOAD_FIELDS]


def _address_text(wire: DataFrame, name: str) -> Column:
    h = F.col(name)
    four = F.col("ip_version") == 4
    return F.when(four, int_to_v4(V4.from_hex(F.when(four, h)))).otherwise(v6_text(V6.from_hex(F.when(~four, h))))


def csv_rows(wire: DataFrame) -> DataFrame:
    """17 text columns: null empty, booleans 0/1, sources joined by `|`."""
    def cell(name: str) -> Column:
        if name in vocab.ASN_SIGNALS + vocab.RANGE_SIGNALS:
            return F.when(F.col(name), "1").otherwise("0")
        if name == "core_sources":
            return F.array_join(name, "|")
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    return wire.select(
        F.col("ip_version").cast("string").alias("ip_version"), _address_text(wire, "start_hex").alias("start_ip"),
        _address_text(wire, "end_hex").alias("end_ip"), *[cell(n).alias(n) for n in vocab.PAYLOAD_FIELDS], "start_hex")


def csv_lines(wire: DataFrame) -> DataFrame:
    r = csv_rows(wire)
    return r.select(F.concat_ws(",", *[csv_field(F.col(n)) for n in CSV_HEADER]).alias("value"))


def write_csv(wire: DataFrame, path: str, compression: str = "gzip") -> None:
    r = csv_rows(wire).withColumn("_v", F.col("ip_version").cast("int"))
    r = r.repartitionByRange("_v", "start_hex").sortWithinPartitions("_v", "start_hex")
    r.select(*CSV_HEADER).write.csv(path, header=True, quote='"', escape='"', emptyValue="", nullValue="", compression=compression)


def write_categories(categories: DataFrame, path: str) -> None:
    ordered_write(categories, ["asn"]).csv(path, header=True, quote='"', escape='"', emptyValue="", nullValue="")


def category_lines(categories: DataFrame) -> DataFrame:
    return categories.select(F.concat_ws(",", *[csv_field(F.col(c)) for c in (
        "asn", "org", "country", "category", "network_role", "flags")]).alias("value"))


def candidate_text(candidates: DataFrame) -> DataFrame:
    """Candidates of a prefix as `asn:votes,...`, most votes first.

    The reader is one line per prefix, so the list is built once per prefix after
    votes have been counted: one entry per distinct origin.
    """
    best = F.array_sort(F.collect_list(F.struct((-F.col("vis")).alias("v"), "asn")))
    return candidates.groupBy("net", "len").agg(best.alias("c")).select(
        "net", "len", F.array_join(F.transform("c", lambda x: F.concat_ws(":", x["asn"].cast("string"), (-x["v"]).cast("string"))), ",").alias("candidates"))


def decision_lines(decisions: DataFrame, candidates: DataFrame) -> DataFrame:
    """Prefix decision TSV rows: prefix, origin, votes, moas, candidates, reason."""
    j = decisions.join(candidate_text(candidates), ["net", "len"], "left")
    t = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return j.select("net", "len", F.concat_ws(
        "\t", F.concat_ws("/", int_to_v4(F.col("net")), F.col("len").cast("string")), t("origin"), t("origin_vis"), t("total_vis"),
        F.when(F.col("moas"), "1").otherwise("0"), t("candidates"), t("reason")).alias("value"))


def write_lines(df: DataFrame, path: str, order: list[str]) -> None:
    df.repartitionByRange(*order).sortWithinPartitions(*order).select("value").write.text(path)


def origin_lines(ranges: DataFrame, space=V4) -> DataFrame:
    """`start,end,asn,` with an empty name column."""
    if space.version == 4:
        s, e = F.col("range_start").cast("string"), F.col("range_end").cast("string")
    else:
        s, e = space.hex(F.col("range_start")), space.hex(F.col("range_end"))
    return ranges.select("range_start", F.concat_ws(",", s, e, F.col("asn").cast("string"), F.lit("")).alias("value"))


def registry_json(registry: DataFrame) -> DataFrame:
    return registry.select("asn", F.to_json(F.struct("asn", "rir", "cc", "registered", "status", "holder"), {"ignoreNullFields": "false"}).alias("value"))


def holder_json(clusters: DataFrame) -> DataFrame:
    """One line per row of clusters; what a row does not have is left out."""
    return clusters.select("holder", F.to_json(F.struct(*clusters.columns)).alias("value"))


def pool_json(parts: DataFrame) -> DataFrame:
    """One line per part of a pool."""
    return parts.select("holder", "part", F.to_json(F.struct("holder", "part", "size", "asns")).alias("value"))


def write_registry_rows(registry: DataFrame, path: str) -> None:
    """The registry lines, from rows that are dealt by ASN ranges (registry_rows with `in_order`)."""
    registry_json(registry).sortWithinPartitions("asn").select("value").write.text(f"{path}/asn-registry", compression="gzip")


def read_registry_rows(spark, path: str) -> DataFrame:
    row = F.from_json("value", "asn bigint, rir string, cc string, registered string, status string, holder string")
    return spark.read.text(f"{path}/asn-registry").select(row.alias("r")).select("r.*")


def write_clusters(heads: DataFrame, parts: DataFrame, path: str) -> None:
    write_lines(holder_json(heads), f"{path}/holders", ["holder"])
    write_lines(pool_json(parts), f"{path}/pools", ["holder", "part"])


def quant_json(quant: DataFrame) -> DataFrame:
    return quant.select("asn", F.to_json(F.struct("asn", "quant", "sources"), {"ignoreNullFields": "false"}).alias("value"))


def draft_lines(drafts: DataFrame, value: str, date: str) -> DataFrame:
    """`AS<n>  <value>  # src: <url> (<date>)`."""
    return drafts.select("asn", F.format_string(
        "AS%d  %s  # src: %s (%s)", "asn", value, "url", F.lit(date)).alias("value"))


def sibling_lines(candidates: DataFrame, registry: DataFrame, url: str) -> DataFrame:
    """Sibling candidates with the listed ASNs that led there."""
    r = registry.select("asn", "cc", "registered")
    via = F.array_join(F.transform("via", lambda a: F.concat(F.lit("AS"), a.cast("string"))), ",")
    return candidates.join(r, "asn", "left").select("asn", F.concat(
        F.lit("AS"), F.col("asn").cast("string"), F.lit("  # sibling of "), via, F.lit(" (holder "), F.col("holder"), F.lit(", "),
        F.coalesce("cc", F.lit("??")), F.lit(", registered "), F.coalesce("registered", F.lit("?")), F.lit(") - src: "), F.lit(url)).alias("value"))


def write_candidates(ready: DataFrame, review: DataFrame, path: str) -> None:
    write_lines(ready, f"{path}/ready", ["asn"])
    write_lines(review, f"{path}/review", ["asn"])


def segment_lines(classified: DataFrame, space=V4) -> DataFrame:
    """Disagreement dump: every segment that is not `same`."""
    text = int_to_v4 if space.version == 4 else v6_text
    size = space.size(F.col("range_start"), F.col("range_end"))
    t = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("string")
    return classified.filter("class <> 'same'").select("range_start", F.concat_ws(
        "\t", "class", text(F.col("range_start")), text(F.col("range_end")), size.cast("string"), t("a_asn"), t("b_asn")).alias("value"))


def lookup_pieces(intervals: DataFrame, shift: int = 16) -> DataFrame:
    return bucket_pieces(intervals, shift)


def write_lookup(intervals: DataFrame, path: str, family: int = 4, shift: int = 16) -> None:
    """IPv4 lookup table: pieces per block, range-partitioned and sorted by block, so
    that Parquet min/max statistics prune files and row groups."""
    p = lookup_pieces(intervals, shift).withColumn("family", F.lit(family))
    p.repartitionByRange("bucket", "range_start").sortWithinPartitions("bucket", "range_start").write.partitionBy("family").parquet(path)


def read_lookup(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)

