"""File readers.  Every read has an explicit schema or is plain text; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netorigin.sources import parse


def lines(spark: SparkSession, path) -> DataFrame:
    """Text lines (gzip and bzip2 are read by Spark itself)."""
    return spark.read.text(path)


def documents(spark: SparkSession, path) -> DataFrame:
    """One row per file: (value, path)."""
    return spark.read.text(path, wholetext=True).select("value", F.input_file_name().alias("path"))


def numbered(df: DataFrame) -> DataFrame:
    """Add an ordinal that follows file order and line order."""
    return df.withColumn("ordinal", F.struct(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("line")))


def origin_ranges(spark, path, family: int = 4) -> DataFrame:
    return (parse.origin_ranges if family == 4 else parse.origin_ranges_v6)(lines(spark, path))


def cidr_list(spark, path) -> DataFrame:
    return parse.cidr_list(lines(spark, path))


def asn_csv(spark, path, header: str = "ASN,Entity") -> DataFrame:
    return parse.first_column_asns(lines(spark, path), header)


def as_lines(spark, path) -> DataFrame:
    return parse.as_lines(lines(spark, path))


def as_metadata(spark, path) -> DataFrame:
    """A large JSON array is streamed record by record, never held as one value."""
    return parse.as_metadata_records(numbered(spark.read.schema(parse.AS_RECORD).json(path, multiLine=True)))


def sparql(spark, path) -> DataFrame:
    return parse.sparql_bindings(documents(spark, path))


def delegations(spark, path, rir: str | None = None, strict: bool = True) -> DataFrame:
    return parse.delegations(numbered(lines(spark, path)), rir, strict)


def as_rank(spark, path) -> DataFrame:
    return parse.as_rank(documents(spark, path))


def eyeballs(spark, path) -> DataFrame:
    return parse.eyeballs(documents(spark, path))


def vrps(spark, path) -> DataFrame:
    return parse.vrps(lines(spark, path))


def prefix_to_as(spark, path) -> DataFrame:
    return parse.prefix_to_as(lines(spark, path))


RIB_ENTRIES = ("collector string, gen int, idx int, family int, net bigint, net_hi bigint, net_lo bigint, len int, "
               "segments array<struct<type:int,asns:array<bigint>>>")
PEERS = "collector string, gen int, idx int, peer_as bigint"


def rib_entries(spark, path, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(RIB_ENTRIES).format(fmt).load(path)


def peers(spark, path, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(PEERS).format(fmt).load(path)


def flag_list(spark, path, name: str) -> DataFrame:
    return parse.flag_list(lines(spark, path), name)


def name_list(spark, path) -> DataFrame:
    return parse.name_list(lines(spark, path))


def country_list(spark, path) -> DataFrame:
    return parse.country_list(lines(spark, path))


CORRECTIONS = "asn bigint, category string, network_role string, reason string, source_url string, date string"


def corrections(spark, path) -> DataFrame:
    return parse.check_corrections(spark.read.schema(CORRECTIONS).json(path))


def interval_records(spark, path) -> DataFrame:
    return parse.interval_records(lines(spark, path))


def dossiers(spark, path) -> DataFrame:
    return parse.dossiers(numbered(lines(spark, path)))


def predictions(spark, path) -> DataFrame:
    return parse.predictions(lines(spark, path))


def metric_history(spark, path) -> DataFrame:
    """<label>.json manifests in a directory."""
    d = documents(spark, path).withColumn("label", F.regexp_extract("path", r"([^/]+)\.json$", 1))
    return parse.metric_history(d)


def cached_evidence(spark, path) -> DataFrame:
    return parse.cached_evidence(documents(spark, path))
