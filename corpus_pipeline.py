"""The corpus pipeline: documents -> quality rules -> near-dedup -> substring dedup -> secrets out -> packed windows.

Every stage is written as Parquet and read again by the next one, so a lost executor costs no more than the stage it was in.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netorigin.llm import neardup, packing, quality, secrets, substrings
from netorigin.llm.queries import tokenizer_file
from netorigin.operators.lineage import shared_folder


REMEMBERED = 100_000  # chunks a worker keeps while packing: workers live on, and other stages need their memory


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules pass."""
    return quality.keep_good(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return neardup.keep_one(docs)


def no_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of repeated windows.  Untouched texts stay as they are; emptied documents go."""
    touched = F.col("found.n_removed") > 0
    made = {"text": F.col("found.kept_text"), "n_chars": F.length("found.kept_text").cast("bigint")}
    return (substrings.find_repeats(docs).filter("found.n_removed = 0 or found.n_removed < found.n_words")
            .select(*[F.when(touched, made[c]).otherwise(F.col(f"row.`{c}`")).alias(c) if c in made else F.col(f"row.`{c}`") for c in docs.columns]))


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every secret replaced by a mark."""
    d = secrets.redact(docs.withColumn("_was", F.col("text")))
    same = F.col("text").eqNullSafe(F.col("_was"))
    return d.withColumn("n_chars", F.when(same, F.col("n_chars")).otherwise(F.length("text").cast("bigint"))).select(*docs.columns)


def windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of 2048 ids, with their ids."""
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"), remembered=REMEMBERED)


STAGES = [("quality_rules", keep_good), ("near_dedup", one_of_each), ("substring_dedup", no_repeats), ("secret_scan", no_secrets), ("packing", windows)]

ORACLE_SQL = None  # tokenizer ids are out of SQL's reach


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over `documents`."""
    base = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(out := f"{base}/{i}-{name}")
        docs = spark.read.parquet(out)
    return STAGES[-1][1](spark, docs, sf_dir)
