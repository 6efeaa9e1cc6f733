"""Seeded and capped samples, reproducible on any partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netorigin.functions import vocab
from netorigin.functions.space import V4
from netorigin.operators.scan import scan


def seeded(key: Column, seed: int) -> Column:
    """Sort key of a seeded shuffle: text hash of the row key and the seed."""
    return F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(seed))))


def every_nth(ranges: DataFrame, n: int, space=V4, start: str = "range_start") -> DataFrame:
    """Every (rows/n)-th row along the address line, first row included."""
    rows = ranges.count()
    step = max(1, rows // n)
    s = scan(ranges.withColumns({"pos": F.col(start), "one": F.lit(1).cast("bigint")}), space, sums=("one",))
    return s.filter((F.col("run_one") - 1) % step == 0).drop("pos", "one", "run_one")


def seeded_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    return df.orderBy(seeded(F.col(key), seed), key).limit(n)


def per_class_sample(pool: DataFrame, cls: str, caps: dict[str, int], key: str, seed: int = vocab.GOLD_SEED) -> DataFrame:
    """At most caps[class] rows per class in seeded order.

    The literal bound comes first, so each partition is cut to the largest cap
    per class before the shuffle.
    """
    w = Window.partitionBy(cls).orderBy(seeded(F.col(key), seed), F.col(key))
    cap = F.lit(0)
    for name, n in caps.items():
        cap = F.when(F.col(cls) == name, F.lit(n)).otherwise(cap)
    return pool.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= max(caps.values())).filter(
        F.col("_r") <= cap).drop("_r")


def stratified_limit(gold: DataFrame, n: int, cls: str = "provenance", key: str = "asn", seed: int = vocab.GOLD_SEED) -> DataFrame:
    """Proportional share per class, at least one row each, largest classes trimmed to n.

    Quotas come from one row per class: what exceeds n is taken one by one from
    the class that is largest at that moment, which means every quota is cut down
    to a common level, and the last few units go class by class.
    """
    counts = gold.groupBy(cls).agg(F.count("*").alias("size"))
    # One row per class from here on.
    share = F.lit(float(n)) / F.sum("size").over(Window.partitionBy(F.lit(0)))
    quota = counts.withColumn("share", share).select(
        cls, F.least(F.col("size"), F.greatest(F.lit(1), F.floor(F.col("size") * F.col("share") + 0.5))).cast("bigint").alias("quota"))
    # Units of each class, numbered; unit k of a class is trimmed before every
    # unit below k of any class.  One row per kept unit, so at most n + classes.
    units = quota.withColumn("k", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("quota"))))
    order = Window.orderBy(F.when(F.col("k") == 1, 0).otherwise(1), "k", cls)
    kept = units.withColumn("o", F.row_number().over(order)).filter((F.col("o") <= n) | (F.col("k") == 1))
    final = kept.groupBy(cls).agg(F.count("*").alias("quota"))
    w = Window.partitionBy(cls).orderBy(seeded(F.col(key), seed), F.col(key))
    return gold.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n).join(
        F.broadcast(final), cls).filter(F.col("_r") <= F.col("quota")).drop("_r", "quota")


def probe_targets(base: DataFrame, n: int = 5) -> DataFrame:
    """The n largest ranges per ASN and one address in each: (asn, ip)."""
    w = Window.partitionBy("asn").orderBy((F.col("range_end") - F.col("range_start")).desc(), "range_start")
    return base.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n).select(
        "asn", F.least(F.col("range_start") + 1, F.col("range_end")).alias("ip"))


def latest_by(df: DataFrame, key: str, ordinal: str) -> DataFrame:
    """Last row per key by ordinal, as an aggregate (partial before the shuffle)."""
    rest = [c for c in df.columns if c not in (key, ordinal)]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), ordinal).alias("r")).select(key, "r.*")
