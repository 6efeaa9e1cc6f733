"""A distributed prefix scan over address positions.

Every ordered, one-pass rule of this engine (interval merge, sweep, coalesce,
predecessor lookup) is a running value along the address line.  A window
without PARTITION BY would put the line on one task, so the line is cut into
buckets: each bucket is scanned on its own, one summary row per bucket is
scanned next, and the result is handed back to the buckets as a carry.
Ranges are therefore never split at bucket bounds and nothing is stitched.

Positions must be distinct (per key).  Callers aggregate by position first,
which also map-side combines any number of copies of one hot position.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from netorigin.operators.lineage import cut

BUCKET = "_b"


def scan(
    df: DataFrame,
    space,
    *,
    sums: tuple[str, ...] = (),
    lasts: tuple[str, ...] = (),
    maxes: tuple[str, ...] = (),
    prevs: tuple[str, ...] = (),
    nexts: bool = False,
    keys: tuple[str, ...] = (),
    pos: str = "pos",
    keep_bucket: bool = False,
) -> DataFrame:
    """Add running columns along `pos`, ascending, per `keys`.

    run_<c>  inclusive running sum            for c in sums
    last_<c> latest non-null value so far     for c in lasts (null = no value)
    top_<c>  maximum over *earlier* rows      for c in maxes
    prev_<c> value on the previous row        for c in prevs
    next_pos position of the following row    when nexts

    With `keep_bucket` the bucket column stays, so that a second scan over the
    result reuses the buckets, their partitioning and the same cut.
    """
    keys = tuple(keys)
    by = [*keys, BUCKET]
    if BUCKET not in df.columns:
        # A scan reads its input twice (rows and bucket summaries), so a chain of
        # scans would double its plan, and its work, at every step.  Cut here, the
        # positions are computed once.
        df = cut(space.bucketed(df, pos, BUCKET))

    summary = df.groupBy(*by).agg(
        F.min(pos).alias("_first"),
        *[F.sum(c).alias(f"_s_{c}") for c in sums],
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(pos))).alias(f"_l_{c}") for c in lasts],
        *[F.max(c).alias(f"_m_{c}") for c in maxes],
        *[F.max_by(c, pos).alias(f"_p_{c}") for c in prevs],
    )
    order = Window.partitionBy(*keys).orderBy(BUCKET)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(
        *[F.col(k).alias(f"_k_{k}") for k in by],
        *[F.coalesce(F.sum(f"_s_{c}").over(before), F.lit(0)).alias(f"_cs_{c}") for c in sums],
        *[F.last(f"_l_{c}", ignorenulls=True).over(before).alias(f"_cl_{c}") for c in lasts],
        *[F.max(f"_m_{c}").over(before).alias(f"_cm_{c}") for c in maxes],
        *[F.lag(f"_p_{c}").over(order).alias(f"_cp_{c}") for c in prevs],
        *([F.lead("_first").over(order).alias("_cn")] if nexts else []),
    )
    if not keys:
        # One row per bucket: at most 65,537 (IPv4), or the shuffle partitions (IPv6).
        carry = F.broadcast(carry)

    line = Window.partitionBy(*by).orderBy(pos)
    upto = line.rowsBetween(Window.unboundedPreceding, 0)
    earlier = line.rowsBetween(Window.unboundedPreceding, -1)
    local = df.select(
        "*",
        *[F.sum(c).over(upto).alias(f"_rs_{c}") for c in sums],
        *[F.last(c, ignorenulls=True).over(upto).alias(f"_rl_{c}") for c in lasts],
        *[F.max(c).over(earlier).alias(f"_rm_{c}") for c in maxes],
        *[F.lag(c).over(line).alias(f"_rp_{c}") for c in prevs],
        *([F.row_number().over(line).alias("_rn")] if prevs else []),
        *([F.lead(pos).over(line).alias("_rx")] if nexts else []),
    )
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys],
                  F.col(BUCKET) == F.col(f"_k_{BUCKET}"))
    return local.join(carry, same).select(
        *[c for c in df.columns if keep_bucket or c != BUCKET],
        *[(F.col(f"_cs_{c}") + F.col(f"_rs_{c}")).alias(f"run_{c}") for c in sums],
        *[F.coalesce(f"_rl_{c}", f"_cl_{c}").alias(f"last_{c}") for c in lasts],
        *[F.greatest(f"_rm_{c}", f"_cm_{c}").alias(f"top_{c}") for c in maxes],
        *[F.when(F.col("_rn") == 1, F.col(f"_cp_{c}")).otherwise(F.col(f"_rp_{c}")).alias(f"prev_{c}") for c in prevs],
        *([F.coalesce("_rx", "_cn").alias("next_pos")] if nexts else []),
    )
