"""Verdicts for a stream of addresses against the current lookup table.

Stateless: the stream is joined with a static table of block pieces by an
equi-join on the address block, so no watermark and no state store are needed.
The table is read again when the query restarts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netorigin.functions.space import V4
from netorigin.operators.classify import verdict_of
from netorigin.operators.ranges import bucket_pieces


def block_table(table: DataFrame, shift: int = 8) -> DataFrame:
    """Pieces of the IPv4 lookup table per /24 block: at most 256 pieces per block."""
    return bucket_pieces(table, shift)


def stream_verdicts(stream: DataFrame, table: DataFrame, addr: str = "ip", shift: int = 8) -> DataFrame:
    """stream(ip, ...) + verdict, rule, asn.  A left equi-join on the /24 block with a
    containment residual: at most one piece of a block contains the address, and a
    block has at most 256 pieces, whatever the size of the table or the stream."""
    p = block_table(table, shift)
    j = stream.withColumn("_block", F.shiftright(addr, shift)).join(
        p, (F.col("_block") == F.col("bucket")) & F.col(addr).between(F.col("range_start"), F.col("range_end")), "left")
    v = j.withColumn("v", verdict_of(F.col(addr), V4))
    return v.select(*stream.columns, "v.verdict", "v.rule",
                    F.when(~F.col("v.rule").startswith("special_"), F.col("asn")).alias("asn"))
