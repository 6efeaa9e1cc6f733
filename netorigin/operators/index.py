"""A stored lookup index: disjoint intervals filed under address cells, built once and read by batch and stream.

The address space is cut by a radix split that the data decides: a prefix that holds more than `CELL_ROWS` interval starts is cut into 16, so cells are small where
intervals are dense and large where there are none, in both families alike.  Cells cover the whole space without overlap.  Every interval is stored whole under each
cell it touches.  Files hold runs of cells (`block` is the partition column), and a small directory lists each cell with its block.

A lookup masks an address to the few cell lengths that occur, keeps the one cell that exists, and compares the address with the rows of that cell.  The
lengths with the fewest cells, together below `BROADCAST_CELLS`, are broadcast; only those with more are joined by shuffle, a point row once for each.  Nothing is
scanned, sorted or checkpointed, so the same code answers a batch or a stream.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netorigin.functions.space import unbias, v6
from netorigin.operators.lineage import cut
from netorigin.operators.ranges import range_join

STEP = 4
CELL_ROWS = 64
BLOCK_ROWS = 1_000_000
BROADCAST_CELLS = 500_000  # rows of some 40 bytes


def child_net(space, net: Column, length: Column, number: Column) -> Column:
    """Network of the `number`-th of the 16 parts of net/length."""
    shift = lambda by: F.call_function("shiftleft", number.cast("bigint"), by.cast("int"))
    if space.version == 4:
        return net + shift(F.lit(32 - STEP) - length)
    high = length < 64
    hi, lo = unbias(net["hi"]), unbias(net["lo"])
    return v6(F.when(high, hi.bitwiseOR(shift(F.lit(64 - STEP) - F.least(length, F.lit(64 - STEP))))).otherwise(hi),
              F.when(high, lo).otherwise(lo.bitwiseOR(shift(F.lit(128 - STEP) - F.greatest(length, F.lit(64))))))


def cells_of(starts: DataFrame, space, most: int = CELL_ROWS) -> DataFrame:
    """(net, len) of cells that cover the space; none holds more than `most` of the distinct `pos` of `starts`.

    Counts are kept per prefix of each level, added up before the shuffle.
    """
    levels = F.array(*[F.lit(n) for n in range(0, space.bits + 1, STEP)])
    counts = (starts.select("pos", F.explode(levels).alias("len")).select("len", space.mask(F.col("pos"), F.col("len")).alias("net"))
              .groupBy("net", "len").agg(F.count("*").alias("n")))
    heavy = cut(counts.filter((F.col("n") > most) & (F.col("len") < space.bits)).select("net", "len"))
    parts = heavy.select(F.col("net").alias("_net"), F.col("len").alias("_len"), F.explode(F.sequence(F.lit(0), F.lit((1 << STEP) - 1))).alias("_part")).select(
        child_net(space, F.col("_net"), F.col("_len"), F.col("_part")).alias("net"), (F.col("_len") + STEP).alias("len"))
    lowest = F.lit(0).cast("bigint") if space.version == 4 else v6(F.lit(0).cast("bigint"), F.lit(0).cast("bigint"))
    root = starts.sparkSession.range(1).select(lowest.alias("net"), F.lit(0).alias("len"))
    return root.unionByName(parts).join(heavy, ["net", "len"], "left_anti")


def write_index(intervals: DataFrame, space, payload: list[str], path: str, cell_rows: int = CELL_ROWS, block_rows: int = BLOCK_ROWS) -> None:
    """Store the disjoint `intervals` (range_start, range_end, payload) at `path`: `rows` by block, and the directory `cells`.

    A cell without intervals is listed with a null block.  Null bounds give no row.  An empty table is one empty cell.
    """
    spark = intervals.sparkSession
    kept = cut(intervals.select("range_start", "range_end", *payload).filter("range_start is not null and range_end is not null"))
    cells = cut(cells_of(kept.select(F.col("range_start").alias("pos")), space, cell_rows))
    spans = cells.select(F.col("net").alias("range_start"), space.last(F.col("net"), F.col("len")).alias("range_end"), "net", "len")
    found = range_join(spans, kept, space)
    rows = found.select(F.col("net").alias("cell_net"), F.col("len").alias("cell_len"), *[F.col(f"r_{c}").alias(c) for c in ("range_start", "range_end", *payload)])
    files = int(kept.count() // block_rows + 1)
    rows.withColumn("block", F.lit(0)).limit(0).coalesce(1).write.parquet(f"{path}/shape")  # the columns, also of an empty index
    (rows.repartitionByRange(files, "cell_net").withColumn("block", F.spark_partition_id()).sortWithinPartitions("cell_net", "range_start")
     .write.partitionBy("block").parquet(f"{path}/rows"))
    filed = read_rows(spark, path).groupBy("cell_net", "cell_len").agg(F.min("block").alias("block"), F.count("*").alias("n"))
    (cells.join(filed, (F.col("net") == F.col("cell_net")) & (F.col("len") == F.col("cell_len")), "left").select("net", "len", "block", F.coalesce("n", F.lit(0)).alias("n"))
     .repartitionByRange(int(cells.count() // block_rows + 1), "net").sortWithinPartitions("net").write.parquet(f"{path}/cells"))


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(spark.read.parquet(f"{path}/shape").schema).parquet(f"{path}/rows")


@dataclass
class StoredIndex:
    """An index on disk; the driver knows the cell lengths that occur and how many cells there are."""

    rows: DataFrame
    cells: DataFrame
    space: object
    lengths: list[int] = field(default_factory=list)
    count: int = 0
    few: list[int] = field(default_factory=list)  # lengths with few cells, together below `BROADCAST_CELLS`

    @classmethod
    def open(cls, spark: SparkSession, path: str, space) -> StoredIndex:
        cells = spark.read.parquet(f"{path}/cells")
        got = cells.groupBy("len").count().collect()  # at most 9 or 33 rows
        few, sofar = [], 0
        for n, length in sorted((r["count"], r["len"]) for r in got):
            sofar += n
            if sofar <= BROADCAST_CELLS:
                few.append(length)
        return cls(read_rows(spark, path), cells, space, sorted(r["len"] for r in got), sum(r["count"] for r in got), sorted(few))

    @property
    def payload(self) -> list[str]:
        return [c for c in self.rows.columns if c not in ("cell_net", "cell_len", "block")]

    def located(self, points: DataFrame, addr: str) -> DataFrame:
        """`points` with the one cell (_net, _len, _block) of each address; null addresses give no row."""
        def among(lengths: list[int], hint) -> DataFrame:
            tried = points.withColumn("_try", F.explode(F.array(*[F.lit(n) for n in lengths]))).withColumn("_at", self.space.mask(F.col(addr), F.col("_try")))
            cells = self.cells.filter(F.col("len").isin(lengths)).select(F.col("net").alias("_net"), F.col("len").alias("_len"), F.col("block").alias("_block"))
            return tried.join(hint(cells), (F.col("_at") == F.col("_net")) & (F.col("_try") == F.col("_len"))).drop("_try", "_at")

        # The cells do not overlap, so an address has one cell in one of the two parts.
        many = [n for n in self.lengths if n not in self.few]
        parts = [among(ls, hint) for ls, hint in ((self.few, F.broadcast), (many, lambda cells: cells)) if ls]
        return reduce(lambda a, b: a.unionByName(b), parts)

    def lookup(self, points: DataFrame, addr: str = "ip", how: str = "inner") -> DataFrame:
        """Every row of `points` with the interval that contains its address; with `how="left"` rows outside all intervals stay, with nulls.

        Rows with a null address give no row.  A hot address is one key on the point side, which adaptive execution splits; the stored side has a few rows a cell.
        """
        at = self.located(points.filter(F.col(addr).isNotNull()), addr)
        rows = self.rows.select("cell_net", "cell_len", *self.payload)
        inside = (F.col("_net") == F.col("cell_net")) & (F.col("_len") == F.col("cell_len")) & (F.col("range_start") <= F.col(addr)) & (F.col(addr) <= F.col("range_end"))
        return at.join(rows, inside, how).select(*points.columns, *self.payload)

    def lookup_few(self, addresses: DataFrame, addr: str = "ip") -> DataFrame:
        """As `lookup` for a handful of addresses: the directory names their blocks first, and only those are listed and read."""
        at = self.located(addresses.filter(F.col(addr).isNotNull()), addr)
        blocks = [r[0] for r in at.filter("_block is not null").select("_block").distinct().collect()]
        return StoredIndex(self.rows.filter(F.col("block").isin(blocks)), self.cells, self.space, self.lengths, self.count, self.few).lookup(addresses, addr)
