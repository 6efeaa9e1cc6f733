"""Figures of a build, counted while its tables are written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class BuildMetrics:
    """Writes tables and keeps what Spark observed of them on the way: no table is read again to be counted.

    An observation is one row of aggregates a write, added up in the tasks; that row is all that the driver gets.  A task that runs twice after a loss is observed
    once, as the write commits it once.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.values: dict[str, int] = {}

    def write(self, name: str, df: DataFrame, path: str, **measures: Column) -> None:
        """Write `df` as Parquet below `path`; its rows count as `name`, each measure as `name.measure`, null for an empty table's sums."""
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.cast("decimal(38,0)").alias(k) for k, c in measures.items()]).write.parquet(f"{path}/{name}")
        got = seen.get
        self.values[name] = got["rows"]
        self.values |= {f"{name}.{k}": None if got[k] is None else int(got[k]) for k in measures}

    def rows(self) -> DataFrame:
        """(metric, value), one row a figure; values as text, since IPv6 address counts pass 64 bits."""
        return self.spark.createDataFrame([(k, None if v is None else str(v)) for k, v in sorted(self.values.items())], "metric string, value string")
