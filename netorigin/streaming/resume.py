"""Resumable batch over a growing table: each run handles only rows not yet done."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def todo(packets: DataFrame, done: DataFrame, key: str = "asn") -> DataFrame:
    return packets.join(done.select(key).distinct(), key, "left_anti")


def process_batch(work: Callable[[DataFrame], DataFrame], done_path: str, key: str = "asn"):
    """A foreachBatch function: anti-join with the done table, work, append.

    The output of batch n goes to its own directory, written in overwrite mode, so
    a batch replayed after a failure replaces its own output and nothing else.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.dropDuplicates([key])
        if batch_id > 0:
            # Batches below this one only: a replay must not see its own earlier output as done.
            done = spark.read.option("basePath", done_path).parquet(f"{done_path}/batch=*").filter(f"batch < {batch_id}")
            rows = todo(rows, done, key)
        work(rows).write.mode("overwrite").parquet(f"{done_path}/batch={batch_id}")

    return run
