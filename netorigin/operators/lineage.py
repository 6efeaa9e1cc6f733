"""Cut a long lineage at a durable place."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir`.

    Only a local session without the setting (tests) gets a folder of its own; on a
    cluster a machine's folder would hide one executor's files from the others.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return tempfile.mkdtemp(prefix="netorigin-")


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder of `spark.checkpoint.dir`.

    A table that is read several times is computed once, the plan stays linear, and
    the rows survive the loss of executors.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)
