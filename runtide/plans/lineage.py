"""Cutting lineage with tables in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder named in `spark.checkpoint.dir`; a temporary one only for local sessions without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="runtide-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has used yet."""
    return f"{shared_folder(spark).rstrip('/')}/runtide/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str = "settled") -> DataFrame:
    """Writes `df` once and reads it back, for frames that several outputs are made from.

    A parquet table rather than `checkpoint()`: it survives the loss of executors just as well, and
    later reads prune columns, push filters down and know the size of what they join with.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle_counted(df: DataFrame, label: str = "settled") -> tuple[DataFrame, int]:
    """`settle`, and the number of rows, observed while they are written: counting them costs no job of its own."""
    seen = Observation()
    settled = settle(df.observe(seen, F.count(F.lit(1)).alias("rows")), label)
    return settled, seen.get["rows"]
