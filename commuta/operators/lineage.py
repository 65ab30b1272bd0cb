"""Cutting lineage where an expensive result is read more than once."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` names it.

    A local session without the setting gets a temporary folder; a cluster session without it is refused.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="run-"))
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` in the shared folder; the result survives the loss of executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def written_table(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Like a checkpoint it survives lost executors, and later readers take only the columns they need.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
