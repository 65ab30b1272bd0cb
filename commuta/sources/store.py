"""Versions of store tables: a table can be replaced by one that is read from it.

The first version of a stage and year is a plain partition folder. Each later one is a folder of its own under ``_versions``, which
folder listings leave out, and becomes the current one by a single row appended to ``_log``. That append is one file
that its job moves into place when it commits: readers see the old version up to then and the new one from then on, and a
job that ends before leaves the old one. Versions that are no longer current stay, since lazy results may still read them.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = "stage string, year int, version string, number long"


def _log(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    try:
        return spark.read.schema(LOG).parquet(f"{root}/{table}/_log")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def replaced(spark: SparkSession, root: str, table: str) -> dict[tuple[str, int], str]:
    """The current version of each stage and year that has been replaced, by (stage, year): a few rows."""
    log = _log(spark, root, table)
    if log is None:
        return {}
    current = log.groupBy("stage", "year").agg(F.max_by("version", F.struct("number", "version")).alias("version"))
    return {(r.stage, r.year): f"{root}/{table}/_versions/{r.version}" for r in current.collect()}


def replace(df: DataFrame, root: str, table: str, stage: str, year: int) -> None:
    """Make ``df`` the current version of a stage and year; it may read the version that it replaces."""
    spark, version = df.sparkSession, uuid.uuid4().hex
    df.write.parquet(f"{root}/{table}/_versions/{version}")
    log = _log(spark, root, table)
    number = 1 + ((log.agg(F.max("number")).first()[0] or 0) if log is not None else 0)
    entry = spark.createDataFrame([(stage, year, version, number)], LOG).coalesce(1)
    entry.write.mode("append").parquet(f"{root}/{table}/_log")
