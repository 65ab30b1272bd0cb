"""Documents as Arrow batches of bounded size, each text sent once; what workers remember between tasks."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a batch between Spark and a Python worker, set in the session where it still has Spark's own default.
BATCH_BYTES = 8 << 20
_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
_SPARKS_OWN = ("67108864", "67108864b", "64MB", "64m")


def bounded(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Keep batches small: a worker holds a batch several times over while it works on it. A size set before stays."""
    if spark.conf.get(_SETTING, None) in (None, *_SPARKS_OWN):
        spark.conf.set(_SETTING, f"{most}b")


def carrying(docs: DataFrame, carry: list[str], text: str) -> DataFrame:
    """``carried``, a struct of ``carry``, and ``body`` with the text unless it is carried already."""
    bounded(docs.sparkSession)
    carried = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.struct(F.lit(0).alias("_"))
    return docs.select(carried.alias("carried"), *([] if text in carry else [F.col(f"`{text}`").alias("body")]))


def bodies(batch: pa.RecordBatch, text: str) -> pa.Array:
    """The texts of a batch that ``carrying`` has made."""
    return batch["body"] if "body" in batch.schema.names else batch["carried"].field(text)


#: What frees the memory that an operator's tasks leave in this worker for its next tasks.
_FREE: dict[str, Callable[[], None]] = {}


def alone(operator: str, free: Callable[[], None] | None = None) -> None:
    """Called as a task begins: frees what tasks of other operators have left in this worker, and remembers ``free``.

    Spark uses a worker again for whatever stage comes next. Tasks of one operator find their memory as they left it; of
    several operators that follow one another only the last one's takes room.
    """
    others = [name for name in _FREE if name != operator]
    for name in others:
        _FREE.pop(name)()
    if others:
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library alone
        if trim is not None:
            trim(0)
    if free is not None:
        _FREE[operator] = free
