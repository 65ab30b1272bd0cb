"""Bitmaps of hashed keys: a bounded broadcast that tells most rows apart from a set of any size without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a bitmap: at most SLOTS / 64 broadcast rows of 16 bytes, 4 MB.
SLOTS = 1 << 24


def _slot(key: list[str]) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(SLOTS))


def bitmap(keys: DataFrame, key: list[str]) -> DataFrame:
    """The slots of all keys: ``word`` (slot / 64) and ``bits``."""
    return (
        keys.select(_slot(key).alias("slot"))
        .groupBy(F.shiftright("slot", 6).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 as int)))").alias("bits"))
    )


def marked(rows: DataFrame, key: list[str], marks: DataFrame) -> DataFrame:
    """``rows`` with ``open``: false only where the bitmap rules out that the row's key is in the set."""
    slot = _slot(key)
    found = rows.join(F.broadcast(marks), F.shiftright(slot, 6) == F.col("word"), "left")
    hit = F.getbit("bits", slot.bitwiseAND(F.lit(63)).cast("int")) == 1
    return found.select(*rows.columns, F.coalesce(hit, F.lit(False)).alias("open"))


def order_key(docs: DataFrame, packed: str) -> Column:
    """A hash of all columns of the struct ``packed`` that can be hashed, to choose among repeated rows."""
    return F.xxhash64(*[F.col(f"{packed}.`{c}`") for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind])
