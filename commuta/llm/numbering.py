"""Consecutive numbers in sorted order without a single task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commuta.operators.lineage import written_table

#: ``monotonically_increasing_id`` counts the rows of a partition in its lower bits.
_PART_BITS = 33


def in_order(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` sorted into ranges and written, with ``at``: numbers that ascend with the order, with gaps between ranges.

    Null comes first, strings go by code points. Of rows that are equal in ``order`` a range may hold any part, so even
    one value on a third of the rows is dealt to several ranges.
    """
    apart = rows.withColumn("_row", F.monotonically_increasing_id())
    dealt = apart.repartitionByRange(*[F.col(c) for c in order], F.col("_row")).sortWithinPartitions(*order, "_row")
    return written_table(dealt.drop("_row").withColumn("at", F.monotonically_increasing_id()), "ordered")


def part() -> Column:
    """The range of a row of :func:`in_order`."""
    return F.shiftright("at", _PART_BITS)


def numbered(ordered: DataFrame, group: str, name: str) -> DataFrame:
    """``ordered`` with ``name``: 0, 1, ... within each ``group``, the leading column of the order. Null is a group too.

    Only one row for each group and range takes part in the sums.
    """
    parts = ordered.groupBy(part().alias("_part"), F.col(group).alias("_group")).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("at").alias("_first")
    )
    before = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    found = ordered.join(parts, (part() == F.col("_part")) & F.col(group).eqNullSafe(F.col("_group")))
    return found.select(*ordered.columns, (F.col("at") - F.col("_first") + F.col("_before")).alias(name))
