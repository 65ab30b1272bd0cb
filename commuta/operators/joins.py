"""Join and running-total shapes that hold up when one key carries a third of the rows.

No join carries a broadcast hint: Spark compares each side's size with
``spark.sql.autoBroadcastJoinThreshold`` and shuffles above it. Sides that are unfolded
into many rows first are always shuffled (``shuffled``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commuta.operators.lineage import cut_lineage, written_table


def lookup(rows: DataFrame, dim: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Attach columns of ``dim`` (one row per key) to every row.

    A hot key's partition of ``rows`` is split at run time by adaptive execution, from the sizes the
    shuffle has measured (``session.SETTINGS``); nothing is repeated where no key is hot.
    """
    return rows.join(dim, on, how)


def running_totals(
    df: DataFrame, chunk: Column, order: str, totals: dict[str, str]
) -> DataFrame:
    """Cumulative sums over the whole table in ``order``; ``totals`` maps output to input.

    ``chunk`` must not decrease along ``order``. Sums run inside each chunk in parallel;
    only one row per chunk takes part in the final pass over chunk offsets. The input is
    checkpointed, since both passes read it.
    """
    chunked = cut_lineage(df.withColumn("_chunk", chunk))
    inside = Window.partitionBy("_chunk").orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    before = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = chunked.groupBy("_chunk").agg(
        *[F.sum(src).alias(f"_t_{out}") for out, src in totals.items()]
    )
    offsets = sums.select(
        F.col("_chunk").alias("_chunk_of"),
        *[F.coalesce(F.sum(f"_t_{out}").over(before), F.lit(0)).alias(f"_o_{out}") for out in totals],
    )
    within = chunked.select("*", *[F.sum(src).over(inside).alias(f"_i_{out}") for out, src in totals.items()])
    return within.join(offsets, F.col("_chunk").eqNullSafe(F.col("_chunk_of"))).select(
        *df.columns, *[(F.col(f"_i_{out}") + F.col(f"_o_{out}")).alias(out) for out in totals]
    )


def as_of(probes: DataFrame, marks: DataFrame, at: str, strict: bool = False) -> DataFrame:
    """Each probe with the columns of the last mark at or before it in ``at``; before it, if ``strict``. NULL without one.

    Marks have distinct values of ``at`` and further columns that probes lack. Marks and probes are sorted together into
    ranges, one row each, and the last mark is carried along; over the borders of ranges goes one row a range. Probes of
    one value are dealt to several ranges where there are many. A probe with a NULL in ``at`` has no mark.
    """
    given = [c for c in marks.columns if c != at]
    kept = [c for c in probes.columns if c != at]
    mark, probe = F.struct(*[F.col(c) for c in given]).alias("_mark"), F.struct(*[F.col(c) for c in kept]).alias("_probe")
    types = {n: df.select(c).schema[n].dataType for df, c, n in ((marks, mark, "_mark"), (probes, probe, "_probe"))}
    first = F.lit(1 if strict else 0)
    both = marks.filter(F.col(at).isNotNull()).select(at, first.alias("_kind"), mark, F.lit(None).cast(types["_probe"]).alias("_probe")).unionByName(
        probes.select(at, (1 - first).alias("_kind"), F.lit(None).cast(types["_mark"]).alias("_mark"), probe)
    ).withColumn("_row", F.monotonically_increasing_id())
    dealt = both.repartitionByRange(at, "_kind", "_row").sortWithinPartitions(at, "_kind", "_row").drop("_kind", "_row")
    ordered = written_table(dealt.withColumn("_place", F.monotonically_increasing_id()), "sorted").withColumn("_range", F.shiftright("_place", 33))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    last = F.max_by("_mark", F.when(F.col("_mark").isNotNull(), F.col("_place")))
    carried = ordered.groupBy("_range").agg(last.alias("_last")).select("_range", F.last("_last", ignorenulls=True).over(before).alias("_before"))
    inside = Window.partitionBy("_range").orderBy("_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = ordered.withColumn("_here", F.last("_mark", ignorenulls=True).over(inside)).filter("_probe is not null")
    found = found.join(carried, "_range").withColumn("_found", F.when(F.col(at).isNotNull(), F.coalesce("_here", "_before")))
    out = {c: F.col(f"_probe.`{c}`") for c in kept} | {at: F.col(at)}
    return found.select(*[out[c].alias(c) for c in probes.columns], *[F.col(f"_found.`{c}`").alias(c) for c in given])


def shuffled(df: DataFrame) -> DataFrame:
    """Keep a join side that unfolding has multiplied from being broadcast: Spark sizes it before its explode."""
    return df.hint("merge")


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by ``keys`` over as many tasks as a shuffle has.

    Spark sizes tasks by bytes, so rows that are small but take long to work on, as shapes do, would all be in one task.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def missing_keys(rows: DataFrame, key: str, ref: DataFrame, ref_key: str) -> DataFrame:
    """Distinct key values of ``rows`` that ``ref`` lacks."""
    return rows.select(F.col(key).alias("_k")).distinct().join(
        ref.select(F.col(ref_key).alias("_k")).distinct(), "_k", "left_anti"
    ).select(F.col("_k").alias(key))
