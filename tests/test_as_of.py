"""The merge as-of join against a search in a sorted list."""

import bisect
import random

import pytest
from pyspark.sql import functions as F

from commuta.operators import skims as sk
from commuta.operators.joins import as_of


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("partitions", [1, 7])
def test_last_mark(spark, strict, partitions):
    rng = random.Random(partitions)
    marks = sorted(rng.sample(range(0, 1000), 30))
    probes = [(k, None if k % 50 == 7 else rng.choice([rng.randrange(-10, 1010), rng.choice(marks), 500])) for k in range(600)]
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = as_of(
            spark.createDataFrame(probes, "id int, at long"), spark.createDataFrame([(m, f"m{m}", None) for m in marks], "at long, name string, more int"), "at", strict
        )
        assert got.columns == ["id", "at", "name", "more"]
        rows = {r.id: (r.at, r.name) for r in got.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    find = bisect.bisect_left if strict else bisect.bisect_right
    for k, at in probes:
        n = find(marks, at) if at is not None else 0
        assert rows[k] == (at, f"m{marks[n - 1]}" if n else None), k
    assert len(rows) == len(probes)


def test_no_marks_and_no_probes(spark):
    marks = spark.createDataFrame([(1, "a")], "at long, name string")
    probes = spark.createDataFrame([(5, 3)], "id long, at long")
    assert [tuple(r) for r in as_of(probes, marks.limit(0), "at").collect()] == [(5, 3, None)]
    assert as_of(probes.limit(0), marks, "at").count() == 0


def test_one_hot_value_is_dealt_to_several_ranges(spark, rows):
    """A third of the probes at one value: each finds its mark, and no range takes all of them."""
    probes = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, 77).otherwise(F.col("id") % 1000).alias("at"))
    marks = spark.createDataFrame([(k * 10, k) for k in range(100)], "at long, mark long")
    got = as_of(probes, marks, "at")
    assert got.filter("mark <> floor(at / 10)").isEmpty() and got.count() == 30_000
    assert got.filter("mark is null").isEmpty()


def test_intervals_by_merge(spark, rows):
    times = spark.createDataFrame([(k, float(k * 13 % 1500)) for k in range(300)], "id long, minute double")
    iskims = spark.createDataFrame([(e,) for e in (60, 360, 720, 1440)], "interval_end int")
    merged = sk.with_interval_merged(times, F.col("minute"), iskims, "end")
    assert rows(merged, "id", "end") == rows(sk.with_interval(times, F.col("minute"), iskims, "end"), "id", "end")
