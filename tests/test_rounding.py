"""Six decimals in plain arithmetic, beside Spark's own rounding; arrays of unpacked rows are made once."""

import math
import random

from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from workload import registry


def test_plain_rounding_is_that_of_round(spark):
    dice = random.Random(3)
    halves = [s * (n + 0.5) / 1e6 for n in (0, 1, 2, 7, 123456789, 2**40) for s in (1, -1)]
    near = [math.nextafter(h, to) for h in halves for to in (math.inf, -math.inf)]
    edges = [0.0, -0.0, 4.9999999999999994e-07, -3e-7, 2.0**52 / 1e6, (2.0**52 + 1) / 1e6, 2.0**53, 1e300, -1e300, 1.7e308, 5e-324, math.nan, math.inf, -math.inf, None]
    rest = [dice.uniform(-1, 1) * 10 ** dice.randint(-9, 13) for _ in range(4000)]
    df = spark.createDataFrame([(v,) for v in halves + near + edges + rest], "v double")
    v = F.col("v")
    got = df.select("v", registry.six_decimals_of_many(v).alias("got"), registry.six_decimals(v).alias("want")).collect()
    assert [r for r in got if (r.got is None) != (r.want is None) or repr(r.got) != repr(r.want)] == []


def test_results_are_rounded_without_decimals(spark, sf_dir):
    plan = entry_points.queries()["k05_od_complete"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "round(" not in plan


def test_arrays_of_unpacked_rows_are_made_once(spark, tables):
    from commuta.operators import skims as sk
    from workload import skims as ws

    plan = ws.transit(tables, periods=["AM"], paths=["WLK_LOC_WLK"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode(sequence(" in plan and plan.count("flatten(concat(array(") == len({s for s in sk.TRANSIT_MEASURES.values() if s})


def test_no_zones_make_no_rows(spark):
    from commuta.operators import skims as sk

    packed = spark.createDataFrame([("AM", "1", 1, []), ("AM", "2", 2, [5.0, None]), ("AM", "3", 3, None)], "timePeriod string, origin string, o_idx int, v array<double>")
    zones = spark.createDataFrame([("1", 1), ("2", 2), ("3", 3)], "zone_id string, idx int")
    assert sorted(map(tuple, sk.unpack_od(packed, zones).collect()), key=repr) == [("AM", "2", "1", 5.0), ("AM", "2", "2", None)]


def test_wide_rows_are_rounded_by_round(spark):
    """Methods of too many expressions are not compiled, so wide rows go on with Spark's function."""
    df = spark.range(3).select(*[(F.col("id") / (i + 7)).alias(f"c{i}") for i in range(registry.MANY_DOUBLES + 1)])
    assert "round(" in registry.rounded(df)._jdf.queryExecution().analyzed().toString()
    narrow = df.drop("c0")
    assert "round(" not in registry.rounded(narrow)._jdf.queryExecution().analyzed().toString()
    assert registry.rounded(df).drop("c0").collect() == registry.rounded(narrow).collect()
