"""One key holds a third of all rows: results stay whole and the rows are shared out."""

import pytest
from pyspark.sql import functions as F

from commuta.operators import demand, geo, landuse
from commuta.operators.joins import lookup, running_totals, shuffled
from commuta.plans import activity
from commuta.session import SETTINGS

N = 30000


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows on key 0, a third on NULL, the rest spread."""
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id") % 1000)
    return spark.range(N).select("id", key.cast("bigint").alias("k"))


def test_lookup_is_whole(spark, hot, rows):
    dim = spark.range(900).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    assert rows(lookup(hot, dim, ["k"]), "id", "k", "v") == rows(hot.join(dim, "k", "left"), "id", "k", "v")
    assert lookup(hot, dim, ["k"], how="inner").count() == hot.join(dim, "k").count()


def test_lookup_splits_a_hot_key(spark):
    """One key at 60 % of the rows: the largest task stays under twice the mean."""
    settings = SETTINGS | {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "64",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "32k",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        n = 400_000
        rows_ = spark.range(n, numPartitions=32).select("id", F.when(F.col("id") % 5 < 3, 7).otherwise(F.col("id") % 5000).alias("k"), F.md5(F.col("id").cast("string")).alias("pad"))
        dim = spark.range(5000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
        sizes = [r.n for r in lookup(rows_, dim, ["k"]).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.max("pad")).collect()]
        assert sum(sizes) == n and max(sizes) < 2 * n / len(sizes) and max(sizes) < 0.1 * n
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_running_totals_equal_one_window(spark):
    df = spark.range(5000).select(F.col("id").alias("t"), (F.col("id") % 7).alias("n")).repartition(5)
    out = running_totals(df, F.floor(F.col("t") / 300), "t", {"cum": "n"}).collect()
    total = 0
    for r in sorted(out, key=lambda r: r.t):
        total += r.n
        assert r.cum == total


@pytest.fixture(scope="module")
def population(spark):
    """Half of the households without a known block; one block holds half of the rest."""
    block = F.when(F.col("id") % 2 == 1, F.lit(None)).when(F.col("id") % 4 == 0, F.lit("484530000011000")).otherwise(
        F.concat(F.lit("48453"), F.lpad((F.col("id") % 97).cast("string"), 6, "0"), F.lit("1001")))
    return spark.range(8000).select(F.col("id").alias("household_id"), block.alias("block_id"))


def test_unplaced_households_follow_the_placed(spark, population, rows):
    zones = population.select("block_id").distinct().filter("block_id is not null").withColumn("zone", F.lit(1))
    out = demand.place_unplaced(population, zones, 5)
    again = demand.place_unplaced(population.repartition(13), zones, 5)
    assert rows(out) == rows(again) and out.count() == 8000 and out.filter("block_id is null").count() == 0
    assert out.join(population.filter("block_id is not null"), ["household_id", "block_id"]).count() == 4000
    drawn = out.join(population.filter("block_id is null").select("household_id"), "household_id")
    share = drawn.filter("block_id = '484530000011000'").count() / 4000
    assert abs(share - 0.5) < 0.03
    assert demand.place_unplaced(population, zones, 6).exceptAll(out).count() > 0


def test_placement_without_any_placed_household_fails(spark, population):
    nowhere = spark.createDataFrame([], "block_id string, zone int")
    with pytest.raises(Exception, match="no household has a known block"):
        demand.place_unplaced(population, nowhere, 5).collect()


def test_sampling_is_partition_independent(spark, rows):
    h = spark.range(10000).select(F.col("id").alias("household_id"))
    a, b = (demand.sample_households(h.repartition(n), 0.25, 9) for n in (1, 11))
    assert rows(a) == rows(b) and abs(a.count() - 2500) < 150
    persons = spark.range(20000).select(F.col("id").alias("person_id"), (F.col("id") % 10000).alias("household_id"))
    assert demand.members_of(persons, a).count() == 2 * a.count()


def test_points_on_one_spot(spark):
    zones = geo.zone_table(spark.createDataFrame([(1, "POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))")], "z int, geometry string"), "z").withColumnRenamed("TAZ", "zone_id")
    x = F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.rand(3) * 2)
    pts = spark.range(N).select("id", x.alias("x"), F.lit(0.5).alias("y"))
    out = geo.points_to_zones(pts, zones)
    assert out.count() == N and out.filter("(x < 1) <> (zone_id is not null)").count() == 0


def test_reports_with_a_hot_person_and_planned_trip(spark, rows):
    a = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("person"),
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("trip"),
        F.lit(500.0).alias("start_time"), F.lit("WORK").alias("type"), F.concat(F.lit("m"), F.col("id") % 3).alias("mode"))
    p = spark.range(40).select(F.col("id").alias("person"), (F.col("id") + 10).alias("age"))
    t = spark.range(9000).select(F.col("id").alias("trip_id"), F.lit(0.0).alias("start_s"), F.col("id").cast("double").alias("end_s")).filter("trip_id > 0")
    out = activity.executed_activity_mode_share(a, p, t, 1)
    want = a.join(p.filter("age > 16"), "person").join(t.filter("end_s - start_s > 2"), a.trip == t.trip_id).groupBy("mode").count()
    assert rows(out) == rows(want)


def test_fk_check_counts_every_row(spark, hot):
    blocks = spark.createDataFrame([("b",)], "block_id string")
    h = hot.select(F.col("id").alias("household_id"), F.when(F.col("k") == 0, "b").alias("block_id"))
    persons = hot.select("id", F.col("k").alias("household_id"))
    out = {r.check: r.violations for r in landuse.fk_check(h, persons, h, h.filter("block_id = 'b'"), blocks).collect()}
    bad = h.filter("block_id is null").count()
    assert out["households.block_id"] == out["jobs.block_id"] == bad and out["residential_units.block_id"] == 0
    assert out["persons.household_id"] == hot.filter("k is null").count()


def test_unfolded_side_is_not_broadcast(spark):
    side = shuffled(spark.range(10).select(F.col("id").alias("k")))
    plan = spark.range(100).select(F.col("id").alias("k")).join(side, "k")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan


def test_a_block_of_any_size_is_not_unfolded(spark):
    zones = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1)], "block_id string, zone int")
    placed = spark.range(50_000).select(F.col("id").alias("household_id"), F.when(F.col("id") < 49_990, "b").when(F.col("id") < 49_995, "a").otherwise("c").alias("block_id"))
    homeless = spark.range(50_000, 52_000).select(F.col("id").alias("household_id"), F.lit(None).cast("string").alias("block_id"))
    out = demand.place_unplaced(placed.unionByName(homeless), zones, 3)
    assert out.count() == 52_000 and out.filter("block_id is null").count() == 0
    assert out.filter("household_id >= 50000 and block_id = 'b'").count() > 1990
