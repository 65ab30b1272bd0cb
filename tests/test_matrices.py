"""The matrices of a skim build."""

from pyspark.sql import functions as F

from commuta.operators import skims as sk
from commuta.plans import yearly
from workload import skims as ws


def test_distance_matrices_for_car_bicycle_and_foot(tables):
    zones = ws.taz(tables)
    out = yearly.build_skims(tables.skim_raw, zones, yearly.SkimConfig(periods=["AM"], highway_paths=["SOV"], transit_paths=["WLK_LOC_WLK"]))
    rows = out["matrices"].filter(F.col("name").startswith("DIST")).collect()
    matrices = {m: {r.o_idx: r["values"] for r in rows if r.name == m} for m in ("DIST", "DISTBIKE", "DISTWALK")}
    assert len(rows) == 3 * zones.count() and len(matrices["DIST"]) == zones.count()
    assert matrices["DISTBIKE"] == matrices["DISTWALK"] == matrices["DIST"]


def test_matrices_in_stretches_store_positions_once(spark, tmp_path):
    """The matrices of a stretch follow one another; apart from the first of the three, positions must take hardly any space."""
    n = 40000
    packed = spark.range(1, 3).select(F.col("id").cast("string").alias("origin"), F.col("id").cast("int").alias("o_idx"), F.array_repeat(F.lit(1.5), n).alias("DIST"))

    def stored(name, matrices):
        matrices.select("name", "o_idx", "first", F.posexplode("values").alias("pos", "value")).select(
            "name", "o_idx", (F.col("first") + F.col("pos") + 1).alias("pos"), "value").coalesce(1).write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name)), sum(f.stat().st_size for f in (tmp_path / name).glob("*.parquet"))

    whole, apart = stored("whole", sk.distance_matrices(packed).withColumn("first", F.lit(0)))
    parts, size = stored("parts", sk.distance_matrices(packed, sk.STRETCH))
    assert parts.count() == 2 * 3 * n and parts.exceptAll(whole).count() == 0
    assert size < apart / 2


def test_matrices_in_stretches_end_where_the_zones_end(spark, rows):
    packed = spark.createDataFrame([("1", 1, [5.0, None, 7.0]), ("2", 2, [])], "origin string, o_idx int, DIST array<double>")
    assert rows(sk.distance_matrices(packed, 2)) == sorted((m, 1, *v) for m in ("DIST", "DISTBIKE", "DISTWALK") for v in ((0, [5.0, None]), (2, [7.0])))
