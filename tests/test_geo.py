"""Geometry against brute force and hand-worked shapes."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from commuta.functions import geometry as gm
from commuta.operators import geo, landuse
from commuta.sources import readers

SQUARE_WITH_HOLE = "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0), (4 4, 4 6, 6 6, 6 4, 4 4))"
TWO_SQUARES = "MULTIPOLYGON (((20 0, 22 0, 22 2, 20 2, 20 0)), ((30 0, 34 0, 34 2, 30 2, 30 0)))"


@pytest.fixture(scope="module")
def zones(spark):
    raw = spark.createDataFrame([("1", SQUARE_WITH_HOLE), ("2", TWO_SQUARES), ("10", "POLYGON EMPTY"), ("3", "POLYGON ((8 8, 12 8, 12 12, 8 12, 8 8))")], "zone_id string, geometry string")
    return geo.zone_table(raw, "zone_id").withColumnRenamed("TAZ", "zone_id")


def test_zone_table_orders_by_number(zones):
    assert [r.zone_id for r in zones.orderBy("idx").collect()] == ["1", "2", "3", "10"]
    assert {r.zone_id: r.n for r in zones.select("zone_id", F.size("geometry").alias("n")).collect()} == {"1": 2, "2": 2, "3": 1, "10": 0}


def test_centroid_subtracts_holes_and_weighs_parts(zones):
    c = {r.zone_id: r.c for r in zones.select("zone_id", gm.centroid(F.col("geometry")).alias("c")).collect()}
    assert (c["1"].x, c["1"].y) == pytest.approx((5, 5))
    assert (c["2"].x, c["2"].y) == pytest.approx(((21 * 4 + 32 * 8) / 12, 1))
    assert c["10"].x is None


def test_points_in_holes_parts_overlaps_and_outside(spark, zones, rows):
    pts = [(1, 1.0, 1.0), (2, 5.0, 5.0), (3, 21.0, 1.0), (4, 25.0, 1.0), (5, 33.0, 1.9), (6, 9.0, 9.0), (7, 11.0, 11.0), (8, None, 1.0), (9, -50.0, 3.0)]
    out = geo.points_to_zones(spark.createDataFrame(pts, "id int, x double, y double"), zones, cell=3.0)
    assert rows(out, "id", "zone_id") == [(1, "1"), (2, None), (3, "2"), (4, None), (5, "2"), (6, "1"), (7, "3"), (8, None), (9, None)]


def test_points_to_zones_any_cell_size(spark, zones, rows):
    rng = random.Random(5)
    pts = spark.createDataFrame([(i, rng.uniform(-2, 36), rng.uniform(-2, 13)) for i in range(400)], "id int, x double, y double")
    results = {tuple(rows(geo.points_to_zones(pts, zones, cell=c), "id", "zone_id")) for c in (0.7, 5.0, 100.0)}
    assert len(results) == 1 and len(next(iter(results))) == 400


@pytest.mark.parametrize("seed", [1, 2])
def test_nearest_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    cands = [(f"c{i:03d}", rng.gauss(-98, 0.02), rng.gauss(30, 0.02)) for i in range(150)] + [("far", -60.0, -30.0), ("twin", -98.0, 30.0), ("aaa", -98.0, 30.0)]
    pts = [(i, rng.uniform(-98.2, -97.8), rng.uniform(29.8, 30.2)) for i in range(120)] + [(900, 100.0, 60.0), (901, -61.0, -30.0), (902, -98.0, 30.0)]
    got = {r.id: r.nearest_id for r in geo.nearest(
        spark.createDataFrame(pts, "id int, x double, y double"), spark.createDataFrame(cands, "id string, x double, y double"), 30.0).collect()}
    k, c = gm.METRES_PER_DEGREE, math.cos(math.radians(30.0))
    for i, x, y in pts:
        want = min(((x * k * c - a * k * c) ** 2 + (y * k - b * k) ** 2, n) for n, a, b in cands)[1]
        assert got[i] == want, i
    assert got[902] == "aaa" and got[901] == "far"


def test_nearest_takes_mean_latitude(spark):
    c = spark.createDataFrame([("a", 0.0, 60.0), ("b", 1.5, 61.0)], "id string, x double, y double")
    p = spark.createDataFrame([(1, 1.0, 60.0)], "id int, x double, y double")
    assert geo.nearest(p, c).first().nearest_id == "a"


def ring(*pts, hole=False):
    return (hole, [(float(x), float(y)) for x, y in pts])


def shared_area(spark, a, b, base=0.0):
    df = spark.createDataFrame([(a, b)], f"a {gm.GEOMETRY}, b {gm.GEOMETRY}")
    return df.select(gm.overlap_area(gm.sides(F.col("a")), gm.sides(F.col("b")), F.lit(base))).first()[0]


def test_shared_area_of_concave_and_holed_shapes(spark):
    arrow = [ring((0, 0), (4, 0), (4, 4), (2, 1), (0, 4))]
    for base in (0.0, -7.5, 3.0):
        assert shared_area(spark, arrow, [ring((-9, -9), (9, -9), (9, 9), (-9, 9))], base) == pytest.approx(10.0)
        assert shared_area(spark, arrow, [ring((0, 1), (4, 1), (4, 4), (0, 4))], base) == pytest.approx(6.0)
    donut = [ring((0, 0), (10, 0), (10, 10), (0, 10)), ring((4, 4), (6, 4), (6, 6), (4, 6), hole=True)]
    assert shared_area(spark, donut, [ring((5, 0), (5, 10), (10, 10), (10, 0))]) == pytest.approx(48.0)
    assert shared_area(spark, donut, [ring((4, 4), (4, 6), (6, 6), (6, 4))]) == pytest.approx(0.0, abs=1e-9)
    assert shared_area(spark, [ring((0, 0), (2, 1), (0, 2))], [ring((2, 1), (4, 0), (4, 2))]) == pytest.approx(0.0, abs=1e-12)


def test_shared_area_against_grid_count(spark):
    rng = random.Random(3)

    def star(cx, cy):
        return [(cx + r * math.cos(a), cy + r * math.sin(a)) for a, r in ((math.pi * i / 5, rng.uniform(1, 4)) for i in range(10))]

    def inside(poly, x, y):
        hits = 0
        for (ax, ay), (bx, by) in zip(poly, poly[1:] + poly[:1]):
            hits += (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax
        return hits % 2

    a, b = star(0, 0), star(1, 1)
    step = 0.02
    grid = [(-5 + step * i, -5 + step * j) for i in range(550) for j in range(550)]
    counted = sum(inside(a, x, y) and inside(b, x, y) for x, y in grid) * step * step
    assert shared_area(spark, [ring(*a)], [ring(*b[::-1])]) == pytest.approx(counted, rel=0.01)


def test_max_overlap_and_fallback(spark, rows):
    def box(x0, y0, x1, y1):
        return f"POLYGON (({x0} {y0}, {x1} {y0}, {x1} {y1}, {x0} {y1}, {x0} {y0}))"

    zones = spark.createDataFrame([("1", box(0, 0, 1, 1)), ("2", box(1, 0, 2, 1)), ("3", "POLYGON EMPTY")], "zone_id string, g string")
    blocks = spark.createDataFrame([("a", box(0.8, 0.2, 1.1, 0.4)), ("b", box(0.9, 0.2, 1.3, 0.4)), ("c", box(5, 5, 5.1, 5.1)), ("d", box(0.5, 0.2, 1.5, 0.4)), ("e", box(-1, 1, 1, 2))], "GEOID string, g string")
    parse = lambda df: df.withColumn("geometry", gm.rings_from_wkt(F.col("g"))).drop("g")
    out = geo.max_overlap_zone(parse(blocks), parse(zones), lat0=0.0, cell=0.3)
    assert rows(out, "GEOID", "zone_id") == [("a", "1"), ("b", "2"), ("c", "2"), ("d", "1"), ("e", "1")]


def test_overlaps_are_worked_out_by_several_tasks(spark, monkeypatch):
    """Shapes that fit one task by their bytes are dealt before they are described and before areas are added up."""
    made, cut = [], geo.cut_lineage
    monkeypatch.setattr(geo, "cut_lineage", lambda df: made.append(cut(df)) or made[-1])
    x = F.col("id").cast("double")
    ring = F.array(*[F.struct((x + dx).alias("x"), F.lit(dy).alias("y")) for dx, dy in ((0.0, 0.0), (0.6, 0.0), (0.6, 0.6), (0.0, 0.6), (0.0, 0.0))])
    shapes = spark.range(0, 100, 1, 1).select(F.col("id").cast("string").alias("GEOID"), F.array(F.struct(F.lit(False).alias("hole"), ring.alias("points"))).alias("geometry"))
    out = geo.max_overlap_zone(shapes, shapes.withColumnRenamed("GEOID", "zone_id"), lat0=0.0, cell=0.5)
    assert {(r.GEOID, r.zone_id) for r in out.collect()} == {(str(k), str(k)) for k in range(100)}
    best = made[0].groupBy(F.spark_partition_id()).count().collect()
    assert len(best) > 1 and max(r[1] for r in best) < 60


def test_block_features_from_landed_json(spark, tmp_path, rows):
    page = {"features": [
        {"attributes": {"GEOID": g, "STATE": "48", "COUNTY": "453", "TRACT": "000001", "BLKGRP": "1"},
         "geometry": {"rings": [[[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]], [[0.5, 0.5], [0.5, 1], [1, 1], [0.5, 0.5]]]}} for g in ("a", "b")]}
    (tmp_path / "page1.json").write_text(json.dumps(page, indent=1))
    pages = readers.read_feature_pages(spark, str(tmp_path))
    out = geo.block_features(pages, spark.createDataFrame([("b",), ("z",)], "GEOID string"))
    assert rows(out, "GEOID", "TRACT", F.size("geometry"), F.col("geometry")[1]["hole"]) == [("b", "000001", 2, True)]


def test_centroid_distance_floor(spark):
    z = spark.createDataFrame([("1", -98.0, 30.0), ("2", -97.0, 30.0)], "zone_id string, cx double, cy double")
    pairs = spark.createDataFrame([("1", "1"), ("1", "2")], "origin string, destination string")
    d = {r.destination: r.miles for r in geo.centroid_distance(z, z, pairs).collect()}
    assert d["1"] == pytest.approx(0.0621371) and d["2"] == pytest.approx(math.radians(1) * 6378137 * 0.621371 / 1000)


def test_job_relocation_moves_only_jobs_without_land(spark, rows):
    blocks = spark.createDataFrame([("a", 0.0, 0.0, 0.0), ("b", 0.0, 0.01, 5.0), ("c", 0.0, 0.005, 0.0), ("d", 1.0, 0.0, 9.0)], "block_id string, x double, y double, square_meters_land double")
    jobs = spark.createDataFrame([(1, "a", "Z1"), (2, "b", "Z2"), (3, "c", None), (4, "x", None)], "job_id int, block_id string, TAZ string")
    assert rows(landuse.relocate_jobs(jobs, blocks, 0.0)) == [(1, "b", "Z1"), (2, "b", "Z2"), (3, "b", None), (4, "x", None)]


def test_enrollment_rules(spark, rows):
    raw = spark.createDataFrame([("1", "POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))")], "zone_id string, geometry string")
    zones = geo.zone_table(raw, "zone_id").withColumnRenamed("TAZ", "zone_id")
    schools = spark.createDataFrame([("s1", "48453", 0.5, 0.5, -3.0), ("s2", "48453", 0.5, 0.5, None), ("s3", "48001", 0.5, 0.5, 9.0), ("s4", "48453", 5.0, 5.0, 9.0), ("s5", "48453", 0.2, 0.2, 7.0)],
                                    "ncessch string, county_code string, latitude double, longitude double, enrollment double")
    assert rows(landuse.enrollment_schools(schools, zones, ["453"]), "ncessch", "enrollment", "TAZ") == [("s1", 0.0, "1"), ("s5", 7.0, "1")]
    colleges = spark.createDataFrame([(1, "A", 0.5, 0.5), (2, "B", 0.5, 0.5), (3, "C", 9.0, 9.0)], "unitid bigint, inst_name string, longitude double, latitude double")
    level = lambda *v: spark.createDataFrame(list(v), "unitid bigint, enrollment_fall double")
    out = landuse.enrollment_colleges(colleges, [level((1, 10.0)), level((1, -4.0), (9, 5.0))], [level((1, None)), level((2, 3.0))], zones)
    assert rows(out, "unitid", "full_time_enrollment", "part_time_enrollment") == [(1, 10.0, 0.0), (2, None, 3.0)]
