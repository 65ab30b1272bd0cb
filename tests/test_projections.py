"""Projections against published control points and their own defining properties."""

import math
import random

import pytest
from pyspark.sql import functions as F

from commuta.functions import geometry as gm
from commuta.functions import projections as pr

US_FOOT = 1200 / 3937
AIRY = pr.Ellipsoid(6377563.396, 6377563.396 / (6377563.396 - 6356256.909))
CLARKE_FEET = pr.Ellipsoid(20925832.16, 294.97870)
# The register's worked example of the conic (in US survey feet), and the national grid's of the cylinder.
TEXAS_1927 = pr.LambertConformal(28 + 23 / 60, 30 + 17 / 60, 27 + 50 / 60, -99.0, 2000000.0, 0.0, CLARKE_FEET)
BRITAIN = pr.TransverseMercator(49.0, -2.0, 0.9996012717, 400000.0, -100000.0, AIRY)
LOCAL = ["EPSG:32140", "EPSG:7131"]
CENTRE = {"EPSG:32140": (-98.0, 30.0), "EPSG:7131": (-122.3, 37.8)}


def one(spark, system, lon, lat):
    row = spark.createDataFrame([(lon, lat)], "lon double, lat double")
    return tuple(row.select(*pr.project(F.col("lon"), F.col("lat"), system)).first())


def test_published_example_of_the_conic(spark):
    east, north = one(spark, TEXAS_1927, -96.0, 28.5)
    assert (east, north) == pytest.approx((2963503.91, 254759.80), abs=0.006)


def test_published_example_of_the_cylinder(spark):
    lon, lat = 1 + 43 / 60 + 4.5177 / 3600, 52 + 39 / 60 + 27.2531 / 3600
    assert one(spark, BRITAIN, lon, lat) == pytest.approx((651409.903, 313177.270), abs=0.001)


def test_origins(spark):
    s = pr.SYSTEMS["EPSG:32140"]
    assert one(spark, s, s.lon0, s.lat0) == pytest.approx((600000.0, 4000000.0), abs=1e-6)
    s = pr.SYSTEMS["EPSG:7131"]
    assert one(spark, s, s.lon0, s.lat0) == pytest.approx((48000.0, 24000.0), abs=1e-6)


def metres_per_radian(lat, ellipsoid):
    """Of longitude and of latitude on the ellipsoid."""
    s = math.sqrt(1 - (ellipsoid.e * math.sin(lat)) ** 2)
    return ellipsoid.a * math.cos(lat) / s, ellipsoid.a * (1 - ellipsoid.e**2) / s**3


@pytest.mark.parametrize("code", LOCAL)
def test_scale_is_the_same_in_all_directions_and_true_where_it_should_be(spark, code):
    system, (lon, lat) = pr.SYSTEMS[code], CENTRE[code]
    step, rng = 1e-6, random.Random(1)
    spots = [(lon + rng.uniform(-1, 1), lat + rng.uniform(-1, 1)) for _ in range(40)]
    true = [(lon, system.lat1), (lon, system.lat2)] if code == "EPSG:32140" else [(system.lon0, lat), (system.lon0, lat + 0.5)]
    rows = [(a, b, a + step, b + step) for a, b in spots + true]
    df = spark.createDataFrame(rows, "a double, b double, a2 double, b2 double")
    here, east, north = (pr.project(F.col(x), F.col(y), system) for x, y in (("a", "b"), ("a2", "b"), ("a", "b2")))
    got = df.select("b", *here, *east, *north).collect()
    scales = []
    for (b, x, y, xe, ye, xn, yn) in got:
        wide, high = metres_per_radian(math.radians(b), system.ellipsoid)
        h = math.hypot(xe - x, ye - y) / (wide * math.radians(step))
        k = math.hypot(xn - x, yn - y) / (high * math.radians(step))
        assert h == pytest.approx(k, rel=2e-7)
        assert (xe - x) * (xn - x) + (ye - y) * (yn - y) == pytest.approx(0, abs=1e-6)  # right angles stay right
        scales.append(h)
    wanted = 1.0 if code == "EPSG:32140" else 1.000007
    assert scales[-2:] == pytest.approx([wanted, wanted], rel=2e-7)


@pytest.mark.parametrize("code", LOCAL)
def test_there_and_back(spark, code):
    lon, lat = CENTRE[code]
    rng = random.Random(2)
    df = spark.createDataFrame([(lon + rng.uniform(-3, 3), lat + rng.uniform(-3, 3)) for _ in range(200)], "lon double, lat double")
    x, y = pr.project(F.col("lon"), F.col("lat"), code)
    back = df.select("lon", "lat", x.alias("x"), y.alias("y")).select("lon", "lat", *pr.SYSTEMS[code].unproject(F.col("x"), F.col("y")))
    for a, b, c, d in back.collect():
        assert (c, d) == pytest.approx((a, b), abs=2e-9)  # a fifth of a millimetre


def test_area_of_a_projected_cell_is_that_on_the_ellipsoid(spark):
    """A hundredth of a degree by a hundredth, against the closed form of the zone's area; the scale squared is between."""
    system, e = pr.SYSTEMS["EPSG:32140"], pr.GRS80.e
    west, south, side = -98.005, 29.3, 0.01

    def zone(lat):
        s = math.sin(math.radians(lat))
        return pr.GRS80.a**2 * (1 - e * e) / 2 * (s / (1 - (e * s) ** 2) + math.atanh(e * s) / e)

    corners = [(west, south), (west + side, south), (west + side, south + side), (west, south + side)]
    df = spark.createDataFrame([([(False, corners)],)], f"g {gm.GEOMETRY}")
    ring = df.select(pr.project_geometry(F.col("g"), system).alias("g")).first().g[0].points
    area = abs(sum(p.x * q.y - q.x * p.y for p, q in zip(ring, ring[1:] + ring[:1]))) / 2
    assert area == pytest.approx((zone(south + side) - zone(south)) * math.radians(side), rel=3e-4)


def test_nulls_and_unknown_systems(spark):
    assert one(spark, "EPSG:32140", None, 30.0) == (None, None) and one(spark, "EPSG:7131", -122.0, None) == (None, None)
    df = spark.createDataFrame([([],), (None,)], f"g {gm.GEOMETRY}")
    assert [r.g for r in df.select(pr.project_geometry(F.col("g"), "EPSG:7131").alias("g")).collect()] == [[], None]
    with pytest.raises(ValueError):
        pr.project(F.lit(1.0), F.lit(1.0), "EPSG:0")


def test_no_python_in_the_plan(spark):
    df = spark.range(5).select(*pr.project(F.col("id") - 98.0, F.col("id") + 28.0, "EPSG:32140"))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
