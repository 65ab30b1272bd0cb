"""Searches by cells against brute force, and how many rows they form."""

import math
import random

import pytest
from pyspark.sql import functions as F

from commuta.functions import geometry as gm
from commuta.functions import projections as pr
from commuta.operators import geo, landuse, lineage

METRES = gm.METRES_PER_DEGREE
COS = math.cos(math.radians(30.0))


def blob(rng, x, y, radius, corners, hole=False):
    """A star-shaped ring around (x, y)."""
    turns = sorted(rng.uniform(0, 2 * math.pi) for _ in range(corners))
    return (hole, [(x + radius * rng.uniform(0.4, 1) * math.cos(t), y + radius * rng.uniform(0.4, 1) * math.sin(t)) for t in turns])


def inside(geom, x, y):
    n = 0
    for _, pts in geom:
        for (ax, ay), (bx, by) in zip(pts, pts[1:] + pts[:1]):
            if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                n += 1
    return n % 2 == 1


def segments(geom):
    return [(a, b) for _, pts in geom for a, b in zip(pts, pts[1:] + pts[:1])]


def gap(p, q):
    """Distance of two segments in the plane."""
    def turn(o, a, b):
        return (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])

    def to(c, a, b):
        dx, dy = b[0] - a[0], b[1] - a[1]
        n = dx * dx + dy * dy
        t = max(0, min(1, ((c[0] - a[0]) * dx + (c[1] - a[1]) * dy) / n)) if n else 0
        return math.hypot(c[0] - a[0] - t * dx, c[1] - a[1] - t * dy)

    if turn(*p, q[0]) * turn(*p, q[1]) < 0 and turn(*q, p[0]) * turn(*q, p[1]) < 0:
        return 0.0
    return min(to(p[0], *q), to(p[1], *q), to(q[0], *p), to(q[1], *p))


def apart(a, b):
    plane = [[(h, [(x * METRES * COS, y * METRES) for x, y in pts]) for h, pts in g] for g in (a, b)]
    if inside(plane[0], *plane[1][0][1][0]) or inside(plane[1], *plane[0][0][1][0]):
        return 0.0
    return min(gap(p, q) for p in segments(plane[0]) for q in segments(plane[1]))


def test_points_in_shapes_of_all_sizes(spark):
    rng = random.Random(8)
    shapes = []
    for i in range(60):
        radius = 10 ** rng.uniform(-3, 0.3)
        x, y = rng.uniform(-98.5, -97.5), rng.uniform(29.5, 30.5)
        shapes.append((f"z{i:02}", [blob(rng, x, y, radius, rng.choice([3, 5, 40, 400])), blob(rng, x, y, radius / 5, 5, True)]))
    pts = [(i, rng.uniform(-99, -97), rng.uniform(29, 31)) for i in range(1500)]
    zones = spark.createDataFrame(shapes, f"zone_id string, geometry {gm.GEOMETRY}")
    got = {r.id: r.zone_id for r in geo.points_to_zones(spark.createDataFrame(pts, "id int, x double, y double"), zones).collect()}
    want = {i: min((z for z, g in shapes if inside(g, x, y)), default=None) for i, x, y in pts}
    assert got == want and sum(z is not None for z in want.values()) > 300


def test_a_shape_of_many_edges_is_never_whole_in_a_row(spark):
    n = 100_000
    pts = [(math.cos(2 * math.pi * k / n) * (1 + 0.2 * math.sin(40 * math.pi * k / n)), math.sin(2 * math.pi * k / n)) for k in range(n)]
    zones = spark.createDataFrame([("a", [(False, pts)])], f"zone_id string, geometry {gm.GEOMETRY}")
    cover = geo.covering(zones, 0.05).select("level", F.size("edges").alias("n"), "inside").collect()
    assert max(r.n for r in cover) <= geo.MOST_EDGES
    assert sum(r.n for r in cover) < 2 * n and any(r.n == 0 and r.inside for r in cover)  # inside cells need no edge
    rng = random.Random(9)
    some = [(i, rng.uniform(-1.3, 1.3), rng.uniform(-1.1, 1.1)) for i in range(40)]
    got = {r.id: r.zone_id for r in geo.points_to_zones(spark.createDataFrame(some, "id int, x double, y double"), zones).collect()}
    assert got == {i: "a" if inside([(False, pts)], x, y) else None for i, x, y in some}


def test_corners_on_cell_borders_and_shared_sides(spark):
    """Squares side by side on round coordinates: each point has one zone, a point on a side the one above or to the right."""
    squares = [(f"{i}{j}", [(False, [(i, j), (i + 1, j), (i + 1, j + 1), (i, j + 1), (i, j)])]) for i in range(4) for j in range(4)]
    zones = spark.createDataFrame([(z, [(h, [(float(a), float(b)) for a, b in p]) for h, p in g]) for z, g in squares], f"zone_id string, geometry {gm.GEOMETRY}")
    pts = [(i * 100 + j, i / 2, j / 2) for i in range(9) for j in range(9)]
    for cell in (0.25, 1.0, 7.0):
        got = {r.id: r.zone_id for r in geo.points_to_zones(spark.createDataFrame(pts, "id int, x double, y double"), zones, cell=cell).collect()}
        assert got == {i: f"{int(x)}{int(y)}" if x < 4 and y < 4 else None for i, x, y in pts}


def test_far_point_beside_a_city(spark, monkeypatch):
    """10^5 candidates in a town and points far from it: few cells and candidates a point, whatever the town holds."""
    rng = random.Random(10)
    town = [(k, rng.gauss(0, 4000), rng.gauss(0, 4000)) for k in range(100_000)] + [(100_000 + k, 50.0 * k, 100.0) for k in range(100)]
    cands = spark.createDataFrame([(f"c{k:06}", x, y) for k, x, y in town], "id string, x double, y double")
    places = [(300_000.0, 0.0), (0.0, -1_500_000.0), (-40_000.0, 40_000.0), (9000.0, 9000.0), (10.0, 10.0), (4e6, 4e6)]
    met = []
    cut = geo.cut_lineage
    monkeypatch.setattr(geo, "cut_lineage", lambda df: met.append(df.count()) or cut(df))
    got = {(r.x, r.y): (r.nearest_id, r.d2) for r in geo.nearest_places(spark.createDataFrame(places, "x double, y double"), cands).collect()}
    for x, y in places:
        d2, want = min(((x - a) ** 2 + (y - b) ** 2, f"c{k:06}") for k, a, b in town)
        assert got[x, y] == (want, pytest.approx(d2)), (x, y)
    assert sum(met) + geo.MOST_MET * len(places) < 100 * len(places)


def test_shape_distance_differs_from_centre_distance(spark):
    bar = [(False, [(-98.0, 30.0), (-97.5, 30.0), (-97.5, 30.01), (-98.0, 30.01)])]  # long: its centre is far
    dot = [(False, [(-98.02, 30.03), (-98.01, 30.03), (-98.01, 30.04), (-98.02, 30.04)])]
    lake = [(False, [(-98.01, 30.0), (-98.005, 30.0), (-98.005, 30.005), (-98.01, 30.005)])]
    shapes = spark.createDataFrame([("bar", bar), ("dot", dot), ("lake", lake)], f"block_id string, geometry {gm.GEOMETRY}")
    blocks = shapes.select(
        "block_id", F.when(F.col("block_id") == "lake", 0).otherwise(5).alias("square_meters_land"),
        gm.centroid(F.col("geometry"))["x"].alias("x"), gm.centroid(F.col("geometry"))["y"].alias("y"),
    )
    jobs = spark.createDataFrame([("lake", 1), ("dot", 2), (None, 3)], "block_id string, job int")
    moved = [{r.job: r.block_id for r in landuse.relocate_jobs(jobs, blocks, 30.0, s).collect()} for s in (None, shapes)]
    assert moved == [{1: "dot", 2: "dot", 3: None}, {1: "bar", 2: "dot", 3: None}]
    local = landuse.relocate_jobs(jobs, blocks, shapes=shapes, system="EPSG:32140").collect()
    assert {r.job: r.block_id for r in local} == moved[1]


@pytest.mark.parametrize("seed", [1, 2])
def test_nearest_shapes_equal_brute_force(spark, seed):
    rng = random.Random(seed)

    def some(n, name):
        return [(f"{name}{i:02}", [blob(rng, rng.uniform(-98.3, -97.7), rng.uniform(29.7, 30.3), 10 ** rng.uniform(-4, -0.7), rng.choice([3, 4, 12]))]) for i in range(n)]

    ours, theirs = some(40, "s"), some(50, "c")
    ours += [("far", [blob(rng, -60.0, 10.0, 0.1, 5)]), ("same", theirs[7][1]), ("none", [])]
    theirs += [("hole", [blob(rng, -99.0, 31.0, 0.3, 30), (True, [(-99.1, 30.9), (-98.9, 30.9), (-98.9, 31.1), (-99.1, 31.1)])]), ("void", [])]
    ours += [("core", [(False, [(-99.01, 31.0), (-99.0, 31.0), (-99.0, 31.01)])])]
    schema = f"id string, geometry {gm.GEOMETRY}"
    got = {r.id: (r.nearest_id, r.distance_m) for r in geo.nearest_shapes(spark.createDataFrame(ours, schema), spark.createDataFrame(theirs, schema), 30.0).collect()}
    assert "none" not in got and got["core"][0] == "hole" and got["core"][1] > 0
    for i, g in ours:
        if g:
            d, want = min((round(apart(g, c), 6), k) for k, c in theirs if c)
            assert got[i] == (want, pytest.approx(d, abs=1e-5)), i


def test_shapes_of_one_form_are_searched_once(spark, monkeypatch):
    """Ids may repeat, also with another form: the nearest of their forms counts, and of equal candidates the least id."""
    def box(x, y):
        return [(False, [(x, y), (x + 0.01, y), (x + 0.01, y + 0.01), (x, y + 0.01)])]

    ours = [(f"s{i:03}", box(-98.0, 30.0)) for i in range(300)] + [("twice", box(-98.0, 30.0)), ("twice", box(-97.0, 30.0)), ("twice", box(-97.0, 30.0))]
    theirs = [(f"c{i:03}", box(-97.98, 30.0)) for i in range(299, -1, -1)] + [("b", box(-97.0, 30.0)), ("c000", box(-96.0, 30.0))]
    sizes = []

    def cut(df):
        sizes.append((kept := lineage.cut_lineage(df)).count())
        return kept

    monkeypatch.setattr(geo, "cut_lineage", cut)
    schema = f"id string, geometry {gm.GEOMETRY}"
    got = geo.nearest_shapes(spark.createDataFrame(ours, schema), spark.createDataFrame(theirs, schema), 30.0).collect()
    found = {r.id: (r.nearest_id, round(r.distance_m)) for r in got}
    gap = round(0.01 * gm.METRES_PER_DEGREE * math.cos(math.radians(30.0)))
    assert len(got) == 301 and found.pop("twice") == ("b", 0) and set(found.values()) == {("c000", gap)}
    assert max(sizes) < 100, sizes


def test_shapes_and_points_that_are_not_finite_lie_nowhere(spark):
    """A system does not reach everywhere: corners beyond it are NaN, which compares as the greatest number and as cell 0."""
    def box(x, y, top):
        return [(False, [(x, y), (x + 1000.0, y), (x + 1000.0, top), (x, top)])]

    zones = spark.createDataFrame([("a", box(-500.0, -500.0, 500.0)), ("b", box(-500.0, -4000.0, math.nan))], f"zone_id string, geometry {gm.GEOMETRY}")
    assert {r.zone_id for r in geo.covering(zones, 100.0).collect()} == {"a"}
    pts = spark.createDataFrame([(1, 50.0, 50.0), (2, math.nan, 50.0), (3, math.nan, math.nan), (4, 50.0, math.inf), (5, 60.0, -3000.0)], "id int, x double, y double")
    assert {r.id: r.zone_id for r in geo.points_to_zones(pts, zones, 100.0).collect()} == {1: "a", 2: None, 3: None, 4: None, 5: None}


def test_local_system(spark):
    """Points and blocks in degrees, zones in degrees: all taken to metres of one system first."""
    ring = [(-98.1, 29.9), (-97.9, 29.9), (-97.9, 30.1), (-98.1, 30.1)]
    zones = spark.createDataFrame([("a", [(False, ring)]), ("b", [(False, [(x + 0.2, y) for x, y in ring])])], f"zone_id string, geometry {gm.GEOMETRY}")
    # The upper side is straight in the system and so lies a little below the parallel between its ends' midpoint.
    middle = [one[1] for one in (spark.range(1).select(*pr.project(F.lit(x), F.lit(30.1), "EPSG:32140")).first() for x in (-98.1, -97.9))]
    _, y = spark.range(1).select(*pr.SYSTEMS["EPSG:32140"].unproject(F.lit(696404.0), F.lit(sum(middle) / 2))).first()
    assert abs(y - 30.1) > 1e-6
    pts = spark.createDataFrame([(1, -98.0, 30.0), (2, -97.8, 30.0), (3, -98.0, 30.1 + (y - 30.1) / 2), (4, None, 1.0)], "id int, x double, y double")
    flat = {r.id: r.zone_id for r in geo.points_to_zones(pts, zones).collect()}
    local = {r.id: (r.zone_id, r.x) for r in geo.points_to_zones(pts, zones, system="EPSG:32140").collect()}
    assert [flat[k] for k in (1, 2, 4)] == [local[k][0] for k in (1, 2, 4)] == ["a", "b", None] and local[1][1] == -98.0
    assert (flat[3] == "a") != (local[3][0] == "a")
    blocks = zones.select(F.col("zone_id").alias("GEOID"), "geometry")
    same = geo.max_overlap_zone(blocks, zones, system="EPSG:32140").collect()
    assert {r.GEOID: r.zone_id for r in same} == {"a": "a", "b": "b"}
    near = geo.nearest(pts.filter("id < 3"), pts.filter("id < 3"), system="EPSG:32140").collect()
    assert {r.id: (r.nearest_id, r.distance_m) for r in near} == {1: (1, 0.0), 2: (2, 0.0)}
