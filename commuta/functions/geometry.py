"""Rings, centroids, projections and containment as column expressions.

A geometry is ``array<struct<hole: boolean, points: array<struct<x, y>>>>``: the shell
and holes of one or several polygons. Containment counts ring crossings, so holes and
multipolygons need no special case.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from commuta.functions.columns import MILES_PER_KM

# Fixed value: sphere radius of the web map projection, in metres.
EARTH_RADIUS = 6378137.0
METRES_PER_DEGREE = math.pi / 180 * EARTH_RADIUS

GEOMETRY = "array<struct<hole: boolean, points: array<struct<x: double, y: double>>>>"


def mercator_x(lon: Column) -> Column:
    return EARTH_RADIUS * F.radians(lon)


def mercator_y(lat: Column) -> Column:
    return EARTH_RADIUS * F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2))


def planar_miles(x1: Column, y1: Column, x2: Column, y2: Column, at_least_m: float = 0.0) -> Column:
    """Distance of two projected points in miles; zero metres become ``at_least_m``."""
    return planar_miles_of(planar_metres(x1 - x2, y1 - y2), at_least_m)


def planar_metres(dx: Column, dy: Column) -> Column:
    """Length of a difference of two projected points."""
    return F.sqrt(dx * dx + dy * dy)


def planar_miles_of(metres: Column, at_least_m: float = 0.0) -> Column:
    """Metres in miles; zero metres become ``at_least_m``."""
    return F.when(metres == 0, at_least_m).otherwise(metres) * (MILES_PER_KM / 1000)


def rings_from_wkt(wkt: Column) -> Column:
    """Rings of a POLYGON or MULTIPOLYGON text."""
    body = F.regexp_replace(F.regexp_replace(wkt, r"^[^(]*\(+", ""), r"\)+\s*$", "")
    polygons = F.split(body, r"\)\s*\)\s*,\s*\(\s*\(")

    def point(text: Column) -> Column:
        xy = F.split(F.trim(text), r"\s+")
        return F.struct(F.get(xy, 0).try_cast("double").alias("x"), F.get(xy, 1).try_cast("double").alias("y"))

    def polygon(text: Column) -> Column:
        rings = F.split(text, r"\)\s*,\s*\(")
        return F.transform(
            rings, lambda r, i: F.struct((i > 0).alias("hole"), F.transform(F.split(r, ","), point).alias("points"))
        )

    parsed = F.flatten(F.transform(polygons, polygon))
    return F.when(wkt.ilike("%EMPTY%"), F.array().cast(GEOMETRY)).otherwise(parsed)


def rings_from_lists(rings: Column) -> Column:
    """Rings from nested coordinate lists ``[[[x, y], ...], ...]``, first ring the shell."""
    return F.transform(
        rings,
        lambda r, i: F.struct(
            (i > 0).alias("hole"),
            F.transform(r, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))).alias("points"),
        ),
    )


def _edges(points: Column) -> Column:
    """Consecutive point pairs (a, b), the last point joined to the first."""
    following = F.concat(F.slice(points, 2, F.greatest(F.size(points) - 1, F.lit(0))), F.slice(points, 1, 1))
    return F.zip_with(points, following, lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def centroid(geom: Column) -> Column:
    """Area centroid of all rings, holes subtracted. Ring moments are taken about the ring's first corner."""
    zero = F.struct(*[F.lit(0.0).alias(n) for n in ("area", "mx", "my")])

    def sums(area: Column, mx: Column, my: Column) -> Column:
        return F.struct(area.alias("area"), mx.alias("mx"), my.alias("my"))

    def moments(ring: Column) -> Column:
        corner = ring["points"][0]

        def add(acc: Column, e: Column) -> Column:
            ax, ay = e["a"]["x"] - corner["x"], e["a"]["y"] - corner["y"]
            bx, by = e["b"]["x"] - corner["x"], e["b"]["y"] - corner["y"]
            cross = ax * by - bx * ay
            return sums(acc["area"] + cross / 2, acc["mx"] + (ax + bx) * cross / 6, acc["my"] + (ay + by) * cross / 6)

        about_corner = F.aggregate(_edges(ring["points"]), zero, add)
        return F.struct(ring["hole"].alias("hole"), corner.alias("corner"), about_corner.alias("m"))

    def add_ring(acc: Column, r: Column) -> Column:
        sign = F.when(r["hole"], -1.0).otherwise(1.0) * F.signum(r["m"]["area"])
        area = sign * r["m"]["area"]
        return sums(
            acc["area"] + area,
            acc["mx"] + sign * r["m"]["mx"] + area * r["corner"]["x"],
            acc["my"] + sign * r["m"]["my"] + area * r["corner"]["y"],
        )

    def mean(acc: Column) -> Column:
        return F.struct(*[F.try_divide(acc[m], acc["area"]).alias(n) for n, m in (("x", "mx"), ("y", "my"))])

    return F.aggregate(F.transform(geom, moments), zero, add_ring, mean)


def edges(geom: Column) -> Column:
    """All ring edges of a geometry, the form ``contains`` tests."""
    return F.flatten(F.transform(geom, lambda r: _edges(r["points"])))


def contains(ring_edges: Column, x: Column, y: Column) -> Column:
    """Odd number of edges crossed by the ray from the point toward +x."""

    def crossed(e: Column) -> Column:
        a, b = e["a"], e["b"]
        spans = (a["y"] > y) != (b["y"] > y)
        at = F.try_divide((b["x"] - a["x"]) * (y - a["y"]), b["y"] - a["y"]) + a["x"]
        return spans & (x < at)

    return F.size(F.filter(ring_edges, crossed)) % 2 == 1


def touches(e: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Whether an edge meets the box: their extents meet, and the box has corners on both sides of the edge's line, or on it."""
    a, b = e["a"], e["b"]
    dx, dy = b["x"] - a["x"], b["y"] - a["y"]
    sides_ = [dx * (y - a["y"]) - dy * (x - a["x"]) for x in (x0, x1) for y in (y0, y1)]
    return (
        (F.least(a["x"], b["x"]) <= x1) & (F.greatest(a["x"], b["x"]) >= x0)
        & (F.least(a["y"], b["y"]) <= y1) & (F.greatest(a["y"], b["y"]) >= y0)
        & (F.least(*sides_) <= 0) & (F.greatest(*sides_) >= 0)
    )


def crossings(ring_edges: Column, x0: Column, y0: Column, x: Column, y: Column) -> Column:
    """Edges crossed on the way from (x0, y0) along x and then along y to (x, y)."""
    def along_x(e: Column) -> Column:
        a, b = e["a"], e["b"]
        at = F.try_divide((b["x"] - a["x"]) * (y0 - a["y"]), b["y"] - a["y"]) + a["x"]
        return ((a["y"] > y0) != (b["y"] > y0)) & ((x0 < at) != (x < at))

    def along_y(e: Column) -> Column:
        a, b = e["a"], e["b"]
        at = F.try_divide((b["y"] - a["y"]) * (x - a["x"]), b["x"] - a["x"]) + a["y"]
        return ((a["x"] > x) != (b["x"] > x)) & ((y0 < at) != (y < at))

    return F.aggregate(ring_edges, F.lit(0), lambda n, e: n + along_x(e).cast("int") + along_y(e).cast("int"))


def edge_distance2(p: Column, q: Column) -> Column:
    """Squared distance of two edges; 0 where they meet."""
    def turn(o: Column, a: Column, b: Column) -> Column:
        return (a["x"] - o["x"]) * (b["y"] - o["y"]) - (a["y"] - o["y"]) * (b["x"] - o["x"])

    def to_edge(c: Column, e: Column) -> Column:
        dx, dy = e["b"]["x"] - e["a"]["x"], e["b"]["y"] - e["a"]["y"]
        wx, wy = c["x"] - e["a"]["x"], c["y"] - e["a"]["y"]
        along = F.coalesce(F.try_divide(wx * dx + wy * dy, dx * dx + dy * dy), F.lit(0.0))
        along = F.greatest(F.least(along, F.lit(1.0)), F.lit(0.0))
        ex, ey = wx - along * dx, wy - along * dy
        return ex * ex + ey * ey

    def apart(e: Column, a: Column, b: Column) -> Column:
        """The ends a and b lie on different sides of the line through e."""
        one, two = turn(e["a"], e["b"], a), turn(e["a"], e["b"], b)
        return ((one > 0) & (two < 0)) | ((one < 0) & (two > 0))

    crossed = apart(p, q["a"], q["b"]) & apart(q, p["a"], p["b"])
    ends = F.least(to_edge(p["a"], q), to_edge(p["b"], q), to_edge(q["a"], p), to_edge(q["b"], p))
    return F.when(crossed, 0.0).otherwise(ends)


def bounds(geom: Column) -> dict[str, Column]:
    """Smallest and largest coordinate over all rings."""
    points = F.flatten(F.transform(geom, lambda r: r["points"]))
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return {"x0": F.array_min(xs), "x1": F.array_max(xs), "y0": F.array_min(ys), "y1": F.array_max(ys)}


def sides(geom: Column) -> Column:
    """The sides of all rings that are not vertical, from left to right, with the sign of the area below them.

    A side counts +1 where the shape lies below it and -1 where it lies above, so the areas
    between the sides and any base line add up to the shape's; rings may turn either way.
    """
    def ring_sides(ring: Column) -> Column:
        ring_edges = _edges(ring["points"])
        twice = F.aggregate(
            ring_edges, F.lit(0.0), lambda t, e: t + (e["a"]["x"] - e["b"]["x"]) * (e["a"]["y"] + e["b"]["y"] - 2 * ring["points"][0]["y"])
        )
        turn = F.signum(twice) * F.when(ring["hole"], -1.0).otherwise(1.0)

        def side(e: Column) -> Column:
            a, b = e["a"], e["b"]
            left = a["x"] < b["x"]

            def end(first: Column, second: Column, axis: str) -> Column:
                return F.when(left, first[axis]).otherwise(second[axis])

            return F.struct(
                end(a, b, "x").alias("x0"), end(a, b, "y").alias("y0"), end(b, a, "x").alias("x1"), end(b, a, "y").alias("y1"),
                F.when(left, -turn).otherwise(turn).alias("sign"),
            )

        return F.transform(F.filter(ring_edges, lambda e: e["a"]["x"] != e["b"]["x"]), side)

    return F.flatten(F.transform(geom, ring_sides))


def overlap_area(a: Column, b: Column, base: Column) -> Column:
    """Area two shapes share, from their ``sides``: the signed area below both sides, over all pairs of sides.

    Areas are taken above the line y = ``base``, which cancels out; one near the shapes keeps digits.
    """
    def height(s: Column, x: Column) -> Column:
        return s["y0"] + (s["y1"] - s["y0"]) * (x - s["x0"]) / (s["x1"] - s["x0"]) - base

    def below_both(p: Column, q: Column) -> Column:
        left, right = F.greatest(p["x0"], q["x0"]), F.least(p["x1"], q["x1"])
        pl, pr, ql, qr = height(p, left), height(p, right), height(q, left), height(q, right)
        dl, dr = pl - ql, pr - qr
        low_l, low_r = F.least(pl, ql), F.least(pr, qr)
        share = dl / (dl - dr)  # of the way to the crossing
        crossing = pl + share * (pr - pl)
        apart = (low_l + low_r) / 2
        crossed = (share * (low_l + crossing) + (1 - share) * (crossing + low_r)) / 2
        return (right - left) * F.when(dl * dr >= 0, apart).otherwise(crossed)

    def with_all(total: Column, p: Column) -> Column:
        meeting = F.filter(b, lambda q: (q["x0"] < p["x1"]) & (p["x0"] < q["x1"]))
        return total + F.aggregate(meeting, F.lit(0.0), lambda t, q: t + p["sign"] * q["sign"] * below_both(p, q))

    return F.aggregate(a, F.lit(0.0), with_all)
