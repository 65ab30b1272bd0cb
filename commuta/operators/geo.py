"""Spatial joins by grid cell.

Points, zones and blocks meet through equal cell numbers, so each spatial question is an
equi-join followed by an exact test; no pair of unrelated shapes is ever formed.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commuta.functions.geometry import (
    EARTH_RADIUS, METRES_PER_DEGREE, bounds, centroid, contains, crossings, edge_distance2, edges, mercator_x, mercator_y, overlap_area,
    planar_miles, rings_from_lists, rings_from_wkt, sides, touches,
)
from commuta.functions.projections import System, project, project_geometry
from commuta.operators.joins import dealt, lookup, shuffled
from commuta.operators.lineage import cut_lineage, written_table

CELL_COLUMNS = ["_cx", "_cy"]
#: Edges in a cell of a covering, the least power of 4 of its sizes, and where its borders lie as a share of a cell.
MOST_EDGES = 64
LEAST_LEVEL = -10
SHIFT = 0.3819660112501051
#: Candidates a place meets one by one, and doublings from the finest grid of a search to its first one.
MOST_MET = 32
FINER = 10


def _cell(v: Column, size: float | Column) -> Column:
    return F.floor(v / size).cast("bigint")


def _covered_cells(df: DataFrame, box: dict[str, Column], size: float) -> DataFrame:
    """Repeat each shape once per grid cell its bounding box touches."""
    return df.withColumn("_cx", F.explode(F.sequence(_cell(box["x0"], size), _cell(box["x1"], size)))).withColumn(
        "_cy", F.explode(F.sequence(_cell(box["y0"], size), _cell(box["y1"], size)))
    )


def _in_system(df: DataFrame, system: str | System | None) -> DataFrame:
    """Shapes in degrees with their corners in metres of a local system, or as they are."""
    return df if system is None else df.withColumn("geometry", project_geometry(F.col("geometry"), system))


def _size(level: Column | int, cell: float) -> Column:
    return F.pow(F.lit(4.0), F.lit(level)) * cell


def _in_covering(v: Column, level: Column | int, cell: float) -> Column:
    """The cell of a coordinate; borders lie off round numbers, where shapes have their corners."""
    return F.floor((v - SHIFT * cell) / _size(level, cell)).cast("bigint")


def _is_finite(numbers: Iterable[Column]) -> Column:
    """Whether none is infinite or NaN, which compares as the greatest."""
    return reduce(lambda a, b: a & b, [F.abs(v) < float("inf") for v in numbers])


def covering(zones: DataFrame, cell: float, most_edges: int = MOST_EDGES) -> DataFrame:
    """Cells that cover zones: ``zone_id``, ``level``, ``cx``, ``cy``, ``inside`` (its lower left corner is) and ``edges``.

    A zone starts with the 2 x 2 cells or fewer of the first size (``cell`` times a power of 4) that its extent fits in. A cell
    with more than ``most_edges`` edges is split into 4 x 4, down to LEAST_LEVEL. Cells hold only the edges that meet them;
    one without edges lies inside as a whole, and those outside are left out. The result is checkpointed.
    A zone with a corner that is not finite, as where a system does not reach, has no extent to cover and is left out.
    """
    box = bounds(F.col("geometry"))
    extent = F.greatest(box["x1"] - box["x0"], box["y1"] - box["y0"]) / cell
    level = F.greatest(F.ceil(F.log2(F.greatest(extent, F.lit(1e-9))) / 2), F.lit(LEAST_LEVEL)).cast("int")
    rows = zones.filter(F.size("geometry") > 0).filter(_is_finite(box.values())).select(
        "zone_id", edges(F.col("geometry")).alias("_all"), level.alias("level"), *[v.alias(k) for k, v in box.items()]
    )
    for c in "xy":
        ends = [_in_covering(F.col(f"{c}{k}"), F.col("level"), cell) for k in (0, 1)]
        rows = rows.withColumn(f"c{c}", F.explode(F.sequence(*ends)))
    size = _size(F.col("level"), cell)
    x0, y0 = (F.col(c) * size + SHIFT * cell for c in ("cx", "cy"))

    def kept(rows: DataFrame, inside: Column) -> DataFrame:
        slack = size * 1e-9
        met = F.filter("_all", lambda e: touches(e, x0 - slack, y0 - slack, x0 + size + slack, y0 + size + slack))
        found = rows.select("zone_id", "level", "cx", "cy", inside.alias("inside"), met.alias("edges"))
        return cut_lineage(found.filter((F.size("edges") > 0) | F.col("inside")))

    rows, done = kept(rows, contains(F.col("_all"), x0, y0)), None
    large = (F.size("edges") > most_edges) & (F.col("level") > LEAST_LEVEL)
    while True:
        if rows.filter(large).isEmpty():
            return rows if done is None else done.unionByName(rows)
        settled = rows.filter(~large)
        done = settled if done is None else done.unionByName(settled)
        split = rows.filter(large).select("zone_id", "level", "cx", "cy", "inside", F.col("edges").alias("_all"), x0.alias("_x"), y0.alias("_y"))
        for c in ("cx", "cy"):
            split = split.withColumn(c, F.explode(F.array(*[F.col(c) * 4 + k for k in range(4)])))
        split = split.withColumn("level", F.col("level") - 1)
        odd = crossings(F.col("_all"), F.col("_x"), F.col("_y"), x0, y0) % 2 == 1
        rows = kept(split, F.col("inside") != odd)


def points_to_zones(points: DataFrame, zones: DataFrame, cell: float = 0.05, system: str | System | None = None) -> DataFrame:
    """Zone of each point (x, y), NULL outside all zones; the least zone id on shared ground.

    With ``system``, a local system of ``projections``, points and zones are taken from degrees into it first, and sides
    are straight there; otherwise they are compared as they come. Points keep their own coordinates.
    Zones are covered by cells of sizes that follow their extents and edges (see ``covering``), ``cell`` coordinate units
    times powers of 4 (with a system: metres, 100,000 times as many). A point meets the cell it lies in, once for each size in use: inside cells
    name their zones at once, others count the edges between the point and the cell's corner. Points are never multiplied
    or regrouped; a crowded cell's points are split by adaptive execution.
    """
    unit = cell if system is None else cell * 1e5
    px, py = (F.col("x"), F.col("y")) if system is None else project(F.col("x"), F.col("y"), system)
    found = _looked_up(points.withColumns({"_px": px, "_py": py}), _in_system(zones.select("zone_id", "geometry"), system), unit)
    return found.select(*points.columns, F.array_min("_zones").alias("zone_id"))


def _all_zones(points: DataFrame, zones: DataFrame, unit: float) -> DataFrame:
    """A row for each zone that a point lies in, with NULL for none."""
    found = _looked_up(points.withColumns({"_px": F.col("x"), "_py": F.col("y")}), zones, unit)
    return found.select(*points.columns, F.explode_outer("_zones").alias("zone_id"))


def _looked_up(found: DataFrame, zones: DataFrame, unit: float) -> DataFrame:
    """Add ``_zones``, the zones that (_px, _py) lies in."""
    cover = covering(zones, unit)
    placed = _is_finite([F.col("_px"), F.col("_py")])
    found = found.withColumns({c: F.when(placed, F.col(c)) for c in ("_px", "_py")})
    levels = sorted(r[0] for r in cover.select("level").distinct().collect())

    def holding(level: int) -> Column:
        """The shapes of a cell that hold the point."""
        corner = [F.col(c) * _size(level, unit) + SHIFT * unit for c in CELL_COLUMNS]
        return F.filter("_shapes", lambda z: z["inside"] != (crossings(z["edges"], *corner, F.col("_px"), F.col("_py")) % 2 == 1))

    for k, level in enumerate(levels):
        cells = cover.filter(F.col("level") == level).groupBy(F.col("cx").alias("_cx"), F.col("cy").alias("_cy"))
        cells = shuffled(cells.agg(F.collect_list(F.struct("zone_id", "inside", "edges")).alias("_shapes")))
        keyed = found.withColumns({c: _in_covering(F.col(p), level, unit) for c, p in zip(CELL_COLUMNS, ("_px", "_py"), strict=True)})
        named = F.transform(holding(level), lambda z: z["zone_id"])
        found = keyed.join(cells, CELL_COLUMNS, "left").withColumn(f"_z{k}", named).drop("_shapes", *CELL_COLUMNS)
    none = F.array().cast(T.ArrayType(zones.schema["zone_id"].dataType))
    return found.withColumn("_zones", F.concat(none, *[F.coalesce(f"_z{k}", none) for k in range(len(levels))]))


def centroid_distance(a: DataFrame, b: DataFrame, pairs: DataFrame) -> DataFrame:
    """Centroid distance in miles of zone pairs (origin, destination); coinciding centroids are 100 m apart.

    ``a`` and ``b`` are zone tables (zone_id, cx, cy) of origins and destinations.
    """
    both = with_centres(with_centres(pairs, a, "origin"), b, "destination")
    return both.select(*pairs.columns, straight_miles().alias("miles"))


def with_centres(pairs: DataFrame, zones: DataFrame, end: str) -> DataFrame:
    """Add the projected centroid of one end's zone; projection is done once per zone."""
    centres = zones.select(
        F.col("zone_id").alias(end), mercator_x(F.col("cx")).alias(f"_{end}_x"), mercator_y(F.col("cy")).alias(f"_{end}_y")
    )
    return lookup(pairs, centres, [end])


def straight_miles() -> Column:
    """Centroid distance of pairs prepared by ``with_centres``, at least 100 m between coinciding ones."""
    ends = [F.col(f"_{end}_{c}") for end in ("origin", "destination") for c in ("x", "y")]
    return planar_miles(*ends, at_least_m=100.0)


def _mean_latitude(df: DataFrame) -> Column:
    return df.agg(F.avg("y")).scalar()


def nearest(
    points: DataFrame, candidates: DataFrame, lat0: float | None = None, cell_m: float = 256.0, system: str | System | None = None
) -> DataFrame:
    """Nearest candidate of every point: columns id, nearest_id, distance_m; least id among equals.

    Both inputs carry id, x, y in degrees; a point is not its own candidate unless the candidates list it. Distances are
    taken in metres of ``system``, or else on a plane true at latitude ``lat0`` (default: mean of the candidates).

    Grids of cells of ``cell_m`` times a power of 4 are laid over the region, coarser and finer. A cell on any grid knows how many candidates
    it holds and the box around them. A point starts two grids' doublings above the finest grid on which any candidate
    lies in its 3 x 3 neighbourhood: there the neighbourhood must hold the nearest one. Of the cells it meets, those
    stay whose box is not farther than the nearest box surely reaches; while they hold more than MOST_MET candidates
    each is replaced by the finer cells in it. So each point meets a few boxes a grid and a few candidates, wherever
    it lies. Starts are found once for each occupied cell; points and candidates that share coordinates are searched once.
    """
    if system is None:
        cos0 = F.lit(math.cos(math.radians(lat0))) if lat0 is not None else F.cos(F.radians(_mean_latitude(candidates)))
        px, py = F.col("x") * METRES_PER_DEGREE * cos0, F.col("y") * METRES_PER_DEGREE
    else:
        px, py = project(F.col("x"), F.col("y"), system)
    found = nearest_places(
        points.select(px.alias("x"), py.alias("y")), candidates.select("id", px.alias("x"), py.alias("y")), cell_m
    )
    placed = points.withColumns({"_px": px, "_py": py}).join(found.withColumnsRenamed({"x": "_px", "y": "_py"}), ["_px", "_py"], "left")
    return placed.select("id", "nearest_id", F.sqrt("d2").alias("distance_m"))


def _box_bounds() -> tuple[Column, Column]:
    """Squared distance from (x, y) to the box of a cell, and one within which one of its candidates surely lies.

    Each side of the box has a candidate on it, so the far end of the nearer side in either direction is far enough.
    """
    low, far, near = [], [], []
    for c in "xy":
        p, a, b = F.col(c), F.col(f"_{c}0"), F.col(f"_{c}1")
        out, one, two = F.greatest(a - p, p - b, F.lit(0.0)), p - a, p - b
        low.append(out * out)
        near.append(F.least(one * one, two * two))
        far.append(F.greatest(one * one, two * two))
    return low[0] + low[1], F.least(near[0] + far[1], far[0] + near[1])


def nearest_places(places: DataFrame, candidates: DataFrame, cell_m: float = 256.0) -> DataFrame:
    """``x``, ``y``, ``nearest_id`` and ``d2`` (squared distance) of every distinct place in metres; see ``nearest``."""
    cell_key = ["_level", *CELL_COLUMNS]
    finest = cell_m / 2**FINER
    levels = 2 * math.ceil(math.log2(2 * math.pi * EARTH_RADIUS / finest) / 2)

    def celled(df: DataFrame) -> DataFrame:
        return df.withColumns({"_fx": _cell(F.col("x"), finest), "_fy": _cell(F.col("y"), finest)})

    def at_level(df: DataFrame) -> DataFrame:
        """The cell on the grid ``_level``: doubling the size drops a bit of the finest cell's number."""
        return df.withColumns({"_cx": F.expr("shiftright(_fx, _level)"), "_cy": F.expr("shiftright(_fy, _level)")})

    def neighbourhood(df: DataFrame) -> DataFrame:
        for c in CELL_COLUMNS:
            df = df.withColumn(c, F.explode(F.array(*[F.col(c) + k for k in (-1, 0, 1)])))
        return df

    def every_level(first: int) -> Column:
        return F.explode(F.sequence(F.lit(first), F.lit(levels), F.lit(2)))

    asked = places.filter("x is not null and y is not null").distinct()
    targets = celled(candidates.filter("x is not null and y is not null").groupBy("x", "y").agg(F.min("id").alias("nearest_id")))
    leveled = at_level(targets.withColumn("_level", every_level(0)))
    extremes = [f(c).alias(f"_{c}{k}") for c in "xy" for k, f in ((0, F.min), (1, F.max))]
    nodes = written_table(leveled.groupBy(*cell_key).agg(F.count(F.lit(1)).alias("_n"), *extremes), "cells")
    # Cells next to an occupied one; a place looks its own cells up among them, once for each cell of the grid of cell_m.
    beside = shuffled(neighbourhood(nodes.filter(F.col("_level") >= FINER).select(*cell_key)).distinct())
    own = celled(asked).withColumns({"_ox": F.shiftright("_fx", FINER), "_oy": F.shiftright("_fy", FINER)})
    cells = own.select("_ox", "_oy").distinct().select(
        "_ox", "_oy", F.expr(f"shiftleft(_ox, {FINER})").alias("_fx"), F.expr(f"shiftleft(_oy, {FINER})").alias("_fy"), every_level(FINER).alias("_level")
    )
    start = at_level(cells).join(beside, cell_key, "left_semi").groupBy("_ox", "_oy").agg(
        F.least(F.min("_level") + 2, F.lit(levels)).cast("int").alias("_level")
    )
    box = ["_n", "_x0", "_x1", "_y0", "_y1"]
    front = neighbourhood(at_level(own.join(start, ["_ox", "_oy"]))).select("x", "y", *cell_key)
    front = front.join(shuffled(nodes), cell_key)
    low, surely = _box_bounds()
    each = Window.partitionBy("x", "y")
    settled = None
    while True:
        front = front.withColumns({"_low": low, "_sure": F.min(surely).over(each)}).filter("_low <= _sure")
        front = cut_lineage(front.withColumn("_met", F.sum("_n").over(each)).select("x", "y", *cell_key, "_met"))
        # A cell of one place has nothing finer; all cells of a point are on one grid, so all of it goes on or none.
        ready = (F.col("_met") <= MOST_MET) | (F.col("_level") == 0)
        part = front.filter(ready).drop("_met")
        settled = part if settled is None else settled.unionByName(part)
        front = front.filter(~ready).drop("_met")
        if front.isEmpty():
            break
        inner = nodes.select(
            *box, F.col("_level").alias("_l"), F.col("_cx").alias("_x"), F.col("_cy").alias("_y"), (F.col("_level") + 2).alias("_level"),
            F.shiftright("_cx", 2).alias("_cx"), F.shiftright("_cy", 2).alias("_cy"),
        )
        front = front.join(inner, cell_key).select("x", "y", F.col("_l").alias("_level"), F.col("_x").alias("_cx"), F.col("_y").alias("_cy"), *box)
    met = leveled.select(*cell_key, F.col("x").alias("_tx"), F.col("y").alias("_ty"), "nearest_id")
    dx, dy = F.col("x") - F.col("_tx"), F.col("y") - F.col("_ty")
    best = F.min(F.struct((dx * dx + dy * dy).alias("d2"), "nearest_id")).alias("_best")
    return settled.join(shuffled(met), cell_key).groupBy("x", "y").agg(best).select("x", "y", "_best.nearest_id", "_best.d2")


def nearest_shapes(
    shapes: DataFrame, candidates: DataFrame, lat0: float | None = None, cell_m: float = 256.0, system: str | System | None = None
) -> DataFrame:
    """Nearest candidate shape of every shape: columns id, nearest_id, distance_m; 0 where they touch, least id among equals.

    Both inputs carry id and geometry in degrees; distances are between the shapes themselves, measured as in ``nearest``. A
    shape that is a candidate itself is found at distance 0. Shapes without corners have no nearest one and are not found.

    No candidate is farther than the nearest corner of one is from a corner of the shape (``nearest_places``). Sides of both
    then meet in the cells of the grid of the larger of them, only where their boxes come as near, and the least distance of two
    sides counts.
    A shape that lies in another's interior is found by one of its corners. Shapes of one form are searched once; of candidates of one
    form, and of those that share a side, only the least id is met.
    """
    if system is None:
        corners = candidates.select(F.explode(edges(F.col("geometry"))).alias("e")).select(F.col("e.a.y").alias("y"))
        lat0 = lat0 if lat0 is not None else corners.agg(F.avg("y")).first()[0] or 0.0
        cos0 = math.cos(math.radians(lat0))

        def corner(p: Column) -> Column:
            return F.struct((p["x"] * METRES_PER_DEGREE * cos0).alias("x"), (p["y"] * METRES_PER_DEGREE).alias("y"))

        plane = F.transform("geometry", lambda r: F.struct(r["hole"].alias("hole"), F.transform(r["points"], corner).alias("points")))
        shapes, candidates = (df.select("id", plane.alias("geometry")) for df in (shapes, candidates))
    else:
        shapes, candidates = (_in_system(df.select("id", "geometry"), system) for df in (shapes, candidates))

    # Forms are numbered in place of ids, since ids may repeat.
    forms = cut_lineage(shapes.select("geometry").distinct()).withColumn("_form", F.monotonically_increasing_id())
    wearers = shapes.join(forms, "geometry").select("id", "_form")
    shapes = forms.withColumnRenamed("_form", "id")
    least = F.min(F.struct("id"))["id"].alias("id")
    candidates = cut_lineage(candidates.groupBy("geometry").agg(least))

    def sides_of(df: DataFrame) -> DataFrame:
        return df.select("id", F.explode(edges(F.col("geometry"))).alias("e"))

    mine, theirs = cut_lineage(sides_of(shapes)), cut_lineage(sides_of(candidates).groupBy("e").agg(least))
    reach = nearest_places(mine.select("e.a.x", "e.a.y"), theirs.select("id", "e.a.x", "e.a.y"), cell_m)
    corners = mine.select("id", F.col("e.a.x").alias("x"), F.col("e.a.y").alias("y"))
    reach = corners.join(reach, ["x", "y"]).groupBy("id").agg(F.min("d2").alias("_reach2"))
    # A box spans at most 2 x 2 cells of the first grid of its size. Two boxes meet on the coarser of their two grids.
    x0, x1, y0, y1 = (f(F.col(f"e.a.{c}"), F.col(f"e.b.{c}")) for c in "xy" for f in (F.least, F.greatest))

    def grid(span: Column) -> Column:
        return F.greatest(F.ceil(F.log2(F.greatest(span, F.lit(1e-9)) / cell_m)), F.lit(-FINER)).cast("int")

    def boxed(df: DataFrame, near: Column) -> DataFrame:
        box = {"_x0": x0 - near, "_x1": x1 + near, "_y0": y0 - near, "_y1": y1 + near}
        return df.withColumns(box).withColumn("_own", grid(F.greatest(F.col("_x1") - F.col("_x0"), F.col("_y1") - F.col("_y0"))))

    def spread(df: DataFrame, levels: Column) -> DataFrame:
        size = F.pow(F.lit(2.0), F.col("_level")) * cell_m
        df = df.withColumn("_level", F.explode(levels))
        for c in "xy":
            df = df.withColumn(f"_c{c}", F.explode(F.sequence(*[_cell(F.col(f"_{c}{k}"), size) for k in (0, 1)])))
        return df

    def some_levels(df: DataFrame) -> Column:
        """The grids in use, as one value: the logarithms of lengths are few."""
        return F.array(*[F.lit(r[0]) for r in df.select("_own").distinct().collect()]).cast("array<int>")

    near = F.sqrt("_reach2") * (1 + 1e-12)
    grown = cut_lineage(boxed(mine.join(reach, "id"), near))
    theirs = boxed(theirs, F.lit(0.0))
    asked, given = some_levels(grown), some_levels(theirs)
    at = ["_level", *CELL_COLUMNS]
    coarser = F.array_distinct(F.concat(F.array("_own"), F.filter(given, lambda k: k > F.col("_own"))))
    left = spread(grown, coarser).select("id", "e", "_reach2", *at, *[F.col(c) for c in ("_own", "_x0", "_x1", "_y0", "_y1")])
    finer = F.array_distinct(F.concat(F.array("_own"), F.filter(asked, lambda k: k > F.col("_own"))))
    right = spread(theirs, finer).select(
        F.col("id").alias("nearest_id"), F.col("e").alias("f"), *at, F.col("_own").alias("_its"),
        *[F.col(f"_{c}{k}").alias(f"_{n}{k}") for c, n in (("x", "u"), ("y", "v")) for k in (0, 1)],
    )
    meet = left.join(shuffled(right), at).filter("_level = greatest(_own, _its)")
    meet = meet.filter("_u0 <= _x1 and _x0 <= _u1 and _v0 <= _y1 and _y0 <= _v1")
    apart = meet.select("id", "nearest_id", edge_distance2(F.col("e"), F.col("f")).alias("d2"))

    # One corner of each ring tells whether a shape lies in the interior of another.
    def one_corner(df: DataFrame) -> DataFrame:
        return df.select("id", F.explode("geometry").alias("r")).select("id", F.col("r.points")[0]["x"].alias("x"), F.col("r.points")[0]["y"].alias("y"))

    def within(points: DataFrame, zones: DataFrame) -> DataFrame:
        return _all_zones(points, zones.select(F.col("id").alias("zone_id"), "geometry"), cell_m).filter("zone_id is not null")

    inside = within(one_corner(shapes), candidates).select("id", F.col("zone_id").alias("nearest_id"), F.lit(0.0).alias("d2"))
    around = within(one_corner(candidates), shapes).select(F.col("zone_id").alias("id"), F.col("id").alias("nearest_id"), F.lit(0.0).alias("d2"))
    best = apart.unionByName(inside).unionByName(around).groupBy("id").agg(F.min(F.struct("d2", "nearest_id")).alias("_best"))
    # An id of several forms has the nearest of them.
    best = wearers.join(best.withColumnRenamed("id", "_form"), "_form").groupBy("id").agg(F.min("_best").alias("_best"))
    return best.select("id", "_best.nearest_id", F.sqrt("_best.d2").alias("distance_m"))


def max_overlap_zone(
    blocks: DataFrame, zones: DataFrame, lat0: float | None = None, cell: float = 0.05, system: str | System | None = None
) -> DataFrame:
    """Zone sharing the largest area with each block; without overlap, the zone of the nearest centroid.

    Blocks are (GEOID, geometry), zones (zone_id, geometry). Areas are compared in square
    degrees: one latitude's scale factor is common to all zones a block can overlap; less
    than a 10^12th of the block's bounding box is no overlap. Equal areas go to the least zone
    id. Only ids and bounding boxes meet in the grid, in the cell of the lower-left corner of
    their shared box, so each pair is formed once; shapes join the pairs whose boxes overlap.
    Shapes are made, and pairs worked on, in tasks dealt by row and not by size; boxes, sides and centres are found once each.
    The overlap result is checkpointed, as the fallback reads it again. With ``system``, shapes are taken from degrees into
    that local system first, areas are in its square metres, distances in its metres, and ``cell`` counts 100,000 metres.
    """
    if system is not None:
        blocks, zones, cell = _in_system(blocks, system), _in_system(zones, system), cell * 1e5
    def described(df: DataFrame, key: str) -> DataFrame:
        box = F.struct(*[v.alias(k) for k, v in bounds(F.col("geometry")).items()])
        return written_table(dealt(df.select(key, "geometry"), key).select(
            key, box.alias("box"), sides(F.col("geometry")).alias("sides"), centroid(F.col("geometry")).alias("centre"),
            (F.size("geometry") > 0).alias("has_rings"),
        ), "shapes")

    def celled(df: DataFrame, key: str, name: str) -> DataFrame:
        boxes = df.filter("has_rings").select(key, F.col("box").alias(name))
        return _covered_cells(boxes, {k: F.col(f"{name}.{k}") for k in ("x0", "x1", "y0", "y1")}, cell)

    blocks, zones = described(blocks, "GEOID"), described(zones, "zone_id")
    b = celled(blocks, "GEOID", "_bb")
    z = shuffled(celled(zones, "zone_id", "_zb"))
    x0, y0 = F.greatest("_bb.x0", "_zb.x0"), F.greatest("_bb.y0", "_zb.y0")
    meets = (F.least("_bb.x1", "_zb.x1") > x0) & (F.least("_bb.y1", "_zb.y1") > y0)
    once = (_cell(x0, cell) == F.col("_cx")) & (_cell(y0, cell) == F.col("_cy"))
    least = (F.col("_bb.x1") - F.col("_bb.x0")) * (F.col("_bb.y1") - F.col("_bb.y0")) * 1e-12
    pairs = lookup(b, z, CELL_COLUMNS, how="inner").filter(meets & once).select("GEOID", "zone_id", y0.alias("_base"), least.alias("_least"))
    block_sides = blocks.select("GEOID", F.col("sides").alias("_bs"))
    zone_sides = zones.select("zone_id", F.col("sides").alias("_zs"))
    best = cut_lineage(
        dealt(pairs, "GEOID").join(block_sides, "GEOID").join(zone_sides, "zone_id")
        .select("GEOID", "zone_id", "_least", overlap_area(F.col("_bs"), F.col("_zs"), F.col("_base")).alias("area"))
        .filter(F.col("area") > F.col("_least"))
        .groupBy("GEOID")
        .agg(F.min_by("zone_id", F.struct(-F.col("area"), "zone_id")).alias("zone_id"))
    )

    def middle(df: DataFrame, key: str) -> DataFrame:
        return df.select(F.col(key).alias("id"), "centre.x", "centre.y")

    rest = middle(blocks.join(best, "GEOID", "left_anti"), "GEOID")
    if system is None:
        fallback = nearest(rest, middle(zones, "zone_id"), lat0)
    else:  # in metres already
        found = nearest_places(rest.select("x", "y"), middle(zones, "zone_id"))
        fallback = rest.join(found, ["x", "y"], "left")
    return best.unionByName(fallback.select(F.col("id").alias("GEOID"), F.col("nearest_id").alias("zone_id")))


def block_features(pages: DataFrame, geoids: DataFrame | None = None) -> DataFrame:
    """Rows of landed feature pages (features[].attributes, geometry.rings); only listed GEOIDs if given."""
    rows = pages.select(F.explode("features").alias("f")).select(
        "f.attributes.*", rings_from_lists(F.col("f.geometry.rings")).alias("geometry")
    )
    return rows if geoids is None else rows.join(geoids.select("GEOID").distinct(), "GEOID", "left_semi")


def zone_table(raw: DataFrame, id_column: str, wkt_column: str = "geometry") -> DataFrame:
    """Zones with parsed geometry and text id TAZ; idx orders ids by number (1, 2, 10)."""
    kept = [c for c in raw.columns if c not in (id_column, wkt_column)]
    return raw.select(
        F.col(id_column).cast("string").alias("TAZ"), F.col(id_column).cast("bigint").alias("idx"), *kept,
        rings_from_wkt(F.col(wkt_column)).alias("geometry"),
    )
