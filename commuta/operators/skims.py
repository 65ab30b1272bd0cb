"""Origin-destination travel-cost tables ("skims").

Long form: one row per slice (time period, path type) and origin-destination pair, one
column per measure. Packed form: one row per slice and origin with one array a measure, by the
destination's position; completion, distances and export work on it, and pairs are unpacked last.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commuta.functions.columns import MILES_PER_KM, finite, hash_uniform, safe_div
from commuta.functions.geometry import mercator_x, mercator_y, planar_metres, planar_miles_of
from commuta.operators.joins import as_of, lookup, missing_keys, running_totals

# Time periods, paths and measure sources of the demand model.
PERIODS = ["EA", "AM", "MD", "PM", "EV"]
HIGHWAY_PATHS = ["SOV", "SOVTOLL", "HOV2", "HOV2TOLL", "HOV3", "HOV3TOLL"]
TRANSIT_PATHS = [
    "DRV_COM_WLK", "DRV_HVY_WLK", "DRV_LOC_WLK", "DRV_LRF_WLK", "DRV_EXP_WLK", "WLK_COM_DRV", "WLK_HVY_DRV",
    "WLK_LOC_DRV", "WLK_LRF_DRV", "WLK_EXP_DRV", "WLK_COM_WLK", "WLK_HVY_WLK", "WLK_LOC_WLK", "WLK_LRF_WLK",
    "WLK_EXP_WLK", "WLK_TRN_WLK",
]
HIGHWAY_MEASURES = {"TIME": "TIME_minutes", "DIST": "DIST_miles", "BTOLL": None, "VTOLL": "VTOLL_FAR"}
TRANSIT_MEASURES = {
    "WAIT": None, "TOTIVT": "TOTIVT_IVT_minutes", "KEYIVT": "KEYIVT_minutes", "FERRYIVT": "FERRYIVT_minutes",
    "FAR": "VTOLL_FAR", "DTIM": "DTIM_minutes", "DDIST": "DDIST_miles", "WAUX": "WAUX_minutes",
    "WEGR": "WEGR_minutes", "WACC": "WACC_minutes", "IWAIT": None, "XWAIT": None, "BOARDS": "BOARDS",
    "IVT": "TOTIVT_IVT_minutes",
}
# Measures kept unscaled, scale of the others, speed in mph behind an unknown time.
UNSCALED = ["FAR", "BOARDS"]
TRANSIT_SCALE = 100
DEFAULT_MPH = 40
# Parts of total transit time, and cells that mean no connection.
TRANSIT_TIME_PARTS = ["TOTIVT", "IWAIT", "WAIT", "WAUX", "WEGR", "XWAIT", "WACC"]
NO_CONNECTION = [0, 999]
# Ride times from here on mean no service; cost per mile without service.
NO_SERVICE_S = 86400
NO_SERVICE_COST = 99999.0

# Fixed value: destinations in a stretch; their names, once for each slice, are within what a compressor looks back on.
STRETCH = 1024

SKIM_KEYS = ["timePeriod", "pathType", "origin", "destination"]
OD = ["origin", "destination"]


def zone_index(blocks: DataFrame, zone_type: str, overlap: DataFrame | None = None) -> DataFrame:
    """GEOID to zone id '1'..'N' in GEOID order, by block or block group; for 'taz' the given overlap map."""
    if zone_type == "taz":
        return overlap.select("GEOID", F.col("zone_id").cast("string").alias("zone_id"))
    geoid = {"block": F.col("block_id"), "block_group": F.substring("block_id", 1, 12)}[zone_type]
    ids = blocks.select(geoid.alias("GEOID"), F.lit(1).alias("one")).distinct()
    tract = F.substring("GEOID", 1, 11)
    return running_totals(ids, tract, "GEOID", {"idx": "one"}).select("GEOID", F.col("idx").cast("string").alias("zone_id"))


def zone_order(zones: DataFrame) -> DataFrame:
    """Zone ids with their numeric position."""
    return zones.select("zone_id", F.col("zone_id").cast("bigint").alias("idx")).distinct()


def geoid_order(mapping: DataFrame) -> DataFrame:
    """For runs by block or block group: the GEOIDs as zone ids, in the order of their mapped zone numbers."""
    return mapping.select(F.col("GEOID").alias("zone_id"), F.col("zone_id").cast("bigint").alias("idx")).distinct()


def zone_order_check(order: DataFrame) -> DataFrame:
    """One row: least and greatest position, number of zones, and whether they run 1..N."""
    seen = order.agg(F.min("idx").alias("first"), F.max("idx").alias("last"), F.countDistinct("idx").alias("zones"))
    runs = (F.col("first") == 1) & (F.col("last") == F.col("zones"))
    return seen.withColumn("contiguous", runs.cast("int"))


def skim_clean(skims: DataFrame) -> DataFrame:
    """Add distances in miles; 0, infinity and NaN become NULL in every measure.

    A drive-access distance of minus infinity is an error, as no later step can repair it.
    """
    km = {"DIST_miles": "DIST_meters", "DDIST_miles": "DDIST_meters"}
    wide = skims.withColumns({m: F.col(src) * (MILES_PER_KM / 1000) for m, src in km.items()})
    broken = F.raise_error(F.lit("origin-destination distances contain infinite values"))
    wide = wide.withColumn(
        "DDIST_miles", F.when(F.col("DDIST_miles") == float("-inf"), broken).otherwise(F.col("DDIST_miles"))
    )
    measures = [f.name for f in wide.schema.fields if f.dataType.typeName() in ("double", "float")]
    return wide.withColumns({c: F.nullif(finite(c), F.lit(0.0)) for c in measures})


def zone_coverage(skims: DataFrame, zones: DataFrame) -> DataFrame:
    """Zones on one side only, for origins and destinations: (side, zone_id, problem)."""
    def side(end: str) -> DataFrame:
        unknown = missing_keys(skims, end, zones, "zone_id").select(F.col(end).alias("zone_id"), F.lit("unknown zone").alias("problem"))
        absent = missing_keys(zones, "zone_id", skims, end).select("zone_id", F.lit("no rows").alias("problem"))
        return unknown.unionByName(absent).select(F.lit(end).alias("side"), "zone_id", "problem")

    return side("origin").unionByName(side("destination"))


def split_by_mode(skims: DataFrame, highway: list[str], transit: list[str]) -> tuple[DataFrame, DataFrame]:
    """Highway rows and transit rows; ``absent_modes`` tells whether one of them is empty."""
    return skims.filter(F.col("pathType").isin(highway)), skims.filter(F.col("pathType").isin(transit))


def absent_modes(skims: DataFrame, highway: list[str], transit: list[str]) -> DataFrame:
    """'highway' or 'transit' (column ``mode``) where no row of the skims has one of its paths."""
    mode = F.when(F.col("pathType").isin(highway), "highway").when(F.col("pathType").isin(transit), "transit")
    counts = skims.agg(*[F.count(F.when(mode == m, 1)).alias(m) for m in ("highway", "transit")])
    rows = F.array(*[F.struct(F.lit(m).alias("mode"), F.col(m).alias("n")) for m in ("highway", "transit")])
    return counts.select(F.inline(rows)).filter("n = 0").select("mode")


def _dealt(df: DataFrame, keys: list[str]) -> DataFrame:
    """Spread few rows that are about to grow into many over all shuffle partitions."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def _zone_list(zones: DataFrame) -> Column:
    """The zones in the order of their positions, as one array value (idx, zone_id)."""
    return zones.agg(F.array_sort(F.collect_list(F.struct(F.col("idx").cast("int").alias("idx"), "zone_id")))).scalar()


def _zone_ids(zones: DataFrame) -> Column:
    """Zone ids by position, as one array value."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col("idx").cast("int").alias("idx"), "zone_id")))
    return zones.agg(F.transform(ordered, lambda z: z["zone_id"])).scalar()


def _given_cells(df: DataFrame, zones: DataFrame, slices: dict[str, list] | list[str], measures: dict[str, Column], dealt_by: list[str]) -> DataFrame:
    """The cells that ``df`` has, as ``_given`` by slice and ``o_idx``; see ``_given_od``. ``dealt_by`` are all of these or some."""
    names = list(slices)
    keys = [*names, "o_idx"]
    unknown = F.raise_error(F.concat_ws(" ", F.lit("unknown zone in the pair"), "origin", "destination"))
    double = F.raise_error(F.concat_ws(" ", F.lit("more than one row for the pair of positions"), "o_idx", "d"))
    rows = df
    if isinstance(slices, dict):
        rows = df.filter(reduce(lambda a, b: a & b, [F.col(c).isin(v) for c, v in slices.items()], F.lit(True)))
    rows = rows.select(*names, *OD, *[v.cast("double").alias(m) for m, v in measures.items()])
    for end, position in (("origin", "_o"), ("destination", "_d")):
        rows = rows.join(zones.select(F.col("zone_id").alias(end), F.col("idx").cast("int").alias(position)), end, "left")
    numbered = rows.select(*names, F.coalesce("_o", unknown).alias("o_idx"), F.coalesce("_d", unknown).alias("d"), *measures)
    return (  # dealt once, as the frame is: neither the count of a pair nor its row's list nor the join needs another shuffle
        _dealt(numbered, dealt_by).groupBy(*keys, "d").agg(F.count("*").alias("_rows"), *[F.max(m).alias(m) for m in measures])
        .filter(F.when(F.col("_rows") > 1, double).otherwise(True))
        .groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("d", *measures))).alias("_given"))
    )


def _given_od(
    df: DataFrame, zones: DataFrame, slices: dict[str, list] | list[str], measures: dict[str, Column], rows_per_part: int | None = None,
) -> DataFrame:
    """All origins of every slice: slice columns, ``origin``, ``o_idx``, ``_given`` and ``_zones`` (their number).

    ``_given`` has the cells that ``df`` has, by destination: structs of the position ``d`` and the measures, which are worked
    out on the rows of ``df``. It is NULL where there are none. See ``pack_od`` for the rest.
    """
    names = list(slices)
    keys = [*names, "o_idx"]
    given = _given_cells(df, zones, slices, measures, keys)
    if isinstance(slices, dict):
        frame = zones.select(F.col("zone_id").alias("origin"), F.col("idx").cast("int").alias("o_idx"))
        for column, values in slices.items():
            frame = frame.withColumn(column, F.explode(F.array(*[F.lit(v) for v in values])))
    else:
        frame = df.select(*names).distinct().withColumn("_zone", F.explode(_zone_list(zones)))
        frame = frame.select(*names, F.col("_zone.zone_id").alias("origin"), F.col("_zone.idx").alias("o_idx"))
    packed = _dealt(frame, keys).join(given, keys, "left")
    if rows_per_part is not None:
        parts = packed.withColumn("_part", F.floor((F.col("o_idx") - 1) / rows_per_part))
        packed = _dealt(parts, [*names, "_part"]).sortWithinPartitions(*keys).drop("_part")
    return packed.withColumn("_zones", zones.agg(F.count("*").cast("int")).scalar())


def _dense(measure: str, default: Column | float | None, given: Column | None = None) -> Column:
    """A measure of all destinations: ``default`` (a number, or an array by position) wherever ``given`` (or column ``_given``) has no value.

    Given values are set between whole stretches of the default, so the work follows the cells that are given.
    """
    by_place = isinstance(default, Column)
    given, n = F.col("_given") if given is None else given, F.col("_zones")
    plain = F.lit(default).cast("double")

    def stretch(first: Column, last: Column) -> Column:
        many = last - first + 1
        return F.slice(default, first, many) if by_place else F.array_repeat(plain, many)

    def value(c: Column) -> Column:
        return F.coalesce(c[measure], F.get(default, c["d"] - 1) if by_place else plain)

    def then_rest(c: Column, i: Column) -> Column:
        return F.concat(F.array(value(c)), stretch(c["d"] + 1, F.coalesce(F.get(given, i + 1)["d"], n + 1) - 1))

    whole = default if by_place else F.array_repeat(plain, n)
    spread = F.flatten(F.concat(F.array(stretch(F.lit(1), F.get(given, 0)["d"] - 1)), F.transform(given, then_rest)))
    return F.when(given.isNull(), whole).when(F.size(given) == n, F.transform(given, value)).otherwise(spread)


def pack_od(
    df: DataFrame, zones: DataFrame, slices: dict[str, list] | list[str], measures: list[str], fill: float | None = None,
    rows_per_part: int | None = None,
) -> DataFrame:
    """All origins of every slice, one row each: slice columns, ``origin``, ``o_idx`` and an array for each measure.

    Entry i of an array belongs to the zone of position i + 1; a pair that is not given, or given as NULL, has ``fill``.
    ``zones`` carries positions ``idx`` 1..N. ``slices`` maps slice columns to their values, or names columns
    whose values are those of the rows. A pair given twice or naming an unknown zone is an error.

    Zones are numbered by joins with the zone list. Only the given cells are shuffled, at most one per zone; they are
    spread over the array where it lies. With ``rows_per_part`` a part of so many consecutive origins of a slice is whole in one task,
    and rows are in order there: they are dealt and sorted while they have the given cells alone.
    """
    given = _given_od(df, zones, slices, {m: F.col(m) for m in measures}, rows_per_part)
    return given.select(*slices, "origin", "o_idx", *[_dense(m, fill).alias(m) for m in measures])


def _array_columns(packed: DataFrame) -> list[str]:
    return [f.name for f in packed.schema if isinstance(f.dataType, T.ArrayType)]


def unpack_od(packed: DataFrame, zones: DataFrame) -> DataFrame:
    """One row per cell of packed rows, in ``SKIM_KEYS`` order. Nothing is shuffled after the cells are unpacked."""
    measures = _array_columns(packed)
    keys = [c for c in packed.columns if c not in ("origin", "o_idx", *measures)]
    size = F.nullif(F.size(measures[0]), F.lit(0))  # no rows for none; a filter would move below and make the array a second time
    places = F.explode(F.sequence(F.lit(0), size - 1)).alias("_d")
    cells = packed.select(*keys, "origin", *measures, places)
    return cells.select(*keys, "origin", F.get(_zone_ids(zones), F.col("_d")).alias("destination"), *[F.get(m, "_d").alias(m) for m in measures])


def od_complete(
    df: DataFrame, zones: DataFrame, slices: dict[str, list], measures: list[str], fill: float | None = 0.0,
) -> DataFrame:
    """Full N x N rows per slice, missing cells filled; see ``pack_od``. An origin's slices are unpacked side by side, by ``STRETCH``
    destinations: where rows are stored, names that stand near to where they stood before take hardly any space again."""
    if not slices:
        return unpack_od(pack_od(df, zones, slices, measures, fill), zones)
    given = _given_cells(df, zones, slices, {m: F.col(m) for m in measures}, ["o_idx"])
    by_origin = given.groupBy("o_idx").agg(F.collect_list(F.struct(*slices, "_given")).alias("_all"))
    frame = zones.select(F.col("zone_id").alias("origin"), F.col("idx").cast("int").alias("o_idx"))
    origins = _dealt(frame, ["o_idx"]).join(by_origin, "o_idx", "left").withColumn("_zones", zones.agg(F.count("*").cast("int")).scalar())
    named = F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip(slices, values, strict=True)]) for values in product(*slices.values())])

    def of_slice(s: Column) -> Column:
        own = F.filter("_all", lambda g: reduce(lambda a, b: a & b, [g[c] == s[c] for c in slices]))
        return F.struct(*[s[c].alias(c) for c in slices], F.get(own, 0)["_given"].alias("_given"))

    def whole(s: Column) -> Column:
        return F.struct(*[s[c].alias(c) for c in slices], *[_dense(m, fill, s["_given"]).alias(m) for m in measures])

    packed = origins.select("origin", "_zones", F.transform(F.transform(named, of_slice), whole).alias("_slices"))
    stretches = packed.select("*", F.explode(F.sequence(F.lit(0), F.col("_zones") - 1, F.lit(STRETCH))).alias("_first"))
    each = stretches.select("*", F.explode(F.sequence(F.lit(0), F.size("_slices") - 1)).alias("_s"))
    one = F.get("_slices", F.col("_s"))
    rows = each.select("origin", "_first", "_zones", *[one[c].alias(c) for c in [*slices, *measures]])  # arrays are taken once a stretch, not once a cell
    cells = rows.select("*", F.explode(F.sequence("_first", F.least(F.col("_first") + STRETCH, "_zones") - 1)).alias("_d"))
    destination = F.get(_zone_ids(zones), F.col("_d")).alias("destination")
    return cells.select(*slices, "origin", destination, *[F.get(m, F.col("_d")).alias(m) for m in measures])


def _pack_miles(highway: DataFrame, zones: DataFrame) -> DataFrame:
    """What miles are made from, by origin: the last highway row's distances (``_miles``), the origin's centroid
    (``_x0``, ``_y0``) and those of all zones by position (``_x``, ``_y``), projected."""
    last = highway.groupBy(*OD).agg(F.max_by("DIST_miles", "ordinal").alias("_miles"))
    centre = F.struct(F.col("idx").cast("int").alias("idx"), mercator_x(F.col("cx")).alias("x"), mercator_y(F.col("cy")).alias("y"))
    centres = F.array_sort(F.collect_list(centre))
    packed = pack_od(last, zones, {}, ["_miles"]).withColumns(
        {f"_{c}": zones.agg(_part(centres, c)).scalar() for c in ("x", "y")}
    )
    return packed.withColumns({f"{c}0": F.get(c, F.col("o_idx") - 1) for c in ("_x", "_y")})


def _miles(given: Column, metres: Column) -> Column:
    return F.coalesce(given, planar_miles_of(metres, at_least_m=100.0))


def pack_distance(highway: DataFrame, zones: DataFrame) -> DataFrame:
    """Packed miles (measure DIST): the last highway row's distance, else between centroids (at least 100 m).

    ``highway`` carries ``ordinal``, its file order; a NULL last distance is imputed too.
    ``zones`` carries centroid cx, cy. Centroids meet the packed rows, not the pairs.
    """
    packed = _pack_miles(highway, zones)
    dx, dy = F.transform("_x", lambda x: F.col("_x0") - x), F.transform("_y", lambda y: F.col("_y0") - y)
    metres = F.zip_with(dx, dy, planar_metres)  # array by array: a term of an expression over arrays is worked out wherever it stands
    return packed.select("origin", "o_idx", F.zip_with("_miles", metres, _miles).alias("DIST"))


def _part(structs: Column, field: str) -> Column:
    return F.transform(structs, lambda z: z[field])


def distance_skim(highway: DataFrame, zones: DataFrame) -> DataFrame:
    """Miles per pair (see ``pack_distance``), published for car, bicycle and foot alike; worked out on the unpacked pairs,
    where expressions are compiled, as those over arrays are not."""
    cells = unpack_od(_pack_miles(highway, zones), zones)
    miles = _miles(F.col("_miles"), planar_metres(F.col("_x0") - F.col("_x"), F.col("_y0") - F.col("_y")))
    return cells.select(*OD, miles.alias("DIST")).withColumns({"DISTBIKE": F.col("DIST"), "DISTWALK": F.col("DIST")})


def pack_auto(
    highway: DataFrame, distance: DataFrame, zones: DataFrame, periods: list[str] = PERIODS,
    paths: list[str] = HIGHWAY_PATHS, measure_map: dict[str, str | None] = HIGHWAY_MEASURES, by_path: bool = False,
) -> DataFrame:
    """Packed drive skims (period, path). Unknown distances come from ``distance`` (packed, see
    ``pack_distance``), unknown times from it at 40 mph, other unknown or unmapped measures are 0.

    By default every path repeats the period's rows, and two highway rows of one pair in a
    period are an error; ``by_path`` gives each path its own rows. Distances join per origin.
    """
    sources = sorted({s for s in measure_map.values() if s})
    slices = {"timePeriod": periods} | ({"pathType": paths} if by_path else {})
    minutes = F.transform("DIST", lambda far: far * (60 / DEFAULT_MPH))
    far = distance.select("o_idx", F.col("DIST").alias("_miles"), minutes.alias("_minutes"))
    packed = _given_od(highway, zones, slices, {m: F.col(m) for m in sources}).join(far, "o_idx")
    defaults = {"DIST": F.col("_miles"), "TIME": F.col("_minutes")}
    measures = [
        (_dense(source, defaults.get(name, 0.0)) if source else F.array_repeat(F.lit(0.0), F.col("_zones"))).alias(name)
        for name, source in measure_map.items()
    ]
    packed = packed.select(*slices, "origin", "o_idx", *measures)
    if not by_path:
        packed = packed.withColumn("pathType", F.explode(F.array(*[F.lit(p) for p in paths])))
    return packed.select("timePeriod", "pathType", "origin", "o_idx", *measure_map)


def auto_skims(highway: DataFrame, distance: DataFrame, zones: DataFrame, *args, **kw) -> DataFrame:
    """Wide drive skims (period, path, pair); see ``pack_auto``."""
    return unpack_od(pack_auto(highway, distance, zones, *args, **kw), zones)


def _given_transit(
    transit: DataFrame, zones: DataFrame, periods: list[str], paths: list[str], measure_map: dict[str, str | None], origins: DataFrame | None = None,
    finish: Callable[[Column], Column] = lambda value: value,
) -> tuple[DataFrame, dict[str, str], Column]:
    """The given cells by period and path read (see ``_given_od``), the column behind each mapped measure, and the names of a path's readers."""
    local: dict[str, list[str]] = {}
    for path in paths:
        local.setdefault(path.replace("EXP", "LOC").replace("TRN", "LOC"), []).append(path)
    sources = {n: f"{s}*1" if n in UNSCALED else f"{s}*{TRANSIT_SCALE}" for n, s in measure_map.items() if s}
    scaled = {sources[n]: finish(F.col(s) if n in UNSCALED else F.col(s) * TRANSIT_SCALE) for n, s in measure_map.items() if s}
    given = _given_od(transit.withColumnRenamed("pathType", "_read"), zones, {"timePeriod": periods, "_read": list(local)}, scaled)
    if origins is not None:
        given = given.join(origins.select("origin"), "origin", "left_semi")
    name_map = F.create_map(*[c for k, v in local.items() for c in (F.lit(k), F.array(*[F.lit(n) for n in v]))])
    return given, sources, name_map[F.col("_read")]


def pack_transit(
    transit: DataFrame, zones: DataFrame, periods: list[str] = PERIODS, paths: list[str] = TRANSIT_PATHS,
    measure_map: dict[str, str | None] = TRANSIT_MEASURES, origins: DataFrame | None = None,
    finish: Callable[[Column], Column] = lambda value: value,
) -> DataFrame:
    """Packed transit skims (period, path); express and any-transit paths read the local path's rows.

    Mapped measures are scaled by 100, on the given rows, except fares and boardings; missing is 0. With ``origins`` (column
    ``origin``) only their rows are completed. ``finish`` is applied to the scaled values of the given rows, before cells are
    completed: what it does must leave 0 as it is.
    """
    given, sources, readers = _given_transit(transit, zones, periods, paths, measure_map, origins, finish)
    dense = given.select("timePeriod", "_read", "origin", "o_idx", "_zones", *[_dense(s, 0.0).alias(s) for s in dict.fromkeys(sources.values())])
    named = dense.withColumn("pathType", F.explode(readers))
    none = F.array_repeat(F.lit(0.0), F.col("_zones"))
    return named.select("timePeriod", "pathType", "origin", "o_idx", *[
        (F.col(f"`{sources[n]}`") if s else none).alias(n) for n, s in measure_map.items()
    ])


def given_transit(
    transit: DataFrame, zones: DataFrame, periods: list[str] = PERIODS, paths: list[str] = TRANSIT_PATHS,
    measure_map: dict[str, str | None] = TRANSIT_MEASURES,
) -> DataFrame:
    """The cells of ``transit_skims`` that ``transit`` has rows for, in the same columns; all others are 0 in every measure."""
    given, sources, readers = _given_transit(transit, zones, periods, paths, measure_map)
    cells = given.select("timePeriod", "origin", F.explode(readers).alias("pathType"), "_given").withColumn("_c", F.explode("_given"))
    none = F.lit(0.0)
    return cells.select("timePeriod", "pathType", "origin", F.get(_zone_ids(zones), F.col("_c.d") - 1).alias("destination"), *[
        (F.coalesce(F.col("_c")[sources[n]], none) if s else none).alias(n) for n, s in measure_map.items()
    ])


def transit_skims(transit: DataFrame, zones: DataFrame, *args, **kw) -> DataFrame:
    """Wide transit skims (period, path, pair); see ``pack_transit``."""
    return unpack_od(pack_transit(transit, zones, *args, **kw), zones)


def pack_wide(wide: DataFrame, zones: DataFrame, rows_per_part: int | None = None) -> DataFrame:
    """Long skims as packed rows: every origin of every slice that has rows, absent pairs NULL; see ``pack_od``."""
    slices = [c for c in SKIM_KEYS if c in wide.columns and c not in OD]
    return pack_od(wide, zones, slices, [c for c in wide.columns if c not in SKIM_KEYS], rows_per_part=rows_per_part)


def matrix_export(packed: DataFrame, name: Column | None = None, side_by_side: bool = False) -> DataFrame:
    """One row per matrix and origin of packed skims: (name, o_idx, values).

    Value i of an array belongs to zone position i; a pair without a value is NULL in its
    place. Names are path_measure__period unless ``name`` gives the prefix. Nothing is shuffled.
    With ``side_by_side`` a slice's matrices stay in one row per origin, a column each, named by their measures.
    """
    measures = _array_columns(packed)
    if side_by_side:
        return packed.drop("origin")
    slices = [c for c in packed.columns if c not in ("origin", "o_idx", *measures)]
    named = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("values")) for m in measures])
    exported = packed.select(*slices, "o_idx", F.explode(named).alias("_m"))
    if name is None:
        name = F.concat("pathType", F.lit("_"), "_m.measure", F.lit("__"), "timePeriod") if slices else F.col("_m.measure")
    return exported.select(name.alias("name"), "o_idx", "_m.values")


def distance_matrices(packed: DataFrame, stretch: int | None = None) -> DataFrame:
    """Matrices of packed distances (see ``pack_distance``), published for car, bicycle and foot alike.

    With ``stretch`` a row has so many values at most, those behind the ``first`` positions, and the matrices of a stretch follow one
    another: positions unfolded from them repeat nearby, so they compress where they are stored.
    """
    names = F.explode(F.array(*[F.lit(m) for m in ("DIST", "DISTBIKE", "DISTWALK")])).alias("name")
    exported = matrix_export(packed)
    if stretch is None:
        return exported.select(names, "o_idx", "values")
    firsts = F.explode(F.sequence(F.lit(0), F.nullif(F.size("values"), F.lit(0)) - 1, F.lit(stretch))).alias("first")
    parts = exported.select("o_idx", "values", firsts).select("o_idx", "first", F.slice("values", F.col("first") + 1, stretch).alias("values"))
    return parts.select(names, "o_idx", "first", "values")


def skim_upsert(base: DataFrame, new: DataFrame | None) -> DataFrame:
    """Newest skims over all skims: matched rows fully replaced, new rows added; without new skims, unchanged."""
    if new is None:
        return base
    keys = new.select(*[F.col(k).alias(f"_{k}") for k in SKIM_KEYS])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in SKIM_KEYS])
    return new.unionByName(base.join(keys, same, "left_anti"), allowMissingColumns=True)


def transit_total_time(wide: DataFrame, path: str = "WLK_LOC_WLK", period: str = "AM") -> DataFrame:
    """Total transit minutes per pair of one path and period."""
    total = reduce(lambda a, b: a + b, [F.col(p) for p in TRANSIT_TIME_PARTS]) / TRANSIT_SCALE
    return wide.filter((F.col("pathType") == path) & (F.col("timePeriod") == period)).select(*OD, total.alias("value"))


def profile_origins(pairs: DataFrame, k: int, seed: int) -> DataFrame:
    """k sampled origins that have any value; pairs of value 0 may be left out."""
    return (
        pairs.groupBy("origin").agg(F.sum("value").alias("_sum")).filter(F.col("_sum") != 0)
        .orderBy(hash_uniform("origin", seed), "origin").limit(k).select("origin")
    )


def skim_profile(pairs: DataFrame, k: int, seed: int, given: DataFrame | None = None) -> DataFrame:
    """Rows of k sampled origins that have any value; 0 and 999 read as no connection (NULL).

    ``given``, where there is one, has all pairs of other origins too, save those of value 0: origins are drawn from it
    (``profile_origins``), and ``pairs`` need be completed for them alone.
    """
    sampled = profile_origins(pairs if given is None else given, k, seed)
    value = F.when(~F.col("value").isin(NO_CONNECTION), F.col("value"))
    return pairs.join(sampled, "origin", "left_semi").withColumn("value", value)


def with_interval(df: DataFrame, minute: Column, iskims: DataFrame, name: str) -> DataFrame:
    """Add the end of the interval holding a time: the first end after it, else the last end.

    A day has few intervals, so their sorted ends travel as one array value.
    """
    ends = iskims.agg(F.array_sort(F.collect_set("interval_end"))).scalar()
    after = F.filter(F.col("_ends"), lambda e: e > minute)
    at = F.coalesce(F.try_element_at(after, F.lit(1)), F.element_at("_ends", -1))
    return df.withColumn("_ends", ends).withColumn(name, at).drop("_ends")


def with_interval_merged(df: DataFrame, minute: Column, ends: DataFrame, name: str) -> DataFrame:
    """``with_interval`` for ends (one row each, column ``interval_end``) too many for one value: by a merge of times and ends."""
    marks = ends.select("interval_end").distinct().select((-F.col("interval_end").cast("double")).alias("_at"), F.col("interval_end").alias(name))
    found = as_of(df.withColumn("_at", -minute.cast("double")), marks, "_at", strict=True).drop("_at")
    return found.withColumn(name, F.coalesce(name, ends.agg(F.max("interval_end")).scalar()))


def _of_mode(iskims: DataFrame, mode: str | None) -> DataFrame:
    """Interval skims of one mode; a table keyed by mode must be given one."""
    if mode is not None:
        return iskims.filter(F.col("mode") == mode).drop("mode")
    if "mode" in iskims.columns:
        raise ValueError("interval skims keyed by mode: name the mode")
    return iskims


def od_time_lookup(
    trips: DataFrame, iskims: DataFrame, zones: DataFrame, measures: list[str], mode: str | None = None
) -> DataFrame:
    """Skim values of each trip (id, o, d, minute) in the interval it starts in; unknown zones drop the trip.

    Interval skims keyed by ``mode`` are read for one mode, in that mode's intervals. More than
    one row for an interval and pair is an error. Nearly all keys of the skims are different, so rows are counted
    in the order that the join sorts them into: no table of all keys is held by a task, and sorting can spill.
    """
    own = _of_mode(iskims, mode)
    known = zones.select("zone")
    kept = lookup(trips, known.select(F.col("zone").alias("o")), ["o"], how="inner")
    kept = lookup(kept, known.select(F.col("zone").alias("d")), ["d"], how="inner")
    timed = with_interval(kept, F.col("minute"), own, "interval_end")
    keys = ["o", "d", "interval_end"]  # intervals are few: sorted by them first, most rows would be equal at first sight
    double = F.raise_error(F.concat_ws(" ", F.lit("more than one skim row for"), "interval_end", "o", "d"))
    rows = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    single = own.select(*keys, *measures, rows.alias("_rows")).filter(F.when(F.col("_rows") > 1, double).otherwise(True))
    return timed.join(single.drop("_rows"), keys, "left").select("id", "o", "d", "minute", *measures)


def od_lookup_rejects(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Zones that trips name but the skims lack, per side, with their number of trips."""
    def side(end: str) -> DataFrame:
        per_zone = trips.groupBy(F.col(end).alias("zone")).agg(F.count("*").alias("trips"))
        return per_zone.join(zones.select("zone"), "zone", "left_anti").withColumn("side", F.lit(end))

    return side("o").unionByName(side("d"))


def cost_per_mile(
    iskims: DataFrame, minute: int = 540, auto_mode: str | None = None, transit_mode: str | None = None
) -> DataFrame:
    """Auto and transit cost per distance unit of every origin, in the interval holding ``minute``.

    Interval skims keyed by mode are read for ``auto_mode`` and ``transit_mode``, each in its own
    intervals. Transit counts other zones with service only; an origin without any costs 99999.
    """
    def current(mode: str | None) -> DataFrame:
        own = _of_mode(iskims, mode)
        return with_interval(own, F.lit(minute), own, "_now").filter(F.col("interval_end") == F.col("_now"))

    served = (F.col("ivtt") > 0) & (F.col("ivtt") < NO_SERVICE_S) & (F.col("o") != F.col("d"))
    auto = [safe_div(F.sum("cost"), F.sum("distance")).alias("auto_costpermile")]
    transit = [
        F.coalesce(F.sum(F.when(served, F.col("fare"))), F.lit(0.0)).alias("_fare"),
        F.coalesce(F.sum(F.when(served, F.col("distance"))), F.lit(0.0)).alias("_dist"),
    ]
    origin = F.col("o").alias("taz")
    if auto_mode == transit_mode:
        sums = current(auto_mode).groupBy(origin).agg(*auto, *transit)
    else:
        sums = current(auto_mode).groupBy(origin).agg(*auto).join(current(transit_mode).groupBy(origin).agg(*transit), "taz", "left")
    none = F.coalesce(F.col("_dist"), F.lit(0.0)) == 0
    return sums.select("taz", "auto_costpermile", F.when(none, NO_SERVICE_COST).otherwise(safe_div("_fare", "_dist")).alias("tran_costpermile"))


def landuse_travel_data(skims: DataFrame, zone_map: DataFrame | None = None) -> DataFrame:
    """Drive-alone morning times and distances for the land-use model, GEOIDs mapped to zones (NULL if unknown)."""
    rows = skims.filter((F.col("pathType") == "SOV") & (F.col("timePeriod") == "AM")).select(
        F.col("origin").cast("string").alias("from_zone_id"), F.col("destination").cast("string").alias("to_zone_id"),
        F.col("TOTIVT_IVT_minutes").alias("SOV_AM_IVT_mins"), "DIST_meters",
    )
    if zone_map is None:
        return rows
    for end in ("from_zone_id", "to_zone_id"):
        ids = zone_map.select(F.col("GEOID").alias(end), F.col("zone_id").alias("_zone"))
        rows = lookup(rows, ids, [end]).drop(end).withColumnRenamed("_zone", end)
    return rows


def matrix_rows_to_od(rows: DataFrame, values: dict[str, str]) -> DataFrame:
    """Matrix rows (from position, one array per measure) to pairs by 0-based position.

    The first measure decides which cells exist; a NULL or NaN cell of it is dropped.
    """
    first, *rest = values.items()
    cells = rows.select(
        F.col("row").cast("string").alias("from_zone_id"), *[F.col(src) for _, src in rest],
        F.posexplode(first[1]).alias("_to", first[0]),
    ).filter(finite(first[0]).isNotNull())
    return cells.select(
        "from_zone_id", F.col("_to").cast("string").alias("to_zone_id"), first[0],
        *[F.get(F.col(src), F.col("_to")).alias(name) for name, src in rest],
    )


def od_accumulate(parts: dict[str, list[DataFrame]], how: dict[str, str], zones: DataFrame) -> DataFrame:
    """Build a full pair table from value lists (o, d, value, ordinal) per measure, missing 0.

    ``how`` is 'sum' (all lists of a measure add up) or 'last' (the latest row of the
    latest list wins). Rows naming unknown zones are left out (see od_ignored_zones).
    """
    known = zones.select("zone_id")

    def tagged() -> list[DataFrame]:
        return [
            df.select(
                F.col("o").cast("string").alias("origin"), F.col("d").cast("string").alias("destination"),
                F.lit(m).alias("_m"), F.lit(i).alias("_part"), F.col("value").cast("double").alias("value"), F.col("ordinal").alias("_row"),
            )
            for m, dfs in parts.items() for i, df in enumerate(dfs)
        ]

    rows = reduce(DataFrame.unionByName, tagged())
    whole = rows.schema["_row"].dataType.typeName() in ("byte", "short", "integer", "long")
    at = F.coalesce(F.col("_row").cast("long"), F.lit(-(2**63))) if whole else F.struct("_row")  # a row without an ordinal comes first

    def measure(m: str) -> list[Column]:
        mine = F.col("_m") == m
        if how[m] == "sum":
            return [F.sum(F.when(mine, F.col("value"))).alias(m)]
        each = [(i, f"_{m}_{i}", mine & (F.col("_part") == i)) for i in range(len(parts[m]))]
        has = [F.max(F.when(own, True)).alias(f"{n}_has") for i, n, own in each if i > 0]
        return [*has, *[F.max_by("value", F.when(own, at)).alias(n) for _, n, own in each]]

    def latest(m: str) -> Column:
        """Of the lists that have rows, the last one's value, also where that is NULL."""
        if how[m] == "sum":
            return F.col(m)
        found = F.col(f"_{m}_0")
        for i in range(1, len(parts[m])):
            found = F.when(F.col(f"_{m}_{i}_has"), F.col(f"_{m}_{i}")).otherwise(found)
        return found

    # Numbers as orders, one a list, are kept in a hashed table; one struct of list and row would have all rows sorted.
    sums = rows.groupBy(*OD).agg(*[c for m in parts for c in measure(m)]).select(*OD, *[latest(m).alias(m) for m in parts])
    inside = sums.join(known.withColumnRenamed("zone_id", "origin"), "origin", "left_semi").join(
        known.withColumnRenamed("zone_id", "destination"), "destination", "left_semi"
    )
    return od_complete(inside, zones, {}, list(parts))


def od_ignored_zones(parts: list[DataFrame], zones: DataFrame) -> DataFrame:
    """Zones named in value lists that the zone list lacks."""
    named = reduce(DataFrame.unionByName, [
        df.select(F.col(end).cast("string").alias("zone_id")) for df in parts for end in ("o", "d")
    ])
    return missing_keys(named, "zone_id", zones, "zone_id")


def zone_subset(listed: DataFrame, known: DataFrame) -> DataFrame:
    """Listed zones (zone, position) that the skims know, numbered from 0 in list order."""
    kept = listed.join(known.select("zone").distinct(), "zone", "left_semi").withColumn("_one", F.lit(1))
    ranked = running_totals(kept, F.floor(F.col("position") / 10000), "position", {"_rank": "_one"})
    return ranked.select("zone", (F.col("_rank") - 1).alias("idx"))


def _between(iskims: DataFrame, origins: DataFrame, destinations: DataFrame) -> DataFrame:
    return iskims.join(origins.select(F.col("zone").alias("o")), "o", "left_semi").join(
        destinations.select(F.col("zone").alias("d")), "d", "left_semi"
    )


def skim_subset_pivot(
    iskims: DataFrame, origins: DataFrame, destinations: DataFrame, intervals: list[int], measures: list[str],
    mode: str | None = None,
) -> DataFrame:
    """Listed origins and destinations only, one column per measure and interval: O, D, measure_interval."""
    kept = _between(_of_mode(iskims, mode), origins, destinations)
    cells = [
        F.max(F.when(F.col("interval_end") == i, F.col(m))).alias(f"{m}_{i}") for m in measures for i in intervals
    ]
    return kept.groupBy(F.col("o").alias("O"), F.col("d").alias("D")).agg(*cells)


def skim_blocks(
    iskims: DataFrame, origins: DataFrame, destinations: DataFrame, measures: list[str],
    intervals: list[int] | None = None, modes: list[str] | None = None,
) -> DataFrame:
    """Listed origins and destinations in blocks of mode and interval: mode, interval_end, O, D, measures.

    ``intervals`` and ``modes`` limit the blocks; without them all are kept.
    """
    kept = _between(iskims, origins, destinations)
    for column, wanted in (("interval_end", intervals), ("mode", modes)):
        if wanted is not None:
            kept = kept.filter(F.col(column).isin(wanted))
    return kept.select("mode", "interval_end", F.col("o").alias("O"), F.col("d").alias("D"), *measures)
