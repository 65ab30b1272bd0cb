"""Population and land-use tables: zone assignment, zone totals, store updates.

Totals by zone are decomposable sums. They are taken per block (persons: per household,
then per block) before each lookup, so every join carries one row per block or household
however unevenly persons and jobs are spread.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commuta.functions.codes import first_match, household_type, pemploy, pstudent, ptype
from commuta.functions.columns import SQ_METRES_PER_ACRE, pad_id, safe_div
from commuta.functions.projections import System
from commuta.operators.geo import nearest, nearest_shapes, points_to_zones
from commuta.operators.joins import lookup

ZONE = "TAZ"

# Household income classes; the first ends below its bound, the others include both.
INCOME_CLASSES = {"HHINCQ1": (None, 30000), "HHINCQ2": (30000, 59999), "HHINCQ3": (60000, 99999), "HHINCQ4": (100000, None)}
# Age classes, both bounds included.
AGE_CLASSES = {"AGE0004": (0, 4), "AGE0519": (5, 19), "AGE2044": (20, 44), "AGE4564": (45, 64), "AGE64P": (65, None), "AGE62P": (62, None)}
# Industry codes of each employment class.
EMPLOYMENT_CLASSES = {
    "RETEMPN": ["44-45"], "FPSEMPN": ["52", "54"], "HEREMPN": ["61", "62", "71"], "AGREMPN": ["11"],
    "MWTEMPN": ["42", "31-33", "32", "48-49"],
}
# Parking cost per density.
PARKING_WEIGHTS = {
    "PRKCST": {"pop_density": -1.92168743, "hh_density": 4.89511403, "hq1_density": 4.2772001, "employment_density": 0.65784643},
    "OPRKCST": {"pop_density": -6.17833544, "hh_density": 17.55155703, "employment_density": 2.0786466},
}
# Upper bounds of the area type classes, rural to regional core.
AREA_TYPE_BOUNDS = {6: "5", 30: "4", 55: "3", 100: "2", 300: "1"}
REGIONAL_CORE = "0"


def assign_zone(
    rows: DataFrame, zones: DataFrame, key: str, unzoned: str = "drop"
) -> DataFrame:
    """Zone of every row through ``key``; rows without one are dropped or kept (``unzoned``)."""
    out = lookup(rows, zones.select(key, ZONE), [key])
    return out.filter(F.col(ZONE).isNotNull()) if unzoned == "drop" else out


def household_table(households: DataFrame, blocks: DataFrame, unzoned: str = "drop") -> DataFrame:
    """Households with zone and household type."""
    return assign_zone(households, blocks, "block_id", unzoned).withColumn("HHT", household_type())


def person_table(persons: DataFrame, households: DataFrame, blocks: DataFrame, unzoned: str = "drop") -> DataFrame:
    """Persons with zone and coordinates of the home block and the three person classes."""
    homes = lookup(
        households.select("household_id", "block_id"),
        blocks.select("block_id", ZONE, F.col("x").alias("home_x"), F.col("y").alias("home_y")),
        ["block_id"],
    ).drop("block_id")
    out = lookup(persons, homes, ["household_id"])
    if unzoned == "drop":
        out = out.filter(F.col(ZONE).isNotNull())
    return out.withColumns({"ptype": ptype(), "pemploy": pemploy(), "pstudent": pstudent()})


def relocate_jobs(
    jobs: DataFrame, blocks: DataFrame, lat0: float | None = None, shapes: DataFrame | None = None, system: str | System | None = None
) -> DataFrame:
    """Move jobs out of blocks with no land to the nearest block that has some.

    With ``shapes`` (``block_id``, ``geometry``) the distance is that between the blocks themselves, else that between
    the centroids ``x``, ``y`` of ``blocks``; in metres of ``system``, or on a plane (see ``geo.nearest``). Only the distinct
    no-land blocks that hold jobs are searched for; a job's zone, if already assigned, stays. A no-land block without a
    shape keeps its jobs.
    """
    places = blocks.select("block_id", "square_meters_land", "x", "y") if shapes is None else blocks.join(shapes, "block_id")
    kept = ["x", "y"] if shapes is None else ["geometry"]
    no_land = (
        jobs.select("block_id").distinct().join(places.filter(F.col("square_meters_land") == 0), "block_id")
        .select(F.col("block_id").alias("id"), *kept)
    )
    with_land = places.filter(F.col("square_meters_land") > 0).select(F.col("block_id").alias("id"), *kept)
    search = nearest if shapes is None else nearest_shapes
    moves = search(no_land, with_land, lat0, system=system).select(
        F.col("id").alias("block_id"), F.col("nearest_id").alias("_to")
    )
    moved = lookup(jobs, moves, ["block_id"])
    return moved.withColumn("block_id", F.coalesce("_to", "block_id")).select(*jobs.columns)


def block_totals(blocks: DataFrame, households: DataFrame, jobs: DataFrame) -> DataFrame:
    """Employment, population and acres of every block."""
    emp = jobs.groupBy("block_id").agg(F.count("sector_id").alias("TOTEMP"))
    pop = households.groupBy("block_id").agg(F.sum("persons").alias("TOTPOP"))
    return (
        blocks.join(emp, "block_id", "left").join(pop, "block_id", "left")
        .fillna(0, subset=["TOTEMP", "TOTPOP"])
        .withColumn("TOTACRE", F.col("square_meters_land") / SQ_METRES_PER_ACRE)
    )


def block_zone_map(blocks: DataFrame, mapping: DataFrame, geoid: str, unmapped: str = "keep") -> DataFrame:
    """Zone id of every block through ``geoid``; unmapped blocks keep their own id, get NULL, or go."""
    ids = mapping.select(F.col("GEOID").alias(geoid), F.col("zone_id").cast("string").alias(ZONE))
    out = lookup(blocks, ids, [geoid])
    if unmapped == "keep":
        return out.withColumn(ZONE, F.coalesce(F.col(ZONE), F.col(geoid).cast("string")))
    return out.filter(F.col(ZONE).isNotNull()) if unmapped == "drop" else out


def _within(c: str, low: float | None, high: float | None) -> Column:
    value = F.col(c)
    if low is None:
        return value < high
    return value >= low if high is None else value.between(low, high)


def _flag(cond: Column) -> Column:
    return F.when(cond, 1).otherwise(0)


def _sums(rows: DataFrame, key: str, values: dict[str, Column]) -> DataFrame:
    return rows.groupBy(key).agg(*[F.sum(v).alias(name) for name, v in values.items()])


def _resum(partial: DataFrame, via: DataFrame, key: str, up: str, names: list[str]) -> DataFrame:
    """Carry per-``key`` sums to the coarser key ``up``."""
    return _sums(partial.join(via.select(key, up), key), up, {n: F.col(n) for n in names})


def household_zone_sums(households: DataFrame, blocks: DataFrame) -> DataFrame:
    values = {"TOTHH": F.lit(1), "EMPRES": F.col("workers")}
    values |= {n: _flag(_within("income", *b)) for n, b in INCOME_CLASSES.items()}
    return _resum(_sums(households, "block_id", values), blocks, "block_id", ZONE, list(values))


def person_zone_sums(persons: DataFrame, households: DataFrame, blocks: DataFrame) -> DataFrame:
    values = {"TOTPOP": F.lit(1)} | {n: _flag(_within("age", *b)) for n, b in AGE_CLASSES.items()}
    per_block = _resum(_sums(persons, "household_id", values), households, "household_id", "block_id", list(values))
    return _resum(per_block, blocks, "block_id", ZONE, list(values))


def job_zone_sums(jobs: DataFrame, blocks: DataFrame) -> DataFrame:
    sector = F.col("sector_id")
    classed = [code for codes in EMPLOYMENT_CLASSES.values() for code in codes]
    values = {"TOTEMP": F.lit(1)}
    values |= {n: _flag(sector.isin(codes)) for n, codes in EMPLOYMENT_CLASSES.items()}
    values["OTHEMPN"] = _flag(sector.isNotNull() & ~sector.isin(classed))
    return _resum(_sums(jobs, "block_id", values), blocks, "block_id", ZONE, list(values))


def land_use_table(
    zones: DataFrame, households: DataFrame, persons: DataFrame, jobs: DataFrame, blocks: DataFrame,
    schools: DataFrame, colleges: DataFrame,
) -> DataFrame:
    """One row per zone: population, employment, enrollment, density, parking cost, area type.

    ``blocks`` carries the zone of each block; schools and colleges carry theirs.
    """
    acres = blocks.withColumn("TOTACRE", F.col("square_meters_land") / SQ_METRES_PER_ACRE)
    parts = [
        household_zone_sums(households, blocks),
        person_zone_sums(persons, households, blocks),
        job_zone_sums(jobs, blocks),
        _sums(acres, ZONE, {"TOTACRE": F.col("TOTACRE")}),
        _sums(schools, ZONE, {"HSENROLL": F.col("enrollment")}),
        _sums(colleges, ZONE, {"COLLFTE": F.col("full_time_enrollment"), "COLLPTE": F.col("part_time_enrollment")}),
    ]
    wide = reduce(lambda z, p: z.join(p, ZONE, "left"), parts, zones)
    filled = wide.fillna(0, subset=[c for p in parts for c in p.columns if c != ZONE])
    return area_type(parking_cost(densities(filled))).withColumns({
        "SHPOP62P": F.coalesce(safe_div("AGE62P", "TOTPOP"), F.lit(0.0)),
        "TOPOLOGY": F.lit(1), "TERMINAL": F.lit(0), "COUNTY": F.lit(1),
    })


def densities(zones: DataFrame) -> DataFrame:
    """Persons, households, low-income households and jobs per acre; NULL without land."""
    per_acre = {"employment_density": "TOTEMP", "pop_density": "TOTPOP", "hh_density": "TOTHH", "hq1_density": "HHINCQ1"}
    return zones.withColumns({d: safe_div(n, "TOTACRE") for d, n in per_acre.items()})


def parking_cost(zones: DataFrame) -> DataFrame:
    """Hourly and other parking cost from densities, never below zero."""
    costs = {}
    for name, weights in PARKING_WEIGHTS.items():
        cost = reduce(lambda a, b: a + b, [F.col(d) * w for d, w in weights.items()])
        costs[name] = F.when(cost > 0, cost).otherwise(0.0)
    return zones.withColumns(costs)


def area_type(zones: DataFrame) -> DataFrame:
    """Area type '0' (regional core) to '5' (rural) from weighted jobs and persons per acre."""
    weight = F.col("TOTPOP") + 2.5 * F.col("TOTEMP")
    metric = F.when(
        F.col("TOTACRE") == 0, F.when(weight > 0, F.lit(float("inf"))).otherwise(0.0)
    ).otherwise(F.coalesce(safe_div(weight, "TOTACRE"), F.lit(0.0)))
    cases = [(metric <= bound, code) for bound, code in AREA_TYPE_BOUNDS.items()]
    return zones.withColumns({
        "area_type_metric": F.when(metric != float("inf"), metric),
        "area_type": first_match(cases, REGIONAL_CORE),
    })


def enrollment_schools(
    rows: DataFrame, zones: DataFrame, counties: list[str], cell: float = 0.05, system: str | System | None = None
) -> DataFrame:
    """Schools of the listed counties with known enrollment (at least 0) and a zone."""
    kept = rows.filter(F.col("enrollment").isNotNull()).select(
        "ncessch", F.substring("county_code", -3, 3).alias("county_code"),
        F.col("longitude").alias("x"), F.col("latitude").alias("y"),
        F.greatest(F.col("enrollment"), F.lit(0.0)).alias("enrollment"),
    ).filter(F.col("county_code").isin(counties))
    return _zoned(kept, "ncessch", zones, cell, system)


def _zoned(rows: DataFrame, key: str, zones: DataFrame, cell: float, system: str | System | None) -> DataFrame:
    found = points_to_zones(rows.select(F.col(key).alias("id"), "x", "y"), zones, cell, system)
    zone = found.filter(F.col("zone_id").isNotNull()).select(F.col("id").alias(key), F.col("zone_id").alias(ZONE))
    return rows.join(zone, key)


def _enrollment_sum(levels: list[DataFrame], name: str) -> DataFrame:
    """Undergraduate plus graduate enrollment per college, a missing or negative level counting 0."""
    known = F.greatest(F.coalesce("enrollment_fall", F.lit(0.0)), F.lit(0.0))
    rows = reduce(DataFrame.unionByName, [lv.select("unitid", known.alias("n")) for lv in levels])
    return rows.groupBy("unitid").agg(F.sum("n").alias(name))


def enrollment_colleges(
    directory: DataFrame, full_time: list[DataFrame], part_time: list[DataFrame], zones: DataFrame, cell: float = 0.05,
    system: str | System | None = None,
) -> DataFrame:
    """Colleges with a zone and their full- and part-time enrollment."""
    places = directory.select("unitid", "inst_name", F.col("longitude").alias("x"), F.col("latitude").alias("y"))
    return (
        _zoned(places, "unitid", zones, cell, system)
        .join(_enrollment_sum(full_time, "full_time_enrollment"), "unitid", "left")
        .join(_enrollment_sum(part_time, "part_time_enrollment"), "unitid", "left")
    )


# Demand-model column names and the store columns they become.
PERSON_RENAMES = {"PNUM": "member_id", "workplace_taz": "work_zone_id", "school_taz": "school_zone_id"}
HOUSEHOLD_RENAMES = {"hhsize": "persons", "num_workers": "workers", "auto_ownership": "cars"}
PERSON_REPLACED = ["work_zone_id", "school_zone_id"]
HOUSEHOLD_REPLACED = ["cars"]


def conform(df: DataFrame, schema: T.StructType, renames: dict[str, str], replaced: list[str]) -> DataFrame:
    """Bring an updated table to the stored schema.

    Stale ``replaced`` columns go, updated ones take their names, and exactly the stored
    columns (plus the replaced ones) remain, cast to the stored types. A missing column
    fails here, before any job runs. ``block_id`` is always text.
    """
    types = {f.name: f.dataType for f in schema.fields}
    wanted = [*types, *[c for c in replaced if c not in types]]
    fresh = df.drop(*replaced).withColumnsRenamed(renames)
    missing = [c for c in wanted if c not in fresh.columns]
    if missing:
        raise ValueError(f"required columns missing: {missing}")
    types["block_id"] = T.StringType()
    text = {f.name for f in fresh.schema.fields if isinstance(f.dataType, T.StringType)}

    def typed(c: str) -> Column:
        value = F.col(c)
        if c in text and isinstance(types[c], T.IntegralType):
            value = value.cast("decimal(38,6)")  # text such as '3.0' is a whole number
        return value.cast(types[c]).alias(c)

    return fresh.select(*[typed(c) if c in types else F.col(c) for c in wanted])


def fk_check(
    households: DataFrame, persons: DataFrame, jobs: DataFrame, units: DataFrame, blocks: DataFrame
) -> DataFrame:
    """Rows that point at a missing block or household, per reference."""
    checks = [
        ("households.block_id", households, blocks, "block_id"),
        ("persons.household_id", persons, households, "household_id"),
        ("jobs.block_id", jobs, blocks, "block_id"),
        ("residential_units.block_id", units, blocks, "block_id"),
    ]

    def violations(name: str, rows: DataFrame, ref: DataFrame, key: str) -> DataFrame:
        per_key = rows.groupBy(key).agg(F.count("*").alias("n"))
        bad = per_key.join(ref.select(key), key, "left_anti")
        return bad.agg(F.lit(name).alias("check"), F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))

    return reduce(DataFrame.unionByName, [violations(*c) for c in checks])


def overwrite_columns(base: DataFrame, updates: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Replace whole columns with values matched by key, unique on both sides; unmatched rows get NULL."""
    kept = [c for c in base.columns if c not in columns]
    order = [*base.columns, *[c for c in columns if c not in base.columns]]
    return base.select(*kept).join(updates.select(*keys, *columns), keys, "left").select(*order)


def warm_start_update(base: DataFrame, choices: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Take choice columns of the demand model into the stored table, by id. Unequal row counts are an error."""
    a, b = (df.agg(F.count("*")).scalar() for df in (base, choices))
    unequal = F.raise_error(F.concat_ws(" ", F.lit("warm start of"), a.cast("string"), F.lit("rows with choices of"), b.cast("string")))
    return overwrite_columns(base, choices, [key], columns).filter(F.when(a == b, True).otherwise(unequal))


def same_row_count(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: both row counts and whether they agree."""
    n = a.select(F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(b.select(F.lit(0).alias("a"), F.lit(1).alias("b")))
    return n.agg(F.sum("a").alias("rows_a"), F.sum("b").alias("rows_b")).withColumn(
        "same", (F.col("rows_a") == F.col("rows_b")).cast("int")
    )


def person_locations_update(persons: DataFrame, demand: DataFrame) -> DataFrame:
    """Work and school location from demand persons (household, id), id counting members from 0."""
    found = demand.select(
        F.col("household").alias("household_id"), (F.col("id") + 1).alias("member_id"),
        F.col("work_location_id").alias("work_zone_id"), F.col("school_location_id").alias("school_zone_id"),
    )
    columns = ["work_zone_id", "school_zone_id"]
    return overwrite_columns(persons, found, ["household_id", "member_id"], columns)


def padded_ids(df: DataFrame, widths: dict[str, int]) -> DataFrame:
    """Zero-pad id columns, for example block_id to 15 and county to 5 characters."""
    return df.withColumns({c: pad_id(c, n) for c, n in widths.items()})
