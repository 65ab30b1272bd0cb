"""Population, land-use and geography queries."""

import math

from pyspark.sql import functions as F

from commuta.functions.columns import pad_id
from commuta.functions.geometry import METRES_PER_DEGREE, rings_from_wkt
from commuta.functions.projections import SYSTEMS, project
from commuta.operators import geo, landuse as lu
from commuta.operators.joins import dealt
from workload.registry import add

LAT0 = 30.25
COS0 = math.cos(math.radians(LAT0))
COUNTIES = ["001", "003", "007", "011"]


def households(T):
    return T.household.withColumnRenamed("household", "household_id")


def persons(T):
    return T.person.withColumnsRenamed({"person": "person_id", "household": "household_id"})


def blocks(T):
    return T.block.withColumn("TAZ", F.col("zone").cast("string"))


def zones(T):
    return geo.zone_table(T.zone_raw, "zone_id").withColumnRenamed("TAZ", "zone_id")


def schools(T):
    return lu.enrollment_schools(T.school, zones(T), COUNTIES)


def colleges(T):
    return lu.enrollment_colleges(T.college, [T.undergraduate, T.graduate], [T.graduate], zones(T))


H = "select h.*, cast(b.zone as varchar) as TAZ from (select household as household_id, * exclude (household, zone) from fx_household) h"
PTYPE = """case when age >= 18 and coalesce(worker = 1, false) and not coalesce(student = 1, false) then 1
    when age >= 18 and coalesce(student = 1, false) then 3
    when age between 18 and 64 and not coalesce(worker = 1, false) and not coalesce(student = 1, false) then 4
    when age >= 65 and not coalesce(worker = 1, false) and not coalesce(student = 1, false) then 5
    when age between 16 and 17 then 6 when age between 6 and 16 then 7 when age between 0 and 5 then 8 else 0 end"""
PEMPLOY = "case when worker = 1 and age >= 16 then 1 when worker = 0 and age >= 16 then 3 when age < 16 then 4 else 0 end"
PSTUDENT = "case when age <= 18 then 1 when student = 1 then 2 when student = 0 then 3 else 0 end"

add("l01_l06_household_table", lambda T: lu.household_table(households(T).drop("zone"), blocks(T)), """
    select h.household as household_id, h.* exclude (household, zone), cast(b.zone as varchar) as TAZ,
        case when persons = 1 then 1 else 4 end as HHT
    from fx_household h join fx_block b on h.block_id = b.block_id""")
add("l01_job_zones_kept", lambda T: lu.assign_zone(
    T.job.select("block_id", "sector_id"), blocks(T), "block_id", unzoned="keep"),
    """select j.block_id, j.sector_id, cast(b.zone as varchar) as TAZ
    from fx_job j left join fx_block b on j.block_id = b.block_id""")
add("l01_l05_person_table", lambda T: lu.person_table(persons(T), households(T), blocks(T)), f"""
    select p.person as person_id, p.household as household_id, p.* exclude (person, household),
        cast(b.zone as varchar) as TAZ, round(b.x, 6) as home_x, round(b.y, 6) as home_y,
        {PTYPE} as ptype, {PEMPLOY} as pemploy, {PSTUDENT} as pstudent
    from fx_person p join fx_household h on p.household = h.household join fx_block b on h.block_id = b.block_id""")
add("l07_relocate_jobs",
    lambda T: lu.relocate_jobs(T.job.select("block_id", "sector_id"), T.block, LAT0), f"""
    with bad as (select distinct j.block_id, b.x, b.y from fx_job j join fx_block b on j.block_id = b.block_id
                 where square_meters_land = 0),
    ranked as (select bad.block_id, c.block_id as target, row_number() over (partition by bad.block_id order by
            power(bad.x * {METRES_PER_DEGREE!r} * {COS0!r} - c.x * {METRES_PER_DEGREE!r} * {COS0!r}, 2)
            + power(bad.y * {METRES_PER_DEGREE!r} - c.y * {METRES_PER_DEGREE!r}, 2), c.block_id) as rn
        from bad, fx_block c where c.square_meters_land > 0)
    select coalesce(r.target, j.block_id) as block_id, j.sector_id
    from fx_job j left join ranked r on j.block_id = r.block_id and r.rn = 1""")
add("l08_block_totals", lambda T: lu.block_totals(T.block, T.household, T.job), """
    select b.*, coalesce(e.n, 0) as TOTEMP, cast(coalesce(p.n, 0) as bigint) as TOTPOP,
        round(square_meters_land / 4046.86, 6) as TOTACRE
    from fx_block b left join (select block_id, count(sector_id) as n from fx_job group by block_id) e on b.block_id = e.block_id
    left join (select block_id, sum(persons) as n from fx_household group by block_id) p on b.block_id = p.block_id""".replace(
    "b.*", "b.* replace (round(b.x, 6) as x, round(b.y, 6) as y)"))


def _mapping(T):
    """Zone ids of the block groups whose tract number is a zone number."""
    groups = T.block.select(F.substring("block_id", 1, 12).alias("GEOID")).distinct()
    return groups.join(T.taz.select(F.concat(F.lit("48453"), F.lpad("zone_id", 6, "0"), F.lit("1")).alias("GEOID"), "zone_id"), "GEOID")


_MAP = """(select distinct substr(block_id, 1, 12) as GEOID, t.zone_id from fx_block b
    join fx_taz t on substr(block_id, 1, 12) = concat('48453', lpad(t.zone_id, 6, '0'), '1'))"""
for mode, cond, value in (
    ("keep", "true", "coalesce(m.zone_id, g.bg)"), ("null", "true", "m.zone_id"), ("drop", "m.zone_id is not null", "m.zone_id"),
):
    add(f"l09_block_zone_map_{mode}", lambda T, mode=mode: lu.block_zone_map(
        T.block.select("block_id", F.substring("block_id", 1, 12).alias("block_group_id")), _mapping(T), "block_group_id", mode), f"""
        select g.block_id, g.bg as block_group_id, {value} as TAZ
        from (select block_id, substr(block_id, 1, 12) as bg from fx_block) g left join {_MAP} m on g.bg = m.GEOID
        where {cond}""")

ENROLL = f"""schools as (select t.zone_id as TAZ, sum(greatest(enrollment, 0)) as HSENROLL from fx_school s
        join fx_taz t on longitude >= x0 and longitude < x1 and latitude >= y0 and latitude < y1
        where enrollment is not null and right(county_code, 3) in ({", ".join(f"'{c}'" for c in COUNTIES)}) group by 1),
    ft as (select unitid, sum(greatest(coalesce(enrollment_fall, 0), 0)) as n from
        (select * from fx_undergraduate union all select * from fx_graduate) group by 1),
    pt as (select unitid, greatest(coalesce(enrollment_fall, 0), 0) as n from fx_graduate),
    colleges as (select c.*, t.zone_id as TAZ, ft.n as full_time_enrollment, pt.n as part_time_enrollment
        from fx_college c join fx_taz t on longitude >= x0 and longitude < x1 and latitude >= y0 and latitude < y1
        left join ft on c.unitid = ft.unitid left join pt on c.unitid = pt.unitid)"""


def land_use(T):
    return lu.land_use_table(
        T.zone.select(F.col("zone").cast("string").alias("TAZ")), households(T), persons(T), T.job, blocks(T),
        schools(T), colleges(T),
    )


LAND_USE = f"""with {ENROLL},
    hh as (select b.zone, count(*) as TOTHH, sum(workers) as EMPRES, count(*) filter (where income < 30000) as HHINCQ1,
            count(*) filter (where income between 30000 and 59999) as HHINCQ2,
            count(*) filter (where income between 60000 and 99999) as HHINCQ3,
            count(*) filter (where income >= 100000) as HHINCQ4
        from fx_household h join fx_block b on h.block_id = b.block_id group by 1),
    pp as (select b.zone, count(*) as TOTPOP, count(*) filter (where age between 0 and 4) as AGE0004,
            count(*) filter (where age between 5 and 19) as AGE0519, count(*) filter (where age between 20 and 44) as AGE2044,
            count(*) filter (where age between 45 and 64) as AGE4564, count(*) filter (where age >= 65) as AGE64P,
            count(*) filter (where age >= 62) as AGE62P
        from fx_person p join fx_household h on p.household = h.household join fx_block b on h.block_id = b.block_id group by 1),
    jj as (select b.zone, count(*) as TOTEMP, count(*) filter (where sector_id = '44-45') as RETEMPN,
            count(*) filter (where sector_id in ('52', '54')) as FPSEMPN,
            count(*) filter (where sector_id in ('61', '62', '71')) as HEREMPN,
            count(*) filter (where sector_id = '11') as AGREMPN,
            count(*) filter (where sector_id in ('42', '31-33', '32', '48-49')) as MWTEMPN,
            count(*) filter (where sector_id not in ('44-45', '52', '54', '61', '62', '71', '11', '42', '31-33', '32', '48-49')) as OTHEMPN
        from fx_job j join fx_block b on j.block_id = b.block_id group by 1),
    bb as (select zone, sum(square_meters_land / 4046.86) as TOTACRE from fx_block group by 1),
    cc as (select TAZ, sum(full_time_enrollment) as COLLFTE, sum(part_time_enrollment) as COLLPTE from colleges group by 1),
    t as (select cast(z.zone as varchar) as TAZ,
        {", ".join(f"cast(coalesce({c}, 0) as bigint) as {c}" for c in "TOTHH EMPRES HHINCQ1 HHINCQ2 HHINCQ3 HHINCQ4 TOTPOP AGE0004 AGE0519 AGE2044 AGE4564 AGE64P AGE62P TOTEMP RETEMPN FPSEMPN HEREMPN AGREMPN MWTEMPN OTHEMPN".split())},
        {", ".join(f"coalesce({c}, 0) as {c}" for c in "TOTACRE HSENROLL COLLFTE COLLPTE".split())}
        from fx_zone z left join hh on z.zone = hh.zone left join pp on z.zone = pp.zone left join jj on z.zone = jj.zone
        left join bb on z.zone = bb.zone left join schools s on s.TAZ = cast(z.zone as varchar)
        left join cc on cc.TAZ = cast(z.zone as varchar)),
    u as (select *, nullif(TOTACRE, 0) as a, TOTPOP + 2.5 * TOTEMP as w from t)
    select * exclude (a, w, TOTACRE), round(TOTACRE, 6) as TOTACRE, round(TOTEMP / a, 6) as employment_density,
        round(TOTPOP / a, 6) as pop_density, round(TOTHH / a, 6) as hh_density, round(HHINCQ1 / a, 6) as hq1_density,
        round(greatest(coalesce((-1.92168743 * TOTPOP + 4.89511403 * TOTHH + 4.2772001 * HHINCQ1 + 0.65784643 * TOTEMP) / a, 0), 0), 6)::double as PRKCST,
        round(greatest(coalesce((-6.17833544 * TOTPOP + 17.55155703 * TOTHH + 2.0786466 * TOTEMP) / a, 0), 0), 6)::double as OPRKCST,
        round(coalesce(AGE62P / nullif(TOTPOP, 0), 0), 6) as SHPOP62P,
        case when a is not null then round(w / a, 6)::double when w > 0 then null else 0.0::double end as area_type_metric,
        case when a is null then case when w > 0 then '0' else '5' end when w / a <= 6 then '5' when w / a <= 30 then '4'
            when w / a <= 55 then '3' when w / a <= 100 then '2' when w / a <= 300 then '1' else '0' end as area_type,
        1 as TOPOLOGY, 0 as TERMINAL, 1 as COUNTY from u"""

add("l10_l12_land_use_table", land_use, LAND_USE)
add("l13_enrollment_schools", schools, f"""
    select s.ncessch, right(s.county_code, 3) as county_code, round(longitude, 6) as x, round(latitude, 6) as y,
        greatest(enrollment, 0)::double as enrollment, t.zone_id as TAZ
    from fx_school s join fx_taz t on longitude >= x0 and longitude < x1 and latitude >= y0 and latitude < y1
    where enrollment is not null and right(county_code, 3) in ({", ".join(f"'{c}'" for c in COUNTIES)})""")
add("l13_enrollment_colleges", colleges, f"""
    with {ENROLL} select unitid, inst_name, round(longitude, 6) as x, round(latitude, 6) as y, TAZ,
        full_time_enrollment::double as full_time_enrollment, part_time_enrollment::double as part_time_enrollment
    from colleges""")


def conformed(T):
    stored = persons(T).select("person_id", "household_id", "member_id", "age").schema
    updated = persons(T).select(
        "person_id", "household_id", F.col("member_id").cast("double").alias("PNUM"), "age",
        F.col("work_location_id").alias("workplace_taz"), F.col("school_location_id").alias("school_taz"),
        F.lit(0).alias("work_zone_id"),
    )
    return lu.conform(updated, stored, lu.PERSON_RENAMES, lu.PERSON_REPLACED)


add("l14_conform", conformed, """
    select person as person_id, household as household_id, member_id, age, work_location_id as work_zone_id,
        school_location_id as school_zone_id from fx_person""")
add("l15_fk_check", lambda T: lu.fk_check(
    households(T), persons(T), T.job, T.household.select("household", F.coalesce("block_id", F.lit("none")).alias("block_id")),
    T.block), """
    with b as (select block_id from fx_block)
    select 'households.block_id' as "check", count(*) as violations from fx_household where block_id is null or block_id not in (from b)
    union all select 'persons.household_id', count(*) from fx_person where household not in (select household from fx_household)
    union all select 'jobs.block_id', count(*) from fx_job where block_id not in (from b)
    union all select 'residential_units.block_id', count(*) from fx_household where coalesce(block_id, 'none') not in (from b)""")


def _choices(T):
    """Choices for the persons who are active in the event log."""
    return T.activity.groupBy(F.col("person").alias("person_id")).agg(
        F.max("location_id").alias("work_zone_id"), F.min("location_id").alias("school_zone_id"))


def _all_choices(T):
    """The same with a row for every person, as a warm start requires."""
    return T.person.select(F.col("person").alias("person_id")).join(_choices(T), "person_id", "left")


add("l16_warm_start_update", lambda T: lu.warm_start_update(
    persons(T).select("person_id", "age", F.col("work_location_id").alias("work_zone_id")), _all_choices(T), "person_id",
    ["work_zone_id", "school_zone_id"]), """
    select p.person as person_id, p.age, c.w as work_zone_id, c.s as school_zone_id from fx_person p left join
    (select person, max(location_id) as w, min(location_id) as s from fx_activity group by 1) c on p.person = c.person""")
add("l16_same_row_count", lambda T: lu.same_row_count(persons(T), _choices(T)), """
    select (select count(*) from fx_person) as rows_a, (select count(distinct person) from fx_activity) as rows_b,
        cast((select count(*) from fx_person) = (select count(distinct person) from fx_activity) as int) as same""")
add("l17_person_locations_update", lambda T: lu.person_locations_update(
    persons(T).select("person_id", "household_id", "member_id", F.col("school_location_id").alias("school_zone_id")),
    T.person.select("household", F.col("relate").alias("id"), "work_location_id", "school_location_id")
    .join(T.location.select(F.col("location").alias("work_location_id")), "work_location_id", "left_semi")), """
    select p.person as person_id, p.household as household_id, p.member_id, q.work_location_id as work_zone_id,
        q.school_location_id as school_zone_id
    from fx_person p left join (select * from fx_person where work_location_id in (select location from fx_location)) q
    on p.household = q.household and p.member_id = q.relate + 1""")
add("l18_id_padding", lambda T: T.block.select(
    "block_no", pad_id("block_no", 15).alias("block_id"), pad_id(F.col("block_no") * 997, 5).alias("county")), """
    select block_no, lpad(cast(block_no as varchar), 15, '0') as block_id,
        case when length(cast(block_no * 997 as varchar)) >= 5 then cast(block_no * 997 as varchar)
        else lpad(cast(block_no * 997 as varchar), 5, '0') end as county from fx_block""")

MILES = """(0.621371 / 1000) * case when m = 0 then 100 else m end"""


def mercator(a, b):
    """Metres between two lon/lat pairs, as SQL."""
    def mx(c):
        return f"6378137.0 * radians({c})"

    def my(c):
        return f"6378137.0 * ln(tan(pi() / 4 + radians({c}) / 2))"

    return f"sqrt(power({mx(a[0])} - {mx(b[0])}, 2) + power({my(a[1])} - {my(b[1])}, 2))"


add("g01_centroid_distance", lambda T: geo.centroid_distance(
    _centroids(T), _centroids(T),
    T.skim_raw.select("origin", "destination").distinct()), f"""
    select origin, destination, round({MILES}, 6)::double as miles from
    (select s.origin, s.destination, {mercator(("o.cx", "o.cy"), ("d.cx", "d.cy"))} as m
     from (select distinct origin, destination from fx_skim_raw) s
     join fx_taz o on s.origin = o.zone_id join fx_taz d on s.destination = d.zone_id)""")


def _centroids(T):
    from commuta.functions.geometry import centroid

    c = centroid(F.col("geometry"))
    return zones(T).select("zone_id", c["x"].alias("cx"), c["y"].alias("cy"))


add("g02_points_to_zones", lambda T: geo.points_to_zones(
    T.school.select(F.col("ncessch").alias("id"), F.col("longitude").alias("x"), F.col("latitude").alias("y")), zones(T)), """
    select ncessch as id, round(longitude, 6) as x, round(latitude, 6) as y, t.zone_id from fx_school
    left join fx_taz t on longitude >= x0 and longitude < x1 and latitude >= y0 and latitude < y1""")
PLANE = f"""power({{0}}.x * {METRES_PER_DEGREE!r} * {COS0!r} - {{1}}.cx * {METRES_PER_DEGREE!r} * {COS0!r}, 2)
    + power({{0}}.y * {METRES_PER_DEGREE!r} - {{1}}.cy * {METRES_PER_DEGREE!r}, 2)"""


def box(df, key):
    """Rectangles x0..y1 as geometry."""
    corner = lambda x, y: F.concat(F.col(x).cast("string"), F.lit(" "), F.col(y).cast("string"))
    ring = F.concat_ws(", ", corner("x0", "y0"), corner("x1", "y0"), corner("x1", "y1"), corner("x0", "y1"), corner("x0", "y0"))
    wkt = F.concat(F.lit("POLYGON (("), ring, F.lit("))"))
    corners = df.select(key, "x0", "x1", "y0", "y1")
    name = corners.columns[0]
    return dealt(corners, name).select(name, rings_from_wkt(wkt).alias("geometry"))


add("g03_max_overlap_zone", lambda T: geo.max_overlap_zone(
    box(T.block_box, F.col("block_id").alias("GEOID")), zones(T), LAT0), f"""
    with pairs as (select b.block_id, t.zone_id, row_number() over (partition by b.block_id order by
            (least(b.x1, t.x1) - greatest(b.x0, t.x0)) * (least(b.y1, t.y1) - greatest(b.y0, t.y0)) desc) as rn
        from fx_block_box b join fx_taz t on least(b.x1, t.x1) > greatest(b.x0, t.x0) and least(b.y1, t.y1) > greatest(b.y0, t.y0)),
    rest as (select block_id, (x0 + x1) / 2 as x, (y0 + y1) / 2 as y from fx_block_box
        where block_id not in (select block_id from pairs)),
    near as (select r.block_id, t.zone_id, row_number() over (partition by r.block_id order by {PLANE.format("r", "t")}, t.zone_id) as rn
        from rest r, fx_taz t)
    select block_id as GEOID, zone_id from pairs where rn = 1 union all select block_id, zone_id from near where rn = 1""")
add("g04_nearest", lambda T: geo.nearest(
    T.block.select(F.col("block_id").alias("id"), "x", "y"),
    T.taz.select(F.col("zone_id").alias("id"), F.col("cx").alias("x"), F.col("cy").alias("y")), LAT0), f"""
    select id, nearest_id, round(sqrt(d), 6) as distance_m from (
        select b.block_id as id, t.zone_id as nearest_id, {PLANE.format("b", "t")} as d,
            row_number() over (partition by b.block_id order by {PLANE.format("b", "t")}, t.zone_id) as rn
        from fx_block b, fx_taz t) where rn = 1""")


def conic_sql(code, lon, lat):
    """Metres east and north in a conic system, as SQL."""
    system = SYSTEMS[code]
    n, scale, radius0 = system._cone()
    e = system.ellipsoid.e
    t = f"(tan(pi() / 4 - radians({lat}) / 2) / power((1 - {e!r} * sin(radians({lat}))) / (1 + {e!r} * sin(radians({lat}))), {e / 2!r}))"
    radius, theta = f"({scale!r} * power({t}, {n!r}))", f"({n!r} * radians({lon} - ({system.lon0!r})))"
    return f"({system.east0!r} + {radius} * sin({theta}))", f"({system.north0 + radius0!r} - {radius} * cos({theta}))"


def cylinder_sql(code, lon, lat):
    """Metres east and north in a transverse cylinder's system, as SQL."""
    system = SYSTEMS[code]
    radius, onto, _ = system._series()
    e = system.ellipsoid.e
    t = f"sinh(atanh(sin(radians({lat}))) - {e!r} * atanh({e!r} * sin(radians({lat}))))"
    away = f"radians({lon} - ({system.lon0!r}))"
    xi, eta = f"atan2({t}, cos({away}))", f"atanh(sin({away}) / sqrt(1 + power({t}, 2)))"
    x = " + ".join([eta, *[f"({a!r}) * cos({2 * k} * {xi}) * sinh({2 * k} * {eta})" for k, a in enumerate(onto, 1)]])
    y = " + ".join([xi, *[f"({a!r}) * sin({2 * k} * {xi}) * cosh({2 * k} * {eta})" for k, a in enumerate(onto, 1)]])
    return f"({system.east0!r} + {radius!r} * ({x}))", f"({system.north0 - system._origin()!r} + {radius!r} * ({y}))"


def projected(T):
    """Blocks in the systems of both regions, to the centimetre; for the second one they are moved there."""
    east = [project(F.col("x"), F.col("y"), "EPSG:32140"), project(F.col("x") - 24.4, F.col("y") + 7.6, "EPSG:7131")]
    names = [("east", "north"), ("bay_east", "bay_north")]
    return T.block.select("block_id", *[F.round(c, 2).alias(n) for pair, two in zip(east, names, strict=True) for c, n in zip(pair, two, strict=True)])


TEXAS, BAY = conic_sql("EPSG:32140", "x", "y"), cylinder_sql("EPSG:7131", "(x - 24.4)", "(y + 7.6)")
add("g07_project", projected, f"""
    select block_id, round({TEXAS[0]}, 2) as east, round({TEXAS[1]}, 2) as north,
        round({BAY[0]}, 2) as bay_east, round({BAY[1]}, 2) as bay_north from fx_block""")


def quad_sql(alias):
    """Whether (px, py) lies in the projected corners of a rectangle, which are convex."""
    corners = [("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1")]
    return " and ".join(
        f"({alias}.{d[0]}{d[1]}_x - {alias}.{c[0]}{c[1]}_x) * (py - {alias}.{c[0]}{c[1]}_y) >= ({alias}.{d[0]}{d[1]}_y - {alias}.{c[0]}{c[1]}_y) * (px - {alias}.{c[0]}{c[1]}_x)"
        for c, d in zip(corners, corners[1:] + corners[:1], strict=True)
    )


QUADS = "select zone_id, " + ", ".join(
    f"{conic_sql('EPSG:32140', x, y)[k]} as {x}{y}_{'xy'[k]}" for x in ("x0", "x1") for y in ("y0", "y1") for k in (0, 1)
) + " from fx_taz"
PLACED = conic_sql("EPSG:32140", "longitude", "latitude")
#: Schools lie on round coordinates, as zone borders do, which a projection bends by rounding: they are moved off them.
MOVED = "(select * replace (longitude + 0.0003 as longitude, latitude + 0.0007 as latitude) from fx_school)"


def moved_schools(T):
    return T.school.withColumns({"longitude": F.col("longitude") + 0.0003, "latitude": F.col("latitude") + 0.0007})


add("g02_points_to_zones_local", lambda T: geo.points_to_zones(
    moved_schools(T).select(F.col("ncessch").alias("id"), F.col("longitude").alias("x"), F.col("latitude").alias("y")), zones(T),
    system="EPSG:32140"), f"""
    select ncessch as id, round(longitude, 6) as x, round(latitude, 6) as y, min(q.zone_id) as zone_id
    from (select *, {PLACED[0]} as px, {PLACED[1]} as py from {MOVED}) s left join ({QUADS}) q on {quad_sql("q")}
    group by all""")
add("l13_enrollment_schools_local", lambda T: lu.enrollment_schools(moved_schools(T), zones(T), COUNTIES, system="EPSG:32140"), f"""
    select s.ncessch, right(s.county_code, 3) as county_code, round(longitude, 6) as x, round(latitude, 6) as y,
        greatest(enrollment, 0)::double as enrollment, min(q.zone_id) as TAZ
    from (select *, {PLACED[0]} as px, {PLACED[1]} as py from {MOVED}) s join ({QUADS}) q on {quad_sql("q")}
    where enrollment is not null and right(county_code, 3) in ({", ".join(f"'{c}'" for c in COUNTIES)}) group by all""")
CENTRES = conic_sql("EPSG:32140", "cx", "cy")
add("g04_nearest_local", lambda T: geo.nearest(
    T.block.select(F.col("block_id").alias("id"), "x", "y"),
    T.taz.select(F.col("zone_id").alias("id"), F.col("cx").alias("x"), F.col("cy").alias("y")), system="EPSG:32140").withColumn(
        "distance_m", F.round("distance_m", 2)), f"""
    select id, nearest_id, round(sqrt(d), 2) as distance_m from (
        select b.block_id as id, t.zone_id as nearest_id, power(bx - tx, 2) + power(by_ - ty, 2) as d,
            row_number() over (partition by b.block_id order by power(bx - tx, 2) + power(by_ - ty, 2), t.zone_id) as rn
        from (select block_id, {TEXAS[0]} as bx, {TEXAS[1]} as by_ from fx_block) b,
             (select zone_id, {CENTRES[0]} as tx, {CENTRES[1]} as ty from fx_taz) t) where rn = 1""")


def boxes(T, key="id"):
    return box(T.block_box, F.col("block_id").alias(key))


#: Squared metres between two rectangles of the plane that is true at LAT0, to the micrometre squared, so that touching ones tie.
BOX_GAP = f"""round(power(greatest(greatest(a.x0 - b.x1, b.x0 - a.x1), 0) * {METRES_PER_DEGREE!r} * {COS0!r}, 2)
    + power(greatest(greatest(a.y0 - b.y1, b.y0 - a.y1), 0) * {METRES_PER_DEGREE!r}, 2), 6)"""


def apart_shapes(T):
    """The nearest block with land of each block without, from shape to shape."""
    land = T.block.select(F.col("block_id").alias("id"), "square_meters_land")
    shapes = boxes(T).join(land, "id")
    return geo.nearest_shapes(shapes.filter("square_meters_land = 0"), shapes.filter("square_meters_land > 0"), LAT0)


NEAREST_BOX = f"""
    select a.block_id as id, min(struct_pack(d := {BOX_GAP}, to_id := b.block_id)) as best
    from fx_block_box a join fx_block m on m.block_id = a.block_id and m.square_meters_land = 0,
         fx_block_box b join fx_block n on n.block_id = b.block_id and n.square_meters_land > 0
    group by a.block_id"""
add("g08_nearest_shapes", apart_shapes, f"""
    select id, best.to_id as nearest_id, round(sqrt(best.d), 6) as distance_m from ({NEAREST_BOX})""")
add("l07_relocate_jobs_shapes", lambda T: lu.relocate_jobs(
    T.job.select("block_id", "sector_id"), T.block, LAT0, boxes(T, "block_id")), f"""
    select coalesce(best.to_id, j.block_id) as block_id, j.sector_id
    from fx_job j left join ({NEAREST_BOX}) r on j.block_id = r.id""")


def feature_pages(T):
    """Landed feature pages: one page per block group."""
    ring = F.array(*[F.array(F.col(x), F.col(y)) for x, y in (("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1"), ("x0", "y0"))])
    feature = F.struct(
        F.struct(F.col("block_id").alias("GEOID"), F.substring("block_id", 1, 2).alias("STATE"),
                 F.substring("block_id", 3, 3).alias("COUNTY"), F.substring("block_id", 6, 6).alias("TRACT"),
                 F.substring("block_id", 12, 1).alias("BLKGRP")).alias("attributes"),
        F.struct(F.array(ring).alias("rings")).alias("geometry"),
    )
    return T.block_box.groupBy(F.substring("block_id", 1, 12).alias("page")).agg(F.collect_list(feature).alias("features"))


add("g05_block_features", lambda T: geo.block_features(
    feature_pages(T), T.household.select(F.col("block_id").alias("GEOID"))).select(
        "GEOID", "STATE", "COUNTY", "TRACT", "BLKGRP", F.size("geometry").alias("rings"),
        F.col("geometry")[0]["points"][2]["x"].alias("x")), """
    select block_id as GEOID, '48' as STATE, '453' as COUNTY, substr(block_id, 6, 6) as TRACT, '1' as BLKGRP, 1 as rings,
        round(x1, 6) as x from fx_block_box where block_id in (select block_id from fx_household)""")
add("g06_zone_table", lambda T: geo.zone_table(T.zone_raw, "zone_id").select(
    "TAZ", "idx", F.size(F.col("geometry")[0]["points"]).alias("points"), F.col("geometry")[0]["points"][2]["y"].alias("y")), """
    select zone_id as TAZ, idx, 5 as points, round(y1, 6) as y from fx_taz""")
