"""Skim queries."""

from pyspark.sql import functions as F

from commuta.operators import skims as sk
from workload.landuse import MILES, mercator
from workload.registry import add, six_decimals

MEASURES = ["TIME_minutes", "TOTIVT_IVT_minutes", "VTOLL_FAR", "DIST_meters", "DDIST_meters", "WACC_minutes", "WAUX_minutes",
            "WEGR_minutes", "DTIM_minutes", "KEYIVT_minutes", "FERRYIVT_minutes", "BOARDS"]
TRANSIT_RAW = ["WLK_LOC_WLK", "WLK_COM_WLK", "DRV_LOC_WLK"]
PERIODS = "unnest(['EA', 'AM', 'MD', 'PM', 'EV'])"
FACTOR = repr(0.621371 / 1000)
CLEAN = f"""clean as (select timePeriod, pathType, origin, destination, ordinal,
    {", ".join(f"nullif({m}, 0) as {m}" for m in MEASURES)},
    nullif(DIST_meters * {FACTOR}, 0) as DIST_miles, nullif(DDIST_meters * {FACTOR}, 0) as DDIST_miles from fx_skim_raw)"""


def clean(T):
    return sk.skim_clean(T.skim_raw)


def taz(T):
    return T.taz.select("zone_id", "idx", "cx", "cy")


def highway(T):
    return clean(T).filter(F.col("pathType") == "SOV")


def distance(T):
    return sk.pack_distance(highway(T), taz(T))


def packed_transit(T, **kw):
    return sk.pack_transit(clean(T).filter(F.col("pathType").isin(TRANSIT_RAW)), taz(T), **kw)


def transit(T, **kw):
    return sk.unpack_od(packed_transit(T, **kw), taz(T))


RAW_COLUMNS = ["timePeriod", "pathType", "origin", "destination", *MEASURES]


def rows_of(T):
    return T.skim_raw.select(*RAW_COLUMNS)


add("k01_zone_index_block_group", lambda T: sk.zone_index(T.block, "block_group"), """
    select g as GEOID, cast(row_number() over (order by g) as varchar) as zone_id
    from (select distinct substr(block_id, 1, 12) as g from fx_block)""")
add("k01_zone_index_block", lambda T: sk.zone_index(T.block, "block"), """
    select block_id as GEOID, cast(row_number() over (order by block_id) as varchar) as zone_id from fx_block""")
add("k02_zone_order", lambda T: sk.zone_order(T.taz), "select zone_id, cast(zone_id as bigint) as idx from fx_taz")
add("k02_geoid_order", lambda T: sk.geoid_order(sk.zone_index(T.block, "block_group")), """
    select g as zone_id, row_number() over (order by g) as idx from (select distinct substr(block_id, 1, 12) as g from fx_block)""")
add("k02_zone_order_check", lambda T: sk.zone_order_check(sk.zone_order(T.taz)), """
    select 1::bigint as "first", count(*) as "last", count(*) as zones, 1 as contiguous from fx_taz""")
add("k03_skim_clean", clean, f"""with {CLEAN} select * replace (round(DIST_miles, 6) as DIST_miles,
    round(DDIST_miles, 6) as DDIST_miles) from clean""")


add("k04_zone_coverage", lambda T: sk.zone_coverage(
    T.skim_raw, T.block.select((F.col("zone") * 4 + 3).cast("string").alias("zone_id")).distinct()), """
    with z as (select distinct cast(zone * 4 + 3 as varchar) as zone_id from fx_block)
    select 'origin' as side, origin as zone_id, 'unknown zone' as problem from (select distinct origin from fx_skim_raw)
        where origin not in (from z)
    union all select 'destination', destination, 'unknown zone' from (select distinct destination from fx_skim_raw)
        where destination not in (from z)
    union all select 'origin', zone_id, 'no rows' from z where zone_id not in (select origin from fx_skim_raw)
    union all select 'destination', zone_id, 'no rows' from z where zone_id not in (select destination from fx_skim_raw)""")
GRID = "grid as (select o.zone_id as origin, d.zone_id as destination, o.cx, o.cy, d.cx as dx, d.cy as dy from fx_taz o, fx_taz d)"
add("k05_od_complete", lambda T: sk.od_complete(
    highway(T), taz(T), {"timePeriod": sk.PERIODS}, ["TIME_minutes", "DIST_miles"]), f"""
    with {CLEAN}, {GRID}, p as (select {PERIODS} as timePeriod)
    select p.timePeriod, g.origin, g.destination, coalesce(TIME_minutes, 0)::double as TIME_minutes,
        round(coalesce(DIST_miles, 0), 6)::double as DIST_miles
    from p cross join grid g left join (select * from clean where pathType = 'SOV') c
    on c.timePeriod = p.timePeriod and c.origin = g.origin and c.destination = g.destination""")
LAST = """last as (select origin, destination, DIST_miles from (select *, row_number() over (
    partition by origin, destination order by ordinal desc) as rn from clean where pathType = 'SOV') where rn = 1)"""
DISTANCE = f"""dist as (select g.origin, g.destination, coalesce(l.DIST_miles, {MILES.replace("0.621371 / 1000", FACTOR)}) as DIST
    from (select *, {mercator(("cx", "cy"), ("dx", "dy"))} as m from grid) g
    left join last l on l.origin = g.origin and l.destination = g.destination)"""
add("k06_distance_skim", lambda T: sk.distance_skim(highway(T), taz(T)), f"""with {CLEAN}, {GRID}, {LAST}, {DISTANCE}
    select origin, destination, round(DIST, 6) as DIST, round(DIST, 6) as DISTBIKE, round(DIST, 6) as DISTWALK from dist""")


def packed_auto(T, **kw):
    return sk.pack_auto(highway(T), distance(T), taz(T), **kw)


def auto(T, **kw):
    return sk.unpack_od(packed_auto(T, **kw), taz(T))


AUTO = f"""auto as (select p.timePeriod, g.origin, g.destination, coalesce(TIME_minutes, g.DIST * 1.5) as TIME,
    coalesce(DIST_miles, g.DIST) as DIST, coalesce(VTOLL_FAR, 0)::double as VTOLL, g.DIST as far
    from (select {PERIODS} as timePeriod) p cross join dist g left join (select * from clean where pathType = 'SOV') c
    on c.timePeriod = p.timePeriod and c.origin = g.origin and c.destination = g.destination)"""
WITH_AUTO = f"with {CLEAN}, {GRID}, {LAST}, {DISTANCE}, {AUTO}"
HIGHWAY_PATHS = "unnest(['SOV', 'SOVTOLL', 'HOV2', 'HOV2TOLL', 'HOV3', 'HOV3TOLL'])"
add("k07_auto_skims", auto, f"""{WITH_AUTO}
    select timePeriod, pathType, origin, destination, round(TIME, 6) as TIME, round(DIST, 6) as DIST, 0::double as BTOLL, VTOLL
    from auto cross join (select {HIGHWAY_PATHS} as pathType)""")
add("k07_auto_skims_by_path", lambda T: auto(T, by_path=True), f"""{WITH_AUTO}
    select timePeriod, 'SOV' as pathType, origin, destination, round(TIME, 6) as TIME, round(DIST, 6) as DIST, 0::double as BTOLL, VTOLL from auto
    union all
    select timePeriod, pathType, origin, destination, round(DIST * 1.5, 6), round(DIST, 6), 0::double, 0::double
    from dist cross join (select {PERIODS} as timePeriod)
    cross join (select unnest(['SOVTOLL', 'HOV2', 'HOV2TOLL', 'HOV3', 'HOV3TOLL']) as pathType)""")
TRANSIT_SUMS = {"WAIT": None, "TOTIVT": "TOTIVT_IVT_minutes * 100", "KEYIVT": "KEYIVT_minutes * 100",
                "FERRYIVT": "FERRYIVT_minutes * 100", "FAR": "VTOLL_FAR", "DTIM": "DTIM_minutes * 100", "DDIST": "DDIST_miles * 100",
                "WAUX": "WAUX_minutes * 100", "WEGR": "WEGR_minutes * 100", "WACC": "WACC_minutes * 100", "IWAIT": None,
                "XWAIT": None, "BOARDS": "BOARDS", "IVT": "TOTIVT_IVT_minutes * 100"}
TRANSIT_PATHS = f"unnest([{', '.join(repr(p) for p in sk.TRANSIT_PATHS)}])"
TRANSIT_CELLS = f"""select p.timePeriod, q.pathType, g.origin, g.destination, {", ".join(
    "0::double as " + m if e is None else f"coalesce({e}, 0)::double as {m}" for m, e in TRANSIT_SUMS.items())}
    from (select {{periods}} as timePeriod) p cross join (select {{paths}} as pathType) q cross join grid g
    left join (select * from clean where pathType in ('WLK_LOC_WLK', 'WLK_COM_WLK', 'DRV_LOC_WLK')) c
    on c.timePeriod = p.timePeriod and c.origin = g.origin and c.destination = g.destination
    and c.pathType = replace(replace(q.pathType, 'EXP', 'LOC'), 'TRN', 'LOC')"""
add("k08_transit_skims", lambda T: transit(T).groupBy("timePeriod", "pathType", "origin").agg(
    F.count("*").alias("cells"), *[F.sum(m).alias(m) for m in sk.TRANSIT_MEASURES],
    *[F.sum(F.col(m) * F.col("destination").cast("int")).alias(f"{m}_placed") for m in sk.TRANSIT_MEASURES]), f"""
    with {CLEAN}, s as (select p.timePeriod, q.pathType, o.zone_id as origin, c.* exclude (timePeriod, pathType, origin)
        from (select {PERIODS} as timePeriod) p cross join (select {TRANSIT_PATHS} as pathType) q cross join fx_taz o
        left join (select * from clean where pathType in ('WLK_LOC_WLK', 'WLK_COM_WLK', 'DRV_LOC_WLK')) c
        on c.timePeriod = p.timePeriod and c.origin = o.zone_id
        and c.pathType = replace(replace(q.pathType, 'EXP', 'LOC'), 'TRN', 'LOC'))
    select timePeriod, pathType, origin, (select count(*) from fx_taz) as cells,
        {", ".join("0::double as " + m if e is None else f"round(coalesce(sum({e}), 0), 6)::double as {m}" for m, e in TRANSIT_SUMS.items())},
        {", ".join("0::double as " + m + "_placed" if e is None else f"round(coalesce(sum({e} * cast(destination as int)), 0), 6)::double as {m}_placed" for m, e in TRANSIT_SUMS.items())}
    from s group by timePeriod, pathType, origin""")
# Given values alone are rounded, before cells are completed: a result of 80 N x N rows has no other values but 0.
add("k08_transit_skims_cells", lambda T: transit(T, finish=six_decimals), f"""
    with {CLEAN}, {GRID}, s as ({TRANSIT_CELLS.format(periods=PERIODS, paths=TRANSIT_PATHS)})
    select timePeriod, pathType, origin, destination, {", ".join(f"round({m}, 6) as {m}" for m in TRANSIT_SUMS)} from s""", finished=True)
add("k09_matrix_export", lambda T: sk.distance_matrices(distance(T), sk.STRETCH).select(
    "name", "o_idx", "first", F.posexplode("values").alias("pos", "value")).select("name", "o_idx", (F.col("first") + F.col("pos") + 1).alias("pos"), "value"), f"""
    with {CLEAN}, {GRID}, {LAST}, {DISTANCE}
    select name, o.idx as o_idx, cast(t.idx as int) as pos, round(d.DIST, 6) as value
    from dist d join fx_taz o on d.origin = o.zone_id join fx_taz t on d.destination = t.zone_id
    cross join (select unnest(['DIST', 'DISTBIKE', 'DISTWALK']) as name)""")
add("k09_matrix_export_auto", lambda T: sk.matrix_export(packed_auto(T)).select(
    "name", "o_idx", F.posexplode("values").alias("pos", "value")).withColumn("pos", F.col("pos") + 1), f"""{WITH_AUTO},
    m as (select timePeriod, origin, destination, unnest(['TIME', 'DIST', 'BTOLL', 'VTOLL']) as measure, unnest([TIME, DIST, 0, VTOLL]) as v
        from auto)
    select pathType || '_' || measure || '__' || timePeriod as name, o.idx as o_idx, cast(t.idx as int) as pos, round(v, 6)::double as value
    from m join fx_taz o on m.origin = o.zone_id join fx_taz t on m.destination = t.zone_id
    cross join (select {HIGHWAY_PATHS} as pathType)""")


def sparse(T):
    """Some pairs of the raw skims only: whole origins and single destinations are absent."""
    kept = T.skim_raw.filter((F.col("pathType") == "SOV") & (F.expr("ordinal % 3") != 0) & F.col("timePeriod").isin("AM", "EV"))
    return kept.select("timePeriod", "pathType", "origin", "destination", "TIME_minutes")


add("k09_matrix_export_sparse", lambda T: sk.matrix_export(sk.pack_wide(sparse(T), taz(T))).select(
    "name", "o_idx", F.posexplode("values").alias("pos", "value")).withColumn("pos", F.col("pos") + 1), f"""
    with {GRID}, s as (select * from fx_skim_raw where pathType = 'SOV' and ordinal % 3 <> 0 and timePeriod in ('AM', 'EV'))
    select 'SOV_TIME_minutes__' || p as name, o.idx as o_idx, cast(d.idx as int) as pos, round(s.TIME_minutes, 6) as value
    from (select unnest(['AM', 'EV']) as p) cross join grid g join fx_taz o on g.origin = o.zone_id join fx_taz d on g.destination = d.zone_id
    left join s on s.timePeriod = p and s.origin = g.origin and s.destination = g.destination""")


def split(T):
    parts = sk.split_by_mode(rows_of(T), sk.HIGHWAY_PATHS, sk.TRANSIT_PATHS)
    return parts[0].withColumn("part", F.lit("highway")).unionByName(parts[1].withColumn("part", F.lit("transit")))


add("k10_split_by_mode", split, f"""
    select {", ".join(RAW_COLUMNS)}, case pathType when 'SOV' then 'highway' else 'transit' end as part from fx_skim_raw""")
add("k10_absent_modes", lambda T: sk.absent_modes(rows_of(T), ["HOV3TOLL"], sk.TRANSIT_PATHS), """
    select 'highway' as mode from (select count(*) as n from fx_skim_raw where pathType = 'HOV3TOLL') where n = 0""")
add("k11_skim_upsert", lambda T: sk.skim_upsert(rows_of(T), T.skim_new.select(*RAW_COLUMNS)), f"""
    select {", ".join(RAW_COLUMNS)} from fx_skim_new union all
    select {", ".join(RAW_COLUMNS)} from fx_skim_raw r where not exists
        (select 1 from fx_skim_new n where n.timePeriod = r.timePeriod and n.pathType = r.pathType
         and n.origin = r.origin and n.destination = r.destination)""")


def given_total(T):
    raw = clean(T).filter(F.col("pathType").isin(TRANSIT_RAW))
    return sk.transit_total_time(sk.given_transit(raw, taz(T), periods=["AM"], paths=["WLK_LOC_WLK"]))


def transit_total(T, **kw):
    return sk.transit_total_time(transit(T, periods=["AM"], paths=["WLK_LOC_WLK"], **kw))


def profile(T):
    """Only the rows of the sampled origins are completed."""
    given = given_total(T)
    return sk.skim_profile(transit_total(T, origins=sk.profile_origins(given, 6, 7)), 6, 7, given)


TOTAL = f"""{GRID}, {CLEAN}, total as (select g.origin, g.destination,
    coalesce(TOTIVT_IVT_minutes, 0) + coalesce(WAUX_minutes, 0) + coalesce(WEGR_minutes, 0) + coalesce(WACC_minutes, 0) as value
    from grid g left join (select * from clean where pathType = 'WLK_LOC_WLK' and timePeriod = 'AM') c
    on c.origin = g.origin and c.destination = g.destination)"""
add("k12_transit_total_time", transit_total, f"with {TOTAL} select origin, destination, round(value, 6)::double as value from total")
add("k12_skim_profile", profile, f"""
    with {TOTAL}, pick as (select origin from total group by origin having sum(value) <> 0
        order by ('0x' || substr(md5(origin || ':7'), 1, 13))::bigint, origin limit 6)
    select origin, destination, case when value not in (0, 999) then round(value, 6) end::double as value
    from total where origin in (from pick)""")
add("k13_cost_per_mile", lambda T: sk.cost_per_mile(T.interval_skim), """
    select o as taz, round(sum(cost) / nullif(sum(distance), 0), 6) as auto_costpermile,
        round(case when coalesce(sum(distance) filter (where s), 0) = 0 then 99999
              else sum(fare) filter (where s) / sum(distance) filter (where s) end, 6)::double as tran_costpermile
    from (select *, ivtt > 0 and ivtt < 86400 and o <> d as s from fx_interval_skim where interval_end = 720) group by o""")


def modal_skims(T):
    """Interval skims keyed by mode: drive, and bus with intervals of its own and other values."""
    drive = T.interval_skim.withColumn("mode", F.lit("AUTO"))
    bus = T.interval_skim.filter("interval_end in (540, 1440)").withColumns({
        "mode": F.lit("BUS"), "interval_end": F.when(F.col("interval_end") == 540, 600).otherwise(F.col("interval_end")),
        "time": F.col("time") * 2 + 1, "fare": F.col("fare") + 1})
    return drive.unionByName(bus)


MODAL = """modal as (select *, 'AUTO' as mode from fx_interval_skim union all
    select case interval_end when 540 then 600 else interval_end end as interval_end, o, d, time * 2 + 1 as time, distance, cost,
        fare + 1 as fare, ivtt, 'BUS' as mode from fx_interval_skim where interval_end in (540, 1440))"""
add("k13_cost_per_mile_modes", lambda T: sk.cost_per_mile(modal_skims(T), auto_mode="AUTO", transit_mode="BUS"), f"""
    with {MODAL}, a as (select o, sum(cost) / nullif(sum(distance), 0) as c from modal where mode = 'AUTO' and interval_end = 720 group by o),
    b as (select o, case when coalesce(sum(distance) filter (where s), 0) = 0 then 99999
              else sum(fare) filter (where s) / sum(distance) filter (where s) end as c
        from (select *, ivtt > 0 and ivtt < 86400 and o <> d as s from modal where mode = 'BUS' and interval_end = 600) group by o)
    select a.o as taz, round(a.c, 6) as auto_costpermile, round(coalesce(b.c, 99999), 6)::double as tran_costpermile from a left join b on a.o = b.o""")
add("k14_landuse_travel_data", lambda T: sk.landuse_travel_data(T.skim_raw), """
    select origin as from_zone_id, destination as to_zone_id, TOTIVT_IVT_minutes as SOV_AM_IVT_mins, DIST_meters
    from fx_skim_raw where pathType = 'SOV' and timePeriod = 'AM'""")
add("k14_landuse_travel_data_mapped", lambda T: sk.landuse_travel_data(
    T.skim_raw, T.block.select(F.col("zone").cast("string").alias("GEOID"), F.concat(F.lit("Z"), "zone").alias("zone_id")).distinct()), """
    with z as (select distinct cast(zone as varchar) as g, concat('Z', zone) as zone_id from fx_block)
    select a.zone_id as from_zone_id, b.zone_id as to_zone_id, TOTIVT_IVT_minutes as SOV_AM_IVT_mins, DIST_meters
    from fx_skim_raw s left join z a on s.origin = a.g left join z b on s.destination = b.g
    where pathType = 'SOV' and timePeriod = 'AM'""")


def matrix_rows(T):
    """Interval skims of the 720 interval as matrix rows, absent cells NaN."""
    nan = F.lit(float("nan"))
    at = T.interval_skim.filter(F.col("interval_end") == 720)
    rows = sk.matrix_export(sk.pack_od(
        at.select(F.col("o").cast("string").alias("origin"), F.col("d").cast("string").alias("destination"), "time", "cost"),
        taz(T), {}, ["time", "cost"]), side_by_side=True)
    wide = rows.select((F.col("o_idx") - 1).alias("row"), "time", "cost")
    return wide.withColumn("time", F.transform("time", lambda v: F.coalesce(v, nan)))


add("k14_matrix_rows_to_od", lambda T: sk.matrix_rows_to_od(
    matrix_rows(T), {"auto_ivtt_8_9_am": "time", "auto_cost_8_9_am": "cost"}), """
    select cast(o - 1 as varchar) as from_zone_id, cast(d - 1 as varchar) as to_zone_id, time as auto_ivtt_8_9_am,
        cost as auto_cost_8_9_am from fx_interval_skim where interval_end = 720""")
LOOKUP = ["time", "distance", "fare"]


def zone_list(T):
    return T.taz.select(F.col("idx").alias("zone"))


add("k15_od_time_lookup", lambda T: sk.od_time_lookup(T.demand_trip, T.interval_skim, zone_list(T), LOOKUP), """
    select t.id, t.o, t.d, round(t.minute, 6) as minute, s.time, s.distance, s.fare
    from fx_demand_trip t join fx_taz a on t.o = a.idx join fx_taz b on t.d = b.idx
    left join fx_interval_skim s on s.o = t.o and s.d = t.d and s.interval_end =
        case when minute < 360 then 360 when minute < 540 then 540 when minute < 720 then 720 else 1440 end""")
for mode, when in (("AUTO", "when minute < 360 then 360 when minute < 540 then 540 when minute < 720 then 720 else 1440"),
                   ("BUS", "when minute < 600 then 600 else 1440")):
    add(f"k15_od_time_lookup_{mode.lower()}", lambda T, mode=mode: sk.od_time_lookup(
        T.demand_trip, modal_skims(T), zone_list(T), LOOKUP, mode=mode), f"""
        with {MODAL}
        select t.id, t.o, t.d, round(t.minute, 6) as minute, s.time, s.distance, s.fare
        from fx_demand_trip t join fx_taz a on t.o = a.idx join fx_taz b on t.d = b.idx
        left join (select * from modal where mode = '{mode}') s on s.o = t.o and s.d = t.d and s.interval_end = case {when} end""")
add("k15_od_lookup_rejects", lambda T: sk.od_lookup_rejects(T.demand_trip, zone_list(T)), """
    select o as zone, 'o' as side, count(*) as trips from fx_demand_trip where o not in (select idx from fx_taz) group by 1
    union all select d, 'd', count(*) from fx_demand_trip where d not in (select idx from fx_taz) group by 1""")


def value_lists(T):
    """Value lists from the interval skims: early and late intervals as separate lists."""
    def part(measure, interval):
        return T.interval_skim.filter(F.col("interval_end") == interval).select(
            (F.col("o") + 1).alias("o"), "d", F.col(measure).alias("value"), (F.col("o") * 100000 + F.col("d")).alias("ordinal"))

    return {"walk": [part("ivtt", 360), part("ivtt", 540)], "ttime": [part("time", 360), part("time", 1440)], "fare": [part("fare", 540)]}


add("k16_od_accumulate", lambda T: sk.od_accumulate(
    value_lists(T), {"walk": "sum", "ttime": "last", "fare": "last"}, taz(T)), f"""
    with {GRID}, s as (select cast(o + 1 as varchar) as o, cast(d as varchar) as d, interval_end as i, time, fare, ivtt from fx_interval_skim)
    select g.origin, g.destination, coalesce(sum(ivtt) filter (where i in (360, 540)), 0)::double as walk,
        coalesce(max(time) filter (where i = 1440), max(time) filter (where i = 360), 0)::double as ttime,
        coalesce(max(fare) filter (where i = 540), 0)::double as fare
    from grid g left join s on s.o = g.origin and s.d = g.destination group by 1, 2""")
add("k16_od_ignored_zones", lambda T: sk.od_ignored_zones([p for ps in value_lists(T).values() for p in ps], taz(T)), """
    select distinct cast(o + 1 as varchar) as zone_id from fx_interval_skim where o + 1 not in (select idx from fx_taz)""")
add("k17_skim_subset_pivot", lambda T: sk.skim_subset_pivot(
    T.interval_skim, T.block.select("zone").distinct(), T.location.select("zone").distinct(),
    [360, 540, 720, 1440], ["time", "fare"]), """
    select o as O, d as D,
        max(time) filter (where interval_end = 360) as time_360, max(time) filter (where interval_end = 540) as time_540,
        max(time) filter (where interval_end = 720) as time_720, max(time) filter (where interval_end = 1440) as time_1440,
        max(fare) filter (where interval_end = 360) as fare_360, max(fare) filter (where interval_end = 540) as fare_540,
        max(fare) filter (where interval_end = 720) as fare_720, max(fare) filter (where interval_end = 1440) as fare_1440
    from fx_interval_skim where o in (select zone from fx_block) and d in (select zone from fx_location) group by o, d""")
add("k17_skim_blocks", lambda T: sk.skim_blocks(
    modal_skims(T), T.block.select("zone").distinct(), T.location.select("zone").distinct(), ["time", "fare"],
    intervals=[360, 600], modes=["AUTO", "BUS"]), f"""
    with {MODAL}
    select mode, interval_end, o as O, d as D, time, fare from modal
    where interval_end in (360, 600) and mode in ('AUTO', 'BUS') and o in (select zone from fx_block) and d in (select zone from fx_location)""")
add("k17_skim_subset_pivot_bus", lambda T: sk.skim_subset_pivot(
    modal_skims(T), T.block.select("zone").distinct(), T.location.select("zone").distinct(), [600, 1440], ["time"], mode="BUS"), f"""
    with {MODAL}
    select o as O, d as D, max(time) filter (where interval_end = 600) as time_600, max(time) filter (where interval_end = 1440) as time_1440
    from modal where mode = 'BUS' and o in (select zone from fx_block) and d in (select zone from fx_location) group by o, d""")
add("k17_zone_subset", lambda T: sk.zone_subset(
    T.location.select("zone", "location").groupBy("zone").agg((-F.max("location")).alias("position")), zone_list(T)), """
    select zone, row_number() over (order by position) - 1 as idx
    from (select zone, -max(location) as position from fx_location group by zone) where zone in (select idx from fx_taz)""")
