"""Input tables for the workload, derived in SQL from the supplied test tables.

The text is portable: Spark and the checking SQL engine read the same definitions. Values are
integer arithmetic on keys; NULL, zero, out-of-range and unmatched cases are deliberate.
Trip ids start at 1 because an activity on trip 0 is a planned one.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

VIEWS: dict[str, str] = {}

VIEWS["fx_zone"] = """
select n_nationkey + 1 as zone, n_nationkey % 6 + 1 as area_type, (n_nationkey * 37) % 500 as employment_total,
       cast(n_nationkey % 5 as double) / 10 - 98 as x0, floor(n_nationkey / 5) / 10 + 30 as y0
from nation
"""

VIEWS["fx_location"] = """
select c_custkey + 1 as location, c_nationkey + 1 as zone, c_nationkey % 6 + 1 as area_type from customer
"""

VIEWS["fx_block"] = """
select concat('48453', lpad(cast(cast(floor(p_partkey / 20) as bigint) as varchar(20)), 6, '0'), '1',
              lpad(cast(p_partkey % 20 as varchar(20)), 3, '0')) as block_id,
       p_partkey as block_no, p_partkey % 25 + 1 as zone,
       cast(p_partkey % 50 as double) / 100 - 98 as x, cast((p_partkey * 3) % 50 as double) / 100 + 30 as y,
       cast(case when p_partkey % 50 = 0 then 0 else p_size * 1000 end as double) as square_meters_land
from part
"""

VIEWS["fx_household"] = """
select h.*, b.block_id, b.zone
from (select c_custkey as household, c_custkey + 1 as location, c_custkey % 5 + 1 as persons,
             c_custkey % 3 as workers, c_custkey % 4 as cars, c_custkey % 8 + 1 as hh_type,
             case when c_custkey % 2 = 0 then 'yes' else 'no' end as sf_detached,
             cast((c_custkey * 7919) % 150000 as double) as income,
             case when c_custkey % 17 = 0 then -1 else c_custkey % (select count(*) from part) end as block_no
      from customer) h
left join fx_block b on h.block_no = b.block_no
"""

VIEWS["fx_person"] = """
select c_custkey * 4 + m as person, c_custkey as household, m + 1 as member_id, m as relate,
       (c_custkey * 7 + m * 23) % 95 as age, (c_custkey + m) % 2 as worker,
       case when (c_custkey + m) % 13 = 0 then null else cast(floor((c_custkey + m) / 2) as bigint) % 2 end as student,
       (c_custkey + m) % 5 as employment, (c_custkey * 3 + m) % 4 as school_enrollment,
       (c_custkey * 11 + m) % 60 as work_hours, (c_custkey + m) % 9 + 1 as race_id,
       case when (c_custkey + m) % 6 = 0 then null else (c_custkey * 31 + m) % (select count(*) from customer) + 1 end as work_location_id,
       case when (c_custkey + m) % 5 = 0 then 0 else (c_custkey * 17) % (select count(*) from customer) + 1 end as school_location_id
from customer {members}
"""

VIEWS["fx_job"] = """
select b.block_id, b.zone,
       case l_suppkey % 10 when 0 then '44-45' when 1 then '52' when 2 then '54' when 3 then '61' when 4 then '62'
            when 5 then '71' when 6 then '11' when 7 then '31-33' when 8 then '81' end as sector_id
from lineitem join fx_block b on l_partkey = b.block_no
"""

VIEWS["fx_trip"] = """
select o_orderkey + 1 as trip_id,
       case when o_orderkey % 9 = 0 then null else o_custkey * 4 + o_orderkey % 4 end as person,
       case when o_orderkey % 3 = 0 then 0 when o_orderkey % 5 = 0 then 9 else (o_orderkey * 7) % 29 end as mode,
       case when o_orderkey % 4 <> 1 then 0 else cast(floor(o_orderkey / 4) as bigint) % 5 end as has_artificial_trip,
       o_custkey + 1 as origin, (o_custkey * 31 + o_orderkey % 6) % (select count(*) from customer) + 1 as destination,
       cast((o_orderkey * 97) % 86400 as double) as start_s,
       cast((o_orderkey * 97) % 86400 + (o_orderkey * 13) % 3600 as double) as end_s,
       case when o_orderkey % 23 = 0 then null else cast((o_orderkey * 11) % 3300 as double) end as routed_travel_time,
       cast((o_orderkey * 19) % 90000 - 5 as double) as skim_travel_time,
       cast((o_orderkey * 17) % 50000 as double) as travel_distance,
       cast((o_orderkey * 13) % 200 as double) / 100 as experienced_gap,
       case when o_orderkey % 7 = 0 then null else o_orderkey end as path,
       case when o_orderkey % 2 = 0 then o_orderkey end as path_multimodal,
       cast(floor(o_orderkey / 7) as bigint) as vehicle, case when o_orderkey % 10 = 0 then 22 else 11 end as type
from orders
"""

VIEWS["fx_activity"] = """
select u.c as person, case when event_type = 'error' then 0 else event_id + 1 end as trip,
       event_id % (select count(*) from customer) + 1 as location_id, cast((event_id * 101) % 86400 as double) as start_time,
       case event_id % 17 when 0 then 'EAT OUT' when 1 then 'ERRANDS' when 2 then 'HEALTHCARE' when 3 then 'HOME'
            when 4 then 'LEISURE' when 5 then 'PERSONAL' when 6 then 'PICKUP-DROPOFF' when 7 then 'RELIGIOUS-CIVIC'
            when 8 then 'SCHOOL' when 9 then 'SERVICE' when 10 then 'SHOP-MAJOR' when 11 then 'SOCIAL'
            when 12 then 'WORK' when 13 then 'WORK AT HOME' when 14 then 'PART_WORK' when 15 then 'SHOP-OTHER'
            else 'OTHER' end as type,
       case event_id % 6 when 0 then 'SOV' when 1 then 'HOV' when 2 then 'BUS' when 3 then 'WALK'
            when 4 then 'NO_MOVE' else 'fail_route' end as mode
from (select events.*, (event_id * 3) % (4 * (select count(*) from customer)) as c from events) u
"""

VIEWS["fx_tnc_trip"] = """
select user_id as vehicle, event_id % (select count(*) from customer) + 1 as origin, (event_id * 7) % (select count(*) from customer) + 1 as destination,
       event_id % 4 as passengers, -(event_id % 3) - 1 as final_status,
       cast((event_id * 89) % 86400 as double) as start_s,
       cast((event_id * 89) % 86400 + (event_id * 5) % 1800 as double) as end_s,
       cast((event_id * 89) % 86400 - (event_id * 3) % 600 as double) as request_time,
       case when event_id % 11 = 0 then cast(0 as double) else cast((event_id * 29) % 30000 as double) end as travel_distance
from events
"""

VIEWS["fx_vehicle"] = """
select p_partkey as vehicle_id, p_partkey % 27 as type from part
"""

VIEWS["fx_vehicle_type"] = """
select n_nationkey as type_id, n_nationkey % 3 as automation_type from nation
"""

VIEWS["fx_zone_wait_times"] = """
select c_nationkey + 1 as zone, cast(c_custkey % 12 as double) as avg_wait_minutes from customer
"""

VIEWS["fx_transit_agencies"] = """
select r_regionkey as agency_id, r_name as agency from region
"""

VIEWS["fx_transit_routes"] = """
select n_nationkey + 1 as route_id, n_regionkey as agency_id from nation
"""

VIEWS["fx_transit_patterns"] = """
select n_nationkey + 1 as pattern_id, n_nationkey + 1 as route_id from nation
"""

VIEWS["fx_transit_trips"] = """
select s_suppkey + 50 as trip_id, s_nationkey + 1 as pattern_id from supplier
"""

VIEWS["fx_transit_vehicle"] = """
select s_suppkey + 50 as transit_vehicle_trip, s_suppkey % 2 + 4 as mode from supplier
"""

VIEWS["fx_transit_stops"] = """
select s_suppkey as stop_id, s_nationkey + 1 as zone from supplier
"""

VIEWS["fx_transit_links"] = """
select p_partkey as transit_link, p_partkey % (select count(*) from supplier) as from_node from part
"""

VIEWS["fx_transit_vehicle_links"] = """
select l_suppkey + 50 as value_transit_vehicle_trip, l_partkey as value_link,
       l_linenumber as value_boardings, l_linenumber % 3 as value_alightings,
       (l_orderkey * 61) % 86400 as value_act_departure_time, l_linenumber * 2 as value_seated_load,
       l_linenumber % 4 as value_standing_load, cast(l_partkey % 900 as double) as value_length
from lineitem
"""

VIEWS["fx_path_multimodal"] = """
select o_orderkey as id, o_orderkey % 10 as mode, o_orderkey % 3 as act_wait_count, o_orderkey % 3 as est_wait_count,
       o_orderkey % 2 as number_of_switches, o_orderkey % 4 as est_transfer_pen,
       cast((o_orderkey * 3) % 600 as double) as act_bus_wait_time, cast((o_orderkey * 5) % 300 as double) as act_rail_wait_time,
       cast(0 as double) as act_comm_rail_wait_time, cast((o_orderkey % 4) * 300 as double) as act_bus_ivtt,
       cast((o_orderkey % 2) * 200 as double) as act_rail_ivtt, cast(0 as double) as act_comm_rail_ivtt,
       cast(o_orderkey % 90 as double) as act_bike_time, cast(o_orderkey % 120 as double) as act_walk_time,
       cast(0 as double) as act_car_time, cast((o_orderkey * 7) % 5000 as double) as act_duration,
       cast((o_orderkey * 3) % 610 as double) as est_bus_wait_time, cast((o_orderkey * 5) % 310 as double) as est_rail_wait_time,
       cast((o_orderkey % 4) * 310 as double) as est_bus_ivtt, cast((o_orderkey % 2) * 210 as double) as est_rail_ivtt,
       cast(o_orderkey % 91 as double) as est_bike_time, cast(o_orderkey % 121 as double) as est_walk_time,
       cast(0 as double) as est_car_time, cast((o_orderkey * 7) % 5100 as double) as est_duration,
       cast((o_orderkey * 41) % 20000 as double) as est_gen_cost
from orders
"""

VIEWS["fx_path_multimodal_links"] = """
select l_orderkey as object_id, l_suppkey + 50 as value_transit_vehicle_trip, l_linenumber % 3 + 4 as value_link_type,
       cast(l_partkey % 5 - 1 as double) * 60 as value_est_bus_wait_time,
       cast(l_partkey % 3 as double) * 30 as value_est_rail_wait_time, cast(0 as double) as value_est_comm_rail_wait_time,
       cast(l_partkey % 7 - 1 as double) * 100 as value_est_bus_ivtt, cast(l_partkey % 2 as double) * 50 as value_est_rail_ivtt
from lineitem
"""

# Zones, skims and lookup tables below grow with the supplier table.

VIEWS["fx_taz"] = """
select cast(s_suppkey + 1 as varchar(20)) as zone_id, s_suppkey + 1 as idx,
       cast(s_suppkey % 10 * 5 as double) / 100 - 98 as x0, cast(s_suppkey % 10 * 5 + 5 as double) / 100 - 98 as x1,
       floor(s_suppkey / 10) * 5 / 100 + 30 as y0, (floor(s_suppkey / 10) * 5 + 5) / 100 + 30 as y1,
       cast(s_suppkey % 10 * 10 + 5 as double) / 200 - 98 as cx, (floor(s_suppkey / 10) * 10 + 5) / 200 + 30 as cy
from supplier
"""

VIEWS["fx_skim_cell"] = """
select l_orderkey % 5 as p, l_partkey % 4 as m, l_suppkey as o,
       l_partkey % (select count(*) from supplier) as d, min(l_orderkey) as k
from lineitem
group by l_orderkey % 5, l_partkey % 4, l_suppkey, l_partkey % (select count(*) from supplier)
"""

VIEWS["fx_skim_raw"] = """
select case p when 0 then 'EA' when 1 then 'AM' when 2 then 'MD' when 3 then 'PM' else 'EV' end as timePeriod,
       case m when 0 then 'SOV' when 1 then 'WLK_LOC_WLK' when 2 then 'WLK_COM_WLK' else 'DRV_LOC_WLK' end as pathType,
       cast(o + 1 as varchar(20)) as origin, cast(d + 1 as varchar(20)) as destination,
       k * 20 + p * 4 + m as ordinal,
       cast((o * 7 + d * 3 + p) % 60 as double) as TIME_minutes,
       cast((o * 5 + d * 11 + p) % 70 as double) as TOTIVT_IVT_minutes, cast((o + d) % 4 as double) as VTOLL_FAR,
       cast((o * 900 + d * 1300 + p * 100) % 40000 as double) as DIST_meters,
       cast((o * 70 + d * 130) % 4000 as double) as DDIST_meters, cast((o + d * 2) % 12 as double) as WACC_minutes,
       cast((o * 2 + d) % 9 as double) as WAUX_minutes, cast((o * 3 + d) % 8 as double) as WEGR_minutes,
       cast((o * 4 + d) % 15 as double) as DTIM_minutes, cast((o * 6 + d) % 50 as double) as KEYIVT_minutes,
       cast(0 as double) as FERRYIVT_minutes, cast((o + d) % 3 as double) as BOARDS
from fx_skim_cell
"""

VIEWS["fx_skim_new"] = """
select timePeriod, case when BOARDS = 2 then 'DRV_COM_WLK' else pathType end as pathType, origin, destination, ordinal,
       TIME_minutes + 1 as TIME_minutes, TOTIVT_IVT_minutes + 2 as TOTIVT_IVT_minutes, VTOLL_FAR, DIST_meters,
       DDIST_meters, WACC_minutes, WAUX_minutes, WEGR_minutes, DTIM_minutes, KEYIVT_minutes, FERRYIVT_minutes, BOARDS
from fx_skim_raw where timePeriod = 'AM' and pathType in ('SOV', 'DRV_LOC_WLK')
"""

VIEWS["fx_interval_skim"] = """
select t.e as interval_end, c.o + 1 as o, c.d + 1 as d,
       cast((c.o * 7 + c.d * 3) % 60 + t.k * ((c.o + c.d) % 20) as double) as time,
       cast((c.o * 900 + c.d * 1300) % 90000 as double) as distance, cast((c.o + c.d) % 9 as double) as cost,
       cast((c.o * c.d) % 5 as double) as fare,
       cast(case when (c.o + c.d) % 8 = 0 then 86400 else (c.o + 2 * c.d) % 50 end as double) as ivtt
from (select distinct l_suppkey as o, l_partkey % (select count(*) from supplier) as d from lineitem) c
{intervals}
"""

VIEWS["fx_od_location"] = """
select c_custkey + 1 as location, c_custkey % (select count(*) from supplier) + 1 as zone from customer
"""

VIEWS["fx_zone_raw"] = """
select zone_id, concat('POLYGON ((', cast(x0 as varchar(30)), ' ', cast(y0 as varchar(30)), ', ', cast(x1 as varchar(30)), ' ',
       cast(y0 as varchar(30)), ', ', cast(x1 as varchar(30)), ' ', cast(y1 as varchar(30)), ', ', cast(x0 as varchar(30)), ' ',
       cast(y1 as varchar(30)), ', ', cast(x0 as varchar(30)), ' ', cast(y0 as varchar(30)), '))') as geometry
from fx_taz
"""

VIEWS["fx_block_box"] = """
select block_id, cast(block_no % 50 * 11 as double) / 1000 - 98 as x0, cast(block_no % 50 * 11 + 13 as double) / 1000 - 98 as x1,
       cast((block_no * 3) % 50 * 10 as double) / 1000 + 30 as y0, cast((block_no * 3) % 50 * 10 + 17 as double) / 1000 + 30 as y1
from fx_block
"""

VIEWS["fx_school"] = """
select cast(p_partkey as varchar(20)) as ncessch, concat('48', lpad(cast(p_partkey % 7 * 2 + 1 as varchar(20)), 3, '0')) as county_code,
       cast(p_partkey % 55 as double) / 100 - 98 as longitude, cast((p_partkey * 3) % 55 as double) / 100 + 30 as latitude,
       cast(case when p_partkey % 9 = 0 then null when p_partkey % 10 = 0 then -5 else p_size * 10 end as double) as enrollment
from part
"""

VIEWS["fx_college"] = """
select c_custkey as unitid, c_name as inst_name, cast(c_custkey % 52 as double) / 100 - 98 as longitude,
       cast((c_custkey * 7) % 52 as double) / 100 + 30 as latitude
from customer
"""

VIEWS["fx_undergraduate"] = """
select s_suppkey as unitid, cast(case when s_suppkey % 11 = 0 then null else (s_suppkey * 37) % 500 - 20 end as double) as enrollment_fall
from supplier
"""

VIEWS["fx_graduate"] = """
select p_partkey as unitid, cast((p_partkey * 13) % 90 - 5 as double) as enrollment_fall from part
"""

VIEWS["fx_gap_iteration"] = """
select concat('iteration_', cast(o_orderkey % 12 as varchar(20))) as iter, o_orderkey % 12 as seq,
       sum(cast(o_orderkey * 13 % 211 as double)) / count(*) as relative_gap_min0
from orders group by o_orderkey % 12
"""

VIEWS["fx_demand_trip"] = """
select o_orderkey + 1 as id, o_custkey % (select count(*) + 3 from supplier) + 1 as o,
       (o_custkey * 31 + o_orderkey) % (select count(*) from supplier) + 1 as d,
       cast((o_orderkey * 97) % 90000 as double) / 60 as minute
from orders
"""


def _needs(sql: str) -> list[str]:
    words = set(re.findall(r"\w+", sql))
    return [v for v in VIEWS if v in words]


def _ordered(names: list[str]) -> list[str]:
    out: list[str] = []
    for name in names:
        for n in [*_ordered(_needs(VIEWS[name])), name]:
            if n not in out:
                out.append(n)
    return out


#: Literal rows beside every row: as SQL has them, and as Spark's explode, which needs no join.
LITERAL_ROWS = {
    "{members}": (
        "cross join (values (0), (1), (2), (3)) t(m)",
        "lateral view explode(array(0, 1, 2, 3)) t as m",
    ),
    "{intervals}": (
        "cross join (values (360, 0), (540, 1), (720, 2), (1440, 3)) t(e, k)",
        "lateral view inline(array(struct(360, 0), struct(540, 1), struct(720, 2), struct(1440, 3))) t as e, k",
    ),
}


def _with_rows(sql: str, spark: bool) -> str:
    for name, forms in LITERAL_ROWS.items():
        sql = sql.replace(name, forms[spark])
    return sql


def with_views(sql: str, spark_dir: str | None = None) -> str:
    """Prefix a SELECT with the definitions it uses; with a folder, of the base tables too."""
    ctes = [f"{n} as ({_with_rows(VIEWS[n].strip(), spark_dir is not None)})" for n in _ordered(_needs(sql))]
    if spark_dir is not None:
        words = set(re.findall(r"\w+", " ".join([sql, *ctes])))
        ctes = [f"{b} as (select * from parquet.`{spark_dir}/{b}.parquet`)" for b in BASE if b in words] + ctes
    body = sql.strip()
    if body[:5].lower() == "with ":
        ctes, body = [*ctes, body[5:].lstrip()], ""
        return "with " + ",\n".join(ctes)
    return ("with " + ",\n".join(ctes) + "\n" if ctes else "") + body


class Tables:
    """Workload inputs as DataFrames, built on first use: ``T["fx_trip"]`` or ``T.trip``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, str(sf_dir).rstrip("/")

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.sql(with_views(f"select * from {name}", self.sf_dir))

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self["fx_" + name]
