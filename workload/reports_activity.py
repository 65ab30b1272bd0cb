"""Activity, mode-share and travel-time reports."""

from commuta.functions import codes
from commuta.plans import activity as act
from workload.registry import add

# Person types.
PERTYPE = """case when employment in (1, 4) and work_hours >= 30 then 'FULLTIME_WORKER'
    when employment in (1, 4) then 'PARTTIME_WORKER'
    when school_enrollment in (2, 3) and age > 18 then 'ADULT_STUDENT' when age >= 65 then 'SENIOR'
    when age > 18 then 'NONWORKER' when age >= 16 then 'STUDENT_DRIVER' when age >= 5 then 'SCHOOL_CHILD'
    when age < 5 then 'PRESCHOOL' else 'NONWORKER' end"""
# Activity types and their labels.
ACTTYPE = f"""case type {" ".join(f"when '{t}' then '{label}'" for t, label in codes.ACTIVITY_LABELS.items())} end"""
# Stays at home that are no executed activity.
EXECUTED = """start_time > 122 and trip <> 0
    and not (mode = 'NO_MOVE' and type in ('HOME', 'WORK AT HOME', 'PICKUP-DROPOFF'))"""
# Columns of the start report and the activity type each counts.
START = {"EAT_OUT": "EAT OUT", "ERRANDS": "ERRANDS", "HEALTHCARE": "HEALTHCARE", "LEISURE": "LEISURE",
         "PERSONAL": "PERSONAL", "RELIGIOUS": "RELIGIOUS-CIVIC", "SERVICE": "SERVICE", "SHOP_MAJOR": "SHOP-MAJOR",
         "SHOP_OTHER": "SHOP-OTHER", "SOCIAL": "SOCIAL", "WORK": "WORK", "WORK_PART": "PART_WORK",
         "WORK_HOME": "WORK AT HOME", "SCHOOL": "SCHOOL", "PICKUP": "PICKUP-DROPOFF", "HOME": "HOME"}
DISTRIBUTION = f"""select {PERTYPE} as pertype, {ACTTYPE} as acttype, cast(count(*) as double) as count
    from fx_person p join fx_activity a on p.person = a.person where {EXECUTED} group by 1, 2"""
TRAVEL = """mode, round(4 * sum(travel_distance) / 1609.3 / 1e6, 6) as million_VMT,
    round(4 * sum(end_s - start_s) / 3600.0 / 1e6, 6) as million_VHT,
    round((4 * sum(travel_distance) / 1609.3) / nullif(4 * sum(end_s - start_s) / 3600.0, 0), 6) as speed_mph,
    4 * count(*) as count"""

add("r01_person_distribution", lambda T: act.person_distribution(T.person),
    f"select {PERTYPE} as pertype, cast(count(*) as double) as total from fx_person group by 1")
add("r02_activity_distribution", lambda T: act.activity_distribution(T.person, T.activity), DISTRIBUTION)
add("r03_activity_rate_distribution", lambda T: act.activity_rate_distribution(T.person, T.activity), f"""
    with d as ({DISTRIBUTION}), p as (select {PERTYPE} as pertype, count(*) as total from fx_person group by 1)
    select d.pertype, d.acttype, round(d.count / nullif(p.total, 0), 6) as rate from d join p on d.pertype = p.pertype""")
add("r04_activity_start_distribution", lambda T: act.activity_start_distribution(T.activity), f"""
    select cast(trunc(start_time / 3600) as bigint) as hour,
    {", ".join(f"nullif(4 * count(*) filter (where type = '{t}'), 0) as {n}" for n, t in START.items())},
    4 * count(*) as total from fx_activity where {EXECUTED} group by 1""")
add("r05_vmt_vht_by_mode", lambda T: act.vmt_vht_by_mode(T.trip),
    f"select {TRAVEL} from fx_trip where has_artificial_trip <> 1 group by mode")
add("r06_vmt_vht_by_mode_city", lambda T: act.vmt_vht_by_mode_city(T.trip, T.location, T.zone), f"""
    select {TRAVEL} from fx_trip t join fx_location l on t.origin = l.location join fx_zone z on l.zone = z.zone
    where end_s > start_s and has_artificial_trip <> 1 and z.area_type <= 3 group by mode""")


def _events(column, log, cond, departs):
    n = ("count(*) as departures, 0 as arrivals", "0 as departures, count(*) as arrivals")[0 if departs else 1]
    return f"""select cast(trunc({column} / 6) as bigint) * 6 as time, {n} from {log} t
        join fx_location l1 on t.origin = l1.location join fx_location l2 on t.destination = l2.location
        where {cond} and (l1.area_type <= 3 or l2.area_type <= 3) group by 1"""


PRIVATE = "mode = 0 and person is not null"
add("r07_trips_in_network_city", lambda T: act.trips_in_network_city(T.trip, T.tnc_trip, T.location), f"""
    with e as ({_events("start_s", "fx_trip", PRIVATE, True)} union {_events("end_s", "fx_trip", PRIVATE, False)}
        union {_events("start_s", "fx_tnc_trip", "true", True)} union {_events("end_s", "fx_tnc_trip", "true", False)}),
    b as (select time, sum(departures) as departures, sum(arrivals) as arrivals from e group by time),
    c as (select time, cast(4 * sum(departures) over w as bigint) as cum_depart,
            cast(4 * sum(arrivals) over w as bigint) as cum_arrive
          from b window w as (order by time rows unbounded preceding))
    select time, cum_depart, cum_arrive, cum_depart - cum_arrive as in_network from c""")

ADULT = "fx_activity a join fx_person p on a.person = p.person"
add("r08_planned_activity_mode_share", lambda T: act.planned_activity_mode_share(T.activity, T.person), f"""
    select mode, 4 * count(*) as mode_count from {ADULT}
    where start_time > 122 and trip = 0 and age > 16 group by mode""")
add("r09_executed_activity_mode_share", lambda T: act.executed_activity_mode_share(T.activity, T.person, T.trip), f"""
    select a.mode, 4 * count(*) as mode_count from {ADULT} join fx_trip t on a.trip = t.trip_id
    where start_time > 122 and t.end_s - t.start_s > 2 and age > 16 and a.mode not ilike 'FAIL%' group by a.mode""")
add("r10_executed_activity_mode_share_fails",
    lambda T: act.executed_activity_mode_share_fails(T.activity, T.person), f"""
    select mode, 4 * count(*) as mode_count from {ADULT}
    where start_time > 122 and trip <> 0 and age > 16 group by mode""")
AREA = "join fx_location l on a.location_id = l.location join fx_zone z on l.zone = z.zone"
add("r11_planned_activity_mode_share_by_area",
    lambda T: act.planned_activity_mode_share_by_area(T.activity, T.person, T.location, T.zone), f"""
    select a.type, z.area_type, a.mode, 4 * count(*) as mode_count from {ADULT} {AREA}
    where start_time > 122 and trip = 0 and age > 16 group by all""")
BY_AREA = f"""select a.type, z.area_type, a.mode, 4 * count(*) as mode_count from {ADULT} {AREA}
    join fx_trip t on a.trip = t.trip_id where start_time > 122 and age > 16 group by all"""


def by_area(T):
    return act.executed_activity_mode_share_by_area(T.activity, T.person, T.trip, T.location, T.zone)


add("r12_executed_activity_mode_share_by_area", by_area, BY_AREA)
add("r13_executed_activity_dist_by_area", lambda T: act.executed_activity_dist_by_area(by_area(T)),
    f"select type, cast(sum(mode_count) as bigint) as mode_count from ({BY_AREA}) group by type")
add("r14_executed_activity_dist_by_area_city", lambda T: act.executed_activity_dist_by_area_city(by_area(T)),
    f"select type, cast(sum(mode_count) as bigint) as mode_count from ({BY_AREA}) where area_type < 4 group by type")

AVERAGES = """a.type as acttype, round(avg(skim_travel_time) / 60, 6) as ttime_avg_skim,
    round(avg(routed_travel_time) / 60, 6) as ttime_avg_routed, round(avg(end_s - start_s) / 60, 6) as ttime_avg,
    round(avg(travel_distance) / 1000, 6) as dist_avg, 4 * count(*) as count"""
TRIP_JOIN = """fx_trip t join fx_person p on t.person = p.person join fx_household h on p.household = h.household
    join fx_activity a on a.trip = t.trip_id where age > 16 and travel_distance < 1000000"""
SKIMMED = "and t.end_s - t.start_s >= 0 and skim_travel_time >= 0 and skim_travel_time < 86400"
add("r15_ttime_by_act_average", lambda T: act.ttime_by_act_average(T.trip, T.activity, T.person, T.household),
    f"select {AVERAGES} from {TRIP_JOIN} and t.end_s - t.start_s > 2 group by a.type")
add("r16_ttime_by_act_average_w_skims",
    lambda T: act.ttime_by_act_average_w_skims(T.trip, T.activity, T.person, T.household),
    f"select {AVERAGES} from {TRIP_JOIN} {SKIMMED} group by a.type")
add("r17_ttime_by_act_average_w_skims_hway",
    lambda T: act.ttime_by_act_average_w_skims_hway(T.trip, T.activity, T.person, T.household),
    f"select t.mode, {AVERAGES} from {TRIP_JOIN} {SKIMMED} and t.mode in (0, 9) group by t.mode, a.type")
add("r18_mode_distribution_adult", lambda T: act.mode_distribution_adult(T.trip, T.person, T.household), """
    select mode, 4 * count(*) filter (where destination = work_location_id) as HBW,
        4 * count(*) filter (where origin = h.location and destination <> work_location_id) as HBO,
        4 * count(*) filter (where origin <> h.location and destination <> h.location
                             and destination <> work_location_id) as NHB,
        4 * count(*) as total
    from fx_trip t join fx_person p on t.person = p.person join fx_household h on p.household = h.household
    where age > 16 and end_s - start_s > 2 group by mode""")
add("r49_employment_validation", lambda T: act.employment_validation(T.person, T.location, T.zone), """
    select l.zone, 4 * count(*) as workers, z.employment_total
    from fx_person p join fx_location l on p.work_location_id = l.location join fx_zone z on l.zone = z.zone
    group by l.zone, z.employment_total""")
