"""Convergence reports over the trip log."""

from functools import reduce

from pyspark.sql import functions as F

from commuta.plans import gap
from workload.registry import SQL, add

DUR = "(end_s - start_s)"
ROUTED = "routed_travel_time"
ROAD = "mode in (0, 9, 17, 18, 19, 20)"
RAN = f"{ROAD} and has_artificial_trip <> 1 and end_s > start_s and {ROUTED} > 0"
LATE = f"case when {DUR} > {ROUTED} then {DUR} - {ROUTED} else 0 end"
EXPERIENCED = f"""case has_artificial_trip when 0 then {DUR} when 2 then 3 * {ROUTED}
    when 3 then greatest({DUR}, {ROUTED}) when 4 then greatest({DUR}, {ROUTED}) end"""
GAP_ABS = f"""case has_artificial_trip when 0 then abs({DUR} - {ROUTED}) when 2 then 2 * {ROUTED}
    when 3 then {LATE} when 4 then {LATE} end"""
GAP_MIN0 = f"case has_artificial_trip when 2 then 2 * {ROUTED} when 0 then {LATE} when 3 then {LATE} when 4 then {LATE} end"
OUTCOMES = ["all_good", "not_routed", "congestion_removal", "simulation_end", "stuck_in_entry_queue"]


def n_where(cond):
    return f"nullif(count(*) filter (where {cond}), 0)"


TOTALS = f"""sum({EXPERIENCED}) as total_experienced_ttime, sum({ROUTED}) as total_routed_ttime,
    sum({GAP_ABS}) as total_gap_abs, sum({GAP_MIN0}) as total_gap_min0, count(*) as number_of_trips,
    {n_where("path is not null")} as trips_with_path, {n_where("path is null")} as trips_without_path"""
COUNTS = ", ".join(f"{n_where(f'has_artificial_trip = {i}')} as {n}" for i, n in enumerate(OUTCOMES))
RATIOS = """round(total_gap_abs / nullif(total_routed_ttime, 0), 6) as relative_gap_abs,
    round(total_gap_min0 / nullif(total_routed_ttime, 0), 6) as relative_gap_min0,
    round((total_experienced_ttime - total_routed_ttime) / nullif(total_routed_ttime, 0), 6) as relative_gap"""
SHARES = ", ".join(
    f"round(cast({c} as double) / nullif(number_of_trips, 0), 6) as perc_{c}"
    for c in ["trips_with_path", "trips_without_path", *OUTCOMES]
)
BIN = f"cast(20 * trunc(({EXPERIENCED}) / 1200) as bigint)"


def _code(i, expr):
    return f"sum({expr}) filter (where has_artificial_trip = {i})"


LONGER = f"greatest({DUR}, {ROUTED})"
BREAKDOWN = ", ".join(
    [f"{_code(i, e)} as total_experienced_ttime_{i}"
     for i, e in enumerate([DUR, ROUTED, f"3 * {ROUTED}", LONGER, LONGER])]
    + [f"{_code(i, ROUTED)} as total_routed_ttime_{i}" for i in range(5)]
    + [f"{_code(i, e)} as total_gap_abs_{i}"
       for i, e in enumerate([f"abs({DUR} - {ROUTED})", "cast(0 as double)", f"2 * {ROUTED}", LATE, LATE])]
)

# Mode codes and labels of the assignment run.
LONG_LABELS = """case mode when 0 then 'SOV' when 1 then 'AUTO' when 2 then 'HOV' when 3 then 'TRUCK' when 4 then 'BUS'
    when 5 then 'RAIL' when 6 then 'NONMOTORIZED' when 7 then 'BICYCLE' when 8 then 'WALK' when 9 then 'TAXI'
    when 10 then 'SCHOOLBUS' when 11 then 'PARK_AND_RIDE' when 12 then 'KISS_AND_RIDE' when 13 then 'PARK_AND_RAIL'
    when 14 then 'KISS_AND_RAIL' when 15 then 'TNC_AND_RIDE' when 16 then 'TNC_AND_RAIL' when 17 then 'MD_TRUCK'
    when 18 then 'HD_TRUCK' when 19 then 'BPLATE' when 20 then 'LD_TRUCK' when 21 then 'RAIL_NEST'
    when 22 then 'BUS40' when 23 then 'BUS60' when 25 then 'TELEPORTED' end"""
# Mode codes and labels of the baseline report.
BASE_LABELS = """case mode when 0 then 'SOV' when 2 then 'HOV' when 4 then 'BUS' when 5 then 'RAIL'
    when 6 then 'NONMOTORIZED' when 7 then 'BICYCLE' when 8 then 'WALK' when 9 then 'TAXI' when 10 then 'SCHOOLBUS'
    when 11 then 'PARK_AND_RIDE' when 12 then 'KISS_AND_RIDE' when 13 then 'PARK_AND_RAIL' when 14 then 'KISS_AND_RAIL'
    when 15 then 'TNC_AND_RIDE' when 16 then 'TNC_AND_RAIL' when 25 then 'RIDE_AND_UNPARK' when 26 then 'RIDE_AND_REKISS'
    when 27 then 'RAIL_AND_UNPARK' when 28 then 'RAIL_AND_REKISS' end"""

add("r31_gap_calculations", lambda T: gap.gap_calculations(T.trip), f"""
    select {RATIOS}, t.*, {SHARES}, round(total_gap_abs / nullif(number_of_trips, 0), 6) as gap_per_trip
    from (select {TOTALS}, {COUNTS} from fx_trip where {RAN}) t""")
add("r31b_gap_summary", lambda T: gap.gap_summary(T.trip), f"""
    select {RATIOS}, total_experienced_ttime, total_routed_ttime, total_gap_abs, total_gap_min0
    from (select {TOTALS} from fx_trip where {RAN}) t""")
add("r32_gap_calculations_binned", lambda T: gap.gap_calculations_binned(T.trip), f"""
    select {BIN} as total_experienced_ttime_bin, {TOTALS} from fx_trip where {RAN} group by {BIN}""")
add("r33_there_is_path", lambda T: gap.there_is_path(T.trip), f"""
    select cast(path is not null as int) as there_is_path,
        round(sum(abs({DUR} - {ROUTED})) / nullif(sum({DUR}), 0), 6) as relative_gap_abs,
        round(sum(case when {ROUTED} is not null then {LATE} end) / nullif(sum({DUR}), 0), 6) as relative_gap_min0,
        count(*) as number_of_trips
    from fx_trip where {ROAD} and has_artificial_trip = 0 group by path is not null""")
GAP_BINS = f"""
    select round(trunc(experienced_gap / cast(0.1 as double)) * cast(0.1 as double), 6) as gap_bin,
        cast(path is not null as int) as there_is_path, count(*) as trip_count
    from fx_trip where {ROAD} and has_artificial_trip = 0 group by all"""
add("r34_gap_bins", lambda T: gap.gap_bins(T.trip), GAP_BINS)
add("r35_greater_routed_time", lambda T: gap.greater_routed_time(T.trip), f"""
    select cast({ROUTED} > {DUR} as int) as greater_routed_time, count(*) as trip_count
    from fx_trip where {ROAD} and has_artificial_trip = 0 group by all""")
add("r36_mode_count", lambda T: gap.mode_count(T.trip), f"""
    select {LONG_LABELS} as mode_name, has_artificial_trip, count(*) as trip_count
    from fx_trip group by mode, has_artificial_trip""")
add("r36b_artificial_count", lambda T: gap.artificial_count(T.trip),
    f"select count(*) as number_of_trips, {COUNTS} from fx_trip where {RAN}")
add("r37_mode_count_baseline", lambda T: gap.mode_count_baseline(T.trip), f"""
    select {BASE_LABELS} as mode_name, has_artificial_trip, 4 * count(*) as mode_count from fx_trip group by 1, 2""")
add("r38_person_gaps", lambda T: gap.person_gaps(T.trip), f"""
    select person, round(sum({GAP_MIN0}) / nullif(sum({ROUTED}), 0), 6) as avg_gap
    from fx_trip where {RAN} and person is not null group by person""")
add("r39_gap_breakdown", lambda T: gap.gap_breakdown(T.trip), f"select {BREAKDOWN} from fx_trip where {RAN}")
add("r40_gap_breakdown_binned", lambda T: gap.gap_breakdown_binned(T.trip), f"""
    select {BIN} as total_experienced_ttime_bin, {BREAKDOWN} from fx_trip where {RAN} group by {BIN}""")

CLEARED = ", ".join(f"null::bigint as {c}" for c in ["vehicle", "person", "path", "path_multimodal"])
add("p08_trip_log_reset", lambda T: gap.trip_log_reset(T.trip), f"""
    select * replace ({CLEARED}) from fx_trip
    where (mode = 0 and person is null) or mode in (17, 18, 19, 20)""")
add("p08b_trip_log_reset_external", lambda T: gap.trip_log_reset(T.trip, 22), f"""
    select * replace ({CLEARED}) from fx_trip where type = 22""")


#: The reports of the trip log by query; one aggregation makes them all.
SUITE = {
    "r31_gap_calculations": "gap_calculations", "r31b_gap_summary": "gap_summary", "r32_gap_calculations_binned": "gap_calculations_binned",
    "r33_there_is_path": "there_is_path", "r34_gap_bins": "gap_bins", "r35_greater_routed_time": "greater_routed_time", "r36_mode_count": "mode_count",
    "r36b_artificial_count": "artificial_count", "r37_mode_count_baseline": "mode_count_baseline", "r38_person_gaps": "person_gaps",
    "r39_gap_breakdown": "gap_breakdown", "r40_gap_breakdown_binned": "gap_breakdown_binned",
}


def suite(T):
    made = gap.gap_reports(T.trip)
    parts = [made[f].withColumn("report", F.lit(q)) for q, f in SUITE.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


add("r31_r40_gap_reports", suite, " union all by name ".join(f"select '{q}' as report, * from ({SQL[q]})" for q in SUITE))
