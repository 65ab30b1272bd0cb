"""Ride-hail reports."""

from commuta.plans import ridehail as rh
from workload.registry import add

SHARES = {"sav": "9", "sov": "0", "hov": "2", "non_motor": "7, 8", "transit": "3, 4, 5, 11, 12, 13, 14, 15, 16"}
SHARE_TESTS = {k: f"mode in ({v})" for k, v in SHARES.items()} | {"other": "(mode = 10 or mode > 16)"}
ALL = " + ".join(f"n_{k}" for k in SHARE_TESTS)

add("r43_tnc_agg_output", lambda T: rh.tnc_agg_output(T.trip, T.tnc_trip, T.transit_vehicle_links), f"""
    with t as (select avg(end_s - start_s) filter (where mode = 9 and has_artificial_trip = 0) / 60 as TT,
            sum(has_artificial_trip) filter (where mode = 9) as codes,
            {", ".join(f"count(*) filter (where {c}) as n_{k}" for k, c in SHARE_TESTS.items())},
            sum(travel_distance) filter (where has_artificial_trip = 0) / 1600 as sim_pmt,
            sum(travel_distance) / 1600 as tot_pmt, sum(travel_distance) filter (where mode = 0) / 1600 as sov_vmt,
            sum(travel_distance) filter (where mode = 2) / 1600 as hov_vmt,
            sum(travel_distance) filter (where mode = 9 and has_artificial_trip <> 0) / 1600 as unmet from fx_trip),
    h as (select avg(end_s - start_s) filter (where final_status = -1) / 60 as pickup,
            avg(start_s - request_time) filter (where final_status = -1) / 60 as wait,
            sum(passengers) filter (where travel_distance <> 0)::double
                / count(*) filter (where travel_distance <> 0) as avo_trips,
            sum(passengers * travel_distance) / sum(travel_distance) as avo_dist,
            sum(passengers) filter (where travel_distance <> 0 and passengers <> 0)::double
                / count(*) filter (where travel_distance <> 0 and passengers <> 0) as avo_trips_revenue,
            sum(passengers * travel_distance) filter (where passengers <> 0)
                / sum(travel_distance) filter (where passengers <> 0) as avo_dist_revenue,
            sum(travel_distance) filter (where passengers = 0) / 1600 as empty_sav_vmt,
            sum(travel_distance) filter (where final_status = -3) / 1600 as repos_vmt,
            sum(travel_distance) / 1600 as sav_vmt from fx_tnc_trip),
    i as (select avg(idle) as avg_idle_time from
            (select 24 - sum(end_s - start_s) / 3600 as idle from fx_tnc_trip group by vehicle)),
    d as (select avg(n) as avg_sav_trips from
            (select count(*) as n from fx_tnc_trip where final_status = -2 group by vehicle)),
    k as (select sum(value_length) / 1600 as transit_vmt from fx_transit_vehicle_links)
    select round(TT, 6) as TT, round(pickup, 6) as pickup, round(wait, 6) as wait, n_sav as demand,
        round(100 * (1 - codes::double / nullif(n_sav, 0)), 6) as perc_met, round(avo_trips, 6) as avo_trips,
        round(avo_dist, 6) as avo_dist, round(avo_trips_revenue, 6) as avo_trips_revenue,
        round(avo_dist_revenue, 6) as avo_dist_revenue, round(avg_idle_time, 6) as avg_idle_time,
        round(avg_idle_time / 24 * 100, 6) as perc_idle, round(avg_sav_trips, 6) as avg_sav_trips,
        round(sim_pmt, 6) as sim_pmt, round(tot_pmt, 6) as tot_pmt, round(sov_vmt, 6) as sov_vmt,
        round(hov_vmt, 6) as hov_vmt, round(transit_vmt, 6) as transit_vmt, round(empty_sav_vmt, 6) as empty_sav_vmt,
        round(repos_vmt, 6) as repos_vmt, round(sav_vmt, 6) as sav_vmt,
        round(unmet / nullif(avo_dist, 0), 6) as estimated_artificial_sav_vmt,
        {", ".join(f"round(100 * n_{k}::double / ({ALL}), 6) as {k}_mode_share" for k in SHARE_TESTS)}
    from t, h, i, d, k""")
add("r44_tnc_avo_revenue_by_tod", lambda T: rh.tnc_avo_revenue_by_tod(T.tnc_trip), """
    select cast(trunc(start_s / 3600) as bigint) as tod, round(sum(passengers)::double / count(*), 6) as avo_t_revenue,
        count(*) as demand from fx_tnc_trip where travel_distance <> 0 and passengers <> 0 group by 1""")
add("r45_tnc_avo_dist_by_tod", lambda T: rh.tnc_avo_dist_by_tod(T.tnc_trip), """
    select cast(trunc(start_s / 3600) as bigint) as tod,
        round(sum(passengers * travel_distance) / nullif(sum(travel_distance), 0), 6) as avo_d
    from fx_tnc_trip group by 1""")
add("r46_tnc_delay_histogram", lambda T: rh.tnc_delay_histogram(T.trip), """
    select cast(trunc((end_s - start_s) / 60 / 5) as bigint) as tt, count(*) as trip_count
    from fx_trip where mode = 9 and has_artificial_trip = 0 group by 1""")
add("r47_tnc_demand_by_tod", lambda T: rh.tnc_demand_by_tod(T.trip), """
    select cast(trunc(start_s / 3600) as bigint) as tod, count(*) as demand
    from fx_trip where mode = 9 and has_artificial_trip = 0 group by 1""")
add("r48_tnc_response_by_tod", lambda T: rh.tnc_response_by_tod(T.tnc_trip), """
    select cast(trunc(start_s / 3600) as bigint) as hour, round(avg(end_s - request_time) / 60, 6) as response_time
    from fx_tnc_trip where final_status = -1 group by 1""")
add("r50_zone_tnc_wait", lambda T: rh.zone_tnc_wait(T.zone_wait_times),
    "select zone, round(avg(avg_wait_minutes), 6) as avg_wait from fx_zone_wait_times group by zone")
add("r50b_od_mode_automation_counts",
    lambda T: rh.od_mode_automation_counts(T.trip, T.location, T.vehicle, T.vehicle_type), """
    select o.zone as o_id, d.zone as d_id, t.mode, vt.automation_type as av_type, count(*) as trips
    from fx_trip t join fx_location o on t.origin = o.location join fx_location d on t.destination = d.location
    join fx_vehicle v on t.vehicle = v.vehicle_id join fx_vehicle_type vt on v.type = vt.type_id
    where t.mode in (0, 9) group by all""")
