"""Transit reports."""

from commuta.plans import transit as tr
from workload.registry import add


def agency(T):
    return tr.vehicle_agency(T.transit_trips, T.transit_patterns, T.transit_routes, T.transit_agencies)


AGENCY = """join fx_transit_trips tt on {trip} = tt.trip_id join fx_transit_patterns tp on tp.pattern_id = tt.pattern_id
    join fx_transit_routes tr on tr.route_id = tp.route_id join fx_transit_agencies ta on ta.agency_id = tr.agency_id"""
STAR = f"""fx_transit_vehicle_links k join fx_transit_vehicle tv on k.value_transit_vehicle_trip = tv.transit_vehicle_trip
    {AGENCY.format(trip="k.value_transit_vehicle_trip")}"""
COUNTS = """cast(4 * sum(value_boardings) as bigint) as boardings,
    cast(4 * sum(value_alightings) as bigint) as alightings"""

add("r19_boardings_by_agency_mode",
    lambda T: tr.boardings_by_agency_mode(T.transit_vehicle_links, agency(T), T.transit_vehicle),
    f"select ta.agency, tv.mode, {COUNTS} from {STAR} group by all")
add("r20_boardings_by_agency_and_trip_mode",
    lambda T: tr.boardings_by_agency_and_trip_mode(T.path_multimodal_links, T.path_multimodal, T.trip, agency(T)), f"""
    select t.mode as trip_mode, ta.agency, k.value_link_type as board_mode, 4 * count(*) as board_count
    from fx_path_multimodal_links k join fx_path_multimodal pm on k.object_id = pm.id
    join fx_trip t on pm.id = t.path_multimodal {AGENCY.format(trip="k.value_transit_vehicle_trip")}
    where value_est_bus_wait_time + value_est_rail_wait_time + value_est_comm_rail_wait_time > 0 group by all""")
add("r21_boardings_by_agency_mode_time",
    lambda T: tr.boardings_by_agency_mode_time(T.transit_vehicle_links, agency(T), T.transit_vehicle), f"""
    select ta.agency, tv.mode, trunc(value_act_departure_time / 1800) / 2 as HH, {COUNTS} from {STAR} group by all""")
add("r22_boardings_by_agency_mode_area_type",
    lambda T: tr.boardings_by_agency_mode_area_type(
        T.transit_vehicle_links, agency(T), T.transit_vehicle, T.transit_links, T.transit_stops, T.zone), f"""
    select ta.agency, tv.mode, z.area_type, {COUNTS} from {STAR}
    join fx_transit_links tl on tl.transit_link = k.value_link join fx_transit_stops ts on ts.stop_id = tl.from_node
    join fx_zone z on ts.zone = z.zone group by all""")
add("r24_transit_occupancy",
    lambda T: tr.transit_occupancy(T.transit_vehicle_links, agency(T), T.transit_vehicle), f"""
    select ta.agency, tv.mode,
        round(4 * cast(0.000621371 as double) * sum((value_seated_load + value_standing_load) * value_length) / 1e6, 6) as PMT,
        round(cast(0.000621371 as double) * sum(value_length) / 1e6, 6) as VMT
    from {STAR} group by all""")
add("r25_act_wait_count", lambda T: tr.act_wait_count(T.path_multimodal),
    "select cast(4 * sum(act_wait_count) as bigint) as act_wait_count from fx_path_multimodal")
WAIT = "(act_bus_wait_time + act_rail_wait_time + act_comm_rail_wait_time)"
IVTT = "(act_bus_ivtt + act_rail_ivtt + act_comm_rail_ivtt)"
add("r26_avg_wait_and_total_time", lambda T: tr.avg_wait_and_total_time(T.path_multimodal), f"""
    select round(avg{WAIT} / 60, 6) as avg_wait_time, round(avg{IVTT} / 60, 6) as avg_ivtt,
        round(avg(act_bike_time + act_walk_time + act_car_time) / 60, 6) as avg_ovtt,
        round(avg(act_duration) / 60, 6) as avg_duration, round(avg(act_wait_count) - 1, 6) as avg_transfer_count
    from fx_path_multimodal where {WAIT} > 0""")
BY_VEHICLE = """select object_id as path_id, value_transit_vehicle_trip as vehicle_trip,
        sum(value_est_bus_wait_time + value_est_rail_wait_time) as trip_wait_time,
        sum(value_est_bus_ivtt + value_est_rail_ivtt) as trip_ivtt
    from fx_path_multimodal_links
    where cast(value_transit_vehicle_trip as varchar) like '5%'
        and (value_est_bus_wait_time >= 0 or value_est_rail_wait_time >= 0)
        and (value_est_bus_ivtt >= 0 or value_est_rail_ivtt >= 0)
    group by 1, 2"""
BY_PATH = f"""select c.*, p.est_bus_wait_time + p.est_rail_wait_time as wait_time,
        p.est_bus_ivtt + p.est_rail_ivtt as ivtt, p.est_bike_time + p.est_walk_time + p.est_car_time as ovtt,
        p.est_duration as duration, p.est_wait_count as boarding_count, p.number_of_switches,
        p.est_bus_wait_time + p.est_rail_wait_time - cta_wait_time as wait_diff,
        p.est_bus_ivtt + p.est_rail_ivtt - cta_ivtt as ivtt_diff, p.est_wait_count - cta_boarding_count as board_diff
    from (select path_id, sum(trip_wait_time) as cta_wait_time, sum(trip_ivtt) as cta_ivtt,
            count(*) as cta_boarding_count from ({BY_VEHICLE}) group by path_id) c
    join fx_path_multimodal p on p.id = c.path_id"""


def by_path(T):
    return tr.ivtt_wait_by_path(tr.ivtt_wait_by_path_and_vehicle(T.path_multimodal_links), T.path_multimodal)


add("r27_ivtt_wait_by_path_and_vehicle", lambda T: tr.ivtt_wait_by_path_and_vehicle(T.path_multimodal_links), BY_VEHICLE)
add("r28_ivtt_wait_by_path", by_path, BY_PATH)
add("r29_avg_wait_and_total_time_by_path", lambda T: tr.avg_wait_and_total_time_by_path(by_path(T)), f"""
    select round(avg(cta_wait_time) / 60, 6) as avg_wait_time, round(avg(cta_ivtt) / 60, 6) as avg_ivtt,
        round(avg(ovtt) / 60, 6) as avg_ovtt, round(avg(duration) / 60, 6) as avg_duration,
        round(avg(cta_boarding_count) - 1, 6) as avg_transfer_count,
        cast(4 * sum(cta_boarding_count) as bigint) as boarding_count, 4 * count(*) as trip_count,
        cast(4 * sum(number_of_switches) as bigint) as reroute_count
    from ({BY_PATH})""")
add("r30_transit_trips_wo_boarding_count", lambda T: tr.transit_trips_wo_boarding_count(T.path_multimodal), f"""
    select 4 * count(*) as transit_trips_wo_boarding_count from fx_path_multimodal
    where {IVTT} = 0 and mode <> 7 and mode <> 8""")
add("r30b_transit_trips_with_boarding_count", lambda T: tr.transit_trips_with_boarding_count(T.path_multimodal), f"""
    select 4 * count(*) as transit_trips_with_boarding_count from fx_path_multimodal
    where {IVTT} > 0 and mode <> 7 and mode <> 8""")
add("r41_transit_transfers_with_gen_cost", lambda T: tr.transit_transfers_with_gen_cost(T.path_multimodal), """
    select cast(trunc(est_gen_cost / 3600 + 1) as bigint) * 3600 as gen_cost_bin, est_wait_count, est_transfer_pen,
        4 * count(*) as trip_count from fx_path_multimodal where mode <> 8 group by 1, 2, 3""")
add("r42_transit_transfers", lambda T: tr.transit_transfers(T.path_multimodal), """
    select est_wait_count, est_transfer_pen, 4 * count(*) as trip_count from fx_path_multimodal
    where mode <> 8 group by 1, 2""")
