"""Transit boardings, occupancy, waiting and transfer reports.

Vehicle-stop and path-leg records are summed per vehicle trip (and stop link or half
hour) before the schedule tables join in, so the star joins run on the reduced rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commuta.functions.columns import trunc_int
from commuta.operators.joins import lookup

# Miles per metre of the occupancy report; path modes that are no transit trip.
MILES_PER_METRE = 0.000621371
BICYCLE, WALK = 7, 8


def vehicle_agency(trips: DataFrame, patterns: DataFrame, routes: DataFrame, agencies: DataFrame) -> DataFrame:
    """Agency of every scheduled vehicle trip."""
    return (
        trips.select("trip_id", "pattern_id")
        .join(patterns.select("pattern_id", "route_id"), "pattern_id")
        .join(routes.select("route_id", "agency_id"), "route_id")
        .join(agencies.select("agency_id", "agency"), "agency_id")
        .select(F.col("trip_id").alias("vehicle_trip"), "agency")
    )


def _vehicle_mode(vehicle: DataFrame) -> DataFrame:
    return vehicle.select(F.col("transit_vehicle_trip").alias("vehicle_trip"), "mode")


def _boardings(links: DataFrame, *keys) -> DataFrame:
    return links.groupBy(F.col("value_transit_vehicle_trip").alias("vehicle_trip"), *keys).agg(
        F.sum("value_boardings").alias("boardings"), F.sum("value_alightings").alias("alightings")
    )


def _boarding_report(sums: DataFrame, agency: DataFrame, vehicle: DataFrame, keys: list[str], x: float) -> DataFrame:
    return (
        sums.join(_vehicle_mode(vehicle), "vehicle_trip")
        .join(agency, "vehicle_trip")
        .groupBy("agency", "mode", *keys)
        .agg(
            (F.lit(x) * F.sum("boardings")).alias("boardings"),
            (F.lit(x) * F.sum("alightings")).alias("alightings"),
        )
    )


def boardings_by_agency_mode(links: DataFrame, agency: DataFrame, vehicle: DataFrame, expansion: float = 4) -> DataFrame:
    return _boarding_report(_boardings(links), agency, vehicle, [], expansion)


def boardings_by_agency_mode_time(
    links: DataFrame, agency: DataFrame, vehicle: DataFrame, expansion: float = 4
) -> DataFrame:
    """Boardings per half hour of departure, as decimal hours."""
    half_hour = (trunc_int(F.col("value_act_departure_time") / 1800) / 2).alias("HH")
    return _boarding_report(_boardings(links, half_hour), agency, vehicle, ["HH"], expansion)


def boardings_by_agency_mode_area_type(
    links: DataFrame, agency: DataFrame, vehicle: DataFrame, transit_links: DataFrame, stops: DataFrame,
    zone: DataFrame, expansion: float = 4,
) -> DataFrame:
    """Boardings by area type of the zone of the stop where the link starts."""
    link_area = (
        transit_links.select(F.col("transit_link").alias("value_link"), F.col("from_node").alias("stop_id"))
        .join(stops.select("stop_id", "zone"), "stop_id")
        .join(zone.select("zone", "area_type"), "zone")
        .select("value_link", "area_type")
    )
    sums = lookup(_boardings(links, "value_link"), link_area, ["value_link"], how="inner")
    per_area = sums.groupBy("vehicle_trip", "area_type").agg(
        F.sum("boardings").alias("boardings"), F.sum("alightings").alias("alightings")
    )
    return _boarding_report(per_area, agency, vehicle, ["area_type"], expansion)


def boardings_by_agency_and_trip_mode(
    path_links: DataFrame, path: DataFrame, trip: DataFrame, agency: DataFrame, expansion: float = 4
) -> DataFrame:
    """Path legs with an estimated wait, by agency, leg type and mode of the person trip."""
    wait = sum(F.col(f"value_est_{m}_wait_time") for m in ("bus", "rail", "comm_rail"))
    legs = path_links.filter(wait > 0).select(
        F.col("object_id").alias("id"), F.col("value_transit_vehicle_trip").alias("vehicle_trip"),
        F.col("value_link_type").alias("board_mode"),
    )
    modes = (
        trip.filter(F.col("path_multimodal").isNotNull())
        .groupBy(F.col("path_multimodal").alias("id"), F.col("mode").alias("trip_mode"))
        .agg(F.count("*").alias("trips"))
        .join(path.select("id"), "id", "left_semi")
    )
    return (
        legs.join(modes, "id")
        .groupBy("vehicle_trip", "trip_mode", "board_mode")
        .agg(F.sum("trips").alias("n"))
        .join(agency, "vehicle_trip")
        .groupBy("trip_mode", "agency", "board_mode")
        .agg((F.lit(expansion) * F.sum("n")).alias("board_count"))
    )


def transit_occupancy(links: DataFrame, agency: DataFrame, vehicle: DataFrame, expansion: float = 4) -> DataFrame:
    """Million person miles and vehicle miles by agency and mode."""
    load = F.col("value_seated_load") + F.col("value_standing_load")
    sums = links.groupBy(F.col("value_transit_vehicle_trip").alias("vehicle_trip")).agg(
        F.sum(load * F.col("value_length")).alias("load_metres"), F.sum("value_length").alias("metres")
    )
    return (
        sums.join(_vehicle_mode(vehicle), "vehicle_trip")
        .join(agency, "vehicle_trip")
        .groupBy("agency", "mode")
        .agg(
            (F.lit(expansion) * MILES_PER_METRE * F.sum("load_metres") / 1e6).alias("PMT"),
            (MILES_PER_METRE * F.sum("metres") / 1e6).alias("VMT"),
        )
    )


def act_wait_count(path: DataFrame, expansion: float = 4) -> DataFrame:
    return path.agg((F.lit(expansion) * F.sum("act_wait_count")).alias("act_wait_count"))


def _actual(kind: str) -> Column:
    return sum(F.col(f"act_{m}_{kind}") for m in ("bus", "rail", "comm_rail"))


def avg_wait_and_total_time(path: DataFrame) -> DataFrame:
    """Mean minutes waiting, riding, outside vehicles and in all, of paths with a wait."""
    outside = F.col("act_bike_time") + F.col("act_walk_time") + F.col("act_car_time")
    return path.filter(_actual("wait_time") > 0).agg(
        (F.avg(_actual("wait_time")) / 60).alias("avg_wait_time"),
        (F.avg(_actual("ivtt")) / 60).alias("avg_ivtt"),
        (F.avg(outside) / 60).alias("avg_ovtt"),
        (F.avg("act_duration") / 60).alias("avg_duration"),
        (F.avg("act_wait_count") - 1).alias("avg_transfer_count"),
    )


def ivtt_wait_by_path_and_vehicle(path_links: DataFrame, vehicle_prefix: str = "5") -> DataFrame:
    """Estimated wait and ride time per path and vehicle trip of one operator's trip numbers."""
    wait = [F.col("value_est_bus_wait_time"), F.col("value_est_rail_wait_time")]
    ride = [F.col("value_est_bus_ivtt"), F.col("value_est_rail_ivtt")]
    return (
        path_links.filter(
            F.col("value_transit_vehicle_trip").cast("string").startswith(vehicle_prefix)
            & ((wait[0] >= 0) | (wait[1] >= 0))
            & ((ride[0] >= 0) | (ride[1] >= 0))
        )
        .groupBy(F.col("object_id").alias("path_id"), F.col("value_transit_vehicle_trip").alias("vehicle_trip"))
        .agg(F.sum(wait[0] + wait[1]).alias("trip_wait_time"), F.sum(ride[0] + ride[1]).alias("trip_ivtt"))
    )


def ivtt_wait_by_path(by_vehicle: DataFrame, path: DataFrame) -> DataFrame:
    """Those sums per path, beside the path's own totals and the differences."""
    sums = by_vehicle.groupBy("path_id").agg(
        F.sum("trip_wait_time").alias("cta_wait_time"),
        F.sum("trip_ivtt").alias("cta_ivtt"),
        F.count("path_id").alias("cta_boarding_count"),
    )
    own = path.select(
        F.col("id").alias("path_id"),
        (F.col("est_bus_wait_time") + F.col("est_rail_wait_time")).alias("wait_time"),
        (F.col("est_bus_ivtt") + F.col("est_rail_ivtt")).alias("ivtt"),
        (F.col("est_bike_time") + F.col("est_walk_time") + F.col("est_car_time")).alias("ovtt"),
        F.col("est_duration").alias("duration"),
        F.col("est_wait_count").alias("boarding_count"),
        "number_of_switches",
    )
    return sums.join(own, "path_id").select(
        "*",
        (F.col("wait_time") - F.col("cta_wait_time")).alias("wait_diff"),
        (F.col("ivtt") - F.col("cta_ivtt")).alias("ivtt_diff"),
        (F.col("boarding_count") - F.col("cta_boarding_count")).alias("board_diff"),
    )


def avg_wait_and_total_time_by_path(by_path: DataFrame, expansion: float = 4) -> DataFrame:
    x = F.lit(expansion)
    return by_path.agg(
        (F.avg("cta_wait_time") / 60).alias("avg_wait_time"),
        (F.avg("cta_ivtt") / 60).alias("avg_ivtt"),
        (F.avg("ovtt") / 60).alias("avg_ovtt"),
        (F.avg("duration") / 60).alias("avg_duration"),
        (F.avg("cta_boarding_count") - 1).alias("avg_transfer_count"),
        (x * F.sum("cta_boarding_count")).alias("boarding_count"),
        (x * F.count("*")).alias("trip_count"),
        (x * F.sum("number_of_switches")).alias("reroute_count"),
    )


def _rides(path: DataFrame, rode: Column) -> Column:
    on_transit = (F.col("mode") != BICYCLE) & (F.col("mode") != WALK)
    return F.count(F.when(on_transit & rode, 1))


def transit_trips_wo_boarding_count(path: DataFrame, expansion: float = 4) -> DataFrame:
    n = _rides(path, _actual("ivtt") == 0)
    return path.agg((F.lit(expansion) * n).alias("transit_trips_wo_boarding_count"))


def transit_trips_with_boarding_count(path: DataFrame, expansion: float = 4) -> DataFrame:
    n = _rides(path, _actual("ivtt") > 0)
    return path.agg((F.lit(expansion) * n).alias("transit_trips_with_boarding_count"))


def transit_transfers(path: DataFrame, expansion: float = 4) -> DataFrame:
    return (
        path.filter(F.col("mode") != WALK)
        .groupBy("est_wait_count", "est_transfer_pen")
        .agg((F.lit(expansion) * F.count("*")).alias("trip_count"))
    )


def transit_transfers_with_gen_cost(path: DataFrame, expansion: float = 4) -> DataFrame:
    """Transfers by upper bound of the hourly bin of generalised cost."""
    cost_bin = (trunc_int(F.col("est_gen_cost") / 3600 + 1) * 3600).alias("gen_cost_bin")
    return (
        path.filter(F.col("mode") != WALK)
        .groupBy(cost_bin, "est_wait_count", "est_transfer_pen")
        .agg((F.lit(expansion) * F.count("*")).alias("trip_count"))
    )
