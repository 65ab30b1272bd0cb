"""Ride-hail service reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commuta.functions.columns import METRES_PER_MILE_RIDEHAIL, safe_div, trunc_int

# Final status of a ride-hail leg.
PICKUP, DROPOFF, REPOSITION = -1, -2, -3
# Trip modes of each demand share.
DEMAND_MODES = {
    "sav": [9], "sov": [0], "hov": [2], "non_motor": [7, 8], "transit": [3, 4, 5, 11, 12, 13, 14, 15, 16],
}
RIDEHAIL = 9


def _miles(cond: Column | None = None, metres: str = "travel_distance") -> Column:
    return F.sum(metres if cond is None else F.when(cond, F.col(metres))) / METRES_PER_MILE_RIDEHAIL


def _trip_side(trip: DataFrame) -> DataFrame:
    mode, code = F.col("mode"), F.col("has_artificial_trip")
    tests = {name: mode.isin(codes) for name, codes in DEMAND_MODES.items()}
    tests["other"] = (mode == 10) | (mode > 16)
    served = (mode == RIDEHAIL) & (code == 0)
    sums = trip.agg(
        (F.avg(F.when(served, F.col("end_s") - F.col("start_s"))) / 60).alias("TT"),
        F.sum(F.when(mode == RIDEHAIL, code)).alias("_codes"),
        *[F.count(F.when(t, 1)).alias(f"_{name}") for name, t in tests.items()],
        _miles(code == 0).alias("sim_pmt"),
        _miles().alias("tot_pmt"),
        _miles(mode == 0).alias("sov_vmt"),
        _miles(mode == 2).alias("hov_vmt"),
        _miles((mode == RIDEHAIL) & (code != 0)).alias("_unmet"),
    )
    requests = reduce(lambda a, b: a + b, [F.col(f"_{name}") for name in tests])
    return sums.select(
        "TT", F.col("_sav").alias("demand"),
        (100 * (1 - safe_div("_codes", "_sav"))).alias("perc_met"),
        "sim_pmt", "tot_pmt", "sov_vmt", "hov_vmt", "_unmet",
        *[(100 * safe_div(f"_{name}", requests)).alias(f"{name}_mode_share") for name in tests],
    )


def _leg_side(tnc_trip: DataFrame) -> DataFrame:
    pax, metres, status = F.col("passengers"), F.col("travel_distance"), F.col("final_status")
    to_rider = status == PICKUP
    moved, paid = metres != 0, (metres != 0) & (pax != 0)

    def occupancy(cond: Column) -> Column:
        return safe_div(F.sum(F.when(cond, pax)), F.count(F.when(cond, 1)))

    def occupancy_by_distance(cond: Column) -> Column:
        return safe_div(F.sum(F.when(cond, pax * metres)), F.sum(F.when(cond, metres)))

    return tnc_trip.agg(
        (F.avg(F.when(to_rider, F.col("end_s") - F.col("start_s"))) / 60).alias("pickup"),
        (F.avg(F.when(to_rider, F.col("start_s") - F.col("request_time"))) / 60).alias("wait"),
        occupancy(moved).alias("avo_trips"),
        occupancy_by_distance(F.lit(True)).alias("avo_dist"),
        occupancy(paid).alias("avo_trips_revenue"),
        occupancy_by_distance(pax != 0).alias("avo_dist_revenue"),
        _miles(pax == 0).alias("empty_sav_vmt"),
        _miles(status == REPOSITION).alias("repos_vmt"),
        _miles().alias("sav_vmt"),
    )


def _vehicle_side(tnc_trip: DataFrame) -> DataFrame:
    """Mean idle hours over all vehicles and mean drop-offs over vehicles with any."""
    per_vehicle = tnc_trip.groupBy("vehicle").agg(
        (24 - F.sum(F.col("end_s") - F.col("start_s")) / 3600).alias("idle"),
        F.count(F.when(F.col("final_status") == DROPOFF, 1)).alias("done"),
    )
    return per_vehicle.agg(
        F.avg("idle").alias("avg_idle_time"),
        F.avg(F.when(F.col("done") > 0, F.col("done"))).alias("avg_sav_trips"),
    ).select("*", (F.col("avg_idle_time") / 24 * 100).alias("perc_idle"))


def tnc_agg_output(trip: DataFrame, tnc_trip: DataFrame, transit_vehicle_links: DataFrame) -> DataFrame:
    """One wide row of ride-hail service, distance and mode-share measures.

    Each log is scanned once (the ride-hail log once more per vehicle); the one-row
    results are stacked and folded into a single row.
    """
    sides = [
        _trip_side(trip), _leg_side(tnc_trip), _vehicle_side(tnc_trip),
        transit_vehicle_links.agg(_miles(metres="value_length").alias("transit_vmt")),
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sides)
    row = stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
    return row.withColumn("estimated_artificial_sav_vmt", safe_div("_unmet", "avo_dist")).drop("_unmet")


def _hour(c: str = "start_s") -> Column:
    return trunc_int(F.col(c) / 3600)


def tnc_avo_revenue_by_tod(tnc_trip: DataFrame) -> DataFrame:
    """Passengers per paid leg by start hour."""
    return (
        tnc_trip.filter((F.col("travel_distance") != 0) & (F.col("passengers") != 0))
        .groupBy(_hour().alias("tod"))
        .agg(safe_div(F.sum("passengers"), F.count("*")).alias("avo_t_revenue"), F.count("*").alias("demand"))
    )


def tnc_avo_dist_by_tod(tnc_trip: DataFrame) -> DataFrame:
    """Distance-weighted passengers by start hour."""
    rider_metres = F.col("passengers") * F.col("travel_distance")
    return tnc_trip.groupBy(_hour().alias("tod")).agg(
        safe_div(F.sum(rider_metres), F.sum("travel_distance")).alias("avo_d")
    )


def _served(trip: DataFrame) -> DataFrame:
    return trip.filter((F.col("mode") == RIDEHAIL) & (F.col("has_artificial_trip") == 0))


def tnc_delay_histogram(trip: DataFrame) -> DataFrame:
    """Served ride-hail trips by five-minute bin number of duration."""
    five_minutes = trunc_int((F.col("end_s") - F.col("start_s")) / 60 / 5).alias("tt")
    return _served(trip).groupBy(five_minutes).agg(F.count("*").alias("trip_count"))


def tnc_demand_by_tod(trip: DataFrame) -> DataFrame:
    return _served(trip).groupBy(_hour().alias("tod")).agg(F.count("*").alias("demand"))


def tnc_response_by_tod(tnc_trip: DataFrame) -> DataFrame:
    """Mean minutes from request to pickup by start hour."""
    return (
        tnc_trip.filter(F.col("final_status") == PICKUP)
        .groupBy(_hour().alias("hour"))
        .agg((F.avg(F.col("end_s") - F.col("request_time")) / 60).alias("response_time"))
    )


def zone_tnc_wait(zone_wait_times: DataFrame) -> DataFrame:
    """Mean ride-hail wait of each zone, in minutes."""
    return zone_wait_times.groupBy("zone").agg(F.avg("avg_wait_minutes").alias("avg_wait"))


def od_mode_automation_counts(
    trip: DataFrame, location: DataFrame, vehicle: DataFrame, vehicle_type: DataFrame
) -> DataFrame:
    """Private and ride-hail trips by origin zone, destination zone, mode and vehicle automation.

    The log is counted per (vehicle, origin, destination, mode) first and regrouped after
    each lookup, so neither a busy vehicle nor a busy location reaches one task whole.
    """
    automation = (
        vehicle.select(F.col("vehicle_id").alias("vehicle"), F.col("type").alias("type_id"))
        .join(vehicle_type.select("type_id", F.col("automation_type").alias("av_type")), "type_id")
        .select("vehicle", "av_type")
    )

    def regroup(df: DataFrame, *keys: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.sum("n").alias("n"))

    counts = (
        trip.filter(F.col("mode").isin(0, RIDEHAIL))
        .groupBy("vehicle", "origin", "destination", "mode")
        .agg(F.count("*").alias("n"))
        .join(automation, "vehicle")
    )
    counts = regroup(counts, "origin", "destination", "mode", "av_type")
    ends = [location.select(F.col("location").alias(e), F.col("zone").alias(z))
            for e, z in (("origin", "o_id"), ("destination", "d_id"))]
    counts = regroup(counts.join(ends[0], "origin"), "o_id", "destination", "mode", "av_type")
    return regroup(counts.join(ends[1], "destination"), "o_id", "d_id", "mode", "av_type").withColumnRenamed(
        "n", "trips"
    )
