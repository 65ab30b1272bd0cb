"""Activity, mode-share and travel-time reports of the simulated day.

Rows are filtered and semi-joined before they are counted, so the log is shuffled once for
each join key. Counts are taken before a join only where they reduce the rows: per person
and kind, per location, and for trip 0, which all planned activities share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commuta.functions.codes import ACTIVITY_LABELS, START_COLUMNS, person_type
from commuta.functions.columns import METRES_PER_MILE, label, safe_div, trunc_int
from commuta.operators.joins import lookup, running_totals

# Warm-up seconds, adult age, largest area type of the city.
WARM_UP_S = 122
ADULT_AGE = 16
CITY_AREA_TYPE = 3
# Stays at home that are no executed activity.
HOME_STAYS = ["HOME", "WORK AT HOME", "PICKUP-DROPOFF"]


def _executed(activity: DataFrame) -> DataFrame:
    stay = (F.col("mode") == "NO_MOVE") & F.col("type").isin(HOME_STAYS)
    return activity.filter((F.col("start_time") > WARM_UP_S) & (F.col("trip") != 0) & ~stay)


def _after_warm_up(activity: DataFrame) -> DataFrame:
    return activity.filter(F.col("start_time") > WARM_UP_S)


def _adults(person: DataFrame) -> DataFrame:
    return person.filter(F.col("age") > ADULT_AGE)


def _tally(df: DataFrame, *keys) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def _regroup(counts: DataFrame, *keys: str) -> DataFrame:
    return counts.groupBy(*keys).agg(F.sum("n").alias("n"))


def _expanded(df: DataFrame, keys: list[str], expansion: float, name: str = "mode_count") -> DataFrame:
    return df.groupBy(*keys).agg((F.lit(expansion) * F.sum("n")).alias(name))


def person_distribution(person: DataFrame) -> DataFrame:
    return person.groupBy(person_type().alias("pertype")).agg(F.count("*").cast("double").alias("total"))


def activity_distribution(person: DataFrame, activity: DataFrame) -> DataFrame:
    """Executed activities by person type and activity label."""
    done = _tally(_executed(activity), "person", label("type", ACTIVITY_LABELS).alias("acttype"))
    types = person.select("person", person_type().alias("pertype"))
    return (
        done.join(types, "person")
        .groupBy("pertype", "acttype")
        .agg(F.sum("n").cast("double").alias("count"))
    )


def activity_rate_distribution(person: DataFrame, activity: DataFrame) -> DataFrame:
    """Executed activities per person of each type."""
    return (
        activity_distribution(person, activity)
        .join(person_distribution(person), "pertype")
        .select("pertype", "acttype", safe_div("count", "total").alias("rate"))
    )


def activity_start_distribution(activity: DataFrame, expansion: float = 4) -> DataFrame:
    """Executed activities by start hour, one column per activity type."""
    return (
        _executed(activity)
        .groupBy(trunc_int(F.col("start_time") / 3600).alias("hour"))
        .agg(
            *[
                (F.lit(expansion) * F.sum(F.when(F.col("type") == t, 1))).alias(name)
                for name, t in START_COLUMNS.items()
            ],
            (F.lit(expansion) * F.count("*")).alias("total"),
        )
    )


def _travel_totals(sums: DataFrame, expansion: float) -> DataFrame:
    x = F.lit(expansion)
    miles, hours = x * F.sum("metres") / METRES_PER_MILE, x * F.sum("seconds") / 3600.0
    return sums.groupBy("mode").agg(
        (miles / 1e6).alias("million_VMT"),
        (hours / 1e6).alias("million_VHT"),
        safe_div(miles, hours).alias("speed_mph"),
        (x * F.sum("n")).alias("count"),
    )


def _travel_sums(trip: DataFrame, *keys: str) -> DataFrame:
    return trip.groupBy(*keys).agg(
        F.sum("travel_distance").alias("metres"),
        F.sum(F.col("end_s") - F.col("start_s")).alias("seconds"),
        F.count("*").alias("n"),
    )


def vmt_vht_by_mode(trip: DataFrame, expansion: float = 4) -> DataFrame:
    """Vehicle miles, hours and speed by mode."""
    return _travel_totals(_travel_sums(trip.filter(F.col("has_artificial_trip") != 1), "mode"), expansion)


def vmt_vht_by_mode_city(trip: DataFrame, location: DataFrame, zone: DataFrame, expansion: float = 4) -> DataFrame:
    """The same for trips that start in a city zone."""
    ran = trip.filter((F.col("has_artificial_trip") != 1) & (F.col("end_s") > F.col("start_s")))
    city = zone.filter(F.col("area_type") <= CITY_AREA_TYPE).select("zone")
    in_city = location.select(F.col("location").alias("origin"), "zone").join(city, "zone")
    return _travel_totals(_travel_sums(ran, "origin", "mode").join(in_city, "origin"), expansion)


def _touching_city(counts: DataFrame, location: DataFrame) -> DataFrame:
    """Rows whose origin or destination lies in the city; both ends must be known locations."""
    city = F.col("area_type") <= CITY_AREA_TYPE
    for end in ("origin", "destination"):
        side = location.select(F.col("location").alias(end), city.alias(f"{end}_city"))
        counts = lookup(counts, side, [end], how="inner")
    return counts.filter(F.col("origin_city") | F.col("destination_city"))


def trips_in_network_city(trip: DataFrame, tnc_trip: DataFrame, location: DataFrame, expansion: float = 4) -> DataFrame:
    """Departures, arrivals and trips under way, cumulated over 6-second bins of the day.

    Departure (or arrival) counts of the two trip logs that are equal in the same bin
    count once, as the report's distinct union has it.
    """

    def six_seconds(c: str) -> Column:
        return trunc_int(F.col(c) / 6) * 6

    def binned(rows: DataFrame) -> DataFrame:
        return rows.select(
            six_seconds("start_s").alias("time_depart"), six_seconds("end_s").alias("time_arrive"), "origin", "destination"
        )

    def events(log: DataFrame) -> DataFrame:
        bins = F.array(
            F.struct(F.col("time_depart").alias("time"), F.lit("departures").alias("kind")),
            F.struct(F.col("time_arrive").alias("time"), F.lit("arrivals").alias("kind")),
        )
        return (
            log.select(F.explode(bins).alias("e")).groupBy("e.time", "e.kind").agg(F.count("*").alias("n"))
        )

    private = trip.filter((F.col("mode") == 0) & F.col("person").isNotNull())
    logs = [events(_touching_city(binned(log), location)) for log in (private, tnc_trip)]
    x = F.lit(expansion)
    per_bin = (
        logs[0].unionByName(logs[1]).distinct()
        .groupBy("time")
        .agg(*[
            F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(k)
            for k in ("departures", "arrivals")
        ])
    )
    cum = running_totals(
        per_bin, F.floor(F.col("time") / 3600), "time", {"cum_depart": "departures", "cum_arrive": "arrivals"}
    )
    return cum.select(
        "time", (x * F.col("cum_depart")).alias("cum_depart"), (x * F.col("cum_arrive")).alias("cum_arrive"),
        (x * (F.col("cum_depart") - F.col("cum_arrive"))).alias("in_network"),
    )


def _of_adults(counts: DataFrame, person: DataFrame) -> DataFrame:
    return counts.join(_adults(person).select("person"), "person", "left_semi")


def planned_activity_mode_share(activity: DataFrame, person: DataFrame, expansion: float = 4) -> DataFrame:
    planned = _tally(_after_warm_up(activity).filter(F.col("trip") == 0), "person", "mode")
    return _expanded(_of_adults(planned, person), ["mode"], expansion)


def _per_trip(activity: DataFrame, *keys: str) -> DataFrame:
    """The log ready to join on trips: rows as they are (n = 1), but those of trip 0, the planned ones, counted first."""
    moving = activity.filter(~F.col("trip").eqNullSafe(0)).select("trip", *keys, F.lit(1).cast("bigint").alias("n"))
    return moving.unionByName(_tally(activity.filter(F.col("trip") == 0), "trip", *keys))


def _on_trips(activity: DataFrame, trips: DataFrame, *keys: str) -> DataFrame:
    return _per_trip(activity, *keys).join(trips.select(F.col("trip_id").alias("trip")), "trip", "left_semi").drop("trip")


def executed_activity_mode_share(
    activity: DataFrame, person: DataFrame, trip: DataFrame, expansion: float = 4
) -> DataFrame:
    """Modes of activities reached by a trip longer than two seconds, failed modes left out."""
    done = _after_warm_up(activity).filter(~F.col("mode").ilike("FAIL%"))
    long_enough = trip.filter(F.col("end_s") - F.col("start_s") > 2)
    return _expanded(_of_adults(_on_trips(done, long_enough, "person", "mode"), person), ["mode"], expansion)


def executed_activity_mode_share_fails(activity: DataFrame, person: DataFrame, expansion: float = 4) -> DataFrame:
    done = _tally(_after_warm_up(activity).filter(F.col("trip") != 0), "person", "mode")
    return _expanded(_of_adults(done, person), ["mode"], expansion)


def _by_area(counts: DataFrame, location: DataFrame, zone: DataFrame, expansion: float) -> DataFrame:
    areas = location.select(F.col("location").alias("location_id"), "zone").join(
        zone.select("zone", "area_type"), "zone"
    )
    placed = _regroup(counts, "location_id", "type", "mode").join(areas, "location_id")
    return _expanded(placed, ["type", "area_type", "mode"], expansion)


def planned_activity_mode_share_by_area(
    activity: DataFrame, person: DataFrame, location: DataFrame, zone: DataFrame, expansion: float = 4
) -> DataFrame:
    planned = _after_warm_up(activity).filter(F.col("trip") == 0)
    counts = _of_adults(_tally(planned, "person", "location_id", "type", "mode"), person)
    return _by_area(counts, location, zone, expansion)


def executed_activity_mode_share_by_area(
    activity: DataFrame, person: DataFrame, trip: DataFrame, location: DataFrame, zone: DataFrame,
    expansion: float = 4,
) -> DataFrame:
    keys = ("person", "location_id", "type", "mode")
    return _by_area(_of_adults(_on_trips(_after_warm_up(activity), trip, *keys), person), location, zone, expansion)


def executed_activity_dist_by_area(mode_share_by_area: DataFrame) -> DataFrame:
    return mode_share_by_area.groupBy("type").agg(F.sum("mode_count").alias("mode_count"))


def executed_activity_dist_by_area_city(mode_share_by_area: DataFrame) -> DataFrame:
    return executed_activity_dist_by_area(mode_share_by_area.filter(F.col("area_type") <= CITY_AREA_TYPE))


def _travel_time_averages(
    trips: DataFrame, activity: DataFrame, person: DataFrame, household: DataFrame, by_mode: bool, expansion: float
) -> DataFrame:
    """Mean skim, routed and actual time and distance of adults' trips by activity type.

    Trips are filtered by person before the activities join; every mean is carried as a
    weighted sum and the weight of its known values until the last grouping.
    """
    keys = ["mode", "acttype"] if by_mode else ["acttype"]
    values = {
        "skim": F.col("skim_travel_time"), "routed": F.col("routed_travel_time"),
        "actual": F.col("end_s") - F.col("start_s"), "metres": F.col("travel_distance"),
    }
    housed = _adults(person).join(household.select("household"), "household", "left_semi").select("person")
    measured = trips.join(housed, "person", "left_semi").select(
        F.col("trip_id").alias("trip"), "mode", *[v.alias(k) for k, v in values.items()]
    )
    purposes = _per_trip(activity.withColumnRenamed("type", "acttype").select("trip", "acttype"), "acttype")
    sums = [F.sum(F.col("n") * F.col(k)).alias(k) for k in values]
    weights = [F.sum(F.when(F.col(k).isNotNull(), F.col("n"))).alias(f"{k}_n") for k in values]
    totals = purposes.join(measured, "trip").groupBy(*keys).agg(*sums, *weights, F.sum("n").alias("n"))

    def mean(k: str, unit: float) -> Column:
        return safe_div(k, f"{k}_n") / unit

    return totals.select(
        *keys, mean("skim", 60).alias("ttime_avg_skim"), mean("routed", 60).alias("ttime_avg_routed"),
        mean("actual", 60).alias("ttime_avg"), mean("metres", 1000).alias("dist_avg"),
        (F.lit(expansion) * F.col("n")).alias("count"),
    )


# Fixed value: distances from here on are not averaged, in metres.
MAX_DISTANCE = 1_000_000


def ttime_by_act_average(
    trip: DataFrame, activity: DataFrame, person: DataFrame, household: DataFrame, expansion: float = 4
) -> DataFrame:
    kept = trip.filter((F.col("travel_distance") < MAX_DISTANCE) & (F.col("end_s") - F.col("start_s") > 2))
    return _travel_time_averages(kept, activity, person, household, False, expansion)


def _with_skims(trip: DataFrame) -> DataFrame:
    return trip.filter(
        (F.col("travel_distance") < MAX_DISTANCE)
        & (F.col("end_s") >= F.col("start_s"))
        & (F.col("skim_travel_time") >= 0)
        & (F.col("skim_travel_time") < 86400)
    )


def ttime_by_act_average_w_skims(
    trip: DataFrame, activity: DataFrame, person: DataFrame, household: DataFrame, expansion: float = 4
) -> DataFrame:
    return _travel_time_averages(_with_skims(trip), activity, person, household, False, expansion)


def ttime_by_act_average_w_skims_hway(
    trip: DataFrame, activity: DataFrame, person: DataFrame, household: DataFrame, expansion: float = 4
) -> DataFrame:
    kept = _with_skims(trip).filter(F.col("mode").isin(0, 9))
    return _travel_time_averages(kept, activity, person, household, True, expansion)


def mode_distribution_adult(
    trip: DataFrame, person: DataFrame, household: DataFrame, expansion: float = 4
) -> DataFrame:
    """Adults' trips by mode: home-based work, home-based other, non-home-based, all."""
    moved = trip.filter(F.col("end_s") - F.col("start_s") > 2).select("person", "mode", "origin", "destination")
    homes = (
        _adults(person).select("person", "household", "work_location_id")
        .join(household.select("household", F.col("location").alias("home")), "household")
        .select("person", "work_location_id", "home")
    )
    origin, dest, home, work = (F.col(c) for c in ("origin", "destination", "home", "work_location_id"))

    def trips(cond: Column) -> Column:
        return F.lit(expansion) * F.sum(F.when(cond, 1).otherwise(0))

    return (
        lookup(moved, homes, ["person"], how="inner")
        .groupBy("mode")
        .agg(
            trips(dest == work).alias("HBW"),
            trips((origin == home) & (dest != work)).alias("HBO"),
            trips((origin != home) & (dest != home) & (dest != work)).alias("NHB"),
            (F.lit(expansion) * F.count("*")).alias("total"),
        )
    )


def employment_validation(person: DataFrame, location: DataFrame, zone: DataFrame, expansion: float = 4) -> DataFrame:
    """Workers by zone of their work location beside the zone's employment total."""
    return (
        _tally(person, F.col("work_location_id").alias("location"))
        .join(location.select("location", "zone"), "location")
        .join(zone.select("zone", "employment_total"), "zone")
        .groupBy("zone", "employment_total")
        .agg((F.lit(expansion) * F.sum("n")).alias("workers"))
    )
