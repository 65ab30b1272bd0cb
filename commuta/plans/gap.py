"""Convergence reports: how far experienced travel time is from routed travel time.

Every report is one scan of the trip log with conditional sums, so the shuffle carries
one partial row per task and group whatever the number of trips.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commuta.functions.codes import BASELINE_MODE_LABELS, MODE_LABELS, ROAD_MODES, TRUCK_MODES
from commuta.functions.columns import count_where, label, safe_div, strict_max, trunc_int
from commuta.operators.lineage import written_table

CODE = "has_artificial_trip"

# Outcome codes of a simulated trip.
OUTCOMES = {0: "all_good", 1: "not_routed", 2: "congestion_removal", 3: "simulation_end", 4: "stuck_in_entry_queue"}


def _duration() -> Column:
    return F.col("end_s") - F.col("start_s")


def _routed() -> Column:
    return F.col("routed_travel_time")


def _late() -> Column:
    return strict_max(_duration() - _routed(), F.lit(0.0))


def _experienced() -> dict[int, Column]:
    longer = strict_max(_duration(), _routed())
    return {0: _duration(), 1: _routed(), 2: 3 * _routed(), 3: longer, 4: longer}


def _gap(finished: Column) -> dict[int, Column]:
    return {0: finished, 1: F.lit(0.0), 2: 2 * _routed(), 3: _late(), 4: _late()}


def _gap_abs() -> dict[int, Column]:
    return _gap(F.abs(_duration() - _routed()))


def _by_code(values: dict[int, Column]) -> Column:
    out = None
    for code, value in values.items():
        test = F.col(CODE) == code
        out = F.when(test, value) if out is None else out.when(test, value)
    return out


def road_trips(trip: DataFrame) -> DataFrame:
    """Routed road trips that ran: positive duration and routed time."""
    return trip.filter(
        F.col("mode").isin(ROAD_MODES)
        & (F.col(CODE) != 1)
        & (F.col("end_s") > F.col("start_s"))
        & (_routed() > 0)
    )


def _finished_road_trips(trip: DataFrame) -> DataFrame:
    return trip.filter(F.col("mode").isin(ROAD_MODES) & (F.col(CODE) == 0))


def _totals() -> list[Column]:
    return [
        F.sum(_by_code(_experienced())).alias("total_experienced_ttime"),
        F.sum(_routed()).alias("total_routed_ttime"),
        F.sum(_by_code(_gap_abs())).alias("total_gap_abs"),
        F.sum(_by_code(_gap(_late()))).alias("total_gap_min0"),
        F.count("*").alias("number_of_trips"),
        count_where(F.col("path").isNotNull()).alias("trips_with_path"),
        count_where(F.col("path").isNull()).alias("trips_without_path"),
    ]


def _outcome_counts() -> list[Column]:
    return [count_where(F.col(CODE) == code).alias(name) for code, name in OUTCOMES.items()]


def _ratios() -> list[Column]:
    routed = "total_routed_ttime"
    return [
        safe_div("total_gap_abs", routed).alias("relative_gap_abs"),
        safe_div("total_gap_min0", routed).alias("relative_gap_min0"),
        safe_div(F.col("total_experienced_ttime") - F.col(routed), routed).alias("relative_gap"),
    ]


def gap_calculations(trip: DataFrame) -> DataFrame:
    """One row: relative gaps, totals, outcome counts and shares."""
    sums = road_trips(trip).agg(*_totals(), *_outcome_counts())
    shares = [
        safe_div(c, "number_of_trips").alias(f"perc_{c}")
        for c in ["trips_with_path", "trips_without_path", *OUTCOMES.values()]
    ]
    return sums.select(
        *_ratios(), "*", *shares, safe_div("total_gap_abs", "number_of_trips").alias("gap_per_trip")
    )


def gap_summary(trip: DataFrame) -> DataFrame:
    """Short form of gap_calculations: the three relative gaps and four totals."""
    return gap_calculations(trip).select(
        "relative_gap_abs", "relative_gap_min0", "relative_gap", "total_experienced_ttime",
        "total_routed_ttime", "total_gap_abs", "total_gap_min0",
    )


def _experienced_bin() -> Column:
    """Lower bound, in minutes, of the 20-minute bin of experienced time."""
    return (20 * trunc_int(_by_code(_experienced()) / 1200)).alias("total_experienced_ttime_bin")


def gap_calculations_binned(trip: DataFrame) -> DataFrame:
    return road_trips(trip).groupBy(_experienced_bin()).agg(*_totals())


def artificial_count(trip: DataFrame) -> DataFrame:
    return road_trips(trip).agg(F.count("*").alias("number_of_trips"), *_outcome_counts())


def there_is_path(trip: DataFrame) -> DataFrame:
    """Relative gaps of finished road trips with and without a path."""
    return (
        _finished_road_trips(trip)
        .groupBy(F.col("path").isNotNull().cast("int").alias("there_is_path"))
        .agg(
            safe_div(F.sum(F.abs(_duration() - _routed())), F.sum(_duration())).alias("relative_gap_abs"),
            safe_div(F.sum(_late()), F.sum(_duration())).alias("relative_gap_min0"),
            F.count("*").alias("number_of_trips"),
        )
    )


def gap_bins(trip: DataFrame) -> DataFrame:
    """Finished road trips by tenth of experienced gap and presence of a path."""
    return (
        _finished_road_trips(trip)
        .groupBy(
            (trunc_int(F.col("experienced_gap") / 0.1) * 0.1).alias("gap_bin"),
            F.col("path").isNotNull().cast("int").alias("there_is_path"),
        )
        .agg(F.count("*").alias("trip_count"))
    )


def greater_routed_time(trip: DataFrame) -> DataFrame:
    return (
        _finished_road_trips(trip)
        .groupBy((_routed() > _duration()).cast("int").alias("greater_routed_time"))
        .agg(F.count("*").alias("trip_count"))
    )


def mode_count(trip: DataFrame) -> DataFrame:
    """Trips by raw mode and outcome, labelled after grouping: each unlabelled code keeps its own row."""
    return (
        trip.groupBy("mode", CODE)
        .agg(F.count("*").alias("trip_count"))
        .select(label("mode", MODE_LABELS).alias("mode_name"), CODE, "trip_count")
    )


def mode_count_baseline(trip: DataFrame, expansion: float = 4) -> DataFrame:
    """Trips by baseline label and outcome; all unlabelled codes share one NULL row."""
    return trip.groupBy(label("mode", BASELINE_MODE_LABELS).alias("mode_name"), CODE).agg(
        (F.lit(expansion) * F.count("*")).alias("mode_count")
    )


def person_gaps(trip: DataFrame) -> DataFrame:
    """Average relative gap of each person with road trips."""
    return (
        road_trips(trip)
        .filter(F.col("person").isNotNull())
        .groupBy("person")
        .agg(safe_div(F.sum(_by_code(_gap(_late()))), F.sum(_routed())).alias("avg_gap"))
    )


def _breakdown() -> list[Column]:
    parts = {
        "total_experienced_ttime": _experienced(),
        "total_routed_ttime": {code: _routed() for code in OUTCOMES},
        "total_gap_abs": _gap_abs(),
    }
    return [
        F.sum(F.when(F.col(CODE) == code, value)).alias(f"{name}_{code}")
        for name, values in parts.items()
        for code, value in values.items()
    ]


def gap_breakdown(trip: DataFrame) -> DataFrame:
    """One row of experienced time, routed time and gap per outcome code."""
    return road_trips(trip).agg(*_breakdown())


def gap_breakdown_binned(trip: DataFrame) -> DataFrame:
    return road_trips(trip).groupBy(_experienced_bin()).agg(*_breakdown())


def _is_road() -> Column:
    """The trips of ``road_trips``, as a condition that is false where unknown."""
    ran = F.col("mode").isin(ROAD_MODES) & (F.col(CODE) != 1) & (F.col("end_s") > F.col("start_s")) & (_routed() > 0)
    return F.coalesce(ran, F.lit(False))


def gap_reports(trip: DataFrame, expansion: float = 4) -> dict[str, DataFrame]:
    """All reports of this module by the name of their function, from one scan of the trip log.

    Every trip counts towards one group of each set of keys, and a report's condition is part of its sums, so one
    aggregation with partial sums serves them all. Its result, a row for each group, is written once; reports only pick from it.
    """
    road, finished = _is_road(), F.coalesce(F.col("mode").isin(ROAD_MODES) & (F.col(CODE) == 0), F.lit(False))
    keys = {
        "_bin": _experienced_bin(), "_gap_bin": trunc_int(F.col("experienced_gap") / 0.1) * 0.1, "_path": F.col("path").isNotNull().cast("int"),
        "_greater": (_routed() > _duration()).cast("int"), "_mode": F.col("mode"), "_code": F.col(CODE), "_person": F.col("person"),
    }
    values = {c: F.col(c) for c in ("start_s", "end_s", "routed_travel_time", CODE, "path", "mode")}
    # Null is a value of a key here: grouping ids tell it from a key that a set leaves out.
    rows = trip.select(*[c.alias(n) for n, c in (values | keys).items()], road.alias("_road"), finished.alias("_finished"))
    sets = [[], ["_bin"], ["_path"], ["_gap_bin", "_path"], ["_greater"], ["_mode", "_code"], ["_person"]]

    def only(flag: str, c: Column) -> Column:
        return F.when(F.col(flag), c)

    road_sums = {
        "total_experienced_ttime": F.sum(only("_road", _by_code(_experienced()))), "total_routed_ttime": F.sum(only("_road", _routed())),
        "total_gap_abs": F.sum(only("_road", _by_code(_gap_abs()))), "total_gap_min0": F.sum(only("_road", _by_code(_gap(_late())))),
        "number_of_trips": F.count(only("_road", F.lit(1))),
        "trips_with_path": count_where(F.col("_road") & F.col("path").isNotNull()),
        "trips_without_path": count_where(F.col("_road") & F.col("path").isNull()),
    }
    outcomes = {name: count_where(F.col("_road") & (F.col(CODE) == code)) for code, name in OUTCOMES.items()}
    parts = {"total_experienced_ttime": _experienced(), "total_routed_ttime": {code: _routed() for code in OUTCOMES}, "total_gap_abs": _gap_abs()}
    breakdown = {
        f"{name}_{code}": F.sum(only("_road", F.when(F.col(CODE) == code, value))) for name, by_code in parts.items() for code, value in by_code.items()
    }
    done = {
        "_abs": F.sum(only("_finished", F.abs(_duration() - _routed()))), "_late": F.sum(only("_finished", _late())),
        "_took": F.sum(only("_finished", _duration())), "_done": F.count(only("_finished", F.lit(1))), "_all": F.count("*"),
    }
    sums = road_sums | outcomes | breakdown | done
    whole = rows.groupingSets([[F.col(k) for k in s] for s in sets], *[F.col(k) for k in keys]).agg(
        F.grouping_id().alias("_set"), *[c.alias(n) for n, c in sums.items()]
    )
    whole = written_table(whole, "gaps")
    order = list(keys)

    def of(*given: str) -> DataFrame:
        """The groups of one set of keys."""
        return whole.filter(F.col("_set") == sum(1 << (len(order) - 1 - k) for k, c in enumerate(order) if c not in given))

    # A log without trips has no group at all, but its totals are one row.
    total = of().agg(*[F.max(n).alias(n) for n in sums]).withColumn("number_of_trips", F.coalesce("number_of_trips", F.lit(0)))
    shares = [safe_div(c, "number_of_trips").alias(f"perc_{c}") for c in ["trips_with_path", "trips_without_path", *OUTCOMES.values()]]
    calculations = total.select(*_ratios(), *road_sums, *outcomes, *shares, safe_div("total_gap_abs", "number_of_trips").alias("gap_per_trip"))
    binned = of("_bin").filter("number_of_trips > 0").withColumnRenamed("_bin", "total_experienced_ttime_bin")
    by_path = of("_path").filter("_done > 0")
    by_mode = of("_mode", "_code")
    labelled = by_mode.select(label("_mode", BASELINE_MODE_LABELS).alias("mode_name"), F.col("_code").alias(CODE), "_all")
    return {
        "gap_calculations": calculations,
        "gap_summary": calculations.select(
            "relative_gap_abs", "relative_gap_min0", "relative_gap", "total_experienced_ttime", "total_routed_ttime", "total_gap_abs", "total_gap_min0"
        ),
        "gap_calculations_binned": binned.select("total_experienced_ttime_bin", *road_sums),
        "there_is_path": by_path.select(
            F.col("_path").alias("there_is_path"), safe_div("_abs", "_took").alias("relative_gap_abs"),
            safe_div("_late", "_took").alias("relative_gap_min0"), F.col("_done").alias("number_of_trips"),
        ),
        "gap_bins": of("_gap_bin", "_path").filter("_done > 0").select(
            F.col("_gap_bin").alias("gap_bin"), F.col("_path").alias("there_is_path"), F.col("_done").alias("trip_count")
        ),
        "greater_routed_time": of("_greater").filter("_done > 0").select(F.col("_greater").alias("greater_routed_time"), F.col("_done").alias("trip_count")),
        "mode_count": by_mode.select(label("_mode", MODE_LABELS).alias("mode_name"), F.col("_code").alias(CODE), F.col("_all").alias("trip_count")),
        "artificial_count": total.select("number_of_trips", *outcomes),
        "mode_count_baseline": labelled.groupBy("mode_name", CODE).agg((F.lit(expansion) * F.sum("_all")).alias("mode_count")),
        "person_gaps": of("_person").filter("_person is not null and number_of_trips > 0").select(
            F.col("_person").alias("person"), safe_div("total_gap_min0", "total_routed_ttime").alias("avg_gap")
        ),
        "gap_breakdown": total.select(*breakdown),
        "gap_breakdown_binned": binned.select("total_experienced_ttime_bin", *breakdown),
    }


def trip_log_reset(trip: DataFrame, external_type: int | None = None) -> DataFrame:
    """Trips kept for the next run, detached from this run's persons, vehicles and paths.

    Kept are road trips of no person and truck trips, or, with ``external_type``,
    the trips of that type only. Trips of unknown mode or type stay.
    """
    if external_type is None:
        no_person = (F.col("mode") == 0) & F.col("person").isNull()
        keep = F.col("mode").isNull() | no_person | F.col("mode").isin(TRUCK_MODES)
    else:
        keep = F.col("type").isNull() | (F.col("type") == external_type)
    cleared = ["vehicle", "person", "path", "path_multimodal"]
    types = {f.name: f.dataType for f in trip.schema.fields}
    return trip.filter(keep).withColumns({c: F.lit(None).cast(types[c]) for c in cleared})
