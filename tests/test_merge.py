"""Iteration merges and store updates."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commuta.operators import demand, landuse, merge
from commuta.plans import gap


def test_replace_households(spark, rows):
    base = spark.createDataFrame([(1, 1, "a"), (2, 1, "a"), (3, 2, "a"), (4, None, "a")], "person_id int, household_id int, v string")
    upd = spark.createDataFrame([(9, 1, "n")], base.schema)
    assert rows(merge.replace_households(base, upd)) == sorted([(9, 1, "n"), (3, 2, "a"), (4, None, "a")], key=repr)


def test_table_precedence(spark):
    a, b, c = (spark.range(n) for n in (1, 2, 3))
    out = merge.table_precedence({"persons": a}, {"persons": b, "jobs": b}, {"jobs": c, "blocks": c}, required=["blocks"])
    assert (out["persons"], out["jobs"], out["blocks"]) == (a, b, c)
    with pytest.raises(ValueError, match="units"):
        merge.table_precedence({"persons": a}, required=["units"])


def test_best_iteration_skips_burn_in(spark):
    gaps = spark.createDataFrame([(f"i{s}", s, g) for s, g in enumerate([0.01, 0.02, 0.03, 0.5, None, 0.4, 0.4])], "iter string, seq int, relative_gap_min0 double")
    assert merge.best_iteration(gaps, 7).first().iter == "i5"
    with pytest.raises(Exception, match="fewer than 8"):
        merge.best_iteration(gaps, 8).collect()


def test_iteration_columns(spark, rows):
    df = spark.createDataFrame([(1, 0, 5.0), (1, 1, 6.0), (2, 1, 7.0)], "time int, loop int, value double")
    assert rows(merge.iteration_columns(df, [0, 1])) == [(1, 5.0, 6.0), (2, None, 7.0)]


def test_conform(spark):
    stored = T.StructType().add("person_id", T.LongType()).add("member_id", T.IntegerType()).add("block_id", T.LongType()).add("work_zone_id", T.StringType())
    df = spark.createDataFrame([("7", "2.0", "48", "stale", 3, "x", "extra")], "person_id string, PNUM string, block_id string, work_zone_id string, workplace_taz int, school_taz string, other string")
    out = landuse.conform(df, stored, landuse.PERSON_RENAMES, landuse.PERSON_REPLACED)
    assert out.columns == ["person_id", "member_id", "block_id", "work_zone_id", "school_zone_id"]
    assert tuple(out.first()) == (7, 2, "48", "3", "x")
    with pytest.raises(ValueError, match="member_id"):
        landuse.conform(df.drop("PNUM"), stored, landuse.PERSON_RENAMES, landuse.PERSON_REPLACED)


def test_warm_start_replaces_whole_columns(spark, rows):
    base = spark.createDataFrame([(1, 5, 0), (2, 6, 0)], "household_id int, persons int, cars int")
    new = spark.createDataFrame([(1, 3), (9, 4)], "household_id int, cars int")
    assert rows(landuse.warm_start_update(base, new, "household_id", ["cars"])) == [(1, 5, 3), (2, 6, None)]
    assert landuse.same_row_count(base, new).first().same == 1 and landuse.same_row_count(base, new.limit(1)).first().same == 0


def test_merge_population(spark, rows):
    new = spark.createDataFrame([(1, 10.0, 100, 1), (2, 20.0, 200, 2)], "household_id int, income double, location int, zone int")
    old = spark.createDataFrame([(1, None, 5, 5), (3, 9.0, 6, 6)], new.schema)
    assert rows(demand.merge_households(new, old)) == [(1, None, 100, 1), (2, 20.0, 200, 2)]
    pn = spark.createDataFrame([(11, 1), (12, 2)], "person_id int, household_id int")
    po = spark.createDataFrame([(71, 1), (73, 3)], "person_id int, household_id int")
    assert rows(demand.merge_members(pn, po, new, old)) == [(12, 2), (71, 1)]


def test_warm_start_needs_equal_rows(spark, rows):
    base = spark.createDataFrame([(1, 5), (2, 6)], "person_id int, w int")
    choices = spark.createDataFrame([(1, 7), (2, None)], "person_id int, w int")
    assert rows(landuse.warm_start_update(base, choices, "person_id", ["w"])) == [(1, 7), (2, None)]
    with pytest.raises(Exception, match="warm start of 2 rows with choices of 1"):
        landuse.warm_start_update(base, choices.limit(1), "person_id", ["w"]).collect()


def test_zone_attributes_edges(spark, rows):
    bz = spark.createDataFrame([("1", 1), ("2", 0), ("3", 3)], "block_id string, zone int")
    hh = spark.createDataFrame([(1, "1", 10.0), (2, "1", 30.0), (3, "9", 5.0)], "household_id int, block_id string, income double")
    pp = spark.createDataFrame([(1, 1, 1), (2, 1, 2), (3, 2, 3), (4, 3, 1)], "person_id int, household_id int, race_id int")
    jobs = spark.createDataFrame([("1", "52"), ("1", "??"), ("x", "52"), ("2", "52"), (None, "52")], "block_id string, sector_id string")
    out = rows(demand.zone_attributes(hh, pp, jobs, bz), "zone", "pop_households", "pop_persons", "employment_total", "employment_services", "percent_white", "hh_inc_avg")
    assert out == [(0, 0, 0, 0, 0, 0.0, 0.0), (1, 2, 3, 2, 1, pytest.approx(1 / 3), 20.0), (3, 0, 0, 0, 0, 0.0, 0.0)]


def test_gap_rules(spark):
    cols = "mode int, has_artificial_trip int, start_s double, end_s double, routed_travel_time double, path int, person int, experienced_gap double, type int, vehicle int, path_multimodal int"
    data = [
        (0, 0, 0.0, 100.0, 150.0, 1, 1, 0.3, 11, 1, 1), (9, 0, 0.0, 1300.0, 100.0, None, 2, 0.1, 11, 1, 1), (17, 2, 0.0, 10.0, 50.0, 1, None, 0.0, 22, 1, 1),
        (0, 3, 0.0, 10.0, 50.0, 1, 1, 0.0, 11, 1, 1), (0, 1, 0.0, 10.0, 50.0, 1, 1, 0.0, 11, 1, 1), (0, 0, 0.0, 0.0, 50.0, 1, 1, 0.0, 11, 1, 1),
        (0, 0, 0.0, 9.0, None, 1, None, None, 11, 1, 1), (5, 0, 0.0, 10.0, 50.0, 1, 1, 0.0, 11, 1, 1), (24, 0, 0.0, 10.0, 5.0, 1, None, 0.0, None, 1, 1),
    ]
    trip = spark.createDataFrame(data, cols)
    r = gap.gap_calculations(trip).first()
    assert (r.number_of_trips, r.not_routed, r.all_good, r.trips_without_path) == (4, None, 2, 1)
    assert (r.total_experienced_ttime, r.total_gap_abs, r.total_gap_min0, r.total_routed_ttime) == (1600.0, 1350.0, 1300.0, 350.0)
    binned = {b.total_experienced_ttime_bin: b.number_of_trips for b in gap.gap_calculations_binned(trip).collect()}
    assert binned == {0: 3, 20: 1}
    whole, parts = gap.gap_breakdown(trip).first().asDict(), gap.gap_breakdown_binned(trip).collect()
    for c, v in whole.items():
        assert v == (sum(p[c] for p in parts if p[c] is not None) if any(p[c] is not None for p in parts) else None)
    bins = {(g.gap_bin and round(g.gap_bin, 6), g.there_is_path): g.trip_count for g in gap.gap_bins(trip).collect()}
    assert bins[0.2, 1] == 1 and bins[0.1, 0] == 1 and bins[None, 1] == 1
    assert {(m.mode_name, m.trip_count) for m in gap.mode_count(trip).collect()} >= {(None, 1), ("MD_TRUCK", 1)}
    kept = gap.trip_log_reset(trip).collect()
    assert sorted(k.mode for k in kept) == [0, 17] and all(k.person is None and k.vehicle is None for k in kept)
    assert gap.trip_log_reset(trip, 22).count() == 2
