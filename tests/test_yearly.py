"""The yearly steps end to end on the workload tables."""

import pytest
from pyspark.sql import functions as F

from commuta.operators import skims as sk
from commuta.plans import yearly
from workload import demand as wd, landuse as wl, skims as ws


def test_build_skims(tables, spark):
    zones = ws.taz(tables)
    out = yearly.build_skims(tables.skim_raw, zones, yearly.SkimConfig(periods=["AM", "PM"]))
    n = zones.count()
    assert out["distance"].count() == n * n
    assert out["auto"].count() == n * n * 2 * len(sk.HIGHWAY_PATHS)
    assert out["transit"].count() == n * n * 2 * len(sk.TRANSIT_PATHS)
    assert out["auto"].filter("TIME is null or DIST is null or DIST <= 0").count() == 0
    assert out["coverage"].filter("problem = 'unknown zone'").count() == 0 and out["zone_offset"].count() == n


def stored(T):
    return {
        "households": wl.households(T).drop("zone"), "persons": wl.persons(T), "blocks": T.block.drop("zone"),
        "jobs": T.job.select("block_id", "sector_id"), "residential_units": T.block.select("block_id"),
    }


@pytest.fixture(scope="module")
def mapping(tables):
    return tables.block.select(F.col("block_id").alias("GEOID"), F.col("zone").cast("string").alias("zone_id"))


def test_demand_inputs(tables, mapping):
    zones = tables.zone.select(F.col("zone").cast("string").alias("TAZ"))
    out = yearly.demand_inputs(
        stored(tables), zones, mapping, "block_id", wl.schools(tables), wl.colleges(tables), ["block_id", "sector_id"])
    assert out["land_use"].agg(F.sum("TOTHH")).first()[0] == out["households"].count()
    assert out["land_use"].agg(F.sum("TOTPOP")).first()[0] == out["persons"].count()
    land = out["blocks"].filter("square_meters_land > 0").select("block_id")
    assert out["jobs"].join(land, "block_id", "left_anti").count() == 0
    assert out["jobs"].count() == tables.job.count()
    assert out["blocks"].agg(F.sum("TOTEMP")).first()[0] == tables.job.filter("sector_id is not null").count()


def test_landuse_inputs(tables, mapping):
    out = yearly.landuse_inputs(stored(tables), tables.skim_raw, mapping, "block_id")
    assert out["blocks"].count() == tables.block.count()
    checks = {r.check: r.violations for r in out["fk_check"].collect()}
    assert checks["persons.household_id"] == 0 and checks["households.block_id"] == tables.household.filter("block_id is null").count()
    assert out["travel_data"].columns == ["from_zone_id", "to_zone_id", "SOV_AM_IVT_mins", "DIST_meters"]


def spark_range(tables, start):
    return tables.spark.range(start, start + 3).select(F.col("id").alias("hhold"))


def test_population_to_demand(tables, rows):
    persons = wd.survey_persons(tables)
    locations = tables.block.select("block_id", (F.col("block_no") + 1).alias("location"))
    args = (wd.survey_households(tables).drop("zone", "location"), persons, tables.job, locations, tables.location, 0.5, 3)
    out = yearly.population_to_demand(*args)
    n = out["household"].count()
    assert 50 < n < 100 and out["person"].count() == 4 * n
    assert out["person"].join(out["household"], "household_id", "left_anti").count() == 0
    assert out["zone"].agg(F.sum("pop_households")).first()[0] == tables.household.count()
    held = out["household"].orderBy("household_id").limit(5)
    vehicles = held.select(F.col("household_id").alias("hhold")).unionByName(spark_range(tables, 10**9)).withColumn("vehicle_id", F.col("hhold") * 10)
    existing = {"households": held.withColumn("income", F.lit(-1.0)), "persons": out["person"].limit(0), "vehicles": vehicles}
    again = yearly.population_to_demand(*args, existing=existing)
    assert again["household"].filter("income = -1").count() == 5 and again["person"].count() == 4 * (n - 5)
    assert rows(again["vehicle"], "hhold") == rows(held, "household_id")


def test_next_iteration_inputs(tables):
    base = stored(tables)
    persons = base["persons"].select("person_id", "household_id", "member_id", "age")
    model = {"persons": persons.withColumnRenamed("member_id", "PNUM").withColumns({"workplace_taz": F.lit("1"), "school_taz": F.lit("2")})}
    out = yearly.next_iteration_inputs(model, {"persons": persons, "jobs": base["jobs"]}, base)
    assert set(out) == set(base) and out["jobs"] is base["jobs"] and out["blocks"] is base["blocks"]
    assert out["persons"].columns == ["person_id", "household_id", "member_id", "age", "work_zone_id", "school_zone_id"]


def test_report_suite(tables, spark, tmp_path):
    from commuta.sources.schemas import TRIP_LOG_TABLES
    from commuta.sources.writers import write_report_tables

    reports = yearly.report_suite({t: tables["fx_" + t] for t in TRIP_LOG_TABLES}, 4)
    assert len(reports) == 49
    picked = ["gap_calculations", "mode_count", "boardings_by_agency_mode", "trips_in_network_city", "TNC_Agg_Output"]
    write_report_tables({n: reports[n] for n in picked}, path=str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "gap_calculations")).count() == 1
    assert all(df.columns for df in reports.values())
