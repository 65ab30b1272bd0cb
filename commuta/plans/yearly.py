"""The yearly steps end to end, each from DataFrames to DataFrames."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commuta.operators import demand, landuse, merge, skims as sk
from commuta.operators.joins import lookup
from commuta.operators.lineage import cut_lineage
from commuta.plans import activity, gap, ridehail, transit


@dataclass
class SkimConfig:
    """Which matrices a skim build makes."""

    periods: list[str] = field(default_factory=lambda: list(sk.PERIODS))
    highway_paths: list[str] = field(default_factory=lambda: list(sk.HIGHWAY_PATHS))
    transit_paths: list[str] = field(default_factory=lambda: list(sk.TRANSIT_PATHS))
    highway_measures: dict[str, str | None] = field(default_factory=lambda: dict(sk.HIGHWAY_MEASURES))
    transit_measures: dict[str, str | None] = field(default_factory=lambda: dict(sk.TRANSIT_MEASURES))
    by_path: bool = False


def build_skims(raw: DataFrame, zones: DataFrame, config: SkimConfig | None = None) -> dict[str, DataFrame]:
    """Raw skims to distance, drive and transit skims in wide form and as matrices, plus coverage, modes
    without rows and the zone offset map.

    Packed distances are checkpointed: they are a result of their own and fill the drive skims.
    """
    c = config or SkimConfig()
    highway, public = sk.split_by_mode(sk.skim_clean(raw), c.highway_paths, c.transit_paths)
    packed = cut_lineage(sk.pack_distance(highway, zones))
    auto = sk.pack_auto(highway, packed, zones, c.periods, c.highway_paths, c.highway_measures, c.by_path)
    transit = sk.pack_transit(public, zones, c.periods, c.transit_paths, c.transit_measures)
    distance = sk.unpack_od(packed, zones).withColumns({m: F.col("DIST") for m in ("DISTBIKE", "DISTWALK")})
    return {
        "coverage": sk.zone_coverage(raw, zones),
        "absent_modes": sk.absent_modes(raw, c.highway_paths, c.transit_paths),
        "distance": distance,
        "auto": sk.unpack_od(auto, zones),
        "transit": sk.unpack_od(transit, zones),
        "matrices": sk.distance_matrices(packed).unionByName(sk.matrix_export(auto)).unionByName(sk.matrix_export(transit)),
        "zone_offset": zones.select("zone_id", "idx"),
    }


def demand_inputs(
    tables: dict[str, DataFrame], zones: DataFrame, mapping: DataFrame, geoid: str, schools: DataFrame,
    colleges: DataFrame, job_key: list[str],
) -> dict[str, DataFrame]:
    """Stored population tables to the demand model's households, persons, jobs, blocks and land use."""
    blocks = landuse.block_zone_map(
        landuse.block_totals(tables["blocks"], tables["households"], tables["jobs"]), mapping, geoid
    )
    jobs = landuse.assign_zone(tables["jobs"], blocks, "block_id", unzoned="keep")
    return {
        "blocks": blocks,
        "households": landuse.household_table(tables["households"], blocks),
        "persons": landuse.person_table(tables["persons"], tables["households"], blocks),
        "jobs": landuse.relocate_jobs(jobs, blocks),
        "land_use": landuse.land_use_table(
            zones, tables["households"], tables["persons"], tables["jobs"], blocks, schools, colleges
        ),
    }


def landuse_inputs(
    tables: dict[str, DataFrame], skims: DataFrame, mapping: DataFrame, geoid: str, zone_map: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Travel data and zoned blocks for the land-use model, with the reference check of its tables."""
    blocks = landuse.block_zone_map(tables["blocks"], mapping, geoid, unmapped="drop")
    return {
        "travel_data": sk.landuse_travel_data(skims, zone_map),
        "blocks": blocks,
        "fk_check": landuse.fk_check(
            tables["households"], tables["persons"], tables["jobs"], tables["residential_units"], blocks
        ),
    }


def population_to_demand(
    households: DataFrame, persons: DataFrame, jobs: DataFrame, block_location: DataFrame, location: DataFrame,
    fraction: float, seed: int, existing: dict[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """Place, sample and recode the population; ``existing`` demand households keep their records.

    Vehicles (vehicle_id, hhold) are those of the existing households that were drawn. Zone
    attributes cover all households, sampled or not.
    """
    block_zone = demand.block_location_zone(block_location, location)
    placed = demand.place_unplaced(households, block_zone, seed)
    drawn = demand.sample_households(placed, fraction, seed + 1)
    homes = lookup(drawn, block_zone, ["block_id"], how="inner")
    recoded = demand.household_recode(homes).join(homes.select("household_id", "location", "zone"), "household_id")
    married = demand.marital_status(persons).select("person_id", "marital_status")
    members = demand.person_recode(demand.members_of(persons, drawn)).drop("marital_status").join(married, "person_id")
    if existing is not None:
        kept = existing["households"]
        members = demand.merge_members(members, existing["persons"], recoded, kept)
        recoded = demand.merge_households(recoded, kept)
    owned = {}
    if existing is not None and "vehicles" in existing:
        vehicles = existing["vehicles"].withColumn("household_id", F.col("hhold"))
        owned = {"vehicle": demand.members_of(vehicles, recoded).drop("household_id")}
    return {
        "household": recoded, "person": members, **owned,
        "zone": demand.zone_attributes(placed, persons, jobs, block_zone),
    }


def next_iteration_inputs(
    model: dict[str, DataFrame], landuse_outputs: dict[str, DataFrame], previous: dict[str, DataFrame]
) -> dict[str, DataFrame]:
    """Tables of the next land-use input: demand-model updates in stored form, else that year's outputs, else the previous inputs."""
    rules = {
        "persons": (landuse.PERSON_RENAMES, landuse.PERSON_REPLACED),
        "households": (landuse.HOUSEHOLD_RENAMES, landuse.HOUSEHOLD_REPLACED),
    }
    updated = {
        name: landuse.conform(model[name], landuse_outputs[name].schema, *rule)
        for name, rule in rules.items() if name in model
    }
    return merge.table_precedence(updated, landuse_outputs, previous, required=list(previous))


def report_suite(t: dict[str, DataFrame], expansion: float = 4) -> dict[str, DataFrame]:
    """Every report table of the trip log by its table name, lazily.

    What several reports read is made at once and kept: the sums of the trip log's convergence reports, the agency of each vehicle trip, modes by area, and waits per path.
    """
    agency = cut_lineage(transit.vehicle_agency(
        t["transit_trips"], t["transit_patterns"], t["transit_routes"], t["transit_agencies"]
    ))
    trip, act, person, household = t["trip"], t["activity"], t["person"], t["household"]
    location, zone, tnc, path = t["location"], t["zone"], t["tnc_trip"], t["path_multimodal"]
    links, legs, vehicle, x = t["transit_vehicle_links"], t["path_multimodal_links"], t["transit_vehicle"], expansion
    gaps = gap.gap_reports(trip, x)
    by_area = cut_lineage(activity.executed_activity_mode_share_by_area(act, person, trip, location, zone, x))
    by_vehicle = cut_lineage(transit.ivtt_wait_by_path_and_vehicle(legs))
    by_path = cut_lineage(transit.ivtt_wait_by_path(by_vehicle, path))
    return {
        "person_distribution": activity.person_distribution(person),
        "activity_distribution": activity.activity_distribution(person, act),
        "activity_rate_distribution": activity.activity_rate_distribution(person, act),
        "activity_Start_Distribution": activity.activity_start_distribution(act, x),
        "vmt_vht_by_mode": activity.vmt_vht_by_mode(trip, x),
        "vmt_vht_by_mode_city": activity.vmt_vht_by_mode_city(trip, location, zone, x),
        "trips_in_network_city": activity.trips_in_network_city(trip, tnc, location, x),
        "planned_activity_mode_share": activity.planned_activity_mode_share(act, person, x),
        "executed_activity_mode_share": activity.executed_activity_mode_share(act, person, trip, x),
        "executed_activity_mode_share_fails": activity.executed_activity_mode_share_fails(act, person, x),
        "planned_activity_mode_share_by_area": activity.planned_activity_mode_share_by_area(act, person, location, zone, x),
        "executed_activity_mode_share_by_area": by_area,
        "executed_activity_dist_by_area": activity.executed_activity_dist_by_area(by_area),
        "executed_activity_dist_by_area_city": activity.executed_activity_dist_by_area_city(by_area),
        "ttime_By_ACT_Average": activity.ttime_by_act_average(trip, act, person, household, x),
        "ttime_By_ACT_Average_w_skims": activity.ttime_by_act_average_w_skims(trip, act, person, household, x),
        "ttime_By_ACT_Average_w_skims_hway": activity.ttime_by_act_average_w_skims_hway(trip, act, person, household, x),
        "mode_Distribution_ADULT": activity.mode_distribution_adult(trip, person, household, x),
        "employment_validation": activity.employment_validation(person, location, zone, x),
        "boardings_by_agency_mode": transit.boardings_by_agency_mode(links, agency, vehicle, x),
        "boardings_by_agency_and_trip_mode": transit.boardings_by_agency_and_trip_mode(legs, path, trip, agency, x),
        "boardings_by_agency_mode_time": transit.boardings_by_agency_mode_time(links, agency, vehicle, x),
        "boardings_by_agency_mode_area_type": transit.boardings_by_agency_mode_area_type(
            links, agency, vehicle, t["transit_links"], t["transit_stops"], zone, x),
        "transit_occupancy": transit.transit_occupancy(links, agency, vehicle, x),
        "act_wait_count": transit.act_wait_count(path, x),
        "avg_wait_and_total_time": transit.avg_wait_and_total_time(path),
        "cta_IVTT_Wait_path_id_trip_id": by_vehicle,
        "cta_IVTT_Wait_path_id_trips_aggregated": by_path,
        "avg_wait_and_total_time_cta": transit.avg_wait_and_total_time_by_path(by_path, x),
        "transit_trips_wo_boarding_count": transit.transit_trips_wo_boarding_count(path, x),
        "transit_trips_with_boarding_count": transit.transit_trips_with_boarding_count(path, x),
        "transit_transfers_with_gen_cost": transit.transit_transfers_with_gen_cost(path, x),
        "transit_transfers": transit.transit_transfers(path, x),
**{name: gaps[made] for name, made in {
            "gap_calculations": "gap_calculations", "gap_calculations_binned": "gap_calculations_binned", "artificial_count": "artificial_count",
            "there_is_path": "there_is_path", "gap_bins": "gap_bins", "greater_routed_time": "greater_routed_time", "mode_count": "mode_count_baseline",
            "Person_Gaps": "person_gaps", "gap_breakdown": "gap_breakdown", "gap_breakdown_binned": "gap_breakdown_binned",
        }.items()},
        "TNC_Agg_Output": ridehail.tnc_agg_output(trip, tnc, links),
        "TNC_AVO_Revenue_by_TOD": ridehail.tnc_avo_revenue_by_tod(tnc),
        "TNC_AVO_Dist_by_TOD": ridehail.tnc_avo_dist_by_tod(tnc),
        "TNC_Delay_Histogram": ridehail.tnc_delay_histogram(trip),
        "TNC_Demand_by_TOD": ridehail.tnc_demand_by_tod(trip),
        "TNC_Response_By_TOD": ridehail.tnc_response_by_tod(tnc),
    }
