"""Declared schemas of the inputs, so that no reader has to scan a file to guess types."""

from __future__ import annotations

# Measure columns of a long skim file.
SKIM_MEASURES = [
    "TIME_minutes", "TOTIVT_IVT_minutes", "VTOLL_FAR", "DIST_meters", "WACC_minutes", "WAUX_minutes", "WEGR_minutes",
    "DTIM_minutes", "DDIST_meters", "KEYIVT_minutes", "FERRYIVT_minutes", "BOARDS",
]
SKIMS = ", ".join(
    [f"{k} string" for k in ("timePeriod", "pathType", "origin", "destination")]
    + [f"{m} double" for m in SKIM_MEASURES]
    + ["DEBUG_TEXT string"]
)
ZONE_INDEX = "GEOID string, zone_id string"
BLOCK_LOCATION = "InputID string, TargetID bigint"
VALUE_LIST = "o string, d string, value string"
FEATURE_PAGE = (
    "features array<struct<attributes: struct<GEOID: string, STATE: string, COUNTY: string, TRACT: string, "
    "BLKGRP: string, CENTLAT: string, CENTLON: string>, geometry: struct<rings: array<array<array<double>>>>>>"
)
SCHOOL_ROW = "ncessch string, county_code string, latitude double, longitude double, enrollment double"
COLLEGE_ROW = "unitid bigint, inst_name string, longitude double, latitude double"
ENROLLMENT_ROW = "unitid bigint, enrollment_fall double"

# Tables of the simulated trip log and the supply tables read beside them.
TRIP_LOG_TABLES = [
    "trip", "activity", "person", "household", "tnc_trip", "vehicle", "vehicle_type", "path_multimodal",
    "path_multimodal_links", "transit_vehicle", "transit_vehicle_links", "location", "zone", "transit_trips",
    "transit_patterns", "transit_routes", "transit_agencies", "transit_links", "transit_stops",
]
# Demand-model output tables, their file prefix, and id columns with their widths.
MODEL_OUTPUT_TABLES = [
    "checkpoints", "land_use", "households", "persons", "tours", "trips", "joint_tour_participants", "plans",
]
MODEL_OUTPUT_PREFIX = "final_"
ID_WIDTHS = {"block_id": 15, "lcm_county_id": 5}
