"""Round trips through every source and sink: given tables are written in the expected layout and read back."""

import uuid

from pyspark.sql import functions as F

from commuta.operators import landuse as lu, skims as sk
from commuta.operators.lineage import shared_folder
from commuta.plans import gap
from commuta.sources import blocks, readers, schemas, writers
from workload.landuse import households
from workload.registry import add
from workload.reports_gap import GAP_BINS
from workload.skims import MEASURES, highway, taz


def folder(T):
    """A folder of its own for each run, where all executors see it."""
    return f"{shared_folder(T.spark)}/source-{uuid.uuid4().hex}"


SKIM_COLUMNS = ["timePeriod", "pathType", "origin", "destination", *schemas.SKIM_MEASURES]


def skim_csv(T, gzip):
    path = folder(T)
    writers.write_csv(T.skim_raw.select(*SKIM_COLUMNS, F.lit("x").alias("DEBUG_TEXT")), path, gzip=gzip)
    return readers.read_skims(T.spark, path).drop("ordinal")


for name, gzip in (("plain", False), ("gzip", True)):
    add(f"s01_skim_csv_{name}", lambda T, gzip=gzip: skim_csv(T, gzip), f"select {', '.join(SKIM_COLUMNS)}, 'x' as DEBUG_TEXT from fx_skim_raw")


def iterated(T):
    """One run with two iterations, read at its highest."""
    root = folder(T)
    rows = T.skim_raw.select(*SKIM_COLUMNS, F.lit("x").alias("DEBUG_TEXT"))
    for iteration, period in ((2, "AM"), (10, "PM")):
        writers.write_csv(rows.filter(F.col("timePeriod") == period), f"{root}/run/ITERS/it.{iteration}")
    return readers.read_iterated_skims(T.spark, root).drop("ordinal")


add("s02_latest_iteration", iterated, f"select {', '.join(SKIM_COLUMNS)}, 'x' as DEBUG_TEXT from fx_skim_raw where timePeriod = 'PM'")


def stored(T, **which):
    root = folder(T)
    rows = households(T).select("household_id", "block_id", "income")
    writers.write_store_table(rows, root, "households", "input", 2010)
    writers.write_store_table(rows.filter("income > 1000"), root, "households", "output", 2015)
    return readers.read_store_table(T.spark, root, "households", base_year=2010, **which)


add("s03_store_table_output", lambda T: stored(T, year=2015), "select household as household_id, block_id, income from fx_household where income > 1000")
add("s03_store_table_warm_start", lambda T: stored(T, year=2015, warm_start=True), "select household as household_id, block_id, income from fx_household")


def store_updated(T):
    """A stored table read, changed and replaced by what has been read from it, twice."""
    root = folder(T)
    rows = households(T).select("household_id", "block_id", "income")
    writers.write_store_table(rows, root, "households", "output", 2015)
    for least in (1000, 2000):
        read = readers.read_store_table(T.spark, root, "households", 2015, 2010)
        writers.write_store_table(read.filter(F.col("income") > least).withColumn("income", F.col("income") * 2), root, "households", "output", 2015, replace=True)
    return readers.read_store_table(T.spark, root, "households", 2015, 2010)


add("s03_store_table_replaced", store_updated, """
    select household as household_id, block_id, income * 4 as income from fx_household where income > 1000 and income * 2 > 2000""")


def model_outputs(T):
    root = folder(T)
    rows = T.block.select((F.col("block_no") + 1).alias("household_id"), F.col("block_no").alias("block_id"), (F.col("zone") * 997).alias("lcm_county_id"))
    writers.write_csv(rows, f"{root}/final_households.csv")
    return readers.read_model_outputs(T.spark, root, ["households"])["households"]


add("s04_model_outputs", model_outputs, """
    select cast(block_no + 1 as varchar) as household_id, lpad(cast(block_no as varchar), 15, '0') as block_id,
        case when length(cast(zone * 997 as varchar)) >= 5 then cast(zone * 997 as varchar) else lpad(cast(zone * 997 as varchar), 5, '0') end as lcm_county_id
    from fx_block""")


def trip_log(T):
    root = folder(T)
    T.trip.write.parquet(f"{root}/trip")
    return readers.read_trip_log(T.spark, root, ["trip"])["trip"].select("trip_id", "person", "mode", "start_s", "end_s")


add("s05_trip_log", trip_log, "select trip_id, person, mode, start_s, end_s from fx_trip")


def block_locations(T):
    path = folder(T)
    writers.write_csv(T.block.select(F.col("block_id").alias("InputID"), (F.col("block_no") + 1).alias("TargetID")), path)
    return readers.read_block_locations(T.spark, path)


add("s06_block_locations", block_locations, "select block_id, block_no + 1 as location from fx_block")


def zone_ids(T):
    path = folder(T)
    writers.write_csv(sk.zone_index(T.block, "block_group"), path)
    return readers.read_zone_index(T.spark, path)


add("s07_zone_index", zone_ids, """
    select g as GEOID, cast(row_number() over (order by g) as varchar) as zone_id from (select distinct substr(block_id, 1, 12) as g from fx_block)""")


def enrollment(T):
    path = folder(T)
    rows = T.location.select("location", F.concat(F.lit("0"), "location").alias("ncessch"), (F.col("zone") / 4).alias("x"), F.col("area_type").alias("enrollment"), F.col("zone").cast("string").alias("TAZ"))
    writers.write_csv(rows.withColumnRenamed("location", ""), path)  # the unnamed index column of some regions
    return readers.read_enrollment(T.spark, path)


add("s08_enrollment", enrollment, """
    select concat('0', location) as ncessch, zone / 4 as x, area_type::double as enrollment, cast(zone as varchar) as TAZ from fx_location""")


def landed(T, pages):
    """JSON documents, one file each."""
    path = folder(T)
    pages.write.partitionBy("page").text(path)
    return f"{path}/*"


def features(T):
    attributes = F.struct(F.col("block_id").alias("GEOID"), F.lit("48").alias("STATE"), F.col("zone").cast("string").alias("TRACT"))
    corner = [F.array(F.col("x") + dx, F.col("y") + dy) for dx, dy in ((0, 0), (1, 0), (1, 1), (0, 0))]
    feature = F.struct(attributes.alias("attributes"), F.struct(F.array(F.array(*corner)).alias("rings")).alias("geometry"))
    pages = T.block.groupBy(F.expr("block_no div 200").alias("page")).agg(F.to_json(F.struct(F.collect_list(feature).alias("features"))).alias("value"))
    from commuta.operators.geo import block_features

    rows = block_features(readers.read_feature_pages(T.spark, landed(T, pages)))
    point = F.col("geometry")[0]["points"][1]
    return rows.select("GEOID", "STATE", "COUNTY", "TRACT", F.size("geometry").alias("rings"), point["x"].alias("x"), point["y"].alias("y"))


add("s09_feature_pages", features, """
    select block_id as GEOID, '48' as STATE, null::varchar as COUNTY, cast(zone as varchar) as TRACT, 1 as rings, round(x + 1, 6) as x, round(y, 6) as y from fx_block""")


def result_pages(T):
    announced = T.location.agg(F.count("*")).scalar()
    row = F.struct(F.col("location").alias("unitid"), (F.col("zone") * 1.5).cast("double").alias("enrollment_fall"))
    pages = T.location.groupBy(F.expr("location div 200").alias("page")).agg(F.collect_list(row).alias("results"))
    text = F.to_json(F.struct(announced.alias("count"), F.lit("more").alias("next"), "results"))
    return readers.read_result_pages(T.spark, landed(T, pages.select("page", text.alias("value"))), schemas.ENROLLMENT_ROW)


add("s10_result_pages", result_pages, "select location as unitid, zone * 1.5::double as enrollment_fall from fx_location")


def value_list(T):
    path = folder(T)
    rows = T.interval_skim.select("o", F.when(F.col("d") % 7 == 0, F.lit("?")).otherwise(F.col("d").cast("string")).alias("d"), "time")
    writers.write_csv(rows, path, header=False)
    return readers.read_value_list(T.spark, path)


add("s11_value_list", lambda T: value_list(T)[0].drop("ordinal"), "select o, d, time as value from fx_interval_skim where d % 7 <> 0")
add("s11_value_list_rejects", lambda T: value_list(T)[1], "select 'd' as problem, count(*) as \"rows\" from fx_interval_skim where d % 7 = 0 having count(*) > 0")


def wide_matrices(T):
    path = folder(T)
    writers.write_skims(T.skim_raw.select(*SKIM_COLUMNS), path)
    return T.spark.read.parquet(path).filter("timePeriod = 'AM' and pathType = 'SOV'").select("origin", "destination", *MEASURES)


add("s12_wide_skims", wide_matrices, f"select origin, destination, {', '.join(MEASURES)} from fx_skim_raw where timePeriod = 'AM' and pathType = 'SOV'")


def dense_matrices(T):
    path = folder(T)
    rows = highway(T).filter("timePeriod = 'EV'").select("timePeriod", "pathType", "origin", "destination", "TIME_minutes")
    writers.write_matrices(sk.matrix_export(sk.pack_wide(rows, taz(T), rows_per_part=writers.ROWS_PER_PART)), path, dealt=True)
    return T.spark.read.parquet(path).select("name", "o_idx", F.posexplode("values").alias("pos", "value")).withColumn("pos", F.col("pos") + 1)


add("s13_dense_matrices", dense_matrices, """
    select 'SOV_TIME_minutes__EV' as name, o.idx as o_idx, cast(d.idx as int) as pos, nullif(s.TIME_minutes, 0) as value
    from fx_taz o cross join fx_taz d left join (select * from fx_skim_raw where timePeriod = 'EV' and pathType = 'SOV') s
    on s.origin = o.zone_id and s.destination = d.zone_id""")


def report_tables(T):
    path = folder(T)
    writers.write_report_tables({"gap_bins": gap.gap_bins(T.trip), "households": households(T).select("household_id", "income")}, path=path)
    return T.spark.read.parquet(f"{path}/households").withColumn("name", F.lit("households")).unionByName(
        T.spark.read.parquet(f"{path}/gap_bins").withColumn("name", F.lit("gap_bins")), allowMissingColumns=True)


add("s14_report_tables", report_tables, f"""
    select household as household_id, income, 'households' as name from fx_household
    union all by name select *, 'gap_bins' as name from ({GAP_BINS})""")


def csv_tables(T):
    path = folder(T)
    writers.write_csv_tables({"blocks": T.block.select("block_id", "block_no", "x"), "zones": T.zone}, path, gzip=True)
    rows = lu.padded_ids(T.spark.read.csv(f"{path}/blocks", header=True), {"block_no": 6})
    zones = T.spark.read.csv(f"{path}/zones", header=True).select("zone")
    return rows.unionByName(zones, allowMissingColumns=True)


add("s15_csv_tables", csv_tables, "select block_id, lpad(cast(block_no as varchar), 6, '0') as block_no, cast(x as varchar) as x from fx_block union all by name select cast(zone as varchar) as zone from fx_zone")


def matrix_blocks(T):
    """Drive and transit matrices between blocks' zones and locations' zones, as text blocks and back."""
    path = folder(T)
    ends = T.block.select("zone").distinct(), T.location.select("zone").distinct()
    blocks.write_matrix_blocks(T.interval_skim, *ends, ["time", "distance", "cost"], f"{path}/auto")
    modes = T.interval_skim.withColumn("mode", F.explode(F.array(F.lit("BUS"), F.lit("RAIL"))))
    blocks.write_matrix_blocks(modes, *ends, ["ivtt", "fare"], f"{path}/transit", transit=True)
    return blocks.read_matrix_blocks(T.spark, f"{path}/auto").unionByName(blocks.read_matrix_blocks(T.spark, f"{path}/transit"))


add("s16_matrix_blocks", matrix_blocks, """
    with kept as (select * from fx_interval_skim where o in (select zone from fx_block) and d in (select zone from fx_location))
    select 'AUTO' as mode, measure, interval_end::bigint as interval_end, o, d, value from
        (select interval_end, o, d, unnest(['time', 'distance', 'cost']) as measure, unnest([time, distance, cost]) as value from kept)
    union all select mode, measure, interval_end::bigint, o, d, value from
        (select interval_end, o, d, unnest(['ivtt', 'fare']) as measure, unnest([ivtt, fare]) as value from kept)
        cross join (select unnest(['BUS', 'RAIL']) as mode)""")
