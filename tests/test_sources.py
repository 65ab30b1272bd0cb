"""Readers and writers on files of the expected shapes."""

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from commuta.operators import skims as sk
from commuta.sources import blocks, readers, schemas, writers

HEADER = "timePeriod,pathType,origin,destination," + ",".join(schemas.SKIM_MEASURES) + ",DEBUG_TEXT\n"


def skim_line(o, d, time, path="SOV", period="AM"):
    return f"{period},{path},{o},{d},{time}," + ",".join("1.5" for _ in schemas.SKIM_MEASURES[1:]) + ",x\n"


def test_read_skims_plain_gzip_and_order(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text(HEADER + skim_line("01", "2", "3.5") + skim_line("01", "2", "NaN") + skim_line("01", "2", ""))
    with gzip.open(tmp_path / "b.csv.gz", "wt") as f:
        f.write(HEADER + skim_line("01", "2", "inf") + skim_line("7", "8", "9"))
    df = readers.read_skims(spark, str(tmp_path))
    assert df.count() == 5 and dict(df.dtypes)["origin"] == "string"
    last = df.groupBy("origin", "destination").agg(F.max_by("TIME_minutes", "ordinal").alias("t"))
    assert rows(last) == [("01", "2", float("inf")), ("7", "8", 9.0)]
    one = readers.read_skims(spark, str(tmp_path / "a.csv"))
    assert [r[0] for r in one.orderBy("ordinal").select("TIME_minutes").collect()] == [3.5, None, None]


def test_value_lists_drop_bad_rows(spark, tmp_path, rows):
    (tmp_path / "v.csv").write_text("O,D,V\n1,2,3.5\n1,2\nx,2,4\n3,4,oops\n5,6,7\n")
    (tmp_path / "v.txt").write_text("1\t2\t8\n")
    good, bad = readers.read_value_list(spark, str(tmp_path / "v.csv"))
    assert rows(good, "o", "d", "value") == [(1, 2, 3.5), (5, 6, 7.0)] and rows(bad) == [("o", 2), ("value", 2)]
    good, bad = readers.read_value_list(spark, str(tmp_path / "v.txt"))
    assert rows(good, "o", "d", "value") == [(1, 2, 8.0)] and bad.count() == 0


def test_store_round_trip(spark, tmp_path, rows):
    root = str(tmp_path / "store")
    df = spark.createDataFrame([(1, "a")], "household_id int, block_id string")
    writers.write_store_table(df, root, "households", "input", 2010)
    writers.write_store_table(df.withColumn("block_id", F.lit("b")), root, "households", "output", 2015)
    writers.write_store_table(df.withColumn("block_id", F.lit("c")), root, "households", "output", 2020)
    read = lambda **k: rows(readers.read_store_table(spark, root, "households", **k))
    assert read(year=2010, base_year=2010) == [(1, "a")] == read(year=2020, base_year=2010, warm_start=True)
    assert read(year=2015, base_year=2010) == [(1, "b")] and read(year=2020, base_year=2010) == [(1, "c")]
    with pytest.raises(Exception, match="already exists"):
        writers.write_store_table(df, root, "households", "output", 2020)
    writers.write_store_table(df, root, "households", "output", 2020, replace=True)
    assert read(year=2020, base_year=2010) == [(1, "a")] and read(year=2015, base_year=2010) == [(1, "b")]
    plan = readers.read_store_table(spark, root, "households", 2015, 2010)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "year" in plan.split("PartitionFilters")[1]


def test_model_outputs_pad_ids(spark, tmp_path, rows):
    for t in schemas.MODEL_OUTPUT_TABLES:
        (tmp_path / f"final_{t}.csv").write_text("household_id,block_id,lcm_county_id\n1,484530001001000,8453\n2,8453,48453\n")
    out = readers.read_model_outputs(spark, str(tmp_path))
    assert set(out) == set(schemas.MODEL_OUTPUT_TABLES)
    assert rows(out["households"]) == [("1", "484530001001000", "08453"), ("2", "000000000008453", "48453")]


def test_result_pages(spark, tmp_path, rows):
    for i, ids in enumerate(((1, 2), (3,))):
        page = {"count": 3, "next": None, "results": [{"unitid": u, "enrollment_fall": u * 1.5, "other": "x"} for u in ids]}
        (tmp_path / f"p{i}.json").write_text(json.dumps(page))
    path = str(tmp_path)
    assert rows(readers.read_result_pages(spark, path, schemas.ENROLLMENT_ROW)) == [(1, 1.5), (2, 3.0), (3, 4.5)]
    assert tuple(readers.result_page_check(spark, path, schemas.ENROLLMENT_ROW).first()) == (3, 3, 1)
    assert rows(readers.read_result_pages(spark, path, "unitid decimal(10,2)"))[0][0] == 1
    (tmp_path / "p1.json").unlink()
    with pytest.raises(Exception, match="announce 3 rows, landed are 2"):
        readers.read_result_pages(spark, path, schemas.ENROLLMENT_ROW).collect()


def test_newest_run_then_highest_iteration(spark, tmp_path):
    import os

    for run, it, when, time in (("old", 9, 1000, 1.0), ("new", 2, 2000, 2.0), ("new", 10, 1500, 3.0)):
        folder = tmp_path / run / "ITERS" / f"it.{it}"
        folder.mkdir(parents=True)
        (folder / "skims.csv").write_text(HEADER + skim_line("1", "2", str(time)))
        os.utime(folder / "skims.csv", (when, when))
    assert [r.TIME_minutes for r in readers.read_iterated_skims(spark, str(tmp_path)).collect()] == [3.0]


def test_database_reads_must_be_split(spark):
    with pytest.raises(ValueError, match="trip"):
        readers.read_trip_log_jdbc(spark, "jdbc:none", {"trip": {"numPartitions": "4"}})


def test_small_tables(spark, tmp_path, rows):
    (tmp_path / "b.csv").write_text("InputID,TargetID\n048,7\n")
    (tmp_path / "z.csv").write_text("GEOID,zone_id\n0481,1\n0482,3\n")
    (tmp_path / "c.csv").write_text(",unitid,inst_name,x,y,full_time_enrollment,part_time_enrollment,TAZ\n0,5,A,1.5,2.5,10,,07\n")
    assert rows(readers.read_block_locations(spark, str(tmp_path / "b.csv"))) == [("048", 7)]
    check = sk.zone_order_check(sk.zone_order(readers.read_zone_index(spark, str(tmp_path / "z.csv")))).first()
    assert (check.zones, check.contiguous) == (2, 0)
    assert rows(readers.read_enrollment(spark, str(tmp_path / "c.csv"))) == [("5", "A", 1.5, 2.5, 10.0, None, "07")]


def test_latest_iteration_is_numeric(spark, tmp_path, rows):
    df = spark.createDataFrame([(f"{i}", i) for i in (2, 9, 10)], "iteration string, v int")
    df.write.partitionBy("iteration").parquet(str(tmp_path / "it"))
    assert rows(readers.latest_iteration(spark.read.parquet(str(tmp_path / "it"))), "v") == [(10,)]


def test_csv_and_table_sinks(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, t string")
    writers.write_csv_tables({"x": df}, str(tmp_path), gzip=True)
    assert list((tmp_path / "x").glob("*.csv.gz"))
    assert rows(spark.read.csv(str(tmp_path / "x"), header=True)) == [("1", "a"), ("2", None)]
    writers.write_report_tables({"r": df}, path=str(tmp_path / "reports"))
    assert rows(spark.read.parquet(str(tmp_path / "reports" / "r"))) == rows(df)
    skims = spark.createDataFrame([("AM", "SOV", "1", "2", 3.0)], "timePeriod string, pathType string, origin string, destination string, TIME double")
    writers.write_skims(skims, str(tmp_path / "skims"))
    assert (tmp_path / "skims" / "timePeriod=AM" / "pathType=SOV").exists()
    zones = spark.createDataFrame([("1", 1), ("2", 2)], "zone_id string, idx int")
    full = sk.od_complete(skims, zones, {"timePeriod": ["AM"], "pathType": ["SOV"]}, ["TIME"])
    writers.write_matrices(sk.matrix_export(sk.pack_wide(full, zones)), str(tmp_path / "m"))
    assert rows(spark.read.parquet(str(tmp_path / "m"))) == [("SOV_TIME__AM", 1, [0.0, 3.0]), ("SOV_TIME__AM", 2, [0.0, 0.0])]


def test_trip_log(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "trip"))
    assert readers.read_trip_log(spark, str(tmp_path), ["trip"])["trip"].count() == 3


def test_a_table_can_be_replaced_by_what_is_read_from_it(spark, tmp_path, rows):
    root = str(tmp_path / "store")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "household_id int, block_id string")
    for stage, year in (("input", 2010), ("output", 2015), ("output", 2020)):
        writers.write_store_table(df, root, "households", stage, year)
    read = lambda **k: readers.read_store_table(spark, root, "households", **k)
    for _ in range(3):
        old = read(year=2015, base_year=2010)
        writers.write_store_table(old.withColumn("household_id", F.col("household_id") + 1), root, "households", "output", 2015, replace=True)
        assert old.count() == 2  # the version that it was read from is still there
    assert rows(read(year=2015, base_year=2010)) == [(4, "a"), (5, "b")]
    assert rows(read(year=2020, base_year=2010)) == [(1, "a"), (2, "b")] == rows(read(year=2010, base_year=2010))
    assert len(read(year=2015, base_year=2010).inputFiles()) <= 2
    # A job that ends before its rows are all there leaves the version before it.
    fails = read(year=2015, base_year=2010).withColumn("block_id", F.raise_error(F.lit("ended")).cast("string"))
    with pytest.raises(Exception, match="ended"):
        writers.write_store_table(fails, root, "households", "output", 2015, replace=True)
    assert rows(read(year=2015, base_year=2010)) == [(4, "a"), (5, "b")]
    writers.write_store_table(df, root, "persons", "input", 2010, replace=True)  # no plain folder at all
    assert rows(readers.read_store_table(spark, root, "persons")) == [(1, "a"), (2, "b")]
    writers.write_store_table(read().filter("household_id = 1"), root, "households", "input", 2010, replace=True)
    assert rows(read(warm_start=True)) == [(1, "a")]


def test_only_the_newest_iteration_is_read(spark, tmp_path):
    for run, it in (("a", 1), ("a", 3), ("b", 2)):
        folder = tmp_path / run / "ITERS" / f"it.{it}"
        folder.mkdir(parents=True)
        (folder / "skims.csv").write_text(HEADER + skim_line("1", "2", "1.0"))
        os.utime(folder / "skims.csv", (1000 + it, 1000 + it))
    read = readers.read_iterated_skims(spark, str(tmp_path))
    assert [f.split("/a/")[1] for f in read.inputFiles()] == ["ITERS/it.3/skims.csv"]
    assert read._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    (tmp_path / "empty" / "x" / "ITERS" / "it.1").mkdir(parents=True)
    with pytest.raises(FileNotFoundError):
        readers.read_iterated_skims(spark, str(tmp_path / "empty"))


def test_matrix_blocks_as_text(spark, tmp_path):
    zones = spark.createDataFrame([(1,), (2,), (10,)], "zone bigint")
    cells = spark.createDataFrame([(720, 1, 2, 3.5, 1.0), (720, 1, 10, 4.0, None), (60, 10, 1, 0.25, 2.0), (60, 99, 1, 9.0, 9.0)], "interval_end int, o bigint, d bigint, time double, cost double")
    blocks.write_matrix_blocks(cells, zones, zones, ["time", "cost"], str(tmp_path / "m"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "m").glob("part-*")))
    assert text == (
        "Auto TTime for interval60\n,1,2,10,\n1,,,,\n2,,,,\n10,0.25,,,\n\nAuto Cost ($) for interval60\n,1,2,10,\n1,,,,\n2,,,,\n10,2.0,,,\n\n"
        "Auto TTime for interval720\n,1,2,10,\n1,,3.5,4.0,\n2,,,,\n10,,,,\n\nAuto Cost ($) for interval720\n,1,2,10,\n1,,1.0,,\n2,,,,\n10,,,,\n\n"
    )
    got = sorted(tuple(r) for r in blocks.read_matrix_blocks(spark, str(tmp_path / "m")).collect())
    assert got == [("AUTO", "cost", 60, 10, 1, 2.0), ("AUTO", "cost", 720, 1, 2, 1.0), ("AUTO", "time", 60, 10, 1, 0.25), ("AUTO", "time", 720, 1, 2, 3.5), ("AUTO", "time", 720, 1, 10, 4.0)]


def test_blocks_go_on_over_splits(spark, tmp_path):
    """Splits far smaller than a block: titles and destinations come from splits before."""
    zones = list(range(1, 41))
    lines = []
    for mode, t in (("BUS", 60), ("RAIL", 720)):
        lines += [f"{mode} Transit Fare Skim @{t}", "," + "".join(f"{z}," for z in zones)]
        lines += [f"{o}," + "".join(f"{o * 100 + d}.5," for d in zones) for o in zones] + [""]
    (tmp_path / "t.csv").write_text("\n".join(lines) + "\n")
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        read = blocks.read_matrix_blocks(spark, str(tmp_path / "t.csv"))
        got = sorted((r.mode, r.measure, r.interval_end, r.o, r.d, r.value) for r in read.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    assert got == sorted((m, "fare", t, o, d, o * 100 + d + 0.5) for m, t in (("BUS", 60), ("RAIL", 720)) for o in zones for d in zones)
    (tmp_path / "bad.csv").write_text("Something else 5\n,1,\n1,2.0,\n")
    with pytest.raises(Exception, match="unknown block title"):
        blocks.read_matrix_blocks(spark, str(tmp_path / "bad.csv")).collect()


def test_skims_are_dealt_by_slice_before_they_are_written(spark, tmp_path):
    """Tasks that hold rows of all slices would sort all they hold and write a file for each slice."""
    df = spark.range(800).selectExpr("if(id % 2 = 0, 'AM', 'PM') as timePeriod", "'SOV' as pathType", "id").repartition(8)
    writers.write_skims(df, str(tmp_path / "skims"))
    assert len(list((tmp_path / "skims").rglob("*.parquet"))) <= 4
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "skims")).collect()) == list(range(800))


def test_dealt_matrices_are_written_in_parts_as_they_come(spark, tmp_path):
    """Parts of consecutive rows, as of rows dealt when they are written; but only given cells are shuffled and sorted."""
    zones = spark.createDataFrame([(str(i), i) for i in range(1, 12)], "zone_id string, idx int")
    wide = spark.createDataFrame([(p, "SOV", str(o), str(11 - o), o * 1.0) for p in ("AM", "PM") for o in (1, 4, 10)],
                                 "timePeriod string, pathType string, origin string, destination string, v double")
    packed = sk.matrix_export(sk.pack_wide(wide, zones, rows_per_part=3))
    plan = packed._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.rindex("array_repeat")]
    assert "Exchange" not in above and "Sort " not in above
    writers.write_matrices(packed, str(tmp_path / "dealt"), 3, dealt=True)
    writers.write_matrices(sk.matrix_export(sk.pack_wide(wide, zones)), str(tmp_path / "sorted"), 3)
    found = {}
    for kind in ("dealt", "sorted"):
        read = spark.read.parquet(str(tmp_path / kind)).select("*", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at")).orderBy("at").collect()
        parts, files = {}, {}
        for r in read:
            files.setdefault((r.name, (r.o_idx - 1) // 3), set()).add(r.file)
            parts.setdefault(r.file, []).append((r.name, r.o_idx))
        assert len(files) == 8 and all(len(f) == 1 for f in files.values()) and all(p == sorted(p) for p in parts.values())
        found[kind] = sorted((r.name, r.o_idx, r["values"]) for r in read)
    assert found["dealt"] == found["sorted"] and len(found["dealt"]) == 22


@pytest.mark.parametrize("dealt", [False, True])
def test_few_matrix_rows_are_read_together(spark, tmp_path, dealt):
    """Row groups are cut by rows: rows of empty cells are long where they are read, and nothing in a file."""
    from pyarrow import parquet

    zones = spark.range(1, 101).select(F.col("id").cast("string").alias("zone_id"), F.col("id").cast("int").alias("idx"))
    wide = spark.createDataFrame([("AM", "SOV", "7", "3", 1.5)], "timePeriod string, pathType string, origin string, destination string, v double")
    matrices = sk.matrix_export(sk.pack_wide(wide, zones, *[writers.ROWS_PER_PART] * dealt))
    writers.write_matrices(matrices, str(tmp_path / "m"), dealt=dealt)
    groups = [f.metadata.row_group(i).num_rows for f in map(parquet.ParquetFile, (tmp_path / "m").glob("*.parquet")) for i in range(f.num_row_groups)]
    assert sum(groups) == 100 and max(groups) <= writers.ROWS_PER_GROUP
    read = {r.o_idx: r["values"] for r in spark.read.parquet(str(tmp_path / "m")).collect()}
    assert len(read) == 100 and read[7] == [None, None, 1.5, *[None] * 97] and read[8] == [None] * 100
