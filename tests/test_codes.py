"""Golden rows of the recodes, with ages, incomes and densities on their edges."""

from commuta.functions import codes
from commuta.functions.columns import finite, hash_uniform, pad_id, safe_div, strict_max, trunc_int
from commuta.operators import demand, landuse
from pyspark.sql import functions as F


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_person_classes(spark):
    cases = [  # age, worker, student -> ptype, pemploy, pstudent
        (5, 0, 0, 8, 4, 1), (6, 0, 0, 7, 4, 1), (15, 1, 0, 7, 4, 1), (16, 0, 1, 6, 3, 1), (16, 1, 0, 6, 1, 1),
        (17, 0, 0, 6, 3, 1), (18, 1, 0, 1, 1, 1), (18, 0, 0, 4, 3, 1), (19, 0, 1, 3, 3, 2), (30, 1, 1, 3, 1, 2),
        (64, 0, 0, 4, 3, 3), (65, 0, 0, 5, 3, 3), (70, 1, 0, 1, 1, 3), (40, None, None, 4, 0, 0), (None, 1, 1, 0, 0, 0),
        (-1, 0, 0, 0, 4, 1),
    ]
    df = spark.createDataFrame(cases, "age int, worker int, student int, pt int, pe int, ps int").coalesce(1)
    for got, want in ((codes.ptype(), 3), (codes.pemploy(), 4), (codes.pstudent(), 5)):
        assert values(df, got) == [c[want] for c in cases]


def test_person_type(spark):
    cases = [
        (40, 4, 0, 30, "FULLTIME_WORKER"), (40, 1, 0, 29, "PARTTIME_WORKER"), (19, 0, 3, 0, "ADULT_STUDENT"),
        (18, 0, 3, 0, "STUDENT_DRIVER"), (65, 0, 0, 0, "SENIOR"), (64, 0, 0, 0, "NONWORKER"), (16, 0, 0, 0, "STUDENT_DRIVER"),
        (15, 0, 0, 0, "SCHOOL_CHILD"), (5, 0, 0, 0, "SCHOOL_CHILD"), (4, 0, 0, 0, "PRESCHOOL"), (None, 0, 0, 0, "NONWORKER"),
        (40, 1, 0, None, "PARTTIME_WORKER"),
    ]
    df = spark.createDataFrame(cases, "age int, employment int, school_enrollment int, work_hours int, want string").coalesce(1)
    assert values(df, codes.person_type()) == [c[-1] for c in cases]


def test_column_rules(spark):
    df = spark.range(1)
    row = df.select(
        safe_div(F.lit(1.0), F.lit(0.0)), safe_div(F.lit(1), F.lit(0)), trunc_int(F.lit(-2.7)), trunc_int(F.lit(2.7)),
        strict_max(F.lit(None).cast("double"), F.lit(0.0)), strict_max(F.lit(-1.0), F.lit(0.0)),
        pad_id(F.lit("12"), 5), pad_id(F.lit("1234567"), 5), finite(F.lit(float("nan"))), finite(F.lit(float("-inf"))),
    ).first()
    assert tuple(row) == (None, None, -2, 2, None, 0.0, "00012", "1234567", None, None)


def test_hash_uniform_is_stable_and_even(spark):
    draws = spark.range(20000).select("id", hash_uniform("id", 3).alias("u"))
    again = draws.repartition(7).select("id", hash_uniform("id", 3).alias("v"))
    assert draws.join(again, "id").filter("u <> v").count() == 0
    low, high, mean = draws.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= low < 0.01 and 0.99 < high < 1 and abs(mean - 0.5) < 0.01
    assert spark.range(100).filter(hash_uniform("id", 3) == hash_uniform("id", 4)).count() == 0


def test_land_use_edges(spark):
    zones = spark.createDataFrame([("1",), ("2",)], "TAZ string")
    blocks = spark.createDataFrame([("a", "1", 4046.86), ("b", "2", 0.0)], "block_id string, TAZ string, square_meters_land double")
    incomes = [29999.0, 29999.5, 30000.0, 59999.0, 59999.5, 60000.0, 99999.5, 100000.0, None]
    households = spark.createDataFrame(
        [(i, "a", 1, x) for i, x in enumerate(incomes)] + [(99, "b", 2, 1.0), (98, None, 3, 1.0)],
        "household_id int, block_id string, workers int, income double")
    persons = spark.createDataFrame(
        [(a, 0) for a in (0, 4, 5, 19, 20, 44, 45, 61, 62, 64, 65)] + [(30, 98)], "age int, household_id int")
    jobs = spark.createDataFrame([("a", "44-45"), ("a", "32"), ("a", "99"), ("a", None), ("z", "52")], "block_id string, sector_id string")
    schools = spark.createDataFrame([("1", 10.0)], "TAZ string, enrollment double")
    colleges = spark.createDataFrame([("2", 5.0, None)], "TAZ string, full_time_enrollment double, part_time_enrollment double")
    out = {r.TAZ: r for r in landuse.land_use_table(zones, households, persons, jobs, blocks, schools, colleges).collect()}
    one, two = out["1"], out["2"]
    assert [one[c] for c in ("TOTHH", "HHINCQ1", "HHINCQ2", "HHINCQ3", "HHINCQ4")] == [9, 2, 2, 1, 1]
    assert [one[c] for c in ("TOTPOP", "AGE0004", "AGE0519", "AGE2044", "AGE4564", "AGE64P", "AGE62P")] == [11, 2, 2, 2, 4, 1, 3]
    assert [one[c] for c in ("TOTEMP", "RETEMPN", "MWTEMPN", "OTHEMPN", "FPSEMPN")] == [4, 1, 1, 1, 0]
    assert (one.TOTACRE, one.HSENROLL, one.COLLFTE, two.COLLFTE, two.COLLPTE) == (1.0, 10.0, 0.0, 5.0, 0.0)
    assert (two.TOTACRE, two.pop_density, two.PRKCST, two.area_type, two.SHPOP62P) == (0.0, None, 0.0, "5", 0.0)


def test_area_type_bins(spark):
    cases = [(0, 0, 0.0, "5"), (5, 0, 0.0, "0"), (6, 0, 1.0, "5"), (7, 0, 1.0, "4"), (30, 0, 1.0, "4"), (55, 0, 1.0, "3"),
             (100, 0, 1.0, "2"), (300, 0, 1.0, "1"), (301, 0, 1.0, "0"), (0, 4, 1.0, "4")]
    df = spark.createDataFrame(cases, "TOTPOP int, TOTEMP int, TOTACRE double, want string")
    assert landuse.area_type(df).filter("area_type <> want").count() == 0


def test_household_and_person_recode(spark, rows):
    h = spark.createDataFrame([(1, "b", 2, 1, 3, 1, "yes", 5.0), (2, "b", 1, 0, 0, 9, "??", 6.0)],
                              "household_id int, block_id string, persons int, workers int, cars int, hh_type int, sf_detached string, income double")
    assert rows(demand.household_recode(h), "household_id", "type", "housing_unit_type", "vehicles") == [(1, 4, 1, 3), (2, None, None, 0)]
    assert rows(demand.unknown_codes(h, "hh_type", demand.HOUSEHOLD_TYPES)) == [(9, 1)]
    p = spark.createDataFrame(
        [(1, 1, 1, 2, 0, 1, 0, 1, 0, 0, 10, 1, None, 0, None), (2, 1, 2, 30, 1, 0, 1, 2, 3, 40, 99, 2, 7, 8, 5)],
        "person_id int, household_id int, member_id int, age int, relate int, student int, worker int, sex int, edu int, hours int, "
        "earning int, race_id int, work_zone_id int, school_zone_id int, time_in_job int").withColumn("work_at_home", F.lit(1))
    got = rows(demand.person_recode(p), "id", "school_enrollment", "school_grade_level", "work_location_id",
               "school_location_id", "time_in_job", "telecommute_level")
    assert got == [(0, 2, 0, -1, -1, -1, 4), (1, 0, 0, 7, 8, 5, 4)]


def test_marital_status_takes_last_members(spark, rows):
    p = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, 1, 1), (4, 2, 0), (5, 3, 1), (6, 3, 2)], "person_id int, household_id int, relate int")
    assert rows(demand.marital_status(p), "person_id", "marital_status") == [(1, 5), (2, 1), (3, 1), (4, 5), (5, 1), (6, 5)]
