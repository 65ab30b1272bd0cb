"""Rules of the skim operators that the SQL comparison does not reach."""

import pytest
from pyspark.sql import functions as F

from commuta.operators import merge, skims as sk
from workload import skims as queries

SCHEMA = "timePeriod string, origin string, destination string, v double"


@pytest.fixture(scope="module")
def zones(spark):
    return spark.createDataFrame([(str(i), i, -98 + i / 10, 30.0) for i in range(1, 6)], "zone_id string, idx int, cx double, cy double")


def test_od_complete_is_square_and_filled(spark, zones, rows):
    df = spark.createDataFrame([("AM", "1", "2", 3.0), ("AM", "5", "5", None), ("XX", "9", "9", 1.0)], SCHEMA)
    out = sk.od_complete(df, zones, {"timePeriod": ["AM", "PM"]}, ["v"], fill=7.0)
    assert rows(out.groupBy("timePeriod").agg(F.count("*"), F.sum("v"))) == [("AM", 25, 171.0), ("PM", 25, 175.0)]
    assert out.select("timePeriod", "origin", "destination").distinct().count() == 50
    assert out.filter("origin = '1' and destination = '2' and timePeriod = 'AM'").first().v == 3.0


@pytest.mark.parametrize("bad, message", [
    ([("AM", "1", "2", 1.0), ("AM", "1", "2", 1.0)], "more than one row"),
    ([("AM", "1", "9", 1.0)], "unknown zone"),
    ([("AM", "9", "1", 1.0)], "unknown zone"),
])
def test_od_complete_rejects(spark, zones, bad, message):
    out = sk.od_complete(spark.createDataFrame(bad, SCHEMA), zones, {"timePeriod": ["AM"]}, ["v"])
    with pytest.raises(Exception, match=message):
        out.collect()


def test_distance_takes_last_row_even_if_null(spark, zones):
    hwy = spark.createDataFrame([("1", "2", 9.0, 1), ("1", "2", None, 2), ("1", "3", 5.0, 1), ("1", "3", 6.0, 2)],
                                "origin string, destination string, DIST_miles double, ordinal int")
    d = {(r.origin, r.destination): r.DIST for r in sk.distance_skim(hwy, zones).collect()}
    assert len(d) == 25 and d["1", "3"] == 6.0
    assert d["1", "2"] == pytest.approx(d["2", "1"]) and d["1", "2"] > 6
    assert d["4", "4"] == pytest.approx(100 * 0.621371 / 1000)


def test_auto_skims_defaults(spark, zones):
    hwy = spark.createDataFrame([("AM", "SOV", "1", "2", None, 8.0, None)],
                                "timePeriod string, pathType string, origin string, destination string, TIME_minutes double, DIST_miles double, VTOLL_FAR double")
    dist = sk.pack_distance(hwy.select("origin", "destination", F.lit(8.0).alias("DIST_miles"), F.lit(1).alias("ordinal")), zones)
    out = sk.auto_skims(hwy, dist, zones, periods=["AM"])
    assert out.count() == 25 * 6
    row = out.filter("pathType = 'HOV3' and origin = '1' and destination = '2'").first()
    assert (row.TIME, row.DIST, row.BTOLL, row.VTOLL) == (12.0, 8.0, 0.0, 0.0)
    twice = hwy.unionByName(hwy.withColumn("pathType", F.lit("HOV2")))
    with pytest.raises(Exception, match="more than one row"):
        sk.auto_skims(twice, dist, zones, periods=["AM"]).collect()
    assert sk.auto_skims(twice, dist, zones, periods=["AM"], paths=["SOV", "HOV2"], by_path=True).count() == 50


def test_transit_skims_scale_and_recode(spark, zones):
    base = {m: 0.0 for m in set(sk.TRANSIT_MEASURES.values()) if m}
    row = base | {"timePeriod": "AM", "pathType": "WLK_LOC_WLK", "origin": "1", "destination": "2", "VTOLL_FAR": 2.5, "DDIST_miles": 3.0, "BOARDS": 1.0, "TOTIVT_IVT_minutes": 4.0}
    out = sk.transit_skims(spark.createDataFrame([row]), zones, periods=["AM"])
    assert out.count() == 25 * len(sk.TRANSIT_PATHS)
    hit = out.filter("origin = '1' and destination = '2' and TOTIVT > 0")
    assert sorted(r.pathType for r in hit.collect()) == ["WLK_EXP_WLK", "WLK_LOC_WLK", "WLK_TRN_WLK"]
    r = hit.first()
    assert (r.FAR, r.BOARDS, r.DDIST, r.TOTIVT, r.IVT, r.WAIT) == (2.5, 1.0, 300.0, 400.0, 400.0, 0.0)


def test_clean_drops_zero_inf_nan_and_rejects_minus_inf(spark):
    def skims(*v):
        return spark.createDataFrame([("AM", x, 1000.0, d) for x, d in v], "timePeriod string, TIME_minutes double, DIST_meters double, DDIST_meters double")

    got = sk.skim_clean(skims((0.0, 1.0), (float("inf"), 0.0), (float("nan"), 1.0), (5.0, 2000.0)))
    assert [r.TIME_minutes for r in got.collect()] == [None, None, None, 5.0]
    assert got.filter("DDIST_miles is null").count() == 1
    with pytest.raises(Exception, match="infinite"):
        sk.skim_clean(skims((1.0, float("-inf")))).collect()


def test_matrix_export_length(spark, zones):
    wide = sk.od_complete(spark.createDataFrame([("AM", "2", "3", 4.0)], SCHEMA), zones, {"timePeriod": ["AM"]}, ["v"]).withColumn("pathType", F.lit("SOV"))
    out = sk.matrix_export(sk.pack_wide(wide, zones)).collect()
    assert {r.name for r in out} == {"SOV_v__AM"} and all(len(r["values"]) == 5 for r in out) and len(out) == 5
    assert next(r["values"] for r in out if r.o_idx == 2) == [0, 0, 4.0, 0, 0]


def test_upsert_is_idempotent_and_null_safe(spark, rows):
    schema = "timePeriod string, pathType string, origin string, destination string, v int, w int"
    base = spark.createDataFrame([("AM", "SOV", "1", "1", 1, 1), (None, "SOV", "1", "1", 2, 2), ("PM", "SOV", "1", "1", 3, 3)], schema)
    new = spark.createDataFrame([("AM", "SOV", "1", "1", 9), (None, "SOV", "1", "1", 8), ("EV", "SOV", "1", "1", 7)], schema.replace(", w int", ""))
    once = sk.skim_upsert(base, new)
    assert rows(once, "timePeriod", "v", "w") == sorted([("AM", 9, None), (None, 8, None), ("EV", 7, None), ("PM", 3, 3)], key=repr)
    assert rows(sk.skim_upsert(once, new)) == rows(once)
    assert sk.skim_upsert(base, None) is base


def test_interval_edges(spark, rows):
    iskims = spark.createDataFrame([(e, 1, 1, float(e)) for e in (360, 540, 1440)], "interval_end int, o int, d int, time double")
    trips = spark.createDataFrame([(1, 1, 1, 0.0), (2, 1, 1, 359.9), (3, 1, 1, 360.0), (4, 1, 1, 1440.0), (5, 1, 1, 2000.0), (6, 2, 1, 5.0)], "id int, o int, d int, minute double")
    zones = spark.createDataFrame([(1,)], "zone int")
    assert rows(sk.od_time_lookup(trips, iskims, zones, ["time"]), "id", "time") == [(1, 360.0), (2, 360.0), (3, 540.0), (4, 1440.0), (5, 1440.0)]
    assert rows(sk.od_lookup_rejects(trips, zones), "zone", "side", "trips") == [(2, "o", 1)]


def test_cost_without_service(spark, rows):
    iskims = spark.createDataFrame([(720, 1, 1, 10.0, 2.0, 1.0, 5.0), (720, 1, 2, 10.0, 2.0, 1.0, 86400.0), (720, 2, 1, 4.0, 2.0, 1.0, 9.0)],
                                   "interval_end int, o int, d int, distance double, cost double, fare double, ivtt double")
    assert rows(sk.cost_per_mile(iskims)) == [(1, 0.2, 99999.0), (2, 0.5, 0.25)]


def test_accumulate_last_list_wins(spark, zones):
    a = spark.createDataFrame([(1, 2, 5.0, 1), (1, 2, 6.0, 2), (9, 1, 1.0, 3)], "o int, d int, value double, ordinal int")
    b = spark.createDataFrame([(1, 2, 1.0, 0)], a.schema)
    out = sk.od_accumulate({"s": [a, b], "l": [a, b]}, {"s": "sum", "l": "last"}, zones)
    r = out.filter("origin = '1' and destination = '2'").first()
    assert out.count() == 25 and (r.s, r.l) == (12.0, 1.0)
    assert [r[0] for r in sk.od_ignored_zones([a, b], zones).collect()] == ["9"]


def test_matrix_rows_to_od(spark, rows):
    m = spark.createDataFrame([(0, [1.0, float("nan")], [5.0, 6.0]), (1, [None, 2.0], [7.0, 8.0])], "row int, t array<double>, c array<double>")
    assert rows(sk.matrix_rows_to_od(m, {"time": "t", "cost": "c"})) == [("0", "0", 1.0, 5.0), ("1", "1", 2.0, 8.0)]


def test_profile_is_stable_and_skips_empty_origins(spark):
    pairs = spark.createDataFrame([(str(o), str(d), 0.0 if o == 3 else float(d * 333)) for o in range(9) for d in range(4)], "origin string, destination string, value double")
    one, two = (sorted(map(tuple, sk.skim_profile(pairs.repartition(n), 5, 1).collect()), key=repr) for n in (1, 6))
    assert one == two and len(one) == 20 and "3" not in {r[0] for r in one}
    assert {r[2] for r in one} == {None, 333.0, 666.0}


def test_profile_completes_sampled_origins_only(spark, tables, monkeypatch, rows):
    seen, unpack = [], sk.unpack_od
    monkeypatch.setattr(sk, "unpack_od", lambda packed, zones: (seen.append(packed.count()), unpack(packed, zones))[1])
    got = rows(queries.profile(tables))
    assert seen == [6]
    monkeypatch.undo()
    assert got == rows(sk.skim_profile(queries.transit_total(tables), 6, 7))


def test_given_transit_are_the_cells_that_have_rows(spark, tables, rows):
    paths = ["WLK_LOC_WLK", "WLK_EXP_WLK", "DRV_COM_WLK"]
    given = sk.given_transit(queries.clean(tables).filter(F.col("pathType").isin(queries.TRANSIT_RAW)), queries.taz(tables), ["AM"], paths)
    whole = queries.transit(tables, periods=["AM"], paths=paths)
    assert given.columns == whole.columns and 0 < given.count() < whole.count()
    assert given.exceptAll(whole).isEmpty()
    rest = whole.join(given.select(*sk.SKIM_KEYS), sk.SKIM_KEYS, "left_anti")
    assert rest.filter(" or ".join(f"{m} != 0" for m in sk.TRANSIT_MEASURES)).isEmpty()


def test_matrices_side_by_side_need_no_grouping(spark, zones, tables):
    packed = sk.pack_od(spark.createDataFrame([("1", "2", 3.0, 4.0)], "origin string, destination string, a double, b double"), zones, {}, ["a", "b"])
    apart = {(r.name, r.o_idx): r["values"] for r in sk.matrix_export(packed).collect()}
    beside = sk.matrix_export(packed, side_by_side=True)
    assert {(m, r.o_idx): r[m] for r in beside.collect() for m in ("a", "b")} == apart and beside.columns == ["o_idx", "a", "b"]
    plan = queries.matrix_rows(tables)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and "max(CASE WHEN" not in plan


def test_time_factors(spark, rows):
    iskims = spark.createDataFrame([(360, 1, 1, 60.0, 200000.0), (540, 1, 1, 120.0, 200000.0), (360, 1, 2, 0.0, 1.0), (360, 2, 1, 60.0, 1.0)],
                                   "interval_end int, o int, d int, time double, distance double")
    counts = spark.createDataFrame([(1, 1, 0, 1, 3), (1, 1, 9, 0, 1)], "o_id int, d_id int, mode int, av_type int, trips int")
    waits = spark.createDataFrame([(1, 30.0)], "zone int, avg_wait double")
    low = {(r.o, r.d, r.interval_end): r.time for r in merge.time_factor_skims(counts, waits, iskims, 0).collect()}
    assert low[1, 1, 360] == pytest.approx(60 * (0.75 * 0.8 + 0.25 * 90 / 60))
    assert low[1, 1, 540] == pytest.approx(120 * (0.75 * 0.6 + 0.25 * 150 / 120))
    assert low[1, 2, 360] == 0.0 and low[2, 1, 360] == 60.0
    assert rows(merge.time_factor_skims(counts, waits, iskims, 2)) == rows(iskims)


def test_zone_index_kinds(spark, rows):
    blocks = spark.createDataFrame([("484530001001002",), ("484530001001001",), ("484530001002001",), ("480010009001001",)], "block_id string")
    assert rows(sk.zone_index(blocks, "block_group")) == [("480010009001", "1"), ("484530001001", "2"), ("484530001002", "3")]
    assert rows(sk.zone_index(blocks, "block"))[-1] == ("484530001002001", "4")
    overlap = spark.createDataFrame([("a", 7)], "GEOID string, zone_id int")
    assert rows(sk.zone_index(blocks, "taz", overlap)) == [("a", "7")]


def test_absent_modes(spark):
    skims = spark.createDataFrame([("SOV",)], "pathType string")
    highway, transit = sk.split_by_mode(skims, sk.HIGHWAY_PATHS, sk.TRANSIT_PATHS)
    assert (highway.count(), transit.count()) == (1, 0)
    assert [r.mode for r in sk.absent_modes(skims, sk.HIGHWAY_PATHS, sk.TRANSIT_PATHS).collect()] == ["transit"]


def test_matrix_places_sparse_values_by_position(spark, zones):
    wide = spark.createDataFrame([("AM", "SOV", "1", "1", 11.0), ("AM", "SOV", "1", "3", 13.0), ("PM", "SOV", "5", "4", 54.0)],
                                 "timePeriod string, pathType string, origin string, destination string, v double")
    got = {(r.name, r.o_idx): r["values"] for r in sk.matrix_export(sk.pack_wide(wide, zones)).collect()}
    assert len(got) == 10 and got["SOV_v__AM", 1] == [11.0, None, 13.0, None, None]
    assert got["SOV_v__AM", 3] == [None] * 5 and got["SOV_v__PM", 5] == [None, None, None, 54.0, None]


@pytest.mark.parametrize("build", ["distance", "auto", "transit"])
def test_nothing_is_shuffled_after_unpacking(spark, zones, build):
    row = {m: 1.0 for m in set(sk.TRANSIT_MEASURES.values()) | {"TIME_minutes", "DIST_miles"} if m}
    rows_ = spark.createDataFrame([row | {"timePeriod": "AM", "pathType": p, "origin": "1", "destination": "2", "ordinal": 1} for p in ("SOV", "WLK_LOC_WLK")])
    highway, transit = sk.split_by_mode(rows_, sk.HIGHWAY_PATHS, sk.TRANSIT_PATHS)
    df = {
        "distance": lambda: sk.distance_skim(highway, zones), "transit": lambda: sk.transit_skims(transit, zones),
        "auto": lambda: sk.auto_skims(highway, sk.pack_distance(highway, zones), zones),
    }[build]()
    plan = df._jdf.queryExecution().executedPlan().toString()
    above = [line for line in plan[: plan.index("Generate explode(sequence(0")].splitlines() if not line.lstrip().startswith(":")]  # without scalar subqueries
    assert not any("Exchange" in line or "Join" in line for line in above)


def test_lookup_by_mode_and_repeated_keys(spark, rows):
    schema = "interval_end int, o int, d int, time double, mode string"
    iskims = spark.createDataFrame([(360, 1, 1, 1.0, "AUTO"), (1440, 1, 1, 2.0, "AUTO"), (1440, 1, 1, 9.0, "BUS")], schema)
    trips = spark.createDataFrame([(1, 1, 1, 5.0), (2, 1, 1, 500.0)], "id int, o int, d int, minute double")
    zones = spark.createDataFrame([(1,)], "zone int")
    assert rows(sk.od_time_lookup(trips, iskims, zones, ["time"], mode="AUTO"), "id", "time") == [(1, 1.0), (2, 2.0)]
    assert rows(sk.od_time_lookup(trips, iskims, zones, ["time"], mode="BUS"), "id", "time") == [(1, 9.0), (2, 9.0)]
    with pytest.raises(ValueError, match="name the mode"):
        sk.od_time_lookup(trips, iskims, zones, ["time"])
    with pytest.raises(Exception, match="more than one skim row"):
        sk.od_time_lookup(trips, iskims.unionByName(iskims), zones, ["time"], mode="BUS").collect()


def test_lookup_holds_no_table_of_all_skim_keys(spark):
    """Skim rows are counted in the order the join sorts them into; an aggregation would hold all keys of a task."""
    iskims = spark.createDataFrame([(360, 1, 1, 1.0), (1440, 1, 1, 2.0)], "interval_end int, o int, d int, time double")
    trips = spark.createDataFrame([(1, 1, 1, 5.0)], "id int, o int, d int, minute double")
    found = sk.od_time_lookup(trips, iskims, spark.createDataFrame([(1,)], "zone int"), ["time"])
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "Aggregate(keys=[o" not in plan and "Aggregate(keys=[interval_end" not in plan


def test_zone_coverage_looks_at_both_ends(spark, zones, rows):
    skims = spark.createDataFrame([("1", "9"), ("2", "1"), (None, "1")], "origin string, destination string")
    got = rows(sk.zone_coverage(skims, zones.limit(2)), "side", "zone_id", "problem")
    assert set(got) >= {("destination", "9", "unknown zone"), ("destination", "2", "no rows")} and ("origin", "1", "no rows") not in got


def test_null_origin_is_an_unknown_zone(spark, zones):
    bad = spark.createDataFrame([("AM", None, "1", 1.0)], SCHEMA)
    with pytest.raises(Exception, match="unknown zone"):
        sk.od_complete(bad, zones, {"timePeriod": ["AM"]}, ["v"]).collect()


@pytest.mark.parametrize("given", [[], [1], [5], [1, 2, 3, 4, 5], [2, 4], [1, 5], [3, 4, 5]])
def test_given_cells_among_defaults(spark, zones, given):
    """Values set between stretches of a default, whatever cells are given: a number, or an array by position."""
    rows = [("AM", "3", str(d), None if d == 4 else d * 1.5, 2.0) for d in given]
    df = spark.createDataFrame(rows, "timePeriod string, origin string, destination string, v double, w double")
    plain = sk.pack_od(df, zones, {"timePeriod": ["AM"]}, ["v", "w"], fill=-1.0).filter("o_idx = 3").first()
    assert plain.v == [d * 1.5 if d in given and d != 4 else -1.0 for d in range(1, 6)]
    assert plain.w == [2.0 if d in given else -1.0 for d in range(1, 6)]
    far = F.array(*[F.lit(10.0 * d) for d in range(1, 6)])
    packed = sk._given_od(df, zones, {"timePeriod": ["AM"]}, {"v": F.col("v")}).withColumn("far", far)
    by_place = packed.select("o_idx", sk._dense("v", F.col("far")).alias("v")).filter("o_idx = 3").first().v
    assert by_place == [d * 1.5 if d in given and d != 4 else 10.0 * d for d in range(1, 6)]


def test_distances_are_worked_out_on_unpacked_pairs(spark, tables):
    """Expressions over arrays are not compiled, and work out a term wherever it stands: pairs first, and each difference once."""
    from workload import skims as ws

    plan = sk.distance_skim(ws.highway(tables), ws.taz(tables))._jdf.queryExecution().optimizedPlan().toString()
    pairs, packed = plan.split("Generate explode(sequence(", 1)
    assert "sqrt(" in pairs.lower() and "sqrt(" not in packed.lower()
    arrays = sk.pack_distance(ws.highway(tables), ws.taz(tables))._jdf.queryExecution().optimizedPlan().toString()
    assert arrays.lower().count("sqrt(") == 1


def test_packed_distances_are_those_of_pairs(spark, zones):
    hwy = spark.createDataFrame([("1", "2", 9.0, 1), ("2", "1", None, 1), ("4", "5", 0.25, 1)], "origin string, destination string, DIST_miles double, ordinal int")
    pairs = {(r.origin, r.destination): r.DIST for r in sk.distance_skim(hwy, zones).collect()}
    packed = {(r.origin, str(i + 1)): v for r in sk.pack_distance(hwy, zones).collect() for i, v in enumerate(r.DIST)}
    assert packed == pairs and pairs["1", "2"] == 9.0 and pairs["4", "5"] == 0.25 and len(pairs) == 25


def test_accumulate_keeps_rows_in_a_hashed_table(spark, zones):
    """Of a list, the row of the greatest ordinal counts, also if its value is NULL; one without an ordinal comes before all others."""
    schema = "o int, d int, value double, ordinal long"
    early = spark.createDataFrame([(1, 2, 5.0, 1), (1, 3, 6.0, 2), (1, 4, 7.0, 7), (2, 1, 8.0, None), (2, 2, 3.0, None), (2, 2, 4.0, -5)], schema)
    late = spark.createDataFrame([(1, 3, 9.0, 1), (1, 4, 1.0, 1), (1, 4, None, 3), (2, 3, 2.0, None)], schema)
    out = sk.od_accumulate({"l": [early, late], "s": [late]}, {"l": "last", "s": "sum"}, zones)
    got = {(r.origin, r.destination): (r.l, r.s) for r in out.filter("l != 0 or s != 0").collect()}
    assert got == {("1", "2"): (5.0, 0.0), ("1", "3"): (9.0, 9.0), ("1", "4"): (0.0, 1.0), ("2", "1"): (8.0, 0.0), ("2", "2"): (4.0, 0.0), ("2", "3"): (2.0, 2.0)}
    assert "SortAggregate" not in out._jdf.queryExecution().sparkPlan().toString()
    text = [df.withColumn("ordinal", F.col("ordinal").cast("string")) for df in (early, late)]
    same = sk.od_accumulate({"l": text, "s": text[1:]}, {"l": "last", "s": "sum"}, zones)
    assert {(r.origin, r.destination): (r.l, r.s) for r in same.filter("l != 0 or s != 0").collect()} == got


def test_given_cells_are_shuffled_once(spark, zones):
    """Dealt by origin as the frame is, they need no shuffle of their own for the count of a pair, the list of a row, or the join."""
    df = spark.createDataFrame([("AM", "1", "2", 3.0)], SCHEMA)
    packed = sk.pack_od(df, zones, {"timePeriod": ["AM"]}, ["v"], 0.0)
    plan = packed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(timePeriod") == plan.count("REPARTITION_BY_NUM") == 2
    packed = sk.pack_od(df.unionByName(df.withColumn("timePeriod", F.lit("PM"))), zones, {"timePeriod": ["AM", "PM"]}, ["v"], 0.0)
    assert [(r.timePeriod, r.o_idx, r.v[1]) for r in packed.filter("v[1] > 0").orderBy("timePeriod").collect()] == [("AM", 1, 3.0), ("PM", 1, 3.0)]


def test_slices_of_an_origin_are_stored_side_by_side(spark, tmp_path):
    """40,000 names fill a compressor's window many times: apart from the first of five slices, they must take hardly any space."""
    n = 40000
    zones = spark.range(1, n + 1).select(F.col("id").cast("string").alias("zone_id"), F.col("id").alias("idx"))
    df = spark.createDataFrame([("AM", "7", "40000", 3.0), ("EV", "7", "1025", 4.0), ("EV", "7", "1024", 5.0)], SCHEMA)

    def stored(name, periods):
        out = sk.od_complete(df, zones, {"timePeriod": periods}, ["v"]).filter("origin = '7'")
        out.coalesce(1).write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name)), sum(f.stat().st_size for f in (tmp_path / name).glob("*.parquet"))

    one, least = stored("one", ["AM"])
    five, size = stored("five", sk.PERIODS)
    assert one.count() == n and five.count() == five.distinct().count() == 5 * n
    assert sorted(map(tuple, five.filter("v != 0").collect())) == [("AM", "7", "40000", 3.0), ("EV", "7", "1024", 5.0), ("EV", "7", "1025", 4.0)]
    assert size < 2 * least


def test_zones_and_slices_named_twice_make_rows_twice(spark, rows):
    zones = spark.createDataFrame([("1", 1), ("2", 2), ("3", 3), ("3", 3)], "zone_id string, idx int")
    df = spark.createDataFrame([("AM", "1", "2", 3.0)], SCHEMA)
    out = sk.od_complete(df, zones, {"timePeriod": ["AM", "PM", "PM"]}, ["v"])
    slow = sk.unpack_od(sk.pack_od(df, zones, {"timePeriod": ["AM", "PM", "PM"]}, ["v"], 0.0), zones)
    assert out.columns == slow.columns and rows(out) == rows(slow) and out.count() == 4 * 4 * 3
