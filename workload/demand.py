"""Demand preparation and iteration merge queries."""

from pyspark.sql import functions as F

from commuta.operators import demand as dm, merge as mg
from commuta.plans import ridehail as rh
from workload.landuse import households, persons
from workload.registry import add

SEED = 11


def uniform(column, seed=SEED):
    return f"(('0x' || substr(md5(cast({column} as varchar) || ':{seed}'), 1, 13))::bigint / power(2, 52))"


def block_zone(T):
    """Blocks with a location; blocks numbered past the last location have none."""
    located = T.block.select("block_id", F.col("block_no") + 1)
    return dm.block_location_zone(located.toDF("block_id", "location"), T.location)


BLOCK_ZONE = """(select b.block_id, l.location, l.zone from fx_block b join fx_location l on b.block_no + 1 = l.location)"""
HT = "case when hh_type in (1, 2) then 4 when hh_type in (3, 4) then 1 when hh_type in (5, 6) then 9 when hh_type in (7, 8) then 6 end"

def survey_households(T):
    return households(T).withColumn("serialno", F.concat(F.lit("s"), "household_id"))


add("p01_household_recode_time_in_home", lambda T: dm.household_recode(survey_households(T).withColumn(
    "time_in_home", F.nullif(F.col("household_id") % 9, F.lit(0)))).select("household_id", "hhold", "time_in_home"), """
    select household as household_id, 's' || household as hhold, coalesce(nullif(household % 9, 0), -1) as time_in_home from fx_household""")
add("p01_household_recode", lambda T: dm.household_recode(survey_households(T)), f"""
    select household as household_id, 's' || household as hhold, block_id, persons, workers, income, cars as vehicles, {HT} as type,
        case sf_detached when 'yes' then 1 when 'no' then 3 end as housing_unit_type, 0 as ecom, 0 as dispose_veh,
        -1 as time_in_home from fx_household""")
add("p01_unknown_codes", lambda T: dm.unknown_codes(households(T), "hh_type", {1: 4, 2: 4, 3: 1}), """
    select hh_type, count(*) as "rows" from fx_household where hh_type not in (1, 2, 3) group by 1""")


def survey_persons(T):
    return persons(T).withColumnsRenamed(
        {"work_location_id": "work_zone_id", "school_location_id": "school_zone_id", "work_hours": "hours"}
    ).withColumns({
        "edu": F.col("school_enrollment"), "sex": F.col("age") % 2 + 1, "earning": F.col("age") * 100,
        "work_at_home": F.col("worker") * F.col("member_id") % 2,
        "time_in_job": F.nullif(F.col("age") % 7, F.lit(0)),
    })


add("p02_person_recode", lambda T: dm.person_recode(survey_persons(T)), """
    select person as person_id, household as household_id, member_id - 1 as id, age, relate, worker as worker_class,
        school_enrollment as education, 0 as industry, worker as employment, age % 2 + 1 as gender, age * 100 as income,
        5 as marital_status, race_id as race, case student when 0 then 0 when 1 then 2 end as school_enrollment,
        case when student is not null then greatest(least(student * (age - 3), 15), 0) end as school_grade_level,
        work_hours, worker * member_id % 2 * 4 as telecommute_level, 0 as transit_pass, 1 as journey_to_work_mode,
        coalesce(work_location_id, -1) as work_location_id, coalesce(nullif(school_location_id, 0), -1) as school_location_id,
        coalesce(nullif(age % 7, 0), -1) as time_in_job from fx_person""")
add("p03_place_unplaced", lambda T: dm.place_unplaced(
    households(T).select("household_id", "block_id", "income"), block_zone(T), SEED), f"""
    with z as (select block_id from {BLOCK_ZONE}),
    h as (select household as id, income, block_id, block_id is not null and block_id in (from z) as ok from fx_household),
    c as (select block_id, count(*) as n, sum(count(*)) over (order by block_id) as high from h where ok group by block_id),
    d as (select id, income, floor({uniform("id")} * (select count(*) from h where ok)) as r from h where not ok)
    select id as household_id, block_id, income from h where ok
    union all select d.id, c.block_id, d.income from d join c on d.r >= c.high - c.n and d.r < c.high""")


def sampled(T, fraction=0.25):
    return dm.sample_households(households(T), fraction, SEED)


add("p04_sample_households", lambda T: sampled(T).select("household_id", "income"),
    f"select household as household_id, income from fx_household where {uniform('household')} < 0.25")
add("p04_members", lambda T: dm.members_of(persons(T).select("person_id", "household_id", "age"), sampled(T)),
    f"select person as person_id, household as household_id, age from fx_person where {uniform('household')} < 0.25")


def located(T):
    h = households(T).select("household_id", "persons", "income", "block_id")
    return h.join(block_zone(T), "block_id").drop("block_id")


def demand_households(T):
    """Households of the demand table: one per active event user."""
    return T.tnc_trip.groupBy(F.col("vehicle").alias("household_id")).agg(
        F.count("*").alias("persons"), F.max("travel_distance").alias("income"),
        F.max("origin").alias("location"), F.max("destination").alias("zone"))


LOCATED = f"""(select h.household as household_id, h.persons, h.income, z.location, z.zone
    from (select * exclude (zone, location) from fx_household) h join {BLOCK_ZONE} z on h.block_id = z.block_id)"""
KNOWN = "(select vehicle as household_id, count(*) as persons, max(travel_distance) as income from fx_tnc_trip group by 1)"
add("p05_merge_households", lambda T: dm.merge_households(located(T), demand_households(T)), f"""
    select n.household_id, coalesce(k.persons, n.persons) as persons, coalesce(k.income, n.income) as income, n.location, n.zone
    from {LOCATED} n left join {KNOWN} k on n.household_id = k.household_id""")


def old_members(T):
    return T.activity.groupBy(F.col("person").alias("person_id")).agg(F.count("*").alias("age")).withColumn(
        "household_id", F.expr("person_id div 4"))


add("p05_merge_members", lambda T: dm.merge_members(
    persons(T).select("person_id", "household_id", "age"), old_members(T), located(T), demand_households(T)), f"""
    with n as (select household_id from {LOCATED}), k as (select household_id from {KNOWN})
    select person as person_id, household as household_id, age from fx_person
        where household in (from n) and household not in (from k)
    union all select person, person // 4, count(*) from fx_activity
        where person // 4 in (from n) and person // 4 in (from k) group by 1, 2""")
add("p06_marital_status", lambda T: dm.marital_status(
    persons(T).select("person_id", "household_id", (F.col("age") % 3).alias("relate"))), """
    with p as (select person as person_id, household as household_id, age % 3 as relate from fx_person),
    c as (select household_id, max(person_id) filter (where relate = 0) as r, max(person_id) filter (where relate = 1) as s
        from p group by 1)
    select p.*, case when c.s is not null and (p.person_id = c.r or p.person_id = c.s) then 1 else 5 end as marital_status
    from p join c on p.household_id = c.household_id""")


GROUP = """case when sector_id in ('42', '44-45') then 0 when sector_id in ('61', '92') then 1
    when sector_id in ('51', '52', '53', '54', '55', '72', '81') then 2
    when sector_id in ('11', '21', '22', '23', '48-49') then 3 when sector_id = '31-33' then 4
    when sector_id in ('56', '62', '71') then 5 end"""
add("p07_zone_attributes", lambda T: dm.zone_attributes(
    households(T).select("household_id", "block_id", "income"), persons(T), T.job, block_zone(T)), f"""
    with z as {BLOCK_ZONE},
    h as (select z.zone, count(*) as n, sum(income) as inc from (select * exclude (zone, location) from fx_household) h
        join z on h.block_id = z.block_id group by 1),
    p as (select z.zone, count(*) as n, count(*) filter (where race_id = 1) as w, count(*) filter (where race_id = 2) as b
        from fx_person p join fx_household h on p.household = h.household join z on h.block_id = z.block_id group by 1),
    j as (select z.zone, count(*) as n, {", ".join(f"count(*) filter (where g = {i}) as g{i}" for i in range(6))}
        from (select block_id, {GROUP} as g from fx_job) j join z on j.block_id = z.block_id where z.zone <> 0 group by 1)
    select q.zone, coalesce(h.n, 0) as pop_households, coalesce(p.n, 0) as pop_persons, coalesce(j.n, 0) as employment_total,
        {", ".join(f"coalesce(j.g{i}, 0) as employment_{n}" for i, n in enumerate(dm.EMPLOYMENT_GROUPS))},
        round(coalesce(p.w / p.n, 0), 6)::double as percent_white, round(coalesce(p.b / p.n, 0), 6)::double as percent_black,
        round(coalesce(h.inc / h.n, 0), 6)::double as hh_inc_avg
    from (select distinct zone from z) q left join h on q.zone = h.zone left join p on q.zone = p.zone left join j on q.zone = j.zone""")
add("p09_block_location_zone", block_zone, f"select * from {BLOCK_ZONE}")


def updated_persons(T):
    """New plans of the households that took a ride-hail trip."""
    ids = T.tnc_trip.select(F.col("vehicle").alias("household_id")).distinct()
    moved = persons(T).select("person_id", "household_id", (F.col("age") + 1).alias("age"))
    return moved.filter(F.col("age") > 18).join(ids, "household_id", "left_semi")


add("m01_replace_households", lambda T: mg.replace_households(
    persons(T).select("person_id", "household_id", "age"), updated_persons(T)), """
    with u as (select person as person_id, household as household_id, age + 1 as age from fx_person
        where household in (select vehicle from fx_tnc_trip) and age + 1 > 18)
    select * from u union all select person, household, age from fx_person where household not in (select household_id from u)""")


def precedence(T):
    stores = [
        {"persons": T.activity.select(F.col("person").alias("id"))},
        {"persons": T.person.select(F.col("person").alias("id")), "jobs": T.job.select(F.col("zone").alias("id"))},
        {"blocks": T.block.select(F.col("block_no").alias("id")), "jobs": T.zone.select(F.col("zone").alias("id"))},
    ]
    merged = mg.table_precedence(*stores, required=["persons", "jobs", "blocks"])
    parts = [df.agg(F.count("*").alias("rows"), F.sum("id").alias("ids")).withColumn("name", F.lit(n)) for n, df in merged.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


add("m02_table_precedence", precedence, """
    select 'persons' as name, count(*) as "rows", cast(sum(person) as bigint) as ids from fx_activity
    union all select 'jobs', count(*), cast(sum(zone) as bigint) from fx_job
    union all select 'blocks', count(*), cast(sum(block_no) as bigint) from fx_block""")
add("m03_best_iteration", lambda T: mg.best_iteration(T.gap_iteration, 12), """
    select iter, round(relative_gap_min0, 6) as relative_gap_min0 from fx_gap_iteration where seq >= 3
    order by fx_gap_iteration.relative_gap_min0, seq limit 1""")
add("m04_iteration_columns", lambda T: mg.iteration_columns(
    T.trip.groupBy(
        F.floor(F.col("start_s") / 360).alias("time"), F.col("has_artificial_trip").alias("loop")).agg(
        F.sum("travel_distance").alias("value")), [0, 1, 2, 3, 4]).withColumnsRenamed({str(i): f"loop_{i}" for i in range(5)}), """
    select cast(floor(start_s / 360) as bigint) as time,
        sum(travel_distance) filter (where has_artificial_trip = 0) as loop_0, sum(travel_distance) filter (where has_artificial_trip = 1) as loop_1,
        sum(travel_distance) filter (where has_artificial_trip = 2) as loop_2, sum(travel_distance) filter (where has_artificial_trip = 3) as loop_3,
        sum(travel_distance) filter (where has_artificial_trip = 4) as loop_4
    from fx_trip group by 1""")
TRIP_COLUMNS = ["origin", "destination", "start_s", "end_s", "travel_distance"]
add("m05_append_external_trips", lambda T: mg.append_trips(T.trip.select(*TRIP_COLUMNS), T.tnc_trip.select(*TRIP_COLUMNS)), f"""
    select {", ".join(TRIP_COLUMNS)} from fx_trip union all select {", ".join(TRIP_COLUMNS)} from fx_tnc_trip""")


def factored(T, vot):
    counts = rh.od_mode_automation_counts(T.trip, T.od_location, T.vehicle, T.vehicle_type)
    return mg.time_factor_skims(counts, rh.zone_tnc_wait(T.zone_wait_times), T.interval_skim, vot)


def factored_sql(vot):
    # Felt shares of travel time at partial and full automation, free-flowing and congested.
    f3, f5 = ((0.8, 0.6), (0.6, 0.425)) if vot == 0 else ((0.95, 0.85), (0.8, 0.6))
    kinds = {"s0": "mode = 0 and av = 0", "s3": "mode = 0 and av = 1", "s5": "mode = 0 and av = 2", "st": "mode = 9"}
    counts = ", ".join(f"count(*) filter (where {c}) as {n}" for n, c in kinds.items())
    sums = ", ".join(f"sum({n}) as {n}" for n in kinds)
    shares = ", ".join(f"coalesce(od.{n} / od.n, oo.{n} / oo.n) as {n}" for n in kinds)
    return f"""with places as materialized (select location, zone from fx_od_location),
    kinds as materialized (select v.vehicle_id, vt.automation_type as av from fx_vehicle v join fx_vehicle_type vt on v.type = vt.type_id),
    od as materialized (select o, d, count(*) as n, {counts} from (
        select o.zone as o, d.zone as d, t.mode, k.av from fx_trip t join places o on t.origin = o.location
        join places d on t.destination = d.location join kinds k on t.vehicle = k.vehicle_id where t.mode in (0, 9)) group by o, d),
    oo as materialized (select o, sum(n) as n, {sums} from od group by o),
    w as materialized (select zone, avg(avg_wait_minutes) as wait from fx_zone_wait_times group by zone),
    s as materialized (select *, first_value(time) over pair / 60 as fft, first_value(distance) over pair / 1000 as km
        from fx_interval_skim window pair as (partition by o, d order by interval_end)),
    x as (select s.*, {shares}, coalesce(w.wait, 0) as wait, fft > 0 and km / nullif(fft, 0) > 80 as hwy,
            fft > 0 and s.time / 60 / nullif(fft, 0) > 1.5 as cong
        from s left join od on od.o = s.o and od.d = s.d left join oo on oo.o = s.o left join w on w.zone = s.o)
    select interval_end, o, d, distance, cost, fare, ivtt, round(time * coalesce(s0
        + s3 * case when hwy then case when cong then {f3[1]} else {f3[0]} end else 1 end
        + s5 * case when cong then {f5[1]} else {f5[0]} end
        + st * case when time > 0 then (wait + time) / time else 1 end, 1), 6)::double as time from x"""


add("m06_time_factor_skims_low_vot", lambda T: factored(T, 0), factored_sql(0))
add("m06_time_factor_skims_high_vot", lambda T: factored(T, 1), factored_sql(1))
add("m06_time_factor_skims_baseline", lambda T: factored(T, 2), "select * from fx_interval_skim")
