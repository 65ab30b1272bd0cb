"""Population to demand tables: recodes, placement, sampling, merging, zone attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commuta.functions.columns import hash_uniform, label, safe_div, trunc_int
from commuta.operators.joins import as_of, lookup, running_totals
from commuta.operators.lineage import cut_lineage

# Household type and housing unit codes.
HOUSEHOLD_TYPES = {1: 4, 2: 4, 3: 1, 4: 1, 5: 9, 6: 9, 7: 6, 8: 6}
HOUSING_UNIT_TYPES = {"yes": 1, "no": 3}
# Enrollment code, marital status codes, telecommute days per flag, missing location.
ENROLLMENT = {0: 0, 1: 2}
MARRIED, NEVER_MARRIED = 1, 5
TELECOMMUTE_DAYS = 4
MISSING = -1
# Industry code to employment group.
EMPLOYMENT_GROUPS = ["retail", "government", "services", "industrial", "manufacturing", "other"]
INDUSTRY_GROUPS = {
    "11": 3, "21": 3, "22": 3, "23": 3, "42": 0, "51": 2, "52": 2, "53": 2, "54": 2, "55": 2, "56": 5, "61": 1,
    "62": 5, "71": 5, "72": 2, "81": 2, "92": 1, "31-33": 4, "44-45": 0, "48-49": 3,
}



def household_recode(households: DataFrame) -> DataFrame:
    """Demand-table household columns; unknown codes become NULL.

    ``hhold`` is the survey's serial number, NULL where the table has none; a given ``time_in_home`` is kept, else unknown.
    """
    given = F.col("time_in_home") if "time_in_home" in households.columns else F.lit(None)
    serial = F.col("serialno") if "serialno" in households.columns else F.lit(None).cast("string")
    return households.select(
        "household_id", serial.alias("hhold"), "block_id", "persons", "workers", "income",
        F.col("cars").alias("vehicles"),
        label("hh_type", HOUSEHOLD_TYPES).alias("type"),
        label("sf_detached", HOUSING_UNIT_TYPES).alias("housing_unit_type"),
        F.lit(0).alias("ecom"), F.lit(0).alias("dispose_veh"), F.coalesce(given, F.lit(MISSING)).alias("time_in_home"),
    )


def unknown_codes(df: DataFrame, column: str, known: dict) -> DataFrame:
    """Codes outside a recode table and how many rows carry them."""
    return df.filter(~F.col(column).isin(list(known))).groupBy(column).agg(F.count("*").alias("rows"))


def person_recode(persons: DataFrame) -> DataFrame:
    """Demand-table person columns; missing locations and job time become -1, so does school 0."""

    def known(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(MISSING))

    grade = F.col("student") * (F.col("age") - 3)
    bounded = F.greatest(F.least(grade, F.lit(15)), F.lit(0))
    return persons.select(
        "person_id", "household_id", (F.col("member_id") - 1).alias("id"), "age", "relate",
        F.col("worker").alias("worker_class"), F.col("edu").alias("education"), F.lit(0).alias("industry"),
        F.col("worker").alias("employment"), F.col("sex").alias("gender"), F.col("earning").alias("income"),
        F.lit(NEVER_MARRIED).alias("marital_status"), F.col("race_id").alias("race"),
        label("student", ENROLLMENT).alias("school_enrollment"),
        F.when(grade.isNotNull(), bounded).alias("school_grade_level"),
        F.col("hours").alias("work_hours"),
        (F.col("work_at_home") * TELECOMMUTE_DAYS).alias("telecommute_level"),
        F.lit(0).alias("transit_pass"), F.lit(1).alias("journey_to_work_mode"),
        known("work_zone_id").alias("work_location_id"),
        F.coalesce(F.nullif("school_zone_id", F.lit(0)), F.lit(MISSING)).alias("school_location_id"),
        known("time_in_job").alias("time_in_job"),
    )


def marital_status(persons: DataFrame) -> DataFrame:
    """Married for the last reference person and last spouse of each household with a spouse."""

    def last(relate: int) -> Column:
        return F.max(F.when(F.col("relate") == relate, F.col("person_id")))

    couples = (
        persons.filter(F.col("relate").isin(0, 1))
        .groupBy("household_id")
        .agg(last(0).alias("_ref"), last(1).alias("_spouse"))
        .filter(F.col("_spouse").isNotNull())
    )
    out = lookup(persons, couples, ["household_id"])
    married = (F.col("person_id") == F.col("_ref")) | (F.col("person_id") == F.col("_spouse"))
    return out.withColumn("marital_status", F.when(married, MARRIED).otherwise(NEVER_MARRIED)).drop("_ref", "_spouse")


def block_location_zone(block_location: DataFrame, location: DataFrame) -> DataFrame:
    """Location and zone of each block."""
    return block_location.join(location.select("location", "zone"), "location").select("block_id", "location", "zone")


def place_unplaced(households: DataFrame, block_zone: DataFrame, seed: int) -> DataFrame:
    """Give households without a known block one drawn in proportion to placed households.

    A draw is a rank among the placed households in block order, so a block is hit as
    often as households live in it; its block is the last one that begins at or before the
    rank, found by one merge of draws and beginnings (``as_of``): a draw stays one row, and no
    block is unfolded, whatever its size. The counts per block are checkpointed, as beginnings
    and total both read them.
    """
    keys = ["block_id"]
    known = block_zone.select("block_id", F.lit(True).alias("_placed"))
    counts = households.groupBy("block_id").agg(F.count("*").alias("n"))
    counts = cut_lineage(counts.join(known, keys, "left_semi"))
    marked = lookup(households, known, keys)
    placed = marked.filter(F.col("_placed")).drop("_placed")
    starts = running_totals(counts, F.substring("block_id", 1, 11), "block_id", {"high": "n"}).select(
        (F.col("high") - F.col("n")).alias("_rank"), F.col("block_id").alias("_drawn")
    )
    nobody = F.raise_error(F.lit("no household has a known block"))
    total = counts.agg(F.sum("n")).scalar()
    draws = marked.filter(F.col("_placed").isNull()).drop("_placed", "block_id").withColumn(
        "_rank", trunc_int(F.floor(hash_uniform("household_id", seed) * total))
    )
    drawn = as_of(draws, starts, "_rank").withColumn("block_id", F.coalesce("_drawn", nobody)).select(*households.columns)
    return placed.select(*households.columns).unionByName(drawn)


def sample_households(households: DataFrame, fraction: float, seed: int) -> DataFrame:
    """Households drawn with the given probability, the same ones at any partitioning."""
    return households.filter(hash_uniform("household_id", seed) < fraction)


def members_of(rows: DataFrame, households: DataFrame) -> DataFrame:
    """Persons or vehicles of the given households."""
    ids = households.select("household_id", F.lit(True).alias("_in"))
    return lookup(rows, ids, ["household_id"], how="inner").select(*rows.columns)


def merge_households(new: DataFrame, existing: DataFrame) -> DataFrame:
    """Every new household; one already in the demand table keeps its record but moves location and zone."""
    moved = ["location", "zone"]
    own = [c for c in existing.columns if c not in ("household_id", *moved)]
    old = existing.select("household_id", F.struct(*own).alias("_old"))
    both = new.join(old, "household_id", "left")

    def pick(c: str) -> Column:
        return F.when(F.col("_old").isNotNull(), F.col(f"_old.{c}")).otherwise(F.col(c)).alias(c)

    return both.select(*[pick(c) if c in own else F.col(c) for c in new.columns])


def merge_members(new: DataFrame, existing: DataFrame, households: DataFrame, known: DataFrame) -> DataFrame:
    """Members of the merged households: the existing ones where ``known`` has the household, else the new ones."""
    ids = households.select("household_id")
    kept = ids.join(known.select("household_id"), "household_id", "left_semi")
    fresh = ids.join(known.select("household_id"), "household_id", "left_anti")
    return members_of(existing, kept).unionByName(members_of(new, fresh), allowMissingColumns=True)


def zone_attributes(
    households: DataFrame, persons: DataFrame, jobs: DataFrame, block_zone: DataFrame
) -> DataFrame:
    """Per zone: households, mean income, persons, shares of two race codes, jobs by group.

    Jobs count where their block id is a number and lies in a zone other than 0. Each
    table is summed per block before the zone lookup. Zones are those of the blocks.
    """
    def zoned(sums: DataFrame) -> DataFrame:
        values = [c for c in sums.columns if c != "block_id"]
        return (
            sums.join(block_zone.select("block_id", "zone"), "block_id")
            .groupBy("zone").agg(*[F.sum(c).alias(c) for c in values])
        )

    hh = households.groupBy("block_id").agg(F.count("*").alias("pop_households"), F.sum("income").alias("_income"))
    per_household = persons.groupBy("household_id").agg(
        F.count("*").alias("pop_persons"),
        *[F.sum(F.when(F.col("race_id") == code, 1).otherwise(0)).alias(n) for n, code in (("_white", 1), ("_black", 2))],
    )
    people = per_household.join(households.select("household_id", "block_id"), "household_id").groupBy("block_id").agg(
        *[F.sum(c).alias(c) for c in ("pop_persons", "_white", "_black")]
    )
    group = label("sector_id", INDUSTRY_GROUPS)
    work = jobs.filter(F.col("block_id").rlike(r"^\s*[+-]?[0-9]+\s*$")).groupBy("block_id").agg(
        F.count("*").alias("employment_total"),
        *[F.sum(F.when(group == i, 1).otherwise(0)).alias(f"employment_{g}") for i, g in enumerate(EMPLOYMENT_GROUPS)],
    )
    jobs_by_zone = zoned(work).filter(F.col("zone") != 0)
    wide = (
        block_zone.select("zone").distinct()
        .join(zoned(hh), "zone", "left").join(zoned(people), "zone", "left").join(jobs_by_zone, "zone", "left")
    )
    filled = wide.fillna(0)
    share = {"percent_white": "_white", "percent_black": "_black"}
    return filled.withColumns({
        **{n: F.coalesce(safe_div(c, "pop_persons"), F.lit(0.0)) for n, c in share.items()},
        "hh_inc_avg": F.coalesce(safe_div("_income", "pop_households"), F.lit(0.0)),
    }).drop("_white", "_black", "_income")
