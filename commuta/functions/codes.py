"""Code lists and recodes of persons, activities and travel modes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mode codes and labels of the assignment run (long list).
MODE_LABELS = {
    0: "SOV", 1: "AUTO", 2: "HOV", 3: "TRUCK", 4: "BUS", 5: "RAIL", 6: "NONMOTORIZED", 7: "BICYCLE", 8: "WALK",
    9: "TAXI", 10: "SCHOOLBUS", 11: "PARK_AND_RIDE", 12: "KISS_AND_RIDE", 13: "PARK_AND_RAIL",
    14: "KISS_AND_RAIL", 15: "TNC_AND_RIDE", 16: "TNC_AND_RAIL", 17: "MD_TRUCK", 18: "HD_TRUCK", 19: "BPLATE",
    20: "LD_TRUCK", 21: "RAIL_NEST", 22: "BUS40", 23: "BUS60", 25: "TELEPORTED",
}

# Mode codes and labels of the baseline report (short list, other meaning of 25 and up).
BASELINE_MODE_LABELS = {
    0: "SOV", 2: "HOV", 4: "BUS", 5: "RAIL", 6: "NONMOTORIZED", 7: "BICYCLE", 8: "WALK", 9: "TAXI",
    10: "SCHOOLBUS", 11: "PARK_AND_RIDE", 12: "KISS_AND_RIDE", 13: "PARK_AND_RAIL", 14: "KISS_AND_RAIL",
    15: "TNC_AND_RIDE", 16: "TNC_AND_RAIL", 25: "RIDE_AND_UNPARK", 26: "RIDE_AND_REKISS",
    27: "RAIL_AND_UNPARK", 28: "RAIL_AND_REKISS",
}

# Activity labels of the activity distribution.
ACTIVITY_LABELS = {
    "EAT OUT": "EAT_OUT", "ERRANDS": "ERRANDS", "HEALTHCARE": "HEALTHCARE", "HOME": "HOME", "LEISURE": "LEISURE",
    "PERSONAL": "PERSONAL_BUSINESS", "PICKUP-DROPOFF": "PICKUP_DROPOFF", "RELIGIOUS-CIVIC": "RELIGIOUS_OR_CIVIC",
    "SCHOOL": "SCHOOL", "SERVICE": "SERVICE_VEHICLE", "SHOP-MAJOR": "MAJOR_SHOPPING", "SOCIAL": "SOCIAL",
    "WORK": "WORK", "WORK AT HOME": "WORK", "PART_WORK": "PART_TIME_WORK", "SHOP-OTHER": "OTHER_SHOPPING",
}

# Columns of the activity start report.
START_COLUMNS = {
    "EAT_OUT": "EAT OUT", "ERRANDS": "ERRANDS", "HEALTHCARE": "HEALTHCARE", "LEISURE": "LEISURE",
    "PERSONAL": "PERSONAL", "RELIGIOUS": "RELIGIOUS-CIVIC", "SERVICE": "SERVICE", "SHOP_MAJOR": "SHOP-MAJOR",
    "SHOP_OTHER": "SHOP-OTHER", "SOCIAL": "SOCIAL", "WORK": "WORK", "WORK_PART": "PART_WORK",
    "WORK_HOME": "WORK AT HOME", "SCHOOL": "SCHOOL", "PICKUP": "PICKUP-DROPOFF", "HOME": "HOME",
}

# Modes whose trips are routed on the road network.
ROAD_MODES = [0, 9, 17, 18, 19, 20]
TRUCK_MODES = [17, 18, 19, 20]


def holds(cond: Column) -> Column:
    """Two-valued test: an unknown outcome counts as false."""
    return F.coalesce(cond, F.lit(False))


def first_match(cases: list[tuple[Column, object]], otherwise: object) -> Column:
    """Value of the first condition that holds."""
    (c0, v0), *rest = cases
    return reduce(lambda acc, cv: acc.when(cv[0], F.lit(cv[1])), rest, F.when(c0, F.lit(v0))).otherwise(
        F.lit(otherwise)
    )


def person_type() -> Column:
    """Nine-way person type from employment, school enrollment, hours and age."""
    age, works = F.col("age"), F.col("employment").isin(1, 4)
    return first_match(
        [
            (works & (F.col("work_hours") >= 30), "FULLTIME_WORKER"),
            (works, "PARTTIME_WORKER"),
            (F.col("school_enrollment").isin(2, 3) & (age > 18), "ADULT_STUDENT"),
            (age >= 65, "SENIOR"),
            (age > 18, "NONWORKER"),
            (age >= 16, "STUDENT_DRIVER"),
            (age >= 5, "SCHOOL_CHILD"),
            (age < 5, "PRESCHOOL"),
        ],
        "NONWORKER",
    )


def ptype() -> Column:
    """Person class 1..8 of the demand model; 0 where no rule applies, 2 is never given."""
    age = F.col("age")
    works, studies = holds(F.col("worker") == 1), holds(F.col("student") == 1)
    idle = ~works & ~studies
    return first_match(
        [
            (holds(age >= 18) & works & ~studies, 1),
            (holds(age >= 18) & studies, 3),
            (holds(age.between(18, 64)) & idle, 4),
            (holds(age >= 65) & idle, 5),
            (holds(age.between(16, 17)), 6),
            (holds(age.between(6, 16)), 7),
            (holds(age.between(0, 5)), 8),
        ],
        0,
    )


def pemploy() -> Column:
    """Employment class: 1 working, 3 not working, 4 under 16, 0 unknown."""
    age, worker = F.col("age"), F.col("worker")
    return first_match([(age < 16, 4), (worker == 1, F.when(age >= 16, 1).otherwise(0)),
                        (worker == 0, F.when(age >= 16, 3).otherwise(0))], 0)


def pstudent() -> Column:
    """School class: 1 up to age 18, then 2 student, 3 not, 0 unknown."""
    return first_match([(F.col("age") <= 18, 1), ((F.col("student") == 1) & (F.col("age") > 18), 2),
                        (F.col("student") == 0, 3)], 0)


def household_type() -> Column:
    """1 for one person, else 4."""
    return F.when(F.col("persons") == 1, 1).otherwise(4)
