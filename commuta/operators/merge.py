"""Reconciling tables between model iterations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from commuta.functions.columns import safe_div
from commuta.operators.joins import lookup
from commuta.operators.lineage import cut_lineage


def replace_households(base: DataFrame, updated: DataFrame) -> DataFrame:
    """All rows of any updated household replaced by its updated rows; other households kept."""
    ids = updated.select("household_id").distinct().withColumn("_new", F.lit(True))
    kept = lookup(base, ids, ["household_id"]).filter(F.col("_new").isNull())
    return updated.unionByName(kept.select(*base.columns))


def table_precedence(*stores: dict[str, DataFrame], required: list[str] | None = None) -> dict[str, DataFrame]:
    """For each table name the first store that has it; names in ``required`` must turn up."""
    merged: dict[str, DataFrame] = {}
    for store in stores:
        merged |= {name: df for name, df in store.items() if name not in merged}
    missing = [n for n in required or [] if n not in merged]
    if missing:
        raise ValueError(f"tables missing from every store: {missing}")
    return merged


def best_iteration(gaps: DataFrame, runs: int, burn_in: int = 3) -> DataFrame:
    """Of the last runs - burn_in iterations, the one with the least relative gap (earliest among equals).

    ``gaps`` has one row per model iteration. Fewer than ``runs`` rows is an error.
    """
    rows = gaps.agg(F.count("*")).scalar()
    last = gaps.orderBy(F.col("seq").desc()).limit(runs - burn_in).filter(F.col("relative_gap_min0").isNotNull())
    best = last.agg(
        F.min_by("iter", F.struct("relative_gap_min0", "seq")).alias("iter"),
        F.min("relative_gap_min0").alias("relative_gap_min0"),
    )
    too_few = F.raise_error(F.lit(f"fewer than {runs} iterations"))
    return best.withColumn("iter", F.when(rows < runs, too_few).otherwise(F.col("iter")))


def iteration_columns(df: DataFrame, loops: list, time: str = "time", loop: str = "loop", value: str = "value") -> DataFrame:
    """One row per time, one value column per listed iteration."""
    return df.groupBy(time).pivot(loop, loops).agg(F.first(value, ignorenulls=True))


def append_trips(new: DataFrame, external: DataFrame) -> DataFrame:
    """Trips of the run followed by the fixed external trips."""
    return new.unionByName(external, allowMissingColumns=True)


# Share of travel time felt at partial (f3) and full (f5) automation, free-flowing and congested,
# by value-of-time level; levels not listed use OTHER. Partial automation counts on highways only.
VOT_FACTORS = {0: {"f3": (0.8, 0.6), "f5": (0.6, 0.425)}}
OTHER_VOT_FACTORS = {"f3": (0.95, 0.85), "f5": (0.8, 0.6)}
BASELINE_VOT = 2
# Km per minute (as the run reports them) above which a pair counts as highway; congestion ratio.
HIGHWAY_SPEED = 80.0
CONGESTED_RATIO = 1.5


def time_factor_skims(counts: DataFrame, waits: DataFrame, iskims: DataFrame, vot_level: int) -> DataFrame:
    """Interval skims with travel time scaled by how automated and ride-hail trips feel it.

    ``counts`` are trips by (o_id, d_id, mode, av_type); pairs without trips take the
    shares of their origin, origins without trips keep their times. ``waits`` is the mean
    ride-hail wait per zone, 0 where unknown. Sums per pair are checkpointed: pair and
    origin shares both come from them.
    """
    if vot_level == BASELINE_VOT:
        return iskims
    mode, av, n = F.col("mode"), F.col("av_type"), F.col("trips")
    parts = {"none": (mode == 0) & (av == 0), "l3": (mode == 0) & (av == 1), "l5": (mode == 0) & (av == 2), "tnc": mode == 9}
    per_pair = cut_lineage(counts.groupBy(F.col("o_id").alias("o"), F.col("d_id").alias("d")).agg(
        F.sum("trips").alias("all"), *[F.sum(F.when(c, n).otherwise(0)).alias(k) for k, c in parts.items()]
    ))
    per_origin = per_pair.groupBy("o").agg(*[F.sum(c).alias(c) for c in ("all", *parts)])

    def shares(sums: DataFrame, name: str, *keys: str) -> DataFrame:
        return sums.select(*keys, F.struct(*[safe_div(k, "all").alias(k) for k in parts]).alias(name))

    pair, origin = shares(per_pair, "_pair", "o", "d"), shares(per_origin, "_origin", "o")
    wait = waits.select(F.col("zone").alias("o"), "avg_wait")
    by_pair = Window.partitionBy("o", "d").orderBy("interval_end")
    first = iskims.withColumns({
        "_free": F.first("time").over(by_pair) / 60.0, "_km": F.first("distance").over(by_pair) / 1000.0,
    })
    joined = (
        first.join(pair, ["o", "d"], "left")
        .join(origin.join(wait, "o", "left"), "o", "left")
        .withColumn("_s", F.coalesce("_pair", "_origin"))
    )
    highway = F.coalesce(safe_div("_km", "_free") > HIGHWAY_SPEED, F.lit(False))
    congested = F.coalesce(safe_div(F.col("time") / 60.0, "_free") > CONGESTED_RATIO, F.lit(False))
    felt = VOT_FACTORS.get(vot_level, OTHER_VOT_FACTORS)

    def by_congestion(key: str):
        free, slow = felt[key]
        return F.when(congested, slow).otherwise(free)

    f3 = F.when(highway, by_congestion("f3")).otherwise(1.0)
    f5 = by_congestion("f5")
    t = F.col("time")
    with_wait = F.when(t > 0, (F.coalesce("avg_wait", F.lit(0.0)) + t) / t).otherwise(1.0)
    s = {k: F.col(f"_s.{k}") for k in parts}
    factor = s["none"] + s["l3"] * f3 + s["l5"] * f5 + s["tnc"] * with_wait
    return joined.withColumn("time", t * F.coalesce(factor, F.lit(1.0))).select(*iskims.columns)
