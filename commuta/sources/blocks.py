"""Matrices as text blocks: a title, a line of destinations, one line an origin, and an empty line.

Files of a folder, taken in the order of their names, are one text. The writer sorts it globally, so a block may go on
in the next file; the reader carries a block's title and destinations over the borders of files and splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Titles of the blocks, before (drive) and after (transit) which the mode stands, and before the interval.
AUTO_TITLES = {
    "time": "Auto TTime for interval", "distance": "Auto Distance (m) for interval", "cost": "Auto Cost ($) for interval",
}
TRANSIT_TITLES = {
    "ivtt": " Transit IVTTime Skim @", "walk": " Transit Walk Access Time Skim @", "auto": " Transit Auto Access Time Skim @",
    "wait": " Transit Wait Time Skim @", "transfers": " Transit Transfers Skim @", "fare": " Transit Fare Skim @",
}


def write_matrix_blocks(
    cells: DataFrame, origins: DataFrame, destinations: DataFrame, measures: list[str], path: str, transit: bool = False
) -> None:
    """Write ``cells`` (``interval_end``, ``o``, ``d``, ``measures``, with ``mode`` if ``transit``) in blocks.

    Blocks go by interval, then mode, then the order of ``measures``; lines and columns by the ``zone`` numbers of ``origins``
    and ``destinations``. A cell that is not given is left empty. A line holds the values of one origin, so it is as long as there are
    destinations; lines are made where the cells of an origin meet, and only sorted after that.
    """
    titles = TRANSIT_TITLES if transit else AUTO_TITLES
    keys = ["interval_end", "mode"] if transit else ["interval_end"]
    listed = destinations.agg(F.array_sort(F.collect_set(F.col("zone").cast("bigint"))).alias("zones"))
    ordered = listed.scalar()
    places = listed.select(F.posexplode("zones").alias("p", "d")).select("d", (F.col("p") + 1).alias("p"))
    kept = cells.join(origins.select(F.col("zone").alias("o")).distinct(), "o", "left_semi")
    kept = kept.join(places, "d")
    values = F.struct("p", *[F.col(m).cast("string").alias(m) for m in measures])
    given = kept.groupBy(*keys, "o").agg(F.array_sort(F.collect_list(values)).alias("_given"))
    blocks = cells.select(*keys).distinct()
    zones = origins.agg(F.collect_set("zone")).scalar()
    rows = blocks.withColumn("o", F.explode(zones)).join(given, [*keys, "o"], "left").withColumn("_zones", ordered)

    def line(k: int, m: str) -> Column:
        """The values of an origin between commas: given cells among as many empty ones as lie between them."""
        place = F.col("_given.p")
        gap = F.transform(place, lambda p, i: p - F.coalesce(F.get(place, i - 1), F.lit(0)))
        text = F.zip_with(gap, "_given", lambda g, c: F.concat(F.repeat(F.lit(","), g), F.coalesce(c[m], F.lit(""))))
        rest = F.repeat(F.lit(","), F.size("_zones") + 1 - F.element_at(place, -1))
        whole = F.when(F.col("_given").isNull(), F.repeat(F.lit(","), F.size("_zones") + 1)).otherwise(F.concat(F.array_join(text, ""), rest))
        return F.struct(F.lit(k).alias("measure"), F.lit(2).alias("part"), F.col("o").cast("bigint").alias("o"), F.concat(F.col("o").cast("string"), whole).alias("value"))

    body = rows.select(*keys, F.explode(F.array(*[line(k, m) for k, m in enumerate(measures)])).alias("l")).select(*keys, "l.*")
    heads = blocks.withColumn("_zones", ordered).select(*keys, F.explode(F.array(*[
        F.struct(F.lit(k).alias("measure"), F.lit(part).alias("part"), F.lit(None).cast("bigint").alias("o"), text.alias("value"))
        for k, m in enumerate(measures)
        for part, text in (
            (0, F.concat(F.col("mode") if transit else F.lit(""), F.lit(titles[m]), F.col("interval_end").cast("string"))),
            (1, F.concat(F.lit(","), F.array_join("_zones", ","), F.lit(","))), (3, F.lit("")),
        )
    ])).alias("l")).select(*keys, "l.*")
    order = [*keys, "measure", "part", "o"]
    text = body.unionByName(heads).repartitionByRange(*order).sortWithinPartitions(*order)
    text.select("value").write.mode("overwrite").text(path)


def read_matrix_blocks(spark: SparkSession, path: str) -> DataFrame:
    """``mode`` (``AUTO`` for drive blocks), ``measure``, ``interval_end``, ``o``, ``d``, ``value`` of all given cells of block files.

    A split is read by one task; only its last title and destinations, a row each, are gathered to carry them on. Lines of
    a split that begin inside a block take them from the splits before. A title of neither kind is an error.
    """
    raw = spark.read.text(path)
    lines = raw.select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row")
    )
    header, title = F.col("value").startswith(","), (F.col("value") != "") & ~F.col("value").contains(",")
    lines = lines.withColumns({"_title": F.when(title, F.col("value")), "_zones": F.when(header, F.col("value"))})
    marks = lines.filter(title | header).groupBy("file", "start").agg(
        F.max_by("_title", F.when(title, F.col("row"))).alias("last_title"), F.max_by("_zones", F.when(header, F.col("row"))).alias("last_zones")
    )
    before = Window.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.select("file", "start").distinct().join(marks, ["file", "start"], "left").select(
        "file", "start", *[F.last(c, ignorenulls=True).over(before).alias(f"before_{c}") for c in ("last_title", "last_zones")]
    )
    inside = Window.partitionBy("file", "start").orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = lines.select("value", "file", "start", *[F.last(c, ignorenulls=True).over(inside).alias(c) for c in ("_title", "_zones")])
    placed = placed.filter((F.col("value") != "") & F.col("value").contains(",") & ~F.col("value").startswith(",")).join(splits, ["file", "start"])
    of = {"_title": F.coalesce("_title", "before_last_title"), "_zones": F.coalesce("_zones", "before_last_zones")}
    cells = placed.select("value", *[c.alias(n) for n, c in of.items()])
    zones, values = F.split("_zones", ","), F.split("value", ",")
    pairs = F.arrays_zip(F.slice(zones, 2, F.size(zones) - 2).alias("d"), F.slice(values, 2, F.size(zones) - 2).alias("v"))
    cells = cells.select("_title", values[0].cast("bigint").alias("o"), F.explode(pairs).alias("c")).filter("c.v != ''")
    unknown = F.raise_error(F.concat_ws(" ", F.lit("unknown block title"), "_title"))
    measure = mode = None
    for m, t in AUTO_TITLES.items():
        found = F.col("_title").startswith(t)
        measure, mode = (F.when(found, v) if w is None else w.when(found, v) for v, w in ((m, measure), ("AUTO", mode)))
    for m, t in TRANSIT_TITLES.items():
        found = F.col("_title").contains(t)
        measure = measure.when(found, m)
        mode = mode.when(found, F.substring_index("_title", t, 1))
    return cells.select(
        mode.otherwise(unknown).alias("mode"), measure.otherwise(unknown).alias("measure"), F.regexp_extract("_title", r"(\d+)$", 1).cast("bigint").alias("interval_end"),
        "o", F.col("c.d").cast("bigint").alias("d"), F.col("c.v").try_cast("double").alias("value"),
    )
