"""Readers. Dirty values become NULL, not errors.

CSV and JSON schemas are declared, save for demand-model outputs and enrollment: their columns
differ by run and region, so the header names them and all are read as text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, LongType, StringType, StructField, StructType

from commuta.functions.columns import finite
from commuta.operators.landuse import padded_ids
from commuta.sources import schemas, store


def _file_order() -> Column:
    """Position of a row in its input: file, split, row; orders rows as the files list them."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"),
    )


def read_skims(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Long skims of one CSV file (plain or gzip) or of all files of a folder, with their file order."""
    rows = spark.read.schema(schemas.SKIMS).csv(
        path, header=True, nullValue="", nanValue="NaN", positiveInf="inf", negativeInf="-inf"
    )
    return rows.withColumn("ordinal", _file_order()).withColumns({m: _not_nan(m) for m in schemas.SKIM_MEASURES})


def _not_nan(c: str) -> Column:
    """NaN read as NULL; infinities stay for the cleaning step to judge."""
    return F.when(~F.isnan(c), F.col(c))


def read_store_table(
    spark: SparkSession, root: str, table: str, year: int | None = None, base_year: int | None = None,
    warm_start: bool = False,
) -> DataFrame:
    """A population table: the input stage in the base year or for a warm start, else that year's output.

    Tables lie under root/table, partitioned by stage and year; the filter prunes folders. A stage and year that has been
    replaced is read from its current version alone.
    """
    base = warm_start or year is None or year == base_year
    asked = (F.col("stage") == "input") if base else (F.col("stage") == "output") & (F.col("year") == year)
    newer = {k: v for k, v in store.replaced(spark, root, table).items() if k[0] == ("input" if base else "output") and (base or k[1] == year)}
    versions = [spark.read.parquet(folder) for folder in newer.values()]
    if newer and not base:
        return versions[0]
    for stage, y in newer:
        asked &= ~((F.col("stage") == stage) & (F.col("year") == y))
    try:
        versions.insert(0, spark.read.parquet(f"{root}/{table}").filter(asked).drop("stage", "year"))
    except AnalysisException:  # no plain folders: all that there is has been written as versions
        if not versions:
            raise
    return reduce(DataFrame.unionByName, versions)


def read_model_outputs(
    spark: SparkSession, folder: str, tables: list[str] = schemas.MODEL_OUTPUT_TABLES,
    prefix: str = schemas.MODEL_OUTPUT_PREFIX,
) -> dict[str, DataFrame]:
    """Demand-model output tables as text columns with padded ids; ``conform`` gives them types."""
    out = {}
    for table in tables:
        df = spark.read.csv(f"{folder}/{prefix}{table}.csv", header=True)
        out[table] = padded_ids(df, {c: n for c, n in schemas.ID_WIDTHS.items() if c in df.columns})
    return out


def read_trip_log(spark: SparkSession, root: str, tables: list[str] = schemas.TRIP_LOG_TABLES) -> dict[str, DataFrame]:
    """Trip-log and supply tables, one Parquet dataset per name."""
    return {t: spark.read.parquet(f"{root}/{t}") for t in tables}


def read_trip_log_jdbc(
    spark: SparkSession, url: str, partition: dict[str, dict[str, str]], **options: str
) -> dict[str, DataFrame]:
    """The same tables from a database, read in parallel.

    ``partition`` names the tables and for each partitionColumn, lowerBound, upperBound and
    numPartitions; a table without them would be read by one task and is refused.
    """
    needed = {"partitionColumn", "lowerBound", "upperBound", "numPartitions"}
    unsplit = [t for t, how in partition.items() if not needed <= set(how)]
    if unsplit:
        raise ValueError(f"tables without {sorted(needed)}: {unsplit}")
    return {t: spark.read.format("jdbc").options(url=url, dbtable=t, **options, **how).load() for t, how in partition.items()}


def read_block_locations(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema(schemas.BLOCK_LOCATION).csv(path, header=True)
    return rows.select(F.col("InputID").alias("block_id"), F.col("TargetID").alias("location"))


def read_zone_index(spark: SparkSession, path: str) -> DataFrame:
    """GEOID and zone id, both text; test it with ``zone_order_check``."""
    return spark.read.schema(schemas.ZONE_INDEX).csv(path, header=True)


def read_enrollment(spark: SparkSession, path: str) -> DataFrame:
    """School or college table; an unnamed leading column is dropped, ids and zone stay text."""
    rows = spark.read.csv(path, header=True)
    numbers = ("x", "y", "enrollment", "full_time_enrollment", "part_time_enrollment")
    return rows.select(*[
        F.col(f"`{c}`").try_cast("double").alias(c) if c in numbers else F.col(f"`{c}`")
        for c in rows.columns if not c.startswith("_c")
    ])


def read_feature_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed feature-service pages, one JSON document per file."""
    return spark.read.schema(schemas.FEATURE_PAGE).json(path, multiLine=True)


def read_result_pages(spark: SparkSession, path: str, row_schema: str) -> DataFrame:
    """Rows of landed result pages ``{count, next, results: [...]}``; fewer or more rows than announced are an error."""
    pages = _result_pages(spark, path, row_schema)
    seen = result_page_check(spark, path, row_schema).select(F.struct("announced", "landed")).scalar()
    pages = pages.select("results", seen.alias("_seen"))  # one value for all pages
    announced, landed = F.col("_seen.announced"), F.col("_seen.landed")
    short = F.raise_error(F.concat_ws(" ", F.lit("result pages announce"), announced.cast("string"), F.lit("rows, landed are"), landed.cast("string")))
    return pages.filter(F.when(announced == landed, True).otherwise(short)).select(F.explode("results").alias("r")).select("r.*")


def _result_pages(spark: SparkSession, path: str, row_schema: str) -> DataFrame:
    fields = StructType([
        StructField("count", LongType()), StructField("next", StringType()), StructField("results", ArrayType(DataType.fromDDL(row_schema))),
    ])
    return spark.read.schema(fields).json(path, multiLine=True)


def result_page_check(spark: SparkSession, path: str, row_schema: str) -> DataFrame:
    """One row: announced count, rows landed, whether they agree."""
    pages = _result_pages(spark, path, row_schema)
    seen = pages.agg(F.max("count").alias("announced"), F.coalesce(F.sum(F.size("results")), F.lit(0)).alias("landed"))
    return seen.withColumn("complete", (F.col("announced") == F.col("landed")).cast("int"))


def read_value_list(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """O, D, value rows of a delimited file without header, tab for .txt and else comma.

    Returns the rows whose fields are numbers, and the others counted by what is wrong with
    them (problem, rows): the first bad field, a missing one included.
    """
    raw = spark.read.schema(schemas.VALUE_LIST).csv(path, sep="\t" if path.endswith(".txt") else ",")
    typed = raw.withColumn("ordinal", _file_order()).select(
        F.col("o").try_cast("bigint").alias("o"), F.col("d").try_cast("bigint").alias("d"),
        finite(F.col("value").try_cast("double")).alias("value"), "ordinal",
    )
    problem = F.when(F.col("o").isNull(), "o").when(F.col("d").isNull(), "d").when(F.col("value").isNull(), "value")
    judged = typed.withColumn("problem", problem)
    rejects = judged.filter("problem is not null").groupBy("problem").agg(F.count("*").alias("rows"))
    return judged.filter("problem is null").drop("problem"), rejects


def latest_iteration(df: DataFrame, column: str = "iteration") -> DataFrame:
    """Rows of the highest iteration number; on a partition column only that folder is read."""
    newest = df.agg(F.max(F.col(column).cast("int"))).scalar()
    return df.filter(F.col(column).cast("int") == newest)


def newest_run(df: DataFrame, run: str = "run", modified: str = "modified", iteration: str = "iteration") -> DataFrame:
    """Rows of the run whose files were modified last, and of that run the highest iteration."""
    last = df.agg(F.max_by(run, F.struct(modified, run))).scalar()
    return latest_iteration(df.filter(F.col(run) == last), iteration)


def newest_iteration(spark: SparkSession, root: str, pattern: str = "*.csv*") -> str | None:
    """The folder RUN/ITERS/it.N of the newest run's highest iteration; None without one.

    Only file metadata is read: the listing as a table of paths and times, without the files' contents. One folder name comes to
    the driver.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(f"{root}/*/ITERS/it.*")
    parts = {c: F.regexp_extract("path", r"^(.*/([^/]+)/ITERS/it[.](\d+))/[^/]+$", k) for k, c in ((1, "folder"), (2, "run"), (3, "iteration"))}
    listed = files.select(F.col("modificationTime").alias("modified"), *[v.alias(c) for c, v in parts.items()]).filter("folder != ''")
    folders = listed.groupBy("run", "folder", F.col("iteration").cast("int").alias("iteration")).agg(F.max("modified").alias("modified"))
    found = folders.groupBy("run").agg(F.max("modified").alias("modified"), F.max_by("folder", "iteration").alias("folder"))
    return found.agg(F.max_by("folder", F.struct("modified", "run"))).first()[0]


def read_iterated_skims(spark: SparkSession, root: str) -> DataFrame:
    """Skims of the newest run's highest iteration, from CSV files under root/RUN/ITERS/it.N/; no other file is opened."""
    folder = newest_iteration(spark, root)
    if folder is None:
        raise FileNotFoundError(f"no iterations under {root}")
    return read_skims(spark, f"{folder}/*.csv*")
