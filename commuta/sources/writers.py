"""Writers. Tables go to a path of their own; nothing is overwritten while it is read (see ``store``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commuta.sources import store

# Fixed value: consecutive rows of a matrix that are written together.
ROWS_PER_PART = 512
# Fixed value: consecutive rows of a matrix that are read together.
ROWS_PER_GROUP = 16


def write_csv(df: DataFrame, path: str, gzip: bool = False, header: bool = True, sep: str = ",") -> None:
    """One folder of CSV (or tab-separated) part files, header on each."""
    df.write.mode("overwrite").csv(path, header=header, sep=sep, compression="gzip" if gzip else "none")


def write_csv_tables(tables: dict[str, DataFrame], root: str, gzip: bool = False) -> None:
    """All tables of a run, one CSV folder per table."""
    for name, df in tables.items():
        write_csv(df, f"{root}/{name}", gzip)


def write_store_table(df: DataFrame, root: str, table: str, stage: str, year: int, replace: bool = False) -> None:
    """Write one stage and year of a population table, a folder of its own.

    An existing stage and year is refused unless ``replace`` is set. Then ``df`` becomes its current version in one step,
    and may itself be read from the version before.
    """
    if replace:
        store.replace(df, root, table, stage, year)
    else:
        df.write.mode("errorifexists").parquet(f"{root}/{table}/stage={stage}/year={year}")


def write_skims(df: DataFrame, path: str) -> None:
    """Long or wide skims as Parquet by period and path, so that slice filters prune folders.

    Rows are sorted by slice before they are written, so they are dealt by slice first, in parts of even sizes that follow
    the data: a task sorts a part, however many rows the skims have.
    """
    df.hint("rebalance", "timePeriod", "pathType").write.mode("overwrite").partitionBy("timePeriod", "pathType").parquet(path)


def write_matrices(matrices: DataFrame, path: str, rows_per_part: int = ROWS_PER_PART, dealt: bool = False) -> None:
    """Exported matrices (name, o_idx, values) as Parquet, in parts of consecutive rows of one matrix.

    Whole rows are shuffled and sorted for that, in as many tasks as a shuffle has: empty cells are nothing in a shuffle, so tasks sized by its
    bytes would sort many parts each. Not so ``dealt`` rows, of one measure and packed with the same ``rows_per_part`` (see
    ``skims.pack_od``): they come in parts, and each row is written as soon as it is made.

    A reader takes up to 4,096 rows of a row group at once, as many as the zones each, and empty cells are nothing in a file either: row
    groups are cut by rows, not by bytes alone.
    """
    if not dealt:
        part = F.floor((F.col("o_idx") - 1) / rows_per_part)
        tasks = int(matrices.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        matrices = matrices.repartition(tasks, "name", part).sortWithinPartitions("name", "o_idx")
    matrices.write.mode("overwrite").option("parquet.block.row.count.limit", ROWS_PER_GROUP).parquet(path)


def write_report_tables(reports: dict[str, DataFrame], database: str | None = None, path: str | None = None) -> None:
    """Create or replace one table per report, in a database or as Parquet folders under ``path``."""
    for name, df in reports.items():
        if path is not None:
            df.write.mode("overwrite").parquet(f"{path}/{name}")
        else:
            df.write.mode("overwrite").saveAsTable(f"{database}.{name}" if database else name)
