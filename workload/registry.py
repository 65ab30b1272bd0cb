"""Registry of queries: a builder over Tables and, where SQL can say it, the same query as SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from workload.fixtures import Tables, with_views

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
SQL: dict[str, str] = {}
#: Queries that round their values themselves, where these are few.
FINISHED: set[str] = set()


def add(name: str, build: Callable[[Tables], DataFrame], sql: str | None = None, finished: bool = False) -> None:
    assert name not in QUERIES, name
    QUERIES[name] = build
    if finished:
        FINISHED.add(name)
    if sql is not None:
        SQL[name] = with_views(sql)


def six_decimals(value: Column) -> Column:
    """Scaling first makes halves fall the same way as in the SQL engine."""
    return F.round(value * 1e6, 0) / 1e6


def six_decimals_of_many(value: Column) -> Column:
    """``six_decimals`` in plain arithmetic: Spark's ``round`` makes a decimal of every double, at several times the cost.

    ``rint`` differs in halves alone, which go away from zero; the difference to it is exact. Adding 0 keeps -0 out.
    """
    scaled = value * 1e6
    near = F.rint(scaled)
    return (F.when(F.abs(scaled - near) == 0.5, scaled + F.signum(scaled) * 0.5).otherwise(near) + 0.0) / 1e6


#: Up to so many doubles, a row's plain arithmetic stays far below the size of method that the JVM compiles.
MANY_DOUBLES = 8


def rounded(df: DataFrame) -> DataFrame:
    """Six decimals on every double, so that summation order does not show."""
    doubles = [n for n, t in df.dtypes if t == "double"]
    shorten = six_decimals_of_many if len(doubles) <= MANY_DOUBLES else six_decimals
    return df.select(*[shorten(F.col(f"`{n}`")).alias(n) if n in doubles else F.col(f"`{n}`") for n in df.columns])
