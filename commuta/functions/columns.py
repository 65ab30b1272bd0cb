"""Arithmetic rules shared by every operator.

Division by zero is NULL, integer bins truncate toward zero, the two-argument
maximum is NULL when either side is, and random draws depend only on the row's
own key so that a recomputed task draws the same number.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MILES_PER_KM = 0.621371
METRES_PER_MILE = 1609.3
METRES_PER_MILE_RIDEHAIL = 1600
SQ_METRES_PER_ACRE = 4046.86


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(a: Column | str, b: Column | str) -> Column:
    """a / b, NULL where b is zero."""
    return F.try_divide(_col(a), _col(b))


def trunc_int(c: Column | str) -> Column:
    """Drop the fraction, toward zero."""
    return _col(c).cast("bigint")


def strict_max(a: Column, b: Column) -> Column:
    """Larger of two values, NULL when either is NULL."""
    return F.when(a.isNotNull() & b.isNotNull(), F.greatest(a, b))


def finite(c: Column | str) -> Column:
    """NULL in place of NaN and both infinities."""
    c = _col(c)
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def pad_id(c: Column | str, n: int) -> Column:
    """Left-pad an id with zeros to n characters; longer ids stay whole."""
    s = _col(c).cast("string")
    return F.when(F.length(s) >= n, s).otherwise(F.lpad(s, n, "0"))


def hash_uniform(key: Column | str, seed: int) -> Column:
    """Uniform draw in [0, 1) fixed by the row key and the seed (52 bits of MD5)."""
    text = F.concat(_col(key).cast("string"), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint") / F.lit(float(2**52))


def label(c: Column | str, names: dict) -> Column:
    """Map literal codes to labels; codes without a label give NULL."""
    c = _col(c)
    return reduce(
        lambda acc, kv: acc.when(c == kv[0], F.lit(kv[1])),
        list(names.items())[1:],
        F.when(c == next(iter(names)), F.lit(next(iter(names.values())))),
    )


def count_where(cond: Column) -> Column:
    """Rows meeting cond, NULL (not 0) when there is none."""
    return F.sum(F.when(cond, F.lit(1)))
