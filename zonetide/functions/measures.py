"""Aggregate expressions whose result does not depend on row order.

A plain ``avg(double)`` changes in its last bits with the order in which tasks
finish.  Money and rates are summed as decimals instead, to ``DIGITS`` places, which is
beyond what the schemas' money, rate and rating columns hold; 22 digits are left
for the sum.  Values that are no finite number surface as NaN in sums and averages.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


DIGITS = 6


def scaled(c: str | Column, digits: int) -> Column:
    """``c`` as a whole number of 10**-digits units; null where it is no finite number."""
    return F.rint(col(c) * float(10**digits)).try_cast("bigint")


def _odd(c: str | Column) -> Column:
    """How many values are NaN or infinite."""
    x = col(c).cast("double")
    return F.count_if(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))


def decimal_sum(c: str | Column) -> Column:
    return F.sum(col(c).try_cast(f"decimal(28,{DIGITS})"))


def exact_sum(c: str | Column) -> Column:
    return F.when(_odd(c) > 0, F.lit(float("nan"))).otherwise(decimal_sum(c).cast("double"))


def exact_avg(c: str | Column) -> Column:
    """Average of the known values, null when there are none."""
    return exact_sum(c) / F.nullif(F.count(col(c)), F.lit(0))


def flag_count(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def flag(condition: Column) -> Column:
    """1 when the condition holds, 0 when it is false or null."""
    return F.when(condition, 1).otherwise(0)


def percent(part: str | Column, whole: str | Column, digits: int = 1) -> Column:
    return F.round(col(part).cast("double") * 100.0 / col(whole), digits)


def rupees(total: Column) -> Column:
    """Currency label with thousands separators and no decimals."""
    return F.concat(F.lit("₹"), F.format_number(total, 0))
