"""Exact money arithmetic.

Money is summed as decimal, so totals do not depend on the order in which tasks
finish, and every ratio is rounded half up in decimal before it becomes a double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
COUNT = "decimal(20,0)"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: str | Column) -> Column:
    return _col(c).cast(MONEY)


def as_double(c: str | Column) -> Column:
    return _col(c).cast("double")


def rounded(c: Column, digits: int) -> Column:
    """Half-up rounding of a decimal, handed on as double."""
    return F.round(c, digits).cast("double")


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """``part`` as a percentage of ``whole`` for two counts; null when whole is 0."""
    return rounded(F.try_divide(part.cast(COUNT) * 100, whole.cast(COUNT)), digits)


def percent_of_money(part: Column, whole: Column, digits: int = 1) -> Column:
    """The same for two money totals."""
    return rounded(F.try_divide(part.cast("decimal(28,2)") * 100, whole.cast("decimal(28,2)")), digits)


def total(c: str | Column) -> Column:
    """Aggregate: exact money total."""
    return as_double(F.sum(money(c)))


def raw_mean(c: str | Column) -> Column:
    """Aggregate: unrounded decimal mean of the non-null values."""
    v = money(c)
    return F.try_divide(F.sum(v), F.count(v).cast(COUNT))


def mean(c: str | Column, digits: int = 2) -> Column:
    """Aggregate: mean rounded half up."""
    return rounded(raw_mean(c), digits)


def churned_count(flag: str | Column = "churn") -> Column:
    return F.sum(_col(flag).cast("bigint"))


def churn_rate(flag: str | Column = "churn", digits: int = 1) -> Column:
    """Aggregate: churned rows as a percentage of all rows."""
    return percent(churned_count(flag), F.count(F.lit(1)), digits)


def total_where(cond: Column, c: str | Column) -> Column:
    """Aggregate: money total of the rows that satisfy ``cond``, 0 when there are none."""
    return as_double(F.sum(F.when(cond, money(c)).otherwise(F.lit(0).cast(MONEY))))


def mean_where(cond: Column, c: str | Column, digits: int) -> Column:
    """Aggregate: mean over the rows that satisfy ``cond``, null when there are none."""
    return mean(F.when(cond, money(c)), digits)


def safe_divide(a: str | Column, b: str | Column) -> Column:
    """Null on a zero divisor or an operand that is not a number."""
    return F.try_divide(safe_number(a), safe_number(b))


def safe_number(c: str | Column) -> Column:
    return _col(c).try_cast("double")


def safe_cast(c: str | Column, to: str) -> Column:
    """Null instead of an error where the text does not parse."""
    return F.trim(_col(c).cast("string")).try_cast(to)


def capped(c: str | Column, ceiling: float | Column) -> Column:
    return F.least(_col(c), ceiling if isinstance(ceiling, Column) else F.lit(ceiling))


def zero_to(c: str | Column, fallback: str | Column) -> Column:
    """``fallback`` where the value is null or zero."""
    return F.coalesce(F.nullif(_col(c), F.lit(0)), _col(fallback))
