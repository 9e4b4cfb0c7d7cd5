"""Exact totals and the two rounding rules of the catalogue.

Totals are added up as decimals and turned into doubles last. Ratios are taken on
doubles. `half_even` is the rounding of array libraries (scale, round to the nearest
even integer, scale back); `half_up` is the rounding of SQL.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from saleslens.schema import MONEY


def money(text_or_number: Column) -> Column:
    """Exact amount; null where the value is no number."""
    return text_or_number.try_cast(MONEY)


def double(value: Column) -> Column:
    return value.cast("double")


def total(name: str) -> Column:
    """Exact sum; an all-null group adds up to zero."""
    return F.coalesce(F.sum(F.col(name)), F.lit(0))


def total_double(name: str) -> Column:
    return double(total(name))


def mean(value: Column) -> Column:
    """Mean of an exact column: exact sum over the number of non-null values."""
    return F.try_divide(double(F.sum(value)), double(F.count(value)))


def mean_margin(name: str = "profit_margin") -> Column:
    """Mean of a two-place percentage, added up exactly."""
    return mean(F.col(name).cast("decimal(24,2)"))


def half_even(value: Column, places: int) -> Column:
    scale = F.lit(float(10**places))
    return F.rint(value * scale) / scale


def half_up(value: Column, places: int) -> Column:
    return F.round(value, places)


def percent_of(part: Column, whole: Column) -> Column:
    """`part` in percent of `whole`, two places; null where `whole` is zero."""
    return half_even(F.try_divide(double(part), double(whole)) * 100, 2)


def count_where(condition: Column) -> Column:
    return F.count_if(condition)
