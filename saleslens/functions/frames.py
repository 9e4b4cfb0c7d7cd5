"""Helpers on whole frames."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def inputs(*columns: str) -> Callable:
    """Declare the silver columns an operator reads.

    Readers use the list to scan, join and derive nothing else.
    """

    def mark(operator):
        operator.inputs = list(columns)
        return operator

    return mark


def one_row(frame: DataFrame) -> Column:
    """The single row of `frame` as a struct column: an uncorrelated scalar subquery.

    Spark runs it once, however many expressions refer to it, and sends one row.
    """
    return frame.select(F.struct(*frame.columns)).scalar()


def with_row(frame: DataFrame, other: DataFrame) -> DataFrame:
    """Add the columns of the one-row frame `other` to every row of `frame`."""
    row = frame.select("*", one_row(other).alias("_row"))
    return row.select(*frame.columns, *[F.col("_row")[c].alias(c) for c in other.columns])


def unpivot(frame: DataFrame, columns: list[str], name: str, value: str, as_type) -> DataFrame:
    """Long form (name, value) of `columns`, all cast to `as_type`; other columns go."""
    cast = [F.col(c).cast(as_type).alias(c) for c in columns]
    return frame.select(*cast).unpivot([], columns, name, value)


def rising(*columns: str) -> list[Column]:
    """Sort order with nulls last, as data-frame libraries have it."""
    return [F.asc_nulls_last(c) for c in columns]


def without_null_keys(frame: DataFrame, keys: list[str]) -> DataFrame:
    """Drop rows whose group key is null, as data-frame libraries do when grouping."""
    return frame.dropna(subset=keys)
