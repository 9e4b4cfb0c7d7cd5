"""Exact distinct counts next to other measures.

One distinct count goes along with the other measures: Spark removes repeats of (group, value) in every task
before the shuffle and spreads the rest by group and value, so a group that holds a large part of the rows is
not gathered. A second one in the same grouping would make Spark write every row once for each; it is
counted apart, over the group and its own column only, which no other part of the plan reads.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslens.functions.frames import with_row


def with_distinct_counts(
    frame: DataFrame, keys: list[str], measures: list[Column], counted: dict[str, str]
) -> DataFrame:
    """Keys, `measures` and, for every `name: column` of `counted`, the number of non-null values."""
    counts = [F.count_distinct(F.col(c)).alias(name) for name, c in counted.items()]
    result = frame.groupBy(*keys).agg(*measures, *counts[:1])
    for (name, column), count in zip(list(counted.items())[1:], counts[1:], strict=True):
        more = frame.select(*keys, column).groupBy(*keys).agg(count)
        result = _beside(result, more, keys, name)
    return result


def _beside(result: DataFrame, more: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Add the column `name` of `more`, one row per key on both sides; null keys are equal."""
    if not keys:
        return with_row(result, more)
    named = more.select(*[F.col(k).alias(f"_{k}") for k in keys], name)
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return result.join(named, same).select(*result.columns, name)
