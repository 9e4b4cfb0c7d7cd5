"""Registered gold tables that later reports read instead of the lines.

A rollup is stored as one version of its table, under the version of the lines it was built from. A report names the
version of the lines it is about; a rollup that was not built from it is refused.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslens.functions.bitmaps import bitmaps, counted, dense_ids, merged
from saleslens.operators import reports, rollups
from saleslens.operators.sales import COUNTED
from saleslens.sources.sinks import read_version, write_snapshot

ROLLUPS = {
    "monthly_trend": rollups.monthly_trend,
    "category_rollup": rollups.category_rollup,
    "regional_rollup": rollups.regional_rollup,
}
# Reports: the rollup each reads, and what it makes of it.
REPORTS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "top_months_by_sales": ("monthly_trend", reports.top_months_of),
    "category_margin_report": ("category_rollup", reports.category_margins_of),
    "regional_report": ("regional_rollup", reports.regions_of),
}


def publish(lines: DataFrame, folder: str, version: int, names: list[str] = tuple(ROLLUPS)) -> None:
    """Build rollups from `lines`, the lines of `version`; building one again replaces only that version."""
    for name in names:
        rollup = ROLLUPS[name]
        write_snapshot(rollup(lines.select(*rollup.inputs)), f"{folder.rstrip('/')}/{name}", version)


def published(spark: SparkSession, folder: str, name: str, version: int) -> DataFrame:
    """One rollup of one version of the lines; an error if it was not built from this version."""
    return read_version(spark, f"{folder.rstrip('/')}/{name}", version)


def report(spark: SparkSession, folder: str, name: str, version: int) -> DataFrame:
    """A report on a stored rollup. The lines are not read."""
    rollup, shown = REPORTS[name]
    return shown(published(spark, folder, rollup, version))


# Distinct orders and customers per month, kept as bitmaps, from which longer periods follow.

PERIODS = {
    "month": F.date_format,
    "quarter": lambda month, _: F.concat(F.year(month).cast("string"), F.lit("-Q"), F.quarter(month).cast("string")),
    "year": lambda month, _: F.year(month).cast("string"),
}


def publish_bitmaps(lines: DataFrame, folder: str, version: int) -> None:
    """Store which orders and customers every month holds. Lines without an order date belong to no month."""
    months = lines.where(F.col("order_date").isNotNull()).withColumn("month", F.trunc("order_date", "month"))
    for name, column in COUNTED.items():
        maps = bitmaps(months, ["month"], column, dense_ids(months, column))
        write_snapshot(maps, f"{folder.rstrip('/')}/{name}_by_month", version)


def cardinality_by_period(spark: SparkSession, folder: str, version: int) -> DataFrame:
    """(level, period, orders, customers) of months, quarters and years, from the stored bitmaps alone."""
    parts = []
    for level, label in PERIODS.items():
        keys = ["level", "period"]
        found = None
        for name in COUNTED:
            maps = published(spark, folder, f"{name}_by_month", version)
            period = maps.select(F.lit(level).alias("level"), label(F.col("month"), "yyyy-MM").alias("period"), "bucket", "bits")
            counts = counted(merged(period, keys), keys, name)
            found = counts if found is None else found.join(counts, keys, "full")
        parts.append(found.na.fill(0, list(COUNTED)))
    every = parts[0]
    for more in parts[1:]:
        every = every.unionByName(more)
    return every.orderBy("level", "period")
