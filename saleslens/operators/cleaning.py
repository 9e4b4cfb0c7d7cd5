"""Cleaning: raw text rows in, typed and enriched order lines out.

The order of the steps is part of the result: duplicates go first, gaps are filled
with statistics of the remaining raw values, and only then are texts turned into
types, so a text that is no number or date stays a gap.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from saleslens.functions.dates import iso_date
from saleslens.functions.frames import unpivot, with_row
from saleslens.functions.numbers import double, half_even, money
from saleslens.functions.order_stats import quantiles
from saleslens.functions.repeats import split
from saleslens.functions.text import strip, title_case, zero_pad
from saleslens.schema import (
    CATEGORY_COLUMNS,
    DATE_COLUMNS,
    DERIVED_FROM,
    LINE_KEY,
    LOSS_THRESHOLD,
    NUMERIC_COLUMNS,
    POSTAL_CODE_WIDTH,
    REGION_ALIASES,
    UNKNOWN,
    UNKNOWN_POSTAL_CODE,
)
from saleslens.session import TABLE_CODEC, freed_shuffles, short_methods

INTEGER_TYPES = {"quantity": "bigint", "row_id": "bigint"}


def _present(raw: DataFrame, columns) -> list[str]:
    return [c for c in columns if c in raw.columns]


# Duplicates


def drop_exact_duplicates(raw: DataFrame) -> DataFrame:
    """One of equal rows. Rows that surely have no equal are not shuffled."""
    once, again = split(raw, raw.columns)
    return once.unionByName(again.distinct())


def drop_key_duplicates(raw: DataFrame, keys: list[str] = LINE_KEY) -> DataFrame:
    """Keep the first row of every key; null keys are equal to each other.

    First means lowest row number; the other columns decide between equal ones, so the
    choice does not depend on how the input is partitioned. Rows whose key surely occurs
    once are neither shuffled nor sorted. Of the others Spark keeps one per key in every
    task before the shuffle, so a key held by many rows is no burden.
    """
    keys = _present(raw, keys)
    if not keys:
        return raw
    first = [F.col("row_id").try_cast("bigint").asc_nulls_last()] if "row_id" in raw.columns else []
    order = first + [F.col(c).asc_nulls_last() for c in raw.columns if c not in keys]
    if not order:
        return drop_exact_duplicates(raw)
    once, again = split(raw, keys)
    place = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return once.unionByName(again.withColumn("_place", place).where(F.col("_place") == 1).drop("_place"))


def remove_duplicates(raw: DataFrame) -> DataFrame:
    """Exact and key duplicates. Equal rows have equal keys, so the key rule covers both."""
    if _present(raw, LINE_KEY):
        return drop_key_duplicates(raw)
    return drop_exact_duplicates(raw)


# Gaps


def medians(raw: DataFrame) -> DataFrame:
    """One row per numeric column: (field, fill), the exact median of its parsable values."""
    columns = _present(raw, NUMERIC_COLUMNS)
    parsed = raw.select(*[double(money(F.col(c))).alias(c) for c in columns])
    values = unpivot(parsed, columns, "field", "value", "double")
    middle = quantiles(values, "field", "value", [0.5])
    return middle.select("field", F.col("quantiles")[0].cast("string").alias("fill"))


def modes(raw: DataFrame) -> DataFrame:
    """One row per category column: (field, fill), the most frequent text, smallest on ties."""
    values = unpivot(raw, _present(raw, CATEGORY_COLUMNS), "field", "value", "string")
    counts = values.dropna().groupBy("field", "value").agg(F.count("*").alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("rank"), "value"))
    return counts.groupBy("field").agg(best["value"].alias("fill"))


def fill_values(raw: DataFrame) -> DataFrame:
    """(field, fill) of every column whose fill is a statistic."""
    return medians(raw).unionByName(modes(raw))


def _with_fills(raw: DataFrame, statistics: DataFrame) -> DataFrame:
    """Add the map `_fills` (field -> fill), computed once, to every row."""
    pairs = F.collect_list(F.struct("field", "fill"))
    return with_row(raw, statistics.agg(F.map_from_entries(pairs).alias("_fills")))


def _fill(name: str) -> Column:
    return F.col("_fills")[name]


def _filled(raw: DataFrame, fills: dict[str, Column]) -> DataFrame:
    columns = [c for c in raw.columns if c != "_fills"]
    return raw.select(
        *[F.coalesce(F.col(c), fills[c]).alias(c) if c in fills else F.col(c) for c in columns]
    )


def _mode_or_unknown(name: str) -> Column:
    return F.coalesce(_fill(name), F.lit(UNKNOWN))


def impute_median(raw: DataFrame) -> DataFrame:
    return _filled(_with_fills(raw, medians(raw)), {c: _fill(c) for c in NUMERIC_COLUMNS})


def impute_postal(raw: DataFrame) -> DataFrame:
    return _filled(raw, {"postal_code": F.lit(UNKNOWN_POSTAL_CODE)})


def impute_mode(raw: DataFrame) -> DataFrame:
    return _filled(
        _with_fills(raw, modes(raw)), {c: _mode_or_unknown(c) for c in CATEGORY_COLUMNS}
    )


def impute_unknown(raw: DataFrame) -> DataFrame:
    """Every column without a rule of its own; dates too, which then fail to parse."""
    ruled = {*NUMERIC_COLUMNS, *CATEGORY_COLUMNS, "postal_code"}
    return raw.na.fill(UNKNOWN, [c for c in raw.columns if c not in ruled])


def impute(raw: DataFrame) -> DataFrame:
    """All four rules, with the statistics of all columns in one subquery."""
    rules = {c: F.lit(UNKNOWN) for c in raw.columns}
    rules |= {c: _fill(c) for c in NUMERIC_COLUMNS}
    rules |= {c: _mode_or_unknown(c) for c in CATEGORY_COLUMNS}
    rules["postal_code"] = F.lit(UNKNOWN_POSTAL_CODE)
    return _filled(_with_fills(raw, fill_values(raw)), rules)


# Types


def _date(name: str) -> Column:
    return iso_date(F.col(name))


def _whole_number(name: str) -> Column:
    kind = INTEGER_TYPES[name]
    return F.coalesce(F.col(name).try_cast("decimal(38,6)").try_cast(kind), F.lit(0).cast(kind))


def _with(raw: DataFrame, expression: Callable[[str], Column], columns) -> DataFrame:
    return raw.withColumns({c: expression(c) for c in _present(raw, columns)})


def cast_dates(raw: DataFrame) -> DataFrame:
    return _with(raw, _date, DATE_COLUMNS)


def cast_numerics(raw: DataFrame) -> DataFrame:
    return _with(raw, lambda c: money(F.col(c)), NUMERIC_COLUMNS)


def normalize_postal(raw: DataFrame) -> DataFrame:
    return _with(raw, lambda c: zero_pad(F.col(c), POSTAL_CODE_WIDTH), ["postal_code"])


def cast_ints(raw: DataFrame) -> DataFrame:
    """Whole numbers, cut towards zero; zero where there is no number."""
    return _with(raw, _whole_number, INTEGER_TYPES)


# Texts


def standardize_text(raw: DataFrame) -> DataFrame:
    # Two steps, as one expression would hold the stripping once for every use that the title case makes of it.
    stripped = _with(raw, lambda c: strip(F.col(c)), CATEGORY_COLUMNS)
    return _with(stripped, lambda c: title_case(F.col(c)), CATEGORY_COLUMNS)


def _alias(name: Column, aliases: dict[str, str]) -> Column:
    known = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
    return F.coalesce(known[name], name)


def map_region_alias(raw: DataFrame, aliases: dict[str, str] = REGION_ALIASES) -> DataFrame:
    """Replace known region names; others pass through."""
    return _with(raw, lambda c: _alias(F.col(c), aliases), ["region"] if aliases else [])


# Derived columns


def profit_margin() -> Column:
    ratio = F.try_divide(double(F.col("profit")), double(F.col("sales")))
    return F.when(F.col("sales") > 0, half_even(ratio * 100, 2)).otherwise(F.lit(0.0))


def discount_amount() -> Column:
    return half_even(double(F.col("sales")) * double(F.col("discount")), 2)


def shipping_days() -> Column:
    return F.coalesce(F.datediff("ship_date", "order_date"), F.lit(0))


def order_day_of_week() -> Column:
    return F.date_format("order_date", "EEEE")


def is_loss(threshold: float = LOSS_THRESHOLD) -> Column:
    """A line without a known profit is not a loss."""
    return F.coalesce(F.col("profit") < threshold, F.lit(False))


_DERIVED = {
    "profit_margin": profit_margin,
    "discount_amount": discount_amount,
    "shipping_days": shipping_days,
    "order_year": lambda: F.year("order_date"),
    "order_month": lambda: F.month("order_date"),
    "order_quarter": lambda: F.quarter("order_date"),
    "order_day_of_week": order_day_of_week,
    "is_loss": is_loss,
}


def derive(typed: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Add the derived columns (or some of them) whose inputs are present."""
    return typed.withColumns(
        {
            name: _DERIVED[name]()
            for name, needs in DERIVED_FROM.items()
            if (columns is None or name in columns) and set(needs) <= set(typed.columns)
        }
    )


def date_parts(typed: DataFrame) -> DataFrame:
    return derive(typed, ["order_year", "order_month", "order_quarter"])


def typed_and_tidied(filled: DataFrame) -> DataFrame:
    """Types, text rules and region names of all columns."""
    return (
        filled.transform(cast_dates)
        .transform(cast_numerics)
        .transform(normalize_postal)
        .transform(cast_ints)
        .transform(standardize_text)
        .transform(map_region_alias)
    )


def deduplicated(raw: DataFrame, staging: str | None = None) -> DataFrame:
    """Rows without duplicates, written to `staging` and read back if it is given."""
    kept = remove_duplicates(raw)
    if staging is None:
        return kept
    with freed_shuffles(raw.sparkSession):
        kept.write.mode("overwrite").parquet(staging, compression=TABLE_CODEC)
    return raw.sparkSession.read.schema(kept.schema).parquet(staging)


def clean(raw: DataFrame, staging: str | None = None) -> DataFrame:
    """The whole chain, lazily.

    The fill statistics and the rows both need the deduplicated rows. With `staging`, a
    folder all executors share, these are written there once; the statistics then read
    only their own columns, and nothing is deduplicated again if an executor is lost.
    """
    short_methods(raw.sparkSession)
    kept = deduplicated(raw, staging)
    return impute(kept).transform(typed_and_tidied).transform(derive)
