"""Exploratory profiles: descriptive statistics, distributions, correlations."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslens.functions.distinct import with_distinct_counts
from saleslens.functions.frames import inputs, rising, unpivot
from saleslens.functions.numbers import count_where, double, half_even
from saleslens.functions.order_stats import quantiles
from saleslens.schema import MONEY, NUMERIC_COLUMNS

DERIVED_NUMERIC = [
    "profit_margin",
    "discount_amount",
    "shipping_days",
    "order_year",
    "order_month",
    "order_quarter",
]
QUARTILES = [0.25, 0.5, 0.75]


def _moments(name: str) -> Column:
    return F.struct(
        F.count(name).alias("count"),
        half_even(F.avg(name), 2).alias("mean"),
        half_even(F.stddev_samp(name), 2).alias("std"),
        half_even(F.min(name), 2).alias("min"),
        half_even(F.max(name), 2).alias("max"),
    )


def describe_numeric(frame: DataFrame, columns: list[str] = NUMERIC_COLUMNS) -> DataFrame:
    """(field, count, mean, std, min, p25, p50, p75, max), exact, two places."""
    numbers = frame.select(*[double(F.col(c)).alias(c) for c in columns])
    moments = numbers.agg(*[_moments(c).alias(c) for c in columns])
    moments = moments.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("m")) for c in columns]))
    )
    moments = moments.select("field", "m.*")
    values = unpivot(numbers, columns, "field", "value", "double")
    points = quantiles(values, "field", "value", QUARTILES)
    return moments.join(points, "field", "left").select(
        "field",
        "count",
        "mean",
        "std",
        "min",
        *[half_even(F.col("quantiles")[i], 2).alias(f"p{n}") for i, n in enumerate((25, 50, 75))],
        "max",
    )


def _exact_bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Number of the equal-width bin; bins are closed on the left, the last on both sides.

    Whole-number division of exact values puts a value that lies on an edge into the
    bin it opens. Without any spread the range is widened by half a unit either way.
    """
    span = F.nullif(high - low, F.lit(0).cast("decimal(1,0)"))
    step = F.least(F.call_function("div", (value - low) * bins, span), F.lit(bins - 1))
    return F.when(span.isNull(), bins // 2).otherwise(step).cast("int")


def histogram(frame: DataFrame, columns: list[str] = NUMERIC_COLUMNS, bins: int = 40) -> DataFrame:
    """(field, bin, bin_start, bin_end, count) of the bins that hold a value."""
    values = unpivot(frame, columns, "field", "value", MONEY.simpleString()).dropna()
    # Broadcast: exactly one row per column of the call.
    spans = values.groupBy("field").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    low, high = F.col("low"), F.col("high")
    counted = (
        values.join(F.broadcast(spans), "field")
        .groupBy("field", "low", "high", _exact_bin(F.col("value"), low, high, bins).alias("bin"))
        .agg(F.count("*").alias("count"))
    )
    flat = low == high
    start = F.when(flat, double(low) - 0.5).otherwise(double(low))
    width = F.when(flat, 1.0).otherwise(double(high) - double(low)) / bins
    return counted.select(
        "field",
        "bin",
        half_even(start + width * F.col("bin"), 4).alias("bin_start"),
        half_even(start + width * (F.col("bin") + 1), 4).alias("bin_end"),
        "count",
    ).orderBy("field", "bin")


@inputs("profit_margin")
def histogram_clipped(
    frame: DataFrame, column: str = "profit_margin", low: int = -100, high: int = 100, bins: int = 50
) -> DataFrame:
    """Histogram with outliers moved to the ends of the range."""
    clipped = F.least(F.greatest(F.col(column), F.lit(float(low))), F.lit(float(high)))
    present = F.when(F.col(column).isNotNull(), clipped)
    return histogram(frame.select(present.alias(column)), [column], bins)


@inputs("shipping_days")
def histogram_edges(
    frame: DataFrame, column: str = "shipping_days", first: int = 0, last: int = 14
) -> DataFrame:
    """(bin, count) between whole-number edges; values outside are left out, the last edge is in."""
    inside = frame.where(F.col(column).between(first, last))
    position = F.least(F.floor(column), F.lit(last - 1)).cast("int")
    return inside.groupBy(position.alias("bin")).agg(F.count("*").alias("count")).orderBy("bin")


def value_counts(
    frame: DataFrame, columns: list[str] = ("region", "category", "segment", "ship_mode")
) -> DataFrame:
    """(field, value, count), most frequent first; nulls are not counted."""
    return (
        unpivot(frame, list(columns), "field", "value", "string")
        .dropna()
        .groupBy("field", "value")
        .agg(F.count("*").alias("count"))
        .orderBy("field", F.desc("count"), "value")
    )


def correlation_matrix(frame: DataFrame, columns: list[str] = NUMERIC_COLUMNS) -> DataFrame:
    """(field_x, field_y, correlation): Pearson over the rows where both are known, six places."""
    pairs = [(x, y) for x in columns for y in columns]
    both = {
        (x, y): half_even(F.corr(double(F.col(x)), double(F.col(y))), 6).alias(f"{x}|{y}")
        for i, x in enumerate(columns)
        for y in columns[i:]
    }
    one = frame.agg(*both.values())
    cells = [
        F.struct(
            F.lit(x).alias("field_x"),
            F.lit(y).alias("field_y"),
            F.col(f"`{x}|{y}`" if (x, y) in both else f"`{y}|{x}`").alias("correlation"),
        )
        for x, y in pairs
    ]
    return one.select(F.inline(F.array(*cells)))


@inputs("order_date", "order_id", "customer_id", "product_id")
def extent_and_cardinality(frame: DataFrame) -> DataFrame:
    """One row: first and last order date; distinct dates, orders, customers, products."""
    span = [F.min("order_date").alias("first_order"), F.max("order_date").alias("last_order")]
    counted = {
        "order_dates": "order_date",
        "orders": "order_id",
        "customers": "customer_id",
        "products": "product_id",
    }
    return with_distinct_counts(frame, [], span, counted)


@inputs("row_id", "product_name", "category", "sales", "profit", "discount", "profit_margin", "is_loss")
def loss_items(frame: DataFrame, n: int = 10) -> DataFrame:
    """The first `n` loss lines in row order."""
    return (
        frame.where("is_loss")
        .orderBy(*rising("row_id", "product_name", "category", "sales", "profit", "discount"))
        .limit(n)
        .select(
            "row_id",
            "product_name",
            "category",
            *[double(F.col(c)).alias(c) for c in ("sales", "profit", "discount")],
            "profit_margin",
        )
    )


@inputs("is_loss")
def loss_share(frame: DataFrame) -> DataFrame:
    """One row: number of loss lines and their share of all lines in percent."""
    losses = count_where(F.col("is_loss"))
    share = F.try_divide(double(losses), double(F.count("*"))) * 100
    return frame.agg(losses.alias("loss_items"), half_even(share, 1).alias("loss_pct"))


def preview(frame: DataFrame, n: int = 5, order: list[str] = ("row_id",)) -> DataFrame:
    """The first `n` rows in a stated order; a plain limit would return any rows."""
    rest = [c for c in frame.columns if c not in order]
    return frame.orderBy(*rising(*order, *rest)).limit(n)
