"""Sales analytics over cleaned order lines.

Rows whose group key is null are left out, an unordered tie is settled by the group
keys, and a ratio with a zero divisor is null.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from saleslens.functions.distinct import with_distinct_counts
from saleslens.functions.frames import inputs, without_null_keys
from saleslens.functions.numbers import (
    count_where,
    double,
    half_even,
    mean,
    mean_margin,
    percent_of,
    total,
    total_double,
)
from saleslens.schema import DISCOUNT_BANDS, PRODUCT_KEY, TOP_N
from saleslens.sources.layers import kept

MEASURES = {
    "sales": lambda: total("sales"),
    "profit": lambda: total("profit"),
    "quantity": lambda: F.coalesce(F.sum("quantity"), F.lit(0)),
    "avg_discount": lambda: mean(F.col("discount")),
}
COUNTED = {"orders": "order_id", "customers": "customer_id"}
AMOUNTS = ("sales", "profit")


def grouped(lines: DataFrame, keys: list[str], *measures: str) -> DataFrame:
    """Keys and measures; amounts stay exact until `presented`."""
    lines = without_null_keys(lines, keys)
    added = [MEASURES[m]().alias(m) for m in measures if m in MEASURES]
    return with_distinct_counts(lines, keys, added, {m: COUNTED[m] for m in measures if m in COUNTED})


def presented(result: DataFrame) -> DataFrame:
    """Exact amounts as doubles."""
    return result.withColumns({c: double(F.col(c)) for c in AMOUNTS if c in result.columns})


def margin(name: str = "profit_margin") -> Column:
    return percent_of(F.col("profit"), F.col("sales")).alias(name)


def discount_pct() -> Column:
    return half_even(F.col("avg_discount") * 100, 2).alias("avg_discount_pct")


def top(n: int | None, default: int = TOP_N) -> int:
    if n is None:
        return default
    if n < 1:
        raise ValueError(f"n must be positive, got {n}")
    return n


def year_month() -> Column:
    return F.date_format("order_date", "yyyy-MM")


# Key figures


@inputs("order_id", "customer_id", "sales", "profit", "discount", "profit_margin", "is_loss")
def kpi_summary(lines: DataFrame) -> DataFrame:
    """One row of key figures.

    The mean order value is the sales of lines with an order over the number of orders,
    which equals the mean of the order totals without building them.
    """
    share = F.try_divide(double(count_where(F.col("is_loss"))), double(F.count("*")))
    sums = [
        half_even(total_double("sales"), 2).alias("total_sales"),
        half_even(total_double("profit"), 2).alias("total_profit"),
        double(F.sum(F.when(F.col("order_id").isNotNull(), F.col("sales")))).alias("ordered"),
        half_even(mean_margin(), 2).alias("avg_profit_margin_pct"),
        half_even(mean(F.col("discount")) * 100, 2).alias("overall_discount_rate_pct"),
        half_even(share * 100, 2).alias("loss_line_items_pct"),
    ]
    counted = {"total_orders": "order_id", "total_customers": "customer_id"}
    per_order = F.try_divide(F.col("ordered"), double(F.col("total_orders")))
    return with_distinct_counts(lines, [], sums, counted).select(
        "total_sales",
        "total_profit",
        "total_orders",
        "total_customers",
        half_even(per_order, 2).alias("avg_order_value"),
        "avg_profit_margin_pct",
        "overall_discount_rate_pct",
        "loss_line_items_pct",
    )


# Trends. Lines without an order date belong to no period.


@inputs("order_date", "order_id", "sales", "profit")
def monthly_sales_trend(lines: DataFrame) -> DataFrame:
    months = lines.withColumn("year_month", year_month())
    result = grouped(months, ["year_month"], "sales", "profit", "orders")
    return presented(result.withColumn("profit_margin", margin())).orderBy("year_month")


@inputs("order_year", "order_quarter", "order_id", "sales", "profit")
def quarterly_sales_trend(lines: DataFrame) -> DataFrame:
    label = F.concat(F.col("order_year").cast("string"), F.lit("-Q"), F.col("order_quarter").cast("string"))
    quarters = lines.withColumn("year_quarter", label)
    result = grouped(quarters, ["year_quarter"], "sales", "profit", "orders")
    return presented(result.withColumn("profit_margin", margin())).orderBy("year_quarter")


@inputs("order_year", "order_id", "customer_id", "sales", "profit")
def yearly_sales_trend(lines: DataFrame) -> DataFrame:
    result = grouped(lines, ["order_year"], "sales", "profit", "orders", "customers")
    return presented(result.withColumn("profit_margin", margin())).orderBy("order_year")


# Categories


@inputs("category", "order_id", "sales", "profit", "quantity", "discount")
def category_performance(lines: DataFrame) -> DataFrame:
    result = grouped(lines, ["category"], "sales", "profit", "quantity", "orders", "avg_discount")
    result = result.withColumns({"profit_margin": margin(), "avg_discount_pct": discount_pct()})
    return presented(result).orderBy(F.desc("sales"), "category")


@inputs("category", "sub_category", "sales", "profit", "quantity", "discount")
def subcategory_performance(lines: DataFrame) -> DataFrame:
    keys = ["category", "sub_category"]
    result = grouped(lines, keys, "sales", "profit", "quantity", "avg_discount")
    return presented(result.withColumn("profit_margin", margin())).orderBy(F.desc("profit"), *keys)


# Regions


@inputs("region", "order_id", "customer_id", "sales", "profit", "discount")
def regional_performance(lines: DataFrame) -> DataFrame:
    result = grouped(lines, ["region"], "sales", "profit", "orders", "customers", "avg_discount")
    result = result.withColumns({"profit_margin": margin(), "avg_discount_pct": discount_pct()})
    return presented(result).orderBy(F.desc("sales"), "region")


def region_by_category(lines: DataFrame, amount: str, categories: list[str] | None = None) -> DataFrame:
    """Regions as rows, one column per category, two places; null where there are no lines.

    Without `categories` the cells, one row per region and category, are written to the shared folder first: the
    lines are read once, and the columns are looked up in that small table.
    """
    cells = without_null_keys(lines, ["region", "category"]).groupBy("region", "category").agg(
        half_even(total_double(amount), 2).alias("cell")
    )
    if categories is None:
        cells = kept(cells, "cells")
    pivot = cells.groupBy("region").pivot("category", categories)
    return pivot.agg(F.first("cell", ignorenulls=True)).orderBy("region")


@inputs("region", "category", "sales")
def regional_category_sales_pivot(lines: DataFrame, categories: list[str] | None = None) -> DataFrame:
    """Sales by region and category; zero where there are no lines."""
    return region_by_category(lines, "sales", categories).na.fill(0.0)


@inputs("state", "region", "sales", "profit")
def state_performance(lines: DataFrame) -> DataFrame:
    keys = ["state", "region"]
    result = grouped(lines, keys, "sales", "profit").withColumn("profit_margin", margin())
    return presented(result).orderBy(F.desc("sales"), *keys)


# Products and customers


@inputs(*PRODUCT_KEY, "sales", "profit", "quantity")
def top_products_by_sales(lines: DataFrame, n: int | None = None) -> DataFrame:
    result = grouped(lines, PRODUCT_KEY, "sales", "profit", "quantity")
    result = result.orderBy(F.desc("sales"), *PRODUCT_KEY).limit(top(n))
    return presented(result.withColumn("profit_margin", margin()))


@inputs(*PRODUCT_KEY, "sales", "profit", "quantity", "discount")
def loss_making_products(lines: DataFrame) -> DataFrame:
    """Products whose exact total profit is negative, largest loss first."""
    result = grouped(lines, PRODUCT_KEY, "sales", "profit", "quantity", "avg_discount")
    result = result.where(F.col("profit") < 0)
    result = result.withColumns({"profit_margin": margin(), "avg_discount_pct": discount_pct()})
    return presented(result.orderBy("profit", *PRODUCT_KEY))


@inputs("segment", "order_id", "customer_id", "sales", "profit")
def segment_performance(lines: DataFrame) -> DataFrame:
    result = grouped(lines, ["segment"], "sales", "profit", "orders", "customers")
    per_order = F.try_divide(double(F.col("sales")), double(F.col("orders")))
    result = result.withColumns(
        {"profit_margin": margin(), "avg_order_value": half_even(per_order, 2)}
    )
    return presented(result).orderBy(F.desc("sales"), "segment")


CUSTOMER_KEY = ["customer_id", "customer_name", "segment"]


@inputs(*CUSTOMER_KEY, "order_id", "sales", "profit")
def top_customers_by_sales(lines: DataFrame, n: int | None = None) -> DataFrame:
    """The `n` customers with the highest sales; orders are counted for these only."""
    best = grouped(lines, CUSTOMER_KEY, "sales", "profit")
    best = best.orderBy(F.desc("sales"), *CUSTOMER_KEY).limit(top(n))
    # Broadcast: `n` rows.
    theirs = lines.select(*CUSTOMER_KEY, "order_id").join(F.broadcast(best), CUSTOMER_KEY)
    counted = theirs.distinct().groupBy(*CUSTOMER_KEY, *AMOUNTS).agg(
        F.count("order_id").alias("orders")
    )
    return presented(counted).orderBy(F.desc("sales"), *CUSTOMER_KEY)


# Discounts and shipping


def discount_band() -> Column:
    """Number of the band, from 1, closed on the right; null outside all bands."""
    discount = F.col("discount")
    band = F.when(discount <= F.lit(DISCOUNT_BANDS[0][0]).cast("decimal(4,2)"), F.lit(None))
    for number, (_, high, _) in enumerate(DISCOUNT_BANDS, start=1):
        band = band.when(discount <= F.lit(high).cast("decimal(4,2)"), number)
    return band


@inputs("discount", "order_id", "sales", "profit", "profit_margin")
def discount_impact_analysis(lines: DataFrame) -> DataFrame:
    """Mean line margin, totals and lines per discount band that occurs, in band order."""
    labels = F.array(*[F.lit(label) for _, _, label in DISCOUNT_BANDS])
    bands = lines.groupBy(discount_band().alias("band")).agg(
        half_even(mean_margin(), 2).alias("avg_profit_margin"),
        total_double("sales").alias("total_sales"),
        total_double("profit").alias("total_profit"),
        F.count("order_id").alias("n_transactions"),
    )
    return (
        bands.where(F.col("band").isNotNull())
        .orderBy("band")
        .select(
            F.element_at(labels, F.col("band")).alias("discount_bucket"),
            "avg_profit_margin",
            "total_sales",
            "total_profit",
            "n_transactions",
        )
    )


@inputs("ship_mode", "order_id", "shipping_days", "sales")
def shipping_analysis(lines: DataFrame) -> DataFrame:
    """Orders, mean days and sales per ship mode; shares of the sum of the modes' orders.

    The window over all rows runs on one row per ship mode.
    """
    lines = without_null_keys(lines, ["ship_mode"])
    measures = [
        half_even(mean(F.col("shipping_days")), 1).alias("avg_shipping_days"),
        total_double("sales").alias("sales"),
    ]
    result = with_distinct_counts(lines, ["ship_mode"], measures, {"orders": "order_id"})
    all_orders = F.sum("orders").over(W.partitionBy())
    return result.withColumn("order_share_pct", percent_of(F.col("orders"), all_orders)).orderBy(
        F.desc("orders"), "ship_mode"
    )
