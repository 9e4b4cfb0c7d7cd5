"""The SQL-style rollups: amounts rounded half up after adding, null keys kept."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from saleslens.functions.distinct import with_distinct_counts
from saleslens.functions.frames import inputs
from saleslens.functions.numbers import double, half_up, mean
from saleslens.functions.order_stats import dense_rank_desc, top_dense_rank_desc
from saleslens.operators.sales import year_month
from saleslens.schema import PRODUCT_KEY


def amount(name: str) -> Column:
    """Exact sum, rounded as an exact value."""
    return double(half_up(F.sum(name), 2))


def discount_pct() -> Column:
    return half_up(mean(F.col("discount")) * 100, 2).alias("avg_discount_pct")


ORDERS = {"orders": "order_id"}
CUSTOMERS = {"customers": "customer_id"}


@inputs("order_id", "customer_id", "sales", "profit", "discount")
def kpis(lines: DataFrame) -> DataFrame:
    sums = [amount("sales").alias("total_sales"), amount("profit").alias("total_profit"), discount_pct()]
    counted = {"total_orders": "order_id", "total_customers": "customer_id"}
    return with_distinct_counts(lines, [], sums, counted).select(
        "total_sales", "total_profit", "total_orders", "total_customers", "avg_discount_pct"
    )


@inputs("order_date", "order_id", "sales", "profit")
def monthly_trend(lines: DataFrame) -> DataFrame:
    months = lines.withColumn("year_month", year_month())
    sums = [amount("sales").alias("sales"), amount("profit").alias("profit")]
    return with_distinct_counts(months, ["year_month"], sums, ORDERS).orderBy("year_month")


@inputs("category", "order_id", "sales", "profit", "quantity", "discount")
def category_rollup(lines: DataFrame) -> DataFrame:
    sums = [
        amount("sales").alias("sales"),
        amount("profit").alias("profit"),
        F.sum("quantity").alias("quantity"),
        discount_pct(),
    ]
    result = with_distinct_counts(lines, ["category"], sums, ORDERS)
    return result.orderBy(F.desc("sales"), "category")


@inputs("category", "sub_category", "sales", "profit", "quantity")
def subcategory_rollup(lines: DataFrame) -> DataFrame:
    return (
        lines.groupBy("category", "sub_category")
        .agg(
            amount("sales").alias("sales"),
            amount("profit").alias("profit"),
            F.sum("quantity").alias("quantity"),
        )
        .orderBy(F.desc("profit"), "category", "sub_category")
    )


@inputs("region", "order_id", "customer_id", "sales", "profit")
def regional_rollup(lines: DataFrame) -> DataFrame:
    sums = [amount("sales").alias("sales"), amount("profit").alias("profit")]
    result = with_distinct_counts(lines, ["region"], sums, ORDERS | CUSTOMERS)
    return result.orderBy(F.desc("sales"), "region")


@inputs("row_id", "order_id", "customer_id", "region", "product_id", "sales", "profit", "quantity")
def order_product_summary(lines: DataFrame) -> DataFrame:
    """Totals, customer, region, distinct products and quantity per order.

    One scan and one grouping: an order is reduced within every task and spread by product, so a large one is
    no burden. A null order has no counts. Customer and region are those of the order's first line: lowest row
    number, then smallest product, quantity and amounts.
    """
    place = F.struct("row_id", "product_id", "quantity", "sales", "profit", "customer_id", "region")
    totals = [
        amount("sales").alias("order_total_sales"),
        amount("profit").alias("order_total_profit"),
        F.min(place).alias("first"),
        F.sum("quantity").alias("quantity"),
    ]
    orders = with_distinct_counts(lines, ["order_id"], totals, {"products": "product_id"})
    known = F.col("order_id").isNotNull()
    return orders.select(
        "order_id",
        "order_total_sales",
        "order_total_profit",
        F.col("first.customer_id").alias("customer_id"),
        F.col("first.region").alias("region"),
        F.when(known, F.col("products")).alias("distinct_products"),
        F.when(known, F.col("quantity")).alias("total_quantity"),
    )


@inputs("order_date", "sales")
def running_monthly_sales(lines: DataFrame) -> DataFrame:
    """Sales per month and their running total within the year."""
    monthly = lines.groupBy(F.year("order_date").alias("year"), F.month("order_date").alias("month")).agg(
        half_up(F.sum("sales"), 2).alias("monthly_sales")
    )
    so_far = W.partitionBy("year").orderBy("month").rowsBetween(W.unboundedPreceding, W.currentRow)
    return monthly.select(
        "year",
        "month",
        double(F.col("monthly_sales")).alias("monthly_sales"),
        double(half_up(F.sum("monthly_sales").over(so_far), 2)).alias("cumulative_sales"),
    ).orderBy("year", "month")


def _product_sales(lines: DataFrame) -> DataFrame:
    return lines.groupBy("category", "product_name").agg(amount("sales").alias("sales"))


@inputs("category", "product_name", "sales")
def product_sales_rank_by_category(lines: DataFrame) -> DataFrame:
    """Every product with its dense rank by sales in its category."""
    ranked = dense_rank_desc(_product_sales(lines), "category", "sales", "rank_in_category")
    return ranked.orderBy("category", "rank_in_category", "product_name")


@inputs("category", "product_name", "sales")
def top_products_per_category(lines: DataFrame, k: int = 3) -> DataFrame:
    """Products of the first `k` ranks by sales in their category."""
    best = top_dense_rank_desc(_product_sales(lines), "category", "sales", "rank_in_category", k)
    return best.orderBy("category", "rank_in_category", "product_name")


@inputs(*PRODUCT_KEY, "sales", "profit", "discount")
def loss_products_rollup(lines: DataFrame) -> DataFrame:
    """Products whose total profit, rounded to two places, is negative."""
    return (
        lines.groupBy(*PRODUCT_KEY)
        .agg(
            amount("sales").alias("total_sales"),
            amount("profit").alias("total_profit"),
            discount_pct(),
        )
        .where(F.col("total_profit") < 0)
        .orderBy("total_profit", *PRODUCT_KEY)
    )
