"""Profitability analytics over cleaned order lines; same rules as the sales analytics."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from saleslens.functions.frames import inputs, without_null_keys
from saleslens.functions.numbers import (
    double,
    half_even,
    mean,
    mean_margin,
    total,
    total_double,
)
from saleslens.operators.sales import (
    discount_pct,
    grouped,
    margin,
    presented,
    region_by_category,
    year_month,
)

MIN_RISK_DISCOUNT = 0.3
MAX_RISK_MARGIN = 5.0


@inputs("state", "region", "order_id", "sales", "profit")
def profitability_by_state(lines: DataFrame) -> DataFrame:
    """States from the worst to the best margin."""
    keys = ["state", "region"]
    result = grouped(lines, keys, "sales", "profit", "orders").withColumn("profit_margin", margin())
    return presented(result).orderBy(F.asc_nulls_last("profit_margin"), *keys)


@inputs("category", "sub_category", "sales", "profit", "quantity", "discount")
def subcategory_return_on_sales(lines: DataFrame) -> DataFrame:
    """Profit in percent of sales per sub-category, worst first."""
    keys = ["category", "sub_category"]
    result = grouped(lines, keys, "sales", "profit", "avg_discount", "quantity")
    result = result.withColumns(
        {"return_on_sales": margin("return_on_sales"), "avg_discount_pct": discount_pct()}
    )
    return presented(result).orderBy(F.asc_nulls_last("return_on_sales"), *keys)


@inputs("order_year", "category", "sales", "profit")
def yoy_profit_growth(lines: DataFrame) -> DataFrame:
    """Growth of a category's profit against its previous year that has sales."""
    result = presented(grouped(lines, ["order_year", "category"], "profit", "sales"))
    prior = F.lag("profit").over(W.partitionBy("category").orderBy("order_year"))
    result = result.withColumn("prior_year_profit", prior)
    change = F.col("profit") - F.col("prior_year_profit")
    growth = F.try_divide(change, F.abs("prior_year_profit")) * 100
    return result.withColumn("yoy_growth_pct", half_even(growth, 2)).orderBy("category", "order_year")


RISK_KEY = ["product_name", "sub_category", "category"]


@inputs(*RISK_KEY, "order_id", "sales", "profit", "discount", "profit_margin")
def high_discount_low_profit_risk(
    lines: DataFrame,
    discount_threshold: float = MIN_RISK_DISCOUNT,
    margin_threshold: float = MAX_RISK_MARGIN,
) -> DataFrame:
    """Products sold at a high discount and a low margin, over those lines only."""
    risky = lines.where(
        (double(F.col("discount")) >= discount_threshold)
        & (F.col("profit_margin") < margin_threshold)
    )
    return (
        without_null_keys(risky, RISK_KEY)
        .groupBy(*RISK_KEY)
        .agg(
            total_double("sales").alias("total_sales"),
            total_double("profit").alias("total_profit"),
            mean(F.col("discount")).alias("avg_discount"),
            mean_margin().alias("avg_margin"),
            F.count("order_id").alias("occurrences"),
        )
        .orderBy("total_profit", *RISK_KEY)
    )


@inputs("region", "category", "profit")
def profitability_pivot(lines: DataFrame, categories: list[str] | None = None) -> DataFrame:
    """Profit by region and category; null where there are no lines."""
    return region_by_category(lines, "profit", categories)


@inputs("order_date", "sales", "profit")
def monthly_profit_trend(lines: DataFrame) -> DataFrame:
    """Profit per month and its mean over the last three months that have sales.

    The window has no partition key; it runs on one row per calendar month.
    """
    months = lines.withColumn("year_month", year_month())
    result = grouped(months, ["year_month"], "profit", "sales").withColumn("profit_margin", margin())
    last = W.partitionBy().orderBy("year_month").rowsBetween(-2, 0)
    rolling = F.try_divide(double(F.sum("profit").over(last)), double(F.count("profit").over(last)))
    return presented(result.withColumn("profit_rolling_3m", half_even(rolling, 2))).orderBy("year_month")


@inputs("product_id", "category", "region", "sales", "profit")
def executive_summary(lines: DataFrame) -> DataFrame:
    """One row: totals, overall margin, best and worst category and region, losses.

    The totals of all lines and of every category, region and product come from one
    scan with grouping sets; only pre-added totals are shuffled. Ties go to the
    smallest name.
    """
    keys = ["category", "region", "product_id"]
    totals = lines.groupingSets([[], *[[k] for k in keys]], *keys).agg(
        F.grouping_id(*keys).alias("level"),
        total("sales").alias("sales"),
        total("profit").alias("profit"),
        F.sum(F.when(F.col("profit") < 0, F.col("profit"))).alias("loss"),
    )
    # The level has a bit set for every key that is not part of the group.
    everything, by_category, by_region, by_product = 0b111, 0b011, 0b101, 0b110

    def only(level: int, value: Column) -> Column:
        return F.when(F.col("level") == level, value)

    def first(level: int, key: str, amount: Column) -> Column:
        known = only(level, F.when(F.col(key).isNotNull(), F.struct(amount.alias("by"), key)))
        return F.min(known)[key]

    profit = F.col("profit")
    sums = {c: F.coalesce(F.max(only(everything, F.col(c))), F.lit(0)) for c in ("sales", "profit", "loss")}
    overall = F.try_divide(double(sums["profit"]), double(sums["sales"])) * 100
    losing = (F.col("level") == by_product) & F.col("product_id").isNotNull() & (profit < 0)
    return totals.agg(
        half_even(double(sums["sales"]), 2).alias("total_sales"),
        half_even(double(sums["profit"]), 2).alias("total_profit"),
        F.coalesce(half_even(overall, 2), F.lit(0.0)).alias("overall_profit_margin_pct"),
        first(by_category, "category", -profit).alias("best_performing_category"),
        first(by_category, "category", profit).alias("worst_performing_category"),
        first(by_region, "region", -profit).alias("best_performing_region"),
        first(by_region, "region", profit).alias("worst_performing_region"),
        half_even(double(sums["loss"]), 2).alias("total_loss_amount"),
        F.count_if(losing).alias("loss_making_sku_count"),
    )
