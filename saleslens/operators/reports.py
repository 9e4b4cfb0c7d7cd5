"""Ad-hoc reports on order lines and on the rollups."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslens.functions.frames import inputs, rising, with_row, without_null_keys
from saleslens.functions.numbers import double, half_even, half_up, mean_margin, total_double
from saleslens.operators.profitability import (
    RISK_KEY,
    executive_summary,
    high_discount_low_profit_risk,
    yoy_profit_growth,
)
from saleslens.operators.rollups import category_rollup, monthly_trend, regional_rollup
from saleslens.operators.sales import kpi_summary


@inputs("category", "discount", "profit_margin", "profit", "order_id")
def high_discount_by_category(lines: DataFrame, threshold: float = 0.4) -> DataFrame:
    """Effect of high discounts per category, over those lines only."""
    deep = lines.where(double(F.col("discount")) >= threshold)
    return (
        without_null_keys(deep, ["category"])
        .groupBy("category")
        .agg(
            half_even(mean_margin(), 2).alias("avg_margin"),
            half_even(total_double("profit"), 2).alias("total_loss"),
            F.count("order_id").alias("count"),
        )
        .orderBy("category")
    )


def margin_pct() -> Column:
    ratio = F.try_divide(F.col("profit"), F.col("sales"))
    return half_up(ratio * 100, 2).alias("profit_margin_pct")


def top_months_of(months: DataFrame, n: int = 5) -> DataFrame:
    """The months of a monthly rollup with the highest sales."""
    shown = months.select("year_month", "sales", "profit", margin_pct())
    return shown.orderBy(F.desc("sales"), "year_month").limit(n)


@inputs(*monthly_trend.inputs)
def top_months_by_sales(lines: DataFrame, n: int = 5) -> DataFrame:
    return top_months_of(monthly_trend(lines), n)


def category_margins_of(categories: DataFrame) -> DataFrame:
    """The categories of a rollup with their margins."""
    shown = categories.select("category", "sales", "profit", margin_pct(), "avg_discount_pct")
    return shown.orderBy(F.desc("sales"), "category")


@inputs(*category_rollup.inputs)
def category_margin_report(lines: DataFrame) -> DataFrame:
    return category_margins_of(category_rollup(lines))


def regions_of(regions: DataFrame) -> DataFrame:
    """The regions of a rollup, highest sales first."""
    return regions.orderBy(F.desc("sales"), "region")


@inputs(*regional_rollup.inputs)
def regional_report(lines: DataFrame) -> DataFrame:
    return regions_of(regional_rollup(lines))


@inputs("row_id", "product_name", "category", "sub_category", "sales", "profit", "discount", "profit_margin")
def top_loss_line_items(lines: DataFrame, n: int = 20) -> DataFrame:
    """The lines with the largest losses."""
    columns = ["product_name", "category", "sub_category", "sales", "profit", "discount"]
    return (
        lines.where(F.col("profit") < 0)
        .orderBy(*rising("profit", "row_id", *columns[:4]))
        .limit(n)
        .select(
            "product_name",
            "category",
            "sub_category",
            double(half_up(F.col("sales"), 2)).alias("sales"),
            double(half_up(F.col("profit"), 2)).alias("profit"),
            double(F.col("discount")).alias("discount"),
            "profit_margin",
        )
    )


@inputs(*yoy_profit_growth.inputs)
def yoy_growth_nonnull(lines: DataFrame) -> DataFrame:
    """Growth rows that have a previous year."""
    growth = yoy_profit_growth(lines)
    return growth.select("order_year", "category", "profit", "yoy_growth_pct").dropna()


KPI_FIELDS = ["total_sales", "total_profit", "avg_profit_margin_pct", "total_orders", "total_customers", "avg_order_value"]
SUMMARY_FIELDS = ["best_performing_category", "worst_performing_category", "best_performing_region", "worst_performing_region", "total_loss_amount", "loss_making_sku_count"]


@inputs(*sorted({*kpi_summary.inputs, *executive_summary.inputs, *RISK_KEY}))
def insights_report(lines: DataFrame) -> DataFrame:
    """One row: key figures, extremes, losses and the number of risky products."""
    summary = executive_summary(lines).select(*SUMMARY_FIELDS)
    risky = high_discount_low_profit_risk(lines).agg(F.count("*").alias("risk_products"))
    return with_row(with_row(kpi_summary(lines).select(*KPI_FIELDS), summary), risky)


def top_preview(ordered: DataFrame, n: int = 10) -> DataFrame:
    """The first rows of an ordered result."""
    return ordered.limit(n)
