"""Data behind the dashboard charts, where a chart needs more than an analytic gives."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from saleslens.functions.frames import inputs, with_row
from saleslens.functions.numbers import half_even
from saleslens.functions.text import shorten
from saleslens.operators.profitability import (
    executive_summary,
    profitability_by_state,
    subcategory_return_on_sales,
)
from saleslens.operators.sales import (
    kpi_summary,
    loss_making_products,
    regional_performance,
    subcategory_performance,
)

LABEL_WIDTH = 35


@inputs(*sorted({*kpi_summary.inputs, *executive_summary.inputs}))
def feed_kpi_card(lines: DataFrame) -> DataFrame:
    """One row: the key figures and the executive summary."""
    kpis = kpi_summary(lines)
    summary = executive_summary(lines)
    more = [c for c in summary.columns if c not in kpis.columns]
    return with_row(kpis, summary.select(*more))


@inputs(*subcategory_performance.inputs)
def feed_subcategory_top20(lines: DataFrame, n: int = 20) -> DataFrame:
    rows = subcategory_performance(lines).limit(n)
    return rows.withColumn("is_negative", F.col("profit") < 0)


@inputs(*regional_performance.inputs)
def feed_regional_share(lines: DataFrame) -> DataFrame:
    """Regions with their share of all sales; the window runs on one row per region."""
    rows = regional_performance(lines)
    share = F.try_divide(F.col("sales"), F.sum(F.col("sales").cast("decimal(30,6)")).over(W.partitionBy()).cast("double"))
    return rows.withColumns(
        {"sales_share_pct": half_even(share * 100, 1), "is_positive": F.col("profit") > 0}
    ).orderBy(F.desc("sales"), "region")


@inputs(*loss_making_products.inputs)
def feed_loss_top10(lines: DataFrame, n: int = 10) -> DataFrame:
    rows = loss_making_products(lines).limit(n)
    return rows.select(
        "product_id", shorten(F.col("product_name"), LABEL_WIDTH).alias("label"), "profit"
    )


@inputs(*profitability_by_state.inputs)
def feed_bottom15_states(lines: DataFrame, n: int = 15) -> DataFrame:
    rows = profitability_by_state(lines).limit(n)
    return rows.withColumn("is_negative", F.col("profit_margin") < 0)


@inputs(*subcategory_return_on_sales.inputs)
def feed_ros_flagged(lines: DataFrame) -> DataFrame:
    rows = subcategory_return_on_sales(lines)
    return rows.withColumn("is_negative", F.col("return_on_sales") < 0)
