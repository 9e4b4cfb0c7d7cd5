import pytest
from pyspark.sql import functions as F

from saleslens.operators import feeds, profitability, reports, rollups, sales
from tests.conftest import values

OPERATORS = [
    operator
    for module in (sales, profitability, rollups, reports, feeds)
    for operator in vars(module).values()
    if callable(operator) and hasattr(operator, "inputs") and operator.__module__ == module.__name__
]


@pytest.mark.parametrize("operator", OPERATORS, ids=lambda o: o.__name__)
def test_declared_inputs_are_enough(lines, operator):
    assert operator(lines.select(*operator.inputs)).collect() is not None


def test_kpis(lines):
    row = sales.kpi_summary(lines).first().asDict()
    assert row == {
        "total_sales": 1750.0,
        "total_profit": 250.0,
        "total_orders": 10,
        "total_customers": 10,
        "avg_order_value": 175.0,
        "avg_profit_margin_pct": 12.0,
        "overall_discount_rate_pct": 16.0,
        "loss_line_items_pct": 20.0,
    }
    assert tuple(rollups.kpis(lines).first()) == (1750.0, 250.0, 10, 10, 16.0)


def test_category_performance(lines):
    got = values(sales.category_performance(lines), "category", "sales", "profit", "quantity")
    assert got == [("Tents", 1200.0, 140.0, 4), ("Paper", 400.0, 93.0, 37), ("Ink", 150.0, 17.0, 15)]


def test_regions_and_segments(lines):
    assert values(sales.regional_performance(lines), "region", "sales", "profit") == [
        ("West", 650.0, 167.0), ("North", 600.0, -28.0), ("South", 500.0, 111.0)
    ]
    assert values(sales.segment_performance(lines), "segment", "sales", "profit") == [
        ("Office", 1200.0, 140.0), ("School", 400.0, 93.0), ("Home", 150.0, 17.0)
    ]


def test_trends(lines):
    assert values(sales.monthly_sales_trend(lines), "year_month", "sales", "profit", "orders") == [
        ("2021-03", 600.0, -28.0, 3), ("2021-07", 400.0, 106.0, 3), ("2022-03", 550.0, 106.0, 3), ("2022-07", 200.0, 66.0, 1)
    ]
    assert values(profitability.monthly_profit_trend(lines), "profit_rolling_3m") == [(-28.0,), (39.0,), (61.33,), (92.67,)]
    assert values(sales.quarterly_sales_trend(lines), "year_quarter") == [("2021-Q1",), ("2021-Q3",), ("2022-Q1",), ("2022-Q3",)]
    assert values(sales.yearly_sales_trend(lines), "order_year", "customers") == [(2021, 6), (2022, 4)]
    assert values(rollups.running_monthly_sales(lines), "year", "month", "monthly_sales", "cumulative_sales") == [
        (2021, 3, 600.0, 600.0), (2021, 7, 400.0, 1000.0), (2022, 3, 550.0, 550.0), (2022, 7, 200.0, 750.0)
    ]


def test_pivots(lines):
    names = ["region", "Ink", "Paper", "Tents"]
    assert values(sales.regional_category_sales_pivot(lines), *names) == [
        ("North", 0.0, 100.0, 500.0), ("South", 100.0, 100.0, 300.0), ("West", 50.0, 200.0, 400.0)
    ]
    assert values(profitability.profitability_pivot(lines), *names)[0] == ("North", None, 22.0, -50.0)


def test_discount_bands(lines):
    got = values(sales.discount_impact_analysis(lines), "discount_bucket", "n_transactions", "avg_profit_margin")
    assert got == [
        ("0%", 4, 29.5), ("0-10%", 2, 22.5), ("10-20%", 1, 5.0), ("20-30%", 1, -10.0), ("30-40%", 1, 2.0), ("40-50%", 1, -40.0)
    ]


def test_discount_band_edges(spark):
    edges = ["-0.02", "-0.01", "-0.005", "0", "0.1", "0.100001", "0.8", "1.01", "1.02"]
    frame = spark.createDataFrame([(e,) for e in edges], "d string")
    bands = frame.select(F.col("d").cast("decimal(18,6)").alias("discount")).select(sales.discount_band().alias("b"))
    assert [b for (b,) in values(bands, "b")] == [None, None, 1, 1, 2, 3, 9, 10, None]


def test_shipping(lines):
    assert values(sales.shipping_analysis(lines), "ship_mode", "orders", "order_share_pct") == [
        ("Courier", 5, 50.0), ("Van", 3, 30.0), ("Bike", 2, 20.0)
    ]


def test_risk_and_losses(lines):
    risky = profitability.high_discount_low_profit_risk(lines)
    assert {v for (v,) in values(risky, "product_name")} == {"Item P3", "Item P5", "Item P9"}
    assert values(sales.loss_making_products(lines), "profit") == [(-50.0,), (-8.0,)]
    assert values(reports.high_discount_by_category(lines), "category", "count") == [("Ink", 2)]


def test_executive_summary(lines):
    row = profitability.executive_summary(lines).first()
    assert (row.overall_profit_margin_pct, row.total_loss_amount, row.loss_making_sku_count) == (14.29, -58.0, 2)
    assert (row.best_performing_category, row.worst_performing_category) == ("Tents", "Ink")
    assert (row.best_performing_region, row.worst_performing_region) == ("West", "North")


def test_insights_and_card(lines):
    row = reports.insights_report(lines).first()
    assert (row.total_orders, row.best_performing_region, row.risk_products) == (10, "West", 3)
    assert feeds.feed_kpi_card(lines).first().overall_profit_margin_pct == 14.29


def test_growth_uses_the_previous_row(spark, lines):
    years = lines.withColumn("order_year", F.expr("if(row_id <= 5, 2020, 2023)"))
    got = values(profitability.yoy_profit_growth(years.where("category = 'Paper'")), "order_year", "prior_year_profit", "yoy_growth_pct")
    assert got == [(2020, None, None), (2023, 22.0, 222.73)]
    assert reports.yoy_growth_nonnull(years).count() == 3


def test_null_keys(lines):
    holes = lines.withColumn("category", F.when(F.col("category") != "Paper", F.col("category")))
    assert sales.category_performance(holes).count() == 2
    assert rollups.category_rollup(holes).where("category is null").first().sales == 400.0


def test_null_dates_belong_to_no_period(lines):
    holes = lines.withColumn("order_date", F.when(F.col("row_id").isin(8, 9), F.col("order_date")))
    holes = holes.withColumns({"order_year": F.year("order_date"), "order_quarter": F.quarter("order_date")})
    for trend in (sales.monthly_sales_trend, sales.quarterly_sales_trend, sales.yearly_sales_trend):
        assert trend(holes).count() == 1


def test_top_n(lines):
    assert sales.top_products_by_sales(lines).count() == 10
    assert values(sales.top_customers_by_sales(lines, 2), "customer_id") == [("K3",), ("K8",)]
    with pytest.raises(ValueError):
        sales.top_products_by_sales(lines, 0)


def test_zero_sales_give_null_ratios(lines):
    free = lines.withColumn("sales", F.lit(0).cast("decimal(18,6)"))
    assert values(sales.category_performance(free), "profit_margin") == [(None,)] * 3
    assert profitability.executive_summary(free).first().overall_profit_margin_pct == 0.0


def test_totals_are_conserved(lines):
    total = 1750.0
    for result in (sales.category_performance(lines), sales.regional_performance(lines), sales.state_performance(lines),
                   sales.subcategory_performance(lines), sales.segment_performance(lines), sales.shipping_analysis(lines)):
        assert result.agg(F.sum("sales")).first()[0] == total
    assert feeds.feed_regional_share(lines).agg(F.round(F.sum("sales_share_pct"), 1)).first()[0] == pytest.approx(100, abs=0.2)


def test_order_summary_equals_the_join_of_its_halves(lines):
    mixed = lines.withColumn("order_id", F.when(F.col("row_id") > 3, F.concat(F.lit("O"), F.col("row_id") % 4)))
    totals = mixed.groupBy("order_id").agg(F.sum("sales").cast("double").alias("s"), F.min_by("region", "row_id").alias("region"))
    counts = mixed.groupBy("order_id").agg(F.count_distinct("product_id").alias("n"), F.sum("quantity").alias("q"))
    joined = totals.join(counts, "order_id", "left").select("order_id", "s", "region", "n", "q")
    single = rollups.order_product_summary(mixed).select("order_id", "order_total_sales", "region", "distinct_products", "total_quantity")
    assert joined.exceptAll(single).count() == 0 and single.exceptAll(joined).count() == 0


def test_rounded_and_exact_loss_rules_differ(lines):
    tiny = lines.withColumn("profit", F.lit("-0.001").cast("decimal(18,6)"))
    assert sales.loss_making_products(tiny).count() == 10
    assert rollups.loss_products_rollup(tiny).count() == 0


def test_feed_flags_and_labels(lines):
    long = lines.withColumn("product_name", F.rpad("product_name", 40, "x"))
    label = feeds.feed_loss_top10(long).first().label
    assert len(label) == 36 and label.endswith("…")
    assert feeds.feed_bottom15_states(lines).columns[-1] == "is_negative"
    assert feeds.feed_subcategory_top20(lines).where("is_negative").count() == 0
