"""Registered queries: name -> callable(spark, folder of the sales tables) -> frame."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslens.functions.numbers import double, total_double
from saleslens.operators import (
    cleaning,
    feeds,
    profiling,
    profitability,
    quality,
    reports,
    rollups,
    sales,
)
from saleslens.plans import gold
from saleslens.plans.pipeline import GOLD, load_validated, run_pipeline
from saleslens.schema import NUMERIC_COLUMNS, RAW_COLUMNS, SILVER_COLUMNS
from saleslens.sources import files, sinks
from saleslens.sources.dirt import as_raw, dirty_raw, inject_dirt
from saleslens.sources.layers import layer_inventory, layer_paths, layer_rows, scratch_folder
from saleslens.sources.star import sales_wide, silver

Query = Callable[[SparkSession, str], DataFrame]
LINE = ["row_id", "order_id", "product_id"]
AMOUNTS = ["sales", "discount", "profit"]


def _shown(frame: DataFrame) -> DataFrame:
    """Exact amounts as doubles, for output."""
    return frame.withColumns({c: double(F.col(c)) for c in AMOUNTS if c in frame.columns})


# Query builders


def _on_lines(operator: Callable[[DataFrame], DataFrame], columns: list[str] | None = None) -> Query:
    """Over cleaned lines, reading only the operator's input columns."""
    return lambda spark, sf_dir: operator(silver(spark, sf_dir, columns or operator.inputs))


def _on_raw(operator: Callable[[DataFrame], DataFrame], columns: list[str] | None = None) -> Query:
    """Over raw text rows with faults."""

    def query(spark, sf_dir):
        result = operator(dirty_raw(spark, sf_dir))
        return result.select(*columns) if columns else result

    return query


def _derived(*columns: str) -> Query:
    return lambda spark, sf_dir: silver(spark, sf_dir, [*LINE, *columns])


def _typed(operator, columns: list[str]) -> Query:
    def query(spark, sf_dir):
        return _shown(operator(dirty_raw(spark, sf_dir)).select(*LINE, *columns))

    return query


def _by_year_and_category(lines: DataFrame) -> DataFrame:
    return lines.groupBy("order_year", "category").agg(
        F.count("*").alias("lines"),
        total_double("sales").alias("sales"),
        total_double("profit").alias("profit"),
    )


# Storage queries write the whole table below the session's shared folder and read it back.


def _raw_file(spark: SparkSession, sf_dir: str, compression: str = "gzip") -> str:
    path = scratch_folder(spark, "raw") + ".csv"
    return sinks.save_results(files.source_columns(dirty_raw(spark, sf_dir)), path, "csv", compression)


def _silver_file(spark: SparkSession, sf_dir: str) -> str:
    return sinks.write_silver(silver(spark, sf_dir), scratch_folder(spark, "silver"))


def _read_raw(spark, sf_dir):
    return files.read_raw(spark, _raw_file(spark, sf_dir, "lz4")).select(*RAW_COLUMNS)


def _read_table(spark, sf_dir):
    path = scratch_folder(spark, "lines") + ".parquet"
    sinks.save_results(sales_wide(spark, sf_dir, ["row_id", "product_id", "sales"]), path)
    return _shown(files.read_table(spark, path))


def _read_silver(spark, sf_dir):
    return _shown(files.read_silver(spark, _silver_file(spark, sf_dir)))


def _gold(name: str, fmt: str = "csv") -> Query:
    """Write one analytic as a gold table and read it back with its types."""

    def query(spark, sf_dir):
        analytic = GOLD[name]
        result = analytic(silver(spark, sf_dir, analytic.inputs))
        folder = scratch_folder(spark, "gold")
        if fmt == "csv":
            return files.read_gold(spark, sinks.write_gold(name, result, folder), result.schema)
        return spark.read.parquet(sinks.save_results(result, f"{folder}/{name}", fmt))

    return query


def _gold_report(name: str) -> Query:
    """Publish the rollup that a report needs, and report on the stored table."""

    def query(spark, sf_dir):
        rollup, _ = gold.REPORTS[name]
        folder = scratch_folder(spark, "rollups")
        gold.publish(silver(spark, sf_dir, gold.ROLLUPS[rollup].inputs), folder, 1, [rollup])
        return gold.report(spark, folder, name, 1)

    return query


def _cardinality_by_period(spark, sf_dir):
    folder = scratch_folder(spark, "bitmaps")
    gold.publish_bitmaps(silver(spark, sf_dir, ["order_date", "order_id", "customer_id"]), folder, 1)
    return gold.cardinality_by_period(spark, folder, 1)


def _write_partitioned(spark, sf_dir):
    path = scratch_folder(spark, "table")
    name = "lines_" + path.rsplit("-", 1)[-1]
    lines = silver(spark, sf_dir, [*RAW_COLUMNS, "order_year"])
    table = sinks.write_partitioned(lines, name, path, finish=lambda rows: cleaning.derive(rows).select(*SILVER_COLUMNS))
    return _by_year_and_category(table.withColumn("order_year", F.col("order_year").cast("int")))


def _sanitize_columns(spark, sf_dir):
    wide = sales_wide(spark, sf_dir, ["row_id", "sub_category", "sales", "quantity"])
    return _shown(files.sanitize_columns(files.source_columns(wide)))


def _layer_inventory(spark, sf_dir):
    base = scratch_folder(spark, "layers")
    layers = layer_paths(base)
    # The star join runs once: the other layers are made from the stored lines.
    lines = files.read_silver(spark, sinks.write_silver(silver(spark, sf_dir), f"{layers['silver']}/lines"))
    raw = files.source_columns(inject_dirt(as_raw(lines.select(*RAW_COLUMNS))))
    sinks.save_results(raw, f"{layers['bronze']}/lines", "csv", "gzip")
    sinks.write_gold("monthly_trend", sales.monthly_sales_trend(lines), layers["gold"])
    # Numbers of files and bytes depend on the writer; whether there are any does not.
    inventory = layer_inventory(spark, base).join(layer_rows(spark, base), "layer")
    return inventory.select("layer", (F.col("files") > 0).alias("has_files"), (F.col("bytes") > 0).alias("has_bytes"), "rows")


def _verify_roundtrip(spark, sf_dir):
    return sinks.verify_roundtrip(silver(spark, sf_dir), _silver_file(spark, sf_dir))


def _compact(spark, sf_dir):
    target = sinks.compact(spark, _silver_file(spark, sf_dir), scratch_folder(spark, "compact"))
    return _by_year_and_category(spark.read.parquet(target))


def _snapshots(spark: SparkSession, sf_dir: str) -> str:
    """Two versions: all lines, then those without a loss, made from the first."""
    path = scratch_folder(spark, "snapshots")
    sinks.write_snapshot(silver(spark, sf_dir), path, 0)
    return sinks.write_snapshot(sinks.read_version(spark, path, 0).where(~F.col("is_loss")), path, 1)


def _read_version(spark, sf_dir):
    return _by_year_and_category(sinks.read_version(spark, _snapshots(spark, sf_dir), 0))


def _write_snapshot(spark, sf_dir):
    return _by_year_and_category(sinks.read_version(spark, _snapshots(spark, sf_dir), 1))


def _history(spark, sf_dir):
    return sinks.history(spark, _snapshots(spark, sf_dir)).drop("written_at")


def _load_validated(spark, sf_dir):
    """All reports as (report, column, figure): invalid dates and numbers, nulls per column, rows and duplicates."""
    _, reports_on_raw = load_validated(spark, _raw_file(spark, sf_dir))
    return reports_on_raw["figures"]


def _run_pipeline(spark, sf_dir):
    base = scratch_folder(spark, "pipeline")
    log = run_pipeline(spark, _raw_file(spark, sf_dir), base, enforce_gate=False)
    return log.drop("finished_at", "run_id")


# Quality queries


def _gate_status(spark, sf_dir):
    lines = silver(spark, sf_dir, SILVER_COLUMNS)
    return quality.gate_status(quality.quality_gate_full(lines), lines)


def _stored_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sinks.save_results(dirty_raw(spark, sf_dir), scratch_folder(spark, "bronze"))
    return files.read_table(spark, path, "parquet")


def _run_summary(spark, sf_dir):
    raw = _stored_raw(spark, sf_dir)
    return quality.run_summary(raw, cleaning.clean(raw, scratch_folder(spark, "kept")))


def _cleaning_report(spark, sf_dir):
    raw = _stored_raw(spark, sf_dir)
    staging = scratch_folder(spark, "kept")
    cleaned = cleaning.clean(raw, staging)
    return quality.cleaning_report(raw, spark.read.parquet(staging), cleaned)


# Cleaning queries


def _impute_unknown(spark, sf_dir):
    """Cities are blanked where the postal code is missing, then filled."""
    raw = dirty_raw(spark, sf_dir)
    blank = raw.withColumn("city", F.when(F.col("postal_code").isNotNull(), F.col("city")))
    return cleaning.impute_unknown(blank).select(*LINE, "city")


def _normalize_postal(spark, sf_dir):
    """Postal codes that lost their leading zeros on the way."""
    raw = dirty_raw(spark, sf_dir).select(*LINE, F.col("postal_code").cast("int").cast("string"))
    return cleaning.normalize_postal(raw)


def _map_region_alias(spark, sf_dir):
    wide = sales_wide(spark, sf_dir, [*LINE, "region"])
    return cleaning.map_region_alias(wide, {"AMERICA": "Americas", "MIDDLE EAST": "Asia"})


def _cast_ints(spark, sf_dir):
    return cleaning.cast_ints(dirty_raw(spark, sf_dir).select(*LINE, "quantity")).select(
        "order_id", "product_id", "row_id", "quantity"
    )


def _impute_median(spark, sf_dir):
    filled = cleaning.impute_median(dirty_raw(spark, sf_dir))
    return _shown(cleaning.cast_numerics(filled).select(*LINE, *NUMERIC_COLUMNS)).withColumn(
        "quantity", double(F.col("quantity"))
    )


def _cast_numerics(spark, sf_dir):
    typed = cleaning.cast_numerics(dirty_raw(spark, sf_dir)).select(*LINE, *NUMERIC_COLUMNS)
    return _shown(typed).withColumn("quantity", double(F.col("quantity")))


def _clean(spark, sf_dir):
    return _shown(cleaning.clean(dirty_raw(spark, sf_dir), scratch_folder(spark, "kept")))


def _first(operator, n: int) -> Query:
    return lambda spark, sf_dir: reports.top_preview(
        operator(silver(spark, sf_dir, operator.inputs)), n
    )


def _on_columns(operator, columns: list[str]) -> Query:
    return _on_lines(lambda lines: operator(lines, columns), columns)


def queries() -> dict[str, Query]:
    return {
        # Sources, sinks, layout
        "sales_wide": lambda spark, sf_dir: _shown(sales_wide(spark, sf_dir)),
        "inject_dirt": dirty_raw,
        "read_raw": _read_raw,
        "read_table": _read_table,
        "read_silver": _read_silver,
        "write_silver": _read_silver,
        "read_gold": _gold("category_performance"),
        "write_gold": _gold("monthly_trend"),
        "save_results": _gold("subcategory_performance", "parquet"),
        "write_partitioned": _write_partitioned,
        "sanitize_columns": _sanitize_columns,
        "layer_inventory": _layer_inventory,
        "verify_roundtrip": _verify_roundtrip,
        "compact": _compact,
        "write_snapshot": _write_snapshot,
        "read_version": _read_version,
        "history": _history,
        "run_pipeline": _run_pipeline,
        # Validation and quality
        "require_columns": _on_raw(quality.require_columns, ["order_id", "product_id", "customer_id"]),
        "load_validated": _load_validated,
        "date_parse_report": _on_raw(quality.date_parse_report),
        "numeric_parse_report": _on_raw(quality.numeric_parse_report),
        "quality_summary": _on_raw(quality.quality_summary),
        "validation_summary": _on_raw(quality.validation_summary),
        "null_pct_by_column": _on_raw(quality.null_pct_by_column),
        "quality_gate_basic": _on_lines(quality.quality_gate_basic),
        "quality_gate_full": _on_lines(quality.quality_gate_full),
        "gate_status": _gate_status,
        "run_summary": _run_summary,
        "cleaning_report": _cleaning_report,
        # Cleaning and enrichment
        "drop_exact_duplicates": _on_raw(cleaning.drop_exact_duplicates),
        "drop_key_duplicates": _on_raw(cleaning.drop_key_duplicates),
        "impute_median": _impute_median,
        "impute_postal": _typed(cleaning.impute_postal, ["postal_code"]),
        "impute_mode": _typed(cleaning.impute_mode, cleaning.CATEGORY_COLUMNS),
        "impute_unknown": _impute_unknown,
        "cast_dates": _typed(cleaning.cast_dates, cleaning.DATE_COLUMNS),
        "cast_numerics": _cast_numerics,
        "normalize_postal": _normalize_postal,
        "cast_ints": _cast_ints,
        "standardize_text": _typed(cleaning.standardize_text, cleaning.CATEGORY_COLUMNS),
        "map_region_alias": _map_region_alias,
        "profit_margin": _derived("profit_margin"),
        "discount_amount": _derived("discount_amount"),
        "shipping_days": _derived("shipping_days"),
        "date_parts": _derived("order_year", "order_month", "order_quarter"),
        "order_day_of_week": _derived("order_day_of_week"),
        "is_loss": _derived("is_loss"),
        "clean": _clean,
        # Profiles
        "describe_numeric": _on_columns(
            profiling.describe_numeric, NUMERIC_COLUMNS + profiling.DERIVED_NUMERIC
        ),
        "histogram": _on_columns(profiling.histogram, NUMERIC_COLUMNS),
        "histogram_clipped": _on_lines(profiling.histogram_clipped),
        "histogram_edges": _on_lines(profiling.histogram_edges),
        "value_counts": _on_columns(
            profiling.value_counts, ["region", "category", "segment", "ship_mode"]
        ),
        "correlation_matrix": _on_columns(profiling.correlation_matrix, NUMERIC_COLUMNS),
        "extent_and_cardinality": _on_lines(profiling.extent_and_cardinality),
        "loss_items": _on_lines(profiling.loss_items),
        "loss_share": _on_lines(profiling.loss_share),
        "preview": lambda spark, sf_dir: _shown(profiling.preview(sales_wide(spark, sf_dir))),
        # Sales
        "kpi_summary": _on_lines(sales.kpi_summary),
        "monthly_sales_trend": _on_lines(sales.monthly_sales_trend),
        "quarterly_sales_trend": _on_lines(sales.quarterly_sales_trend),
        "yearly_sales_trend": _on_lines(sales.yearly_sales_trend),
        "category_performance": _on_lines(sales.category_performance),
        "subcategory_performance": _on_lines(sales.subcategory_performance),
        "regional_performance": _on_lines(sales.regional_performance),
        "regional_category_sales_pivot": _on_lines(sales.regional_category_sales_pivot),
        "state_performance": _on_lines(sales.state_performance),
        "top_products_by_sales": _on_lines(sales.top_products_by_sales),
        "loss_making_products": _on_lines(sales.loss_making_products),
        "segment_performance": _on_lines(sales.segment_performance),
        "top_customers_by_sales": _on_lines(sales.top_customers_by_sales),
        "discount_impact_analysis": _on_lines(sales.discount_impact_analysis),
        "shipping_analysis": _on_lines(sales.shipping_analysis),
        # Profitability
        "profitability_by_state": _on_lines(profitability.profitability_by_state),
        "subcategory_return_on_sales": _on_lines(profitability.subcategory_return_on_sales),
        "yoy_profit_growth": _on_lines(profitability.yoy_profit_growth),
        "high_discount_low_profit_risk": _on_lines(profitability.high_discount_low_profit_risk),
        "profitability_pivot": _on_lines(profitability.profitability_pivot),
        "monthly_profit_trend": _on_lines(profitability.monthly_profit_trend),
        "executive_summary": _on_lines(profitability.executive_summary),
        # Rollups
        "spark_kpi_summary": _on_lines(rollups.kpis),
        "spark_monthly_trend": _on_lines(rollups.monthly_trend),
        "spark_category_performance": _on_lines(rollups.category_rollup),
        "spark_subcategory_performance": _on_lines(rollups.subcategory_rollup),
        "spark_regional_performance": _on_lines(rollups.regional_rollup),
        "join_order_with_product_summary": _on_lines(rollups.order_product_summary),
        "running_monthly_sales": _on_lines(rollups.running_monthly_sales),
        "product_sales_rank_by_category": _on_lines(rollups.product_sales_rank_by_category),
        "top_products_per_category": _on_lines(rollups.top_products_per_category),
        "spark_loss_making_products": _on_lines(rollups.loss_products_rollup),
        # Reports
        "high_discount_by_category": _on_lines(reports.high_discount_by_category),
        "top_months_by_sales": _on_lines(reports.top_months_by_sales),
        "category_margin_report": _on_lines(reports.category_margin_report),
        "regional_report": _on_lines(reports.regional_report),
        "top_loss_line_items": _on_lines(reports.top_loss_line_items),
        "yoy_growth_nonnull": _on_lines(reports.yoy_growth_nonnull),
        "insights_report": _on_lines(reports.insights_report),
        "top_preview_months": _first(sales.monthly_sales_trend, 12),
        "top_preview_losses": _first(sales.loss_making_products, 10),
        "top_preview_return_on_sales": _first(profitability.subcategory_return_on_sales, 10),
        "gold_top_months": _gold_report("top_months_by_sales"),
        "gold_category_margins": _gold_report("category_margin_report"),
        "gold_regions": _gold_report("regional_report"),
        "cardinality_by_period": _cardinality_by_period,
        # Chart feeds
        "feed_kpi_card": _on_lines(feeds.feed_kpi_card),
        "feed_subcategory_top20": _on_lines(feeds.feed_subcategory_top20),
        "feed_regional_share": _on_lines(feeds.feed_regional_share),
        "feed_loss_top10": _on_lines(feeds.feed_loss_top10),
        "feed_bottom15_states": _on_lines(feeds.feed_bottom15_states),
        "feed_ros_flagged": _on_lines(feeds.feed_ros_flagged),
    }
