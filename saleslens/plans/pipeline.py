"""Batch pipeline: raw file -> bronze -> silver -> gold -> gate -> run log.

Every stage reads the table the stage before it wrote, so a lost executor or a rerun
costs at most one stage, and every write replaces its target. Raw rows are kept as they
came in the bronze table, which the validation reports and all later counts read. Rows
without duplicates are written once beside the silver table; the fill statistics and the
cleaning then read them instead of repeating the deduplication.
"""

from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslens.operators import profitability, rollups, sales
from saleslens.operators.cleaning import clean
from saleslens.operators.quality import (
    date_parse_report,
    enforce,
    gates_of,
    measured_lines,
    measured_raw,
    numeric_parse_report,
    quality_summary,
    raw_reports,
    require_columns,
    summary_of,
    validation_figures,
    validation_summary,
)
from saleslens.sources.files import read_raw, read_silver
from saleslens.sources.layers import layer_paths
from saleslens.sources.sinks import save_results, write_gold, write_silver

# Gold tables are small and independent; some of their jobs are submitted side by side.
PARALLEL_WRITES = 4

# Analytics published as gold tables, under the names dashboards look for.
GOLD = {
    "monthly_trend": sales.monthly_sales_trend,
    "quarterly_trend": sales.quarterly_sales_trend,
    "category_performance": sales.category_performance,
    "subcategory_performance": sales.subcategory_performance,
    "regional_performance": sales.regional_performance,
    "loss_products": sales.loss_making_products,
    "segment_performance": sales.segment_performance,
    "discount_impact": sales.discount_impact_analysis,
    "state_profitability": profitability.profitability_by_state,
    "yoy_growth": profitability.yoy_profit_growth,
    "return_on_sales": profitability.subcategory_return_on_sales,
    "high_risk_products": profitability.high_discount_low_profit_risk,
    "kpi_summary": sales.kpi_summary,
    "executive_summary": profitability.executive_summary,
    "spark_monthly_trend": rollups.monthly_trend,
    "spark_category_performance": rollups.category_rollup,
    "spark_regional": rollups.regional_rollup,
    "spark_loss_products": rollups.loss_products_rollup,
}


def reports_on(raw: DataFrame) -> dict[str, DataFrame]:
    """The validation reports on raw rows (not yet run)."""
    return {
        "dates": date_parse_report(raw),
        "numbers": numeric_parse_report(raw),
        "quality": quality_summary(raw),
        "summary": validation_summary(raw),
        "figures": validation_figures(raw),
    }


def load_validated(spark: SparkSession, path: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Raw rows with all required columns, and the reports on them (not yet run)."""
    raw = require_columns(read_raw(spark, path))
    return raw, reports_on(raw)


def run_pipeline(
    spark: SparkSession,
    raw_path: str,
    base: str,
    gold: dict = GOLD,
    enforce_gate: bool = True,
    run_id: str = "latest",
) -> DataFrame:
    """Build all layers below `base`; returns the run log, one row per run id.

    Validation reports and the outcome of both gates are stored below the gold layer, also when a gate
    then stops the run. Their figures are gathered by the tasks that write the bronze and the silver table;
    only duplicates are looked for afterwards. A run replaces the log row of an earlier one with its id.
    """
    layers = layer_paths(base)
    read = measured_raw(require_columns(read_raw(spark, raw_path)))
    raw = read_silver(spark, save_results(read.frame, f"{layers['bronze']}/lines"))
    cleaned = measured_lines(clean(raw, staging=f"{layers['silver']}/kept"))
    lines = read_silver(spark, write_silver(cleaned.frame, f"{layers['silver']}/lines"))

    basic, full = gates_of(cleaned)
    checks = {f"validation/{name}": report for name, report in raw_reports(read, raw).items()}
    _write_all(checks | {"gate/basic": basic, "gate/full": full}, layers["gold"])
    if enforce_gate:
        enforce(basic)
        enforce(full)
    _write_all({name: analytic(lines.select(*analytic.inputs)) for name, analytic in gold.items()}, layers["gold"])

    log = f"{layers['gold']}/run_log"
    summary = summary_of(read, cleaned).withColumns(
        {"finished_at": F.current_timestamp(), "run_id": F.lit(run_id)}
    )
    summary.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(log)
    return spark.read.parquet(log)


def _write_all(tables: dict[str, DataFrame], folder: str) -> None:
    with ThreadPool(PARALLEL_WRITES) as pool:
        pool.starmap(lambda name, table: write_gold(name, table, folder), tables.items())
