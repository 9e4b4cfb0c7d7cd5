"""Every registered query against its SQL counterpart, and the shape of the plans."""

import re

import pytest

import __spark_entry__ as contract
from saleslens.functions.numbers import total_double
from saleslens.operators import cleaning, rollups, sales
from saleslens.plans import catalog, oracle
from saleslens.schema import SILVER_COLUMNS
from saleslens.sources.star import silver
from tests.conftest import TESTDATA
from tests.oracle_check import TABLES, difference, duck

SMALL = f"{TESTDATA}/sf0.001"
QUERIES = catalog.queries()
ORACLES = oracle.oracle_sql()
# Queries that write tables and read them back.
STORED = {"read_raw", "load_validated", "layer_inventory", "run_pipeline", "write_partitioned", "compact",
          "write_snapshot", "read_version", "history", "verify_roundtrip", "read_silver", "write_silver", "read_gold",
          "write_gold", "save_results", "read_table", "run_summary", "cleaning_report", "clean"}
WITHOUT_SQL: set[str] = set()


@pytest.fixture(scope="module")
def connection():
    return duck(SMALL)


def test_every_query_has_its_counterpart():
    assert set(QUERIES) - set(ORACLES) == WITHOUT_SQL
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, connection, name):
    assert difference(QUERIES[name](spark, SMALL), connection, ORACLES[name]) is None


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """The small tables with a third of the lines on one order, a third on one product,
    most orders on one customer, null and orphan keys, null names, dates and zero prices."""
    folder = str(tmp_path_factory.mktemp("skewed"))
    source = duck(SMALL)
    changes = {
        "lineitem": """* REPLACE (
            CASE WHEN i % 3 = 0 THEN 7 WHEN i % 50 = 1 THEN NULL
                 WHEN i % 50 = 2 THEN 99999999999 ELSE l_orderkey END AS l_orderkey,
            CASE WHEN i % 3 = 1 THEN 5 WHEN i % 40 = 2 THEN NULL
                 WHEN i % 40 = 3 THEN 123456789 ELSE l_partkey END AS l_partkey,
            CASE WHEN i % 60 = 0 THEN 0 ELSE l_extendedprice END AS l_extendedprice,
            CASE WHEN i % 70 = 0 THEN NULL ELSE l_shipdate END AS l_shipdate)""",
        "orders": """* REPLACE (
            CASE WHEN i % 9 = 0 THEN NULL WHEN i % 3 > 0 THEN 11 ELSE o_custkey END AS o_custkey,
            CASE WHEN i % 8 = 0 THEN NULL ELSE o_orderdate END AS o_orderdate,
            CASE WHEN i % 10 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority)""",
        "part": """* REPLACE (
            CASE WHEN i % 13 = 0 THEN NULL ELSE p_name END AS p_name,
            CASE WHEN i % 7 = 0 THEN NULL ELSE p_brand END AS p_brand,
            CASE WHEN i % 11 = 0 THEN NULL ELSE p_type END AS p_type)""",
        "region": "* REPLACE (CASE WHEN i = 2 THEN NULL ELSE r_name END AS r_name)",
        "customer": "* REPLACE (CASE WHEN i % 6 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment)",
    }
    for table in TABLES:
        select = changes.get(table, "*")
        source.execute(
            f"COPY (SELECT * EXCLUDE (i) FROM (SELECT {select} FROM "
            f"(SELECT *, row_number() OVER () AS i FROM {table}))) "
            f"TO '{folder}/{table}.parquet' (FORMAT parquet)"
        )
    return folder


@pytest.mark.parametrize("name", sorted((set(ORACLES) - STORED) | {"clean", "cleaning_report"}))
def test_query_equals_sql_on_skewed_tables(spark, skewed, name):
    assert difference(QUERIES[name](spark, skewed), duck(skewed), ORACLES[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STORED))
def test_plans_stay_in_the_jvm_and_cross_nothing(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan


def test_scans_read_only_what_is_needed(spark):
    plan = plan_of(QUERIES["category_performance"](spark, SMALL))
    assert "orders.parquet" not in plan and "customer.parquet" not in plan
    assert re.search(r"ReadSchema: struct<p_partkey:bigint,p_type:string,p_retailprice:double>", plan)


def test_filters_reach_the_scan_of_a_stored_table(spark, lines):
    plan = plan_of(sales.loss_making_products(lines.where("discount >= 0.3")))
    assert "PushedFilters: [IsNotNull(discount), GreaterThanOrEqual(discount" in plan


def test_keeping_the_first_row_drops_rows_before_the_shuffle(spark):
    raw = spark.createDataFrame([("1", "a", "b", "c", "d")], "row_id string, order_id string, product_id string, customer_id string, city string")
    plan = plan_of(cleaning.drop_key_duplicates(raw))
    assert "row_number(), 1, Partial" in plan and "row_number(), 1, Final" in plan


def test_top_ranks_are_limited_before_the_shuffle(lines):
    plan = plan_of(rollups.top_products_per_category(lines))
    assert "row_number(), 3, Partial" in plan


def test_top_n_is_not_a_global_sort(lines):
    plan = plan_of(sales.top_products_by_sales(lines))
    assert "TakeOrderedAndProject" in plan


@pytest.mark.parametrize("keys", [["category"], ["region"], ["state", "region"], ["segment"], ["ship_mode"]])
def test_totals_are_conserved_on_tables(spark, keys):
    frame = silver(spark, f"{TESTDATA}/sf0.01", [*keys, "sales", "profit"])
    whole = frame.agg(total_double("sales").alias("s"), total_double("profit").alias("p")).first()
    parts = sales.grouped(frame, keys, "sales", "profit").selectExpr("cast(sum(sales) as double) s", "cast(sum(profit) as double) p").first()
    assert (whole.s, whole.p) == (parts.s, parts.p)


def test_write_silver_returns_every_row_it_wrote(spark):
    written = QUERIES["write_silver"](spark, SMALL)
    assert written.columns == SILVER_COLUMNS and written.count() == silver(spark, SMALL, ["row_id"]).count()


def test_known_figures(spark):
    """Figures of the sf0.01 tables computed independently beforehand."""
    row = QUERIES["spark_kpi_summary"](spark, f"{TESTDATA}/sf0.01").first()
    assert (row.total_sales, row.total_profit) == (3024008727.89, 128309451.89)
    assert (row.total_orders, row.total_customers) == (14743, 1500)
    bands = QUERIES["discount_impact_analysis"](spark, f"{TESTDATA}/sf0.01").collect()
    assert bands[0].n_transactions == 2941 and sum(b.n_transactions for b in bands) == 60000
