"""The order-line fact as a star join of normalised sales tables.

Dimension keys are unique, so a left join keeps every line exactly once and a
dimension none of whose columns is wanted can be left out without changing a row.
Customer, nation and region are joined to orders first: the line table is then
shuffled at most once per key. Orders are joined last: the second shuffle carries the few
columns of the part instead of those of order and customer, and the lines of an order
come out side by side, which takes less space when they are stored or counted. No side is hinted; Spark broadcasts a side only when
its size is known to be small, and splits hot keys of the line side.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslens.functions.text import zero_pad
from saleslens.operators.cleaning import derive
from saleslens.schema import MONEY, RAW_COLUMNS, SILVER_COLUMNS, raw_inputs

# The columns read from each table. Stating them saves Spark the pass over
# all file footers it needs to find them out.
TABLES = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_retailprice double",
}
# How the tables map to the wide model.
COUNTRY = "Synthetic"
DISCOUNT_SCALE = 8
COST_SHARE = 2

_FROM_REGION = {"region"}
_FROM_NATION = {"city", "state"} | _FROM_REGION
_FROM_CUSTOMER = {"customer_name", "segment"} | _FROM_NATION
_FROM_ORDERS = {"order_date", "ship_mode", "customer_id", "postal_code"} | _FROM_CUSTOMER
_FROM_PART = {"product_name", "category", "sub_category", "profit"}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _orders(spark: SparkSession, sf_dir: str, wanted: set[str]) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    if not wanted & _FROM_CUSTOMER:
        return orders
    customer = _table(spark, sf_dir, "customer")
    orders = orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
    if not wanted & _FROM_NATION:
        return orders
    nation = _table(spark, sf_dir, "nation")
    if wanted & _FROM_REGION:
        region = _table(spark, sf_dir, "region")
        nation = nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
    return orders.join(nation, orders.c_nationkey == nation.n_nationkey, "left")


def sales_wide(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    """The 21 raw columns, typed, or those of them in `columns`; reads and joins only these."""
    columns = columns or RAW_COLUMNS
    wanted = set(columns)
    lines = _table(spark, sf_dir, "lineitem")
    if wanted & _FROM_PART:
        part = _table(spark, sf_dir, "part")
        lines = lines.join(part, lines.l_partkey == part.p_partkey, "left")
    if wanted & _FROM_ORDERS:
        orders = _orders(spark, sf_dir, wanted)
        lines = lines.join(orders, lines.l_orderkey == orders.o_orderkey, "left")

    # The tables hold prices and rates with two places as doubles. A line's amount has four
    # places, far above the error of a few double operations, so it is exact once rounded.
    amount = "decimal(18,4)"
    sales = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    quantity = F.col("l_quantity").cast("int")
    cost = quantity * F.col("p_retailprice") * COST_SHARE
    mapping = {
        "row_id": F.col("l_orderkey") * 10 + F.col("l_linenumber"),
        "order_id": F.concat(F.lit("ORD-"), zero_pad(F.col("l_orderkey"), 8)),
        "order_date": F.col("o_orderdate").cast("date"),
        "ship_date": F.col("l_shipdate").cast("date"),
        "ship_mode": F.col("o_orderpriority"),
        "customer_id": F.concat(F.lit("CUS-"), zero_pad(F.col("o_custkey"), 7)),
        "customer_name": F.col("c_name"),
        "segment": F.col("c_mktsegment"),
        "country": F.lit(COUNTRY),
        "city": F.col("n_name"),
        "state": F.col("n_name"),
        "postal_code": zero_pad(F.pmod(F.col("o_custkey"), F.lit(100000)), 5),
        "region": F.col("r_name"),
        "product_id": F.col("l_partkey").cast("string"),
        "category": F.col("p_type"),
        "sub_category": F.col("p_brand"),
        "product_name": F.col("p_name"),
        "sales": sales.cast(amount).cast(MONEY),
        "quantity": quantity.cast("bigint"),
        "discount": (F.col("l_discount") * DISCOUNT_SCALE).cast(amount).cast(MONEY),
        "profit": (sales - cost).cast(amount).cast(MONEY),
    }
    return lines.select(*[mapping[c].alias(c) for c in columns])


def silver(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    """Order lines with the derived columns, or those in `columns`."""
    columns = columns or SILVER_COLUMNS
    wide = sales_wide(spark, sf_dir, raw_inputs(columns))
    return derive(wide, columns).select(*columns)
