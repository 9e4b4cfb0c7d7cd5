"""Data model: column names, roles, types and the fixed settings of the sales catalogue.

The fact is one wide table with one row per order line. Operators use the
snake_case engine names; files written for or by other tools use the source names.
"""

from pyspark.sql import types as T

# Amounts are exact decimals, so that totals do not depend on the order in which
# partitions are added up; six places hold the mean of any two four-place amounts.
MONEY = T.DecimalType(28, 6)

# The column contract of a raw file, in file order.
SOURCE_COLUMNS = [
    "Row ID",
    "Order ID",
    "Order Date",
    "Ship Date",
    "Ship Mode",
    "Customer ID",
    "Customer Name",
    "Segment",
    "Country",
    "City",
    "State",
    "Postal Code",
    "Region",
    "Product ID",
    "Category",
    "Sub-Category",
    "Product Name",
    "Sales",
    "Quantity",
    "Discount",
    "Profit",
]


def engine_name(source_name: str) -> str:
    """`Sub-Category` -> `sub_category`; names that are engine names already are kept."""
    return source_name.strip().replace(" ", "_").replace("-", "_").lower()


ENGINE_TO_SOURCE = {engine_name(name): name for name in SOURCE_COLUMNS}
RAW_COLUMNS = list(ENGINE_TO_SOURCE)

# Column roles.
DATE_COLUMNS = ["order_date", "ship_date"]
NUMERIC_COLUMNS = ["sales", "quantity", "discount", "profit"]
CATEGORY_COLUMNS = ["region", "category", "sub_category", "segment", "ship_mode"]
LINE_KEY = ["order_id", "product_id", "customer_id"]
CRITICAL_COLUMNS = ["order_id", "customer_id", "product_id", "sales", "profit", "region"]
PRODUCT_KEY = ["product_id", "product_name", "category", "sub_category"]

# Columns computed from the raw ones, each with the raw columns it reads.
DERIVED_FROM = {
    "profit_margin": ["sales", "profit"],
    "discount_amount": ["sales", "discount"],
    "shipping_days": ["order_date", "ship_date"],
    "order_year": ["order_date"],
    "order_month": ["order_date"],
    "order_quarter": ["order_date"],
    "order_day_of_week": ["order_date"],
    "is_loss": ["profit"],
}
SILVER_COLUMNS = RAW_COLUMNS + list(DERIVED_FROM)

# Settings the results depend on.
UNKNOWN = "Unknown"
UNKNOWN_POSTAL_CODE = "00000"
POSTAL_CODE_WIDTH = 5
LOSS_THRESHOLD = 0
TOP_N = 10
MIN_ROWS = 1000
REGION_ALIASES = {"Central": "Central", "East": "East", "South": "South", "West": "West"}
DISCOUNT_BANDS = [
    ("-0.01", "0.0", "0%"),
    ("0.0", "0.1", "0-10%"),
    ("0.1", "0.2", "10-20%"),
    ("0.2", "0.3", "20-30%"),
    ("0.3", "0.4", "30-40%"),
    ("0.4", "0.5", "40-50%"),
    ("0.5", "0.6", "50-60%"),
    ("0.6", "0.7", "60-70%"),
    ("0.7", "0.8", "70-80%"),
    ("0.8", "1.01", "80%+"),
]
# Texts a CSV reader for data frames takes for a missing value.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

_STRING = T.StringType()
_CLEAN_TYPES = {
    "row_id": T.LongType(),
    "order_date": T.DateType(),
    "ship_date": T.DateType(),
    "sales": MONEY,
    "quantity": T.LongType(),
    "discount": MONEY,
    "profit": MONEY,
    "profit_margin": T.DoubleType(),
    "discount_amount": T.DoubleType(),
    "shipping_days": T.IntegerType(),
    "order_year": T.IntegerType(),
    "order_month": T.IntegerType(),
    "order_quarter": T.IntegerType(),
    "is_loss": T.BooleanType(),
}
RAW_SCHEMA = T.StructType([T.StructField(c, _STRING) for c in RAW_COLUMNS])
SILVER_SCHEMA = T.StructType(
    [T.StructField(c, _CLEAN_TYPES.get(c, _STRING)) for c in SILVER_COLUMNS]
)


def raw_inputs(columns) -> list[str]:
    """Raw columns needed to produce `columns`, in file order."""
    wanted = set()
    for name in columns:
        wanted.update(DERIVED_FROM.get(name, [name]))
    return [c for c in RAW_COLUMNS if c in wanted]
