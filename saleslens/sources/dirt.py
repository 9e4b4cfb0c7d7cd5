"""Raw text rows with known faults, to give the cleaning steps something to find.

Which rows are hit is decided by a digest of the row, of which every rule looks at its
own four digits: the same rows every time, on any engine, and the given share of them at
any scale.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslens.schema import RAW_COLUMNS
from saleslens.sources.star import sales_wide

# The columns the digest is taken of, the first digit each rule looks at, and
# the hexadecimal bounds below which a row is hit (1, 14 and 0.5 rows in 100).
DIGEST_OF = ["order_id", "product_id", "row_id", "quantity"]
FIRST_DIGIT = {
    "postal": 1,
    "sales": 5,
    "sales text": 9,
    "region": 13,
    "region text": 17,
    "date": 21,
    "repeat": 25,
}
ONE_PERCENT = "028f"
FOURTEEN_PERCENT = "23d7"
HALF_PERCENT = "0148"


def _hit(rule: str, below: str) -> Column:
    return F.substring("_digest", FIRST_DIGIT[rule], 4) < below


def as_raw(typed: DataFrame) -> DataFrame:
    """All columns as text, as a raw file holds them."""
    return typed.select(*[F.col(c).cast("string").alias(c) for c in typed.columns])


def inject_dirt(raw: DataFrame) -> DataFrame:
    """Blank, misspell and repeat a small share of the rows of a raw text frame."""
    faults = {
        "postal_code": F.when(~_hit("postal", ONE_PERCENT), F.col("postal_code")),
        "sales": F.when(_hit("sales text", ONE_PERCENT), F.lit("n.a.")).when(
            ~_hit("sales", ONE_PERCENT), F.col("sales")
        ),
        "region": F.when(
            _hit("region text", FOURTEEN_PERCENT),
            F.concat(F.lit("  "), F.lower("region"), F.lit(" ")),
        ).when(~_hit("region", ONE_PERCENT), F.col("region")),
        "order_date": F.when(_hit("date", ONE_PERCENT), F.lit("not-a-date")).otherwise(
            F.col("order_date")
        ),
    }
    repeats = F.when(_hit("repeat", HALF_PERCENT), 2).otherwise(1)
    return (
        raw.withColumn("_digest", F.md5(F.concat_ws("|", *DIGEST_OF)))
        .select(
            *[faults.get(c, F.col(c)).alias(c) for c in raw.columns],
            F.explode(F.array_repeat(F.lit(0), repeats)).alias("_copy"),
        )
        .drop("_copy")
    )


def dirty_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inject_dirt(as_raw(sales_wide(spark, sf_dir, RAW_COLUMNS)))
