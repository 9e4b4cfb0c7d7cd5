"""Distinct counts that add up: exact bitmaps over dense ids.

Every distinct value gets a number from 1 on without gaps. The numbers seen in a group are kept as bitmaps of 32,768
bits each, so that the counts of a coarser group follow from the stored bitmaps of its parts, without
reading rows again: months make quarters, quarters make years. No buffer is larger than one bitmap, and values
that a group holds many times over cost nothing more.
"""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BUCKETS = 1024  # in which distinct values are numbered; a task orders one at a time


def dense_ids(values: DataFrame, column: str, buckets: int = BUCKETS) -> DataFrame:
    """(column, id): a number from 1 on, without gaps, for every distinct value that is not null."""
    distinct = values.select(column).where(F.col(column).isNotNull()).distinct()
    rows = distinct.withColumn("_bucket", F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int"))
    sizes = rows.groupBy("_bucket").agg(F.count("*").alias("_size"))
    before = F.sum("_size").over(W.partitionBy().orderBy("_bucket")) - F.col("_size")  # one row a bucket
    offsets = sizes.select(F.col("_bucket").alias("_of"), before.alias("_before"))
    place = F.row_number().over(W.partitionBy("_bucket").orderBy(column))
    placed = rows.withColumn("_place", place).join(F.broadcast(offsets), F.col("_bucket") == F.col("_of"))
    return placed.select(column, (F.col("_before") + F.col("_place")).alias("id"))


def bitmaps(rows: DataFrame, keys: list[str], column: str, ids: DataFrame) -> DataFrame:
    """(keys, bucket, bits): which ids of `column` every group holds."""
    numbered = rows.select(*keys, column).distinct().join(ids, column)
    at = F.bitmap_bit_position("id")
    return numbered.groupBy(*keys, F.bitmap_bucket_number("id").alias("bucket")).agg(F.bitmap_construct_agg(at).alias("bits"))


def merged(maps: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, bucket, bits) of coarser groups, from the bitmaps of their parts."""
    return maps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def counted(maps: DataFrame, keys: list[str], name: str) -> DataFrame:
    """(keys, name): distinct values of every group."""
    return maps.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(name))
