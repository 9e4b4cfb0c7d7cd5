"""Operator 5: weighted rendezvous sharding, in DataFrame functions alone.

Every shard scores every record, -weight / ln(u) with u drawn in (0, 1) by a hash of record key and
shard number; the record goes to the highest score. Scores of different shards do not depend on each
other, so one more shard takes records only into itself, and a changed weight moves only that
shard's share.

Edge cases: null keys hash like any value and so go to one shard; a null text has no bytes; rows that
repeat a key go to one shard, each with its own slot; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleslens.llm.shared import partitions

SHARDS = 24
BUCKETS_PER_TASK = 8
FRACTION = float(2**53)


def _score(key: Column, shard: int, weight: float) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(shard), key), 11)
    draw = (bits.cast("double") + F.lit(0.5)) / F.lit(FRACTION)
    return F.lit(-float(weight)) / F.log(draw)


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """Number of the shard with the highest score; shards of weight 0 get nothing."""
    scored = [F.struct(_score(key, i, w).alias("score"), F.lit(-i).alias("i")) for i, w in enumerate(weights) if w > 0]
    if not scored:
        raise ValueError("no shard has a weight above 0")
    return (-F.array_max(F.array(*scored))["i"]).cast("int")


def assign(rows: DataFrame, key_col: str, weights: Sequence[float], into: str = "shard") -> DataFrame:
    return rows.withColumn(into, rendezvous(F.col(key_col), weights))


def with_slots(rows: DataFrame, shard_col: str, order: list[str]) -> DataFrame:
    """Adds `slot`, gapless from 0 in each shard.

    A shard is cut into many buckets by a hash of `order`; rows are numbered within their bucket and
    start after all rows of lower buckets, whose sizes are a table of shards x buckets. So no task
    holds a shard, and which slot a row gets depends on the rows alone.
    """
    buckets = partitions(rows.sparkSession) * BUCKETS_PER_TASK
    cut = rows.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    place = [shard_col, "_bucket"]
    sizes = cut.groupBy(*place).agg(F.count("*").alias("_rows"))
    lower = Window.partitionBy(shard_col).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(*place, F.coalesce(F.sum("_rows").over(lower), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(*place).orderBy(*order)) - 1
    return cut.withColumn("_inside", inside).join(before, place).withColumn(
        "slot", (F.col("_before") + F.col("_inside")).cast("long")
    ).drop("_bucket", "_inside", "_before")


def query(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Contract of op5, law `key`. Texts are measured where they are read; only sizes are shuffled."""
    rows = docs.select(
        "doc_id",
        (F.octet_length(F.coalesce("text", F.lit(""))) + F.lit(8)).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"),
    )
    rows = assign(rows, "doc_id", [1.0] * shards)
    rows = assign(rows, "doc_id", [1.0] * (shards + 1), into="grown_shard")
    return with_slots(rows, "shard", ["doc_id", "text_crc32", "size"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )
