import random

import numpy as np
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from saleslens.functions.order_stats import dense_rank_desc, first_digit, quantiles, top_dense_rank_desc
from saleslens.operators.profiling import describe_numeric, histogram, histogram_edges
from tests.conftest import values

FRACTIONS = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]


def _columns(seed: int) -> dict[str, list]:
    rng = random.Random(seed)
    return {
        "normal": [rng.gauss(0, 1000) for _ in range(997)],
        "hot": [0.0] * 400 + [rng.random() for _ in range(600)],
        "heavy": [rng.paretovariate(0.4) for _ in range(500)],
        "tiny": [rng.random() * 1e-9 for _ in range(100)] + [None],
        "one": [7.5],
        "signs": [-3.0, -0.0, 0.0, 3.0],
    }


@pytest.mark.parametrize("seed", [1, 2])
def test_quantiles_equal_brute_force(spark, seed):
    data = _columns(seed)
    rows = [(name, v) for name, column in data.items() for v in column]
    random.Random(seed).shuffle(rows)
    frame = spark.createDataFrame(rows, "field string, value double").repartition(7)
    got = {r.field: r.quantiles for r in quantiles(frame, "field", "value", FRACTIONS).collect()}
    for name, column in data.items():
        known = [v for v in column if v is not None]
        assert got[name] == pytest.approx(list(np.quantile(known, FRACTIONS)), rel=1e-12, abs=1e-15)


def test_first_digits_keep_the_order(spark):
    rng = random.Random(5)
    edges = [2.0**e for e in range(-1074, 1024, 7)]
    numbers = [0.0, 5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, float("inf")]
    numbers += [x for e in edges for x in (e, np.nextafter(e, 0), np.nextafter(e, np.inf))]
    numbers += [rng.uniform(-1, 1) * 10 ** rng.randint(-300, 300) for _ in range(2000)]
    numbers = [float(x) for x in numbers] + [-float(x) for x in numbers] + [float("nan")]
    rows = spark.createDataFrame([(x,) for x in numbers], "v double").select("v", first_digit(F.col("v")).alias("d"))
    digits = [r.d for r in rows.orderBy("v").collect()]
    assert digits == sorted(digits)
    assert {r.d for r in rows.where("v = 0").collect()} == {0} and rows.where("d = 0 and v <> 0").isEmpty()


@pytest.mark.parametrize("parts", [1 << 22, 1000, 2, 1])
def test_quantiles_of_close_values(spark, parts):
    """All values within 1e-9 of each other, and some that differ in the last bit only."""
    rng = random.Random(6)
    close = [1.0 + rng.random() * 1e-9 for _ in range(3000)] + [1.0, float(np.nextafter(1.0, 2))] * 50
    frame = spark.createDataFrame([("a", v) for v in close] + [("b", None)], "field string, value double").repartition(5)
    got = {r.field: r.quantiles for r in quantiles(frame, "field", "value", FRACTIONS, parts).collect()}
    assert list(got) == ["a"] and got["a"] == pytest.approx(list(np.quantile(close, FRACTIONS)), rel=1e-16, abs=0)


def test_close_values_are_counted_not_sorted(spark):
    """A third of a million values within 1e-9 of each other."""
    rows = spark.range(300_001, numPartitions=8).select(F.lit("a").alias("field"), (1 + F.col("id") * 2.0**-50).alias("value"))
    found = quantiles(rows, "field", "value", [0.5])
    assert found.first().quantiles[0] == 1 + 150_000 * 2.0**-50


def _skewed(spark):
    rng = random.Random(3)
    rows = [("hot", float(rng.randrange(4000))) for _ in range(6000)]
    rows += [("hot", 0.0)] * 3000 + [("few", 1.0), ("few", 1.0), ("few", 2.0), (None, 5.0), ("few", None)]
    rows += [(f"k{i}", float(rng.randrange(3))) for i in range(300)]
    return spark.createDataFrame(rows, "k string, v double").repartition(6)


@pytest.mark.parametrize("parts", [1, 8, 512])
def test_split_rank_equals_the_window(spark, parts):
    frame = _skewed(spark)
    wanted = frame.withColumn("r", F.dense_rank().over(W.partitionBy("k").orderBy(F.desc("v"))))
    got = dense_rank_desc(frame, "k", "v", "r", parts)
    assert got.exceptAll(wanted).count() == 0 and wanted.exceptAll(got).count() == 0


def test_top_ranks_equal_the_window(spark):
    frame = _skewed(spark)
    wanted = frame.withColumn("r", F.dense_rank().over(W.partitionBy("k").orderBy(F.desc("v")))).where("r <= 3")
    got = top_dense_rank_desc(frame, "k", "v", "r", 3)
    assert got.exceptAll(wanted).count() == 0 and wanted.exceptAll(got).count() == 0


def test_describe(lines):
    row = describe_numeric(lines).where("field = 'sales'").first()
    sales = np.array([float(v) for (v,) in values(lines, "sales")])
    assert (row["count"], row["mean"], row["p50"], row["max"]) == (10, 175.0, 90.0, 500.0)
    assert row["std"] == round(float(sales.std(ddof=1)), 2)


def test_histogram_counts_edges_exactly(spark):
    tenths = [i / 10 for i in range(11)]
    frame = spark.createDataFrame([(v,) for v in tenths], "x double")
    got = histogram(frame, ["x"], 10).select("bin", "count").collect()
    assert [tuple(r) for r in got] == [(i, 1) for i in range(9)] + [(9, 2)]
    flat = histogram(frame.select(F.lit(2.0).alias("x")), ["x"], 40).first()
    assert (flat.bin, flat.bin_start, flat["count"]) == (20, 2.0, 11)


def test_histogram_between_edges(spark):
    frame = spark.createDataFrame([(v,) for v in (-1, 0, 0, 13, 14, 15, None)], "shipping_days int")
    assert [tuple(r) for r in histogram_edges(frame).collect()] == [(0, 2), (13, 2)]
