"""Stored rollups and bitmaps: refused when stale, equal to plain counts, merged without the lines."""

import random

import pytest
from pyspark.sql import functions as F

from saleslens.errors import SourceError
from saleslens.functions.bitmaps import bitmaps, counted, dense_ids, merged
from saleslens.operators import reports
from saleslens.plans import gold
from tests.conftest import values


def test_reports_read_the_stored_rollup_of_their_version(spark, lines, tmp_path):
    folder = str(tmp_path / "rollups")
    gold.publish(lines, folder, 3)
    for name, direct in (("top_months_by_sales", reports.top_months_by_sales),
                         ("category_margin_report", reports.category_margin_report),
                         ("regional_report", reports.regional_report)):
        shown = gold.report(spark, folder, name, 3)
        assert shown.collect() == direct(lines).collect()
        assert all(folder in f for f in shown.inputFiles())
    with pytest.raises(SourceError, match="no version 4"):
        gold.report(spark, folder, "regional_report", 4)
    gold.publish(lines.where("region = 'North'"), folder, 4)
    assert values(gold.report(spark, folder, "regional_report", 4), "region") == [("North",)]
    assert gold.report(spark, folder, "regional_report", 3).count() == 3


@pytest.mark.parametrize("buckets", [1, 7, 1024])
def test_ids_have_no_gaps(spark, buckets):
    texts = [None, "", "a", "b", "é"] * 3 + [f"v{i}" for i in range(500)]
    frame = spark.createDataFrame([(t,) for t in texts], "v string").repartition(5)
    rows = dense_ids(frame, "v", buckets).collect()
    assert sorted(r.id for r in rows) == list(range(1, 505))
    assert {r.v for r in rows} == set(texts) - {None}


def test_bitmaps_count_and_merge(spark):
    rng = random.Random(2)
    rows = [(rng.choice("abc"), rng.choice("xy"), rng.choice([None, *range(40_000)])) for _ in range(90_000)]
    frame = spark.createDataFrame(rows, "g string, h string, v int").repartition(4)
    maps = bitmaps(frame, ["g", "h"], "v", dense_ids(frame, "v"))
    wanted = {}
    for g, h, v in rows:
        for key in ((g, h), (g, None), (None, None)):
            wanted.setdefault(key, set()).add(v)
    fine = {(r.g, r.h): r.n for r in counted(maps, ["g", "h"], "n").collect()}
    coarse = {(r.g, None): r.n for r in counted(merged(maps, ["g"]), ["g"], "n").collect()}
    every = counted(merged(maps.withColumn("all", F.lit(1)), ["all"]), ["all"], "n").first().n
    assert fine | coarse | {(None, None): every} == {k: len(v - {None}) for k, v in wanted.items()}


def test_periods_follow_from_months(spark, lines, tmp_path):
    gold.publish_bitmaps(lines.unionByName(lines.withColumn("order_date", F.lit(None).cast("date"))), str(tmp_path), 1)
    rows = {(r.level, r.period): (r.orders, r.customers) for r in gold.cardinality_by_period(spark, str(tmp_path), 1).collect()}
    assert rows["month", "2021-03"] == (3, 3) and rows["quarter", "2021-Q3"] == (3, 3) and rows["year", "2022"] == (4, 4)
    assert sum(level == "year" for level, _ in rows) == 2
