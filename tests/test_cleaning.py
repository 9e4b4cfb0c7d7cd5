import datetime

import pytest
from pyspark.sql import functions as F

from saleslens.functions.text import shorten, title_case, zero_pad
from saleslens.operators import cleaning as c
from saleslens.schema import SILVER_COLUMNS, SILVER_SCHEMA
from tests.conftest import make_raw, values


def test_clean_shape_and_types(lines):
    assert lines.count() == 10
    assert lines.columns == SILVER_COLUMNS
    assert dict(lines.dtypes) == {f.name: f.dataType.simpleString() for f in SILVER_SCHEMA}


def test_clean_leaves_no_nulls(lines):
    nulls = lines.agg(*[F.count_if(F.col(n).isNull()).alias(n) for n in lines.columns]).first()
    assert set(nulls) == {0}


def test_exact_duplicates_go(raw):
    assert raw.count() == 11
    assert c.drop_exact_duplicates(raw).count() == 10


def test_first_row_of_a_key_stays_whatever_the_partitioning(spark):
    key = {"order_id": "O", "product_id": "P", "customer_id": "C"}
    rows = make_raw(spark, *[{**key, "row_id": str(i), "sales": str(i)} for i in (10, 9, 2, 30)])
    for parts in (1, 3, 4):
        kept = c.drop_key_duplicates(rows.repartition(parts))
        assert values(kept, "row_id", "sales") == [("2", "2")]


def test_null_keys_are_equal_and_absent_keys_are_skipped(spark):
    rows = make_raw(spark, {"order_id": None}, {"order_id": None}, {"order_id": "x"})
    assert c.drop_key_duplicates(rows).count() == 2
    assert c.drop_key_duplicates(rows.drop("order_id", "product_id", "customer_id")).count() == 3


def test_median_fill_is_interpolated_and_ignores_text(spark):
    rows = make_raw(spark, {"sales": "1"}, {"sales": "2"}, {"sales": "4"}, {"sales": "10"}, {"sales": "abc"}, {"sales": None})
    filled = c.cast_numerics(c.impute_median(rows))
    found = {float(v) if v is not None else None for (v,) in values(filled, "sales")}
    assert found == {1.0, 2.0, 4.0, 10.0, 3.0, None}


def test_mode_fill_prefers_the_smallest_on_ties(spark):
    rows = make_raw(spark, *[{"region": r} for r in ("West", "East", "West", "East", None)])
    assert sorted(v for (v,) in values(c.impute_mode(rows), "region")) == ["East"] * 3 + ["West"] * 2


def test_mode_of_an_empty_column_is_unknown(spark):
    rows = make_raw(spark, {"region": None}, {"region": None})
    assert values(c.impute_mode(rows), "region") == [("Unknown",)] * 2


def test_postal_codes_are_filled_and_padded_but_never_cut(spark):
    rows = make_raw(spark, {"postal_code": None}, {"postal_code": "501"}, {"postal_code": "1234567"})
    tidy = c.normalize_postal(c.impute_postal(rows))
    assert sorted(values(tidy, "postal_code")) == [("00000",), ("00501",), ("1234567",)]


def test_other_gaps_become_unknown_and_dates_then_null(spark):
    rows = make_raw(spark, {"customer_name": None, "order_date": None})
    cleaned = c.clean(rows)
    assert values(cleaned, "customer_name", "order_date", "order_year", "shipping_days") == [("Unknown", None, None, 0)]


@pytest.mark.parametrize(
    ("text", "day"),
    [("2023-01-05", datetime.date(2023, 1, 5)), ("2023-1-5", datetime.date(2023, 1, 5)), ("05/01/2023", None), ("2023-02-30", None)],
)
def test_dates(spark, text, day):
    assert values(c.cast_dates(make_raw(spark, {"order_date": text})), "order_date") == [(day,)]


def test_integers_are_cut_and_default_to_zero(spark):
    rows = make_raw(spark, {"quantity": "3.9"}, {"quantity": "x"}, {"row_id": None})
    assert sorted(values(c.cast_ints(rows), "quantity")) == [(0,), (3,), (4,)]
    assert (0,) in values(c.cast_ints(rows), "row_id")


@pytest.mark.parametrize(
    ("text", "wanted"),
    [("  home-office o'neil\t", "Home-Office O'Neil"), ("STANDARD class", "Standard Class"), (" east ", "East"), ("éclair 2nd", "Éclair 2Nd"), ("\u00a0a\u2003", "A"), ("x\u0001 y", "X\u0001 Y"), ("a  b_c", "A  B_C"), ("", "")],
)
def test_texts(spark, text, wanted):
    assert values(c.standardize_text(make_raw(spark, {"region": text})), "region") == [(wanted,)]
    assert wanted == text.strip().title()


def test_region_aliases(spark):
    rows = make_raw(spark, {"region": "East"}, {"region": "Nowhere"})
    assert values(c.map_region_alias(rows), "region") == [("East",), ("Nowhere",)]
    assert values(c.map_region_alias(rows, {"Nowhere": "X"}), "region") == [("East",), ("X",)]


def test_derived_columns(lines):
    first = lines.where("row_id = 2").first()
    assert (first.profit_margin, first.discount_amount, first.shipping_days) == (20.0, 6.0, 4)
    assert (first.order_year, first.order_month, first.order_quarter) == (2021, 3, 1)
    assert (first.order_day_of_week, first.is_loss) == ("Tuesday", False)


def test_margin_without_sales(spark):
    rows = make_raw(spark, {"sales": "0", "profit": "5"}, {"sales": "-3", "profit": "1"}, {"sales": "8", "profit": "0.005"})
    assert sorted(values(c.clean(rows), "profit_margin")) == [(0.0,), (0.0,), (0.06,)]


def test_half_even_rounding(spark):
    # 0.125 % and 0.375 % are exact in binary: to the even neighbour.
    rows = make_raw(spark, {"sales": "800", "profit": "1"}, {"sales": "800", "profit": "3"})
    assert sorted(values(c.clean(rows), "profit_margin")) == [(0.12,), (0.38,)]


def test_unparsable_amounts_stay_null(spark):
    cleaned = c.clean(make_raw(spark, {"sales": "n.a.", "profit": "x"}))
    assert values(cleaned, "sales", "profit", "profit_margin", "is_loss") == [(None, None, 0.0, False)]


def test_staged_cleaning_gives_the_same_rows(spark, raw, lines, tmp_path):
    staged = c.clean(raw, str(tmp_path / "kept"))
    assert staged.exceptAll(lines).count() == 0 and lines.exceptAll(staged).count() == 0


def test_text_helpers(spark):
    row = spark.sql("select 'abcdef' t, 'abc' u, '123456' n").select(
        shorten(F.col("t"), 3), shorten(F.col("u"), 3), zero_pad(F.col("n"), 4), zero_pad(F.col("u"), 5), title_case(F.lit("a1b"))
    ).first()
    assert tuple(row) == ("abc…", "abc", "123456", "00abc", "A1B")


def test_large_numbers_are_kept(spark):
    """Row ids and quantities up to 64 bits, and amounts of 20 digits and more, come through with their totals."""
    rows = make_raw(
        spark,
        {"row_id": "6000000000017", "quantity": "3000000000", "sales": "1234567890123.5"},
        {"row_id": "9223372036854775807", "sales": "1e12"},
        {"row_id": "5", "sales": "12345678901234567890.25", "quantity": "9223372036854775807"},
    )
    cleaned = c.clean(rows)
    assert sorted(values(cleaned, "row_id")) == [(5,), (6000000000017,), (9223372036854775807,)]
    assert sorted(values(cleaned, "quantity")) == [(4,), (3000000000,), (9223372036854775807,)]
    total = cleaned.agg(F.sum("sales").cast("string").alias("t")).first().t
    assert total == "12345681135802458013.750000"


def test_each_text_is_stripped_once_and_generated_methods_are_short(spark, raw):
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    plan = c.clean(raw)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("p{Z}]+$") == 5
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_a_line_without_a_date_has_no_week_day(spark, tmp_path):
    rows = make_raw(spark, {"order_date": "not-a-date"}, {"order_date": "2021-03-06"})
    cleaned = c.clean(rows, str(tmp_path / "kept")).orderBy("row_id")
    assert values(cleaned, "order_date", "order_day_of_week") == [(None, None), (datetime.date(2021, 3, 6), "Saturday")]
