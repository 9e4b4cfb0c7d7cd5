import pytest
from pyspark.sql import functions as F

from saleslens.errors import QualityGateError, SchemaValidationError
from saleslens.operators import quality as q
from saleslens.operators.cleaning import clean, remove_duplicates
from tests.conftest import make_raw, values


def test_missing_columns_raise_sorted(raw):
    assert q.require_columns(raw.withColumn("more", F.lit(1))).columns[-1] == "more"
    with pytest.raises(SchemaValidationError, match=r"\['profit', 'sales'\]"):
        q.require_columns(raw.drop("sales", "profit"))


def test_parse_reports(spark):
    rows = make_raw(spark, {"order_date": "soon", "sales": "x"}, {"order_date": None, "sales": None}, {"sales": "1e3"})
    assert values(q.date_parse_report(rows), "column", "invalid") == [("order_date", 1), ("ship_date", 0)]
    assert dict(values(q.numeric_parse_report(rows), "column", "invalid")) == {
        "sales": 1, "quantity": 0, "discount": 0, "profit": 0
    }


def test_summaries(raw):
    row = q.quality_summary(raw).where("column = 'postal_code'").first()
    assert (row.rows, row.columns, row.duplicate_rows, row.nulls, row.null_pct) == (11, 21, 1, 2, 18.18)
    assert values(q.validation_summary(raw), "rows", "nulls", "duplicates") == [(11, 2, 1)]
    assert values(q.null_pct_by_column(raw), "column", "null_pct") == [("postal_code", 18.18)]


def test_cleaning_report(raw):
    kept = remove_duplicates(raw)
    rows = {r.column: r for r in q.cleaning_report(raw, kept, clean(raw)).collect()}
    assert len(rows) == 21
    postal = rows["postal_code"]
    assert (postal.rows_before, postal.rows_after, postal.rows_removed) == (11, 10, 1)
    assert (postal.nulls_filled, postal.fill_value, postal.nulls_left) == (2, "00000", 0)
    assert rows["sales"].fill_value is None


def test_gates(lines):
    basic = dict(values(q.quality_gate_basic(lines), "check", "passed"))
    assert len(basic) == 9
    assert [name for name, passed in basic.items() if not passed] == ["at least 1000 rows"]
    full = {r.check: (r.violations, r.passed) for r in q.quality_gate_full(lines).collect()}
    assert len(full) == 11 and full["at least 1000 rows"] == (990, False)
    with pytest.raises(QualityGateError, match="at least 1000 rows"):
        q.enforce(q.quality_gate_basic(lines))


def test_gates_see_each_fault(lines):
    many = lines.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(120)))).drop("copy")
    q.enforce(q.quality_gate_basic(many))
    q.enforce(q.quality_gate_full(many))
    assert values(q.gate_status(q.quality_gate_full(many), many), "status", "rows", "columns") == [("PASSED", 1200, 29)]
    faults = {
        "sales above 0": ("sales", F.lit(0).cast("decimal(18,6)")),
        "discount within 0 and 1": ("discount", F.lit("1.5").cast("decimal(18,6)")),
        "shipping_days not negative": ("shipping_days", F.lit(-1)),
        "region has no nulls": ("region", F.lit(None).cast("string")),
        "profit_margin matches": ("profit_margin", F.lit(1234.5)),
    }
    for check, (column, value) in faults.items():
        broken = many.withColumn(column, value)
        assert check in {r.check for r in q.quality_gate_full(broken).where("not passed").collect()}


def test_missing_values_fail_the_basic_gate(lines):
    holes = lines.withColumn("discount", F.lit(None).cast("decimal(18,6)"))
    assert not dict(values(q.quality_gate_basic(holes), "check", "passed"))["discount within 0 and 1"]


def test_run_summary(raw, lines):
    assert tuple(q.run_summary(raw, lines).first()) == (11, 10, 2, 1750.0, 250.0)


def test_all_validation_figures_from_one_row(raw):
    found = {(r.report, r.column): r.figure for r in q.validation_figures(raw).collect()}
    single = {("dates", r.column): r.invalid for r in q.date_parse_report(raw).collect()}
    single |= {("numbers", r.column): r.invalid for r in q.numeric_parse_report(raw).collect()}
    single |= {("quality", r.column): r.nulls for r in q.quality_summary(raw).collect()}
    summary = q.validation_summary(raw).first()
    single |= {("summary", c): summary[c] for c in ("rows", "nulls", "duplicates")}
    assert found == single and found["summary", "duplicates"] == 1
