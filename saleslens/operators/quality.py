"""Validation reports and quality gates.

Reports are frames; nothing is counted until the caller asks. Only `require_columns`
and `enforce` raise.
"""

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from saleslens.errors import QualityGateError, SchemaValidationError
from saleslens.functions.dates import iso_date
from saleslens.functions.frames import inputs, one_row, with_row
from saleslens.functions.numbers import count_where, double, half_even, money, total_double
from saleslens.functions.repeats import fingerprint, marked, repeated  # noqa: F401 (tests put a worse one in every module)
from saleslens.operators.cleaning import fill_values
from saleslens.schema import (
    CRITICAL_COLUMNS,
    DATE_COLUMNS,
    MIN_ROWS,
    NUMERIC_COLUMNS,
    RAW_COLUMNS,
    UNKNOWN,
    UNKNOWN_POSTAL_CODE,
)


def require_columns(frame: DataFrame, columns: list[str] = RAW_COLUMNS) -> DataFrame:
    """`frame` itself; raises if a column is missing. More columns are fine."""
    missing = sorted(set(columns) - set(frame.columns))
    if missing:
        raise SchemaValidationError(f"missing columns: {missing}")
    return frame


def _present(frame: DataFrame, columns) -> list[str]:
    return [c for c in columns if c in frame.columns]


def _null_count(name: str) -> Column:
    return count_where(F.col(name).isNull()).alias(name)


def _percent(part: str, whole: str) -> Column:
    return half_even(F.try_divide(double(F.col(part)), double(F.col(whole))) * 100, 2)


# Raw data


def invalid_dates(raw: DataFrame) -> dict[str, Column]:
    """Per date column, the number of values that are no date in the expected format."""
    return {
        c: count_where(F.col(c).isNotNull() & iso_date(F.col(c)).isNull())
        for c in _present(raw, DATE_COLUMNS)
    }


def invalid_numbers(raw: DataFrame) -> dict[str, Column]:
    """Per number column, the number of values that are no number."""
    return {
        c: count_where(F.col(c).isNotNull() & money(F.col(c)).isNull())
        for c in _present(raw, NUMERIC_COLUMNS)
    }


def date_parse_report(raw: DataFrame) -> DataFrame:
    """(column, invalid): values that are no date in the expected format."""
    return _unpivoted(raw, invalid_dates(raw), "invalid", "column")


def numeric_parse_report(raw: DataFrame) -> DataFrame:
    """(column, invalid): values that are no number."""
    return _unpivoted(raw, invalid_numbers(raw), "invalid", "column")


def _duplicates(raw: DataFrame) -> DataFrame:
    """One row: duplicate rows. Of all rows only fingerprints are shuffled; those that may occur again are grouped whole."""
    again = marked(raw, raw.columns, repeated(raw, raw.columns)).where("_again").drop("_again")
    more = again.groupBy(*raw.columns).agg((F.count("*") - 1).alias("_more"))
    return more.agg(F.coalesce(F.sum("_more"), F.lit(0)).alias("_duplicates"))


def _distinct_counts(raw: DataFrame) -> DataFrame:
    """One row: rows, duplicate rows and nulls per column."""
    counts = raw.agg(F.count("*").alias("_rows"), *[_null_count(c) for c in raw.columns])
    return with_row(counts, _duplicates(raw))


def quality_summary(raw: DataFrame) -> DataFrame:
    """(column, rows, columns, duplicate_rows, nulls, null_pct) for every column."""
    return _summary_of(_distinct_counts(raw), raw)


def _summary_of(counts: DataFrame, raw: DataFrame) -> DataFrame:
    return (
        counts.unpivot(["_rows", "_duplicates"], raw.columns, "column", "nulls")
        .select(
            "column",
            F.col("_rows").alias("rows"),
            F.lit(len(raw.columns)).cast("bigint").alias("columns"),
            F.col("_duplicates").alias("duplicate_rows"),
            "nulls",
            _percent("nulls", "_rows").alias("null_pct"),
        )
    )


def validation_summary(raw: DataFrame) -> DataFrame:
    """One row: rows, column names, null cells, duplicate rows."""
    cells = sum((F.col(c) for c in raw.columns), F.lit(0).cast("bigint"))
    return _distinct_counts(raw).select(
        F.col("_rows").alias("rows"),
        F.lit(",".join(raw.columns)).alias("columns"),
        cells.alias("nulls"),
        F.col("_duplicates").alias("duplicates"),
    )


def validation_figures(raw: DataFrame) -> DataFrame:
    """(report, column, figure): invalid dates and numbers, nulls per column, rows, null cells and duplicate rows.

    All reports come from one row, which reads `raw` three times: for all counts, for fingerprints that occur again, and
    for the rows that have them.
    """
    invalid = {"dates": invalid_dates(raw), "numbers": invalid_numbers(raw)}
    rules = [rule.alias(f"_{name}_{c}") for name, found in invalid.items() for c, rule in found.items()]
    counts = raw.agg(F.count("*").alias("_rows"), *[_null_count(c) for c in raw.columns], *rules)
    row = with_row(counts, _duplicates(raw))
    cells = sum((F.col(c) for c in raw.columns), F.lit(0).cast("bigint"))
    figures = [(name, c, F.col(f"_{name}_{c}")) for name, found in invalid.items() for c in found]
    figures += [("quality", c, F.col(c)) for c in raw.columns]
    figures += [("summary", "rows", F.col("_rows")), ("summary", "nulls", cells), ("summary", "duplicates", F.col("_duplicates"))]
    shown = [F.struct(F.lit(r).alias("report"), F.lit(c).alias("column"), f.alias("figure")) for r, c, f in figures]
    return row.select(F.inline(F.array(*shown)))


def null_pct_by_column(frame: DataFrame) -> DataFrame:
    """(column, null_pct) of the columns that have nulls."""
    counts = frame.agg(F.count("*").alias("_rows"), *[_null_count(c) for c in frame.columns])
    return (
        counts.unpivot(["_rows"], frame.columns, "column", "nulls")
        .where(F.col("nulls") > 0)
        .select("column", _percent("nulls", "_rows").alias("null_pct"))
    )


# Cleaning


def cleaning_report(raw: DataFrame, kept: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Per raw column: rows before and after, gaps filled and with what, gaps left.

    `kept` holds the rows of `raw` that are left when duplicates are gone.
    """
    filled = kept.agg(*[_null_count(c) for c in raw.columns]).unpivot(
        [], raw.columns, "column", "nulls_filled"
    )
    left = cleaned.agg(
        F.count("*").alias("rows_after"), *[_null_count(c) for c in raw.columns]
    ).unpivot(["rows_after"], raw.columns, "column", "nulls_left")
    before = raw.agg(F.count("*").alias("rows_before"))
    fixed = (
        F.when(F.col("column") == "postal_code", UNKNOWN_POSTAL_CODE)
        .when(F.col("column").isin(NUMERIC_COLUMNS), F.lit(None))
        .otherwise(UNKNOWN)
    )
    fills = fill_values(kept).withColumnRenamed("field", "column")
    return (
        with_row(filled.join(left, "column").join(fills, "column", "left"), before)
        .select(
            "column",
            "rows_before",
            "rows_after",
            (F.col("rows_before") - F.col("rows_after")).alias("rows_removed"),
            "nulls_filled",
            F.when(F.col("nulls_filled") > 0, F.coalesce("fill", fixed)).alias("fill_value"),
            "nulls_left",
        )
    )


def summary_figures() -> dict[str, Column]:
    """Rows, loss lines, total sales and profit of cleaned lines."""
    return {
        "clean_rows": F.count("*"),
        "loss_items": count_where(F.col("is_loss")),
        "total_sales": half_even(total_double("sales"), 2),
        "total_profit": half_even(total_double("profit"), 2),
    }


def run_summary(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """One row: rows in, rows out, loss lines, total sales and profit."""
    figures = summary_figures()
    return cleaned.agg(*[c.alias(name) for name, c in figures.items()]).select(
        one_row(raw.agg(F.count("*").alias("n")))["n"].alias("raw_rows"), *figures
    )


# Gates. A missing value never satisfies a rule of the basic gate.


def _all(condition: Column) -> Column:
    return count_where(~F.coalesce(condition, F.lit(False))) == 0


def basic_rules(cleaned: DataFrame) -> dict[str, Column]:
    """The nine publishing rules: whether each holds for all rows."""
    types = dict(cleaned.dtypes)
    return {
        "order_id has no nulls": _all(F.col("order_id").isNotNull()),
        "sales has no nulls": _all(F.col("sales").isNotNull()),
        "profit has no nulls": _all(F.col("profit").isNotNull()),
        "sales above 0": _all(F.col("sales") > 0),
        "discount within 0 and 1": _all(F.col("discount").between(0, 1)),
        "shipping_days not negative": _all(F.col("shipping_days") >= 0),
        "profit_margin exists": F.lit("profit_margin" in types),
        "is_loss is boolean": F.lit(types.get("is_loss") == "boolean"),
        f"at least {MIN_ROWS} rows": F.count("*") >= MIN_ROWS,
    }


@inputs("order_id", "sales", "profit", "discount", "shipping_days", "profit_margin", "is_loss")
def quality_gate_basic(cleaned: DataFrame) -> DataFrame:
    """(check, passed) of the nine publishing rules."""
    return _unpivoted(cleaned, basic_rules(cleaned), "passed")


def _unpivoted(frame: DataFrame, rules: dict[str, Column], value: str, name: str = "check") -> DataFrame:
    """One pass over `frame`, one row per rule."""
    return frame.agg(*[r.alias(n) for n, r in rules.items()]).unpivot(
        [], [F.col(f"`{n}`") for n in rules], name, value
    )


def full_rules(cleaned: DataFrame) -> dict[str, Column]:
    """The detailed rules: how many rows violate each."""
    sales, profit = double(F.col("sales")), double(F.col("profit"))
    again = half_even(F.try_divide(profit, sales) * 100, 1)
    differs = F.abs(again - half_even(F.col("profit_margin"), 1)) > 0.5
    infinite = (sales == 0) & (profit != 0)
    rules = {f"{c} has no nulls": count_where(F.col(c).isNull()) for c in CRITICAL_COLUMNS}
    return rules | {
        "sales above 0": count_where(F.col("sales") <= 0),
        "discount within 0 and 1": count_where(~F.col("discount").between(0, 1)),
        "shipping_days not negative": count_where(F.col("shipping_days") < 0),
        "profit_margin matches": count_where(F.coalesce(differs, F.lit(False)) | infinite),
        f"at least {MIN_ROWS} rows": F.greatest(MIN_ROWS - F.count("*"), F.lit(0).cast("bigint")),
    }


@inputs(*CRITICAL_COLUMNS, "discount", "shipping_days", "profit_margin")
def quality_gate_full(cleaned: DataFrame) -> DataFrame:
    """(check, violations, passed) of the detailed rules."""
    return _with_verdict(_unpivoted(cleaned, full_rules(cleaned), "violations"))


def _with_verdict(violations: DataFrame) -> DataFrame:
    return violations.withColumn("passed", F.col("violations") == 0)


def gate_status(gate: DataFrame, table: DataFrame) -> DataFrame:
    """One row: PASSED or FAILED, with the size of the table."""
    return gate.agg(
        F.when(F.every("passed"), "PASSED").otherwise("FAILED").alias("status")
    ).select(
        "status",
        one_row(table.agg(F.count("*").alias("n")))["n"].alias("rows"),
        F.lit(len(table.columns)).cast("bigint").alias("columns"),
    )


def enforce(gate: DataFrame) -> None:
    """Run the gate; raise with the names of the rules that failed (a handful of rows)."""
    failed = [r["check"] for r in gate.where(~F.col("passed")).select("check").collect()]
    if failed:
        raise QualityGateError(f"quality checks failed: {sorted(failed)}")




# Reports measured while a table is written. The figures of all rules are gathered by the tasks that write
# the rows, so that no report reads the table again.


class Measured:
    """A frame to be written, and the figures that its write gathers.

    The rules are aggregates without distinct counts. Only the write itself may evaluate `frame`; it should
    not shuffle behind it, as tasks that run again before a shuffle would count twice.
    """

    def __init__(self, frame: DataFrame, groups: dict[str, dict[str, Column]]):
        self.spark = frame.sparkSession
        self.names = {g: {n: f"{g}|{n}" for n in rules} for g, rules in groups.items()}
        self.observation = Observation()
        figures = [rule.alias(self.names[g][n]) for g, rules in groups.items() for n, rule in rules.items()]
        self.frame = frame.observe(self.observation, *figures)

    def figures(self, group: str) -> dict:
        """Name to figure, once the frame is written."""
        found = self.observation.get
        return {n: found[full] for n, full in self.names[group].items()}

    def report(self, group: str, value: str, kind: str, name: str = "check") -> DataFrame:
        """(name, value) of one group of rules."""
        return self.spark.createDataFrame(list(self.figures(group).items()), f"`{name}` string, `{value}` {kind}")


def measured_raw(raw: DataFrame) -> Measured:
    """Raw rows with what the validation reports need."""
    groups = {"dates": invalid_dates(raw), "numbers": invalid_numbers(raw), "rows": {"rows": F.count("*")}}
    return Measured(raw, groups)


def raw_reports(measured: Measured, stored: DataFrame) -> dict[str, DataFrame]:
    """The validation reports on raw rows; only duplicates are looked for in the table."""
    return {
        "dates": measured.report("dates", "invalid", "bigint", "column"),
        "numbers": measured.report("numbers", "invalid", "bigint", "column"),
        "quality": quality_summary(stored),
    }


def measured_lines(cleaned: DataFrame) -> Measured:
    """Cleaned lines with the figures of both gates and of the run log."""
    groups = {"basic": basic_rules(cleaned), "full": full_rules(cleaned), "summary": summary_figures()}
    return Measured(cleaned, groups)


def gates_of(measured: Measured) -> tuple[DataFrame, DataFrame]:
    """Both gates, as `quality_gate_basic` and `quality_gate_full` give them."""
    full = measured.report("full", "violations", "bigint")
    return measured.report("basic", "passed", "boolean"), _with_verdict(full)


def summary_of(raw: Measured, cleaned: Measured) -> DataFrame:
    """The row of `run_summary`."""
    row = {"raw_rows": raw.figures("rows")["rows"], **cleaned.figures("summary")}
    kinds = "raw_rows bigint, clean_rows bigint, loss_items bigint, total_sales double, total_profit double"
    return cleaned.spark.createDataFrame([tuple(row.values())], kinds)
