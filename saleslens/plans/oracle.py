"""SQL counterparts of the registered queries, written for DuckDB on the same tables."""

from saleslens.schema import (
    CATEGORY_COLUMNS,
    CRITICAL_COLUMNS,
    DISCOUNT_BANDS,
    NUMERIC_COLUMNS,
    PRODUCT_KEY,
    RAW_COLUMNS,
    SILVER_COLUMNS,
)
from saleslens.sources.dirt import (
    DIGEST_OF,
    FIRST_DIGIT,
    FOURTEEN_PERCENT,
    HALF_PERCENT,
    ONE_PERCENT,
)

# Expressions


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def half_even(x: str, places: int) -> str:
    scale = f"{10**places}.0::DOUBLE"
    y = f"(({x}) * {scale})"
    nearest = f"CASE WHEN abs({y} - trunc({y})) = 0.5 THEN 2 * round({y} / 2) ELSE round({y}) END"
    return f"(({nearest}) / {scale})"


def half_up(x: str, places: int) -> str:
    """Rounds the shortest decimal notation of a double."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 14)), {places}) AS DOUBLE)"


def total(c: str) -> str:
    return f"CAST(COALESCE(sum({c}), 0) AS DOUBLE)"


def ratio(a: str, b: str) -> str:
    return f"({dbl(a)} / nullif({dbl(b)}, 0))"


def mean(c: str) -> str:
    return ratio(f"sum({c})", f"count({c})")


MEAN_MARGIN = mean("CAST(profit_margin AS DECIMAL(24, 2))")
AVG_DISCOUNT = mean("discount")


def margin(name: str = "profit_margin") -> str:
    return half_even(f"{ratio('sum(profit)', 'sum(sales)')} * 100", 2) + f" AS {name}"


def discount_pct() -> str:
    return half_even(f"{AVG_DISCOUNT} * 100", 2) + " AS avg_discount_pct"


ORDERS = "count(DISTINCT order_id)"
CUSTOMERS = "count(DISTINCT customer_id)"
SALES, PROFIT = f"{total('sales')} AS sales", f"{total('profit')} AS profit"
QUANTITY = "CAST(COALESCE(sum(quantity), 0) AS BIGINT) AS quantity"


def pad(x: str, width: int) -> str:
    return f"CASE WHEN length({x}) < {width} THEN lpad({x}, {width}, '0') ELSE {x} END"


# Tables

WIDE = f"""
wide AS (
  SELECT l_orderkey * 10 + l_linenumber AS row_id,
         'ORD-' || {pad('CAST(l_orderkey AS VARCHAR)', 8)} AS order_id,
         CAST(o_orderdate AS DATE) AS order_date,
         CAST(l_shipdate AS DATE) AS ship_date,
         o_orderpriority AS ship_mode,
         'CUS-' || {pad('CAST(o_custkey AS VARCHAR)', 7)} AS customer_id,
         c_name AS customer_name,
         c_mktsegment AS segment,
         'Synthetic' AS country,
         n_name AS city,
         n_name AS state,
         {pad('CAST(o_custkey % 100000 AS VARCHAR)', 5)} AS postal_code,
         r_name AS region,
         CAST(l_partkey AS VARCHAR) AS product_id,
         p_type AS category,
         p_brand AS sub_category,
         p_name AS product_name,
         CAST(sold AS DECIMAL(18, 6)) AS sales,
         CAST(l_quantity AS BIGINT) AS quantity,
         CAST(8 * rate AS DECIMAL(18, 6)) AS discount,
         CAST(sold - 2 * CAST(l_quantity AS INTEGER) * CAST(p_retailprice AS DECIMAL(15, 2))
              AS DECIMAL(18, 6)) AS profit
  FROM (SELECT *, CAST(l_discount AS DECIMAL(5, 2)) AS rate,
               CAST(l_extendedprice AS DECIMAL(15, 2)) * (1 - CAST(l_discount AS DECIMAL(5, 2))) AS sold
        FROM lineitem) AS lines
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN part ON l_partkey = p_partkey
)"""

LINE_MARGIN = half_even(f"{dbl('profit')} / nullif({dbl('sales')}, 0) * 100", 2)
DERIVED = {
    "profit_margin": f"CASE WHEN sales > 0 THEN {LINE_MARGIN} ELSE 0.0::DOUBLE END",
    "discount_amount": half_even(f"{dbl('sales')} * {dbl('discount')}", 2),
    "shipping_days": "CAST(COALESCE(datediff('day', order_date, ship_date), 0) AS INTEGER)",
    "order_year": "CAST(year(order_date) AS INTEGER)",
    "order_month": "CAST(month(order_date) AS INTEGER)",
    "order_quarter": "CAST(quarter(order_date) AS INTEGER)",
    "order_day_of_week": "dayname(order_date)",
    "is_loss": "COALESCE(profit < 0, FALSE)",
}
DERIVE = ", ".join(f"{sql} AS {name}" for name, sql in DERIVED.items())
SILVER = f"{WIDE}, silver AS (SELECT *, {DERIVE} FROM wide)"


def _hit(rule: str, below: str) -> str:
    key = ", ".join(f"CAST({c} AS VARCHAR)" for c in DIGEST_OF)
    return f"substring(md5(concat_ws('|', {key})), {FIRST_DIGIT[rule]}, 4) < '{below}'"


_FAULTS = {
    "postal_code": f"CASE WHEN NOT {_hit('postal', ONE_PERCENT)} THEN postal_code END",
    "sales": f"""CASE WHEN {_hit('sales text', ONE_PERCENT)} THEN 'n.a.'
                 WHEN NOT {_hit('sales', ONE_PERCENT)} THEN CAST(sales AS VARCHAR) END""",
    "region": f"""CASE WHEN {_hit('region text', FOURTEEN_PERCENT)} THEN '  ' || lower(region) || ' '
                  WHEN NOT {_hit('region', ONE_PERCENT)} THEN region END""",
    "order_date": f"""CASE WHEN {_hit('date', ONE_PERCENT)} THEN 'not-a-date'
                      ELSE CAST(order_date AS VARCHAR) END""",
}
_RAW = ", ".join(f"{_FAULTS.get(c, f'CAST({c} AS VARCHAR)')} AS {c}" for c in RAW_COLUMNS)
RAW = f"""{WIDE},
raw AS (
  SELECT {_RAW} FROM wide
  UNION ALL
  SELECT {_RAW} FROM wide WHERE {_hit('repeat', HALF_PERCENT)}
)"""

_KEYS = ["order_id", "product_id", "customer_id"]
_FIRST = ", ".join(
    ["TRY_CAST(row_id AS BIGINT) NULLS LAST"]
    + [f"{c} NULLS LAST" for c in RAW_COLUMNS if c not in _KEYS]
)
KEPT = f"""{RAW},
kept AS (
  SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (PARTITION BY {', '.join(_KEYS)} ORDER BY {_FIRST}) AS place FROM raw)
  WHERE place = 1
)"""


def number(c: str) -> str:
    return f"TRY_CAST({c} AS DECIMAL(38, 6))"


def median_of(c: str, table: str) -> str:
    return f"(SELECT CAST(quantile_cont({dbl(number(c))}, 0.5) AS VARCHAR) FROM {table})"


def mode_of(c: str, table: str) -> str:
    return f"(SELECT {c} FROM {table} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


def day(c: str) -> str:
    return f"CAST(try_strptime({c}, '%Y-%m-%d') AS DATE)"


def whole(c: str, kind: str) -> str:
    return f"CAST(COALESCE(trunc({number(c)}), 0) AS {kind})"


def title(c: str) -> str:
    stripped = rf"regexp_replace({c}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"
    runs = rf"regexp_extract_all(lower({stripped}), '(\p{{Ll}}+|[^\p{{Ll}}]+)')"
    return f"array_to_string(list_transform({runs}, lambda x: upper(x[1]) || x[2:]), '')"


def _gap_filled(c: str) -> str:
    if c in NUMERIC_COLUMNS:
        return f"COALESCE({c}, {median_of(c, 'kept')})"
    if c in CATEGORY_COLUMNS:
        return f"COALESCE({c}, {mode_of(c, 'kept')}, 'Unknown')"
    return f"COALESCE({c}, '{'00000' if c == 'postal_code' else 'Unknown'}')"


def _typed(c: str) -> str:
    if c in ("order_date", "ship_date"):
        return day(c)
    if c == "quantity":
        return whole(c, "BIGINT")
    if c == "row_id":
        return whole(c, "BIGINT")
    if c in NUMERIC_COLUMNS:
        return number(c)
    if c == "postal_code":
        return pad(c, 5)
    if c in CATEGORY_COLUMNS:
        return title(c)
    return c


CLEAN = f"""{KEPT},
filled AS (SELECT {', '.join(f'{_gap_filled(c)} AS {c}' for c in RAW_COLUMNS)} FROM kept),
typed AS (SELECT {', '.join(f'{_typed(c)} AS {c}' for c in RAW_COLUMNS)} FROM filled),
clean AS (SELECT *, {DERIVE} FROM typed)"""


def over(tables: str, query: str) -> str:
    return f"WITH {tables}\n{query}"


def _as_output(columns) -> str:
    amounts = {"sales", "discount", "profit"}
    return ", ".join(f"{dbl(c)} AS {c}" if c in amounts else c for c in columns)


def grouped(keys: list[str], *measures: str, tail: str = "", table: str = "silver", drop_null: bool = True) -> str:
    where = " AND ".join(f"{k.split(' AS ')[0]} IS NOT NULL" for k in keys) if drop_null else "TRUE"
    group = ", ".join(str(i + 1) for i in range(len(keys)))
    return over(
        SILVER,
        f"SELECT {', '.join([*keys, *measures])} FROM {table} WHERE {where} GROUP BY {group} {tail}",
    )


# Queries

_YEAR_MONTH = "strftime(order_date, '%Y-%m') AS year_month"
_STATE = ["state", "region"]
_SUB = ["category", "sub_category"]
_ROLL_SALES = "CAST(round(sum(sales), 2) AS DOUBLE)"
_ROLL_PROFIT = "CAST(round(sum(profit), 2) AS DOUBLE)"
_ROLL = [f"{_ROLL_SALES} AS sales", f"{_ROLL_PROFIT} AS profit"]
_ROLL_QUANTITY = "CAST(sum(quantity) AS BIGINT) AS quantity"
_ROLL_DISCOUNT = half_up(f"{AVG_DISCOUNT} * 100", 2) + " AS avg_discount_pct"

_KPI = {
    "total_sales": half_even(total("sales"), 2),
    "total_profit": half_even(total("profit"), 2),
    "total_orders": ORDERS,
    "total_customers": CUSTOMERS,
    "avg_order_value": "(SELECT "
    + half_even("avg_total", 2)
    + " FROM (SELECT sum(order_total) / count(*) AS avg_total FROM "
    "(SELECT CAST(sum(sales) AS DOUBLE) AS order_total FROM silver WHERE order_id IS NOT NULL GROUP BY order_id)))",
    "avg_profit_margin_pct": half_even(MEAN_MARGIN, 2),
    "overall_discount_rate_pct": half_even(f"{AVG_DISCOUNT} * 100", 2),
    "loss_line_items_pct": half_even(f"{ratio('count(*) FILTER (WHERE is_loss)', 'count(*)')} * 100", 2),
}


def _extreme(key: str, order: str) -> str:
    return (
        f"(SELECT {key} FROM silver WHERE {key} IS NOT NULL GROUP BY {key} "
        f"ORDER BY sum(profit) {order}, {key} LIMIT 1)"
    )


_SUMMARY = {
    "total_sales": half_even(total("sales"), 2),
    "total_profit": half_even(total("profit"), 2),
    "overall_profit_margin_pct": f"COALESCE({half_even(ratio('sum(profit)', 'sum(sales)') + ' * 100', 2)}, 0)",
    "best_performing_category": _extreme("category", "DESC"),
    "worst_performing_category": _extreme("category", "ASC"),
    "best_performing_region": _extreme("region", "DESC"),
    "worst_performing_region": _extreme("region", "ASC"),
    "total_loss_amount": half_even("CAST(COALESCE(sum(profit) FILTER (WHERE profit < 0), 0) AS DOUBLE)", 2),
    "loss_making_sku_count": "(SELECT count(*) FROM (SELECT 1 FROM silver WHERE product_id IS NOT NULL "
    "GROUP BY product_id HAVING sum(profit) < 0))",
}


def _fields(expressions: dict[str, str], names=None) -> str:
    return ", ".join(f"{expressions[n]} AS {n}" for n in (names or expressions))


_RISK = f"""SELECT product_name, sub_category, category, {total('sales')} AS total_sales,
       {total('profit')} AS total_profit, {AVG_DISCOUNT} AS avg_discount, {MEAN_MARGIN} AS avg_margin,
       count(order_id) AS occurrences
FROM silver
WHERE CAST(discount AS DOUBLE) >= 0.3 AND profit_margin < 5.0
  AND product_name IS NOT NULL AND sub_category IS NOT NULL AND category IS NOT NULL
GROUP BY ALL"""

_YOY = f"""SELECT *, {half_even('(profit - prior_year_profit) / nullif(abs(prior_year_profit), 0) * 100', 2)} AS yoy_growth_pct
FROM (SELECT *, lag(profit) OVER (PARTITION BY category ORDER BY order_year) AS prior_year_profit
      FROM (SELECT order_year, category, {PROFIT}, {SALES} FROM silver
            WHERE order_year IS NOT NULL AND category IS NOT NULL GROUP BY order_year, category))"""


def _bands() -> str:
    cases = " ".join(
        f"WHEN discount > {low} AND discount <= {high} THEN '{label}'" for low, high, label in DISCOUNT_BANDS
    )
    return f"CASE {cases} END"


def _counted(values: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {values}) AS BIGINT)"


def _rows(pairs: dict[str, str], source: str, name: str, value: str) -> str:
    """One row per expression over `source`."""
    return "\nUNION ALL\n".join(
        f"SELECT '{label}' AS {name}, {sql} AS {value} FROM {source}" for label, sql in pairs.items()
    )


_DUPLICATES = "(SELECT count(*) FROM raw) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw))"

_BASIC_RULES = {
    "order_id has no nulls": "count(*) FILTER (WHERE order_id IS NULL) = 0",
    "sales has no nulls": "count(*) FILTER (WHERE sales IS NULL) = 0",
    "profit has no nulls": "count(*) FILTER (WHERE profit IS NULL) = 0",
    "sales above 0": "COALESCE(bool_and(COALESCE(sales > 0, FALSE)), TRUE)",
    "discount within 0 and 1": "COALESCE(bool_and(COALESCE(discount BETWEEN 0 AND 1, FALSE)), TRUE)",
    "shipping_days not negative": "COALESCE(bool_and(COALESCE(shipping_days >= 0, FALSE)), TRUE)",
    "profit_margin exists": "count(profit_margin) >= 0",
    "is_loss is boolean": "bool_and(typeof(is_loss) = 'BOOLEAN')",
    "at least 1000 rows": "count(*) >= 1000",
}
_MARGIN_1 = half_even(f"{dbl('profit')} / nullif({dbl('sales')}, 0) * 100", 1)
_FULL_RULES = {f"{c} has no nulls": _counted(f"{c} IS NULL") for c in CRITICAL_COLUMNS} | {
    "sales above 0": _counted("sales <= 0"),
    "discount within 0 and 1": _counted("discount < 0 OR discount > 1"),
    "shipping_days not negative": _counted("shipping_days < 0"),
    "profit_margin matches": _counted(
        f"(sales = 0 AND profit <> 0) OR abs({_MARGIN_1} - {half_even('profit_margin', 1)}) > 0.5"
    ),
    "at least 1000 rows": "CAST(greatest(1000 - count(*), 0) AS BIGINT)",
}


def _describe(columns) -> str:
    def one(c):
        v = dbl(c)
        quartiles = ", ".join(
            f"{half_even(f'quantile_cont({v}, {q})', 2)} AS p{int(q * 100)}" for q in (0.25, 0.5, 0.75)
        )
        return (
            f"SELECT '{c}' AS field, count({c}) AS count, {half_even(f'avg({v})', 2)} AS mean, "
            f"{half_even(f'stddev_samp({v})', 2)} AS std, {half_even(f'min({v})', 2)} AS min, "
            f"{quartiles}, {half_even(f'max({v})', 2)} AS max FROM silver"
        )

    return "\nUNION ALL\n".join(one(c) for c in columns)


def _histogram(columns, bins: int, value="{}") -> str:
    def one(c):
        v = f"CAST({value.format(c)} AS DECIMAL(18, 6))"
        steps = "CAST((v - low) * 1000000 AS HUGEINT) * {b} // nullif(CAST((high - low) * 1000000 AS HUGEINT), 0)"
        place = (
            f"CAST(CASE WHEN high = low THEN {bins // 2} "
            f"ELSE least({steps.format(b=bins)}, {bins - 1}) END AS INTEGER)"
        )
        return (
            f"SELECT '{c}' AS field, {place} AS bin, low, high, count(*) AS count FROM "
            f"(SELECT {v} AS v, min({v}) OVER () AS low, max({v}) OVER () AS high FROM silver WHERE {c} IS NOT NULL) "
            "GROUP BY ALL"
        )

    start = "CASE WHEN low = high THEN CAST(low AS DOUBLE) - 0.5 ELSE CAST(low AS DOUBLE) END"
    width = f"(CASE WHEN low = high THEN 1.0::DOUBLE ELSE CAST(high AS DOUBLE) - CAST(low AS DOUBLE) END / {bins})"
    return (
        f"SELECT field, bin, {half_even(f'{start} + {width} * bin', 4)} AS bin_start, "
        f"{half_even(f'{start} + {width} * (bin + 1)', 4)} AS bin_end, count FROM ("
        + "\nUNION ALL\n".join(one(c) for c in columns)
        + ")"
    )


DESCRIBED = [
    *NUMERIC_COLUMNS,
    "profit_margin",
    "discount_amount",
    "shipping_days",
    "order_year",
    "order_month",
    "order_quarter",
]
LINE = ["row_id", "order_id", "product_id"]


def _line(derived: list[str]) -> str:
    return over(SILVER, f"SELECT {', '.join(LINE + derived)} FROM silver")


def oracle_sql() -> dict[str, str]:
    sub_measures = [SALES, PROFIT, QUANTITY, f"{AVG_DISCOUNT} AS avg_discount"]
    sql: dict[str, str] = {}

    # Input, output, layout
    raw_rows = over(RAW, f"SELECT {', '.join(RAW_COLUMNS)} FROM raw")
    by_category = over(
        SILVER,
        f"SELECT order_year, category, count(*) AS lines, {SALES}, {PROFIT} FROM silver GROUP BY 1, 2",
    )
    sql["sales_wide"] = over(WIDE, f"SELECT {_as_output(RAW_COLUMNS)} FROM wide")
    sql["inject_dirt"] = sql["read_raw"] = raw_rows
    sql["read_table"] = over(WIDE, "SELECT row_id, product_id, CAST(sales AS DOUBLE) AS sales FROM wide")
    sql["write_silver"] = sql["read_silver"] = over(SILVER, f"SELECT {_as_output(SILVER_COLUMNS)} FROM silver")
    sql["sanitize_columns"] = over(
        WIDE, "SELECT row_id, sub_category, CAST(sales AS DOUBLE) AS sales, quantity FROM wide"
    )
    sql["write_partitioned"] = sql["compact"] = sql["read_version"] = by_category
    sql["write_snapshot"] = by_category.replace("FROM silver", "FROM silver WHERE NOT is_loss")
    sql["layer_inventory"] = over(
        f"{RAW}, silver AS (SELECT *, {DERIVE} FROM wide)",
        "SELECT layer, rows > 0 AS has_files, rows > 0 AS has_bytes, CAST(rows AS BIGINT) AS rows FROM ("
        "SELECT 'bronze' AS layer, count(*) AS rows FROM raw UNION ALL SELECT 'silver', count(*) FROM silver UNION ALL "
        f"SELECT 'gold', count(DISTINCT {_YEAR_MONTH.split(' AS ')[0]}) FROM silver UNION ALL SELECT 'dashboard', 0)",
    )
    sql["history"] = over(
        SILVER,
        "SELECT CAST(0 AS BIGINT) AS snapshot_id, count(*) AS rows FROM silver UNION ALL "
        "SELECT CAST(1 AS BIGINT), count(*) FROM silver WHERE NOT is_loss",
    )
    sql["verify_roundtrip"] = over(
        WIDE,
        "SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(*) AS BIGINT) AS stored_rows, "
        f"CAST({len(SILVER_COLUMNS)} AS BIGINT) AS columns, CAST({len(SILVER_COLUMNS)} AS BIGINT) AS stored_columns, "
        "CAST(0 AS BIGINT) AS rows_lost, CAST(0 AS BIGINT) AS rows_added, TRUE AS matches FROM wide",
    )

    # Validation
    sql["require_columns"] = over(RAW, "SELECT order_id, product_id, customer_id FROM raw")
    sql["date_parse_report"] = over(
        RAW,
        _rows(
            {c: _counted(f"{c} IS NOT NULL AND {day(c)} IS NULL") for c in ("order_date", "ship_date")},
            "raw", "column", "invalid",
        ),
    )
    sql["numeric_parse_report"] = over(
        RAW,
        _rows(
            {c: _counted(f"{c} IS NOT NULL AND {number(c)} IS NULL") for c in NUMERIC_COLUMNS},
            "raw", "column", "invalid",
        ),
    )
    nulls = _rows({c: _counted(f"{c} IS NULL") for c in RAW_COLUMNS}, "raw", "column", "nulls")
    rows = "(SELECT count(*) FROM raw)"
    null_pct = half_even(f"{ratio('nulls', rows)} * 100", 2)
    sql["quality_summary"] = over(
        RAW,
        f"SELECT \"column\", {rows} AS rows, CAST({len(RAW_COLUMNS)} AS BIGINT) AS columns, "
        f"{_DUPLICATES} AS duplicate_rows, nulls, {null_pct} AS null_pct FROM ({nulls})",
    )
    sql["validation_summary"] = over(
        RAW,
        f"SELECT {rows} AS rows, '{','.join(RAW_COLUMNS)}' AS columns, "
        f"(SELECT CAST(sum(nulls) AS BIGINT) FROM ({nulls})) AS nulls, {_DUPLICATES} AS duplicates",
    )
    invalid_dates = {c: _counted(f"{c} IS NOT NULL AND {day(c)} IS NULL") for c in ("order_date", "ship_date")}
    invalid_numbers = {c: _counted(f"{c} IS NOT NULL AND {number(c)} IS NULL") for c in NUMERIC_COLUMNS}
    loaded = [
        f"SELECT 'dates' AS report, * FROM ({_rows(invalid_dates, 'raw', 'column', 'figure')})",
        f"SELECT 'numbers', * FROM ({_rows(invalid_numbers, 'raw', 'column', 'figure')})",
        f"SELECT 'quality', * FROM ({nulls})",
        f"SELECT 'summary', 'rows', {rows}",
        f"SELECT 'summary', 'nulls', (SELECT CAST(sum(nulls) AS BIGINT) FROM ({nulls}))",
        f"SELECT 'summary', 'duplicates', {_DUPLICATES}",
    ]
    sql["load_validated"] = over(RAW, "\nUNION ALL\n".join(loaded))
    sql["null_pct_by_column"] = over(
        RAW, f"SELECT \"column\", {null_pct} AS null_pct FROM ({nulls}) WHERE nulls > 0"
    )
    sql["quality_gate_basic"] = over(SILVER, _rows(_BASIC_RULES, "silver", '"check"', "passed"))
    full = _rows(_FULL_RULES, "silver", '"check"', "violations")
    sql["quality_gate_full"] = over(SILVER, f"SELECT *, violations = 0 AS passed FROM ({full})")
    sql["gate_status"] = over(
        SILVER,
        f"SELECT CASE WHEN bool_and(violations = 0) THEN 'PASSED' ELSE 'FAILED' END AS status, "
        f"(SELECT count(*) FROM silver) AS rows, CAST({len(SILVER_COLUMNS)} AS BIGINT) AS columns FROM ({full})",
    )
    run = (
        f"SELECT {rows} AS raw_rows, count(*) AS clean_rows, count(*) FILTER (WHERE is_loss) AS loss_items, "
        f"{half_even(total('sales'), 2)} AS total_sales, {half_even(total('profit'), 2)} AS total_profit FROM clean"
    )
    sql["run_summary"] = sql["run_pipeline"] = over(CLEAN, run)

    def report_row(c):
        if c in NUMERIC_COLUMNS:
            fill = median_of(c, "kept")
        elif c in CATEGORY_COLUMNS:
            fill = mode_of(c, "kept")
        else:
            fill = "'00000'" if c == "postal_code" else "'Unknown'"
        gaps = f"(SELECT count(*) FROM kept WHERE {c} IS NULL)"
        return (
            f"SELECT '{c}' AS \"column\", {rows} AS rows_before, count(*) AS rows_after, "
            f"{rows} - count(*) AS rows_removed, {gaps} AS nulls_filled, "
            f"CASE WHEN {gaps} > 0 THEN {fill} END AS fill_value, "
            f"count(*) FILTER (WHERE {c} IS NULL) AS nulls_left FROM clean"
        )

    sql["cleaning_report"] = over(CLEAN, "\nUNION ALL\n".join(report_row(c) for c in RAW_COLUMNS))

    # Cleaning steps
    sql["drop_exact_duplicates"] = over(RAW, f"SELECT DISTINCT {', '.join(RAW_COLUMNS)} FROM raw")
    sql["drop_key_duplicates"] = over(KEPT, f"SELECT {', '.join(RAW_COLUMNS)} FROM kept")

    def step(columns: dict[str, str], table: str = "raw") -> str:
        fields = ", ".join([*LINE, *[f"{x} AS {c}" for c, x in columns.items()]])
        return over(RAW, f"SELECT {fields} FROM {table}")

    sql["impute_median"] = step(
        {c: dbl(f"TRY_CAST(COALESCE({c}, {median_of(c, 'raw')}) AS DECIMAL(38, 6))") for c in NUMERIC_COLUMNS}
    )
    sql["impute_postal"] = step({"postal_code": "COALESCE(postal_code, '00000')"})
    sql["impute_mode"] = step(
        {c: f"COALESCE({c}, {mode_of(c, 'raw')}, 'Unknown')" for c in CATEGORY_COLUMNS}
    )
    sql["impute_unknown"] = over(
        RAW,
        f"SELECT {', '.join(f'COALESCE({c}, {chr(39)}Unknown{chr(39)}) AS {c}' for c in [*LINE, 'city'])} "
        "FROM (SELECT * REPLACE (CASE WHEN postal_code IS NOT NULL THEN city END AS city) FROM raw)",
    )
    sql["cast_dates"] = step({c: day(c) for c in ("order_date", "ship_date")})
    sql["cast_numerics"] = step({c: dbl(number(c)) for c in NUMERIC_COLUMNS})
    sql["normalize_postal"] = step({"postal_code": pad("CAST(CAST(postal_code AS INTEGER) AS VARCHAR)", 5)})
    sql["cast_ints"] = over(
        RAW,
        f"SELECT order_id, product_id, {whole('row_id', 'BIGINT')} AS row_id, "
        f"{whole('quantity', 'BIGINT')} AS quantity FROM raw",
    )
    sql["standardize_text"] = step({c: title(c) for c in CATEGORY_COLUMNS})
    sql["map_region_alias"] = over(
        WIDE,
        "SELECT row_id, order_id, product_id, CASE region WHEN 'AMERICA' THEN 'Americas' "
        "WHEN 'MIDDLE EAST' THEN 'Asia' ELSE region END AS region FROM wide",
    )
    sql["profit_margin"] = _line(["profit_margin"])
    sql["discount_amount"] = _line(["discount_amount"])
    sql["shipping_days"] = _line(["shipping_days"])
    sql["date_parts"] = _line(["order_year", "order_month", "order_quarter"])
    sql["order_day_of_week"] = _line(["order_day_of_week"])
    sql["is_loss"] = _line(["is_loss"])
    sql["clean"] = over(CLEAN, f"SELECT {_as_output(SILVER_COLUMNS)} FROM clean")

    # Profiles
    sql["describe_numeric"] = over(SILVER, _describe(DESCRIBED))
    sql["histogram"] = over(SILVER, _histogram(NUMERIC_COLUMNS, 40))
    sql["histogram_clipped"] = over(
        SILVER, _histogram(["profit_margin"], 50, "least(greatest({}, -100.0::DOUBLE), 100.0::DOUBLE)")
    )
    sql["histogram_edges"] = over(
        SILVER,
        "SELECT CAST(least(shipping_days, 13) AS INTEGER) AS bin, count(*) AS count FROM silver "
        "WHERE shipping_days BETWEEN 0 AND 14 GROUP BY 1",
    )
    sql["value_counts"] = over(
        SILVER,
        "\nUNION ALL\n".join(
            f"SELECT '{c}' AS field, {c} AS value, count(*) AS count FROM silver WHERE {c} IS NOT NULL GROUP BY {c}"
            for c in ("region", "category", "segment", "ship_mode")
        ),
    )
    sql["correlation_matrix"] = over(
        SILVER,
        "\nUNION ALL\n".join(
            f"SELECT '{x}' AS field_x, '{y}' AS field_y, {half_even(f'corr({dbl(x)}, {dbl(y)})', 6)} AS correlation FROM silver"
            for x in NUMERIC_COLUMNS
            for y in NUMERIC_COLUMNS
        ),
    )
    sql["extent_and_cardinality"] = over(
        SILVER,
        "SELECT min(order_date) AS first_order, max(order_date) AS last_order, "
        "count(DISTINCT order_date) AS order_dates, count(DISTINCT order_id) AS orders, "
        "count(DISTINCT customer_id) AS customers, count(DISTINCT product_id) AS products FROM silver",
    )
    loss = ["row_id", "product_name", "category", "sales", "profit", "discount"]
    sql["loss_items"] = over(
        SILVER,
        f"SELECT {_as_output([*loss, 'profit_margin'])} FROM (SELECT * FROM silver WHERE is_loss "
        f"ORDER BY {', '.join(loss)} LIMIT 10)",
    )
    sql["loss_share"] = over(
        SILVER,
        "SELECT count(*) FILTER (WHERE is_loss) AS loss_items, "
        f"{half_even(ratio('count(*) FILTER (WHERE is_loss)', 'count(*)') + ' * 100', 1)} AS loss_pct FROM silver",
    )
    rest = [c for c in RAW_COLUMNS if c != "row_id"]
    sql["preview"] = over(
        WIDE,
        f"SELECT {_as_output(RAW_COLUMNS)} FROM (SELECT * FROM wide ORDER BY row_id, {', '.join(rest)} LIMIT 5)",
    )

    # Sales
    sql["kpi_summary"] = over(SILVER, f"SELECT {_fields(_KPI)} FROM silver")
    sql["monthly_sales_trend"] = over(
        SILVER,
        f"SELECT {_YEAR_MONTH}, {SALES}, {PROFIT}, {ORDERS} AS orders, {margin()} FROM silver "
        "WHERE order_date IS NOT NULL GROUP BY 1",
    )
    sql["quarterly_sales_trend"] = over(
        SILVER,
        f"SELECT order_year || '-Q' || order_quarter AS year_quarter, {SALES}, {PROFIT}, {ORDERS} AS orders, "
        f"{margin()} FROM silver WHERE order_date IS NOT NULL GROUP BY 1",
    )
    sql["yearly_sales_trend"] = grouped(
        ["order_year"], SALES, PROFIT, f"{ORDERS} AS orders", f"{CUSTOMERS} AS customers", margin()
    )
    sql["category_performance"] = grouped(
        ["category"], SALES, PROFIT, QUANTITY, f"{ORDERS} AS orders", f"{AVG_DISCOUNT} AS avg_discount",
        margin(), discount_pct(),
    )
    sql["subcategory_performance"] = grouped(_SUB, *sub_measures, margin())
    regional = [
        SALES, PROFIT, f"{ORDERS} AS orders", f"{CUSTOMERS} AS customers",
        f"{AVG_DISCOUNT} AS avg_discount", margin(), discount_pct(),
    ]
    sql["regional_performance"] = grouped(["region"], *regional)

    def pivot(amount: str, missing: str) -> str:
        cells = ", ".join(
            f"COALESCE({half_even(f'CAST(sum({amount}) FILTER (WHERE category = {chr(39)}{c}{chr(39)}) AS DOUBLE)', 2)}, "
            f'{missing}) AS "{c}"'
            for c in PIVOT_CATEGORIES
        )
        return grouped(["region"], cells)

    sql["regional_category_sales_pivot"] = pivot("sales", "0.0::DOUBLE")
    sql["state_performance"] = grouped(_STATE, SALES, PROFIT, margin())
    sql["top_products_by_sales"] = grouped(
        PRODUCT_KEY, SALES, PROFIT, QUANTITY, margin(),
        tail=f"ORDER BY sum(silver.sales) DESC, {', '.join(PRODUCT_KEY)} LIMIT 10",
    )
    loss_products = grouped(
        PRODUCT_KEY, *sub_measures, margin(), discount_pct(), tail="HAVING sum(silver.profit) < 0"
    )
    sql["loss_making_products"] = loss_products
    sql["segment_performance"] = grouped(
        ["segment"], SALES, PROFIT, f"{ORDERS} AS orders", f"{CUSTOMERS} AS customers", margin(),
        half_even(ratio("sum(silver.sales)", ORDERS), 2) + " AS avg_order_value",
    )
    sql["top_customers_by_sales"] = grouped(
        ["customer_id", "customer_name", "segment"], SALES, PROFIT, f"{ORDERS} AS orders",
        tail="ORDER BY sum(silver.sales) DESC, customer_id, customer_name, segment LIMIT 10",
    )
    sql["discount_impact_analysis"] = over(
        SILVER,
        f"SELECT {_bands()} AS discount_bucket, {half_even(MEAN_MARGIN, 2)} AS avg_profit_margin, "
        f"{total('sales')} AS total_sales, {total('profit')} AS total_profit, count(order_id) AS n_transactions "
        f"FROM silver WHERE {_bands()} IS NOT NULL GROUP BY 1",
    )
    sql["shipping_analysis"] = over(
        SILVER,
        f"SELECT *, {half_even(ratio('orders', 'sum(orders) OVER ()') + ' * 100', 2)} AS order_share_pct FROM ("
        f"SELECT ship_mode, {ORDERS} AS orders, {half_even(mean('shipping_days'), 1)} AS avg_shipping_days, {SALES} "
        "FROM silver WHERE ship_mode IS NOT NULL GROUP BY 1)",
    )

    # Profitability
    sql["profitability_by_state"] = grouped(_STATE, SALES, PROFIT, f"{ORDERS} AS orders", margin())
    sql["subcategory_return_on_sales"] = grouped(_SUB, *sub_measures, margin("return_on_sales"), discount_pct())
    sql["yoy_profit_growth"] = over(SILVER, _YOY)
    sql["high_discount_low_profit_risk"] = over(SILVER, _RISK)
    sql["profitability_pivot"] = pivot("profit", "NULL")
    sql["monthly_profit_trend"] = over(
        SILVER,
        f"SELECT year_month, CAST(p AS DOUBLE) AS profit, CAST(s AS DOUBLE) AS sales, "
        f"{half_even(ratio('p', 's') + ' * 100', 2)} AS profit_margin, "
        f"{half_even(ratio('sum(p) OVER w', 'count(p) OVER w'), 2)} AS profit_rolling_3m FROM ("
        f"SELECT {_YEAR_MONTH}, COALESCE(sum(profit), 0) AS p, COALESCE(sum(sales), 0) AS s FROM silver "
        "WHERE order_date IS NOT NULL GROUP BY 1) "
        "WINDOW w AS (ORDER BY year_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)",
    )
    sql["executive_summary"] = over(SILVER, f"SELECT {_fields(_SUMMARY)} FROM silver")

    # Rollups
    sql["spark_kpi_summary"] = over(
        SILVER,
        f"SELECT {_ROLL_SALES} AS total_sales, {_ROLL_PROFIT} AS total_profit, {ORDERS} AS total_orders, "
        f"{CUSTOMERS} AS total_customers, {_ROLL_DISCOUNT} FROM silver",
    )
    month_roll = [*_ROLL, f"{ORDERS} AS orders"]
    category_roll = [*_ROLL, _ROLL_QUANTITY, _ROLL_DISCOUNT, f"{ORDERS} AS orders"]
    region_roll = [*_ROLL, f"{ORDERS} AS orders", f"{CUSTOMERS} AS customers"]
    sql["spark_monthly_trend"] = grouped([_YEAR_MONTH], *month_roll, drop_null=False)
    sql["spark_category_performance"] = grouped(["category"], *category_roll, drop_null=False)
    sql["spark_subcategory_performance"] = grouped(_SUB, *_ROLL, _ROLL_QUANTITY, drop_null=False)
    sql["spark_regional_performance"] = grouped(["region"], *region_roll, drop_null=False)
    sql["join_order_with_product_summary"] = over(
        SILVER,
        f"""SELECT a.*, b.distinct_products, b.total_quantity
FROM (SELECT order_id, {_ROLL_SALES} AS order_total_sales, {_ROLL_PROFIT} AS order_total_profit,
             first(customer_id ORDER BY row_id, product_id, quantity, sales, profit, customer_id, region) AS customer_id,
             first(region ORDER BY row_id, product_id, quantity, sales, profit, customer_id, region) AS region
      FROM silver GROUP BY order_id) AS a
LEFT JOIN (SELECT order_id, count(DISTINCT product_id) AS distinct_products,
                  CAST(sum(quantity) AS BIGINT) AS total_quantity
           FROM silver GROUP BY order_id) AS b ON a.order_id = b.order_id""",
    )
    sql["running_monthly_sales"] = over(
        SILVER,
        """SELECT year, month, CAST(m AS DOUBLE) AS monthly_sales,
       CAST(round(sum(m) OVER (PARTITION BY year ORDER BY month ROWS UNBOUNDED PRECEDING), 2) AS DOUBLE) AS cumulative_sales
FROM (SELECT order_year AS year, order_month AS month, round(sum(sales), 2) AS m FROM silver GROUP BY 1, 2)""",
    )
    ranked = (
        "SELECT *, CAST(dense_rank() OVER (PARTITION BY category ORDER BY sales DESC NULLS LAST) AS INTEGER) "
        f"AS rank_in_category FROM (SELECT category, product_name, {_ROLL_SALES} AS sales FROM silver GROUP BY 1, 2)"
    )
    sql["product_sales_rank_by_category"] = over(SILVER, ranked)
    sql["top_products_per_category"] = over(SILVER, f"SELECT * FROM ({ranked}) WHERE rank_in_category <= 3")
    sql["spark_loss_making_products"] = over(
        SILVER,
        f"SELECT * FROM (SELECT {', '.join(PRODUCT_KEY)}, {_ROLL_SALES} AS total_sales, "
        f"{_ROLL_PROFIT} AS total_profit, {_ROLL_DISCOUNT} FROM silver GROUP BY ALL) WHERE total_profit < 0",
    )

    sql["read_gold"] = sql["category_performance"]
    sql["write_gold"] = sql["monthly_sales_trend"]
    sql["save_results"] = sql["subcategory_performance"]

    # Reports
    pct = half_up("profit / nullif(sales, 0) * 100", 2) + " AS profit_margin_pct"

    def roll(keys: str, measures: list[str]) -> str:
        return f"(SELECT {keys}, {', '.join(measures)} FROM silver GROUP BY 1)"

    sql["high_discount_by_category"] = over(
        SILVER,
        f"SELECT category, {half_even(MEAN_MARGIN, 2)} AS avg_margin, {half_even(total('profit'), 2)} AS total_loss, "
        "count(order_id) AS count FROM silver WHERE CAST(discount AS DOUBLE) >= 0.4 AND category IS NOT NULL GROUP BY 1",
    )
    sql["top_months_by_sales"] = over(
        SILVER,
        f"SELECT year_month, sales, profit, {pct} FROM {roll(_YEAR_MONTH, month_roll)} ORDER BY sales DESC, year_month LIMIT 5",
    )
    sql["category_margin_report"] = over(
        SILVER, f"SELECT category, sales, profit, {pct}, avg_discount_pct FROM {roll('category', category_roll)}"
    )
    sql["regional_report"] = sql["spark_regional_performance"]
    sql["top_loss_line_items"] = over(
        SILVER,
        "SELECT product_name, category, sub_category, CAST(round(sales, 2) AS DOUBLE) AS sales, "
        "CAST(round(profit, 2) AS DOUBLE) AS profit, CAST(discount AS DOUBLE) AS discount, profit_margin FROM ("
        "SELECT * FROM silver WHERE profit < 0 ORDER BY profit, row_id, product_name, category, sub_category, sales LIMIT 20)",
    )
    sql["yoy_growth_nonnull"] = over(
        SILVER,
        f"SELECT order_year, category, profit, yoy_growth_pct FROM ({_YOY}) "
        "WHERE profit IS NOT NULL AND yoy_growth_pct IS NOT NULL",
    )
    kpi_names = ["total_sales", "total_profit", "avg_profit_margin_pct", "total_orders", "total_customers", "avg_order_value"]
    extremes = [n for n in _SUMMARY if n not in ("total_sales", "total_profit", "overall_profit_margin_pct")]
    sql["insights_report"] = over(
        SILVER,
        f"SELECT {_fields(_KPI, kpi_names)}, {_fields(_SUMMARY, extremes)}, "
        f"(SELECT count(*) FROM ({_RISK})) AS risk_products FROM silver",
    )

    def first_of(name: str, n: int, order: str) -> str:
        return f"SELECT * FROM ({sql[name]}) ORDER BY {order} LIMIT {n}"

    product_order = ", ".join(PRODUCT_KEY)
    sql["top_preview_months"] = first_of("monthly_sales_trend", 12, "year_month")
    sql["top_preview_losses"] = first_of("loss_making_products", 10, f"profit, {product_order}")
    sql["top_preview_return_on_sales"] = first_of(
        "subcategory_return_on_sales", 10, "return_on_sales NULLS LAST, category, sub_category"
    )

    # Chart feeds
    more = [n for n in _SUMMARY if n not in _KPI]
    sql["feed_kpi_card"] = over(SILVER, f"SELECT {_fields(_KPI)}, {_fields(_SUMMARY, more)} FROM silver")
    sql["feed_subcategory_top20"] = (
        f"SELECT *, profit < 0 AS is_negative FROM ({sql['subcategory_performance']}) "
        "ORDER BY profit DESC, category, sub_category LIMIT 20"
    )
    sql["feed_regional_share"] = (
        f"SELECT *, {half_even(ratio('sales', 'sum(CAST(sales AS DECIMAL(30, 6))) OVER ()') + ' * 100', 1)} AS sales_share_pct, "
        f"profit > 0 AS is_positive FROM ({sql['regional_performance']})"
    )
    sql["feed_loss_top10"] = (
        "SELECT product_id, CASE WHEN length(product_name) > 35 THEN substring(product_name, 1, 35) || '…' "
        f"ELSE product_name END AS label, profit FROM ({sql['top_preview_losses']})"
    )
    sql["feed_bottom15_states"] = (
        f"SELECT *, profit_margin < 0 AS is_negative FROM ({sql['profitability_by_state']}) "
        "ORDER BY profit_margin NULLS LAST, state, region LIMIT 15"
    )
    sql["feed_ros_flagged"] = f"SELECT *, return_on_sales < 0 AS is_negative FROM ({sql['subcategory_return_on_sales']})"
    sql["gold_top_months"] = sql["top_months_by_sales"]
    sql["gold_category_margins"] = sql["category_margin_report"]
    sql["gold_regions"] = sql["regional_report"]
    periods = {
        "month": _YEAR_MONTH.split(" AS ")[0],
        "quarter": "order_year || '-Q' || order_quarter",
        "year": "CAST(order_year AS VARCHAR)",
    }
    sql["cardinality_by_period"] = over(
        SILVER,
        "\nUNION ALL\n".join(
            f"SELECT '{level}' AS level, {label} AS period, {ORDERS} AS orders, {CUSTOMERS} AS customers "
            "FROM silver WHERE order_date IS NOT NULL GROUP BY 2"
            for level, label in periods.items()
        ),
    )
    return sql


# The categories of the generated part table.
PIVOT_CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
