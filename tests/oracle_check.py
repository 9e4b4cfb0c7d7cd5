"""Run registered queries and their SQL counterparts side by side.

    python -m tests.oracle_check [folder of the tables] [query ...]
"""

import datetime
import decimal
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
DUCK_TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "DATE": "date",
}


def duck(sf_dir: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, float) and math.isnan(value):
        return ("nan",)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def difference(frame, connection, sql: str) -> str | None:
    """None if names, types and rows agree."""
    result = connection.execute(sql)
    want_names = [d[0] for d in result.description]
    want_types = {d[0]: DUCK_TYPES.get(str(d[1]), str(d[1])) for d in result.description}
    want = result.fetchall()
    got = frame.collect()
    if sorted(want_names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(want_names)}"
    if dict(frame.dtypes) != want_types:
        wrong = {c: (t, want_types[c]) for c, t in frame.dtypes if t != want_types[c]}
        return f"types (spark, sql): {wrong}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    got_rows, want_rows = _rows(frame.columns, got), _rows(want_names, want)
    wrong = [(g, w) for g, w in zip(got_rows, want_rows, strict=True) if g != w]
    if wrong:
        return f"{len(wrong)} of {len(got)} rows differ, first (spark, sql): {wrong[0]}"
    return None


def main(arguments: list[str]) -> int:
    import __spark_entry__ as contract
    from saleslens.session import local_session

    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    names = arguments[1:] or list(contract.queries())
    spark = local_session()
    connection = duck(sf_dir)
    oracles = contract.oracle_sql()
    bad = 0
    for name in names:
        start = time.time()
        try:
            frame = contract.queries()[name](spark, sf_dir)
            if name in oracles:
                problem = difference(frame, connection, oracles[name])
            else:
                problem = None if frame.count() else "no rows"
        except Exception as error:  # the report goes on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
