"""Readers. Raw and gold files are read with known types; nothing is inferred."""

from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslens.errors import SourceError
from saleslens.schema import ENGINE_TO_SOURCE, MISSING_TEXTS, engine_name

FORMATS = {".csv": "csv", ".parquet": "parquet", ".pq": "parquet"}
# Quotes inside quoted fields are doubled and blanks around a text are part of it.
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "encoding": "utf-8",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
# Every file's header must name the same columns in the same order, and a row with too many or too few fields stops the
# read: nothing is swapped, cut or filled up unseen. Whole rows are parsed, as a pruned read would not see such faults.
CSV_CHECKS = {"enforceSchema": False, "mode": "FAILFAST", "columnPruning": False}


def sanitize_columns(frame: DataFrame) -> DataFrame:
    """Source names to engine names."""
    return frame.toDF(*[engine_name(c) for c in frame.columns])


def source_columns(frame: DataFrame) -> DataFrame:
    """Engine names back to source names; derived columns keep theirs."""
    return frame.toDF(*[ENGINE_TO_SOURCE.get(c, c) for c in frame.columns])


def read_table(spark: SparkSession, path: str, fmt: str | None = None, **options) -> DataFrame:
    """Read a CSV or Parquet file or folder; the format follows from the name if not given."""
    name = path.rstrip("/").rsplit("/", 1)[-1].lower()
    suffix = "." + name.rsplit(".", 1)[-1] if "." in name else ""
    fmt = fmt or FORMATS.get(suffix)
    if fmt not in FORMATS.values():
        raise SourceError(f"no reader for {fmt or suffix!r}: {path}")
    if fmt == "csv":
        options = {**CSV_OPTIONS, **CSV_CHECKS, **options}
    try:
        return spark.read.format(fmt).options(**options).load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise SourceError(f"nothing to read at {path}") from error
        raise


def files_with_line_breaks(spark: SparkSession, path: str) -> list[str]:
    """Files below `path` that may hold a value with a line break, from one pass over their lines.

    A line break inside a value stands between quotes, so the line before it has an odd number of them, doubled
    ones included. Files whose lines all have an even number hold none.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    return [_plain_path(r.file) for r in lines.where(quotes % 2 == 1).select("file").distinct().collect()]


def _plain_path(uri: str) -> str:
    """A file's URI, which Spark gives in two spellings, as a path to read from."""
    scheme, _, path = unquote(uri).partition(":")
    return f"file:/{path.lstrip('/')}" if scheme == "file" else f"{scheme}:{path}"


def _read_by_need(spark: SparkSession, path: str, fmt: str | None, encoding: str) -> DataFrame:
    """CSV files that hold line breaks in values are read whole, all others are split among tasks."""
    if encoding.lower().replace("-", "").startswith(("utf16", "utf32")):  # lines cannot be told byte by byte
        return read_table(spark, path, fmt, encoding=encoding, multiLine=True)
    split = read_table(spark, path, fmt, encoding=encoding, multiLine=False)
    whole = set(files_with_line_breaks(spark, path))
    if not whole:
        return split
    rest = [f for f in map(_plain_path, split.inputFiles()) if f not in whole]
    if not rest:
        return read_table(spark, path, fmt, encoding=encoding, multiLine=True)
    options = {**CSV_OPTIONS, **CSV_CHECKS, "encoding": encoding, "basePath": path}
    # Whole files come first, as theirs are the longest tasks.
    parts = [spark.read.options(**options, multiLine=m).csv(sorted(f)) for m, f in ((True, whole), (False, rest))]
    if parts[0].columns != parts[1].columns:
        raise SourceError(f"files with different columns at {path}")
    return parts[0].union(parts[1])


def read_raw(spark: SparkSession, path: str, encoding: str = "utf-8", multi_line: bool | None = None) -> DataFrame:
    """Raw order lines as text, by header name, missing-value texts as null.

    Values may hold line breaks. A CSV file with such values is read by one task; others, as a first pass over
    the lines finds out, are split among tasks. `multi_line` saves that pass: True has every file read by one task,
    False has all split, and a value with a line break then stops the read.
    """
    fmt = None if path.rstrip("/").lower().endswith(tuple(FORMATS)) else "csv"
    if multi_line is None and not path.rstrip("/").lower().endswith((".parquet", ".pq")):
        read = _read_by_need(spark, path, fmt, encoding)
    else:
        read = read_table(spark, path, fmt, encoding=encoding, multiLine=bool(multi_line))
    frame = sanitize_columns(read)
    texts = [F.col(c).cast("string") for c in frame.columns]
    missing = [F.lit(text) for text in MISSING_TEXTS]
    return frame.select(
        *[
            F.when(~text.isin(missing), text).alias(c)
            for c, text in zip(frame.columns, texts, strict=True)
        ]
    )


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """Cleaned order lines."""
    return read_table(spark, path, "parquet")


def read_gold(spark: SparkSession, path: str, schema) -> DataFrame:
    """A gold CSV with the types of the analytic that wrote it; values may hold line breaks."""
    try:
        return spark.read.options(**CSV_OPTIONS, **CSV_CHECKS, multiLine=True).schema(schema).csv(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise SourceError(f"no gold table at {path}") from error
        raise
