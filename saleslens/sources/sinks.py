"""Writers. Every write is one Spark job that replaces its target, so it can be repeated."""

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslens.errors import SinkError, SourceError
from saleslens.functions.frames import with_row
from saleslens.functions.repeats import fingerprint
from saleslens.session import TABLE_CODEC, freed_shuffles
from saleslens.sources.files import CSV_OPTIONS
from saleslens.sources.layers import kept

SINK_FORMATS = ["parquet", "csv", "delta"]
PARTITION_COLUMNS = ["order_year", "category"]
CLUSTER_COLUMNS = ["category", "region"]
SNAPSHOT = "snapshot_id"
# Usual bytes of a value in memory, 8 where nothing is said.
WIDTHS = {"string": 24, "decimal": 24, "binary": 100, "array": 100, "map": 100, "struct": 100}


# A compressed text file is read by one task, so it holds at most so many rows.
ROWS_OF_COMPRESSED = 1_000_000


def save_results(frame: DataFrame, path: str, format: str = "parquet", compression: str | None = None) -> str:
    """Replace `path` by `frame`. Delta needs its library on the class path.

    With `compression` (as `gzip`), CSV files are stored compressed, each with at most `ROWS_OF_COMPRESSED` rows. Parquet files
    are stored with `TABLE_CODEC` if nothing else is asked for.
    """
    if format not in SINK_FORMATS:
        raise SinkError(f"no writer for {format!r}, use one of {SINK_FORMATS}")
    options = CSV_OPTIONS if format == "csv" else {}
    if format == "parquet":
        compression = compression or TABLE_CODEC
    if compression:
        options = {**options, "compression": compression}
        if format == "csv":
            options["maxRecordsPerFile"] = ROWS_OF_COMPRESSED
    try:
        with freed_shuffles(frame.sparkSession):
            frame.write.format(format).mode("overwrite").options(**options).save(path)
    except AnalysisException as error:
        raise SinkError(f"cannot write {format} to {path}: {error}") from error
    except Exception as error:
        if format == "delta" and "DATA_SOURCE_NOT_FOUND" in str(error):
            raise SinkError("the Delta library is not on the class path") from error
        raise
    return path


def write_silver(frame: DataFrame, path: str) -> str:
    return save_results(frame, path, "parquet")


def write_gold(name: str, frame: DataFrame, folder: str) -> str:
    """One analytic as CSV with header, under its own name."""
    return save_results(frame, f"{folder.rstrip('/')}/{name}", "csv")


def write_partitioned(
    frame: DataFrame, table: str, path: str, by: list[str] = PARTITION_COLUMNS,
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Replace a registered Parquet table, one folder per value of `by`.

    Rows of a folder are brought together before the write, so tasks do not each write
    a small file to every folder; folders that hold a large part of the rows are split
    into several tasks by the adaptive rebalance. `finish` adds columns that follow from the
    others, behind the shuffle, which then moves less.
    """
    rows = frame.hint("rebalance", *by)
    (
        (finish(rows) if finish else rows)
        .write.mode("overwrite")
        .partitionBy(*by)
        .option("path", path)
        .saveAsTable(table)
    )
    return frame.sparkSession.table(table)


def list_tables(spark: SparkSession) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables())


BUCKETS = 1 << 16


def _bucket_sums(frame: DataFrame, columns: list[str]) -> DataFrame:
    """Per bucket of rows: how many, and two sums of their fingerprints, whatever the order of the rows."""
    halves = [F.shiftrightunsigned("_print", 32), F.col("_print").bitwiseAND(F.lit(0xFFFFFFFF))]
    sums = [F.sum(h).alias(n) for h, n in zip(halves, ("_high", "_low"), strict=True)]
    return with_bucket(frame, columns).groupBy("_bucket").agg(F.count("*").alias("_n"), *sums)


def with_bucket(frame: DataFrame, columns: list[str]) -> DataFrame:
    rows = frame.select("*", fingerprint(columns).alias("_print"))
    return rows.withColumn("_bucket", F.col("_print").bitwiseAND(F.lit(BUCKETS - 1)).cast("int"))


def unequal_buckets(frame: DataFrame, other: DataFrame, columns: list[str]) -> DataFrame:
    """(_bucket, rows, stored_rows): every bucket, and whether its rows may `differ`."""
    mine = _bucket_sums(frame, columns)
    theirs = _bucket_sums(other, columns).toDF("_other", "_m", "_h", "_l")
    met = mine.join(theirs, F.col("_bucket") == F.col("_other"), "full")
    same = (F.col("_n") == F.col("_m")) & (F.col("_high") == F.col("_h")) & (F.col("_low") == F.col("_l"))
    return met.select(
        F.coalesce("_bucket", "_other").alias("_bucket"),
        F.coalesce("_n", F.lit(0)).alias("rows"),
        F.coalesce("_m", F.lit(0)).alias("stored_rows"),
        (~F.coalesce(same, F.lit(False))).alias("differ"),
    )


def differing_rows(frame: DataFrame, other: DataFrame, buckets: DataFrame | None = None) -> DataFrame:
    """Rows that one of two tables with the same columns holds more often, with the `surplus` of the first.

    Rows are summed up by bucket; only rows of buckets whose sums differ are shuffled and compared whole.
    `buckets` are those of `unequal_buckets`, if they are known already.
    """
    columns = frame.columns
    if buckets is None:
        buckets = unequal_buckets(frame, other.select(*columns), columns)
    suspects = F.broadcast(buckets.where("differ").select("_bucket"))  # at most `BUCKETS` numbers

    def rows(side: DataFrame, sign: int) -> DataFrame:
        return with_bucket(side.select(*columns), columns).join(suspects, "_bucket").select(*columns, F.lit(sign).alias("_here"))

    both = rows(frame, 1).unionByName(rows(other, -1))
    return both.groupBy(*columns).agg(F.sum("_here").alias("surplus")).where(F.col("surplus") != 0)


def verify_roundtrip(frame: DataFrame, path: str) -> DataFrame:
    """Compare `frame` with the Parquet table at `path`: shape, and rows on either side only.

    Equal tables are told by sums of row fingerprints, of which only one row a bucket is shuffled; where sums
    differ, the rows of these buckets are compared whole. Tables with different columns have no equal rows, but
    for those whose missing values are null.
    """
    stored = frame.sparkSession.read.parquet(path)
    every = [*frame.columns, *[c for c in stored.columns if c not in frame.columns]]
    left, right = _widened(frame, stored, every), _widened(stored, frame, every)
    buckets = kept(unequal_buckets(left, right, every), "buckets")
    sums = buckets.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.coalesce(F.sum("stored_rows"), F.lit(0)).alias("stored_rows")
    )
    # Nothing of the rows is read again where all sums agree.
    found = left.select(F.lit(0).cast("bigint").alias("surplus")).limit(0)
    if not buckets.where("differ").isEmpty():
        found = differing_rows(left, right, buckets)
    surplus = found.agg(
        F.coalesce(F.sum(F.greatest("surplus", F.lit(0))), F.lit(0)).alias("rows_lost"),
        F.coalesce(F.sum(F.greatest(-F.col("surplus"), F.lit(0))), F.lit(0)).alias("rows_added"),
    )
    return with_row(sums, surplus).select(
        "rows",
        "stored_rows",
        F.lit(len(frame.columns)).cast("bigint").alias("columns"),
        F.lit(len(stored.columns)).cast("bigint").alias("stored_columns"),
        "rows_lost",
        "rows_added",
        ((F.col("rows_lost") == 0) & (F.col("rows_added") == 0) & F.lit(frame.columns == stored.columns)).alias("matches"),
    )


def _widened(frame: DataFrame, other: DataFrame, columns: list[str]) -> DataFrame:
    """`frame` with all of `columns`; those that only `other` has are null."""
    kinds = {f.name: f.dataType for f in other.schema}
    return frame.select(*[F.col(c) if c in frame.columns else F.lit(None).cast(kinds[c]).alias(c) for c in columns])


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files below `path`, from the file listing."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()["bytes"]


def compact(
    spark: SparkSession,
    path: str,
    target: str,
    cluster_by: list[str] = CLUSTER_COLUMNS,
    spread_by: list[str] = ("order_id", "product_id"),
    file_bytes: int = 512 * 2**20,
    sort_bytes: int = 2**29,
) -> str:
    """Rewrite a Parquet table as files of about `file_bytes` at most, clustered by `cluster_by`.

    Range filters on these columns then skip most files. `spread_by` follows in the
    range key, so one combination of cluster values may stretch over many files. A file is sorted
    by one task, whose rows take several times the file's size: files are smaller where the rows
    of one would take more than about `sort_bytes`, at the usual width of their types.
    """
    table = spark.read.parquet(path)
    keys = [*cluster_by, *[c for c in spread_by if c in table.columns]]
    width = sum(WIDTHS.get(f.dataType.typeName(), 8) for f in table.schema)
    files = max(1, -(-stored_bytes(spark, path) // file_bytes), -(-table.count() * width // sort_bytes))
    ranged = table.repartitionByRange(files, *keys).sortWithinPartitions(*keys)
    with freed_shuffles(spark):
        ranged.write.mode("overwrite").parquet(target, compression=TABLE_CODEC)
    return target


# Versions of a table, each a partition of its own.


def write_snapshot(frame: DataFrame, path: str, version: int) -> str:
    """Store `frame` as one version; writing a version again replaces only it."""
    (
        frame.withColumn("written_at", F.current_timestamp())
        .withColumn(SNAPSHOT, F.lit(version).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(SNAPSHOT)
        .parquet(path)
    )
    return path


def read_version(spark: SparkSession, path: str, version: int) -> DataFrame:
    """One version; the folders of the others are not read. A version that was never written is an error."""
    stored = spark.read.parquet(path)
    if stored.where(F.col(SNAPSHOT) == version).isEmpty():
        raise SourceError(f"{path} has no version {version}")
    return stored.where(F.col(SNAPSHOT) == version).drop(SNAPSHOT, "written_at")


def history(spark: SparkSession, path: str) -> DataFrame:
    """Rows and time of every version, latest first."""
    return (
        spark.read.parquet(path)
        .groupBy(F.col(SNAPSHOT).cast("bigint").alias(SNAPSHOT))
        .agg(F.count("*").alias("rows"), F.max("written_at").alias("written_at"))
        .orderBy(F.desc(SNAPSHOT))
    )
