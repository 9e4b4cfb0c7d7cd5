"""Session settings the operators are designed for."""

from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Re-plan at run time: small sides are broadcast only after their size is known,
    # small shuffle partitions are merged and hot ones are split, also where the
    # split costs one more exchange.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

# Stored tables: about a third smaller than with Spark's own choice of codec.
TABLE_CODEC = "zstd"


def short_methods(spark: SparkSession) -> None:
    """Rows with many long expressions otherwise make one generated method of more than 8,000 bytes, which the JVM
    interprets; Spark then makes several short ones, which are compiled. For sessions that others set up."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


# Files of a shuffle are deleted when the action that made it ends, and not only once the driver collects garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock = Lock()
_writers: dict[SparkSession, tuple[int, str | None]] = {}


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes in here leave no shuffle files behind; side by side, the last one to end restores the session's setting."""
    with _lock:
        writers, before = _writers.get(spark) or (0, spark.conf.get(FREE_SHUFFLES, None))
        _writers[spark] = writers + 1, before
        spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        with _lock:
            writers, before = _writers.pop(spark)
            if writers > 1:
                _writers[spark] = writers - 1, before
            elif before is None:
                spark.conf.unset(FREE_SHUFFLES)
            else:
                spark.conf.set(FREE_SHUFFLES, before)


def local_session(cpus: int = 8, app: str = "saleslens", memory: str = "8g") -> SparkSession:
    """Single-machine session for tests and the bench; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.driver.memory", memory)
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
