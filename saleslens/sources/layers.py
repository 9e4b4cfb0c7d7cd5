"""Storage layout: one folder per layer under any URI Spark can reach."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LAYERS = ["bronze", "silver", "gold", "dashboard"]
# The same folders as an object store names them.
BLOB_LAYERS = {"raw": "raw", "processed": "processed", "charts": "output/charts", "analytics": "output/analytics"}


def layer_paths(base: str, layers: list[str] | dict[str, str] = LAYERS) -> dict[str, str]:
    """Layer name to folder URI below `base` (`file:`, `abfss:`, `s3a:`, `hdfs:` ...)."""
    folders = layers if isinstance(layers, dict) else {name: name for name in layers}
    root = base.rstrip("/")
    return {name: f"{root}/{folder}" for name, folder in folders.items()}


def azure_base(account: str, container: str) -> str:
    return f"abfss://{container}@{account}.dfs.core.windows.net"


def layer_inventory(
    spark: SparkSession, base: str, layers: list[str] | dict[str, str] = LAYERS
) -> DataFrame:
    """(layer, files, bytes) of every layer below `base`, 0 where there is none. File contents are not read."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base.rstrip("/"))
    system = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    folders = layer_paths(system.makeQualified(root).toString(), layers)
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(base.rstrip("/"))
        .where(~F.element_at(F.split("path", "/"), -1).rlike(r"^[._]"))
    )
    layer = F.coalesce(
        *[F.when(F.col("path").startswith(f"{folder}/"), F.lit(name)) for name, folder in folders.items()]
    )
    found = files.groupBy(layer.alias("layer")).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    names = F.explode(F.array(*[F.lit(name) for name in folders])).alias("layer")
    return (
        spark.range(1)
        .select(names)
        .join(found, "layer", "left")
        .fillna(0, ["files", "bytes"])
        .orderBy("layer")
    )


def layer_rows(spark: SparkSession, base: str, layers: list[str] | dict[str, str] = LAYERS) -> DataFrame:
    """(layer, rows) of the Parquet and CSV files of every layer below `base`, 0 where there is none.

    Parquet rows are counted from the files' footers, CSV rows (of compressed files, too) while parsing no column.
    """
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base.rstrip("/"))
    system = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    folders = layer_paths(base, layers)
    every = spark.createDataFrame([(name, 0) for name in folders], "layer string, rows bigint")
    for name, folder in folders.items():
        if not system.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)):
            continue
        for kind, options in {"parquet": {}, "csv": {"header": True, "multiLine": True, "escape": '"'}}.items():
            read = spark.read.options(recursiveFileLookup=True, pathGlobFilter=f"*.{kind}*", **options).schema("_row string")
            every = every.unionByName(read.format(kind).load(folder).select(F.lit(name).alias("layer"), F.lit(1).cast("bigint").alias("rows")))
    return every.groupBy("layer").agg(F.sum("rows").alias("rows")).orderBy("layer")


def _scratch_root(spark: SparkSession) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.gettempdir()
    return f"{shared.rstrip('/')}/saleslens/{spark.sparkContext.applicationId}"


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder every executor can reach, below the checkpoint folder of the session."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def kept(frame: DataFrame, name: str) -> DataFrame:
    """`frame` written to a fresh shared folder and read back."""
    path = scratch_folder(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete the scratch folders of this application, once its results are no longer read."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)
