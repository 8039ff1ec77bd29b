"""Session settings, and the shared folder that holds intermediate tables."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

# Runtime options the jobs rely on. They can all be changed on a live session.
RUNTIME_OPTIONS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Folders made for local sessions; they go away with the process.
_LOCAL_FOLDERS: list[tempfile.TemporaryDirectory] = []


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime options."""
    for key, value in RUNTIME_OPTIONS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("quayside")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder for checkpoints: the one the cluster names, else (local master only) a temporary one."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if current is None and named:
        context.setCheckpointDir(named)
        current = named
    if current is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.TemporaryDirectory(prefix="quayside-", ignore_cleanup_errors=True)
        _LOCAL_FOLDERS.append(folder)
        context.setCheckpointDir(folder.name)
        current = context.getCheckpointDir()
    return current


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write a frame that several later jobs read to the shared folder, and read it back.

    A lost executor then never replays the inputs. Being a parquet table, a later pass reads only the columns
    it needs, and the optimizer knows the size when it picks a join.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/stored-{uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*stored: DataFrame) -> None:
    """Delete frames that ``cut_lineage`` returned and no later job reads, so that a long job needs less disk."""
    for df in stored:
        spark = df.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(df.inputFiles()[0]).getParent()
        if not folder.getName().startswith("stored-"):
            raise ValueError(f"not a stored frame: {folder}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def by_key(df: DataFrame, *keys: str) -> DataFrame:
    """Gather groups for Python work. The stated partition number keeps adaptive execution from merging the
    (small, but slow to process) partitions; grouping by the same keys afterwards needs no further exchange."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
