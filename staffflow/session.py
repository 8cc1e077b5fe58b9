"""Session settings, the shared work folder and lineage cuts."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# AQE splits skewed join partitions and coalesces small ones; the sizes below
# keep one task's input near 128 MB whatever the table size.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


def cluster_conf(input_bytes: int) -> dict[str, str]:
    """Settings for a cluster that reads so many bytes: SCALE_CONF, and shuffles of about 128 MB a task.

    AQE only merges partitions, so their first number has to follow the input.
    """
    first = max(200, -(-input_bytes // (128 << 20)))
    return SCALE_CONF | {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(first)}


def local_session(cores: int | str = 8, app: str = "staffflow") -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", os.environ.get("STAFFFLOW_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for key, value in SCALE_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster names it in spark.checkpoint.dir.

    Only a local master may fall back to a folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="staffflow-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the table to the shared folder and go on from there.

    Survives the loss of any executor and, unlike a row checkpoint, later steps
    read only the columns they need and know the table's size.
    """
    return written(df)[0]


def written(df: DataFrame) -> tuple[DataFrame, str]:
    """``cut_lineage`` with the place of the table, for tables that go again with ``remove``."""
    path = new_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Folders directly below ``path``, in ascending order; none where it does not exist."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        return []
    return sorted(str(x.getPath()) for x in files.listStatus(place) if x.isDirectory())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table that ``written`` made and nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
