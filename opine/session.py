"""Session set-up, shared folders and size checks."""

from __future__ import annotations

import atexit
import math
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# A table no bigger than one default input split may sit in a single row group,
# so only such a table is ever spread by hand.
SPREAD_LIMIT_BYTES = 128 * 1024 * 1024
SPREAD_PARTITION_BYTES = 64 * 1024

_local_root: str | None = None


def local_session(
    cores: str | int = "*", shuffle_partitions: int = 8, memory: str = "8g", checkpoint_dir: str | None = None
) -> SparkSession:
    """A single-machine session for tests and the benchmark; `checkpoint_dir` holds what is staged."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("opine")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    return (builder.config("spark.checkpoint.dir", checkpoint_dir) if checkpoint_dir else builder).getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir`.

    Only a local master, where one machine is the whole cluster, may fall back to
    a temporary folder; that one is removed when Python ends.
    """
    global _local_root
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="opine-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return _local_root


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path nobody used before, under the shared folder. Spark creates it on write."""
    return f"{shared_root(spark)}/{spark.sparkContext.applicationId}/{purpose}-{uuid.uuid4().hex}"


def remove_staged(spark: SparkSession) -> None:
    """Delete what this application staged, and nothing else. Tables read from it are gone afterwards."""
    own = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_root(spark)}/{spark.sparkContext.applicationId}")
    own.getFileSystem(spark._jsc.hadoopConfiguration()).delete(own, True)


def path_bytes(spark: SparkSession, path: str) -> int:
    """Bytes under a path, asked from the file system: no rows are read."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return file_system.getContentSummary(hadoop_path).getLength()


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def spread(df: DataFrame, size_bytes: int) -> DataFrame:
    """Give a small table's rows to all cores before costly expressions run on them.

    This changes the plan only, never a result. Larger tables are left alone: their input splits already fill the cluster, and
    moving their text would be a shuffle for nothing. Where that does not hold, `shared_out` deals them.
    """
    if size_bytes > SPREAD_LIMIT_BYTES:
        return df
    parts = min(df.sparkSession.sparkContext.defaultParallelism, math.ceil(size_bytes / SPREAD_PARTITION_BYTES))
    return df.repartition(parts) if parts > 1 else df


def shared_out(df: DataFrame, size_bytes: int, *keys: str) -> DataFrame:
    """Give a larger table's rows to all cores too, for work that costs much more than a shuffle of the rows.

    A row group is read by one task, whatever its size: splits of a file with few row groups are mostly empty. Tables that
    `spread` takes are left to it. This changes the plan only, never a result.
    """
    return df.repartition(*keys) if size_bytes > SPREAD_LIMIT_BYTES else df


def dealt(df: DataFrame, key: str, partitions: int) -> DataFrame:
    """Rows dealt by a key into a fixed number of sorted partitions.

    For fits whose random starts depend on partitions: files, sizes and cores then change nothing.
    """
    return df.repartition(partitions, key).sortWithinPartitions(key)


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write a result once to the shared folder and read it back.

    For results that several passes need: later passes read columns instead of
    cleaning the text again, and a lost executor costs no recomputation.
    """
    return stage_at(df, new_folder(df.sparkSession, purpose))


def stage_at(df: DataFrame, folder: str) -> DataFrame:
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its scheme and authority, as the cluster's default file system completes it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    uri = file_system.makeQualified(hadoop_path).toUri()
    return f"{uri.getScheme()}://{uri.getAuthority() or ''}{uri.getPath()}"
