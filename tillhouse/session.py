"""Session settings, shuffle sizing and the shared working folder."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Runtime settings every job relies on. They can be set on a running session.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # '05' must stay text when it comes from a path like month=05.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even when that costs one more shuffle after it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A task that sums rows up before they are shuffled holds most of what it reads: its share bounds its memory.
    "spark.sql.files.maxPartitionBytes": "32m",
    # Folders of many days are listed by tasks, but not by one task each.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
}

# On one machine small partitions keep its cores busy; on a cluster they would be thousands of tiny tasks.
LOCAL_SETTINGS = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "4k"}

# Only used when a storage path is s3a://.
OBJECT_STORE_SETTINGS = {
    "spark.hadoop.fs.s3a.multipart.size": "104857600",
    "spark.hadoop.fs.s3a.threads.max": "20",
    "spark.hadoop.fs.s3a.committer.name": "magic",
}

SHUFFLE_BYTES = 256 * 1024 * 1024


def get_spark(app: str = "tillhouse", master: str | None = None, paths: tuple[str, ...] = ()) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(SETTINGS)
    if any(path.startswith("s3a://") for path in paths):
        settings.update(OBJECT_STORE_SETTINGS)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    local = spark.sparkContext.master.startswith("local")
    for key, value in {**SETTINGS, **(LOCAL_SETTINGS if local else {})}.items():
        spark.conf.set(key, value)
    return spark


def shuffle_partitions(input_bytes: int, configured: int) -> int:
    """Partitions to start a shuffle with; adaptive execution merges small ones afterwards."""
    wanted = math.ceil(input_bytes / SHUFFLE_BYTES)
    return max(configured, wanted)


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Set the initial shuffle width for a job that reads that much."""
    width = shuffle_partitions(input_bytes, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(width))
    return width


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as that file system's object."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def stored_bytes(spark: SparkSession, path: str) -> int:
    fs, hadoop_path = file_system(spark, path)
    return fs.getContentSummary(hadoop_path).getLength() if fs.exists(hadoop_path) else 0


def run_together(spark: SparkSession, jobs: Iterable[Callable[[], Any]], at_once: int = 4) -> list[Any]:
    """Start jobs that do not depend on each other side by side, so small ones do not leave the
    cluster idle. All of them finish; the first failure is then raised."""
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    return [job.result() for job in started]


_local_root: str | None = None


def work_root(spark: SparkSession) -> str:
    """The shared folder named in spark.checkpoint.dir; a temporary one only on local masters."""
    global _local_root
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder all executors share")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="tillhouse-")
    return _local_root


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A folder of its own for one run, under the shared working folder."""
    return f"{work_root(spark)}/{name}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Remove a working folder once nothing reads it any more."""
    fs, folder = file_system(spark, path)
    fs.delete(folder, True)
