"""Session helpers: runtime settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Runtime-settable choices every job relies on. Shuffle width is left to the
# cluster: AQE coalesces small partitions and splits skewed join partitions.
# A columnar file is several times smaller than its rows in memory, so file
# sizes are scaled before they are held against the broadcast threshold; and
# a shuffled join whose partitions turn out small skips its sorts. Shuffle files
# go when the action that wrote them ends: else they lie on the disks until the driver
# happens to collect its garbage, and a run of many tables holds all tables' files at once.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.fileCompressionFactor": "3.0",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "32MB",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(name: str = "weirstone", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, for tables written between stages.

    It is the one the cluster names in ``spark.checkpoint.dir``. Only a local
    session, whose executors live on this machine, may fall back to ``/tmp``.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the whole cluster")
    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def side_by_side(
    spark: SparkSession, job: Callable[[Any], Any], items: Iterable[Any], parallel: int = 4
) -> list[Any]:
    """Submit independent jobs from a few driver threads; results in the order of the items."""
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        # wrapped once per item: each job gets its own copy of the local properties
        running = [pool.submit(inheritable_thread_target(spark)(job), item) for item in items]
        return [one.result() for one in running]
