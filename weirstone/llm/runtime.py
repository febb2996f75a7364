"""What every operator needs of a session: the package on the executors, and folders for tables between steps."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from weirstone.session import shared_folder

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, and have batches of texts kept small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")  # whole texts; a longer one is a batch of its own
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    handle, name = tempfile.mkstemp(prefix=f"{package.name}-", suffix=".zip")
    with os.fdopen(handle, "wb") as out, zipfile.ZipFile(out, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    context.addPyFile(name)
    _shipped.add(context.applicationId)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder that all executors share."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """The rows written to the shared folder and read again: short lineage, and nothing is computed twice."""
    folder = folder or scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def width(spark: SparkSession) -> int:
    """Tasks that a shuffle is dealt to."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


TASK_BYTES = 64 << 20


def tasks_for(size: int, spark: SparkSession) -> int:
    """Tasks for reading ``size`` bytes that rows of a few numbers point to: a shuffle of such rows is dealt to this
    number, as by its own bytes it would be merged into very few."""
    return max(width(spark), -(-size // TASK_BYTES))


def remove(spark: SparkSession, folder: str) -> None:
    """Take back a folder made by ``scratch``."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def if_small(df: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """A side of few, narrow columns: broadcast when it is counted to have at most ``rows`` rows, else left to a shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
