"""Shared scratch tables and bounded looks at small tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession

#: Bytes of an Arrow batch between Spark and Python.
BATCH_BYTES = "4m"


def scratch_dir(spark: SparkSession) -> str:
    """A new folder below the shared checkpoint folder the cluster names.

    Only a session whose tasks run in the driver's own process may go without
    that setting; it then gets a folder for all its scratch tables.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        root = tempfile.mkdtemp(prefix="labelflow-")
        spark.conf.set("spark.checkpoint.dir", root)
    path = f"{root.rstrip('/')}/labelflow-{uuid.uuid4().hex}"
    for made in _watching:
        made.append(path)
    return path


_watching: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end, every scratch table that was made inside.

    Results that are read from them must be written or collected before.
    """
    made: list[str] = []
    _watching.append(made)
    try:
        yield
    finally:
        _watching.remove(made)
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        for path in made:
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(hadoop).delete(folder, True)


def materialise(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read back.

    Cuts the lineage, survives the loss of any executor, and gives the planner
    the true size of the table.
    """
    path = scratch_dir(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def open_files(spark: SparkSession, n: int) -> Iterator[None]:
    """Tasks that write partitioned folders inside keep up to ``n`` files open
    instead of sorting their rows; those of further folders are sorted."""
    before = spark.conf.get(_WRITERS)
    spark.conf.set(_WRITERS, n)
    try:
        yield
    finally:
        spark.conf.set(_WRITERS, before)


def text_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session from now on sends Arrow batches of few megabytes.

    By default a batch may have 64 MB, which a task holds several times over:
    in Arrow's own memory, on its way, and in Python.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df


def rows_if_at_most(df: DataFrame, limit: int) -> list[Row] | None:
    """All rows if there are at most ``limit``, else None (never a part)."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def spread(df: DataFrame) -> DataFrame:
    """Spread a table that sits in fewer partitions than there are cores.

    Only for a plain scan that feeds CPU-heavy expressions: counting the
    partitions of a table behind a shuffle would run that shuffle. A large table
    already has more partitions than cores and is left alone, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
