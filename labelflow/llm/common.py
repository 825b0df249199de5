"""Helpers that several of the training-data operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelflow.storage import materialise, text_batches  # noqa: F401

#: A word, for Java's and DuckDB's regular expressions alike.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of ids and numbers in one file, for tables that shrink from round to round.
ROWS_PER_FILE = 10_000


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores in front while ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def store_rows(df: DataFrame, rows: int) -> DataFrame:
    """``materialise`` a table of at most ``rows`` narrow rows in as few files as
    that takes, however many partitions it was shuffled into: a round over a
    small table should not write and read hundreds of files."""
    return materialise(df.coalesce(max(1, -(-rows // ROWS_PER_FILE))))


def by_bytes(
    batches: Iterator[pa.RecordBatch], column: str, limit: int
) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` has at most ``limit`` bytes in each.

    A longer single value comes alone. Keeps a task's memory in proportion to
    ``limit`` or its longest text, however many rows Spark puts into a batch.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.schema.get_field_index(column)
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(at)), 0)
        start, held = 0, 0
        for i, size in enumerate(sizes.to_pylist()):
            if i > start and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        yield batch.slice(start)
