"""Write results, requests, metrics and ledgers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelflow.storage import open_files, text_batches

#: Batches that a task writes at once; those beyond are sorted.
BATCH_FILES = 64


def write_json(
    df: DataFrame, path: str, mode: str = "append", compression: str | None = None
) -> None:
    """JSON lines; appending adds files and never rewrites old rows."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path, compression=compression)


def write_json_arrays(df: DataFrame, path: str, order: list[str | Column]) -> None:
    """A folder of JSON arrays in the given order, each file one valid array.

    One file for each range partition: its first row opens the array, its last
    one closes it. Readers that take one array per file read the folder whole.
    """

    def bracketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, opening = None, "["
        for batch in batches:
            lines = []
            for value in batch.column(0).to_pylist():
                if last is not None:
                    lines.append(opening + last)
                    opening = ","
                last = value
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([f"{opening}{last}]"])], names=["value"])

    lines = (
        df.repartitionByRange(*[F.col(o) if isinstance(o, str) else o for o in order])
        .sortWithinPartitions(*order)
        .select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
    )
    text_batches(lines).mapInArrow(bracketed, "value string").write.text(path)


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    """CSV with a header; arrays, maps and structs become JSON text."""
    nested = ("array", "map", "struct")
    flat = df.select(
        *[
            F.to_json(c).alias(c) if t.startswith(nested) else F.col(c)
            for c, t in df.dtypes
        ]
    )
    (
        flat.write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_requests(
    rows: DataFrame, render: Callable[[DataFrame], DataFrame], path: str
) -> None:
    """One folder with one file of request lines per ``first_pos``.

    A file is limited in rows and bytes, so one task can write it. ``rows``
    carry the columns that ``render`` needs, such as an item's title and text;
    it adds ``line``, which also holds the template, after the shuffle. Rows
    without a file are left out: ``plans.export`` writes them as rejects.
    """
    (
        rows.where(F.col("first_pos").isNotNull())
        .repartition("first_pos")
        .sortWithinPartitions("first_pos", "pos")
        .transform(render)
        .select("first_pos", F.col("line").alias("value"))
        .write.partitionBy("first_pos")
        .text(path)
    )


def write_batches(lines: DataFrame, path: str) -> None:
    """Model output lines in one folder per batch, in gzip files.

    A task writes a few batches at once: sorted by batch first, as Spark does by
    default, its lines may go to disk another time.
    """
    with open_files(lines.sparkSession, BATCH_FILES):
        lines.select("batch_id", F.col("line").alias("value")).write.partitionBy(
            "batch_id"
        ).text(path, compression="gzip")


def append_ledger(rows: DataFrame, path: str) -> None:
    rows.select("batch_id", "batch_file", "input_file_id").write.mode("append").json(path)
