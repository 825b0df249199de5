"""Consecutive row numbers without a single-partition sort."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelflow.storage import materialise


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores in front while ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def quoted(names: list[str]) -> list[Column]:
    """Columns by their exact names, dots included."""
    return [F.col(f"`{n.replace('`', '``')}`") for n in names]


def _ranged(df: DataFrame, order: list[str | Column]) -> tuple[DataFrame, str, str]:
    """``df`` sorted in range partitions and stored, and the names of two columns
    more: the partition, and the row's number in it."""
    part, row = free_name(df, "_part"), free_name(df, "_row")
    local = F.monotonically_increasing_id()
    ranged = (
        df.repartitionByRange(*[F.col(o) if isinstance(o, str) else o for o in order])
        .sortWithinPartitions(*order)
        .withColumn(part, F.shiftright(local, 33))
        .withColumn(row, local.bitwiseAND(F.lit((1 << 33) - 1)))
    )
    return materialise(ranged), part, row


def _starts(df: DataFrame, part: str, amount: Column, start: str) -> DataFrame:
    """(part, start): what the partitions before hold. One row for each range
    partition reaches the driver, so their number bounds the table."""
    sums = sorted(tuple(r) for r in df.groupBy(part).agg(amount).collect())
    starts = accumulate((n for _, n in sums), initial=0)
    return F.broadcast(
        df.sparkSession.createDataFrame(
            [(p, s) for (p, _), s in zip(sums, starts)], f"{part} long, {start} long"
        )
    )


def with_positions(
    df: DataFrame, order: list[str | Column], name: str = "pos"
) -> DataFrame:
    """Add 0..n-1 in the given order.

    Rows are range-partitioned and sorted inside their partitions; only one
    count per partition reaches the driver. ``order`` must be unique, which also
    lets a range boundary fall inside a hot key. The sorted rows are written
    once, so the counts and the numbering see the same partitions. Columns of
    ``df`` may have any names but ``name``.
    """
    ranged, part, row = _ranged(df, order)
    start = free_name(ranged, "_start")
    return ranged.join(_starts(ranged, part, F.count("*"), start), part).select(
        (F.col(start) + F.col(row)).alias(name), *quoted(df.columns)
    )


def running_total(df: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """Add the sum of ``value`` over all rows before, in the given (unique) order.

    Sums within range partitions, and one total per partition, as above.
    """
    ranged, part, row = _ranged(df, order)
    before = Window.partitionBy(part).orderBy(row).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn(name, F.coalesce(F.sum(value).over(before), F.lit(0)))
    start = free_name(local, "_start")
    starts = _starts(ranged, part, F.sum(value), start)
    return local.join(starts, part).select(
        *quoted(df.columns), (F.col(start) + F.col(name)).alias(name)
    )


#: Columns that tell where a row stood in the files it was read from.
PLACE = ("_file", "_block", "_scan")


def with_place(df: DataFrame) -> DataFrame:
    """Add PLACE to a table just read from files."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias(PLACE[0]),
        F.col("_metadata.file_block_start").alias(PLACE[1]),
        F.monotonically_increasing_id().alias(PLACE[2]),
    )


def numbered_files(df: DataFrame, name: str = "pos") -> DataFrame:
    """Add 0..n-1 by file name and place in the file, as the last column.

    For a table just read from files, not yet filtered. A file block is read by
    one task from start to end, so its rows need only its first number: one pass
    counts the rows of each block, reading no other column, and the blocks, a
    table of their own, are summed up in file order. Rows are not shuffled
    unless there are too many blocks for the planner to broadcast.
    """
    file, block, scan, low, count, start = (
        free_name(df, n) for n in (*PLACE, "_low", "_count", "_start")
    )
    placed = df.select(
        "*",
        F.col("_metadata.file_path").alias(file),
        F.col("_metadata.file_block_start").alias(block),
        F.monotonically_increasing_id().alias(scan),
    )
    blocks = placed.groupBy(file, block).agg(
        F.count("*").alias(count), F.min(scan).alias(low)
    )
    started = materialise(running_total(blocks, [file, block], count, start))
    return placed.join(started, [file, block]).select(
        *quoted(df.columns), (F.col(scan) - F.col(low) + F.col(start)).alias(name)
    )
