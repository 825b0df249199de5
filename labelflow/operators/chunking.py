"""Cut requests into files limited by rows and by bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelflow.operators.positions import with_positions

ROWS_PER_CHUNK = 50_000
BYTES_PER_CHUNK = 200 * 1024 * 1024


def chunk_by_count(
    requests: DataFrame, order: list[str | Column], rows: int = ROWS_PER_CHUNK
) -> DataFrame:
    """Add ``pos`` and ``chunk``: consecutive groups of ``rows`` requests."""
    return with_positions(requests, order).withColumn(
        "chunk", F.floor(F.col("pos") / rows)
    )


def _halves(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges that fit, found by halving; a single row may not fit.

    Rows of one file are joined by one newline byte each.
    """
    total = np.concatenate([[0], np.cumsum(sizes)])
    todo = [(0, len(sizes))]
    while todo:
        low, high = todo.pop()
        if total[high] - total[low] + (high - low - 1) <= limit:
            yield low, high
        elif high - low > 1:
            middle = low + (high - low) // 2
            todo += [(middle, high), (low, middle)]


def chunk_by_bytes(chunked: DataFrame, limit: int = BYTES_PER_CHUNK) -> DataFrame:
    """``chunked`` with the first position of each row's file, first_pos.

    ``chunked`` needs (chunk, pos, nbytes); all its columns are grouped, so
    select few. A group is one chunk, at most ``ROWS_PER_CHUNK`` rows by
    construction. A request that exceeds the limit by itself gets no file (null).
    """
    schema = T.StructType([*chunked.schema.fields, T.StructField("first_pos", T.LongType())])

    def assign(chunk: pd.DataFrame) -> pd.DataFrame:
        chunk = chunk.sort_values("pos", ignore_index=True)
        first = np.full(len(chunk), -1, dtype="int64")
        positions = chunk["pos"].to_numpy()
        for low, high in _halves(chunk["nbytes"].to_numpy(), limit):
            first[low:high] = positions[low]
        return chunk.assign(first_pos=first)

    assigned = chunked.groupBy("chunk").applyInPandas(assign, schema)
    return assigned.withColumn(
        "first_pos", F.when(F.col("first_pos") >= 0, F.col("first_pos"))
    )


def chunk_summary(assigned: DataFrame) -> DataFrame:
    """Rows and bytes of each file, and the number of row chunks in the run.

    ``assigned`` needs (chunk, first_pos, nbytes). Requests without a file are
    counted in a row of their own, with a null ``first_pos``.
    """
    chunks = assigned.agg((F.max("chunk") + 1).alias("n")).scalar()
    return (
        assigned.groupBy("first_pos")
        .agg(
            F.count("*").alias("chunk_size"),
            (F.sum("nbytes") + F.count("*") - 1).alias("n_bytes"),
        )
        .withColumn("total_chunks", chunks)
    )
