"""Items to request files: prompts, requests, chunks, files, rejects and a ledger."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelflow.operators.chunking import (
    BYTES_PER_CHUNK,
    ROWS_PER_CHUNK,
    chunk_by_bytes,
    chunk_by_count,
    chunk_summary,
)
from labelflow.plans.label import Step
from labelflow.sources.sinks import append_ledger, write_json, write_requests
from labelflow.storage import materialise


@dataclass(frozen=True)
class Exported:
    """What an export left: the assignment of requests to files (stored), a
    row per file, and the requests that exceed the limit by themselves."""

    assigned: DataFrame
    summary: DataFrame
    rejected: DataFrame


def assign_files(
    items: DataFrame, render: Step, order: list[str | Column],
    rows: int = ROWS_PER_CHUNK, limit: int = BYTES_PER_CHUNK,
) -> DataFrame:
    """``items`` with pos, chunk, nbytes and first_pos (null: over the limit).

    ``render`` adds a request's ``line`` to rows with the columns of ``items``. Sizes come with
    the positions; the lines, which repeat the vocabulary, are not stored or
    moved. The items' own texts move twice: by range, and to their file.
    """
    sized = render(items).withColumn("nbytes", F.octet_length("line").cast("long")).drop("line")
    placed = chunk_by_count(sized, order, rows)
    files = chunk_by_bytes(placed, limit).select("pos", "first_pos")
    return placed.join(files, "pos")


def export_requests(
    items: DataFrame, render: Step, order: list[str | Column], path: str,
    rows: int = ROWS_PER_CHUNK, limit: int = BYTES_PER_CHUNK,
) -> Exported:
    """Write ``path``/requests (a folder per file), ``path``/rejected (JSON
    lines of id and nbytes) and a ledger row per file in ``path``/ledger.

    ``items`` needs ``id``. Every item is in one file or among the rejects.
    """
    assigned = materialise(assign_files(items, render, order, rows, limit))
    write_requests(assigned, render, f"{path}/requests")
    rejected = assigned.where(F.col("first_pos").isNull()).select(
        F.col("id").alias("custom_id"), "nbytes"
    )
    write_json(rejected, f"{path}/rejected")
    summary = materialise(chunk_summary(assigned))
    batch = F.col("first_pos").cast("string")
    append_ledger(
        summary.where(F.col("first_pos").isNotNull()).select(
            F.concat(F.lit("batch_"), batch).alias("batch_id"),
            F.concat(F.lit("first_pos="), batch).alias("batch_file"),
            F.lit(None).cast("string").alias("input_file_id"),
        ),
        f"{path}/ledger",
    )
    return Exported(assigned, summary, rejected)
