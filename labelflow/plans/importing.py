"""Batch output files to labelled results: read, keep, normalize, write, count."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelflow.operators.matching import Vocabulary
from labelflow.operators.monitoring import request_counts
from labelflow.plans.normalize import cut_labels, resolve_labels
from labelflow.sources.batches import RESULT_COLUMNS, classify, read_batch_files
from labelflow.sources.sinks import write_json
from labelflow.storage import materialise, spread


@dataclass(frozen=True)
class Imported:
    """The labelled results, and total, completed and failed lines per batch."""

    results: DataFrame
    counts: DataFrame


def import_batches(
    spark, source: str, path: str, vocabulary: Vocabulary, default_model: str, **options
) -> Imported:
    """Read the output files below ``source`` (a folder per batch) and write
    ``path``/results and ``path``/counts as JSON lines, the results in gzip files.

    The lines are parsed once and stored once, results with their labels and
    others with their outcome only: the normalizer looks at labels twice, and the
    counts take two columns. Answers are not stored again. ``options`` go to the
    normalizer.
    """
    lines = classify(read_batch_files(spark, source), default_model)
    parts = {c: F.when(F.col("outcome") == "ok", F.col(c)) for c in RESULT_COLUMNS}
    parsed = spread(lines.withColumns(parts | {"batch_id": F.col("batch_id")}))
    protect = options.pop("protect_comma_labels", False)
    stored = materialise(cut_labels(parsed, vocabulary, protect).drop("raw_response"))
    good = stored.where(F.col("outcome") == "ok")
    keep = [c for c in RESULT_COLUMNS if c != "raw_response"]
    labelled = resolve_labels(good, vocabulary, keep, **options)
    write_json(labelled, f"{path}/results", compression="gzip")
    write_json(request_counts(stored.select("batch_id", "outcome")), f"{path}/counts")
    return Imported(
        spark.read.schema(labelled.schema).json(f"{path}/results"),
        spark.read.schema("batch_id string, total long, completed long, failed long").json(
            f"{path}/counts"
        ),
    )


def completion(counts: DataFrame) -> DataFrame:
    """One row over all batches: lines, results, and the share that succeeded."""
    return counts.agg(
        F.sum("total").alias("total"),
        F.sum("completed").alias("completed"),
        (F.sum("completed") / F.sum("total")).alias("share"),
    )
