"""Reports over the batch ledger and the run ledger.

Ledger rows are (batch_id, status, created_at). Clocks are parameters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelflow.functions import status as S
from labelflow.operators.costs import seconds_between
from labelflow.sources.sinks import write_json
from labelflow.storage import materialise


def with_elapsed(ledger: DataFrame, as_of: Column) -> DataFrame:
    return ledger.withColumn(
        "elapsed_seconds", seconds_between(F.col("created_at"), as_of)
    )


def batch_status(ledger: DataFrame, as_of: Column) -> DataFrame:
    """Status details; an estimate only while a job is in a running state."""
    elapsed = F.col("elapsed_seconds")
    estimate = F.when(
        F.col("status").isin(S.ESTIMATED),
        S.completion_estimate(F.col("status"), elapsed),
    )
    return with_elapsed(ledger, as_of).withColumn("estimated_completion", estimate)


def status_counts(ledger: DataFrame) -> DataFrame:
    return (
        ledger.groupBy(S.status_class(F.col("status")).alias("status_class"))
        .agg(F.count("*").alias("n_batches"))
    )


def request_counts(classified: DataFrame) -> DataFrame:
    """Total, completed and failed requests of each batch."""
    ok = F.col("outcome") == "ok"
    return classified.groupBy("batch_id").agg(
        F.count("*").alias("total"),
        F.count_if(ok).alias("completed"),
        F.count_if(~ok).alias("failed"),
    )


def _monitor_class() -> Column:
    """A completed batch without results counts as failed."""
    state = S.status_class(F.col("status"))
    empty = (state == "completed") & (F.col("n_results") == 0)
    return F.when(empty, "failed").otherwise(state)


def monitor_summary(ledger: DataFrame, as_of: Column) -> DataFrame:
    """One row of counts and the time since the first batch was created."""
    state = _monitor_class()
    return ledger.agg(
        F.count_if(state == "completed").alias("completed"),
        F.count_if(state == "failed").alias("failed"),
        F.count_if(state == "running").alias("remaining"),
        seconds_between(F.min("created_at"), as_of).alias("total_seconds"),
    )


def failed_batches(ledger: DataFrame) -> DataFrame:
    """Ids of failed batches, one row each."""
    return ledger.where(_monitor_class() == "failed").select("batch_id", "status")


def status_lines(ledger: DataFrame, as_of: Column) -> DataFrame:
    """Progress log lines."""
    rows = batch_status(ledger, as_of)
    line = F.format_string(
        "[%s] Batch %s: %s (elapsed: %d s, ETA: %s)",
        F.date_format(as_of, "yyyy-MM-dd HH:mm:ss"),
        F.col("batch_id"),
        F.col("status"),
        F.col("elapsed_seconds").cast("long"),
        F.coalesce("estimated_completion", F.lit("Unknown")),
    )
    return rows.select("batch_id", line.alias("line"))


def append_status(ledger: DataFrame, as_of: Column, path: str) -> None:
    """Add the progress lines of this moment to a status history (JSON lines)."""
    write_json(status_lines(ledger, as_of).withColumn("at", as_of.cast("string")), path)


def validate_ids(requested: DataFrame, ledger: DataFrame) -> DataFrame:
    """Requested ids with ``valid``: does the ledger know them."""
    known = materialise(
        ledger.select("batch_id").distinct().select("batch_id", F.lit(True).alias("_known"))
    )
    return requested.join(known, "batch_id", "left").select(
        "batch_id", F.coalesce("_known", F.lit(False)).alias("valid")
    )


def session_report(sessions: DataFrame) -> DataFrame:
    """Sessions of a run ledger, ordered by id: status, counts, when the last row
    was written, the error of a crashed run, how long the run took up to then (seconds
    and as h:mm:ss), and its checkpoint settings."""
    state = F.col("additional_state")
    elapsed = seconds_between(F.col("started_at"), F.col("timestamp"))
    whole = F.floor(elapsed).cast("long")
    hours = F.floor(whole / 3600).cast("long")
    text = F.format_string("%d:%02d:%02d", hours, F.floor(whole % 3600 / 60).cast("long"), whole % 60)
    return sessions.select(
        "session_id",
        "processed_count",
        "total_results",
        "pending_items_count",
        S.session_status(state["emergency_save"], state["completed"]).alias("status"),
        F.col("timestamp").alias("updated_at"),
        state["last_error"].alias("last_error"),
        elapsed.alias("elapsed_seconds"),
        F.when(elapsed.isNotNull(), text).alias("elapsed_text"),
        "interval",
        "enabled",
    ).orderBy("session_id")


def progress(sessions: DataFrame, as_of: Column) -> DataFrame:
    """Percent done and remaining time, where a total and progress are known.

    Needs (session_id, processed_count, total_items, started_at).
    """
    elapsed = seconds_between(F.col("started_at"), as_of)
    ratio = F.when(
        (F.col("processed_count") > 0) & (F.col("total_items") > 0),
        F.col("processed_count") / F.col("total_items"),
    )
    remaining = elapsed / ratio - elapsed
    return sessions.select(
        "session_id",
        "processed_count",
        elapsed.alias("elapsed_seconds"),
        (ratio * 100).alias("progress_percent"),
        remaining.alias("remaining_seconds"),
        F.timestamp_add("SECOND", remaining.cast("long"), as_of).alias("finish_at"),
    )
