"""Rules over batch jobs and run ledgers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The states of a remote batch job.
RUNNING = ["validating", "in_progress", "finalizing", "cancelling"]
DONE = ["completed"]
FAILED = ["failed", "cancelled", "expired"]
ESTIMATED = ["in_progress", "finalizing", "validating"]

HOUR = 3600


def status_class(status: Column) -> Column:
    """running / completed / failed; anything else is null."""
    return (
        F.when(status.isin(RUNNING), "running")
        .when(status.isin(DONE), "completed")
        .when(status.isin(FAILED), "failed")
    )


def poll_seconds(age_minutes: Column) -> Column:
    return (
        F.when(age_minutes < 5, 30)
        .when(age_minutes < 15, 60)
        .when(age_minutes < 60, 300)
        .otherwise(600)
    )


def completion_estimate(status: Column, elapsed_seconds: Column) -> Column:
    in_progress = (
        F.when(elapsed_seconds < HOUR, "2-20 hours")
        .when(elapsed_seconds < 12 * HOUR, "2-12 hours")
        .otherwise("1-6 hours")
    )
    return (
        F.when(status == "validating", "2-5 minutes")
        .when(status == "in_progress", in_progress)
        .when(status == "finalizing", "1-10 minutes")
    )


def session_status(emergency: Column, completed: Column) -> Column:
    return (
        F.when(F.coalesce(emergency, F.lit(False)), "crashed")
        .when(F.coalesce(completed, F.lit(False)), "completed")
        .otherwise("in progress")
    )
