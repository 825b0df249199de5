"""The run ledger: a state row of a session after each step, as JSON lines."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SESSION_SCHEMA = (
    "session_id string, timestamp timestamp_ntz, processed_count long, total_results long,"
    " pending_items_count long, total_items long, started_at timestamp_ntz,"
    " interval long, enabled boolean, additional_state struct<last_error: string, emergency_save: boolean,"
    " completed: boolean>"
)


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _reason(error: BaseException) -> str:
    """What went wrong: of an error in a task's or a batch's Python code, which
    comes with the whole traceback, the line that names it."""
    named = re.findall(r"^(?:\w+\.)*\w+(?:Error|Exception): .+$", str(error), re.MULTILINE)
    return named[-1] if named else (str(error).splitlines() or [type(error).__name__])[0]


@dataclass
class Session:
    """One run. As a context manager it records how the run ended: completed,
    or an emergency row with the error, which is raised on.

    ``interval`` is what a micro-batch takes (files, or rows of the user's own
    stream) and stands in the ledger. With ``enabled`` false nothing is written.
    """

    spark: SparkSession
    path: str
    session_id: str
    total_items: int | None = None
    started_at: datetime | None = None
    interval: int | None = None
    enabled: bool = True
    processed: int = 0
    results: int = 0

    def __enter__(self) -> Session:
        self.started_at = self.started_at or _now()
        return self

    def __exit__(self, kind, error, trace) -> None:
        if error is None:
            self._append(completed=True)
        else:
            self._append(last_error=_reason(error), emergency_save=True)

    def progress(self, processed: int, results: int) -> None:
        self.processed += processed
        self.results += results
        self._append()

    def _append(self, last_error=None, emergency_save=None, completed=None) -> None:
        if not self.enabled:
            return
        pending = None if self.total_items is None else self.total_items - self.processed
        row = (
            self.session_id, _now(), self.processed, self.results, pending, self.total_items,
            self.started_at or _now(), self.interval, self.enabled, (last_error, emergency_save, completed),
        )
        rows = self.spark.createDataFrame([row], SESSION_SCHEMA)
        rows.coalesce(1).write.mode("append").option("ignoreNullFields", False).json(self.path)


def read_sessions(spark: SparkSession, path: str) -> DataFrame:
    """The newest state of each session in a ledger."""
    rows = spark.read.schema(SESSION_SCHEMA).json(path)
    columns = [c for c in rows.columns if c != "session_id"]
    last = F.max_by(F.struct(*columns), F.struct("timestamp", "processed_count"))
    return rows.groupBy("session_id").agg(last.alias("s")).select("session_id", "s.*")
