"""Batch reports over an orders-derived ledger, session reports over real runs."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelflow.bindings import derived as d
from labelflow.functions import status as S
from labelflow.operators import monitoring as M
from labelflow.storage import scratch_dir
from labelflow.streaming import incremental, ledger


def _as_of():
    return F.expr(f"timestamp_ntz'{d.AS_OF}'")


def _text(name: str):
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


def poll_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = M.with_elapsed(d.ledger(spark, sf_dir), _as_of())
    return rows.select(
        "batch_id", S.poll_seconds(F.col("elapsed_seconds") / 60).alias("poll_seconds")
    )


def eta_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = M.with_elapsed(d.ledger(spark, sf_dir), _as_of())
    return rows.select(
        "batch_id",
        S.completion_estimate(F.col("status"), F.col("elapsed_seconds")).alias("eta"),
    )


def batch_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.batch_status(d.ledger(spark, sf_dir), _as_of()).select(
        "batch_id", "status", _text("created_at"), "elapsed_seconds",
        "estimated_completion",
    )


def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.status_counts(d.ledger(spark, sf_dir))


def monitor_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.monitor_summary(d.ledger(spark, sf_dir), _as_of())


def failed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.failed_batches(d.ledger(spark, sf_dir))


def status_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.status_lines(d.ledger(spark, sf_dir), _as_of())


def status_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress lines of two moments, appended to one history."""
    path, ledger = scratch_dir(spark), d.ledger(spark, sf_dir)
    later = F.expr(f"timestamp_ntz'{d.AS_OF}' + interval 1 hour")
    for moment in (_as_of(), later):
        M.append_status(ledger, moment, path)
    rows = spark.read.schema("batch_id string, line string, at string").json(path)
    return rows.groupBy(F.col("at").alias("moment")).agg(
        F.count("*").alias("n_lines"), F.min("line").alias("first"), F.max("line").alias("last")
    )


def validate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ask for the batch of every line item, shifted so that some are unknown."""
    asked = d.table(spark, sf_dir, "lineitem").select(
        F.concat(
            F.lit("batch_"), (F.col("l_orderkey") * 2).cast("string")
        ).alias("batch_id")
    )
    return M.validate_ids(asked, d.ledger(spark, sf_dir))


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run ledger of three runs: one over a third of the parts that completes,
    one over the rest whose model is lost halfway, and one that resumes it.

    Parts arrive in as many files as the table has partitions. The number of
    files of an arrival is the size of a micro-batch, so the second run gets the
    second third whole before it meets the third.
    """
    work, parts = scratch_dir(spark), d.table(spark, sf_dir, "part")
    third = F.col("p_partkey") % 3
    count = {r["k"]: r["n"] for r in parts.groupBy(third.alias("k")).agg(F.count("*").alias("n")).collect()}
    as_of = datetime.fromisoformat(d.AS_OF)
    arrived = [0]

    def arrive(k: int) -> None:
        parts.where(third == k).write.mode("append").parquet(f"{work}/in")
        arrived.append(len(spark.read.schema(parts.schema).parquet(f"{work}/in").inputFiles()))

    def run(name: str, minutes: int, total: int | None, files: int, fail: bool = False) -> None:
        def labelled(batch: DataFrame) -> DataFrame:
            if fail and not batch.where(third == 2).isEmpty():
                raise RuntimeError("model lost")
            return batch.where("p_size > 10").select("p_partkey")

        session = ledger.Session(
            spark, f"{work}/ledger", name, total, as_of - timedelta(minutes=minutes), interval=files
        )
        source = incremental.read_stream(spark, f"{work}/in", parts.schema, files_per_trigger=files)
        try:
            incremental.write_once(source, labelled, f"{work}/out", f"{work}/state", session)
        except StreamingQueryException:
            if not fail:
                raise

    arrive(0)
    run("sync_1", 300, count.get(0, 0), arrived[1])
    arrive(1)
    arrive(2)
    files = max(1, arrived[2] - arrived[1])
    run("sync_2", 200, count.get(1, 0) + count.get(2, 0), files, fail=True)
    run("sync_3", 100, None, max(1, arrived[3] - arrived[2]))
    return ledger.read_sessions(spark, f"{work}/ledger")


def list_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.session_report(_runs(spark, sf_dir)).select(
        "session_id", "processed_count", "total_results", "pending_items_count"
    )


def session_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How each run stands, and what it says of itself."""
    return M.session_report(_runs(spark, sf_dir)).select(
        "session_id", "status", "enabled", (F.col("interval") > 0).alias("has_interval"),
        F.col("last_error").contains("model lost").alias("lost"),
        F.col("updated_at").isNotNull().alias("dated"),
        F.col("elapsed_text").rlike(r"^\d+:\d\d:\d\d$").alias("timed"),
    )


def progress_eta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.progress(_runs(spark, sf_dir), _as_of()).select(
        "session_id", "processed_count", "elapsed_seconds",
        F.round("progress_percent", 4).alias("progress_percent"),
        F.round("remaining_seconds", 4).alias("remaining_seconds"),
        _text("finish_at"),
    )


QUERIES = {
    "poll_interval": poll_interval,
    "eta_bucket": eta_bucket,
    "batch_status": batch_status,
    "status_counts": status_counts,
    "monitor_summary": monitor_summary,
    "failed_batches": failed_batches,
    "status_lines": status_lines,
    "status_history": status_history,
    "validate_ids": validate_ids,
    "list_sessions": list_sessions,
    "session_status": session_status,
    "progress_eta": progress_eta,
}

_AGED = f"""WITH {d.LEDGER_SQL},
aged AS (
  SELECT *, CAST(epoch(TIMESTAMP '{d.AS_OF}') - epoch(created_at) AS DOUBLE) AS s FROM ledger
),
dated AS (
  SELECT *, CASE WHEN status = 'validating' THEN '2-5 minutes'
    WHEN status = 'in_progress' THEN CASE WHEN s < 3600 THEN '2-20 hours'
      WHEN s < 43200 THEN '2-12 hours' ELSE '1-6 hours' END
    WHEN status = 'finalizing' THEN '1-10 minutes' END AS eta FROM aged
),
classed AS (
  SELECT *, CASE WHEN status IN ('validating', 'in_progress', 'finalizing', 'cancelling')
    THEN 'running' WHEN status = 'completed' THEN 'completed' ELSE 'failed' END AS class,
    status IN ('failed', 'cancelled', 'expired')
      OR (status = 'completed' AND n_results = 0) AS bad
  FROM dated
)"""
_SESSIONS = """WITH counted AS (
  SELECT p_partkey % 3 AS k, count(*) AS n, count(*) FILTER (WHERE p_size > 10) AS r
  FROM part GROUP BY k
),
sessions AS (
  SELECT k, 'sync_' || k + 1 AS session_id, n AS processed, r AS results,
    CASE k WHEN 0 THEN 0 WHEN 1 THEN (SELECT n FROM counted WHERE k = 2) END AS pending,
    (3 - k) * 6000.0 AS elapsed,
    CASE k WHEN 0 THEN 1.0
      WHEN 1 THEN n / (SELECT sum(n) FROM counted WHERE k > 0) END AS ratio
  FROM counted
)"""

ORACLE = {
    "poll_interval": f"""{_AGED}
SELECT batch_id, CASE WHEN s < 300 THEN 30 WHEN s < 900 THEN 60 WHEN s < 3600 THEN 300
  ELSE 600 END AS poll_seconds FROM aged""",
    "eta_bucket": f"{_AGED} SELECT batch_id, eta FROM dated",
    "batch_status": f"""{_AGED}
SELECT batch_id, status, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at,
       s AS elapsed_seconds, eta AS estimated_completion FROM dated""",
    "status_counts": f"""{_AGED}
SELECT class AS status_class, count(*) AS n_batches FROM classed GROUP BY class""",
    "monitor_summary": f"""{_AGED}
SELECT count(*) FILTER (WHERE class = 'completed' AND NOT bad) AS completed,
  count(*) FILTER (WHERE bad) AS failed,
  count(*) FILTER (WHERE class = 'running') AS remaining, max(s) AS total_seconds
FROM classed""",
    "failed_batches": f"{_AGED} SELECT batch_id, status FROM classed WHERE bad",
    "status_lines": f"""{_AGED}
SELECT batch_id, '[{d.AS_OF}] Batch ' || batch_id || ': ' || status || ' (elapsed: '
  || CAST(s AS BIGINT) || ' s, ETA: ' || coalesce(eta, 'Unknown') || ')' AS line
FROM dated""",
    "status_history": f"""{_AGED},
moments AS (SELECT unnest([0, 3600]) AS more),
moved AS (
  SELECT *, s + more AS t, strftime(TIMESTAMP '{d.AS_OF}' + to_seconds(more), '%Y-%m-%d %H:%M:%S') AS moment
  FROM aged, moments
),
lines AS (
  SELECT moment, '[' || moment || '] Batch ' || batch_id || ': ' || status || ' (elapsed: '
    || CAST(t AS BIGINT) || ' s, ETA: ' || coalesce(CASE WHEN status = 'validating' THEN '2-5 minutes'
      WHEN status = 'in_progress' THEN CASE WHEN t < 3600 THEN '2-20 hours'
        WHEN t < 43200 THEN '2-12 hours' ELSE '1-6 hours' END
      WHEN status = 'finalizing' THEN '1-10 minutes' END, 'Unknown') || ')' AS line FROM moved
)
SELECT moment, count(*) AS n_lines, min(line) AS first, max(line) AS last FROM lines GROUP BY moment""",
    "validate_ids": """
SELECT 'batch_' || l_orderkey * 2 AS batch_id,
       l_orderkey * 2 IN (SELECT o_orderkey FROM orders) AS valid FROM lineitem""",
    "list_sessions": f"""{_SESSIONS}
SELECT session_id, processed AS processed_count, results AS total_results,
       pending AS pending_items_count FROM sessions""",
    "session_status": f"""{_SESSIONS}
SELECT session_id, CASE WHEN k = 1 THEN 'crashed' ELSE 'completed' END AS status,
  true AS enabled, true AS has_interval, CASE WHEN k = 1 THEN true END AS lost, true AS dated, true AS timed
FROM sessions""",
    "progress_eta": f"""{_SESSIONS}
SELECT session_id, processed AS processed_count, CAST(elapsed AS DOUBLE) AS elapsed_seconds,
  round(ratio * 100, 4) AS progress_percent,
  round(elapsed / ratio - elapsed, 4) AS remaining_seconds,
  strftime(TIMESTAMP '{d.AS_OF}' + to_seconds(CAST(trunc(elapsed / ratio - elapsed) AS BIGINT)),
    '%Y-%m-%d %H:%M:%S') AS finish_at FROM sessions""",
}
