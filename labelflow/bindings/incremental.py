"""Inference, resume and streams over part, documents and events."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelflow.bindings import derived as d
from labelflow.bindings import normalizer as N
from labelflow.bindings.costs import samples
from labelflow.bindings.models import FlakyModel, TermModel, TitleModel
from labelflow.bindings.requests import topic_table
from labelflow.functions.prompts import fill, metadata_field
from labelflow.operators import costs as C
from labelflow.operators import results as R
from labelflow.operators.infer import infer
from labelflow.operators.matching import Vocabulary
from labelflow.plans import label as L
from labelflow.sources.table import ResultTable
from labelflow.storage import scratch_dir
from labelflow.streaming import incremental as S
from labelflow.streaming.repeats import drop_repeats_for, keyed_state

TEMPLATE = "<title>: <abstract>"


def prompt_topics(spark: SparkSession, sf_dir: str) -> list[str]:
    """The terms that the stand-in models know."""
    return sorted(r["topic"] for r in topic_table(spark, sf_dir).toLocalIterator())


def _to_items(parts: DataFrame) -> DataFrame:
    return parts.select(
        F.col("p_partkey").cast("string").alias("id"),
        F.concat_ws(" ", F.lower("p_type"), "p_brand").alias("text"),
        F.create_map(F.lit("title"), F.col("p_name")).alias("metadata"),
    )


def part_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _to_items(d.table(spark, sf_dir, "part"))


def _fields():
    return {"title": metadata_field("title"), "abstract": F.col("text")}


def _prompts(items: DataFrame) -> DataFrame:
    # The key makes each prompt unique, which FlakyModel relies on.
    return items.select("id", F.concat_ws(" ", fill(TEMPLATE, _fields()), "id").alias("prompt"))


def infer_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = prompt_topics(spark, sf_dir)
    out = infer(_prompts(part_items(spark, sf_dir)), lambda: TermModel(terms), rows_per_call=64)
    return out.select("id", "raw_response")


def _retried(spark: SparkSession, sf_dir: str, on_error: str = "row") -> DataFrame:
    terms = prompt_topics(spark, sf_dir)
    return infer(
        _prompts(part_items(spark, sf_dir)),
        lambda: FlakyModel(terms),
        retry_delay=0,
        on_error=on_error,
    )


def infer_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _retried(spark, sf_dir).select("id", "raw_response", "error", "attempts")


def infer_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model calls as cost facts, summed by outcome."""
    calls = _retried(spark, sf_dir).withColumnsRenamed(
        {"raw_response": "completion"}
    ).withColumn("model", F.lit("gpt-4o"))
    facts = C.request_metrics(calls, C.price_book(spark))
    return facts.groupBy("error").agg(
        F.count("*").alias("n_requests"),
        F.sum("prompt_tokens").alias("prompt_tokens"),
        F.round(F.sum("cost"), 8).alias("cost"),
        F.bool_and(F.col("runtime") >= 0).alias("timed"),
    )


def dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, failed = S.split_failures(_retried(spark, sf_dir))
    return failed.select("id", "error")


def custom_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two user steps around the built-in cleaning."""
    steps = [
        lambda df: df.withColumn("text", F.concat("text", F.lit(" <b>x</b> "))),
        L.clean_step(max_length=30),
        lambda df: df.where(F.length("text") % 2 == 0),
    ]
    return L.apply_steps(part_items(spark, sf_dir), steps).select("id", "text")


def _labeller(terms: list[str], vocabulary: Vocabulary):
    def run(items: DataFrame) -> DataFrame:
        out = L.label(
            items,
            lambda: TitleModel(terms),
            vocabulary,
            TEMPLATE,
            _fields(),
            rows_per_call=64,
        )
        return out.select("id", "categories", "hallucinations")

    return run


RESULT_SCHEMA = "id string, categories array<string>, hallucinations array<string>, epoch long"


def _shown(results: DataFrame) -> DataFrame:
    return results.select(
        "id",
        F.array_join("categories", "~").alias("categories"),
        F.array_join("hallucinations", "~").alias("hallucinations"),
    )


def label_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = d.vocabulary(spark, sf_dir)
    items = part_items(spark, sf_dir)
    return _shown(_labeller(prompt_topics(spark, sf_dir), vocabulary)(items))


def _stream(spark: SparkSession, sf_dir: str, path: str, pattern: str, work: str) -> DataFrame:
    """One run over the files that are new since the last run."""
    parts = d.table(spark, sf_dir, "part").schema
    source = S.read_stream(spark, path, parts, pattern, files_per_trigger=1)
    run = _labeller(prompt_topics(spark, sf_dir), d.vocabulary(spark, sf_dir))
    S.write_once(source, lambda b: run(_to_items(b)), f"{work}/out", f"{work}/state")
    return S.read_results(spark, f"{work}/out", RESULT_SCHEMA)


def stream_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_stream(spark, sf_dir, sf_dir, "part.parquet", scratch_dir(spark)))


def resume_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the parts arrive and are labelled; the other half follows, with
    every third part of the first half once more."""
    work = scratch_dir(spark)
    parts, key = d.table(spark, sf_dir, "part"), F.col("p_partkey")
    schema = RESULT_SCHEMA.removesuffix(", epoch long")
    table = ResultTable.create(spark, f"{work}/out", schema, buckets=16)
    run = _labeller(prompt_topics(spark, sf_dir), d.vocabulary(spark, sf_dir))
    for arrived in (key % 2 == 0, (key % 2 == 1) | (key % 3 == 0)):
        parts.where(arrived).write.mode("append").parquet(f"{work}/in")
        source = S.read_stream(spark, f"{work}/in", parts.schema)
        S.upsert_once(source, lambda b: run(_to_items(b)), table, f"{work}/state", "label")
    return _shown(table.read())


def table_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs put their results into one table, the first one twice."""
    old, new = _runs(spark, sf_dir)
    schema = "id long, processed_at timestamp_ntz, categories array<string>"
    table = ResultTable.create(spark, scratch_dir(spark), schema, buckets=16)
    for number, run in ((0, old), (1, new), (0, old)):
        table.upsert(run, F.col("processed_at"), batch=("runs", number))
    table.compact()
    table.vacuum()
    return table.read().select("id", F.array_join("categories", "~").alias("categories"))


def table_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each commit wrote: two appends, one of them replayed, and a merge."""
    old, new = _runs(spark, sf_dir)
    schema = "id long, processed_at timestamp_ntz, categories array<string>"
    table = ResultTable.create(spark, scratch_dir(spark), schema, buckets=1)
    for number, run in ((0, old), (0, old), (1, new)):
        table.append(run, batch=("runs", number))
    table.compact()
    return table.history()


def table_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as it was before the second run."""
    old, new = _runs(spark, sf_dir)
    schema = "id long, processed_at timestamp_ntz, categories array<string>"
    table = ResultTable.create(spark, scratch_dir(spark), schema, buckets=16)
    first = table.upsert(old)
    table.upsert(new)
    return table.read(first).select("id", F.array_join("categories", "~").alias("categories"))


def _documents(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    items = d.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), "text", "source"
    )
    done = d.table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"), "quality"
    )
    return items, done


def filtered_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that a length rule would lose."""
    items, _ = _documents(spark, sf_dir)
    return R.filtered_items(items, items.where(F.length("text") >= 400)).select("id")


def pending_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, done = _documents(spark, sf_dir)
    return R.pending_items(items, done).select("id", "source")


def _runs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A crashed run over even documents and a new run over two thirds of all."""
    items, _ = _documents(spark, sf_dir)

    def run(condition, when: str):
        return items.where(condition).select(
            "id",
            F.lit(when).cast("timestamp_ntz").alias("processed_at"),
            F.array(F.lit(when), F.col("source")).alias("categories"),
        )

    key = F.col("id")
    return (
        run(key % 2 == 0, "2024-01-01 00:00:00"),
        run(key % 3 > 0, "2024-01-02 00:00:00"),
    )


def recover_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _runs(spark, sf_dir)
    return R.latest_results(old, new, old).select(
        "id", F.array_join("categories", "~").alias("categories")
    )


def results_with_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results next to whole items: text and metadata."""
    items, done = _documents(spark, sf_dir)
    shifted = done.withColumn("id", F.col("id") + 1)
    items = items.select("id", "text", F.create_map(F.lit("source"), "source").alias("metadata"))
    return R.with_source(shifted, items).select(
        "id", "quality", "text", F.try_element_at("metadata", F.lit("source")).alias("source")
    )


EVENTS = (
    "event_id long, ts timestamp_ntz, user_id long, event_type string, value double,"
    " props string"
)


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = S.read_stream(spark, sf_dir, EVENTS, "events.parquet")
    return rows.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("at"),
        F.col("value").alias("cpu_percent"),
        (F.col("value") * 4).alias("memory_mb"),
    )


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event arrives twice and is kept once."""
    work = scratch_dir(spark)
    twice = _event_stream(spark, sf_dir).withColumn(
        "copy", F.explode(F.array(F.lit(0), F.lit(1)))
    )
    once = S.drop_repeats(twice, "event_id", "at", "1 hour").select(
        "event_id", "cpu_percent"
    )
    S.append_once(once, f"{work}/out", f"{work}/state")
    return spark.read.schema("event_id long, cpu_percent double").parquet(f"{work}/out")


def stream_dedup_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event arrives, and all of them again five hours later by their time:
    long after the delay, but within the lifetime of what is remembered."""
    work = scratch_dir(spark)
    events = d.table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("at"), F.col("value").alias("cpu_percent")
    )
    again = events.select(
        "event_id", (F.col("at") + F.expr("interval 5 hours")).alias("at"), F.lit(-1.0).alias("cpu_percent")
    )
    for rows in (events, again):
        rows.write.mode("append").parquet(f"{work}/in")
        with keyed_state(spark):
            arrived = S.read_stream(spark, f"{work}/in", rows.schema)
            # All events are within the delay of the first arrival, whose rows are in no order.
            once = drop_repeats_for(arrived, "event_id", "at", "1 hour", timedelta(days=366))
            S.append_once(once.select("event_id", "cpu_percent"), f"{work}/out", f"{work}/state")
    return spark.read.schema("event_id long, cpu_percent double").parquet(f"{work}/out")


def _shown_windows(windows: DataFrame) -> DataFrame:
    return windows.select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_start"),
        "n_samples",
        *[
            F.round(c, 6).alias(c)
            for c in ("peak_cpu", "avg_cpu", "peak_memory", "avg_memory")
        ],
    )


def resource_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six-hour windows of a stream, the last, open one included."""
    work = scratch_dir(spark)
    windows = S.resource_windows(_event_stream(spark, sf_dir), "6 hours")
    return _shown_windows(S.replace_once(windows, f"{work}/out", f"{work}/state"))


def resource_windows_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same operator on a finished table, six hours every two hours."""
    return _shown_windows(S.resource_windows(samples(spark, sf_dir), "6 hours", "2 hours"))


QUERIES = {
    "infer": infer_terms,
    "infer_retry": infer_retry,
    "infer_metrics": infer_metrics,
    "dead_letter": dead_letter,
    "custom_steps": custom_steps,
    "label_table": label_table,
    "stream_label": stream_label,
    "resume_run": resume_run,
    "filtered_items": filtered_items,
    "pending_items": pending_items,
    "table_upsert": table_upsert,
    "table_history": table_history,
    "table_as_of": table_as_of,
    "recover_results": recover_results,
    "results_with_source": results_with_source,
    "stream_dedup": stream_dedup,
    "stream_dedup_late": stream_dedup_late,
    "resource_windows": resource_windows,
    "resource_windows_sliding": resource_windows_sliding,
}

_ASKED = """
types AS (SELECT list(DISTINCT lower(p_type) ORDER BY lower(p_type)) AS t FROM part),
asked AS (
  SELECT CAST(p_partkey AS VARCHAR) AS id, p_name,
         p_name || ': ' || lower(p_type) || ' ' || p_brand AS text,
         p_name || ': ' || lower(p_type) || ' ' || p_brand || ' ' || p_partkey AS prompt
  FROM part
),
answered AS (
  SELECT *, array_to_string(list_filter(t, lambda x: contains(lower(text), x)), chr(9))
    AS answer, contains(text, 'promo') AS bad
  FROM asked, types
)"""
_LABELLED = N.normalize_sql(
    f"{_ASKED}, responses AS (SELECT id, answer || chr(9) || p_name || 'x' AS raw_response FROM answered)"
)
_WINDOW_COLUMNS = """count(*) AS n_samples, round(max(value), 6) AS peak_cpu,
  round(avg(value), 6) AS avg_cpu, round(max(value * 4), 6) AS peak_memory,
  round(avg(value * 4), 6) AS avg_memory"""
_RECOVERED = """SELECT doc_id AS id,
  CASE WHEN doc_id % 3 > 0 THEN '2024-01-02 00:00:00~' ELSE '2024-01-01 00:00:00~' END
    || source AS categories
FROM documents WHERE doc_id % 2 = 0 OR doc_id % 3 > 0"""

ORACLE = {
    "infer": f"WITH {_ASKED} SELECT id, answer AS raw_response FROM answered",
    "infer_retry": f"""WITH {_ASKED}
SELECT id, CASE WHEN NOT bad THEN answer END AS raw_response,
  CASE WHEN bad THEN 'model failed' END AS error, CASE WHEN bad THEN 3 ELSE 2 END AS attempts
FROM answered""",
    "infer_metrics": f"""WITH {_ASKED}, counted AS (
  SELECT bad, len(regexp_extract_all(prompt, '[A-Za-z0-9]+|[:#]')) AS n_in,
    CASE WHEN bad THEN 0 ELSE len(regexp_extract_all(answer, '[a-z]+')) END AS n_out
  FROM answered)
SELECT CASE WHEN bad THEN 'model failed' END AS error, count(*) AS n_requests,
  CAST(sum(n_in) AS BIGINT) AS prompt_tokens, round(sum(n_in / 1e6 * 2.5 + n_out / 1e6 * 10), 8) AS cost,
  true AS timed
FROM counted GROUP BY bad""",
    "dead_letter": f"WITH {_ASKED} SELECT id, 'model failed' AS error FROM answered WHERE bad",
    "custom_steps": """WITH cut AS (
  SELECT CAST(p_partkey AS VARCHAR) AS id,
    substr(lower(p_type) || ' ' || p_brand || ' x', 1, 30) AS text FROM part)
SELECT id, text FROM cut WHERE length(text) % 2 = 0""",
    "label_table": _LABELLED,
    "stream_label": _LABELLED,
    "resume_run": _LABELLED,
    "filtered_items": "SELECT doc_id AS id FROM documents WHERE length(text) < 400",
    "pending_items": """SELECT doc_id AS id, source FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "recover_results": _RECOVERED,
    "table_upsert": _RECOVERED,
    "table_as_of": """SELECT doc_id AS id, '2024-01-01 00:00:00~' || source AS categories
FROM documents WHERE doc_id % 2 = 0""",
    "table_history": """WITH n AS (
  SELECT count(*) FILTER (doc_id % 2 = 0) AS old, count(*) FILTER (doc_id % 3 > 0) AS new FROM documents)
SELECT version, operation, rows FROM (
  SELECT 0 AS version, 'create' AS operation, 0 AS rows UNION ALL SELECT 1, 'append', old FROM n
  UNION ALL SELECT 2, 'append', new FROM n UNION ALL SELECT 3, 'compact', old + new FROM n)""",
    "results_with_source": """SELECT l.doc_id + 1 AS id, quality, text, source
FROM labels l LEFT JOIN documents d ON d.doc_id = l.doc_id + 1""",
    "stream_dedup_late": "SELECT event_id, value AS cpu_percent FROM events",
    "stream_dedup": "SELECT event_id, value AS cpu_percent FROM events",
    "resource_windows": f"""WITH w AS (
  SELECT *, time_bucket(INTERVAL 6 HOURS, ts, TIMESTAMP '2000-01-01') AS start FROM events)
SELECT strftime(start, '%Y-%m-%d %H:%M') AS window_start, {_WINDOW_COLUMNS}
FROM w GROUP BY start""",
    "resource_windows_sliding": f"""WITH w AS (
  SELECT value, unnest([b, b - INTERVAL 2 HOURS, b - INTERVAL 4 HOURS]) AS start
  FROM (SELECT *, time_bucket(INTERVAL 2 HOURS, ts, TIMESTAMP '2000-01-01') AS b FROM events))
SELECT strftime(start, '%Y-%m-%d %H:%M') AS window_start, {_WINDOW_COLUMNS}
FROM w GROUP BY start""",
}
