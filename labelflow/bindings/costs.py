"""Cost and resource metrics over conversations and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelflow.bindings import derived as d
from labelflow.bindings.text import sql_tokens
from labelflow.operators import costs as C
from labelflow.sources.sinks import write_json
from labelflow.storage import scratch_dir

_START = f"timestamp'{d.AS_OF}'"


def results(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Requests, and results of which every 7th conversation lost its text."""
    users, answers = d.turns(spark, sf_dir)
    words = F.slice(F.split("completion", " "), 1, 2)
    conv = F.substring_index("id", "-", 1).cast("long")
    return users, answers.select(
        "id",
        F.when(conv % 7 > 0, F.col("completion")).alias("completion"),
        words.alias("categories"),
    )


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    users, answers = results(spark, sf_dir)
    conv, turn = F.col("conv_id"), F.col("turn")
    start = F.expr(
        f"{_START} + make_dt_interval(0, 0, cast(conv_id % 5000 as int), cast(turn * 10 as int))"
    )
    seconds = (F.length("completion") % 97).cast("int") + 1
    return (
        C.pair_requests(users, answers)
        .withColumn("model", d.model_name())
        .withColumn("started_at", start)
        .withColumn(
            "ended_at",
            F.col("started_at") + F.make_dt_interval(secs=seconds),
        )
        .withColumn("error", F.when((conv + turn) % 10 == 0, F.lit("timeout")))
        .withColumn("batch_id", F.concat(F.lit("b"), conv.cast("string")))
        .withColumn("explicit_cost", F.when(conv % 11 == 0, F.lit(0.5)))
    )


def pair_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    users, answers = results(spark, sf_dir)
    return C.pair_requests(users, answers).select("id", "prompt", "completion")


def price_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    users, _ = d.turns(spark, sf_dir)
    rows = users.select("id", d.model_name().alias("model"))
    return C.with_prices(rows, C.price_book(spark), "batch")


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.request_metrics(pairs(spark, sf_dir), C.price_book(spark))


def _money(name: str):
    return F.round(name, 9).alias(name)


def request_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _requests(spark, sf_dir).select("request_id", _money("cost"))


def request_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _requests(spark, sf_dir).select(
        "request_id", "model", "runtime", "prompt_tokens", "completion_tokens",
        "error", "pricing_mode", _money("cost"),
    )


def batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.batch_metrics(pairs(spark, sf_dir), C.price_book(spark)).select(
        "batch_id", "num_samples", "runtime", "error", "pricing_mode",
        "total_input_tokens", "total_output_tokens", _money("cost"),
        F.round("average_input_tokens", 6).alias("average_input_tokens"),
        F.round("average_output_tokens", 6).alias("average_output_tokens"),
    )


def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.run_totals(_requests(spark, sf_dir)).select(
        "total_samples", F.round("total_cost", 6).alias("total_cost"),
        _money("cost_per_sample"),
    )


def run_timing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.run_totals(_requests(spark, sf_dir)).select(
        "total_runtime",
        F.round("average_time_per_sample", 6).alias("average_time_per_sample"),
    )


def error_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.error_list(_requests(spark, sf_dir)).select(
        "error", "n_errors",
        F.date_format("first_at", "yyyy-MM-dd HH:mm:ss").alias("first_at"),
        F.date_format("last_at", "yyyy-MM-dd HH:mm:ss").alias("last_at"),
    )


def outcome_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.outcome_counts(_requests(spark, sf_dir))


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("at"),
        F.col("value").alias("cpu_percent"),
        (F.col("value") * 4).alias("memory_mb"),
    )


def resource_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = C.resource_stats(samples(spark, sf_dir))
    return stats.select(*[F.round(c, 6).alias(c) for c in stats.columns])


def resource_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, value = F.col("event_id"), F.col("value")
    rows = d.table(spark, sf_dir, "events").select(
        key.alias("at"),
        F.when(key % 2 == 0, value * 10).alias("gpu_memory_mb"),
        F.when(key % 3 > 0, value).alias("cpu_percent"),
        F.when(key % 5 == 0, value + 100).alias("watts"),
    )
    return C.resource_series(rows).select(
        "at", "series", F.round("value", 6).alias("value")
    )


def simple_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.simple_stats(
        C.run_totals(_requests(spark, sf_dir)),
        C.resource_stats(samples(spark, sf_dir)),
        "gpt-4o",
    )


def sink_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark)
    C.save_metrics(request_metrics(spark, sf_dir), simple_stats(spark, sf_dir), path)
    schema = (
        "request_id string, runtime double, prompt_tokens long, cost double, error string"
    )
    return spark.read.schema(schema).json(f"{path}/facts")


def sink_metrics_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary that was written next to the facts."""
    path, summary = scratch_dir(spark), simple_stats(spark, sf_dir)
    C.save_metrics(request_metrics(spark, sf_dir), summary, path)
    return spark.read.schema(summary.schema).json(f"{path}/summary")


QUERIES = {
    "pair_requests": pair_requests,
    "price_lookup": price_lookup,
    "request_cost": request_cost,
    "request_metrics": request_metrics,
    "batch_metrics": batch_metrics,
    "run_totals": run_totals,
    "run_timing": run_timing,
    "error_list": error_list,
    "outcome_counts": outcome_counts,
    "resource_stats": resource_stats,
    "resource_series": resource_series,
    "simple_stats": simple_stats,
    "sink_metrics": sink_metrics,
    "sink_metrics_summary": sink_metrics_summary,
}

_PRICES = ", ".join(f"('{m}', '{k}', {i}, {o})" for m, k, i, o in C.PRICES)
_BOOK = f"""
book(model, mode, input_price, output_price) AS (VALUES {_PRICES}),
asked AS (
  SELECT conv_id, turn, id, prompt, {d.MODEL_SQL} AS model,
    CASE WHEN conv_id % 7 > 0 THEN completion ELSE
      '[''' || array_to_string(list_slice(string_split(completion, ' '), 1, 2), ''', ''')
      || ''']' END AS completion
  FROM pairs
)"""


def _priced(mode: str) -> str:
    return f"""priced AS (
  SELECT a.*, coalesce(b.input_price, g.input_price) AS input_price,
         coalesce(b.output_price, g.output_price) AS output_price
  FROM asked a LEFT JOIN book b ON b.model = a.model AND b.mode = '{mode}'
  JOIN book g ON g.model = 'gpt-4o-mini' AND g.mode = '{mode}'
)"""


def _facts(mode: str) -> str:
    return f"""WITH {d.PAIRS_SQL}, {_BOOK}, {_priced(mode)},
facts AS (
  SELECT *, CASE WHEN (conv_id + turn) % 10 = 0 THEN 'timeout' END AS error,
    TIMESTAMP '{d.AS_OF}' + to_minutes(conv_id % 5000) + to_seconds(turn * 10) AS started_at,
    TIMESTAMP '{d.AS_OF}' + to_minutes(conv_id % 5000)
      + to_seconds(turn * 10 + length(completion) % 97 + 1) AS ended_at,
    {sql_tokens('prompt')} AS n_in, {sql_tokens('completion')} AS n_out
  FROM priced
),
metrics AS (
  SELECT *, epoch(ended_at) - epoch(started_at) AS runtime,
    CASE WHEN error IS NULL THEN n_out ELSE 0 END AS n_done,
    n_in / 1e6 * input_price
      + CASE WHEN error IS NULL THEN n_out ELSE 0 END / 1e6 * output_price AS cost
  FROM facts
)"""


_TOTALS = """totals AS (
  SELECT count(*) AS n, sum(cost) AS cost,
         epoch(max(ended_at)) - epoch(min(started_at)) AS seconds FROM metrics
)"""

_STATS = f"""{_facts('non_batch')}, {_TOTALS},
resources AS (SELECT max(value) AS cpu, avg(value) AS mean FROM events)
SELECT 'gpt-4o' AS model, printf('%.2fs', seconds) AS total_runtime,
  printf('%.3fs', seconds / n) AS time_per_sample,
  printf('%.1f MB', cpu * 4) AS peak_memory, printf('%.1f MB', mean * 4) AS average_memory,
  printf('%.1f%%', cpu) AS peak_cpu_usage, printf('%.1f%%', mean) AS average_cpu_usage,
  printf('$%.4f', cost) AS total_cost, printf('$%.4f', cost / n) AS cost_per_sample
FROM totals, resources"""

ORACLE = {
    "pair_requests": f"""WITH {d.PAIRS_SQL}, {_BOOK}
SELECT id, prompt, completion FROM asked""",
    "price_lookup": f"""WITH {_BOOK.replace('FROM pairs', "FROM (SELECT conv_id, turn, conv_id || '-' || turn AS id, text AS prompt, '' AS completion FROM conversations WHERE role = 'user')")}, {_priced('batch')}
SELECT id, model, CAST(input_price AS DOUBLE) AS input_price,
       CAST(output_price AS DOUBLE) AS output_price FROM priced""",
    "request_cost": f"""{_facts('non_batch')}
SELECT id AS request_id, round(cost, 9) AS cost FROM metrics""",
    "request_metrics": f"""{_facts('non_batch')}
SELECT id AS request_id, model, runtime, CAST(n_in AS INTEGER) AS prompt_tokens,
       CAST(n_done AS INTEGER) AS completion_tokens, error, 'non_batch' AS pricing_mode,
       round(cost, 9) AS cost FROM metrics""",
    "batch_metrics": f"""{_facts('batch')}
SELECT 'b' || conv_id AS batch_id, count(*) AS num_samples,
  epoch(max(ended_at)) - epoch(min(started_at)) AS runtime, max(error) AS error,
  'batch' AS pricing_mode, CAST(sum(n_in) AS BIGINT) AS total_input_tokens,
  CAST(sum(n_out) AS BIGINT) AS total_output_tokens,
  CASE WHEN conv_id % 11 = 0 THEN 0.5 ELSE round(sum(n_in) / 1e6 * max(input_price)
    + sum(n_out) / 1e6 * max(output_price), 9) END AS cost,
  round(sum(n_in) / count(*), 6) AS average_input_tokens,
  round(sum(n_out) / count(*), 6) AS average_output_tokens
FROM metrics GROUP BY conv_id""",
    "run_totals": f"""{_facts('non_batch')}, {_TOTALS}
SELECT n AS total_samples, round(cost, 6) AS total_cost,
       round(cost / n, 9) AS cost_per_sample FROM totals""",
    "run_timing": f"""{_facts('non_batch')}, {_TOTALS}
SELECT seconds AS total_runtime, round(seconds / n, 6) AS average_time_per_sample
FROM totals""",
    "error_list": f"""{_facts('non_batch')}
SELECT error, count(*) AS n_errors,
  strftime(min(ended_at), '%Y-%m-%d %H:%M:%S') AS first_at,
  strftime(max(ended_at), '%Y-%m-%d %H:%M:%S') AS last_at
FROM metrics WHERE error IS NOT NULL GROUP BY error""",
    "outcome_counts": f"""{_facts('non_batch')}
SELECT count(*) FILTER (WHERE error IS NULL) AS n_ok,
       count(*) FILTER (WHERE error IS NOT NULL) AS n_failed FROM metrics""",
    "resource_stats": """SELECT round(max(value), 6) AS peak_cpu_percent,
  round(avg(value), 6) AS avg_cpu_percent, round(max(value * 4), 6) AS peak_memory_mb,
  round(avg(value * 4), 6) AS avg_memory_mb FROM events""",
    "resource_series": """
SELECT event_id AS at, 'gpu_memory_mb' AS series, round(value * 10, 6) AS value
FROM events WHERE event_id % 2 = 0
UNION ALL SELECT event_id, 'cpu_percent', round(value, 6) FROM events WHERE event_id % 3 > 0
UNION ALL SELECT event_id, 'watts', round(value + 100, 6) FROM events WHERE event_id % 5 = 0""",
    "simple_stats": _STATS,
    "sink_metrics_summary": _STATS,
    "sink_metrics": f"""{_facts('non_batch')}
SELECT id AS request_id, runtime, n_in AS prompt_tokens, round(cost, 9) AS cost, error
FROM metrics""",
}
