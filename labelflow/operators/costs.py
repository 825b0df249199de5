"""Token cost, timing and resource metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelflow.functions.text import TokenCounter, token_count
from labelflow.sources.sinks import write_json
from labelflow.storage import materialise

# US dollars per million tokens (model, mode, input, output).
PRICES = [
    ("gpt-4o", "batch", 1.25, 5.00),
    ("gpt-4o", "non_batch", 2.50, 10.00),
    ("gpt-4o-mini", "batch", 0.075, 0.30),
    ("gpt-4o-mini", "non_batch", 0.15, 0.60),
    ("gpt-4.1", "batch", 1.00, 4.00),
    ("gpt-4.1", "non_batch", 2.00, 8.00),
    ("gpt-4.1-nano", "batch", 0.05, 0.20),
    ("gpt-4.1-nano", "non_batch", 0.10, 0.40),
]
DEFAULT_MODEL = "gpt-4o-mini"
MILLION = 1_000_000


def seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / 1e6


def price_book(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        PRICES, "model string, mode string, input_price double, output_price double"
    )


def with_prices(
    rows: DataFrame, prices: DataFrame, mode: str, default_model: str = DEFAULT_MODEL
) -> DataFrame:
    """Add ``input_price`` and ``output_price``; unknown models cost the default.

    One (model, mode) pair has one price, so the join adds no rows.
    """
    book = prices.where(F.col("mode") == mode).drop("mode")
    default = book.where(F.col("model") == default_model).agg(
        F.first(F.struct("input_price", "output_price")).alias("p")
    )
    known = book.select(
        "model",
        F.col("input_price").alias("_in"),
        F.col("output_price").alias("_out"),
    )
    return (
        rows.join(known, "model", "left")
        .withColumn("_default", default.scalar())
        .withColumn("input_price", F.coalesce("_in", "_default.input_price"))
        .withColumn("output_price", F.coalesce("_out", "_default.output_price"))
        .drop("_in", "_out", "_default")
    )


def pair_requests(requests: DataFrame, results: DataFrame) -> DataFrame:
    """Prompt and completion by id; the label list stands in for lost text.

    requests(id, prompt, ...), results(id, completion, categories). Results of
    one id are reduced to one before the join, so requests never multiply.
    """
    labels = F.concat(F.lit("['"), F.array_join("categories", "', '"), F.lit("']"))
    answers = results.groupBy("id").agg(
        F.max(F.coalesce("completion", labels)).alias("completion")
    )
    return requests.join(materialise(answers), "id")


def save_metrics(facts: DataFrame, summary: DataFrame, path: str) -> None:
    """Facts as JSON lines below ``path``/facts and the summary, a row per run,
    appended below ``path``/summary."""
    write_json(facts, f"{path}/facts")
    write_json(summary, f"{path}/summary")


def token_cost(prompt_tokens: Column, completion_tokens: Column) -> Column:
    return (
        prompt_tokens / MILLION * F.col("input_price")
        + completion_tokens / MILLION * F.col("output_price")
    )


def request_metrics(
    pairs: DataFrame, prices: DataFrame, count: TokenCounter = token_count
) -> DataFrame:
    """One row per request at non-batch prices.

    ``pairs`` needs (id, model, prompt, completion, started_at, ended_at, error).
    A failed request has no completion.
    """
    completion = F.when(F.col("error").isNull(), F.col("completion")).otherwise("")
    counted = pairs.select(
        F.col("id").alias("request_id"),
        "model",
        "started_at",
        "ended_at",
        seconds_between(F.col("started_at"), F.col("ended_at")).alias("runtime"),
        count(F.col("prompt")).alias("prompt_tokens"),
        count(completion).alias("completion_tokens"),
        "error",
        F.lit("non_batch").alias("pricing_mode"),
    )
    cost = token_cost(F.col("prompt_tokens"), F.col("completion_tokens"))
    return (
        with_prices(counted, prices, "non_batch")
        .withColumn("cost", cost)
        .drop("input_price", "output_price")
    )


def batch_metrics(
    pairs: DataFrame, prices: DataFrame, count: TokenCounter = token_count
) -> DataFrame:
    """One row per batch at batch prices; an explicit cost wins.

    ``pairs`` needs (batch_id, model, prompt, completion, started_at, ended_at,
    error, explicit_cost). Token totals need texts: without them the cost is 0.
    Everything is a partial aggregate, so a hot batch is summed map-side.
    """
    has_text = F.col("prompt").isNotNull() & F.col("completion").isNotNull()
    counted = pairs.select(
        "batch_id",
        "model",
        "started_at",
        "ended_at",
        "error",
        "explicit_cost",
        F.when(has_text, count(F.col("prompt"))).alias("n_in"),
        F.when(has_text, count(F.col("completion"))).alias("n_out"),
    )
    grouped = counted.groupBy("batch_id").agg(
        F.max("model").alias("model"),
        F.count("*").alias("num_samples"),
        F.min("started_at").alias("started_at"),
        F.max("ended_at").alias("ended_at"),
        F.max("error").alias("error"),
        F.max("explicit_cost").alias("explicit_cost"),
        F.sum("n_in").alias("total_input_tokens"),
        F.sum("n_out").alias("total_output_tokens"),
    )
    cost = token_cost(F.col("total_input_tokens"), F.col("total_output_tokens"))
    samples = F.col("num_samples")
    return (
        with_prices(grouped, prices, "batch")
        .withColumn("cost", F.coalesce("explicit_cost", cost, F.lit(0.0)))
        .withColumn(
            "runtime", seconds_between(F.col("started_at"), F.col("ended_at"))
        )
        .withColumn("average_input_tokens", F.col("total_input_tokens") / samples)
        .withColumn("average_output_tokens", F.col("total_output_tokens") / samples)
        .withColumn("pricing_mode", F.lit("batch"))
        .drop("explicit_cost", "input_price", "output_price")
    )


def run_totals(metrics: DataFrame) -> DataFrame:
    """Samples, cost, cost per sample, runtime and time per sample of a run."""
    totals = metrics.agg(
        F.count("*").alias("total_samples"),
        F.coalesce(F.sum("cost"), F.lit(0.0)).alias("total_cost"),
        seconds_between(F.min("started_at"), F.max("ended_at")).alias("total_runtime"),
    )
    samples = F.col("total_samples")
    return totals.withColumn(
        "cost_per_sample",
        F.coalesce(F.try_divide("total_cost", samples), F.lit(0.0)),
    ).withColumn(
        "average_time_per_sample",
        F.coalesce(F.try_divide("total_runtime", samples), F.lit(0.0)),
    )


def error_list(metrics: DataFrame) -> DataFrame:
    """Failures by message, with the first and last time."""
    return (
        metrics.where(F.col("error").isNotNull())
        .groupBy("error")
        .agg(
            F.count("*").alias("n_errors"),
            F.min("ended_at").alias("first_at"),
            F.max("ended_at").alias("last_at"),
        )
    )


def outcome_counts(metrics: DataFrame) -> DataFrame:
    return metrics.agg(
        F.count_if(F.col("error").isNull()).alias("n_ok"),
        F.count_if(F.col("error").isNotNull()).alias("n_failed"),
    )


def resource_stats(samples: DataFrame) -> DataFrame:
    """Peak and mean of (cpu_percent, memory_mb); 0 when there is no sample."""
    zero = F.lit(0.0)
    return samples.agg(
        F.coalesce(F.max("cpu_percent"), zero).alias("peak_cpu_percent"),
        F.coalesce(F.avg("cpu_percent"), zero).alias("avg_cpu_percent"),
        F.coalesce(F.max("memory_mb"), zero).alias("peak_memory_mb"),
        F.coalesce(F.avg("memory_mb"), zero).alias("avg_memory_mb"),
    )


def resource_series(samples: DataFrame, is_local: bool = True) -> DataFrame:
    """Long form (at, series, value) of local-model samples without nulls."""
    long = samples.unpivot(
        "at", ["gpu_memory_mb", "cpu_percent", "watts"], "series", "value"
    )
    return long.where(F.col("value").isNotNull() & F.lit(is_local))


def simple_stats(totals: DataFrame, resources: DataFrame, model: str) -> DataFrame:
    """The printed one-row summary of a run; both inputs are one-row reports."""
    both = totals.withColumn(
        "_r", resources.select(F.struct(*resources.columns)).scalar()
    )

    def shown(pattern: str, column: str) -> Column:
        return F.format_string(pattern, F.col(column))

    return both.select(
        F.lit(model).alias("model"),
        shown("%.2fs", "total_runtime").alias("total_runtime"),
        shown("%.3fs", "average_time_per_sample").alias("time_per_sample"),
        shown("%.1f MB", "_r.peak_memory_mb").alias("peak_memory"),
        shown("%.1f MB", "_r.avg_memory_mb").alias("average_memory"),
        shown("%.1f%%", "_r.peak_cpu_percent").alias("peak_cpu_usage"),
        shown("%.1f%%", "_r.avg_cpu_percent").alias("average_cpu_usage"),
        shown("$%.4f", "total_cost").alias("total_cost"),
        shown("$%.4f", "cost_per_sample").alias("cost_per_sample"),
    )
