"""Read model output lines back into responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelflow.functions.once import with_once

LINE_SCHEMA = (
    "custom_id string, error string, response struct<status_code int, body string>,"
    " _corrupt string"
)
BODY_SCHEMA = (
    "model string,"
    " choices array<struct<message: struct<content: string>, logprobs: string>>"
)
#: The parts of a line that is a result.
RESULT_COLUMNS = ("id", "raw_response", "model_name", "batch_id", "confidence_scores")
_FALSY = ["", "{}", "[]", "false", "0"]


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines under a schema; a line that cannot be read is kept as text."""
    return parse_json_lines(spark.read.text(path), F.col("value"), schema)


def parse_json_lines(df: DataFrame, line: Column, schema: str) -> DataFrame:
    parsed = F.from_json(
        line, f"{schema}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"}
    )
    return df.select(*[c for c in df.columns if c != "value"], parsed.alias("_r")).select(
        *[c for c in df.columns if c != "value"], "_r.*"
    )


def read_batch_files(spark: SparkSession, path: str) -> DataFrame:
    """(batch_id, line) of all output files; the batch is named by its folder."""
    return spark.read.text(path).select(
        F.regexp_extract("_metadata.file_path", r"batch_id=([^/]+)/", 1).alias(
            "batch_id"
        ),
        F.col("value").alias("line"),
    )


def _parsed(lines: DataFrame) -> DataFrame:
    record = F.from_json("line", LINE_SCHEMA, {"columnNameOfCorruptRecord": "_corrupt"})
    parsed = with_once(lines, "_r", record)
    return with_once(parsed, "_b", F.from_json("_r.response.body", BODY_SCHEMA))


def parse_batch_output(lines: DataFrame) -> DataFrame:
    """(custom_id, status_code, response_content); failed rows keep null content."""
    choices = F.col("_b.choices")
    content = F.when(F.size(choices) == 0, F.lit(None)).otherwise(
        F.coalesce(F.get(choices, F.lit(0))["message"]["content"], F.lit(""))
    )
    status = F.col("_r.response.status_code")
    return _parsed(lines).select(
        F.col("_r.custom_id").alias("custom_id"),
        status.alias("status_code"),
        F.when(status == 200, content).alias("response_content"),
    )


def classify(lines: DataFrame, default_model: str) -> DataFrame:
    """Each line of (batch_id, line) with an ``outcome`` and its parts.

    The first reason that applies is given; only ``ok`` lines are results.
    """
    record, body = F.col("_r"), F.col("_b")
    choice = F.get(body["choices"], F.lit(0))
    # A key named error stands in the text, if not in escapes: most need no third look.
    text = record["response"]["body"]
    maybe = F.contains(text, F.lit('"error"')) | F.contains(text, F.lit("\\u"))
    keys = F.json_object_keys(text)
    error = record["error"]
    outcome = (
        F.when(record.isNull() | record["_corrupt"].isNotNull(), "bad_json")
        .when(error.isNotNull() & ~error.isin(_FALSY), "api_error")
        .when(record["custom_id"].isNull(), "missing_key")
        .when(record["response"]["body"].isNull(), "missing_key")
        .when(maybe & F.array_contains(keys, "error"), "body_error")
        .when(F.size(body["choices"]) == 0, "empty_choices")
        .when(choice["message"]["content"].isNull(), "missing_key")
        .otherwise("ok")
    )
    return _parsed(lines).select(
        "batch_id",
        outcome.alias("outcome"),
        record["custom_id"].alias("id"),
        choice["message"]["content"].alias("raw_response"),
        F.coalesce(body["model"], F.lit(default_model)).alias("model_name"),
        choice["logprobs"].alias("confidence_scores"),
    )


def batch_results(lines: DataFrame, default_model: str) -> DataFrame:
    """Usable results: (id, raw_response, model_name, batch_id, confidence_scores)."""
    return (
        classify(lines, default_model)
        .where(F.col("outcome") == "ok")
        .select(*RESULT_COLUMNS)
    )


def error_report(lines: DataFrame, default_model: str) -> DataFrame:
    return (
        classify(lines, default_model)
        .groupBy("batch_id", "outcome")
        .agg(F.count("*").alias("n_lines"))
    )
