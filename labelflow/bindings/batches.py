"""Model output lines rendered from conversations, with planted faults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelflow.bindings import derived as d
from labelflow.bindings import normalizer as N
from labelflow.operators.monitoring import request_counts as count_requests
from labelflow.plans import importing as I
from labelflow.sources import batches as B
from labelflow.sources.sinks import write_batches
from labelflow.storage import scratch_dir

DEFAULT_MODEL = "gpt-4.1-nano"


def _json(**fields: Column) -> Column:
    return F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(batch_id, line): one line per answer, eight kinds by number."""
    rows = d.table(spark, sf_dir, "conversations").where(F.col("role") == "assistant")
    conv, turn = F.col("conv_id"), F.col("turn")
    item = F.concat_ws("-", "conv_id", "turn")
    message = F.struct(F.col("text").alias("content"))
    plain = F.array(F.struct(message.alias("message")))
    scored = F.array(
        F.struct(message.alias("message"), F.array(F.lit(0.5)).alias("logprobs"))
    )
    model = F.lit("gpt-4o")

    def body(**fields: Column) -> Column:
        return F.struct(*[v.alias(k) for k, v in fields.items()])

    def ok(inner: Column, status: int = 200) -> Column:
        return F.struct(F.lit(status).alias("status_code"), inner.alias("body"))

    fault = body(error=F.struct(F.lit("rate").alias("message")))
    kinds = [
        F.lit("not json {"),
        _json(custom_id=item, response=ok(fault, 429)),
        _json(custom_id=item, error=F.struct(F.lit("gone").alias("message"))),
        _json(response=ok(body(model=model, choices=plain))),
        _json(custom_id=item, response=ok(body(model=model, choices=F.slice(plain, 1, 0)))),
        F.concat(
            F.lit('{"custom_id":"'), item,
            F.lit('","error":null,"response":{"status_code":200,"body":{"error":null,"choices":'),
            F.to_json(plain), F.lit("}}}"),
        ),
        _json(custom_id=item, response=ok(body(choices=plain))),
        _json(custom_id=item, response=ok(body(model=model, choices=scored))),
    ]
    kind = ((conv + turn) % 8).cast("int")
    line = F.lit(None).cast("string")
    for i, rendered in enumerate(kinds):
        line = F.when(kind == i, rendered).otherwise(line)
    return rows.select(
        F.concat(F.lit("b"), (conv % 4).cast("string")).alias("batch_id"),
        line.alias("line"),
    )


def _written(spark: SparkSession, rows: DataFrame) -> DataFrame:
    path = scratch_dir(spark)
    write_batches(rows, path)
    return B.read_batch_files(spark, path)


def parse_batch_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.parse_batch_output(lines(spark, sf_dir))


def batch_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.batch_results(lines(spark, sf_dir), DEFAULT_MODEL)


def batch_error_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.error_report(lines(spark, sf_dir), DEFAULT_MODEL)


def request_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_requests(B.classify(lines(spark, sf_dir), DEFAULT_MODEL))


def union_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = B.batch_results(_written(spark, lines(spark, sf_dir)), DEFAULT_MODEL)
    return rows.select("id", "batch_id", "raw_response")


def src_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written lines read back; a line that is not JSON is kept as text."""
    path = scratch_dir(spark)
    lines(spark, sf_dir).select(F.col("line").alias("value")).write.text(path)
    return B.read_jsonl(spark, path, "custom_id string").select(
        "custom_id", F.col("_corrupt").alias("unread")
    )


def _imported(spark: SparkSession, sf_dir: str) -> I.Imported:
    """Output files of earlier batches: read, keep good lines, normalize, write."""
    answers = d.responses(spark, sf_dir)
    content = F.struct(F.col("raw_response").alias("content")).alias("message")
    response = F.struct(
        F.lit(200).alias("status_code"),
        F.struct(F.array(F.struct(content)).alias("choices")).alias("body"),
    )
    batch = F.substring_index("id", "-", -1).cast("long") % 4
    rows = answers.select(
        F.concat(F.lit("b"), batch.cast("string")).alias("batch_id"),
        _json(custom_id=F.col("id"), response=response).alias("line"),
    )
    source = scratch_dir(spark)
    write_batches(rows, source)
    return I.import_batches(
        spark, source, scratch_dir(spark), d.vocabulary(spark, sf_dir), DEFAULT_MODEL
    )


def import_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _imported(spark, sf_dir).counts


def existing_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _imported(spark, sf_dir).results.select(
        "id", "batch_id", "model_name",
        F.array_join("categories", "~").alias("categories"),
    )


QUERIES = {
    "parse_batch_output": parse_batch_output,
    "batch_results": batch_results,
    "batch_error_report": batch_error_report,
    "request_counts": request_counts,
    "union_batches": union_batches,
    "src_jsonl": src_jsonl,
    "existing_batches": existing_batches,
    "import_counts": import_counts,
}

_LINES = """
rendered AS (
  SELECT 'b' || conv_id % 4 AS batch_id, conv_id || '-' || turn AS item, text,
         (conv_id + turn) % 8 AS kind
  FROM conversations WHERE role = 'assistant'
)"""
_OUTCOME = """CASE kind WHEN 0 THEN 'bad_json' WHEN 1 THEN 'body_error'
  WHEN 2 THEN 'api_error' WHEN 3 THEN 'missing_key' WHEN 4 THEN 'empty_choices'
  WHEN 5 THEN 'body_error' ELSE 'ok' END"""

ORACLE = {
    "parse_batch_output": f"""WITH {_LINES}
SELECT CASE WHEN kind NOT IN (0, 3) THEN item END AS custom_id,
  CASE WHEN kind = 1 THEN 429 WHEN kind IN (0, 2) THEN NULL ELSE 200 END AS status_code,
  CASE WHEN kind IN (3, 5, 6, 7) THEN text END AS response_content FROM rendered""",
    "batch_results": f"""WITH {_LINES}
SELECT item AS id, text AS raw_response,
  CASE kind WHEN 6 THEN 'gpt-4.1-nano' ELSE 'gpt-4o' END AS model_name, batch_id,
  CASE kind WHEN 7 THEN '[0.5]' END AS confidence_scores
FROM rendered WHERE kind >= 6""",
    "batch_error_report": f"""WITH {_LINES}
SELECT batch_id, {_OUTCOME} AS outcome, count(*) AS n_lines FROM rendered GROUP BY ALL""",
    "request_counts": f"""WITH {_LINES}
SELECT batch_id, count(*) AS total, count(*) FILTER (WHERE kind >= 6) AS completed,
       count(*) FILTER (WHERE kind < 6) AS failed FROM rendered GROUP BY batch_id""",
    "union_batches": f"""WITH {_LINES}
SELECT item AS id, batch_id, text AS raw_response FROM rendered WHERE kind >= 6""",
    "src_jsonl": f"""WITH {_LINES}
SELECT CASE WHEN kind NOT IN (0, 3) THEN item END AS custom_id,
       CASE WHEN kind = 0 THEN 'not json {{' END AS unread FROM rendered""",
    "import_counts": f"""WITH {d.RESPONSES_SQL}
SELECT 'b' || CAST(split_part(id, '-', 4) AS BIGINT) % 4 AS batch_id, count(*) AS total,
  count(raw_response) AS completed, count(*) - count(raw_response) AS failed
FROM responses GROUP BY batch_id""",
    "existing_batches": f"""WITH {N.PARTITION_SQL}, {N.MATCH_SQL}, {N.BEST_SQL}
SELECT id, 'b' || CAST(split_part(id, '-', 4) AS BIGINT) % 4 AS batch_id,
  'gpt-4.1-nano' AS model_name,
  array_to_string(CASE WHEN len(valid) > 0 THEN list_concat(valid, matched)
    ELSE [] END, '~') AS categories
FROM merged WHERE labels IS NOT NULL""",
}
