"""Prompt templates and model requests as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelflow.functions.text import TokenCutter, keep_tokens

# Fixed values of a chat request line.
METHOD = "POST"
ENDPOINT = "/v1/chat/completions"
MAX_OUTPUT_TOKENS = 248
CONTEXT_TOKENS = 128_000

# A starting point; any text with <title>, <abstract>, <topics> works.
DEFAULT_TEMPLATE = (
    'Dataset title: "<title>"\nDataset summary: "<abstract>"\n\n'
    "Choose the <num_terms> terms from the list below that fit this dataset best."
    " Answer with the terms only, separated by tabs, spelled as in the list.\n\n"
    "<topics>\n"
)


def format_template(template: str, topics: Sequence[str], **values: object) -> str:
    """Put the vocabulary and further values into a template once per job.

    The vocabulary is part of every prompt, so it has to be short enough for
    one; placeholders without a value stay as they are.
    """
    text = template.replace("<topics>", "\n".join(topics))
    for key, value in values.items():
        text = text.replace(f"<{key}>", str(value))
    return text


def read_template(spark: SparkSession, path: str) -> str:
    """A template file, wherever Spark can read it. One prompt's text."""
    return spark.read.text(path, wholetext=True).first()["value"]


def topic_lines(topics: DataFrame, topic: str = "topic", mark: str = "") -> Column:
    """The sorted distinct topics as one text, for vocabularies of any length.

    A scalar subquery: computed once per query, next to the rows that use it.
    """
    names = F.array_sort(F.collect_set(topic))
    lines = F.array_join(F.transform(names, lambda t: F.concat(F.lit(mark), t)), "\n")
    return topics.agg(lines.alias("lines")).scalar()


def bullets(topics: Sequence[str]) -> str:
    return "\n".join(f"- {topic}" for topic in topics)


def fill(
    template: str | Column, fields: Mapping[str, Column], opening: str = "<", closing: str = ">"
) -> Column:
    """Replace placeholders one after another, in the order of ``fields``.

    A later placeholder inside an earlier value is replaced too. A missing
    value becomes an empty string.
    """
    prompt = F.lit(template)  # a column stays as it is
    for name, value in fields.items():
        prompt = F.replace(
            prompt,
            F.lit(f"{opening}{name}{closing}"),
            F.coalesce(value.cast("string"), F.lit("")),
        )
    return prompt


def metadata_field(key: str, default: str | None = None) -> Column:
    value = F.try_element_at(F.col("metadata"), F.lit(key))
    return value if default is None else F.coalesce(value, F.lit(default))


def request(
    custom_id: Column,
    prompt: Column,
    model: str,
    max_tokens: int = MAX_OUTPUT_TOKENS,
    context_tokens: int = CONTEXT_TOKENS,
    cut: TokenCutter = keep_tokens,
) -> Column:
    """Nested chat request; a prompt over the context limit is cut to it."""
    message = F.struct(
        F.lit("user").alias("role"),
        cut(prompt, F.lit(context_tokens)).alias("content"),
    )
    body = F.struct(
        F.lit(model).alias("model"),
        F.array(message).alias("messages"),
        F.lit(max_tokens).alias("max_tokens"),
    )
    return F.struct(
        custom_id.cast("string").alias("custom_id"),
        F.lit(METHOD).alias("method"),
        F.lit(ENDPOINT).alias("url"),
        body.alias("body"),
    )


def request_line(record: Column) -> Column:
    return F.to_json(record, {"ignoreNullFields": "false"})
