"""Cleaning and token operators over all pages and documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelflow.bindings import derived as d
from labelflow.functions import text as X
from labelflow.sources.items import combine_text
from labelflow.storage import spread

TEMPLATE_TOKENS, BUDGET = 20, 150


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, title, text): web pages with their address, and documents."""
    pages = d.table(spark, sf_dir, "pages").select(
        F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("id"),
        F.col("url").alias("title"),
        F.concat_ws(" ", "html", "url").alias("text"),
    )
    documents = d.table(spark, sf_dir, "documents").select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"),
        F.col("source").alias("title"),
        F.when(F.col("doc_id") % 50 == 0, None)
        .when(F.col("doc_id") % 50 == 1, "")
        .otherwise(F.col("text"))
        .alias("text"),
    )
    return spread(pages.unionByName(documents))


def _query(out: Callable[[Column], Column], name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return texts(spark, sf_dir).select("id", out(F.col("text")).alias(name))

    return run


def truncate_to_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = X.keep_to_budget(
        F.coalesce("text", F.lit("")), F.col("title"), TEMPLATE_TOKENS, BUDGET
    )
    return texts(spark, sf_dir).select("id", cut.alias("text"))


def fill_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir).select(
        "id",
        X.fill_default(F.col("text"), "No Description").alias("text"),
        X.fill_default(F.col("title"), "No Title").alias("title"),
    )


def combine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null parts are skipped, empty parts are kept."""
    key = F.col("doc_id")
    rows = spread(d.table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.when(key % 3 > 0, F.concat(F.lit(" "), "text", F.lit("\n"))).alias("body"),
        F.when(key % 4 > 1, F.col("source")).when(key % 4 > 0, F.lit("")).alias("head"),
    )
    return rows.select(
        "doc_id", combine_text(rows, ["head", "absent", "body"], " | ").alias("text")
    )


def strip_echo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers that repeat their prompt, and answers that do not."""
    users, answers = d.turns(spark, sf_dir)
    pairs = users.join(answers, "id").withColumn(
        "response",
        F.when(
            F.col("turn") % 4 == 0,
            F.concat("prompt", F.lit("\n "), "completion", F.lit(" ")),
        ).otherwise(F.col("completion")),
    )
    return pairs.select(
        "id", X.strip_echo(F.col("response"), F.col("prompt")).alias("answer")
    )


def parse_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = d.table(spark, sf_dir, "conversations").where(F.col("role") == "assistant")
    return rows.select(
        "conv_id", "turn", F.array_join(X.parse_lines(F.col("text")), "~").alias("lines")
    )


QUERIES = {
    "remove_urls": _query(X.remove_urls, "text"),
    "remove_html": _query(X.remove_html, "text"),
    "normalize_ws": _query(X.normalize_whitespace, "text"),
    "truncate_chars": _query(lambda c: X.truncate_chars(c, 200), "text"),
    "min_length": _query(lambda c: X.blank_if_short(c, 400), "text"),
    "text_placeholder": _query(X.or_placeholder, "text"),
    "clean_text": _query(lambda c: X.clean_text(c, min_length=30), "text"),
    "token_count": _query(X.token_count, "n_tokens"),
    "truncate_tokens": _query(lambda c: X.keep_tokens(c, 100), "text"),
    "truncate_to_budget": truncate_to_budget,
    "fill_defaults": fill_defaults,
    "combine_text": combine,
    "strip_echo": strip_echo,
    "parse_lines": parse_lines,
}

TEXTS_SQL = """
texts AS (
  SELECT 'p' || page_id AS id, url AS title, html || ' ' || url AS text FROM pages
  UNION ALL
  SELECT 'd' || doc_id, source,
         CASE WHEN doc_id % 50 = 0 THEN NULL WHEN doc_id % 50 = 1 THEN '' ELSE text END
  FROM documents
)"""
_TOKEN = r"(?:[\p{L}\p{M}\p{N}_]+|[^\p{L}\p{M}\p{N}_" + d.WS_CLASS + "])"
_SPACED = f"[{d.WS_CLASS}]*{_TOKEN}"


def sql_tokens(x: str) -> str:
    return f"coalesce(len(regexp_extract_all({x}, '{_TOKEN}')), 0)"


def _sql_keep(x: str, n: str) -> str:
    return f"""CASE WHEN {sql_tokens(x)} > {n} THEN
      array_to_string(list_slice(regexp_extract_all({x}, '{_SPACED}'), 1, {n}), '')
      ELSE {x} END"""


def _sql_urls(x: str) -> str:
    return f"regexp_replace({x}, 'https?://[!$-_a-z]+', ' ', 'g')"


def _sql_html(x: str) -> str:
    return f"regexp_replace({x}, '<[^>]+>', ' ', 'g')"


def _sql_ws(x: str) -> str:
    return f"trim(regexp_replace({x}, '[{d.WS_CLASS}]+', ' ', 'g'), ' ')"


def _sql(expr: str, name: str = "text") -> str:
    return f"WITH {TEXTS_SQL} SELECT id, {expr} AS {name} FROM texts"


CLEAN = _sql_ws(_sql_html(_sql_urls("coalesce(nullif(text, ''), 'No text provided')")))

ORACLE = {
    "remove_urls": _sql(_sql_urls("text")),
    "remove_html": _sql(_sql_html("text")),
    "normalize_ws": _sql(_sql_ws("text")),
    "truncate_chars": _sql("substr(text, 1, 200)"),
    "min_length": _sql("CASE WHEN length(text) < 400 THEN '' ELSE text END"),
    "text_placeholder": _sql("coalesce(nullif(text, ''), 'No text provided')"),
    "clean_text": f"""WITH {TEXTS_SQL}, cleaned AS (SELECT id, {CLEAN} AS c FROM texts)
SELECT id, CASE WHEN length(c) < 30 THEN 'No text provided' ELSE c END AS text
FROM cleaned""",
    "token_count": _sql(f"CAST({sql_tokens('text')} AS INTEGER)", "n_tokens"),
    "truncate_tokens": _sql(_sql_keep("text", "100")),
    "truncate_to_budget": f"""WITH {TEXTS_SQL}, limited AS (
  SELECT id, coalesce(text, '') AS t,
         greatest({BUDGET - TEMPLATE_TOKENS} - {sql_tokens('title')}, 0) AS n FROM texts)
SELECT id, {_sql_keep('t', 'n')} AS text FROM limited""",
    "fill_defaults": f"""WITH {TEXTS_SQL}
SELECT id, coalesce(nullif(text, ''), 'No Description') AS text,
       coalesce(nullif(title, ''), 'No Title') AS title FROM texts""",
    "combine_text": f"""WITH parts AS (
  SELECT doc_id, CASE WHEN doc_id % 3 > 0 THEN {d.sql_strip("' ' || text || chr(10)")} END AS body,
         CASE WHEN doc_id % 4 > 1 THEN {d.sql_strip('source')}
              WHEN doc_id % 4 > 0 THEN '' END AS head
  FROM documents)
SELECT doc_id, CASE WHEN head IS NULL AND body IS NULL THEN 'No Description'
                    WHEN head IS NULL THEN body WHEN body IS NULL THEN head
                    ELSE head || ' | ' || body END AS text FROM parts""",
    "strip_echo": f"""WITH {d.PAIRS_SQL},
answered AS (SELECT *, CASE WHEN turn % 4 = 0
    THEN prompt || chr(10) || ' ' || completion || ' ' ELSE completion END AS response
  FROM pairs)
SELECT id, {d.sql_strip('''CASE WHEN starts_with(response, prompt)
  THEN substr(response, length(prompt) + 1) ELSE response END''')} AS answer
FROM answered""",
    "parse_lines": f"""SELECT conv_id, turn, array_to_string(list_filter(list_transform(
    string_split(text, chr(10)), lambda x: {d.sql_strip('x')}), lambda x: x <> ''), '~')
  AS lines FROM conversations WHERE role = 'assistant'""",
}
