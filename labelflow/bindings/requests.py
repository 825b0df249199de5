"""Items, prompts, requests and their files, from part."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelflow.bindings import derived as d
from labelflow.functions import prompts as P
from labelflow.operators import chunking as C
from labelflow.plans import export as E
from labelflow.sources import items as I
from labelflow.storage import scratch_dir, spread

TEMPLATE = (
    'Title: "<title>" Summary: "<abstract>" Pick <num_terms> of:\n<topics>\nThanks.'
)
ROWS, BYTES = 1_000, 100_000
# Between the shortest and the longest prompt of the parts.
CONTEXT_TOKENS = 33
CONFIGS = {
    "parts": {
        "text_columns": ["p_type", "p_note"],
        "id_column": "p_id",
        "metadata_mapping": {"p_name": "title", "p_brand": "brand"},
    }
}


def part_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part with some null titles, notes and ids, and titles with placeholders."""
    key = F.col("p_partkey")
    return spread(d.table(spark, sf_dir, "part")).select(
        "p_partkey",
        F.when(key % 13 > 0, key).alias("p_id"),
        F.when(key % 7 == 0, None)
        .when(key % 7 == 1, F.concat("p_name", F.lit(" <abstract>")))
        .otherwise(F.col("p_name"))
        .alias("p_name"),
        F.when(key % 5 > 0, F.col("p_brand")).alias("p_brand"),
        F.when(key % 4 > 0, F.lower("p_type")).alias("p_type"),
        F.when(
            key % 3 > 0, F.concat(F.lit("size "), F.col("p_size").cast("string"))
        ).alias("p_note"),
    )


PARTS_SQL = """
parts AS (
  SELECT p_partkey,
    CASE WHEN p_partkey % 13 > 0 THEN p_partkey END AS p_id,
    CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 7 = 1
         THEN p_name || ' <abstract>' ELSE p_name END AS p_name,
    CASE WHEN p_partkey % 5 > 0 THEN p_brand END AS p_brand,
    CASE WHEN p_partkey % 4 > 0 THEN lower(p_type) END AS p_type,
    CASE WHEN p_partkey % 3 > 0 THEN 'size ' || p_size END AS p_note
  FROM part
),
items AS (
  SELECT p_partkey, coalesce(CAST(p_id AS VARCHAR), '') AS id,
    CASE WHEN p_type IS NULL AND p_note IS NULL THEN 'No Description'
         ELSE concat_ws(' ', p_type, p_note) END AS text,
    p_name AS title, p_brand AS brand
  FROM parts
)"""


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = I.DatasetConfig.named(CONFIGS, "parts")
    return I.to_items(part_rows(spark, sf_dir), config)


def topic_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vocabulary of the prompts."""
    types = (
        d.table(spark, sf_dir, "part")
        .select(F.lower("p_type").alias("topic"))
        .distinct()
    )
    return types


def extract_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = part_rows(spark, sf_dir)
    pairs = F.map_entries(
        I.extract_metadata(rows, {"p_name": "title", "p_brand": "brand", "x": "y"})
    )
    text = F.array_join(
        F.transform(
            F.array_sort(pairs), lambda e: F.concat_ws("=", e["key"], e["value"])
        ),
        "~",
    )
    return rows.select("p_partkey", text.alias("metadata"))


def assign_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequential ids in the order of name and key."""
    rows = part_rows(spark, sf_dir)
    out = I.assign_ids(rows, None, [F.col("p_name").asc_nulls_first(), "p_partkey"])
    return out.select("item_id", "p_partkey")


def source_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = I.source_check(part_rows(spark, sf_dir), "part", "p_id")
    for name, key in (("documents", "doc_id"), ("pages", "page_id")):
        check = I.source_check(d.table(spark, sf_dir, name), name, key)
        parts = parts.unionByName(check)
    return parts


def mapped_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A named mapping, and the fallback mapping for an unknown name."""
    named = items(spark, sf_dir)
    other = d.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id_"),
        F.col("source").alias("name"),
        F.col("text").alias("description"),
    )
    fallback = I.DatasetConfig.named(CONFIGS, "other")
    other = I.to_items(other, fallback, order=["id_"])
    return named.unionByName(other).select(
        "id",
        "text",
        P.metadata_field("title").alias("title"),
        P.metadata_field("brand").alias("brand"),
    )


def _template(spark: SparkSession, sf_dir: str, **values: object) -> Column:
    """The job's template; a vocabulary of any length becomes a part of it."""
    topics = P.topic_lines(topic_table(spark, sf_dir))
    return P.fill(P.format_template(TEMPLATE, ["<topics>"], **values), {"topics": topics})


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = {
        "title": P.metadata_field("title"),
        "abstract": F.col("text"),
        "brand": P.metadata_field("brand"),
    }
    template = _template(spark, sf_dir, num_terms=3)
    return items(spark, sf_dir).withColumn("prompt", P.fill(template, fields))


def format_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job template next to each part, with the key as a further value."""
    template = _template(spark, sf_dir)
    return part_rows(spark, sf_dir).select(
        "p_partkey", P.fill(template, {"num_terms": F.col("p_partkey")}).alias("template")
    )


def format_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prompts(spark, sf_dir).select("id", "prompt")


def format_prompt_bullets(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = {
        "text": F.col("text"),
        "categories": P.topic_lines(topic_table(spark, sf_dir), mark="- "),
    }
    prompt = P.fill("Text: {text}\nOptions:\n{categories}", fields, "{", "}")
    return items(spark, sf_dir).select("id", prompt.alias("prompt"))


def format_prompt_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = {"title": P.metadata_field("title", "No Title"), "abstract": F.col("text")}
    return items(spark, sf_dir).select(
        "id", P.fill("<title>: <abstract>", fields).alias("prompt")
    )


def build_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of all parts; the longer half of the prompts is cut."""
    record = P.request(
        F.col("id"), F.col("prompt"), "gpt-4.1-nano", context_tokens=CONTEXT_TOKENS
    )
    return prompts(spark, sf_dir).select("id", P.request_line(record).alias("line"))


def request_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items under the part's own key; the text of every 997th is very long."""
    rows, config = part_rows(spark, sf_dir), I.DatasetConfig.named(CONFIGS, "parts")
    text = I.combine_text(rows, config.text_columns)
    long = F.when(F.col("p_partkey") % 997 == 5, F.repeat(text, F.lit(9_000))).otherwise(text)
    return rows.select(
        "p_partkey",
        F.col("p_partkey").cast("string").alias("id"),
        long.alias("text"),
        I.extract_metadata(rows, config.metadata_mapping).alias("metadata"),
    )


def _with_line(spark: SparkSession, sf_dir: str):
    """A step that renders an item's request: template, title and text."""
    fields = {"title": P.metadata_field("title"), "abstract": F.col("text")}
    prompt = P.fill(_template(spark, sf_dir, num_terms=3), fields)
    record = P.request(F.col("id"), F.col("prompt"), "gpt-4.1-nano")
    return lambda rows: rows.withColumn("prompt", prompt).withColumn(
        "line", P.request_line(record)
    ).drop("prompt")


def chunk_by_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = request_items(spark, sf_dir).select("p_partkey")
    return C.chunk_by_count(rows, ["p_partkey"], ROWS).select("p_partkey", "pos", "chunk")


def chunk_by_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of whole requests; only key, position and size are grouped."""
    lines = request_items(spark, sf_dir).transform(_with_line(spark, sf_dir))
    sizes = lines.select("p_partkey", F.octet_length("line").cast("long").alias("nbytes"))
    sized = C.chunk_by_count(sizes, ["p_partkey"], ROWS)
    return C.chunk_by_bytes(sized, BYTES).select("p_partkey", "pos", "first_pos")


def exported(spark: SparkSession, sf_dir: str, path: str) -> E.Exported:
    return E.export_requests(
        request_items(spark, sf_dir), _with_line(spark, sf_dir), ["p_partkey"], path,
        ROWS, BYTES,
    )


def chunk_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exported(spark, sf_dir, scratch_dir(spark)).summary


def sink_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the request files, then read their lines back with the file's name."""
    path = scratch_dir(spark)
    exported(spark, sf_dir, path)
    return spark.read.text(f"{path}/requests").select(
        F.get_json_object("value", "$.custom_id").alias("custom_id"),
        F.col("first_pos").cast("long").alias("first_pos"),
        F.col("value").alias("line"),
    )


def rejected_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests over the limit, as written next to the request files."""
    path = scratch_dir(spark)
    exported(spark, sf_dir, path)
    return spark.read.schema("custom_id string, nbytes long").json(f"{path}/rejected")


def sample_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten items chosen by a seeded hash: the same ten on every run."""
    rows = d.table(spark, sf_dir, "part").select("p_partkey", "p_name")
    order = F.md5(F.concat(F.lit("seed-1-"), F.col("p_partkey").cast("string")))
    return rows.orderBy(order, "p_partkey").limit(10)


QUERIES = {
    "extract_metadata": extract_metadata,
    "assign_ids": assign_ids,
    "source_check": source_check,
    "mapped_items": mapped_items,
    "format_template": format_template,
    "format_prompt": format_prompt,
    "format_prompt_bullets": format_prompt_bullets,
    "format_prompt_defaults": format_prompt_defaults,
    "build_requests": build_requests,
    "chunk_by_count": chunk_by_count,
    "chunk_by_bytes": chunk_by_bytes,
    "chunk_summary": chunk_summary,
    "sink_requests": sink_requests,
    "rejected_requests": rejected_requests,
    "sample_n": sample_n,
}

_TYPES_SQL = """types AS (
  SELECT string_agg(t, chr(10) ORDER BY t) AS listed,
         string_agg('- ' || t, chr(10) ORDER BY t) AS bullets
  FROM (SELECT DISTINCT lower(p_type) AS t FROM part)
)"""
_TEMPLATE_SQL = "'" + TEMPLATE.replace("\n", "' || chr(10) || '") + "'"
_FILLED_SQL = (
    f"replace(replace({_TEMPLATE_SQL}, '<topics>', listed), '<num_terms>', '3')"
)
PROMPTS_SQL = f"""{PARTS_SQL}, {_TYPES_SQL},
prompts AS (
  SELECT p_partkey, id, replace(replace(replace({_FILLED_SQL},
    '<title>', coalesce(title, '')), '<abstract>', text), '<brand>', coalesce(brand, ''))
    AS prompt
  FROM items, types
)"""


def sql_request(custom_id: str, prompt: str) -> str:
    return f"""CAST(to_json({{'custom_id': CAST({custom_id} AS VARCHAR), 'method': 'POST',
  'url': '/v1/chat/completions', 'body': {{'model': 'gpt-4.1-nano',
  'messages': [{{'role': 'user', 'content': {prompt}}}], 'max_tokens': 248}}}}) AS VARCHAR)"""


_SIZED_SQL = f"""{PARTS_SQL}, {_TYPES_SQL},
lines AS (
  SELECT p_partkey, {sql_request('p_partkey', f"""replace(replace({_FILLED_SQL}, '<title>',
    coalesce(title, '')), '<abstract>',
    CASE WHEN p_partkey % 997 = 5 THEN repeat(text, 9000) ELSE text END)""")} AS line
  FROM items, types
),
sized AS (
  SELECT p_partkey, line, octet_length(encode(line)) AS nbytes,
         row_number() OVER (ORDER BY p_partkey) - 1 AS pos,
         (row_number() OVER (ORDER BY p_partkey) - 1) // {ROWS} AS chunk
  FROM lines
)"""
_ASSIGNED_SQL = f"""{_SIZED_SQL},
prefix AS (
  SELECT pos + 1 AS at, sum(nbytes) OVER (ORDER BY pos) AS total FROM sized
  UNION ALL SELECT 0, 0
),
ranges(low, high) AS (
  SELECT min(pos), max(pos) + 1 FROM sized GROUP BY chunk
  UNION ALL
  SELECT unnest([low, low + (high - low) // 2]), unnest([low + (high - low) // 2, high])
  FROM ranges JOIN prefix a ON a.at = low JOIN prefix b ON b.at = high
  WHERE b.total - a.total + high - low - 1 > {BYTES} AND high - low > 1
),
fits AS (
  SELECT low, high FROM ranges JOIN prefix a ON a.at = low JOIN prefix b ON b.at = high
  WHERE b.total - a.total + high - low - 1 <= {BYTES}
),
assigned AS (
  SELECT p_partkey, line, nbytes, chunk, pos, low AS first_pos
  FROM sized LEFT JOIN fits ON pos >= low AND pos < high
)"""
_ASSIGNED_SQL = "RECURSIVE " + _ASSIGNED_SQL

_SPLIT_TOKENS = r"[\s]*(?:[\p{L}\p{M}\p{N}_]+|[^\p{L}\p{M}\p{N}_\s])"
ORACLE = {
    "extract_metadata": f"""WITH {PARTS_SQL}
SELECT p_partkey, concat_ws('~', 'brand=' || p_brand, 'title=' || p_name) AS metadata
FROM parts""",
    "assign_ids": f"""WITH {PARTS_SQL}
SELECT CAST(row_number() OVER (ORDER BY p_name NULLS FIRST, p_partkey) - 1 AS VARCHAR)
  AS item_id, p_partkey FROM parts""",
    "source_check": f"""WITH {PARTS_SQL}
SELECT 'part' AS source, count(*) AS n_rows, count(*) - count(p_id) AS n_null_ids,
       count(*) > 0 AS valid FROM parts
UNION ALL SELECT 'documents', count(*), count(*) - count(doc_id), count(*) > 0 FROM documents
UNION ALL SELECT 'pages', count(*), count(*) - count(page_id), count(*) > 0 FROM pages""",
    "mapped_items": f"""WITH {PARTS_SQL}
SELECT id, text, title, brand FROM items
UNION ALL SELECT CAST(row_number() OVER (ORDER BY doc_id) - 1 AS VARCHAR),
  {d.sql_strip('text')}, source, NULL FROM documents""",
    "format_template": f"""WITH {_TYPES_SQL}
SELECT p_partkey, replace(replace({_TEMPLATE_SQL}, '<topics>', listed), '<num_terms>',
  CAST(p_partkey AS VARCHAR)) AS template FROM part, types""",
    "format_prompt": f"WITH {PROMPTS_SQL} SELECT id, prompt FROM prompts",
    "format_prompt_bullets": f"""WITH {PARTS_SQL}, {_TYPES_SQL}
SELECT id, 'Text: ' || text || chr(10) || 'Options:' || chr(10) || bullets AS prompt
FROM items, types""",
    "format_prompt_defaults": f"""WITH {PARTS_SQL}
SELECT id, replace(coalesce(title, 'No Title') || ': <abstract>', '<abstract>', text)
  AS prompt FROM items""",
    "build_requests": f"""WITH {PROMPTS_SQL}, cut AS (
  SELECT id, array_to_string(list_slice(
    regexp_extract_all(prompt, '{_SPLIT_TOKENS}'), 1, {CONTEXT_TOKENS}), '') AS p FROM prompts)
SELECT id, {sql_request('id', 'p')} AS line FROM cut""",
    "chunk_by_count": f"WITH {_SIZED_SQL} SELECT p_partkey, pos, chunk FROM sized",
    "chunk_by_bytes": f"""WITH {_ASSIGNED_SQL}
SELECT p_partkey, pos, first_pos FROM assigned""",
    "chunk_summary": f"""WITH {_ASSIGNED_SQL}
SELECT first_pos, count(*) AS chunk_size,
       CAST(sum(nbytes) + count(*) - 1 AS BIGINT) AS n_bytes,
       (SELECT max(chunk) + 1 FROM sized) AS total_chunks
FROM assigned GROUP BY first_pos""",
    "sink_requests": f"""WITH {_ASSIGNED_SQL}
SELECT CAST(p_partkey AS VARCHAR) AS custom_id, first_pos, line
FROM assigned WHERE first_pos IS NOT NULL""",
    "rejected_requests": f"""WITH {_ASSIGNED_SQL}
SELECT CAST(p_partkey AS VARCHAR) AS custom_id, CAST(nbytes AS BIGINT) AS nbytes
FROM assigned WHERE first_pos IS NULL""",
    "sample_n": """SELECT p_partkey, p_name FROM part
ORDER BY md5('seed-1-' || p_partkey), p_partkey LIMIT 10""",
}
