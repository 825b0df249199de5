"""Inputs derived from the test tables, in Spark and in SQL side by side.

Nothing here groups by a raw key: every derived row comes from one table row
(plus its part), so no hot key can gather rows in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelflow.operators.matching import Vocabulary
from labelflow.storage import spread

AS_OF = "2024-02-01 00:00:00"

WS_SQL = (
    "chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)"
    "||chr(32)||chr(133)||chr(160)||chr(5760)||chr(8192)||chr(8193)||chr(8194)"
    "||chr(8195)||chr(8196)||chr(8197)||chr(8198)||chr(8199)||chr(8200)||chr(8201)"
    "||chr(8202)||chr(8232)||chr(8233)||chr(8239)||chr(8287)||chr(12288)"
)
WS_CLASS = (
    r"\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)


def sql_strip(expr: str) -> str:
    return f"trim({expr}, {WS_SQL})"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- vocabulary -----------------------------------------------------------

TOPICS_SQL = """
topics AS (
  SELECT DISTINCT topic, topic AS pos FROM (
    SELECT p_name AS topic FROM part
    UNION ALL SELECT lower(p_type) FROM part
    UNION ALL SELECT lower(p_type) || ', ' || split_part(p_name, ' ', 1) FROM part
  )
),
synonyms AS (
  SELECT DISTINCT synonym, synonym AS pos, label FROM (
    SELECT split_part(p_name, ' ', 2) || ' ' || split_part(p_name, ' ', 1) AS synonym,
           p_name AS label FROM part
    UNION ALL
    SELECT CASE split_part(p_name, ' ', 1) WHEN 'large' THEN 'jumbo' ELSE 'tiny' END,
           split_part(p_name, ' ', 1)
    FROM part WHERE split_part(p_name, ' ', 1) IN ('large', 'small')
  )
)"""


def _first(name: Column) -> Column:
    return F.split_part(name, F.lit(" "), F.lit(1))


def _second(name: Column) -> Column:
    return F.split_part(name, F.lit(" "), F.lit(2))


def topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, kind = F.col("p_name"), F.lower("p_type")
    return (
        table(spark, sf_dir, "part")
        .select(
            F.explode(
                F.array(name, kind, F.concat(kind, F.lit(", "), _first(name)))
            ).alias("topic")
        )
        .distinct()
        .select(F.col("topic").alias("pos"), "topic")
    )


def synonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("p_name")
    swapped = F.struct(
        F.concat_ws(" ", _second(name), _first(name)).alias("synonym"),
        name.alias("label"),
    )
    size = F.struct(
        F.when(_first(name) == "large", "jumbo")
        .when(_first(name) == "small", "tiny")
        .alias("synonym"),
        _first(name).alias("label"),
    )
    return (
        table(spark, sf_dir, "part")
        .select(F.inline(F.array(swapped, size)))
        .where(F.col("synonym").isNotNull())
        .distinct()
        .select(F.col("synonym").alias("pos"), "synonym", "label")
    )


def vocabulary(spark: SparkSession, sf_dir: str) -> Vocabulary:
    return Vocabulary.of(topics(spark, sf_dir), synonyms(spark, sf_dir))


# --- model responses ------------------------------------------------------

_SPECIAL = [
    None,
    "",
    "ned rod",
    "red rod, a jumbo thing",
    "Category 1: hot rod",
    'Category 2: "large, blue"',
    "hot-rod",
    'half "open rod, new rod',
    "old rod, old rodd, old rodx, old rod.",
    "small. economy",
]


def _variants() -> Column:
    """The label forms that depend on the part alone."""
    name, kind = F.col("p_name"), F.lower("p_type")
    swapped = F.concat_ws(" ", _second(name), _first(name))
    return F.array(
        name,
        F.left(name, F.length(name) - 1),
        F.concat(name, F.lit("xx")),
        swapped,
        F.concat(swapped, F.lit("s")),
        F.concat(F.lit("about "), kind, F.lit(" matters")),
        F.concat(F.lit('"'), kind, F.lit(", "), _first(name), F.lit('"')),
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, raw_response): one to three labels about the part of each line."""
    lines = spread(
        table(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"
        )
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", _variants().alias("v"))
    k = F.col("l_linenumber") + F.col("l_partkey")

    def label(case: Column) -> Column:
        return F.coalesce(
            F.get("v", case.cast("int")), F.concat(F.lit("unknown label "), "l_linenumber")
        )

    separator = F.element_at(
        F.array(*[F.lit(s) for s in ("\t", ", ", "; ", "\n", " | ")]),
        (F.col("l_orderkey") % 5 + 1).cast("int"),
    )
    n, size = F.col("l_orderkey") % 101, F.col("l_suppkey") % 3
    response = F
    for i, text in enumerate(_SPECIAL):
        response = response.when(n == i, F.lit(text))
    a, b, c = label(k % 8), label((k + 3) % 8), label((k * 5) % 8)
    response = (
        response.when(size == 0, a)
        .when(size == 1, F.concat(a, separator, b))
        .otherwise(F.concat(a, separator, b, separator, c))
    )
    return lines.join(parts, lines.l_partkey == parts.p_partkey).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias(
            "id"
        ),
        response.alias("raw_response"),
    )


def _sql_text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _sql_label(k: str) -> str:
    return f"""CASE {k}
      WHEN 0 THEN p_name
      WHEN 1 THEN substr(p_name, 1, length(p_name) - 1)
      WHEN 2 THEN p_name || 'xx'
      WHEN 3 THEN split_part(p_name, ' ', 2) || ' ' || split_part(p_name, ' ', 1)
      WHEN 4 THEN split_part(p_name, ' ', 2) || ' ' || split_part(p_name, ' ', 1) || 's'
      WHEN 5 THEN 'about ' || lower(p_type) || ' matters'
      WHEN 6 THEN '"' || lower(p_type) || ', ' || split_part(p_name, ' ', 1) || '"'
      ELSE 'unknown label ' || l_linenumber END"""


RESPONSES_SQL = f"""
labelled AS (
  SELECT l_orderkey, l_suppkey,
         l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS id,
         {_sql_label('(l_linenumber + l_partkey) % 8')} AS a,
         {_sql_label('(l_linenumber + l_partkey + 3) % 8')} AS b,
         {_sql_label('((l_linenumber + l_partkey) * 5) % 8')} AS c,
         CASE l_orderkey % 5 WHEN 0 THEN chr(9) WHEN 1 THEN ', ' WHEN 2 THEN '; '
              WHEN 3 THEN chr(10) ELSE ' | ' END AS sep
  FROM lineitem JOIN part ON l_partkey = p_partkey
),
responses AS (
  SELECT id, CASE
    {' '.join(f"WHEN l_orderkey % 101 = {i} THEN {_sql_text(s)}" for i, s in enumerate(_SPECIAL))}
    WHEN l_suppkey % 3 = 0 THEN a
    WHEN l_suppkey % 3 = 1 THEN a || sep || b
    ELSE a || sep || b || sep || c END AS raw_response
  FROM labelled
)"""

# The separators of ``functions.labels``, as DuckDB spells them.
SEP_REGEX = (
    r"    |   |  |\n|<TAB>|TAB|<tab>|\(tab\)|<Tab>|\[tab\]|\x{25aa}\x{fe0f}|\(Tab\)"
    r"|\x{a0}\x{a0}\x{a0}\x{a0}|\x{a0}|\x{2003}|\x{3001}|\x0b|\x0c|;|\.|--|-|\x{2013}"
    r"|_|\\|\\n|/|@|\||\r|\+|<|>|\x{b7}"
)


def sql_tabs(x: str) -> str:
    return f"list_transform(string_split({x}, chr(9)), lambda t: {sql_strip('t')})"


def sql_mask(x: str) -> str:
    """Comma masking over one text."""
    return f"""array_to_string(list_transform(string_split({x}, '"'), lambda s, i:
      CASE WHEN (len(string_split({x}, '"')) - i) % 2 = 0 THEN replace(s, ',', '|')
           ELSE s END), '"')"""


def sql_pieces(x: str) -> str:
    return f"""list_filter(list_transform(regexp_split_to_array({x}, '{SEP_REGEX}'),
      lambda y: {sql_strip('y')}), lambda y: y <> '')"""


def sql_segments(x: str) -> str:
    return f"""CASE WHEN contains({x}, '"') THEN regexp_extract_all({x}, '[^"]+|"[^"]+"')
      ELSE list_transform(string_split({x}, ','), lambda y: {sql_strip('y')}) END"""


def labels_sql(source: str = "responses", keep: str = "id, raw_response") -> str:
    """CTE chain ending in ``labels(keep, labels)`` over ``source``."""
    return f"""
tabbed AS (SELECT {keep}, {sql_tabs('raw_response')} AS l FROM {source}),
masked AS (SELECT * REPLACE (list_transform(l, lambda m: {sql_mask('m')}) AS l) FROM tabbed),
pieced AS (SELECT * REPLACE (flatten(list_transform(l, lambda p: {sql_pieces('p')})) AS l)
           FROM masked),
plain AS (SELECT * REPLACE (list_transform(l, lambda c:
            regexp_replace(c, 'Category \\d+:', '', 'g')) AS l) FROM pieced),
labels AS (SELECT * EXCLUDE (l), flatten(list_transform(l, lambda q: {sql_segments('q')}))
             AS labels FROM plain)"""


# --- conversations --------------------------------------------------------

PAIRS_SQL = """
pairs AS (
  SELECT u.conv_id, u.turn, u.conv_id || '-' || u.turn AS id, u.text AS prompt,
         a.text AS completion
  FROM conversations u JOIN conversations a
    ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
  WHERE u.role = 'user'
)"""

MODEL_SQL = """CASE conv_id % 5 WHEN 0 THEN 'gpt-4o' WHEN 1 THEN 'gpt-4o-mini'
  WHEN 2 THEN 'gpt-4.1' WHEN 3 THEN 'gpt-4.1-nano' ELSE 'other-model' END"""


def turns(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """User turns (id, conv_id, turn, prompt) and answers (id, completion)."""
    rows = table(spark, sf_dir, "conversations")
    users = rows.where(F.col("role") == "user").select(
        F.concat_ws("-", "conv_id", "turn").alias("id"),
        "conv_id",
        "turn",
        F.col("text").alias("prompt"),
    )
    answers = rows.where(F.col("role") == "assistant").select(
        F.concat_ws("-", "conv_id", (F.col("turn") - 1).cast("string")).alias("id"),
        F.col("text").alias("completion"),
    )
    return users, answers


def model_name() -> Column:
    names = ["gpt-4o", "gpt-4o-mini", "gpt-4.1", "gpt-4.1-nano", "other-model"]
    return F.get(
        F.array(*[F.lit(n) for n in names]), (F.col("conv_id") % 5).cast("int")
    )


# --- batch ledger ---------------------------------------------------------

STATUSES = [
    "validating", "in_progress", "finalizing", "cancelling",
    "completed", "failed", "cancelled", "expired",
]


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(batch_id, status, created_at, n_results) from orders."""
    key = F.col("o_orderkey")
    created = F.expr(
        f"timestamp_ntz'{AS_OF}' - make_dt_interval(0, 0, cast(o_orderkey % 2000 as int), 0)"
    )
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("batch_"), key.cast("string")).alias("batch_id"),
        F.get(F.array(*[F.lit(s) for s in STATUSES]), (key % 8).cast("int")).alias(
            "status"
        ),
        created.alias("created_at"),
        (key % 11).alias("n_results"),
    )


LEDGER_SQL = f"""
ledger AS (
  SELECT 'batch_' || o_orderkey AS batch_id,
         CASE o_orderkey % 8 {' '.join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(STATUSES))}
           END AS status,
         TIMESTAMP '{AS_OF}' - to_minutes(CAST(o_orderkey % 2000 AS BIGINT)) AS created_at,
         o_orderkey % 11 AS n_results
  FROM orders
)"""
