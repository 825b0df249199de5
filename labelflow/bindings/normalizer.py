"""Response normalization over lineitem-derived responses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelflow.bindings import derived as d
from labelflow.functions import labels as L
from labelflow.operators import matching as M
from labelflow.plans import normalize as N


def _joined(array: str):
    return F.array_join(array, "~").alias(array)


def _element_query(out):
    """One output column per response: a string or a '~'-joined list."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = d.responses(spark, sf_dir)
        return rows.select("id", out(F.col("raw_response")))

    return run


split_tabs = _element_query(
    lambda raw: F.array_join(L.split_tabs(raw), "~").alias("tabs")
)
mask_commas = _element_query(lambda raw: L.mask_commas(raw).alias("masked"))
split_labels = _element_query(
    lambda raw: F.array_join(L.split_separators(raw), "~").alias("pieces")
)
strip_label_prefix = _element_query(
    lambda raw: L.strip_label_prefix(raw).alias("stripped")
)
quoted_segments = _element_query(
    lambda raw: F.array_join(L.quoted_segments(raw), "~").alias("segments")
)
label_list = _element_query(
    lambda raw: F.array_join(L.label_list(raw), "~").alias("labels")
)


def protect_labels(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """Responses without quotes, so that only protection keeps comma labels whole."""
    rows = d.responses(spark, sf_dir).withColumn(
        "raw_response", F.translate("raw_response", '"', "")
    )
    out = N.protected_labels(rows, M.Vocabulary.of(d.topics(spark, sf_dir), **options))
    return out.select("id", _joined("labels"))


def protect_labels_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a vocabulary that is not held in the plan."""
    return protect_labels(spark, sf_dir, inline_limit=0)


def unexpected_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.unexpected_labels(
        d.responses(spark, sf_dir), d.vocabulary(spark, sf_dir)
    )


def partition_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = N.partition_labels(d.responses(spark, sf_dir), d.vocabulary(spark, sf_dir))
    return rows.select("id", _joined("valid"), _joined("misses"))


def _misses(spark: SparkSession, sf_dir: str, vocabulary: M.Vocabulary) -> DataFrame:
    rows = N.with_labels(d.responses(spark, sf_dir))
    return N.distinct_misses(rows, vocabulary)


def _matches(kinds: tuple[int, ...]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        vocabulary = d.vocabulary(spark, sf_dir)
        return M.match_misses(_misses(spark, sf_dir, vocabulary), vocabulary, kinds)

    return run


fuzzy_topics = _matches((M.TOPIC_EDIT,))
fuzzy_synonyms = _matches((M.SYNONYM_EDIT,))
token_fallback = _matches((M.TOPIC_TOKEN, M.SYNONYM_TOKEN))
match_misses = _matches((M.TOPIC_EDIT, M.SYNONYM_EDIT, M.TOPIC_TOKEN, M.SYNONYM_TOKEN))


def _results(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return N.normalize(
        d.responses(spark, sf_dir), d.vocabulary(spark, sf_dir), **options
    )


def normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _results(spark, sf_dir).select(
        "id", _joined("categories"), _joined("hallucinations")
    )


def normalize_by_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same result through the plan for large vocabularies."""
    vocabulary = M.Vocabulary.of(
        d.topics(spark, sf_dir), d.synonyms(spark, sf_dir), inline_limit=0
    )
    out = N.normalize(d.responses(spark, sf_dir), vocabulary)
    return out.select("id", _joined("categories"), _joined("hallucinations"))


def append_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rescue rows whose labels all missed; keep each category once."""
    out = _results(spark, sf_dir, rescue_all_miss=True, distinct_categories=True)
    return out.select("id", _joined("categories"))


def top_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.top_labels(_results(spark, sf_dir), 20)


QUERIES = {
    "split_tabs": split_tabs,
    "mask_commas": mask_commas,
    "split_labels": split_labels,
    "strip_label_prefix": strip_label_prefix,
    "quoted_segments": quoted_segments,
    "label_list": label_list,
    "protect_labels": protect_labels,
    "protect_labels_large": protect_labels_large,
    "unexpected_labels": unexpected_labels,
    "partition_labels": partition_labels,
    "fuzzy_topics": fuzzy_topics,
    "fuzzy_synonyms": fuzzy_synonyms,
    "token_fallback": token_fallback,
    "match_misses": match_misses,
    "append_matches": append_matches,
    "normalize": normalize,
    "normalize_by_list": normalize_by_list,
    "top_labels": top_labels,
}

BARE = "replace(replace(x, '.', ''), '\"', '')"

# labels -> valid, misses (distinct, first place kept)
def partition_sql(responses: str) -> str:
    """CTEs over a ``responses(id, raw_response)`` CTE given as SQL."""
    return f"""
{d.TOPICS_SQL}, {responses}, {d.labels_sql()},
numbered AS (SELECT id, labels, row_number() OVER () AS rid FROM labels),
exploded AS (
  SELECT rid, unnest(labels) AS x, generate_subscripts(labels, 1) AS i
  FROM numbered WHERE len(labels) > 0
),
looked AS (
  SELECT rid, x, i, {BARE} AS b, {BARE} IN (SELECT topic FROM topics) AS known
  FROM exploded
),
kept AS (
  SELECT rid, list(x ORDER BY i) AS valid FROM looked WHERE known GROUP BY rid
),
missed AS (SELECT rid, b, min(i) AS i FROM looked WHERE NOT known GROUP BY rid, b)"""


PARTITION_SQL = partition_sql(d.RESPONSES_SQL)

# distinct misses -> best match by brute force over the whole vocabulary
MATCH_SQL = """
distinct_misses AS (SELECT DISTINCT b AS miss FROM missed),
candidates AS (
  SELECT miss, 0 AS rank, levenshtein(miss, topic) AS d, pos, topic AS label
  FROM distinct_misses, topics WHERE levenshtein(miss, topic) BETWEEN 1 AND 2
  UNION ALL
  SELECT miss, 1, levenshtein(miss, synonym), pos, label
  FROM distinct_misses, synonyms WHERE levenshtein(miss, synonym) <= 1
  UNION ALL
  SELECT miss, 2, levenshtein(miss, topic), pos, topic FROM distinct_misses, topics
  WHERE list_contains(string_split(lower(miss), ' '), lower(topic))
  UNION ALL
  SELECT miss, 3, levenshtein(miss, synonym), pos, label FROM distinct_misses, synonyms
  WHERE list_contains(string_split(lower(miss), ' '), lower(synonym))
)"""


def _match_sql(ranks: str) -> str:
    return f"""WITH {PARTITION_SQL}, {MATCH_SQL}
SELECT miss, label, CASE rank WHEN 0 THEN 'topic' WHEN 1 THEN 'synonym'
         WHEN 2 THEN 'topic token' ELSE 'synonym token' END AS kind, CAST(d AS INTEGER) AS distance
FROM candidates WHERE rank IN ({ranks})
QUALIFY row_number() OVER (PARTITION BY miss ORDER BY rank, d, pos) = 1"""


BEST_SQL = """
best AS (
  SELECT miss, label FROM candidates
  QUALIFY row_number() OVER (PARTITION BY miss ORDER BY rank, d, pos) = 1
),
miss_lists AS (
  SELECT rid, list(b ORDER BY i) AS misses,
         list(label ORDER BY i) FILTER (WHERE label IS NOT NULL) AS matched
  FROM missed LEFT JOIN best ON miss = b GROUP BY rid
),
merged AS (
  SELECT id, labels, coalesce(valid, []) AS valid, coalesce(misses, []) AS misses,
         coalesce(matched, []) AS matched
  FROM numbered LEFT JOIN kept USING (rid) LEFT JOIN miss_lists USING (rid)
)"""

def normalize_sql(responses: str) -> str:
    return f"""WITH {partition_sql(responses)}, {MATCH_SQL}, {BEST_SQL}
SELECT id,
  array_to_string(CASE WHEN len(valid) > 0 THEN list_concat(valid, matched)
    ELSE [] END, '~') AS categories,
  CASE WHEN len(labels) > 0 THEN array_to_string(misses, '~') END AS hallucinations
FROM merged"""


NORMALIZE_SQL = normalize_sql(d.RESPONSES_SQL)


def _element_sql(expr: str, name: str) -> str:
    return f"WITH {d.RESPONSES_SQL} SELECT id, {expr} AS {name} FROM responses"


PROTECT_SQL = f"""WITH {d.TOPICS_SQL}, {d.RESPONSES_SQL},
entries AS (
  SELECT list(topic ORDER BY length(topic) DESC, topic DESC) AS e
  FROM topics WHERE contains(topic, ',')
),
unquoted AS (
  SELECT id, list_reduce(list_prepend(replace(raw_response, '"', ''), e),
      lambda t, w: replace(t, w, replace(w, ',', chr(57344)))) AS raw_response
  FROM responses, entries
), {d.labels_sql('unquoted')}
SELECT id, replace(array_to_string(labels, '~'), chr(57344), ',') AS labels
FROM labels"""

ORACLE = {
    "split_tabs": _element_sql(
        f"array_to_string({d.sql_tabs('raw_response')}, '~')", "tabs"
    ),
    "mask_commas": _element_sql(d.sql_mask("raw_response"), "masked"),
    "split_labels": _element_sql(
        f"array_to_string({d.sql_pieces('raw_response')}, '~')", "pieces"
    ),
    "strip_label_prefix": _element_sql(
        r"regexp_replace(raw_response, 'Category \d+:', '', 'g')", "stripped"
    ),
    "quoted_segments": _element_sql(
        f"array_to_string({d.sql_segments('raw_response')}, '~')", "segments"
    ),
    "label_list": f"""WITH {d.RESPONSES_SQL}, {d.labels_sql()}
SELECT id, array_to_string(labels, '~') AS labels FROM labels""",
    "protect_labels": PROTECT_SQL,
    "protect_labels_large": PROTECT_SQL,
    "unexpected_labels": f"""WITH {d.TOPICS_SQL}, {d.RESPONSES_SQL}, {d.labels_sql()}
SELECT id, labels[1] AS label FROM labels
WHERE len(labels) = 1 AND NOT contains(labels[1], '"') AND contains(labels[1], ' ')
  AND labels[1] NOT IN (SELECT topic FROM topics)""",
    "partition_labels": f"""WITH {PARTITION_SQL},
miss_lists AS (SELECT rid, list(b ORDER BY i) AS misses FROM missed GROUP BY rid)
SELECT id, coalesce(array_to_string(valid, '~'), '') AS valid,
  CASE WHEN len(labels) > 0 THEN coalesce(array_to_string(misses, '~'), '') END AS misses
FROM numbered LEFT JOIN kept USING (rid) LEFT JOIN miss_lists USING (rid)""",
    "fuzzy_topics": _match_sql("0"),
    "fuzzy_synonyms": _match_sql("1"),
    "token_fallback": _match_sql("2, 3"),
    "match_misses": _match_sql("0, 1, 2, 3"),
    "append_matches": f"""WITH {PARTITION_SQL}, {MATCH_SQL}, {BEST_SQL}
SELECT id, array_to_string(list_transform(list_filter(
    list_transform(list_concat(valid, matched), lambda x, i: {{'x': x, 'i': i}}),
    lambda e: list_position(list_concat(valid, matched), e.x) = e.i),
    lambda e: e.x), '~') AS categories
FROM merged""",
    "normalize": NORMALIZE_SQL,
    "normalize_by_list": NORMALIZE_SQL,
    "top_labels": f"""WITH {PARTITION_SQL}, {MATCH_SQL}, {BEST_SQL},
cats AS (
  SELECT unnest(list_concat(valid, matched)) AS label FROM merged WHERE len(valid) > 0
)
SELECT label, count(*) AS n_rows FROM cats GROUP BY label
ORDER BY n_rows DESC, label LIMIT 20""",
}
