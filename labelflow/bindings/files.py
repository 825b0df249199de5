"""File sources and sinks: written to shared scratch space and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelflow.bindings import derived as d
from labelflow.sources import items as I
from labelflow.sources import sinks as K
from labelflow.sources import vocabulary as V
from labelflow.storage import scratch_dir

CONFIG = I.DatasetConfig(("text",), {"title": "name"}, "doc_id")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a title that is sometimes a word for "missing"."""
    key = F.col("doc_id")
    return d.table(spark, sf_dir, "documents").select(
        key.cast("string").alias("doc_id"),
        F.when(key % 9 == 0, F.lit("N/A"))
        .when(key % 9 == 1, F.lit(""))
        .when(key % 9 == 2, F.concat(F.lit('a "quoted", title '), "source"))
        .otherwise(F.col("source"))
        .alias("title"),
        "text",
    )


def _items(items: DataFrame) -> DataFrame:
    title = F.try_element_at("metadata", F.lit("name"))
    return items.select("id", "text", title.alias("title"))


def src_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_dir(spark)}.csv"
    K.write_csv(_documents(spark, sf_dir), path)
    return _items(I.read_items(spark, path, CONFIG))


def src_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_dir(spark)}.jsonl"
    K.write_json(_documents(spark, sf_dir), path)
    return _items(I.read_items(spark, path, CONFIG))


def src_json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON arrays, one for each range of documents; tasks share each file."""
    path = f"{scratch_dir(spark)}.json"
    K.write_json_arrays(_documents(spark, sf_dir), path, [F.col("doc_id").cast("long")])
    return _items(I.read_items(spark, path, CONFIG))


def src_json_array_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequential ids over the elements of several arrays, in file order."""
    path = f"{scratch_dir(spark)}.json"
    K.write_json_arrays(_documents(spark, sf_dir), path, [F.col("doc_id").cast("long")])
    config = I.DatasetConfig(("title",), {"doc_id": "name"})
    return _items(I.read_items(spark, path, config)).select("id", F.col("title").alias("doc_id"))


def src_csv_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequential ids over several files, in the order of files and rows."""
    path = f"{scratch_dir(spark)}.csv"
    ordered = _documents(spark, sf_dir).orderBy(F.col("doc_id").cast("long"))
    K.write_csv(ordered, path)
    config = I.DatasetConfig(("title",), {"doc_id": "name"}, required=("title", "doc_id"))
    return _items(I.read_items(spark, path, config)).select("id", F.col("title").alias("doc_id"))


def load_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vocabulary as a text file with quoted comma labels and padding."""
    topic = F.col("topic")
    line = F.when(F.contains(topic, F.lit(",")), F.concat(F.lit('"'), topic, F.lit('" ')))
    path = scratch_dir(spark)
    ordered = d.topics(spark, sf_dir).orderBy("topic")
    ordered.select(line.otherwise(topic).alias("value")).write.text(path)
    return V.read_topics(spark, path)


def load_synonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many parts share a swapped name: the last part's label wins."""
    classes = _classes(spark, sf_dir)
    out = V.synonym_table(classes, "p_partkey")
    return out.select(
        "synonym", "label", F.col("pos.row").alias("row"), F.col("pos.i").alias("i")
    )


def load_synonyms_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through a CSV table of several files, in file order."""
    path = f"{scratch_dir(spark)}.csv"
    K.write_csv(_classes(spark, sf_dir).orderBy("p_partkey").drop("p_partkey"), path)
    return V.read_synonyms(spark, path).select("synonym", "label")


def _classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, name = F.col("p_partkey"), F.col("p_name")
    swapped = F.concat_ws(
        " ", F.split_part(name, F.lit(" "), F.lit(2)), F.split_part(name, F.lit(" "), F.lit(1))
    )
    kind = F.when(key % 3 == 0, F.lit("operation_")).otherwise(F.lit("topic_"))
    return d.table(spark, sf_dir, "part").select(
        "p_partkey",
        F.concat(kind, key.cast("string")).alias("Class ID"),
        F.concat_ws(" ", "p_name", "p_brand").alias("Preferred Label"),
        F.when(key % 4 > 0, F.concat_ws("|", swapped, "p_brand")).alias("Synonyms"),
    )


def read_id_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark)
    key = F.col("o_orderkey")
    line = F.when(key % 5 == 0, F.lit("  ")).otherwise(
        F.concat(F.lit(" batch_"), key.cast("string"), F.lit("\t"))
    )
    d.table(spark, sf_dir, "orders").select(line.alias("value")).write.text(path)
    return V.read_id_list(spark, path)


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"),
        F.array("lang", "source").alias("categories"),
        F.when(F.col("doc_id") % 2 == 0, F.col("lang")).alias("confidence_scores"),
    )


def sink_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends into one table."""
    path = scratch_dir(spark)
    rows = _results(spark, sf_dir)
    K.write_json(rows.where(F.col("id").cast("long") % 2 == 0), path)
    K.write_json(rows.where(F.col("id").cast("long") % 2 == 1), path)
    schema = "id string, categories array<string>, confidence_scores string"
    back = spark.read.schema(schema).json(path)
    return back.withColumn("categories", F.array_join("categories", "~"))


def sink_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark)
    K.write_csv(_results(spark, sf_dir), path)
    return I.read_csv(spark, path)


def sink_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger rows of the running and of the other batches, appended."""
    path = scratch_dir(spark)
    rows = d.ledger(spark, sf_dir).select(
        "batch_id",
        F.concat("batch_id", F.lit(".jsonl")).alias("batch_file"),
        F.concat(F.lit("file_"), "status").alias("input_file_id"),
        "n_results",
    )
    K.append_ledger(rows.where("n_results < 5"), path)
    K.append_ledger(rows.where("n_results >= 5"), path)
    schema = "batch_id string, batch_file string, input_file_id string"
    return spark.read.schema(schema).json(path)


QUERIES = {
    "src_csv": src_csv,
    "src_json": src_json,
    "src_json_array": src_json_array,
    "src_json_array_ids": src_json_array_ids,
    "src_csv_ids": src_csv_ids,
    "load_topics": load_topics,
    "load_synonyms": load_synonyms,
    "load_synonyms_csv": load_synonyms_csv,
    "read_id_list": read_id_list,
    "sink_json": sink_json,
    "sink_csv": sink_csv,
    "sink_ledger": sink_ledger,
}


def _source_sql(missing: str) -> str:
    return f"""
SELECT CAST(doc_id AS VARCHAR) AS id, {d.sql_strip('text')} AS text,
  CASE WHEN doc_id % 9 = 0 THEN {missing} WHEN doc_id % 9 = 1
       THEN {"NULL" if missing == "NULL" else "''"}
       WHEN doc_id % 9 = 2 THEN 'a "quoted", title ' || source ELSE source END AS title
FROM documents"""


_LISTED = """WITH listed AS (
  SELECT p_partkey AS row, p_name || ' ' || p_brand AS label, 0 AS i,
         split_part(p_name, ' ', 2) || ' ' || split_part(p_name, ' ', 1) AS synonym
  FROM part WHERE p_partkey % 3 > 0 AND p_partkey % 4 > 0
  UNION ALL
  SELECT p_partkey, p_name || ' ' || p_brand, 1, p_brand
  FROM part WHERE p_partkey % 3 > 0 AND p_partkey % 4 > 0
)"""

ORACLE = {
    "src_csv": _source_sql("NULL"),
    "src_json": _source_sql("'N/A'"),
    "src_json_array": _source_sql("'N/A'"),
    "src_json_array_ids": """SELECT CAST(row_number() OVER (ORDER BY doc_id) - 1 AS VARCHAR) AS id,
  CAST(doc_id AS VARCHAR) AS doc_id FROM documents""",
    "src_csv_ids": """SELECT CAST(row_number() OVER (ORDER BY doc_id) - 1 AS VARCHAR) AS id,
  CAST(doc_id AS VARCHAR) AS doc_id FROM documents""",
    "load_topics": f"""WITH {d.TOPICS_SQL}
SELECT row_number() OVER (ORDER BY topic) - 1 AS pos, topic,
  CASE WHEN contains(topic, ',') THEN '"' || topic || '"' ELSE topic END AS topic_raw
FROM topics""",
    "load_synonyms": f"""{_LISTED}
SELECT synonym, arg_max(label, row) AS label, min(row) AS row, min(i) AS i
FROM listed GROUP BY synonym""",
    "load_synonyms_csv": f"""{_LISTED}
SELECT synonym, arg_max(label, row) AS label FROM listed GROUP BY synonym""",
    "read_id_list": "SELECT 'batch_' || o_orderkey AS id FROM orders WHERE o_orderkey % 5 > 0",
    "sink_json": """SELECT CAST(doc_id AS VARCHAR) AS id, lang || '~' || source AS categories,
  CASE WHEN doc_id % 2 = 0 THEN lang END AS confidence_scores FROM documents""",
    "sink_csv": """SELECT CAST(doc_id AS VARCHAR) AS id,
  '["' || lang || '","' || source || '"]' AS categories,
  CASE WHEN doc_id % 2 = 0 THEN lang END AS confidence_scores FROM documents""",
    "sink_ledger": f"""WITH {d.LEDGER_SQL}
SELECT batch_id, batch_id || '.jsonl' AS batch_file, 'file_' || status AS input_file_id
FROM ledger""",
}
