"""A key in half of the rows must be split by adaptive execution."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from labelflow.operators.costs import pair_requests
from labelflow.operators.matching import Vocabulary
from labelflow.operators.monitoring import validate_ids
from labelflow.operators.results import latest_results, pending_items, with_source
from labelflow.plans import normalize as N

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.files.maxPartitionBytes": "64k",
}
N_ROWS = 20_000


@pytest.fixture
def small_partitions(spark):
    before = {k: spark.conf.get(k) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _hot(spark, name="id"):
    """Ids of which half are the empty string; wide enough to be worth splitting."""
    key = F.col("id")
    return spark.range(0, N_ROWS, 1, 16).select(
        F.when(key % 2 == 0, "").otherwise(key.cast("string")).alias(name),
        F.md5(key.cast("string")).alias("payload"),
    )


def _is_split(df) -> bool:
    df.write.format("noop").mode("overwrite").save()
    query = df._jdf.queryExecution()
    df.collect()
    return "skew=true" in query.executedPlan().toString()


def test_pending_items(spark, small_partitions):
    done = spark.range(5).select(F.col("id").cast("string"))
    out = pending_items(_hot(spark), done)
    assert _is_split(out)
    assert out.count() == N_ROWS - 2


def test_with_source(spark, small_partitions):
    items = spark.range(200).select(
        F.when(F.col("id") < 20, "").otherwise(F.col("id").cast("string")).alias("id"),
        F.create_map(F.lit("k"), F.col("id").cast("string")).alias("metadata"),
    )
    out = with_source(_hot(spark), items)
    assert _is_split(out)
    assert out.count() == N_ROWS


def test_validate_ids(spark, small_partitions):
    ledger = spark.range(50).select(F.col("id").cast("string").alias("batch_id"))
    out = validate_ids(_hot(spark, "batch_id"), ledger)
    assert _is_split(out)
    assert out.count() == N_ROWS


def test_pair_requests(spark, small_partitions):
    results = spark.createDataFrame(
        [("", "x", ["a"]), ("", None, ["b"]), ("1", "y", [])],
        "id string, completion string, categories array<string>",
    )
    out = pair_requests(_hot(spark), results)
    assert _is_split(out)
    assert out.count() == N_ROWS // 2 + 1


def test_latest_results_of_map_columns(spark):
    rows = spark.createDataFrame(
        [("1", 1, {"a": "b"}), ("1", 2, {"c": "d"}), ("2", 1, None)],
        "id string, processed_at int, metadata map<string,string>",
    )
    out = latest_results(rows, rows)
    assert sorted((r["id"], r["processed_at"]) for r in out.collect()) == [("1", 2), ("2", 1)]


def test_rows_without_labels_are_spread(spark):
    rows = spark.range(1_000).select("id", F.lit(None).cast("string").alias("raw_response"))
    keyed = N._with_list_key(N.with_labels(rows))
    assert keyed.select("list_key").distinct().count() > 500


def test_a_common_label_is_split(spark, small_partitions):
    topics = spark.range(50).select("id", F.concat(F.lit("topic "), "id").alias("topic"))
    vocabulary = Vocabulary.of(topics.withColumnRenamed("id", "pos"), inline_limit=0)
    lists = spark.range(0, N_ROWS, 1, 8).select(
        F.col("id").cast("string").alias("list_key"),
        F.array(F.lit("none"), F.concat(F.lit("x"), "id")).alias("labels"),
    )
    elements = lists.select("list_key", F.posexplode("labels").alias("i", "bare"))
    joined = elements.join(N._resolutions(vocabulary, None), "bare", "left")
    assert _is_split(joined)
