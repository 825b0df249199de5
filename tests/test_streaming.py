from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from labelflow.functions.prompts import metadata_field
from labelflow.bindings.models import TermModel
from labelflow.operators.matching import Vocabulary
from labelflow.plans import label as L
from labelflow.streaming import incremental as S

SCHEMA = "id string, text string, metadata map<string,string>"
RESULTS = "id string, categories array<string>"


def _items(spark, low, high):
    return spark.range(low, high).select(
        F.col("id").cast("string"),
        F.concat(F.lit("about biology <b>x</b> "), F.col("id").cast("string")).alias("text"),
        F.create_map(F.lit("title"), F.lit("chemistry")).alias("metadata"),
    )


@pytest.fixture(scope="module")
def labeller(spark):
    topics = spark.createDataFrame([(0, "biology"), (1, "chemistry")], "pos long, topic string")
    vocabulary = Vocabulary.of(topics)

    def run(items):
        fields = {"title": metadata_field("title"), "abstract": F.col("text")}
        return L.label(
            items, lambda: TermModel(["biology", "chemistri"]), vocabulary,
            "<title> <abstract>", fields,
        ).select("id", "categories")

    return run


def _bag(df):
    return sorted((r["id"], tuple(r["categories"])) for r in df.collect())


def test_restart_after_a_crash_gives_each_result_once(spark, labeller, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for low in (0, 10):
        _items(spark, low, low + 10).coalesce(1).write.mode("append").parquet(source)
    failed = []

    def fragile(batch):
        result = labeller(batch)
        if batch.where(F.col("id") == "15").count() and not failed:
            failed.append(True)
            result.write.mode("overwrite").parquet(f"{out}/epoch=1")
            raise RuntimeError("lost")
        return result

    def run():
        stream = S.read_stream(spark, source, SCHEMA, files_per_trigger=1)
        S.write_once(stream, fragile, out, state)

    with pytest.raises(Exception, match="lost"):
        run()
    run()
    _items(spark, 20, 25).coalesce(1).write.mode("append").parquet(source)
    run()
    run()
    got = _bag(S.read_results(spark, out, RESULTS))
    assert got == _bag(labeller(_items(spark, 0, 25)))
    assert len(got) == 25


def test_inputs_are_checked(spark):
    topics = spark.createDataFrame([], "pos long, topic string")
    with pytest.raises(ValueError, match="vocabulary"):
        L.check_inputs(_items(spark, 0, 1), Vocabulary.of(topics))
    topics = spark.createDataFrame([(0, "a")], "pos long, topic string")
    with pytest.raises(ValueError, match="rows"):
        L.check_inputs(_items(spark, 0, 0), Vocabulary.of(topics))


def test_failures_are_split(spark):
    df = spark.createDataFrame([("1", None), ("2", "e")], "id string, error string")
    good, bad = S.split_failures(df)
    assert [r["id"] for r in good.collect()] == ["1"]
    assert [r["id"] for r in bad.collect()] == ["2"]
