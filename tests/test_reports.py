"""As-of joins, levels and quantile sketches on small tables."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from labelflow.sources import sinks
from labelflow.operators.asof import valid_at
from labelflow.operators.levels import cost_levels, merged_quantiles, quantile_states


def plain_valid(facts, history):
    out = []
    for key, at, tag in facts:
        rows = [] if key is None or at is None else [
            (s, p) for k, s, p in history if k == key and s is not None and s <= at
        ]
        out.append((tag, *(max(rows) if rows else (None, None))))
    return sorted(out)


def test_valid_at_over_partition_borders(spark):
    """A hot key over many range partitions, prices far before what they hold for."""
    rng = random.Random(1)
    for rows, keys in ((400, "a"), (300, "aaab"), (60, "abcd"), (0, "a")):
        facts = [(rng.choice([*keys, None]), rng.choice([None, *range(200)]), i) for i in range(rows)]
        history = [("a", 3, 1.0), ("a", 3, 2.0), ("a", 150, 3.0), ("b", None, 9.0), (None, 1, 9.0), ("d", 50, 4.0)]
        df = spark.createDataFrame(facts, "k string, _row long, tag long").repartition(5)
        prices = spark.createDataFrame(history, "k string, since long, price double")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            found = valid_at(df, prices, "k", "_row", "since")
            got = sorted((r["tag"], r["since"], r["price"]) for r in found.collect())
        finally:
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        assert got == plain_valid(facts, history)
        assert found.columns == ["k", "_row", "tag", "since", "price"]


def test_facts_multiply_with_no_history(spark):
    facts = spark.range(5).selectExpr("id AS k", "id AS at")
    none = facts.selectExpr("k", "at AS since", "1 AS price").limit(0)
    assert [r["price"] for r in valid_at(facts, none, "k", "at", "since").collect()] == [None] * 5


def test_levels_tell_totals_from_nulls(spark):
    facts = spark.createDataFrame(
        [("x", None, 1, 7), ("x", "d", 2, 7), (None, "d", 3, 8)], "m string, day string, cost long, u long"
    )
    rows = cost_levels(facts, [["m", "day"], ["m"], []], "cost", "u").collect()
    assert sorted((r["level"], r["m"] or "", r["day"] or "", r["n"], r["cost"], r["u_estimate"]) for r in rows) == [
        (0, "", "d", 1, 3, 1), (0, "x", "", 1, 1, 1), (0, "x", "d", 1, 2, 1),
        (1, "", "", 1, 3, 1), (1, "x", "", 2, 3, 1), (3, "", "", 3, 6, 2),
    ]
    plan = cost_levels(facts, [["m"], []], "cost", "u")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand") == 1


def test_merged_sketches_keep_their_bound(spark):
    values = spark.range(50_000).select(
        (F.col("id") % 100).alias("run"), F.pmod(F.xxhash64("id"), F.lit(10_000)).alias("v")
    )
    states = quantile_states(values.unionByName(values.selectExpr("run", "NULL AS v")), ["run"], "v")
    rows = merged_quantiles(states.withColumn("all", F.lit(1)), ["all"], (0.0, 0.5, 0.95, 0.99, 1.0)).collect()
    for r in rows:
        below = values.where(F.col("v") <= r["value"]).count() / 50_000
        assert abs(below - r["p"]) < 0.03 and r["n"] == 50_000
    assert states.agg(F.max(F.length("state"))).first()[0] < 20_000
    none = quantile_states(values.selectExpr("run", "CAST(NULL AS DOUBLE) AS v"), ["run"], "v")
    assert merged_quantiles(none, ["run"], (0.5,)).count() == 0


def test_import_parses_lines_once(spark, tmp_path, monkeypatch):
    from labelflow.operators.matching import Vocabulary
    from labelflow.plans import importing
    from labelflow.sources import batches

    calls, parsed = [], batches._parsed
    monkeypatch.setattr(batches, "_parsed", lambda lines: calls.append(1) or parsed(lines))
    good = (
        '{"custom_id": "1", "response": {"status_code": 200, "body": {"choices": '
        '[{"message": {"content": "Biology, error"}}]}}}'
    )
    failed = '{"custom_id": "2", "response": {"status_code": 400, "body": {"error": null}}}'
    escaped = failed.replace('"error"', '"\\\\u0065rror"')
    rows = [("b1", good), ("b1", failed), ("b1", escaped), ("b2", "{")]
    sinks.write_batches(spark.createDataFrame(rows, "batch_id string, line string"), str(tmp_path / "in"))
    topics = spark.createDataFrame([(0, "Biology")], "pos long, topic string")
    synonyms = spark.createDataFrame([], "pos long, synonym string, label string")
    done = importing.import_batches(
        spark, str(tmp_path / "in"), str(tmp_path / "out"), Vocabulary.of(topics, synonyms), "m"
    )
    assert len(calls) == 1
    assert sorted(map(tuple, done.counts.collect())) == [("b1", 3, 1, 2), ("b2", 1, 0, 1)]
    assert [(r["id"], r["batch_id"], r["categories"]) for r in done.results.collect()] == [("1", "b1", ["Biology"])]


def test_import_stores_lines_once_and_packs_them(spark, tmp_path, monkeypatch):
    """Disk: files of lines and results in gzip, one stored table of ids, none of answers."""
    from labelflow import storage
    from labelflow.operators.matching import Vocabulary
    from labelflow.plans import importing

    head, tail = '{"custom_id": "', '", "response": {"status_code": 200, "body": {"choices": [{"message": {"content": '
    lines = [(f"b{i % 3}", f'{head}{i}{tail}"Biology, botany {i % 7}"}}}}]}}}}}}') for i in range(3_000)]
    lines += [("b1", "{"), ("b9", f"{head}x{tail}null}}]}}}}}}")]
    source, out = tmp_path / "in", tmp_path / "out"
    before = spark.conf.get(storage._WRITERS)
    monkeypatch.setattr(sinks, "BATCH_FILES", 2)  # of four batches: the rest is sorted
    sinks.write_batches(spark.createDataFrame(lines, "batch_id string, line string").coalesce(2), str(source))
    assert spark.conf.get(storage._WRITERS) == before
    size = lambda folder: sum(p.stat().st_size for p in folder.rglob("part-*"))
    plain = sum(len(line or "") for _, line in lines)
    assert size(source) < plain / 4
    topics = spark.createDataFrame([(0, "Biology")], "pos long, topic string")
    synonyms = spark.createDataFrame([], "pos long, synonym string, label string")
    stored = []
    for limit in (10, 0):  # a vocabulary looked up in the row, and one that is joined
        made = []
        storage._watching.append(made)
        try:
            done = importing.import_batches(
                spark, str(source), str(out / str(limit)), Vocabulary.of(topics, synonyms, limit), "m"
            )
        finally:
            storage._watching.remove(made)
        columns = [spark.read.parquet(path).columns for path in made]
        stored.append(sum("id" in c for c in columns))
        assert not any("raw_response" in c for c in columns)
        assert size(out / str(limit) / "results") < size(source)
        rows = {r["id"]: (r["batch_id"], r["categories"], r["hallucinations"]) for r in done.results.collect()}
        assert rows == {str(i): (f"b{i % 3}", ["Biology"], [f"botany {i % 7}"]) for i in range(3_000)}
        assert sorted(map(tuple, done.counts.collect())) == [
            ("b0", 1000, 1000, 0), ("b1", 1001, 1000, 1), ("b2", 1000, 1000, 0), ("b9", 1, 0, 1)
        ]
    assert stored == [1, 1]
