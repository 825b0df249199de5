from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelflow.functions import status as S
from labelflow.operators import chunking as C
from labelflow.operators import costs
from labelflow.operators import monitoring as M
from labelflow.operators import results as R
from labelflow.operators.infer import infer
from labelflow.operators.positions import with_positions


def test_positions_are_the_sorted_order(spark):
    rng = random.Random(3)
    # One key holds most rows; the second key makes the order unique.
    rows = [(rng.choice([1, 1, 1, 2, 3]), i) for i in range(2000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k long, i long").repartition(7)
    got = {(r["k"], r["i"]): r["pos"] for r in with_positions(df, ["k", "i"]).collect()}
    assert got == {row: pos for pos, row in enumerate(sorted(rows))}


def test_positions_of_nothing(spark):
    assert with_positions(spark.range(0), ["id"]).collect() == []


def _recursive(sizes, limit, low=0):
    if sum(sizes) + len(sizes) - 1 <= limit:
        return [(low, low + len(sizes))]
    middle = len(sizes) // 2
    if middle == 0:
        return []
    return _recursive(sizes[:middle], limit, low) + _recursive(
        sizes[middle:], limit, low + middle
    )


def test_halving_equals_recursion():
    rng = random.Random(11)
    for _ in range(2000):
        sizes = [rng.randint(1, 60) for _ in range(rng.randint(1, 40))]
        limit = rng.randint(1, 300)
        assert list(C._halves(np.array(sizes), limit)) == _recursive(sizes, limit)


def test_chunks(spark):
    df = spark.range(25).select("id", F.when(F.col("id") == 13, 99).otherwise(10).alias("nbytes"))
    sized = C.chunk_by_count(df, ["id"], rows=10)
    got = {r["pos"]: r["first_pos"] for r in C.chunk_by_bytes(sized, limit=60).collect()}
    assert [got[i] for i in range(25)] == (
        [0] * 5 + [5] * 5 + [10, 10, 12, None, 14] + [15] * 5 + [20] * 5
    )


@pytest.mark.parametrize("rows_per_call", [1, 4])
def test_infer_retries_and_keeps_errors(spark, rows_per_call):
    def factory():
        calls = {}

        def model(prompts):
            for p in prompts:
                calls[p] = calls.get(p, 0) + 1
                if p == "bad":
                    raise RuntimeError("no")
                if p == "late" and calls[p] < 3:
                    raise RuntimeError("wait")
            return [p.upper() for p in prompts]

        return model

    df = spark.createDataFrame([(p,) for p in ["a", "bad", "late", "b"]], "prompt string").coalesce(1)
    options = {"rows_per_call": rows_per_call, "retry_delay": 0}
    rows = {r["prompt"]: r for r in infer(df, factory, **options).collect()}
    assert rows["a"]["raw_response"] == "A" and rows["a"]["error"] is None
    assert rows["late"]["raw_response"] == "LATE"
    assert rows["bad"]["raw_response"] is None and rows["bad"]["error"] == "no"
    assert rows["bad"]["attempts"] == 3
    kept = infer(df, factory, on_error="drop", **options).collect()
    assert {r["prompt"] for r in kept} == {"a", "late", "b"}
    with pytest.raises(Exception, match="no"):
        infer(df, factory, on_error="fail", **options).collect()
    with pytest.raises(ValueError):
        infer(df, factory, on_error="skip")


def test_latest_result_wins_once_per_id(spark):
    def run(rows):
        return spark.createDataFrame(rows, "id string, processed_at long, categories array<string>")

    old = run([("1", 1, ["a"]), ("2", 1, ["b"])])
    new = run([("1", 2, ["c"]), ("3", 2, ["d"])])
    out = R.latest_results(old, new, old)
    assert {r["id"]: r["categories"] for r in out.collect()} == {"1": ["c"], "2": ["b"], "3": ["d"]}


def test_pending(spark):
    assert sorted(
        r["id"] for r in R.pending_items(spark.range(5), spark.range(2, 4)).collect()
    ) == [0, 1, 4]


def test_unknown_model_costs_the_default(spark):
    df = spark.createDataFrame([("gpt-4o",), ("who",)], "model string")
    rows = costs.with_prices(df, costs.price_book(spark), "batch").collect()
    assert {r["model"]: (r["input_price"], r["output_price"]) for r in rows} == {
        "gpt-4o": (1.25, 5.0),
        "who": (0.075, 0.3),
    }


def test_empty_run_has_zero_totals(spark):
    df = spark.createDataFrame([], "cost double, started_at timestamp, ended_at timestamp")
    (row,) = costs.run_totals(df).collect()
    assert (row["total_samples"], row["total_cost"], row["cost_per_sample"]) == (0, 0.0, 0.0)


def test_lost_text_falls_back_to_labels(spark):
    asked = spark.createDataFrame([("1", "p"), ("2", "q")], "id string, prompt string")
    done = spark.createDataFrame(
        [("2", None, ["a", "b"])], "id string, completion string, categories array<string>"
    )
    (row,) = costs.pair_requests(asked, done).collect()
    assert (row["id"], row["completion"]) == ("2", "['a', 'b']")


def test_status_rules(spark):
    rows = [("validating", 0), ("in_progress", 3599), ("in_progress", 3600), ("in_progress", 43200),
            ("finalizing", 1), ("completed", 1), ("expired", 1), ("odd", 1)]
    df = spark.createDataFrame(rows, "status string, s long").coalesce(1)
    status, s = F.col("status"), F.col("s")
    got = df.select(
        S.completion_estimate(status, s).alias("eta"), S.status_class(status).alias("c")
    ).collect()
    assert [r["eta"] for r in got] == [
        "2-5 minutes", "2-20 hours", "2-12 hours", "1-6 hours", "1-10 minutes", None, None, None,
    ]
    assert [r["c"] for r in got] == ["running"] * 5 + ["completed", "failed", None]
    polls = spark.createDataFrame([(4.9,), (5.0,), (15.0,), (60.0,)], "m double").coalesce(1)
    assert [r[0] for r in polls.select(S.poll_seconds(F.col("m"))).collect()] == [30, 60, 300, 600]


def test_done_but_empty_batch_failed(spark):
    ledger = spark.createDataFrame(
        [("a", "completed", 0), ("b", "completed", 2), ("c", "expired", 0), ("d", "finalizing", 0)],
        "batch_id string, status string, n_results long",
    )
    assert sorted(r["batch_id"] for r in M.failed_batches(ledger).collect()) == ["a", "c"]


def test_progress_needs_a_total_and_progress(spark):
    df = spark.sql(
        "select * from values ('a', 10L, 40L), ('b', 0L, 40L), ('c', 5L, null)"
        " as t(session_id, processed_count, total_items)"
    ).withColumn("started_at", F.expr("timestamp'2024-01-01 00:00:00'"))
    as_of = F.expr("timestamp'2024-01-01 00:01:00'")
    rows = {r["session_id"]: r for r in M.progress(df, as_of).collect()}
    assert (rows["a"]["progress_percent"], rows["a"]["remaining_seconds"]) == (25.0, 180.0)
    assert rows["b"]["progress_percent"] is None and rows["c"]["remaining_seconds"] is None
