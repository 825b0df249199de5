"""Batches as state machines: order of arrival, alarms, restart, end of state."""

from __future__ import annotations

from datetime import datetime, timedelta

from labelflow.streaming import incremental as S
from labelflow.streaming import repeats
from labelflow.streaming.lifecycle import batch_life
from labelflow.streaming.repeats import keyed_state

SCHEMA = "batch_id string, status string, at timestamp"
START = datetime(2024, 1, 1)
LIMITS = {"validating": 300, "in_progress": 3600}


def _write(spark, folder, rows):
    data = [(b, s, None if m is None else START + timedelta(minutes=m)) for b, s, m in rows]
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_life_of_batches_over_restarts(spark, tmp_path):
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    batches = [
        # "a" arrives in the wrong order; "b" repeats a status; odd rows in between
        [("a", "in_progress", 4), ("b", "validating", 0), ("a", "validating", 1), ("b", "validating", 3),
         (None, "validating", 2), ("c", None, 0), ("c", "validating", None)],
        [("a", "in_progress", 3), ("a", "completed", 64), ("b", "in_progress", 5), ("clock", None, 30)],
        [("clock", None, 200)],
        [("a", "validating", 5), ("a", "validating", 201), ("clock", None, 400)],  # the first is late
    ]
    held = []
    for batch in batches:
        _write(spark, folder, batch)
        with keyed_state(spark):
            life = batch_life(S.read_stream(spark, folder, SCHEMA), "10 minutes", LIMITS)
            S.append_once(life, out, state)
        now = spark.read.format("statestore").option("stateVarName", "now").load(state)
        held.append(now.count())
    rows = spark.read.parquet(out).collect()
    got = sorted(
        (r["batch_id"] or "", (r["at"] - START).total_seconds() / 60, r["kind"], r["from_status"], r["to_status"], r["seconds"])
        for r in rows
    )
    assert got == [
        ("", 2, "transition", None, "validating", None),
        ("", 7, "overdue", "validating", None, 300),
        ("a", 1, "transition", None, "validating", None),
        ("a", 3, "transition", "validating", "in_progress", 120),
        ("a", 63, "overdue", "in_progress", None, 3600),
        ("a", 64, "transition", "in_progress", "completed", 3660),
        ("a", 201, "transition", None, "validating", None),
        ("a", 206, "overdue", "validating", None, 300),
        ("b", 0, "transition", None, "validating", None),
        ("b", 5, "overdue", "validating", None, 300),
        ("b", 5, "transition", "validating", "in_progress", 300),
        ("b", 65, "overdue", "in_progress", None, 3600),
    ]
    assert held[2] == 2  # "a" has ended; null and "b" still stand


def test_batches_of_a_group_share_lists_of_state(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(repeats, "GROUPS", 4)
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "batch_id long, status string, at timestamp"
    big = (1 << 60) + 1
    ids = [None, *range(big, big + 200)]
    rows = [(b, "in_progress", START + timedelta(minutes=1)) for b in ids]
    rows += [(b, "validating", START) for b in ids] + [(0, None, START + timedelta(minutes=30))]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(folder)
    with keyed_state(spark):
        S.append_once(batch_life(S.read_stream(spark, folder, schema), "10 minutes", LIMITS), out, state)
    got = spark.read.parquet(out).select("batch_id", "to_status", "seconds").collect()
    first = [(b or 0, "validating", None) for b in ids]
    second = [(b or 0, "in_progress", 60.0) for b in ids]
    assert sorted(((r[0] or 0, r[1], r[2]) for r in got), key=lambda x: x[:2]) == sorted(first + second, key=lambda x: x[:2])
    now = spark.read.format("statestore").option("stateVarName", "now").load(state)
    assert now.count() == 201 and now.select("key").distinct().count() == 4
