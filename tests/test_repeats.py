"""Keyed state with a lifetime: late repeats, expiry, restart."""

from __future__ import annotations

from datetime import datetime, timedelta

from labelflow.streaming import incremental as S
from labelflow.streaming import repeats
from labelflow.streaming.repeats import drop_repeats_for, keyed_state

SCHEMA = "k string, at timestamp, v long"
START = datetime(2024, 1, 1)


def _write(spark, folder, rows):
    data = [(k, START + timedelta(minutes=m), v) for k, m, v in rows]
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def _state_rows(spark, state):
    return spark.read.format("statestore").option("stateVarName", "seen").load(state).count()


def test_a_repeat_after_the_delay_is_dropped_until_the_lifetime_ends(spark, tmp_path):
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    batches = [
        [("a", 0, 1), ("a", 5, 2), ("b", 1, 3), (None, 0, 9)],
        [("a", 90, 4), ("c", 95, 5), (None, 90, 10)],  # over an hour after the delay, state lives
        [("d", 300, 6)],  # the watermark passes the lifetime of a and b
        [("e", 301, 7)],
        [("a", 302, 8)],  # after its lifetime
    ]
    held = []
    for batch in batches:
        _write(spark, folder, batch)
        # Each run is a restart from the state that the one before left.
        with keyed_state(spark):
            once = drop_repeats_for(
                S.read_stream(spark, folder, SCHEMA), "k", "at", "10 minutes", timedelta(hours=2)
            )
            S.append_once(once, out, state)
        held.append(_state_rows(spark, state))
    got = sorted(tuple(r) for r in spark.read.schema(SCHEMA).parquet(out).select("v").collect())
    assert got == [(1,), (3,), (5,), (6,), (7,), (8,), (9,)]
    assert held[0] == 3 and held[1] == 4 and held[-1] <= 3


def test_keys_of_a_group_share_a_list_of_state(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(repeats, "GROUPS", 4)
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    big = (1 << 60) + 1
    ids = [None, *range(big, big + 300)]
    for minute in (0, 30):
        rows = [(k, START + timedelta(minutes=minute), None if k is None else k + minute) for k in ids]
        schema = "k long, at timestamp, v long"
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        with keyed_state(spark):
            once = drop_repeats_for(
                S.read_stream(spark, folder, schema), "k", "at", "10 minutes", timedelta(hours=2)
            )
            S.append_once(once, out, state)
    got = spark.read.parquet(out).select("k", "v").collect()
    assert sorted((r["k"] or 0, r["v"] or 0) for r in got) == sorted((k or 0, k or 0) for k in ids)
    seen = spark.read.format("statestore").option("stateVarName", "seen").load(state)
    assert seen.count() == 301 and seen.select("key").distinct().count() == 4
