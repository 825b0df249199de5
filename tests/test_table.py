"""The committed results table: writers, readers, replays, merges."""

from __future__ import annotations

import threading

import pytest
from pyspark.sql import functions as F

from labelflow.sources import table as module
from labelflow.sources.table import Conflict, ResultTable
from labelflow.streaming import incremental as S

SCHEMA = "id string, value long, bucket string"


@pytest.fixture
def table(spark, tmp_path):
    return ResultTable.create(spark, str(tmp_path / "t"), SCHEMA, buckets=4)


def rows(spark, *values):
    return spark.createDataFrame([(i, v, f"b{v}") for i, v in values], SCHEMA)


def content(df):
    return sorted((r["id"] or "", r["value"], r["bucket"]) for r in df.collect())


def test_upsert_replaces_and_adds(spark, table):
    assert content(table.read()) == []
    table.upsert(rows(spark, ("a", 1), ("b", 2), (None, 3), ("a", 0)), F.col("value"))
    table.upsert(rows(spark, ("b", 5), (None, 6), ("c", 7)))
    assert content(table.read()) == [("", 6, "b6"), ("a", 1, "b1"), ("b", 5, "b5"), ("c", 7, "b7")]
    assert content(table.read(1)) == [("", 3, "b3"), ("a", 1, "b1"), ("b", 2, "b2")]
    table.upsert(rows(spark).limit(0))
    assert len(content(table.read())) == 4
    again = ResultTable.create(spark, table.root, "other string", buckets=99)
    assert again.snapshot().buckets == 4 and content(again.read()) == content(table.read())


def test_a_reader_during_a_write_sees_the_old_state(spark, table, monkeypatch):
    table.upsert(rows(spark, ("a", 1)))
    before, seen, put = table.read(), [], table._put

    def watched(snapshot):
        seen.append(content(ResultTable(spark, table.root).read()))
        return put(snapshot)

    monkeypatch.setattr(table, "_put", watched)
    table.upsert(rows(spark, ("a", 2)))
    assert seen == [[("a", 1, "b1")]] and content(before) == [("a", 1, "b1")]
    assert content(table.read()) == [("a", 2, "b2")]


@pytest.mark.parametrize("same_bucket", [True, False])
def test_of_two_writers_one_tries_again(spark, table, monkeypatch, same_bucket):
    ids = [r["id"] for r in spark.range(50).select(F.col("id").cast("string")).collect()]
    place = {
        r["id"]: r["b"]
        for r in spark.createDataFrame([(i,) for i in ids], "id string").select("id", table._bucket(table.snapshot()).alias("b")).collect()
    }
    mine = ids[0]
    other = next(i for i in ids[1:] if (place[i] == place[mine]) == same_bucket)
    table.upsert(rows(spark, (mine, 0)))
    put, writes, write, overtaken = table._put, [], table._write, []

    def late(snapshot):
        if not overtaken:
            overtaken.append(1)
            ResultTable(spark, table.root).upsert(rows(spark, (other, 5)))
        return put(snapshot)

    monkeypatch.setattr(table, "_put", late)
    monkeypatch.setattr(table, "_write", lambda *a: writes.append(1) or write(*a))
    table.upsert(rows(spark, (mine, 1)))
    assert content(table.read()) == sorted([(mine, 1, "b1"), (other, 5, "b5")])
    # What the other writer left alone need not be written again.
    assert len(writes) == (2 if same_bucket else 1)


def test_many_writers_at_once(spark, table):
    def write(k):
        ResultTable(spark, table.root).upsert(rows(spark, (f"k{k}", k), ("shared", k)))

    threads = [threading.Thread(target=write, args=(k,)) for k in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    got = content(table.read())
    assert [x[0] for x in got] == ["k0", "k1", "k2", "k3", "shared"] and table.versions() == [0, 1, 2, 3, 4]


def test_a_writer_gives_up_at_last(spark, table, monkeypatch):
    monkeypatch.setattr(table, "_put", lambda snapshot: False)
    monkeypatch.setattr(module, "ATTEMPTS", 2)
    with pytest.raises(Conflict):
        table.append(rows(spark, ("a", 1)))


def test_replay_merge_and_clean_up(spark, table):
    for _ in range(2):
        table.append(rows(spark, ("a", 1), ("b", 2)), batch=("s", 0))
    table.append(rows(spark, ("a", 1)), batch=("s", 1))
    table.append(rows(spark, ("c", 9)), batch=("other", 0))
    want = [("a", 1, "b1"), ("a", 1, "b1"), ("b", 2, "b2"), ("c", 9, "b9")]
    assert content(table.read()) == want
    table.compact()
    snapshot = table.snapshot()
    assert content(table.read()) == want and max(map(len, snapshot.folders.values())) == 1
    table._write(snapshot, rows(spark, ("lost", 1)))  # a writer that died before its commit
    table.vacuum(keep=1, orphan_seconds=1e6)
    assert table.versions() == [snapshot.version] and len(table.files.names("data")) >= 2
    table.vacuum(keep=1, orphan_seconds=-1)
    left = {f"data/{n}" for n, _ in table.files.names("data")}
    assert left == {f.rpartition("/")[0] for fs in snapshot.folders.values() for f in fs}
    assert content(table.read()) == want and snapshot.batches == {"s": 1, "other": 0}


def test_stream_crash_between_commit_and_checkpoint(spark, table, tmp_path, monkeypatch):
    folder, state = str(tmp_path / "in"), str(tmp_path / "state")
    rows(spark, ("a", 1), ("b", 2)).write.parquet(folder)
    upsert = table.upsert

    def crash(*args, **kwargs):
        upsert(*args, **kwargs)
        raise RuntimeError("lost after the commit")

    def run():
        S.upsert_once(S.read_stream(spark, folder, SCHEMA), lambda b: b, table, state, "s")

    monkeypatch.setattr(table, "upsert", crash)
    with pytest.raises(Exception):
        run()
    monkeypatch.undo()
    run()
    assert table.versions() == [0, 1] and content(table.read()) == [("a", 1, "b1"), ("b", 2, "b2")]
    assert [r["rows"] for r in table.history().orderBy("version").collect()] == [0, 2]
