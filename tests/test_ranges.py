"""Parallel reading of quoted CSV and JSON arrays against plain readers."""

from __future__ import annotations

import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelflow import storage
from labelflow.sources import items as I
from labelflow.sources import ranges, sinks

VALUES = [
    "", "a", "x,y", 'say "hi"', "two\nlines", '\n', '","', '"', '""', "}{", '\\', 'a\\"b', "é中👩",
    "tail\\\\", "[1, {", "\n\n,\n", "  pad ", '"start', 'end"', "]", "\t", "long " * 40,
]


KEYS = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")


@pytest.fixture
def tiny(spark, monkeypatch):
    """Ranges of some bytes for the scan of the files, which is the first to be stored."""
    old, store = {k: spark.conf.get(k) for k in KEYS}, ranges.materialise

    def size(n):
        def first(df):
            for key in KEYS:
                spark.conf.set(key, n)
            try:
                return store(df)
            finally:
                for key in KEYS:
                    spark.conf.set(key, old[key])
                monkeypatch.setattr(ranges, "materialise", store)

        monkeypatch.setattr(ranges, "materialise", first)
        monkeypatch.setattr(ranges, "PART_CHARS", max(1, n // 8))

    return size


@pytest.mark.parametrize("size", [31, 257, 1 << 20])
def test_csv_equals_plain(spark, tiny, tmp_path, size):
    rng = random.Random(size)
    folder, want = tmp_path / "in.csv", []
    folder.mkdir()
    for f in range(4):
        out = io.StringIO()
        writer = csv.writer(out, lineterminator="\n", quoting=rng.choice([csv.QUOTE_ALL, csv.QUOTE_MINIMAL]))
        writer.writerow(["a", "b", "_number"])
        for i in range([0, 1, 25, 25][f]):
            row = [rng.choice(VALUES), rng.choice(VALUES), f"{f}-{i}"]
            writer.writerow(row)
            want.append(row)
            if rng.random() < 0.2:
                out.write("\n")
        text = out.getvalue()
        (folder / f"part-{f}.csv").write_text(text if f != 2 else text.removesuffix("\n"))
    tiny(size)
    df = I.read_csv(spark, str(folder), number=True)
    assert df.columns == ["a", "b", "_number", "__number"]
    got = [tuple(r) for r in df.collect()]
    assert sorted(r[3] for r in got) == list(range(len(want)))
    for a, b, name, n in got:
        assert [a, b, name] == [v or None for v in want[n]]
    # The reader with one task for each file gives the same.
    plain = (
        spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(folder))
    )
    assert sorted(map(str, plain.collect())) == sorted(str(r) for r in df.select("a", "b", "_number").collect())


@pytest.mark.parametrize("size", [31, 257, 1 << 20])
@pytest.mark.parametrize("indent", [None, 1])
def test_json_array_equals_plain(spark, tiny, tmp_path, size, indent):
    rng = random.Random(size)
    folder, want = tmp_path / "in.json", []
    folder.mkdir()
    for f in range(4):
        rows = [
            {
                "a": rng.choice([*VALUES, None, 5, True]), "b": rng.choice([[1, {"x": "}"}], {"y": ["]"]}, "s"]),
                rng.choice(VALUES): rng.choice(VALUES),
            }
            for _ in range([0, 1, 20, 20][f])
        ]
        want += rows
        text = json.dumps(rows, indent=indent, ensure_ascii=rng.random() < 0.5)
        (folder / f"part-{f}.json").write_text(text + "\n" * (f % 2))
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("_number", T.StringType())])
    tiny(size)
    df = ranges.read_json_array(spark, str(folder), schema, number=True)
    assert df.columns == ["a", "_number", "__number"]
    got = {r[2]: r[0] for r in df.collect()}
    assert sorted(got) == list(range(len(want)))
    for n, row in enumerate(want):
        value = row["a"]
        plain = value if value is None or isinstance(value, str) else json.dumps(value)
        assert got[n] == plain, row
    plain = spark.read.schema(schema).option("multiLine", True).json(str(folder))
    assert sorted(map(str, plain.collect())) == sorted(str(r) for r in df.select("a", "_number").collect())


def test_one_object_and_broken_ends(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.StringType())])
    (tmp_path / "a.json").write_text('{"a": {"b": 1}}\n')
    (tmp_path / "b.json").write_text(' \n')
    (tmp_path / "c.json").write_text('[{"a": 1}, {"a": 2}')
    (tmp_path / "d.json").write_text("[ ]")
    got = ranges.read_json_array(spark, f"{tmp_path}/*.json", schema, number=True)
    assert sorted(tuple(r) for r in got.collect()) == [("1", 1), ("2", 2), ('{"b":1}', 0)]
    (tmp_path / "e.csv").write_text('a,b\r\n1,"x\r\ny"\r\n\r\n2,"never closed\n3,4\n')
    rows = I.read_csv(spark, f"{tmp_path}/e.csv", number=True).collect()
    assert sorted(r["_number"] for r in rows) == [0, 1] and {r["a"] for r in rows} == {"1", "2"}


def test_tasks_share_one_file(spark, tiny, tmp_path):
    rows = [{"a": f"{i}," + "x}{" * 50} for i in range(400)]
    (tmp_path / "one.json").write_text(json.dumps(rows))
    tiny(4096)
    schema = T.StructType([T.StructField("a", T.StringType())])
    stored = []
    scan = ranges.materialise

    def watched(df):
        out = scan(df)
        stored.append(out)
        return out

    ranges.materialise = watched
    got = ranges.read_json_array(spark, str(tmp_path / "one.json"), schema)
    assert stored[0].select("block").distinct().count() > 8
    assert {r["a"] for r in got.collect()} == {r["a"] for r in rows}


def test_user_columns_of_internal_names_stay(spark, tmp_path):
    from labelflow.operators.chunking import chunk_by_count
    from labelflow.operators.positions import with_positions
    from labelflow.operators.results import latest_results, with_source

    names = ["_row", "_part", "_start", "_file", "_block", "_scan", "_number", "item_id"]
    rows = [(f"v{i}", *[f"{n}{i}" for n in names]) for i in range(9)]
    df = spark.createDataFrame(rows, ["k", *names])
    for out in (with_positions(df, ["k"]), chunk_by_count(df, ["k"], 4), I.assign_ids(df.drop("item_id"), None, ["k"])):
        kept = names if "item_id" in out.columns and "pos" in out.columns else names[:-1]
        assert sorted(r["_row"] for r in out.collect()) == sorted(r[1] for r in rows)
        for r in out.collect():
            assert all(r[n] == f"{n}{r['k'][1:]}" for n in kept)
    dated = df.withColumnRenamed("k", "id").selectExpr("id", "timestamp_ntz'2024-01-01' AS processed_at", *names)
    for r in latest_results(dated, dated).collect():
        assert all(r[n] == f"{n}{r['id'][1:]}" for n in names)
    for r in with_source(dated.select("id"), dated).collect():
        assert all(r[n] == f"{n}{r['id'][1:]}" for n in names)
    path = str(tmp_path / "in.parquet")
    df.drop("item_id").orderBy("k").coalesce(1).write.parquet(path)
    table = I.read_table(spark, path, I.DatasetConfig(), number=True)
    assert [r[-1] for r in table.orderBy("k").collect()] == list(range(9))
    assert sorted(r["_number"] for r in table.collect()) == sorted(r[7] for r in rows)


def test_tasks_get_batches_of_few_megabytes(spark, tmp_path):
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(setting)
    rows = spark.range(40).select("id", F.repeat(F.lit("x, {y} "), 1000).alias("t"))
    sinks.write_json_arrays(rows, str(tmp_path / "a"), ["id"])
    assert spark.conf.get(setting) == storage.BATCH_BYTES
    spark.conf.unset(setting)
    records = ranges.read_records(spark, str(tmp_path / "a"), ranges.JsonElements())
    assert spark.conf.get(setting) == storage.BATCH_BYTES
    assert records.count() == 40
