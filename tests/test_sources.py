from __future__ import annotations

import json
from pathlib import Path

import pytest

from labelflow.sources import batches as B
from labelflow.sources import items as I
from labelflow.sources import sinks as K
from labelflow.sources import vocabulary as V

CONFIG = I.DatasetConfig(("head", "absent", "body"), {"name": "title", "no": "x"}, "_id", " | ")


def _rows(df):
    return sorted((r["id"], r["text"], r["metadata"]) for r in df.collect())


def test_csv_items(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text(
        '_id,head,body,name\n007,"a ""q"", b","line\nbreak ",T\n,NA, x ,N/A\n3,,,"NULL"\n'
    )
    assert _rows(I.read_items(spark, str(path), CONFIG)) == [
        ("", "x", {}),
        ("007", 'a "q", b | line\nbreak', {"title": "T"}),
        ("3", "No Description", {}),
    ]


def test_json_array_and_lines(spark, tmp_path):
    records = [
        {"_id": 1, "head": "", "body": None, "name": "T"},
        {"_id": None, "head": "h", "body": "b", "other": 1},
    ]
    array, lines = tmp_path / "a.JSON", tmp_path / "a.jsonl"
    array.write_text(json.dumps(records))
    lines.write_text("\n".join(json.dumps(r) for r in records))
    # An empty part is kept, only a missing part is skipped.
    expected = [("", "h | b", {}), ("1", "", {"title": "T"})]
    assert _rows(I.read_items(spark, str(array), CONFIG)) == expected
    assert _rows(I.read_items(spark, str(lines), CONFIG)) == expected


def test_sequential_ids(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("description\n" + "".join(f"t{i}\n" for i in range(50)))
    items = I.read_items(spark, str(path), I.DatasetConfig())
    assert {(r["id"], r["text"]) for r in items.collect()} == {
        (str(i), f"t{i}") for i in range(50)
    }


def test_unknown_format_and_missing_columns(spark):
    with pytest.raises(ValueError):
        I.read_items(spark, "a.xml", CONFIG)
    with pytest.raises(ValueError):
        I.require_columns(spark.range(1), ["id", "name"])


def test_named_config_falls_back():
    configs = {"a": {"text_columns": ["t"]}}
    assert I.DatasetConfig.named(configs, "a").text_columns == ["t"]
    other = I.DatasetConfig.named(configs, "b")
    assert tuple(other.text_columns) == ("description",)
    assert other.metadata_mapping == {"name": "title"}


def test_topics_file(spark, tmp_path):
    path = tmp_path / "topics.txt"
    path.write_text('Biology \n\n"Work, life"\n"\nAcoustics\n')
    rows = [tuple(r) for r in V.read_topics(spark, str(path)).orderBy("pos").collect()]
    assert rows == [
        (0, "Biology", "Biology"),
        (1, "Work, life", '"Work, life"'),
        (2, "", '"'),
        (3, "Acoustics", "Acoustics"),
    ]


def test_synonyms_last_label_first_place(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text(
        "Class ID,Preferred Label,Synonyms\n"
        "x/topic_1,A,s|t\nx/operation_2,B,s\nx/topic_3,C,\nx/topic_4,D,t|u\n"
    )
    rows = V.read_synonyms(spark, str(path)).orderBy("pos").collect()
    assert [(r["synonym"], r["label"]) for r in rows] == [("s", "A"), ("t", "D"), ("u", "D")]


def test_id_list(spark, tmp_path):
    path = tmp_path / "ids.txt"
    path.write_text(" b1 \n\n b2\n")
    assert sorted(r["id"] for r in V.read_id_list(spark, str(path)).collect()) == ["b1", "b2"]


def _line(**fields):
    return json.dumps(fields)


def _body(**fields):
    return {"status_code": 200, "body": fields}


CHOICE = [{"message": {"content": "yes"}, "logprobs": {"a": [1]}}]
LINES = [
    ("bad_json", "{"),
    ("api_error", _line(custom_id="1", error={"code": 1}, response=None)),
    ("missing_key", _line(error=None, response=_body(choices=CHOICE))),
    ("missing_key", _line(custom_id="1", response=None)),
    ("body_error", _line(custom_id="1", response=_body(error=None, choices=CHOICE))),
    ("empty_choices", _line(custom_id="1", response=_body(choices=[]))),
    ("missing_key", _line(custom_id="1", response=_body(model="m"))),
    ("missing_key", _line(custom_id="1", response=_body(choices=[{"message": {}}]))),
    ("ok", _line(custom_id="1", error={}, response=_body(choices=CHOICE))),
    ("ok", _line(custom_id="2", response=_body(model="m", choices=CHOICE))),
]


def test_batch_output_outcomes(spark):
    df = spark.createDataFrame([("b", line) for _, line in LINES], "batch_id string, line string")
    got = [r["outcome"] for r in B.classify(df.coalesce(1), "default").collect()]
    assert got == [outcome for outcome, _ in LINES]
    results = B.batch_results(df.coalesce(1), "default").collect()
    assert [(r["id"], r["raw_response"], r["model_name"], r["confidence_scores"]) for r in results] == [
        ("1", "yes", "default", '{"a":[1]}'),
        ("2", "yes", "m", '{"a":[1]}'),
    ]


def test_parsed_output_keeps_failed_rows(spark):
    lines = [line for _, line in LINES] + [
        _line(custom_id="9", response={"status_code": 429, "body": {}}),
    ]
    df = spark.createDataFrame([("b", x) for x in lines], "batch_id string, line string")
    rows = [tuple(r) for r in B.parse_batch_output(df.coalesce(1)).collect()]
    assert len(rows) == len(lines)
    assert rows[-1] == ("9", 429, None)
    assert rows[5] == ("1", 200, None)
    assert rows[6] == ("1", 200, "")
    assert rows[8] == ("1", 200, "yes")


def test_json_sink_appends(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([("1", None)], "id string, note string")
    K.write_json(df, path)
    K.write_json(df, path)
    assert [r["value"] for r in spark.read.text(path).collect()] == ['{"id":"1","note":null}'] * 2


def test_template_and_configuration_files(spark, tmp_path):
    from labelflow.functions.prompts import read_template

    (tmp_path / "t.txt").write_text("Title: <title>\n<topics>\n")
    assert read_template(spark, str(tmp_path / "t.txt")) == "Title: <title>\n<topics>\n"
    (tmp_path / "c.json").write_text('{"a": {"text_columns": ["x"], "id_column": "i"}}')
    configs = I.read_configs(spark, str(tmp_path / "c.json"))
    assert I.DatasetConfig.named(configs, "a") == I.DatasetConfig(["x"], {}, "i")


def test_required_columns_and_missing_order(spark):
    df = spark.createDataFrame([("a",)], "x string")
    with pytest.raises(ValueError, match="missing columns: y"):
        I.to_items(df, I.DatasetConfig(("x",), required=("x", "y"), id_column="x"))
    with pytest.raises(ValueError, match="order"):
        I.to_items(df, I.DatasetConfig(("x",)))


def test_ids_follow_file_order_not_file_size(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.mkdir()
    for name, rows in (("a", 2), ("b", 50), ("c", 5)):
        lines = [f"{name}{i}" for i in range(rows)]
        (path / f"{name}.csv").write_text("description\n" + "\n".join(lines) + "\n")
    items = I.read_items(spark, str(path), I.DatasetConfig(multi_line=False)).collect()
    texts = [r["text"] for r in sorted(items, key=lambda r: int(r["id"]))]
    assert texts == ["a0", "a1", *[f"b{i}" for i in range(50)], *[f"c{i}" for i in range(5)]]


def test_scratch_tables_are_removed(spark):
    from labelflow.storage import materialise, scratch

    with scratch(spark):
        table = materialise(spark.range(5))
        files = table.inputFiles()
        assert table.count() == 5 and files
    assert not any(Path(f.removeprefix("file://")).exists() for f in files)
