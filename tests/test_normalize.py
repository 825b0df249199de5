from __future__ import annotations

import pytest

from labelflow.operators.matching import Vocabulary
from labelflow.plans import normalize as N

TOPICS = ["Biology", "Chemistry", "Work, life", "hot rod", "X-ray diffraction"]
SYNONYMS = [("Life science", "Biology"), ("jumbo", "hot rod")]
ROWS = [
    ("1", "Biology\tChemistri"),
    ("2", "Chemistri"),
    ("3", "Biology, Biologi, Biologx, Biology"),
    ("4", '"Work, life"; a jumbo thing; "Biology"'),
    ("5", None),
    ("6", ""),
    ("", "Life science, Chemistry"),
    ("", "Life science, Chemistry"),
    ("", None),
    ("7", "nothing here, Chemistry, nothing here"),
    ("8", "hot-rod"),
    ("9", "Biology stuff"),
    ("10", "X-ray diffraction"),
]
EXPECTED = {
    ("1", ("Biology", "Chemistry"), ("Chemistri",)),
    # All labels missed: matches are not appended.
    ("2", (), ("Chemistri",)),
    # Appending does not remove repeats.
    ("3", ("Biology", "Biology", "Biology", "Biology"), ("Biologi", "Biologx")),
    ("4", ('"Work, life"', '"Biology"', "hot rod"), ("a jumbo thing",)),
    ("5", (), None),
    ("6", (), None),
    ("", ("Chemistry", "Biology"), ("Life science",)),
    ("", (), None),
    ("7", ("Chemistry",), ("nothing here",)),
    ("8", (), ("hot", "rod")),
    ("9", (), ("Biology stuff",)),
    ("10", (), ("X", "ray diffraction")),
}
PLANS = [(1000, 1000), (1000, 0), (0, 1000)]


def _vocabulary(spark, limit=1000):
    topics = spark.createDataFrame(list(enumerate(TOPICS)), "pos long, topic string")
    synonyms = spark.createDataFrame(
        [(i, *s) for i, s in enumerate(SYNONYMS)], "pos long, synonym string, label string"
    )
    return Vocabulary.of(topics, synonyms, inline_limit=limit)


def _responses(spark, rows=ROWS):
    return spark.createDataFrame(rows, "id string, raw_response string")


def _bag(df):
    return [
        (
            r["id"],
            tuple(r["categories"]),
            None if r["hallucinations"] is None else tuple(r["hallucinations"]),
        )
        for r in df.collect()
    ]


@pytest.mark.parametrize("limits", PLANS)
def test_normalize(spark, limits):
    vocabulary_limit, match_limit = limits
    out = N.normalize(
        _responses(spark), _vocabulary(spark, vocabulary_limit), inline_matches=match_limit
    )
    got = _bag(out)
    assert len(got) == len(ROWS)
    assert set(got) == EXPECTED
    assert got.count(("", ("Chemistry", "Biology"), ("Life science",))) == 2


@pytest.mark.parametrize("limits", PLANS)
def test_hot_rows_are_all_kept(spark, limits):
    rows = [("hot", "Biology, Chemistri")] * 3000 + [("", None)] * 1500 + ROWS
    out = N.normalize(
        _responses(spark, rows), _vocabulary(spark, limits[0]), inline_matches=limits[1]
    )
    got = _bag(out)
    assert len(got) == len(rows)
    assert got.count(("hot", ("Biology", "Chemistry"), ("Chemistri",))) == 3000


def test_rescue_and_distinct(spark):
    out = N.normalize(
        _responses(spark), _vocabulary(spark), rescue_all_miss=True, distinct_categories=True
    )
    got = {r["id"]: r["categories"] for r in out.collect()}
    assert got["2"] == ["Chemistry"]
    assert got["3"] == ["Biology"]
    assert got["9"] == ["Biology"]


def test_protection_keeps_labels_with_separators(spark):
    out = N.normalize(_responses(spark), _vocabulary(spark), protect_comma_labels=True)
    assert {r["id"]: r["categories"] for r in out.collect()}["10"] == ["X-ray diffraction"]


def test_rows_without_response_keep_their_categories(spark):
    rows = spark.createDataFrame(
        [("a", None, ["Biology", "Chemistri"]), ("b", "hot rod", ["Biology"])],
        "id string, raw_response string, categories array<string>",
    )
    out = N.normalize(rows, _vocabulary(spark))
    assert {r["id"]: r["categories"] for r in out.collect()} == {
        "a": ["Biology", "Chemistry"],
        "b": ["hot rod"],
    }


@pytest.mark.parametrize("limit", [1000, 0])
def test_unexpected_labels(spark, limit):
    rows = [
        ("1", "hot rod"), ("2", "a phrase"), ("3", '"a phrase"'), ("4", "word"),
        ("5", "a phrase, b"), ("6", None),
    ]
    out = N.unexpected_labels(_responses(spark, rows), _vocabulary(spark, limit))
    assert [tuple(r) for r in out.collect()] == [("2", "a phrase")]


@pytest.mark.parametrize("limit", [1000, 0])
def test_partition_covers_all_labels(spark, limit):
    out = N.partition_labels(_responses(spark), _vocabulary(spark, limit)).collect()
    assert len(out) == len(ROWS)
    for row in out:
        bare = [x.replace('"', "").replace(".", "") for x in row["labels"] or []]
        valid = [x.replace('"', "").replace(".", "") for x in row["valid"]]
        assert set(bare) == set(valid) | set(row["misses"] or [])
        assert set(valid) <= set(TOPICS)


def test_top_labels(spark):
    out = N.top_labels(N.normalize(_responses(spark), _vocabulary(spark)), 2)
    # Quoted labels count as written.
    assert [tuple(r) for r in out.collect()] == [("Biology", 7), ("Chemistry", 4)]


@pytest.mark.parametrize("limit", [1000, 0])
def test_responses_are_cut_once(spark, limit):
    """The result reads labels back instead of cutting each response again."""
    out = N.normalize(_responses(spark), _vocabulary(spark, limit))
    assert "regexp_replace" not in out._jdf.queryExecution().optimizedPlan().toString()
