from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from labelflow.operators import matching as M
from labelflow.sources import vocabulary as V


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        previous, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            previous, row[j] = row[j], min(
                row[j] + 1, row[j - 1] + 1, previous + (x != y)
            )
    return row[-1]


def brute_force(miss, topics, synonyms):
    """First kind that hits, then distance, then list order."""
    found = []
    for pos, topic in enumerate(topics):
        d = distance(miss, topic)
        if 0 < d <= 2:
            found.append((0, d, pos, topic))
        if topic.lower() in miss.lower().split():
            found.append((2, d, pos, topic))
    for pos, (synonym, label) in enumerate(synonyms):
        d = distance(miss, synonym)
        if d <= 1:
            found.append((1, d, pos, label))
        if synonym.lower() in miss.lower().split():
            found.append((3, d, pos, label))
    return min(found)[3] if found else None


def _edit(rng: random.Random, text: str, edits: int) -> str:
    for _ in range(edits):
        i = rng.randrange(len(text) + 1)
        kind = rng.randrange(3)
        letter = rng.choice("abcé ")
        text = text[:i] + ("" if kind == 0 else letter) + text[i + (kind != 1):]
    return text


def _words(rng: random.Random, n: int, lengths: tuple[int, int]) -> list[str]:
    return [
        "".join(rng.choices("abcdé Xy", k=rng.randint(*lengths))).strip() for _ in range(n)
    ]


@pytest.fixture(scope="module", params=["inline", "joined"])
def cases(request, spark):
    rng = random.Random(7)
    topics = list(
        dict.fromkeys(
            [*_words(rng, 40, (1, 9)), *_words(rng, 20, (44, 54)), "Biology", "red rod", "new rod"]
        )
    )
    synonyms = [
        (s, f"label {i}")
        for i, s in enumerate(
            dict.fromkeys([*_words(rng, 25, (1, 9)), *_words(rng, 10, (44, 54)), "jumbo"])
        )
    ]
    sources = topics + [s for s, _ in synonyms]
    misses = {_edit(rng, rng.choice(sources), rng.randint(0, 4)) for _ in range(900)}
    misses |= {"ned rod", "a JUMBO thing", "about biology now", "", "x" * 500, "the red jumbo"}
    misses -= set(topics)
    spark_topics = spark.createDataFrame(list(enumerate(topics)), "pos long, topic string")
    spark_synonyms = spark.createDataFrame(
        [(i, s, t) for i, (s, t) in enumerate(synonyms)],
        "pos long, synonym string, label string",
    )
    limit = 1000 if request.param == "inline" else 0
    vocabulary = M.Vocabulary.of(spark_topics, spark_synonyms, inline_limit=limit)
    assert (vocabulary.names is not None) == (request.param == "inline")
    return sorted(misses), topics, synonyms, vocabulary


def test_matches_equal_brute_force(spark, cases):
    misses, topics, synonyms, vocabulary = cases
    df = spark.createDataFrame([(m,) for m in misses], "miss string")
    got = {r["miss"]: r["label"] for r in M.match_misses(df, vocabulary).collect()}
    want = {m: brute_force(m, topics, synonyms) for m in misses}
    assert got == {m: label for m, label in want.items() if label is not None}
    assert len(got) > 300


def test_tie_goes_to_the_earlier_entry(spark):
    topics = spark.createDataFrame(
        [(5, "red rod"), (2, "new rod"), (9, "net rod")], "pos long, topic string"
    )
    misses = spark.createDataFrame([("ned rod",)], "miss string")
    (row,) = M.match_misses(misses, M.Vocabulary.of(topics)).collect()
    assert (row["label"], row["kind"], row["distance"]) == ("new rod", "topic", 1)


@pytest.mark.parametrize("limit", [1000, 0])
def test_topics_and_synonyms_may_be_ordered_differently(spark, tmp_path, limit):
    (tmp_path / "t.txt").write_text("Biology\nChemistry\n")
    (tmp_path / "s.csv").write_text(
        "Class ID,Preferred Label,Synonyms\ntopic_1,Biology,Life science|Bio\n"
    )
    vocabulary = M.Vocabulary.of(
        V.read_topics(spark, str(tmp_path / "t.txt")),
        V.read_synonyms(spark, str(tmp_path / "s.csv")),
        inline_limit=limit,
    )
    misses = spark.createDataFrame([("Chemistri",), ("life science",), ("the bio",)], "miss string")
    got = {r["miss"]: r["label"] for r in M.match_misses(misses, vocabulary).collect()}
    assert got == {"Chemistri": "Chemistry", "life science": "Biology", "the bio": "Biology"}


def test_empty_vocabulary(spark):
    topics = spark.createDataFrame([], "pos long, topic string")
    misses = spark.createDataFrame([("a",)], "miss string")
    assert M.match_misses(misses, M.Vocabulary.of(topics)).collect() == []


def test_no_cross_join_in_the_plan(spark, cases):
    misses, _, _, vocabulary = cases
    df = spark.createDataFrame([(m,) for m in misses], "miss string")
    plan = M.match_misses(df, vocabulary)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_few_probe_keys_for_any_length(spark):
    rows = [("x y" * n)[:n] for n in range(0, 200)]
    df = spark.createDataFrame([(r,) for r in rows], "miss string")
    kinds = (M.TOPIC_EDIT, M.SYNONYM_EDIT)
    most = df.select(F.max(F.size(M._probe_keys(F.col("miss"), F.lit(10_000), kinds)))).first()[0]
    assert most < 100
