"""Repair model answers against a vocabulary.

A response is split into labels, labels outside the vocabulary are matched to
it, and the matches are appended. Two exact plans give the same rows:

* inline: vocabulary and match table are small (both are counted first). Labels
  are looked up inside the row, so the responses are never shuffled.
* by list: everything else. Distinct label lists are resolved by joins and
  joined back, so a hot label, list or id is handled once per distinct value.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelflow.functions.labels import (
    bare,
    hide_entries,
    is_torn,
    label_list,
    show_separators,
)
from labelflow.functions.once import with_once
from labelflow.operators.matching import Vocabulary, match_misses
from labelflow.operators.results import content_hash
from labelflow.storage import materialise

# A match table within both bounds is looked up inside the row.
INLINE_MATCHES = 20_000
INLINE_MATCH_CHARS = 1_000_000
#: Characters of vocabulary entries that one pass of label protection sends out.
PROTECT_CHARS = 4_000_000
_BUCKETS = 1024
_SPREAD = 4096


def with_labels(responses: DataFrame, labels: Column | None = None) -> DataFrame:
    """Add ``labels``; a row without a response keeps its own categories."""
    out = label_list(F.col("raw_response")) if labels is None else labels
    if "categories" in responses.columns:
        out = F.coalesce(out, F.col("categories"))
    return with_once(responses, "labels", out)


def protected_labels(responses: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``with_labels`` that keeps vocabulary entries holding separators whole.

    Longer entries come first. The entries go to the tasks in groups of
    PROTECT_CHARS characters, one pass over the responses for each group, so a
    vocabulary may have any size.
    """
    torn = (
        vocabulary.topics.where(is_torn(F.col("topic")))
        .select("topic")
        .distinct()
        .orderBy(F.length("topic").desc(), "topic")
    )
    hidden, group, chars, passes = F.col("raw_response"), [], 0, 0
    for row in torn.toLocalIterator():
        if group and chars + len(row["topic"]) > PROTECT_CHARS:
            hidden, passes = hide_entries(hidden, group, passes > 0), passes + 1
            group, chars = [], 0
        group.append(row["topic"])
        chars += len(row["topic"])
    if not group:
        return with_labels(responses)
    rows = with_once(responses, "_hidden", hide_entries(hidden, group, passes > 0))
    labels = F.transform(label_list(F.col("_hidden")), show_separators)
    return with_labels(rows, labels).drop("_hidden")


def _distinct_bare(labels: Column) -> Column:
    return F.array_distinct(F.transform(labels, bare))


def _split_inline(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    labels = F.col("labels")
    misses = F.filter(_distinct_bare(labels), lambda x: ~vocabulary.contains(x))
    valid = F.filter(labels, lambda x: vocabulary.contains(bare(x)))
    return rows.withColumn(
        "misses", F.when(F.size(labels) > 0, misses)
    ).withColumn("valid", F.coalesce(valid, F.array().cast("array<string>")))


def _with_list_key(rows: DataFrame) -> DataFrame:
    """Content key of the label list; rows without labels are spread evenly."""
    spread = F.pmod(content_hash(rows, rows.columns), F.lit(_SPREAD))
    key = F.when(F.size("labels") > 0, F.md5(F.to_json("labels"))).otherwise(
        F.concat(F.lit("none-"), spread)
    )
    return with_once(rows, "list_key", key)


def _distinct_lists(keyed: DataFrame) -> DataFrame:
    """(list_key, labels): every distinct non-empty label list, stored."""
    return materialise(
        keyed.where(F.size("labels") > 0)
        .groupBy("list_key")
        .agg(F.first("labels").alias("labels"))
    )


def distinct_misses(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(miss): every distinct unknown label of a table with ``labels``."""
    labels = rows.select(F.explode("labels").alias("label")).select(
        bare(F.col("label")).alias("miss")
    )
    if vocabulary.names is not None:
        return labels.where(~vocabulary.contains(F.col("miss"))).distinct()
    topics = vocabulary.topics.select(F.col("topic").alias("miss"))
    return labels.distinct().join(topics, "miss", "left_anti")


def _resolutions(vocabulary: Vocabulary, matches: DataFrame | None) -> DataFrame:
    """(bare, known, match): what each label that is known or matched stands for.

    A matched label is outside the vocabulary, so ``bare`` is unique.
    """
    known = vocabulary.topics.select(
        F.col("topic").alias("bare"), F.lit(True).alias("known"), F.lit(None).cast("string").alias("match")
    ).dropDuplicates(["bare"])
    if matches is not None:
        found = matches.select(
            F.col("miss").alias("bare"), F.lit(None).cast("boolean").alias("known"), F.col("label").alias("match")
        )
        known = known.union(found)
    return materialise(known)


def _resolve_lists(
    lists: DataFrame, vocabulary: Vocabulary, matches: DataFrame | None
) -> DataFrame:
    """(list_key, valid, misses, matched) for each distinct label list, stored.

    Labels are resolved in one join whose sides are plain, so that a label in
    very many lists is split.
    """
    elements = lists.select("list_key", F.posexplode("labels").alias("i", "x")).withColumn(
        "bare", bare(F.col("x"))
    )
    joined = elements.join(_resolutions(vocabulary, matches), "bare", "left")
    items = F.sort_array(F.collect_list(F.struct("i", "x", "bare", "known", "match")))
    grouped = joined.groupBy("list_key").agg(items.alias("items"))
    missing = F.filter("items", lambda e: e["known"].isNull())
    # Repeats of a miss have the same match; both are kept at the first place.
    # Strings are compared by hash, so this stays linear in the list.
    pair = F.transform(
        F.filter("missing", lambda e: e["match"].isNotNull()),
        lambda e: F.concat(e["bare"], F.lit("\x00"), e["match"]),
    )
    return materialise(
        grouped.withColumn("missing", missing).select(
            "list_key",
            F.filter("items", lambda e: e["known"])["x"].alias("valid"),
            F.array_distinct("missing.bare").alias("misses"),
            F.transform(
                F.array_distinct(pair), lambda p: F.substring_index(p, "\x00", -1)
            ).alias("matched"),
        )
    )


def partition_labels(
    responses: DataFrame, vocabulary: Vocabulary
) -> DataFrame:
    """Split labels into ``valid`` (kept as written) and distinct ``misses``."""
    rows = with_labels(responses)
    if vocabulary.names is not None:
        return _split_inline(rows, vocabulary)
    rows = _with_list_key(rows)
    lists = _resolve_lists(_distinct_lists(rows), vocabulary, None).drop("matched")
    none = F.array().cast("array<string>")
    return (
        rows.join(lists, "list_key", "left")
        .withColumn("valid", F.coalesce("valid", none))
        .drop("list_key")
    )


def _lookup_table(matches: DataFrame) -> Column:
    """A small match table as one constant: an array of maps, indexed by hash.

    Spark folds the constant once per query, and a lookup reads one small map.
    """
    bucket = F.pmod(F.xxhash64("miss"), F.lit(_BUCKETS)).cast("int")
    table: list[dict[str, str]] = [{} for _ in range(_BUCKETS)]
    for b, miss, label in matches.select(bucket, "miss", "label").collect():
        table[b][miss] = label
    return F.from_json(F.lit(json.dumps(table)), "array<map<string,string>>")


def _lookup(table: Column, miss: Column) -> Column:
    bucket = F.pmod(F.xxhash64(miss), F.lit(_BUCKETS)).cast("int")
    return F.get(table, bucket)[miss]


def _append(valid: Column, matched: Column, rescue_all_miss: bool) -> Column:
    """Matches join a row only if a label survived, unless asked otherwise."""
    if rescue_all_miss:
        return F.concat(valid, matched)
    return F.when(F.size(valid) > 0, F.concat(valid, matched)).otherwise(valid)


def cut_labels(
    responses: DataFrame, vocabulary: Vocabulary, protect_comma_labels: bool = False
) -> DataFrame:
    """Rows with ``labels``, and under a large vocabulary ``list_key``: what is
    to be stored for ``resolve_labels``."""
    if protect_comma_labels:
        rows = protected_labels(responses, vocabulary)
    else:
        rows = with_labels(responses)
    return _with_list_key(rows) if vocabulary.names is None else rows


def resolve_labels(
    rows: DataFrame,
    vocabulary: Vocabulary,
    keep: list[str],
    *,
    rescue_all_miss: bool = False,
    distinct_categories: bool = False,
    inline_matches: int = INLINE_MATCHES,
) -> DataFrame:
    """The columns ``keep`` of stored rows of ``cut_labels``, with ``categories``
    and ``hallucinations``."""
    keyed = lists = None
    if vocabulary.names is None:
        keyed, lists = rows, _distinct_lists(rows)
    matches = materialise(
        match_misses(
            distinct_misses(rows if lists is None else lists, vocabulary), vocabulary
        ).select("miss", "label")
    )
    size = matches.agg(
        F.count("*").alias("n"), F.sum(F.length("miss") + F.length("label")).alias("c")
    ).first()
    inline = (
        vocabulary.names is not None
        and size["n"] <= inline_matches
        and (size["c"] or 0) <= INLINE_MATCH_CHARS
    )
    none = F.array().cast("array<string>")
    if inline:
        split = _split_inline(rows, vocabulary)
        table = _lookup_table(matches)
        matched = F.filter(
            F.transform("misses", lambda m: _lookup(table, m)),
            lambda m: m.isNotNull(),
        )
        resolved = split.withColumn("matched", F.coalesce(matched, none))
    else:
        if lists is None:
            keyed = _with_list_key(rows)
            lists = _distinct_lists(keyed)
        resolved = (
            keyed.join(_resolve_lists(lists, vocabulary, matches), "list_key", "left")
            .withColumn("valid", F.coalesce("valid", none))
            .withColumn("matched", F.coalesce("matched", none))
        )
    categories = _append(F.col("valid"), F.col("matched"), rescue_all_miss)
    if distinct_categories:
        categories = F.array_distinct(categories)
    return resolved.select(
        *keep, categories.alias("categories"), F.col("misses").alias("hallucinations")
    )


def normalize(
    responses: DataFrame,
    vocabulary: Vocabulary,
    *,
    rescue_all_miss: bool = False,
    distinct_categories: bool = False,
    protect_comma_labels: bool = False,
    inline_matches: int = INLINE_MATCHES,
) -> DataFrame:
    """Add ``categories`` and ``hallucinations`` to rows with ``raw_response``.

    ``hallucinations`` is null where a row has no labels at all. Rows are stored
    with their labels, which are looked at twice: cutting a response costs more
    than reading it back.
    """
    return resolve_labels(
        materialise(cut_labels(responses, vocabulary, protect_comma_labels)),
        vocabulary,
        [c for c in responses.columns if c not in ("categories", "hallucinations")],
        rescue_all_miss=rescue_all_miss,
        distinct_categories=distinct_categories,
        inline_matches=inline_matches,
    )


def unexpected_labels(responses: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Rows whose only label is an unquoted phrase outside the vocabulary."""
    label = F.col("label")
    single = (
        with_labels(responses)
        .where(F.size("labels") == 1)
        .select("id", F.get("labels", F.lit(0)).alias("label"))
        .where(~F.contains(label, F.lit('"')) & F.contains(label, F.lit(" ")))
    )
    if vocabulary.names is not None:
        return single.where(~vocabulary.contains(label))
    topics = vocabulary.topics.select(F.col("topic").alias("label"))
    return single.join(topics, "label", "left_anti").select("id", "label")


def top_labels(results: DataFrame, n: int) -> DataFrame:
    """The ``n`` most frequent categories; ties by label."""
    return (
        results.select(F.explode("categories").alias("label"))
        .groupBy("label")
        .agg(F.count("*").alias("n_rows"))
        .orderBy(F.desc("n_rows"), "label")
        .limit(n)
    )
