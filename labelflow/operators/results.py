"""Joins and unions around a result table keyed by id.

The reduced side of a join is stored first. The join then has plain inputs on
both sides, so adaptive execution can split a key that fills much of a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelflow.operators.positions import free_name
from labelflow.storage import materialise


def content_hash(df: DataFrame, columns: list[str]) -> Column:
    """A hash of the columns of a row; maps and nested types count as JSON."""
    nested = {c for c, t in df.dtypes if t.startswith(("map", "array", "struct"))}
    return F.xxhash64(
        *[F.to_json(F.struct(c)) if c in nested else F.col(c) for c in columns]
    )


def pending_items(items: DataFrame, done: DataFrame) -> DataFrame:
    """Items without a result: what remains after a resume.

    Finished ids are made distinct first, so an id that was finished very often
    is reduced before the shuffle.
    """
    finished = materialise(done.select("id").distinct())
    return items.join(finished, "id", "left_anti").select(*items.columns)


def filtered_items(before: DataFrame, after: DataFrame) -> DataFrame:
    """Items that preprocessing lost."""
    return pending_items(before, after)


def one_per_id(rows: DataFrame, order: Column, newest: bool) -> DataFrame:
    """The row of each id with the largest or smallest ``order``.

    Only (id, order, row number) is aggregated, with a partial step per task;
    the other columns are fetched by the number of the row that was chosen.
    """
    row = free_name(rows, "_row")
    stored = materialise(rows.withColumn(row, F.monotonically_increasing_id()))
    pick = F.max_by if newest else F.min_by
    chosen = materialise(stored.groupBy("id").agg(pick(row, order).alias(row)).select(row))
    return stored.join(chosen, row, "left_semi").drop(row)


def latest_results(*runs: DataFrame) -> DataFrame:
    """One row per id over all runs: the newest, ties by a hash of the content."""
    out = runs[0]
    for run in runs[1:]:
        out = out.unionByName(run)
    rest = [c for c in out.columns if c not in ("id", "processed_at")]
    order = F.struct(F.col("processed_at"), content_hash(out, rest).alias("h"))
    return one_per_id(out, order, newest=True).select("id", "processed_at", *rest)


def with_source(results: DataFrame, items: DataFrame) -> DataFrame:
    """Results next to the columns of their items.

    If an id names several items, one of them, chosen by a hash of its content,
    stands for it: a result never multiplies, not even for a missing id that
    many rows share. Items without a result are dropped before anything else.
    """
    wanted = items.join(
        materialise(results.select("id").distinct()), "id", "left_semi"
    )
    rest = [c for c in items.columns if c != "id"]
    one = one_per_id(wanted, content_hash(items, rest), newest=False)
    return results.join(materialise(one.select("id", *rest)), "id", "left")
