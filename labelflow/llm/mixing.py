"""Mix sources to target weights by systematic sampling. DataFrame functions only."""

from __future__ import annotations

import random
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelflow.llm.common import WORD, free_name, text_or_empty
from labelflow.operators.positions import with_positions
from labelflow.storage import materialise


@dataclass(frozen=True)
class Mix:
    """Weights of the sources in code point order (null last), repeating; the
    mix's size as a share of all sizes; the most of a source's size; a seed."""

    weights: tuple[int, ...] = (3, 1, 2)
    share: float = 1.5
    most: int = 2
    seed: int = 7

    @property
    def offset(self) -> float:
        """The one random offset, in [0, 1), short enough to add up exactly."""
        return random.Random(self.seed).randrange(1 << 20) / (1 << 20)


def words(text: str) -> Column:
    """Number of words; 0 for a null text."""
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def source_targets(sources: DataFrame, mix: Mix) -> DataFrame:
    """Targets of a table (source, source_size) with one row per source.

    Each round shares what is left by weight among the sources below their
    limit; a source that would pass ``most`` times its size stops there. Only
    three sums a round reach the driver. Sources without words get 0.
    """
    order = [F.col("source").isNull(), F.col("source")]
    n = len(mix.weights)
    weight = F.element_at(
        F.array(*[F.lit(w) for w in mix.weights]), (F.col("_rank") % n + 1).cast("int")
    )
    ranked = with_positions(sources, order, "_rank").select(
        "source",
        "source_size",
        weight.cast("double").alias("_weight"),
        (mix.most * F.col("source_size")).cast("double").alias("_limit"),
    )
    ranked = materialise(ranked)
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    amount = float(mix.share * total)
    per_weight, stopped = None, -1
    while True:
        capped = (
            F.lit(False) if per_weight is None else F.col("_limit") <= per_weight * F.col("_weight")
        )
        sums = ranked.agg(
            F.sum(F.when(capped, F.col("_limit")).otherwise(0.0)),
            F.sum(F.when(capped, 0.0).otherwise(F.col("_weight"))),
            F.count_if(capped),
        ).first()
        if sums[2] == stopped or not sums[1]:
            break
        stopped = sums[2]
        left, weights = amount - sums[0], sums[1]
        per_weight = left / weights
    if per_weight is None:
        return ranked.select("source", "source_size", F.lit(0.0).alias("target"))
    share = F.lit(left) * F.col("_weight") / F.lit(weights)
    return ranked.select(
        "source", "source_size", F.least("_limit", share).alias("target")
    )


def copies(df: DataFrame, source: str, size: str, tie: list[Column], mix: Mix) -> DataFrame:
    """``df`` with source_size, target and copies: how often each row is taken.

    All rows of a source have the same expected copies, target / source_size,
    so the prefix sum of expected copies before a row is its rank times that.
    A row is emitted once for every integer that the prefix sum, plus the one
    random offset, crosses at it. Rows are ranked by size within their source,
    so that what is taken of a source stays within about its largest row of its
    target, and no row is taken more than ``most`` times.

    Ranks come from a range partition, one count per partition and an offset
    (``operators.positions``); a source that fills a third of the table is cut
    by the range like any other. Runs agree if (size, ``tie``) is unique.
    """
    rank, start, rows = (free_name(df, n) for n in ("_pos", "_start", "_rows"))
    order = [F.col(source).isNull(), F.col(source), F.col(size), *tie]
    placed = with_positions(df, order, rank)
    sources = materialise(
        placed.groupBy(F.col(source).cast("string").alias("source")).agg(
            F.sum(size).alias("source_size"), F.min(rank).alias("_start"), F.count("*").alias("_n")
        )
    )
    targets = source_targets(sources.select("source", "source_size"), mix)
    rates = materialise(
        sources.join(
            targets.withColumnRenamed("source", "_s").drop("source_size"),
            F.col("source").eqNullSafe(F.col("_s")),
        ).select(
            F.col("source").alias("_source"),
            F.col("source_size").alias("_source_size"),
            F.col("target").alias("_target"),
            F.col("_start").alias(start),
            # with null sizes or no words at all, nothing is taken
            F.coalesce(F.col("target") / F.nullif("source_size", F.lit(0)), F.lit(0.0)).alias("_rate"),
        )
    )
    before = F.col("_rate") * (F.col(rank) - F.col(start)) + F.lit(mix.offset)
    after = F.col("_rate") * (F.col(rank) - F.col(start) + 1) + F.lit(mix.offset)
    joined = placed.join(rates, F.col(source).eqNullSafe(F.col("_source")))
    return joined.select(
        *[F.col(c) for c in df.columns],
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.floor(after) - F.floor(before)).alias("copies"),
    )


def mix_documents(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mixed table itself: the columns of ``docs`` (text, source, doc_id and
    any others), each row as often as it is taken.

    A null text has size 0; null sources are one source, the last; null doc_ids
    and repeated rows are rows of their own, and equal rows are
    interchangeable. An empty table stays empty. Texts move once, with their
    rows, in the range partition.
    """
    size, tie = free_name(docs, "_size"), free_name(docs, "_tie")
    chosen = {c.lower() for c in ("source_size", "target", "copies")}
    plain = {c: (f"_own_{c}" if c.lower() in chosen or c.startswith("_") else c) for c in docs.columns}
    sized = docs.withColumnsRenamed(plain).withColumns(
        {size: words("text"), tie: F.xxhash64(text_or_empty("text"))}
    )
    taken = copies(sized, "source", size, [F.col("doc_id"), F.col(tie)], mix).where("copies > 0")
    each = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return taken.select(*[F.col(p).alias(c) for c, p in plain.items()], each.alias("_copy")).drop(
        "_copy"
    )
