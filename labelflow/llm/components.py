"""Connected components of a link table, for any sizes of components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelflow.llm.common import store_rows
from labelflow.storage import materialise


def _star(edges: DataFrame, large: bool, rows: int) -> DataFrame:
    """One large-star or small-star step over ``rows`` edges (a, b) with a > b.

    The least neighbour of every node comes from a partial minimum and is
    stored, so that the join with the links of a hub can be split.
    """
    if large:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges
    least = store_rows(
        both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("node"), F.least("a", "m").alias("m")
        ),
        2 * rows,
    )
    joined = both.join(least, F.col("a") == F.col("node"))
    if large:
        new = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        new = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("node").alias("a"), F.col("m").alias("b"))
        )
    return store_rows(new.where("a > b").distinct(), 2 * rows)


def connected(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b), two long columns.

    root is the least node that can be reached. Alternating large-star and
    small-star steps (Kiveris et al. 2014) turn every component into a star in
    a few rounds; each is written to the shared folder, and only a count and a
    checksum per round reach the driver.
    """
    stored = materialise(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    )
    edges = store_rows(stored.distinct(), stored.count())

    def state(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    seen = state(edges)
    while seen[0]:
        edges = _star(_star(edges, True, seen[0]), False, seen[0])
        now = state(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
