"""The newest row at or before each time, such as the price valid at a request."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelflow.operators.positions import _ranged


def valid_at(facts: DataFrame, history: DataFrame, by: str, at: str, since: str) -> DataFrame:
    """``facts`` with the columns of the row of ``history`` that was valid for
    them: the same ``by``, and the newest ``since`` up to ``at``; nulls if none is.

    Both tables are put in one order by key and time, in range partitions, so a
    hot key is split and no fact meets more than one row of history. Within a
    partition the last row of history stands for what follows it; one row for
    each partition, what its last key ends with, goes to the driver and on to
    the partitions behind. Of rows of history with equal key and time the one
    with the largest other columns counts. Null keys and times match nothing.
    """
    given = [c for c in history.columns if c != by]
    right = T.StructType([history.schema[c] for c in given])
    left = facts.select(
        F.col(by).alias("by"), F.col(at).alias("at"), F.lit(1).alias("side"),
        F.struct(*[f"`{c}`" for c in facts.columns]).alias("fact"),
        F.lit(None).cast(right).alias("valid"),
        F.monotonically_increasing_id().alias("nth"),
    )
    known = history.where(F.col(by).isNotNull() & F.col(since).isNotNull()).select(
        F.col(by).alias("by"), F.col(since).alias("at"), F.lit(0).alias("side"),
        F.lit(None).cast(left.schema["fact"].dataType).alias("fact"),
        F.struct(*[f"`{c}`" for c in given]).alias("valid"),
        F.monotonically_increasing_id().alias("nth"),
    )
    order = [F.col(c).asc_nulls_first() for c in ("by", "at", "side", "valid", "nth")]
    ranged, part, row = _ranged(known.unionByName(left), order)
    before = Window.partitionBy(part, "by").orderBy(row).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.withColumn("own", F.last("valid", ignorenulls=True).over(before))

    ends = sorted(
        ranged.groupBy(part)
        .agg(
            F.max_by("by", row).alias("last"),
            F.max_by(F.struct("by", "valid"), F.when(F.col("side") == 0, F.col(row))).alias("valid"),
        )
        .collect(),
        key=lambda r: r[0],
    )
    carried, held = [], (None, None)
    for number, last, valid in ends:
        carried.append((number, *held))
        if valid is not None and valid["by"] == last:
            held = (last, valid["valid"])
        elif held[0] != last:
            held = (None, None)
    schema = T.StructType(
        [
            T.StructField(part, T.LongType()),
            T.StructField("key", ranged.schema["by"].dataType),
            T.StructField("carried", right),
        ]
    )
    # One row for each range partition.
    begins = F.broadcast(facts.sparkSession.createDataFrame(carried, schema))
    own = F.coalesce("own", F.when(F.col("by") == F.col("key"), F.col("carried")))
    found = F.when(F.col("at").isNotNull() & F.col("by").isNotNull(), own)
    names = [c for c in given if c not in facts.columns]
    return local.where("side = 1").join(begins, part).select("fact", found.alias("valid")).select(
        "fact.*", *[F.col("valid")[c].alias(c) for c in names]
    )
