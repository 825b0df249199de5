"""Keep an expensive column from being computed twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``withColumn`` whose value is computed once per row.

    A filter on a plain computed column is pushed below it, and the column is
    then computed for the filter and again for the output. A generator stops
    that. One row in, one row out.
    """
    return df.select("*", F.explode_outer(F.array(value)).alias(name))
