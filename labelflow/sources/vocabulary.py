"""Read vocabularies, synonym tables and id lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelflow.functions.text import strip
from labelflow.operators.positions import PLACE, with_place, with_positions
from labelflow.sources.items import read_csv


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(line) and PLACE: text lines with their place in the files."""
    lines = with_place(spark.read.text(path))
    return lines.select(strip(F.col("value")).alias("line"), *PLACE)


def read_topics(spark: SparkSession, path: str, keep_blank: bool = False) -> DataFrame:
    """(pos, topic, topic_raw) in file order; ``topic`` is without its quotes."""
    lines = _lines(spark, path)
    if not keep_blank:
        lines = lines.where(F.col("line") != "")
    raw = F.col("line")
    quoted = F.startswith(raw, F.lit('"')) & F.endswith(raw, F.lit('"'))
    topic = F.when(quoted, F.substr(raw, F.lit(2), F.greatest(F.length(raw) - 2, F.lit(0))))
    numbered = with_positions(lines, list(PLACE))
    return numbered.select(
        "pos", topic.otherwise(raw).alias("topic"), raw.alias("topic_raw")
    )


def synonym_table(classes: DataFrame, order: str | Column) -> DataFrame:
    """(pos, synonym, label) from rows with a class id, a label and synonyms.

    Only topic classes count. If a synonym is listed for several labels, the
    last label wins and the first place is kept.
    """
    place = F.struct("row", "i")
    return (
        classes.where(F.contains(F.col("Class ID"), F.lit("topic")))
        .select(
            (F.col(order) if isinstance(order, str) else order).alias("row"),
            F.col("Preferred Label").alias("label"),
            F.posexplode(
                F.split(F.nullif(F.col("Synonyms"), F.lit("")), r"\|")
            ).alias("i", "synonym"),
        )
        .groupBy("synonym")
        .agg(F.max_by("label", place).alias("label"), F.min(place).alias("pos"))
        .select("pos", "synonym", "label")
    )


def read_synonyms(spark: SparkSession, path: str) -> DataFrame:
    """``synonym_table`` in the order of the files and of their rows."""
    classes = read_csv(spark, path, number=True)
    return synonym_table(classes, classes.columns[-1])


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """One id per line; padding and blank lines are dropped."""
    return _lines(spark, path).where(F.col("line") != "").select(F.col("line").alias("id"))
