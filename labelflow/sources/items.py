"""Read text tables and project them to items (id, text, metadata)."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelflow.functions.text import strip
from labelflow.operators.positions import free_name, numbered_files, quoted, with_positions
from labelflow.sources import ranges

NO_DESCRIPTION = "No Description"

# The words a CSV file may use for a missing value.
MISSING_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]


@dataclass(frozen=True)
class DatasetConfig:
    """Which columns make up an item."""

    text_columns: Sequence[str] = ("description",)
    metadata_mapping: Mapping[str, str] = field(default_factory=dict)
    id_column: str | None = None
    separator: str = " "
    required: Sequence[str] = ()
    #: Fields of CSV files may hold line breaks; False saves a scan for quotes.
    multi_line: bool = True

    @classmethod
    def named(cls, configs: Mapping[str, Mapping[str, Any]], name: str):
        """The configuration of a data set; unknown names use the usual columns."""
        if name not in configs:
            return cls(metadata_mapping={"name": "title"})
        return cls(**configs[name])


def read_configs(spark: SparkSession, path: str) -> dict[str, dict[str, Any]]:
    """Data set configurations from a JSON file: name to the fields of
    ``DatasetConfig``."""
    return json.loads(spark.read.text(path, wholetext=True).first()["value"])


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def combine_text(df: DataFrame, columns: Sequence[str], separator: str = " ") -> Column:
    """Join the stripped non-null columns; absent columns are skipped."""
    present = [strip(F.col(c).cast("string")) for c in columns if c in df.columns]
    if not present:
        return F.lit(NO_DESCRIPTION)
    all_null = F.coalesce(*present).isNull()
    return F.when(all_null, F.lit(NO_DESCRIPTION)).otherwise(
        F.concat_ws(separator, *present)
    )


def extract_metadata(df: DataFrame, mapping: Mapping[str, str]) -> Column:
    """Map of the renamed non-null columns, values as strings."""
    pairs = [
        part
        for column, key in mapping.items()
        if column in df.columns
        for part in (F.lit(key), F.col(column).cast("string"))
    ]
    if not pairs:
        return F.create_map().cast("map<string,string>")
    return F.map_filter(F.create_map(*pairs), lambda _, value: value.isNotNull())


def assign_ids(
    df: DataFrame,
    id_column: str | None,
    order: Sequence[str | Column] | None = None,
    number: str | None = None,
    name: str = "item_id",
) -> DataFrame:
    """Add ``name``: the column as text (null is empty), else 0..n-1.

    Without an id column rows are numbered by ``order``, a unique key, or have
    their number in the column ``number`` (see ``read_table``), which goes.
    """
    if id_column and id_column in df.columns:
        value = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
        return df.withColumn(name, value)
    if order is not None:
        number = name
        df = with_positions(df, list(order), name)
    elif number is None:
        raise ValueError("rows without an id column need an order")
    keep = quoted([c for c in df.columns if c != number])
    return df.select(*keep, F.col(number).cast("string").alias(name))


def to_items(
    df: DataFrame,
    config: DatasetConfig,
    order: Sequence[str | Column] | None = None,
    number: str | None = None,
) -> DataFrame:
    """Project to items. Columns that ``config.required`` names must exist."""
    require_columns(df, config.required)
    name = free_name(df, "item_id")
    df = assign_ids(df, config.id_column, order, number, name)
    return df.select(
        F.col(name).alias("id"),
        combine_text(df, config.text_columns, config.separator).alias("text"),
        extract_metadata(df, config.metadata_mapping).alias("metadata"),
    )


def read_csv(
    spark: SparkSession, path: str, multi_line: bool = True, number: bool = False
) -> DataFrame:
    """All columns as strings. Big files are split among tasks, also inside of
    fields with line breaks, unless ``multi_line=False`` says there are none.
    ``number`` adds a last column, 0..n-1 in the order of files and rows."""
    reader = (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )
    if multi_line:
        names = reader.option("multiLine", True).csv(path).columns
        df = ranges.read_csv(spark, path, names, number)
    else:
        df = reader.csv(path)
        df = numbered_files(df, free_name(df, "_number")) if number else df
        names = df.columns[:-1] if number else df.columns
    known = [
        F.when(~c.isin(MISSING_WORDS), c).alias(n) for c, n in zip(quoted(names), names)
    ]
    return df.select(*known, *quoted(df.columns[len(names) :]))


def read_json(
    spark: SparkSession, path: str, columns: Sequence[str], lines: bool, number: bool = False
) -> DataFrame:
    """Named fields as strings from JSON array files or from JSON lines; both are
    split among tasks. ``number`` adds a last column, 0..n-1 in file order."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    if not lines:
        return ranges.read_json_array(spark, path, schema, number)
    df = spark.read.schema(schema).json(path)
    return numbered_files(df, free_name(df, "_number")) if number else df


def read_table(
    spark: SparkSession, path: str, config: DatasetConfig, number: bool = False
) -> DataFrame:
    """Read by file extension: csv, json (array), jsonl or parquet. ``number``
    adds a last column, 0..n-1 in the order of files and rows."""
    name = path.rstrip("/").lower()
    used = [*config.text_columns, *config.metadata_mapping]
    if config.id_column:
        used.append(config.id_column)
    columns = list(dict.fromkeys(used))
    if name.endswith(".csv"):
        return read_csv(spark, path, config.multi_line, number)
    if name.endswith((".json", ".jsonl")):
        return read_json(spark, path, columns, name.endswith(".jsonl"), number)
    if name.endswith(".parquet"):
        df = spark.read.parquet(path)
        return numbered_files(df, free_name(df, "_number")) if number else df
    raise ValueError(f"cannot read {path}: use csv, json, jsonl or parquet")


def read_items(spark: SparkSession, path: str, config: DatasetConfig) -> DataFrame:
    number = not config.id_column
    df = read_table(spark, path, config, number)
    return to_items(df, config, number=df.columns[-1] if number else None)


def source_check(df: DataFrame, name: str, id_column: str) -> DataFrame:
    """One row: rows, rows without id, and whether the source can be used."""
    return df.agg(
        F.lit(name).alias("source"),
        F.count("*").alias("n_rows"),
        F.count_if(F.col(id_column).isNull()).alias("n_null_ids"),
        (F.count("*") > 0).alias("valid"),
    )
