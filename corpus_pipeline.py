"""Five stages that turn raw documents into packed training sequences."""

from __future__ import annotations

import os
import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import labelflow  # noqa: E402
from labelflow.llm import mixing, packing, quality, similar, substring_dedup  # noqa: E402
from labelflow.llm.common import table  # noqa: E402
from labelflow.llm.queries import CAPACITY, MIX, PACK_END, WORD_BPE, tokenizer_path  # noqa: E402
from labelflow.storage import scratch_dir  # noqa: E402

# Python workers get the package's functions by value and need no import path.
cloudpickle.register_pickle_by_value(labelflow)

#: The near-duplicate stage finds texts whose five-word shingles have a similarity
#: of 0.8 or more. Candidates are within RADIUS bits in the fingerprints of their
#: distinct words (covering tables) and within ALSO_RADIUS in those of their
#: shingles, where texts of similarity 0.8 have 10 on average, with a deviation
#: of 3, and unrelated ones 32.
SHINGLE, SIMILARITY = 5, 0.8
RADIUS, ALSO_RADIUS = 6, 19

#: SQL has neither the classifier nor the hashes: tested against plain versions.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the classifier, which is fitted on
    the labelled rows of the documents given."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least doc_id, of each near-duplicate group."""
    return similar.keep_dissimilar(docs, SHINGLE, SIMILARITY, RADIUS, ALSO_RADIUS)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur earlier in the table."""
    return substring_dedup.remove_repeats(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks, up to twice."""
    return mixing.mix_documents(docs, MIX)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, token ids included, with their places in sequences."""
    packed = packing.pack_documents(
        docs, "doc_id", "text", tokenizer_path(WORD_BPE), PACK_END, CAPACITY, with_ids=True
    )
    return packed.withColumnRenamed("key", "doc_id")


STAGES = [
    ("quality rules", quality_stage),
    ("near-duplicate removal", near_dedup_stage),
    ("substring removal", substring_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each writes a table that the next reads."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        path = scratch_dir(spark)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
