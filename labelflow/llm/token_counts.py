"""Token counts of whole texts, without keeping any ids."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelflow.llm.common import by_bytes, text_batches, text_or_empty
from labelflow.llm.tokens import PieceCounter, load_tokenizer

#: Characters of all pieces the library gets in one call, and bytes of texts
#: that are split at once.
CALL = 1 << 18
TEXT_BYTES = 4 << 20


def count_tokens(df: DataFrame, keys: list[str], text: str, tokenizer: str) -> DataFrame:
    """One row per row of ``df``: ``keys``, n_bytes (UTF-8) and n_tokens.

    ``tokenizer`` is the path of a file for ``tokenizers`` (.json) or
    ``sentencepiece`` (.model); counts are the library's, without begin, end or
    other added tokens. Special strings inside a text count as the library
    takes them by default. Map-only: no shuffle. Texts for .json files are split
    at safe boundaries, and each task encodes a distinct piece once, in calls
    balanced by size; those for .model files stay whole, as sentencepiece joins
    white space. Only lengths are kept.

    A null or empty text has 0 bytes and 0 tokens. Repeated rows, null keys and
    an empty table need no care; other columns of ``df``, whatever their names,
    are not read.
    """
    fields = [df.schema[k] for k in keys]
    schema = T.StructType(
        [
            *fields,
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
        ]
    )
    whole = tokenizer.endswith(".model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for batch in by_bytes(batches, "_text", TEXT_BYTES):
            texts = batch.column("_text")
            if whole:
                counter = counter or load_tokenizer(tokenizer)
                found = counter.encode(texts.to_pylist(), num_threads=1)
                counts = np.array([len(x) for x in found], np.int64)
            else:
                counter = counter or PieceCounter(tokenizer, CALL)
                counts = counter.count(texts)
            columns = [batch.column(f"_k{i}") for i in range(len(keys))]
            yield pa.RecordBatch.from_arrays(
                [*columns, batch.column("_bytes"), pa.array(counts)], names=schema.names
            )

    return text_batches(df).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        text_or_empty(text).alias("_text"),
        F.octet_length(text_or_empty(text)).cast("long").alias("_bytes"),
    ).mapInArrow(run, schema)
