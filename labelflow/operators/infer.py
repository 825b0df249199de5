"""Run a user's model over prompts, partition by partition."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from datetime import datetime, timezone

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Model = Callable[[Sequence[str]], Sequence[str]]

MAX_RETRIES = 3
RETRY_DELAY = 5.0
ON_ERROR = ("row", "drop", "fail")

_ADDED = [
    T.StructField("raw_response", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("attempts", T.IntegerType()),
    T.StructField("started_at", T.TimestampType()),
    T.StructField("ended_at", T.TimestampType()),
    T.StructField("partition_id", T.IntegerType()),
]


def infer(
    prompts: DataFrame,
    factory: Callable[[], Model],
    *,
    rows_per_call: int = 1,
    max_retries: int = MAX_RETRIES,
    retry_delay: float = RETRY_DELAY,
    on_error: str = "row",
    partitions: int | None = None,
) -> DataFrame:
    """Add the model's answer to each row of a table with ``prompt``.

    ``factory`` is called once per partition, so a model is loaded once. A call
    is retried; a call over several rows that keeps failing is repeated row by
    row, so one bad prompt does not spoil its neighbours. ``on_error`` says what
    a row that keeps failing becomes: a row with ``error``, nothing, or a failed
    job. ``partitions`` spreads the rows evenly before a slow model.
    """
    if on_error not in ON_ERROR:
        raise ValueError(f"on_error must be one of {ON_ERROR}")
    if partitions:
        prompts = prompts.repartition(partitions)

    def attempt(model: Model, texts: list[str]) -> tuple[list, list, int]:
        error = None
        for n in range(1, max_retries + 1):
            try:
                answers = list(model(texts))
                if len(answers) != len(texts):
                    raise ValueError("the model must give one answer per prompt")
                return answers, [None] * len(texts), n
            except Exception as caught:
                error = caught
                if n < max_retries and retry_delay:
                    time.sleep(retry_delay)
        if len(texts) == 1 and on_error == "fail":
            raise error
        return [None] * len(texts), [str(error)] * len(texts), max_retries

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = None
        context = TaskContext.get()
        for batch in batches:
            model = model or factory()
            rows = []
            texts = batch["prompt"].tolist()
            for low in range(0, len(texts), rows_per_call):
                part = texts[low : low + rows_per_call]
                start = datetime.now(timezone.utc)
                answers, errors, n = attempt(model, part)
                if errors[0] is not None and len(part) > 1:
                    singles = [attempt(model, [text]) for text in part]
                    end = datetime.now(timezone.utc)
                    rows += [(a[0], e[0], k, start, end) for a, e, k in singles]
                else:
                    end = datetime.now(timezone.utc)
                    rows += [(a, e, n, start, end) for a, e in zip(answers, errors)]
            added = pd.DataFrame(
                rows,
                columns=["raw_response", "error", "attempts", "started_at", "ended_at"],
            ).assign(partition_id=context.partitionId() if context else 0)
            yield pd.concat([batch.reset_index(drop=True), added], axis=1)

    schema = T.StructType([*prompts.schema.fields, *_ADDED])
    out = prompts.mapInPandas(run, schema)
    return out.where(F.col("error").isNull()) if on_error == "drop" else out
