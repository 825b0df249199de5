"""Streams: label new files once, survive restarts, watch resources."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelflow.operators.results import one_per_id
from labelflow.sources.table import ResultTable
from labelflow.storage import materialise
from labelflow.streaming.ledger import Session

Transform = Callable[[DataFrame], DataFrame]


def read_stream(
    spark: SparkSession,
    path: str,
    schema: str,
    pattern: str = "*.parquet",
    files_per_trigger: int = 1_000,
) -> DataFrame:
    """New parquet files of a folder; the number of files sets the batch size."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(path)
    )


def write_once(
    source: DataFrame, transform: Transform, out: str, state: str, session: Session | None = None
) -> None:
    """Run all available input through ``transform`` and stop.

    Each micro-batch owns one folder and overwrites it. A replay after a crash
    therefore repeats its own folder and nothing else: exactly one copy of each
    result, and a run that failed continues with the batch that failed. Rows
    with an ``error`` go to ``out``_failed, if the results have that column.
    ``session`` gets a ledger row after each micro-batch and at the end.
    """

    def store(batch: DataFrame, epoch: int) -> None:
        results, folder = transform(batch), f"{out}/epoch={epoch}"
        if "error" in results.columns:
            results, failed = split_failures(results)
            failed.write.mode("overwrite").parquet(f"{out}_failed/epoch={epoch}")
        results.write.mode("overwrite").parquet(folder)
        if session:
            done = batch.sparkSession.read.schema(results.schema).parquet(folder).count()
            session.progress(batch.count(), done)

    if session:
        with session:
            _run(source, store, state)
    else:
        _run(source, store, state)


def upsert_once(
    source: DataFrame, transform: Transform, table: ResultTable, state: str, name: str
) -> None:
    """Run all available input through ``transform`` into a committed table.

    Each micro-batch is one commit of the stream ``name``, which a replay after a
    crash finds done. The newest result of an item stands. The rows of a commit
    are counted by its own write and kept with it (``ResultTable.history``).
    """

    def store(batch: DataFrame, epoch: int) -> None:
        table.upsert(transform(batch), batch=(name, epoch))

    _run(source, store, state)


def _run(source: DataFrame, store: Callable[[DataFrame, int], None], state: str) -> None:
    query = (
        source.writeStream.foreachBatch(store)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def append_once(stream: DataFrame, out: str, state: str) -> None:
    """Run all available input into a parquet sink and stop."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_results(spark: SparkSession, out: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("basePath", out).parquet(out)


def split_failures(results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and failed rows for the dead-letter table.

    The results are stored first, so that a model behind them runs once.
    """
    failed = F.col("error").isNotNull()
    stored = materialise(results)
    return stored.where(~failed), stored.where(failed)


def latest_per_id(results: DataFrame) -> DataFrame:
    """One row per id over all micro-batches: that of the newest ``epoch``.

    An item that is delivered again in a new file is labelled again; its newest
    result stands.
    """
    return one_per_id(results, F.col("epoch"), newest=True)


def replace_once(stream: DataFrame, out: str, state: str) -> DataFrame:
    """Aggregate all available input; every group comes out, open ones too.

    Complete mode: each micro-batch writes the whole aggregate into a folder of
    its own, and the newest one is read. For aggregates with few groups.
    """

    def store(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    query = (
        stream.writeStream.foreachBatch(store)
        .outputMode("complete")
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    schema = T.StructType([*stream.schema.fields, T.StructField("epoch", T.LongType())])
    every = stream.sparkSession.read.schema(schema).option("basePath", out).parquet(out)
    newest = every.agg(F.max("epoch").alias("epoch"))
    return every.join(F.broadcast(newest), "epoch", "left_semi").drop("epoch")


def drop_repeats(stream: DataFrame, key: str, at: str, delay: str) -> DataFrame:
    """One row per key; a repeat later than ``delay`` is not held in state."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark([key])


def resource_windows(
    samples: DataFrame, width: str, slide: str | None = None, delay: str = "10 minutes"
) -> DataFrame:
    """Peak and mean CPU and memory per time window (at, cpu_percent, memory_mb)."""
    window = F.window("at", width, slide) if slide else F.window("at", width)
    return (
        samples.withWatermark("at", delay)
        .groupBy(window.alias("w"))
        .agg(
            F.count("*").alias("n_samples"),
            F.max("cpu_percent").alias("peak_cpu"),
            F.avg("cpu_percent").alias("avg_cpu"),
            F.max("memory_mb").alias("peak_memory"),
            F.avg("memory_mb").alias("avg_memory"),
        )
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "n_samples",
            "peak_cpu",
            "avg_cpu",
            "peak_memory",
            "avg_memory",
        )
    )
