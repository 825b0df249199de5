"""Repeats in a stream, told by keyed state with a lifetime of its own."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from datetime import timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: Groups that keys are dealt into. A call into keyed state costs far more than a
#: row of it, so a group's keys are read and written together. State is laid out
#: by it: a stream keeps its number.
GROUPS = 1 << 13
#: Rows of a group that are put in order at once.
HELD = 200_000


def group_of(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(GROUPS)).cast("int")


def as_text(key: Column, of: T.DataType) -> Column:
    """A key as text, equal where the keys are; null stays null. In pandas, numbers
    next to nulls would become floating-point ones."""
    if isinstance(of, T.TimestampType):
        return F.unix_micros(key).cast("string")
    if isinstance(of, T.BinaryType):
        return F.hex(key)
    if isinstance(of, T.FractionalType) and not isinstance(of, T.DecimalType):
        return F.when(key == 0, F.lit(0)).otherwise(key).cast("string")
    if isinstance(of, (T.StructType, T.ArrayType)):
        return F.to_json(key, {"ignoreNullFields": "false"})
    return key.cast("string")


def from_text(text: Column, of: T.DataType) -> Column:
    if isinstance(of, T.TimestampType):
        return F.timestamp_micros(text.cast("long"))
    if isinstance(of, T.BinaryType):
        return F.unhex(text)
    if isinstance(of, (T.StructType, T.ArrayType)):
        return F.from_json(text, of)
    return text.cast(of)


def _together(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: list[pd.DataFrame] = []
    for some in rows:
        held.append(some)
        if sum(map(len, held)) >= HELD:
            yield pd.concat(held)
            held = []
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


class FirstOfKey(StatefulProcessor):
    """Lets the first row of a key through, and others only after its lifetime.

    A group of keys has a list of its keys (column ``key``), each with the time
    of the row that went through. A timer at the least of these times plus the
    lifetime, in event time, removes what has ended, so state holds the keys of
    one lifetime and a sixteenth, and is written anew at most that often.
    """

    def __init__(self, at: str, lifetime: timedelta, columns: list[str]):
        self.at, self.columns = at, columns
        self.span = int(lifetime.total_seconds() * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getListState("seen", "key string, ms long")

    def _register(self, times: Iterable[int]) -> None:
        step = max(1, self.span // 16)
        self.handle.registerTimer(-(-(min(times) + self.span) // step) * step)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last = dict(self.seen.get()) if self.seen.exists() else {}
        new: dict[str | None, int] = {}
        again = False
        for some in _together(rows):
            some = some.sort_values(self.at, kind="stable")
            times = some[self.at].astype("datetime64[ms]").astype("int64").tolist()
            kept = []
            for place, (k, ms) in enumerate(zip(some["key"].tolist(), times)):
                if k not in last or ms >= last[k] + self.span:
                    kept.append(place)
                    again |= k in last
                    last[k] = new[k] = ms
            if kept:
                yield some.iloc[kept][self.columns]
        if again:
            self.seen.put(list(last.items()))
        elif new:
            self.seen.appendList(list(new.items()))
        if new:
            self._register(new.values())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # A later row of a key may have begun a lifetime since.
        passed = timerValues.getCurrentWatermarkInMs()
        if self.seen.exists():
            held = list(self.seen.get())
            lives = [(k, ms) for k, ms in held if ms + self.span > passed]
            if not lives:
                self.seen.clear()
            else:
                if len(lives) < len(held):
                    self.seen.put(lives)
                self._register(ms for _, ms in lives)
        return iter(())

    def close(self) -> None:
        pass


def drop_repeats_for(
    stream: DataFrame, key: str, at: str, delay: str, lifetime: timedelta
) -> DataFrame:
    """One row per key and ``lifetime``: the first that arrives, by ``at`` within a
    micro-batch's rows.

    ``delay`` only tells how late rows may come; a repeat that comes much later
    than it is still dropped while the key's state lives, unlike with state that
    ends with the watermark. Rows later than ``delay`` are dropped as late. Start
    the query inside of ``keyed_state``.
    """
    # Pandas sees plain column names, and whole numbers, which may be next to
    # nulls, as text.
    names = {f.name: f"c{i}" for i, f in enumerate(stream.schema)}
    whole = [isinstance(f.dataType, T.IntegralType) for f in stream.schema]
    columns = [
        (F.col(f"`{f.name}`").cast("string") if w else F.col(f"`{f.name}`")).alias(names[f.name])
        for f, w in zip(stream.schema, whole)
    ]
    passed = [
        T.StructField(names[f.name], T.StringType() if w else f.dataType)
        for f, w in zip(stream.schema, whole)
    ]
    of_key = as_text(F.col(f"`{key}`"), stream.schema[key].dataType)
    found = (
        stream.withWatermark(at, delay)
        .select(*columns, of_key.alias("key"))
        .withColumn("group", group_of(F.col("key")))
        .groupBy("group")
        .transformWithStateInPandas(
            statefulProcessor=FirstOfKey(names[at], lifetime, list(names.values())),
            outputStructType=T.StructType(passed),
            outputMode="Append",
            timeMode="EventTime",
        )
    )
    return found.select(
        *[F.col(names[f.name]).cast(f.dataType).alias(f.name) for f in stream.schema]
    )


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """The state store that keyed state needs, for queries started inside."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)
