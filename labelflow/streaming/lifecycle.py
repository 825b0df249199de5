"""Batches as state machines over a stream of status events."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from labelflow.functions.status import DONE, FAILED
from labelflow.streaming.repeats import as_text, from_text, group_of

_OUT = ["id", "kind", "from_status", "to_status", "at_ms", "since_ms"]


class BatchLife(StatefulProcessor):
    """Transitions of the batches of a group, and an alarm where a status lasts too long.

    ``waiting`` holds events that the watermark has not passed, so that they are
    taken in the order of their times however they arrive; ``now`` holds each
    batch's status, since when, and whether its alarm is out. Both are read and
    written for a group of batches together. Timers stand at the next moments at
    which something can happen.
    """

    def __init__(self, limits: dict[str, int], final: tuple[str, ...]):
        self.limits, self.final = limits, final

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "id string, ms long, status string")
        self.now = handle.getListState("now", "id string, status string, since long, alarmed boolean")
        self.handled: dict = {}  # the watermark up to which groups were looked at

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for some in rows:
            events = [
                (one, int(ms), status)
                for one, ms, status in zip(*(some[c].tolist() for c in ("id", "ms", "status")))
                if status is not None
            ]
            if events:
                self.waiting.appendList(events)
                self.handle.registerTimer(min(ms for _, ms, _ in events))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        if self.handled.get(key) == passed:  # by another timer
            return
        self.handled[key] = passed
        ready: dict[str | None, list] = {}
        later = []
        waiting = list(self.waiting.get()) if self.waiting.exists() else []
        for one, ms, status in waiting:
            if ms <= passed:
                ready.setdefault(one, []).append((ms, status))
            else:
                later.append((one, ms, status))
        now = {one: rest for one, *rest in self.now.get()} if self.now.exists() else {}
        found = []
        for one in {**now, **ready}:
            status, since, alarmed = now.get(one, (None, None, False))
            for ms, following in [*sorted(ready.get(one, ())), (passed, None)]:
                due = None if status is None or alarmed else self._due(status, since)
                if due is not None and due <= ms:
                    found.append((one, "overdue", status, None, due, since))
                    alarmed = True
                if following is not None and following != status:
                    found.append((one, "transition", status, following, ms, since))
                    status, since, alarmed = following, ms, False
                    if status in self.final:
                        status, since = None, None
            now[one] = (status, since, alarmed)
        if ready:
            self.waiting.put(later) if later else self.waiting.clear()
        now = {one: state for one, state in now.items() if state[0] is not None}
        if found:
            self.now.put([(one, *state) for one, state in now.items()]) if now else self.now.clear()
        dues = [self._due(status, since) for status, since, alarmed in now.values() if not alarmed]
        next_moments = [ms for ms in (*dues, *(ms for _, ms, _ in later)) if ms is not None]
        if next_moments:
            self.handle.registerTimer(min(next_moments))
        if found:
            yield pd.DataFrame(found, columns=_OUT).astype({"since_ms": "Int64"})

    def _due(self, status: str, since: int) -> int | None:
        limit = self.limits.get(status)
        return None if limit is None else since + 1000 * limit

    def close(self) -> None:
        pass


def batch_life(
    events: DataFrame, delay: str, limits: dict[str, int], final: tuple[str, ...] = (*DONE, *FAILED)
) -> DataFrame:
    """What happened to batches, from a stream of (batch_id, status, at) events.

    A row per ``transition`` (from_status, to_status, at, seconds in the status
    before), and an ``overdue`` row at the moment a status has stood for its
    ``limits`` seconds without another until then or at that very moment. The
    first transition of a batch comes from null. A status that is repeated is no
    transition. With a ``final`` status the life of a batch and its state end;
    whatever comes behind begins a new one.

    Rows come out when the watermark, ``delay`` behind the newest event, has
    passed them, so they do not depend on the order of arrival; events that come
    later than ``delay`` are dropped. Equal times are taken by status. Times count
    in milliseconds. An event without a status only moves the clock on; one
    without a time is left out; those without an id are one batch. Start the
    query inside of ``repeats.keyed_state``.
    """
    of = events.schema["batch_id"].dataType
    rows = events.where(F.col("at").isNotNull()).select(
        as_text(F.col("batch_id"), of).alias("id"), "status", "at", F.unix_millis("at").alias("ms")
    )
    found = (
        rows.withWatermark("at", delay)
        .withColumn("group", group_of(F.col("id")))
        .groupBy("group")
        .transformWithStateInPandas(
            statefulProcessor=BatchLife(limits, final),
            outputStructType=(
                "id string, kind string, from_status string, to_status string, at_ms long, since_ms long"
            ),
            outputMode="Append",
            timeMode="EventTime",
        )
    )
    return found.select(
        from_text(F.col("id"), of).alias("batch_id"), "kind", "from_status", "to_status", F.timestamp_millis("at_ms").alias("at"),
        ((F.col("at_ms") - F.col("since_ms")) / 1000).alias("seconds"),
    )
