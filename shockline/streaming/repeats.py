"""Exact removal of repeated events with state that leaves: arbitrary state with timers."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle


class FirstOfEach(StatefulProcessor):
    """The first row of each key; a timer forgets the key when the watermark is `horizon` behind that row."""

    def __init__(self, millis: str, horizon: timedelta):
        self.millis, self.horizon = millis, int(horizon.total_seconds() * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("until", "until long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        first = min(rows, key=lambda r: r[self.millis])
        # a batch's rows come before its timers: what a timer of this batch is about to forget counts as forgotten
        if not self.seen.exists() or self.seen.get()[0] <= timerValues.getCurrentWatermarkInMs():
            until = max(first[self.millis], timerValues.getCurrentWatermarkInMs()) + self.horizon
            self.seen.update((until,))
            self.handle.registerTimer(until)
            yield first

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.seen.exists() and self.seen.get()[0] <= expiredTimerInfo.getExpiryTimeInMs():
            self.seen.clear()
        yield from ()

    def close(self) -> None:
        pass


def first_within(events: DataFrame, key: str, time: str, horizon: timedelta) -> DataFrame:
    """One row for each key whose repetitions lie within the horizon of its first row, on a stream with a watermark on `time`.

    A repetition that arrives before the watermark has passed the first row's time by the horizon is dropped, however late it is
    in arrival; rows behind the watermark are dropped and counted by Spark. Then the key's state leaves. Needs the RocksDB state store.
    """
    if horizon <= timedelta(0):
        raise ValueError("the horizon must be positive")
    timed = events.withColumn("_millis", F.unix_millis(time))
    return timed.groupBy(key).transformWithState(FirstOfEach("_millis", horizon), timed.schema, "Append", "EventTime", eventTimeColumnName=time).drop("_millis")
