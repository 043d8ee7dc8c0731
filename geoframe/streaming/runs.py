"""Forecast runs as keyed state with event-time timers: told once when complete, told as expired at their deadline, then forgotten."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def timers(spark: SparkSession) -> Iterator[None]:
    """Streams that are started inside use the state store that keeps timers."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


class RunTracker(StatefulProcessor):
    """A run's state is a bitmap of its steps, whether it was told, and one timer at its time.

    The timer fires when the watermark has passed the run's time, which is so long after it as the
    watermark's delay. Steps that repeat, or come before ``first`` or at or after ``last``, change nothing.
    """

    def __init__(self, first: int, last: int, expected: int):
        self.first, self.last, self.expected = first, last, expected

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", "seen binary, told boolean, began long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self.run.get()
        seen, told, began = (int.from_bytes(held[0], "little"), held[1], held[2]) if held else (0, False, None)
        for row in rows:
            if row.step is not None and self.first <= row.step < self.last:
                seen |= 1 << row.step - self.first
            if began is None:
                began = row.began
                self.handle.registerTimer(began)
        full = seen.bit_count() >= self.expected
        if full and not told:
            yield self._row(key, "complete", seen, began)
        self.run.update((seen.to_bytes(-(-seen.bit_length() // 8), "little"), told or full, began))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = self.run.get()
        if held and not held[1]:
            yield self._row(key, "expired", int.from_bytes(held[0], "little"), held[2])
        self.run.clear()

    def _row(self, key, status: str, seen: int, began: int) -> Row:
        missing = [self.first + k for k in range(self.expected) if not seen >> k & 1] if status == "expired" else []
        return Row(run=key[0], status=status, steps=seen.bit_count(), missing=missing, began=began)


def tracked_runs(stream: DataFrame, run: str, step: str, expected: int, time: str, delay: str, first: int = 0, last: int | None = None) -> DataFrame:
    """(run, status, steps, missing, time) of each run of a stream, once.

    ``complete`` comes in the batch that brings the last of ``expected`` different steps, ``expired``
    once the watermark, ``delay`` behind the latest time, has reached the time of a run that isn't
    complete, with the steps that it lacks. Then nothing of the run is kept, and rows that come later
    are dropped as late. Rows without run or time are left out. Start the result inside ``timers``.
    """
    given = stream.where(F.col(run).isNotNull() & F.col(time).isNotNull()).withWatermark(time, delay)
    keyed = given.select(F.col(run), F.col(step).cast("long").alias("step"), F.col(time), F.unix_millis(time).alias("began"))
    schema = f"run {stream.schema[run].dataType.simpleString()}, status string, steps long, missing array<long>, began long"
    told = keyed.groupBy(run).transformWithState(RunTracker(first, last or first + expected, expected), schema, "Append", "EventTime")
    return told.select(F.col("run").alias(run), "status", "steps", "missing", F.timestamp_millis("began").alias(time))
