"""Incremental jobs as Structured Streaming: ingest, windows with a closing delay, exactly-once and idempotent sinks.

Every job runs what is there and stops (trigger availableNow); with another trigger it keeps running.
Event times are TIMESTAMP, as watermarks need; the session's time zone should be UTC.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoframe.sources.store import Store
from geoframe.streaming.runs import timers, tracked_runs


def read_files(spark: SparkSession, path: str, schema: str, time: str, files_per_batch: int = 64) -> DataFrame:
    """A stream of Parquet files, its time column as TIMESTAMP. path may be a folder or a single file.

    Spark refuses a single file, but takes a pattern that matches it: the name's first letter as a class.
    """
    head, _, name = path.rstrip("/").rpartition("/")
    df = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(f"{head}/[{name[0]}]{name[1:]}")
    return df.withColumn(time, F.col(time).cast("timestamp"))


def to_files(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Appends finished rows as Parquet, exactly once."""
    stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path).awaitTermination()


def each_batch(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def closed_windows(stream: DataFrame, time: str, width: str, delay: str, keys: list[str], **sums: Column) -> DataFrame:
    """Sums by tumbling window and keys, given out when the watermark has passed the window by ``delay``."""
    return stream.withWatermark(time, delay).groupBy(F.window(time, width), *keys).agg(*(c.alias(n) for n, c in sums.items())).select(F.col("window.start").cast("timestamp_ntz").alias("start"), *keys, *sums)


def windows(df: DataFrame, time: str, width: str, keys: list[str], **sums: Column) -> DataFrame:
    """The batch twin of closed_windows, all windows."""
    return df.groupBy(F.window(time, width), *keys).agg(*(c.alias(n) for n, c in sums.items())).select(F.col("window.start").cast("timestamp_ntz").alias("start"), *keys, *sums)


def once_by_name(stream: DataFrame, time: str, delay: str, name: str) -> DataFrame:
    """First row of each product name; a name is remembered until the watermark has passed it by ``delay``."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([name])


def region_sink(store: Store) -> Callable[[DataFrame, int], None]:
    """Late or repeated scenes replace their region; running a batch again changes nothing."""
    return lambda batch, _: store.write_regions(batch.select(store.schema.names)) and None


def upsert_sink(store: Store, keys: list[str]) -> Callable[[DataFrame, int], None]:
    return lambda batch, _: store.upsert(batch.select(store.schema.names), keys) and None


def ledger_sink(store: Store, product: str, offset: int = 0) -> Callable[[DataFrame, int], None]:
    """Products that no committed batch has; a batch that was committed is skipped, so a retry is safe."""
    return lambda batch, number: store.append_products(batch.select(store.schema.names), product, number + offset) and None


def _changed_runs(stream: DataFrame, run: str, step: str, time: str, delay: str) -> DataFrame:
    """(time, run, seen, steps, before) of each run that a batch of a stream has rows of: its different steps, how many they are, and how many of them other batches brought.

    State is the set of steps of each run and time of its start, each with the times of the batches that
    brought it, until the watermark has passed the run's time by ``delay``; Spark keeps it, no Python runs.
    A retried batch has the time it had, so it counts as itself. Null steps count as none.
    """
    now = F.current_timestamp()
    given = stream.withWatermark(time, delay).withColumn("_brought", now)
    brought = F.when(F.col(step).isNotNull(), F.struct(F.col(step).alias("step"), F.col("_brought").alias("at")))
    held = given.groupBy(time, run).agg(F.collect_set(brought).alias("_held"))
    different = lambda held: F.array_distinct(F.transform(held, lambda s: s["step"]))
    other = F.filter("_held", lambda s: s["at"] != F.col("_now"))
    seen = held.select(time, run, "_held", now.alias("_now")).select(time, run, different(F.col("_held")).alias("seen"), F.size(different(other)).cast("long").alias("before"))
    return seen.select(time, run, "seen", F.size("seen").cast("long").alias("steps"), "before")


def complete_runs(stream: DataFrame, run: str, step: str, expected: int, time: str, delay: str, path: str, checkpoint: str) -> None:
    """Writes (run, steps) of each run, once, in the batch in which its last step arrives.

    A run is complete now and wasn't before if its steps of other batches are too few and all are
    enough, so no batch reads what others have written, and a retried one overwrites its own folder.
    ``deadline_runs`` also tells the runs that never complete.
    """

    def write(batch: DataFrame, number: int) -> None:
        new = batch.where((F.col("steps") >= expected) & (F.col("before") < expected)).select(run, "steps")
        new.write.mode("overwrite").parquet(f"{path}/batch={number}")

    counted = _changed_runs(stream.where(F.col(step).isNotNull()), run, step, time, delay)
    counted.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def deadline_runs(stream: DataFrame, run: str, step: str, expected: int, time: str, delay: str, path: str, checkpoint: str, first: int = 0) -> None:
    """Tells each run of a stream, once, as ``tracked_runs`` does, but without Python; ``told_runs`` reads what it tells.

    A first stream writes each batch's changed runs, whose new complete ones it thereby tells. A second
    one takes these up: it holds a run's last count until the watermark, ``delay`` behind the latest
    time, has reached the run's time, and tells it as expired if steps are lacking. It sees only rows
    that weren't late for the first one, and its watermark is never ahead, so no run is told twice or
    lost, however batches fall and wherever a job was ended. A run is known by its name and time; rows without either are left out, any
    different steps count, those from ``first`` on are named as missing.
    """
    given = stream.where(F.col(run).isNotNull() & F.col(time).isNotNull())
    wanted = F.array(*(F.lit(first + k).cast(stream.schema[step].dataType) for k in range(expected)))
    changed = _changed_runs(given, run, step, time, delay).select(time, run, "steps", "before", F.array_except(wanted, "seen").alias("missing"))

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/changed/{number}")

    changed.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", f"{checkpoint}/changed").trigger(availableNow=True).start().awaitTermination()
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in changed.schema)
    last = stream.sparkSession.readStream.schema(schema).parquet(f"{path}/changed/*").withWatermark(time, delay)
    closed = last.groupBy(time, run).agg(F.max(F.struct("steps", "missing")).alias("_last"))
    to_files(closed.where(F.col("_last.steps") < expected).select(time, run, "_last.steps", "_last.missing"), f"{path}/expired", f"{checkpoint}/expired")


def told_runs(spark: SparkSession, path: str, schema: str, expected: int) -> DataFrame:
    """(run, status, steps, missing, time) of the runs that ``deadline_runs`` has told; schema: run and time, as DDL."""
    run, time = (x.split()[0] for x in schema.split(", "))
    read = lambda name, more: spark.read.schema(f"{schema}, steps long, missing array<long>{more}").parquet(f"{path}/{name}")
    complete = read("changed/*", ", before long").where((F.col("steps") >= expected) & (F.col("before") < expected)).withColumns({"status": F.lit("complete"), "missing": F.array().cast("array<long>")})
    return complete.select(run, "status", "steps", "missing", time).unionByName(read("expired", "").withColumn("status", F.lit("expired")).select(run, "status", "steps", "missing", time))


def window_number(time: Column, unit: str) -> Column:
    """How many calendar windows of a unit (hour, day, week, month, quarter, year) have begun since 1970 before that of a time; weeks begin on Mondays."""
    months = (F.year(time) - 1970) * 12 + F.month(time) - 1
    days = F.date_diff(time.cast("date"), F.lit("1970-01-01").cast("date"))
    numbers = {"hour": F.floor(F.unix_seconds(F.date_trunc("hour", time).cast("timestamp")) / 3600), "day": days, "week": F.floor((days + 3) / 7), "month": months, "quarter": F.floor(months / 3), "year": F.year(time) - 1970}
    return numbers[unit].cast("long")


def calendar_windows(stream: DataFrame, time: str, unit: str, end_offset: int, keys: list[str], **sums: Column) -> DataFrame:
    """(start, end, keys, sums) by calendar window, given out once the stream has rows of a window that is -end_offset + 1 later.

    The watermark counts windows, not seconds: the event time that Spark sees is the window's number
    as so many seconds, so months of any length and weeks from Monday close by the same rule, and a
    row of a closed window is late. An end_offset of 0 waits for the next window, -2 for two more.
    """
    slot = F.timestamp_seconds(window_number(F.col(time), unit))
    start = F.date_trunc(unit, F.col(time)).cast("timestamp_ntz")
    slotted = stream.withColumn("_slot", slot).withColumn("start", start).withWatermark("_slot", f"{1 - end_offset} seconds")
    made = slotted.groupBy("_slot", "start", *keys).agg(*(c.alias(n) for n, c in sums.items()))
    return made.select("start", (F.col("start") + F.expr(f"INTERVAL {3 if unit == 'quarter' else 1} {'MONTH' if unit == 'quarter' else unit.upper()}")).alias("end"), *keys, *sums)


def parts_by_time(df: DataFrame, time: str, parts: int) -> list[DataFrame]:
    """df as parts that follow each other in time and have about as many rows, for jobs that take up what has arrived; rows without a time are in the first."""
    at = F.unix_micros(F.col(time).cast("timestamp"))
    bounds = df.select(F.percentile_approx(at, F.lit([k / parts for k in range(1, parts)])).alias("b")).first()["b"] or []
    low = F.coalesce(at, F.lit(-(1 << 63)))
    number = F.lit(0)
    for b in bounds:
        number = number + (low > b).cast("int")
    return [df.where(number == k) for k in range(len(bounds) + 1)]
