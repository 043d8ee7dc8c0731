"""Time axes, templates and partition catalogues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoframe.functions.times import ntz


def time_axis(df: DataFrame, start: Column, end: Column, every: str) -> DataFrame:
    """df with a row for each time of a regular axis, both ends included if hit; ``every`` is an interval like '2 MINUTES'."""
    return df.withColumn("time", F.explode(F.sequence(ntz(start), ntz(end), F.expr(f"INTERVAL {every}"))))


def month_ends(df: DataFrame, start: Column, end: Column) -> DataFrame:
    """df with a row for each last day of a month between the first and the last month."""
    months = F.sequence(F.date_trunc("month", start).cast("date"), F.date_trunc("month", end).cast("date"), F.expr("INTERVAL 1 MONTH"))
    return df.withColumn("time", F.explode(F.transform(months, lambda m: ntz(F.last_day(m)))))


def span(df: DataFrame, time: str) -> DataFrame:
    """One row with the ends of a time column."""
    return df.agg(F.min(time).alias("start"), F.max(time).alias("end"))


def available_times(ranges: DataFrame, cadence_s: int, now: str) -> DataFrame:
    """All scan times of each source's operating range (start, end); an open end is ``now``."""
    end = F.coalesce("end", F.lit(now).cast("timestamp_ntz"))
    return time_axis(ranges.where(F.col("start") <= end), F.col("start"), end, f"{cadence_s} SECONDS").drop("start", "end")


def template(times: DataFrame, coordinates: DataFrame, fills: dict[str, object]) -> DataFrame:
    """Every time at every coordinate with fill values; a lazy view, made partition by partition where it is used."""
    return times.crossJoin(coordinates).withColumns({k: F.lit(v) for k, v in fills.items()})


def windows(df: DataFrame, start: Column, end: Column, unit: str, end_offset: int = 0, keys: DataFrame | None = None) -> DataFrame:
    """Partition windows (start, end) of an hour, day, week or month; a negative offset leaves out the last ones, keys make a second dimension."""
    interval = F.expr(f"INTERVAL 1 {unit.upper()}")
    first, last = F.date_trunc(unit, start).cast("timestamp_ntz"), F.date_trunc(unit, end).cast("timestamp_ntz")
    shift = F.expr(f"INTERVAL {-end_offset} {unit.upper()}")
    begun = df.select(F.explode(F.sequence(first, last - shift, interval)).alias("start"))
    made = begun.withColumn("end", F.col("start") + interval)
    return made if keys is None else made.crossJoin(keys)
