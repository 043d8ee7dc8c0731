"""Concatenation, set operations, deduplication, counts, forecast steps and order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from geoframe.functions.times import micros, step_seconds


def concat(parts: list[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Rows of all parts, columns matched by name; with ``allow_missing`` absent ones are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), parts)


def concat_along(parts: dict[str, DataFrame], axis: str) -> DataFrame:
    """Rows of all parts with the part's label in a new axis column; columns that a part lacks are null."""
    return concat([df.withColumn(axis, F.lit(label)) for label, df in parts.items()], allow_missing=True)


def first_wins(parts: list[DataFrame], key: list[str]) -> DataFrame:
    """One row for each key, from the earliest part that has it; of several there, the smallest."""
    rest = [c for c in parts[0].columns if c not in key]
    stacked = concat([p.withColumn("_part", F.lit(k)) for k, p in enumerate(parts)])
    return stacked.groupBy(*key).agg(F.min(F.struct("_part", *rest)).alias("m")).select(*key, *(F.col(f"m.{c}").alias(c) for c in rest))


def first_rows(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """df with one row for each key, the first in a total order; pre-aggregated before the shuffle."""
    rest = [c for c in df.columns if c not in key and c not in order]
    return df.groupBy(*key).agg(F.min(F.struct(*order, *rest)).alias("m")).select(*key, *(F.col(f"m.{c}").alias(c) for c in [*order, *rest])).select(df.columns)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def missing_slots(expected: DataFrame, present: DataFrame) -> DataFrame:
    """Expected rows that aren't there."""
    return expected.join(present, expected.columns, "left_anti")


def run_report(df: DataFrame, run: list[str], size: str, ok: str) -> DataFrame:
    """Bytes and counts of what succeeded and failed in each run."""
    return df.groupBy(*run).agg(F.sum(F.when(F.col(ok), F.col(size)).otherwise(0)).alias("bytes"), F.count_if(ok).alias("succeeded"), F.count_if(~F.col(ok)).alias("failed"))


def coverage(df: DataFrame, key: str, time: str) -> DataFrame:
    """First and last time and number of reports of each station."""
    return df.groupBy(key).agg(F.min(time).alias("start"), F.max(time).alias("end"), F.count("*").alias("total"))


def id_lists(df: DataFrame, id_col: str, size: int, pad_last: bool = False) -> DataFrame:
    """Comma lists of ``size`` consecutive ids from 0 on; with ``pad_last`` the last list runs past the last id."""
    block = F.floor(F.col(id_col) / size).cast("long")
    made = df.groupBy(block.alias("block")).agg(F.sort_array(F.collect_set(id_col)).alias("ids"))
    ids = F.sequence(F.col("block") * size, F.col("block") * size + size - 1) if pad_last else F.col("ids")
    return made.select("block", F.concat_ws(",", F.transform(ids, lambda x: x.cast("string"))).alias("ids"))


def availability(df: DataFrame, source: str, time: str, slots_per_day: int, sources: DataFrame | None = None, days: DataFrame | None = None) -> DataFrame:
    """Slots expected and present of each source on each day, also where there is none.

    Sources (source) are those of df or as given, days (day) all from its first to its last one or as
    given. The two axes are crossed, which is what is reported; the rows are counted first and meet it
    by key.
    """
    width = 86_400_000_000 // slots_per_day
    day = F.date_trunc("day", time).cast("timestamp_ntz")
    slotted = df.select(source, day.alias("day"), F.floor(micros(F.col(time)) / width).alias("slot"))
    present = slotted.groupBy(source, "day").agg(F.count_distinct("slot").cast("long").alias("present"))
    if days is None:
        ends = df.agg(F.min(day).alias("a"), F.max(day).alias("b"))
        days = ends.where("a is not null").select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 DAY"))).alias("day"))
    known = (df if sources is None else sources).select(source).distinct()
    return known.crossJoin(days.select("day")).join(present, [source, "day"], "left").select(source, "day", F.coalesce("present", F.lit(0)).cast("long").alias("present"), F.lit(slots_per_day).cast("long").alias("expected"))


def forecast_steps(df: DataFrame, run: list[str], time: str) -> DataFrame:
    """df with the run's first valid time as init_time and each row's step in seconds; a run is as large as its steps, so one window holds it."""
    init = F.min(time).over(Window.partitionBy(*run))
    return df.withColumn("init_time", init).withColumn("step_s", step_seconds(F.col(time), F.col("init_time")))


def axis_index(df: DataFrame, column: str) -> DataFrame:
    """Position of each distinct value in the ordered axis; values are ranked by partition, so no task holds the axis."""
    from geoframe.operators.shape import numbered

    return numbered(df.select(column).distinct(), [column], "position")


def first_available(df: DataFrame, order: list[str]) -> DataFrame:
    return df.orderBy(*order).limit(1)
