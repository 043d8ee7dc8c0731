"""Filters, validation against small rule tables, and completeness checks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Operating ranges, open ends null, and the routing of the imagers; himawari8 serves both ends of its range, himawari9 all other times.
OPERATING = [
    ("goes16", "2017-12-18", "2025-04-07"), ("goes17", "2019-02-12", "2023-01-04"), ("goes18", "2023-01-04", None), ("goes19", "2025-04-07", None),
    ("goes-east", "2017-12-18", None), ("goes-west", "2019-02-12", None), ("himawari8", "2015-07-07", "2022-12-13"), ("himawari9", "2022-11-04", None),
    ("gk2a", "2023-02-23", None), ("n21", "2023-02-27", None), ("n20", "2022-11-07", None), ("snpp", "2022-11-07", None),
]
ROUTES = [
    ("east", "goes16", None, "2025-04-07"), ("east", "goes19", "2025-04-07", None), ("west", "goes17", None, "2023-01-04"), ("west", "goes18", "2023-01-04", None),
    ("himawari", "himawari9", None, "2015-07-07"), ("himawari", "himawari8", "2015-07-07", "2022-12-13 00:00:00.000001"), ("himawari", "himawari9", "2022-12-13 00:00:00.000001", None),
]
RESOLUTION = {
    "goes": {"high": ("C02",), "medium": ("C01", "C03", "C05"), "low": ("C04", "C06", "C07", "C08", "C09", "C10", "C11", "C12", "C13", "C14", "C15", "C16")},
    "himawari": {"high": ("B03",), "medium": ("B01", "B02", "B04"), "low": ("B05", "B06", "B07", "B08", "B09", "B10", "B11", "B12", "B13", "B14", "B15", "B16")},
    "gk2a": {"high": ("VI006",), "medium": ("VI008", "VI005", "VI004"), "low": ("NR013", "NR016", "SW038", "WV063", "WV069", "WV073", "IR087", "IR096", "IR105", "IR112", "IR123", "IR133")},
}


def operating_ranges(spark) -> DataFrame:
    rows = spark.createDataFrame(OPERATING, "satellite string, start string, end string")
    return rows.select("satellite", F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"))


def routes(spark) -> DataFrame:
    """(position, satellite, start, end) of ROUTES."""
    rows = spark.createDataFrame(ROUTES, "position string, satellite string, start string, end string")
    return rows.select("position", "satellite", F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"))


def since(df: DataFrame, time: str, start: str) -> DataFrame:
    """Rows from a time on; the bound is a literal, so it reaches the scan."""
    return df.where(F.col(time) >= F.lit(start).cast("timestamp_ntz"))


def between(df: DataFrame, time: str, start: str, end: str) -> DataFrame:
    """Rows of a closed time window."""
    return df.where(F.col(time).between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")))


def masked(value: Column, condition: Column) -> Column:
    """The value where the condition holds, else null; the row stays."""
    return F.when(condition, value)


def usable_stations(df: DataFrame, end: str, total: str, year: int, least: int, needed: list[str]) -> DataFrame:
    return df.where((F.col(end) >= year) & (F.col(total) > least)).dropna(subset=needed)


def overlapping(df: DataFrame, start: str, end: str, first: str, last: str) -> DataFrame:
    """Rows whose interval, given as text, meets a closed interval; those that can't be parsed go."""
    a, b = (F.try_to_timestamp(F.col(c), F.lit("yyyy-MM-dd")).cast("timestamp_ntz") for c in (start, end))
    return df.where((a <= F.lit(last).cast("timestamp_ntz")) & (b >= F.lit(first).cast("timestamp_ntz")))


def matching_files(df: DataFrame, path: str, part: str | None = None, like: str | None = None, hidden: bool = False) -> DataFrame:
    """Paths with a part or of a pattern; names that begin with ._ are left out unless hidden is set."""
    out = df if hidden else df.where(~F.col(path).rlike(r"(^|/)\._[^/]*$"))
    if part is not None:
        out = out.where(F.contains(F.col(path), F.lit(part)))
    return out if like is None else out.where(F.col(path).like(like))


def not_all_missing(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(how="all", subset=columns)


def variables_with_values(df: DataFrame, columns: list[str]) -> list[str]:
    """The columns that have a value in any row, by one aggregation."""
    found = df.agg(*(F.max(F.col(c).isNotNull()).alias(c) for c in columns)).first()
    return [c for c in columns if found[c]]


def in_history(requests: DataFrame, ranges: DataFrame, satellite: str = "satellite", time: str = "time", strict: bool = False) -> DataFrame:
    """requests with a status: ok, unknown satellite, before start or after end; both ends of a range are allowed.

    The range table has a row per satellite; Spark broadcasts it if it is small. With ``strict`` a status other than ok raises.
    """
    r = ranges.select(F.col("satellite").alias("_satellite"), "start", "end")
    joined = requests.join(r, F.col(satellite) == F.col("_satellite"), "left")
    status = F.when(F.col("_satellite").isNull(), "unknown satellite").when(F.col(time) < F.col("start"), "before start").when(F.col("end").isNotNull() & (F.col(time) > F.col("end")), "after end").otherwise("ok")
    out = joined.withColumn("status", status).drop("_satellite", "start", "end")
    return out.where(F.when(F.col("status") == "ok", F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("invalid request: "), F.col("status"))).cast("boolean"))) if strict else out


def single_resolution(df: DataFrame, family: str, request: str, channel: str) -> DataFrame:
    """For each request its number of resolution classes, of unknown channels, and whether all share one class."""
    table = F.create_map(*(F.lit(x) for name, channels in RESOLUTION[family].items() for c in channels for x in (c, name)))
    marked = df.withColumn("_class", F.try_element_at(table, F.col(channel)))
    return marked.groupBy(request).agg(F.count_distinct("_class").cast("long").alias("classes"), F.count_if(F.col("_class").isNull()).cast("long").alias("unknown")).withColumn("valid", (F.col("classes") == 1) & (F.col("unknown") == 0))


def allowed(value: Column, values: Iterable[str]) -> Column:
    return F.coalesce(value.isin(*values), F.lit(False))


def complete_runs(df: DataFrame, run: list[str], step: str, expected: int) -> DataFrame:
    """Each run's distinct steps and whether all are there."""
    return df.groupBy(*run).agg(F.count_distinct(step).cast("long").alias("steps")).withColumn("complete", F.col("steps") >= expected)


def readable(df: DataFrame, ok: str) -> DataFrame:
    """Rows that were decoded."""
    return df.where(F.col(ok))


def readable_runs(df: DataFrame, run: str, ok: str) -> DataFrame:
    """Rows of the runs none of whose files failed."""
    good = df.groupBy(run).agg(F.bool_and(ok).alias("good")).where("good").select(run)
    return df.join(good, run, "left_semi")
