"""Readers of station files, lists, inventories, archives and nested products. Schemas are given, never inferred."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def station_years(spark: SparkSession, path: str, schema: str, stations: list | None = None, years: list[int] | None = None) -> DataFrame:
    """Observations stored by station and year; both filters prune folders and row groups."""
    df = spark.read.schema(schema).parquet(path)
    if stations is not None:
        df = df.where(F.col("station").isin(stations))
    return df if years is None else df.where(F.col("year").isin(years))


def station_list(spark: SparkSession, path: str, fields: list[tuple[str, int, str]]) -> DataFrame:
    """Text lines of white-space delimited fields as a table; fields are (name, position from 0, type), unreadable values null."""
    part = F.split(F.trim("value"), r"\s+")
    return spark.read.text(path).where(F.trim("value") != "").select(*(F.get(part, F.lit(k)).try_cast(t).alias(n) for n, k, t in fields))


def names_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("station")).where("station <> ''")


def csv_series(spark: SparkSession, path: str, schema: str, header: bool = True) -> DataFrame:
    """CSV, compressed or not, with a given schema; only the columns that are used are converted."""
    return spark.read.schema(schema).option("header", header).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """(id, start, end) of a JSON station inventory with nested ranges."""
    found = spark.read.schema("id string, inventory struct<hourly struct<start string, end string>>").json(path)
    return found.select("id", "inventory.hourly.start", "inventory.hourly.end")


def network_stations(spark: SparkSession, path: str) -> DataFrame:
    """Station ids of GeoJSON feature collections, one document a line."""
    found = spark.read.schema("features array<struct<properties struct<sid string>>>").json(path)
    return found.select(F.explode("features").alias("f")).select(F.col("f.properties.sid").alias("sid"))


def multi_file(spark: SparkSession, paths: list[str], preprocess: Callable[..., DataFrame], schema: str | None = None, **bound) -> DataFrame:
    """Many files as one table, each row with its file, and a preprocess step with bound arguments applied."""
    read = spark.read.schema(schema) if schema else spark.read
    return read.parquet(*paths).withColumn("file", F.col("_metadata.file_path")).transform(preprocess, **bound)


def nested_files(spark: SparkSession, files: dict, preprocess: Callable[..., DataFrame], outer: str, inner: str, schema: str | None = None, **bound) -> DataFrame:
    """Files given as {outer label: {inner label: path}}, joined along two new axes, each file preprocessed on its own.

    ``preprocess`` gets the rows of one file, so it may use that file's extent, and bound arguments.
    Columns that a file lacks are null. The plan has a scan for each file, so this is for the files of
    a run, not for an archive; those share one scan in ``multi_file``.
    """
    read = spark.read.schema(schema) if schema else spark.read
    parts = [preprocess(read.parquet(path), **bound).withColumn(inner, F.lit(b)).withColumn(outer, F.lit(a)) for a, held in files.items() for b, path in held.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def discovered(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """(path, length) of files of a name pattern at any depth; AppleDouble companions are left out. Contents are not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    return found.where(~F.col("path").rlike(r"/\._[^/]*$")).select("path", "length").orderBy("path")


def flattened(df: DataFrame, group: str) -> DataFrame:
    """Fields of a group as columns."""
    return df.select(*(c for c in df.columns if c != group), f"{group}.*")


def months(df: DataFrame, start: Column, end: Column) -> DataFrame:
    """df with a row for each month that a closed range touches, as its first day."""
    return df.withColumn("month", F.explode(F.sequence(F.trunc(start, "month"), F.trunc(end, "month"), F.expr("INTERVAL 1 MONTH"))))


def month_window(wanted: DataFrame, manifest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(found, missing): manifest rows of the wanted months, and the months that have none."""
    return manifest.join(wanted.select("month").distinct(), "month", "left_semi"), wanted.join(manifest.select("month"), "month", "left_anti")


def decoded(df: DataFrame, decoder: Callable[[bytes], pd.DataFrame], schema: str, path: str = "path", content: str = "content") -> DataFrame:
    """Files (path, content) run through a user's decoder, each on its own; a file that fails gives one row with its error.

    schema is that of the decoder's frames; file and error are added.
    """
    names = [x.strip().split()[0] for x in schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, data in zip(batch[path], batch[content]):
                try:
                    yield decoder(data)[names].assign(file=file, error=None)
                except Exception as error:  # any decoder's failure is a row
                    yield pd.DataFrame({n: [None] for n in names}).assign(file=file, error=f"{type(error).__name__}: {error}")

    return df.select(path, content).mapInPandas(run, f"{schema}, file string, error string")
