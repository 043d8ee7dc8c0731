"""Readers that keep what is damaged: each row with its file and, if it can't be read, its text; then rejection by file or run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, _parse_datatype_string

ERROR, FILE = "error", "file"


def _schema(schema: str | StructType) -> StructType:
    given = _parse_datatype_string(schema) if isinstance(schema, str) else schema
    return StructType([*given.fields, StructField(ERROR, StringType())])


def _sourced(read: DataFrame) -> DataFrame:
    """read with its file. The error is made to depend on all columns, without which Spark would not convert those that a query leaves out, nor see what is wrong in them."""
    values = [c for c in read.columns if c != ERROR]
    error = F.when(F.spark_partition_id() < 0, F.hash(*values).cast("string")).otherwise(F.col(ERROR))
    return read.select(*values, error.alias(ERROR), F.col("_metadata.file_path").alias(FILE))


def csv_rows(spark: SparkSession, path: str, schema: str, header: bool = True, times: str = "yyyy-MM-dd HH:mm:ss.SSSSSS", delimiter: str = ",") -> DataFrame:
    """CSV rows (schema, error, file), compressed or not; ``error`` is the text of a row with too few or many fields or a value of another type.

    All columns are converted, used or not, as a row counts as damaged by any of them.
    """
    reader = spark.read.schema(_schema(schema)).option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", ERROR)
    return _sourced(reader.option("timestampNTZFormat", times).option("delimiter", delimiter).option("enforceSchema", True).csv(path))


def json_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON rows (schema, error, file), one document a line; ``error`` is the text of a line that isn't JSON of the schema."""
    return _sourced(spark.read.schema(_schema(schema)).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", ERROR).json(path))


def damage(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(by, good, damaged, example) of each file, or of other columns; the example is the smallest damaged text."""
    return rows.groupBy(*(by or [FILE])).agg(F.count_if(F.col(ERROR).isNull()).alias("good"), F.count_if(F.col(ERROR).isNotNull()).alias("damaged"), F.min(ERROR).alias("example"))


def sound_rows(rows: DataFrame) -> DataFrame:
    """Rows that could be read, without the error column."""
    return rows.where(F.col(ERROR).isNull()).drop(ERROR)


def sound_groups(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows of files, or of groups by other columns such as a run, that have no damaged row at all; ``by`` must be readable from undamaged parts, as a folder's column is.

    Damaged groups are found by an aggregation, one row each, and taken out by a join, so a group of any
    size stays dealt over tasks.
    """
    keys = by or [FILE]
    bad = rows.where(F.col(ERROR).isNotNull()).select(*keys).distinct()
    return rows.join(bad, keys, "left_anti").drop(ERROR)
