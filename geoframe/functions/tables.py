"""Axes, partition catalogues and manifests as table functions of Spark SQL; Catalyst puts their bodies in place of the calls."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: name(arguments) -> columns and the SELECT that makes them.
FUNCTIONS = {
    "time_axis(first TIMESTAMP_NTZ, last TIMESTAMP_NTZ, minutes INT)": (
        "time TIMESTAMP_NTZ",
        "SELECT explode(sequence(first, last, make_dt_interval(0, 0, minutes)))",
    ),
    "month_ends(first DATE, last DATE)": (
        "day DATE",
        "SELECT last_day(m) FROM (SELECT explode(sequence(trunc(first, 'MONTH'), trunc(last, 'MONTH'), INTERVAL 1 MONTH)) AS m)",
    ),
    "day_windows(first TIMESTAMP_NTZ, last TIMESTAMP_NTZ, days INT, end_offset INT)": (
        "start TIMESTAMP_NTZ, stop TIMESTAMP_NTZ",
        "SELECT s, s + make_dt_interval(days) FROM (SELECT explode(sequence(CAST(date_trunc('DAY', first) AS TIMESTAMP_NTZ), last + make_dt_interval(days * end_offset), make_dt_interval(days))) AS s)",
    ),
    "week_windows(first TIMESTAMP_NTZ, last TIMESTAMP_NTZ, end_offset INT)": (
        "start TIMESTAMP_NTZ, stop TIMESTAMP_NTZ",
        "SELECT s, s + INTERVAL 7 DAYS FROM (SELECT explode(sequence(CAST(date_trunc('WEEK', first) AS TIMESTAMP_NTZ), CAST(date_trunc('WEEK', last) AS TIMESTAMP_NTZ) + make_dt_interval(7 * end_offset), INTERVAL 7 DAYS)) AS s)",
    ),
    "month_windows(first TIMESTAMP_NTZ, last TIMESTAMP_NTZ, end_offset INT)": (
        "start TIMESTAMP_NTZ, stop TIMESTAMP_NTZ",
        "SELECT s, s + INTERVAL 1 MONTH FROM (SELECT explode(sequence(CAST(date_trunc('MONTH', first) AS TIMESTAMP_NTZ), CAST(date_trunc('MONTH', last) AS TIMESTAMP_NTZ) + make_ym_interval(0, end_offset), INTERVAL 1 MONTH)) AS s)",
    ),
    "forecast_files(run TIMESTAMP_NTZ, steps INT, prefix STRING)": (
        "step INT, url STRING",
        "SELECT s, prefix || '_' || date_format(run, \"yyyyMMdd'00'\") || '_' || lpad(CAST(s AS STRING), 3, '0') || '.nc4' FROM (SELECT explode(sequence(1, steps)) AS s)",
    ),
    "year_days(first INT, last INT)": (
        "year INT, day_of_year INT",
        "SELECT year(d), dayofyear(d) FROM (SELECT explode(sequence(make_date(first, 1, 1), make_date(last, 12, 31))) AS d)",
    ),
    "month_blocks(size INT)": (
        "block INT, months STRING",
        "SELECT b, array_join(transform(sequence(b * size + 1, b * size + size), m -> lpad(CAST(m AS STRING), 2, '0')), ',') FROM (SELECT explode(sequence(0, 12 DIV size - 1)) AS b)",
    ),
    "backward_windows(first TIMESTAMP_NTZ, last TIMESTAMP_NTZ, days INT)": (
        "start TIMESTAMP_NTZ, stop TIMESTAMP_NTZ",
        "SELECT e - make_dt_interval(days), e FROM (SELECT explode(sequence(last, first, -make_dt_interval(days))) AS e) WHERE e > first",
    ),
    "scene_slots(day DATE, minutes INT)": (
        "time TIMESTAMP_NTZ",
        "SELECT explode(sequence(CAST(day AS TIMESTAMP_NTZ), CAST(day AS TIMESTAMP_NTZ) + INTERVAL 1 DAY - make_dt_interval(0, 0, minutes), make_dt_interval(0, 0, minutes)))",
    ),
}


def register(spark: SparkSession) -> SparkSession:
    """Makes the functions known to the session; they replace ones of the same name."""
    for signature, (columns, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS TABLE ({columns}) RETURN {body}")
    return spark
