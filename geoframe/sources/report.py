"""Materialisation reports that are gathered while rows are written, without another scan."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def reported_write(df: DataFrame, write: Callable[[DataFrame], None], runs: list[str], run: str, size: Column, ok: Column) -> DataFrame:
    """(run, bytes, succeeded, failed) of a given list of runs, summed by the job that writes those rows that succeeded.

    Rows of runs that aren't listed, and of a null one, are written and reported under a null run. Failed
    rows are counted and not written. The report is one row of sums whatever is written.
    """
    spark: SparkSession = df.sparkSession
    known = F.coalesce(F.col(run).cast("string").isin(runs), F.lit(False))
    groups = [(r, F.col(run).cast("string").eqNullSafe(F.lit(r))) for r in runs] + [(None, ~known)]
    good = F.coalesce(ok, F.lit(False))
    sums = []
    for k, (_, inside) in enumerate(groups):
        sums += [F.sum(F.when(inside & good, F.coalesce(size, F.lit(0)).cast("long")).otherwise(0)).alias(f"bytes_{k}"), F.count_if(inside & good).alias(f"succeeded_{k}"), F.count_if(inside & ~good).alias(f"failed_{k}")]
    seen = Observation()
    write(df.observe(seen, *sums).where(good))
    found = seen.get
    rows = [(r, found[f"bytes_{k}"] or 0, found[f"succeeded_{k}"] or 0, found[f"failed_{k}"] or 0) for k, (r, _) in enumerate(groups)]
    return spark.createDataFrame(rows, "run string, bytes long, succeeded long, failed long").where("run is not null or succeeded + failed > 0")
