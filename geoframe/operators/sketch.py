"""Distinct counts kept as mergeable sketches, one for each partition of a store, so that only changed partitions are counted again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoframe.sources.store import Store, scratch

#: Logarithm of the sketch's size; the estimate's relative standard error is about 1.04 / sqrt(2^LOG_K).
LOG_K = 12


def error_bound(log_k: int = LOG_K) -> float:
    """Relative error that an estimate exceeds in fewer than 3 of 1,000 cases."""
    return 3 * 1.04 / 2 ** (log_k / 2)


def sketched(df: DataFrame, keys: list[str], value: Column, log_k: int = LOG_K) -> DataFrame:
    """(keys, sketch) of the distinct values of each key; nulls aren't counted."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(value, F.lit(log_k)).alias("sketch"))


def merged(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, estimate) of the union of sketches of coarser keys; no value is read."""
    made = sketches.groupBy(*keys) if keys else sketches.groupBy()
    return made.agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


class CountedStore:
    """Sketches of a store's distinct values, by partition columns and more keys, in a store beside it."""

    def __init__(self, store: Store, path: str, keys: list[str], value: Column, log_k: int = LOG_K):
        self.store, self.keys, self.value, self.log_k = store, keys, value, log_k
        self.sketches = Store(store.spark, path, store.partition)
        self.sketches.create(self._of(store.read()))

    def _of(self, df: DataFrame) -> DataFrame:
        return sketched(df, [*self.keys, *(c for c in self.store.partition if c not in self.keys)], self.value, self.log_k)

    def refresh(self, changed: DataFrame) -> CountedStore:
        """Counts the partitions that ``changed`` names again, after the store's regions were replaced; others keep their sketches."""
        touched = self.store.read().join(changed.select(*self.store.partition).distinct(), self.store.partition, "left_semi")
        self.sketches.write_regions(self._of(touched))
        return self

    def add(self, rows: DataFrame) -> CountedStore:
        """Unions the sketches of appended rows into those of their partitions; stored rows aren't read."""
        new = self._of(rows)
        keys = [c for c in new.columns if c != "sketch"]
        held = self.sketches.read().join(new.select(*self.store.partition).distinct(), self.store.partition, "left_semi")
        both = held.unionByName(new).groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))
        staged = scratch(self.store.spark, "sketches")
        both.write.parquet(staged)
        self.sketches.write_regions(self.store.spark.read.schema(both.schema).parquet(staged))
        return self

    def estimates(self, keys: list[str]) -> DataFrame:
        """(keys, estimate) over all partitions."""
        return merged(self.sketches.read(), keys)
