"""Stores: partitioned Parquet with a ledger of committed batches; append, region write, upsert and exports."""

from __future__ import annotations

import json
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from geoframe.sources.ledger import Ledger

OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
WRITERS = 16


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (spark.checkpoint.dir). Where it is unset, on one machine only, in a temporary one."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not folder and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    return f"{(folder or tempfile.mkdtemp(prefix='spark-')).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def unsorted_writes(spark: SparkSession) -> Iterator[None]:
    """Writes that are started inside keep up to WRITERS files of a task open, instead of sorting the task's rows by folder first."""
    before = spark.conf.get(OPEN_FILES)
    spark.conf.set(OPEN_FILES, str(WRITERS))
    try:
        yield
    finally:
        spark.conf.set(OPEN_FILES, before)


def write_folders(df: DataFrame, path: str, keys: list[str], mode: str = "errorifexists", **options: str) -> None:
    """Parquet with a folder for each value of keys, in few files each.

    Spark deals the rows by keys, and a key of many rows over as many tasks as its size needs
    (rebalance), so no task holds, or sorts, more of a key than a part of bounded size.
    """
    with unsorted_writes(df.sparkSession):
        df.hint("rebalance", *(F.col(k) for k in keys)).write.mode(mode).options(**options).partitionBy(*keys).parquet(path)


class Store:
    """A dataset at a path, partitioned by columns, and batches of products beside it, of which those in its ledger are read."""

    def __init__(self, spark: SparkSession, path: str, partition: list[str], schema: StructType | None = None):
        self.spark, self.path, self.partition, self.schema = spark, f"{path}/data", partition, schema
        self.schema_path, self.batch_path, self.ledger_path = f"{path}/schema", f"{path}/batches", f"{path}/ledger"
        self.ledger = Ledger(spark, self.ledger_path)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> Store:
        """The store that an earlier process has made at the path."""
        held = json.loads(spark.read.text(f"{path}/schema", wholetext=True).first()[0])
        return cls(spark, path, held["partition"], StructType.fromJson(held["schema"]))

    def create(self, df: DataFrame, compression: str = "zstd") -> Store:
        """Writes a new store; rows are dealt by partition first, so that each partition is few files."""
        self.schema = df.schema
        held = json.dumps({"partition": self.partition, "schema": df.schema.jsonValue()})
        self.spark.range(1).select(F.lit(held).alias("value")).coalesce(1).write.mode("overwrite").text(self.schema_path)
        write_folders(df, self.path, self.partition, "overwrite", compression=compression)
        return self

    def _stored(self, path: str, *more: StructField) -> DataFrame | None:
        """The rows at a path, or None if nothing was written there."""
        fields = [f for f in self.schema if f.name not in self.partition] + [f for f in self.schema if f.name in self.partition]
        try:
            return self.spark.read.schema(StructType([*fields, *more])).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def batches(self) -> DataFrame | None:
        """Rows of the batches in the ledger; what a failed batch has left isn't read."""
        found = self._stored(self.batch_path, StructField("_batch", LongType()))
        known = self.ledger.batches().select(F.col("batch").alias("_batch"))
        return found and found.join(known, "_batch", "left_semi").select(self.schema.names)

    def read(self) -> DataFrame:
        batches = self.batches()
        rows = self._stored(self.path).select(self.schema.names)
        return rows if batches is None else rows.unionByName(batches)

    def check(self, df: DataFrame) -> None:
        """Refuses rows whose columns the store has not all."""
        unknown = set(df.columns) - set(self.schema.names)
        if unknown:
            raise ValueError(f"the store lacks {sorted(unknown)}")

    def append(self, df: DataFrame) -> Store:
        self.check(df)
        write_folders(df, self.path, self.partition, "append")
        return self

    def write_regions(self, df: DataFrame) -> Store:
        """Replaces exactly the partitions that df has rows in; a store with batches of products can only grow."""
        self.check(df)
        if self._stored(self.batch_path) is not None:
            raise ValueError("a store with batches of products has no regions")
        write_folders(df.select(self.schema.names), self.path, self.partition, "overwrite", partitionOverwriteMode="dynamic")
        return self

    def write_known_regions(self, df: DataFrame, axis: DataFrame, key: str) -> Store:
        """Region write of the rows whose key is on the store's axis; others are left out."""
        return self.write_regions(df.join(axis.select(key), key, "left_semi"))

    def upsert(self, df: DataFrame, keys: list[str]) -> Store:
        """Rows with known keys overwrite, others are added; of repeated keys in df one row, the smallest, counts.

        Only partitions that df touches are rewritten, from a staging copy, since Spark doesn't overwrite what it reads.
        A row stays in its partition: one whose key is known in another partition is refused.
        """
        self.check(df)
        names = self.schema.names
        rest = [c for c in names if c not in keys]
        new = df.select(names).groupBy(*keys).agg(F.min(F.struct(*rest)).alias("m")).select(*keys, *(F.col(f"m.{c}").alias(c) for c in rest)).select(names)
        if not set(self.partition) <= set(keys):
            at = [c for c in self.partition if c not in keys]
            other = self.read().select(*keys, *(F.col(c).alias(f"_{c}") for c in at)).join(new.select(*keys, *at), keys)
            if not other.where(reduce(lambda a, b: a | b, (~F.col(c).eqNullSafe(F.col(f"_{c}")) for c in at))).isEmpty():
                raise ValueError(f"known keys in other partitions of {at}")
        touched = self.read().join(new.select(*self.partition).distinct(), self.partition, "left_semi")
        merged = touched.join(new.select(*keys), keys, "left_anti").select(names).unionByName(new)
        staging = f"{self.path}-staging-{uuid.uuid4().hex}"
        merged.write.parquet(staging)
        return self.write_regions(self.spark.read.schema(merged.schema).parquet(staging))

    def append_new_batch(self, df: DataFrame, key: str) -> bool:
        """Appends df unless any of its keys is there already; tells whether it did."""
        if not df.join(self.read().select(key), key, "left_semi").limit(1).isEmpty():
            return False
        self.append(df)
        return True

    def used(self) -> DataFrame:
        """(product, batch) of committed batches."""
        return self.ledger.names()

    def append_products(self, df: DataFrame, product: str, batch: int) -> Store:
        """Writes the rows of products that no earlier batch had as a batch, then commits their names; a batch that is there already is skipped.

        A batch has a folder of its own, which a retry overwrites, and it is read only once the ledger has its
        commit, which is one write. Whatever a run that failed in between has left doesn't count.
        """
        self.check(df)
        if self.ledger.committed(batch):
            return self
        name = F.col(product).cast("string")
        asked = f"{self.ledger_path}/asked-{uuid.uuid4().hex}"
        df.where(name.isNotNull()).select(name.alias("product")).distinct().write.parquet(asked)
        names = self.spark.read.schema("product string").parquet(asked)
        known = self.ledger.known(names, batch).select(F.col("product").alias("_product"))
        fresh = df.select(self.schema.names).join(known, name == F.col("_product"), "left_anti")
        write_folders(fresh, f"{self.batch_path}/_batch={batch}", self.partition, "overwrite")
        self._commit(names.join(known, F.col("product") == F.col("_product"), "left_anti"), batch)
        return self

    def _commit(self, names: DataFrame, batch: int) -> None:
        self.ledger.commit(names, batch)

    def committed(self, product: str) -> DataFrame:
        """Rows of products in the ledger only."""
        batches = self.batches()
        return self.read().limit(0) if batches is None else batches.where(F.col(product).isNotNull())


def export_csv(df: DataFrame, path: str, partition: list[str], compression: str = "none") -> str:
    """CSV with headers, a folder for each partition."""
    df.write.mode("overwrite").option("header", True).option("compression", compression).partitionBy(*partition).csv(path)
    return path


def export_text(df: DataFrame, column: Column, path: str) -> str:
    """One line for each row."""
    df.select(column.cast("string").alias("value")).write.mode("overwrite").text(path)
    return path


def export_blocks(df: DataFrame, key: str, block: Column, path: str) -> str:
    """A folder for each block of keys, rows of a key together and in order; a block is dealt over tasks by ranges of keys."""
    given = df.withColumn("block", block).repartitionByRange("block", key).sortWithinPartitions("block", key)
    with unsorted_writes(df.sparkSession):
        given.write.mode("overwrite").partitionBy("block").parquet(path)
    return path
