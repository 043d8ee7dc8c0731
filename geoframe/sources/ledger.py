"""The ledger of used product names: a bucketed table, so that a batch meets it bucket by bucket without an exchange of what is stored."""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 32
#: A batch of at most so many names reads their buckets only; a larger one meets all.
NAMES = 1_000
#: Files of names after which they are written anew, one file a bucket.
COMPACT = 2_048


class Ledger:
    """Names of products with the batch that brought them, and the batches that are committed.

    Names are dealt by hash into buckets of one or more sorted files. A name counts once its batch has
    a commit, a folder of its own that is written last, so a batch that failed in between is as if it
    had never been, and can be run again. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _read(self, schema: str, path: str) -> DataFrame | None:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def committed(self, batch: int) -> bool:
        return self._read("at long", f"{self.path}/commits/batch={batch}") is not None

    def batches(self) -> DataFrame:
        """(batch) of all commits."""
        found = self._read("at long, batch long", f"{self.path}/commits")
        return self.spark.createDataFrame([], "batch long") if found is None else found.select("batch")

    def _generation(self) -> dict:
        """Which folder has the names, in how many buckets; the last line counts."""
        try:
            lines = self.spark.read.text(f"{self.path}/generation").agg(F.max("value")).first()[0]
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            lines = None
        return json.loads(lines) if lines else {"number": 0, "buckets": BUCKETS}

    def table(self, generation: dict | None = None) -> str:
        """The session's table over the names' folder."""
        g = generation or self._generation()
        folder = f"{self.path}/names-{g['number']:06d}"
        name = f"ledger_{uuid.uuid5(uuid.NAMESPACE_URL, folder).hex}"
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (product STRING, batch BIGINT) USING parquet CLUSTERED BY (product) SORTED BY (product) INTO {g['buckets']} BUCKETS LOCATION '{folder}'")
        return name

    def _append(self, names: DataFrame, generation: dict) -> None:
        dealt = names.select(F.col("product").cast("string").alias("product"), F.col("batch").cast("long").alias("batch")).repartition(generation["buckets"], "product")
        dealt.write.mode("append").format("parquet").bucketBy(generation["buckets"], "product").sortBy("product").saveAsTable(self.table(generation))

    def names(self) -> DataFrame:
        """(product, batch) of committed batches."""
        return self.spark.table(self.table()).join(F.broadcast(self.batches()), "batch", "left_semi").select("product", "batch")

    def known(self, names: DataFrame, batch: int) -> DataFrame:
        """(product) of ``names`` (product) that committed batches other than ``batch`` have.

        Few names read only the buckets they fall into. Stored names stay where they are in either case;
        only those that are asked for are exchanged.
        """
        stored = self.spark.table(self.table()).where(F.col("batch") != batch)
        few = [r[0] for r in names.limit(NAMES + 1).collect()]
        if len(few) <= NAMES:
            stored = stored.where(F.col("product").isin(few))
        held = stored.hint("shuffle_merge").join(names.select("product").hint("shuffle_merge"), "product", "left_semi")
        return held.join(self.batches(), "batch", "left_semi").select("product").distinct()

    def commit(self, names: DataFrame, batch: int) -> None:
        """Adds the names (product) of a batch, then its commit."""
        self._append(names.select("product", F.lit(batch).alias("batch")), self._generation())
        self.spark.range(1).select(F.unix_millis(F.current_timestamp()).alias("at")).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commits/batch={batch}")

    def files(self) -> int:
        return len(self.spark.table(self.table()).inputFiles())

    def compact(self, buckets: int | None = None) -> Ledger:
        """Writes the committed names as one sorted file for each bucket, in a new folder, then makes that one count."""
        old = self._generation()
        new = {"number": old["number"] + 1, "buckets": buckets or old["buckets"]}
        self._append(self.names().dropDuplicates(["product"]), new)
        self.spark.range(1).select(F.lit(json.dumps({"number": new["number"], "buckets": new["buckets"]})).alias("value")).coalesce(1).write.mode("overwrite").text(f"{self.path}/generation")
        return self
