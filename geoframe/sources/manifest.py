"""Reference manifests by satellite, band and hour or day, and lookups that open only the partitions that requests name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoframe.functions.times import micros, ntz
from geoframe.sources.store import Store

PARTITION = ["satellite", "band", "slot"]
#: Units of a slot and how their folders are named.
SLOTS = {"hour": "yyyyMMddHH", "day": "yyyyMMdd", "month": "yyyyMM"}
#: No satellite has scenes before.
FIRST = "1960-01-01 00:00:00"


class Manifest:
    """(satellite, band, time, path, ...) of scenes with a folder for each satellite, band and slot of time."""

    def __init__(self, store: Store, unit: str = "hour"):
        self.store, self.unit = store, unit

    @classmethod
    def write(cls, spark: SparkSession, path: str, scenes: DataFrame, unit: str = "hour") -> Manifest:
        """A new manifest; the unit should give folders of some megabytes."""
        return cls(Store(spark, path, PARTITION).create(scenes.withColumn("slot", cls._slot(F.col("time"), unit))), unit)

    @staticmethod
    def _slot(time: Column, unit: str) -> Column:
        return F.date_format(time, SLOTS[unit])

    def found(self, requests: DataFrame, within_s: int = 3600) -> DataFrame:
        """requests (satellite, band, time) with the nearest scene's time and path, at most ``within_s`` seconds off; requests without one have nulls.

        A request names the slots that it reaches into, and Spark prunes the manifest's folders by them
        when it runs, as it does where the requests are small enough to be broadcast, so what is opened
        follows the requests, not the manifest. Requests before FIRST find nothing. Of equally near
        scenes the earlier counts, of several at one time the smallest path. Repeated requests are
        answered each.
        """
        # Spark prunes by a key only where another column of the requests is filtered
        named = requests.select("satellite", "band", "time").where(F.col("satellite").isNotNull() & F.col("band").isNotNull() & (F.col("time") >= F.lit(FIRST).cast("timestamp_ntz"))).distinct()
        reach = F.expr(f"INTERVAL {within_s} SECONDS")
        slots = F.sequence(F.date_trunc(self.unit, F.col("time") - reach), F.date_trunc(self.unit, F.col("time") + reach), F.expr(f"INTERVAL 1 {self.unit.upper()}"))
        asked = named.select("satellite", "band", F.col("time").alias("asked"), F.explode(F.transform(slots, lambda s: self._slot(s, self.unit))).alias("slot"))
        off = F.abs(micros(F.col("time")) - micros(F.col("asked")))
        # a key of all three, as keys one by one would open each satellite's folders of the others' slots
        folder = F.concat_ws("/", *PARTITION).alias("folder")
        near = asked.select("*", folder).join(self.store.read().select("*", folder), [*PARTITION, "folder"]).withColumn("off", off).where(F.col("off") <= within_s * 1_000_000)
        best = near.groupBy("satellite", "band", "asked").agg(F.min(F.struct("off", "time", "path")).alias("m"))
        answers = best.select("satellite", "band", F.col("asked").alias("time"), ntz(F.col("m.time")).alias("scene_time"), F.col("m.path").alias("path"))
        return requests.join(answers, ["satellite", "band", "time"], "left")
