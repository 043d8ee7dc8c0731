"""Lookup of scenes by time and variable: validated, routed to the nearest scene and ordered by time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoframe.functions.times import day_slots
from geoframe.operators.join import nearest_in_hour, routed
from geoframe.operators.select import routes


class SceneSource:
    """A source of scenes (channel, time, path, ...) with an operating range; an open end is None.

    A source of several satellites has a position of ``select.ROUTES`` and scenes with their satellite.
    """

    def __init__(self, scenes: DataFrame, channels: tuple[str, ...], start: str, end: str | None = None, minutes: int = 10, position: str | None = None):
        self.scenes, self.channels, self.start, self.end, self.minutes, self.position = scenes, channels, start, end, minutes, position

    def available_times(self, now: str) -> DataFrame:
        """All scan times from the start to the end of the range, or to ``now``."""
        spark = self.scenes.sparkSession
        days = spark.range(1).select(F.explode(F.sequence(F.lit(self.start).cast("date"), F.lit(self.end or now).cast("date"))).alias("day"))
        slots = days.select(F.explode(day_slots(F.col("day").cast("timestamp_ntz"), self.minutes)).alias("time"))
        return slots.where(F.col("time").between(F.lit(self.start).cast("timestamp_ntz"), F.lit(self.end or now).cast("timestamp_ntz")))

    def valid(self, times: DataFrame) -> DataFrame:
        """The requested times inside the operating range, both ends included."""
        inside = F.col("time") >= F.lit(self.start).cast("timestamp_ntz")
        return times.where(inside & (F.col("time") <= F.lit(self.end).cast("timestamp_ntz")) if self.end else inside)

    def history(self, times: DataFrame) -> DataFrame:
        """times with a status: ok, before start or after end."""
        late = F.col("time") > F.lit(self.end).cast("timestamp_ntz") if self.end else F.lit(False)
        return times.withColumn("status", F.when(F.col("time") < F.lit(self.start).cast("timestamp_ntz"), "before start").when(late, "after end").otherwise("ok"))

    def find(self, times: DataFrame, channels: list[str]) -> DataFrame | None:
        """The scenes of requests that must all lie in the operating range, else ValueError; None if there is no scene."""
        wrong = self.history(times).where("status <> 'ok'").first()
        if wrong:
            raise ValueError(f"{wrong['time']} is {wrong['status']}")
        found = self(times, channels)
        return None if found.isEmpty() else found

    def __call__(self, times: DataFrame, channels: list[str]) -> DataFrame:
        """The nearest scene of each channel in the hour of each time (time), ordered by time.

        Times outside the operating range (``history`` tells them) and hours without a scene give no row.
        """
        unknown = set(channels) - set(self.channels)
        if unknown:
            raise ValueError(f"unknown channels: {sorted(unknown)}")
        asked = self.valid(times).withColumn("channel", F.explode(F.array(*map(F.lit, channels))))
        keys = ["channel"]
        if self.position:
            asked = routed(asked.withColumn("position", F.lit(self.position)), routes(times.sparkSession), "position").drop("position")
            keys = ["channel", "satellite"]
        return nearest_in_hour(asked, self.scenes.where(F.col("channel").isin(*channels)), keys).orderBy("time", "channel")
