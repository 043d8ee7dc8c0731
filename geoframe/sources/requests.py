"""Request manifests: which files a source should have, as DataFrames of paths built from axes. Nothing is downloaded."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoframe.functions.times import templated

# Level axes of the forecast models.
PRESSURE_GLOBAL = (1000, 950, 925, 900, 850, 800, 700, 600, 500, 400, 300, 250, 200, 150, 100, 70, 50, 30)
PRESSURE_EUROPE = (1000, 950, 925, 900, 875, 850, 825, 800, 775, 700, 600, 500, 400, 300, 250, 200, 150, 100, 70, 50)
PRESSURE_DUST = (10000, 100000, 15000, 20000, 25000, 3000, 30000, 40000, 5000, 50000, 60000, 7000, 70000, 80000, 85000, 90000, 92500, 95000)
MODEL_LEVELS_GLOBAL, MODEL_LEVELS_EUROPE = range(121), range(76)
WAVELENGTHS = (1064, 532)
SOIL_DEPTHS = (0.0, 0.005, 0.01, 0.02, 0.03, 0.06, 0.09, 0.18, 0.27, 0.54, 0.81, 1.62, 2.43, 4.86, 7.29, 14.58)
# Field families of the forecast models.
VARIABLES_3D = {"global": ("fi", "relhum", "t", "u", "v"), "europe": ("clc", "fi", "omega", "relhum", "t", "u", "v")}
VARIABLES_MODEL = {"global": ("u", "v", "w", "qv"), "europe": ("u", "v", "w")}
INVARIANT = ("clat", "clon")
# Variables of the European air-quality forecast, its lead hours and heights.
AIR_QUALITY = (
    "alder_pollen", "ammonia", "birch_pollen", "carbon_monoxide", "dust", "grass_pollen", "nitrogen_dioxide", "nitrogen_monoxide", "non_methane_vocs", "olive_pollen", "ozone",
    "particulate_matter_10um", "particulate_matter_2.5um", "peroxyacyl_nitrates", "pm10_wildfires", "ragweed_pollen", "secondary_inorganic_aerosol", "sulphur_dioxide",
)
AIR_QUALITY_HOURS, AIR_QUALITY_HEIGHTS = range(97), (0, 50, 250, 500, 1000, 3000, 5000)
# Channels of the global mosaic and the names their files have.
MOSAIC_FILES = (("VIS", "VIS"), ("SSR", "SSR"), ("WV", "WV"), ("LW", "LIR"), ("SW", "SIR"))
#: Level types in field addresses.
PRESSURE, MODEL, SOIL = 100, 150, 106


@dataclass(frozen=True)
class Fields:
    """Families of fields to request; names with levels are written name@level, with a wavelength name@wavelength@level."""

    single: tuple[str, ...] = ()
    pressure: tuple[str, ...] = ()
    model: tuple[str, ...] = ()
    soil: tuple[str, ...] = ()
    wavelength: tuple[str, ...] = ()
    invariant: tuple[str, ...] = ()
    steps: tuple[int, ...] = field(default=tuple(range(0, 79)))

    def __post_init__(self) -> None:
        if not (self.single or self.pressure or self.model):
            raise ValueError("at least one single, pressure or model level field is needed")

    def rows(self) -> list[tuple]:
        """(family, name, path of the level part, all steps)."""
        out = [("single", v, "", True) for v in self.single] + [("invariant", v, "", False) for v in self.invariant]
        for family, kind in (("pressure", PRESSURE), ("model", MODEL), ("soil", SOIL)):
            for v in getattr(self, family):
                name, level = v.split("@")
                out.append((family, name, f"/lvt1/{kind}/lv1/{level}", True))
        for v in self.wavelength:
            name, wave, level = v.split("@")
            out.append(("wavelength", name, f"/wvl1/{wave}/lvt1/{MODEL}/lv1/{level}", True))
        return out


def field_requests(runs: DataFrame, fields: Fields, base: str) -> DataFrame:
    """(run columns, family, name, step, url) of every field of every run (init time ``init_time``); invariant fields come at step 0 only."""
    spark = runs.sparkSession
    wanted = spark.createDataFrame(fields.rows(), "family string, name string, level string, every boolean")
    steps = spark.createDataFrame([(int(s),) for s in fields.steps], "step int")
    stepped = wanted.where("every").crossJoin(steps).unionByName(wanted.where("not every").withColumn("step", F.lit(0))).drop("every")
    url = F.concat(F.lit(f"{base}/"), "name", "level", F.lit("/r/"), F.date_format("init_time", "yyyy-MM-dd'T'HH:mm"), F.lit("/s/PT"), F.lpad(F.col("step").cast("string"), 3, "0"), F.lit("H00M.grib2"))
    return runs.crossJoin(F.broadcast(stepped)).withColumn("url", url).drop("level")


def hourly_forecast(runs: DataFrame, steps: int, prefix: str) -> DataFrame:
    """Files 1 to ``steps`` of each daily run (init_time)."""
    url = templated(f"{prefix}_{{run}}_{{step}}.nc4", run=F.date_format("init_time", "yyyyMMdd'00'"), step=F.lpad(F.col("step").cast("string"), 3, "0"))
    return runs.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(steps)))).withColumn("url", url)


def entity_periods(entities: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """Every entity with every day of the years, leap days included, as year and day of year."""
    days = F.sequence(F.make_date(F.lit(first_year), F.lit(1), F.lit(1)), F.make_date(F.lit(last_year), F.lit(12), F.lit(31)))
    return entities.withColumn("date", F.explode(days)).withColumn("year", F.year("date")).withColumn("day_of_year", F.dayofyear("date"))


def variable_weeks(weeks: DataFrame, variables: tuple[str, ...], present: DataFrame | None = None) -> DataFrame:
    """Every variable for every week (start), with its file name; files that are present are left out."""
    end = F.date_add("start", 7)
    name = F.concat(F.date_format("start", "yyyyMMdd"), F.lit("-"), F.date_format(end, "yyyyMMdd"), F.lit("_"), F.col("variable"), F.lit(".nc.zip"))
    made = weeks.withColumn("variable", F.explode(F.array(*map(F.lit, variables)))).withColumn("file", name)
    return made if present is None else made.join(present.select("file"), "file", "left_anti")


def month_blocks(years: DataFrame, size: int) -> DataFrame:
    """Each year in blocks of so many months: (year, block, months), months two digits each."""
    months = F.transform(F.sequence(F.col("block") * size + 1, F.col("block") * size + size), lambda m: F.lpad(m.cast("string"), 2, "0"))
    return years.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(12 // size - 1)))).withColumn("months", months)


def channel_files(times: DataFrame, root: str) -> DataFrame:
    """File of every mosaic channel at each time."""
    spark: SparkSession = times.sparkSession
    names = spark.createDataFrame(list(MOSAIC_FILES), "channel string, written string")
    path = F.concat(F.lit(f"{root}_"), F.col("channel"), F.date_format("time", "/yyyy/MM/dd/HH/"), F.lit("GLOBCOMP"), F.col("written"), F.lit("_nc."), F.date_format("time", "yyyyMMddHH"))
    return times.crossJoin(F.broadcast(names)).withColumn("path", path).drop("written")


def backward_windows(stations: DataFrame, start: str, end: str, days: int = 365) -> DataFrame:
    """Windows (start, end) of so many days for each station, from the last one back until the start is passed."""
    step = F.expr(f"INTERVAL {days} DAYS")
    ends = F.filter(F.sequence(F.lit(end).cast("timestamp_ntz"), F.lit(start).cast("timestamp_ntz"), F.expr(f"INTERVAL -{days} DAYS")), lambda t: t > F.lit(start).cast("timestamp_ntz"))
    return stations.withColumn("end", F.explode(ends)).withColumn("start", F.col("end") - step)
