"""Catalogues of forecast models as tables: which fields a model has, and whether a request asks for others."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoframe.sources import requests as R

# Single-level fields of the forecast models.
SINGLE_EUROPE = (
    "alb_rad alhfl_s ashfl_s asob_s asob_t aswdifd_s aswdifu_s aswdir_s athb_s athb_t aumfl_s avmfl_s cape_con cape_ml clch clcl clcm clct clct_mod cldepth evap_pl h_snow hbas_con htop_con htop_dc hsnow_max hzerocl "
    "pmsl ps qv_2m qv_s rain_con rain_gsp relhum_2m rho_snow runoff_g runoff_s snow_con snow_gsp snowlmt t_2m t_g t_snow tch tcm td_2m tmax_2m tmin_2m tot_prec tqc tqi u_10m v_10m vmax_10m w_snow ww z0"
)
SINGLE_GLOBAL = (
    "alb_rad alhfl_s ashfl_s asob_s asob_t aswdifd_s aswdifu_s aswdir_s athb_s athb_t aumfl_s avmfl_s cape_con cape_ml clch clcl clcm clct clct_mod cldepth c_t_lk freshsnw fr_ice h_snow h_ice h_ml_lk hbas_con htop_con htop_dc hzerocl "
    "pmsl ps qv_s rain_con rain_gsp relhum_2m rho_snow runoff_g runoff_s snow_con snow_gsp t_2m t_g t_snow t_ice tch tcm td_2m tmax_2m tmin_2m tot_prec tqc tqi tqr tqs tqv u_10m v_10m vmax_10m w_snow ww z0"
)
# Fields of the ensembles.
ENSEMBLE_GLOBAL = "asob_s aswdir_s athb_s relhum_2m sobs_rad t_2m td_2m thbs_rad tot_prec u_10m v_10m vmax_10m clct"
ENSEMBLE_EUROPE = "aswdifd_s aswdir_s athb_s t_2m snow_con snow_gsp sobs_rad thbs_rad tot_prec u_10m v_10m vmax_10m tqv ps cape_ml"
ENSEMBLE_EUROPE_3D = "fi u v t"
# Fields of the dust model; those of a mode end in A, B or C.
DUST_MODES = "ACCDRYDEPO_DUST ACCEMISS_DUST ACCSEDIM_DUST ACCWETDEPO_CON_DUST ACCWETDEPO_GSP_DUST"
DUST_SINGLE = (
    "ALB_RAD ALHFL_S ASHFL_S ASOB_S ASOB_T ASWDIFD_S ASWDIFU_S ASWDIR_S ATHB_S ATHB_T AUMFL_S AVMFL_S CAPE_CON CAPE_ML CLCH CLCL CLCM CLCT CLCT_MOD CLDEPTH C_T_LK DUST_TOTAL_MC_VI FRESHSNW FR_ICE HBAS_CON HTOP_CON HTOP_DC HZEROCL "
    "H_ICE H_ML_LK H_SNOW LPI_CON_MAX PMSL PS QV_S RAIN_CON RAIN_GSP RELHUM_2M RHO_SNOW ROOTDP RUNOFF_G RUNOFF_S SNOW_CON SNOW_GSP TAOD_DUST TCH TCM TD_2M T_2M TOT_PREC TQC TQI TQR TQS TQV U_10M V_10M VMAX_10M T_SNOW W_SNOW"
)
DUST_3D, DUST_SOIL = "FI RELHUM", "T_SO W_SO W_SO_ICE SMI"
DUST_MODEL = "T U V W P DUSTA DUSTB DUSTC DUSTA0 DUSTB0 DUSTC0 DUST_MAX_TOTAL_MC_LAYER DUST_TOTAL_MC"
DUST_WAVES = "CEIL_BSC_DUST SAT_BSC_DUST AER_DUST"
DUST_LEVELS = range(77, 121)
# Variables of the global air-quality forecast, its lead hours and runs.
OPTICAL_DEPTHS = (469, 550, 670, 865, 1240, 340, 355, 380, 400, 440, 500, 532, 645, 800, 858, 1020, 1064, 1640, 2130)
RADIATION = (
    "direct_solar_radiation", "downward_uv_radiation_at_the_surface", "surface_net_solar_radiation", "surface_net_thermal_radiation", "surface_solar_radiation_downwards",
    "surface_thermal_radiation_downwards", "toa_incident_solar_radiation", "total_sky_direct_solar_radiation_at_surface",
)
AIR_QUALITY_GLOBAL = (*(f"total_aerosol_optical_depth_{n}nm" for n in OPTICAL_DEPTHS), *RADIATION)
LEAD_HOURS_GLOBAL, RUNS_GLOBAL = range(121), ("00:00", "12:00")


def _families(model: str) -> dict[str, list[tuple[str, str | None, str | None]]]:
    """(name, wavelength, level) of each family of a model."""
    one = lambda names: [(v, None, None) for v in names]
    on = lambda names, levels: [(v, None, str(x)) for v in names for x in levels]
    if model == "global":
        return {"single": one(SINGLE_GLOBAL.split()), "pressure": on(R.VARIABLES_3D[model], R.PRESSURE_GLOBAL), "model": on(R.VARIABLES_MODEL[model], R.MODEL_LEVELS_GLOBAL), "soil": on(("t_so",), R.SOIL_DEPTHS), "invariant": one(R.INVARIANT)}
    if model == "europe":
        return {"single": one(SINGLE_EUROPE.split()), "pressure": on(R.VARIABLES_3D[model], R.PRESSURE_EUROPE), "model": on(R.VARIABLES_MODEL[model], R.MODEL_LEVELS_EUROPE), "soil": on(("t_so",), R.SOIL_DEPTHS), "invariant": one(R.INVARIANT)}
    if model == "global ensemble":
        return {"single": one(ENSEMBLE_GLOBAL.split())}
    if model == "europe ensemble":
        return {"single": one(ENSEMBLE_EUROPE.split()), "pressure": on(ENSEMBLE_EUROPE_3D.split(), R.PRESSURE_EUROPE)}
    if model == "dust":
        single = [m + c for m in DUST_MODES.split() for c in "ABC"] + DUST_SINGLE.split()
        waves = [(v, str(w), str(x)) for v in DUST_WAVES.split() for w in R.WAVELENGTHS for x in DUST_LEVELS]
        return {"single": one(single), "pressure": on(DUST_3D.split(), R.PRESSURE_DUST), "model": on(DUST_MODEL.split(), DUST_LEVELS), "soil": on(DUST_SOIL.split(), R.SOIL_DEPTHS), "wavelength": waves}
    raise ValueError(f"no model {model}")


MODELS = ("global", "europe", "global ensemble", "europe ensemble", "dust")


def fields(spark: SparkSession, models: tuple[str, ...] = MODELS) -> DataFrame:
    """(model, family, name, wavelength, level) of all fields of the models; levels and wavelengths are text, null where a family has none."""
    rows = [(m, family, *field) for m in models for family, found in _families(m).items() for field in found]
    return spark.createDataFrame(rows, "model string, family string, name string, wavelength string, level string")


def requests(runs: DataFrame, catalogue: DataFrame, steps: tuple[int, ...], base: str) -> DataFrame:
    """(run columns, model, family, name, step, url) of every field of a catalogue for every run (init_time); invariant fields come at step 0 only."""
    kind = F.when(F.col("family") == "pressure", R.PRESSURE).when(F.col("family") == "soil", R.SOIL).otherwise(R.MODEL)
    levels = F.concat(F.coalesce(F.concat(F.lit("/wvl1/"), "wavelength"), F.lit("")), F.coalesce(F.concat(F.lit("/lvt1/"), kind.cast("string"), F.lit("/lv1/"), "level"), F.lit("")))
    step = F.explode(F.when(F.col("family") == "invariant", F.array(F.lit(0))).otherwise(F.array(*map(F.lit, steps))))
    fielded = catalogue.select("model", "family", "name", levels.alias("at")).withColumn("step", step)
    url = F.concat(F.lit(f"{base}/"), "name", "at", F.lit("/r/"), F.date_format("init_time", "yyyy-MM-dd'T'HH:mm"), F.lit("/s/PT"), F.lpad(F.col("step").cast("string"), 3, "0"), F.lit("H00M.grib2"))
    return runs.crossJoin(F.broadcast(fielded)).withColumn("url", url).drop("at")


def not_offered(wanted: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Rows of wanted (model, family, name, wavelength, level) that the catalogue hasn't; none if a run's configuration is right."""
    names = ["model", "family", "name", "wavelength", "level"]
    right = catalogue.select(*(F.col(c).alias(f"_{c}") for c in names)).distinct()
    same = F.lit(True)
    for c in names:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    return wanted.join(right, same, "left_anti")


def global_air_quality(weeks: DataFrame, present: DataFrame | None = None) -> DataFrame:
    """(start, variable, file, run, lead_hour): what a week's request of each variable of the global forecast asks for; files that are present are left out."""
    files = R.variable_weeks(weeks, AIR_QUALITY_GLOBAL, present)
    runs = F.explode(F.array(*map(F.lit, RUNS_GLOBAL)))
    return files.withColumn("run", runs).withColumn("lead_hour", F.explode(F.sequence(F.lit(LEAD_HOURS_GLOBAL.start), F.lit(LEAD_HOURS_GLOBAL.stop - 1))))


def european_air_quality(weeks: DataFrame, present: DataFrame | None = None) -> DataFrame:
    """(start, variable, file, lead_hour, height): what a week's request of each variable of the European forecast, one run a day, asks for; files that are present are left out."""
    files = R.variable_weeks(weeks, R.AIR_QUALITY, present)
    hours = F.explode(F.sequence(F.lit(R.AIR_QUALITY_HOURS.start), F.lit(R.AIR_QUALITY_HOURS.stop - 1)))
    return files.withColumn("lead_hour", hours).withColumn("height", F.explode(F.array(*map(F.lit, R.AIR_QUALITY_HEIGHTS))))
