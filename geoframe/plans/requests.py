"""Queries of request manifests: GEN3 to GEN10."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoframe.catalog import query, table
from geoframe.functions import times as T
from geoframe.sources import catalogues as K
from geoframe.sources import requests as R

DAYS = "(SELECT DISTINCT o_orderdate AS init_time FROM orders)"


def runs(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("init_time")).distinct()


@query("GEN3_hourly_forecast_files", f"SELECT init_time, CAST(s AS INT) AS step, 'dust_' || strftime(init_time, '%Y%m%d') || '00_' || lpad(CAST(s AS VARCHAR), 3, '0') || '.nc4' AS url FROM {DAYS}, range(1, 121) t(s)")
def gen3(spark, sf_dir):
    return R.hourly_forecast(runs(spark, sf_dir), 120, "dust")


@query("GEN4_model_field_manifest", f"SELECT init_time, family, name, step, 'x/' || name || level || '/r/' || strftime(init_time, '%Y-%m-%dT%H:%M') || '/s/PT' || lpad(CAST(step AS VARCHAR), 3, '0') || 'H00M.grib2' AS url FROM {DAYS}, (VALUES ('single', 't_2m', '', 0), ('single', 't_2m', '', 3), ('pressure', 'fi', '/lvt1/100/lv1/500', 0), ('pressure', 'fi', '/lvt1/100/lv1/500', 3), ('model', 'u', '/lvt1/150/lv1/10', 0), ('model', 'u', '/lvt1/150/lv1/10', 3), ('soil', 't_so', '/lvt1/106/lv1/0.01', 0), ('soil', 't_so', '/lvt1/106/lv1/0.01', 3), ('wavelength', 'T', '/wvl1/532/lvt1/150/lv1/118', 0), ('wavelength', 'T', '/wvl1/532/lvt1/150/lv1/118', 3), ('invariant', 'clat', '', 0)) v(family, name, level, step)")
def gen4(spark, sf_dir):
    fields = R.Fields(single=("t_2m",), pressure=("fi@500",), model=("u@10",), soil=("t_so@0.01",), wavelength=("T@532@118",), invariant=("clat",), steps=(0, 3))
    return R.field_requests(runs(spark, sf_dir), fields, "x")


@query("GEN5_entity_periods", "SELECT n_nationkey, year(d)::INT AS year, dayofyear(d)::INT AS day_of_year FROM nation, (SELECT unnest(generate_series(DATE '2023-01-01', DATE '2024-12-31', INTERVAL 1 DAY)) AS d)")
def gen5(spark, sf_dir):
    return R.entity_periods(table(spark, sf_dir, "nation").select("n_nationkey"), 2023, 2024).drop("date")


@query("GEN6_variable_weeks", "SELECT CAST(start AS VARCHAR) AS start, variable, strftime(start, '%Y%m%d') || '-' || strftime(start + INTERVAL 7 DAY, '%Y%m%d') || '_' || variable || '.nc.zip' AS file FROM (SELECT DISTINCT date_trunc('week', o_orderdate)::DATE AS start FROM orders), (SELECT unnest(" + str(list(R.AIR_QUALITY)) + ") AS variable) WHERE NOT (variable = 'ozone' AND year(start) = 1997)")
def gen6(spark, sf_dir):
    weeks = table(spark, sf_dir, "orders").select(F.to_date(F.date_trunc("week", "o_orderdate")).alias("start")).distinct()
    present = R.variable_weeks(weeks.where(F.year("start") == 1997), ("ozone",))
    return R.variable_weeks(weeks, R.AIR_QUALITY, present).select(F.col("start").cast("string").alias("start"), "variable", "file")


@query("GEN7_month_blocks", "SELECT year, CAST(b AS INT) AS block, lpad(CAST(2 * b + 1 AS VARCHAR), 2, '0') || ',' || lpad(CAST(2 * b + 2 AS VARCHAR), 2, '0') AS months FROM (SELECT DISTINCT year(o_orderdate)::INT AS year FROM orders), range(6) t(b)")
def gen7(spark, sf_dir):
    years = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year")).distinct()
    return R.month_blocks(years, 2).withColumn("months", F.concat_ws(",", "months"))


@query("GEN8_channel_files", "SELECT time, channel, 'm_' || channel || strftime(time, '/%Y/%m/%d/%H/') || 'GLOBCOMP' || written || '_nc.' || strftime(time, '%Y%m%d%H') AS path FROM (SELECT DISTINCT date_trunc('hour', ts)::TIMESTAMP AS time FROM events), (VALUES ('VIS', 'VIS'), ('SSR', 'SSR'), ('WV', 'WV'), ('LW', 'LIR'), ('SW', 'SIR')) v(channel, written)")
def gen8(spark, sf_dir):
    times = table(spark, sf_dir, "events").select(T.ntz(F.date_trunc("hour", "ts")).alias("time")).distinct()
    return R.channel_files(times, "m")


@query("GEN10_backward_windows", "SELECT c_custkey, e - INTERVAL 365 DAY AS start, e AS \"end\" FROM customer, (SELECT TIMESTAMP '2020-01-31' - to_days(CAST(365 * k AS INT)) AS e FROM range(30) t(k)) WHERE e > TIMESTAMP '2000-01-01'")
def gen10(spark, sf_dir):
    return R.backward_windows(table(spark, sf_dir, "customer").select("c_custkey"), "2000-01-01 00:00:00", "2020-01-31 00:00:00")


MONTHS = "(SELECT DISTINCT date_trunc('month', o_orderdate)::TIMESTAMP AS init_time FROM orders)"


def _catalogue_sql() -> str:
    """The catalogues in SQL, a query for each family from the same fixed values."""
    names = lambda model, family, xs: f"SELECT '{model}' AS model, '{family}' AS family, unnest({list(xs)}) AS name, '' AS place"
    levels = lambda model, family, kind, xs, ys: f"SELECT '{model}', '{family}', n, '/lvt1/{kind}/lv1/' || y FROM (SELECT unnest({list(xs)}) AS n), (SELECT unnest({[str(y) for y in ys]}) AS y)"
    dust = [m + c for m in K.DUST_MODES.split() for c in "ABC"] + K.DUST_SINGLE.split()
    parts = [
        names("global", "single", K.SINGLE_GLOBAL.split()), levels("global", "pressure", 100, R.VARIABLES_3D["global"], R.PRESSURE_GLOBAL), levels("global", "model", 150, R.VARIABLES_MODEL["global"], R.MODEL_LEVELS_GLOBAL), levels("global", "soil", 106, ("t_so",), R.SOIL_DEPTHS),
        names("europe", "single", K.SINGLE_EUROPE.split()), levels("europe", "pressure", 100, R.VARIABLES_3D["europe"], R.PRESSURE_EUROPE), levels("europe", "model", 150, R.VARIABLES_MODEL["europe"], R.MODEL_LEVELS_EUROPE), levels("europe", "soil", 106, ("t_so",), R.SOIL_DEPTHS),
        names("global ensemble", "single", K.ENSEMBLE_GLOBAL.split()), names("europe ensemble", "single", K.ENSEMBLE_EUROPE.split()), levels("europe ensemble", "pressure", 100, K.ENSEMBLE_EUROPE_3D.split(), R.PRESSURE_EUROPE),
        names("dust", "single", dust), levels("dust", "pressure", 100, K.DUST_3D.split(), R.PRESSURE_DUST), levels("dust", "model", 150, K.DUST_MODEL.split(), K.DUST_LEVELS), levels("dust", "soil", 106, K.DUST_SOIL.split(), R.SOIL_DEPTHS),
        f"SELECT 'dust', 'wavelength', n, '/wvl1/' || w || '/lvt1/150/lv1/' || y FROM (SELECT unnest({K.DUST_WAVES.split()}) AS n), (SELECT unnest({list(R.WAVELENGTHS)}) AS w), (SELECT unnest({list(K.DUST_LEVELS)}) AS y)",
    ]
    stepped = f"SELECT model, family, name, place, s AS step FROM ({' UNION ALL '.join(parts)}), (VALUES (0), (6)) v(s)"
    still = " UNION ALL ".join(f"SELECT model, family, name, place, 0 FROM ({names(m, 'invariant', R.INVARIANT)})" for m in ("global", "europe"))
    return f"{stepped} UNION ALL {still}"


@query("GEN4_whole_catalogues", f"SELECT init_time, model, family, count(*) AS n, count(DISTINCT url) AS urls, min(url) AS first, max(url) AS last FROM (SELECT *, 'x/' || name || place || '/r/' || strftime(init_time, '%Y-%m-%dT%H:%M') || '/s/PT' || lpad(CAST(step AS VARCHAR), 3, '0') || 'H00M.grib2' AS url FROM {MONTHS}, ({_catalogue_sql()})) GROUP BY 1, 2, 3")
def gen4_catalogues(spark, sf_dir):
    months = table(spark, sf_dir, "orders").select(T.ntz(F.date_trunc("month", "o_orderdate")).alias("init_time")).distinct()
    made = K.requests(months, K.fields(spark), (0, 6), "x")
    return made.groupBy("init_time", "model", "family").agg(F.count("*").alias("n"), F.count_distinct("url").alias("urls"), F.min("url").alias("first"), F.max("url").alias("last"))


@query("GEN4_fields_not_offered", "SELECT p_partkey AS request, CASE p_partkey % 3 WHEN 0 THEN 'global' WHEN 1 THEN 'europe' ELSE 'dust' END AS model FROM part WHERE p_partkey % 3 = 2 OR p_partkey % 3 = 1 AND p_partkey % 200 > 75 OR p_partkey % 3 = 0 AND p_partkey % 200 > 120")
def gen4_not_offered(spark, sf_dir):
    """Configurations that ask for the wind on a model level that their model hasn't; the dust model writes its names otherwise."""
    k = F.col("p_partkey")
    model = F.when(k % 3 == 0, "global").when(k % 3 == 1, "europe").otherwise("dust")
    wanted = table(spark, sf_dir, "part").select(k.alias("request"), model.alias("model"), F.lit("model").alias("family"), F.lit("u").alias("name"), F.lit(None).cast("string").alias("wavelength"), (k % 200).cast("string").alias("level"))
    return K.not_offered(wanted, K.fields(spark)).select("request", "model")


@query("GEN6_global_weeks", f"SELECT CAST(start AS VARCHAR) AS start, variable, count(*) AS n, min(run) AS first_run, max(lead) AS last_lead FROM (SELECT DISTINCT date_trunc('week', o_orderdate)::DATE AS start FROM orders), (SELECT unnest({list(K.AIR_QUALITY_GLOBAL)}) AS variable), (VALUES ('00:00'), ('12:00')) r(run), (SELECT CAST(k AS INT) AS lead FROM range(121) t(k)) WHERE NOT (variable = 'direct_solar_radiation' AND year(start) = 1997) GROUP BY 1, 2")
def gen6_global(spark, sf_dir):
    weeks = table(spark, sf_dir, "orders").select(F.to_date(F.date_trunc("week", "o_orderdate")).alias("start")).distinct()
    present = R.variable_weeks(weeks.where(F.year("start") == 1997), ("direct_solar_radiation",))
    made = K.global_air_quality(weeks, present)
    return made.groupBy(F.col("start").cast("string").alias("start"), "variable").agg(F.count("*").alias("n"), F.min("run").alias("first_run"), F.max("lead_hour").alias("last_lead"))


@query("GEN6_europe_heights", f"SELECT CAST(start AS VARCHAR) AS start, height, count(*) AS n, count(DISTINCT variable) AS variables, max(lead) AS last_lead FROM (SELECT DISTINCT date_trunc('week', o_orderdate)::DATE AS start FROM orders), (SELECT unnest({list(R.AIR_QUALITY)}) AS variable), (SELECT unnest({list(R.AIR_QUALITY_HEIGHTS)}) AS height), (SELECT CAST(k AS INT) AS lead FROM range(97) t(k)) WHERE NOT (variable = 'ozone' AND year(start) = 1997) GROUP BY 1, 2")
def gen6_europe(spark, sf_dir):
    weeks = table(spark, sf_dir, "orders").select(F.to_date(F.date_trunc("week", "o_orderdate")).alias("start")).distinct()
    made = K.european_air_quality(weeks, R.variable_weeks(weeks.where(F.year("start") == 1997), ("ozone",)))
    return made.groupBy(F.col("start").cast("string").alias("start"), "height").agg(F.count("*").alias("n"), F.count_distinct("variable").alias("variables"), F.max("lead_hour").alias("last_lead"))
