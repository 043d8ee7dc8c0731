"""Whole pipelines composed of the library's operators: PIP. Each goes from file names or raw values to a stored or merged product."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoframe.catalog import query, table
from geoframe.functions import times as T
from geoframe.functions import values as V
from geoframe.operators import axes as A
from geoframe.operators import combine as C
from geoframe.operators import join as J
from geoframe.operators import select as L
from geoframe.operators import shape as S
from geoframe.sources.store import Store, scratch

SPAN = "(SELECT date_trunc('day', min(ts))::TIMESTAMP AS a, max(ts) AS b FROM events)"


@query("PIP1_radar_day", f"SELECT time, coalesce(n, 0)::BIGINT AS n, coalesce(rate, 0.0) AS rate FROM (SELECT unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS time FROM {SPAN}) LEFT JOIN (SELECT date_trunc('hour', ts) AS h, count(*) AS n, max(value) FILTER (event_id % 13 <> 0) AS rate FROM events GROUP BY 1) ON h = time")
def pip1(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    name = F.concat(F.lit("PrecipRate_"), F.date_format("ts", "yyyyMMdd-HHmmss"), F.lit(".grib2"))
    cells = events.select(T.time_from_name(name, "radar").alias("time"), V.fill_to_null(F.when(F.col("event_id") % 13 == 0, -1.0).otherwise(F.col("value")), -1.0).alias("rate"))
    hourly = cells.groupBy(T.ntz(F.date_trunc("hour", "time")).alias("time")).agg(F.count("*").alias("n"), F.max("rate").alias("rate"))
    store = Store(spark, scratch(spark, "radar"), ["day"]).create(hourly.withColumn("day", F.to_date("time")))
    axis = A.time_axis(A.span(events, "ts"), F.date_trunc("day", "start"), F.col("end"), "1 HOUR").select("time")
    return J.filled(axis, store.read().drop("day"), ["time"], {"n": 0, "rate": 0.0})


@query("PIP2_global_mosaic", "SELECT user_id, date_trunc('hour', ts)::TIMESTAMP AS time, coalesce(max(CAST(round_even(value, 0) AS BIGINT)) FILTER (event_type = 'click'), 255)::BIGINT AS vis, coalesce(max(CAST(round_even(value, 0) AS BIGINT)) FILTER (event_type = 'view'), 255)::BIGINT AS wv FROM events WHERE event_type IN ('click', 'view') GROUP BY 1, 2")
def pip2(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("time", T.ntz(F.date_trunc("hour", "ts")))
    channel = lambda kind, name: events.where(F.col("event_type") == kind).select("user_id", "time", F.rint("value").cast("long").alias(name))
    merged = J.merged([channel("click", "vis"), channel("view", "wv")], ["user_id", "time"])
    return merged.select("user_id", "time", V.null_to_fill(F.col("vis"), 255).alias("vis"), V.null_to_fill(F.col("wv"), 255).alias("wv"))


@query("PIP7_dust_runs", "SELECT o_orderkey, l_shipdate AS time, date_diff('second', o_orderdate, l_shipdate) AS step_s, max(l_quantity) AS dust FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_linenumber) >= 4) AND l_linenumber = 1 GROUP BY ALL")
def pip7(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    name = F.concat(F.lit("SILAM-dust-glob01_v5_7_2_"), F.date_format("o_orderdate", "yyyyMMddHH"), F.lit("_001.nc4"))
    runs = table(spark, sf_dir, "orders").select("o_orderkey", T.time_from_name(name, "dust").alias("init_time"))
    complete = L.complete_runs(lines, ["l_orderkey"], "l_linenumber", 4).where("complete").select(F.col("l_orderkey").alias("o_orderkey"))
    first = lines.where("l_linenumber = 1").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_shipdate").alias("time"), "l_quantity")
    joined = J.existing(first.join(runs, "o_orderkey"), complete, ["o_orderkey"]).withColumn("step_s", T.step_seconds(F.col("time"), F.col("init_time")))
    return joined.groupBy("o_orderkey", "time", "step_s").agg(F.max("l_quantity").alias("dust"))


@query("PIP8_surface_and_pressure", "SELECT l_orderkey AS run, l_linenumber AS level, max(l_extendedprice) AS temperature, max(o_totalprice) AS surface FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2")
def pip8(spark, sf_dir):
    surface = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("run"), F.col("o_totalprice").alias("surface"))
    levels = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("run"), F.col("l_linenumber").alias("level")).agg(F.max("l_extendedprice").alias("temperature"))
    return J.families(surface, levels, ["run"], "inner").select("run", "level", "temperature", "surface")


@query("PIP11_imager_requests", "SELECT r.time, r.channel, e.event_id AS path, make_timestamp((epoch_us(e.ts) + epoch_us(e.ts + to_seconds(570))) // 2) AS mid_time FROM (SELECT a + to_hours(CAST(k AS INT)) + to_minutes(30) AS time, c AS channel FROM " + SPAN + ", range(0, 2000) t(k), (VALUES ('click'), ('view')) v(c) WHERE a + to_hours(CAST(k AS INT)) + to_minutes(30) <= b) r JOIN events e ON e.event_type = r.channel AND date_trunc('hour', e.ts) = date_trunc('hour', r.time) QUALIFY row_number() OVER (PARTITION BY r.time, r.channel ORDER BY abs(epoch_us(e.ts) - epoch_us(r.time)), e.event_id) = 1")
def pip11(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    hours = A.time_axis(A.span(events, "ts"), F.date_trunc("day", "start") + F.expr("INTERVAL 30 MINUTES"), F.col("end"), "1 HOUR").select("time")
    asked = hours.withColumn("channel", F.explode(F.array(F.lit("click"), F.lit("view"))))
    scenes = events.select(F.col("event_type").alias("channel"), F.col("ts").alias("time"), F.col("event_id").alias("path"))
    found = J.nearest_in_hour(asked, scenes, ["channel"])
    end = F.col("scene_time") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(570))
    return found.select("time", "channel", "path", T.mid_time(F.col("scene_time"), end).alias("mid_time"))


@query("PIP13_polar_swaths", "SELECT platform, count(*) AS n, min(ts) AS first FROM (SELECT CASE user_id % 4 WHEN 1 THEN 'Metop-B' WHEN 2 THEN 'Metop-A' WHEN 3 THEN 'Metop-C' END AS platform, ts FROM events WHERE ts NOT IN (SELECT ts FROM events WHERE event_id % 5 = 0)) WHERE platform IS NOT NULL GROUP BY 1")
def pip13(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts", F.concat(F.lit("IASI_xxx_1C_M0"), (F.col("user_id") % 4).cast("string"), F.lit("_2025")).alias("product"))
    new = J.not_present(events, events.where("event_id % 5 = 0"), ["ts"])
    return new.withColumn("platform", V.platform_name(F.col("product"))).where("platform is not null").groupBy("platform").agg(F.count("*").alias("n"), F.min("ts").alias("first"))


@query("PIP14_radiosondes", "SELECT b AS block, count(*) AS n, count(temperature) AS filled FROM (SELECT k.user_id // 50 AS b, d.temperature FROM (SELECT DISTINCT user_id FROM events) k CROSS JOIN (SELECT DISTINCT date_trunc('day', ts)::TIMESTAMP AS time FROM events) t LEFT JOIN (SELECT user_id, date_trunc('day', ts)::TIMESTAMP AS time, min(value) AS temperature FROM events GROUP BY 1, 2) d ON d.user_id = k.user_id AND d.time = t.time) GROUP BY 1")
def pip14(spark, sf_dir):
    soundings = table(spark, sf_dir, "events").select("user_id", T.ntz(F.date_trunc("day", "ts")).alias("time"), "value")
    renamed = S.renamed(C.first_rows(soundings, ["user_id", "time"], ["value"]), {"value": "temperature"})
    matrix = J.aligned(renamed, "user_id", "time", ["temperature"])
    return matrix.groupBy(F.floor(F.col("user_id") / 50).cast("long").alias("block")).agg(F.count("*").alias("n"), F.count("temperature").alias("filled"))


@query("PIP18_tile_mosaic", "SELECT ring, count(*) AS cells, count(DISTINCT tile) AS tiles FROM (SELECT vec_id % 88 AS tile, CASE WHEN vec_id % 88 <= 5 THEN 'top2' WHEN vec_id % 88 <= 13 THEN 'top' WHEN vec_id % 88 <= 73 THEN 'centre' WHEN vec_id % 88 <= 81 THEN 'bottom' ELSE 'bottom2' END AS ring, unnest(embedding) AS v FROM embeddings) GROUP BY 1")
def pip18(spark, sf_dir):
    tiles = table(spark, sf_dir, "embeddings").select((F.col("vec_id") % 88).alias("tile"), "embedding")
    placed = S.cells(tiles, "embedding", 8).withColumn("ring", S.ring(F.col("tile")))
    return placed.groupBy("ring").agg(F.count("*").alias("cells"), F.count_distinct("tile").alias("tiles"))
