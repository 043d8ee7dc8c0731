"""Queries of joins: JON, and the scene lookup UDF3."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoframe.catalog import query, table
from geoframe.functions import times as T
from geoframe.operators import join as J
from geoframe.operators import shape as H
from geoframe.operators.select import routes
from geoframe.sources.lookup import SceneSource

HOURLY = "(SELECT unnest(generate_series(date_trunc('hour', (SELECT min(ts) FROM events)), (SELECT max(ts) FROM events), INTERVAL 1 HOUR)) + to_minutes(30) AS time)"
NEAREST = f"""
SELECT r.time, r.channel, e.event_id AS path, abs(epoch_us(e.ts) - epoch_us(r.time)) AS apart_us
FROM (SELECT time, channel FROM {HOURLY}, (SELECT DISTINCT event_type AS channel FROM events)) r
JOIN events e ON e.event_type = r.channel AND date_trunc('hour', e.ts) = date_trunc('hour', r.time)
QUALIFY row_number() OVER (PARTITION BY r.time, r.channel ORDER BY abs(epoch_us(e.ts) - epoch_us(r.time)), e.event_id) = 1
"""


def hourly_requests(spark, sf_dir):
    """An hourly axis over the events' range, at half past, for each channel."""
    events = table(spark, sf_dir, "events")
    ends = events.agg(F.date_trunc("hour", F.min("ts")).alias("a"), F.max("ts").alias("b"))
    hours = ends.select(F.explode(F.sequence(T.ntz(F.col("a")), F.col("b"), F.expr("INTERVAL 1 HOUR"))).alias("time"))
    return J.crossed(hours.select((F.col("time") + F.expr("INTERVAL 30 MINUTES")).alias("time")), events.select(F.col("event_type").alias("channel")).distinct())


def scenes(spark, sf_dir):
    return table(spark, sf_dir, "events").select(F.col("event_type").alias("channel"), F.col("ts").alias("time"), F.col("event_id").alias("path"), "value")


@query("JON1_merge_variables", "SELECT user_id, date_trunc('day', ts)::TIMESTAMP AS day, " + ", ".join(f"max(value) FILTER (event_type = '{v}') AS {v}" for v in ("click", "purchase", "view")) + " FROM events WHERE event_type IN ('click', 'purchase', 'view') GROUP BY 1, 2")
def jon1(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("day", T.ntz(F.date_trunc("day", "ts")))
    return J.merged([events.where(F.col("event_type") == v).select("user_id", "day", F.col("value").alias(v)) for v in ("click", "purchase", "view")], ["user_id", "day"])


@query("JON2_merge_families", "SELECT coalesce(s.k, l.k) AS run, surface, coalesce(n_levels, 0) AS n_levels FROM (SELECT o_orderkey AS k, o_totalprice AS surface FROM orders WHERE o_orderkey % 3 <> 0) s FULL JOIN (SELECT l_orderkey AS k, count(*) AS n_levels FROM lineitem GROUP BY 1) l ON s.k = l.k")
def jon2(spark, sf_dir):
    surface = table(spark, sf_dir, "orders").where("o_orderkey % 3 <> 0").select(F.col("o_orderkey").alias("run"), F.col("o_totalprice").alias("surface"))
    levels = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("run")).agg(F.count("*").alias("n_levels"))
    return J.families(surface, levels, ["run"]).withColumn("n_levels", F.coalesce("n_levels", F.lit(0)))


@query("JON3_surface_along_levels", "SELECT l_orderkey AS run, l_linenumber, l_partkey, l_suppkey, l_quantity, o_totalprice AS surface, date_diff('second', o_orderdate, l_shipdate) AS step_s FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def jon3(spark, sf_dir):
    surface = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("run"), F.col("o_totalprice").alias("surface"), F.col("o_orderdate").alias("init_time"))
    levels = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("run"), "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
    return J.families(surface, levels, ["run"], "inner").select("run", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "surface", T.step_seconds(F.col("l_shipdate"), F.col("init_time")).alias("step_s"))


@query("JON4_match_by_name", "SELECT 'ACRR_' || a.event_id || '.h5' AS instant, a.value AS rate, b.value AS day_sum, c.value AS half_day_sum FROM events a JOIN events b ON a.event_id = b.event_id JOIN events c ON a.event_id = c.event_id WHERE a.event_id % 2 = 0 AND b.event_id % 3 = 0 AND c.event_id % 5 <> 0")
def jon4(spark, sf_dir):
    def product(hours, present):
        path = F.concat(F.lit(f"ACRR{hours}H_"), F.col("event_id").cast("string"), F.lit(".h5"))
        return table(spark, sf_dir, "events").where(present).select(path.alias("path"), "value")

    products = {"hour": product(1, "event_id % 2 = 0"), "day": product(24, "event_id % 3 = 0"), "half_day": product(12, "event_id % 5 <> 0")}
    met = J.by_derived_key(products, "path", r"(?<=ACRR)\d+H")
    return met.select("instant", F.col("hour_value").alias("rate"), F.col("day_value").alias("day_sum"), F.col("half_day_value").alias("half_day_sum"))


@query("JON5_navigation", "SELECT c_custkey, n_nationkey * 2.5 AS latitude, n_regionkey * 10.0 AS longitude FROM customer JOIN nation ON c_nationkey = n_nationkey")
def jon5(spark, sf_dir):
    navigation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), (F.col("n_nationkey") * F.lit(2.5)).alias("latitude"), (F.col("n_regionkey") * F.lit(10.0)).alias("longitude"))
    return J.navigated(table(spark, sf_dir, "customer"), navigation, ["c_nationkey"]).select("c_custkey", "latitude", "longitude")


@query("JON6_nearest_in_hour", NEAREST)
def jon6(spark, sf_dir):
    return J.nearest_in_hour(hourly_requests(spark, sf_dir), scenes(spark, sf_dir), ["channel"]).select("time", "channel", "path", "apart_us")


@query("JON7_route_to_satellite", """
SELECT o_orderkey, CASE o_orderkey % 3
  WHEN 0 THEN CASE WHEN t < TIMESTAMP '2025-04-07' THEN 'goes16' ELSE 'goes19' END
  WHEN 1 THEN CASE WHEN t < TIMESTAMP '2023-01-04' THEN 'goes17' ELSE 'goes18' END
  ELSE CASE WHEN t BETWEEN TIMESTAMP '2015-07-07' AND TIMESTAMP '2022-12-13' THEN 'himawari8' ELSE 'himawari9' END END AS satellite
FROM (SELECT o_orderkey, o_orderdate + to_days(9200) AS t FROM orders)
""")
def jon7(spark, sf_dir):
    position = F.element_at(F.array(F.lit("east"), F.lit("west"), F.lit("himawari")), (F.col("o_orderkey") % 3 + 1).cast("int"))
    given = table(spark, sf_dir, "orders").select("o_orderkey", position.alias("position"), (F.col("o_orderdate") + F.expr("INTERVAL 9200 DAYS")).alias("time"))
    return J.routed(given, routes(spark), "position").select("o_orderkey", "satellite")


@query("JON8_present_times_removed", "SELECT event_id, ts FROM events WHERE ts NOT IN (SELECT ts FROM events WHERE event_id % 4 = 0)")
def jon8(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    return J.not_present(events, events.where("event_id % 4 = 0"), ["ts"])


@query("JON9_downloaded_files_removed", "SELECT page_id, url FROM pages WHERE url NOT IN (SELECT url FROM pages WHERE page_id % 3 = 0)")
def jon9(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return J.not_present(pages, pages.where("page_id % 3 = 0"), ["url"])


@query("JON10_existing_files", "SELECT page_id, url FROM pages WHERE url IN (SELECT url FROM pages WHERE length(html) > 2000)")
def jon10(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return J.existing(pages.select("page_id", "url"), pages.where(F.char_length("html") > 2000).select("url"), ["url"])


@query("JON11_outer_alignment", "WITH h AS (SELECT user_id, date_trunc('day', ts)::TIMESTAMP AS day, min(value) AS value FROM events GROUP BY 1, 2) SELECT k.user_id, d.day, h.value FROM (SELECT DISTINCT user_id FROM h) k CROSS JOIN (SELECT DISTINCT day FROM h) d LEFT JOIN h ON h.user_id = k.user_id AND h.day = d.day")
def jon11(spark, sf_dir):
    given = table(spark, sf_dir, "events").select("user_id", T.ntz(F.date_trunc("day", "ts")).alias("day"), "value")
    return J.aligned(given, "user_id", "day", ["value"])


@query("JON12_pair_by_position", "WITH a AS (SELECT o_orderdate AS d, o_orderkey, row_number() OVER (PARTITION BY o_orderdate ORDER BY o_orderkey)::INT AS r, count(*) OVER (PARTITION BY o_orderdate) AS n FROM orders WHERE o_orderkey % 2 = 0), b AS (SELECT o_orderdate AS d, o_orderkey, row_number() OVER (PARTITION BY o_orderdate ORDER BY o_orderkey)::INT AS r, count(*) OVER (PARTITION BY o_orderdate) AS n FROM orders WHERE o_orderkey % 2 = 1) SELECT a.d AS day, a.r AS rank, a.o_orderkey AS data, b.o_orderkey AS geo FROM a JOIN b ON a.d = b.d AND a.r = b.r AND a.n = b.n")
def jon12(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    data = orders.where("o_orderkey % 2 = 0").select(F.col("o_orderdate").alias("day"), F.col("o_orderkey").alias("data"))
    geo = orders.where("o_orderkey % 2 = 1").select(F.col("o_orderdate").alias("day"), F.col("o_orderkey").alias("geo"))
    return J.paired_by_rank(data, geo, ["day"], ["data"], ["geo"]).select("day", "rank", "data", "geo")


@query("JON13_cross_product", "SELECT p_type AS var, p_size AS level, r_name AS region, CAST(s AS INT) AS step FROM (SELECT DISTINCT p_type FROM part), (SELECT DISTINCT p_size FROM part), region, range(0, 120, 24) t(s)")
def jon13(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    steps = table(spark, sf_dir, "region").select(F.col("r_name").alias("region"), F.explode(F.sequence(F.lit(0), F.lit(96), F.lit(24))).alias("step"))
    return J.crossed(part.select(F.col("p_type").alias("var")).distinct(), part.select(F.col("p_size").alias("level")).distinct(), steps)


@query("JON14_mosaic_of_tiles", "SELECT y, x, value, vec_id FROM (SELECT CAST((vec_id // 4 % 40) * 4 + (k - 1) // 8 AS INT) AS y, CAST((vec_id % 4) * 4 + (k - 1) % 8 AS INT) AS x, embedding[k] AS value, vec_id, row_number() OVER (PARTITION BY (vec_id // 4 % 40) * 4 + (k - 1) // 8, (vec_id % 4) * 4 + (k - 1) % 8 ORDER BY vec_id) AS r FROM embeddings, range(1, 65) t(k)) WHERE r = 1")
def jon14(spark, sf_dir):
    cells = H.cells(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "embedding", 8)
    tile = F.floor(F.col("vec_id") / 4).cast("long") % 40
    placed = cells.select((tile * 4 + F.col("y")).cast("int").alias("y"), (F.col("vec_id") % 4 * 4 + F.col("x")).cast("int").alias("x"), "value", "vec_id")
    return J.mosaic([placed], ["vec_id"]).select("y", "x", "value", "vec_id")


@query("JON15_exact_slot", "SELECT r.o_orderkey, e.event_id AS path FROM (SELECT o_orderkey, (SELECT min(ts) FROM events) + to_minutes(CAST(10 * o_orderkey AS INT)) AS t FROM orders) r JOIN events e ON epoch_us(e.ts) // 600000000 = epoch_us(r.t) // 600000000")
def jon15(spark, sf_dir):
    first = table(spark, sf_dir, "events").agg(F.min("ts").alias("first"))
    asked = table(spark, sf_dir, "orders").join(F.broadcast(first)).select("o_orderkey", (F.col("first") + F.make_dt_interval(F.lit(0), F.lit(0), (10 * F.col("o_orderkey")).cast("int"))).alias("time"))
    return J.exact_slot(asked, scenes(spark, sf_dir)).select("o_orderkey", "path")


@query("JON17_gap_filled_view", f"SELECT h.time, coalesce(count(e.event_id), 0)::BIGINT AS n, coalesce(max(e.value), -99.0) AS value FROM (SELECT time - to_minutes(30) AS time FROM {HOURLY}) h LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') e ON date_trunc('hour', e.ts) = h.time GROUP BY h.time")
def jon17(spark, sf_dir):
    hours = hourly_requests(spark, sf_dir).select(T.ntz(F.date_trunc("hour", "time")).alias("time")).distinct()
    data = table(spark, sf_dir, "events").where("event_type = 'purchase'").groupBy(T.ntz(F.date_trunc("hour", "ts")).alias("time")).agg(F.count("*").alias("n"), F.max("value").alias("value"))
    return J.filled(hours, data, ["time"], {"n": 0, "value": -99.0})


@query("UDF3_scene_source", NEAREST.replace("SELECT r.time", "SELECT r.time", 1).replace("abs(epoch_us(e.ts) - epoch_us(r.time)) AS apart_us", "e.value, e.ts AS scene_time").replace("JOIN events e ON", "JOIN events e ON r.channel IN ('click', 'view') AND r.time >= TIMESTAMP '2024-01-10' AND r.time <= TIMESTAMP '2024-01-20' AND"))
def udf3(spark, sf_dir):
    source = SceneSource(scenes(spark, sf_dir), channels=("click", "error", "purchase", "signup", "view"), start="2024-01-10 00:00:00", end="2024-01-20 00:00:00")
    return source(hourly_requests(spark, sf_dir).select("time").distinct(), ["click", "view"]).select("time", "channel", "path", "value", "scene_time")
