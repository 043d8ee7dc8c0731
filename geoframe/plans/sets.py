"""Queries of concatenation, deduplication, windows and order: UNI, WIN, SRT."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoframe.catalog import query, table
from geoframe.functions import times as T
from geoframe.operators import combine as C


def kind(spark, sf_dir, name):
    return table(spark, sf_dir, "events").where(F.col("event_type") == name)


@query("UNI1_concat_time", "SELECT event_id, ts, value FROM events WHERE event_type IN ('click', 'view')")
def uni1(spark, sf_dir):
    return C.concat([kind(spark, sf_dir, v).select("event_id", "ts", "value") for v in ("click", "view")])


@query("UNI2_concat_step", "SELECT l_orderkey, l_partkey, l_quantity, l_linenumber * 3600::BIGINT AS step_s FROM lineitem WHERE l_linenumber <= 3")
def uni2(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return C.concat([lines.where(F.col("l_linenumber") == k).select("l_orderkey", "l_partkey", "l_quantity", F.lit(k * 3600).cast("long").alias("step_s")) for k in (1, 2, 3)])


@query("UNI3_concat_new_axis", "SELECT event_id, event_type AS band, CASE WHEN event_type = 'click' THEN value END AS a, CASE WHEN event_type = 'view' THEN value END AS b FROM events WHERE event_type IN ('click', 'view')")
def uni3(spark, sf_dir):
    parts = {v: kind(spark, sf_dir, v).select("event_id", F.col("value").alias(n)) for v, n in (("click", "a"), ("view", "b"))}
    return C.concat_along(parts, "band").select("event_id", "band", "a", "b")


@query("UNI4_first_wins", "SELECT l_partkey, coalesce(min(l_suppkey) FILTER (l_linenumber = 1), min(l_suppkey) FILTER (l_linenumber = 2)) AS coordinate FROM lineitem WHERE l_linenumber <= 2 GROUP BY 1")
def uni4(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return C.first_wins([lines.where(F.col("l_linenumber") == k).select("l_partkey", F.col("l_suppkey").alias("coordinate")) for k in (1, 2)], ["l_partkey"])


@query("UNI5_concat_levels_in_steps", "SELECT epoch_ms(l_shipdate) // 86400000 AS step, l_linenumber AS level, count(*) AS n, sum(l_quantity) AS total FROM lineitem GROUP BY 1, 2")
def uni5(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select((T.encode_time(F.col("l_shipdate"), "s") / 86400).cast("long").alias("step"), F.col("l_linenumber").alias("level"), "l_quantity")
    return lines.groupBy("step", "level").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("total")).orderBy("step", "level")


@query("UNI6_stations_beside_each_other", "SELECT date_trunc('day', ts)::TIMESTAMP AS time, " + ", ".join(f"max(value) FILTER (user_id = {k}) AS s{k}" for k in (1, 2, 3)) + " FROM events WHERE user_id IN (1, 2, 3) GROUP BY 1")
def uni6(spark, sf_dir):
    given = table(spark, sf_dir, "events").where("user_id in (1, 2, 3)").select(T.ntz(F.date_trunc("day", "ts")).alias("time"), F.concat(F.lit("s"), F.col("user_id").cast("string")).alias("station"), "value")
    return given.groupBy("time").pivot("station", ["s1", "s2", "s3"]).agg(F.max("value"))


@query("UNI7_satellites_by_time", "SELECT 'n20' AS satellite, event_id, ts FROM events WHERE event_type = 'click' UNION ALL SELECT 'n21', event_id, ts FROM events WHERE event_type = 'view'")
def uni7(spark, sf_dir):
    parts = {s: kind(spark, sf_dir, v).select("event_id", "ts") for s, v in (("n20", "click"), ("n21", "view"))}
    return C.concat_along(parts, "satellite").orderBy("ts", "satellite")


@query("UNI8_union_of_times", "SELECT DISTINCT date_trunc('minute', ts)::TIMESTAMP AS time FROM events")
def uni8(spark, sf_dir):
    return C.distinct_values(table(spark, sf_dir, "events").select(T.ntz(F.date_trunc("minute", "ts")).alias("time")), "time").orderBy("time")


@query("UNI9_distinct_platforms", "SELECT DISTINCT user_id FROM events")
def uni9(spark, sf_dir):
    return C.distinct_values(table(spark, sf_dir, "events"), "user_id")


@query("UNI10_drop_duplicate_times", "SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity) AS r FROM lineitem) WHERE r = 1")
def uni10(spark, sf_dir):
    given = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity")
    return C.first_rows(given, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity"])


@query("UNI11_union_of_years", "SELECT o_orderkey, year(o_orderdate)::INT AS year FROM orders WHERE year(o_orderdate) IN (1996, 1998)")
def uni11(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return C.concat([orders.where(F.year("o_orderdate") == y).select("o_orderkey", F.lit(y).alias("year")) for y in (1996, 1998)])


@query("UNI12_flatten_lists", "SELECT o_custkey, o_orderkey AS uri FROM orders")
def uni12(spark, sf_dir):
    lists = table(spark, sf_dir, "orders").groupBy("o_custkey", "o_orderstatus").agg(F.collect_list("o_orderkey").alias("uris"))
    return lists.groupBy("o_custkey").agg(F.flatten(F.collect_list("uris")).alias("uris")).select("o_custkey", F.explode("uris").alias("uri"))


@query("UNI13_missing_slots", "SELECT u.user_id, d.day FROM (SELECT DISTINCT user_id FROM events) u CROSS JOIN (SELECT DISTINCT date_trunc('day', ts)::TIMESTAMP AS day FROM events) d WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = u.user_id AND e.event_type = 'purchase' AND date_trunc('day', e.ts) = d.day)")
def uni13(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", T.ntz(F.date_trunc("day", "ts")).alias("day"), "event_type")
    expected = events.select("user_id").distinct().crossJoin(events.select("day").distinct())
    return C.missing_slots(expected, events.where("event_type = 'purchase'").select("user_id", "day").distinct())


@query("WIN1_steps_from_first_time", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, min(l_shipdate) OVER (PARTITION BY l_orderkey) AS init_time, date_diff('second', min(l_shipdate) OVER (PARTITION BY l_orderkey), l_shipdate) AS step_s FROM lineitem")
def win1(spark, sf_dir):
    given = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    return C.forecast_steps(given, ["l_orderkey"], "l_shipdate").drop("l_shipdate")


@query("WIN2_steps_from_file_name", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, date_diff('second', o_orderdate, l_shipdate) AS step_s FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def win2(spark, sf_dir):
    name = F.concat(F.lit("SILAM-dust-glob01_v5_7_2_"), F.date_format("o_orderdate", "yyyyMMddHH"), F.lit("_001.nc4"))
    files = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), name.alias("name"))
    joined = table(spark, sf_dir, "lineitem").join(files, "l_orderkey")
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", T.step_seconds(F.col("l_shipdate"), T.time_from_name(F.col("name"), "dust")).alias("step_s"))


@query("WIN3_axis_position", "SELECT hour AS time, row_number() OVER (ORDER BY hour) - 1 AS position FROM (SELECT DISTINCT date_trunc('hour', ts)::TIMESTAMP AS hour FROM events)")
def win3(spark, sf_dir):
    return C.axis_index(table(spark, sf_dir, "events").select(T.ntz(F.date_trunc("hour", "ts")).alias("time")), "time")


@query("SRT1_sorted_by_time", "SELECT event_id, ts, row_number() OVER (ORDER BY ts DESC, event_id) - 1 AS position FROM events")
def srt1(spark, sf_dir):
    from geoframe.operators.shape import numbered

    return numbered(table(spark, sf_dir, "events").select("event_id", "ts", (-T.micros(F.col("ts"))).alias("falling")), ["falling", "event_id"]).drop("falling").orderBy(F.desc("ts"), "event_id")


@query("SRT2_first_available", "SELECT o_orderdate, o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT' ORDER BY o_orderdate, o_orderkey LIMIT 1")
def srt2(spark, sf_dir):
    return C.first_available(table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select("o_orderdate", "o_orderkey"), ["o_orderdate", "o_orderkey"])
