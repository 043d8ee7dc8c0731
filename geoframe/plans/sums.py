"""Queries of aggregations: AGG."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoframe.catalog import query, table
from geoframe.operators import axes as A
from geoframe.operators import combine as C
from geoframe.operators import shape as S
from geoframe.operators import sketch as K
from geoframe.sources.store import Store, scratch


@query("AGG1_unique_times", "SELECT user_id, count(DISTINCT date_trunc('hour', ts))::BIGINT AS times FROM events GROUP BY 1")
def agg1(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.count_distinct(F.date_trunc("hour", "ts")).cast("long").alias("times"))


@query("AGG2_ends_of_times", "SELECT user_id, min(ts) AS first, max(ts) AS last, arg_min(event_id, ts) AS first_id, arg_max(event_id, ts) AS last_id FROM events GROUP BY 1")
def agg2(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.min("ts").alias("first"), F.max("ts").alias("last"), F.min_by("event_id", "ts").alias("first_id"), F.max_by("event_id", "ts").alias("last_id"))


@query("AGG3_run_report", "SELECT regexp_extract(url, '://([^/]+)', 1) AS run, coalesce(sum(strlen(html)) FILTER (page_id % 5 <> 0), 0)::BIGINT AS bytes, count(*) FILTER (page_id % 5 <> 0) AS succeeded, count(*) FILTER (page_id % 5 = 0) AS failed FROM pages GROUP BY 1")
def agg3(spark, sf_dir):
    given = table(spark, sf_dir, "pages").select(F.regexp_extract("url", "://([^/]+)", 1).alias("run"), F.octet_length("html").cast("long").alias("size"), (F.col("page_id") % 5 != 0).alias("ok"))
    return C.run_report(given, ["run"], "size", "ok")


@query("AGG4_files_by_station", "SELECT o_custkey, string_agg(o_orderkey, ',' ORDER BY o_orderkey) AS files, count(*) AS n FROM orders GROUP BY 1")
def agg4(spark, sf_dir):
    listed = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.sort_array(F.collect_list("o_orderkey")).alias("ids"))
    return listed.select("o_custkey", F.concat_ws(",", F.col("ids").cast("array<string>")).alias("files"), F.size("ids").cast("long").alias("n"))


@query("AGG5_reports_by_platform", "SELECT user_id, count(value) AS n FROM events GROUP BY 1 HAVING count(value) > 0")
def agg5(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("value").alias("n")).where("n > 0")


@query("AGG9_write_batches", "SELECT b AS block, count(*) AS n, min(event_id) AS first FROM (SELECT event_id, (row_number() OVER (ORDER BY ts, event_id) - 1) // 15 AS b FROM events) GROUP BY b")
def agg9(spark, sf_dir):
    return S.blocks(table(spark, sf_dir, "events").select("event_id", "ts"), ["ts", "event_id"], 15).groupBy("block").agg(F.count("*").alias("n"), F.min("event_id").alias("first"))


@query("AGG10_station_coverage", "SELECT user_id, min(ts) AS start, max(ts) AS \"end\", count(*) AS total FROM events GROUP BY 1")
def agg10(spark, sf_dir):
    return C.coverage(table(spark, sf_dir, "events"), "user_id", "ts")


@query("AGG11_id_lists", "SELECT c_custkey // 40 AS block, string_agg(c_custkey, ',' ORDER BY c_custkey) AS ids FROM customer GROUP BY 1")
def agg11(spark, sf_dir):
    return C.id_lists(table(spark, sf_dir, "customer"), "c_custkey", 40)


@query("AGG11_padded_last_list", "SELECT b AS block, string_agg(40 * b + k, ',' ORDER BY k) AS ids FROM (SELECT DISTINCT c_custkey // 40 AS b FROM customer), range(40) t(k) GROUP BY 1")
def agg11_padded(spark, sf_dir):
    return C.id_lists(table(spark, sf_dir, "customer"), "c_custkey", 40, pad_last=True)


@query("AGG12_availability", """
WITH s AS (SELECT DISTINCT event_type FROM events UNION SELECT 'backfill'), d AS (SELECT unnest(generate_series(date_trunc('day', min(ts))::TIMESTAMP, date_trunc('day', max(ts))::TIMESTAMP, INTERVAL 1 DAY)) AS day FROM events),
p AS (SELECT event_type, date_trunc('day', ts)::TIMESTAMP AS day, count(DISTINCT epoch_us(ts) // 3600000000)::BIGINT AS present FROM events WHERE day(ts) % 6 <> 0 GROUP BY 1, 2)
SELECT event_type, day, coalesce(present, 0)::BIGINT AS present, 24::BIGINT AS expected FROM s CROSS JOIN d LEFT JOIN p USING (event_type, day)
""")
def agg12(spark, sf_dir):
    """A source that never delivered and days on which none did are rows, too."""
    events = table(spark, sf_dir, "events")
    days = A.time_axis(A.span(events, "ts"), F.date_trunc("day", "start"), F.date_trunc("day", "end"), "1 DAY").select(F.col("time").alias("day"))
    sources = events.select("event_type").unionByName(events.agg(F.lit("backfill").alias("event_type")))
    return C.availability(events.where("day(ts) % 6 <> 0"), "event_type", "ts", 24, sources, days)


@query("AGG12_days_without_any", "WITH d AS (SELECT unnest(generate_series(date_trunc('day', min(o_orderdate))::TIMESTAMP, date_trunc('day', max(o_orderdate))::TIMESTAMP, INTERVAL 1 DAY)) AS day FROM orders WHERE o_orderkey % 97 = 1), p AS (SELECT o_orderpriority, date_trunc('day', o_orderdate)::TIMESTAMP AS day FROM orders WHERE o_orderkey % 97 = 1) SELECT o_orderpriority, count(*) FILTER (n = 0) AS empty_days, count(*) AS days FROM (SELECT s.o_orderpriority, d.day, count(p.day) AS n FROM (SELECT DISTINCT o_orderpriority FROM p) s CROSS JOIN d LEFT JOIN p ON p.o_orderpriority = s.o_orderpriority AND p.day = d.day GROUP BY 1, 2) GROUP BY 1")
def agg12_empty(spark, sf_dir):
    made = C.availability(table(spark, sf_dir, "orders").where("o_orderkey % 97 = 1"), "o_orderpriority", "o_orderdate", 1)
    return made.groupBy("o_orderpriority").agg(F.count_if(F.col("present") == 0).alias("empty_days"), F.count("*").alias("days"))


@query("AGG1_sketched_times", "SELECT event_type, count(DISTINCT user_id * 100 + hour(ts))::BIGINT AS exact, true AS within FROM events GROUP BY 1")
def agg1_sketched(spark, sf_dir):
    """Distinct pairs of station and hour of each type from sketches by day: made of a part of the days, then the others are added and one is replaced."""
    given = table(spark, sf_dir, "events").select("event_id", "event_type", F.to_date("ts").alias("day"), (F.col("user_id") * 100 + F.hour("ts")).alias("slot"))
    store = Store(spark, scratch(spark, "times"), ["day"]).create(given.where("day(day) % 3 = 0"))
    counted = K.CountedStore(store, scratch(spark, "sketches"), ["event_type"], F.col("slot"))
    later = given.where("day(day) % 3 <> 0")
    store.append(later)
    counted.add(later)
    replaced = given.where("day(day) = 5")
    store.write_regions(replaced)
    counted.refresh(replaced.select("day").distinct())
    exact = given.groupBy("event_type").agg(F.count_distinct("slot").cast("long").alias("exact"))
    estimates = counted.estimates(["event_type"])
    return exact.join(estimates, "event_type").select("event_type", "exact", (F.abs(F.col("estimate") - F.col("exact")) <= K.error_bound() * F.col("exact")).alias("within"))


@query("AGG10_sketched_stations", "SELECT date_trunc('month', o_orderdate)::TIMESTAMP AS month, count(DISTINCT o_custkey)::BIGINT AS exact, true AS within FROM orders GROUP BY 1")
def agg10_sketched(spark, sf_dir):
    """Stations that reported in each month, from sketches by day."""
    orders = table(spark, sf_dir, "orders")
    month = F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("month")
    by_day = K.sketched(orders.select("o_orderdate", "o_custkey", month), ["month", "o_orderdate"], F.col("o_custkey"))
    exact = orders.groupBy(month).agg(F.count_distinct("o_custkey").cast("long").alias("exact"))
    return exact.join(K.merged(by_day, ["month"]), "month").select("month", "exact", (F.abs(F.col("estimate") - F.col("exact")) <= K.error_bound() * F.col("exact") + 1).alias("within"))
