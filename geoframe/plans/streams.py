"""Queries of streaming jobs: STR. Each stream reads the events' files to their end; the SQL states the batch result."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoframe.catalog import query, table
from geoframe.plans.stores import interrupted
from geoframe.sources.store import Store, scratch
from geoframe.streaming import jobs as J

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
LINES = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
#: Windows that a delay of one partition has closed when the stream ends.
CLOSED = "date_trunc('{0}', ts) + INTERVAL {1} <= (SELECT max(ts) FROM events) - INTERVAL {2}"


def events(spark, sf_dir):
    return J.read_files(spark, f"{sf_dir}/events.parquet", EVENTS, "ts")


def through_files(spark, stream):
    """Runs a stream into Parquet and reads the result."""
    path = scratch(spark, "stream")
    J.to_files(stream, path, scratch(spark, "progress"))
    return spark.read.schema(stream.schema).parquet(path)


@query("STR1_incremental_ingest", "SELECT event_id, ts AS time, event_type AS band, CASE WHEN value > 0.5 THEN value END AS value FROM events")
def str1(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", F.col("ts").cast("timestamp_ntz").alias("time"), F.col("event_type").alias("band"), F.when(F.col("value") > 0.5, F.col("value")).alias("value"))
    return through_files(spark, rows)


@query("STR2_tumbling_partitions", "SELECT date_trunc('hour', ts)::TIMESTAMP AS start, count(*) AS n, round(sum(value), 4) AS total FROM events WHERE " + CLOSED.format("hour", "1 HOUR", "0 SECOND") + " GROUP BY 1")
def str2(spark, sf_dir):
    made = J.closed_windows(events(spark, sf_dir), "ts", "1 hour", "0 seconds", [], n=F.count("*"), total=F.sum("value"))
    return through_files(spark, made).withColumn("total", F.round("total", 4))


@query("STR3_closing_delay", "SELECT date_trunc('day', ts)::TIMESTAMP AS start, count(*) AS n FROM events WHERE " + CLOSED.format("day", "1 DAY", "2 DAY") + " GROUP BY 1")
def str3(spark, sf_dir):
    return through_files(spark, J.closed_windows(events(spark, sf_dir), "ts", "1 day", "2 days", [], n=F.count("*")))


@query("STR4_late_regions", "SELECT event_id, event_type, value FROM events")
def str4(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "value", "event_type")
    store = Store(spark, scratch(spark, "late"), ["event_type"]).create(rows.where("event_type = 'click'").withColumn("value", F.lit(-1.0)))
    sink = J.region_sink(store)
    J.each_batch(events(spark, sf_dir).select("event_id", "value", "event_type"), lambda batch, k: (sink(batch, k), sink(batch, k)) and None, scratch(spark, "progress"))
    return store.read().select("event_id", "event_type", "value")


@query("STR5_exactly_once", "SELECT count(*) AS products, count(DISTINCT user_id) AS names FROM (SELECT DISTINCT user_id FROM events)")
def str5(spark, sf_dir):
    stream = events(spark, sf_dir).select("ts", F.col("user_id").cast("string").alias("product"))
    once = through_files(spark, J.once_by_name(stream, "ts", "100 days", "product"))
    return once.agg(F.count("*").alias("products"), F.count_distinct("product").alias("names"))


@query("STR6_two_dimensions", "SELECT date_trunc('day', ts)::TIMESTAMP AS start, event_type, count(*) AS n FROM events WHERE " + CLOSED.format("day", "1 DAY", "1 DAY") + " GROUP BY 1, 2")
def str6(spark, sf_dir):
    return through_files(spark, J.closed_windows(events(spark, sf_dir), "ts", "1 day", "1 day", ["event_type"], n=F.count("*")))


@query("STR7_complete_runs", "SELECT l_orderkey, count(DISTINCT l_linenumber)::BIGINT AS steps FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_linenumber) >= 4")
def str7(spark, sf_dir):
    runs = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").cast("timestamp").alias("init_time"))
    stream = J.read_files(spark, f"{sf_dir}/lineitem.parquet", LINES, "l_shipdate").select("l_orderkey", "l_linenumber").join(runs, "l_orderkey")
    path = scratch(spark, "runs")
    J.complete_runs(stream, "l_orderkey", "l_linenumber", 4, "init_time", "4000 days", path, scratch(spark, "progress"))
    return spark.read.schema("l_orderkey long, steps long").parquet(path).select("l_orderkey", "steps")


@query("STR8_backfill_and_live", "SELECT user_id, count(*) AS n FROM events GROUP BY 1")
def str8(spark, sf_dir):
    rows = lambda df: df.select("event_id", F.col("user_id").cast("string").alias("product"), "user_id", F.to_date("ts").alias("day"))
    history = rows(table(spark, sf_dir, "events"))
    store = Store(spark, scratch(spark, "both"), ["day"]).create(history.where("user_id < 0"))
    store.append_products(history.where("user_id % 3 = 0"), "product", -1)
    J.each_batch(rows(events(spark, sf_dir)), J.ledger_sink(store, "product"), scratch(spark, "progress"))
    return store.committed("product").groupBy("user_id").agg(F.count("*").alias("n"))


@query("STR9_retried_batches", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def str9(spark, sf_dir):
    given = table(spark, sf_dir, "events").select("event_id", "event_type", F.to_date("ts").alias("day"))
    store = Store(spark, scratch(spark, "retry"), ["day"]).create(given.where("event_id < 0"))
    sink = J.ledger_sink(store, "event_type")

    def twice(batch, number):
        interrupted(store, batch, "event_type", number)
        sink(batch, number)
        sink(batch, number)

    J.each_batch(events(spark, sf_dir).select("event_id", "event_type", F.to_date("ts").alias("day")), twice, scratch(spark, "progress"))
    return store.committed("event_type").groupBy("event_type").agg(F.count("*").alias("n"))


def whole_stream(spark, sf_dir, name, time):
    """A table's file as a stream, its schema as stored."""
    return J.read_files(spark, f"{sf_dir}/{name}.parquet", table(spark, sf_dir, name).schema, time)


@query("STR2_calendar_weeks", "SELECT date_trunc('week', ts)::TIMESTAMP AS start, date_trunc('week', ts)::TIMESTAMP + INTERVAL 7 DAY AS \"end\", count(*) AS n, round(sum(value), 4) AS total FROM events WHERE date_trunc('week', ts) < (SELECT date_trunc('week', max(ts)) FROM events) GROUP BY 1")
def str2_weeks(spark, sf_dir):
    made = J.calendar_windows(whole_stream(spark, sf_dir, "events", "ts"), "ts", "week", 0, [], n=F.count("*"), total=F.sum("value"))
    return through_files(spark, made).withColumn("total", F.round("total", 4))


@query("STR3_months_with_delay", "SELECT date_trunc('month', o_orderdate)::TIMESTAMP AS start, date_trunc('month', o_orderdate)::TIMESTAMP + INTERVAL 1 MONTH AS \"end\", count(*) AS n FROM orders WHERE date_trunc('month', o_orderdate) < (SELECT date_trunc('month', max(o_orderdate)) - INTERVAL 2 MONTH FROM orders) GROUP BY 1")
def str3_months(spark, sf_dir):
    return through_files(spark, J.calendar_windows(whole_stream(spark, sf_dir, "orders", "o_orderdate"), "o_orderdate", "month", -2, [], n=F.count("*")))


@query("STR6_months_by_priority", "SELECT date_trunc('month', o_orderdate)::TIMESTAMP AS start, o_orderpriority, count(*) AS n, max(o_totalprice) AS most FROM orders WHERE date_trunc('month', o_orderdate) < (SELECT date_trunc('month', max(o_orderdate)) - INTERVAL 1 MONTH FROM orders) GROUP BY 1, 2")
def str6_months(spark, sf_dir):
    made = J.calendar_windows(whole_stream(spark, sf_dir, "orders", "o_orderdate"), "o_orderdate", "month", -1, ["o_orderpriority"], n=F.count("*"), most=F.max("o_totalprice"))
    return through_files(spark, made).drop("end")


@query("STR7_run_deadlines", """
WITH r AS (SELECT l_orderkey, o_orderdate, list(DISTINCT l_linenumber) AS lines FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2)
SELECT l_orderkey, CASE WHEN len(lines) >= 4 THEN 'complete' ELSE 'expired' END AS status, len(lines)::BIGINT AS steps, CASE WHEN len(lines) >= 4 THEN '' ELSE array_to_string([k FOR k IN [1, 2, 3, 4] IF NOT list_contains(lines, k)], ',') END AS missing
FROM r WHERE len(lines) >= 4 OR o_orderdate <= (SELECT max(o_orderdate) FROM r) - INTERVAL 30 DAY
""")
def str7_deadlines(spark, sf_dir):
    runs = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").alias("init_time"))
    steps = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber")).join(runs, "l_orderkey")
    held, files, path, progress = (scratch(spark, n) for n in ("held", "steps", "told", "progress"))
    steps.write.parquet(held)
    for part in J.parts_by_time(spark.read.schema(steps.schema).parquet(held), "init_time", 3):
        part.write.mode("append").parquet(files)
        stream = spark.readStream.schema(steps.schema).parquet(files).withColumn("init_time", F.col("init_time").cast("timestamp"))
        J.deadline_runs(stream, "l_orderkey", "l_linenumber", 4, "init_time", "30 days", path, progress, first=1)
    told = J.told_runs(spark, path, "l_orderkey long, init_time timestamp", 4)
    return told.select("l_orderkey", "status", "steps", F.concat_ws(",", F.transform("missing", lambda k: k.cast("string"))).alias("missing"))
