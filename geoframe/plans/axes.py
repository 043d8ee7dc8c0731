"""Queries of time axes and templates: GEN1, GEN2, GEN11, SNK6, SNK7."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoframe.catalog import query, table
from geoframe.functions import tables
from geoframe.functions import times as T
from geoframe.operators import axes as A
from geoframe.operators import join as J

ENDS = "(SELECT min(ts) AS a, max(ts) AS b FROM events)"


@query("GEN1_regular_time_axis", f"SELECT unnest(generate_series(date_trunc('day', a)::TIMESTAMP, b, INTERVAL 15 MINUTE)) AS time FROM {ENDS}")
def gen1(spark, sf_dir):
    ends = A.span(table(spark, sf_dir, "events"), "ts")
    return A.time_axis(ends, F.date_trunc("day", "start"), F.col("end"), "15 MINUTES").select("time")


@query("GEN1_month_ends", "SELECT last_day(m)::TIMESTAMP AS time FROM (SELECT unnest(generate_series(date_trunc('month', a)::TIMESTAMP, b, INTERVAL 1 MONTH)) AS m FROM (SELECT min(o_orderdate) AS a, max(o_orderdate) AS b FROM orders))")
def gen1m(spark, sf_dir):
    return A.month_ends(A.span(table(spark, sf_dir, "orders"), "o_orderdate"), F.col("start"), F.col("end")).select("time")


@query("GEN2_available_times", "SELECT event_type AS satellite, unnest(generate_series(a, b, INTERVAL 600 SECOND)) AS time FROM (SELECT event_type, min(ts) AS a, CASE WHEN event_type = 'view' THEN TIMESTAMP '2024-02-05' ELSE max(ts) END AS b FROM events GROUP BY 1)")
def gen2(spark, sf_dir):
    ranges = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("satellite")).agg(F.min("ts").alias("start"), F.max("ts").alias("end"))
    opened = ranges.withColumn("end", F.when(F.col("satellite") != "view", F.col("end")))
    return A.available_times(opened, 600, "2024-02-05 00:00:00")


@query("GEN11_partition_catalogue", f"SELECT s AS start, s + INTERVAL 1 DAY AS \"end\", band FROM (SELECT unnest(generate_series(date_trunc('day', a)::TIMESTAMP, date_trunc('day', b)::TIMESTAMP - INTERVAL 2 DAY, INTERVAL 1 DAY)) AS s FROM {ENDS}), (SELECT DISTINCT event_type AS band FROM events)")
def gen11(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return A.windows(A.span(events, "ts"), F.col("start"), F.col("end"), "day", -2, events.select(F.col("event_type").alias("band")).distinct())


@query("SNK6_template_store", f"SELECT time, c_nationkey, CAST(-99 AS INT) AS flag, 0.0 AS rate FROM (SELECT unnest(generate_series(date_trunc('day', a)::TIMESTAMP, b, INTERVAL 1 HOUR)) AS time FROM {ENDS}), (SELECT DISTINCT c_nationkey FROM customer)")
def snk6(spark, sf_dir):
    hours = A.time_axis(A.span(table(spark, sf_dir, "events"), "ts"), F.date_trunc("day", "start"), F.col("end"), "1 HOUR").select("time")
    return A.template(hours, table(spark, sf_dir, "customer").select("c_nationkey").distinct(), {"flag": -99, "rate": 0.0})


@query("SNK7_region_templates", f"SELECT region, time, coalesce(flag, -99)::BIGINT AS flag FROM (SELECT r_name AS region, time FROM region, (SELECT unnest(generate_series(date_trunc('day', a)::TIMESTAMP, b, INTERVAL 1 DAY)) AS time FROM {ENDS})) t LEFT JOIN (SELECT r_name AS r2, date_trunc('day', ts) AS d, count(*) AS flag FROM events JOIN region ON user_id % 7 = r_regionkey GROUP BY 1, 2) e ON region = r2 AND time = d")
def snk7(spark, sf_dir):
    region, events = table(spark, sf_dir, "region"), table(spark, sf_dir, "events")
    days = A.time_axis(A.span(events, "ts"), F.date_trunc("day", "start"), F.col("end"), "1 DAY").select("time")
    made = A.template(days, region.select(F.col("r_name").alias("region")), {})
    data = events.withColumn("r_regionkey", (F.col("user_id") % 7).cast("int")).join(region, "r_regionkey").groupBy(F.col("r_name").alias("region"), T.ntz(F.date_trunc("day", "ts")).alias("time")).agg(F.count("*").alias("flag"))
    return J.filled(made, data, ["region", "time"], {"flag": -99})


def in_sql(spark, sf_dir, sql, *names):
    """Spark SQL over the given tables as views, with the table functions."""
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(f"sql_{name}")
    return tables.register(spark).sql(sql)


SPAN = "(SELECT min(ts) AS a, max(ts) AS b FROM sql_events)"


@query("GEN1_axis_in_sql", f"SELECT unnest(generate_series(date_trunc('hour', a)::TIMESTAMP, b, INTERVAL 30 MINUTE)) AS time FROM {ENDS}")
def gen1_sql(spark, sf_dir):
    return in_sql(spark, sf_dir, f"SELECT t.time FROM {SPAN}, LATERAL time_axis(CAST(date_trunc('HOUR', a) AS TIMESTAMP_NTZ), b, 30) t", "events")


@query("GEN1_month_ends_in_sql", "SELECT last_day(m)::TIMESTAMP AS day FROM (SELECT unnest(generate_series(date_trunc('month', a)::TIMESTAMP, b, INTERVAL 1 MONTH)) AS m FROM (SELECT min(o_orderdate) AS a, max(o_orderdate) AS b FROM orders))")
def gen1_ends_sql(spark, sf_dir):
    return in_sql(spark, sf_dir, "SELECT CAST(t.day AS TIMESTAMP_NTZ) AS day FROM (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b FROM sql_orders), LATERAL month_ends(a, b) t", "orders")


@query("GEN2_slots_in_sql", "SELECT day, count(*) AS slots, max(day + to_minutes(CAST(15 * k AS BIGINT))) AS last FROM (SELECT DISTINCT date_trunc('day', ts)::TIMESTAMP AS day FROM events), range(96) t(k) GROUP BY 1")
def gen2_sql(spark, sf_dir):
    return in_sql(spark, sf_dir, "SELECT CAST(d.day AS TIMESTAMP_NTZ) AS day, count(*) AS slots, max(t.time) AS last FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM sql_events) d, LATERAL scene_slots(d.day, 15) t GROUP BY 1", "events")


@query("GEN3_forecast_files_in_sql", "SELECT o_orderdate::TIMESTAMP AS run, CAST(s AS INT) AS step, 'dust_' || strftime(o_orderdate, '%Y%m%d') || '00_' || lpad(CAST(s AS VARCHAR), 3, '0') || '.nc4' AS url FROM (SELECT DISTINCT o_orderdate FROM orders), range(1, 25) t(s)")
def gen3_sql(spark, sf_dir):
    return in_sql(spark, sf_dir, "SELECT r.run, t.step, t.url FROM (SELECT DISTINCT CAST(o_orderdate AS TIMESTAMP_NTZ) AS run FROM sql_orders) r, LATERAL forecast_files(r.run, 24, 'dust') t", "orders")


@query("GEN5_entity_days_in_sql", "SELECT n_nationkey, year(d)::INT AS year, dayofyear(d)::INT AS day_of_year FROM nation, (SELECT unnest(generate_series(DATE '2023-01-01', DATE '2024-12-31', INTERVAL 1 DAY)) AS d)")
def gen5_sql(spark, sf_dir):
    return in_sql(spark, sf_dir, "SELECT n_nationkey, t.year, t.day_of_year FROM sql_nation, year_days(2023, 2024) t", "nation")


@query("GEN7_month_blocks_in_sql", "SELECT year, CAST(b AS INT) AS block, lpad(CAST(3 * b + 1 AS VARCHAR), 2, '0') || ',' || lpad(CAST(3 * b + 2 AS VARCHAR), 2, '0') || ',' || lpad(CAST(3 * b + 3 AS VARCHAR), 2, '0') AS months FROM (SELECT DISTINCT year(o_orderdate)::INT AS year FROM orders), range(4) t(b)")
def gen7_sql(spark, sf_dir):
    return in_sql(spark, sf_dir, "SELECT y.year, t.block, t.months FROM (SELECT DISTINCT year(o_orderdate) AS year FROM sql_orders) y, month_blocks(3) t", "orders")


@query("GEN10_backward_windows_in_sql", "SELECT c_custkey, e - INTERVAL 365 DAY AS start, e AS stop FROM customer, (SELECT TIMESTAMP '2020-01-31' - to_days(CAST(365 * k AS INT)) AS e FROM range(30) t(k)) WHERE e > TIMESTAMP '2000-01-01'")
def gen10_sql(spark, sf_dir):
    return in_sql(spark, sf_dir, "SELECT c_custkey, t.start, t.stop FROM sql_customer, backward_windows(TIMESTAMP_NTZ '2000-01-01', TIMESTAMP_NTZ '2020-01-31', 365) t", "customer")


@query("GEN11_weeks_in_sql", f"SELECT s AS start, s + INTERVAL 7 DAY AS stop, band FROM (SELECT unnest(generate_series(date_trunc('week', a)::TIMESTAMP, date_trunc('week', b)::TIMESTAMP - INTERVAL 7 DAY, INTERVAL 7 DAY)) AS s FROM {ENDS}), (SELECT DISTINCT event_type AS band FROM events)")
def gen11_weeks_sql(spark, sf_dir):
    return in_sql(spark, sf_dir, f"SELECT t.start, t.stop, band FROM {SPAN}, LATERAL week_windows(a, b, -1) t, (SELECT DISTINCT event_type AS band FROM sql_events)", "events")


@query("GEN11_months_in_sql", "SELECT s AS start, s + INTERVAL 1 MONTH AS stop FROM (SELECT unnest(generate_series(date_trunc('month', a)::TIMESTAMP, date_trunc('month', b)::TIMESTAMP - INTERVAL 2 MONTH, INTERVAL 1 MONTH)) AS s FROM (SELECT min(o_orderdate) AS a, max(o_orderdate) AS b FROM orders))")
def gen11_months_sql(spark, sf_dir):
    return in_sql(spark, sf_dir, "SELECT t.start, t.stop FROM (SELECT CAST(min(o_orderdate) AS TIMESTAMP_NTZ) AS a, CAST(max(o_orderdate) AS TIMESTAMP_NTZ) AS b FROM sql_orders), LATERAL month_windows(a, b, -2) t", "orders")


@query("GEN11_ten_days_in_sql", f"SELECT s AS start, s + INTERVAL 10 DAY AS stop FROM (SELECT unnest(generate_series(date_trunc('day', a)::TIMESTAMP, b - INTERVAL 10 DAY, INTERVAL 10 DAY)) AS s FROM {ENDS})")
def gen11_days_sql(spark, sf_dir):
    return in_sql(spark, sf_dir, f"SELECT t.start, t.stop FROM {SPAN}, LATERAL day_windows(a, b, 10, -1) t", "events")
