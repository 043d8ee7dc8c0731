"""Queries of filters and validations: FLT."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoframe.catalog import query, table
from geoframe.functions import values as V
from geoframe.operators import select as S

CLASS_OF = "CASE p_type WHEN 'STANDARD' THEN 'STATION OBS' WHEN 'MEDIUM' THEN 'DRIFTING BUOYS' WHEN 'ECONOMY' THEN 'VOLUNTEER OBSERVING SHIPS' WHEN 'PROMO' THEN 'PROFILING FLOATS AND GLIDERS (GENERIC)' WHEN 'LARGE' THEN 'VOSCLIM' ELSE 'RESEARCH' END"
RANGES_SQL = "(VALUES ('goes16', TIMESTAMP '2017-12-18', TIMESTAMP '2025-04-07'), ('goes17', '2019-02-12', '2023-01-04'), ('goes18', '2023-01-04', NULL), ('n21', '2023-02-27', NULL))"


@query("FLT1_time_lower_bound", "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-15'")
def flt1(spark, sf_dir):
    return S.since(table(spark, sf_dir, "events").select("event_id", "ts"), "ts", "2024-01-15")


@query("FLT2_masking_where", "SELECT event_id, CASE WHEN value > 5 THEN value END AS value FROM events")
def flt2(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", S.masked(F.col("value"), F.col("value") > 5).alias("value"))


@query("FLT4_usable_stations", "SELECT p_partkey FROM part WHERE 1990 + p_size >= 2020 AND p_retailprice > 905 AND p_partkey % 9 <> 0")
def flt4(spark, sf_dir):
    given = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") + 1990).alias("end"), F.col("p_retailprice").alias("total"), F.when(F.col("p_partkey") % 9 != 0, 1.0).alias("latitude"))
    return S.usable_stations(given, "end", "total", 2020, 905, ["latitude"]).select("p_partkey")


@query("FLT5_interval_overlap", "SELECT o_orderkey FROM orders WHERE o_orderkey % 10 <> 0 AND o_orderdate <= TIMESTAMP '1998-12-31' AND o_orderdate + to_days(90) >= TIMESTAMP '1998-01-01'")
def flt5(spark, sf_dir):
    start = F.when(F.col("o_orderkey") % 10 == 0, F.lit("unknown")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    given = table(spark, sf_dir, "orders").select("o_orderkey", start.alias("start"), F.date_format(F.date_add("o_orderdate", 90), "yyyy-MM-dd").alias("end"))
    return S.overlapping(given, "start", "end", "1998-01-01", "1998-12-31").select("o_orderkey")


@query("FLT6_closed_window", "SELECT event_id, ts FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-11 23:59:59'")
def flt6(spark, sf_dir):
    return S.between(table(spark, sf_dir, "events").select("event_id", "ts"), "ts", "2024-01-05 00:00:00", "2024-01-11 23:59:59")


@query("FLT7_platform_equality", "SELECT event_id, user_id, value FROM events WHERE event_type = 'click' AND user_id = 7")
def flt7(spark, sf_dir):
    return table(spark, sf_dir, "events").where((F.col("event_type") == "click") & (F.col("user_id") == 7)).select("event_id", "user_id", "value")


@query("FLT8_platform_classes", f"SELECT p_partkey, class FROM (SELECT p_partkey, unnest([CASE WHEN contains(n, 'BUOY') THEN 'buoys' END, CASE WHEN contains(n, 'SHIP') OR contains(n, 'UNCREWED SURFACE VEHICLE') OR contains(n, 'VOSCLIM') THEN 'ships' END, CASE WHEN contains(n, 'STATION') THEN 'stations' END, CASE WHEN contains(n, 'OBS') THEN 'obs' END, CASE WHEN contains(n, 'GLIDER') OR contains(n, 'FLOAT') THEN 'gliders' END]) AS class FROM (SELECT p_partkey, {CLASS_OF} AS n FROM part)) WHERE class IS NOT NULL")
def flt8(spark, sf_dir):
    named = table(spark, sf_dir, "part").select("p_partkey", F.expr(CLASS_OF).alias("name"))
    return named.select("p_partkey", F.explode(V.platform_classes(F.col("name"))).alias("class"))


@query("FLT9_membership", "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'view') AND user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'HOUSEHOLD')")
def flt9(spark, sf_dir):
    keys = table(spark, sf_dir, "customer").where("c_mktsegment = 'HOUSEHOLD'").select(F.col("c_custkey").alias("user_id"))
    return table(spark, sf_dir, "events").where(F.col("event_type").isin("click", "view")).join(keys, "user_id", "left_semi").select("event_id", "event_type")


@query("FLT10_missing_rows_and_variables", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN value END AS a, CASE WHEN event_id % 3 = 0 THEN value END AS b FROM events WHERE event_id % 2 = 0 OR event_id % 3 = 0")
def flt10(spark, sf_dir):
    value = F.col("value")
    given = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 2 == 0, value).alias("a"), F.when(F.col("event_id") % 3 == 0, value).alias("b"), F.when(F.col("event_id") < 0, value).alias("c"))
    return S.not_all_missing(given.select("event_id", *S.variables_with_values(given, ["a", "b", "c"])), ["a", "b"])


@query("FLT11_file_patterns", "SELECT page_id, url FROM pages WHERE contains(url, '/en/') AND url LIKE 'https://%'")
def flt11(spark, sf_dir):
    return S.matching_files(table(spark, sf_dir, "pages").select("page_id", "url"), "url", part="/en/", like="https://%")


@query("FLT12_history_validation", f"SELECT event_id, CASE WHEN r.s IS NULL THEN 'unknown satellite' WHEN t < r.a THEN 'before start' WHEN r.b IS NOT NULL AND t > r.b THEN 'after end' ELSE 'ok' END AS status FROM (SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'goes16' WHEN 1 THEN 'goes17' WHEN 2 THEN 'goes18' WHEN 3 THEN 'n21' ELSE 'sat0' END AS satellite, ts - to_days(CAST(event_id % 2500 AS INT)) + to_days(500) AS t FROM events) LEFT JOIN {RANGES_SQL} r(s, a, b) ON satellite = r.s")
def flt12(spark, sf_dir):
    which = F.element_at(F.array(*map(F.lit, ("goes16", "goes17", "goes18", "n21", "sat0"))), (F.col("event_id") % 5 + 1).cast("int"))
    given = table(spark, sf_dir, "events").select("event_id", which.alias("satellite"), (F.col("ts") + F.make_dt_interval((500 - F.col("event_id") % 2500).cast("int"))).alias("time"))
    return S.in_history(given, S.operating_ranges(spark)).select("event_id", "status")


@query("FLT13_single_resolution", "SELECT o, count(DISTINCT k)::BIGINT AS classes, count(*) FILTER (k IS NULL)::BIGINT AS unknown, count(DISTINCT k) = 1 AND count(*) FILTER (k IS NULL) = 0 AS valid FROM (SELECT l_orderkey AS o, CASE WHEN c = 2 THEN 'high' WHEN c IN (1, 3, 5) THEN 'medium' WHEN c BETWEEN 1 AND 16 THEN 'low' END AS k FROM (SELECT l_orderkey, l_partkey % 18 AS c FROM lineitem)) GROUP BY o")
def flt13(spark, sf_dir):
    channel = F.concat(F.lit("C"), F.lpad((F.col("l_partkey") % 18).cast("string"), 2, "0"))
    return S.single_resolution(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o"), channel.alias("channel")), "goes", "o", "channel")


@query("FLT14_enum_validation", "SELECT event_id, event_type IN ('click', 'view', 'signup') AS valid FROM events")
def flt14(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", S.allowed(F.col("event_type"), ("click", "view", "signup")).alias("valid"))


@query("FLT15_completeness", "SELECT l_orderkey, count(DISTINCT l_linenumber)::BIGINT AS steps, count(DISTINCT l_linenumber) >= 5 AS complete FROM lineitem GROUP BY 1")
def flt15(spark, sf_dir):
    return S.complete_runs(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_linenumber", 5)


@query("FLT16_broken_inputs", "SELECT event_id, user_id FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_id % 97 = 0)")
def flt16(spark, sf_dir):
    given = table(spark, sf_dir, "events").select("event_id", "user_id", (F.col("event_id") % 97 != 0).alias("ok"))
    return S.readable(S.readable_runs(given, "user_id", "ok"), "ok").select("event_id", "user_id")
