"""Queries of sources, sinks and user functions: SRC, SNK1 to SNK16, UDF1, UDF2. Files are written from the tables, then read back."""

from __future__ import annotations

import copy
import io
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from geoframe.catalog import query, table
from geoframe.functions import times as T
from geoframe.functions import values as V
from geoframe.operators import combine as C
from geoframe.operators import join as J
from geoframe.operators import select as L
from geoframe.operators import shape as S
from geoframe.sources import archives as A
from geoframe.sources import checked as X
from geoframe.sources import manifest as M
from geoframe.sources import readers as R
from geoframe.sources import report as P
from geoframe.sources.store import Store, export_blocks, export_csv, export_text, scratch, write_folders


def daily(spark, sf_dir):
    """events with their day, as (event_id, ts, event_type, value, day)."""
    return table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value", F.to_date("ts").alias("day"))


def interrupted(store, rows, product, batch):
    """A batch of a run that fails after its data and before its ledger; the next run must not see it."""
    failing = copy.copy(store)
    failing._commit = None
    try:
        failing.append_products(rows, product, batch)
    except TypeError:
        return
    raise AssertionError("the run should have failed")


@query("SRC1_station_years", "SELECT o_custkey AS station, year(o_orderdate)::INT AS year, o_totalprice AS value FROM orders WHERE year(o_orderdate) IN (1996, 1997)")
def src1(spark, sf_dir):
    path = scratch(spark, "station-years")
    write_folders(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("station"), F.col("o_totalprice").alias("value"), F.year("o_orderdate").alias("year")), path, ["year"])
    return R.station_years(spark, path, "station long, value double, year int", years=[1996, 1997]).select("station", "year", "value")


@query("SRC2_station_list", "SELECT c_name AS id, c_acctbal AS latitude, c_custkey * 0.5 AS longitude, CASE WHEN c_custkey % 10 <> 0 THEN c_nationkey * 1.5 END AS elevation FROM customer")
def src2(spark, sf_dir):
    elevation = F.when(F.col("c_custkey") % 10 == 0, F.lit("-")).otherwise((F.col("c_nationkey") * F.lit(1.5)).cast("string"))
    line = F.concat_ws("   ", F.col("c_name"), (F.col("c_custkey") * F.lit(0.5)).cast("string"), F.col("c_acctbal").cast("string"), elevation)
    path = export_text(table(spark, sf_dir, "customer"), line, scratch(spark, "stations"))
    return R.station_list(spark, path, [("id", 0, "string"), ("latitude", 2, "double"), ("longitude", 1, "double"), ("elevation", 3, "double")])


@query("SRC4_gzip_csv", "SELECT event_id, date_trunc('second', ts) AS ts, value FROM events")
def src4(spark, sf_dir):
    given = table(spark, sf_dir, "events").select("event_id", T.ntz(F.date_trunc("second", "ts")).alias("ts"), "value", (F.col("user_id") % 10).alias("station"))
    path = export_csv(given.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), "value", "station"), scratch(spark, "hourly"), ["station"], "gzip")
    return R.csv_series(spark, path, "event_id long, ts timestamp_ntz, value double, station long").select("event_id", "ts", "value")


@query("SRC5_minute_text", "SELECT l_orderkey, l_linenumber, l_quantity AS tmpf, l_tax AS precip FROM lineitem")
def src5(spark, sf_dir):
    names = {"l_orderkey": "station", "l_linenumber": "valid", "l_quantity": "tmpf", "l_extendedprice": "dwpf", "l_discount": "sknt", "l_tax": "precip"}
    path = scratch(spark, "minutes")
    table(spark, sf_dir, "lineitem").select(*(F.col(a).alias(b) for a, b in names.items())).write.option("header", True).csv(path)
    read = R.csv_series(spark, path, "station long, valid int, tmpf double, dwpf double, sknt double, precip double")
    return read.select(F.col("station").alias("l_orderkey"), F.col("valid").alias("l_linenumber"), "tmpf", "precip")


def packed_archives(rows):
    """(path, content) of zip archives of the rows (station, time, value), one for each batch, with a TSV member for each station and one that isn't data."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            held = io.BytesIO()
            with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr("readme.txt", "not a member")
                for station, own in batch.groupby("station"):
                    archive.writestr(f"data/tngxxx{station:02d}.tsv", own[["time", "value"]].to_csv(sep="\t", header=False, index=False))
            yield pd.DataFrame({"path": [f"{uuid.uuid4().hex[:2]}/{uuid.uuid4().hex}.zip"], "content": [held.getvalue()]})

    return rows.mapInPandas(pack, "path string, content binary")


@query("SRC6_zip_of_tsv", "SELECT CAST(user_id % 100 AS INT) AS station, date_trunc('second', ts) AS time, 'power' AS variable, value FROM events WHERE value IS NOT NULL")
def src6(spark, sf_dir):
    given = table(spark, sf_dir, "events").select((F.col("user_id") % 100).cast("int").alias("station"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("time"), "value")
    path = A.write_files(packed_archives(given), scratch(spark, "archives"))
    return A.station_members(spark, path, "tng", ["power"]).select("station", "time", "variable", "value")


@query("SRC6_one_station", "SELECT CAST(user_id % 100 AS INT) AS station, count(*) AS n, round(sum(value), 4) AS total FROM events WHERE user_id % 100 = 7 AND value IS NOT NULL GROUP BY 1")
def src6_station(spark, sf_dir):
    given = table(spark, sf_dir, "events").select((F.col("user_id") % 100).cast("int").alias("station"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("time"), "value")
    path = A.write_files(packed_archives(given), scratch(spark, "archives"))
    return A.station_members(spark, path, "tng", ["power"], "07").groupBy("station").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("SRC7_json_inventory", "SELECT CAST(user_id AS VARCHAR) AS id, strftime(min(ts), '%Y-%m-%d') AS start, strftime(max(ts), '%Y-%m-%d') AS \"end\" FROM events GROUP BY 1")
def src7(spark, sf_dir):
    ends = table(spark, sf_dir, "events").groupBy("user_id").agg(F.date_format(F.min("ts"), "yyyy-MM-dd").alias("start"), F.date_format(F.max("ts"), "yyyy-MM-dd").alias("end"))
    path = scratch(spark, "inventory")
    ends.select(F.col("user_id").cast("string").alias("id"), F.struct(F.struct("start", "end").alias("hourly")).alias("inventory")).write.json(path)
    return R.inventory(spark, path)


@query("SRC8_geojson_networks", "SELECT 'S' || c_custkey AS sid FROM customer")
def src8(spark, sf_dir):
    path = scratch(spark, "networks")
    feature = F.struct(F.struct(F.concat(F.lit("S"), F.col("c_custkey").cast("string")).alias("sid")).alias("properties"))
    salted = table(spark, sf_dir, "customer").groupBy("c_nationkey", F.floor(F.col("c_custkey") / 1000).alias("part")).agg(F.collect_list(feature).alias("features"))
    salted.select("features").write.json(path)
    return R.network_stations(spark, path)


def _scaled_time(df, gain=1.0):
    return df.withColumn("value", F.col("value") * gain).withColumnRenamed("ts", "time")


@query("SRC9_multi_file_preprocess", "SELECT event_id, ts AS time, value * 2.0 AS value FROM events")
def src9(spark, sf_dir):
    path = scratch(spark, "parts")
    given = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    for k in (0, 1):
        given.where(F.col("event_id") % 2 == k).write.parquet(f"{path}/{k}")
    return R.multi_file(spark, [f"{path}/0", f"{path}/1"], _scaled_time, "event_id long, ts timestamp_ntz, value double", gain=2.0).select("event_id", "time", "value")


def _above_own_minimum(df, gain=1.0):
    """Values as distance from the least one of their own file."""
    return df.join(F.broadcast(df.agg(F.min("value").alias("least")))).withColumn("value", (F.col("value") - F.col("least")) * gain).drop("least")


@query("SRC9_nested_files", "SELECT event_type AS band, CAST(user_id % 2 AS INT) AS half, event_id, round((value - min(value) OVER (PARTITION BY event_type, user_id % 2)) * 3.0, 6) AS value FROM events")
def src9_nested(spark, sf_dir):
    path = scratch(spark, "nested")
    given = table(spark, sf_dir, "events").select("event_id", "value", "event_type", (F.col("user_id") % 2).cast("int").alias("half"))
    write_folders(given, path, ["event_type", "half"])
    bands = [r[0] for r in given.select("event_type").distinct().orderBy("event_type").collect()]
    files = {b: {h: f"{path}/event_type={b}/half={h}" for h in (0, 1)} for b in bands}
    return R.nested_files(spark, files, _above_own_minimum, "band", "half", "event_id long, value double", gain=3.0).withColumn("value", F.round("value", 6))


@query("SRC10_file_discovery", "SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS day FROM events")
def src10(spark, sf_dir):
    path = scratch(spark, "found")
    write_folders(table(spark, sf_dir, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("day")), path, ["day"])
    return R.discovered(spark, path, "*.parquet").select(F.regexp_extract("path", "day=([0-9-]+)", 1).alias("day")).distinct()


@query("SRC11_grouped_read", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity AS precipitation, l_tax AS random_error FROM lineitem")
def src11(spark, sf_dir):
    path = scratch(spark, "grouped")
    table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.struct(F.col("l_quantity").alias("precipitation"), F.col("l_tax").alias("random_error")).alias("Grid")).write.parquet(path)
    return R.flattened(spark.read.schema("l_orderkey long, l_linenumber int, l_partkey long, Grid struct<precipitation double, random_error double>").parquet(path), "Grid")


@query("SRC12_read_committed", "SELECT event_id, event_type, value FROM events WHERE event_type NOT IN ('purchase', 'error')")
def src12(spark, sf_dir):
    given = table(spark, sf_dir, "events").select("event_id", "event_type", "value", F.to_date("ts").alias("day"))
    path = scratch(spark, "committed")
    store = Store(spark, path, ["day"]).create(given.where("event_type = 'error'"))
    store.append_products(given.where("event_type = 'click'"), "event_type", 1).append_products(given.where("event_type not in ('click', 'purchase', 'error')"), "event_type", 2)
    interrupted(store, given.where("event_type = 'purchase'"), "event_type", 3)
    store = Store.open(spark, path)
    return store.committed("event_type").select("event_id", "event_type", "value")


@query("SRC13_navigation_scan", "SELECT n_nationkey, n_nationkey * 2.5 AS latitude, count(c_custkey) AS n FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_nationkey")
def src13(spark, sf_dir):
    navigation = table(spark, sf_dir, "nation").select("n_nationkey", (F.col("n_nationkey") * F.lit(2.5)).alias("latitude"))
    counted = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("n"))
    return J.filled(navigation, counted, ["n_nationkey"], {"n": 0})


@query("SRC14_merge_products", "SELECT a.l_orderkey, a.ghi, b.wind FROM (SELECT l_orderkey, sum(l_quantity) AS ghi FROM lineitem GROUP BY 1) a JOIN (SELECT l_orderkey, max(l_extendedprice) AS wind FROM lineitem WHERE l_linenumber > 2 GROUP BY 1) b USING (l_orderkey)")
def src14(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    irradiance = lines.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("ghi"))
    ancillary = lines.where("l_linenumber > 2").groupBy("l_orderkey").agg(F.max("l_extendedprice").alias("wind"))
    return J.families(irradiance, ancillary, ["l_orderkey"], "inner")


@query("SRC15_month_window", "SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n, 'found' AS status FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1997-11-01' AND TIMESTAMP '1998-03-31' AND month(o_orderdate) <> 1 GROUP BY 1 UNION ALL SELECT '1998-01', 0, 'missing' WHERE EXISTS (SELECT 1 FROM orders)")
def src15(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").where(F.month("o_orderdate") != 1).select(F.trunc("o_orderdate", "month").alias("month"), "o_orderkey")
    ends = table(spark, sf_dir, "orders").limit(1).select(F.lit("1997-11-15").cast("date").alias("a"), F.lit("1998-03-10").cast("date").alias("b"))
    found, missing = R.month_window(R.months(ends, F.col("a"), F.col("b")), orders)
    counted = found.groupBy("month").agg(F.count("*").alias("n")).withColumn("status", F.lit("found"))
    return counted.unionByName(missing.select("month", F.lit(0).cast("long").alias("n"), F.lit("missing").alias("status"))).withColumn("month", F.date_format("month", "yyyy-MM"))


@query("SRC16_variable_subset", "SELECT l_orderkey, l_linenumber, l_quantity, l_tax FROM lineitem")
def src16(spark, sf_dir):
    return S.kept(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber", "l_quantity", "l_tax"])


@query("SNK1_create_store", "SELECT event_id, ts, event_type, value, strftime(ts, '%Y-%m-%d') AS day FROM events")
def snk1(spark, sf_dir):
    return Store(spark, scratch(spark, "created"), ["day"]).create(daily(spark, sf_dir)).read().withColumn("day", F.col("day").cast("string"))


@query("SNK2_append_time", "SELECT event_id, ts, value FROM events")
def snk2(spark, sf_dir):
    given = daily(spark, sf_dir)
    store = Store(spark, scratch(spark, "appended"), ["day"]).create(given.where("event_id % 2 = 0"))
    return store.append(given.where("event_id % 2 = 1")).read().select("event_id", "ts", "value")


@query("SNK3_region_write", "SELECT event_id, CASE WHEN ts::DATE = DATE '2024-01-05' THEN value + 1000 ELSE value END AS value FROM events WHERE ts::DATE <> DATE '2024-01-05' OR event_id % 2 = 0")
def snk3(spark, sf_dir):
    given = daily(spark, sf_dir)
    store = Store(spark, scratch(spark, "region"), ["day"]).create(given)
    new = given.where("day = '2024-01-05' and event_id % 2 = 0").withColumn("value", F.col("value") + 1000)
    return store.write_regions(new).write_regions(new).read().select("event_id", "value")


@query("SNK4_region_by_axis", "SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1997 THEN -o_totalprice ELSE o_totalprice END AS value FROM orders WHERE year(o_orderdate) <= 1999")
def snk4(spark, sf_dir):
    given = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").alias("value"), F.year("o_orderdate").alias("year"))
    store = Store(spark, scratch(spark, "axis"), ["year"]).create(given.where("year <= 1999"))
    batch = given.where("year in (1997, 2000)").withColumn("value", -F.col("value"))
    return store.write_known_regions(batch, store.read().select("year").distinct(), "year").read().select("o_orderkey", "value")


@query("SNK5_upsert", "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN value + 1000 ELSE value END AS value FROM events WHERE event_id % 2 = 0 OR event_id % 3 = 0")
def snk5(spark, sf_dir):
    given = daily(spark, sf_dir)
    store = Store(spark, scratch(spark, "upsert"), ["day"]).create(given.where("event_id % 2 = 0"))
    new = given.where("event_id % 3 = 0").withColumn("value", F.col("value") + 1000)
    return store.upsert(new, ["event_id", "day"]).upsert(new, ["event_id", "day"]).read().select("event_id", "value")


@query("SNK8_schema_guard", "SELECT l_orderkey, l_quantity, -1 AS l_linenumber FROM lineitem WHERE l_linenumber = 1 UNION ALL SELECT l_orderkey, l_quantity, l_linenumber FROM lineitem WHERE l_linenumber > 1")
def snk8(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_linenumber", "l_returnflag")
    store = Store(spark, scratch(spark, "guarded"), ["l_returnflag"]).create(lines.where("l_linenumber > 1"))
    try:
        store.append(lines.withColumn("unknown", F.lit(1)))
    except ValueError:
        store.append(lines.where("l_linenumber = 1").withColumn("l_linenumber", F.lit(None).cast("int")))
    return store.read().select("l_orderkey", "l_quantity", V.null_to_fill(F.col("l_linenumber"), -1).alias("l_linenumber"))


@query("SNK9_batch_guard", "SELECT o_orderkey, year(o_orderdate)::INT AS year FROM orders WHERE year(o_orderdate) IN (1995, 1996, 1998)")
def snk9(spark, sf_dir):
    given = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", F.year("o_orderdate").alias("year"))
    store = Store(spark, scratch(spark, "batches"), ["year"]).create(given.where("year in (1995, 1996)"))
    store.append_new_batch(given.where("year in (1996, 1997)"), "o_orderdate")
    store.append_new_batch(given.where("year = 1998"), "o_orderdate")
    return store.read().select("o_orderkey", "year")


@query("SNK11_product_ledger", "SELECT user_id, count(*) AS n FROM events WHERE user_id % 4 <> 3 GROUP BY 1")
def snk11(spark, sf_dir):
    given = table(spark, sf_dir, "events").select("event_id", F.col("user_id").cast("string").alias("product"), "user_id", F.to_date("ts").alias("day"))
    store = Store(spark, scratch(spark, "ledger"), ["day"]).create(given.where("user_id < 0"))
    store.append_products(given.where("user_id % 2 = 0"), "product", 1)
    interrupted(store, given.where("user_id % 4 < 3"), "product", 2)
    store.append_products(given.where("user_id % 4 < 3"), "product", 2).append_products(given, "product", 2)
    return store.committed("product").groupBy("user_id").agg(F.count("*").alias("n"))


@query("SNK12_csv_of_month", "SELECT event_id, value, strftime(ts, '%Y-%m') AS month FROM events")
def snk12(spark, sf_dir):
    path = export_csv(table(spark, sf_dir, "events").select("event_id", "value", F.date_format("ts", "yyyy-MM").alias("month")), scratch(spark, "csv"), ["month"])
    return R.csv_series(spark, path, "event_id long, value double, month string")


@query("SNK13_text_of_urls", "SELECT url AS station FROM pages")
def snk13(spark, sf_dir):
    return R.names_list(spark, export_text(table(spark, sf_dir, "pages"), F.col("url"), scratch(spark, "urls")))


@query("SNK14_station_blocks", "SELECT user_id // 50 AS block, count(*) AS n, count(DISTINCT user_id) AS stations FROM events GROUP BY 1")
def snk14(spark, sf_dir):
    path = export_blocks(table(spark, sf_dir, "events").select("event_id", "user_id", "ts"), "user_id", F.floor(F.col("user_id") / 50).cast("long"), scratch(spark, "blocks"))
    read = spark.read.schema("event_id long, user_id long, ts timestamp_ntz, block long").parquet(path)
    return read.groupBy("block").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("stations"))


@query("SNK16_reference_index", "SELECT event_id, 'goes16/' || strftime(ts, '%Y/%j/%H') || '/' || event_id AS path, event_type AS band, strftime(ts, '%Y%m%d%H') AS hour FROM events")
def snk16(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    manifest = events.select("event_id", F.concat(T.day_path(F.col("ts"), "goes16"), F.lit("/"), F.col("event_id").cast("string")).alias("path"), F.col("event_type").alias("band"), F.date_format("ts", "yyyyMMddHH").alias("hour"))
    store = Store(spark, scratch(spark, "index"), ["band"]).create(manifest)
    return store.read()


SCENES = "SELECT 'sat' || (user_id % 3) AS satellite, event_type AS band, ts AS time, 's/' || event_id AS path FROM events"
ASKED = "SELECT 'sat' || (user_id % 3) AS satellite, event_type AS band, date_trunc('hour', ts)::TIMESTAMP + INTERVAL 30 MINUTE AS time FROM events WHERE day(ts) IN (3, 4) GROUP BY ALL"


def scenes_of(events):
    return events.select(F.concat(F.lit("sat"), (F.col("user_id") % 3).cast("string")).alias("satellite"), F.col("event_type").alias("band"), F.col("ts").alias("time"), F.concat(F.lit("s/"), F.col("event_id").cast("string")).alias("path"))


@query("SNK16_pruned_manifest", f"""
SELECT a.satellite, a.band, a.time, arg_min(s.time, (abs(epoch_us(s.time) - epoch_us(a.time)), s.time, s.path)) AS scene_time, arg_min(s.path, (abs(epoch_us(s.time) - epoch_us(a.time)), s.time, s.path)) AS path
FROM ({ASKED}) a LEFT JOIN ({SCENES}) s ON s.satellite = a.satellite AND s.band = a.band AND abs(epoch_us(s.time) - epoch_us(a.time)) <= 1800000000 GROUP BY 1, 2, 3
""")
def snk16_pruned(spark, sf_dir):
    scenes = scenes_of(table(spark, sf_dir, "events"))
    manifest = M.Manifest.write(spark, scratch(spark, "manifest"), scenes, "day")
    asked = scenes.where("day(time) in (3, 4)").select("satellite", "band", (F.date_trunc("hour", "time").cast("timestamp_ntz") + F.expr("INTERVAL 30 MINUTES")).alias("time")).distinct()
    return manifest.found(asked, 1800)


#: Rows that are damaged when they are written, as text.
DAMAGED = "event_id % 211 = 3"


def damaged_csv(spark, sf_dir):
    """events as CSV by day, some values unreadable and some rows short."""
    value = F.when(F.expr(f"{DAMAGED} and event_id % 2 = 0"), F.lit("n/a?")).otherwise(F.col("value").cast("string"))
    tail = F.when(F.expr(f"{DAMAGED} and event_id % 2 = 1"), F.lit("")).otherwise(F.concat(F.lit(","), F.coalesce(value, F.lit(""))))
    line = F.concat(F.col("event_id").cast("string"), F.lit(","), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), tail)
    path = scratch(spark, "damaged")
    table(spark, sf_dir, "events").select(line.alias("value"), F.date_format("ts", "yyyy-MM-dd").alias("day")).write.option("compression", "gzip").partitionBy("day").text(path)
    return X.csv_rows(spark, path, "event_id long, ts timestamp_ntz, value double", header=False)


@query("SRC4_damage_by_day", f"SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) FILTER (NOT ({DAMAGED})) AS good, count(*) FILTER ({DAMAGED}) AS damaged FROM events GROUP BY 1")
def src4_damage(spark, sf_dir):
    rows = damaged_csv(spark, sf_dir).withColumn("day", F.col("day").cast("string"))
    return X.damage(rows, ["day"]).drop("example")


@query("SRC4_sound_rows", f"SELECT event_id, ts, value FROM events WHERE NOT ({DAMAGED})")
def src4_sound(spark, sf_dir):
    return X.sound_rows(damaged_csv(spark, sf_dir)).select("event_id", "ts", "value")


@query("FLT16_runs_without_damage", f"SELECT event_id, value FROM events WHERE strftime(ts, '%Y-%m-%d') NOT IN (SELECT strftime(ts, '%Y-%m-%d') FROM events WHERE {DAMAGED})")
def flt16_runs(spark, sf_dir):
    return X.sound_groups(damaged_csv(spark, sf_dir), ["day"]).select("event_id", "value")


@query("SRC7_damaged_inventory", "SELECT c_custkey % 5 = 0 AS bad, count(*) AS n FROM customer GROUP BY 1")
def src7_damage(spark, sf_dir):
    start = F.format_string('{"id": "%d", "inventory": {"hourly": {"start": "2020-01-01", "end": "2024-01-01"}}}', F.col("c_custkey"))
    line = F.when(F.col("c_custkey") % 5 == 0, F.concat(F.lit('{"id": '), F.col("c_custkey").cast("string"))).otherwise(start)
    path = export_text(table(spark, sf_dir, "customer"), line, scratch(spark, "inventory"))
    rows = X.json_rows(spark, path, "id string, inventory struct<hourly struct<start string, end string>>")
    return rows.groupBy(F.col("error").isNotNull().alias("bad")).agg(F.count("*").alias("n"))


@query("FLT16_decoder_failures", "SELECT vec_id, CAST(len(embedding) AS BIGINT) AS n FROM embeddings WHERE label NOT IN (SELECT label FROM embeddings WHERE vec_id % 251 = 5)")
def flt16_decoder(spark, sf_dir):
    """A decoder that fails on one file of a run: the whole run of that label goes, other runs stay."""

    def decode(content: bytes) -> pd.DataFrame:
        if len(content) % 4:
            raise ValueError("not whole numbers")
        return pd.DataFrame({"n": [len(content) // 4]})

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            held = [np.asarray(v, "<f4").tobytes() + b"x" * (i % 251 == 5) for i, v in zip(batch["vec_id"], batch["embedding"])]
            yield pd.DataFrame({"path": [f"{a}/{i}" for a, i in zip(batch["label"], batch["vec_id"])], "content": held})

    files = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label").mapInPandas(encode, "path string, content binary")
    run, number = F.split("file", "/")[0], F.split("file", "/")[1].cast("long")
    rows = R.decoded(files, decode, "n long").select(number.alias("vec_id"), run.alias("run"), "n", "error")
    return X.sound_groups(rows, ["run"]).select("vec_id", "n")


@query("AGG3_report_while_writing", "SELECT event_type AS run, CAST(coalesce(sum(user_id) FILTER (event_id % 7 <> 0), 0) AS BIGINT) AS bytes, count(*) FILTER (event_id % 7 <> 0) AS succeeded, count(*) FILTER (event_id % 7 = 0) AS failed FROM events GROUP BY 1")
def agg3_observed(spark, sf_dir):
    given = daily(spark, sf_dir).join(table(spark, sf_dir, "events").select("event_id", "user_id"), "event_id")
    runs = [r[0] for r in given.select("event_type").distinct().collect()]
    store = Store(spark, scratch(spark, "observed"), ["day"])
    return P.reported_write(given, store.create, runs, "event_type", F.col("user_id"), F.col("event_id") % 7 != 0)


@query("SNK11_many_batches", "SELECT CAST(user_id AS VARCHAR) AS product, count(*) AS n FROM events GROUP BY 1")
def snk11_batches(spark, sf_dir):
    """Names come again in later batches and are skipped; the ledger is compacted on the way."""
    given = table(spark, sf_dir, "events").select("event_id", F.col("user_id").cast("string").alias("product"), F.to_date("ts").alias("day"))
    store = Store(spark, scratch(spark, "batched"), ["day"]).create(given.limit(0))
    store.append_products(given.where("crc32(product) % 3 = 0"), "product", 1).append_products(given.where("crc32(product) % 3 < 2"), "product", 2)
    store.ledger.compact()
    store.append_products(given, "product", 3).append_products(given, "product", 4)
    return store.committed("product").groupBy("product").agg(F.count("*").alias("n"))


@query("UDF1_preprocess_hook", "SELECT event_id, ts AS time, value * 3.0 AS value FROM events")
def udf1(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "ts", "value").transform(_scaled_time, gain=3.0)


@query("UDF2_worker_over_files", "SELECT vec_id, CAST(len(embedding) AS BIGINT) AS n, embedding[1] AS first FROM embeddings")
def udf2(spark, sf_dir):
    def decode(content: bytes) -> pd.DataFrame:
        values = np.frombuffer(content[8:], "<f4")
        return pd.DataFrame({"vec_id": [int.from_bytes(content[:8], "little")], "n": [len(values)], "first": values[:1]})

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"path": batch["vec_id"].astype(str), "content": [int(i).to_bytes(8, "little") + np.asarray(v, "<f4").tobytes() for i, v in zip(batch["vec_id"], batch["embedding"])]})

    files = table(spark, sf_dir, "embeddings").select("vec_id", "embedding").mapInPandas(encode, "path string, content binary")
    return R.decoded(files, decode, "vec_id long, n long, first float").where("error is null").select("vec_id", "n", "first")


@query("PIP4_rain_rate_pipeline", "SELECT n_nationkey, date_trunc('day', ts)::TIMESTAMP AS day, count(rate) AS n, round(max(rate), 6) AS rate FROM (SELECT user_id % 25 AS k, ts, CASE WHEN event_id % 11 <> 0 THEN value * 0.1 END AS rate FROM events) JOIN nation ON k = n_nationkey GROUP BY 1, 2")
def pip4(spark, sf_dir):
    raw = table(spark, sf_dir, "events").select((F.col("user_id") % 25).cast("int").alias("n_nationkey"), F.concat(F.lit("NPR.GEO.GHE.v1.S"), F.date_format("ts", "yyyyMMddHHmm"), F.lit(".nc.gz")).alias("name"), F.when(F.col("event_id") % 11 == 0, -1.0).otherwise(F.col("value")).alias("raw"))
    cells = raw.select("n_nationkey", T.time_from_name(F.col("name"), "rain_rate").alias("time"), V.scaled(V.fill_to_null(F.col("raw"), -1.0), 0.1).alias("rate"))
    located = J.navigated(cells, table(spark, sf_dir, "nation").select("n_nationkey"), ["n_nationkey"]).withColumn("day", F.date_trunc("day", "time").cast("timestamp_ntz"))
    store = Store(spark, scratch(spark, "rain"), ["day"]).create(located.select("n_nationkey", "rate", "day"))
    return store.read().groupBy("n_nationkey", "day").agg(F.count("rate").alias("n"), F.round(F.max("rate"), 6).alias("rate"))


@query("PIP15_ocean_platforms", "WITH d AS (SELECT user_id, date_trunc('hour', ts)::TIMESTAMP AS time, min(value) AS value FROM events WHERE ts >= TIMESTAMP '2024-01-20' GROUP BY 1, 2) SELECT k.user_id, count(*) AS times, count(d.value) AS filled FROM (SELECT DISTINCT user_id FROM d) k CROSS JOIN (SELECT DISTINCT time FROM d) t LEFT JOIN d ON d.user_id = k.user_id AND d.time = t.time GROUP BY 1")
def pip15(spark, sf_dir):
    recent = L.since(table(spark, sf_dir, "events"), "ts", "2024-01-20").select("user_id", T.ntz(F.date_trunc("hour", "ts")).alias("time"), "value")
    single = C.first_rows(recent, ["user_id", "time"], ["value"])
    return J.aligned(single, "user_id", "time", ["value"]).groupBy("user_id").agg(F.count("*").alias("times"), F.count("value").alias("filled"))
