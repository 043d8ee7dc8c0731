"""Queries of projections, positional selection and layouts: PRJ, SEL, SNK17, SNK18, FN28, FN29, AGG6, AGG7."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoframe.catalog import query, table
from geoframe.functions import times as T
from geoframe.functions import values as V
from geoframe.operators import chunk as K
from geoframe.operators import shape as S

LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
LINES = ", ".join(LINE)


@query("PRJ1_canonical_coordinates", "SELECT l_orderkey AS scene, l_linenumber AS level, l_shipdate AS time, l_quantity AS value FROM lineitem")
def prj1(spark, sf_dir):
    names = {"l_orderkey": "scene", "l_linenumber": "level", "l_shipdate": "time", "l_quantity": "value", "lat": "latitude"}
    return S.renamed(table(spark, sf_dir, "lineitem"), names).select("scene", "level", "time", "value")


@query("PRJ2_variable_names", "SELECT l_orderkey AS station, l_quantity AS temperature, l_extendedprice AS geopotential_height, l_discount AS relative_humidity, l_tax AS wind_speed FROM lineitem")
def prj2(spark, sf_dir):
    names = {"l_orderkey": "station", "l_quantity": "temperature", "l_extendedprice": "geopotential_height", "l_discount": "relative_humidity", "l_tax": "wind_speed"}
    return S.renamed(table(spark, sf_dir, "lineitem"), names).select(*names.values())


@query("PRJ3_single_variable", "SELECT event_id, ts, value AS rainfall FROM events")
def prj3(spark, sf_dir):
    return S.single_variable(table(spark, sf_dir, "events").select("event_id", "ts", "value"), ["event_id", "ts"], "rainfall")


@query("PRJ4_height_suffix", "SELECT l_orderkey, " + ", ".join(f"max(l_quantity) FILTER (l_linenumber = {h}) AS temp_{h}" for h in range(1, 8)) + " FROM lineitem GROUP BY l_orderkey")
def prj4(spark, sf_dir):
    highest = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("value"))
    return S.height_suffixed(highest, ["l_orderkey"], "temp", "l_linenumber", list(range(1, 8)))


@query("PRJ5_keep_list", f"SELECT {LINES}, l_quantity, l_tax FROM lineitem")
def prj5(spark, sf_dir):
    return S.kept(table(spark, sf_dir, "lineitem"), [*LINE, "l_quantity", "l_tax", "not_there"])


@query("PRJ6_drop_if_present", f"SELECT {LINES}, l_quantity, l_shipdate FROM lineitem")
def prj6(spark, sf_dir):
    return S.without(table(spark, sf_dir, "lineitem"), "flag", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")


@query("PRJ7_drop_auxiliary_coordinates", f"SELECT {LINES}, l_shipdate AS time, l_quantity FROM lineitem")
def prj7(spark, sf_dir):
    return S.without_auxiliary(table(spark, sf_dir, "lineitem").withColumnRenamed("l_shipdate", "time"), LINE, ["l_quantity"])


@query("PRJ8_drop_carried_dimensions", "SELECT vec_id, label FROM embeddings")
def prj8(spark, sf_dir):
    return S.without_arrays(table(spark, sf_dir, "embeddings"))


@query("PRJ9_attributes_to_columns", "SELECT event_id, json_extract_string(props, '$.k') AS satellite_k, 1 AS n_kept FROM events")
def prj9(spark, sf_dir):
    number = F.get_json_object("props", "$.k")
    given = table(spark, sf_dir, "events").select("event_id", F.create_map(F.lit("satellite_k"), number, F.lit("satellite_id"), F.lit("x"), F.lit("k"), number).alias("attributes"))
    found = given.select("event_id", V.matching_attributes(F.col("attributes"), "satellite", "satellite_id").alias("a"))
    return found.select("event_id", F.col("a")["satellite_k"].alias("satellite_k"), F.size("a").alias("n_kept"))


@query("PRJ10_scalar_coordinates", "SELECT event_id, value, 'station-' || user_id AS station, TIMESTAMP '2024-01-01' AS init_time FROM events")
def prj10(spark, sf_dir):
    given = table(spark, sf_dir, "events").select("event_id", "value", "user_id")
    return S.with_constants(given, station=F.concat(F.lit("station-"), F.col("user_id").cast("string")), init_time=F.lit("2024-01-01").cast("timestamp_ntz")).drop("user_id")


@query("PRJ11_scene_constants", "SELECT event_id, ts AS start_time, ts + to_seconds(570) AS end_time, 'goes-' || user_id AS platform_name, substr(props, 1, 16) AS orbital_parameters FROM events")
def prj11(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("start_time"), (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(570))).alias("end_time"), F.concat(F.lit("goes-"), F.col("user_id").cast("string")).alias("platform_name"), V.fixed_width(F.col("props"), 16).alias("orbital_parameters"))


@query("PRJ12_first_coordinate_of_station", "SELECT user_id, arg_min(value, ts) AS latitude, arg_min(event_type, ts) AS kind FROM events GROUP BY user_id")
def prj12(spark, sf_dir):
    return S.first_per_key(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], ["value", "event_type"]).select("user_id", F.col("value").alias("latitude"), F.col("event_type").alias("kind"))


@query("PRJ13_axis_order", "SELECT vec_id, embedding[1] AS first, embedding[9] AS second, embedding[2] AS ninth, embedding[64] AS last FROM embeddings")
def prj13(spark, sf_dir):
    turned = table(spark, sf_dir, "embeddings").select("vec_id", S.transposed(F.col("embedding"), 8, 8).alias("t"))
    return turned.select("vec_id", *(F.get("t", F.lit(k)).alias(n) for n, k in (("first", 0), ("second", 1), ("ninth", 8), ("last", 63))))


@query("PRJ14_axes_in_scene", "SELECT vec_id, -28.0 AS x_first, 28.0 AS x_last, 8 AS n FROM embeddings")
def prj14(spark, sf_dir):
    axis = table(spark, sf_dir, "embeddings").select("vec_id", V.regular_axis(-28, 28, 8).alias("x"))
    return axis.select("vec_id", F.get("x", F.lit(0)).alias("x_first"), F.element_at("x", -1).alias("x_last"), F.size("x").alias("n"))


@query("PRJ16_dimension_by_size", "SELECT vec_id, CASE WHEN len(embedding) - vec_id % 3 = 64 THEN 'time' WHEN vec_id % 3 = 1 THEN 'latitude_longitude' ELSE 'index' END AS role FROM embeddings")
def prj16(spark, sf_dir):
    axis = F.when(F.col("vec_id") % 3 == 0, F.col("embedding")).otherwise(F.slice("embedding", 1, F.when(F.col("vec_id") % 3 == 1, F.lit(2)).otherwise(F.lit(5))))
    return table(spark, sf_dir, "embeddings").select("vec_id", S.axis_role(axis, 64).alias("role"))


@query("PRJ17_swap_time_index", "SELECT event_id, date_trunc('second', ts) AS time, value FROM events")
def prj17(spark, sf_dir):
    given = table(spark, sf_dir, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("time_index"), "value")
    return given.select("event_id", T.iso_time(F.col("time_index")).alias("time"), "value")


@query("SEL1_first_level", f"SELECT {LINES}, l_quantity FROM lineitem WHERE l_linenumber = 1".replace("l_linenumber, ", ""))
def sel1(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").where("l_linenumber = 1").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")


@query("SEL2_by_label", "SELECT vec_id, embedding[1] AS first FROM embeddings WHERE label = 1")
def sel2(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").where("label = 1").select("vec_id", F.get("embedding", F.lit(0)).alias("first"))


@query("SEL3_blocks_of_1000", "SELECT event_id, (row_number() OVER (ORDER BY ts, event_id) - 1) // 1000 AS block FROM events")
def sel3(spark, sf_dir):
    return S.blocks(table(spark, sf_dir, "events").select("event_id", "ts"), ["ts", "event_id"], 1000).select("event_id", "block")


@query("SEL4_tile_rings", "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN t <= 5 THEN 'top2' WHEN t <= 13 THEN 'top' WHEN t <= 73 THEN 'centre' WHEN t <= 81 THEN 'bottom' ELSE 'bottom2' END AS ring FROM (SELECT *, l_partkey % 88 AS t FROM lineitem)")
def sel4(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", S.ring(F.col("l_partkey") % 88).alias("ring"))


@query("SEL5_truncate_to_multiple", "SELECT event_id FROM (SELECT event_id, row_number() OVER (ORDER BY event_id) AS r, count(*) OVER () AS n FROM events) WHERE r <= n // 900 * 900")
def sel5(spark, sf_dir):
    return S.truncated(table(spark, sf_dir, "events").select("event_id"), ["event_id"], 900).select("event_id")


@query("SEL6_first_files_of_day", "SELECT day, event_id, r AS rank FROM (SELECT date_trunc('day', ts)::TIMESTAMP AS day, event_id, row_number() OVER (PARTITION BY date_trunc('day', ts) ORDER BY ts, event_id)::INT AS r FROM events) WHERE r <= 10")
def sel6(spark, sf_dir):
    given = table(spark, sf_dir, "events").select(T.ntz(F.date_trunc("day", "ts")).alias("day"), "event_id", "ts")
    return S.first_of_group(given, ["day"], ["ts", "event_id"], 10).select("day", "event_id", "rank")


@query("SEL7_backfill_cursor", "SELECT day FROM (SELECT DISTINCT date_trunc('day', ts)::TIMESTAMP AS day FROM events) WHERE day <= (SELECT min(ts) FROM events WHERE event_id % 10 > 4 AND ts >= (SELECT max(ts) FROM events) - to_days(9))")
def sel7(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    days = events.select(T.ntz(F.date_trunc("day", "ts")).alias("day")).distinct()
    last = events.agg((F.max("ts") - F.make_dt_interval(F.lit(9))).alias("from"))
    cursor = events.where("event_id % 10 > 4").join(F.broadcast(last), F.col("ts") >= F.col("from")).agg(F.min("ts").alias("cursor"))
    return days.join(F.broadcast(cursor), F.col("day") <= F.col("cursor")).select("day")


@query("SNK17_cells_to_chunks", "SELECT l_orderkey // 8 AS chunk, count(*) AS n, sum(l_quantity) AS total, min(l_orderkey) AS first FROM lineitem GROUP BY 1")
def snk17(spark, sf_dir):
    made = S.chunks(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity"), "l_orderkey", 8, ["l_quantity"])
    total = F.aggregate("rows", F.lit(0.0), lambda a, r: a + r["l_quantity"])
    return made.select("chunk", F.size("rows").cast("long").alias("n"), total.alias("total"), F.col("rows")[0]["l_orderkey"].alias("first"))


@query("SNK18_chunks_to_cells", "SELECT vec_id, CAST((k - 1) // 8 AS INT) AS y, CAST((k - 1) % 8 AS INT) AS x, embedding[k] AS value FROM embeddings, range(1, 65) t(k)")
def snk18(spark, sf_dir):
    return S.cells(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "embedding", 8)


@query("SNK17_SNK18_round_trip", "SELECT vec_id, len(embedding) AS n, embedding[1] AS first, embedding[20] AS middle, embedding[64] AS last FROM embeddings")
def snk17_18(spark, sf_dir):
    back = S.scenes(S.cells(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "embedding", 8), ["vec_id"])
    return back.select("vec_id", F.size("payload").cast("long").alias("n"), *(F.get("payload", F.lit(k)).alias(n) for n, k in (("first", 0), ("middle", 19), ("last", 63))))


@query("FN28_pad_series", "WITH n AS (SELECT count(*) AS n FROM events) SELECT is_pad, platform, count(*) AS n FROM (SELECT false AS is_pad, event_type AS platform FROM events UNION ALL SELECT true, 'Metop-Z' FROM range(9180) t(k), n WHERE k < (9180 - n % 9180) % 9180) GROUP BY ALL")
def fn28(spark, sf_dir):
    given = table(spark, sf_dir, "events").select("event_id", "ts", F.col("event_type").alias("platform"), "value")
    return S.padded(given, ["event_id"], 9180, {"platform": "Metop-Z", "ts": "2000-01-01 00:00:00", "event_id": -1}).groupBy("is_pad", "platform").agg(F.count("*").alias("n"))


@query("FN29_pad_scene", "SELECT vec_id, embedding[1] AS first, embedding[9] AS row_two, CAST(NULL AS FLOAT) AS ninth, 120 AS n, 56 AS n_null FROM embeddings")
def fn29(spark, sf_dir):
    wide = table(spark, sf_dir, "embeddings").select("vec_id", S.padded_scene(F.col("embedding"), 8, 8, 12, 10).alias("p"))
    return wide.select("vec_id", F.get("p", F.lit(0)).alias("first"), F.get("p", F.lit(10)).alias("row_two"), F.get("p", F.lit(8)).alias("ninth"), F.size("p").alias("n"), F.size(F.filter("p", lambda v: v.isNull())).alias("n_null"))


@query("AGG6_scene_extent", "SELECT vec_id, round(-1.0 * 35.8, 6) AS low, round(1.0 * 35.8, 6) AS high FROM embeddings")
def agg6(spark, sf_dir):
    axis = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(V.regular_axis(-0.875, 0.875, 0.25)).alias("i", "x"))
    return S.extent(axis, ["vec_id"], "x", "i", 35.8)


@query("AGG7_bounding_box", "SELECT c_nationkey, min(c_acctbal / 100) AS west, min(c_acctbal / 200) AS south, max(c_acctbal / 100) AS east, max(c_acctbal / 200) AS north FROM customer GROUP BY 1")
def agg7(spark, sf_dir):
    cells = table(spark, sf_dir, "customer").select("c_nationkey", (F.col("c_acctbal") / 100).alias("longitude"), (F.col("c_acctbal") / 200).alias("latitude"))
    return S.bounding_box(cells, ["c_nationkey"], "latitude", "longitude")


def _digest(chunks, grid, value, keys=()):
    """Blocks and, in row-major order, cells, nulls and their weighted sum."""
    weighted = F.aggregate(F.transform(value, lambda v, k: F.coalesce(v.cast("double"), F.lit(0.0)) * (k + 1)), F.lit(0.0), lambda a, v: a + v)
    return chunks.select(*keys, *grid.blocks, F.size(value).cast("long").alias("n"), F.size(F.filter(value, lambda v: v.isNull())).cast("long").alias("n_null"), F.round(weighted, 3).alias("weighted"))


@query("SNK17_sample_major_to_value_major", """
WITH n AS (SELECT max(vec_id) + 1 AS n FROM embeddings),
grid AS (SELECT s.s AS sample, k, s // 100 AS bs, k // 24 AS bk FROM (SELECT unnest(range((SELECT n FROM n))) AS s) s, range(64) t(k)),
cells AS (SELECT bs, bk, (sample - bs * 100) * least(24, 64 - bk * 24) + k - bk * 24 AS pos, embedding[k + 1]::DOUBLE AS v FROM grid LEFT JOIN embeddings ON vec_id = sample)
SELECT CAST(bs AS INT) AS block_sample, CAST(bk AS INT) AS block_value, count(*) AS n, count(*) FILTER (v IS NULL) AS n_null, round(sum(coalesce(v, 0) * (pos + 1)), 3) AS weighted FROM cells GROUP BY 1, 2
""")
def snk17_axes(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    samples = vectors.agg(F.max("vec_id") + 1).first()[0] or 1
    one = K.Grid({"sample": samples, "value": 64}, {"sample": 1, "value": -1})
    many = K.Grid({"sample": samples, "value": 64}, {"sample": 100, "value": 24})
    rows = vectors.select(F.col("vec_id").cast("int").alias("block_sample"), F.lit(0).alias("block_value"), F.col("embedding").alias("v"))
    return _digest(K.rechunked(rows, one, many, ["v"]), many, "v")


@query("SNK17_three_axes", """
WITH ends AS (SELECT date_trunc('day', min(ts)) AS a, date_diff('day', date_trunc('day', min(ts)), date_trunc('day', max(ts))) + 1 AS days FROM events),
cells AS (SELECT date_diff('day', a, date_trunc('day', ts)) AS day, hour(ts) AS hour, user_id % 10 AS band, sum(value) AS v FROM events, ends GROUP BY 1, 2, 3),
grid AS (SELECT d.d AS day, h.h AS hour, b.b AS band FROM (SELECT unnest(range((SELECT days FROM ends))) AS d) d, range(24) h(h), range(10) b(b)),
placed AS (SELECT day // 7 AS bd, hour // 24 AS bh, band // 4 AS bb, ((day % 7) * 24 + hour) * least(4, 10 - band // 4 * 4) + band % 4 AS pos, v FROM grid LEFT JOIN cells USING (day, hour, band))
SELECT CAST(bd AS INT) AS block_day, CAST(bh AS INT) AS block_hour, CAST(bb AS INT) AS block_band, count(*) AS n, count(*) FILTER (v IS NULL) AS n_null, round(sum(coalesce(v, 0) * (pos + 1)), 3) AS weighted FROM placed GROUP BY 1, 2, 3 HAVING count(v) > 0
""")
def snk17_three(spark, sf_dir):
    """Cells to chunks of an hour for all days and bands, those to weeks of all hours for four bands, which are short at the axes' ends."""
    events = table(spark, sf_dir, "events")
    first, last = events.agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    lengths = {"day": (last - first).days + 1 if first else 1, "hour": 24, "band": 10}
    cells = events.groupBy(F.date_diff(F.to_date("ts"), F.lit(first)).alias("day"), F.hour("ts").alias("hour"), (F.col("user_id") % 10).cast("int").alias("band")).agg(F.sum("value").alias("v"))
    hourly, weekly = K.Grid(lengths, {"day": -1, "hour": 1, "band": -1}), K.Grid(lengths, {"day": 7, "hour": -1, "band": 4})
    made = K.rechunked(K.to_chunks(cells, hourly, ["v"]), hourly, weekly, ["v"])
    return _digest(made.where(F.exists("v", lambda v: v.isNotNull())), weekly, "v")


@query("SNK18_three_axes_to_cells", "SELECT date_diff('day', (SELECT date_trunc('day', min(ts)) FROM events), date_trunc('day', ts))::INT AS day, hour(ts)::INT AS hour, (user_id % 10)::INT AS band, round(sum(value), 6) AS v, count(*) AS n FROM events GROUP BY 1, 2, 3")
def snk18_three(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    first, last = events.agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    grid = K.Grid({"day": (last - first).days + 1 if first else 1, "hour": 24, "band": 10}, {"day": 5, "hour": 7, "band": 3})
    cells = events.groupBy(F.date_diff(F.to_date("ts"), F.lit(first)).alias("day"), F.hour("ts").alias("hour"), (F.col("user_id") % 10).cast("int").alias("band")).agg(F.sum("value").alias("v"), F.count("*").alias("n"))
    return K.to_cells(K.to_chunks(cells, grid, ["v", "n"]), grid, ["v", "n"]).where("n is not null").withColumn("v", F.round("v", 6))
