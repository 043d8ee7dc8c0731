"""Positions over many partitions, interrupted batches, reopened stores, and values at the ends of their range."""

import copy

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoframe.functions import values as V
from geoframe.operators import join as J
from geoframe.operators import shape as S
from geoframe.operators.select import routes
from geoframe.sources.lookup import SceneSource
from geoframe.sources.store import Store, scratch


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_numbered_loses_no_row(spark, coalesce):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        given = spark.range(1_000_000).select(F.pmod(F.xxhash64("id"), F.lit(700_000)).alias("v"), "id", F.repeat(F.col("id").cast("string"), 6).alias("payload"))
        row = S.numbered(given, ["v", "id"]).agg(F.count("*"), F.count_distinct("position"), F.min("position"), F.max("position"), F.count_distinct("id")).first()
        assert tuple(row) == (1_000_000, 1_000_000, 0, 999_999, 1_000_000)
        placed = S.truncated(given.drop("payload"), ["v", "id"], 999)
        assert placed.count() == 1_000_000 // 999 * 999
        ordered = S.numbered(given.where("id < 3000"), ["v", "id"]).orderBy("position").select("v", "id").collect()
        assert ordered == sorted(ordered)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_store_survives_an_interrupted_batch_and_opens_again(spark):
    path = scratch(spark, "store")
    rows = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "product string, v int, part string")
    store = Store(spark, path, ["part"]).create(rows.limit(0))
    failing = copy.copy(store)
    failing._commit = None
    with pytest.raises(TypeError):
        failing.append_products(rows, "product", 1)
    assert store.read().count() == 0
    store.append_products(rows.where("v = 1"), "product", 1).append_products(rows.where("v = 1"), "product", 1)
    store = Store.open(spark, path)
    store.append_products(rows, "product", 2)
    assert sorted(map(tuple, store.read().collect())) == [("a", 1, "x"), ("b", 2, "y")] and store.read().schema == rows.schema
    with pytest.raises(ValueError, match="no regions"):
        store.write_regions(rows)


def test_upsert_refuses_keys_in_other_partitions(spark):
    store = Store(spark, scratch(spark, "moved"), ["part"]).create(spark.createDataFrame([(1, "x", 0), (2, "y", 0)], "k int, part string, v int"))
    with pytest.raises(ValueError, match="other partitions"):
        store.upsert(spark.createDataFrame([(1, "y", 5)], "k int, part string, v int"), ["k"])
    store.upsert(spark.createDataFrame([(1, "x", 5), (3, "y", 6)], "k int, part string, v int"), ["k"])
    assert sorted(map(tuple, store.read().collect())) == [(1, "x", 5), (2, "y", 0), (3, "y", 6)]


def test_repeated_requests_are_answered_each(spark):
    t = "TIMESTAMP_NTZ '2024-01-01 00:30:00'"
    asked = spark.sql(f"SELECT {t} AS time, 'a' AS channel UNION ALL SELECT {t}, 'a' UNION ALL SELECT {t}, 'b'")
    have = spark.sql("SELECT 'a' AS channel, TIMESTAMP_NTZ '2024-01-01 00:10:00' AS time, 'p' AS path")
    assert [r.path for r in J.nearest_in_hour(asked, have, ["channel"]).collect()] == ["p", "p"]


def test_extent_of_one_pixel(spark):
    got = S.extent(spark.createDataFrame([(1, 0, 5.0), (2, 0, 1.0), (2, 1, 3.0)], "k int, i int, x double"), ["k"], "x", "i").orderBy("k").collect()
    assert list(map(tuple, got)) == [(1, 5.0, 5.0), (2, 0.0, 4.0)]


def test_rounding_to_few_bits_of_all_values(spark):
    made = np.random.default_rng(1)
    given = [0.0, -0.0, 5e-324, 1e-310, 2.0**-24, 2.0**-25, 3 * 2.0**-26, 65519.99, 65520.0, -7e4, float("inf"), float("-inf"), float("nan"), *(2.0**k * (1 + d) for k in range(-30, 20) for d in (-2.0**-52, 0, 2.0**-52)), *(made.normal(size=500) * 10 ** made.uniform(-9, 6, 500))]
    rows = spark.createDataFrame([(k, float(x)) for k, x in enumerate(given)], "k int, x double").select("k", "x", V.to_half(F.col("x")).alias("half"), V.bit_rounded(F.col("x")).alias("kept")).orderBy("k").toPandas()
    with np.errstate(over="ignore"):
        want = np.array(given).astype(np.float16).astype(np.float32)
    assert np.array_equal(rows.half.to_numpy(np.float32), want, equal_nan=True)
    normal = np.isfinite(given)
    mantissa, exponent = np.frexp(np.array(given))
    rounded = np.ldexp(np.rint(np.ldexp(mantissa, 10)), exponent - 10)
    assert np.array_equal(rows.kept.to_numpy()[normal], rounded[normal])
    assert np.array_equal(rows.kept.to_numpy()[~normal], np.array(given)[~normal], equal_nan=True)


def test_routing_and_lookup(spark):
    times = spark.sql("SELECT explode(array(TIMESTAMP_NTZ '2015-07-06', TIMESTAMP_NTZ '2015-07-07', TIMESTAMP_NTZ '2022-12-13', TIMESTAMP_NTZ '2022-12-13 00:00:01')) AS time")
    got = J.routed(times.withColumn("position", F.lit("himawari")), routes(spark), "position").orderBy("time").collect()
    assert [r.satellite for r in got] == ["himawari9", "himawari8", "himawari8", "himawari9"]
    have = spark.sql("SELECT 'B03' AS channel, TIMESTAMP_NTZ '2022-12-13 00:05:00' AS time, s AS path, s AS satellite FROM VALUES ('himawari8'), ('himawari9') AS v(s)")
    source = SceneSource(have, ("B03", "B13"), "2015-07-07", None, position="himawari")
    assert [r.path for r in source(times, ["B03"]).collect()] == ["himawari8", "himawari9"]
    assert [r.status for r in source.history(times).orderBy("time").collect()] == ["before start", "ok", "ok", "ok"]
    assert source.find(times.where("time > '2022-01-01'"), ["B13"]) is None
    with pytest.raises(ValueError, match="before start"):
        source.find(times, ["B03"])
