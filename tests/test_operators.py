"""Properties of operators: inverses, idempotence, counts, order and plans."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from geoframe.operators import combine as C
from geoframe.operators import join as J
from geoframe.operators import select as L
from geoframe.operators import shape as S
from geoframe.sources.requests import Fields
from geoframe.sources.store import OPEN_FILES, Store, export_blocks, scratch

HERE = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@HERE
@given(st.lists(st.lists(st.floats(-9, 9, width=32), min_size=6, max_size=6), min_size=1, max_size=4))
def test_cells_and_scenes_are_inverse(spark, payloads):
    df = spark.createDataFrame(list(enumerate(payloads)), "k int, payload array<float>")
    assert sorted(map(tuple, S.scenes(S.cells(df, "payload", 3), ["k"]).select("k", "payload").collect())) == sorted(map(tuple, df.collect()))


@HERE
@given(st.lists(st.integers(0, 30), min_size=0, max_size=40))
def test_numbered_is_a_total_order(spark, values):
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v int, i int")
    got = S.numbered(df, ["v", "i"]).orderBy("position").collect()
    assert [(r.v, r.i) for r in got] == sorted((v, i) for i, v in enumerate(values))
    assert [r.position for r in got] == list(range(len(values)))


@HERE
@given(st.integers(0, 25), st.integers(1, 9))
def test_padding_and_truncation(spark, n, multiple):
    df = spark.range(n).select(F.col("id").alias("k"))
    assert S.padded(df, ["k"], multiple, {"k": -1}).count() % multiple == 0
    assert S.truncated(df, ["k"], multiple).count() == n // multiple * multiple


def test_transposed_and_padded_scene(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0, 5.0, 6.0],)], "p array<double>")
    assert df.select(S.transposed(F.col("p"), 2, 3)).first()[0] == [1, 4, 2, 5, 3, 6]
    assert df.select(S.padded_scene(F.col("p"), 2, 3, 3, 4)).first()[0] == [1, 2, 3, None, 4, 5, 6, None, None, None, None, None]


def test_nearest_stays_in_the_hour_and_takes_the_first_on_ties(spark):
    t = lambda h, m, s=0: dt.datetime(2025, 1, 1, h, m, s)
    scenes = spark.createDataFrame([("c", t(9, 59), "p0"), ("c", t(10, 29, 55), "p1"), ("c", t(10, 30, 5), "p2"), ("c", t(10, 40), "p3")], "channel string, time timestamp_ntz, path string")
    ask = spark.createDataFrame([("c", t(10, 30)), ("c", t(10, 1)), ("c", t(12, 0))], "channel string, time timestamp_ntz")
    got = {r.time: r.path for r in J.nearest_in_hour(ask, scenes, ["channel"]).collect()}
    assert got == {t(10, 30): "p1", t(10, 1): "p1"}
    plan = J.nearest_in_hour(ask, scenes, ["channel"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_alignment_has_keys_times_times_rows(spark):
    df = spark.createDataFrame([(1, 1, 1.0), (1, 2, 2.0), (2, 3, 3.0), (2, 3, 4.0)], "k int, t int, v double")
    got = J.aligned(df, "k", "t", ["v"])
    assert got.count() == 6 and got.where("v is null").count() == 3


def test_first_rows_is_idempotent(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 5, "c"), (1, 1, "a")], "k int, t int, v string")
    once = C.first_rows(df, ["k"], ["t", "v"])
    assert sorted(map(tuple, once.collect())) == [(1, 1, "a"), (2, 5, "c")] == sorted(map(tuple, C.first_rows(once, ["k"], ["t", "v"]).collect()))


def test_id_lists(spark):
    df = spark.range(8).select(F.col("id"))
    assert {r.ids for r in C.id_lists(df, "id", 5).collect()} == {"0,1,2,3,4", "5,6,7"}
    assert {r.ids for r in C.id_lists(df, "id", 5, pad_last=True).collect()} == {"0,1,2,3,4", "5,6,7,8,9"}


def test_history_ends_are_allowed(spark):
    ask = spark.createDataFrame([("goes17", dt.datetime(2019, 2, 12)), ("goes17", dt.datetime(2023, 1, 4)), ("goes17", dt.datetime(2023, 1, 5)), ("x", dt.datetime(2023, 1, 5))], "satellite string, time timestamp_ntz")
    got = [r.status for r in L.in_history(ask, L.operating_ranges(spark)).orderBy("satellite", "time").collect()]
    assert got == ["ok", "ok", "after end", "unknown satellite"]
    with pytest.raises(Exception, match="invalid request"):
        L.in_history(ask, L.operating_ranges(spark), strict=True).collect()


def test_time_filter_reaches_the_scan(spark, sf_dir):
    plan = L.since(spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts"), "ts", "2024-01-15")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "value" not in plan.split("ReadSchema")[1]


def test_store_writes_are_idempotent(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k int, part string, v double")
    store = Store(spark, scratch(spark, "t"), ["part"]).create(df)
    new = spark.createDataFrame([(2, "b", 5.0), (3, "b", 6.0), (3, "b", 6.0)], "k int, part string, v double")
    want = [(1, "a", 1.0), (2, "b", 5.0), (3, "b", 6.0)]
    assert sorted(map(tuple, store.upsert(new, ["k", "part"]).read().collect())) == want
    assert sorted(map(tuple, store.upsert(new, ["k", "part"]).read().collect())) == want
    assert not store.append_new_batch(new, "k") and store.append_new_batch(new.withColumn("k", F.col("k") + 10), "k")
    with pytest.raises(ValueError, match="lacks"):
        store.append(new.withColumn("other", F.lit(1)))


@pytest.fixture
def small_tasks(spark):
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000b", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1b"}
    before = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_a_large_partition_is_written_by_several_tasks(spark, small_tasks):
    before = spark.conf.get(OPEN_FILES)
    df = spark.range(60000, numPartitions=8).select(F.xxhash64("id").alias("k"), F.when(F.col("id") % 50 == 0, "b").otherwise("a").alias("part"))
    store = Store(spark, scratch(spark, "large"), ["part"]).create(df)
    files = store.read().select("part", F.input_file_name().alias("f"), "k").groupBy("part", "f").count().groupBy("part").agg(F.count("*").alias("files"), F.sum("count").alias("rows")).collect()
    assert {r.part: r.rows for r in files} == {"a": 58800, "b": 1200}
    assert {r.part: r.files for r in files}["a"] >= 4
    assert sorted(map(tuple, store.read().collect())) == sorted(map(tuple, df.collect()))
    assert spark.conf.get(OPEN_FILES) == before


def test_blocks_keep_a_key_together_and_in_order(spark, small_tasks):
    df = spark.range(40000, numPartitions=4).select((F.col("id") * 7 % 90).alias("key"), "id")
    path = export_blocks(df, "key", F.floor(F.col("key") / 50).cast("long"), scratch(spark, "blocks"))
    seen = {}
    for r in spark.read.parquet(path).select("key", "block", "id", F.input_file_name().alias("f")).collect():
        assert r.block == r.key // 50
        seen.setdefault(r.f, []).append(r.key)
    assert all(v == sorted(v) for v in seen.values()) and sum(map(len, seen.values())) == 40000
    assert all(len([1 for v in seen.values() if k in v]) == 1 for k in range(90))
    assert len(seen) > 2


def test_fields_need_a_main_family():
    with pytest.raises(ValueError, match="at least one"):
        Fields(invariant=("clat",))
