"""State with timers, calendar windows, chunks of several axes, archives, ledger, manifest, sketches, damage, reports and table functions."""

import datetime as dt
import io
import os
import random
import zipfile

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from geoframe.functions import tables
from geoframe.operators import chunk as K
from geoframe.operators import combine as C
from geoframe.operators import sketch
from geoframe.sources import archives, catalogues, checked, manifest, report
from geoframe.sources.ledger import Ledger
from geoframe.sources.store import Store, scratch
from geoframe.streaming import jobs as J
from geoframe.streaming import runs as R

STEPS = "run string, step long, init timestamp_ntz"


def at(day, hour=0):
    return dt.datetime(2024, 1, 1, hour) + dt.timedelta(days=day - 1)


class Arrivals:
    """A folder of rows that a stream takes up bit by bit, one run of the stream for each delivery, as after restarts."""

    def __init__(self, spark, schema, time):
        self.spark, self.schema, self.time = spark, schema, time
        self.files, self.out, self.progress = (scratch(spark, n) for n in ("files", "out", "progress"))

    def deliver(self, rows, job):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(self.files)
        stream = self.spark.readStream.schema(self.schema).parquet(self.files).withColumn(self.time, F.col(self.time).cast("timestamp"))
        made = job(stream)
        with R.timers(self.spark):
            J.to_files(made, self.out, self.progress)
        return sorted(map(tuple, self.spark.read.schema(made.schema).parquet(self.out).collect()))


def test_runs_are_told_once_and_forgotten(spark):
    job = lambda s: R.tracked_runs(s, "run", "step", 3, "init", "5 days").select("run", "status", "steps", F.concat_ws(",", F.col("missing").cast("array<string>")).alias("missing"))
    a = Arrivals(spark, STEPS, "init")
    done, lacks = ("a", "complete", 3, ""), ("b", "expired", 2, "1")
    assert a.deliver([("a", 0, at(1)), ("a", 2, at(1)), ("b", 0, at(2)), ("b", 0, at(2)), (None, 1, at(2)), ("b", None, at(2)), ("b", 9, at(2))], job) == []
    assert a.deliver([("a", 1, at(1)), ("b", 2, at(2))], job) == [done]
    assert a.deliver([("a", 1, at(1)), ("a", 0, at(1))], job) == [done]
    assert a.deliver([("c", 0, at(8)), ("c", 1, at(8))], job) == [done, lacks]
    # the watermark is at day 3: late steps of a and b change nothing, c goes on
    assert a.deliver([("b", 1, at(2)), ("a", 2, at(1)), ("c", 2, at(8))], job) == [done, lacks, ("c", "complete", 3, "")]
    state = spark.read.format("statestore").option("stateVarName", "run").load(a.progress)
    assert [r[0] for r in state.select("key.run").collect()] == ["c"]


def test_complete_runs_reads_no_earlier_output(spark):
    path, progress, files = (scratch(spark, n) for n in ("runs", "progress", "files"))
    seen = []
    for rows in ([("a", 1, at(1)), ("b", 1, at(1))], [("a", 2, at(1)), ("b", 1, at(1)), ("b", None, at(1))], [("a", 2, at(1)), ("b", 2, at(1)), ("b", 3, at(1))], [("a", 3, at(1)), ("b", 9, at(1))]):
        spark.createDataFrame(rows, STEPS).coalesce(1).write.mode("append").parquet(files)
        stream = spark.readStream.schema(STEPS).parquet(files).withColumn("init", F.col("init").cast("timestamp"))
        J.complete_runs(stream, "run", "step", 2, "init", "30 days", path, progress)
        seen.append(sorted(map(tuple, spark.read.schema("run string, steps long").parquet(path).select("run", "steps").collect())))
    assert seen == [[], [("a", 2)], [("a", 2), ("b", 3)], [("a", 2), ("b", 3)]]


def test_deadline_runs_need_no_python_and_tell_once(spark):
    path, progress, files = (scratch(spark, n) for n in ("told", "progress", "files"))
    done, lacks, late = ("a", "complete", 3, ""), ("b", "expired", 2, "1"), ("c", "complete", 3, "")
    deliveries = [
        ([("a", 0, at(1)), ("a", 2, at(1)), ("b", 0, at(2)), ("b", 0, at(2)), (None, 1, at(2)), ("b", None, at(2)), ("n", 0, None)], []),
        ([("a", 1, at(1)), ("b", 2, at(2))], [done]),
        ([("a", 1, at(1)), ("a", 0, at(1)), ("d", None, at(6))], [done]),
        ([("c", 0, at(8)), ("c", 1, at(8))], [done, lacks]),
        # the watermark is at day 3: late steps of a and b change nothing, c goes on
        ([("b", 1, at(2)), ("a", 2, at(1)), ("c", 2, at(8))], [done, lacks, late]),
        ([("e", 0, at(20))], [done, lacks, late, ("d", "expired", 0, "0,1,2")]),
    ]
    for rows, want in deliveries:
        spark.createDataFrame(rows, STEPS).coalesce(1).write.mode("append").parquet(files)
        stream = spark.readStream.schema(STEPS).parquet(files).withColumn("init", F.col("init").cast("timestamp"))
        J.deadline_runs(stream, "run", "step", 3, "init", "5 days", path, progress)
        told = J.told_runs(spark, path, "run string, init timestamp", 3)
        assert sorted(map(tuple, told.select("run", "status", "steps", F.concat_ws(",", F.col("missing").cast("array<string>"))).collect())) == sorted(want)


@pytest.mark.parametrize("unit", ["hour", "day", "week", "month", "quarter", "year"])
def test_window_numbers_follow_the_calendar(spark, unit):
    rows = [(dt.datetime(1969, 12, 31, 23) + dt.timedelta(hours=h),) for h in (*range(0, 2000, 7), *range(400000, 402000, 11))]
    got = spark.createDataFrame(rows, "t timestamp_ntz").select("t", J.window_number(F.col("t"), unit).alias("n"), F.date_trunc(unit, "t").alias("start")).orderBy("t").collect()
    for a, b in zip(got, got[1:]):
        assert (a.n == b.n) == (a.start == b.start) and a.n <= b.n
        if b.t - a.t <= dt.timedelta(hours=11) and a.start != b.start:
            assert b.n == a.n + (1 if unit != "hour" else int((b.start - a.start).total_seconds() // 3600))


def test_calendar_windows_close_by_windows(spark):
    schema = "t timestamp_ntz, v long"
    week = Arrivals(spark, schema, "t")
    job = lambda s: J.calendar_windows(s, "t", "week", -1, [], v=F.sum("v")).select("start", "v")
    assert week.deliver([(at(1), 1), (at(7, 23), 1), (at(8), 5)], job) == []
    assert week.deliver([(at(14), 5), (at(15), 7)], job) == [(at(1), 2)]
    # the first week is closed, so its row is late; the second takes one more
    assert week.deliver([(at(2), 100), (at(9), 5), (at(22), 0)], job) == [(at(1), 2), (at(8), 15)]
    month = Arrivals(spark, schema, "t")
    job = lambda s: J.calendar_windows(s, "t", "month", 0, [], v=F.sum("v"))
    assert month.deliver([(at(1), 1), (at(31, 23), 2), (at(32), 4), (at(60), 8)], job) == [(at(1), at(32), 3)]
    assert month.deliver([(at(61), 0)], job) == [(at(1), at(32), 3), (at(32), at(61), 12)]


def array_of(chunks, grid, value="v"):
    held = np.full(tuple(grid.lengths.values()), None, object)
    for row in chunks.collect():
        block = tuple(row[b] for b in grid.blocks)
        where = tuple(slice(b * s, b * s + n) for b, s, n in zip(block, grid.sizes.values(), grid.shape(block)))
        assert len(row[value]) == np.prod(grid.shape(block))
        held[where] = np.array([*row[value], None], object)[:-1].reshape(grid.shape(block))
    return held


def test_chunks_of_several_axes(spark):
    random.seed(4)
    lengths = {"a": 5, "b": 7, "c": 4}
    cells = [(i, j, k, random.choice([None, 1.5, 2.0, 100.0 * i + 10 * j + k]), f"{i}{j}{k}") for i in range(5) for j in range(7) for k in range(4) if random.random() < 0.6]
    df = spark.createDataFrame(cells + [(9, 0, 0, 1.0, "out"), (None, 0, 0, 1.0, "none")] + cells[:3], "a int, b int, c int, v double, s string").repartition(5)
    want = np.full((5, 7, 4), None, object)
    for i, j, k, v, _ in cells:
        want[i, j, k] = v
    grids = [K.Grid(lengths, dict(zip(lengths, sizes))) for sizes in ((1, -1, -1), (2, 3, 3), (-1, 1, 4), (5, 7, 4), (1, 1, 1), (4, 2, 100))]
    for grid in grids:
        made = K.to_chunks(df, grid, ["v", "s"])
        assert (array_of(made, grid) == want).all()
        back = K.to_cells(made, grid, ["v", "s"]).where("s is not null")
        assert sorted(map(str, map(tuple, back.collect()))) == sorted(map(str, cells))
    for old in grids[:4]:
        for new in grids[1:5]:
            made = K.rechunked(K.to_chunks(df, old, ["v", "s"]), old, new, ["v", "s"])
            assert (array_of(made, new) == want).all()
            assert [f.dataType.simpleString() for f in made.schema][-2:] == ["array<double>", "array<string>"]


def test_rechunking_is_one_exchange_and_keeps_keys(spark):
    old, new = K.Grid({"t": 10, "x": 6}, {"t": 1, "x": -1}), K.Grid({"t": 10, "x": 6}, {"t": -1, "x": 4})
    rows = [(run, t, 0, [float(100 * run + 10 * t + x) for x in range(6)]) for run in (1, 2) for t in range(10)]
    made = K.rechunked(spark.createDataFrame(rows, "run int, block_t int, block_x int, v array<double>"), old, new, ["v"], ["run"])
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    got = {(r.run, r.block_t, r.block_x): r.v for r in made.collect()}
    assert got == {(run, 0, b): [100.0 * run + 10 * t + x for t in range(10) for x in range(4 * b, min(6, 4 * b + 4))] for run in (1, 2) for b in (0, 1)}
    assert K.rechunked(spark.createDataFrame([], "run int, block_t int, block_x int, v array<double>"), old, new, ["v"], ["run"]).count() == 0


def test_grids_are_checked():
    for lengths, chunk in (({"a": 3}, {"b": 1}), ({"a": 3}, {"a": 0}), ({"a": 0}, {"a": 1}), ({"a": 1 << 13, "b": 1 << 13}, {"a": -1, "b": -1})):
        with pytest.raises(ValueError):
            K.Grid(lengths, chunk)


def zipped(members):
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as archive:
        for name, data in members.items():
            archive.writestr(name, data)
    return held.getvalue()


def test_archives_are_written_whole_and_scanned_by_member(spark):
    path = scratch(spark, "zips")
    files = [
        ("a/one.zip", zipped({"x/tngabc07.tsv": "2024-01-01 00:00:00\t1.5\t2\n2024-01-01 00:15:00\t\tbad\n", "tngabc08.tsv": "2024-01-01 00:00:00\t3\t4\n", "readme.txt": "no", "other07.tsv": "x\ty\tz\n", "tngabc09.tsv": ""})),
        ("two.zip", b"this is no archive"),
        ("b/three.zip", zipped({"tngabc07.tsv": "not a time\t5\t6\n", "tngabc11.tsv": "1\t2\n"})),
        ("notes.txt", b"left alone"),
        ("empty.zip", zipped({})),
    ]
    archives.write_files(spark.createDataFrame(files, "path string, content binary").repartition(3), path)
    assert sorted(os.path.relpath(os.path.join(d, f), path) for d, _, fs in os.walk(path) for f in fs if not f.startswith("._") and not f.endswith(".crc")) == sorted(f for f, _ in files)
    got = archives.station_members(spark, path, "tng", ["power", "tilt"])
    assert got.rdd.getNumPartitions() == 4
    rows = [tuple(r)[1:] for r in got.collect()]
    good = sorted(r[:4] for r in rows if r[4] is None)
    noon = dt.datetime(2024, 1, 1)
    assert good == [(7, noon, "power", 1.5), (7, noon, "tilt", 2.0), (8, noon, "power", 3.0), (8, noon, "tilt", 4.0)]
    bad = sorted(str(r[4]).split(":")[0] for r in rows if r[4] is not None)
    assert bad.count("not a number") == 1 and bad.count("not a time") == 2 and bad.count("BadZipFile") == 1 and bad.count("ArrowInvalid") == 1
    assert {r.station for r in archives.station_members(spark, path, "tng", ["power", "tilt"], "08").where("station is not null").collect()} == {8}


def test_a_failed_write_leaves_no_file(spark):
    path = scratch(spark, "failed")
    rows = spark.range(20).select(F.concat(F.lit("f"), F.col("id").cast("string")).alias("path"), F.when(F.col("id") == 13, F.raise_error(F.lit("boom"))).otherwise(F.lit("x")).cast("binary").alias("content"))
    with pytest.raises(Exception, match="boom"):
        archives.write_files(rows.repartition(4), path)
    assert [f for _, _, fs in os.walk(path) for f in fs] == []
    archives.write_files(spark.createDataFrame([("f1", b"a")], "path string, content binary"), path)
    archives.write_files(spark.createDataFrame([("g/f2", b"b")], "path string, content binary"), path, "overwrite")
    assert [f for _, _, fs in os.walk(path) for f in fs] == ["f2"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_ledger_meets_a_batch_by_bucket(spark):
    ledger = Ledger(spark, scratch(spark, "ledger"))
    names = lambda *xs: spark.createDataFrame([(x,) for x in xs], "product string")
    assert ledger.known(names("a", "b"), 1).count() == 0 and not ledger.committed(1)
    ledger.commit(names("a", "b", None), 1)
    assert ledger.committed(1) and sorted(r[0] for r in ledger.known(names("a", "c"), 2).collect()) == ["a"]
    # names without a commit don't count, nor do those of the batch itself
    ledger._append(names("c").withColumn("batch", F.lit(2)), ledger._generation())
    assert [r[0] for r in ledger.known(names("a", "c"), 3).collect()] == ["a"]
    ledger.commit(names("c", "d"), 2)
    assert sorted(r[0] for r in ledger.known(names("a", "c", "d", "e"), 3).collect()) == ["a", "c", "d"]
    assert sorted(r[0] for r in ledger.known(names("a", "c", "d", "e"), 2).collect()) == ["a"]
    for batch in range(3, 40):
        ledger.commit(names(*(f"{batch}-{k}" for k in range(3))), batch)
    few = ledger.known(names("7-1", "none"), 99)
    scan = next(line for line in plan_of(few).split("\n") if "FileScan" in line and "Bucketed: true" in line)
    # two names lie in two of 32 buckets, however many batches there are
    assert "SelectedBucketsCount: 2 out of 32" in scan or "SelectedBucketsCount: 1 out of 32" in scan
    lines = plan_of(few).split("\n")
    at = next(k for k, line in enumerate(lines) if "Bucketed: true" in line)
    join = max(k for k in range(at) if "SortMergeJoin" in lines[k])
    assert not any("Exchange" in line for line in lines[join:at])
    many = names(*(str(k) for k in range(1500)), "39-2")
    assert [r[0] for r in ledger.known(many, 99).collect()] == ["39-2"]
    everything = lambda: [r[0] for r in ledger.names().where("product is not null").select("product").collect()]
    before, held = ledger.files(), everything()
    ledger.compact(8)
    # a batch that was run again has its names twice until then
    assert ledger.files() <= 8 < before and sorted(everything()) == sorted(set(held)) and len(held) == len(set(held)) + 1
    ledger.commit(names("z"), 100)
    assert sorted(r[0] for r in ledger.known(names("z", "39-2", "q"), 101).collect()) == ["39-2", "z"]
    again = Ledger(spark, ledger.path)
    assert [r[0] for r in again.known(names("z"), 101).collect()] == ["z"]


def files_read(df):
    """Sum of the files that the scans of an executed plan have opened."""
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if hasattr(plan, "executedPlan") else plan
    total, todo = 0, [plan]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name.startswith("Scan parquet"):
            total += node.metrics().get("numFiles").get().value()
        kids = node.children()
        todo += [kids.apply(k) for k in range(kids.size())]
        if "QueryStage" in node.getClass().getSimpleName():
            todo.append(node.plan())
    return total


def test_the_manifest_is_pruned_by_requests(spark):
    rows = [(f"s{s}", b, at(d, h), f"{s}{b}{d}{h}") for s in (1, 2) for b in "xy" for d in range(1, 5) for h in range(0, 24, 3)]
    store = manifest.Manifest.write(spark, scratch(spark, "manifest"), spark.createDataFrame(rows, "satellite string, band string, time timestamp_ntz, path string"))
    asked = [("s1", "x", at(2, 3) + dt.timedelta(minutes=20)), ("s1", "x", at(2, 3) + dt.timedelta(minutes=20)), ("s2", "y", at(4, 20)), ("s2", "y", at(4, 4)), ("s9", "x", at(1)), (None, "x", at(1))]
    path = scratch(spark, "asked")
    spark.createDataFrame(asked, "satellite string, band string, time timestamp_ntz").coalesce(1).write.parquet(path)
    found = store.found(spark.read.schema("satellite string, band string, time timestamp_ntz").parquet(path), 3600)
    assert "dynamicpruning" in plan_of(found).lower()
    got = sorted(((r.satellite or "", r.time, r.path) for r in found.collect()))
    assert got == sorted([("s1", asked[0][2], "1x23"), ("s1", asked[0][2], "1x23"), ("s2", at(4, 20), "2y421"), ("s2", at(4, 4), "2y43"), ("s9", at(1), None), ("", at(1), None)])
    # three folders of the manifest's 128, and the requests' file once or twice
    assert 3 < files_read(found) <= 6 and len(store.store.read().inputFiles()) == 128


def test_sketches_union_to_one_pass(spark):
    random.seed(6)
    rows = [(random.choice("ab"), random.randrange(20), random.randrange(5000)) for _ in range(20000)]
    df = spark.createDataFrame(rows, "k string, part int, v int")
    once = {r.k: r.estimate for r in sketch.merged(sketch.sketched(df, ["k"], F.col("v")), ["k"]).collect()}
    store = Store(spark, scratch(spark, "held"), ["part"]).create(df.where("part < 10"))
    counted = sketch.CountedStore(store, scratch(spark, "sketches"), ["k"], F.col("v"))
    for low, high in ((10, 15), (5, 20)):
        more = df.where(f"part >= {max(low, 10)} and part < {high}") if low == 10 else df.where("part >= 15")
        store.append(more)
        counted.add(more)
    assert {r.k: r.estimate for r in counted.estimates(["k"]).collect()} == once
    for k, estimate in once.items():
        exact = len({v for a, _, v in rows if a == k})
        assert abs(estimate - exact) <= sketch.error_bound() * exact
    store.write_regions(df.where("part = 3").withColumn("v", F.lit(7)))
    counted.refresh(spark.createDataFrame([(3,)], "part int"))
    again = df.where("part <> 3").unionByName(df.where("part = 3").withColumn("v", F.lit(7)))
    assert {r.k: r.estimate for r in counted.estimates(["k"]).collect()} == {r.k: r.estimate for r in sketch.merged(sketch.sketched(again, ["k"], F.col("v")), ["k"]).collect()}
    assert counted.estimates([]).count() == 1


def test_damage_is_told_by_file(spark):
    path = scratch(spark, "csv")
    lines = [("1,2024-01-01 00:00:00,1.5", "a"), ("2,2024-01-01 00:00:00,", "a"), ("3,not a time,2", "b"), ("4,2024-01-01 00:00:00", "b"), ("5,2024-01-01 00:00:00,1,9", "c"), ("x,2024-01-01 00:00:00,1", "c"), ("7,2024-01-01 00:00:00,1", "c")]
    spark.createDataFrame(lines, "value string, run string").write.partitionBy("run").text(path)
    rows = checked.csv_rows(spark, path, "id int, t timestamp_ntz, v double", header=False, times="yyyy-MM-dd HH:mm:ss")
    told = {r.run: (r.good, r.damaged, r.example) for r in checked.damage(rows, ["run"]).collect()}
    assert told == {"a": (2, 0, None), "b": (0, 2, lines[2][0]), "c": (1, 2, lines[4][0])}
    assert sorted(r.id for r in checked.sound_rows(rows).collect()) == [1, 2, 7]
    assert sorted(r.id for r in checked.sound_groups(rows).collect()) == [1, 2] == sorted(r.id for r in checked.sound_groups(rows, ["run"]).collect())
    assert checked.damage(rows).agg(F.sum("damaged")).first()[0] == 4
    assert checked.damage(rows).count() == rows.select("file").distinct().count()
    held = scratch(spark, "json")
    spark.createDataFrame([('{"id": "a", "n": 1}',), ('{"id": "b", "n": "x"}',), ("{",)], "value string").write.text(held)
    assert sorted((r.id or "", r.error is not None) for r in checked.json_rows(spark, held, "id string, n int").collect()) == [("", True), ("a", False), ("b", True)]


def test_reports_come_with_the_write(spark):
    rows = spark.createDataFrame([("a", 10, True), ("a", 5, False), ("b", 7, True), ("c", 1, True), (None, 2, True), ("b", None, True), ("b", 3, None)], "run string, size long, ok boolean")
    path = scratch(spark, "reported")
    tracker = spark.sparkContext.statusTracker()
    group = "reported-write"
    spark.sparkContext.setJobGroup(group, "a write and its report")
    got = report.reported_write(rows, lambda df: df.write.parquet(path), ["a", "b", "d"], "run", F.col("size"), F.col("ok"))
    assert len(tracker.getJobIdsForGroup(group)) == 1
    spark.sparkContext._jsc.sc().clearJobGroup()
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [("a", 10, 1, 1), ("b", 7, 2, 1), ("d", 0, 0, 0), (None, 3, 2, 0)]))
    assert spark.read.parquet(path).count() == 5


def test_table_functions_are_inlined(spark):
    tables.register(spark)
    df = spark.sql("SELECT s.k, t.start, t.stop FROM VALUES (1, TIMESTAMP_NTZ '2024-01-10', TIMESTAMP_NTZ '2024-02-01') s(k, a, b), LATERAL week_windows(s.a, s.b, -1) t")
    assert [(r.start, r.stop) for r in df.orderBy("start").collect()] == [(at(8), at(15)), (at(15), at(22)), (at(22), at(29))]
    plan = plan_of(df)
    assert "Python" not in plan and "Join" not in plan
    assert [r.start for r in spark.sql("SELECT * FROM month_windows(TIMESTAMP_NTZ '2023-11-20', TIMESTAMP_NTZ '2024-03-02', -1)").orderBy("start").collect()] == [dt.datetime(2023, 11, 1), dt.datetime(2023, 12, 1), dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)]


def test_availability_has_rows_for_what_is_empty(spark):
    rows = spark.createDataFrame([("a", at(1, 3)), ("a", at(1, 3)), ("a", at(3)), ("b", at(3, 5))], "source string, t timestamp_ntz")
    got = sorted((r.source, r.day.day, r.present, r.expected) for r in C.availability(rows, "source", "t", 24).collect())
    assert got == [("a", 1, 1, 24), ("a", 2, 0, 24), ("a", 3, 1, 24), ("b", 1, 0, 24), ("b", 2, 0, 24), ("b", 3, 1, 24)]
    assert C.availability(rows.limit(0), "source", "t", 24).count() == 0


def test_catalogues_know_their_fields(spark):
    held = catalogues.fields(spark)
    sizes = {(r.model, r.family): r["count"] for r in held.groupBy("model", "family").count().collect()}
    assert sizes[("global", "pressure")] == 5 * 18 and sizes[("europe", "model")] == 3 * 76 and sizes[("dust", "single")] == 15 + 60 and sizes[("global ensemble", "single")] == 13
    wanted = spark.createDataFrame([("global", "pressure", "t", None, "850"), ("global", "pressure", "t", None, "851"), ("europe", "single", "qv_2m", None, None), ("global", "single", "qv_2m", None, None)], "model string, family string, name string, wavelength string, level string")
    assert sorted((r.model, r.name) for r in catalogues.not_offered(wanted, held).collect()) == [("global", "qv_2m"), ("global", "t")]
    assert len(catalogues.AIR_QUALITY_GLOBAL) == len(set(catalogues.AIR_QUALITY_GLOBAL)) == 27
    assert pd.Series(catalogues.LEAD_HOURS_GLOBAL).size * len(catalogues.RUNS_GLOBAL) == 242
