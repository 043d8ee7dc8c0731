"""Helpers that the text operators share: tables, lineage cuts, connected components, interval arithmetic."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or where it is unset, on one machine only, a new temporary one."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not folder:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        folder = tempfile.mkdtemp(prefix="spark-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows survive the loss of any executor and the lineage ends here."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(*frames: DataFrame) -> None:
    """Deletes the files of checkpoints that nothing reads any more: what came of them has been cut or written itself."""
    for df in frames:
        file = df._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
        if file.isDefined():
            session = df.sparkSession
            path = session._jvm.org.apache.hadoop.fs.Path(file.get())
            path.getFileSystem(session._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes df as compressed Parquet to the shared folder and reads it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: A table of at most so many short rows is broadcast, of more it is joined by a shuffle.
BROADCAST = 1 << 18


def bounded(df: DataFrame, rows: int = BROADCAST) -> DataFrame:
    """df, given as a checkpoint, with a broadcast hint if it has few rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


#: What a Python worker keeps from task to task, also while it is idle: encoders with the words that they know.
REMEMBERED: dict = {}


def forget() -> None:
    """Gives back what another operator's tasks remembered in this worker; they build it anew when they need it."""
    if REMEMBERED:
        REMEMBERED.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()


def steps(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, so that what a task derives from one batch stays small."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def text_bytes(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each text, empty for null, without building Python strings."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    for value in column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()):
        yield value.as_py() or b""


def merge_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open intervals as maximal disjoint intervals, in order; touching ones join."""
    if len(starts) == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    order = np.argsort(starts, kind="stable")
    starts, reach = np.asarray(starts, np.int64)[order], np.maximum.accumulate(np.asarray(ends, np.int64)[order])
    new = np.concatenate(([True], starts[1:] > reach[:-1]))
    last = np.append(np.flatnonzero(new)[1:], len(starts)) - 1
    return starts[new], reach[last]


def components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """Connected components of an undirected graph given as (a long, b long), as (node, component).

    component is the smallest node reachable. Rounds alternate a large star and a small star, each a
    group minimum and a join, so a node of any degree is spread over tasks; every round is
    checkpointed. Only nodes with an edge to another node appear; an empty graph gives no rows.
    """
    graph = cut(edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = graph.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    for _ in range(max_rounds):
        if not state[0]:
            break
        both = graph.select("a", "b").union(graph.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.*").where("a <> b").distinct()
        graph = cut(small)
        now = graph.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return graph.select(F.col("a").alias("node"), F.col("b").alias("component")).union(graph.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
