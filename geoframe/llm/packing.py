"""Best-fit packing of token pieces: a configuration linear program over the histogram of lengths, rounded."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from geoframe.llm.common import cut, table
from geoframe.llm.tokens import WORD_BPE, encoder, slices, with_end

CAPACITY = 2048
#: Rounds of multiplicative weights; each prices one configuration.
ROUNDS = 192


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str = WORD_BPE, last: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each text's ids and the id ``last``, cut only if longer than ``capacity``. Null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            for part in slices(batch, 1):
                ids, ends = with_end(*encode(part.column(1)), last)
                begins = np.concatenate(([0], ends[:-1]))
                count = -(-(ends - begins) // capacity)
                row = np.repeat(np.arange(len(ends)), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                start = piece * capacity
                length = np.minimum(capacity, (ends - begins)[row] - start)
                data = memoryview(ids.astype("<u4")).cast("B")
                at = begins[row] + start
                crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(at.tolist(), (at + length).tolist())]
                yield pa.record_batch([part.column(0).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_configuration(values: np.ndarray, capacity: int) -> dict[int, int]:
    """Unbounded knapsack by dynamic programming: the multiset of lengths within capacity of the largest value. values[length], 0 for no such item."""
    best = np.zeros(capacity + 1)
    taken = np.zeros(capacity + 1, np.int64)
    lengths = np.flatnonzero(values > 0)
    for room in range(1, capacity + 1):
        fit = lengths[: np.searchsorted(lengths, room, "right")]
        if len(fit):
            gain = best[room - fit] + values[fit]
            k = int(gain.argmax())
            if gain[k] > best[room - 1]:
                best[room], taken[room] = gain[k], fit[k]
                continue
        best[room] = best[room - 1]
    config: dict[int, int] = defaultdict(int)
    room = capacity
    while room > 0:
        if taken[room]:
            config[int(taken[room])] += 1
            room -= int(taken[room])
        else:
            room -= 1
    return dict(config)


def solve_configurations(counts: np.ndarray, capacity: int, rounds: int = ROUNDS) -> list[tuple[dict[int, int], float]]:
    """An approximate fractional cover: configurations and how often each is used.

    Multiplicative weights: the weight of a length is its dual price per item; the priced
    configuration is used for an equal share of the bins, and lengths that it serves beyond their
    demand so far lose weight.
    """
    lengths = np.flatnonzero(counts)
    if not len(lengths):
        return []
    bins = float(counts @ np.arange(len(counts))) / capacity
    share, demand = bins / rounds, counts[lengths].astype(float)
    served = np.zeros(len(lengths))
    used: dict[tuple, float] = defaultdict(float)
    for turn in range(rounds):
        behind = np.clip((demand * (turn + 1) / rounds - served) / demand, -1, 1)
        values = np.zeros(capacity + 1)
        values[lengths] = lengths / capacity * np.exp(4.0 * behind)
        config = best_configuration(values, capacity)
        used[tuple(sorted(config.items()))] += share
        for length, n in config.items():
            served[np.searchsorted(lengths, length)] += share * n
    return [(dict(c), x) for c, x in used.items()]


def plan_bins(counts: np.ndarray, capacity: int, rounds: int = ROUNDS) -> list[tuple[list[int], int]]:
    """(lengths in one bin, number of such bins) for counts[length] items of each length.

    The program's fractional cover is rounded. Rounding may cost a bin, so if there are more than the
    tokens need at least, best fit without the program is tried, too, and the fewer bins count.
    """
    left = counts.astype(np.int64).copy()
    left[capacity] = 0
    planned = rounded(counts, capacity, solve_configurations(left, capacity, rounds))
    bins = lambda plan: sum(n for _, n in plan)
    if bins(planned) * capacity - int(counts @ np.arange(len(counts))) < capacity:
        return planned
    return min(planned, rounded(counts, capacity, []), key=bins)


def rounded(counts: np.ndarray, capacity: int, cover: list[tuple[dict[int, int], float]]) -> list[tuple[list[int], int]]:
    """(lengths in one bin, number of such bins) from a fractional cover.

    The cover is rounded down, never beyond what is left of a length; the rest goes by best fit in
    order of falling length into the rounded bins' gaps and new bins. All work is on groups of equal
    bins, so its cost depends on the histogram, not on the number of items.
    """
    left = counts.astype(np.int64).copy()
    rooms: dict[int, list[tuple[list[int], int]]] = defaultdict(list)
    if left[capacity]:
        rooms[0].append(([capacity], int(left[capacity])))
        left[capacity] = 0
    for config, x in cover:
        n = min([int(x), *(int(left[length]) // k for length, k in config.items())])
        if n > 0:
            items = [length for length, k in config.items() for _ in range(k)]
            for length, k in config.items():
                left[length] -= n * k
            rooms[capacity - sum(items)].append((items, n))
    for length in np.flatnonzero(left)[::-1].tolist():
        todo = int(left[length])
        while todo:
            room = min((r for r in rooms if r >= length and rooms[r]), default=None)
            items, n = rooms[room].pop() if room is not None else ([], todo)
            room = capacity if room is None else room
            most = room // length
            full = min(n, todo // most) if most else 0
            if full:
                rooms[room - most * length].append((items + [length] * most, full))
                todo -= full * most
            else:
                rooms[room - todo * length].append((items + [length] * todo, 1))
                todo, full = 0, 1
            if items and n > full:
                rooms[room].append((items, n - full))
    return [bin for group in rooms.values() for bin in group]


def pack(parts: DataFrame, capacity: int = CAPACITY, rounds: int = ROUNDS) -> DataFrame:
    """parts with sequence_id and offset: pieces (doc_id, piece, length, ...) placed gapless into few sequences of at most ``capacity`` tokens.

    The driver sees the histogram only, at most ``capacity`` numbers. Pieces of a length are numbered
    in parallel, by a salt and in order within it, and take the plan's slots for that length in turn.
    Other columns may have any names but sequence_id and offset, which are refused. Repeated rows are
    placed one by one; an empty table gives no rows.
    """
    if {"sequence_id", "offset"} & set(parts.columns):
        raise ValueError("sequence_id and offset are the columns that packing makes")
    parts = cut(parts)
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in parts.groupBy("length").count().collect():  # at most `capacity` rows
        counts[length] = n
    slots: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    base = 0
    for items, n in plan_bins(counts, capacity, rounds):
        offset = 0
        for length in items:
            slots[length].append((n, base, offset))
            offset += length
        base += n
    keys, bases, offsets = [], [], []
    for length, given in sorted(slots.items()):
        first = 0
        for n, at, offset in given:
            keys.append(length << 48 | first)
            bases.append(at - first)
            offsets.append(offset)
            first += n
    plan = parts.sparkSession.sparkContext.broadcast((np.array(keys, np.int64), np.array(bases, np.int64), np.array(offsets, np.int64)))

    salts = max(64, int(counts.sum()) >> 20)
    salted = parts.withColumn("_pack_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    size = salted.groupBy("length", "_pack_salt").agg(F.count("*").alias("_pack_n"))
    before = size.select("length", "_pack_salt", (F.sum("_pack_n").over(Window.partitionBy("length").orderBy("_pack_salt")) - F.col("_pack_n")).alias("_pack_before"))
    rank = F.row_number().over(Window.partitionBy("length", "_pack_salt").orderBy("doc_id", "piece"))
    ranked = salted.withColumn("_pack_rank", rank).join(before, ["length", "_pack_salt"]).withColumn("_pack_rank", F.col("_pack_before") + F.col("_pack_rank") - 1).select(*parts.columns, "_pack_rank")
    at = ranked.columns.index("length"), ranked.columns.index("_pack_rank")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, bases, offsets = plan.value
        for batch in batches:
            length, rank = (batch.column(k).to_numpy(zero_copy_only=False) for k in at)
            slot = np.searchsorted(keys, length << 48 | rank, "right") - 1
            yield pa.record_batch([*batch.columns[:-1], pa.array(bases[slot] + rank), pa.array(offsets[slot])], [*names, "sequence_id", "offset"])

    names = parts.columns
    return ranked.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema), "sequence_id long", "offset long"]))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(pieces(table(spark, sf_dir, "documents")))
