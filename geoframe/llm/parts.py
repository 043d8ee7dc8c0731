"""Parts of sets that similar sets must share: keys by which large groups of loosely alike texts fall apart into small ones."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoframe.llm.common import cut, release, steps

#: A group is taken apart by its keys if that compares fewer than this share of its pairs.
WORTH = 0.25
#: Keys beyond those that are needed, as a share of the differences that a similar pair may have; half of them may be left out.
SPARE_PARTS = 0.1
_MIX = np.uint64(0x9E3779B97F4A7C15)


def kind_of(size: int, similarity: float) -> int:
    """Size class of a set: similar sets are of one class or of neighbouring ones."""
    return math.floor(math.log(size) / (math.log(1 / similarity) + 1e-9))


def partition_of(kind: int, similarity: float) -> tuple[int, int]:
    """(parts, spare) for pairs whose smaller set is of a class.

    Of two similar sets the smaller of n elements, at most n * (1 - s) / s elements are in one only, and
    each is in one part, so that all other parts are equal: with ``spare`` parts more than that and one,
    at least spare + 1 are.
    """
    largest = math.floor(math.exp((math.log(1 / similarity) + 1e-9) * (kind + 1)) + 1e-6)
    differ = math.floor(largest * (1 - similarity) / similarity + 1e-9)
    spare = 2 * math.ceil(SPARE_PARTS / 2 * differ)
    return differ + 1 + spare, spare


def _mixed(value: np.ndarray) -> np.ndarray:
    value = (value ^ value >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    value = (value ^ value >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return value ^ value >> np.uint64(31)


def keys_of(size: int, shared: np.ndarray, similarity: float) -> np.ndarray:
    """The keys of a set of ``size`` elements of which others have ``shared``: one at least is a key of every similar set, too.

    A key stands for the class of the pair's smaller set, a part and all shared elements in it. Elements
    that no other set has are differences of any pair, so a set with a of them agrees with a similar
    one on a parts more, and it leaves out that many and half of the spare ones, those with the fewest
    elements, which tell least.
    """
    own, out = size - len(shared), []
    values = _mixed(shared.view(np.uint64) + _MIX)
    for kind in (kind_of(size, similarity), kind_of(size, similarity) - 1):
        if kind < 0:
            continue
        parts, spare = partition_of(kind, similarity)
        part = (values >> np.uint64(17)) % np.uint64(parts)
        order = np.argsort(part, kind="stable")
        held, first = np.unique(part[order], return_index=True)
        content, count = np.zeros(parts, np.uint64), np.zeros(parts, np.int64)
        if len(held):
            content[held.astype(np.int64)] = np.add.reduceat(values[order], first)
            count[held.astype(np.int64)] = np.diff(np.append(first, len(part)))
        kept = np.argsort(count, kind="stable")[spare // 2 + own :]
        out.append(_mixed(content[kept] + _mixed(np.full(len(kept), kind + 1, np.uint64) * _MIX + kept.astype(np.uint64))))
    return np.unique(np.concatenate(out)) if out else np.empty(0, np.uint64)


def part_keys(members: DataFrame, similarity: float) -> DataFrame:
    """(cluster, key, node) of each (cluster, node, size, shared)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            found = [keys_of(n, np.asarray(x.values), similarity) for n, x in zip(batch.column(2).to_pylist(), batch.column(3))]
            row = np.repeat(np.arange(len(found)), [len(k) for k in found])
            flat = np.concatenate(found) if found else np.empty(0, np.uint64)
            yield pa.record_batch([batch.column(0).take(pa.array(row)), pa.array(flat.view(np.int64)), batch.column(1).take(pa.array(row))], ["cluster", "key", "node"])

    return members.select("cluster", "node", "size", "shared").mapInArrow(run, "cluster long, key long, node long")


def taken_apart(members: DataFrame, similarity: float) -> DataFrame:
    """members (cluster, node, size, shared) with each loose cluster replaced by the groups of its sets that share a key; a set is in several.

    Similar sets of a cluster are in one of these groups at least, whatever the cluster is: loose are
    those whose groups have together fewer than WORTH of the cluster's pairs, as texts made of the same
    passages have, and not those of many copies of one text, which share most keys. ``members`` must be
    a checkpoint.
    """
    keys = cut(part_keys(members, similarity))
    held = cut(keys.groupBy("cluster", "key").agg(F.count("*").alias("n")).where("n > 1"))
    square = lambda n: F.col(n).cast("double") * F.col(n)
    cost = held.groupBy("cluster").agg(F.sum(square("n")).alias("apart"))
    whole = members.groupBy("cluster").agg(F.count("*").alias("all"))
    loose = cut(whole.join(cost, "cluster", "left").where(F.coalesce("apart", F.lit(0.0)) < WORTH * square("all")).select("cluster"))
    if loose.isEmpty():
        release(keys, held)
        return members.select("cluster", "node", "size", "shared")
    dense = members.join(loose, "cluster", "left_anti").select("cluster", "node", "size", "shared")
    groups = cut(keys.join(loose, "cluster", "left_semi").join(held.select("cluster", "key"), ["cluster", "key"]).select("key", "node"))
    release(keys, held)
    apart = groups.join(members.select("node", "size", "shared"), "node").select(F.col("key").alias("cluster"), "node", "size", "shared")
    return dense.unionByName(apart)
