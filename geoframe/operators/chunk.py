"""Chunked arrays of several axes: cells to chunks and back, and from one chunking to another in one exchange.

A chunk is a row: keys, a ``block_`` number for each axis and row-major payload arrays. Blocks at an
axis' end are shorter. Nulls and any element type are kept, as payloads are rearranged by positions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import product
from math import prod

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

#: A chunk is one row of a task, so it has at most so many cells.
CELLS = 1 << 24


@dataclass(frozen=True)
class Grid:
    """Lengths of named axes, the slowest first, and the length of a chunk along each; -1 is the whole axis."""

    lengths: dict[str, int]
    chunk: dict[str, int]

    def __post_init__(self) -> None:
        if self.lengths.keys() != self.chunk.keys() or min([*self.lengths.values(), 1]) < 1:
            raise ValueError("each axis needs a length and a chunk length")
        if any(c < 1 and c != -1 for c in self.chunk.values()):
            raise ValueError("a chunk has a length of at least 1, or -1 for a whole axis")
        if prod(self.sizes.values()) > CELLS:
            raise ValueError(f"a chunk of {prod(self.sizes.values())} cells; at most {CELLS} fit a task")

    @property
    def axes(self) -> list[str]:
        return list(self.lengths)

    @property
    def sizes(self) -> dict[str, int]:
        return {a: n if self.chunk[a] == -1 else min(self.chunk[a], n) for a, n in self.lengths.items()}

    @property
    def blocks(self) -> list[str]:
        return [f"block_{a}" for a in self.axes]

    def block(self, axis: str) -> Column:
        """The block that an index is in."""
        return F.floor(F.col(axis) / self.sizes[axis]).cast("int")

    def extent(self, axis: str) -> Column:
        """How many indexes the chunk of this row has along an axis."""
        return F.least(F.lit(self.sizes[axis]), F.lit(self.lengths[axis]) - F.col(f"block_{axis}") * self.sizes[axis])

    def cells(self) -> Column:
        return reduce(lambda a, b: a * b, (self.extent(a) for a in self.axes), F.lit(1))

    def shape(self, block: tuple[int, ...]) -> tuple[int, ...]:
        return tuple(min(s, n - b * s) for b, s, n in zip(block, self.sizes.values(), self.lengths.values()))


def to_chunks(cells: DataFrame, grid: Grid, values: list[str], keys: list[str] | None = None) -> DataFrame:
    """Cell rows (keys, an index of each axis, values) as chunks; a chunk without any cell has no row.

    Absent cells are null. Of repeated cells the one with the largest values counts. Cells outside the
    grid, or with a null index, are left out.
    """
    keys = keys or []
    inside = reduce(lambda a, b: a & b, ((F.col(a) >= 0) & (F.col(a) < n) for a, n in grid.lengths.items()))
    blocked = cells.where(inside).select(*keys, *(grid.block(a).alias(f"block_{a}") for a in grid.axes), *(F.col(a).cast("int").alias(f"_at_{a}") for a in grid.axes), *values)
    position = F.lit(0)
    for a in grid.axes:
        position = position * grid.extent(a) + F.col(f"_at_{a}") - F.col(f"block_{a}") * grid.sizes[a]
    held = F.array_sort(F.collect_list(F.struct(position.alias("p"), *values)))
    sorted_rows = blocked.groupBy(*keys, *grid.blocks).agg(held.alias("_held")).withColumn("_n", grid.cells())
    after = lambda k: F.coalesce(F.get("_held", k + 1)["p"], F.col("_n"))

    def payload(value: str) -> Column:
        # each cell and as many nulls as there are positions up to the next one; of equal positions the last stays
        runs = F.transform("_held", lambda s, k: F.when(after(k) == s["p"], F.array().cast(f"array<{cells.schema[value].dataType.simpleString()}>")).otherwise(F.concat(F.array(s[value]), F.array_repeat(F.lit(None).cast(cells.schema[value].dataType), after(k) - s["p"] - 1))))
        return F.concat(F.array_repeat(F.lit(None).cast(cells.schema[value].dataType), F.col("_held")[0]["p"]), F.flatten(runs))

    return sorted_rows.select(*keys, *grid.blocks, *(payload(v).alias(v) for v in values))


def to_cells(chunks: DataFrame, grid: Grid, values: list[str], keys: list[str] | None = None) -> DataFrame:
    """Chunks as cell rows (keys, index of each axis, values), null cells included."""
    keys = keys or []
    flat = chunks.select(*keys, *grid.blocks, F.posexplode(F.arrays_zip(*values)).alias("_p", "_v"))
    left, out = F.col("_p"), {}
    for a in reversed(grid.axes):
        out[a] = (F.col(f"block_{a}") * grid.sizes[a] + left % grid.extent(a)).cast("int")
        left = F.floor(left / grid.extent(a)).cast("int")
    return flat.select(*keys, *(out[a].alias(a) for a in grid.axes), *(F.col(f"_v.{v}").alias(v) for v in values))


def _ranges(start: int, stop: int, size: int) -> Iterator[tuple[int, int, int]]:
    """(block, from, to) of the blocks of a size that start..stop meets."""
    for block in range(start // size, -(-stop // size)):
        yield block, max(start, block * size), min(stop, (block + 1) * size)


def rechunked(chunks: DataFrame, old: Grid, new: Grid, values: list[str], keys: list[str] | None = None) -> DataFrame:
    """The same array in chunks of another grid with the same axes, in one exchange.

    Tasks cut each old chunk into the pieces that it shares with new ones, which are what is shuffled,
    not cells; each new chunk is put together where its pieces meet. No task holds more of an axis than
    a chunk does. Cells of absent old chunks are null; a new chunk without any piece has no row.
    """
    if old.lengths != new.lengths:
        raise ValueError("both grids need the same axes")
    keys = keys or []
    fields = {f.name: f for f in chunks.schema}
    corner = [StructField(f"_{kind}_{a}", IntegerType()) for kind in ("from", "to") for a in old.axes]
    cut = StructType([*(fields[k] for k in keys), *(StructField(b, IntegerType()) for b in new.blocks), *corner, *(fields[v] for v in values)])
    made = StructType([*(fields[k] for k in keys), *(StructField(b, IntegerType()) for b in new.blocks), *(StructField(v, ArrayType(fields[v].dataType.elementType)) for v in values)])
    names, sizes = [f.name for f in cut], list(new.sizes.values())

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                block = tuple(one.column(b)[0].as_py() for b in old.blocks)
                shape, origin = old.shape(block), [b * s for b, s in zip(block, old.sizes.values())]
                at = np.arange(prod(shape)).reshape(shape)
                whole = {v: one.column(v).flatten() for v in values}
                for ranges in product(*(_ranges(o, o + n, s) for o, n, s in zip(origin, shape, sizes))):
                    inner = pa.array(at[tuple(slice(a - o, b - o) for (_, a, b), o in zip(ranges, origin))].ravel())
                    own = {v: pa.array([x.take(inner)], cut_type(one, v)) for v, x in whole.items()}
                    numbers = [pa.array([n], pa.int32()) for k in range(3) for n in (r[k] for r in ranges)]
                    yield pa.RecordBatch.from_arrays([*(one.column(k) for k in keys), *numbers, *own.values()], names)

    def cut_type(batch: pa.RecordBatch, value: str) -> pa.DataType:
        return batch.schema.field(value).type

    def joined(group: pa.Table) -> pa.Table:
        block = tuple(group.column(b)[0].as_py() for b in new.blocks)
        shape, origin = new.shape(block), [b * s for b, s in zip(block, sizes)]
        at, source, seen = np.arange(prod(shape)).reshape(shape), np.full(prod(shape), -1), 0
        for row in range(group.num_rows):
            ends = [(group.column(f"_from_{a}")[row].as_py(), group.column(f"_to_{a}")[row].as_py()) for a in new.axes]
            inner = at[tuple(slice(a - o, b - o) for (a, b), o in zip(ends, origin))].ravel()
            source[inner] = np.arange(seen, seen + len(inner))
            seen += len(inner)
        index = pa.array(source, mask=source < 0)
        first = group.slice(0, 1)
        payloads = {v: pa.array([pa.concat_arrays([c.flatten() for c in group.column(v).chunks]).take(index)], group.schema.field(v).type) for v in values}
        return pa.Table.from_arrays([*(first.column(k) for k in [*keys, *new.blocks]), *payloads.values()], names=[f.name for f in made])

    cut_up = chunks.select(*keys, *old.blocks, *values).mapInArrow(pieces, cut)
    return cut_up.groupBy(*keys, *new.blocks).applyInArrow(joined, made)
