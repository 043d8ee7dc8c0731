"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation over distributed rows.

The driver holds vectors as long as an embedding, never as long as the table: every left vector is
the centred table times such a short vector, so tasks make it anew from the stored rows, and what a
step takes from the rows are sums. Steps read one checkpointed table and leave nothing on executors.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoframe.llm.common import cut, steps, table

COMPONENTS = 16
#: An entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Rows of a block, and bytes of the rows of a partition.
BLOCK, PARTITION = 1024, 4 << 20
#: A direction whose deviation is under this part of the largest counts as having none.
RANK = 1e-10
#: If less than this part of a left vector's length is left, its parts along the former ones are taken away once more.
KEPT = 0.7
SEED = 11


class Fit(NamedTuple):
    """n fitted vectors with exact sums; components in columns with their variances, falling; variance of all dimensions; of the whitened fit list the largest difference of its covariance from the identity."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    variances: np.ndarray
    total: float
    identity_error: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - sums / n for rows x of longs, rounded once."""
        return _times(x, self.n, self.sums).astype(np.float64) / max(self.n, 1)


def _times(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """n * x - sums exactly: as 64-bit numbers if all fit, else as Python's."""
    largest = max(int(np.abs(x).max(initial=0)), 1) * max(n, 1) + max((abs(s) for s in sums), default=0)
    kind = np.int64 if largest < 1 << 62 else object
    return n * x.astype(kind) - np.array(sums, kind)


def fixed_point(vectors: DataFrame, vector: str = "embedding", scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """vectors with ``x``, floor(scale * c) + shift of each entry; rows whose vector is null, empty or holds null or non-finite entries are left out.

    Rows of another length than most have (of equally many the longest) are left out, too, as they
    lie in another space.
    """
    entry: Callable[[Column], Column] = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < math.inf)
    sound = vectors.where(F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda c: F.coalesce(entry(c.cast("double")), F.lit(False))))
    widths = sound.groupBy(F.size(vector).alias("width")).count().orderBy(F.desc("count"), F.desc("width")).select("width").first()
    if widths is not None:
        sound = sound.where(F.size(vector) == widths[0])
    return sound.withColumn("x", F.transform(vector, lambda c: F.floor(c.cast("double") * scale).cast("long") + shift))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of longs, all of one length."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of x as blocks of little-endian longs."""
    for batch in steps(batches, BLOCK):
        yield pa.RecordBatch.from_arrays([pa.array([_matrix(batch.column("x")).astype("<i8").tobytes()], pa.binary())], ["block"])


class Rows:
    """The fit list as checkpointed blocks, from which sums are taken."""

    def __init__(self, fixed: DataFrame):
        distinct = cut(fixed.select("x").distinct())
        size = distinct.agg(F.count("*"), F.max(F.size("x"))).first()
        self.n, self.width = int(size[0]), int(size[1] or 0)
        parts = max(1, -(-self.n * self.width * 8 // PARTITION))
        self.blocks = cut(distinct.coalesce(parts).mapInArrow(_packed, "block binary"))
        low, high = self._summed(lambda x: np.concatenate(((x & 0xFFFF).sum(0), (x >> 16).sum(0))), 2 * self.width, "long").reshape(2, -1).astype(object) if self.n else np.zeros((2, 0), object)
        self.sums = tuple(int(a) + (int(b) << 16) for a, b in zip(low, high))

    def _summed(self, of: Callable[[np.ndarray], np.ndarray], size: int, kind: str = "double") -> np.ndarray:
        """of(rows of a block), an array of ``size`` numbers, summed over all blocks: within a task first, then by Spark."""
        width = self.width
        dtype = np.int64 if kind == "long" else np.float64

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size, dtype)
            for batch in batches:
                for block in batch.column("block"):
                    total = total + of(np.frombuffer(block.as_buffer(), "<i8").reshape(-1, width))
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.from_numpy_dtype(dtype)))], ["s"])

        parts = self.blocks.mapInArrow(task, f"s array<{kind}>")
        exact = "decimal(38,0)" if kind == "long" else "double"
        return np.array(parts.selectExpr(*(f"sum(CAST(s[{k}] AS {exact})) AS s{k}" for k in range(size))).first(), object if kind == "long" else float)

    def products(self, of: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
        """of(centred rows of a block), summed over the fit list."""
        centred = Fit(self.n, self.sums, None, None, 0.0, 0.0).centred
        return self._summed(lambda x: of(centred(x)), size)


def bidiagonalised(rows: Rows) -> tuple[np.ndarray, np.ndarray, float]:
    """(V, B, squared norm of the rows): orthonormal V in columns and upper bidiagonal B with B'B = V'X'XV, X being the centred rows.

    A step makes u = X v less its parts along all former left vectors, and from it the next v = X'u
    less its parts along all former right ones, twice where once would leave rounding behind. The left
    vectors are X G for short columns G, and X'u of what is taken away is known from V and B, so a step
    passes over the rows once, or twice where little of u is left. If nothing of a vector is left, the
    next right one is drawn anew, orthogonal to all former ones, so that V spans all dimensions also
    where deviations are equal or zero.
    """
    d = rows.width
    V, G, B = np.zeros((d, d)), np.zeros((d, d)), np.zeros((d, d))
    norm = math.sqrt(rows.products(lambda x: np.array([(x * x).sum()]), 1)[0])
    random = np.random.default_rng(SEED)

    def along(g: np.ndarray, k: int) -> tuple[np.ndarray, float, np.ndarray]:
        """For u = X g: its products with the first k left vectors, its squared length, and X'u."""
        left = G.copy()

        def of(x: np.ndarray) -> np.ndarray:
            u = x @ g
            return np.concatenate(((x @ left).T @ u, [u @ u], x.T @ u))

        found = rows.products(of, 2 * d + 1)
        return found[:k], found[d], found[d + 1 :]

    v, beta = None, 0.0
    for k in range(d):
        if v is None:
            v, beta = random.standard_normal(d), 0.0
        for _ in range(2):
            v = v - V[:, :k] @ (V[:, :k].T @ v)
        v /= np.linalg.norm(v)
        V[:, k] = v
        if k:
            B[k - 1, k] = beta
        g = v - beta * G[:, k - 1] if k else v
        for _ in range(2):
            dots, square, w = along(g, k)
            g, w = g - G[:, :k] @ dots, w - _along_left(V, B, k, dots)
            alpha = math.sqrt(max(square - dots @ dots, 0.0))
            if alpha >= KEPT * math.sqrt(square):
                break
        if alpha <= RANK * norm:
            v = None
            continue
        B[k, k] = alpha
        G[:, k] = g / alpha
        w = w / alpha - alpha * v
        for _ in range(2):
            w = w - V[:, : k + 1] @ (V[:, : k + 1].T @ w)
        beta = float(np.linalg.norm(w))
        v = w if beta > RANK * norm else None
    return V, B, norm * norm


def _along_left(V: np.ndarray, B: np.ndarray, k: int, dots: np.ndarray) -> np.ndarray:
    """X' times the first k left vectors, weighted by dots: X'u of a left vector is its row of B along V."""
    return V[:, : k + 1] @ (B[:k, : k + 1].T @ dots)


def fit(fixed: DataFrame, components: int = COMPONENTS) -> Fit:
    """The components of the distinct x vectors of ``fixed``: unit eigenvectors of their covariance, divisor n, by falling variance.

    Of each the entry of largest size is positive. Directions without variance aren't components, so
    there may be fewer, and none of one vector or of an empty table.
    """
    rows = Rows(fixed)
    nothing = Fit(rows.n, rows.sums, np.zeros((rows.width, 0)), np.zeros(0), 0.0, 0.0)
    if rows.n < 2:
        return nothing
    V, B, square = bidiagonalised(rows)
    _, deviations, right = np.linalg.svd(B)
    kept = min(components, int((deviations > RANK * deviations[0]).sum()))
    axes = V @ right[:kept].T
    axes /= np.linalg.norm(axes, axis=0)
    axes *= np.sign(axes[np.abs(axes).argmax(0), np.arange(kept)])
    found = nothing._replace(components=axes, variances=deviations[:kept] ** 2 / rows.n, total=square / rows.n)
    whiten = found.components / np.sqrt(found.variances)
    mean = rows.products(lambda x: (x @ whiten).sum(0), kept) / rows.n

    def spread(x: np.ndarray) -> np.ndarray:
        y = x @ whiten - mean
        return (y.T @ y).ravel()

    off = rows.products(spread, kept * kept).reshape(kept, kept) / rows.n - np.eye(kept)
    return found._replace(identity_error=float(np.abs(off).max()))


def whitened(fixed: DataFrame, model: Fit) -> DataFrame:
    """A row for each row of ``fixed`` and component: vec_id, component, deviation (sum of squares of n * x - sums, exact), whitened.

    Repeated rows and equal vectors give equal rows, null ids stay, other columns aren't read; an
    empty table gives no rows.
    """
    whiten = model.components / np.sqrt(model.variances)
    kept = whiten.shape[1]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, BLOCK):
            if not kept:
                continue
            x = _matrix(batch.column("x"))
            off = _times(x, model.n, model.sums)
            exact = off if off.dtype == object or int(np.abs(off).max()) ** 2 * off.shape[1] < 1 << 62 else off.astype(object)
            deviation = pa.array((exact * exact).sum(1).tolist(), pa.int64())
            rows = np.repeat(np.arange(len(x)), kept)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(rows)), pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), len(x))), deviation.take(pa.array(rows)), pa.array((model.centred(x) @ whiten).ravel())],
                ["vec_id", "component", "deviation", "whitened"],
            )

    return fixed.select(F.col("vec_id").cast("long").alias("vec_id"), "x").mapInArrow(each, "vec_id long, component int, deviation long, whitened double")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixed = fixed_point(table(spark, sf_dir, "embeddings"))
    model = fit(fixed)
    explained = F.array(*map(F.lit, (model.variances / model.total).tolist())) if len(model.variances) else F.array(F.lit(0.0))
    return whitened(fixed, model).select("vec_id", "component", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", F.element_at(explained, F.col("component")).alias("explained"), F.lit(model.identity_error).alias("identity_error"))
