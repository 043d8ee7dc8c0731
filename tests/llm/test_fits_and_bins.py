"""Fits that no rates meet against least squares, packing against plain best fit, features under other kernels, and checkpoints that go."""

import os
import random
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoframe.llm import mixing, packing
from geoframe.llm.common import cut, release


def nonnegative_least_squares(a, b):
    """Lawson and Hanson's active sets: x of 0 or more with the least |a x - b|."""
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    for _ in range(10 * a.shape[1]):
        w = a.T @ (b - a @ x)
        if active.all() or w[~active].max() < 1e-12:
            return x
        active[np.argmax(np.where(active, -np.inf, w))] = True
        while True:
            z = np.zeros_like(x)
            z[active] = np.linalg.lstsq(a[:, active], b, rcond=None)[0]
            if z[active].min() > 0:
                x = z
                break
            low = active & (z <= 0)
            x = x + (x[low] / (x[low] - z[low])).min() * (z - x)
            active &= x > 1e-14
            x[~active] = 0
    return x


@pytest.mark.parametrize("targets", [(0.92, 0.05, 0.03), (0.2, 0.2, 0.6), (0.7, 0.25, 0.05)])
def test_rates_are_as_near_as_least_squares(spark, targets):
    """Reachable or not: the third domain is never over 0.4 of a text."""
    made = np.random.default_rng(7)
    p = made.dirichlet((4, 1, 0.5), 200)
    p[:, 2] = np.minimum(p[:, 2], 0.4 * (p[:, 0] + p[:, 1]) / 0.6)
    p /= p.sum(1)[:, None]
    n = made.integers(5, 500, 200)
    got = mixing.fit_rates(spark.createDataFrame([(k, int(n[k]), *map(float, p[k])) for k in range(200)], "doc_id long, n_tokens long, p0 double, p1 double, p2 double"), targets)
    reached = np.array(got.first().reached)
    a = (p * (n / n.sum())[:, None]).T
    best = a @ nonnegative_least_squares(a, np.array(targets))
    assert np.linalg.norm(reached - targets) <= np.linalg.norm(best - targets) + 1e-6


def test_targets_are_limited_by_what_is_there(spark):
    limited = mixing.attainable((0.92, 0.05, 0.03), np.array([0.9, 0.0995, 0.0005]), 4)
    assert abs(limited.sum() - 1) < 1e-12 and limited[2] == 0.002 and abs(limited[0] / limited[1] - 0.92 / 0.05) < 1e-9
    assert mixing.attainable((0.5, 0.5), np.array([0.4, 0.6]), 4).tolist() == [0.5, 0.5]
    assert np.allclose(mixing.attainable((0.1, 0.9), np.array([0.9, 0.1]), 2), [0.8, 0.2])
    members = spark.createDataFrame([(k, 10, *((0.98, 0.02) if k else (0.02, 0.98))) for k in range(500)], "doc_id long, n_tokens long, p0 double, p1 double")
    got = mixing.fit_rates(members, (0.5, 0.5), most=3).toPandas()
    assert np.abs(np.array(got.wanted[0]) - np.array(got.reached[0])).max() < 1e-6 and got.wanted[0][1] < 0.07 and got.rate.max() < 30


def best_fit(lengths, capacity):
    rooms = []
    for x in sorted(lengths, reverse=True):
        fit = [r for r in rooms if r >= x]
        if fit:
            rooms.remove(min(fit))
            rooms.append(min(fit) - x)
        else:
            rooms.append(capacity - x)
    return len(rooms)


def test_bins_are_never_more_than_best_fits():
    random.seed(9)
    for capacity, most in ((64, 64), (64, 30), (100, 45), (128, 128), (50, 26)):
        for _ in range(12):
            lengths = [random.randrange(1, most + 1) for _ in range(random.randrange(1, 300))]
            counts = np.bincount(lengths, minlength=capacity + 1)
            plan = packing.plan_bins(counts, capacity)
            placed = np.zeros(capacity + 1, np.int64)
            for items, n in plan:
                assert sum(items) <= capacity
                for x in items:
                    placed[x] += n
            assert (placed == counts).all()
            assert sum(n for _, n in plan) <= best_fit(lengths, capacity)


def test_packed_rows_may_have_any_names(spark):
    rows = spark.createDataFrame([(k % 7, 0, 1 + k % 40, f"r{k}", k, "s") for k in range(60)], "doc_id long, piece int, length long, rank string, n long, salt string").withColumn("before", F.lit("x")).withColumn("odd name", F.lit(1))
    got = packing.pack(rows, 50)
    assert got.columns == [*rows.columns, "sequence_id", "offset"] and got.count() == 60
    assert sorted(r["rank"] for r in got.collect()) == sorted(f"r{k}" for k in range(60))
    assert packing.pack(rows.limit(0), 50).count() == 0
    with pytest.raises(ValueError, match="sequence_id"):
        packing.pack(rows.withColumn("offset", F.lit(1)), 50)


FEATURES = "import sys; sys.path.insert(0, {root!r}); import hashlib, random; from geoframe.llm import audio; random.seed(3); texts = [' '.join(random.choice(['alpha', 'béta', 'x', '  ', 'zz top']) for _ in range(n)).encode() for n in (0, 3, 40, 900, 20000)]; print([audio._describe(audio.features(audio.to_wav(audio.padded(t)))) for t in texts])"


def test_features_do_not_depend_on_kernels():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    kinds = [{}, {"OPENBLAS_CORETYPE": "Sandybridge"}, {"OPENBLAS_CORETYPE": "Haswell", "OPENBLAS_NUM_THREADS": "1"}, {"NPY_DISABLE_CPU_FEATURES": "AVX512F AVX512CD AVX512_SKX"}]
    told = {subprocess.run([sys.executable, "-W", "ignore", "-c", FEATURES.format(root=root)], env=os.environ | e, capture_output=True, text=True, check=True).stdout for e in kinds}
    assert len(told) == 1


def test_released_checkpoints_are_gone(spark):
    held = cut(spark.range(5))
    file = held._jdf.queryExecution().analyzed().rdd().getCheckpointFile().get().removeprefix("file:")
    assert os.path.isdir(file) and held.count() == 5
    release(held)
    assert not os.path.exists(file)
    release(held)
