"""Keys of parts against all pairs of similar sets."""

import random

import numpy as np
import pytest

from geoframe.llm import parts
from geoframe.llm.common import cut


def similar(a, b, similarity):
    both = len(a & b)
    return both >= similarity * (len(a) + len(b) - both) - 1e-9


@pytest.mark.parametrize("similarity", [0.8, 0.6, 0.9])
def test_similar_sets_share_a_key(similarity):
    """Also at the very threshold, with elements of their own, and of neighbouring size classes."""
    random.seed(int(similarity * 100))
    close = 0
    for _ in range(4000):
        n = random.choice([1, 2, 3, 4, 5, 9, 10, 24, 25, 26, 60, 130])
        a = {random.getrandbits(63) for _ in range(n)}
        lost = random.randrange(0, int((1 - similarity) * n) + 2)
        b = set(random.sample(sorted(a), max(0, n - lost))) | {random.getrandbits(63) for _ in range(random.randrange(0, int((1 - similarity) / similarity * n) + 2))}
        if not b or not similar(a, b, similarity):
            continue
        close += 1
        # of what only one of the two has, some is shared with third sets and some is not
        only = sorted(a ^ b)
        third = set(random.sample(only, random.randrange(len(only) + 1)))
        one, two = (parts.keys_of(len(x), np.array(sorted(x & (a & b | third)), np.int64), similarity) for x in (a, b))
        assert len(np.intersect1d(one, two))
    assert close > 500


def test_loose_clusters_fall_apart_and_dense_ones_stay(spark):
    random.seed(1)
    sentences = [[random.getrandbits(63) for _ in range(10)] for _ in range(200)]
    texts = [sorted({x for s in random.sample(sentences, 10) for x in s}) for _ in range(600)]
    twins = [sorted({*t[:-8], *(random.getrandbits(63) for _ in range(3))}) for t in texts[:20]]
    base = [random.getrandbits(63) for _ in range(100)]
    copies = [sorted({*random.sample(base, 97), *(random.getrandbits(63) for _ in range(2))}) for _ in range(150)]
    every = [(1, k, t) for k, t in enumerate(texts + twins)] + [(2, 10_000 + k, t) for k, t in enumerate(copies)]
    seen = {}
    for _, _, t in every:
        for x in t:
            seen[x] = seen.get(x, 0) + 1
    rows = [(c, k, len(t), [x for x in t if seen[x] > 1]) for c, k, t in every]
    made = parts.taken_apart(cut(spark.createDataFrame(rows, "cluster long, node long, size long, shared array<long>")), 0.8).select("cluster", "node").collect()
    groups = {}
    for r in made:
        groups.setdefault(r.cluster, set()).add(r.node)
    assert groups.pop(2) == set(range(10_000, 10_150)) and 1 not in groups
    assert all(any({k, 600 + k} <= g for g in groups.values()) for k in range(20))
    assert sum(len(g) ** 2 for g in groups.values()) < 0.1 * 620**2
    assert parts.taken_apart(cut(spark.createDataFrame([], "cluster long, node long, size long, shared array<long>")), 0.8).count() == 0


def test_what_is_sent_grows_with_the_texts(spark):
    """Texts of ten sentences out of 200, none of them alike: the square of their number would be four times as many sets; a set has a bounded number of keys."""
    random.seed(4)
    sentences = [[random.getrandbits(63) for _ in range(10)] for _ in range(200)]

    def sent(n):
        rows = [(1, k, 100, sorted(x for s in random.sample(sentences, 10) for x in s)) for k in range(n)]
        return parts.taken_apart(cut(spark.createDataFrame(rows, "cluster long, node long, size long, shared array<long>").repartition(4)), 0.8).count()

    few, many = sent(1500), sent(3000)
    assert few < 1500 * 12 and many < 3 * few
