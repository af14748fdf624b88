"""Exact k-means against plain Python, and the projection's bounds."""

import hashlib
import random

import numpy as np

from tremora.llm import centroids

DDL = "vec_id bigint, embedding array<float>, cluster int, distance string, units double"


def plain_means(rows, k, rounds, dims, scale):
    """``(cluster, distance)`` per usable row, and the final centroids, in Python's numbers."""
    def usable(e):
        return e is not None and len(e) == dims and all(
            x is not None and x == x and abs(x) != float("inf") for x in e)
    kept = [(i, [int(x * scale // 1) for x in map(float, e)]) for i, e in rows if usable(e)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(
        f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    middles = [v for _, v in order[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(middles))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        for n, members in groups.items():
            middles[n] = [sum(col) // len(members) for col in zip(*members)]
    return [(i, *near(v)[::-1]) for i, v in kept], middles


def vectors(seed, count, dims, size=1.0):
    r = random.Random(seed)
    centers = [[r.gauss(0, size) for _ in range(dims)] for _ in range(5)]
    return [(i, [float(np.float32(x + r.gauss(0, size / 8))) for x in r.choice(centers)])
            for i in range(count)]


def against_plain(spark, rows, k=16, rounds=3, dims=64, scale=64):
    df = spark.createDataFrame([(i, e, 7, "x", 0.5) for i, e in rows], DDL).repartition(3)
    got = centroids.clusters(df, k, rounds, dims, scale).collect()
    want, middles = plain_means(rows, k, rounds, dims, scale)
    top = 2 ** 63 - 1
    sums = {}
    for _, c, d in want:
        sums[c] = sums.get(c, 0) + min(d, top)
    expected = [(i, c, min(d, top), min(sums[c], top), min(sum(sums.values()), top),
                 hashlib.sha256(",".join(map(str, middles[c])).encode()).hexdigest())
                for i, c, d in want]
    key = repr
    assert sorted((tuple(r) for r in got), key=key) == sorted(expected, key=key)


def test_clusters_equal_plain_python(spark):
    rows = vectors(1, 300, 64)
    rows += [(300, None), (301, [1.0] * 63), (302, [float("nan")] + [0.0] * 63),
             (303, [float("inf")] + [0.0] * 63), (304, [None] + [0.0] * 63), (305, []),
             (306, [0.0] * 64), (306, [0.0] * 64), (None, rows[0][1]), (None, rows[1][1])]
    rows += [rows[3]] * 4  # repeated rows
    against_plain(spark, rows)


def test_ties_few_vectors_and_empty_tables(spark):
    against_plain(spark, [(i, [float(i % 2)] * 64) for i in range(40)])
    against_plain(spark, vectors(2, 5, 64))  # fewer than centroids
    against_plain(spark, [])
    against_plain(spark, [(1, None)])


def test_components_beyond_a_long(spark):
    rows = vectors(3, 40, 64) + vectors(4, 20, 64, 1e12) + vectors(5, 10, 64, 1e30)
    against_plain(spark, [(k, e) for k, (_, e) in enumerate(rows)])


def test_bounds_hold_and_spare_comparisons():
    r = np.random.default_rng(6)
    centers = r.integers(-60, 60, (16, 64))
    data = centers[r.integers(0, 16, 2000)] + r.integers(-6, 7, (2000, 64))
    simplex = centroids.Simplex(np.r_[data[:7], data[:1]])  # one pivot twice: left out
    assert len(simplex.pivots) == 7
    apexes = simplex.apexes(simplex.distances(data))
    tops = simplex.apexes(simplex.distances(centers))
    exact = ((data[:, None] - centers[None]) ** 2).sum(2)
    low, high = centroids.bounds(apexes, tops)
    assert (low <= exact).all() and (exact <= high).all()
    best, far, compared = centroids.nearest(data, apexes, centers, tops)
    assert (best == exact.argmin(1)).all() and (far == exact.min(1)).all()
    assert compared < 0.7 * exact.size
    same = centroids.Simplex(np.r_[data[:1], data[:1]])  # one pivot only
    alone = same.apexes(same.distances(data))
    assert (centroids.nearest(data, alone, centers, same.apexes(same.distances(centers)))[0]
            == exact.argmin(1)).all()


def test_limbs():
    for value in (0, -1, 5, 2 ** 61, 2 ** 62, -2 ** 62, -2 ** 200 + 3, 10 ** 80):
        assert sum(part << (60 * k) for k, part in enumerate(centroids.limbs(value))) == value
        assert all(-2 ** 63 <= part < 2 ** 63 for part in centroids.limbs(value))
