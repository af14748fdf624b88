"""Exact integer k-means, with an n-simplex projection in front of the comparisons.

Vectors are turned into whole numbers once, and their distances to a few pivots are kept with them.
From these distances alone a vector becomes an apex: its coordinates along the simplex of the
pivots and its height above it. The plain distance of two apexes is never more than the true
distance, and the distance with one apex mirrored below the simplex is never less. A centroid
whose lower bound is above the least upper bound of all centroids cannot be the nearest; only the
others are compared, in whole numbers. The bounds carry a slack far above their rounding, so the
filter changes no result.

A round reads the table once, and each task sends one sum per centroid and component; the driver
sees these sums over all tasks (``clusters * dims`` numbers) and the centroids, nothing else.
Sums are cut into limbs of 60 bits, so that no size of component can overflow.

Defined cases: vectors that are null, of another length, or with a component that is null, not
finite, or not finite once scaled, take no part and are not returned; with fewer vectors than
centroids there are as many centroids as vectors; vectors with the same hash (repeated ids, null ids)
go by their components; repeated rows are vectors each; an empty cluster keeps its centroid;
distances and sums beyond a long are given as the largest long; further columns are not read;
an empty table gives an empty one.
"""

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremora.llm.common import small_batches
from tremora.session import written

CLUSTERS, ROUNDS, DIMS, SCALE = 16, 3, 64, 64
#: Reference vectors of the projection.
PIVOTS = 8
#: Rows per Arrow batch.
BATCH = 2048
_LARGEST = 2 ** 63 - 1
_LIMB = 60


def usable(vector: Column, dims: int = DIMS, scale: int = SCALE) -> Column:
    """Whether a vector takes part: its length, and every component finite, scaled too."""
    def finite(x: Column) -> Column:
        y = x.cast("double") * scale
        return x.isNotNull() & ~F.isnan(y) & (F.abs(y) < F.lit(float("inf")))
    return F.coalesce((F.size(vector) == dims) & F.forall(vector, finite), F.lit(False))


def small(dims: int) -> int:
    """Components up to here keep squared distances of ``dims`` components within a long."""
    return math.isqrt(2 ** 62 // max(1, dims)) // 2


def whole(values: np.ndarray) -> np.ndarray:
    """Doubles without fraction as whole numbers: 64-bit ones, or Python's if they are large."""
    if np.abs(values).max(initial=0) <= small(values.shape[1]):
        return values.astype(np.int64)
    return np.array([[int(x) for x in row] for row in values], dtype=object)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    gap = a - b
    return (gap * gap).sum(-1)


class Simplex:
    """The simplex of some pivots, in coordinates in which pivot k has k numbers that count.

    Pivots that lie (nearly) within the simplex of those before add nothing but rounding, and are
    left out; the first one is always in."""

    def __init__(self, pivots: np.ndarray, least: float = 1e-2) -> None:
        rows = [np.array([float(x) for x in p]) for p in pivots]
        self.pivots, axes, corners = rows[:1], [], [np.zeros(0)]
        reach = max((np.linalg.norm(r - rows[0]) for r in rows), default=0.0)
        for row in rows[1:]:
            rest, along = row - rows[0], []
            for axis in axes:
                along.append(float(rest @ axis))
                rest = rest - along[-1] * axis
            height = float(np.linalg.norm(rest))
            if height > least * reach:
                axes.append(rest / height)
                self.pivots.append(row)
                corners.append(np.array([*along, height]))
        self.corners = corners

    def distances(self, vectors: np.ndarray) -> np.ndarray:
        """Squared distances to the pivots, one column each."""
        data = vectors.astype(np.float64)
        return np.stack([squared(data, p) for p in self.pivots], 1)

    def apexes(self, distances: np.ndarray) -> np.ndarray:
        """Coordinates from squared distances to the pivots alone; the last one is the height."""
        first = distances[:, 0]
        at = np.zeros((len(distances), len(self.pivots)))
        used = np.zeros(len(distances))
        for k, corner in enumerate(self.corners[1:]):
            inner = (first - distances[:, k + 1] + corner @ corner) / 2
            at[:, k] = (inner - at[:, :k] @ corner[:k]) / corner[k]
            used += at[:, k] ** 2
        at[:, -1] = np.sqrt(np.maximum(first - used, 0.0))
        return at


def bounds(one: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the squared distances between two sets of apexes, with slack."""
    base = ((one[:, None, :-1] - other[None, :, :-1]) ** 2).sum(2)
    heights, tops = one[:, None, -1], other[None, :, -1]
    slack = 1.0 + 1e-6 * ((one ** 2).sum(1)[:, None] + (other ** 2).sum(1)[None, :])
    return base + (heights - tops) ** 2 - slack, base + (heights + tops) ** 2 + slack


def nearest(vectors: np.ndarray, apexes: np.ndarray, centroids: np.ndarray,
            tops: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest centroid of each vector (ties: the smaller number), its squared distance, and
    how many pairs were compared in whole numbers."""
    low, high = bounds(apexes, tops)
    row, number = np.nonzero(~(low > high.min(1)[:, None]))  # what is no number stays in, too
    if vectors.dtype != centroids.dtype:
        vectors, centroids = vectors.astype(object), centroids.astype(object)
    exact = squared(vectors[row], centroids[number])
    order = np.lexsort((number, row)) if exact.dtype == object else np.lexsort((number, exact, row))
    best, far = np.zeros(len(vectors), np.int64), np.zeros(len(vectors), exact.dtype)
    if exact.dtype == object:
        seen: dict = {}
        for k in order:
            if row[k] not in seen or exact[k] < seen[row[k]][0]:
                seen[row[k]] = (exact[k], number[k])
        for r, (d, c) in seen.items():
            best[r], far[r] = c, d
    else:
        first = order[np.r_[True, row[order][1:] != row[order][:-1]]] if len(order) else order
        best[row[first]], far[row[first]] = number[first], exact[first]
    return best, far, len(row)


def limbs(value: int) -> list[int]:
    """A whole number in base 2**60, smallest part first; all but the last are not negative."""
    out = []
    while not -2 ** 62 < value < 2 ** 62:
        out.append(value & (2 ** _LIMB - 1))
        value >>= _LIMB
    return [*out, value]


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """A list column as doubles; the arrays of a batch need not start at its first value."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """``vec_id, units``: the vectors that take part, floored after scaling (doubles without
    fraction, which hold every such number exactly)."""
    scaled = F.transform(F.col(vector_col), lambda x: F.rint(x.cast("double") * scale) - F.when(
        F.rint(x.cast("double") * scale) > x.cast("double") * scale, 1.0).otherwise(0.0))
    return vectors.where(usable(F.col(vector_col), dims, scale)).select(
        F.col(id_col).alias("vec_id"), scaled.alias("units"))


def first_by_hash(units: DataFrame, prefix: str, count: int) -> np.ndarray:
    """The vectors with the smallest hash of prefix and id, in that order."""
    mark = F.sha2(F.concat(F.lit(prefix), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = units.orderBy(mark, "units").limit(count).select("units").collect()
    return whole(np.array([r.units for r in rows], np.float64)) if rows else np.zeros((0, 0), np.int64)


def with_distances(units: DataFrame, simplex: Simplex, dims: int = DIMS) -> DataFrame:
    """``vec_id, units, cached``: the vectors with their squared distances to the pivots."""
    small_batches(units.sparkSession, BATCH)
    kind = units.schema["vec_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            found = simplex.distances(_matrix(batch.column(1), dims))
            lists = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), found.shape[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), lists.cast(pa.list_(pa.float64()))],
                ["vec_id", "units", "cached"])

    return units.mapInArrow(run, f"vec_id {kind}, units array<double>, cached array<double>")


def _tops(centroids: np.ndarray, simplex: Simplex) -> np.ndarray:
    return simplex.apexes(simplex.distances(centroids))


def cluster_sums(table: DataFrame, centroids: np.ndarray, simplex: Simplex,
                 dims: int = DIMS) -> DataFrame:
    """``cluster, component, limb, value``: sums of the vectors nearest to each centroid; component
    -1 is their number."""
    tops, count = _tops(centroids, simplex), len(centroids)

    def run(batches):
        totals = [[0] * dims for _ in range(count)]
        sizes = [0] * count
        for batch in batches:
            vectors = whole(_matrix(batch.column(1), dims))
            apexes = simplex.apexes(_matrix(batch.column(2), len(simplex.pivots)))
            best = nearest(vectors, apexes, centroids, tops)[0]
            for c in np.unique(best).tolist():
                members = vectors[best == c]
                sizes[c] += len(members)
                totals[c] = [a + int(b) for a, b in zip(totals[c], members.sum(0))]
        rows = [(c, k, place, part) for c in range(count) if sizes[c]
                for k, value in [(-1, sizes[c]), *enumerate(totals[c])]
                for place, part in enumerate(limbs(value))]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], t) for k, t in enumerate(
                (pa.int32(), pa.int32(), pa.int32(), pa.int64()))],
            ["cluster", "component", "limb", "value"])

    parts = table.mapInArrow(run, "cluster int, component int, limb int, value bigint")
    return parts.groupBy("cluster", "component", "limb").agg(
        F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))


def moved(centroids: np.ndarray, sums: list) -> np.ndarray:
    """The floored means; a centroid without members stays."""
    totals: dict = {}
    for cluster, component, limb, value in sums:
        key = (cluster, component)
        totals[key] = totals.get(key, 0) + (int(value) << (_LIMB * limb))
    out = [[int(x) for x in row] for row in centroids]
    for c in range(len(out)):
        size = totals.get((c, -1), 0)
        if size:
            out[c] = [totals.get((c, k), 0) // size for k in range(len(out[c]))]
    limit = small(len(out[0]))
    fits = all(abs(x) <= limit for row in out for x in row)
    return np.array(out, dtype=np.int64 if fits else object)


def assigned(table: DataFrame, centroids: np.ndarray, simplex: Simplex,
             dims: int = DIMS) -> DataFrame:
    """``vec_id, cluster, distance`` of every vector, and how many exact comparisons its batch
    took (``compared``, on the batch's first row)."""
    kind = table.schema["vec_id"].dataType.simpleString()
    tops = _tops(centroids, simplex)

    def run(batches):
        for batch in batches:
            best, far, pairs = nearest(
                whole(_matrix(batch.column(1), dims)),
                simplex.apexes(_matrix(batch.column(2), len(simplex.pivots))), centroids, tops)
            far = [min(int(d), _LARGEST) for d in far]
            taken = [pairs] + [0] * (len(far) - 1) if len(far) else []
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(best, pa.int32()), pa.array(far, pa.int64()),
                 pa.array(taken, pa.int64())], ["vec_id", "cluster", "distance", "compared"])

    return table.mapInArrow(run, f"vec_id {kind}, cluster int, distance bigint, compared bigint")


def _as_long(total: Column) -> Column:
    return F.least(total, F.lit(_LARGEST).cast("decimal(38,0)")).cast("long")


def clusters(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS,
             scale: int = SCALE, pivots: int = PIVOTS, id_col: str = "vec_id",
             vector_col: str = "embedding") -> DataFrame:
    """One row per vector that takes part: ``vec_id, cluster, distance, cluster_inertia, inertia,
    centroid_sha256``."""
    spark = vectors.sparkSession
    units = written(integer_vectors(vectors, id_col, vector_col, dims, scale), "units")
    centroids = first_by_hash(units, "1:", k)
    if not len(centroids):
        return units.select("vec_id", F.lit(0).alias("cluster"), *[
            F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")],
            F.lit("").alias("centroid_sha256"))
    simplex = Simplex(first_by_hash(units, "pivot:", pivots))
    table = written(with_distances(units, simplex, dims), "unit-distances")
    for _ in range(rounds):
        centroids = moved(centroids, [tuple(r) for r in cluster_sums(
            table, centroids, simplex, dims).collect()])
    rows = written(assigned(table, centroids, simplex, dims), "assigned")
    digests = [(c, hashlib.sha256(",".join(str(int(x)) for x in row).encode()).hexdigest())
               for c, row in enumerate(centroids)]
    # a row per cluster, k at most
    sums = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum"))
    all_in_all = sums.agg(F.sum("sum")).scalar()
    named = sums.join(F.broadcast(spark.createDataFrame(digests, "cluster int, centroid_sha256 string")),
                      "cluster").select("cluster", _as_long(F.col("sum")).alias("cluster_inertia"),
                                        _as_long(all_in_all).alias("inertia"), "centroid_sha256")
    return rows.join(F.broadcast(named), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
