"""Centroid clustering by equal-average, equal-variance nearest-neighbour search.

Centroids are sorted by the sum of their components.  A vector begins at its own sum and
scans outward to both sides, nearest sum first.  Two inequalities between a vector and a
centroid of k components, of sums S and deviations V = sqrt(k * sum of squares - S^2),

    k * distance >= (S - S')^2        and        k * distance >= (S - S')^2 + (V - V')^2,

reject without a distance: the first ends the whole scan, as every centroid further out has
a larger gap; the second skips one centroid.  What is left is settled by integer distances.
All of it runs on whole batches, one step of every vector's scan at a time.

Vectors are integers, so sums, means and distances are exact and alike in any order of rows.
A round reads the stored vectors once and hands back one row per centroid and task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstar.llm.common import bounded, narrow, store

DIMENSIONS = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
SEED = "1"
#: Components of this size or more have no distance that fits a long.
LIMIT = 1 << 27
#: Vectors whose scan runs at the same time: 16 MB of differences.
BLOCK = 1 << 15

VECTORS = "vec_id long, v array<int>"


def integers(column: pa.Array, scale: int, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the usable vectors in a column of lists, and their components floor(scale * x)."""
    sizes = np.diff(column.offsets.to_numpy())
    good = (sizes == dimensions) & column.is_valid().to_numpy(zero_copy_only=False)
    flat = column.values.to_numpy(zero_copy_only=False)  # nulls become nan
    starts = column.offsets.to_numpy()[:-1][good]
    x = flat[starts[:, None] + np.arange(dimensions)] if len(starts) else np.zeros((0, dimensions))
    with np.errstate(invalid="ignore", over="ignore"):
        x = np.floor(scale * x.astype(float))
    fits = (np.abs(x) < LIMIT).all(axis=1)  # false for nan and infinite ones too
    return np.flatnonzero(good)[fits], x[fits].astype(np.int64)


def _vectors(scale: int, dimensions: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x = integers(batch.column(1), scale, dimensions)
            lists = pa.ListArray.from_arrays(
                np.arange(len(rows) + 1, dtype=np.int32) * dimensions, pa.array(x.astype(np.int32).reshape(-1))
            )
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), lists], names=["vec_id", "v"])

    return run


def matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    """A column of stored vectors as rows of 64-bit integers."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions).astype(np.int64)


def _sums(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    total = x.sum(axis=1)
    spread = x.shape[1] * (x.astype(float) ** 2).sum(axis=1) - total.astype(float) ** 2
    return total, np.sqrt(np.maximum(spread, 0))


class Search:
    """Nearest centroid of many vectors; ties go to the smaller centroid number."""

    def __init__(self, centroids: np.ndarray):
        total, deviation = _sums(centroids)
        order = np.argsort(total, kind="stable")
        self.number, self.centroid = order, centroids[order]
        self.total, self.deviation = total[order], deviation[order]
        #: Distances worked out so far, of vectors times centroids possible.
        self.computed = 0

    def __call__(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(centroid number, squared distance) of each row."""
        parts = [self._block(x[k : k + BLOCK]) for k in range(0, len(x), BLOCK)]
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(side) for side in zip(*parts))

    def _block(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, k, last = len(x), x.shape[1], len(self.number)
        total, deviation = _sums(x)
        best, distance = np.full(n, last, np.int64), np.full(n, np.iinfo(np.int64).max)
        high = np.searchsorted(self.total, total)
        low = high - 1
        on = np.arange(n)
        for _ in range(last):
            t = total[on]
            below = np.where(low[on] >= 0, t - self.total[np.maximum(low[on], 0)], np.inf)
            above = np.where(high[on] < last, self.total[np.minimum(high[on], last - 1)] - t, np.inf)
            down = below <= above
            at = np.where(down, low[on], high[on])
            gap = np.where(down, below, above)
            low[on[down]] -= 1
            high[on[~down]] += 1
            # A margin far above rounding keeps equal bounds in: they may be ties.
            most = k * distance[on].astype(float) * (1 + 1e-9) + 1
            near = gap**2 <= most
            on, at, gap, most = on[near], at[near], gap[near], most[near]
            if not len(on):
                break
            try_ = gap**2 + (deviation[on] - self.deviation[at]) ** 2 * (1 - 1e-9) - 1 <= most
            rows, cols = on[try_], at[try_]
            if len(rows):
                self.computed += len(rows)
                d = ((x[rows] - self.centroid[cols]) ** 2).sum(axis=1)
                number = self.number[cols]
                won = (d < distance[rows]) | ((d == distance[rows]) & (number < best[rows]))
                best[rows[won]], distance[rows[won]] = number[won], d[won]
        return best, distance


def _partial_sums(centroids: np.ndarray):
    """Per task and centroid: how many vectors are nearest to it and their componentwise sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, size = Search(centroids), centroids.shape
        count, total = np.zeros(size[0], np.int64), np.zeros(size, np.int64)
        for batch in batches:
            x = matrix(batch.column(1), size[1])
            best, _ = search(x)
            count += np.bincount(best, minlength=size[0])
            for c in np.unique(best):
                total[c] += x[best == c].sum(axis=0)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(count[used]), pa.array(list(total[used]), pa.list_(pa.int64()))],
            names=["cluster", "n", "total"],
        )

    return run


def refine(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid replaced by floor(sum / count) of its vectors; one without vectors stays."""
    parts = bounded(vectors).mapInArrow(_partial_sums(centroids), "cluster int, n long, total array<long>")
    sums = [F.sum(F.col("total")[i]).alias(f"s{i}") for i in range(centroids.shape[1])]
    out = centroids.copy()
    for row in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *sums).collect():  # a row per centroid
        out[row.cluster] = [row[f"s{i}"] // row.n for i in range(centroids.shape[1])]
    return out


def _assigned(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(centroids)
        for batch in batches:
            best, distance = search(matrix(batch.column(1), centroids.shape[1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(best.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"]
            )

    return run


def vectors_of(table: DataFrame, scale: int = SCALE, dimensions: int = DIMENSIONS) -> DataFrame:
    """VECTORS of the usable rows of (vec_id, embedding), stored."""
    one = bounded(narrow(table, vec_id="long", embedding="array<double>"))
    return store(one.mapInArrow(_vectors(scale, dimensions), VECTORS), "vectors")


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS, seed: str = SEED) -> np.ndarray:
    """The vectors with the smallest sha256 of `seed:vec_id`, in that order."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    named = vectors.select(F.sha2(name.cast("binary"), 256).alias("hash"), "v")
    return np.array([r.v for r in named.orderBy("hash", "v").limit(clusters).collect()], np.int64)


def cluster(table: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every usable row of `table`, and the final centroids.

    Usable rows have exactly DIMENSIONS components, none null or non-finite.  (A component
    so large that its square leaves 64-bit integers, 2^21 or more before scaling, makes a
    row unusable too.)  Repeated rows each count; a null id has an empty name.  Of equal
    hashes the smaller vector comes first.  Fewer usable rows than `clusters` make fewer
    centroids; none give no rows.  Other columns are not read.
    """
    vectors = vectors_of(table)
    centroids = first_centroids(vectors, clusters)
    if not len(centroids):
        return vectors.selectExpr("vec_id", "cast(0 as int) as cluster", "0L as distance"), centroids
    for _ in range(rounds):
        centroids = refine(vectors, centroids)
    return bounded(vectors).mapInArrow(_assigned(centroids), "vec_id long, cluster int, distance long"), centroids


def clustering(table: DataFrame) -> DataFrame:
    """`cluster` with each cluster's and the whole inertia, and the digest of the final centroids.

    An inertia beyond 64 bits is null.
    """
    found, centroids = cluster(table)
    found = store(found, "assigned")
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    rows = found.groupBy("cluster").agg(exact.alias("inertia")).collect()  # a row per centroid
    whole = sum(int(r.inertia) for r in rows)
    fits = lambda x: x if x < 1 << 63 else None
    digest = lambda c: hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()
    about = [(r.cluster, fits(int(r.inertia)), fits(whole), digest(centroids[r.cluster])) for r in rows]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    each = table.sparkSession.createDataFrame(about, schema)
    return found.join(F.broadcast(each), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
