"""Nearest-centroid clustering of integer vectors, filtered in PCA-rotated coordinates.

Vectors are turned into integers once and stored beside what the filter needs: their
leading coordinates in the basis of the principal components, and the norm of what the
rotation leaves. A rotation keeps distances, so for vector x and centroid c

    |x - c|^2  >=  |head(x) - head(c)|^2 + (rest(x) - rest(c))^2

where ``rest`` is the residual norm (the two residuals differ in length by no more than
their distance). That bound needs a few coordinates instead of all. The centroid of least
bound is verified first, in integers; others are verified only where their bound does not
exceed that distance. Rotation and bounds are floating, with slack for their rounding;
every distance that decides is an integer, so results do not depend on the basis.

Each round is one pass over the stored table: every task adds up its vectors per cluster,
sums are added as decimals, and the centroids (a few rows of ``dims`` integers) come back
to the driver. No vector is shuffled but for the choice of the first centroids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.llm.frames import pieces, stored

LEADING = 12  # rotated coordinates that are stored
SAFE = 1 << 26  # components up to here are subtracted and squared in 64 bits
WIDE = 1 << 62  # components are held between -WIDE and WIDE
SCALE = 64


def integer_vectors(vectors: DataFrame, dims: int = 64, column: str = "embedding",
                    id_column: str = "vec_id") -> DataFrame:
    """``vec_id`` and ``v`` (array<bigint>): floor(64 x) of vectors of ``dims`` finite values."""
    usable = (F.size(column) == dims) & F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x)
                                                 & (F.abs(x) < float("inf")))
    whole = F.transform(column, lambda x: F.greatest(F.least(
        F.floor(x.cast("double") * SCALE), F.lit(WIDE)), F.lit(-WIDE)).cast("bigint"))
    return vectors.filter(usable).select(F.col(id_column).alias("vec_id"), whole.alias("v"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def moments(whole: DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and principal axes (columns, by falling variance), from sums added per task."""
    size = dims + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in pieces(batches, 4096):
            x = _matrix(batch.column(0), dims).astype(np.float64)
            x = np.hstack([x, np.ones((len(x), 1))])
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size * size), pa.int32()),
                                          pa.array(total.ravel())], ["cell", "value"])

    found = (whole.select("v").mapInArrow(run, "cell int, value double")
             .groupBy("cell").agg(F.sum("value").alias("value")).toPandas())
    total = np.zeros(size * size)
    total[found["cell"]] = found["value"]
    total = total.reshape(size, size)
    n = max(total[-1, -1], 1.0)
    mean = total[-1, :dims] / n
    spread = total[:dims, :dims] / n - np.outer(mean, mean)
    axes = np.linalg.eigh((spread + spread.T) / 2)[1][:, ::-1]
    return mean, axes


def rotate(whole: DataFrame, mean: np.ndarray, axes: np.ndarray,
           leading: int = LEADING) -> DataFrame:
    """The table of the rounds: ``vec_id``, ``v``, ``head`` (leading coordinates), ``rest``."""
    dims = len(mean)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 4096):
            head, rest = _rotated(_matrix(batch.column(1), dims), mean, axes, leading)
            stops = pa.array(np.arange(len(head) + 1) * leading, pa.int32())
            heads = pa.ListArray.from_arrays(stops, pa.array(head.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, heads, pa.array(rest)],
                                             ["vec_id", "v", "head", "rest"])

    kind = whole.schema["vec_id"].dataType.simpleString()
    return whole.select("vec_id", "v").mapInArrow(
        run, f"vec_id {kind}, v array<bigint>, head array<double>, rest double")


def _rotated(x: np.ndarray, mean: np.ndarray, axes: np.ndarray,
             leading: int) -> tuple[np.ndarray, np.ndarray]:
    centred = x.astype(np.float64) - mean
    turned = centred @ axes
    return turned[:, :leading], np.sqrt((turned[:, leading:] ** 2).sum(1))


class Centroids:
    """Integer centroids with their rotated form."""

    def __init__(self, rows: Sequence[Sequence[int]], mean: np.ndarray, axes: np.ndarray,
                 leading: int):
        self.rows = [tuple(map(int, r)) for r in rows]
        self.exact = np.array(self.rows, object).reshape(len(rows), len(mean))
        self.small = all(abs(v) <= SAFE for r in self.rows for v in r)
        self.int64 = self.exact.astype(np.int64)  # components lie within WIDE
        self.head, self.rest = _rotated(self.int64, mean, axes, leading)
        self.verified = 0  # distances that were computed in full

    def nearest(self, x: np.ndarray, head: np.ndarray,
                rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cluster (ties: smaller number) and exact squared distance of every vector."""
        n, k = len(x), len(self.rows)
        cluster, distance = np.zeros(n, np.int64), np.zeros(n, object)
        fits = ((np.abs(x) <= SAFE).all(1) if self.small else np.zeros(n, bool))
        for i in np.flatnonzero(~fits):  # beyond 64 bits: whole numbers of any size
            gap = self.exact - x[i].astype(object)
            distance[i], cluster[i] = min((d, j) for j, d in enumerate((gap * gap).sum(1)))
            self.verified += k
        at = np.flatnonzero(fits)
        if not len(at):
            return cluster, distance
        x, head, rest = x[at], head[at], rest[at]
        size = (head ** 2).sum(1) + rest ** 2
        own = (self.head ** 2).sum(1) + self.rest ** 2
        bound = ((head ** 2).sum(1)[:, None] - 2 * head @ self.head.T
                 + (self.head ** 2).sum(1) + (rest[:, None] - self.rest) ** 2)
        bound -= 1e-9 * (size[:, None] + own) + 1e-3  # rounding of rotation and products
        first = bound.argmin(1)
        best = self._verify(x, first)
        who = first.copy()
        for j in range(k):
            left = np.flatnonzero((bound[:, j] <= best) & (first != j))
            if len(left):
                d = self._verify(x[left], np.full(len(left), j))
                won = (d < best[left]) | ((d == best[left]) & (j < who[left]))
                best[left[won]], who[left[won]] = d[won], j
        cluster[at], distance[at] = who, best
        return cluster, distance

    def _verify(self, x: np.ndarray, which: np.ndarray) -> np.ndarray:
        self.verified += len(x)
        gap = x - self.int64[which]
        return (gap * gap).sum(1)

    def sha256(self, j: int) -> str:
        return hashlib.sha256(",".join(map(str, self.rows[j])).encode()).hexdigest()


def seeds(whole: DataFrame, k: int) -> list[list[int]]:
    """The first centroids: vectors of smallest sha256 of ``1:<vec_id>``; ties by components."""
    key = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    rows = whole.select(key.alias("key"), "v").orderBy(F.asc_nulls_last("key"), "v").limit(k)
    return [r["v"] for r in rows.collect()]


def sums(table: DataFrame, now: Centroids) -> dict[int, list[int]]:
    """New centroids of the clusters that have vectors: exact floor(sum / count)."""
    dims, leading = now.exact.shape[1], now.head.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, totals = {}, {}
        for batch in pieces(batches, 4096):
            x = _matrix(batch.column(0), dims)
            who, _ = now.nearest(x, _matrix(batch.column(1), leading), batch.column(2).to_numpy())
            exact = x if (np.abs(x) <= SAFE).all() else x.astype(object)
            for j in np.unique(who).tolist():
                part = exact[who == j]
                counts[j] = counts.get(j, 0) + len(part)
                totals[j] = totals.get(j, 0) + part.sum(0).astype(object)
        cells = [(j, d, Decimal(int(v)), counts[j]) for j, t in totals.items()
                 for d, v in enumerate(t)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([c[i] for c in cells], kind) for i, kind in
             enumerate((pa.int32(), pa.int32(), pa.decimal128(38, 0), pa.int64()))],
            ["cluster", "dim", "total", "n"])

    found = (table.select("v", "head", "rest")
             .mapInArrow(run, "cluster int, dim int, total decimal(38,0), n bigint")
             .groupBy("cluster", "dim").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
             .collect())  # clusters x dims rows
    new: dict[int, list[int]] = {}
    for r in found:
        new.setdefault(r["cluster"], [0] * dims)[r["dim"]] = int(r["total"]) // r["n"]
    return new


def assign(table: DataFrame, now: Centroids) -> DataFrame:
    """``vec_id``, ``cluster``, ``distance`` of every stored vector."""
    dims, leading = now.exact.shape[1], now.head.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 4096):
            who, far = now.nearest(_matrix(batch.column(1), dims),
                                   _matrix(batch.column(2), leading), batch.column(3).to_numpy())
            exact = pa.array([d if d < 1 << 63 else None for d in far.tolist()], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(who, pa.int32()), exact],
                ["vec_id", "cluster", "distance"])

    kind = table.schema["vec_id"].dataType.simpleString()
    return table.select("vec_id", "v", "head", "rest").mapInArrow(
        run, f"vec_id {kind}, cluster int, distance bigint")


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64,
            column: str = "embedding", id_column: str = "vec_id",
            leading: int = LEADING) -> DataFrame:
    """``vec_id``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256``.

    Vectors that are null, of another length, or hold a null or a value that is not finite
    give no row; repeated rows and ids are kept as they are and count each time; a null
    ``vec_id`` is a vector like others, last in the order of first centroids. With fewer
    than ``k`` vectors there are as many centroids as vectors; an empty table gives no
    rows. Equal distances go to the smaller number, and a cluster without vectors keeps
    its centroid. Components are held within 2^62; a distance beyond 64 bits still decides
    exactly and is shown as null. Other columns play no part.
    """
    spark = vectors.sparkSession
    whole = stored(integer_vectors(vectors, dims, column, id_column), "integer-vectors")
    kind = whole.schema["vec_id"].dataType.simpleString()
    first = seeds(whole, k)
    if not first:
        return spark.createDataFrame([], f"vec_id {kind}, cluster int, distance bigint, "
                                     "cluster_inertia bigint, inertia bigint, "
                                     "centroid_sha256 string")
    mean, axes = moments(whole, dims)
    leading = min(leading, dims)
    table = stored(rotate(whole, mean, axes, leading), "rotated-vectors")
    now = Centroids(first, mean, axes, leading)
    for _ in range(rounds):
        new = sums(table, now)
        now = Centroids([new.get(j, old) for j, old in enumerate(now.rows)], mean, axes, leading)
    assigned = stored(assign(table, now), "assigned-vectors")
    per = (assigned.groupBy("cluster")  # at most k rows
           .agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"),
                F.count_if(F.col("distance").isNull()).alias("unseen")).collect())
    inertia = {r["cluster"]: None if r["unseen"] else int(r["s"]) for r in per}
    total = None if None in inertia.values() else sum(inertia.values())
    facts = [(j, _long(s), _long(total), now.sha256(j)) for j, s in inertia.items()]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia bigint, inertia bigint, "
                                  "centroid_sha256 string")
    return (assigned.join(F.broadcast(facts), "cluster")
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                    "centroid_sha256"))


def _long(value: int | None) -> int | None:
    return value if value is not None and value < 1 << 63 else None
