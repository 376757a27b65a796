"""Centroid clustering with N-simplex projection: a vector's stored distances to
the pivots become the coordinates of an apex over the pivots' simplex. Distances
between apexes bound the true ones from both sides, so most centroids fall out
before the exact integer comparison."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_package, slices, store

#: Centroids, rounds, components of a vector, and the factor of the integer grid.
CENTROIDS, ROUNDS, SIZE, SCALE = 16, 3, 64, 64
#: Largest integer component: squared distances of 64 of them fit a long.
LIMIT = 1 << 27
#: A pivot joins the simplex if its height over the earlier ones is this share of
#: its distance to the first, which keeps the coordinates well conditioned.
LEAST_HEIGHT = 0.05
#: Rows handled at once in a Python worker.
ROWS = 8192


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of x to those of y (few)."""
    out = np.empty((len(x), len(y)), np.int64)
    for k, c in enumerate(y):
        d = x - c
        out[:, k] = np.einsum("ij,ij->i", d, d)
    return out


class Simplex:
    """The simplex of the pivots in coordinates, built from distances alone. The
    first pivot is the origin; each next one is the apex over those before it."""

    def __init__(self, candidates: np.ndarray):
        self.pivots, self.base = candidates[:1], np.zeros((0, 0))
        self._ready()
        for p in candidates[1:]:
            top = self.apex(squared(p[None], self.pivots))[0]
            if top[-1] > LEAST_HEIGHT * float(np.sqrt(top @ top)):
                n = len(self.base)
                grown = np.zeros((n + 1, n + 1))
                grown[:n, :n], grown[n] = self.base, top
                self.base, self.pivots = grown, np.vstack([self.pivots, p])
                self._ready()

    def _ready(self) -> None:
        self.inverse = np.linalg.inv(self.base) if len(self.base) else self.base
        self.norms = (self.base ** 2).sum(1)
        condition = np.linalg.norm(self.base, 2) * np.linalg.norm(self.inverse, 2) if len(self.base) else 1.0
        #: share of the squared scale by which rounding can move a squared bound: a
        #: height is a root, so its error is the root of the error below it
        self.slack = 4 * np.sqrt(64 * np.finfo(float).eps) * condition

    def apex(self, d2: np.ndarray) -> np.ndarray:
        """Coordinates from squared distances to the pivots: the place over the
        base simplex, then the height."""
        d2 = d2.astype(float)
        flat = (self.norms + d2[:, :1] - d2[:, 1:]) / 2 @ self.inverse.T
        high = np.sqrt(np.maximum(d2[:, 0] - (flat ** 2).sum(1), 0))
        return np.column_stack([flat, high])

    def candidates(self, apexes: np.ndarray, tops: np.ndarray) -> np.ndarray:
        """Which centroids can be nearest: lower bound (heights on one side) not
        above the least upper bound (heights on opposite sides)."""
        a, c = (apexes ** 2).sum(1), (tops ** 2).sum(1)
        low = a[:, None] + c - 2 * apexes @ tops.T
        high = low + 4 * apexes[:, -1:] * tops[:, -1]
        return low <= (high.min(1) + self.slack * (a + c.max()))[:, None]


def nearest(simplex: Simplex, x: np.ndarray, apexes: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nearest centroid, ties to the smaller number; squared distance; number of
    centroids compared exactly) of each row."""
    left = simplex.candidates(apexes, simplex.apex(squared(centroids, simplex.pivots)))
    d2 = np.full(left.shape, np.iinfo(np.int64).max)
    for k in range(len(centroids)):
        at = np.flatnonzero(left[:, k])
        d2[at, k] = squared(x[at], centroids[k:k + 1])[:, 0]
    at = d2.argmin(1)
    return at, d2[np.arange(len(x)), at], left.sum(1)


def _matrix(column: pa.Array, kind) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(kind, copy=False).reshape(len(column), -1)


def project(simplex: Simplex):
    def run(batches):
        for b in (s for x in batches for s in slices([x], ROWS)):
            if b.num_rows:
                x = _matrix(b.column("x"), np.int64)
                if x.max() > LIMIT or x.min() < -LIMIT:
                    raise ValueError(f"a component is beyond {LIMIT}; squared distances would not fit a long")
                apexes = simplex.apex(squared(x, simplex.pivots))
                yield pa.record_batch([b.column("vec_id"), b.column("x"), pa.array(list(apexes), pa.list_(pa.float64()))], ["vec_id", "x", "apex"])
    return run


def partial_sums(simplex: Simplex, centroids: np.ndarray):
    """A task's count and componentwise sum of each cluster."""
    def run(batches):
        n, total = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for b in slices(batches, ROWS):
            if b.num_rows:
                x = _matrix(b.column("x"), np.int64)
                at, _, _ = nearest(simplex, x, _matrix(b.column("apex"), float), centroids)
                n += np.bincount(at, minlength=len(n))
                np.add.at(total, at, x)
        k = np.flatnonzero(n)
        yield pa.record_batch([pa.array(k, pa.int32()), pa.array(n[k]), pa.array(list(total[k]), pa.list_(pa.int64()))], ["cluster", "n", "total"])
    return run


def assign(simplex: Simplex, centroids: np.ndarray):
    def run(batches):
        for b in slices(batches, ROWS):
            if b.num_rows:
                at, d2, many = nearest(simplex, _matrix(b.column("x"), np.int64), _matrix(b.column("apex"), float), centroids)
                yield pa.record_batch([b.column("vec_id"), pa.array(at, pa.int32()), pa.array(d2), pa.array(many, pa.int32())], ["vec_id", "cluster", "distance", "compared"])
    return run


def kept(vectors: DataFrame, id_col: str, vec_col: str, size: int, scale: int) -> DataFrame:
    """(vec_id, x): vectors of ``size`` finite components on the integer grid."""
    v = F.col(f"`{vec_col}`")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    return (vectors.where((F.size(v) == size) & finite)
            .select(F.col(f"`{id_col}`").alias("vec_id"), F.transform(v, lambda c: F.floor(c.cast("double") * scale)).alias("x")))


def simplex_clusters(vectors: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS, size: int = SIZE, scale: int = SCALE,
                     id_col: str = "vec_id", vec_col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256,
    compared) of each kept row, and the final centroids. ``compared`` is the
    number of centroids left for the exact comparison in the last assignment.

    Kept are vectors of exactly ``size`` components, none null or non-finite. The
    first centroids are the kept rows with the smallest hashes of their ids, equal
    hashes (repeated ids) by vector, null ids last; with fewer rows there are
    fewer centroids. Repeated rows and ids count row by row; equal centroids and
    ties go to the smaller number, an empty cluster keeps its centroid. Other
    columns are ignored; a table without a kept row gives no row. A component
    beyond ``LIMIT`` on the grid raises an error, as distances wouldn't fit."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows = kept(vectors, id_col, vec_col, size, scale)
    kind = rows.schema["vec_id"].dataType.simpleString()
    order = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    seeds = rows.orderBy(order.asc_nulls_last(), "x").limit(centroids).collect()
    if not seeds:
        return spark.createDataFrame([], f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, compared int"), np.zeros((0, size), np.int64)
    at = np.array([r["x"] for r in seeds], np.int64)
    if np.abs(at).max() > LIMIT:
        raise ValueError(f"a component is beyond {LIMIT}; squared distances would not fit a long")
    simplex = Simplex(at)
    rows = store(rows.mapInArrow(project(simplex), f"vec_id {kind}, x array<bigint>, apex array<double>"), "apexes")
    for _ in range(rounds):
        sums = (rows.mapInArrow(partial_sums(simplex, at), "cluster int, n long, total array<bigint>")
                .select("cluster", "n", F.posexplode("total").alias("k", "s")).groupBy("cluster", "k")
                .agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect())  # centroids x size rows
        at = at.copy()
        for r in sums:
            at[r["cluster"], r["k"]] = int(r["s"]) // r["n"]
    placed = store(rows.mapInArrow(assign(simplex, at), f"vec_id {kind}, cluster int, distance long, compared int"), "assigned")
    own = {r["cluster"]: int(r["s"]) for r in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in at.tolist()]
    facts = spark.createDataFrame([(k, s, sum(own.values()), sha[k]) for k, s in own.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    out = placed.join(F.broadcast(facts), "cluster")  # at most a row for each centroid
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "compared"), at
