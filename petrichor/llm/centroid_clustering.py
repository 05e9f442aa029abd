"""Centroid clustering; the nearest centroid is found by the threshold algorithm.

For each dimension the centroids stand in a list sorted by that component. A
vector walks every list outward from its own value, one centroid of each list
per step; a centroid met for the first time gets its exact distance. The sum of
the squared steps reached last bounds the distance of every centroid not met
yet, so a vector stops once that sum is strictly more than its best distance:
at equality a centroid of smaller number may still tie. All numbers are integers.

A round sends one small table of sums per task, never vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from .phases import Phases

#: Components beyond this have squared distances that a long may not hold.
LARGEST = 1 << 21
#: Numbers in the widest array of a step.
CELLS = 1 << 22


def nearest(points: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each row's nearest centroid; the smaller number wins a tie."""
    step = max(1, CELLS // max(1, centroids.size))
    parts = [_walk(points[i : i + step], centroids) for i in range(0, len(points), step)]
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*parts))


def _walk(points: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n, (k, d) = len(points), centroids.shape
    far = np.iinfo(np.int64).max
    order = np.argsort(centroids, axis=0, kind="stable")
    lists = np.take_along_axis(centroids, order, axis=0)
    dims = np.arange(d)
    above = np.stack([np.searchsorted(lists[:, j], points[:, j]) for j in dims], axis=1) if d else np.zeros((n, 0), np.int64)
    below = above - 1
    exact = np.full((n, k), far, np.int64)
    met = np.zeros((n, k), bool)
    left = np.arange(n)
    for _ in range(k):
        x, lo, hi = points[left], below[left], above[left]
        down = np.where(lo >= 0, x - lists[np.maximum(lo, 0), dims], far)
        up = np.where(hi < k, lists[np.minimum(hi, k - 1), dims] - x, far)
        falls = down <= up
        reached = np.zeros((len(left), k), bool)
        reached[np.arange(len(left))[:, None], order[np.where(falls, lo, hi), dims]] = True
        below[left], above[left] = lo - falls, hi + ~falls
        row, centroid = np.nonzero(reached & ~met[left])
        gap = x[row] - centroids[centroid]
        exact[left[row], centroid] = np.einsum("ij,ij->i", gap, gap)
        met[left] |= reached
        frontier = np.minimum(down, up)
        left = left[np.einsum("ij,ij->i", frontier, frontier) <= exact[left].min(axis=1)]
        if not len(left):
            break
    number = exact.argmin(axis=1)
    return number, exact[np.arange(n), number]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(False).astype(np.int64).reshape(-1, width)


def _sums(centroids: np.ndarray):
    """A task's sums: (cluster, place, total), its count of vectors under place -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, d = centroids.shape
        totals = np.zeros((k, d + 1), np.int64)
        for batch in batches:
            points = _matrix(batch["x"], d)
            cluster, _ = nearest(points, centroids)
            np.add.at(totals, cluster, np.column_stack([np.ones(len(points), np.int64), points]))
        used = np.flatnonzero(totals[:, 0])
        columns = [np.repeat(used, d + 1), np.tile(np.arange(-1, d), len(used)), totals[used].ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2])], ["cluster", "place", "total"])

    return run


def _assigned(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster, distance = nearest(_matrix(batch["x"], centroids.shape[1]), centroids)
            yield pa.RecordBatch.from_arrays([batch["vec_id"], pa.array(cluster, pa.int32()), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return run


def scaled_vectors(vectors: DataFrame, width: int, scale: int) -> DataFrame:
    """(vec_id, x): the usable vectors as integers, floor(scale * component)."""
    usable = F.forall("embedding", lambda v: v.isNotNull() & (F.abs(v.cast("double")) < LARGEST))
    rows = vectors.select("vec_id", "embedding").where((F.size("embedding") == width) & F.coalesce(usable, F.lit(False)))
    return rows.select("vec_id", F.transform("embedding", lambda v: F.floor(v.cast("double") * scale).cast("int")).alias("x"))


def first_centroids(scaled: DataFrame, clusters: int) -> np.ndarray:
    """Components of the ``clusters`` vectors of smallest hash, which are all that reaches the driver."""
    hashed = scaled.where("vec_id is not null").select(F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256).alias("h"), "x")
    return np.array([r["x"] for r in hashed.orderBy("h", "x").limit(clusters).collect()], np.int64)


def moved(scaled: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: floor of the mean of their vectors, exact at any count; empty ones stay."""
    sums = scaled.select("x").mapInArrow(_sums(centroids), "cluster int, place int, total long")
    sums = sums.groupBy("cluster", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    cells = {(r["cluster"], r["place"]): int(r["total"]) for r in sums.collect()}  # clusters x (width + 1) rows at most
    out = centroids.copy()
    for cluster, place in cells:
        if place >= 0:
            out[cluster, place] = cells[cluster, place] // cells[cluster, -1]
    return out


def clustered(vectors: DataFrame, clusters: int = 16, rounds: int = 3, width: int = 64, scale: int = 64) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid) of every usable vector.

    Usable are vectors of exactly ``width`` components, none null, non-finite or
    2**21 or more in size (their squared distance may not fit a long); others, and
    null or empty ones, have no row. The first centroids are those of smallest
    sha256 of ``1:<vec_id>``; vectors that repeat a vec_id go by their components,
    each row counts, and one with null vec_id is assigned but never a first centroid.
    With fewer vectors there are fewer clusters; an empty table, or one without any
    vec_id, gives an empty one. A sum of distances that a long can't hold is null.
    Other columns are ignored.
    """
    spark = vectors.sparkSession
    phases = Phases(spark, "centroids")
    scaled = phases.land(scaled_vectors(vectors, width, scale), "scaled")
    schema = StructType([
        StructField("cluster", IntegerType()), StructField("cluster_inertia", LongType()),
        StructField("inertia", LongType()), StructField("centroid", ArrayType(LongType())),
    ])
    centroids = first_centroids(scaled, clusters)
    if not len(centroids):
        groups = spark.createDataFrame([], schema)
        return scaled.where("false").select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).join(groups, "cluster").select("vec_id", "cluster", "distance", *schema.names[1:])
    for _ in range(rounds):
        centroids = moved(scaled, centroids)
    out = StructType([scaled.schema["vec_id"], StructField("cluster", IntegerType()), StructField("distance", LongType())])
    rows = phases.land(scaled.mapInArrow(_assigned(centroids), out), "assigned")
    phases.drop(scaled)
    sums = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # a row per cluster
    sums = {r["cluster"]: int(r["s"]) for r in sums}
    held = lambda v: v if v < 1 << 63 else None
    total = held(sum(sums.values()))
    groups = spark.createDataFrame([(c, held(s), total, centroids[c].tolist()) for c, s in sums.items()], schema)
    return rows.join(F.broadcast(groups), "cluster").select("vec_id", "cluster", "distance", *schema.names[1:])
