"""Nearest centres, farthest-first seeds, k-means and cluster summaries.

Points are (point_id, features array<double>). Centres are k vectors, a number fixed by the caller,
so they travel inside the task closure; the points never leave the executors, and each pass returns
at most clusters * dimensions numbers per task.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyvein.functions.vectors import as_matrix, squared_distances
from tallyvein.session import Scratch

MOMENTS = "cluster_id int, dim int, n bigint, sum double, sumsq double"


def as_points(df: DataFrame, id_col: str, features: str) -> DataFrame:
    return df.select(F.col(id_col).alias("point_id"), F.col(features).cast("array<double>").alias("features"))


def with_nearest(points: DataFrame, centres) -> DataFrame:
    """Add cluster_id and distance of the nearest centre; the lower number wins a tie."""
    centres = np.asarray(centres, dtype=np.float64)

    @F.arrow_udf("struct<cluster_id:int,distance:double>")
    def nearest(features: pa.Array) -> pa.Array:
        squares = squared_distances(as_matrix(features), centres)
        best = squares.argmin(axis=1)
        distance = np.sqrt(squares[np.arange(len(best)), best])
        return pa.StructArray.from_arrays([pa.array(best.astype(np.int32)), pa.array(distance)], ["cluster_id", "distance"])

    found = points.withColumn("_near", nearest("features"))
    return found.select(*points.columns, "_near.cluster_id", "_near.distance")


def farthest_point(points: DataFrame, centres) -> list[float]:
    """The point whose nearest centre is farthest away; the smallest id wins a tie."""
    near = with_nearest(points, centres)
    best = near.agg(F.min(F.struct((-F.col("distance")).alias("neg"), "point_id", "features")).alias("best"))
    return list(best.first()["best"]["features"])


def farthest_first(points: DataFrame, k: int, start=None, carry: int = 16) -> list[list[float]]:
    """k seeds: a start point (the smallest id unless given), then again and again the farthest point.

    k - 1 passes over the points, one row back per pass. After every ``carry`` seeds the distance to the
    nearest of them is written beside each point, so a pass measures ``carry`` distances per point at most,
    however many seeds there are.
    """
    if start is None:
        first = points.agg(F.min_by("features", "point_id").alias("f")).first()["f"]
    else:
        first = points.where(F.col("point_id") == F.lit(start)).select("features").first()["features"]
    centres, carried = [list(first)], 0
    scratch, held = None, points.select("point_id", "features", F.lit(float("inf")).alias("near"))
    while len(centres) < k:
        if len(centres) - carried > carry:
            scratch = scratch or Scratch(points.sparkSession, "seeds")
            last = f"near-{carried}" if carried else None
            held = scratch.write(_with_carried(held, centres[carried:]), f"near-{len(centres)}")
            if last:
                scratch.drop(last)
            carried = len(centres)
        near = _with_carried(held, centres[carried:])
        best = near.agg(F.min(F.struct((-F.col("near")).alias("neg"), "point_id", "features")).alias("best"))
        centres.append(list(best.first()["best"]["features"]))
    return centres


def _with_carried(held: DataFrame, centres) -> DataFrame:
    """(point_id, features, near): the distance to the nearest of the centres, or what is carried if that is less."""
    near = with_nearest(held, centres) if centres else held.withColumn("distance", F.col("near"))
    return near.select("point_id", "features", F.least("near", "distance").alias("near"))


def _moment_rows(labels: np.ndarray, matrix: np.ndarray) -> pa.RecordBatch:
    clusters, index = np.unique(labels, return_inverse=True)
    dims = matrix.shape[1]
    sums = np.zeros((len(clusters), dims))
    squares = np.zeros((len(clusters), dims))
    np.add.at(sums, index, matrix)
    np.add.at(squares, index, matrix * matrix)
    counts = np.bincount(index, minlength=len(clusters)).astype(np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.repeat(clusters.astype(np.int32), dims)),
            pa.array(np.tile(np.arange(dims, dtype=np.int32), len(clusters))),
            pa.array(np.repeat(counts, dims)),
            pa.array(sums.reshape(-1)),
            pa.array(squares.reshape(-1)),
        ],
        names=["cluster_id", "dim", "n", "sum", "sumsq"],
    )


def _added(parts: DataFrame) -> DataFrame:
    totals = [F.sum(c).alias(c) for c in ("n", "sum", "sumsq")]
    return parts.groupBy("cluster_id", "dim").agg(*totals)


def step_moments(points: DataFrame, centres) -> DataFrame:
    """Assign and add up in one pass: (cluster_id, dim, n, sum, sumsq)."""
    centres = np.asarray(centres, dtype=np.float64)

    def fold(batches):
        for batch in batches:
            if batch.num_rows:
                matrix = as_matrix(batch.column(0))
                yield _moment_rows(squared_distances(matrix, centres).argmin(axis=1), matrix)

    return _added(points.select("features").mapInArrow(fold, MOMENTS))


def label_moments(assigned: DataFrame) -> DataFrame:
    """(cluster_id, dim, n, sum, sumsq) of points that carry a cluster_id."""

    def fold(batches):
        for batch in batches:
            if batch.num_rows:
                yield _moment_rows(batch.column(0).to_numpy(), as_matrix(batch.column(1)))

    return _added(assigned.select(F.col("cluster_id").cast("int"), "features").mapInArrow(fold, MOMENTS))


def cluster_summary(assigned: DataFrame) -> DataFrame:
    """One row per cluster: n, and sum and sumsq as arrays over the dimensions."""
    ordered = F.array_sort(F.collect_list(F.struct("dim", "sum", "sumsq")))  # one entry per dimension
    return (
        label_moments(assigned)
        .groupBy("cluster_id")
        .agg(F.max("n").alias("n"), ordered.alias("_m"))
        .select("cluster_id", "n", F.col("_m.sum").alias("sum"), F.col("_m.sumsq").alias("sumsq"))
    )


def centroids(assigned: DataFrame) -> DataFrame:
    """(cluster_id, dim, mean) of labelled points."""
    return label_moments(assigned).select("cluster_id", "dim", (F.col("sum") / F.col("n")).alias("mean"))


def kmeans_step(points: DataFrame, centres) -> list[list[float]]:
    """The means after one assignment; a centre without points stays where it is."""
    moved = np.array(centres, dtype=np.float64)
    for row in step_moments(points, centres).collect():  # at most k * dimensions rows
        moved[row["cluster_id"], row["dim"]] = row["sum"] / row["n"]
    return moved.tolist()


def centre_shift(before, after) -> float:
    """Length of the total move of all centres."""
    return float(np.linalg.norm(np.asarray(before) - np.asarray(after)))


@dataclass(frozen=True)
class KMeansResult:
    labels: DataFrame  # point_id, features, cluster_id, distance
    centres: list[list[float]]
    rounds: int


def kmeans(points: DataFrame, k: int, max_iter: int = 120, tol: float = 1e-9, start=None) -> KMeansResult:
    """Lloyd rounds from farthest-first seeds until the centres move no more than ``tol``.

    The points are persisted for the loop, as each of its passes reads them all.
    """
    held = points.select("point_id", "features").persist()
    try:
        centres = farthest_first(held, k, start)
        rounds = 0
        while rounds < max_iter:
            rounds += 1
            moved = kmeans_step(held, centres)
            shift = centre_shift(centres, moved)
            centres = moved
            if shift <= tol:
                break
    finally:
        held.unpersist()
    return KMeansResult(with_nearest(points, centres), centres, rounds)


def kmeans_parallel(points: DataFrame, k: int, max_iter: int = 20, seed: int = 28) -> DataFrame:
    """k-means|| of Spark ML, for a k too large for one pass per seed: (point_id, cluster_id)."""
    vectors = points.select("point_id", array_to_vector("features").alias("features"))
    model = KMeans(k=k, maxIter=max_iter, seed=seed, initMode="k-means||").fit(vectors)
    return model.transform(vectors).select("point_id", F.col("prediction").alias("cluster_id"))
