"""Centroid clustering on integers, nearest centroids found by a tournament of bisectors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._work import Shelf, name

#: Up to here in size, products and sums of components stay below 2 ** 63.
LARGEST = 1 << 27
#: Vectors of a batch that are compared at once.
CHUNK = 4096


@dataclass(frozen=True)
class Settings:
    """What is clustered and how."""

    dimensions: int = 64
    centroids: int = 40
    rounds: int = 5
    scale: int = 256
    seed: int = 2


def cluster(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", settings: Settings = Settings()) -> DataFrame:
    """Every sound vector's cluster and squared distance to its centroid, the sums of distances, and the centroid's hash.

    A vector is sound if it has exactly `settings.dimensions` components, none null or non-finite; others
    have no result row. A component x becomes the integer floor(scale * x). The first centroids are the
    vectors of the least sha256 of `<seed>:<key>`. A round assigns every vector to the nearest centroid
    (the smaller number of equally near ones) and moves each centroid that has vectors to the floor of
    their mean; after the last round the vectors are assigned once more. Only the centroids and their
    hyperplanes are held in one place, as many as `settings` says however many vectors there are.

    Null keys come last among the candidates for first centroids; rows of equal keys follow in the order of
    their components. Repeated rows are vectors like others. With fewer vectors than centroids each is one. Of no
    sound vectors there is no result row. Other columns are not read, whatever their names. Components
    beyond 2 ** 27 once scaled raise an error: their squared distances do not fit 64 bits.
    """
    spark = vectors.sparkSession
    shelf = Shelf(spark, "centroids")
    v = name(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    rows = vectors.filter((F.size(v) == settings.dimensions) & F.coalesce(finite, F.lit(False)))
    scaled = F.transform(v.cast("array<double>"), lambda x: F.floor(x * settings.scale))
    points = shelf.put(rows.select(name(key).alias("key"), scaled.alias("point")))
    large = points.filter(F.exists("point", lambda x: F.abs(x) > LARGEST))
    if not large.isEmpty():
        raise ArithmeticError(f"scaled components beyond {LARGEST} cannot be compared exactly in 64 bits")
    digest = F.sha2(F.concat(F.lit(f"{settings.seed}:"), F.col("key").cast("string")), 256)
    first = points.select(digest.alias("digest"), "point").orderBy(F.col("digest").asc_nulls_last(), "point").limit(settings.centroids)
    centroids = np.array([r["point"] for r in first.collect()], np.int64).reshape(-1, settings.dimensions)
    for _ in range(settings.rounds if len(centroids) else 0):
        centroids = _moved(points, centroids)
    assigned = shelf.put(_assigned(points, centroids))
    inertia = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    # A row per centroid.
    sums = inertia.withColumn("inertia", F.sum("cluster_inertia").over(Window.partitionBy()))
    hashes = spark.createDataFrame(
        [(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(centroids.tolist())],
        "cluster int, centroid_sha256 string",
    )
    facts = F.broadcast(sums.join(hashes, "cluster"))
    return shelf.last(assigned.join(facts, "cluster").select(F.col("key").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))


def bisectors(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For centroids a < b the integer normal and threshold of the plane between them.

    b is nearer to x than a exactly if normal . x > threshold; on the plane the smaller number wins.
    """
    normals = 2 * (centroids[None, :, :] - centroids[:, None, :])
    squares = (centroids * centroids).sum(axis=1)
    return normals, squares[None, :] - squares[:, None]


def nearest(points: np.ndarray, normals: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """The nearest centroid of each point: the holder meets the next number in turn, one sign test each.

    The holder's number is always below the challenger's, so a tie leaves it in place.
    """
    holder = np.zeros(len(points), np.int64)
    for challenger in range(1, len(normals)):
        side = np.einsum("ij,ij->i", normals[holder, challenger], points)
        holder[side > thresholds[holder, challenger]] = challenger
    return holder


def _chunks(batches: Iterator[pa.RecordBatch], dimensions: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK):
            part = batch.slice(at, CHUNK)
            yield part, part.column("point").flatten().to_numpy().reshape(-1, dimensions)


def _moved(points: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round: sums are added up per task, then per centroid."""
    normals, thresholds = bisectors(centroids)
    k, d = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((k, d), np.int64), np.zeros(k, np.int64)
        for _, x in _chunks(batches, d):
            own = nearest(x, normals, thresholds)
            np.add.at(total, own, x)
            count += np.bincount(own, minlength=k)
        cluster, component = np.divmod(np.arange(k * d), d)
        used = count[cluster] > 0
        cells = [cluster[used], component[used], total.ravel()[used], count[cluster][used]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cells], names=["cluster", "component", "total", "n"])

    found = points.select("point").mapInArrow(sums, "cluster bigint, component bigint, total bigint, n bigint")
    # A task's sums fit 64 bits; all tasks' may not.
    added = found.groupBy("cluster", "component").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    moved = centroids.copy()
    for r in added.collect():  # centroids x dimensions rows at most
        moved[r["cluster"], r["component"]] = int(r["total"]) // r["n"]
    return moved


def _assigned(points: DataFrame, centroids: np.ndarray) -> DataFrame:
    normals, thresholds = bisectors(centroids)
    d = centroids.shape[1]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _chunks(batches, d):
            own = nearest(x, normals, thresholds)
            away = x - centroids[own]
            cells = [part.column("key"), pa.array(own, pa.int32()), pa.array((away * away).sum(axis=1), pa.int64())]
            yield pa.RecordBatch.from_arrays(cells, names=["key", "cluster", "distance"])

    return points.mapInArrow(assign, f"key {points.schema['key'].dataType.simpleString()}, cluster int, distance bigint")
