"""Centroid clustering of whole-number vectors by an incremental distance matrix.

The squared distance of a vector to a centroid is ``|v|^2 - 2 v.c + |c|^2``. All three parts are whole numbers,
so nothing is rounded and no order of summing matters.

1. Each vector is written with ``v.c`` for every centroid: its row of the matrix.
2. A round takes the nearest centroid of each vector, sums the vectors of every cluster with map-side
   combining, and replaces the centroids. Only sums and counts, one line per cluster, reach the driver.
3. The matrix follows by the change alone: for the components of a centroid that changed, ``v.c`` grows by ``v[d]``
   times the change. A centroid that stays costs nothing, and if all stay the written matrix is the next one.

Each round's matrix is written to the shared folder and the one before it is freed, so lineage stays short. Vectors are
never shuffled, and a cluster with most of the rows is no hot group.

Defined cases: a NULL vector and one with a wrong number of components, or a component that is NULL, NaN or
infinite, is left out; a NULL ``vec_id`` counts as an empty number; rows alike count each; fewer vectors than ``clusters``
give as many centroids as there are vectors, an empty table none. A scaled component beyond 2**26 would overflow the 64
bits of the result and is refused with an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuebreaks.llm.inputs import ship_package
from cuebreaks.sources.staging import Stage

CLUSTERS = 16
ROUNDS = 3
DIMENSIONS = 64
SCALE = 64
LARGEST = 1 << 26

Centroids = list[list[int]]
MATRIX_SCHEMA = "vec_id long, v array<int>, norm long, dots array<long>, cluster int, distance long"


def whole_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """``vec_id, v``: the usable vectors, each component ``x`` as ``floor(scale * x)``."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    usable = (F.size(x) == dimensions) & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    )
    scaled = F.transform(x, lambda c: F.floor(c * scale))
    small = F.forall(x, lambda c: F.abs(c * scale) <= LARGEST)
    refused = F.raise_error(F.lit(f"a scaled component lies beyond {LARGEST}")).cast("array<int>")
    return vectors.filter(F.coalesce(usable, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(small, scaled.cast("array<int>")).otherwise(refused).alias("v"),
    )


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS, seed: int = 1) -> Centroids:
    """The ``clusters`` vectors of least id hash, in its order; equal ids go by their components."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    chosen = vectors.select(F.sha2(name, 256).alias("h"), "v").orderBy("h", "v").limit(clusters)
    return [row.v for row in chosen.collect()]  # one line per cluster


def _changes(before: Centroids | None, after: Centroids) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """``(centroid, components, differences)`` of the centroids that changed; all of them to begin with."""
    old = np.zeros((len(after), len(after[0])), "int64") if before is None else np.array(before, "int64")
    difference = np.array(after, "int64") - old
    places = [np.flatnonzero(row) for row in difference]
    return [(j, at, difference[j, at]) for j, at in enumerate(places) if len(at)]


def _matrix(state: DataFrame, before: Centroids | None, after: Centroids, dimensions: int) -> DataFrame:
    """The vectors with their products, nearest centroid and distance; ``state`` has the products for ``before``."""
    changes = _changes(before, after)
    clusters = len(after)
    squares = (np.array(after, "int64") ** 2).sum(axis=1)

    def rows(column: pa.ListArray, width: int) -> np.ndarray:
        return column.flatten().to_numpy().astype("int64").reshape(-1, width)

    def lists(matrix: np.ndarray, kind: pa.DataType) -> pa.ListArray:
        borders = pa.array(np.arange(0, matrix.size + 1, matrix.shape[1], dtype="int32"))
        return pa.ListArray.from_arrays(borders, pa.array(matrix.ravel(), kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = rows(batch.column("v"), dimensions)
            if before is None:
                norm, dots = (v * v).sum(axis=1), np.zeros((len(v), clusters), "int64")
            else:
                norm, dots = batch.column("norm").to_numpy(), rows(batch.column("dots"), clusters)
            for j, places, differences in changes:
                dots[:, j] += v[:, places] @ differences
            beyond = squares - 2 * dots  # what the squared distance adds to |v|^2
            nearest = beyond.argmin(axis=1)  # of equal ones the first
            distance = norm + beyond[np.arange(len(v)), nearest]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    lists(v, pa.int32()),
                    pa.array(norm, pa.int64()),
                    lists(dots, pa.int64()),
                    pa.array(nearest, pa.int32()),
                    pa.array(distance, pa.int64()),
                ],
                ["vec_id", "v", "norm", "dots", "cluster", "distance"],
            )

    return state.mapInArrow(run, MATRIX_SCHEMA)


def _replaced(state: DataFrame, centroids: Centroids, dimensions: int) -> Centroids:
    """Each non-empty cluster's componentwise ``floor(sum / count)``; empty ones keep theirs."""
    sums = F.array(*[F.sum(F.col("v")[d].cast("long")) for d in range(dimensions)])
    found = {r.cluster: r for r in state.groupBy("cluster").agg(sums.alias("sums"), F.count("*").alias("n")).collect()}
    return [
        [total // found[j].n for total in found[j].sums] if j in found else old for j, old in enumerate(centroids)
    ]


def _by_cluster(values: list, kind: str) -> Column:
    """The value of a row's cluster."""
    listed = F.array(*[F.lit(v) for v in values]) if values else F.array()
    return F.get(listed.cast(f"array<{kind}>"), F.col("cluster"))


def cluster(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    seed: int = 1,
    stage: Stage | None = None,
) -> DataFrame:
    """One row per usable vector of ``vectors`` (``vec_id, embedding``).

    ``vec_id, v, cluster, distance, cluster_inertia, inertia, centroid``; ``centroid`` is the final one of the cluster.
    """
    ship_package(vectors.sparkSession)
    stage = stage or Stage(vectors.sparkSession)
    usable = whole_vectors(vectors, dimensions, scale)
    centroids = first_centroids(usable, clusters, seed)
    if not centroids:
        schema = "vec_id long, v array<int>, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>"
        return vectors.sparkSession.createDataFrame([], schema)
    state = stage.write(_matrix(usable, None, centroids, dimensions), "matrix")
    for _ in range(rounds):
        after = _replaced(state, centroids, dimensions)
        if after == centroids:
            break
        moved = stage.write(_matrix(state, centroids, after, dimensions), "matrix")
        stage.drop(state)
        state, centroids = moved, after
    sums = dict(state.groupBy("cluster").agg(F.sum("distance")).collect())
    inertia = [sums.get(j, 0) for j in range(len(centroids))]
    return state.select(
        "vec_id",
        "v",
        "cluster",
        "distance",
        _by_cluster(inertia, "long").alias("cluster_inertia"),
        F.lit(sum(inertia)).cast("long").alias("inertia"),
        F.get(
            F.array(*[F.array(*[F.lit(c).cast("long") for c in row]) for row in centroids]), F.col("cluster")
        ).alias("centroid"),
    )
