import hashlib
import math
import random

import pytest

from cuebreaks.llm import centroids
from cuebreaks.sources.staging import Stage

SCHEMA = "vec_id long, embedding array<float>"


def plain(rows, clusters, rounds, dimensions, scale=64):
    kept = [
        (i, [math.floor(scale * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)
    ]
    named = lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    found = [v for _, v in sorted(kept, key=named)[:clusters]]
    away = lambda v, c: sum((x - y) ** 2 for x, y in zip(v, c))

    def assigned():
        return [min(range(len(found)), key=lambda j: (away(v, found[j]), j)) for _, v in kept]

    for _ in range(rounds):
        own = assigned()
        for j in range(len(found)):
            members = [v for (_, v), k in zip(kept, own) if k == j]
            if members:
                found[j] = [sum(column) // len(members) for column in zip(*members)]
    own = assigned()
    gap = [away(v, found[j]) for (_, v), j in zip(kept, own)]
    inertia = [sum(g for g, k in zip(gap, own) if k == j) for j in range(len(found))]
    return [
        (i, j, g, inertia[j], sum(inertia), found[j]) for (i, _), j, g in zip(kept, own, gap)
    ]


def told(frame):
    names = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]
    return sorted((tuple(r) for r in frame.select(names).collect()), key=repr)


def vectors(seed, n, dimensions):
    rng = random.Random(seed)
    return [(k, [rng.choice([-1, 0, 1]) * rng.randrange(5) + rng.randrange(64) / 64 for _ in range(dimensions)]) for k in range(n)]


@pytest.mark.parametrize("seed, clusters, rounds", [(1, 4, 3), (2, 7, 5), (3, 1, 2), (4, 16, 0)])
def test_against_brute_force(spark, seed, clusters, rounds):
    rows = vectors(seed, 120, 3)
    found = centroids.cluster(spark.createDataFrame(rows, SCHEMA), clusters, rounds, 3)
    assert told(found) == sorted(plain(rows, clusters, rounds, 3), key=repr)


def test_odd_rows_ties_and_copies(spark):
    rows = vectors(5, 40, 2) + [(7, [0.0, 0.0])] * 30 + [(None, [1.0, 1.0]), (None, [1.0, 1.0]), (None, [-1.0, 2.0])]
    bad = [(90, None), (91, []), (92, [1.0]), (93, [1.0, 2.0, 3.0]), (94, [1.0, None]), (95, [float("nan"), 0.0])]
    bad += [(96, [float("inf"), 0.0]), (97, [0.0, float("-inf")])]
    frame = spark.createDataFrame(rows + bad, SCHEMA)
    for name in ("v", "norm", "dots", "cluster", "distance", "centroid", "h"):
        frame = frame.selectExpr("*", f"'own {name}' AS {name}")
    found = told(centroids.cluster(frame, 5, 3, 2))
    assert found == sorted(plain(rows + bad, 5, 3, 2), key=repr) and len(found) == len(rows)


def test_fewer_vectors_than_clusters_and_empty_table(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 1.0])]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert told(centroids.cluster(frame, 16, 3, 2)) == sorted(plain(rows, 16, 3, 2), key=repr)
    assert centroids.cluster(frame, 16, 3, 64).count() == 0
    assert centroids.cluster(spark.createDataFrame([], SCHEMA)).columns == centroids.cluster(frame, 1, 1, 2).columns


def test_components_too_large_are_refused(spark):
    frame = spark.createDataFrame([(1, [1e30, 0.0])], SCHEMA)
    with pytest.raises(Exception, match="beyond"):
        centroids.cluster(frame, 2, 1, 2).collect()


def test_only_changed_components_are_followed():
    before, after = [[1, 2, 3], [4, 5, 6], [7, 8, 9]], [[1, 2, 3], [4, 0, 6], [8, 8, 7]]
    changes = [(j, at.tolist(), d.tolist()) for j, at, d in centroids._changes(before, after)]
    assert changes == [(1, [1], [-5]), (2, [0, 2], [1, -2])]


def test_matrix_before_is_freed(spark):
    stage = Stage(spark)
    found = centroids.cluster(spark.createDataFrame(vectors(9, 50, 3), SCHEMA), 4, 3, 3, stage=stage)
    assert sum(written is not None for _, written in stage._written) == 1
    assert found.count() == 50
