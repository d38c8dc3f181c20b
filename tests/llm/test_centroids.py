import hashlib
from math import floor, inf, nan

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from hypothesis.extra.numpy import arrays

from policy_mart.llm import centroids, queries

from .frames import rows_of

SCHEMA = "vec_id long, embedding array<double>, cluster string, distance int, point string, key int"
COLUMNS = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
DATA = "/root/testdata/sf0.001"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "c", 1, "p", 2) for i, v in rows], SCHEMA).repartition(3)


def by_hand(rows, s):
    """Rows (key, vector) clustered with whole numbers, one distance at a time."""
    kept = [
        (i, [floor(s.scale * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == s.dimensions and all(x is not None and abs(x) < inf for x in v)
    ]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{s.seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    middle = [v for _, v in order[: s.centroids]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m, strict=True)), c) for c, m in enumerate(middle))

    for _ in range(s.rounds):
        of = [nearest(v)[1] for _, v in kept]
        for c in range(len(middle)):
            mine = [v for (_, v), o in zip(kept, of, strict=True) if o == c]
            if mine:
                middle[c] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    last = [(i, *nearest(v)) for i, v in kept]
    total = sum(d for _, d, _ in last)
    return [
        (i, c, d, sum(e for _, e, o in last if o == c), total, hashlib.sha256(",".join(map(str, middle[c])).encode()).hexdigest())
        for i, d, c in last
    ]


def test_query_against_definition(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = queries.QUERIES["op13_bisectors"](spark, DATA)
    assert rows_of(got, *COLUMNS) == sorted(by_hand(rows, centroids.Settings()), key=repr)


def test_ties_repeated_rows_and_unsound_vectors(spark):
    r = np.random.default_rng(3)
    s = centroids.Settings(dimensions=2, centroids=6, rounds=3, scale=2)
    rows = [(i, (r.integers(-6, 6, 2) / 2).tolist()) for i in range(200)]
    rows += [(900, None), (901, []), (902, [1.0]), (903, [1.0, None]), (904, [nan, 1.0]), (905, [inf, 0.0]), (906, [1.0, 2.0, 3.0])]
    rows += [(907, [-0.25, 0.25])] * 5 + [(None, [1.0, 1.0]), (None, [2.0, -1.0]), (908, [0.0, 0.0]), (908, [5.0, 5.0])]
    assert rows_of(centroids.cluster(frame(spark, rows), settings=s), *COLUMNS) == sorted(by_hand(rows, s), key=repr)


def test_fewer_vectors_than_centroids_and_none(spark):
    s = centroids.Settings(dimensions=3)
    rows = [(i, [float(i), 0.0, 1.0]) for i in range(4)]
    assert rows_of(centroids.cluster(frame(spark, rows), settings=s), *COLUMNS) == sorted(by_hand(rows, s), key=repr)
    for nothing in ([], [(1, None)]):
        got = centroids.cluster(frame(spark, nothing), settings=s)
        assert got.columns == COLUMNS and got.collect() == []


def test_a_cluster_that_empties_keeps_its_centroid(spark):
    """Equal first centroids: the larger number gets no vector."""
    s = centroids.Settings(dimensions=1, centroids=5, rounds=4)
    rows = [(1, [0.0])] * 4 + [(2, [9.0]), (3, [8.0])]
    got = centroids.cluster(frame(spark, rows), settings=s)
    assert rows_of(got, *COLUMNS) == sorted(by_hand(rows, s), key=repr)
    assert got.select("cluster").distinct().count() < 5


def test_large_components(spark):
    s = centroids.Settings(dimensions=2, centroids=2, scale=1)
    top = float(centroids.LARGEST)
    rows = [(1, [top, -top]), (2, [-top, top]), (3, [top, top]), (4, [0.0, 0.0])]
    assert rows_of(centroids.cluster(frame(spark, rows), settings=s), *COLUMNS) == sorted(by_hand(rows, s), key=repr)
    with pytest.raises(ArithmeticError):
        centroids.cluster(frame(spark, [(1, [2 * top, 0.0])]), settings=s)


@settings(max_examples=100, deadline=None)
@given(arrays(np.int64, (7, 3), elements=st.integers(-4, 4)), arrays(np.int64, (20, 3), elements=st.integers(-4, 4)))
def test_tournament_finds_the_nearest_with_the_smallest_number(middle, points):
    distances = ((points[:, None, :] - middle[None, :, :]) ** 2).sum(axis=2)
    assert centroids.nearest(points, *centroids.bisectors(middle)).tolist() == distances.argmin(axis=1).tolist()
