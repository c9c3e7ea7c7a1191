from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tradewatch.llm import queries
from tradewatch.llm.centroids import cluster_vectors, nearest

SF = "/root/testdata/sf0.001"
INF, NAN = float("inf"), float("nan")


def brute(rows, k=8, rounds=10, dims=64):
    own = []
    for vec_id, x in rows:
        if x is not None and len(x) == dims and all(v is not None and np.isfinite(v) for v in x):
            whole = [max(-(1 << 27), min(1 << 27, int(np.floor(1024 * float(v))))) for v in x]
            own.append((vec_id, whole))
    order = sorted(own, key=lambda r: (sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [x for _, x in order[:k]]

    def assigned():
        return [min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), j) for j, c in enumerate(centroids)) for _, x in own]

    for _ in range(rounds):
        found = assigned()
        for j in range(len(centroids)):
            mine = [x for (_, x), (_, c) in zip(own, found, strict=True) if c == j]
            if mine:
                centroids[j] = [sum(v) // len(mine) for v in zip(*mine, strict=True)]
    found = assigned()
    sums = {j: sum(d for d, c in found if c == j) for j in range(len(centroids))}
    return sorted(
        [(v, c, d, sums[c], sum(sums.values()), centroids[c]) for (v, _), (d, c) in zip(own, found, strict=True)], key=repr
    )


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 6), st.integers(1, 5), st.integers(0, 12), st.randoms())
def test_walks_find_the_nearest(k, dims, n, rng):
    vectors = np.array([[rng.randint(-4, 4) for _ in range(dims)] for _ in range(n)], np.int64).reshape(n, dims)
    centroids = np.array([[rng.randint(-4, 4) for _ in range(dims)] for _ in range(k)], np.int64)
    number, distance = nearest(vectors, centroids)
    table = ((vectors[:, None] - centroids[None]) ** 2).sum(2)
    assert number.tolist() == table.argmin(1).tolist() and distance.tolist() == table.min(1).tolist()


@pytest.mark.parametrize("dims,k", [(3, 2), (2, 4)])
def test_against_brute_force(spark, dims, k):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in np.round(rng.normal(0, 2, dims), 1)]) for i in range(80)]
    rows += [(7, rows[7][1]), (None, [0.5] * dims), (200, None), (201, []), (202, [1.0] * (dims + 1)), (203, [None] * dims)]
    rows += [(204, [NAN] * dims), (205, [INF] * dims), (206, [1e30] * dims), (207, [-1e30] * dims)]
    df = spark.createDataFrame([(*r, 1, "c") for r in rows], "vec_id long, embedding array<double>, cluster int, vector string").repartition(3)
    got = [tuple(x) for x in cluster_vectors(df, k=k, rounds=4, dims=dims).collect()]
    assert sorted(got, key=repr) == brute(rows, k, 4, dims)


def test_few_and_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    got = cluster_vectors(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.5])], schema), k=8, dims=2).collect()
    assert sorted(x["distance"] for x in got) == [0, 0]
    assert cluster_vectors(spark.createDataFrame([], schema), k=8, dims=2).count() == 0


def test_query_against_brute_force(spark):
    rows = [(x["vec_id"], x["embedding"]) for x in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want = [(*x[:5], sha256(",".join(map(str, x[5])).encode()).hexdigest()) for x in brute(rows)]
    assert sorted(map(tuple, queries.op13_clusters(spark, SF).collect()), key=repr) == sorted(want, key=repr)
