"""Lloyd's clustering with nearest centroids found by the threshold algorithm.

For each dimension the centroids stand in a list sorted by their component. A vector walks all lists at once, outward from its own
value, a step in each list per turn. A centroid that is met is compared in full. The sum of the squared distances at which the
walks stand bounds what has not been met yet: once it strictly exceeds the best distance found, nothing closer and no tie is left.

Vectors with exactly ``dims`` components, none null or not finite, are kept; others go. Components become floor(1024 * x); beyond
``LARGEST`` (x of 131,072) they count as that, so that squared distances fit a long. Sums of distances beyond a long are given as its
largest value. The first centroids are the kept vectors with the smallest sha256 of ``<seed>:<vec_id>`` (null: nothing behind the
colon; of rows with one id the one with the smaller components first). With fewer vectors than ``k`` there are fewer centroids;
without vectors there are no rows. Equal vectors are rows of their own. Other columns are not read.

A round reads the vectors once; each task hands on one row of sums per centroid and dimension, and k * dims sums go to the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch.llm.common import stored

DIMS, K, ROUNDS, SEED = 64, 8, 10, 3
SCALE, LARGEST = 1024, 1 << 27
#: Vectors that walk at once.
WALKERS = 2048


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, squared distance) of each vector; of equally near ones the smaller number."""
    n, dims = vectors.shape
    k = len(centroids)
    order = np.argsort(centroids, axis=0, kind="stable")
    lists = np.take_along_axis(centroids, order, 0)
    far = np.iinfo(np.int64).max
    table = np.full((n, k), far)
    high = np.empty((n, dims), np.int64)
    for d in range(dims):
        high[:, d] = np.searchsorted(lists[:, d], vectors[:, d])
    low = high - 1
    walking, at = np.arange(n), np.arange(dims)
    for _ in range(k):
        own = vectors[walking]
        below = np.where(low >= 0, own - lists[np.maximum(low, 0), at], far)
        above = np.where(high < k, lists[np.minimum(high, k - 1), at] - own, far)
        down = below <= above
        met = order[np.where(down, low, high), at]
        frontier = np.where(down, below, above)
        low, high = low - down, high + ~down
        fresh = np.zeros((len(walking), k), bool)
        fresh[np.arange(len(walking))[:, None], met] = True
        rows, numbers = np.nonzero(fresh & (table[walking] == far))
        table[walking[rows], numbers] = ((own[rows] - centroids[numbers]) ** 2).sum(1)
        left = (frontier**2).sum(1) <= table[walking].min(1)
        walking, low, high = walking[left], low[left], high[left]
        if not len(walking):
            break
    return table.argmin(1), table.min(1)


def _batches(batch: pa.RecordBatch, dims: int):
    """Runs of the batch's vectors as rows of an array, with where they begin."""
    column = batch.column("vector")
    for at in range(0, len(column), WALKERS):
        part = column.slice(at, WALKERS)
        yield at, part.flatten().to_numpy().astype(np.int64).reshape(len(part), dims)


def kept_vectors(rows: DataFrame, dims: int = DIMS) -> DataFrame:
    """vec_id and vector (whole numbers) of the rows that are kept."""
    value = F.col("embedding")
    whole = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    number = lambda x: F.greatest(F.least(F.floor(x.cast("double") * SCALE).cast("double"), F.lit(float(LARGEST))), F.lit(-float(LARGEST))).cast("int")
    kept = rows.where((F.size(value) == dims) & whole)
    return kept.select("vec_id", F.transform(value, number).alias("vector"))


def _sums(vectors: DataFrame, centroids: np.ndarray) -> dict[tuple[int, int], tuple[int, int]]:
    """(vectors, sum of components) by centroid and dimension."""
    k, dims = centroids.shape

    def run(batches):
        sums, counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for _, own in _batches(batch, dims):
                found, _ = nearest(own, centroids)
                counts += np.bincount(found, minlength=k)
                for c in np.unique(found).tolist():
                    sums[c] += own[found == c].sum(0)
        cluster, dim = np.divmod(np.arange(k * dims), dims)
        used = counts[cluster] > 0
        columns = [cluster[used], dim[used], counts[cluster][used], sums.ravel()[used]]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["cluster", "dim", "n", "total"])

    parts = vectors.select("vector").mapInArrow(run, "cluster long, dim long, n long, total long")
    whole = parts.groupBy("cluster", "dim").agg(*[F.sum(F.col(x).cast("decimal(38,0)")).alias(x) for x in ("n", "total")])
    return {(x["cluster"], x["dim"]): (int(x["n"]), int(x["total"])) for x in whole.collect()}


def first_centroids(vectors: DataFrame, k: int, seed: int, dims: int) -> np.ndarray:
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.orderBy(name, "vector").limit(k).select("vector").collect()
    return np.array([x["vector"] for x in rows], np.int64).reshape(-1, dims)


def fit(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, seed: int = SEED, dims: int = DIMS) -> np.ndarray:
    """The centroids after so many rounds; a centroid without vectors stays where it is."""
    centroids = first_centroids(vectors, k, seed, dims)
    for _ in range(rounds if len(centroids) else 0):
        centroids = centroids.copy()
        for (c, d), (n, total) in _sums(vectors, centroids).items():
            centroids[c, d] = total // n
    return centroids


def assign(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster, distance of every vector."""
    dims = centroids.shape[1]

    def run(batches):
        for batch in batches:
            parts = [nearest(own, centroids) for _, own in _batches(batch, dims)]
            if parts:
                cluster, distance = (np.concatenate(x) for x in zip(*parts, strict=True))
                columns = [batch.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(distance)]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    return vectors.mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster_vectors(rows: DataFrame, k: int = K, rounds: int = ROUNDS, seed: int = SEED, dims: int = DIMS) -> DataFrame:
    """One row per kept vector of ``rows`` (vec_id, embedding): vec_id, cluster, distance, the summed distances of its cluster and of
    all (cluster_inertia, inertia) and the centroid's components."""
    vectors = stored(kept_vectors(rows, dims), "vectors")
    centroids = fit(vectors, k, rounds, seed, dims)
    assigned = stored(assign(vectors, centroids), "assigned")
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("n")).collect()
    own = {x["cluster"]: int(x["n"]) for x in sums}
    most = (1 << 63) - 1
    named = [(c, min(n, most), min(sum(own.values()), most), [int(x) for x in centroids[c]]) for c, n in own.items()]
    known = rows.sparkSession.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return assigned.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")

