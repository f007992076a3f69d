"""Exact k-means in integers, with centroids filtered by bounds in rotated coordinates.

Vectors become integers ``floor(scale * x)`` and are stored once, with their
first ``lead`` coordinates in the axes of greatest variance and the norm of
what remains.  The axes come from the covariance of all vectors: each task
sums the products of its own, and 64 rows of sums travel on.

For a vector and a centroid, the squared distance of the leading coordinates
plus the squared difference of the remaining norms is never above their true
squared distance.  In each round a vector is compared in integers with the
centroid of the least bound, then with only those whose bound, less a margin
for rounding, does not exceed the best distance found.  The integers decide,
so rotation and margin change the work and never the result.

The centroids (``k`` rows) go with the tasks; each task returns a sum and a
count for each centroid, combined before and after a shuffle of ``k`` keys.
The vectors stay where they are.

Defined cases: vectors that are null, of another length, or hold null or
non-finite components take no part.  A null id takes part, last in the
choice of first centroids; among equal ids the smaller vector goes first.
With fewer than ``k`` vectors there are as many centroids as vectors; an
empty table gives no rows.  Equal distances go to the smaller number.
Repeated rows count as often as they stand there.  Columns beside the two do
not matter, whatever their names.  Components of 2^28 or more after scaling
would overflow the distance and raise an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshard.llm.common import stored

#: components of a vector, scale of the integers, centroids, rounds, leading coordinates
DIM, SCALE, K, ROUNDS, LEAD = 64, 64, 16, 3, 8
#: share of the squared norms that rounding may take from a bound
MARGIN = 1e-9
LARGEST = 1 << 28


def integers(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """``vec_id, v``: the vectors that take part, as integers."""
    v = F.col(vector_col)
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x - x))  # an infinity minus itself is no number
    kept = vectors.where(v.isNotNull() & (F.size(v) == dim) & whole)
    return kept.select(F.col(id_col).alias("vec_id"), F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")).alias("v"))


def seeds(kept: DataFrame, k: int = K) -> list[list[int]]:
    """The first centroids: ``k`` vectors by the SHA-256 of ``1:<id>``."""
    key = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    return [list(r["v"]) for r in kept.select("v", key.alias("key")).orderBy(F.col("key").asc_nulls_last(), "v").limit(k).collect()]


def _matrix(lists: pa.Array, dim: int) -> np.ndarray:
    flat = np.asarray(lists.flatten())
    if len(flat) and max(int(flat.max()), -int(flat.min())) >= LARGEST:
        raise ValueError(f"a component of {LARGEST} or more after scaling")
    return flat.reshape(-1, dim).astype(np.int64)


def axes(kept: DataFrame, dim: int = DIM, lead: int = LEAD) -> tuple[np.ndarray, np.ndarray]:
    """Mean, and the ``lead`` axes of greatest variance (columns) over all vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, products = 0, np.zeros(dim), np.zeros((dim, dim))
        for b in batches:
            m = _matrix(b.column("v"), dim).astype(np.float64)
            n, total, products = n + len(m), total + m.sum(0), products + m.T @ m
        yield pa.RecordBatch.from_pydict({"i": list(range(dim + 1)), "n": [float(n)] * (dim + 1), "x": [total.tolist(), *products.tolist()]},
                                         schema=pa.schema([("i", pa.int32()), ("n", pa.float64()), ("x", pa.list_(pa.float64()))]))

    sums = (kept.select("v").mapInArrow(run, "i int, n double, x array<double>").groupBy("i")
            .agg(F.sum("n").alias("n"), *[F.sum(F.col("x")[j]).alias(f"x{j}") for j in range(dim)]).orderBy("i").collect())
    n = sums[0]["n"] if sums else 0
    if not n:
        return np.zeros(dim), np.eye(dim, lead)
    x = np.array([[r[f"x{j}"] for j in range(dim)] for r in sums])
    mean = x[0] / n
    _, vectors = np.linalg.eigh(x[1:] / n - np.outer(mean, mean))
    return mean, vectors[:, ::-1][:, :lead].copy()


def rotate(m: np.ndarray, mean: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Leading coordinates, and the norm of the rest."""
    d = m - mean
    y = d @ turn
    return y, np.linalg.norm(d - y @ turn.T, axis=1)


def rotated(kept: DataFrame, mean: np.ndarray, turn: np.ndarray, dim: int = DIM) -> DataFrame:
    """``vec_id, v, y, rest``: every vector with its leading coordinates and remaining norm."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            y, rest = rotate(_matrix(b.column("v"), dim), mean, turn)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(y.ravel()), turn.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("v"), lists, pa.array(rest)], names=["vec_id", "v", "y", "rest"])

    kind = kept.schema["vec_id"].dataType.simpleString()
    return kept.mapInArrow(run, f"vec_id {kind}, v array<long>, y array<double>, rest double")


def nearest(m: np.ndarray, y: np.ndarray, rest: np.ndarray, c: np.ndarray, cy: np.ndarray, crest: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of the nearest centroid of each vector, and how many pairs were verified in integers."""
    bound = (rest[:, None] - crest) ** 2 + (y**2).sum(1)[:, None] + (cy**2).sum(1) - 2 * (y @ cy.T)
    size = rest**2 + (y**2).sum(1)
    bound -= MARGIN * (size[:, None] + crest**2 + (cy**2).sum(1)) + 1e-6
    which = bound.argmin(1)
    best = ((m - c[which]) ** 2).sum(1)
    verified = len(m)
    for j in range(len(c)):
        at = np.flatnonzero((bound[:, j] <= best) & (which != j))
        verified += len(at)
        d = ((m[at] - c[j]) ** 2).sum(1)
        better = (d < best[at]) | ((d == best[at]) & (j < which[at]))
        which[at[better]], best[at[better]] = j, d[better]
    return which, best, verified


def _reader(c: list[list[int]], mean: np.ndarray, turn: np.ndarray, dim: int):
    """A function from a batch of ``rotated`` to integers, numbers and distances."""
    centres = np.array(c, np.int64)
    cy, crest = rotate(centres, mean, turn)

    def read(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        m = _matrix(b.column("v"), dim)
        y = np.asarray(b.column("y").flatten()).reshape(len(m), -1)
        which, best, _ = nearest(m, y, np.asarray(b.column("rest")), centres, cy, crest)
        return m, which, best

    return read


def assign(table: DataFrame, c: list[list[int]], mean: np.ndarray, turn: np.ndarray, dim: int = DIM) -> DataFrame:
    """``vec_id, cluster, distance`` of every row of ``rotated``."""
    read = _reader(c, mean, turn, dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, which, best = read(b)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(which.astype(np.int32)), pa.array(best)], names=["vec_id", "cluster", "distance"])

    kind = table.schema["vec_id"].dataType.simpleString()
    return table.mapInArrow(run, f"vec_id {kind}, cluster int, distance long")


def moved(table: DataFrame, c: list[list[int]], mean: np.ndarray, turn: np.ndarray, dim: int = DIM) -> list[list[int]]:
    """The centroids after one round: the floor of the mean of their vectors; one without vectors stays."""
    read = _reader(c, mean, turn, dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((len(c), dim), np.int64), np.zeros(len(c), np.int64)
        for b in batches:
            m, which, _ = read(b)
            np.add.at(total, which, m)
            count += np.bincount(which, minlength=len(c))
        at = np.flatnonzero(count).tolist()
        yield pa.RecordBatch.from_pydict({"cluster": at, "n": count[at].tolist(), "s": total[at].tolist()},
                                         schema=pa.schema([("cluster", pa.int32()), ("n", pa.int64()), ("s", pa.list_(pa.int64()))]))

    exact = lambda x: F.sum(x.cast("decimal(20,0)"))
    sums = (table.select("v", "y", "rest").mapInArrow(run, "cluster int, n long, s array<long>").groupBy("cluster")
            .agg(exact(F.col("n")).alias("n"), *[exact(F.col("s")[j]).alias(f"s{j}") for j in range(dim)]).collect())
    out = [list(x) for x in c]
    for r in sums:
        out[r["cluster"]] = [int(r[f"s{j}"]) // int(r["n"]) for j in range(dim)]
    return out


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dim: int = DIM, scale: int = SCALE,
            k: int = K, rounds: int = ROUNDS, lead: int = LEAD) -> tuple[DataFrame, list[list[int]]]:
    """``vec_id, cluster, distance`` after ``rounds`` rounds, stored, and the final centroids."""
    kept = stored(integers(vectors, id_col, vector_col, dim, scale), "kmeans-integers")
    c = seeds(kept, k)
    mean, turn = axes(kept, dim, lead)
    table = stored(rotated(kept, mean, turn, dim), "kmeans-rotated")
    if not c:
        return table.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), c
    for _ in range(rounds):
        c = moved(table, c, mean, turn, dim)
    return stored(assign(table, c, mean, turn, dim), "kmeans-assigned"), c


def centroid_digest(c: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()


def with_inertia(assigned: DataFrame, c: list[list[int]]) -> DataFrame:
    """Add the sums of distances over each cluster and over all, and each centroid's digest (``k`` rows are joined)."""
    total = {r["cluster"]: int(r["s"]) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()}
    everything = sum(total.values())
    rows = [(j, total.get(j, 0), everything, centroid_digest(x)) for j, x in enumerate(c)]
    sums = assigned.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(sums), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
