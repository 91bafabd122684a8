"""Centroid clustering of whole-number vectors with scalar lookup tables.

Each component becomes the whole number floor(256 x). A round tabulates, for each dimension, the
squared difference between every whole number that occurs there and every centroid; a vector's
distances are then table rows gathered by its numbers and summed over the dimensions, in int64 and
so exactly. Rounds alternate assignment (ties: the smaller number) and componentwise floored means.

Scale: the whole-number vectors are written once, four bytes a component, and read once a round. A task emits
at most one row a cluster (its sums and count), Spark adds those up, and the driver gets k rows: the
centroids, bounded by the parameter ``k``. Nothing is shuffled by cluster or by vector, so a hot
cluster or a vector that repeats a million times is no hot key. The first centroids are a top-k by hash.

Defined cases: null lists, lists of another length, and lists with a null, NaN or infinite component
are left out; repeated rows all count; a null id is hashed as an empty text; rows with one id are
ordered by their components where they tie for a first centroid; whole numbers beyond +-2**26 count as that bound,
so that a squared distance stays a long; fewer vectors than ``k`` give fewer centroids, and none an
empty result; columns besides the two are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlens.llm.cluster import ship_code
from ticketlens.session import materialise

DIMENSIONS = 64
SCALE = 256
CLUSTERS = 40
ROUNDS = 5
SEED = 2
BOUND = 1 << 26
_BATCH = 4096  # vectors whose distances are held at once


def whole_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                  dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """``vec_id`` and ``q``, little-endian 32-bit whole numbers, of every usable vector."""
    ship_code(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x"))
    schema = T.StructType([rows.schema["vec_id"], T.StructField("q", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            right = pc.fill_null(pc.equal(pc.list_value_length(b["x"]), dimensions), False)
            b = b.filter(right)
            x = pc.list_flatten(b["x"])  # nulls turn into NaN
            x = pc.fill_null(x, float("nan")).to_numpy(zero_copy_only=False).reshape(len(b), dimensions)
            keep = np.isfinite(x).all(1)
            q = np.floor(np.clip(x[keep], -2 * BOUND, 2 * BOUND) * scale).clip(-BOUND, BOUND).astype("<i4")
            packed = pa.array([v.tobytes() for v in q], pa.binary())
            yield pa.RecordBatch.from_arrays([b["vec_id"].filter(pa.array(keep)), packed], schema.names)

    return rows.mapInArrow(run, schema)


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    raw = b"".join(x.as_py() for x in column)
    return np.frombuffer(raw, "<i4").reshape(len(column), dimensions)


def nearest(q: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) of each row: per dimension a table of the numbers that occur
    against the centroids, gathered and summed."""
    best, least = np.empty(len(q), np.int64), np.empty(len(q), np.int64)
    tables = []
    for d in range(q.shape[1]):
        occurring, place = np.unique(q[:, d], return_inverse=True)
        gap = occurring.astype(np.int64)[:, None] - centroids[None, :, d]
        tables.append((gap * gap, place))
    for lo in range(0, len(q), _BATCH):
        total = np.zeros((min(_BATCH, len(q) - lo), len(centroids)), np.int64)
        for table, place in tables:
            total += table.take(place[lo:lo + _BATCH], axis=0)
        at = total.argmin(1)  # the first of equal ones
        best[lo:lo + _BATCH] = at
        least[lo:lo + _BATCH] = total[np.arange(len(at)), at]
    return best, least


def first_centroids(whole: DataFrame, k: int = CLUSTERS, seed: int = SEED, dimensions: int = DIMENSIONS) -> np.ndarray:
    """The ``k`` vectors of least hash of their id, in the order of the hashes."""
    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = whole.select(named.alias("h"), "q").orderBy("h", "q").limit(k).collect()
    return np.array([np.frombuffer(r.q, "<i4") for r in rows], np.int64).reshape(len(rows), dimensions)


def moved(whole: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: floored means of the vectors nearest to each, empty ones as they are."""
    k, dimensions = centroids.shape
    shared = whole.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, count = np.zeros((k, dimensions), np.int64), np.zeros(k, np.int64)
        for b in batches:
            if not len(b):
                continue
            q = _matrix(b["q"], dimensions)
            of, _ = nearest(q, shared.value)
            order = np.argsort(of, kind="stable")
            hit, begin = np.unique(of[order], return_index=True)
            sums[hit] += np.add.reduceat(q[order].astype(np.int64), begin, axis=0)
            count += np.bincount(of, minlength=k)
        hit = np.flatnonzero(count)
        lists = pa.ListArray.from_arrays(np.arange(len(hit) + 1, dtype=np.int32) * dimensions, sums[hit].reshape(-1))
        yield pa.RecordBatch.from_arrays([pa.array(hit), lists, pa.array(count[hit])], ["cluster", "sums", "n"])

    parts = whole.select("q").mapInArrow(run, "cluster long, sums array<long>, n long")
    totals = parts.groupBy("cluster").agg(*(F.sum(F.col("sums")[d]).alias(f"s{d}") for d in range(dimensions)),
                                          F.sum("n").alias("n"))
    out = centroids.copy()
    for r in totals.collect():  # a row a cluster
        out[r.cluster] = np.array([r[f"s{d}"] for d in range(dimensions)]) // r.n
    return out


def assigned(whole: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``vec_id, cluster, distance`` of every vector."""
    dimensions = centroids.shape[1]
    shared = whole.sparkSession.sparkContext.broadcast(centroids)
    schema = T.StructType([whole.schema["vec_id"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                of, far = nearest(_matrix(b["q"], dimensions), shared.value)
                yield pa.RecordBatch.from_arrays([b["vec_id"], pa.array(of.astype(np.int32)), pa.array(far)], schema.names)

    return whole.mapInArrow(run, schema)


def fit(whole: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED,
        dimensions: int = DIMENSIONS) -> np.ndarray:
    """The centroids after all rounds, from :func:`whole_vectors` (written, as each round reads it)."""
    centroids = first_centroids(whole, k, seed, dimensions)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(whole, centroids)
    return centroids


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = CLUSTERS,
            rounds: int = ROUNDS, seed: int = SEED, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """Per usable vector: ``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``."""
    whole = materialise(whole_vectors(vectors, id_col, vector_col, dimensions, scale), "whole")
    centroids = fit(whole, k, rounds, seed, dimensions)
    found = materialise(assigned(whole, centroids), "assigned")
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    names = found.sparkSession.createDataFrame(list(enumerate(digests)), "cluster int, centroid_sha256 string")
    sums = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))  # a row a cluster
    total = found.agg(F.sum("distance")).first()[0]
    known = F.broadcast(sums.join(F.broadcast(names), "cluster"))  # k rows
    return found.join(known, "cluster").select("vec_id", "cluster", "distance", "cluster_inertia",
                                               F.lit(total).cast("long").alias("inertia"), "centroid_sha256")
