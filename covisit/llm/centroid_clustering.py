"""Centroid clustering (Lloyd's rounds) that scans only vectors whose nearest centroid is in doubt.

Each vector carries a lower bound of its distance to every centroid but its own. When centroids move, the
bound must give way by as much as any of them may have come nearer. The full drift of the farthest
mover is more than that: a cluster's vectors lie in a sphere about its old centroid, and seen from there a
centroid comes nearer only by the part of its move that points at the sphere.

    Let c move to c', m be the middle between them, x a point, and a the angle at m between c' and x. Then
    |x - c| - |x - c'| <= |c - c'| cos(a): the difference is 4 z h / (|x - c| + |x - c'|), with z the
    height of x over the plane between them and h half the drift, and the two distances sum to 2 |x - m| at least.
    Every x of the sphere (centre o, radius r) lies in the disc (z0, y0, r) of the half plane through c, c' and
    o, whose least angle is angle(o) - asin(r / |o - m|). So the bound loosens by drift times the cosine of that
    angle; by the full drift only if the sphere holds m or meets the axis ahead, by nothing if it is behind.

A vector whose own distance is below its loosened bound stays; all others are held against all centroids, in
whole numbers. Distances, sums and ties are exact, so bounds decide what is scanned and never a result.

Between rounds vectors lie in the shared folder with cluster and bound; what a round needs of all of them
(per cluster a count, sums and a radius) is aggregated by Spark, and the driver sees centroids alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covisit.session import Staged

#: Components (after scaling) are at most this, so that squared distances of 64 components fit a long.
LARGEST = 2**27
#: Up to this, float64 sums of 64 products are exact.
EXACT_FLOAT = 2**22
#: Slack for the rounding of square roots and sums in bounds, relative to the numbers at hand.
SLACK = 1e-9
#: Vectors scanned at once: a block of distances of 8 bytes each to every centroid.
BLOCK = 8192


@dataclass(frozen=True)
class Clustering:
    """How vectors are read and clustered. ``centroids`` bounds what the driver and each task hold."""

    dimension: int = 64
    scale: int = 256
    centroids: int = 40
    rounds: int = 5
    seed: int = 2


def whole_vectors(vectors: DataFrame, how: Clustering) -> DataFrame:
    """row (the row as it is), digest, vector (longs): the rows whose embedding has exactly ``dimension`` components, all finite.

    A component beyond what squared distances can hold (see LARGEST) raises an error.
    """
    embedding = F.col("embedding")
    rows = vectors.select(
        F.struct(*(F.col(f"`{c}`") for c in vectors.columns if c != "embedding")).alias("row"),
        F.sha2(F.concat(F.lit(f"{how.seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256).alias("digest"),
        embedding.cast("array<double>").alias("vector")).where(F.size(embedding) == how.dimension)
    kept = T.StructType([*(f for f in rows.schema if f.name != "vector"), T.StructField("vector", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vector")
            values = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, how.dimension)  # null components are NaN
            finite = np.isfinite(values).all(axis=1)
            whole = np.floor(values[finite] * how.scale)
            if whole.size and np.abs(whole).max() > LARGEST:
                raise OverflowError(f"a component is beyond {LARGEST // how.scale}: squared distances do not fit a long")
            batch = batch.filter(pa.array(finite))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("digest"), _lists(whole.astype(np.int64))], ["row", "digest", "vector"])

    return rows.mapInArrow(run, kept)


def _lists(matrix: np.ndarray) -> pa.Array:
    n, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * np.int32(width)), pa.array(matrix.ravel()))


def _matrix(batch: pa.RecordBatch, name: str, width: int) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def all_distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of each vector to each centroid."""
    if max(np.abs(vectors).max(initial=0), np.abs(centroids).max(initial=0)) <= EXACT_FLOAT:
        x, c = vectors.astype(np.float64), centroids.astype(np.float64)
        return ((x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)).astype(np.int64)
    return np.stack([((vectors - c) ** 2).sum(1) for c in centroids], 1)


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per vector: the nearest centroid (ties: the smaller number), its squared distance, and the distance to the next."""
    squared = all_distances(vectors, centroids)
    at = np.arange(len(vectors))
    best = squared.argmin(1)
    own = squared[at, best].copy()
    squared[at, best] = np.iinfo(np.int64).max
    return best, own, np.sqrt(squared.min(1).astype(np.float64)) * (1 - SLACK)


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """Per cluster: how much nearer any other centroid may have come to a vector within ``radius`` of its old centroid."""
    old, new = old.astype(np.float64), new.astype(np.float64)
    drift = np.sqrt(((new - old) ** 2).sum(1))
    middle = (old + new) / 2
    out = np.zeros(len(old))
    for k in range(len(old)):
        moved = drift > 0
        moved[k] = False  # the bound is on the other centroids
        if not moved.any():
            continue
        spoke = old[k] - middle[moved]  # from each middle to the centre of the sphere
        far = np.sqrt((spoke**2).sum(1))
        axis = (new - old)[moved] / drift[moved][:, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            angle = np.arccos(np.clip((spoke * axis).sum(1) / far, -1, 1))
            least = angle - np.arcsin(np.clip(radius[k] * (1 + SLACK) / far, 0, 1))
        whole = (far <= radius[k] * (1 + SLACK)) | (least <= 0)
        nearer = drift[moved] * np.where(whole, 1.0, np.clip(np.cos(least) + SLACK, 0, 1))
        out[k] = nearer.max()
    return out


def _assign(rows: DataFrame, how: Clustering, centroids: np.ndarray, loosened: np.ndarray | None) -> DataFrame:
    """row, vector, cluster, distance (squared), lower, scanned. ``loosened`` is None in the first round, which scans all."""
    schema = T.StructType([rows.schema["row"], rows.schema["vector"], *T._parse_datatype_string(
        "cluster int, distance long, lower double, scanned boolean")])
    width = how.dimension

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(start, BLOCK)
                vectors = _matrix(batch, "vector", width)
                n = len(vectors)
                cluster, distance, lower, doubt = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n), np.ones(n, bool)
                if loosened is not None:
                    cluster = batch.column("cluster").to_numpy().astype(np.int64)
                    distance = ((vectors - centroids[cluster]) ** 2).sum(1)
                    lower = batch.column("lower").to_numpy() * (1 - SLACK) - loosened[cluster]
                    doubt = np.sqrt(distance.astype(np.float64)) * (1 + SLACK) >= lower
                if doubt.any():
                    cluster, distance, lower = cluster.copy(), distance.copy(), lower.copy()
                    cluster[doubt], distance[doubt], lower[doubt] = nearest(vectors[doubt], centroids)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), batch.column("vector"), pa.array(cluster.astype(np.int32)), pa.array(distance), pa.array(lower), pa.array(doubt)],
                    schema.names)

    return rows.mapInArrow(run, schema)


def _summary(state: DataFrame, how: Clustering) -> dict[int, tuple]:
    """Per cluster: rows, sums of components, largest and summed squared distance, rows scanned. Combined in tasks first."""
    sums = [F.sum(F.col("vector")[k]).alias(f"s{k}") for k in range(how.dimension)]
    found = state.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), F.max("distance").alias("most"), F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia"),
        F.count_if("scanned").alias("scanned"), *sums).collect()  # a row for each centroid
    return {r["cluster"]: (r["n"], [r[f"s{k}"] for k in range(how.dimension)], r["most"], int(r["inertia"]), r["scanned"]) for r in found}


@dataclass
class Clusters:
    """``rows``: row, vector, cluster, distance. The rest per centroid, in whole numbers. ``scanned``: vectors held against all, per round."""

    rows: DataFrame
    centroids: np.ndarray
    inertia: dict[int, int]
    scanned: list[int]


def cluster(vectors: DataFrame, how: Clustering = Clustering()) -> Clusters:
    """Cluster the rows of ``vectors`` (vec_id, embedding) that ``whole_vectors`` keeps.

    The first centroids are the ``centroids`` vectors whose digests of vec_id are smallest (equal ones: by components);
    with fewer vectors each is one. Repeated rows are vectors of their own; a null vec_id digests as an
    empty one. An empty table gives no rows.
    """
    state = Staged(whole_vectors(vectors, how), "vectors")
    first = state.frame.select("digest", "vector").orderBy("digest", "vector").limit(how.centroids).collect()
    centroids = np.array([r["vector"] for r in first], np.int64).reshape(-1, how.dimension)
    if not len(first):
        return Clusters(_assign(state.frame, how, centroids, None), centroids, {}, [])
    loosened, scanned = None, []
    for turn in range(how.rounds + 1):
        before, state = state, Staged(_assign(state.frame, how, centroids, loosened), "assigned")
        before.close()
        found = _summary(state.frame, how)
        scanned.append(sum(x[4] for x in found.values()))
        if turn < how.rounds:
            new, radius = centroids.copy(), np.zeros(len(centroids))
            for k, (n, sums, most, _, _) in found.items():
                new[k], radius[k] = [s // n for s in sums], np.sqrt(float(most))
            loosened, centroids = loosening(centroids, new, radius), new
    return Clusters(state.frame, centroids, {k: x[3] for k, x in found.items()}, scanned)


def clustered(vectors: DataFrame, how: Clustering = Clustering()) -> DataFrame:
    """The columns of ``vectors`` but ``embedding``, for the rows that are clustered, with ``cluster``, ``distance`` (squared), ``cluster_inertia``,
    ``inertia`` and ``centroid_sha256``. A column of the input that bears a result's name is replaced."""
    done = cluster(vectors, how)
    results = ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    about = [(k, done.inertia.get(k, 0), hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for k, c in enumerate(done.centroids)]
    table = vectors.sparkSession.createDataFrame(about, "number int, cluster_inertia long, centroid_sha256 string")  # a row for each centroid
    rows = done.rows.join(F.broadcast(table), F.col("cluster") == F.col("number"))
    names = [c for c in vectors.columns if c != "embedding" and c not in results]
    return rows.select(
        *(F.col("row")[c].alias(c) for c in names), "cluster", "distance", "cluster_inertia",
        F.lit(sum(done.inertia.values())).cast("long").alias("inertia"), "centroid_sha256")
