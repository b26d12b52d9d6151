import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from covisit.llm import centroid_clustering as cc
from covisit.llm.queries import QUERIES

from .tools import SMALL, rows_of

SCHEMA = "vec_id long, embedding array<float>, label int"


def lloyd(rows, dimension=64, k=40, rounds=5):
    """Plain rounds in Python's whole numbers: vec_id and the result's columns, sorted."""
    kept = []
    for r in rows:
        e = r["embedding"]
        if e is not None and len(e) == dimension and all(x is not None and math.isfinite(x) for x in e):
            digest = hashlib.sha256(f"2:{'' if r['vec_id'] is None else r['vec_id']}".encode()).hexdigest()
            kept.append((digest, [math.floor(256 * float(np.float32(x))) for x in e], r["vec_id"]))
    centroids = [v for _, v, _ in sorted(kept, key=lambda x: x[:2])[:k]]

    def assigned():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids)) for _, v, _ in kept]

    for _ in range(rounds):
        at = assigned()
        for j in range(len(centroids)):
            own = [v for (_, v, _), (_, c) in zip(kept, at) if c == j]
            if own:
                centroids[j] = [sum(x) // len(own) for x in zip(*own)]
    at = assigned()
    inertia = [sum(d for d, c in at if c == j) for j in range(len(centroids))]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, inertia[c], sum(inertia), digests[c]) for (_, _, i), (d, c) in zip(kept, at)), key=repr)


def listed(df):
    names = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr)


def table(spark, rows):
    return spark.createDataFrame([(r["vec_id"], r["embedding"], 0) for r in rows], SCHEMA)


def blobs(n, dimension, seed, centres=6, spread=0.3):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dimension))
    points = middle[rng.integers(centres, size=n)] + spread * rng.normal(size=(n, dimension))
    return [{"vec_id": k, "embedding": [float(x) for x in p.astype(np.float32)]} for k, p in enumerate(points)]


def test_query(spark):
    assert listed(QUERIES["op12_centroid_clustering"](spark, SMALL)) == lloyd(rows_of("embeddings"))


@pytest.mark.parametrize("dimension, k, spread", [(2, 5, 0.3), (2, 7, 2.0), (3, 4, 0.0), (8, 12, 0.5)])
def test_rounds_with_ties_and_repeated_rows(spark, dimension, k, spread):
    rows = blobs(300, dimension, k, spread=spread)
    rows += [{"vec_id": r["vec_id"], "embedding": r["embedding"]} for r in rows[:90]] + [{"vec_id": 1000 + j, "embedding": rows[0]["embedding"]} for j in range(150)]
    how = cc.Clustering(dimension=dimension, centroids=k, rounds=6)
    assert listed(cc.clustered(table(spark, rows), how)) == lloyd(rows, dimension, k, 6)


def test_bounds_spare_scans(spark):
    rows = blobs(2000, 8, 1, centres=10, spread=0.05)
    done = cc.cluster(table(spark, rows), cc.Clustering(dimension=8, centroids=10, rounds=8))
    assert done.scanned[0] == 2000 and done.scanned[-1] < 200
    assert done.rows.count() == 2000


def test_rows_that_are_left_out(spark):
    nan, inf = float("nan"), float("inf")
    good = blobs(6, 2, 3)
    odd = [None, [], [1.0], [1.0, 2.0, 3.0], [None, 1.0], [nan, 1.0], [1.0, inf], [-inf, 0.0]]
    rows = good + [{"vec_id": 100 + k, "embedding": e} for k, e in enumerate(odd)] + [{"vec_id": None, "embedding": [0.5, -0.25]}] * 2
    how = cc.Clustering(dimension=2, centroids=40)
    found = listed(cc.clustered(table(spark, rows), how))
    assert found == lloyd(rows, 2) and len(found) == 8


def test_no_rows_large_components_and_clashing_names(spark):
    how = cc.Clustering(dimension=2, centroids=3)
    assert listed(cc.clustered(table(spark, []), how)) == []
    assert listed(cc.clustered(table(spark, [{"vec_id": 1, "embedding": None}]), how)) == []
    wide = [{"vec_id": k, "embedding": [k * 400000.0, -k * 500000.0]} for k in range(2)] + [{"vec_id": 5, "embedding": [131072.5, 1.0]}]
    assert listed(cc.clustered(table(spark, wide), how)) == lloyd(wide, 2, 3)
    with pytest.raises(Exception, match="do not fit a long"):
        cc.clustered(table(spark, [{"vec_id": 1, "embedding": [1e30, 0.0]}]), how).collect()
    clash = table(spark, blobs(5, 2, 1)).withColumns({"cluster": F.lit("x"), "row": F.lit("r"), "vector": F.lit("v"), "number": F.lit("n")})
    row = cc.clustered(clash, how).first()
    assert (row["row"], row["vector"], row["number"]) == ("r", "v", "n") and isinstance(row["cluster"], int)


def test_loosening_is_a_bound_below_the_drift():
    rng = np.random.default_rng(7)
    less = 0
    for _ in range(200):
        d = int(rng.integers(2, 5))
        old, radius = rng.normal(size=(4, d)) * 100, np.abs(rng.normal(size=4)) * 60
        new = old + rng.normal(size=(4, d)) * rng.choice([0, 1, 30], size=(4, 1))
        bound, drift = cc.loosening(old, new, radius), np.sqrt(((new - old) ** 2).sum(1))
        for k in range(4):
            step = rng.normal(size=(400, d))
            points = old[k] + step / np.sqrt((step**2).sum(1))[:, None] * radius[k] * rng.random((400, 1)) ** 0.2
            others = [j for j in range(4) if j != k]
            gain = max((np.sqrt(((points - old[j]) ** 2).sum(1)) - np.sqrt(((points - new[j]) ** 2).sum(1))).max() for j in others)
            assert gain <= bound[k] + 1e-6
            assert bound[k] <= drift[others].max() + 1e-6
            less += bound[k] < 0.9 * drift[others].max()
    assert less > 300
