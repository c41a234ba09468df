import hashlib
import math
import random

import numpy as np
import pytest

from cityflow.llm.centroids import centroid_clusters, partial_distances

from .conftest import plain

SCHEMA = "cluster string, vec_id long, shard int, embedding array<float>, `a.b` int, distance double"


def by_hand(rows, dims, clusters, rounds, scale=64):
    """Lloyd rounds in plain whole numbers."""
    kept = []
    for number, vector in rows:
        if vector is None or len(vector) != dims or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((number, [math.floor(scale * float(np.float32(x))) for x in vector]))
    digest = lambda n: hashlib.sha256(f"1:{n}".encode()).hexdigest()
    first = sorted(kept, key=lambda r: (r[0] is None, "" if r[0] is None else digest(r[0]), r[1]))[:clusters]
    centroids = [v for _, v in first]
    for turn in range(rounds + 1):
        placed = []
        for number, v in kept:
            distance, cluster = min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centroids))
            placed.append((number, cluster, distance, v))
        if turn < rounds:
            for i in range(len(centroids)):
                own = [v for _, c, _, v in placed if c == i]
                if own:
                    centroids[i] = [sum(x) // len(own) for x in zip(*own)]
    total = sum(d for _, _, d, _ in placed) if kept else 0
    inertia = {i: sum(d for _, c, d, _ in placed if c == i) for i in range(len(centroids))}
    told = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(n, c, d, inertia[c], total, told[c]) for n, c, d, _ in placed] if kept else []


def frame(spark, rows):
    return spark.createDataFrame([("c", n, 1, v, 2, 0.5) for n, v in rows], SCHEMA).repartition(3)


def rows_of(n, dims, seed=1):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(dims)]) for i in range(n)]
    # A third of all rows hold one vector, some rows are repeated, some cannot be kept.
    rows = [(i, rows[0][1] if i % 3 == 0 else v) for i, v in rows] + rows[3:5]
    return rows + [(7000, None), (7001, [None] * dims), (7002, [0.1] * (dims - 1)), (7003, [float("nan")] * dims), (7004, [float("-inf")] * dims), (None, rows[4][1]), (7005, [])]


@pytest.mark.parametrize("dims, clusters, rounds, shards", [(64, 16, 3, 4), (10, 5, 2, 4), (7, 3, 0, 1)])
def test_against_whole_number_rounds(spark, dims, clusters, rounds, shards):
    rows = rows_of(500, dims)
    found = centroid_clusters(frame(spark, rows), dims=dims, clusters=clusters, rounds=rounds, shards=shards)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert plain(found.collect()) == plain(by_hand(rows, dims, clusters, rounds))


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.5, -0.5])], [(1, [0.5, 0.5]), (2, [0.5, 0.5]), (2, [0.5, 0.5])], [(None, [0.1, 0.2])], [(1, [3e38, -3e38]), (2, [0.0, 0.0])]])
def test_edges(spark, rows):
    found = centroid_clusters(frame(spark, rows), dims=2, clusters=4, rounds=3).collect()
    held = [(n, v and [max(-(2.0**25) / 64, min(2.0**25 / 64, x)) for x in v]) for n, v in rows]
    assert plain(found) == plain(by_hand(held, 2, 4, 3))


def test_blocks_of_columns_add_up():
    rng = np.random.default_rng(3)
    x, c = rng.integers(-500, 500, (40, 12)), rng.integers(-500, 500, (5, 12))
    parts = [partial_distances(x[:, s : s + 4], c[:, s : s + 4]) for s in (0, 4, 8)]
    assert (sum(parts) == ((x[:, None] - c[None]) ** 2).sum(2)).all()


def test_blocks_are_bounded_and_centroids_stay_small(spark, monkeypatch):
    """More chunks than one give the same rows."""
    from cityflow.llm import centroids

    rows = rows_of(300, 8, seed=4)
    monkeypatch.setattr(centroids, "CHUNK", 16)
    found = centroid_clusters(frame(spark, rows), dims=8, clusters=6, rounds=3).collect()
    assert plain(found) == plain(by_hand(rows, 8, 6, 3))
