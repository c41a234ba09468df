import math
import random

import numpy as np
import pytest

from cityflow.llm import negatives
from cityflow.llm.negatives import hard_negatives, multi_sequence

from .conftest import plain

SCHEMA = "label int, score string, vec_id long, key string, tag int, embedding array<float>, `a.b` int"


def by_hand(rows):
    """The contract, by comparing every anchor with every row."""
    kept = []
    for number, label, vector in rows:
        if number is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((number, (label + 1) % 10 if number % 7 == 0 else label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    found = []
    for i, (anchor, label, vector) in enumerate(kept):
        if anchor % 50:
            continue
        scored = [(-sum(a * b for a, b in zip(vector, v)), n, y) for j, (n, y, v) in enumerate(kept) if j != i]
        for score, positive, _ in sorted(s for s in scored if s[2] == label)[:5]:
            others = sorted(s for s in scored if s[2] != label and 50 * -score <= 100 * -s[0] <= 95 * -score)[:3]
            found += [(anchor, positive, rank, n, -score, -s) for rank, (s, n, _) in enumerate(others, 1)]
    return found


def frame(spark, rows):
    wide = [(y, "s", n, "k", 1, v, 2) for n, y, v in rows]
    return spark.createDataFrame(wide, SCHEMA).repartition(5)


def vectors(rng, n, dims, groups=12, spread=0.2):
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(groups)]
    rows = []
    for i in range(n):
        centre = rng.choice(centres)
        rows.append((i, rng.randrange(4), [c / dims**0.5 + rng.gauss(0, spread) / dims**0.5 for c in centre]))
    return rows


def test_against_all_pairs(spark, monkeypatch):
    """Small cells and probes, so that heaps stop early and searches need their second pass."""
    rng = random.Random(5)
    rows = vectors(rng, 700, 16)
    # Copies of one vector, also under other labels, a third of all rows; ties in order of ids.
    rows = [(n, y if n % 3 else n % 2, rows[0][2] if n % 3 == 0 else v) for n, y, v in rows]
    rows += rows[50:52] + rows[100:101]
    rows += [(1000, None, rows[1][2]), (1050, 1, None), (1100, 1, [0.5] * 15 + [None]), (1150, 1, [0.5] * 15 + [float("nan")]), (1200, 1, [float("inf")] * 16), (None, 1, rows[1][2])]
    monkeypatch.setattr(negatives, "PER_CELL", 8)
    monkeypatch.setattr(negatives, "PROBED", 30)
    monkeypatch.setattr(negatives, "BLOCK", 16)
    monkeypatch.setattr(negatives, "BATCH", 5)
    found = hard_negatives(frame(spark, rows))
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    expected = by_hand(rows)
    assert plain(found.collect()) == plain(expected) and len(expected) > 50


@pytest.mark.parametrize("rows", [[], [(1, 1, [0.5, 0.5])], [(50, 1, [0.5, 0.5])], [(50, 1, []), (51, 1, []), (52, 2, [])], [(50, 1, [1.0]), (51, 1, [1.0, 0.0]), (52, 2, [0.75]), (53, 3, [0.75, 0.1])]])
def test_edges(spark, rows):
    longest = max((len(v) for _, _, v in rows), default=0)
    even = [(n, y, [*v, *[0.0] * (longest - len(v))]) for n, y, v in rows]
    assert plain(hard_negatives(frame(spark, rows)).collect()) == plain(by_hand(even))


def test_multi_sequence_visits_all_pairs_in_order():
    rng = np.random.default_rng(1)
    for n, m in [(1, 1), (3, 7), (8, 5), (0, 4)]:
        left, right = rng.integers(0, 9, n).astype(float), rng.integers(0, 9, m).astype(float)
        seen = list(multi_sequence(left, right))
        assert sorted((i, j) for _, i, j in seen) == [(i, j) for i in range(n) for j in range(m)]
        assert [s for s, _, _ in seen] == sorted((s for s, _, _ in seen), reverse=True)
        assert all(s == left[i] + right[j] for s, i, j in seen)


def test_bounds_hold_for_all_members(spark):
    rng = random.Random(8)
    rows = [(i, 1, [rng.gauss(0, 1) for _ in range(6)]) for i in range(300)]
    data = spark.createDataFrame([(i, i, 1, [int(256 * x) for x in v]) for i, _, v in rows], "tag long, vec_id long, label long, v array<int>")
    index = negatives.MultiIndex.over(data, 6).index
    points = np.array([[int(256 * x) for x in v] for _, _, v in rows])
    left, right = index.bounds(points[:20])
    halves = index.halves(points)
    for half, bound, book in zip(halves, (left, right), index.books):
        cell = ((half[:, None, :] - book[None]) ** 2).sum(2).argmin(1)
        assert (half[:20] @ half.T <= bound[:, cell]).all()
    assert sum(index.held.values()) == 300


def test_pruning_leaves_cells_out(spark):
    """On grouped vectors the second pass visits few of the cells."""
    rng = random.Random(2)
    rows = vectors(rng, 4000, 8, groups=40, spread=0.05)
    data = spark.createDataFrame([(i, i, y, [int(256 * x) for x in v]) for i, y, v in rows], "tag long, vec_id long, label long, v array<int>")
    index = negatives.MultiIndex.over(data, 8).index
    points = np.array([[int(256 * x) for x in v] for _, _, v in rows])
    left, right = index.bounds(points[:50])
    for q in range(50):
        best = np.sort(points @ points[q])[-6]
        later = list(negatives.visits(index, left[q], right[q], float(best)))
        assert len(later) < len(index.held)
