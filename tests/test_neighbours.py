"""The neighbour projection against plain loops, on files, and in a run."""

from __future__ import annotations

import json
import math

import numpy as np
import pytest

from clickloom.operators import neighbours
from clickloom.operators.neighbours import NeighbourProjection
from clickloom.plans import config
from clickloom.plans.pipeline import KEY, Models, Registry, score_sites

COLS = tuple(f"c{i}" for i in range(6))


def model(n=400, seed=0, **more):
    rng = np.random.default_rng(seed)
    points = rng.normal(size=(n, 6)) + rng.integers(0, 3, (n, 1)) * 4
    points[1] = points[0]  # equal points
    return NeighbourProjection(COLS, points, points[:, :2] + rng.normal(size=(n, 2)) * 0.1, **more)


def plain(m, x):
    """One point, by lists."""
    d = sorted((math.sqrt(sum((a - b) ** 2 for a, b in zip(x, p))), i) for i, p in enumerate(m.points.tolist()))[: m.k]
    low, high, mid = 0.0, math.inf, 1.0
    for _ in range(64):
        total = sum(math.exp(-v / mid) if v > 0 else 1.0 for v, _ in d[1:])
        if abs(total - math.log2(len(d))) < 1e-5:
            break
        if total > math.log2(len(d)):
            high = mid
        else:
            low = mid
        mid = mid * 2 if math.isinf(high) else (low + high) / 2
    mid = max(mid, 1e-3 * sum(v for v, _ in d) / len(d))
    w = [1.0 if v <= 0 else math.exp(-v / mid) for v, _ in d]
    z = [sum(m.places[i][c] * v for (_, i), v in zip(d, w)) / sum(w) for c in (0, 1)]
    for e in range(m.epochs):
        for n, ((_, i), v) in enumerate(zip(d, w)):
            step = m.rate * (1 - e / m.epochs) * v / max(w)
            for k, j in enumerate((i, *m.pushing(e * len(d) + n))):
                gap = [z[c] - m.places[j][c] for c in (0, 1)]
                r = gap[0] ** 2 + gap[1] ** 2
                f = 0.0
                if r > 0:
                    f = 2 * m.b / ((0.001 + r) * (m.a * r**m.b + 1)) if k else -2 * m.a * m.b * r ** (m.b - 1) / (m.a * r**m.b + 1)
                z = [z[c] + step * min(4, max(-4, f * gap[c])) for c in (0, 1)]
    return [i for _, i in d], w, z


@pytest.mark.parametrize("more", [{}, {"k": 3, "epochs": 0}, {"k": 1000, "epochs": 1, "pushes": 1}])
def test_projection_by_plain_loops(more, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 64)  # many blocks
    monkeypatch.setattr(neighbours, "ROWS", 7)
    m = model(**more)
    rng = np.random.default_rng(2)
    x = np.concatenate((rng.normal(size=(20, 6)) * 3 + 4, m.points[:3], np.full((1, 6), 1e6)))
    i, d = m.nearest(x)
    w, z = m.weights(d), m(x)
    for r, row in enumerate(x.tolist()):
        want = plain(m, row)
        # steps near an attracting place enlarge differences of rounding
        assert i[r].tolist() == want[0] and w[r].tolist() == pytest.approx(want[1]) and z[r].tolist() == pytest.approx(want[2], rel=1e-3, abs=1e-3)
    assert m(x[:0]).shape == (0, 2)
    assert np.allclose(np.concatenate([m(x[k : k + 1]) for k in range(len(x))]), z)  # whatever batch a point comes in


def test_points_land_among_their_kind():
    m = model(600)
    rng = np.random.default_rng(5)
    new = rng.normal(size=(90, 6)) + np.repeat([0, 4, 8], 30)[:, None]
    z = m(new)
    for k in range(3):
        assert np.linalg.norm(np.median(z[30 * k : 30 * k + 30], 0) - 4 * k) < 2


def test_model_files_and_a_run(spark, tmp_path):
    m = model(50, k=5)
    folder = tmp_path / "own" / "desktop"
    folder.mkdir(parents=True)
    m.save(str(folder))
    (folder / "scaler.json").write_text(json.dumps({c: {"scale": 1.0, "min": 0.0} for c in COLS}))
    (folder / "centroid.json").write_text(json.dumps({"centroid_x": 0.0, "centroid_y": 0.0, "bot_distance_p95": 9.0}))
    got = Models.load(config.Site("1_1", "f", (str(tmp_path / "own"),)), "desktop")
    x = np.random.default_rng(3).normal(size=(12, 6))
    assert np.array_equal(got.projection(x), m(x))
    feats = spark.createDataFrame([("1_1", f"s{i}", *map(float, r)) for i, r in enumerate(x)], "site_id string, session_id string, " + ", ".join(f"{c} double" for c in COLS))
    scores = {r["session_id"]: r for r in score_sites(feats.limit(0), feats, Registry(None, {"1_1": got})).collect()}
    want = np.maximum(np.clip(1 - np.linalg.norm(m(x), axis=1) / 9.0, 0, 1), 0.01)
    assert [scores[f"s{i}"]["probability_bot_umap"] for i in range(12)] == pytest.approx(want.tolist()) and set(KEY) < set(feats.columns)
    np.savez(str(folder / "projection.npz"), points=m.points, places=m.places[:7])
    with pytest.raises(ValueError):
        neighbours.load(str(folder / "projection.json"))
