from __future__ import annotations

import math
import random

import numpy as np
import pytest

from clickloom.operators import trajectory as T
from clickloom.operators.decode import track

STAIRS = [(0, 0, 1000), (10, 0, 1010), (10, 10, 1030), (20, 10, 1040), (20, 20, 1060)]


def made(points, device="desktop"):
    return T.stats(*(np.array(c, float) for c in zip(*points)), [len(points)], device)


def test_straight_line():
    got = made([(10 * i, 0, 1000 + 10 * i) for i in range(4)])
    for name in ("direction_entropy", "jerk", "jitter", "speed_variability", "curvature", "repetition_patterns", "time_irregularity"):
        assert got[name] == 0
    assert (got["linearity"], got["l"], got["ms"], got["acceleration_variability"], got["bot_score"], got["is_likely_bot"]) == (1, 30, 30, None, 1, True)


def test_stairs():
    d, m = made(STAIRS), made(STAIRS, "mobile")
    want = {"direction_entropy": 1.0, "jerk": 0.01257788237343632, "linearity": math.sqrt(0.5), "jitter": 0, "speed_variability": 1 / 3, "time_irregularity": 1 / 3, "curvature": 1.0,
            "acceleration_variability": 0.3535533905932738, "turn_rate_45_per_100": 100, "mean_abs_angle_deg": 90, "angle_entropy": 0, "curvature_per_100px": 11.780972450961723, "l": 40, "ms": 60}
    for k, v in want.items():
        assert d[k] == pytest.approx(v, abs=1e-12)
    assert d["bot_score"] == pytest.approx(0.7) and d["is_likely_bot"]
    assert m["bot_score"] == 0.49999999999999994 and not m["is_likely_bot"]


def test_intake():
    x, y, t = (np.array(c, float) for c in zip((0, 0, 0), (0, 0, 10), (1, 0, 20), (1, 0, 16020), (5, 0, 16021)))
    keep, _, anew = T.taken_in(x, y, t, np.array([0, 5]))
    assert keep.tolist() == [4] and anew.tolist() == [True]
    assert T.stats(x, y, t, [5], "desktop") is None
    n = 1500
    assert T.taken_in(np.arange(n) * 2.0, np.zeros(n), np.arange(n) * 1.0, np.array([0, n]))[0].tolist() == list(range(n - T.MOST_POINTS, n))


def plain_intake(x, y, t):
    kept, anew = [], False
    for i in range(len(x)):
        if kept:
            if math.sqrt((x[i] - x[kept[-1]]) ** 2 + (y[i] - y[kept[-1]]) ** 2) < 1:
                continue
            if t[i] - t[kept[-1]] > 15000:
                kept, anew = [], True
        kept.append(i)
    return kept[-T.MOST_POINTS :], anew


def test_intake_of_a_batch_against_plain_loops():
    rng = np.random.default_rng(4)
    for _ in range(60):
        sizes = rng.integers(0, 30, 12)
        at = np.concatenate(([0], sizes.cumsum()))
        x, y = (rng.integers(0, 6, at[-1]) * rng.choice([0.3, 0.5, 1.0]) for _ in "xy")
        x[rng.random(at[-1]) < 0.03] = np.nan
        t = rng.integers(0, 4000, at[-1]).cumsum() * rng.choice([1.0, 4.0])
        keep, cuts, anew = T.taken_in(x, y, t, at)
        for k in range(len(sizes)):
            want, reset = plain_intake(*(c[at[k] : at[k + 1]] for c in (x, y, t)))
            assert (keep[cuts[k] : cuts[k + 1]] - at[k]).tolist() == want and anew[k] == reset


def test_a_batch_equals_its_trajectories_one_by_one():
    rng = np.random.default_rng(8)
    sizes = rng.integers(0, 40, 60)
    at = np.concatenate(([0], sizes.cumsum()))
    x, y, t = rng.integers(0, 40, at[-1]) * 0.7, rng.integers(0, 40, at[-1]) * 1.3, rng.integers(-2, 400, at[-1]).cumsum() * 1.0
    desktop = rng.random(60) < 0.5
    there, out = T.batch_stats(x, y, t, at, np.full(60, 5.0), desktop)
    seen = 0
    for k in range(60):
        alone = T.stats(*(c[at[k] : at[k + 1]] for c in (x, y, t)), [5], "desktop" if desktop[k] else "mobile")
        assert (alone is not None) == there[k]
        if alone is not None:
            for name, v in alone.items():
                got = out[name][seen]
                assert got == pytest.approx(v, rel=1e-12) if v is not None else np.isnan(got)
            seen += 1

def plain_repetition(x, y):
    alike = total = 0
    for i in range(len(x) - 5):
        for j in range(i + 3, len(x) - 2):
            gap = sum(math.sqrt((x[i + k] - x[i] - (x[j + k] - x[j])) ** 2 + (y[i + k] - y[i] - (y[j + k] - y[j])) ** 2) for k in range(3)) / 3
            total += 1
            alike += max(0, 1 - gap / 50) > 0.8
    return alike / total if total else 0


def test_repetition_against_plain_loops():
    """Short and long trajectories together, with many distances at the very limit and some unknown points."""
    rng = np.random.default_rng(0)
    sizes = np.array([14, 0, 5, 6, 7, 150, 140, 3, 200])
    at = np.concatenate(([0], sizes.cumsum()))
    x, y = (rng.integers(0, 7, at[-1]) * 5.0 for _ in "xy")
    x[at[6] : at[7]] = np.cumsum(rng.normal(0, 20, 140))
    x[at[8] + 9] = np.nan
    got = T.repetitions(x, y, at)
    assert got.tolist() == [plain_repetition(x[a:b], y[a:b]) for a, b in zip(at, at[1:])]
    assert T.repetitions(np.zeros(0), np.zeros(0), np.array([0])).tolist() == []


def test_a_thousand_points_are_soon_compared():
    import time

    rng = np.random.default_rng(1)
    x, y, at = np.cumsum(rng.normal(0, 12, 1000)), np.cumsum(rng.normal(0, 12, 1000)), np.array([0, 1000])
    took = []
    for _ in range(7):
        began = time.perf_counter()
        T.repetitions(x, y, at)
        took.append(time.perf_counter() - began)
    assert min(took) < 0.03  # 85 ms by a loop over points; 5 ms and less on an idle machine


def test_window_form_agrees_with_arrays(spark):
    rng = np.random.default_rng(1)
    rows = [(s, i, float(1000 + 50 * i + rng.integers(0, 40)), float(v[0]), float(v[1])) for s in range(4) for i, v in enumerate(np.cumsum(rng.integers(2, 40, (12, 2)), 0))]
    got = {r["session_id"]: r for r in T.point_features(spark.createDataFrame(rows, "session_id long, seq long, tm double, x double, y double")).collect()}
    for s in range(4):
        want = made([(r[3], r[4], r[2]) for r in rows if r[0] == s])
        for name in set(T.COMMON + T.DESKTOP_ONLY) - {"repetition_patterns", "mmv_points_per_group"}:
            assert got[s][name] == pytest.approx(want[name], rel=1e-9, abs=1e-12), name


def test_track_times_are_running_sums(spark):
    """Around the edges of a block, with an unreadable delta, an empty and a null track."""
    digits = "0123456789abcdefghijklmnopqrstuvwxyz"
    to36 = lambda n: (to36(n // 36) if n >= 36 else "") + digits[n % 36]
    rnd = random.Random(3)
    deltas = [[rnd.randrange(500) for _ in range(n)] for n in (1, 2, 63, 64, 65, 128, 129, 1000)]
    texts = [";".join(f"{to36(d)},{to36(i)},1" for i, d in enumerate(ds)) for ds in deltas] + ["5,1,2;?!,1,2;3,3,3", "", None]
    rows = [(i, t, 1e12 + rnd.random()) for i, t in enumerate(texts)]
    got = spark.createDataFrame(rows, "i int, text string, tm double").select("i", track("text", "tm").alias("t")).orderBy("i").collect()
    for (_, _, tm), ds, g in zip(rows, [*deltas, [5, None, 3], [None]], got, strict=False):
        want, at = [], tm
        for d in ds:
            at = None if at is None or d is None else at + d
            want.append(at)
        assert [p.tm for p in g.t] == want
    assert got[-1].t is None
