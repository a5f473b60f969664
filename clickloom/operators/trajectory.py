"""Bot-detection features of a trajectory.

Two forms with the same definitions. `point_features` works on a table of points with windows, inside
whole-stage code, for trajectories that need no noise suppression. `track_stats` takes arrays of points,
whole batches at once in an Arrow function: the intake rules look back at the last point kept, which no window does.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.expressions import ratio

# Intake, bins and limits of the features.
MOST_POINTS, LEAST_POINTS, PAUSE_MS, LEAST_MOVE = 1000, 3, 15000, 1.0
DIRECTIONS, ANGLE_BIN, STRAIGHT_DEG, STRAIGHT_RUN, SHARP_DEG = 16, 10.0, 5.0, 5, 45.0
SEGMENT, SEGMENT_SCALE, ALIKE = 3, 50.0, 0.8

# Terms of the score, (feature, desktop only, ((operator, limit, points), ...)); the first that holds counts, in this order.
SCORE_TERMS = (
    ("direction_entropy", False, (("<", 2.0, 0.3), ("<", 2.5, 0.1))),
    ("linearity", False, ((">", 0.9, 0.2), (">", 0.8, 0.1))),
    ("jerk", False, (("<", 0.001, 0.2), ("<", 0.01, 0.1))),
    ("jitter", False, (("<", 0.1, 0.15), ("<", 0.2, 0.05))),
    ("micro_jitter_2px", True, (("<", 0.12, 0.1), ("<", 0.15, 0.05))),
    ("mmv_points_per_group", True, ((">=", 30, 0.15), (">=", 25, 0.05))),
    ("long_straight_run_share", True, ((">=", 0.45, 0.2), (">=", 0.35, 0.1))),
    ("turn_rate_45_per_100", True, (("<", 3, 0.15), ("<", 4, 0.05))),
    ("mean_abs_angle_deg", True, (("<", 9, 0.1),)),
    ("angle_entropy", True, (("<", 2.2, 0.1),)),
    ("curvature_per_100px", True, (("<", 3, 0.05),)),
    ("speed_variability", False, (("<", 0.3, 0.15), ("<", 0.5, 0.05))),
    ("repetition_patterns", False, ((">", 0.3, 0.2), (">", 0.1, 0.1))),
    ("time_irregularity", False, (("<", 0.3, 0.1),)),
)
LIKELY = 0.5

COMMON = ("direction_entropy", "jerk", "linearity", "jitter", "speed_variability", "curvature", "repetition_patterns", "time_irregularity", "acceleration_variability")
DESKTOP_ONLY = ("micro_jitter_2px", "mmv_points_per_group", "long_straight_run_share", "turn_rate_45_per_100", "mean_abs_angle_deg", "p90_abs_angle_deg", "angle_entropy", "curvature_per_100px")


def features_of(device: str) -> tuple[str, ...]:
    return COMMON + (DESKTOP_ONLY if device == "desktop" else ())


def bot_score(desktop: Column | bool, names: set[str] | None = None) -> Column:
    """Sum of the score's terms over feature columns, at most 1. Unknown features add nothing."""
    total = F.lit(0.0)
    for name, only_desktop, cases in SCORE_TERMS:
        if names is not None and name not in names:
            continue
        term = F.lit(0.0)
        for op, limit, points in reversed(cases):
            c = F.col(name)
            holds = c < limit if op == "<" else c > limit if op == ">" else c >= limit
            term = F.when(holds, F.lit(points)).otherwise(term)
        if only_desktop:
            term = F.when(desktop if isinstance(desktop, Column) else F.lit(desktop), term).otherwise(0.0)
        total = total + term
    return F.least(F.lit(1.0), total)


# ---------------------------------------------------------------- a table of points


def steps(points: DataFrame, key: str = "session_id", order: tuple[str, ...] = ("tm", "seq")) -> DataFrame:
    """Points (key, seq, tm, x, y) with the step from the point before, and the steps before that.

    One sort by key serves all windows.
    """
    w = Window.partitionBy(key).orderBy(*order)
    moved = points.withColumns({f"d{c}": F.col(c) - F.lag(c).over(w) for c in ("x", "y", "tm")} | {"i": F.row_number().over(w)})
    moved = moved.withColumn("dist", F.sqrt(F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy")))
    back = {f"{c}_{k}": F.lag(c, k).over(w) for c in ("dx", "dy", "dtm", "dist") for k in (1, 2)}
    return moved.withColumns(back).withColumns(
        {
            "cross": F.col("dx_1") * F.col("dy") - F.col("dy_1") * F.col("dx"),
            "dot": F.col("dx_1") * F.col("dx") + F.col("dy_1") * F.col("dy"),
        }
    ).withColumn("angle", F.when((F.col("cross") != 0) | (F.col("dot") != 0), F.abs(F.atan2("cross", "dot") * 180 / math.pi)))


def entropy(df: DataFrame, key: str, bin_: Column, name: str) -> DataFrame:
    """(key, name): Shannon entropy, to base 2, over any number of bins; counted before the shuffle."""
    counts = df.where(bin_.isNotNull()).groupBy(key, bin_.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.groupBy(key).agg(F.sum("n").alias("t"), F.sum(F.col("n") * F.log2("n")).alias("s"))
    return total.select(key, (F.log2("t") - F.col("s") / F.col("t") + 0.0).alias(name))


def binned_entropy(bin_: Column, bins: int) -> Column:
    """The same as an aggregate of its own, for few bins: one counter each, so that no further shuffle is needed. 0 without values."""
    counts = F.array(*(F.count_if(bin_ == k) for k in range(bins)))
    total = F.count(bin_)
    logs = F.aggregate(counts, F.lit(0.0), lambda a, n: a + F.when(n > 0, n * F.log2(n.cast("double"))).otherwise(0.0))
    return F.when(total > 0, F.log2(total.cast("double")) - logs / total + 0.0).otherwise(0.0)


def direction_bin() -> Column:
    return F.pmod(F.floor((F.atan2("dy", "dx") + math.pi) / (2 * math.pi / DIRECTIONS)), F.lit(DIRECTIONS))


def cv(x: Column, least: int = 2) -> Column:
    """Population deviation over the mean of what is known; 0 with fewer than `least` values, NULL if the mean is 0."""
    return F.when(F.count(x) < least, 0.0).otherwise(ratio(F.stddev_pop(x), F.avg(x)))


def with_runs(stepped: DataFrame, key: str = "session_id") -> DataFrame:
    """Steps with `run`: how many turns the run of turns under five degrees has that the step is in. No further shuffle."""
    w = Window.partitionBy(key).orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    breaks = F.when(F.col("angle") >= STRAIGHT_DEG, 1).otherwise(0)
    inside = Window.partitionBy(key, "island")
    return stepped.withColumn("island", F.sum(breaks).over(w)).withColumn("run", F.count_if(F.col("angle") < STRAIGHT_DEG).over(inside))


def straight_share() -> Column:
    """Share of turns in runs of five or more turns under five degrees."""
    return F.coalesce(ratio(F.count_if((F.col("angle") < STRAIGHT_DEG) & (F.col("run") >= STRAIGHT_RUN)), F.count("angle")), F.lit(0.0))


def straight_runs(stepped: DataFrame, key: str = "session_id") -> DataFrame:
    """(key, long_straight_run_share) for each key with a turn."""
    return with_runs(stepped, key).groupBy(key).agg(F.count("angle").alias("_n"), straight_share().alias("long_straight_run_share")).where("_n > 0").drop("_n")


def point_features(points: DataFrame, key: str = "session_id") -> DataFrame:
    """One row a key with all features that need neither segments nor groups of points: one shuffle, one aggregate."""
    s = with_runs(steps(points, key), key)
    speed = lambda c, back: ratio(F.col(c + back), F.col("dtm" + back))
    forward = (F.col("dtm") > 0) & (F.col("dtm_1") > 0)
    accel = {c: (speed(c, "") - speed(c, "_1")) / F.col("dtm") for c in ("dx", "dy")}
    before = {c: (speed(c, "_1") - speed(c, "_2")) / F.col("dtm_1") for c in ("dx", "dy")}
    jerk = {c: (accel[c] - before[c]) / F.col("dtm") for c in ("dx", "dy")}
    length = lambda v: F.sqrt(v["dx"] * v["dx"] + v["dy"] * v["dy"])
    s = s.withColumns(
        {
            "v": F.when(F.col("dtm") > 0, ratio(F.col("dist"), F.col("dtm"))),
            "a": F.when(forward, length(accel)),
            "jerk_at": F.when(forward & (F.col("dtm_2") > 0), length(jerk)),
        }
    )
    both = F.col("dist") * F.col("dist_1")
    first, last = (lambda c: F.min_by(c, "i")), (lambda c: F.max_by(c, "i"))
    chord = F.sqrt(F.pow(last("x") - first("x"), F.lit(2.0)) + F.pow(last("y") - first("y"), F.lit(2.0)))
    path = F.coalesce(F.sum("dist"), F.lit(0.0))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    flat = s.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        (last("tm") - first("tm")).alias("ms"),
        path.alias("l"),
        zero(F.avg("jerk_at")).alias("jerk"),
        F.when((chord == 0) | (path == 0), 1.0).otherwise(ratio(chord, path)).alias("linearity"),
        zero(F.avg(F.when(F.col("dist").isNotNull(), (F.col("dist") < 3).cast("double")))).alias("jitter"),
        zero(F.avg(F.when(F.col("dist").isNotNull(), (F.col("dist") < 2).cast("double")))).alias("micro_jitter_2px"),
        cv(F.col("v")).alias("speed_variability"),
        zero(F.avg(F.when(both > 0, F.abs("cross") / both))).alias("curvature"),
        F.when(F.count("dtm") < 1, 0.0).otherwise(ratio(F.stddev_pop("dtm"), F.avg("dtm"))).alias("time_irregularity"),
        cv(F.col("a")).alias("acceleration_variability"),
        zero(100 * F.avg(F.when(F.col("angle").isNotNull(), (F.col("angle") > SHARP_DEG).cast("double")))).alias("turn_rate_45_per_100"),
        zero(F.avg("angle")).alias("mean_abs_angle_deg"),
        zero(F.percentile("angle", F.lit(0.9))).alias("p90_abs_angle_deg"),
        zero(F.when(path > 0, 100 * F.sum("angle") * math.pi / 180 / path)).alias("curvature_per_100px"),
        binned_entropy(direction_bin(), DIRECTIONS).alias("direction_entropy"),
        binned_entropy(F.floor(F.col("angle") / ANGLE_BIN), int(180 / ANGLE_BIN) + 1).alias("angle_entropy"),
        straight_share().alias("long_straight_run_share"),
    )
    return flat


# ---------------------------------------------------------------- arrays of points
# A batch of trajectories is one set of flat arrays: `at` has the first position of each and, last, the end. Every
# feature is a sum by trajectory over points, steps, turns or pairs of segments; nothing loops over points or trajectories
# but the intake of those that hold noise, which hops from one dropped point to the next.


def taken_in(x: np.ndarray, y: np.ndarray, t: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of the points that stay, `at` among them, and of which trajectories a pause has started anew.

    A point nearer than one pixel to the last one kept is noise; after a pause of 15 s only what
    follows stays; of more than 1000 the last stay.
    """
    of = np.repeat(np.arange(len(at) - 1), np.diff(at))
    near = (np.sqrt(np.diff(x) ** 2 + np.diff(y) ** 2) < LEAST_MOVE) & (of[1:] == of[:-1])
    stay = np.ones(len(x), bool)
    marks = np.flatnonzero(near)  # such a point and the next one
    for k in np.unique(of[marks]).tolist():
        a, b = int(at[k]), int(at[k + 1])
        xs, ys, i = x[a:b].tolist(), y[a:b].tolist(), 0
        mine = (marks[np.searchsorted(marks, a) : np.searchsorted(marks, b)] - a).tolist()
        for m in mine:
            if m < i:  # dropped or passed already
                continue
            px, py, i = xs[m], ys[m], m + 1
            while i < b - a and math.sqrt((xs[i] - px) ** 2 + (ys[i] - py) ** 2) < LEAST_MOVE:
                stay[a + i] = False
                i += 1
    kept = np.flatnonzero(stay)
    of = of[kept]
    paused = np.flatnonzero((np.diff(t[kept]) > PAUSE_MS) & (of[1:] == of[:-1])) + 1
    first = np.searchsorted(of, np.arange(len(at) - 1))
    anew = np.zeros(len(at) - 1, bool)
    anew[of[paused]] = True
    first[of[paused]] = paused  # of several pauses the last counts
    ends = np.searchsorted(of, np.arange(len(at) - 1), "right")
    first = np.maximum(first, ends - MOST_POINTS)
    n = ends - first
    chosen = np.repeat(first - np.concatenate(([0], n.cumsum()[:-1])), n) + np.arange(n.sum())
    return kept[chosen], np.concatenate(([0], n.cumsum())), anew


def _farthest() -> float:
    """The largest sum of distances at which two segments are alike, in the arithmetic of the definition."""
    d = SEGMENT * SEGMENT_SCALE * (1 - ALIKE)
    alike = lambda d: max(0, 1 - d / SEGMENT / SEGMENT_SCALE) > ALIKE
    while alike(d):
        d = math.nextafter(d, math.inf)
    while not alike(d):
        d = math.nextafter(d, 0)
    return d


FARTHEST = _farthest()
#: Pairs of segments that are compared in one go; segments of a trajectory from which on they are sorted first.
PAIRS, MANY = 1 << 20, 128


def _alike(v: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether segments i and j are alike; v: both offsets of each from its start, as rows (x1, y1, x2, y2)."""
    d = v[:, i] - v[:, j]
    d *= d
    return np.sqrt(d[0] + d[1]) + np.sqrt(d[2] + d[3]) <= FARTHEST


def _alike_of_many(v: np.ndarray) -> int:
    """Pairs of alike segments, at least three points apart, of one trajectory.

    Alike segments differ by less than FARTHEST in their first offset: they are sorted by it, and a block of them meets only those
    up to there. Pairs nearer than three points are counted, too, and taken off again.
    """
    n = v.shape[1]
    s = np.ascontiguousarray(v[:, np.argsort(v[0], kind="stable")])
    upto = np.searchsorted(s[0], s[0] + FARTHEST, "right")
    total, step = 0, 48
    room = np.empty((3, step * n))
    for a in range(0, n, step):
        b = min(a + step, n)
        e = max(b, int(upto[a:b].max()))
        one, two, both = (r[: (b - a) * (e - a)].reshape(b - a, e - a) for r in room)
        for k, into in ((0, both), (2, one)):
            np.subtract(s[k, a:b, None], s[k, None, a:e], out=into)
            np.multiply(into, into, out=into)
            np.subtract(s[k + 1, a:b, None], s[k + 1, None, a:e], out=two)
            np.multiply(two, two, out=two)
            np.sqrt(np.add(into, two, out=into), out=into)
        hit = np.add(both, one, out=both) <= FARTHEST
        total += np.count_nonzero(hit) - np.count_nonzero(np.tril(hit[:, : b - a]))
    for gap in range(1, min(SEGMENT, n)):
        total -= int(_alike(v, np.arange(n - gap), np.arange(gap, n)).sum())
    return total


def repetitions(x: np.ndarray, y: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of each trajectory the share of pairs of three-point segments, at least three points apart, that are alike when moved to their starts."""
    n = np.diff(at)
    of = np.repeat(np.arange(len(n)), n)
    rows = np.flatnonzero(np.arange(len(x)) <= at[of + 1] - SEGMENT)  # where a segment starts
    v = np.stack([c[rows + k] - c[rows] for k in (1, 2) for c in (x, y)]) if len(rows) else np.zeros((4, 0))
    of, segments = of[rows], np.maximum(n - SEGMENT + 1, 0)
    ends = np.repeat(segments.cumsum(), segments)
    alike, here = np.zeros(len(n)), np.arange(len(rows))
    for k in np.flatnonzero(segments > MANY).tolist():
        e = int(segments[: k + 1].sum())
        alike[k] = _alike_of_many(v[:, e - int(segments[k]) : e])
    partners = np.where(segments[of] > MANY, 0, np.maximum(ends - here - SEGMENT, 0))
    upto = partners.cumsum()
    a = 0
    while a < len(rows):
        b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + PAIRS, "right")))
        count = partners[a:b]
        i = np.repeat(here[a:b], count)
        j = np.arange(count.sum()) - np.repeat(count.cumsum() - count, count) + i + SEGMENT
        alike += np.bincount(of[i], _alike(v, i, j), len(n))
        a = b
    total = np.maximum(n - 2 * SEGMENT + 1, 0) * np.maximum(n - 2 * SEGMENT + 2, 0) / 2
    return np.divide(alike, total, out=np.zeros(len(n)), where=total > 0)


class _By:
    """Sums by trajectory over one kind of thing."""

    def __init__(self, of: np.ndarray, n: int):
        self.of, self.n = of, n
        self.count = np.bincount(of, minlength=n)

    def sum(self, v: np.ndarray) -> np.ndarray:
        return np.bincount(self.of, v, self.n)

    def mean(self, v: np.ndarray, empty: float = 0.0) -> np.ndarray:
        return np.where(self.count > 0, self.sum(v) / self.count, empty)

    def std(self, v: np.ndarray) -> np.ndarray:
        m = self.sum(v) / self.count
        return np.sqrt(self.sum((v - m[self.of]) ** 2) / self.count)

    def variability(self, v: np.ndarray, least: int) -> np.ndarray:
        """Deviation over the mean; 0 with fewer than `least` values, NaN if the mean is 0."""
        m = self.sum(v) / self.count
        return np.where(self.count < least, 0.0, np.where(m == 0, np.nan, self.std(v) / m))

    def entropy(self, bins: np.ndarray, most: int) -> np.ndarray:
        """Shannon entropy, to base 2, of bins 0 to most - 1; unknown values are a bin of their own. 0 without values."""
        b = np.where(np.isnan(bins), most, bins).astype(int)
        counts = np.bincount(self.of * (most + 1) + b, minlength=self.n * (most + 1)).reshape(self.n, most + 1)
        p = counts / np.maximum(self.count, 1)[:, None]
        return -np.where(p > 0, p * np.log2(np.where(p > 0, p, 1)), 0).sum(1) + 0.0

    def percentile(self, v: np.ndarray, q: float) -> np.ndarray:
        """Linear between the values around the rank; 0 without values, NaN if one is."""
        order = np.lexsort((v, self.of))
        v, first = v[order], np.concatenate(([0], self.count.cumsum()[:-1]))
        rank = np.maximum(self.count - 1, 0) * q
        low = first + np.floor(rank).astype(int)
        high = first + np.ceil(rank).astype(int)
        v = np.append(v, 0.0)
        last = v[np.minimum(first + np.maximum(self.count - 1, 0), len(v) - 1)]
        low, high = np.minimum(low, len(v) - 1), np.minimum(high, len(v) - 1)
        out = v[low] + (v[high] - v[low]) * (rank - np.floor(rank))
        return np.where(self.count == 0, 0.0, np.where(np.isnan(last), np.nan, out))


def batch_stats(x: np.ndarray, y: np.ndarray, t: np.ndarray, at: np.ndarray, mean_group: np.ndarray, desktop: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Which trajectories have three points or more after the intake, and of those all features; unknown ones are NaN.

    mean_group: mean size of each trajectory's groups of points, 0 without any.
    """
    with np.errstate(all="ignore"):
        keep, at, anew = taken_in(x, y, t, at)
        n = np.diff(at)
        there = n >= LEAST_POINTS
        keep = keep[np.repeat(there, n)]
        n, anew, mean_group, desktop = n[there], anew[there], mean_group[there], desktop[there]
        at, m = np.concatenate(([0], n.cumsum())), len(n)
        x, y, t = x[keep], y[keep], t[keep]
        of = np.repeat(np.arange(m), n)
        last, first = at[1:] - 1, at[:-1]

        step = np.flatnonzero(of[1:] == of[:-1])
        dx, dy, dt = (np.diff(c)[step] for c in (x, y, t))
        of = of[step]
        dist = np.sqrt(dx * dx + dy * dy)
        steps = _By(of, m)
        path, chord = steps.sum(dist), np.sqrt((x[last] - x[first]) ** 2 + (y[last] - y[first]) ** 2)
        vx, vy = dx / dt, dy / dt
        moving = dt > 0
        speeds = _By(of[moving], m)

        two = np.flatnonzero(of[1:] == of[:-1])  # a step and the next one
        ax, ay = np.diff(vx)[two] / dt[two + 1], np.diff(vy)[two] / dt[two + 1]
        forward = moving[two] & moving[two + 1]
        accel = _By(of[two][forward], m)
        cross, dot = dx[two] * dy[two + 1] - dy[two] * dx[two + 1], dx[two] * dx[two + 1] + dy[two] * dy[two + 1]
        turned = (cross != 0) | (dot != 0)
        degrees, turns = np.abs(np.degrees(np.arctan2(cross, dot)))[turned], _By(of[two][turned], m)
        both = dist[two] * dist[two + 1]
        bent = both > 0
        bends = _By(of[two][bent], m)

        three = np.flatnonzero(of[two][1:] == of[two][:-1])  # of `two` and the next of it
        jx, jy = np.diff(ax)[three] / dt[two[three] + 2], np.diff(ay)[three] / dt[two[three] + 2]
        on = forward[three] & forward[three + 1]
        jerks = _By(of[two[three]][on], m)

        out = {
            "direction_entropy": steps.entropy(np.floor((np.arctan2(dy, dx) + math.pi) / (2 * math.pi / DIRECTIONS)) % DIRECTIONS, DIRECTIONS),
            "jerk": jerks.mean(np.sqrt(jx * jx + jy * jy)[on]),
            "linearity": np.where((chord == 0) | (path == 0), 1.0, chord / path),
            "jitter": steps.mean(dist < 3),
            "speed_variability": speeds.variability((dist / dt)[moving], 2),
            "curvature": bends.mean((np.abs(cross) / both)[bent]),
            "repetition_patterns": repetitions(x, y, at),
            "time_irregularity": steps.variability(dt, 1),
            "acceleration_variability": accel.variability(np.sqrt(ax * ax + ay * ay)[forward], 2),
        }
        straight = degrees < STRAIGHT_DEG
        edge = np.flatnonzero((np.diff(straight) != 0) | (np.diff(turns.of) != 0)) + 1
        starts = np.concatenate(([0], edge)) if len(straight) else np.zeros(0, int)
        runs = np.diff(np.append(starts, len(straight)))
        long = straight[starts] & (runs >= STRAIGHT_RUN)
        in_runs = np.bincount(turns.of[starts[long]], runs[long], m)
        for_desktop = {
            "micro_jitter_2px": steps.mean(dist < 2),
            "mmv_points_per_group": np.where(anew, 0.0, mean_group),
            "long_straight_run_share": np.where(turns.count > 0, in_runs / turns.count, 0.0),
            "turn_rate_45_per_100": 100 * turns.mean(degrees > SHARP_DEG),
            "mean_abs_angle_deg": turns.mean(degrees),
            "p90_abs_angle_deg": turns.percentile(degrees, 0.9),
            "angle_entropy": turns.entropy(np.floor(degrees / ANGLE_BIN), int(180 / ANGLE_BIN) + 1),
            "curvature_per_100px": np.where((turns.count > 0) & (path != 0), 100 * turns.sum(np.radians(degrees)) / path, 0.0),
        }
        score = np.zeros(m)
        for name, only_desktop, cases in SCORE_TERMS:
            f = for_desktop[name] if only_desktop else out[name]
            term = np.zeros(m)
            for op, limit, points in reversed(cases):
                term = np.where(f < limit if op == "<" else f > limit if op == ">" else f >= limit, points, term)
            score += np.where(desktop, term, 0.0) if only_desktop else term
        out |= {k: np.where(desktop, v, np.nan) for k, v in for_desktop.items()}
        out = {k: np.where(np.isfinite(v), v, np.nan) for k, v in out.items()}
        score = np.minimum(1.0, score)
        out |= {"bot_score": score, "is_likely_bot": score > LIKELY, "n": n}
        out |= {"tm": t[last], "ms": t[last] - t[first], "l": path, "x0": x[first], "y0": y[first], "x1": x[last], "y1": y[last]}
        return there, out


def stats(x: np.ndarray, y: np.ndarray, t: np.ndarray, groups: list[int], device: str) -> dict | None:
    """`batch_stats` of one trajectory; None with fewer than three points, and for each unknown feature."""
    sizes = [g for g in groups if g > 0]
    there, out = batch_stats(x, y, t, np.array([0, len(x)]), np.array([sum(sizes) / len(sizes) if sizes else 0.0]), np.array([device == "desktop"]))
    names = features_of(device) + tuple(c for c in _NAMES if c not in COMMON + DESKTOP_ONLY)
    return {k: None if isinstance(v := out[k][0].item(), float) and math.isnan(v) else v for k in names} if there[0] else None


STATS = "n int, tm double, ms double, l double, x0 double, y0 double, x1 double, y1 double, " + ", ".join(f"{c} double" for c in COMMON + DESKTOP_ONLY) + ", bot_score double, is_likely_bot boolean"
_NAMES = [c.split()[0] for c in STATS.split(", ")]
#: Points of the trajectories that are worked off together.
POINTS_AT_ONCE = 1 << 18


def _flat(lists: list, sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([np.asarray(v, float) for v, n in zip(lists, sizes, strict=True) if n]) if sizes.any() else np.zeros(0)


def track_stats(x: Column, y: Column, tm: Column, groups: Column, device: Column) -> Column:
    """Struct of STATS for arrays x, y, tm, group sizes and the device; all fields NULL for short trajectories."""

    @F.pandas_udf(STATS)
    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for xs, ys, ts, gs, ds in batches:
            sizes = np.array([0 if a is None else len(a) for a in xs], int)
            some = [[] if g is None else [k for k in g if k > 0] for g in gs]
            group = np.array([sum(g) / len(g) if g else 0.0 for g in some])
            desktop = (ds == "desktop").to_numpy(bool)
            full = {c: np.full(len(sizes), np.nan) for c in _NAMES}
            lists = [v.tolist() for v in (xs, ys, ts)]
            upto, a = sizes.cumsum(), 0
            while a < len(sizes):
                b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + POINTS_AT_ONCE, "right")))
                at = np.concatenate(([0], sizes[a:b].cumsum()))
                there, out = batch_stats(*(_flat(v[a:b], sizes[a:b]) for v in lists), at, group[a:b], desktop[a:b])
                for c in _NAMES:
                    full[c][a:b][there] = out[c]
                a = b
            out = pd.DataFrame(full)
            none = out["n"].isna()
            yield out.assign(n=out["n"].astype("Int32"), is_likely_bot=(out["is_likely_bot"] > 0).astype("boolean").mask(none))

    return run.asNondeterministic()(x, y, tm, groups, device)  # else a filter on a field would run it twice
