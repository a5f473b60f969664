"""Projection of new points by a neighbour graph: where their nearest stored points lie, then refined.

The model is what a trained map leaves behind: its training points, their places in the plane, the number of neighbours and
the curve 1 / (1 + a d^2b) of the map (see McInnes, Healy, Melville, "UMAP", arXiv:1802.03426, whose transform of new data this is). A new point finds its
exact nearest training points, weighs them by its own local scale, starts at their weighted mean and then moves by the
map's forces: drawn to its neighbours by their weights, pushed off from other training points. The pushing points are a fixed
low-discrepancy sequence over the training points instead of random draws, and a neighbour draws in every round by its weight instead of in a share of
the rounds, so that a point's place depends on the model and on itself alone, not on the batch that it comes in.

The model is a file that is sent to every task once (its size is checked there); points come in Arrow batches.
"""

from __future__ import annotations

import io
import json
import math
import posixpath
from dataclasses import dataclass

import numpy as np

from clickloom.sources import files

from .scoring import Projection

#: Share of 2^32 that the golden ratio leaves: odd, so that multiples run through all numbers.
GOLDEN = 2_654_435_769
#: Training points and new points that are compared in one go.
BLOCK, ROWS = 8192, 1024


@dataclass(frozen=True)
class NeighbourProjection:
    """points: training points (n, d), as the scaler leaves them; places: their places (n, 2); k: neighbours; a, b: the
    curve; epochs: rounds of the refinement, 0 for none; pushes: points that push at each neighbour; rate, push: strength of steps and of pushes."""

    columns: tuple[str, ...]
    points: np.ndarray
    places: np.ndarray
    k: int = 15
    a: float = 1.5769434603113077
    b: float = 0.8950608779109733
    epochs: int = 30
    pushes: int = 5
    rate: float = 0.25
    push: float = 1.0

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(indices, distances) of the k nearest training points of each row, the nearest first, of equal ones the first."""
        k, at, far = min(self.k, len(self.points)), [], []
        for r in range(0, len(x), ROWS):
            i, d = self._nearest(x[r : r + ROWS], k)
            at.append(i)
            far.append(d)
        return (np.concatenate(at), np.concatenate(far)) if at else (np.zeros((0, k), int), np.zeros((0, k)))

    def _nearest(self, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        best = np.full((len(x), 0), 0), np.zeros((len(x), 0))
        xx = (x * x).sum(1)
        for s in range(0, len(self.points), BLOCK):
            p = self.points[s : s + BLOCK]
            pp = (p * p).sum(1)
            rough = xx[:, None] + pp - 2 * x @ p.T
            # products lose digits: what could be among the k is measured again, by differences
            slack = 1e-9 * (xx[:, None] + pp + 1)
            kth = np.partition(rough + slack, min(k, len(p)) - 1, axis=1)[:, min(k, len(p)) - 1]
            maybe = rough - slack <= kth[:, None]
            i, j = np.nonzero(maybe)
            d = np.sqrt(((x[i] - p[j]) ** 2).sum(1))
            width = int(maybe.sum(1).max(initial=0))
            place = np.arange(len(i)) - np.repeat(maybe.sum(1).cumsum() - maybe.sum(1), maybe.sum(1))
            ids, far = np.full((len(x), width), len(self.points)), np.full((len(x), width), np.inf)
            ids[i, place], far[i, place] = j + s, d
            ids, far = np.concatenate((best[0], ids), 1), np.concatenate((best[1], far), 1)
            order = np.lexsort((ids, far), axis=1)[:, :k]
            best = np.take_along_axis(ids, order, 1), np.take_along_axis(far, order, 1)
        return best

    @staticmethod
    def scale(d: np.ndarray) -> np.ndarray:
        """Of each row of distances the scale at which the neighbours after the first weigh log2(k) together, by 64 halvings."""
        low, high, mid = np.zeros(len(d)), np.full(len(d), np.inf), np.ones(len(d))
        target, rest = math.log2(max(d.shape[1], 1)), d[:, 1:]
        done = np.zeros(len(d), bool)
        for _ in range(64):
            total = np.where(rest > 0, np.exp(-rest / mid[:, None]), 1.0).sum(1)
            done |= np.abs(total - target) < 1e-5
            more = total > target
            high, low = np.where(~done & more, mid, high), np.where(~done & ~more, mid, low)
            mid = np.where(done, mid, np.where(np.isinf(high), mid * 2, (low + high) / 2))
        return np.maximum(mid, 1e-3 * d.mean(1)) if d.size else mid

    def weights(self, d: np.ndarray) -> np.ndarray:
        """Membership of each neighbour, between 0 and 1."""
        s = self.scale(d)[:, None]
        return np.where((d <= 0) | (s == 0), 1.0, np.exp(-d / np.where(s == 0, 1.0, s)))

    def start(self, i: np.ndarray, w: np.ndarray) -> np.ndarray:
        return (self.places[i] * (w / w.sum(1, keepdims=True))[:, :, None]).sum(1)

    def pushing(self, step: int) -> np.ndarray:
        """The training points that push in a step, the same for every point."""
        at = (np.arange(1, self.pushes + 1, dtype=np.uint64) + np.uint64(step * self.pushes)) * np.uint64(GOLDEN) % np.uint64(1 << 32)
        return (at * np.uint64(len(self.points)) >> np.uint64(32)).astype(int)

    def refined(self, z: np.ndarray, i: np.ndarray, w: np.ndarray) -> np.ndarray:
        """z after `epochs` rounds over the neighbours, the nearest first: a step towards each, by its weight, and steps off from the
        points that push, each clipped to 4 and all shrinking to 0."""
        z, a, b = z.copy(), self.a, self.b
        share = w / np.maximum(w.max(1, keepdims=True), 1e-300)
        for e in range(self.epochs):
            rate = self.rate * (1 - e / self.epochs)
            for j in range(i.shape[1]):
                step = (rate * share[:, j])[:, None]
                gap = z - self.places[i[:, j]]
                d2 = (gap * gap).sum(1)
                drawn = np.where(d2 > 0, -2 * a * b * np.where(d2 > 0, d2, 1.0) ** (b - 1) / (a * d2**b + 1), 0.0)
                z += step * np.clip(drawn[:, None] * gap, -4, 4)
                for n in self.pushing(e * i.shape[1] + j):
                    gap = z - self.places[n]
                    d2 = (gap * gap).sum(1)
                    pushed = np.where(d2 > 0, 2 * self.push * b / ((0.001 + d2) * (a * d2**b + 1)), 0.0)
                    z += step * np.clip(pushed[:, None] * gap, -4, 4)
        return z

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if not len(self.points):
            raise ValueError("a model without points")
        x = np.asarray(x, float)
        i, d = self.nearest(x)
        w = self.weights(d)
        return self.refined(self.start(i, w), i, w)

    def save(self, folder: str) -> None:
        """projection.json, and the arrays beside it."""
        np.savez(posixpath.join(folder, "projection.npz"), points=self.points, places=self.places)
        body = {"kind": "neighbours", "columns": list(self.columns), "arrays": "projection.npz"} | {c: getattr(self, c) for c in ("k", "a", "b", "epochs", "pushes", "rate", "push")}
        with open(posixpath.join(folder, "projection.json"), "w") as f:
            json.dump(body, f)


def load(path: str) -> Projection | NeighbourProjection:
    """The projection that a JSON file describes: linear, or by neighbours with the arrays in an NPZ file beside it; nothing is unpickled."""
    m = json.loads(files.read(path))
    if m.get("kind", "linear") != "neighbours":
        return Projection.load(path)
    with np.load(io.BytesIO(files.read(posixpath.join(posixpath.dirname(path), m["arrays"]))), allow_pickle=False) as f:
        points, places = np.asarray(f["points"], float), np.asarray(f["places"], float)
    if points.ndim != 2 or places.shape != (len(points), 2) or points.shape[1] != len(m["columns"]):
        raise ValueError("points and places don't fit")
    return NeighbourProjection(tuple(m["columns"]), points, places, **{c: m[c] for c in ("k", "a", "b", "epochs", "pushes", "rate", "push") if c in m})
