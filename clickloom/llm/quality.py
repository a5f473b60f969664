"""Quality classifier: a sparse rule ensemble over statistics of the text.

Shallow trees are boosted on labelled training rows; each path from a root is a conjunctive rule
over statistics. A logistic regression with an L1 penalty weighs the rules and leaves most at zero;
what is left is one Spark column expression.

The training sample has at most `sample` rows, by smallest hashed id, never held-out ones; its
statistics (a few numbers a row) are fitted on the driver. Labels, lang, source and doc_id are no
inputs. A null text counts as empty; empty texts have all statistics 0 and get a score. Without
training rows of both kinds every score is the share of label 1 (0.5 without any). Repeated rows
score alike; an empty table gives an empty result; other columns can't clash. Very long texts are read whole, in time
linear in their length, one at a time. Of cuts of equal gain the first statistic's lowest one is taken, so that a fit is the same on every run; scores aren't ranked.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_fold, labelled_sample

STATISTICS = (
    "n_words", "mean_word", "upper", "upper_words", "digits", "marks", "bars", "bangs", "stops", "commas", "odd", "lines", "repeated_lines",
    "longest_line", "distinct_words", "top_word", "short_words", "odd_ends", "entropy",
)
_UPPER, _DIGITS = bytes(range(65, 91)), bytes(range(48, 58))
_MARKS = b"#$%&*@^~_=+<>\\{}[]"
_LETTERS = bytes(range(97, 123)) + _UPPER + bytes(range(128, 256))


def statistics(text: str) -> tuple[float, ...]:
    """Shares and means over the whole text, in the order of STATISTICS."""
    b = text.encode("utf-8", "surrogatepass")
    w = b.split()
    if not w:
        return (0.0,) * len(STATISTICS)
    n, size = len(b), len(w)
    less = lambda s: (n - len(b.translate(None, s))) / n
    lines = [x for x in b.split(b"\n") if x.strip()]
    per_line, per_word = Counter(lines), Counter(w)
    letters = b.translate(None, _LETTERS)
    chars = np.bincount(np.frombuffer(b, np.uint8), minlength=256) / n
    chars = chars[chars > 0]
    return (
        float(size), sum(map(len, w)) / size, less(_UPPER), sum(x.isupper() for x in w) / size, less(_DIGITS), less(_MARKS), b.count(b"|") / size,
        b.count(b"!") / size, b.count(b".") / size, b.count(b",") / size, len(letters) / n, float(len(lines)),
        1 - len(per_line) / len(lines), max(map(len, lines)) / n, len(per_word) / size, max(per_word.values()) / size, sum(len(x) <= 3 for x in w) / size,
        sum(x[-1:] in b"#$%&*!|@" for x in w) / size, float(-(chars * np.log2(chars)).sum()),
    )


def with_statistics(docs: DataFrame, *others: str) -> DataFrame:
    """doc_id, `others` and `s`, the struct of STATISTICS, of every row."""

    @F.pandas_udf(", ".join(f"{x} double" for x in STATISTICS))
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([statistics(t or "") for t in texts], columns=list(STATISTICS), dtype=float)

    return docs.select("doc_id", *others, run("text").alias("s"))


#: (statistic, at most?, threshold); a rule holds where all its conditions do.
Rule = tuple[tuple[str, bool, float], ...]


@dataclass(frozen=True)
class Fit:
    """sample: most training rows; trees, depth, rate: of the boosting; cuts: thresholds tried a statistic;
    penalty: of the L1 norm, a row; least: rows in a leaf."""

    sample: int = 20_000
    trees: int = 24
    depth: int = 3
    rate: float = 0.3
    cuts: int = 48
    penalty: float = 2e-4
    least: int = 8
    rounds: int = 400


@dataclass(frozen=True)
class Ensemble:
    rules: tuple[tuple[Rule, float], ...]
    bias: float

    def column(self, s: str = "s") -> Column:
        """The score as one expression over the struct of statistics."""
        total = F.lit(float(self.bias))
        for rule, weight in self.rules:
            holds = F.lit(True)
            for name, below, at in rule:
                holds &= (F.col(f"{s}.{name}") <= at) if below else (F.col(f"{s}.{name}") > at)
            total += F.when(holds, F.lit(float(weight))).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def _tree(X: np.ndarray, g: np.ndarray, h: np.ndarray, cuts: list[np.ndarray], fit: Fit) -> tuple[list[Rule], np.ndarray]:
    """Paths of one regression tree on gradients, and its step for each row."""
    paths: list[Rule] = []
    step = np.zeros(len(g))

    def grow(rows: np.ndarray, path: Rule, depth: int) -> None:
        if path:
            paths.append(path)
        best = (1e-6, None)
        if depth < fit.depth and len(rows) >= 2 * fit.least:
            G, H = g[rows].sum(), h[rows].sum()
            for k, at in enumerate(cuts):
                if not len(at):
                    continue
                where = np.searchsorted(at, X[rows, k], side="left")  # X <= at[i] for i >= where
                gs = np.bincount(where, g[rows], len(at) + 1).cumsum()[:-1]
                hs = np.bincount(where, h[rows], len(at) + 1).cumsum()[:-1]
                ns = np.bincount(where, minlength=len(at) + 1).cumsum()[:-1]
                gain = gs**2 / (hs + 1) + (G - gs) ** 2 / (H - hs + 1) - G**2 / (H + 1)
                gain[(ns < fit.least) | (len(rows) - ns < fit.least)] = 0
                if gain.max() > best[0]:
                    best = (gain.max(), (k, at[gain.argmax()]))
        if best[1] is None:
            step[rows] = -g[rows].sum() / (h[rows].sum() + 1)
            return
        k, at = best[1]
        left = X[rows, k] <= at
        grow(rows[left], (*path, (STATISTICS[k], True, float(at))), depth + 1)
        grow(rows[~left], (*path, (STATISTICS[k], False, float(at))), depth + 1)

    grow(np.arange(len(g)), (), 0)
    return paths, step


def _holds(X: np.ndarray, rule: Rule) -> np.ndarray:
    ok = np.ones(len(X), bool)
    for name, below, at in rule:
        x = X[:, STATISTICS.index(name)]
        ok &= (x <= at) if below else (x > at)
    return ok


def ensemble(X: np.ndarray, y: np.ndarray, fit: Fit = Fit()) -> Ensemble:
    """Boosts trees, takes their paths as rules and fits the L1-penalised logistic weights (accelerated proximal steps)."""
    share = float(y.mean()) if len(y) else 0.5
    if len(y) < 2 * fit.least or share in (0.0, 1.0):
        share = min(max(share, 1e-3), 1 - 1e-3)
        return Ensemble((), math.log(share / (1 - share)))
    cuts = [np.unique(np.quantile(X[:, k], np.linspace(0, 1, fit.cuts + 2)[1:-1])) for k in range(X.shape[1])]
    f = np.full(len(y), math.log(share / (1 - share)))
    rules: dict[Rule, None] = {}
    for _ in range(fit.trees):
        p = 1 / (1 + np.exp(-f))
        paths, step = _tree(X, p - y, p * (1 - p), cuts, fit)
        rules.update(dict.fromkeys(paths))
        f += fit.rate * step
    names = list(rules)
    R = np.stack([_holds(X, r) for r in names], 1).astype(float)
    A = np.concatenate((R, np.ones((len(y), 1))), 1)
    lipschitz = np.linalg.norm(A.T @ A, 2) / (4 * len(y))
    w = z = np.zeros(A.shape[1])
    t = 1.0
    for _ in range(fit.rounds):
        grad = A.T @ (1 / (1 + np.exp(-np.clip(A @ z, -30, 30))) - y) / len(y)
        new = z - grad / lipschitz
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - fit.penalty / lipschitz, 0)
        t, last = (1 + math.sqrt(1 + 4 * t * t)) / 2, t
        z, w = new + (last - 1) / t * (new - w), new
    return Ensemble(tuple((r, float(v)) for r, v in zip(names, w[:-1], strict=True) if abs(v) > 1e-6), float(w[-1]))


def learn(docs: DataFrame, labels: DataFrame, fit: Fit = Fit(), label: str = "quality") -> Ensemble:
    """The ensemble of the training rows: one of each labelled id, of several texts the one with the least statistics."""
    rows = F.broadcast(labelled_sample(labels, label, fit.sample))  # at most fit.sample rows of two numbers
    known = docs.select("doc_id", "text").join(rows, "doc_id")
    found = with_statistics(known, "y").groupBy("doc_id", "y").agg(F.min("s").alias("s")).select("doc_id", "y", "s.*")
    got = found.toPandas().sort_values("doc_id", kind="stable")  # one order on every run
    return ensemble(got[list(STATISTICS)].to_numpy(float), (got["y"] > 0).to_numpy(float), fit)


def score(docs: DataFrame, model: Ensemble, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of `docs`."""
    scored = with_statistics(docs).select("doc_id", in_fold("doc_id").alias("held_out"), model.column().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
