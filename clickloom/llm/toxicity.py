"""Toxicity: a weighted lexicon matched by Aho-Corasick in folded text.

Folding lowers case, maps homoglyphs of Latin letters and, inside words with a letter, digits and
signs that stand for letters. The lexicon is a seed list plus word stems of any length, and short whole words, learned from labelled
training rows (counts of documents with and without the label, over executors); a stem's weight is
its smoothed log odds. As many stems count as have the evidence. A stem counts where a word begins, unless it lies in an exception phrase.
A document's sum of weights, normalised by a power of its length, goes through a logistic curve
fitted on the same rows.

The training sample has at most `sample` rows, by smallest hashed id, never held-out ones. A null
or empty text has no hits and the score of no hits. Without labels of both kinds the seed list
alone decides. Repeated rows score alike, and the same id teaches once; equal weights are all kept, so ties need no choice. Very long texts are
folded and searched whole, in time near linear in their length. An empty table gives an empty result; only doc_id and
text are read, so other columns can't clash.
"""

from __future__ import annotations

import bisect
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_fold, labelled_sample, lean

# A seed lexicon of stems with weights, and phrases in which they are harmless.
SEED = {
    "idiot": 3.0, "moron": 3.0, "stupid": 2.5, "imbecil": 3.0, "scum": 3.0, "loser": 2.5, "worthless": 2.5, "pathetic": 2.5,
    "disgusting": 2.5, "asshole": 4.0, "bastard": 3.0, "bitch": 3.5, "fuck": 3.5, "cunt": 4.0, "retard": 3.5, "dumbass": 3.5,
}
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "trash collect", "clown fish", "clownfish", "circus clown", "stupid me",
              "loser of the match", "not stupid", "bastard file", "scumble", "scumming")
# Letters that look like Latin ones, and signs that stand for letters.
HOMOGLYPHS = str.maketrans("абсԁеёһіјкӏмоөрԛѕтυуԝхαβγεικνορτυχϲııɑɡ", "abcdeehijklmoopqstuywxabyeikvoptuxciiag")
SIGNS = str.maketrans("0134578@$!|", "oieastbasil")
_WORD = re.compile(r"[^\W_]+")


def folded(text: str) -> str:
    """Lower case without accents on Latin homoglyphs; digits and signs become letters in mixed words only."""
    low = text.lower()
    if not low.isascii():
        low = unicodedata.normalize("NFKC", low).lower().translate(HOMOGLYPHS)
        low = low.replace("​", "").replace("‌", "").replace("‍", "").replace("­", "")
    if low.isascii() and not any(c in low for c in "0134578@$!|"):
        return low
    out = []
    for word in low.split(" "):
        core = word.rstrip("!$|@.,;:?")
        if core and not core.isalpha() and any(c.isalpha() for c in core):
            word = core.translate(SIGNS) + word[len(core):]
        out.append(word)
    return " ".join(out)


#: A word of fewer letters counts whole, and is written with this mark at its end, which no word has.
SHORTEST, WHOLE = 4, "."
#: Letters up to which each beginning of a word is a stem; longer ones are those of 64, 128, ... letters and the word.
STEPS = 32


def stems(text: str) -> set[str]:
    found = set()
    for w in set(_WORD.findall(text)):
        n = len(w)
        if n < SHORTEST:
            found.add(w + WHOLE)
            continue
        found.update(w[:k] for k in range(SHORTEST, min(n, STEPS) + 1))
        k = 2 * STEPS
        while k < n:
            found.add(w[:k])
            k *= 2
        found.add(w)
    return found


@dataclass(frozen=True)
class Fit:
    """sample: most training rows; support: least toxic documents with a stem; odds: least log odds; evidence: least log
    likelihood ratio against no connection, so that of very many stems few get in by chance: these alone decide which stems count;
    power: of the length in words by which sums are divided; most: stems that can be sent to every task: with more, `learn` raises."""

    sample: int = 20_000
    support: int = 3
    odds: float = 2.5
    evidence: float = 10.0
    power: float = 0.1
    most: int = 500_000


@dataclass(frozen=True)
class Lexicon:
    weights: dict[str, float]
    slope: float = 1.5
    middle: float = 1.5
    power: float = 0.1
    exceptions: tuple[str, ...] = EXCEPTIONS

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            whole = term.endswith(WHOLE)
            letters = term[:-1] if whole else term
            found.add_word(letters, (len(letters), weight, whole))
        for phrase in self.exceptions:
            found.add_word(phrase, (len(phrase), None, False))
        found.make_automaton()
        return found

    def total(self, automaton: ahocorasick.Automaton, text: str) -> tuple[float, int]:
        """Sum of the weights of the words hit, divided by the length's power; number of hits."""
        low = folded(text)
        best: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        for last, (length, weight, whole) in automaton.iter(low):
            at = last + 1 - length
            if at and low[at - 1].isalnum() or whole and low[last + 1 : last + 2].isalnum():
                continue
            if weight is None:
                spared.append((at, last))
            elif weight > best.get(at, 0.0):
                best[at] = weight
        if spared:
            best = _outside(best, spared)
        n = low.count(" ") + low.count("\n") + 1
        return sum(best.values()) / n**self.power, len(best)

    def score(self, total: float) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.slope * (total - self.middle)))))


def _outside(hits: dict[int, float], spans: list[tuple[int, int]]) -> dict[int, float]:
    """The hits that begin in no span; spans are joined first, so that time stays near linear."""
    starts: list[int] = []
    ends: list[int] = []
    for a, b in sorted(spans):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    inside = lambda at: (k := bisect.bisect_right(starts, at)) > 0 and at <= ends[k - 1]
    return {at: w for at, w in hits.items() if not inside(at)}


def learn(docs: DataFrame, labels: DataFrame, fit: Fit = Fit(), label: str = "toxic") -> Lexicon:
    """Counts stems in the training rows on the executors, then picks the lexicon on the driver.

    Of rows that repeat an id the least text counts. To the driver come the stems with enough evidence, at most fit.most, and
    the number of training rows for each rounded sum and label.
    """
    rows = F.broadcast(labelled_sample(labels, label, fit.sample))  # at most fit.sample rows of two numbers
    known = docs.select("doc_id", "text").where("text is not null").join(rows, "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text")).select("text", "y").persist()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for batch in batches:
            for text, y in zip(batch["text"], batch["y"], strict=True):
                seen[int(y > 0)].update(stems(folded(text)))
                if sum(map(len, seen.values())) > 150_000:  # bounded memory; the sums go on in Spark
                    yield _counted(seen)
                    seen = {0: Counter(), 1: Counter()}
        if any(seen.values()):  # an empty frame has no type to send
            yield _counted(seen)
        del seen
        lean()

    n = {int(r["y"] > 0): r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        known.unpersist()
        return Lexicon(dict(SEED), power=fit.power)
    odds = F.log((F.col("bad") + 0.5) / (n[1] + 1)) - F.log((F.col("good") + 0.5) / (n[0] + 1))
    both = F.col("bad") + F.col("good")
    log_part = lambda n, expected: F.when(n > 0, n * F.log(n / expected)).otherwise(0.0)
    share = n[1] / (n[0] + n[1])
    evidence = log_part(F.col("bad"), both * share) + log_part(F.col("good"), both * (1 - share))
    top = (
        known.mapInPandas(count, "stem string, bad long, good long")
        .groupBy("stem").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
        .withColumn("odds", odds)
        .where((F.col("bad") >= fit.support) & (F.col("odds") >= fit.odds) & (evidence >= fit.evidence))
        .limit(fit.most + 1)
        .collect()
    )
    if len(top) > fit.most:
        raise ValueError(f"more than {fit.most} stems have evidence: ask for more of it")
    weights = _picked([(r["stem"], r["bad"], r["odds"]) for r in top])
    lexicon = Lexicon({**{k: v for k, v in SEED.items() if not any(k.startswith(w) for w in weights)}, **weights}, power=fit.power)

    def totals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = lexicon.automaton()
        for batch in batches:
            yield pd.DataFrame({"x": [lexicon.total(automaton, t)[0] for t in batch["text"]], "y": batch["y"] > 0})

    # rounded and counted, so that few numbers reach the driver
    seen = known.mapInPandas(totals, "x double, y boolean").groupBy(F.round("x", 3).alias("x"), "y").agg(F.count(F.lit(1)).alias("n")).orderBy("x", "y").collect()
    known.unpersist()
    slope, middle = _curve(*(np.array([r[c] for r in seen], float) for c in "xyn"))
    return Lexicon(lexicon.weights, slope, middle, fit.power)


def _counted(seen: dict[int, Counter]) -> pd.DataFrame:
    names = list(seen[0].keys() | seen[1].keys())
    return pd.DataFrame({"stem": names, "bad": [seen[1][x] for x in names], "good": [seen[0][x] for x in names]})


def _picked(found: list[tuple[str, int, float]]) -> dict[str, float]:
    """Of stems that begin with one another, the longest that is in nearly all documents of the shorter one."""
    by = {s: (bad, odds) for s, bad, odds in found}
    sizes = sorted({len(s) for s in by})
    shorter = {t[:k] for t in by for k in sizes if k < len(t) and t[:k] in by and by[t][0] >= 0.95 * by[t[:k]][0]}
    out: dict[str, float] = {}
    for s in sorted(by.keys() - shorter, key=lambda s: (len(s), s)):
        if not any(s[:k] in out for k in sizes if k < len(s)):
            out[s] = float(by[s][1])
    return out


def _curve(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Logistic curve through n rows of each x and y by Newton's steps with a little shrinkage, so that separable data end too."""
    w, X = np.zeros(2), np.stack([x, np.ones_like(x)], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(X @ w, -30, 30)))
        H = X.T @ (X * (n * p * (1 - p))[:, None]) + 0.05 * np.eye(2)
        step = np.linalg.solve(H, X.T @ (n * (y - p)) - 0.05 * w)
        w += step
        if abs(step).max() < 1e-8:
            break
    slope = max(float(w[0]), 1e-3)
    return slope, float(-w[1] / slope)


def score(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted, hits for every row of `docs`."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            found = [lexicon.total(automaton, t.as_py() or "") for t in batch.column(1)]
            s = np.array([lexicon.score(x) for x, _ in found], float)
            hits = pa.array([h for _, h in found], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array((s >= threshold).astype(np.int32)), hits], names=["doc_id", "score", "predicted", "hits"])

    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double, predicted int, hits int")
    return scored.select("doc_id", in_fold("doc_id").alias("held_out"), "score", "predicted", "hits")


def clean_only(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.5) -> DataFrame:
    """Rows of `docs`, with all columns, that the lexicon doesn't reject."""

    @F.pandas_udf("boolean")
    def rejected(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = lexicon.automaton()
        for batch in batches:
            yield pd.Series([lexicon.score(lexicon.total(automaton, t or "")[0]) >= threshold for t in batch], dtype=bool)

    return docs.where(~rejected("text"))
