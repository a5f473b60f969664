"""Scores: distance to a centroid, probabilities, page tokens, sequence encoder, boosted trees and their merge.

Models are plain JSON or NPZ files: nothing is unpickled.
"""

from __future__ import annotations

import io
import json
import math
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.sources import files

from .quantiles import quantiles
from .scaling import aligned

# Floors of the probabilities.
FLOOR, TAIL_FLOOR = 0.01, 0.001
# Page types by pattern of the path; the first that is found counts.
PAGE_PATTERNS = (
    (r"/personal/order/make/", "order_make"),
    (r"/personal/cart/", "cart"),
    (r"^/personal/orders/", "personal_orders"),
    (r"^/personal/", "personal"),
    (r"^/search", "search"),
    (r"^/store", "store"),
    (r"^/here_to_help/", "here_to_help"),
    (r"^/culinary-world/", "culinary_world"),
    (r"^/auth", "auth"),
    (r"/filter/", "catalog_filter"),
    (r"^/catalog/[^/]+/[^/]+/[^/]+/[^/]+/?", "catalog_4_levels"),
    (r"^/catalog/[^/]+/[^/]+/[^/]+/?", "catalog_3_levels"),
    (r"^/catalog/[^/]+/[^/]+/?", "catalog_2_levels"),
    (r"^/catalog/[^/]+/?", "catalog_1_levels"),
    (r"^/catalog/?$", "catalog"),
    (r"^/$", "home"),
)


# ---------------------------------------------------------------- probabilities


def sigma(p95: float, p99: float, floor: float = FLOOR, tail: float = TAIL_FLOOR) -> float:
    """How fast the probability falls beyond p95, so that it is `tail` at p99."""
    if p99 <= p95:
        return max(p95, 1e-6)
    return max(p99 - p95, 1e-6) if floor <= tail else (p99 - p95) / math.log(floor / tail)


def linear(d: Column, p95: float, floor: float = FLOOR) -> Column:
    if p95 <= 0:
        return F.when(d.isNotNull(), 0.0)
    return F.when(d.isNotNull(), F.greatest(F.least(F.greatest(1 - d / p95, F.lit(0.0)), F.lit(1.0)), F.lit(floor)))


def decay(d: Column, p95: float, p99: float, floor: float = FLOOR, tail: float = TAIL_FLOOR) -> Column:
    if p95 <= 0:
        return F.when(d.isNotNull(), 0.0)
    inner = F.greatest(1 - d / p95, F.lit(floor))
    outer = floor * F.exp(-(d - p95) / sigma(p95, p99, floor, tail))
    return F.when(d.isNotNull(), F.greatest(F.when(d <= p95, inner).otherwise(outer), F.lit(tail)))


def probability(d: Column, centroid: dict, mode: str | None = None) -> Column:
    """By mode decay (default; also for unknown modes) or linear; decay without `all_distance_p99` is linear. p95 is required."""
    p95 = float(centroid["bot_distance_p95"])
    mode = (mode or "decay").strip().lower()
    if mode == "linear" or centroid.get("all_distance_p99") is None:
        return linear(d, p95)
    return decay(d, p95, float(centroid["all_distance_p99"]))


def probabilities(d: np.ndarray, centroid: dict, mode: str | None = None) -> np.ndarray:
    """`probability` for an array of distances."""
    p95, p99 = float(centroid["bot_distance_p95"]), centroid.get("all_distance_p99")
    if p95 <= 0:
        return np.zeros(len(d))
    inner = np.maximum(np.clip(1 - d / p95, 0.0, 1.0), FLOOR)
    if (mode or "decay").strip().lower() == "linear" or p99 is None:
        return inner
    return np.maximum(np.where(d <= p95, inner, FLOOR * np.exp(-(d - p95) / sigma(p95, float(p99)))), TAIL_FLOOR)


def distance(x: Column, y: Column, centroid: dict) -> Column:
    dx, dy = x - float(centroid["centroid_x"]), y - float(centroid["centroid_y"])
    return F.sqrt(dx * dx + dy * dy)


@dataclass(frozen=True)
class Projection:
    """A linear projection to two dimensions, for tests and as the form of an exported model: x @ weights + bias."""

    columns: tuple[str, ...]
    weights: tuple[tuple[float, float], ...]
    bias: tuple[float, float] = (0.0, 0.0)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return x @ np.asarray(self.weights, float) + np.asarray(self.bias, float)

    @classmethod
    def load(cls, path: str) -> Projection:
        m = json.loads(files.read(path))
        return cls(tuple(m["columns"]), tuple(map(tuple, m["weights"])), tuple(m.get("bias", (0.0, 0.0))))


def _listed(key: Sequence[str] | str) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _typed(df: DataFrame, key: list[str]) -> str:
    return ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in key)


def _numbers(batch: pa.RecordBatch, columns: Sequence[str]) -> np.ndarray:
    """A matrix of the batch's columns; NULL is NaN."""
    cols = [batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in columns]
    return np.stack(cols, 1) if cols else np.zeros((batch.num_rows, 0))


def score_projection(features: DataFrame, model: Callable[[np.ndarray], np.ndarray], columns: list[str], centroid: dict, mode: str | None = None, key: Sequence[str] | str = "session_id") -> DataFrame:
    """(key, probability_bot_umap): only the projection runs in Python, in Arrow batches; distance and probability are expressions."""
    key = _listed(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            z = np.nan_to_num(np.asarray(model(_numbers(b, columns)), float), nan=0.0, posinf=1e10, neginf=-1e10)
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in key), pa.array(z[:, 0]), pa.array(z[:, 1])], names=[*key, "px", "py"])

    flat = aligned(features, columns, key).mapInArrow(run, f"{_typed(features, key)}, px double, py double")
    return flat.select(*key, probability(distance(F.col("px"), F.col("py"), centroid), centroid, mode).alias("probability_bot_umap"))


# ---------------------------------------------------------------- page tokens


def page_type(uri: Column, patterns: Sequence[tuple[str, str]] = PAGE_PATTERNS) -> Column:
    """Type of a page's path (up to `?`), NULL where no pattern is found."""
    path = F.substring_index(F.coalesce(uri, F.lit("")), "?", 1)
    found = F.lit(None).cast("string")
    for pattern, name in reversed(patterns):
        found = F.when(path.rlike(pattern), name).otherwise(found)
    return found


def page_sequences(records: DataFrame, key: Sequence[str] | str = "session_id", patterns: Sequence[tuple[str, str]] = PAGE_PATTERNS) -> DataFrame:
    """(key, tokens): types of the first record of each page view, by ts (unknown: 0) and arrival; unmatched ones are left out.

    records: key, page_id, uri, ts, seq. All records without a page id are one page view.
    """
    key = _listed(key)
    w = Window.partitionBy(*key, "page_id").orderBy("_ts", "seq")
    first = records.withColumn("_ts", F.coalesce("ts", F.lit(0.0))).withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
    typed = first.withColumn("_type", page_type(F.col("uri"), patterns))
    return typed.groupBy(*key).agg(F.expr("transform(array_sort(collect_list(case when _type is not null then struct(_ts, seq, _type) end)), x -> x._type)").alias("tokens"))


def token_ids(tokens: str, vocabulary: dict[str, int], most: int) -> Column:
    """Ids of the first `most` tokens, those outside the vocabulary then left out. The vocabulary is a model's: a short list."""
    pairs = [x for k, v in vocabulary.items() for x in (F.lit(k), F.lit(v))]
    known = F.create_map(*pairs)
    return F.filter(F.transform(F.slice(tokens, 1, most), lambda t: F.element_at(known, t)), lambda i: i.isNotNull())


# ---------------------------------------------------------------- encoder


@dataclass(frozen=True)
class Encoder:
    """A pre-norm transformer whose first position is the summary. weights: arrays by name, see `names`."""

    weights: dict[str, np.ndarray]
    heads: int = 4
    layers: int = 2
    most: int = 64
    batch: int = 256

    names = "embed position cls norm.g norm.b {i}.norm1.g {i}.norm1.b {i}.qkv.w {i}.qkv.b {i}.out.w {i}.out.b {i}.norm2.g {i}.norm2.b {i}.ff1.w {i}.ff1.b {i}.ff2.w {i}.ff2.b"

    @property
    def width(self) -> int:
        return self.weights["embed"].shape[1]

    @classmethod
    def load(cls, path: str, **config: int) -> Encoder:
        with np.load(io.BytesIO(files.read(path)), allow_pickle=False) as f:
            return cls({k: f[k] for k in f.files}, **config)

    def __call__(self, ids: Sequence[Sequence[int]]) -> np.ndarray:
        """(n, width): padded positions are masked; each batch on its own."""
        return np.concatenate([self._batch(ids[i : i + self.batch]) for i in range(0, len(ids), self.batch)]) if len(ids) else np.zeros((0, self.width), np.float32)

    def _batch(self, ids: Sequence[Sequence[int]]) -> np.ndarray:
        p, d = self.weights, self.width
        n, most = len(ids), max(map(len, ids), default=0)
        x = np.zeros((n, most + 1, d), np.float64)
        masked = np.ones((n, most + 1), bool)
        x[:, 0] = p["cls"] + p["position"][0]
        masked[:, 0] = False
        for i, row in enumerate(ids):
            k = len(row)
            if k:
                x[i, 1 : k + 1] = p["embed"][np.asarray(row, int)] * math.sqrt(d) + p["position"][1 : k + 1]
                masked[i, 1 : k + 1] = False
        for i in range(self.layers):
            x = x + self._attend(_norm(x, p[f"{i}.norm1.g"], p[f"{i}.norm1.b"]), masked, i)
            h = np.maximum(_norm(x, p[f"{i}.norm2.g"], p[f"{i}.norm2.b"]) @ p[f"{i}.ff1.w"] + p[f"{i}.ff1.b"], 0)
            x = x + h @ p[f"{i}.ff2.w"] + p[f"{i}.ff2.b"]
        return _norm(x[:, 0], p["norm.g"], p["norm.b"]).astype(np.float32) if "norm.g" in p else x[:, 0].astype(np.float32)

    def _attend(self, x: np.ndarray, masked: np.ndarray, i: int) -> np.ndarray:
        p, (n, length, d) = self.weights, x.shape
        q, k, v = np.split((x @ p[f"{i}.qkv.w"] + p[f"{i}.qkv.b"]).reshape(n, length, 3, self.heads, -1).transpose(2, 0, 3, 1, 4), 3)
        a = q[0] @ k[0].swapaxes(-1, -2) / math.sqrt(d // self.heads)
        a = np.where(masked[:, None, None, :], -np.inf, a)
        a = np.exp(a - a.max(-1, keepdims=True))
        out = (a / a.sum(-1, keepdims=True)) @ v[0]
        return out.transpose(0, 2, 1, 3).reshape(n, length, d) @ p[f"{i}.out.w"] + p[f"{i}.out.b"]


def _norm(x: np.ndarray, g: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (x - x.mean(-1, keepdims=True)) / np.sqrt(x.var(-1, keepdims=True) + 1e-5) * g + b


def embed(sequences: DataFrame, encoder: Encoder, vocabulary: dict[str, int], key: Sequence[str] | str = "session_id") -> DataFrame:
    """(key, embedding) for each session with a known token; others are left out."""
    key = _listed(key)
    ids = sequences.select(*key, token_ids("tokens", vocabulary, encoder.most).alias("ids")).where(F.size("ids") > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = encoder(b.column("ids").to_pylist()).astype(np.float32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * encoder.width), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in key), lists], names=[*key, "embedding"])

    return ids.mapInArrow(run, f"{_typed(sequences, key)}, embedding array<float>")


# ---------------------------------------------------------------- trees


@dataclass(frozen=True)
class Trees:
    """Boosted trees as arrays: of each tree feature, threshold, left, right (a negative child is the leaf ~child) and leaf values.

    A row goes left if its value is at most the threshold, and where it is unknown if `missing_left`.
    """

    columns: tuple[str, ...]
    trees: tuple[dict, ...]
    base: float = 0.0
    embedding: int = 64
    missing_left: bool = True
    scaler: dict = field(default_factory=dict)

    REQUIRED = ("feature_columns", "trees")

    @classmethod
    def load(cls, path: str) -> Trees:
        m = json.loads(files.read(path))
        if lost := [k for k in cls.REQUIRED if k not in m]:
            raise ValueError(f"tree model without {lost}")
        return cls(tuple(m["feature_columns"]), tuple(m["trees"]), m.get("base", 0.0), m.get("embedding_dim", 64), m.get("missing_left", True), m.get("scaler", {}))

    def save(self, path: str) -> None:
        with open(path, "w") as f:
            json.dump({"version": 1, "feature_columns": list(self.columns), "trees": list(self.trees), "base": self.base, "embedding_dim": self.embedding, "missing_left": self.missing_left, "scaler": self.scaler}, f)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for t in self.trees:
            feature, at = np.asarray(t["feature"], int), np.asarray(t["threshold"], float)
            child = np.stack((np.asarray(t["left"], int), np.asarray(t["right"], int)))
            node = np.zeros(len(x), int) if len(feature) else np.full(len(x), -1)
            while (inner := node >= 0).any():
                i = np.flatnonzero(inner)
                v = x[i, feature[node[i]]]
                right = np.where(np.isnan(v), not self.missing_left, v > at[node[i]])
                node[i] = child[right.astype(int), node[i]]
            total += np.asarray(t["leaf"], float)[~node]
        return 1 / (1 + np.exp(-total))

    def column(self) -> Column:
        """The same score as one expression, for small ensembles."""

        def node(t: dict, k: int) -> Column:
            if k < 0:
                return F.lit(float(t["leaf"][~k]))
            c = F.col(f"`{self.columns[t['feature'][k]]}`")
            left = F.coalesce(c <= float(t["threshold"][k]), F.lit(self.missing_left))
            return F.when(left, node(t, t["left"][k])).otherwise(node(t, t["right"][k]))

        total = F.lit(self.base)
        for t in self.trees:
            total = total + node(t, 0 if t["feature"] else -1)
        return 1 / (1 + F.exp(-total))


def tree_matrix(features: DataFrame, embeddings: DataFrame, model: Trees, key: Sequence[str] | str = "session_id") -> DataFrame:
    """key and the model's columns: sessions with features, their embedding or zeros, in the model's order."""
    key = _listed(key)
    zeros = F.array_repeat(F.lit(0.0).cast("float"), model.embedding)
    e = F.coalesce("embedding", zeros)
    joined = features.join(embeddings, key, "left").withColumn("embedding", F.when(F.size(e) == model.embedding, e).otherwise(F.raise_error(F.lit("embedding of another width"))))
    named = re.compile(r"transformer_embedding_(\d+)\Z")
    pick = lambda c: F.get("embedding", F.lit(int(m[1]))) if (m := named.match(c)) else F.col(c)
    return joined.select(*key, *(pick(c).cast("float").alias(c) for c in model.columns))


def score_trees(matrix: DataFrame, model: Trees, key: Sequence[str] | str = "session_id") -> DataFrame:
    """(key, probability_lgbm)."""
    key, columns = _listed(key), list(model.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = np.asarray(model(_numbers(b, columns)), float)
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in key), pa.array(p)], names=[*key, "probability_lgbm"])

    return matrix.mapInArrow(run, f"{_typed(matrix, key)}, probability_lgbm double")


# ---------------------------------------------------------------- merge

SCORES = ["probability_bot_umap", "probability_lgbm"]


def merge_scores(bots: DataFrame, trees: DataFrame | None, existing: DataFrame | None = None, key: list[str] | str = "session_id") -> DataFrame:
    """key and both scores. Full rebuild (no `existing`): sessions of either; else existing rows take over what is new, column by column."""
    key = _listed(key)
    if trees is None:
        trees = bots.select(*key, F.lit(None).cast("double").alias(SCORES[1])).limit(0)
    new = bots.join(trees, key, "full")
    if existing is None:
        return new.select(*key, *SCORES)
    fresh = [c + "_new" for c in SCORES]
    renamed = new.select(*key, *(F.col(c).alias(f) for c, f in zip(SCORES, fresh, strict=True)))
    return existing.join(renamed, key, "full").select(*key, *(F.coalesce(f, c).alias(c) for c, f in zip(SCORES, fresh, strict=True)))


def needs_rebuild(changed: DataFrame | None, full_rebuild: bool, existing: DataFrame | None, force: bool = False) -> bool:
    """No changed set, its flag, a force, no earlier scores, or earlier ones of which no bot score is known."""
    if changed is None or full_rebuild or force or existing is None:
        return True
    return existing.where(F.col(SCORES[0]).isNotNull()).isEmpty()


def distribution(scores: DataFrame, column: str = SCORES[0]) -> DataFrame:
    """One row: min, median and max of the known scores. The median is found by rounds of counts."""
    ends = scores.agg(F.min(column).alias("min"), F.max(column).alias("max"))
    return ends.select("min", F.lit(quantiles(scores, [column], [0.5])[column][0]).cast("double").alias("median"), "max")
