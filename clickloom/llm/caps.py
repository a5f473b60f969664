"""Embedding near-duplicates by spherical-cap filters.

Filter directions are a random product code: a random rotation, then in each of `blocks` blocks
the signed coordinate axes. A filter takes one axis from each block, and its inner product with a
vector is a sum of coordinates. Each vector is list-decoded to all filters that its inner product
exceeds a bound for. What is sent to a filter is a sketch of a byte a component with its exact error; only vectors
that by those bounds may link with another one there are sent whole, and verified by cosine in double precision.

The bound hangs on the vector's best filter: a pair at the threshold angle t is counted at the best
filter of its midpoint, and from there either vector's sum can lie below its own best by at most
sin(t/2) * sqrt(2 n) with n blocks that differ. For a random rotation the loss is that length times
a coordinate of a random direction; `sigmas` standard deviations are allowed for (a miss has a
chance of about 4e-8 a block's axis at 5.5), or all of it with sigmas = inf, which misses nothing.
Since each pair counts at its midpoint's filter only, it is counted once without any list of pairs.

The number of filters grows with the largest label: of two random vectors of 64 dimensions, 4,096 filters in two blocks
bring 0.11 pairs together, 78,000 in three 0.048, a million in four 0.031, and a vector is in 21, 59 or 150 of them
(measured on 2,000 vectors), so more blocks pay only for larger labels.

Filters with more than `grid` vectors are dealt out in pairs of blocks. Only counts and a spanning
forest leave a filter. Vectors meet only within one label and one dimension.

Null, zero or non-finite vectors, and those with a null label, link with nothing (n_links 0, a
component of their own). Repeated rows are vectors of their own that link; rows with the same id
share a component. A null id takes no part and isn't kept. An empty table gives an empty result;
only vec_id, embedding and label are read, so other columns can't clash.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import settled
from .components import components
from .vectors import runs, usable

MOST_BROADCAST = 50_000  # rows of four numbers
ORDER = ["label", "dim", "code", "part"]


@dataclass(frozen=True)
class Caps:
    """cosine: of a link; blocks: of the product code (0: `blocks_for` the largest label); sigmas: see above; grid: most
    vectors compared in one go."""

    cosine: float = 0.98
    blocks: int = 0
    sigmas: float = 5.5
    grid: int = 2048
    seed: int = 3

    def rotation(self, d: int) -> np.ndarray:
        q, r = np.linalg.qr(np.random.default_rng(self.seed).standard_normal((d, d)))
        return q * np.sign(np.diag(r))

    def borders(self, d: int) -> list[int]:
        return [d * i // self.blocks for i in range(self.blocks + 1)]

    def loss(self, differing: np.ndarray, d: int) -> np.ndarray:
        """How far a sum may lie below the best one when so many blocks differ."""
        half = math.sqrt((1 - self.cosine) / 2)
        return half * np.sqrt(2 * differing) * min(1.0, self.sigmas / math.sqrt(max(1, d - 1))) + 1e-9


def blocks_for(n: int) -> int:
    """Blocks of the product code for n vectors of one label and dimension: 2 below 100,000, one more for each factor
    of 5, at most 5 (whose filters still have numbers of 63 bits at 15,000 dimensions)."""
    blocks, most = 2, 100_000
    while n >= most and blocks < 5:
        blocks, most = blocks + 1, most * 5
    return blocks


def _numbered(rows: DataFrame) -> DataFrame:
    """`rows` with a number for each label; labels that aren't whole numbers are compared as they are."""
    if isinstance(rows.schema["label"].dataType, T.IntegralType):
        return rows.withColumn("label", F.col("label").cast("long"))
    ids = settled(rows.where("label is not null").select("label").distinct().withColumn("number", F.monotonically_increasing_id()))
    return rows.join(ids, "label", "left").withColumn("label", F.col("number")).drop("number")


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision; zero rows stay zero."""
    x = x.astype(np.float64)
    most = np.abs(x).max(1, keepdims=True, initial=0.0)
    x = np.divide(x, most, out=np.zeros_like(x), where=most > 0)
    n = np.sqrt((x * x).sum(1, keepdims=True))
    return np.divide(x, n, out=np.zeros_like(x), where=n > 0)


def _best(z: np.ndarray, borders: list[int]) -> np.ndarray:
    """The filter with the largest sum: an axis of each block, 2 * coordinate + (negative)."""
    code = np.zeros(len(z), np.int64)
    for a, b in itertools.pairwise(borders):
        k = np.abs(z[:, a:b]).argmax(1)
        code = code * (2 * (b - a)) + 2 * k + (z[np.arange(len(z)), a + k] < 0)
    return code


def decoded(z: np.ndarray, caps: Caps) -> tuple[np.ndarray, np.ndarray]:
    """All filters within the loss of each row of rotated unit vectors: rows, ascending, and filters."""
    borders = caps.borders(z.shape[1])
    bound = caps.loss(np.arange(caps.blocks + 1), z.shape[1])
    rows = np.arange(len(z))
    codes, gaps, differing = np.zeros(len(z), np.int64), np.zeros(len(z)), np.zeros(len(z), np.int64)
    for a, b in itertools.pairwise(borders):
        if a == b:
            continue
        own = np.empty((len(z), 2 * (b - a)))
        own[:, 0::2], own[:, 1::2] = z[:, a:b], -z[:, a:b]
        top = own.argmax(1)
        gap = own[np.arange(len(z)), top][:, None] - own
        of, axis = np.nonzero(gap <= bound[-1])
        # each filter so far goes on with every near axis of its row
        many = np.bincount(of, minlength=len(z))
        first = np.cumsum(many) - many
        reps = many[rows]
        up = np.repeat(np.arange(len(rows)), reps)
        near = np.arange(len(up)) - np.repeat(np.cumsum(reps) - reps, reps) + first[rows][up]
        rows, axis = rows[up], axis[near]
        codes, gaps, differing = codes[up] * own.shape[1] + axis, gaps[up] + gap[rows, axis], differing[up] + (axis != top[rows])
        # a block that differs later only widens the bound, so the widest one decides until the last block
        ok = gaps <= (bound[-1] if b != borders[-1] else bound[differing])
        rows, codes, gaps, differing = rows[ok], codes[ok], gaps[ok], differing[ok]
    return rows, codes


def _listed(rows: DataFrame, caps: Caps) -> DataFrame:
    """(uid, label, dim, code, sketch, err): the sketch of each usable vector once for each of its filters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for batch in batches:
            uid, label = batch.column("uid").to_numpy(), batch.column("label").to_numpy()
            vectors = batch.column("v")
            dims = np.diff(vectors.offsets.to_numpy())
            for d in np.unique(dims[dims > 0]).tolist():
                if d not in turns:
                    turns[d] = caps.rotation(d)
                at = np.flatnonzero(dims == d)
                x = unit(vectors.take(pa.array(at)).flatten().to_numpy().reshape(-1, d))
                z = x @ turns[d]
                for s in range(0, len(at), 512):
                    where, code = decoded(z[s : s + 512], caps)
                    sketch, err = sketched(x[s : s + 512])
                    rows_of = at[s + where]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(uid[rows_of]),
                            pa.array(label[rows_of].astype(np.int64)),
                            pa.array(np.full(len(where), d, np.int32)),
                            pa.array(code),
                            pa.array(sketch, pa.binary()).take(pa.array(where)),
                            pa.array(err[where]),
                        ],
                        names=["uid", "label", "dim", "code", "sketch", "err"],
                    )

    return rows.mapInArrow(run, "uid long, label long, dim int, code long, sketch binary, err double")


def sketched(x: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """Unit rows with a byte a component after their step, and how far each lies from its row."""
    step = (np.abs(x).max(1, keepdims=True, initial=0.0) / 127).astype(np.float32)
    q = np.rint(np.divide(x, step, out=np.zeros_like(x), where=step > 0)).clip(-127, 127).astype(np.int8)
    err = np.sqrt(((x - q * step.astype(np.float64)) ** 2).sum(1))
    return [a.tobytes() + b.tobytes() for a, b in zip(step, q, strict=True)], err


def may_link(y: np.ndarray, err: np.ndarray, cell: np.ndarray, across: bool, cosine: float) -> np.ndarray:
    """Which of the sketches have a partner, by the sum of both errors, whose vector may reach the cosine."""
    out = np.zeros(len(y), bool)
    for s in range(0, len(y), 256):
        e = min(s + 256, len(y))
        near = y[s:e] @ y[s:].T + (err[s:e, None] * (1 + err[None, s:]) + err[None, s:]) >= cosine - 1e-4
        near[np.arange(e - s), np.arange(e - s)] = False
        if across:
            near &= cell[s:e, None] != cell[None, s:]
        out[s:e] |= near.any(1)
        out[s:] |= near.any(0)
    return out


def _met(listed: DataFrame, caps: Caps) -> DataFrame:
    """(label, dim, code, part, cells, cell, uid) of the vectors that may link with another one of their filter."""
    key = ["label", "dim", "code"]
    large = settled(listed.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > caps.grid))
    few = large.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST
    dealt = (
        listed.join(F.broadcast(large) if few else large, key, "left")
        .withColumn("cells", F.coalesce(F.ceil(F.col("n") / caps.grid), F.lit(1)).cast("int"))
        .withColumn("cell", F.pmod(F.xxhash64("uid"), F.col("cells")).cast("int"))
        .withColumn("part", F.explode(F.expr("transform(sequence(0, cells - 1), j -> least(cell, j) * cells + greatest(cell, j))")))
        .select(*ORDER, "cells", "cell", "uid", "sketch", "err")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, first in runs(batches, ORDER):
            keep = np.zeros(batch.num_rows, bool)
            cell, err, dims = (batch.column(c).to_numpy() for c in ("cell", "err", "dim"))
            parts, cells = batch.column("part").to_numpy(), batch.column("cells").to_numpy()
            for a, b in itertools.pairwise(first.tolist()):
                if b - a < 2:
                    continue
                one, two = divmod(int(parts[a]), int(cells[a]))
                raw = np.frombuffer(b"".join(batch.column("sketch").slice(a, b - a).to_pylist()), np.uint8).reshape(b - a, 4 + int(dims[a]))
                y = raw[:, 4:].view(np.int8) * raw[:, :4].copy().view(np.float32)
                keep[a:b] = may_link(y, err[a:b], cell[a:b], one != two, caps.cosine)
            if keep.any():
                yield batch.filter(pa.array(keep)).select([*ORDER, "cells", "cell", "uid"])

    return dealt.repartition(*ORDER).sortWithinPartitions(*ORDER).mapInArrow(run, "label long, dim int, code long, part int, cells int, cell int, uid long")


def _found(met: DataFrame, caps: Caps) -> DataFrame:
    """(uid, n, root): links that count at this filter, and another vector of the same piece of the forest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for batch, first in runs(batches, ORDER):
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            uid, cell = batch.column("uid").to_numpy(), batch.column("cell").to_numpy()
            dims, codes = batch.column("dim").to_numpy(), batch.column("code").to_numpy()
            parts, cells = batch.column("part").to_numpy(), batch.column("cells").to_numpy()
            flat, offsets = batch.column("v").flatten().to_numpy(), batch.column("v").offsets.to_numpy()
            offsets = offsets - offsets[0]
            for a, b in itertools.pairwise(first.tolist()):
                if b - a < 2:
                    continue
                d = int(dims[a])
                x = unit(flat[offsets[a] : offsets[b]].reshape(-1, d))
                if d not in turns:
                    turns[d] = caps.rotation(d)
                one, two = divmod(int(parts[a]), int(cells[a]))
                i, j = _near(x, x @ turns[d], cell[a:b], one != two, caps, int(codes[a]))
                if len(i):
                    n = np.bincount(i, minlength=b - a) + np.bincount(j, minlength=b - a)
                    roots = _forest(b - a, i, j)
                    some = np.flatnonzero(n)
                    out.append((uid[a:b][some], n[some], uid[a:b][roots[some]]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=["uid", "n", "root"])

    return met.repartition(*ORDER).sortWithinPartitions(*ORDER).mapInArrow(run, "uid long, n long, root long")


def _near(x: np.ndarray, z: np.ndarray, cell: np.ndarray, across: bool, caps: Caps, code: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs i < j of unit rows with the cosine or more whose midpoint belongs to filter `code`, between two blocks
    or within one. A few rows of the product, and a bounded number of pairs, at a time."""
    found: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    borders = caps.borders(z.shape[1])
    for s in range(0, len(x), 256):
        i, j = np.nonzero(x[s : s + 256] @ x[s:].T >= caps.cosine)
        i, j = i + s, j + s
        ok = i < j
        if across:
            ok &= cell[i] != cell[j]
        i, j = i[ok], j[ok]
        for t in range(0, len(i), 32768):
            a, b = i[t : t + 32768], j[t : t + 32768]
            mine = _best(z[a] + z[b], borders) == code
            found.append((a[mine], b[mine]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    roots = np.arange(n)
    while True:
        x, y = roots[i], roots[j]
        if (x == y).all():
            return roots
        np.minimum.at(roots, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up := roots[roots], roots):
            roots = up


def near_duplicates(embeddings: DataFrame, caps: Caps = Caps()) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of `embeddings`."""
    rows = settled(embeddings.select("vec_id", F.col("embedding").alias("v"), "label").transform(_numbered).withColumn("uid", F.monotonically_increasing_id()))
    zero = ~F.exists("v", lambda x: x != 0)
    part = rows.where(usable("v") & F.col("label").isNotNull() & F.col("vec_id").isNotNull()).where(~zero)
    if not caps.blocks:
        most = part.groupBy("label", F.size("v")).count().agg(F.max("count").alias("most")).first()["most"]
        caps = replace(caps, blocks=blocks_for(most or 0))
    met = settled(_met(_listed(part.select("uid", "label", "v"), caps), caps))
    found = settled(_found(met.join(part.select("uid", "v"), "uid"), caps))
    links = found.groupBy("uid").agg(F.sum("n").alias("n_links"))
    ids = rows.select("uid", F.col("vec_id").cast("long").alias("id"))
    forest = found.where("uid != root").select("uid", "root").distinct()
    edges = forest.join(ids.withColumnRenamed("id", "a"), "uid").join(ids.select(F.col("uid").alias("root"), F.col("id").alias("b")), "root").select("a", "b")
    of = components(edges)
    known = rows.select("vec_id", "uid").join(links, "uid", "left")
    out = known.join(of, known["vec_id"] == of["id"], "left")
    component = F.coalesce("component", F.col("vec_id").cast("long"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"))
