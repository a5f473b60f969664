"""Exact top-k by inner product over norm-sorted vectors.

Vectors are rotated to the axes of their second moments, so that the first coordinates hold most
of each product. Candidates are packed into blocks by descending length. A first pass compares each block of queries
with the longest blocks of its dimension, which gives every query a k-th score; then a block is sent to
those blocks of queries only of which one can still be reached by its largest length. Blocks are dealt to strands,
whose number grows with theirs. A task holds one block of queries and goes down a strand: a query leaves when its length
times the block's largest length can't reach its k-th score any more; for the others the sum over the
first coordinates plus the product of the residual lengths (Cauchy-Schwarz) bounds each score, and
only what reaches the k-th score is computed exactly, in whole numbers. The strands' lists, at most
k rows each, are merged by rank.

Scores are exact while they are below 2**53. Rows that are null, hold null or non-finite components
or have a null id take no part. Vectors meet only within one dimension. Repeated rows are candidates of
their own, but no row with a query's id is its candidate; rows that repeat a query's id and vector are answered once, and an
id that stands on several vectors asks with each of them, told apart by `query_place`. Ties go to the smaller id. An empty table gives an empty result; only vec_id and embedding are read, so other
columns can't clash. Only counts and the second moments of at most `turned` dimensions (squared, each at most
`widest`; other vectors aren't rotated, with the same result) reach the driver.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settled
from .vectors import usable


#: Products of one step; values of the salt in joins by dimension, which may be the same for all.
PAIRS, SALTS = 1 << 20, 64
PACKED = ("dim", "most", "form", "ids", "places", "data")


@dataclass(frozen=True)
class Search:
    """k: scores for each query; leading: share of the coordinates in the partial sums; block, queries: vectors in
    a block of either kind; first: blocks of the first pass; strands: least number for each query block; longest: blocks of a
    strand; widest, turned: widest dimension, and number of dimensions, that are rotated."""

    k: int = 20
    leading: float = 0.25
    block: int = 4096
    queries: int = 8192
    first: int = 2
    strands: int = 8
    longest: int = 512
    widest: int = 1024
    turned: int = 4


def whole_numbers(vector: str = "embedding", factor: float = 64.0) -> Column:
    """floor(factor * x) of each component, x as double."""
    return F.transform(vector, lambda x: F.floor(F.lit(factor) * x.cast("double")).cast("double"))


def _moments(rows: DataFrame, how: Search) -> dict[int, np.ndarray]:
    """Axes by falling second moment over all rows, for the `turned` most frequent dimensions of at most `widest`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            v = batch.column("v")
            dims = np.diff(v.offsets.to_numpy())
            for d in np.intersect1d(dims, often).tolist():
                x = v.take(pa.array(np.flatnonzero(dims == d))).flatten().to_numpy().reshape(-1, d)
                sums[d] = sums.get(d, 0) + x.T @ x
        for d, m in sums.items():
            i = np.repeat(np.arange(d), d)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(d * d, d)), pa.array(i), pa.array(np.tile(np.arange(d), d)), pa.array(m.ravel())], names=["d", "i", "j", "m"])

    counts = rows.where(F.col("dim").between(2, how.widest)).groupBy("dim").count().orderBy(F.col("count").desc(), "dim").limit(how.turned)
    often = [r["dim"] for r in counts.collect()]
    if not often:
        return {}
    cells = rows.select("v").mapInArrow(run, "d long, i long, j long, m double").groupBy("d", "i", "j").agg(F.sum("m").alias("m"))
    out = {d: np.zeros((d, d)) for d in often}
    for r in cells.collect():
        out[r["d"]][r["i"], r["j"]] = r["m"]
    return {d: np.linalg.eigh((m + m.T) / 2)[1][:, ::-1].copy() for d, m in out.items()}


def _narrow(x: np.ndarray) -> tuple[str, bytes]:
    """Whole numbers in the narrowest form that holds them all, and its name."""
    most = np.abs(x).max(initial=0.0)
    form = "i1" if most < 2**7 else "i2" if most < 2**15 else "i4" if most < 2**31 else "f8"
    return form, x.astype(form).tobytes()


def _packed(rows: DataFrame, size: int) -> DataFrame:
    """Blocks of at most `size` rows of one dimension, in the order they come: PACKED. places: `place` of each row, if there is one.

    A task holds the rows of one block, however many rows of a dimension its partition has.
    """

    placed = "place" in rows.columns

    def block(held: list[pa.RecordBatch], d: int) -> pa.RecordBatch:
        part = pa.concat_batches(held)
        form, data = _narrow(part.column("v").flatten().to_numpy())
        most = float(part.column("norm").to_numpy().max())
        ids = part.column("vec_id").to_numpy().tobytes()
        places = part.column("place").to_numpy().tobytes() if placed else b""
        return pa.RecordBatch.from_arrays([pa.array([d]), pa.array([most]), pa.array([form]), *(pa.array([x], pa.binary()) for x in (ids, places, data))], names=list(PACKED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n, d = 0, -1
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            cuts = [0, *(np.flatnonzero(dims[1:] != dims[:-1]) + 1).tolist(), len(dims)]
            for a, b in itertools.pairwise(cuts):
                while a < b:
                    if held and (n == size or d != dims[a]):
                        yield block(held, d)
                        held, n = [], 0
                    take = min(b - a, size - n)
                    held.append(batch.slice(a, take))
                    a, n, d = a + take, n + take, int(dims[a])
        if held:
            yield block(held, d)

    return rows.mapInArrow(run, "dim long, most double, form string, ids binary, places binary, data binary")


class _Best:
    """The k best of each query so far; scores below a query's `floor` aren't needed."""

    def __init__(self, n: int, k: int, floor: np.ndarray | None = None):
        self.k = k
        self.floor = np.full(n, -np.inf) if floor is None else floor
        self.scores = np.full((n, k), -np.inf)
        self.ids = np.full((n, k), np.iinfo(np.int64).max)

    @property
    def last(self) -> np.ndarray:
        return np.maximum(self.scores[:, -1], self.floor)

    def add(self, q: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        touched = np.unique(q)
        where = np.concatenate((q, np.repeat(touched, self.k)))
        s = np.concatenate((scores, self.scores[touched].ravel()))
        i = np.concatenate((ids, self.ids[touched].ravel()))
        order = np.lexsort((i, -s, where))
        where, s, i = where[order], s[order], i[order]
        first = np.searchsorted(where, touched)
        take = first[:, None] + np.arange(self.k)
        self.scores[touched], self.ids[touched] = s[take], i[take]


def _down(Q: np.ndarray, qid: np.ndarray, best: _Best, X: np.ndarray, xid: np.ndarray, axes: np.ndarray | None, lead: int) -> None:
    """One candidate block for one query block."""
    q_len, x_len = np.sqrt((Q * Q).sum(1)), np.sqrt((X * X).sum(1))
    alive = np.flatnonzero(q_len * x_len.max(initial=0.0) * (1 + 1e-9) >= best.last - 0.5)
    if not len(alive):
        return
    Qr, Xr = (Q[alive], X) if axes is None else (Q[alive] @ axes, X @ axes)
    q_rest = np.sqrt(np.maximum((Qr[:, lead:] ** 2).sum(1), 0))
    x_rest = np.sqrt(np.maximum((Xr[:, lead:] ** 2).sum(1), 0))
    step = max(16, PAIRS // len(alive))
    for s in range(0, len(X), step):
        e = min(s + step, len(X))
        slack = 0.5 + 1e-9 * q_len[alive] * x_len[s:e].max(initial=0.0)
        bound = Qr[:, :lead] @ Xr[s:e, :lead].T + q_rest[:, None] * x_rest[None, s:e]
        a, b = np.nonzero(bound >= (best.last[alive] - slack)[:, None])
        if not len(a):
            continue
        q, x = alive[a], b + s
        if len(a) * 4 > len(alive) * (e - s):
            exact = (Q[alive] @ X[s:e].T)[a, b]
        else:
            exact = np.concatenate([np.einsum("ij,ij->i", Q[q[t : t + 65536]], X[x[t : t + 65536]]) for t in range(0, len(q), 65536)])
        ok = (exact >= best.last[q]) & (qid[q] != xid[x])
        if ok.any():
            best.add(q[ok], exact[ok], xid[x[ok]])


def top_k(vectors: DataFrame, is_query: Column, how: Search = Search()) -> DataFrame:
    """query_id, rank, vec_id, score, query_place: the k best of all rows for each row where `is_query` holds.

    query_place: 1, or the number of the query's vector among those of its id, in their order.

    vectors: vec_id and `v`, an array of whole numbers as double.
    """
    spark = vectors.sparkSession
    rows = settled(
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "v", is_query.alias("is_query"))
        .withColumns({"dim": F.size("v").cast("long"), "norm": F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))})
    )
    axes = spark.sparkContext.broadcast(_moments(rows, how))  # at most turned * widest^2 numbers
    n = rows.agg(F.count(F.lit(1)).alias("all"), F.count_if("is_query").alias("asked")).first()
    parts = max(spark.sparkContext.defaultParallelism, n["all"] // (256 * how.block))
    falling = rows.select("vec_id", "v", "dim", "norm").repartitionByRange(parts, "dim", F.col("norm").desc()).sortWithinPartitions("dim", F.col("norm").desc(), "vec_id")
    candidates = settled(_packed(falling, how.block).withColumn("cb", F.monotonically_increasing_id()))
    # an id may stand on several vectors: each is a query with a list of its own
    asked = rows.where("is_query").groupBy("vec_id", "v").agg(F.first("dim").alias("dim"), F.first("norm").alias("norm"))
    asked = asked.withColumn("place", F.row_number().over(Window.partitionBy("vec_id").orderBy("v")).cast("long"))
    by_id = asked.repartitionByRange(max(1, -(-n["asked"] // how.queries)), "dim", "vec_id").sortWithinPartitions("dim")
    blocks = settled(_packed(by_id, how.queries).withColumn("qb", F.monotonically_increasing_id()))

    # the longest blocks of each dimension give every query a k-th score to begin with
    longest = F.row_number().over(Window.partitionBy("dim").orderBy(F.col("most").desc(), "cb"))
    first = candidates.select("cb", "dim", "most").withColumn("place", longest).where(F.col("place") <= how.first).select("cb")
    salts = F.sequence(F.lit(0), F.lit(SALTS - 1))
    spread = candidates.join(first, "cb").withColumn("salt", F.explode(salts))
    near = blocks.select("qb", "dim", F.pmod(F.xxhash64("qb"), F.lit(SALTS)).cast("int").alias("salt")).join(spread, ["dim", "salt"])
    no_floor = F.lit(None).cast("array<double>").alias("floor")
    heads = blocks.select("qb", F.lit(0).alias("strand"), F.lit(0).alias("kind"), no_floor, *PACKED)
    tails = near.select("qb", F.lit(0).alias("strand"), F.lit(1).alias("kind"), no_floor, *PACKED)
    begun = settled(_dealt(heads, tails, axes, how))

    # and then only blocks that are long enough to reach it are sent to a block of queries
    n_blocks = candidates.count()
    strands = max(how.strands, n_blocks // how.longest)
    strand = F.pmod(F.xxhash64("cb"), F.lit(strands)).cast("int").alias("strand")
    needs = begun.select("qb", "dim", "need").withColumn("salt", F.explode(salts))
    rest = candidates.join(first, "cb", "left_anti").withColumn("salt", F.pmod(F.xxhash64("cb", "most"), F.lit(SALTS)).cast("int"))
    pairs = rest.join(needs, ["dim", "salt"]).where(F.col("most") * (1 + 1e-8) >= F.col("need"))
    against = pairs.select("qb", strand, F.lit(1).alias("kind"), no_floor, *PACKED)
    used = against.select("qb", "strand").distinct()
    again = blocks.join(begun.select("qb", "floor"), "qb").join(used, "qb").select("qb", "strand", F.lit(0).alias("kind"), "floor", *PACKED)
    found = _dealt(again, against, axes, how)

    each = F.explode(F.arrays_zip("query_id", "query_place", "vec_id", "score")).alias("x")
    listed = begun.select(each).unionByName(found.select(each)).select("x.*")
    rank = F.row_number().over(Window.partitionBy("query_id", "query_place").orderBy(F.col("score").desc(), "vec_id"))
    return listed.withColumn("rank", rank).where(F.col("rank") <= how.k).select("query_id", "rank", "vec_id", "score", "query_place")


def _dealt(heads: DataFrame, against: DataFrame, axes: Broadcast, how: Search) -> DataFrame:
    """The best of each (qb, strand): query_id, vec_id and score as lists, each query's `floor` (the k-th score,
    if it has so many) and `need`, the least length with which a vector can reach the floor of any of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, best, Q, qid, place, d = None, None, np.zeros((0, 0)), np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        for batch in batches:
            for r in range(batch.num_rows):
                qb, strand, kind, floor, d_, _, form, ids, places, data = (batch.column(c)[r] for c in range(10))
                now = (qb.as_py(), strand.as_py())
                ids = np.frombuffer(ids.as_buffer(), np.int64)
                x = np.frombuffer(data.as_buffer(), form.as_py()).astype(np.float64).reshape(len(ids), d_.as_py())
                if kind.as_py() == 0:
                    if best is not None:
                        yield _result(key[0], d, best, Q, qid, place)
                    key, Q, qid, place, d = now, x, ids.copy(), np.frombuffer(places.as_buffer(), np.int64).copy(), d_.as_py()
                    best = _Best(len(ids), how.k, None if floor.as_py() is None else np.array(floor.as_py()))
                elif now == key:
                    turn = axes.value.get(d)
                    _down(Q, qid, best, x, ids, turn, d if turn is None else max(1, int(d * how.leading)))
        if best is not None:
            yield _result(key[0], d, best, Q, qid, place)

    dealt = heads.unionByName(against).repartition("qb", "strand").sortWithinPartitions("qb", "strand", "kind", F.col("most").desc())
    schema = "qb long, dim long, need double, floor array<double>, query_id array<long>, query_place array<long>, vec_id array<long>, score array<long>"
    return dealt.mapInArrow(run, schema)


def _result(qb: int, d: int, best: _Best, Q: np.ndarray, qid: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    q, k = np.nonzero(np.isfinite(best.scores))
    length = np.sqrt((Q * Q).sum(1))
    need = np.divide(best.last - 0.5, length, out=np.full(len(length), -np.inf), where=length > 0)
    columns = {
        "qb": [qb],
        "dim": [d],
        "need": [float(need.min())],
        "floor": [best.last],
        "query_id": [qid[q]],
        "query_place": [place[q]],
        "vec_id": [best.ids[q, k]],
        "score": [best.scores[q, k].astype(np.int64)],
    }
    return pa.RecordBatch.from_pydict(columns)


def search(embeddings: DataFrame, every: int = 20, how: Search = Search()) -> DataFrame:
    """`top_k` over the whole-number vectors of `embeddings`; queries are the rows whose id `every` divides."""
    rows = embeddings.where(F.col("vec_id").isNotNull() & usable()).select("vec_id", whole_numbers().alias("v"))
    return top_k(rows, F.col("vec_id") % every == 0, how)
