"""SimHash near-duplicates with pigeonring filtering.

A fingerprint sums the bits of a text's shingle hashes. Two fingerprints at distance <= tau, cut
into m segments on a ring, have by the pigeonring principle a segment from which every chain of l
consecutive segments differs in at most l * tau / m bits. Where that budget is below 1 the segments
are equal: the leading equal ones are the join key, the longer chains are checked before the full
distance.

Equal fingerprints are one node. Nodes that share a key are compared inside the key's bucket, in
numpy, and only a spanning forest of the links leaves it: no pairs are made. A bucket of more than
`grid` nodes is dealt out in pairs of blocks, so that none needs one task.

With `signs` > 1 a document has so many independent fingerprints; a pair is compared if a chain
of one of them fits, and linked by the distance of the first `compared` ones. That is for radii that no
key of 64 bits can guarantee; then candidates are those that share an equal segment. `near_copies` chooses
the segments' width by the number of texts, so that unrelated texts don't crowd a bucket, and the number
of fingerprints by the recall asked for.

With `similarity`, fingerprints only propose: the shingle sets of each component of proposed links are
read once and compared in full, and what links is a Jaccard similarity of that size. Blocks of large
components are dealt out in pairs, too.

A null text counts as empty; a text without words has fingerprint zero and is linked like any
other; with fewer words than a shingle has, the whole sequence is the shingle. Rows that repeat an id and
a text are one document. Rows with a null id have a fingerprint but no component. An empty table gives an
empty result. Ids of any type with an order stay as they are; other columns can't clash.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import marked, settled
from .components import components

MOST_BROADCAST = 50_000  # rows of three numbers
MOST_SHINGLES = 2_000_000  # of a block of a component, about


@dataclass(frozen=True)
class SimHash:
    """words: of a shingle; tau: most differing bits of the fingerprints compared; segments: m of each fingerprint;
    bits: of a segment (None: 64 / m); signs: number of fingerprints; compared: of them, for the distance (None: all);
    chain_tau: of one fingerprint, for the chains (tau if there is one); grid: most nodes of a bucket that are
    compared in one go; distinct: repeated shingles count once; similarity: least Jaccard similarity of shingle sets
    that links (None: the fingerprints decide)."""

    words: int = 3
    tau: int = 2
    segments: int = 5
    signs: int = 1
    chain_tau: int | None = None
    grid: int = 4096
    distinct: bool = False
    similarity: float | None = None
    bits: int | None = None
    compared: int | None = None

    @property
    def budgets(self) -> list[int]:
        tau = self.tau if self.chain_tau is None else self.chain_tau
        return [length * tau // self.segments for length in range(1, self.segments + 1)]

    @property
    def lead(self) -> int:
        """Leading segments that must be equal; one at least, which is the key."""
        return max(1, sum(x == 0 for x in self.budgets))

    def masks(self) -> np.ndarray:
        if self.bits:
            cuts = [self.bits * i for i in range(self.segments + 1)]
        else:
            cuts = [64 * i // self.segments for i in range(self.segments + 1)]
        return np.array([(1 << b) - (1 << a) for a, b in itertools.pairwise(cuts)], dtype=np.uint64)


def near_copies(texts: int = 0, similarity: float = 0.8, words: int = 5, recall: float = 0.95, crowd: int = 256) -> SimHash:
    """For shingle sets that overlap by `similarity` or more, among so many `texts`.

    Their hash vectors then have a cosine of at least 2 s / (1 + s), and signs differ in a share p = acos of that / pi
    of the bits. A key of w bits is equal in (1 - p)^w of such pairs and in 2^-w of unrelated ones: w is at least 16
    and so large that `crowd` unrelated texts at most meet in a bucket on average, and there are so many keys that
    `recall` of the pairs at just `similarity` share one (more similar ones, more of them). Both grow with the corpus: to
    16 million texts w is 16 with 40 keys, for 10 billion 26 with 214. Small sets differ in up to 0.1875 of the bits at
    0.8 (four hashes and five, where half of four is no majority): tau lies five standard deviations above that.
    """
    bits = max(16, math.ceil(math.log2(max(texts, 1) / crowd)))
    differ = math.acos(2 * similarity / (1 + similarity)) / math.pi
    keys = math.ceil(math.log(1 - recall) / math.log(1 - (1 - differ) ** bits))
    segments = max(1, 64 // bits)
    signs = math.ceil(keys / segments)
    compared = min(signs, 11)
    n, p = 64 * compared, differ * 0.1875 / 0.1517
    return SimHash(words, int(n * p + 5 * math.sqrt(n * p * (1 - p))), segments, signs, segments * bits // 4, distinct=True, similarity=similarity, bits=bits, compared=compared)


NEAR_COPIES = near_copies()


def shingles(text: str, words: int, distinct: bool = False) -> np.ndarray:
    """The hashes of a text's shingles, in order; `distinct`: sorted, each once."""
    w = text.encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return np.zeros(0, np.uint64)
    flat = b" ".join(w)
    ends = np.cumsum([len(x) + 1 for x in w]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
    digest = xxhash.xxh64_intdigest
    ends = ends[words - 1 :].tolist() or [len(flat)]
    h = np.array([digest(flat[a:b], 42) for a, b in zip(starts, ends, strict=False)], dtype=np.uint64)
    return np.unique(h) if distinct else h


class _Words(dict):
    """Hashes of words, with a bound on how many are kept."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        out = self[word] = xxhash.xxh64_intdigest(word, 42)
        return out


def shingle_sets(text: str, words: int, memo: _Words) -> np.ndarray:
    """One sorted hash for each different shingle, from its words' hashes: for sets, where no particular hash is asked for."""
    w = text.encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(memo.__getitem__, w), np.uint64, len(w))
    k = min(words, len(w))
    total = np.zeros(len(w) - k + 1, np.uint64)
    for i in range(k):
        total = total * np.uint64(0x9E3779B97F4A7C15) + h[i : len(w) - k + 1 + i]
    total ^= total >> np.uint64(31)
    total *= np.uint64(0xD6E8FEB86659FD93)
    total ^= total >> np.uint64(32)
    return np.unique(total)


def fingerprint(text: str, words: int, multipliers: np.ndarray, distinct: bool = False) -> np.ndarray:
    """One unsigned 64-bit fingerprint for each multiplier; the first multiplier is 1, which keeps the hash."""
    return _signs(shingles(text, words, distinct), multipliers)


def _signs(h: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    total = np.zeros(64 * len(multipliers), np.int64)
    for at in range(0, len(h), 255):  # so many rows that a sum fits a byte
        part = h[at : at + 255]
        x = (part ^ (part >> np.uint64(29)))[:, None] * multipliers
        x ^= x >> np.uint64(32)
        x[:, 0] = part
        bits = np.unpackbits(x.astype(">u8").view(np.uint8), axis=1)
        total += np.add.reduce(bits, axis=0, dtype=np.uint8)
    return np.packbits(2 * total > len(h)).view(">u8").astype(np.uint64)


def _multipliers(signs: int) -> np.ndarray:
    rest = np.random.default_rng(64).integers(1, 2**63, signs - 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return np.concatenate((np.array([1], np.uint64), rest))


def _identified(docs: DataFrame) -> DataFrame:
    """doc_id, digest (of the text) and text: what tells a document from others with its id."""
    return docs.select("doc_id", F.xxhash64("text").alias("digest"), "text")


def fingerprints(docs: DataFrame, how: SimHash = SimHash()) -> DataFrame:
    """doc_id, digest and `fps`, the fingerprints as longs, of every row. With `distinct`, `fps` ends with the set's own hash."""
    multipliers, words, distinct = _multipliers(how.signs), how.words, how.distinct
    kind = docs.schema["doc_id"].dataType.simpleString()
    width = how.signs + distinct

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _Words()
        for batch in batches:
            out = np.zeros((batch.num_rows, width), np.uint64)
            for i, text in enumerate(batch.column(2)):
                t = text.as_py() or ""
                h = shingle_sets(t, words, memo) if distinct else shingles(t, words)
                out[i, : how.signs] = _signs(h, multipliers)
                if distinct:
                    out[i, -1] = xxhash.xxh64_intdigest(h.tobytes())
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * width)
            fps = pa.ListArray.from_arrays(offsets, pa.array(out.view(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), fps], names=["doc_id", "digest", "fps"])

    return _identified(docs).mapInArrow(run, f"doc_id {kind}, digest long, fps array<long>")


def _keys(nodes: DataFrame, how: SimHash) -> DataFrame:
    """A row for each node, fingerprint and start of a chain: `key`, the equal leading segments, `own`, that
    fingerprint, and `fps`, those that the distance compares."""
    masks = how.masks()
    key = []
    for sign in range(how.signs):
        for i in range(how.segments):
            mask = int(np.bitwise_or.reduce(masks[[(i + j) % how.segments for j in range(how.lead)]]).view(np.int64))
            own = F.get("fps", F.lit(sign))
            key.append(F.struct(F.lit(sign * how.segments + i).alias("t"), own.bitwiseAND(F.lit(mask)).alias("key"), own.alias("own")))
    compared = F.slice("fps", 1, how.compared or how.signs)
    return nodes.select("node", compared.alias("fps"), F.explode(F.array(*key)).alias("k")).select("node", "fps", "k.t", "k.key", "k.own")


def _dealt(keys: DataFrame, how: SimHash) -> DataFrame:
    """Nodes with the part of their bucket; those of large buckets once for each pair of blocks.

    Only the large buckets' sizes are joined. There is at most one for every `grid` rows; they are
    broadcast only if they are few.
    """
    counts = keys.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > how.grid)
    large = settled(counts)
    few = large.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST
    many = keys.join(F.broadcast(large) if few else large, ["t", "key"], "left").withColumn("blocks", F.coalesce(F.ceil(F.col("n") / how.grid), F.lit(1)).cast("int"))
    return many.select("t", "key", "node", "own", "fps", F.explode(_parts()).alias("part"))


def _parts() -> Column:
    """The pairs of blocks that a node takes part in, from `node` and the number of `blocks`."""
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    return F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.least(block, j) * F.col("blocks") + F.greatest(block, j))


def _roots(roots: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the sets of a[i] and b[i] in `roots`, which stays flat."""
    while len(a):
        x, y = roots[a], roots[b]
        open_ = x != y
        if not open_.any():
            return
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(roots, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up := roots[roots], roots):
            roots[:] = up


def linked(group: np.ndarray, start: np.ndarray, own: np.ndarray, fps: np.ndarray, how: SimHash) -> np.ndarray:
    """Root (a position) of each row, by links inside equal runs of `group`; rows are sorted by group.

    Row i is compared with row i + lag for lag = 1, 2, ...; pairs that are joined already need no
    distance, so a tight bucket costs little more than its own length.
    """
    n = len(group)
    roots = np.arange(n)
    masks, budgets = how.masks(), how.budgets
    left = np.arange(n - 1) if n else np.arange(0)
    lag = 1
    while len(left):
        left = left[left + lag < n]
        left = left[group[left] == group[left + lag]]
        a = left[roots[left] != roots[left + lag]]
        for at in range(0, len(a), 65536):
            i = a[at : at + 65536]
            j = i + lag
            seg = start[i] % how.segments
            if how.lead < how.segments:
                diff = own[i] ^ own[j]
                total = np.zeros(len(i), np.int64)
                ok = np.ones(len(i), bool)
                for length in range(how.segments):
                    total += np.bitwise_count(diff & masks[(seg + length) % how.segments])
                    ok &= total <= max(budgets[length], 0)
                i, j = i[ok], j[ok]
            near = np.bitwise_count(fps[i] ^ fps[j]).sum(1, dtype=np.int64) <= how.tau
            _roots(roots, i[near], j[near])
        lag += 1
    return roots


def _buckets(batches: Iterator[pa.RecordBatch], order: list[str]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows of whole buckets, which are equal runs of the columns `order`, with the number of the bucket and those columns."""
    rest: pa.RecordBatch | None = None
    for batch in itertools.chain(batches, [None]):
        if batch is None:
            whole = rest
        elif not batch.num_rows:
            continue
        else:
            whole = batch if rest is None else pa.concat_batches([rest, batch])
        if whole is None:
            return
        cols = np.stack([whole.column(c).to_numpy() for c in order], 1).astype(np.int64)
        new = np.concatenate(([0], (cols[1:] != cols[:-1]).any(1).cumsum()))
        if batch is not None:  # the last bucket may go on in the next batch
            cut = int(np.searchsorted(new, new[-1]))
            rest, whole, new, cols = whole.slice(cut), whole.slice(0, cut), new[:cut], cols[:cut]
        if whole.num_rows:
            yield whole, new, cols


def links(nodes: DataFrame, how: SimHash) -> DataFrame:
    """(a, b): a forest that connects the nodes (node, fps) just as all links between them would."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole, new, cols in _buckets(batches, order):
            fps = whole.column("fps").flatten().to_numpy().view(np.uint64).reshape(whole.num_rows, -1)
            own = whole.column("own").to_numpy().view(np.uint64)
            roots = linked(new, cols[:, 0], own, fps, how)
            far = roots != np.arange(len(roots))
            node = whole.column("node").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(node[roots[far]]), pa.array(node[far])], names=["a", "b"])

    dealt = _dealt(_keys(nodes, how), how)
    order = ["t", "key", "part"]
    return dealt.repartition(*order).sortWithinPartitions(*order).mapInArrow(run, "a long, b long")


def alike(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """Root (a position) of each set, where a Jaccard similarity of at least `similarity` links; all pairs are decided.

    A set meets all others at once by the lists of who holds its hashes. A pair is settled when one of
    the two has been met or both are joined, so the smallest class goes first and the largest rests.
    """
    n = len(sets)
    sizes = np.array([len(x) for x in sets])
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
    ends, holder = sizes.cumsum(), np.repeat(np.arange(n), sizes)[np.argsort(ids, kind="stable")]
    first = np.concatenate(([0], np.bincount(ids).cumsum()))
    roots, left = np.arange(n), np.ones(n, bool)
    while True:
        open_ = np.flatnonzero(left)
        count = np.bincount(roots[open_], minlength=n)
        classes = np.flatnonzero(count)
        if len(classes) < 2:
            return roots
        i = open_[roots[open_] == classes[count[classes].argmin()]][0]
        mine = ids[ends[i] - sizes[i] : ends[i]]
        many = first[mine + 1] - first[mine]
        both = np.bincount(holder[np.repeat(first[mine] - many.cumsum() + many, many) + np.arange(many.sum())], minlength=n)
        near = np.flatnonzero(both / np.maximum(sizes[i] + sizes - both, 1) >= similarity)
        _roots(roots, np.full(len(near), i), near)
        left[i] = False


def verified(docs: DataFrame, loose: DataFrame, how: SimHash) -> DataFrame:
    """(a, b): a forest of the links by `similarity` inside each component of proposals.

    loose: (doc_id, digest, node, component), one row a node. Only these texts are read again, once each.
    """
    words, similarity = how.words, how.similarity

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _Words()
        for batch in batches:
            sets = [shingle_sets(t.as_py() or "", words, memo).view(np.int64) for t in batch.column(2)]
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in sets]))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*sets, np.zeros(0, np.int64)])))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["node", "component", "shingles"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole, new, _ in _buckets(batches, order):
            node, lists = whole.column("node").to_numpy(), whole.column("shingles")
            ends, flat = np.cumsum(lists.value_lengths().to_numpy()), lists.flatten().to_numpy()
            sets = np.split(flat, ends[:-1])
            cuts = [*np.searchsorted(new, np.unique(new)).tolist(), len(new)]
            for a, b in itertools.pairwise(cuts):
                roots = alike(sets[a:b], similarity)
                far = roots != np.arange(b - a)
                yield pa.RecordBatch.from_arrays([pa.array(node[a:b][roots[far]]), pa.array(node[a:b][far])], names=["a", "b"])

    order = ["component", "part"]
    texts = marked(_identified(docs), loose, ["doc_id", "digest"]).where("maybe").join(loose, ["doc_id", "digest"]).select("node", "component", "text")
    # a document that stands in several rows counts once
    sets = settled(texts.mapInArrow(read, "node long, component long, shingles array<long>").dropDuplicates(["node"]))
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / how.grid), F.ceil(F.sum(F.size("shingles")) / MOST_SHINGLES)).cast("int")
    large = settled(sets.groupBy("component").agg(blocks.alias("blocks")).where("blocks > 1"))
    few = large.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST
    many = sets.join(F.broadcast(large) if few else large, "component", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = many.select("component", "node", "shingles", F.explode(_parts()).alias("part"))
    return dealt.repartition(*order).sortWithinPartitions(*order).mapInArrow(run, "a long, b long")


def _classes(docs: DataFrame, how: SimHash, by_id: bool) -> tuple[DataFrame, DataFrame]:
    """Rows (row, doc_id, digest, fps) and nodes (fps, node, n, least, component): the smallest row with
    the fingerprints stands for all, n of them, with smallest id `least`; component is null for a node without links."""
    rows = settled(fingerprints(docs, how).withColumn("row", F.monotonically_increasing_id()))
    known = rows.where("doc_id is not null")
    nodes = settled(known.groupBy("fps").agg(F.min("row").alias("node"), F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("least")))
    near = links(nodes, how)
    if how.similarity is not None:
        found = components(near)
        loose = known.join(found, known["row"] == found["id"]).select("doc_id", "digest", F.col("row").alias("node"), "component")
        near = verified(docs, settled(loose), how)
    if by_id:
        # an id that stands on rows with different texts links their nodes
        several = known.groupBy("doc_id").agg(F.min("digest").alias("a"), F.max("digest").alias("b")).where("a != b").select("doc_id")
        odd = known.join(several, "doc_id", "left_semi").select("doc_id", "fps").join(nodes.select("fps", "node"), "fps")
        least = odd.groupBy("doc_id").agg(F.min("node").alias("a"))
        near = near.union(odd.join(least, "doc_id").select("a", F.col("node").alias("b")))
    found = components(near)
    return rows, nodes.join(found, nodes["node"] == found["id"], "left").drop("id")


def groups(docs: DataFrame, how: SimHash = SimHash()) -> DataFrame:
    """doc_id, fps, component_id for each row: the smallest id among documents that links reach.

    An id stands for one document, whatever its rows' texts: they belong together.
    """
    rows, nodes = _classes(docs, how, by_id=True)
    nodes = settled(nodes)
    named = nodes.where("component is not null").groupBy("component").agg(F.min("least").alias("first"))
    with_name = nodes.join(named, "component", "left").select("fps", F.coalesce("first", "least").alias("component_id"))
    r, n = rows.alias("r"), with_name.alias("n")
    return r.join(n, (F.col("r.fps") == F.col("n.fps")) & F.col("r.doc_id").isNotNull(), "left").select("r.doc_id", "r.fps", "n.component_id")


def one_of_each(docs: DataFrame, how: SimHash | None = None) -> DataFrame:
    """Rows of `docs`, with all their columns, that stay: of each group the document with the smallest id.

    Documents are told apart by id and text: rows that share an id but not a text are different documents (of
    equal ids in a group the one with the smallest hash of the text stays). Of rows that repeat an id and its text
    one stays, the one with the smallest hash of all columns. Rows without an id stay. Only the texts of documents that
    are verified, go or repeat are shuffled.
    """
    how = how or near_copies(docs.count())
    rows, nodes = _classes(docs, how, by_id=False)
    busy = nodes.where("n > 1 or component is not null").select("fps", F.coalesce("component", "node").alias("class"))
    member = settled(rows.where("doc_id is not null").join(busy, "fps").groupBy("class", "doc_id", "digest").agg(F.count(F.lit(1)).alias("n")))
    first = settled(member.groupBy("class").agg(F.min(F.struct("doc_id", "digest")).alias("first")))
    told = settled(member.join(first, "class").select("doc_id", "digest", (F.struct("doc_id", "digest") == F.col("first")).alias("stays"), "n").where("not stays or n > 1"))
    each = marked(docs.select(F.struct("*").alias("row"), "doc_id", F.xxhash64("text").alias("digest")), told, ["doc_id", "digest"])
    odd = each.where("maybe").join(told, ["doc_id", "digest"], "left")
    order = Window.partitionBy("doc_id", "digest").orderBy(F.xxhash64(F.to_json("row", {"ignoreNullFields": "false"})))
    one = odd.where("stays").withColumn("i", F.row_number().over(order)).where("i = 1")
    return each.where("not maybe").select("row.*").union(odd.where("stays is null").select("row.*")).union(one.select("row.*"))
