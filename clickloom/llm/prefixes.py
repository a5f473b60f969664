"""Conversation prefix trie: every distinct beginning of a conversation is a node, with what its subtree holds.

A turn is known by the first 120 bits of the SHA-256 of its role and text, so that no text is shuffled. Conversations
are rebuilt (`rebuilt`), cut into layers of at most `layer` turns and reduced to their distinct sequences, with the number and the
smallest of their conversations. Sequences are dealt to prefix shards: by their first turn, and where the
distinct sequences of a prefix have more than `shard` turns, by 2, 4, 8, ... turns. A shard packs its sequences into a double-array
trie: its turns get dense codes, the child of slot s by code c is the slot BASE[s] + c, and CHECK names its parent. All sequences walk the
arrays at once, one turn a step, which gives members and ends of each node; sums over subtrees go up by depth.
Nodes above the shards' tops are shared: what shards and sequences that end above know of them is merged
by prefix. Layers are worked off from the deepest one, whose totals go to the end of the layer above.

Equal sequences are summed up before any shuffle by prefix, and a shard has a bounded number of turns, however often a turn, a
prefix or a conversation stands. The digests of ends are made in two steps: ids are joined in ranges of 65,536, and
these texts stream through the hash, so that no list of ids is held.

Turns go by number, null first; equal numbers by role, then by the turn's digest; a repeated row is a turn of its own. Null role and text
are empty. Rows without conv_id belong to no conversation and are left out. An empty table has no node at all, not even the
root. Only conv_id, turn, role and text are read, so other columns can't clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import dropped, settled

#: Letters of a turn's name: 15 bytes to base 64.
NAME = 20
EMPTY = hashlib.sha256(b"").hexdigest()
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]


@dataclass(frozen=True)
class Shape:
    """layer: turns of a layer; shard: turns of the distinct sequences of a shard; most: turns that another conversation lends,
    every: the distance of those that lend."""

    layer: int = 512
    shard: int = 200_000
    most: int = 6
    every: int = 100


def _named(text: str) -> str:
    """SQL for the short name of a text or binary value."""
    return f"base64(substring(unhex(sha2({text}, 256)), 1, 15))"


def _end() -> str:
    """SQL for the name of the node to which `path` leads from `root`. Names have no comma."""
    return f"case when path = '' then root else {_named(f"concat(root, ',', {_named('path')})")} end"


def numbered(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(conv_id, pos, key, n) of each turn, from 0, (conv_id, n_own) of each conversation, and the table that both read.

    Turns are range-sorted over all conversations; a turn's place is its place in its range and what ranges before
    have of its conversation, so that a long conversation is spread over tasks.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), text.alias("text")
    )
    keyed = settled(turns.select("conv_id", "turn", "role", F.expr(_named("concat(length(role), ':', role, text)")).alias("key"), F.length("text").alias("n")))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("key")]
    ranged = settled(
        keyed.repartitionByRange(*order).sortWithinPartitions(*order)
        .select("conv_id", "key", "n", F.spark_partition_id().alias("part"), F.expr("monotonically_increasing_id() & 8589934591").alias("i"))
    )
    dropped(keyed)
    blocks = ranged.groupBy("conv_id", "part").agg(F.min("i").alias("first"), F.count(F.lit(1)).alias("rows"))
    upto = F.sum("rows").over(Window.partitionBy("conv_id").orderBy("part"))
    starts = blocks.select("conv_id", "part", (upto - F.col("rows") - F.col("first")).alias("shift"))
    turns = ranged.join(starts, ["conv_id", "part"]).select("conv_id", (F.col("i") + F.col("shift")).alias("pos"), "key", "n")
    return turns, blocks.groupBy("conv_id").agg(F.sum("rows").alias("n_own")), ranged


def rebuilt(turns: DataFrame, convs: DataFrame, how: Shape = Shape()) -> tuple[DataFrame, DataFrame]:
    """(conv_id, pos, key, n) and (conv_id, length) after each conversation took over the first h turns of conversation
    c - c % `every`, for its own first h; h = crc32(c) % `most`."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % how.most
    c = convs.select("conv_id", "n_own", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % how.every).alias("base"))
    lenders = convs.select(F.col("conv_id").alias("base"), F.col("n_own").alias("n_base"))
    c = c.join(lenders, "base", "left").withColumn("k", F.least("h", F.coalesce("n_base", F.lit(0))))
    c = c.withColumn("length", F.col("k") + F.greatest(F.lit(0), F.col("n_own") - F.col("h")))
    heads = turns.where((F.col("conv_id") % how.every == 0) & (F.col("pos") < how.most - 1)).withColumnRenamed("conv_id", "base")
    lent = c.select("conv_id", "base", "h").join(heads, "base").where("pos < h").select("conv_id", "pos", "key", "n")
    own = turns.join(c.select("conv_id", "h", "k"), "conv_id").where("pos >= h").select("conv_id", (F.col("pos") - F.col("h") + F.col("k")).alias("pos"), "key", "n")
    return own.unionByName(lent), c.select("conv_id", "length")


def _segments(conversations: DataFrame, how: Shape) -> DataFrame:
    """(conv_id, seg, root, path, ns, last) of each layer of each rebuilt conversation; one without turns has an empty path.

    root: name of the node at which the layer begins ('' for the first); ns: code points of the turns.
    """
    *both, ranged = numbered(conversations)
    turns, lengths = rebuilt(*both, how)
    cut = (
        turns.withColumn("seg", F.expr(f"pos div {how.layer}")).groupBy("conv_id", "seg")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "key", "n"))).alias("t"))
        .select("conv_id", "seg", F.expr("array_join(transform(t, x -> x.key), '')").alias("path"), F.expr("transform(t, x -> x.n)").alias("ns"))
    )
    some = cut.join(lengths, "conv_id").select("conv_id", "seg", "path", "ns", (F.col("seg") == F.expr(f"(length - 1) div {how.layer}")).alias("last"))
    none = lengths.where("length = 0").select("conv_id", F.lit(0).cast("long").alias("seg"), F.lit("").alias("path"), F.expr("cast(array() as array<int>)").alias("ns"), F.lit(True).alias("last"))
    segs = settled(some.unionByName(none))
    dropped(ranged)
    long = segs.where(F.length("path") == NAME * how.layer)
    if long.isEmpty():
        return segs.withColumn("root", F.lit(""))
    chain = long.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("seg", F.expr(_named("path")).alias("d")))).alias("ds"))
    # the path stands in the name by its own short name, so that only these are gathered
    named = _named("concat(element_at(a, -1), ',', x.d)")
    roots = chain.select("conv_id", F.posexplode(F.expr(f"aggregate(ds, array(''), (a, x) -> concat(a, array({named})))")).alias("seg", "root"))
    whole = settled(segs.join(roots.withColumn("seg", F.col("seg").cast("long")), ["conv_id", "seg"], "left").withColumn("root", F.coalesce("root", F.lit(""))))
    dropped(segs)
    return whole


def end_digests(segs: DataFrame) -> DataFrame:
    """(end, ends_sha256): of each node at which conversations end their ids, ascending, comma-joined."""
    ids = segs.where("last").select(F.expr(_end()).alias("end"), "conv_id")
    ranges = ids.groupBy("end", F.shiftright("conv_id", 16).alias("at")).agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest, done = None, None, []
        for batch in batches:
            for end, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if end != key:
                    if digest is not None:
                        done.append((key, digest.hexdigest()))
                    key, digest = end, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(text.as_buffer())
            if len(done) > 5000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*done, strict=True)], names=["end", "ends_sha256"])
                done = []
        if digest is not None:
            done.append((key, digest.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*done, strict=True)], names=["end", "ends_sha256"])

    return ranges.repartition("end").sortWithinPartitions("end", "at").select("end", "ids").mapInArrow(run, "end string, ends_sha256 string")


class DoubleArray:
    """Sequences of codes from 1, sorted, as BASE and CHECK. Slot 0 is the root; CHECK is -1 where a slot is free."""

    def __init__(self, sequences: list[np.ndarray], codes: int):
        room = sum(map(len, sequences)) + codes + 2
        self.base, self.check = np.zeros(room, np.int64), np.full(room, -1, np.int64)
        self.check[0] = 0
        self.free = 1
        level = [(0, 0, len(sequences))]  # slot and the sequences below it
        depth = 0
        while level:
            below = []
            for slot, a, b in level:
                while a < b and len(sequences[a]) <= depth:  # those that end here come first
                    a += 1
                if a == b:
                    continue
                if b - a == 1:
                    kids, cuts = [int(sequences[a][depth])], [a, b]
                else:
                    column = np.fromiter((s[depth] for s in sequences[a:b]), np.int64, b - a)
                    at = np.flatnonzero(np.diff(column)) + 1
                    kids, cuts = column[np.concatenate(([0], at))].tolist(), [a, *(at + a).tolist(), b]
                base = self._place(kids)
                self.base[slot] = base
                for k, (x, y) in zip(kids, zip(cuts, cuts[1:]), strict=True):
                    self.check[base + k] = slot
                    below.append((base + k, x, y))
            level, depth = below, depth + 1

    def _place(self, kids: list[int]) -> int:
        """The first base at which the slots of all children are free."""
        check = self.check
        while check[self.free] != -1:
            self.free += 1
            if self.free == len(check):
                self._grow(len(check))
                check = self.check
        at = self.free
        rest = np.array(kids[1:], np.int64) - kids[0]
        while True:
            last = at + int(rest[-1]) if len(rest) else at
            if last >= len(check):
                self._grow(last + 1)
                check = self.check
            if check[at] == -1 and (check[at + rest] == -1).all():
                return at - kids[0]
            at += 1

    def _grow(self, least: int) -> None:
        more = max(least, len(self.check) // 2)
        self.base = np.concatenate((self.base, np.zeros(more, np.int64)))
        self.check = np.concatenate((self.check, np.full(more, -1, np.int64)))

    def step(self, slots: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The child of each slot by a code."""
        to = self.base[slots] + codes
        if (self.check[to] != slots).any():
            raise LookupError("no such sequence")
        return to


TRIE = "root string, top string, ns array<int>, is_top boolean, conv_id long, depth int, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, end string"
ROWS = ["root", "top", "path", "ns", "least", "members", "end", "leaves", "saved", "children"]


def _shard(rows: list[tuple]) -> pa.RecordBatch:
    """All nodes of one shard, its top included: depth counts from the layer's root."""
    root, top = rows[0][0], rows[0][1]
    skip = len(top) // NAME
    names = np.concatenate([np.frombuffer(r[2].encode(), f"S{NAME}") for r in rows])
    chars = np.concatenate([np.asarray(r[3], np.int64) for r in rows])
    found, first, dense = np.unique(names, return_index=True, return_inverse=True)  # dense codes, in the order of names
    sizes = np.array([len(r[3]) for r in rows])
    starts = np.concatenate(([0], sizes.cumsum()))
    sequences = [dense[a + skip : b] + 1 for a, b in zip(starts, starts[1:])]
    trie = DoubleArray(sequences, len(found))
    size = len(trie.check)
    n_convs, least, ends = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max), [None] * len(rows)
    members, smallest = np.array([r[5] for r in rows], np.int64), np.array([r[4] for r in rows], np.int64)
    text, depth = np.zeros(size, np.int64), np.zeros(size, np.int32)
    by_code = chars[first]
    slots, at, levels = np.zeros(len(rows), np.int64), np.arange(len(rows)), []
    d = 0
    last = np.zeros(len(rows), np.int64)
    while True:  # all sequences one turn further
        np.add.at(n_convs, slots, members[at])
        np.minimum.at(least, slots, smallest[at])
        depth[slots] = d
        levels.append(np.unique(slots))
        last[at] = slots
        more = sizes[at] - skip > d
        if not more.any():
            break
        slots, at = slots[more], at[more]
        codes = dense[starts[at] + skip + d] + 1
        slots = trie.step(slots, codes)
        text[slots] = by_code[codes - 1]
        d += 1
    there = np.concatenate(levels)
    parents = trie.check[there]
    children = np.bincount(parents[1:], minlength=size).astype(np.int64)
    leaves, saved = np.zeros(size, np.int64), np.zeros(size, np.int64)
    end_of: dict[int, str] = {}
    for i, r in enumerate(rows):  # each sequence ends at a slot of its own
        s = int(last[i])
        if r[6] is not None:
            end_of[s] = r[6]
        if r[9]:
            leaves[s] += r[7]
            saved[s] += r[8]
            children[s] += r[9]
    leaves[there] += children[there] == 0
    own = (n_convs - 1) * text
    own[0] = 0 if skip == 0 else (n_convs[0] - 1) * int(chars[skip - 1])
    saved[there] += own[there]
    for level in reversed(levels[1:]):
        np.add.at(leaves, trie.check[level], leaves[level])
        np.add.at(saved, trie.check[level], saved[level])
    n = len(there)
    parent = pa.array(least[parents], pa.int64(), mask=there == 0)
    tops = pa.array([rows[0][3][:skip] if s == 0 else None for s in there.tolist()], pa.list_(pa.int32()))
    columns = [
        pa.array([root] * n, pa.string()), pa.array([top if s == 0 else None for s in there.tolist()], pa.string()), tops, pa.array(there == 0),
        pa.array(least[there]), pa.array(depth[there] + skip, pa.int32()), parent, pa.array(n_convs[there]), pa.array(children[there]),
        pa.array(leaves[there]), pa.array(saved[there]), pa.array([end_of.get(s) for s in there.tolist()], pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in TRIE.split(", ")])


def _tries(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in range(len(ROWS))), strict=True):
                if r[:2] != key and held:
                    yield _shard(held)
                    held = []
                key = r[:2]
                held.append(r)
        if held:
            yield _shard(held)

    return rows.select(*ROWS).repartition("root", "top").sortWithinPartitions("root", "top", "path").mapInArrow(run, TRIE)


def _prefix(path: str, turns: str | int) -> str:
    return f"substring({path}, 1, {NAME} * ({turns}))"


def _dealt(sequences: DataFrame, how: Shape) -> tuple[DataFrame, DataFrame]:
    """Sequences with the prefix `top` of their shard, and those that end above the tops of the shards around them."""
    turns = F.expr(f"length(path) div {NAME}")
    left, tops, short, s = sequences.withColumn("turns", turns), None, None, 1
    while True:
        ended, going = left.where(F.col("turns") < s), left.where(F.col("turns") >= s).withColumn("top", F.expr(_prefix("path", s)))
        short = ended if short is None else short.unionByName(ended)
        big = settled(going.groupBy("root", "top").agg(F.sum("turns").alias("w")).where(F.col("w") > max(how.shard, how.layer)).select("root", "top"))
        if big.isEmpty():
            dropped(big)
            return (going if tops is None else tops.unionByName(going)), short
        fits = going.join(big, ["root", "top"], "left_anti")
        tops = fits if tops is None else tops.unionByName(fits)
        left = settled(going.join(big, ["root", "top"], "left_semi").drop("top"))
        s *= 2


def _upper(tops: DataFrame, short: DataFrame) -> DataFrame:
    """Nodes above the shards' tops, merged by prefix: root, path, depth, least, n_convs, n_children, n_leaves, saved_tokens, end; the layer's root has depth 0."""
    of_tops = tops.select("root", F.col("top").alias("path"), "ns", "n_convs", F.col("conv_id").alias("least"), "n_leaves", F.col("saved_tokens").alias("saved"), F.lit(None).cast("string").alias("end"), F.lit(-1).alias("up"))
    of_ends = short.select("root", "path", "ns", F.col("members").alias("n_convs"), "least", F.lit(0).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved"), "end", F.lit(0).alias("up"))
    each = of_tops.unionByName(of_ends).withColumn("depth", F.explode(F.expr("sequence(0, size(ns) + up)")))
    at = each.withColumn("here", F.expr(_prefix("path", "depth")))
    merged = settled(
        at.groupBy("root", "depth", "here").agg(
            F.sum("n_convs").alias("n_convs"), F.min("least").alias("least"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"),
            F.max(F.expr("get(ns, depth - 1)")).alias("chars"), F.max(F.when(F.expr("up = 0 and depth = size(ns)"), F.col("end"))).alias("end"),
        )
    )
    above = F.expr(_prefix("here", "depth - 1"))
    kids = merged.where("depth > 0").select("root", above.alias("here")).unionByName(tops.select("root", F.expr(f"substring(top, 1, length(top) - {NAME})").alias("here")))
    nodes = merged.join(kids.groupBy("root", "here").agg(F.count(F.lit(1)).alias("n_children")), ["root", "here"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
    nodes = nodes.withColumns({"leaf": (F.col("n_children") == 0).cast("long"), "own": F.when(F.col("depth") > 0, (F.col("n_convs") - 1) * F.col("chars")).otherwise(0)})
    sums = nodes.where("leaf + own > 0").withColumn("to", F.explode(F.expr("sequence(0, depth)"))).groupBy("root", F.expr(_prefix("here", "to")).alias("here")).agg(F.sum("leaf").alias("more_leaves"), F.sum("own").alias("more_saved"))
    plus = lambda a, b: (F.col(a) + F.coalesce(b, F.lit(0))).cast("long")
    return nodes.join(sums, ["root", "here"], "left").select(
        "root", F.col("here").alias("path"), "depth", "least", "n_convs", "n_children", plus("n_leaves", "more_leaves").alias("n_leaves"), plus("saved", "more_saved").alias("saved_tokens"), "end"
    )


def trie(conversations: DataFrame, how: Shape = Shape()) -> DataFrame:
    """NODE and ends_sha256 of every node."""
    segs = _segments(conversations, how)
    ends = F.count_if("last") > 0
    whole = segs.groupBy("seg", "root", "path").agg(F.first("ns").alias("ns"), F.min("conv_id").alias("least"), F.count(F.lit(1)).alias("members"), F.when(ends, F.lit(True)).alias("ends"))
    sequences = settled(whole.withColumns({"here": F.expr(_end()), "end": F.expr(f"case when ends then {_end()} end")}).drop("ends"))
    deepest = sequences.agg(F.max("seg")).first()[0]
    found, below = None, None
    for seg in range(-1 if deepest is None else deepest, -1, -1):
        rows = sequences.where(F.col("seg") == seg)
        totals = ["leaves", "saved", "children"]
        if below is None:
            rows = rows.withColumns({c: F.lit(0).cast("long") for c in totals})
        else:
            rows = rows.join(below, rows["here"] == below["node"], "left").drop("node").withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in totals})
        dealt, short = _dealt(rows.drop("here", "seg"), how)
        inner = settled(_tries(dealt))
        tops = inner.where("is_top")
        upper = settled(_upper(tops, short))
        # who is smallest above: the shared nodes, and for a layer's first turns the end of the layer before
        names = upper.where("depth > 0" if seg else "true").select("root", F.col("path").alias("above"), F.col("least").alias("parent"))
        if seg:
            first = segs.where((F.col("seg") == seg - 1) & (F.length("path") == NAME * how.layer)).select(F.expr(_end()).alias("root"), "conv_id").groupBy("root").agg(F.min("conv_id").alias("parent"))
            names = names.unionByName(first.select("root", F.lit("").alias("above"), "parent"))
        shared = tops.select("root", F.expr(f"substring(top, 1, length(top) - {NAME})").alias("above"), *(c for c in NODE if c != "parent_conv_id"), "end").unionByName(
            upper.where("depth > 0" if seg else "true").select(
                "root", F.when(F.col("depth") > 0, F.expr(_prefix("path", "depth - 1"))).alias("above"), F.col("least").alias("conv_id"), "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "end"
            )
        )
        shared = shared.join(names, ["root", "above"], "left").withColumnRenamed("parent", "parent_conv_id")
        nodes = inner.where("not is_top").select(*NODE, "end").unionByName(shared.select(*NODE, "end"))
        nodes = nodes.withColumns({"depth": F.col("depth").cast("long") + seg * how.layer, "n_children": F.col("n_children").cast("long")})
        found = nodes if found is None else found.unionByName(nodes)
        below = upper.where("depth = 0").select(F.col("root").alias("node"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"), F.col("n_children").alias("children"))
    if found is None:
        schema = ", ".join(f"{c} long" for c in NODE) + ", ends_sha256 string"
        return conversations.sparkSession.createDataFrame([], schema)
    with_end = found.where("end is not null").join(end_digests(segs), "end").select(*NODE, "ends_sha256")
    return found.where("end is null").select(*NODE, F.lit(EMPTY).alias("ends_sha256")).unionByName(with_end)
