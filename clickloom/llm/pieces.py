"""SentencePiece encoding and decoding over a relational lattice.

Texts are cut into units that no piece crosses. The lattice of all different units is a table: substrings of bounded
length are exploded and joined by equality to the piece table (bounded: the vocabulary), the edges are grouped by unit, and a
higher-order aggregate folds them: Viterbi's best sum of scores for unigram models; for BPE models, whose scores are merge
ranks and whose best sum isn't what the model encodes, the merges over the same edges, each edge once in the order in which
merges happen (`Local.rules`). The borders of a unit are the bits of one number: the rare units of over `LATTICE` characters,
which are no words, are folded by the same rule with a heap, a row each.

Texts are not shuffled. Each file split that Spark scans is a shard; a first pass lists its different units, and the
units' ids go back to the shards that hold them, as a table with a folder for each. A second pass over the same splits reads the
dictionary of its shard, which is as large as a split has different words. A table that isn't read from files is written once.

Every text is encoded whole. A null or empty text has no ids. Characters that are no piece become
the pieces of their UTF-8 bytes, so that decoding gives the text back; only a literal U+2581 comes
back as a space. Of equal scores the leftmost merge goes first. Repeated rows are encoded alike; an empty table gives an empty result; only doc_id
and text are read, so other columns can't clash.
"""

from __future__ import annotations

import heapq
import os
import posixpath
import re
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import dropped, filesystem, lean, settled, shared_dir

SPACE = "▁"
#: The model file where none is named: a setting of the driver's environment.
MODEL = os.environ.get("CLICKLOOM_PIECES", "/opt/tokenizers/piece_bpe_32k.model")
#: Characters of the longest unit whose edges are a relation.
LATTICE = 64
#: Words and units that a task has seen and still holds.
HELD = 500_000


@dataclass(frozen=True)
class Model:
    """pieces: (piece, score) by id for ordinary pieces, None for the others; first_byte: id of byte 0's piece, or
    None; unk: id for what has no piece; kind: bpe or unigram; prefix: a space is put before each text."""

    pieces: tuple[tuple[str, float] | None, ...]
    first_byte: int | None
    unk: int = 0
    kind: str = "bpe"
    prefix: bool = True

    @classmethod
    def load(cls, path: str = MODEL, kind: str = "bpe") -> Model:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(sp.get_piece_size())
        odd = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i) for i in ids]
        pieces = tuple(None if odd[i] else (sp.id_to_piece(i), sp.get_score(i)) for i in ids)
        return cls(pieces, next((i for i in ids if sp.is_byte(i)), None), sp.unk_id(), kind)

    @property
    def longest(self) -> int:
        return max((len(p[0]) for p in self.pieces if p), default=1)

    def units(self) -> re.Pattern:
        """Matches one unit after another, with no piece across a border.

        Characters in no piece of several are units of their own; spaces begin a unit; where no
        piece has a letter before another character, letters end one.
        """
        multi = [p[0] for p in self.pieces if p and len(p[0]) > 1]
        known = set("".join(multi)) - {SPACE}
        if any(SPACE in p.lstrip(SPACE) for p in multi):
            return re.compile(r"(?s).+")
        letters = {c for c in known if c.isalpha()}
        escape = lambda s: "[" + "".join(map(re.escape, sorted(s))) + "]" if s else r"(?!)"
        if any(a in letters and b not in letters for p in multi for a, b in zip(p, p[1:])):
            return re.compile(f"(?s){SPACE}*{escape(known)}+|{SPACE}+|.")
        rest = escape(known - letters)
        return re.compile(f"(?s){SPACE}*(?:{rest}*{escape(letters)}+|{rest}+)|{SPACE}+|.")

    def spaced(self, text: str) -> str:
        return (SPACE * self.prefix + text.replace(" ", SPACE)) if text else ""

    def cut(self) -> Callable[[str], list[str]]:
        """Cuts a text at its spaces into words of one unit or several; texts repeat words, so that few need be cut into units.

        Several spaces in a row stay together: such a text is cut into its units, and so is one where a unit may go on after a space.
        """
        find = self.units().findall
        simple, first = not any(SPACE in p[0].lstrip(SPACE) for p in self.pieces if p), SPACE * self.prefix

        def words(text: str) -> list[str]:
            if simple and text[:1] != " " and "  " not in text and SPACE not in text:
                return (first + text.replace(" ", " " + SPACE)).split(" ") if text else []
            return find(self.spaced(text))

        return words


class Local:
    """The folds for one unit, over the edges that the piece table gives."""

    def __init__(self, model: Model):
        self.model = model
        self.ids = {p[0]: i for i, p in enumerate(model.pieces) if p}
        self.scores = {p[0]: p[1] for p in model.pieces if p}
        self.longest = model.longest

    def of_piece(self, piece: str) -> list[int]:
        found = self.ids.get(piece)
        if found is not None:
            return [found]
        if self.model.first_byte is None:
            return [self.model.unk]
        return [self.model.first_byte + b for b in piece.encode("utf-8", "surrogatepass")]

    def fold(self, unit: str) -> list[int]:
        parts = self._viterbi(unit) if self.model.kind == "unigram" else self._merged(unit)
        return [i for p in parts for i in self.of_piece(p)]

    def rules(self) -> list[tuple[str, int, int, int, int, int]]:
        """(piece, id, mid, rank, offset, path) of each piece that merges can make: where its two parts meet, and when it is made.

        What is merged inside a piece that comes about is what is merged in the piece alone. So its two last parts are always the
        same, and if they make no whole of it, it never comes about. By score, a piece comes after its parts, unless one of them has
        a worse score: then it is made right after that one. `rank` is the worst score on the way, `offset` where its piece begins, and
        `path` tells those apart that follow it. By rank, place of rank's piece and path, the edges of a unit are in order of their merges.
        """
        rank = {s: i for i, s in enumerate(sorted(set(self.scores.values()), reverse=True))}
        when: dict[str, tuple[tuple[int, int], tuple]] = {}
        mids: dict[str, int] = {}
        for piece in sorted((p for p in self.scores if len(p) > 1), key=len):
            parts, mid = self._merges(piece)
            if len(parts) > 1:
                continue
            (left, path), ((worst, at), other) = (when.get(x, ((-1, 0), ())) for x in (piece[:mid], piece[mid:]))
            last, path = max((left, path), ((worst, mid + at), other))
            own = (rank[self.scores[piece]], 0)
            when[piece] = (own, ()) if own > last else (last, (*path, (own[0], -last[1])))
            mids[piece] = mid
        paths = {x: i for i, x in enumerate(sorted({path for _, path in when.values()}))}
        return [(p, self.ids[p], mids[p], *last, paths[path]) for p, (last, path) in when.items()]

    def _merged(self, unit: str) -> list[str]:
        return self._merges(unit)[0]

    def _merges(self, unit: str) -> tuple[list[str], int]:
        """The merges in order of score, of equal ones the leftmost, from a heap; and where the two parts of the last one met."""
        parts: list[str] = list(unit)
        mid = 0
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, int, str]] = []

        def push(i: int, j: int) -> None:
            both = parts[i] + parts[j]
            if both in self.scores:
                heapq.heappush(heap, (-self.scores[both], i, j, both))

        for i in range(len(parts) - 1):
            push(i, i + 1)
        while heap:
            _, i, j, both = heapq.heappop(heap)
            if not parts[i] or not parts[j] or after[i] != j or parts[i] + parts[j] != both:
                continue
            parts[i], parts[j], after[i], mid = both, "", after[j], j
            if after[j] < len(parts):
                before[after[j]] = i
                push(i, after[j])
            if before[i] >= 0:
                push(before[i], i)
        return [p for p in parts if p], mid

    def _viterbi(self, unit: str) -> list[str]:
        low = min(self.scores.values(), default=0.0) - 10.0
        best: list[tuple[float, int]] = [(0.0, 0)]
        for end in range(1, len(unit) + 1):
            options = [(best[end - 1][0] + low, end - 1)] if unit[end - 1] not in self.scores else []
            options += [(best[a][0] + self.scores[unit[a:end]], a) for a in range(max(0, end - self.longest), end) if unit[a:end] in self.scores]
            best.append(max(options, key=lambda x: (x[0], -x[1])))
        parts, end = [], len(unit)
        while end:
            parts.append(unit[best[end][1] : end])
            end = best[end][1]
        return parts[::-1]


def piece_table(spark: SparkSession, model: Model) -> DataFrame:
    """(piece, id, score) of the ordinary pieces: as many rows as the vocabulary, at most."""
    rows = [(p[0], i, float(p[1])) for i, p in enumerate(model.pieces) if p]
    return spark.createDataFrame(rows, "piece string, id int, score double")


def sharded(docs: DataFrame) -> DataFrame:
    """(shard, doc_id, text): the shard names the file split that a row is read from, so that a second scan finds the same.

    A table that isn't a plain scan of files (rows of one split must stay together) is written once.
    """
    try:
        rows = docs.select(F.xxhash64("_metadata.file_path", "_metadata.file_block_start").alias("shard"), "doc_id", "text")
        plan = rows._jdf.queryExecution().optimizedPlan().toString().splitlines()
        if all(re.match(r"\W*(Project|Filter|Relation)\b", x) for x in plan if x.strip()):
            return rows
    except AnalysisException:  # not read from files
        pass
    return sharded(settled(docs.select("doc_id", "text")))


def shard_units(rows: DataFrame, model: Model) -> DataFrame:
    """(unit, shards): all different units, each with the shards that hold it. What a task has seen twice is sent once."""

    def table(seen: dict[int, set[str]]) -> pa.RecordBatch:
        n = [len(v) for v in seen.values()]
        return pa.RecordBatch.from_arrays([pa.array([u for v in seen.values() for u in v], pa.string()), pa.array(np.repeat(np.array(list(seen), np.int64), n))], names=["unit", "shard"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()  # of what stages before have left in this worker
        find, words, seen, known = model.units().findall, model.cut(), {}, {}
        for batch in batches:
            for at in range(0, batch.num_rows, 256):  # texts may be long
                part = batch.slice(at, 256)
                for shard, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    if text:
                        units, old = seen.setdefault(shard, set()), known.setdefault(shard, set())
                        for w in set(words(text)) - old:
                            found = find(w)
                            units.update(found) if len(found) > 1 else units.add(w)
                            if len(w) <= LATTICE:
                                old.add(w)
                if sum(map(len, (*seen.values(), *known.values()))) > HELD:  # bounded memory; the rest is told apart in Spark
                    yield table(seen)
                    seen, known = {}, {}
        if seen:
            yield table(seen)
        del seen, known
        lean()

    return rows.select("shard", "text").mapInArrow(run, "unit string, shard long").groupBy("unit").agg(F.collect_set("shard").alias("shards"))


def lattice(units: DataFrame, pieces: DataFrame, longest: int) -> DataFrame:
    """(unit, edges): every substring of `unit` that is a piece, as (start, end, id, score), from 1, end exclusive."""
    starts = units.select("unit", F.explode(F.sequence(F.lit(1), F.length("unit"))).alias("start"))
    cut = starts.select("unit", "start", F.explode(F.expr(f"sequence(start + 1, least(start + {longest}, length(unit) + 1))")).alias("end"))
    edges = cut.withColumn("piece", F.expr("substring(unit, start, end - start)")).join(F.broadcast(pieces), "piece")  # bounded by the vocabulary
    grouped = edges.groupBy("unit").agg(F.collect_list(F.struct("start", "end", "id", "score")).alias("edges"))
    return units.select("unit").join(grouped, "unit", "left").withColumn("edges", F.coalesce("edges", F.expr("cast(array() as array<struct<start:int,end:int,id:int,score:double>>)")))


def merge_table(spark: SparkSession, model: Model) -> DataFrame:
    """`Local.rules` as a table, and the empty piece, that no unit is left without a row."""
    return spark.createDataFrame([("", None, None, None, None, None), *Local(model).rules()], "piece string, id int, mid int, rank int, offset int, path int")


def merge_lattice(units: DataFrame, pieces: DataFrame, longest: int) -> DataFrame:
    """(unit, edges): every substring of `unit` (two characters or more) that merges can make, in `merge_table`.

    Borders of a unit are bits, from 0 before its first character. span: those of the edge, its ends included; before: those that
    are there when it can be merged; after: those that are left then, its ends. Border 64 falls on bit 0, which is always there too.
    """
    starts = units.select("unit", F.explode(F.expr("sequence(-1, length(unit) - 2)")).alias("start"))
    cut = starts.select("unit", "start", F.explode(F.expr(f"sequence(start + 2, if(start < 0, 1, least(start + {longest}, length(unit))))")).alias("end"))
    edges = cut.withColumn("piece", F.expr("if(start < 0, '', substring(unit, start + 1, end - start))")).join(F.broadcast(pieces), "piece")  # bounded by the vocabulary
    bits = edges.withColumn("after", F.expr("shiftleft(1L, start) | shiftleft(1L, end)")).withColumn("inner", F.expr("shiftleft(shiftleft(-1L, start), 1) & ~shiftleft(shiftleft(-1L, end - 1), 1)"))
    key = F.expr("shiftleft(cast(rank as long), 32) | shiftleft(cast(start + offset as long), 24) | path")
    edge = F.struct(key.alias("key"), F.expr("after | inner").alias("span"), F.expr("after | shiftleft(1L, start + mid)").alias("before"), "after", "start", "id")
    return bits.groupBy("unit").agg(F.collect_list(F.when(F.col("start") >= 0, edge)).alias("edges"))


def merged(grid: DataFrame) -> DataFrame:
    """(unit, ids): one pass over the edges in the order of their merges; each that can be merged takes away the border in it.

    A character that is in no edge left has -1 less its code point.
    """
    borders = "aggregate(sort_array(edges), -1L, (m, e) -> if(m & e.span = e.before, m ^ e.before ^ e.after, m))"
    parts = grid.withColumn("borders", F.expr(borders)).withColumn("parts", F.expr("filter(edges, e -> borders & e.span = e.after)"))
    return parts.select(
        "unit",
        F.expr("""transform(filter(sequence(0, length(unit) - 1), i -> shiftright(borders, i) & 1 = 1), i ->
            coalesce(get(filter(parts, e -> e.start = i), 0).id, -1 - ascii(substring(unit, i + 1, 1))))""").alias("ids"),
    )


def _best_path(low: float) -> Column:
    """Borders of the path with the largest sum of scores; a character without a piece costs `low`."""
    return F.expr(f"""
        aggregate(sequence(1, length(unit)), array(struct(cast(0 as double) as score, array(1) as cuts)), (best, j) ->
          concat(best, array(array_max(transform(
              concat(filter(edges, e -> e.end = j + 1),
                     case when exists(edges, e -> e.end = j + 1 and e.start = j) then cast(array() as array<struct<start:int,end:int,id:int,score:double>>)
                          else array(struct(j as start, j + 1 as end, cast(null as int) as id, cast({low} as double) as score)) end),
              e -> struct(best[e.start - 1].score + e.score as score, concat(best[e.start - 1].cuts, array(e.end)) as cuts))))),
          best -> element_at(best, -1).cuts)""")


def folded(grid: DataFrame, model: Model) -> DataFrame:
    """(unit, parts): the ids of each part, or null for a character without a piece, with its text."""
    low = min((p[1] for p in model.pieces if p), default=0.0) - 10.0
    return grid.withColumn("cuts", _best_path(low)).select(
        "unit",
        F.expr("""transform(slice(cuts, 1, size(cuts) - 1), (a, i) -> struct(
            get(filter(edges, e -> e.start = a and e.end = cuts[i + 1]), 0).id as id,
            substring(unit, a, cuts[i + 1] - a) as piece))""").alias("parts"),
    )


def _ids(model: Model) -> Column:
    """The ids of `parts`: a character without a piece stands as its bytes, or as the unknown piece."""
    if model.first_byte is None:
        other = f"array({model.unk})"
    else:
        other = f"transform(sequence(1, octet_length(p.piece)), i -> {model.first_byte} + cast(conv(substring(hex(p.piece), 2 * i - 1, 2), 16, 10) as int))"
    return F.expr(f"flatten(transform(parts, p -> case when p.id is not null then array(p.id) else {other} end))")


def _with_lone(ids: pa.ListArray, local: Local) -> pa.ListArray:
    """`ids` with the ids of each character that stands as -1 less its code point."""
    flat, ends = ids.flatten().to_numpy(zero_copy_only=False), ids.value_lengths().to_numpy(zero_copy_only=False).cumsum()
    lone, at = np.unique(flat[flat < 0], return_inverse=True)
    of = [local.of_piece(chr(-1 - x)) for x in lone.tolist()]
    n = np.ones(len(flat), np.int64)
    n[flat < 0] = np.array([len(x) for x in of], np.int64)[at]
    out = np.repeat(flat, n)
    if len(lone):
        out[out < 0] = np.concatenate([of[x] for x in at.tolist()])
    offsets = np.concatenate(([0], n.cumsum()))[np.concatenate(([0], ends))]
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(out.astype(np.int32)))


def encoded_units(units: DataFrame, model: Model) -> DataFrame:
    """(unit, ids, same) of all units of `units`, a row each; same: decoding the ids gives the unit."""
    local = Local(model)

    def one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([local.fold(u) for u in batch.column(0).to_pylist()], pa.list_(pa.int32()))], names=["unit", "ids"])

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        table = pa.array(decoder(model), pa.binary())
        for batch in batches:
            ids = _with_lone(batch.column(1), local)
            text = pc.binary_join(pa.ListArray.from_arrays(ids.offsets, table.take(ids.values)), b"")
            same = pc.equal(text, pc.replace_substring(batch.column(0), SPACE, " ").cast(pa.binary()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, same], names=["unit", "ids", "same"])

    words, others = (units.select("unit").where(c) for c in (F.length("unit") <= LATTICE, F.length("unit") > LATTICE))
    if model.kind == "bpe":
        found = merged(merge_lattice(words, merge_table(units.sparkSession, model), model.longest))
    else:
        found = folded(lattice(words, piece_table(units.sparkSession, model), model.longest), model).select("unit", _ids(model).alias("ids"))
    every = found.unionByName(others.mapInArrow(one_by_one, "unit string, ids array<int>"))
    return every.mapInArrow(decoded, "unit string, ids array<int>, same boolean")


#: Units whose lattice a task holds.
UNITS = 30_000
#: A unit in so large a share of the shards (one in two) stands in one dictionary for all; so that has at most as many units as two shards.
COMMON = 2


def dictionaries(rows: DataFrame, model: Model) -> str:
    """Writes the ids of each shard's units to a folder of its own under the one returned, in the shared folder.

    Units that many shards have are written once, to the folder `common`, and not sent to each.
    """
    units = settled(shard_units(rows, model))  # texts are cut once
    folder = f"{shared_dir(rows.sparkSession)}/clickloom-pieces-{uuid.uuid4().hex}"
    n = rows.select("shard").distinct().count()
    places = F.when(F.size("shards") * COMMON >= n, F.array(F.lit("common"))).otherwise(F.col("shards").cast("array<string>"))
    parts = units.count() // UNITS + 1
    known = encoded_units(units.select("unit").repartition(parts, "unit"), model).join(units, "unit")
    known.select("unit", "ids", "same", F.explode(places).alias("shard")).repartition("shard").write.partitionBy("shard").parquet(folder)
    dropped(units)
    return folder


class Known(dict):
    """The ids of units and, as they come, of words of several units."""

    def __init__(self, model: Model):
        super().__init__()
        self.find, self.odd = model.units().findall, set()

    def __missing__(self, word: str) -> bytes:
        units = self.find(word)
        if units == [word]:
            raise KeyError(word)
        ids = b"".join([self[u] for u in units])
        if not self.odd.isdisjoint(units):
            self.odd.add(word)
        if len(word) <= LATTICE:
            self[word] = ids
        return ids


class Shard:
    """The dictionary of the shard that a task is at, with the common one."""

    def __init__(self, folder: str, model: Model):
        self.fs, self.root = filesystem(folder)
        self.model, self.at, self.known = model, None, Known(model)

    @property
    def odd(self) -> set[str]:
        return self.known.odd

    def _read(self, name: str) -> None:
        out = self.known
        place = posixpath.join(self.root, f"shard={name}")
        for f in self.fs.get_file_info(pyarrow.fs.FileSelector(place, allow_not_found=True)):
            if f.path.endswith(".parquet"):
                with self.fs.open_input_file(f.path) as source:
                    for part in pq.ParquetFile(source).iter_batches(columns=["unit", "ids", "same"]):
                        ids = part.column("ids")
                        self.odd.update(part.column("unit").filter(pc.invert(part.column("same"))).to_pylist())
                        flat, ends = ids.flatten().to_numpy(zero_copy_only=False).astype(np.int32), ids.value_lengths().to_numpy(zero_copy_only=False).astype(int).cumsum()
                        out.update(zip(part.column("unit").to_pylist(), (flat[i:j].tobytes() for i, j in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)), strict=True))

    def ids(self, shard: int, words: list[str]) -> bytes:
        """The ids of all words, one after another; those of several units are kept like units."""
        if shard != self.at:
            self.known = Known(self.model)  # the one before goes first
            self.at = shard
            self._read("common")
            self._read(str(shard))
        return b"".join(map(self.known.__getitem__, words))


def decoder(model: Model) -> list[bytes]:
    """The bytes of each id; control pieces have none, the unknown piece has U+2047."""
    out = [b""] * len(model.pieces)
    for i, p in enumerate(model.pieces):
        if p:
            out[i] = p[0].replace(SPACE, " ").encode()
        elif model.first_byte is not None and 0 <= i - model.first_byte < 256:
            out[i] = bytes([i - model.first_byte])
    if not out[model.unk]:
        out[model.unk] = " ⁇ ".encode()
    return out


def _text(ids: list[int], table: list[bytes], prefix: bool) -> str:
    text = b"".join(map(table.__getitem__, ids)).decode("utf-8", "replace")
    return text[1:] if prefix and text[:1] == " " else text


def encode(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, ids, n_tokens, round_trip (decoding gives the text) for each row of `docs`."""
    model = model or Model.load()
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = sharded(docs)
    folder = dictionaries(rows, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        shard, cut = Shard(folder, model), model.cut()
        for batch in batches:
            shards, doc_ids, texts = batch.columns
            for at in range(0, batch.num_rows, 256):  # texts may be long
                found, same = [], []
                for of, text in zip(shards.slice(at, 256).to_pylist(), texts.slice(at, 256).to_pylist(), strict=True):
                    words = cut(text) if text else []
                    found.append(shard.ids(of, words) if words else b"")
                    # decoding joins what the units give: a space for U+2581, and the units themselves but for odd ones
                    same.append(not text or (SPACE not in text and (not shard.odd or shard.odd.isdisjoint(words))))
                n = np.array([len(x) // 4 for x in found], np.int64)
                flat = pa.Array.from_buffers(pa.int32(), int(n.sum()), [None, pa.py_buffer(b"".join(found))])
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], n.cumsum())).astype(np.int32)), flat)
                yield pa.RecordBatch.from_arrays([doc_ids.slice(at, 256), lists, pa.array(n), pa.array(same, pa.bool_())], names=["doc_id", "ids", "n_tokens", "round_trip"])

    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, n_tokens long, round_trip boolean")


def decode(encoded: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id and text of each row (doc_id, ids). Null ids are an empty text; ids outside the model raise."""
    model = model or Model.load()
    table, prefix = decoder(model), model.prefix
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [_text(ids or [], table, prefix) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")
