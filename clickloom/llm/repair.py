"""Conversation structure repair: the cheapest edits that give each conversation a legal order of roles.

Rows may be damaged first, by a checksum of their key (`damaged`), as tests of a repair need. `repair`
takes the rows of each conversation by turn, counts their faults and finds the cheapest edits (Keep,
Rerole, Delete, Insert) after which the role initials read `(s?(ua)+)?`; of equally cheap edits those
whose initials are the ASCII-least.

The dynamic program goes once over the rows of a conversation, with one candidate for each of the four
states of that pattern. Candidates share the prefixes of their edits: an edit is a node with its parent, an ancestor
further up (skew-binary lifting: one jump a node instead of one for each power of two, so that memory
stays linear) and a rolling hash of the letters down to it. Two candidates of equal cost are compared by a
search for their longest common prefix over those jumps, by hash; what the hash calls equal is then verified letter by
letter up to the node that both share. Candidates that can't become the cheapest any more are given up, and from time to time what
all others begin with is written down, one byte a row, and its nodes are forgotten. The repaired text is not kept: each candidate
carries the running digest of its own.

Rows are shuffled by conversation and sorted, and stream through a task: it holds a digest and a letter for each row
and the nodes of the last ones, never the texts, and one conversation, which is one row of the result, in one task, however long it is.

Null role, text or turn count as one space in the key that decides the damage, null role and text as one space
elsewhere too. Rows of equal turn go by role, then text. A null conv_id is a conversation of its own. Repeated rows are
duplicates. A conversation that the damage empties has zeros, no edits and the digest of the empty text. Very
long texts are hashed as they come. An empty table gives an empty result; only conv_id, turn,
role and text are read, so other columns can't clash.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
_FILLED = re.compile(r"[^\x20\x09-\x0D]")
_ENDS = ".!?"
#: States: nothing yet, after a system row, after a user row, after an assistant row. The initials that may follow, and where to.
START, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: The role that an insertion or a new role gives in each state.
NEXT = (("user", USER), ("user", USER), ("assistant", ASSISTANT), ("user", USER))
LEGAL_PAIRS = {"su", "ua", "au"}
BASE, MODULUS = 1_000_003, (1 << 61) - 1
OUT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and `dropped`, after the damage: 0 drops a row, 1 empties its text, 2 takes its `.`, `!`
    and `?` away, 3 repeats it, 4 makes it the user's, by crc32 of `conv_id:turn` mod 20. Dropped rows stay, without text, as marks of their conversation."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    how = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), how.alias("how"))
    cut = F.when(F.col("how") <= 1, "").when(F.col("how") == 2, F.regexp_replace("text", r"[.!?]", "")).otherwise(F.col("text"))
    out = rows.select("conv_id", "turn", F.when(F.col("how") == 4, "user").otherwise(F.col("role")).alias("role"), cut.alias("text"), (F.col("how") == 0).alias("dropped"), "how")
    return out.withColumn("twice", F.explode(F.expr("array_repeat(0, if(how = 3, 2, 1))"))).drop("how", "twice")


class Edits:
    """Lists of edits that share their prefixes: node 0 is the empty one, or what all lists begin with (`done`, in pieces)."""

    def __init__(self):
        self.parent, self.jump, self.depth, self.hash, self.letter = [0], [0], [0], [0], [""]
        self.done: list[str] = []

    def __len__(self) -> int:
        return len(self.letter)

    def add(self, node: int, letter: str) -> int:
        """The list `node` with one more letter."""
        near = self.jump[node]
        far = self.jump[near]
        depth = self.depth
        # two jumps of equal length become one that is twice as long and one more
        self.jump.append(far if depth[node] - depth[near] == depth[near] - depth[far] else node)
        self.parent.append(node)
        depth.append(depth[node] + 1)
        self.hash.append((self.hash[node] * BASE + ord(letter)) % MODULUS)
        self.letter.append(letter)
        return len(self.letter) - 1

    def up(self, node: int, depth: int) -> int:
        """The prefix of that many letters."""
        while self.depth[node] > depth:
            j = self.jump[node]
            node = j if self.depth[j] >= depth else self.parent[node]
        return node

    def less(self, a: int, b: int) -> bool:
        """Whether a's letters come before b's."""
        n = min(self.depth[a], self.depth[b])
        x, y = self.up(a, n), self.up(b, n)
        if self.hash[x] == self.hash[y] and self._same(x, y):
            return self.depth[a] < self.depth[b]
        while True:
            p, q = self.parent[x], self.parent[y]
            if self.hash[p] == self.hash[q] and self._same(p, q):
                return self.letter[x] < self.letter[y]
            i, j = self.jump[x], self.jump[y]  # of equal depth, as the jumps depend on the depth alone
            x, y = (i, j) if self.hash[i] != self.hash[j] else (p, q)

    def _same(self, x: int, y: int) -> bool:
        """Letters are equal; nodes that two lists share need no further look."""
        while x != y:
            if self.letter[x] != self.letter[y]:
                return False
            x, y = self.parent[x], self.parent[y]
        return True

    def _since(self, node: int) -> str:
        """The letters after `done`."""
        out = []
        while node:
            out.append(self.letter[node])
            node = self.parent[node]
        return "".join(reversed(out))

    def letters(self, node: int) -> str:
        return "".join(self.done) + self._since(node)

    def shared(self, a: int, b: int) -> int:
        """The last node that both lists have."""
        n = min(self.depth[a], self.depth[b])
        a, b = self.up(a, n), self.up(b, n)
        while a != b:
            i, j = self.jump[a], self.jump[b]
            a, b = (i, j) if i != j else (self.parent[a], self.parent[b])
        return a

    def settle(self, live: list[int]) -> list[int]:
        """Keeps the lists `live` alone, under the nodes returned; what all of them begin with goes to `done`."""
        root = functools.reduce(self.shared, live)
        kept = set()
        for node in live:
            while node != root and node not in kept:
                kept.add(node)
                node = self.parent[node]
        fresh, now = Edits(), {root: 0}
        for node in sorted(kept):  # parents are older
            now[node] = fresh.add(now[self.parent[node]], self.letter[node])
        fresh.done = [*self.done, self._since(root)]
        self.__dict__.update(vars(fresh))
        return [now[node] for node in live]


class Repair:
    """One conversation, row after row; room: nodes from which on those that no candidate needs are forgotten."""

    def __init__(self, room: int = 4096):
        self.edits = Edits()
        self.least_room = self.room = room
        #: of each state: cost, edits, digest of the repaired text, whether that has a row
        self.best: list[tuple | None] = [(0, 0, hashlib.sha256(), False), None, None, None]
        self.seen: set[bytes] = set()
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.initial: str | None = None
        self.least = self.most = self.last = None
        self.distinct = 0

    def row(self, turn: int | None, role: str, text: str) -> None:
        """Rows come by turn."""
        if turn is not None:
            self.least = turn if self.least is None else self.least
            self.distinct += turn != self.last
            self.most = self.last = turn
        initial = role[:1]
        self.illegal += self.initial is not None and self.initial + initial not in LEGAL_PAIRS
        self.initial = initial
        body = f"{role}:{text}".encode("utf-8", "surrogatepass")
        key = hashlib.sha256(len(role).to_bytes(8, "big") + body).digest()
        again = key in self.seen
        self.seen.add(key)
        filled = [m for m in (_last_filled(text),) if m]
        gone = not filled or again
        cut = not gone and filled[0] not in _ENDS
        self.blank += not filled
        self.duplicate += bool(filled) and again
        self.truncated += cut
        self._step(role, body, text, gone, TRUNCATED * cut)

    def _step(self, role: str, body: bytes, text: str, gone: bool, extra: int) -> None:
        now: list[tuple | None] = [None] * 4
        self._insert(self.best)
        for q, c in enumerate(self.best):
            if c is None:
                continue
            self._offer(now, q, c, DELETE, "D", None)
            if gone:
                continue
            to = FOLLOWS[q].get(role[:1])
            if to is not None:
                self._offer(now, to, c, extra, "K", body)
            new, to = NEXT[q]
            self._offer(now, to, c, REROLE + extra, "R", f"{new}:{text}".encode("utf-8", "surrogatepass"))
        # before a first pair anything follows that may follow a whole one, and a system row, which costs at most DELETE after one
        for q, more in ((START, DELETE), (SYSTEM, 0)):
            if now[q] is not None and now[q][0] > now[ASSISTANT][0] + more:
                now[q] = None
        self.best = [c and self._taken(c) for c in now]
        if len(self.edits) > self.room:
            live = [q for q, c in enumerate(self.best) if c is not None]
            for q, node in zip(live, self.edits.settle([self.best[q][1] for q in live]), strict=True):
                self.best[q] = (self.best[q][0], node, *self.best[q][2:])
            self.room = max(self.least_room, 2 * len(self.edits))

    def _insert(self, best: list[tuple | None]) -> None:
        """Up to two insertions, from every state; more lead back to the same state."""
        for q in (START, SYSTEM, ASSISTANT, USER, ASSISTANT):
            if best[q] is not None:
                role, to = NEXT[q]
                made: list[tuple | None] = [None] * 4
                self._offer(made, to, best[q], INSERT, "I", f"{role}:".encode())
                if best[to] is None or made[to][0] <= best[to][0]:
                    c = self._taken(made[to])
                    if best[to] is None or c[0] < best[to][0] or self.edits.less(c[1], best[to][1]):
                        best[to] = c

    def _offer(self, into: list[tuple | None], to: int, c: tuple, cost: int, letter: str, body: bytes | None) -> None:
        """Keeps the better one of what stands in `into` and an edit of c: (cost, node before, digest, has a row, letter, body)."""
        new = (c[0] + cost, c[1], c[2], c[3], letter, body)
        had = into[to]
        if had is None or new[0] < had[0] or (new[0] == had[0] and self._before(new, had)):
            into[to] = new

    def _before(self, a: tuple, b: tuple) -> bool:
        """Both lack their last letter: compared once it is there, for which the nodes are cheap."""
        if a[1] == b[1]:
            return a[4] < b[4]
        return self.edits.less(self.edits.add(a[1], a[4]), self.edits.add(b[1], b[4]))

    def _taken(self, c: tuple) -> tuple:
        cost, node, digest, some, letter, body = c
        if body is not None:
            digest = digest.copy()
            digest.update(b"\n" + body if some else body)
        return cost, self.edits.add(node, letter), digest, some or body is not None

    def result(self) -> tuple:
        self._insert(self.best)
        ends = [c for c in (self.best[START], self.best[ASSISTANT]) if c is not None]
        cost, node, digest, _ = ends[0]
        for c in ends[1:]:
            if c[0] < cost or (c[0] == cost and self.edits.less(c[1], node)):
                cost, node, digest, _ = c
        gaps = self.most - self.least + 1 - self.distinct if self.least is not None else 0
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, self.edits.letters(node), digest.hexdigest()


def _last_filled(text: str) -> str:
    """The last character that isn't white space, or ''."""
    for at in range(len(text) - 1, -1, -1):
        if _FILLED.match(text[at]):
            return text[at]
    return ""


def repair(rows: DataFrame, dropped: Column | None = None) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of each conversation of `rows`
    (conv_id, turn, role, text). Rows where `dropped` holds only name their conversation."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    flat = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), space("role").alias("role"), space("text").alias("text"), (F.lit(False) if dropped is None else dropped).alias("dropped"))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, now, done = None, None, []
        for batch in batches:
            ids, columns = batch.column(0), [batch.column(c).to_pylist() for c in range(5)]
            for c, turn, role, text, gone in zip(*columns, strict=True):
                if now is None or c != key:
                    if now is not None:
                        done.append((key, *now.result()))
                    key, now = c, Repair()
                if not gone:
                    now.row(turn, role, text)
            if len(done) >= 1000:
                yield _table(done, ids.type)
                done = []
        if now is not None:
            done.append((key, *now.result()))
        if done:
            yield _table(done, ids.type)

    return flat.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(run, f"conv_id {kind}, {OUT}")


def _table(done: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    names = ["conv_id", *(x.split()[0] for x in OUT.split(", "))]
    types = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)], names=names)
