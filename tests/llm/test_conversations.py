"""Prefix trie and structure repair against plain versions over whole lists."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from clickloom.llm import prefixes, repair

COLUMNS = "conv_id long, turn long, role string, text string, seg string, root int"


def plain_trie(rows, every=100, most=6):
    by = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            by[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in by.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % most
        whole[c] = tuple(own.get(c - c % every, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, t in whole.items():
        for d in range(len(t) + 1):
            members[t[:d]].append(c)
    children = defaultdict(set)
    for p in members:
        if p:
            children[p[:-1]].add(p)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p in members:
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(members[p]) - 1) * len(p[-1][1]) if p else 0
    return list(
        (
            min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p],
            hashlib.sha256(",".join(str(c) for c in sorted(m) if len(whole[c]) == len(p)).encode()).hexdigest(),
        )
        for p, m in members.items()
    )


def random_rows(r, n):
    """Few words, so that beginnings are shared; some turns without number, some repeated, some ids shared by lenders."""
    ids = [0, 100, 200, 300, *r.sample(range(1, 400), n)]
    rows = []
    for c in ids:
        for t in range(r.choice([1, 1, 2, 3, 6, 9])):
            rows.append((c, None if r.random() < 0.02 else t, r.choice(["user", "assistant", None]), r.choice(["a", "b", "", None, "ä😀"])))
    return rows


@pytest.mark.parametrize("shape", [prefixes.Shape(), prefixes.Shape(layer=4, shard=6), prefixes.Shape(layer=8, shard=5)])
def test_trie(spark, shape):
    rows = random_rows(random.Random(11), 80)
    if shape.layer < 512:
        rows += [(c, 20 + t, "user", "x") for c in (100, 101, 102, 103) for t in range(9 + c % 3)] + [(c, 0, "user", "same") for c in range(500, 560)]
    rows.append((None, 0, "user", "same"))
    # equal numbers go by role and then by digest: only turns that need no such choice are left to the plain version
    times = Counter(x[:2] for x in rows)
    rows = [x for x in rows if times[x[:2]] == 1]
    df = spark.createDataFrame([(*x, "clash", 1) for x in rows], COLUMNS).repartition(3)
    known = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted(map(tuple, prefixes.trie(df, shape).collect()), key=known) == sorted(plain_trie(rows), key=known)


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    assert prefixes.trie(spark.createDataFrame([], COLUMNS)).collect() == []
    # one lends nothing, as its lender isn't there, and has no turn beyond those it would take over
    c = next(c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6 > 1)
    got = prefixes.trie(spark.createDataFrame([(c, 0, "user", "a", "", 0)], COLUMNS)).collect()
    assert [tuple(x) for x in got] == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_trie_takes_equal_numbers_by_role_and_repeated_rows(spark):
    c = next(c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6 == 0)
    rows = [(c, 1, "user", "b"), (c, 1, "assistant", "b"), (c, None, "user", "z"), (c, None, "user", "z")]
    got = prefixes.trie(spark.createDataFrame([(*x, "", 0) for x in rows], COLUMNS)).collect()
    assert sorted(map(tuple, got), key=lambda x: x[1]) == sorted(plain_trie(rows), key=lambda x: x[1]) and len(got) == 5


def test_double_array_holds_each_sequence():
    r = random.Random(3)
    for _ in range(40):
        codes = r.randrange(1, 30)
        seqs = sorted({tuple(r.randrange(1, codes + 1) for _ in range(r.randrange(1, 6))) for _ in range(r.randrange(1, 60))})
        t = prefixes.DoubleArray([np.array(s) for s in seqs], codes)
        slots = {}
        for s in seqs:
            at = np.zeros(1, np.int64)
            for d, x in enumerate(s):
                at = t.step(at, np.array([x]))
                assert slots.setdefault(int(at[0]), s[: d + 1]) == s[: d + 1]
        assert len(set(slots.values())) == len(slots)


# ---------------------------------------------------------------- repair


def plain_damage(rows):
    out = []
    for c, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        how = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        if how == 0:
            continue
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        role = "user" if how == 4 else role
        out += [(c, turn, role, text)] * (2 if how == 3 else 1)
    return out


def plain_repair(rows):
    """All edits, by cost and then by letters, from a table of the best for each row and state."""
    rows = sorted(rows, key=lambda x: (x[1] is not None, x[1] or 0, x[2], x[3]))
    seen, faults = set(), []
    for _, _, role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]", "", text)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None)
        seen.add((role, text))
    start, system, user, assistant = range(4)
    follows = {start: {"s": system, "u": user}, system: {"u": user}, user: {"a": assistant}, assistant: {"u": user}}
    forced = {start: ("user", user), system: ("user", user), user: ("assistant", assistant), assistant: ("user", user)}
    best = {start: (0, "", ())}

    def inserted(best):
        for _ in range(3):
            for q in list(best):
                cost, letters, out = best[q]
                role, to = forced[q]
                new = (cost + 2, letters + "I", (*out, f"{role}:"))
                if to not in best or new[:2] < best[to][:2]:
                    best[to] = new
        return best

    for (_, _, role, text), fault in zip(rows, faults):
        now = {}
        for q, (cost, letters, out) in inserted(best).items():
            new = [(q, (cost + 3, letters + "D", out))]
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                if role[:1] in follows[q]:
                    new.append((follows[q][role[:1]], (cost + extra, letters + "K", (*out, f"{role}:{text}"))))
                new.append((forced[q][1], (cost + 2 + extra, letters + "R", (*out, f"{forced[q][0]}:{text}"))))
            for to, x in new:
                if to not in now or x[:2] < now[to][:2]:
                    now[to] = x
        best = now
    best = inserted(best)
    cost, letters, out = min((best[q] for q in (start, assistant) if q in best), key=lambda x: x[:2])
    turns = [x[1] for x in rows if x[1] is not None]
    pairs = [a[2][:1] + b[2][:1] for a, b in itertools.pairwise(rows)]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
        sum(p not in ("su", "ua", "au") for p in pairs), cost, letters, hashlib.sha256("\n".join(out).encode()).hexdigest(),
    )


def repair_rows(r, n):
    rows = []
    for c in [*range(n), None, -3]:
        for t in range(r.choice([1, 2, 4, 7, 12])):
            turn = None if r.random() < 0.05 else t * r.choice([1, 1, 2])
            rows.append((c, turn, r.choice(["user", "assistant", "system", "tool", "", None]) if r.random() < 0.4 else ["user", "assistant"][t % 2], r.choice(["Hi.", "So?", "cut", "", None, " \t", "Ünd!", "a. \n"])))
    return rows


def test_repair(spark):
    rows = repair_rows(random.Random(13), 150)
    df = spark.createDataFrame([(*x, "clash", 1) for x in rows], COLUMNS).repartition(3)
    got = {x["conv_id"]: tuple(x)[1:] for x in repair.repair(repair.damaged(df), repair.F.col("dropped")).collect()}
    by = defaultdict(list)
    for x in plain_damage(rows):
        by[x[0]].append(x)
    assert set(got) == {x[0] for x in rows}
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    for c in got:
        assert got[c] == (plain_repair(by[c]) if by[c] else empty), c
    assert any(not by[c] for c in got) and any(g[6].count("I") for g in got.values())
    assert repair.repair(df.limit(0)).collect() == []


def test_repair_of_one_long_conversation(spark):
    r = random.Random(5)
    rows = [(1, t, r.choice(["user", "assistant", "system"]), r.choice(["Hi.", "cut", f"{t}."])) for t in range(3000)] + [(2, 0, "user", "x" * 2_000_000 + ".")]
    got = {x["conv_id"]: tuple(x)[1:] for x in repair.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert got[1] == plain_repair(rows[:-1]) and got[2] == plain_repair(rows[-1:])


@pytest.mark.parametrize("room", [1, 8, 100])
def test_repair_forgets_what_all_candidates_share(room):
    r = random.Random(room)
    for n in (0, 1, 2, 5, 40, 400):
        for roles in (["user", "assistant"], ["user"], ["system"], ["assistant", "system", "user", "tool"]):
            rows = [(1, t, r.choice(roles), r.choice(["Hi.", "cut", "", f"{t}.", f"{t}"])) for t in range(n)]
            one = repair.Repair(room)
            for x in sorted(rows, key=lambda x: x[1]):
                one.row(*x[1:])
            assert one.result() == plain_repair(rows)


def test_repair_holds_few_nodes_of_a_long_conversation():
    r = random.Random(8)
    one, most = repair.Repair(), 0
    for t in range(60_000):
        one.row(t, r.choice(["user", "assistant", "system"]) if r.random() < 0.4 else ["user", "assistant"][t % 2], f"{t}" if r.random() < 0.1 else f"{t}.")
        most = max(most, len(one.edits))
    assert most < 5000 and len(one.result()[6]) >= 60_000


def test_settled_edits_keep_their_letters():
    r = random.Random(4)
    for _ in range(60):
        e, nodes = repair.Edits(), {0: ""}
        for _ in range(4):
            for _ in range(r.randrange(40)):
                at = r.choice(list(nodes)[-6:])
                letter = r.choice("DIKR")
                nodes[e.add(at, letter)] = nodes[at] + letter
            live = r.sample(sorted(nodes), min(len(nodes), r.randrange(1, 5)))
            texts = [nodes[x] for x in live]
            nodes = dict(zip(e.settle(live), texts))
            assert [e.letters(x) for x in nodes] == list(nodes.values())
            for a, b in itertools.product(nodes, nodes):
                assert e.less(a, b) == (nodes[a] < nodes[b])


def test_edits_compare_like_their_letters():
    r = random.Random(2)
    e = repair.Edits()
    nodes = {0: ""}
    for _ in range(600):
        at = r.choice(list(nodes)[-30:] + [0])
        letter = r.choice("DIK")
        nodes[e.add(at, letter)] = nodes[at] + letter
    for _ in range(4000):
        a, b = r.choice(list(nodes)), r.choice(list(nodes))
        assert e.less(a, b) == (nodes[a] < nodes[b]) and e.letters(a) == nodes[a]
    e.hash = [0] * len(e.hash)  # every hash collides: the letters decide
    for _ in range(2000):
        a, b = r.choice(list(nodes)), r.choice(list(nodes))
        assert e.less(a, b) == (nodes[a] < nodes[b])
