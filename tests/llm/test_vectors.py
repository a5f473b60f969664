"""Spherical caps, exact search, components and SimHash against brute force."""

from __future__ import annotations

import dataclasses
import math
import random

import numpy as np
import pytest
import xxhash

from clickloom.llm import caps, simhash, topk
from clickloom.llm.components import components


def union(n, pairs):
    root = {i: i for i in n}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in n}


def test_components(spark):
    r = random.Random(0)
    pairs = [(r.randrange(300), r.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(40)] + [(7, 7)] + [(2000, 2001 + i) for i in range(100)]
    got = {x["id"]: x["component"] for x in components(spark.createDataFrame(pairs, "x long, y long")).collect()}
    linked = {i for a, b in pairs if a != b for i in (a, b)}
    want = union({i for p in pairs for i in p}, pairs)
    assert got == {i: want[i] for i in linked}
    assert components(spark.createDataFrame([], "x long, y long")).collect() == []


def vectors(spark, n=240, d=24, seed=0):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(30, d))
    rows = [(i, (centers[i % 30] + rng.normal(size=d) * rng.choice([0.02, 0.12, 1.0])).astype(np.float32).tolist(), i % 30 % 3) for i in range(n)]
    rows += [(n, None, 1), (n + 1, [0.0] * d, 1), (n + 2, [math.nan] * d, 1), (n + 3, [math.inf] + [0.0] * (d - 1), 1), (n + 4, [None] + [1.0] * (d - 1), 0), (n + 5, rows[0][1], None), (n + 6, rows[0][1], rows[0][2]), (n + 7, [], 1), (n + 8, rows[1][1][:5], 1), (None, rows[0][1], 0)]
    return rows, spark.createDataFrame([(*r, 9, 9) for r in rows], "vec_id long, embedding array<float>, label int, uid long, n_links long")


@pytest.mark.parametrize(("grid", "sigmas"), [(2048, 5.5), (4, math.inf)])
def test_caps(spark, grid, sigmas):
    rows, df = vectors(spark)
    got = {x["vec_id"]: x for x in caps.near_duplicates(df, caps.Caps(grid=grid, sigmas=sigmas)).collect()}
    ok = [r for r in rows if r[0] is not None and r[1] and r[2] is not None and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])]
    cos = lambda a, b: float(np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b)) if len(a) == len(b) else 0
    pairs = [(a[0], b[0]) for i, a in enumerate(ok) for b in ok[:i] if a[2] == b[2] and cos(np.array(a[1], float), np.array(b[1], float)) >= 0.98]
    assert len(pairs) > 30
    want = union([r[0] for r in rows if r[0] is not None], pairs)
    n = {i: sum(i in p for p in pairs) for i in want}
    assert {i: (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) for i in want} == {i: (n[i], want[i], want[i] == i) for i in want}
    assert got[None]["n_links"] == 0 and not got[None]["kept"]


def test_caps_repeated_rows_and_empty(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [1.0, 0.01], 0)], "vec_id long, embedding array<float>, label int")
    assert sorted(map(tuple, caps.near_duplicates(df).collect())) == [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False)]
    assert caps.near_duplicates(df.limit(0)).collect() == []


def test_caps_compares_labels_as_they_are(spark):
    rows = [(1, [1.0, 0.0], "a", 1.2), (2, [1.0, 0.01], "a", 1.2), (3, [1.0, 0.0], "b", 1.5), (4, [1.0, 0.0], None, None), (5, [1.0, 0.0], "1", 1.0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, text string, number double")
    for label in ("text", "number"):
        got = caps.near_duplicates(df.selectExpr("vec_id", "embedding", f"{label} AS label")).collect()
        assert {x["vec_id"]: x["component_id"] for x in got} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5}


def test_caps_blocks_grow_with_the_vectors():
    assert [caps.blocks_for(n) for n in (0, 99_999, 100_000, 500_000, 2_500_000, 10**10)] == [2, 2, 3, 4, 5, 5]


@pytest.mark.parametrize("blocks", [1, 3, 5])
def test_caps_of_any_number_of_blocks_find_the_same(spark, blocks):
    _, df = vectors(spark)
    seen = [sorted(map(str, caps.near_duplicates(df, caps.Caps(blocks=b)).collect())) for b in (2, blocks)]
    assert seen[0] == seen[1]


@pytest.mark.parametrize("how", [topk.Search(), topk.Search(k=5, block=16, queries=3, strands=2, leading=0.1)])
def test_topk(spark, how):
    rows, df = vectors(spark, 200, 12)
    got = {}
    for x in topk.search(df, 20, how).collect():
        got.setdefault(x["query_id"], []).append((x["rank"], x["vec_id"], x["score"]))
    ok = [(r[0], [math.floor(64 * float(x)) for x in r[1]]) for r in rows if r[0] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    for i, q in ok:
        if i % 20 == 0:
            best = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in ok if j != i and len(v) == len(q))[: how.k]
            assert sorted(got.pop(i)) == [(k + 1, j, -s) for k, (s, j) in enumerate(best)]
    assert not got


def test_topk_blocks_of_short_vectors_arent_sent(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=8) * 20 * 0.97**i).tolist()) for i in rng.permutation(300).tolist()]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    sent = []
    dealt = topk._dealt

    def counting(heads, against, axes, how):
        sent.append(against.count())
        return dealt(heads, against, axes, how)

    monkeypatch.setattr(topk, "_dealt", counting)
    got = sorted((x["query_id"], x["rank"], x["vec_id"], x["score"]) for x in topk.search(df, 20, topk.Search(k=3, block=10, queries=5, first=1)).collect())
    whole = {i: [math.floor(64 * x) for x in v] for i, v in rows}
    want = []
    for i in range(0, 300, 20):
        best = sorted((-sum(a * b for a, b in zip(whole[i], v, strict=True)), j) for j, v in whole.items() if j != i)[:3]
        want += [(i, k + 1, j, -x) for k, (x, j) in enumerate(best)]
    assert got == want
    assert sent[0] == 3 and 0 < sent[1] < 3 * (300 // 10 - 1)  # of all pairs of blocks


def test_topk_narrow_forms_keep_the_numbers():
    for most in (0, 127, 128, 32767, 32768, 2**31 - 1, 2**31, 2**50):
        x = np.array([[most, -most]], float)
        form, data = topk._narrow(x)
        assert (np.frombuffer(data, form).astype(float) == x.ravel()).all()


def test_topk_ties_and_empty(spark):
    df = spark.createDataFrame([(i, [1.0, 0.0]) for i in (0, 5, 3, 3, 9)] + [(40, [])], "vec_id long, embedding array<float>")
    got = sorted((x["query_id"], x["rank"], x["vec_id"]) for x in topk.search(df).collect())
    assert got == [(0, 1, 3), (0, 2, 3), (0, 3, 5), (0, 4, 9)]
    assert topk.search(df.limit(0)).collect() == []


# ---------------------------------------------------------------- SimHash


def plain_fingerprint(text, k=3):
    import re

    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + k]).encode(), 42) for i in range(max(1, len(w) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints_and_groups(spark):
    r = random.Random(3)
    words = [f"w{i}" for i in range(60)] + ["É", "x\u00a0y", "İ"]
    base = [[r.choice(words) for _ in range(r.choice([1, 2, 3, 40, 400]))] for _ in range(60)]
    texts = [" ".join(b) for b in base]
    for b in base:
        for _ in range(3):
            c = list(b)
            c[r.randrange(len(c))] = "changed"
            texts.append("\t".join(c).upper() if r.random() < 0.3 else " \n".join(c))
    texts += ["", None, " \t\x0b\x0c\r", texts[0], "a" * 20_000]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(None, "x", 1)], "doc_id long, text string, node long")
    for how in (simhash.SimHash(), simhash.SimHash(grid=2)):
        got = {x["doc_id"]: x for x in simhash.groups(df, how).collect()}
        fps = {i: plain_fingerprint(t) for i, t in enumerate(texts)}
        assert {i: got[i]["fps"][0] & (2**64 - 1) for i in fps} == fps
        pairs = [(i, j) for i in fps for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2]
        want = union(fps, pairs)
        assert {i: got[i]["component_id"] for i in fps} == want and got[None]["component_id"] is None
    assert simhash.groups(df.limit(0)).collect() == []


def test_chains_find_every_pair_of_two_bits():
    """The pigeonring condition loses no pair within the radius."""
    rng = np.random.default_rng(5)
    how = simhash.SimHash()
    masks = how.masks()
    x = rng.integers(0, 2**63, 400, dtype=np.uint64)
    y = x.copy()
    for i in range(400):
        for b in rng.choice(64, rng.integers(0, 3), replace=False):
            y[i] ^= np.uint64(1) << np.uint64(b)
    hit = np.zeros(400, bool)
    for s in range(how.segments):
        chain = [np.bitwise_count((x ^ y) & np.bitwise_or.reduce(masks[[(s + j) % 5 for j in range(n)]])) <= how.budgets[n - 1] for n in range(1, 6)]
        hit |= np.logical_and.reduce(chain)
    assert hit.all() and how.lead == 2


def test_repeated_ids(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    df = spark.createDataFrame([(5, a), (5, b), (7, a), (3, b), (3, b)], "doc_id long, text string")
    assert {x["component_id"] for x in simhash.groups(df).collect()} == {3}
    # an id with two texts is two documents for deduplication: (5, a) stands for (7, a), (3, b) for (5, b)
    assert sorted(map(tuple, simhash.one_of_each(df, simhash.SimHash()).collect())) == [(3, b), (5, a)]


def test_ids_and_columns_stay_as_they_are(spark):
    """Ids above 2^53 beside a null one; columns named like those used inside; repeated rows."""
    big, t = 2**53 + 1, " ".join(f"a{i}" for i in range(30))
    names = "doc_id long, text string, _row int, row string, digest long, component int, node int, fps int, i int"
    rest = (7, "r", 1, 2, 3, 4, 5)
    rows = [(big, t, *rest), (big, t, *rest), (None, t, *rest), (None, t, *rest), (big + 2, t, *rest), (big + 4, "other words", *rest), (big + 6, None, *rest), (big + 8, "", *rest)]
    df = spark.createDataFrame(rows, names)
    got = {x["doc_id"]: x["component_id"] for x in simhash.groups(df).collect()}
    assert got == {big: big, big + 2: big, big + 4: big + 4, big + 6: big + 6, big + 8: big + 6, None: None}
    for how in (None, simhash.SimHash()):
        kept = sorted(map(tuple, simhash.one_of_each(df, how).collect()), key=str)
        assert kept == sorted([rows[0], rows[2], rows[3], rows[5], rows[6]], key=str)
    text_ids = spark.createDataFrame([("b", t), ("a", t), ("c", "x")], "doc_id string, text string")
    assert sorted(x["doc_id"] for x in simhash.one_of_each(text_ids).collect()) == ["a", "c"]
    assert simhash.one_of_each(df.limit(0)).collect() == []


@pytest.mark.parametrize("texts", [0, 10**8, 10**10])
def test_recall_of_the_keys(texts):
    """At a similarity of just 0.8 the stated share of pairs is proposed, whatever the corpus' size asks of the keys."""
    how = simhash.near_copies(texts)
    assert how.bits >= math.log2(max(texts, 2**24) / 256) - 1e-9 and how.segments * how.bits <= 64
    r, m = random.Random(texts), simhash._multipliers(how.signs)
    hit, n = 0, 150
    for _ in range(n):
        a = [f"z{r.randrange(10**6)}" for _ in range(230)]
        b = list(a)
        for p in range(10, 10 + 40 * 5, 40):
            b[p] = "edit"
        assert jaccard(" ".join(a), " ".join(b)) == 201 / 251
        f = [simhash._signs(simhash.shingle_sets(" ".join(x), 5, simhash._Words()), m) for x in (a, b)]
        near = np.bitwise_count(f[0][: how.compared] ^ f[1][: how.compared]).sum() <= how.tau
        key = False
        for s in range(how.signs):
            own = np.array([x[s] for x in f])
            for start in range(how.segments):
                masks = how.masks()
                if not (own[0] ^ own[1]) & masks[start]:
                    key |= bool(simhash.linked(np.zeros(2), np.full(2, start), own, np.stack([x[: how.compared] for x in f]), how)[1] == 0)
        hit += bool(near and key)
    assert hit / n >= 0.9


def test_shingle_sets_are_the_shingles():
    r = random.Random(3)
    for _ in range(60):
        t = " ".join(r.choice("abcdefg") for _ in range(r.randrange(0, 60)))
        assert len(simhash.shingle_sets(t, 5, simhash._Words())) == len(simhash.shingles(t, 5, True))
    a, b = "p q r s t u v w", "x q r s t u v w"
    memo = simhash._Words()
    assert len(np.intersect1d(simhash.shingle_sets(a, 5, memo), simhash.shingle_sets(b, 5, memo))) == 3


def test_near_copies(spark):
    """Five-word shingles: copies at a similarity of 0.85 or more go, unrelated texts stay."""
    r = random.Random(9)
    fresh = lambda n: [f"v{r.randrange(5000)}" for _ in range(n)]
    kept, copies = [fresh(300) for _ in range(40)], []
    for k in kept:
        c = list(k)
        for p in r.sample(range(300), 4):
            c[p] = "edit"
        copies.append(c)
    texts = [" ".join(x) for x in kept + copies]
    got = sorted(x["doc_id"] for x in simhash.one_of_each(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect())
    assert set(range(40)) <= set(got) and len(got) <= 41


def jaccard(a, b):
    x, y = ({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (a.split(), b.split()))
    return len(x & y) / len(x | y)


@pytest.mark.parametrize("grid", [4096, 2])
def test_near_copies_with_repeated_lines(spark, grid):
    """A repeated line neither joins texts that share nothing else nor parts near copies."""
    r = random.Random(11)
    fresh = lambda n: " ".join(f"u{r.randrange(50_000)}" for _ in range(n))
    line = fresh(12)
    texts = [fresh(300) + f" {line}" * 20 for _ in range(12)]
    for _ in range(6):
        t = fresh(400)
        texts += [t, t + f" {fresh(12)}" * 50]
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if jaccard(texts[i], texts[j]) >= 0.8]
    assert len(pairs) == 6
    want = union(range(len(texts)), pairs)
    how = dataclasses.replace(simhash.NEAR_COPIES, grid=grid)
    got = {x["doc_id"]: x["component_id"] for x in simhash.groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), how).collect()}
    assert got == want


def test_alike_decides_every_pair():
    r = random.Random(12)
    for n in (1, 2, 5, 40):
        sets = [set(r.sample(range(60), r.randrange(1, 20))) for _ in range(n)]
        sets += [set(list(s)[1:]) | ({100 + i} if i % 2 else set()) for i, s in enumerate(sets)]
        pairs = [(i, j) for i in range(len(sets)) for j in range(i) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) > 0]
        roots = simhash.alike([np.array(sorted(s), np.int64) for s in sets], 0.8)
        assert dict(enumerate(roots.tolist())) == union(range(len(sets)), pairs)


def test_similarity_decides_around_the_threshold(spark):
    """Pairs just below 0.8 stay, and the radius proposes pairs of 0.8 and more, short texts too."""
    r = random.Random(13)
    fresh = lambda n: [f"z{r.randrange(90_000)}" for _ in range(n)]
    texts = []
    for edits in [5] * 20 + [4] * 20:  # similarity 171 / 221 and 176 / 216
        a = fresh(200)
        b = list(a)
        for p in range(10, 10 + 30 * edits, 30):
            b[p] = "edit"
        texts += [" ".join(a), " ".join(b)]
    assert {round(jaccard(texts[i], texts[i + 1]), 4) for i in range(0, 80, 2)} == {round(171 / 221, 4), round(176 / 216, 4)}
    kept = {x["doc_id"] for x in simhash.one_of_each(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert set(range(40)) <= kept and len(kept & set(range(41, 80, 2))) <= 3
    m, how = simhash._multipliers(simhash.NEAR_COPIES.signs), simhash.NEAR_COPIES
    far = 0
    for _ in range(200):
        a = fresh(8)
        f = [simhash.fingerprint(" ".join(x), 5, m, True) for x in (a, a + fresh(1))]
        far += int(np.bitwise_count(f[0] ^ f[1]).sum()) > how.tau
    assert far == 0


def test_caps_sketches_lose_no_link():
    rng = np.random.default_rng(8)
    base = caps.unit(rng.normal(size=(40, 48)))
    x = caps.unit(np.concatenate([base] + [base + rng.normal(size=base.shape) * w for w in (0.0, 0.01, 0.029, 0.0293, 0.03, 0.05)] + [np.eye(48)]))
    sketch, err = caps.sketched(x)
    raw = np.frombuffer(b"".join(sketch), np.uint8).reshape(len(x), 52)
    y = raw[:, 4:].view(np.int8) * raw[:, :4].copy().view(np.float32)
    assert (np.linalg.norm(x - y, axis=1) <= err + 1e-6).all()
    cell = rng.integers(0, 2, len(x))
    for across in (False, True):
        real = (x @ x.T >= 0.98) & ~np.eye(len(x), dtype=bool) & ((cell[:, None] != cell) | (not across))
        kept = caps.may_link(y, err, cell, across, 0.98)
        assert kept[real.any(1)].all() and not kept[-48:].any()


def test_topk_of_an_id_on_two_vectors(spark):
    """Each of its vectors is a query with a list of its own, and each row a candidate."""
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (0, [0.0, 1.0]), (1, [0.5, 0.25]), (2, [0.25, 0.5]), (2, [0.125, 0.0])]
    got = topk.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    want = [(0, 1, k + 1, j, s) for k, (j, s) in enumerate([(2, 2048), (1, 1024), (2, 0)])] + [(0, 2, k + 1, j, s) for k, (j, s) in enumerate([(1, 2048), (2, 1024), (2, 512)])]
    assert sorted((x["query_id"], x["query_place"], x["rank"], x["vec_id"], x["score"]) for x in got) == sorted(want)
