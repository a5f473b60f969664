"""SentencePiece against the library and enumeration; mixing against plain water filling."""

from __future__ import annotations

import itertools
import os
import random

import pytest

from clickloom.llm import mixing, pieces

HAVE = os.path.exists(pieces.MODEL)


@pytest.mark.skipif(not HAVE, reason="no public tokenizer here")
def test_bpe_equals_the_library(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    r = random.Random(6)
    words = ["thing", "ing", " ", "  ", "\n", "\t", "é", "e\u0301", "😀", "㍍", "123", "...", "();", "\r", "ﬁ", "ab" * 30, "Wörter", "C++", "a.b@c.de", "' s", "\x00"]
    texts = ["".join(r.choice(words) for _ in range(r.randrange(1, 30))) for _ in range(250)] + [None, "", " ", "x" * 3000, "ab " * 4000, "thing thing thing"] * 2
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, ids int")
    enc = pieces.encode(df)
    got = {x["doc_id"]: x for x in enc.collect()}
    for i, t in enumerate(texts):
        assert list(got[i]["ids"]) == (sp.encode(t) if t else []), t
        assert got[i]["round_trip"] and got[i]["n_tokens"] == len(got[i]["ids"])
    back = {x["doc_id"]: x["text"] for x in pieces.decode(enc).collect()}
    assert back == {i: t or "" for i, t in enumerate(texts)}
    odd = spark.createDataFrame([(0, "a ▁b"), (1, "a b")], "doc_id long, text string")
    assert {x["doc_id"]: x["round_trip"] for x in pieces.encode(odd).collect()} == {0: False, 1: True}
    assert pieces.encode(df.limit(0)).collect() == []


def units_of(spark, texts, model):
    """The ids of all units of the texts, by the relation."""
    rows = pieces.sharded(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    return {x["unit"]: list(x["ids"]) for x in pieces.encoded_units(pieces.shard_units(rows, model), model).collect()}


@pytest.mark.skipif(not HAVE, reason="no public tokenizer here")
def test_relational_fold_equals_the_local_one(spark):
    m = pieces.Model.load()
    local = pieces.Local(m)
    r = random.Random(4)
    rare = ["".join(r.choice("abcdefghijklmnopqrstuvwxyzéß") for _ in range(r.randrange(1, 40))) for _ in range(150)]
    text = "the thing that is there, aaaaaaa baaab (a)+(b) Überraschung naïve 😀😀 zzzz " + " ".join(rare) + " " + "ab" * 100
    known = units_of(spark, [text, None, ""], m)
    assert len(known) > 150 and known == {u: local.fold(u) for u in known}
    assert set(known) == set(m.units().findall(m.spaced(text)))  # every unit, however rare


@pytest.mark.skipif(not HAVE, reason="no public tokenizer here")
def test_encoding_of_files_in_many_splits(spark, tmp_path):
    """Each split finds its own dictionary, whatever units the others have; a column named like the files' one is left alone."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    texts = [f"word{i} some {'x' * (i % 90)} of split {i * i}" for i in range(300)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7).write.parquet(str(tmp_path / "t"))
    files = spark.read.parquet(str(tmp_path / "t"))
    for df in (files, files.withColumn("_metadata", pieces.F.lit("mine")), files.join(files.select("doc_id"), "doc_id")):
        assert {x["doc_id"]: list(x["ids"]) for x in pieces.encode(df).collect()} == {i: sp.encode(t) for i, t in enumerate(texts)}


def random_model(seed, chars, n):
    """Pieces of random parts with random scores, repeated ones among them: parts may have worse scores than the whole, or not exist."""
    r = random.Random(seed)
    made = list(chars)
    for _ in range(n):
        made.append("".join(r.choice(made) for _ in range(r.choice((2, 2, 2, 3))))[:12])
    multi = [p for p in dict.fromkeys(made) if len(p) > 1]
    return pieces.Model((None, *((c, -900.0) for c in chars[1:]), *((p, -float(r.randrange(n // 2 + 1))) for p in multi)), None, 0, "bpe", prefix=False)


def test_merges_in_one_pass():
    """The order of `Local.rules`, walked through once, gives what the heap gives, also where a piece has a better score than its parts."""
    r, late = random.Random(8), 0
    for seed in range(60):
        m = random_model(seed, "abc"[: 2 + seed % 2], 3 + seed)
        local = pieces.Local(m)
        rules = {x[0]: x[1:] for x in local.rules()}
        late += sum(x[4] > 0 for x in rules.values())
        for _ in range(60):
            unit = "".join(r.choice("abc"[: 2 + seed % 2]) for _ in range(r.randrange(1, 40)))
            edges = [(rank, a + offset, path, a, a + mid, a + n) for a in range(len(unit)) for n in range(2, 13) if unit[a : a + n] in rules and a + n <= len(unit) for _, mid, rank, offset, path in [rules[unit[a : a + n]]]]
            cuts = set(range(len(unit) + 1))
            for *_, a, mid, b in sorted(edges):
                if {x for x in cuts if a <= x <= b} == {a, mid, b}:
                    cuts.remove(mid)
            assert [unit[a:b] for a, b in itertools.pairwise(sorted(cuts))] == local._merged(unit)
    assert late > 300


def test_relational_merges_of_a_random_model(spark):
    """Late pieces, ties, characters without a piece and units of up to 64 characters, against the heap."""
    m = random_model(59, "abc", 120)
    local, r = pieces.Local(m), random.Random(2)
    assert any(x[5] > 0 for x in local.rules())
    units = ["".join(r.choice("abbccé😀" if k % 3 == 0 else "abc") for _ in range(r.choice((1, 2, 3, 9, 30, 62, 63, 64, 65)))) for k in range(300)]
    got = {x["unit"]: list(x["ids"]) for x in pieces.encoded_units(spark.createDataFrame([(u,) for u in set(units)], "unit string"), m).collect()}
    assert got == {u: local.fold(u) for u in set(units)}


def test_words_are_cut_like_texts():
    """Cut at spaces first, then into units: the same units as of the whole text."""
    r = random.Random(5)
    known = tuple((p, -float(k)) for k, p in enumerate(["▁a", "ab", "▁▁", "(a", "))", "▁ab", "b"]))
    for prefix, more in itertools.product((True, False), ((), (("a▁b", -9.0),))):
        m = pieces.Model((None, *known, *more), None, 0, "bpe", prefix=prefix)
        find, cut = m.units().findall, m.cut()
        for _ in range(500):
            text = "".join(r.choice("aab () \n▁x" if k else "ab(x ") for k in range(r.randrange(12)))
            assert [u for w in cut(text) for u in find(w)] == find(m.spaced(text)), text


def test_viterbi(spark):
    """A unigram model: the best sum over all segmentations, relational and local."""
    scores = {"a": -2.0, "b": -2.5, "ab": -3.0, "aba": -5.1, "ba": -4.0, "bab": -4.2, "c": -1.0}
    m = pieces.Model((None, *scores.items()), None, 0, "unigram", prefix=False)
    local = pieces.Local(m)
    texts = ["".join(t) for n in range(1, 6) for t in itertools.product("abx", repeat=n)][:150]
    known = units_of(spark, texts, m)
    low = min(scores.values()) - 10

    def best(t):
        cuts = [[0, *c, len(t)] for k in range(len(t)) for c in itertools.combinations(range(1, len(t)), k)]
        sums = [sum(scores.get(t[a:b], low if b - a == 1 else -1e9) for a, b in itertools.pairwise(c)) for c in cuts]
        return max(sums)

    names = [None, *scores]
    for u in known:
        assert sum(scores[names[i]] if i else low for i in known[u]) == pytest.approx(best(u))
        assert sum(scores[names[i]] if i else low for i in local.fold(u)) == pytest.approx(best(u))


# ---------------------------------------------------------------- mixing


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: k % 3 + 1 for k, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in capped]
        level = (total - sum(capped.values())) / sum(w[s] for s in free) if free else 0
        over = [s for s in free if level * w[s] > 3 * sizes[s]]
        if not over:
            return {s: capped.get(s, level * w[s]) for s in order}
        capped |= {s: 3.0 * sizes[s] for s in over}


def corpus(n, seed=0, hot=0.4):
    r = random.Random(seed)
    src = lambda: "hot" if r.random() < hot else r.choice(["a", "b", "Z", "é", None, "tiny"] if r.random() < 0.9 else ["rare"])
    return [(i, " ".join("w" for _ in range(r.choice([1, 5, 80, 300, 900]))), src()) for i in range(n)] + [(n, None, "a"), (n + 1, "", "none"), (n + 2, " \t\x0b", "a"), (n + 3, " x\ny ", "one"), (None, "q r", "a"), (5, "again and again", "b"), (5, "again and again", "b")]


@pytest.mark.parametrize("n", [30, 900])
def test_mix(spark, n):
    rows = corpus(n)
    df = spark.createDataFrame([(*r, 1, 2.0) for r in rows], "doc_id long, text string, source string, size long, target double")
    got = mixing.mix(df).collect()
    size = lambda t: len((t or "").encode().split())
    assert sorted((r["doc_id"] or -1, r["size"]) for r in got) == sorted((r[0] or -1, size(r[1])) for r in rows)
    by = {}
    for r in rows:
        by[r[2]] = by.get(r[2], 0) + size(r[1])
    want = plain_targets(by)
    taken, target = {}, {}
    for r in got:
        assert r["taken"] <= 3 * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        target[r["source"]] = (r["source_size"], r["target"])
    assert {s: v[0] for s, v in target.items()} == by
    assert {s: v[1] for s, v in target.items()} == pytest.approx(want)
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(4, 0.02 * t), (s, taken[s], t)
    again = mixing.mix(df.repartition(3)).collect()
    key = lambda rows: sorted((r["doc_id"] or -1, r["taken"]) for r in rows)
    assert key(got) == key(again)


def test_mix_of_one_very_long_text(spark):
    """A text of 300,000 words spans many blocks; its source's words come near the target, and no text exceeds three times its size."""
    rows = [(0, "w " * 300_000, "a"), (1, "w", "a"), *((i, "some words here " * 40, "b") for i in range(2, 60))]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    for s, t in plain_targets({"a": 300_001, "b": 58 * 120}).items():
        taken = sum(r["taken"] for r in got if r["source"] == s)
        assert abs(taken - t) <= 0.02 * t and all(r["target"] == pytest.approx(t) for r in got if r["source"] == s)
    assert all(r["taken"] <= 3 * r["size"] for r in got) and {r["size"] for r in got if r["doc_id"] == 0} == {300_000}


def test_repeated(spark):
    rows = corpus(200)
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    times = {}
    for r in mixing.mix(df).collect():
        if r["size"]:
            times[r["doc_id"]] = times.get(r["doc_id"], 0) + int(r["taken"] / r["size"] + 0.5)
    got = {}
    for r in mixing.repeated(df).collect():
        assert (r["doc_id"], r["text"], r["source"]) in rows
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
    assert got == {k: v for k, v in times.items() if v}
    assert mixing.mix(df.limit(0)).collect() == [] and mixing.repeated(df.limit(0)).collect() == []
    assert mixing.mix(spark.createDataFrame([(1, "", "a"), (2, None, None)], df.schema)).select("taken").distinct().collect()[0][0] == 0


def test_repeated_rows_and_names(spark):
    """Columns named like those used inside; rows that repeat an id and a text share its copies, different ones too."""
    names = "doc_id long, text string, source string, _copy string, _h int, _i int, h string, copies int, row int"
    rest = ("c", 1, 2, "h", 3, 4)
    rows = [(i, f"some words of text {i}", "a", *rest) for i in range(60)] + [(7, "twin words here", "b", *rest)] * 50 + [(7, "twin words here", "b", *rest[:-1], 9)] * 30
    df = spark.createDataFrame(rows, names)
    taken = sum(int(r["taken"] / r["size"] + 0.5) for r in mixing.mix(df).collect() if r["source"] == "b")
    got = [tuple(r) for r in mixing.repeated(df).collect()]
    assert set(got) <= set(rows) and mixing.repeated(df).columns == df.columns
    twins = [got.count(rows[60]), got.count(rows[-1])]
    assert sum(twins) == taken > 80 and abs(twins[0] / sum(twins) - 5 / 8) < 0.05


def test_stages_pass_columns_that_cannot_be_compared(spark):
    """MAP and VARIANT columns go through mixing and near-dedup as they are."""
    from clickloom.llm import simhash

    rows = [(i % 7, f"some words of text {i % 7} and a few more {'x ' * 20}", "a", i) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, i int")
    df = df.selectExpr("*", "map('k', i % 3, 'l', null) as m", "parse_json(concat('{\"v\":', i % 2, '}')) as v", "named_struct('m', map(i % 2, 1)) as s")
    taken = sum(int(x["taken"] / x["size"] + 0.5) for x in mixing.mix(df).collect())
    got = mixing.repeated(df)
    assert got.dtypes == df.dtypes and abs(got.selectExpr("doc_id", "m", "cast(v as string) as v", "s").count() - taken) <= 7
    assert {(x["m"]["k"], x["v"]) for x in got.selectExpr("m", "cast(v as string) as v").collect()} == {(k, f'{{"v":{v}}}') for k in range(3) for v in range(2)}
    assert simhash.one_of_each(df).selectExpr("doc_id", "m", "cast(v as string) as v").count() == 7
