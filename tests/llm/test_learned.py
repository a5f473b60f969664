"""Toxicity and quality: parts against plain code, and held-out accuracy."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from clickloom.llm import quality, toxicity
from clickloom.llm.common import in_fold, labelled_sample

BAD = ["grumbolt", "snarkel", "vexipod"]


def corpus(n=700, seed=4):
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdeghilmnoprstuw") for _ in range(r.randrange(3, 8))) for _ in range(400)]
    rows = []
    for i in range(n):
        w = [r.choice(vocab) for _ in range(r.randrange(20, 200))]
        toxic, low = i % 9 == 0, i % 7 == 0
        if toxic:
            for _ in range(4):
                x = r.choice(BAD) + r.choice(["", "s", "ed"])
                w.insert(r.randrange(len(w)), r.choice([x, x.upper(), x.replace("o", "0"), x.replace("e", "е")]))
        if low:
            w = [x + r.choice(["###", "$$$", "|"]) for x in w]
        rows.append((i, " ".join(w), int(toxic), int(not low)))
    return rows


def tables(spark, rows):
    docs = spark.createDataFrame([(i, t, "hits", 0.5) for i, t, _, _ in rows] + [(10_001, None, "", 0.0), (10_002, "", "", 0.0), (None, "x", "", 0.0)], "doc_id long, text string, hits string, score double")
    labels = spark.createDataFrame([(i, q, t) for i, _, t, q in rows] + [(None, 1, 1), (3, None, None), (99_999, 0, 1)], "doc_id long, quality int, toxic int")
    return docs, labels


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_folds(spark):
    df = spark.createDataFrame([(i,) for i in range(50)] + [(None,)], "doc_id long")
    assert [r[0] for r in df.select(in_fold("doc_id")).collect()] == [held(i) for i in range(50)] + [True]
    lab = spark.createDataFrame([(i, i % 2) for i in range(50)] * 2, "doc_id long, y int")
    rows = labelled_sample(lab, "y", 10).collect()
    assert len(rows) == 10 and not any(held(r["doc_id"]) for r in rows)


def test_folding():
    assert toxicity.folded("ІDІ0T ѕtupid 1d10t!") == "idiot stupid idiot!"
    assert toxicity.folded("call 1045 now, M0R0N") == "call 1045 now, moron"


def test_lexicon_boundaries_and_exceptions():
    x = toxicity.Lexicon({"trash": 2.0, "trashy": 3.0, "clown": 1.0}, power=0.0)
    a = x.automaton()
    assert x.total(a, "trash trashy") == (5.0, 2)
    assert x.total(a, "the trash can and a circus clown") == (0.0, 0)
    assert x.total(a, "untrash") == (0.0, 0) and x.total(a, "") == (0.0, 0)


def test_toxicity_on_held_out_rows(spark):
    rows = corpus()
    docs, labels = tables(spark, rows)
    lex = toxicity.learn(docs, labels)
    assert any(k.startswith("grumb") for k in lex.weights)
    got = {r["doc_id"]: r for r in toxicity.score(docs, lex).collect()}
    out = [(got[i]["predicted"], t) for i, _, t, _ in rows if held(i)]
    assert np.mean([a == b for a, b in out]) >= 0.98
    assert all(got[i]["held_out"] == held(i) and 0 <= got[i]["score"] <= 1 for i, *_ in rows)
    assert got[10_001]["score"] == got[10_002]["score"] < 0.5 and len(got) == len(rows) + 3
    kept = {r["doc_id"] for r in toxicity.clean_only(docs, lex).collect()}
    assert kept == {i for i, r in got.items() if r["score"] < 0.5}


def test_toxicity_without_labels(spark):
    docs, labels = tables(spark, corpus(20))
    lex = toxicity.learn(docs, labels.limit(0))
    assert lex.weights == toxicity.SEED
    assert toxicity.score(docs.limit(0), lex).collect() == []


def test_quality_on_held_out_rows(spark):
    rows = corpus()
    docs, labels = tables(spark, rows)
    model = quality.learn(docs, labels)
    got = {r["doc_id"]: r for r in quality.score(docs, model).collect()}
    out = [(got[i]["predicted"], q) for i, _, _, q in rows if held(i)]
    assert np.mean([a == b for a, b in out]) >= 0.98 and len(got) == len(rows) + 3
    assert 0 <= got[10_001]["score"] == got[10_002]["score"] <= 1


def test_rules_as_columns(spark):
    rng = np.random.default_rng(0)
    texts = [t for _, t, _, _ in corpus(120)]
    X = np.array([quality.statistics(t) for t in texts])
    y = (X[:, quality.STATISTICS.index("n_words")] > 80).astype(float) * (rng.random(120) > 0.05)
    m = quality.ensemble(X, y)
    assert 0 < len(m.rules) < 200
    total = m.bias + sum(w * quality._holds(X, r) for r, w in m.rules)
    df = quality.with_statistics(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    got = [r["p"] for r in df.select("doc_id", m.column().alias("p")).orderBy("doc_id").collect()]
    assert got == pytest.approx((1 / (1 + np.exp(-total))).tolist())


def test_first_split_by_brute_force():
    """The root of a tree takes the cut of the largest gain among all cuts of all statistics."""
    r = np.random.default_rng(3)
    for least in (1, 8, 25):
        X, g, h = r.integers(0, 6, (60, len(quality.STATISTICS))).astype(float), r.normal(size=60), r.random(60) + 0.1
        cuts = [np.unique(X[:, k])[:-1] for k in range(X.shape[1])]
        gains = {}
        for k, at in enumerate(cuts):
            for c in at.tolist():
                left = [i for i in range(60) if X[i, k] <= c]
                right = [i for i in range(60) if X[i, k] > c]
                if min(len(left), len(right)) >= least:
                    worth = lambda rows: sum(g[i] for i in rows) ** 2 / (sum(h[i] for i in rows) + 1)
                    gains[k, c] = worth(left) + worth(right) - worth(left + right)
        (k, c), _ = max(gains.items(), key=lambda x: x[1])
        paths, step = quality._tree(X, g, h, cuts, quality.Fit(depth=1, least=least))
        assert paths == [((quality.STATISTICS[k], True, c),), ((quality.STATISTICS[k], False, c),)]
        for side in (X[:, k] <= c, X[:, k] > c):
            assert step[side] == pytest.approx(-g[side].sum() / (h[side].sum() + 1))


def test_lasso_weights_are_optimal():
    """At the fitted weights the loss falls by exactly the penalty along each rule that is kept, and not at all along the bias."""
    rng = np.random.default_rng(0)
    X = np.array([quality.statistics(t) for _, t, _, _ in corpus(160)])
    y = (X[:, quality.STATISTICS.index("n_words")] > 80).astype(float)
    y = np.where(rng.random(160) < 0.1, 1 - y, y)
    fit = quality.Fit(trees=4, penalty=5e-3, rounds=20_000)
    m = quality.ensemble(X, y, fit)
    total = m.bias + sum(w * quality._holds(X, r) for r, w in m.rules)
    off = 1 / (1 + np.exp(-total)) - y
    assert 0 < len(m.rules) < 40 and abs(off.mean()) < 1e-4
    for rule, w in m.rules:
        assert (off * quality._holds(X, rule)).mean() == pytest.approx(-fit.penalty * np.sign(w), abs=1e-4)


def test_very_long_texts_of_the_classifiers(spark):
    """A text of two megabytes has the statistics of its words, and is scored beside a short one."""
    long = "Word, and more. " * 130_000
    got, one = (dict(zip(quality.STATISTICS, quality.statistics(t), strict=True)) for t in (long, "Word, and more. "))
    assert got["n_words"] == 390_000 and all(got[c] == pytest.approx(one[c]) for c in ("mean_word", "upper", "digits", "stops", "commas", "short_words"))
    docs = spark.createDataFrame([(1, long), (2, "short"), (3, long + "snarkel")], "doc_id long, text string")
    model = quality.Ensemble((((("n_words", False, 10.0),), 2.0),), -1.0)
    assert {r["doc_id"]: round(r["score"], 6) for r in quality.score(docs, model).collect()} == {1: 0.731059, 2: 0.268941, 3: 0.731059}
    lex = toxicity.Lexicon({"snarkel": 5.0}, power=0.0)
    assert lex.total(lex.automaton(), long + "snarkel") == (5.0, 1) and lex.total(lex.automaton(), long)[1] == 0


def test_quality_degenerate(spark):
    docs, labels = tables(spark, corpus(20))
    m = quality.learn(docs, labels.limit(0))
    assert {round(r["score"], 6) for r in quality.score(docs, m).collect()} == {0.5}
    assert quality.statistics("") == (0.0,) * len(quality.STATISTICS)


def test_toxicity_with_empty_partitions(spark):
    docs, labels = tables(spark, corpus(60))
    few = docs.where("doc_id < 60").repartition(16, "doc_id")
    assert toxicity.learn(few, labels, toxicity.Fit(support=1, evidence=0.0, odds=0.5)).weights


def plain_total(weights, exceptions, text, power):
    """The lexicon without an automaton: every place of every term, one after another."""
    low = toxicity.folded(text)
    starts = lambda term: {i for i in range(len(low)) if low.startswith(term, i) and (i == 0 or not low[i - 1].isalnum())}
    spared = {x for e in exceptions for i in starts(e) for x in range(i, i + len(e))}
    best = {}
    for term, w in weights.items():
        for i in starts(term) - spared:
            best[i] = max(best.get(i, 0.0), w)
    return sum(best.values()) / (low.count(" ") + low.count("\n") + 1) ** power, len(best)


def test_lexicon_by_brute_force():
    r = random.Random(21)
    words = ["trash", "trashy", "trash can", "can", "clown", "clownfish", "untrash", "TR4SH", "сlоwn", "fish", "not", "fine", "1045", "a.trash", "trash-can", "stupid", "not stupid", "stupid me"]
    weights = {"trash": 2.0, "trashy": 3.0, "clown": 1.0, "stupid": 2.5, "stu": 0.5}
    for _ in range(400):
        text = "".join(r.choice(words) + r.choice([" ", " ", "\n", ", ", ""]) for _ in range(r.randrange(0, 25)))
        x = toxicity.Lexicon(weights, power=0.1)
        assert x.total(x.automaton(), text) == pytest.approx(plain_total(weights, x.exceptions, text, 0.1))
    long = "trash can " * 30_000 + "trash"  # hits and exceptions in one long text
    x = toxicity.Lexicon(weights, power=0.0)
    assert x.total(x.automaton(), long) == (2.0, 1)


def test_stem_counts_by_brute_force(spark):
    """The learned weights are the smoothed log odds of plain counts over the training rows."""
    import math

    rows = corpus(300, seed=6)
    docs, labels = tables(spark, rows)
    fit = toxicity.Fit(support=2, odds=1.0, evidence=3.0)
    train = [(toxicity.folded(t), y) for i, t, y, _ in rows if not held(i)]
    n = [sum(y == k for _, y in train) for k in (0, 1)]
    weights = toxicity.learn(docs, labels, fit).weights
    learned = {k: w for k, w in weights.items() if k not in toxicity.SEED}
    assert len(learned) >= 3
    for stem, w in learned.items():
        same = (lambda x: x == stem[:-1]) if stem.endswith(toxicity.WHOLE) else (lambda x: x.startswith(stem))
        good, bad = (sum(any(map(same, toxicity._WORD.findall(t))) for t, y in train if y == k) for k in (0, 1))
        assert w == pytest.approx(math.log((bad + 0.5) / (n[1] + 1)) - math.log((good + 0.5) / (n[0] + 1)))


def test_short_and_very_long_words_are_learned(spark):
    """A word of two letters counts whole only, one of 300 letters by a stem that begins it; neither number nor length of stems is bounded."""
    r = random.Random(9)
    long = "q" + "xyz" * 100
    rows = [(i, " ".join(r.choice(["fine", "words", "zombie", "here"]) for _ in range(9)) + (f" zo {long}{i}" if i % 3 == 0 else ""), i % 3 == 0) for i in range(240)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(y)) for i, _, y in rows], "doc_id long, toxic int")
    lex = toxicity.learn(docs, labels)
    assert "zo." in lex.weights and any(long.startswith(w) and len(w) > 64 for w in lex.weights)
    a = lex.automaton()
    assert lex.total(a, "a zo b")[1] == lex.total(a, "zo")[1] == 1 and lex.total(a, "zombie zoo gonzo")[1] == 0
    with pytest.raises(ValueError):
        toxicity.learn(docs, labels, toxicity.Fit(most=1))


def test_ids_and_repeats_of_the_classifiers(spark):
    """Ids above 2^53 beside a null one stay; documents that repeat an id change no model; repeated rows score alike."""
    rows = corpus(300)
    docs, labels = tables(spark, rows)
    big = 2**53 + 1
    odd = spark.createDataFrame([(big, "snarkel snarkel"), (None, "fine words"), (big, "snarkel snarkel")], "doc_id long, text string").coalesce(1)
    twice = docs.unionByName(docs)
    lex, lex2 = toxicity.learn(docs, labels), toxicity.learn(twice, labels)
    got = toxicity.score(odd, lex).collect()
    assert sorted((r["doc_id"] or 0) for r in got) == [0, big, big] and len({r["score"] for r in got if r["doc_id"]}) == 1
    assert lex == lex2
    q, q2 = quality.learn(docs, labels), quality.learn(twice, labels)
    assert q == q2
    got = quality.score(odd, q).collect()
    assert sorted((r["doc_id"] or 0) for r in got) == [0, big, big] and len({r["score"] for r in got if r["doc_id"]}) == 1


def test_statistics_by_brute_force():
    """Every statistic against a plain count over bytes, words and lines."""
    import math
    from collections import Counter

    r = random.Random(2)
    parts = ["Word", "word", "ABC", "12", "a|b", "!", "x.", "y,", "#", "é", "\n", "\n\n", " ", "$$$", "the cat", "\t"]
    for _ in range(300):
        t = "".join(r.choice(parts) + r.choice(["", " "]) for _ in range(r.randrange(1, 40)))
        b = t.encode()
        w = [x for x in b.replace(b"\n", b" ").replace(b"\t", b" ").split(b" ") if x]
        got = dict(zip(quality.STATISTICS, quality.statistics(t), strict=True))
        if not w:
            assert set(got.values()) == {0.0}
            continue
        share = lambda f: sum(f(bytes([c])) for c in b) / len(b)
        lines = [x for x in b.split(b"\n") if x.strip()]
        n = Counter(b)
        want = {
            "n_words": len(w), "mean_word": sum(map(len, w)) / len(w), "upper": share(lambda c: b"A" <= c <= b"Z"), "upper_words": sum(x.isupper() for x in w) / len(w),
            "digits": share(lambda c: c.isdigit()), "marks": share(lambda c: c in b"#$%&*@^~_=+<>\\{}[]"), "bars": b.count(b"|") / len(w), "bangs": b.count(b"!") / len(w),
            "stops": b.count(b".") / len(w), "commas": b.count(b",") / len(w), "odd": share(lambda c: not (c.isalpha() or c[0] >= 128)), "lines": len(lines),
            "repeated_lines": 1 - len(set(lines)) / len(lines), "longest_line": max(map(len, lines)) / len(b), "distinct_words": len(set(w)) / len(w),
            "top_word": max(Counter(w).values()) / len(w), "short_words": sum(len(x) <= 3 for x in w) / len(w), "odd_ends": sum(x[-1:] in b"#$%&*!|@" for x in w) / len(w),
            "entropy": -sum(k / len(b) * math.log2(k / len(b)) for k in n.values()),
        }
        assert got == pytest.approx(want)
