"""The corpus pipeline against brute force, stage by stage, over sf0.001."""

from __future__ import annotations

import os
from collections import Counter

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from clickloom.llm import mixing, pieces, secrets, simhash, toxicity  # noqa: E402
from clickloom.llm.common import settled  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, f in corpus_pipeline.STAGES:
        out.append(settled(f(spark, out[-1], SF)))
    return out


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "secret_scan", "mixing", "sentencepiece"]
    for s in stages[1:-1]:
        assert s.schema.names == stages[0].schema.names and s.dtypes == stages[0].dtypes


def test_toxic_documents_go(spark, stages):
    lex = toxicity.learn(stages[0], spark.read.parquet(f"{SF}/labels.parquet"))
    a = lex.automaton()
    want = [r for r in stages[0].collect() if lex.score(lex.total(a, r["text"] or "")[0]) < 0.5]
    assert rows(stages[1]) == sorted(map(tuple, want), key=str) and len(want) < stages[0].count()


def test_near_copies_by_exact_similarity(stages):
    """Of each group that five-word similarities of 0.8 link, over all pairs, the smallest id stays."""
    docs = {r["doc_id"]: r for r in stages[1].collect()}
    ids = sorted(docs)
    sets = {i: set(simhash.shingles(docs[i]["text"] or "", 5).tolist()) for i in ids}
    root = {i: i for i in ids}
    for k, i in enumerate(ids):
        for j in ids[:k]:
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = {x: min(a, b) if r in (a, b) else r for x, r in root.items()}
    assert rows(stages[2]) == sorted((tuple(docs[i]) for i in ids if root[i] == i), key=str)


def test_secrets_are_redacted(stages):
    want = []
    for r in stages[2].collect():
        d = r.asDict()
        d["text"] = secrets.redacted(d["text"], secrets.all_spans(d["text"], secrets.Scan())[1]) if d["text"] else d["text"]
        want.append(tuple(d[c] if c != "n_chars" or d["text"] is None else len(d["text"]) for c in stages[2].columns))
    assert rows(stages[3]) == sorted(want, key=str)


def test_redaction_in_the_stage(spark, stages):
    odd = spark.createDataFrame([(1, "token = abcdefgh", "en", "a", 16), (2, None, "en", "a", 7)], stages[0].schema)
    assert rows(corpus_pipeline.STAGES[2][1](spark, odd, SF)) == [(1, "<secret>", "en", "a", 8), (2, None, "en", "a", 7)]


def test_mix_repeats_documents(stages):
    times = {r["doc_id"]: int(r["taken"] / r["size"] + 0.5) for r in mixing.mix(stages[3]).collect() if r["size"]}
    got = Counter(r["doc_id"] for r in stages[4].collect())
    assert got == {k: v for k, v in times.items() if v}
    assert {tuple(r) for r in stages[4].collect()} <= {tuple(r) for r in stages[3].collect()}


@pytest.mark.skipif(not os.path.exists(pieces.MODEL), reason="no public tokenizer here")
def test_encoding(spark, stages):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    texts = {r["doc_id"]: r["text"] for r in stages[4].collect()}
    assert Counter(r["doc_id"] for r in stages[5].collect()) == Counter(r["doc_id"] for r in stages[4].collect())
    for r in stages[5].collect():
        assert list(r["ids"]) == sp.encode(texts[r["doc_id"]]) and r["round_trip"]
    assert rows(corpus_pipeline.run(spark, SF)) == rows(stages[5])


def test_empty_and_null_rows(spark, stages):
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0), (2, "token = abcdefgh", None, None, 16)], stages[0].schema)
    for docs in (odd, odd.limit(0)):
        n = docs.count()
        for _, f in corpus_pipeline.STAGES:
            docs = settled(f(spark, docs, SF))
        assert docs.count() == 0 if n == 0 else [r["doc_id"] for r in docs.collect()] == [2]
