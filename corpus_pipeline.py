"""Corpus pipeline: toxicity, SimHash near-dedup, secret scan, mixing, SentencePiece encoding.

Each stage takes (spark, docs, sf_dir) and returns a table that is written and read again as the
next one's docs. All but the last keep the columns of documents. Nulls, empty texts, repeated rows
and further columns are handled as the operators state; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import mixing, pieces, secrets, simhash, toxicity
from clickloom.llm.common import dropped, settled, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity lexicon rejects go. It is learned from the labels of sf_dir on the documents given."""
    return toxicity.clean_only(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8) the document with the smallest id stays."""
    return simhash.one_of_each(docs, simhash.NEAR_COPIES)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in its text become a mark, and n_chars follows the text."""
    clean = secrets.redact_secrets(docs)
    n = F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars"))
    return clean.withColumn("n_chars", n)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document stands as often as the mix takes its words: 0 to 3 times."""
    return mixing.repeated(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids and n_tokens of each row."""
    return pieces.encode(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("secret_scan", redact_secrets),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

#: Learned lexicons and fingerprints over fitted codes have no SQL; tests hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's table over the documents of sf_dir; the others are written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        kept = settled(stage(spark, docs, sf_dir))
        if k:
            dropped(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
