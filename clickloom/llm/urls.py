"""URL filter: host and path rules, then a weighted vocabulary matched by Aho-Corasick.

The vocabulary, given or read from a table, has strict terms, one of which rejects, and soft terms with
weights, of which different ones reject together when their weights reach `reject_at`. A term counts where
it stands between two characters that are neither letters nor digits (or at an end of the url), so that
`sex` isn't found in `essex`. Percent-encoded characters are decoded for it (once; what is no UTF-8 becomes
U+FFFD). All terms are matched in one pass over each url, whatever their number, so that time is linear in
the url; of overlapping terms each counts.

A null url and one without `://` has an empty host and path; such a url fits no rule and is judged
by its whole text, a null one as ''. Repeated rows are judged alike; an empty table gives an empty
result; columns other than page_id and url take no part.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The rules of the query, in the order given.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
# An example vocabulary, its soft terms weighing 1 each; callers pass or read their own.
STRICT = ("porn", "porno", "xxx", "viagra", "cialis", "casino", "escort", "camgirls", "hentai", "spam", "warez")
SOFT = ("adult", "bet", "cheap", "click", "dating", "free", "gambling", "loan", "nude", "pharmacy", "pills",
        "poker", "sex", "slots", "torrent", "winner")


@dataclass(frozen=True)
class Vocabulary:
    """strict: one rejects; soft: terms, or (term, weight) pairs; `reject_at`: the sum of the weights of different soft terms that rejects."""

    strict: tuple[str, ...] = STRICT
    soft: tuple[str | tuple[str, float], ...] = SOFT
    reject_at: float = 2.0

    @classmethod
    def from_table(cls, terms: DataFrame, reject_at: float = 2.0, most: int = 100_000) -> Vocabulary:
        """From rows (term, weight); a null weight marks a strict term, of repeated terms the largest weight counts.

        It goes to every task, so more than `most` terms raise. Null and empty terms don't count.
        """
        low = F.lower("term")
        found = terms.where(F.length("term") > 0).groupBy(low.alias("term")).agg(F.max("weight").cast("double").alias("weight"), F.count_if(F.col("weight").isNull()).alias("strict"))
        rows = found.limit(most + 1).collect()
        if len(rows) > most:
            raise ValueError(f"more than {most} terms")
        strict = sorted(r["term"] for r in rows if r["strict"])
        return cls(tuple(strict), tuple(sorted((r["term"], r["weight"]) for r in rows if not r["strict"])), reject_at)

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for term in self.soft:
            name, weight = term if isinstance(term, tuple) else (term, 1.0)
            found.add_word(name.lower(), (name.lower(), weight))
        for name in self.strict:
            found.add_word(name.lower(), (name.lower(), None))
        found.make_automaton()
        return found


def judge(urls: Iterable[str], vocabulary: Vocabulary, automaton: ahocorasick.Automaton) -> Iterator[tuple[int, int, bool]]:
    """For each url: strict hits, different soft terms hit, rejected or not."""
    for url in urls:
        low = (unquote(url) if "%" in url else url).lower()
        strict, soft = 0, {}
        for last, (term, weight) in automaton.iter(low) if len(automaton) else ():
            before, after = last - len(term), last + 1
            if (before < 0 or not low[before].isalnum()) and (after == len(low) or not low[after].isalnum()):
                if weight is None:
                    strict += 1
                else:
                    soft[term] = weight
        yield strict, len(soft), strict > 0 or sum(soft.values()) >= vocabulary.reject_at


def _parts(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(u, instr(u, '://') + 3)")).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, path


def _fits(rule: str) -> Column:
    host, slash, path = rule.partition("/")
    return ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(slash + path)


def filter_urls(pages: DataFrame, rules: Iterable[tuple[str, str]] = RULES, vocabulary: Vocabulary = Vocabulary()) -> DataFrame:
    """page_id, host, path, rule, verdict, n_strict, n_soft for every row of `pages`.

    `rules` are (verdict, host + path); of those that fit a url the longest wins, of equally long
    ones the first. A fixed, short list: it becomes one CASE expression.
    """
    @F.pandas_udf("n_strict long, n_soft long, rejected boolean")
    def by_vocabulary(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = vocabulary.automaton()
        for batch in batches:
            yield pd.DataFrame(list(judge(batch, vocabulary, automaton)), columns=["n_strict", "n_soft", "rejected"])

    ordered = sorted(rules, key=lambda r: -len(r[1]))
    rule, verdict = F.lit(None).cast("string"), F.when(F.col("m.rejected"), "block").otherwise("allow")
    for kind, name in reversed(ordered):
        rule, verdict = F.when(_fits(name), F.lit(name)).otherwise(rule), F.when(_fits(name), F.lit(kind)).otherwise(verdict)
    host, path = _parts(F.col("u"))
    return (
        pages.select("page_id", F.coalesce("url", F.lit("")).alias("u"))
        .withColumns({"host": host, "path": path, "m": by_vocabulary("u")})
        .select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), "m.n_strict", "m.n_soft")
    )
