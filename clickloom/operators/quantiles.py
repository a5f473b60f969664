"""Exact quantiles of many columns by rounds of counts, so that no task holds a column.

A quantile between two ranks lies between two order statistics. Each of these has an interval of values that holds it; a round counts
the values of all intervals in buckets, and the one with the rank becomes the interval, shrunk to its least and
largest value. It ends when these are equal. Rounds cut intervals by logarithm (on both sides of 0) and evenly in turn, so that wide ranges and narrow ones shrink by the
number of buckets. To the driver come counts: at most `BUCKETS` for each order statistic that is still open.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1024


def _flat(df: DataFrame, columns: list[str]) -> DataFrame:
    """(c, x): the known finite values of each column, by its number."""
    each = F.explode(F.array(*(F.struct(F.lit(i).alias("c"), F.col(f"`{c}`").cast("double").alias("x")) for i, c in enumerate(columns)))).alias("v")
    return df.select(each).select("v.*").where("x is not null and not isnan(x) and abs(x) < double('Infinity')")


def quantiles(df: DataFrame, columns: list[str], shares: list[float]) -> dict[str, list[float | None]]:
    """{column: the quantile at each share}, linear between ranks; None for a column without values. `df` is read once a round."""
    flat = _flat(df, columns)
    whole = {r["c"]: r for r in flat.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("a"), F.max("x").alias("b")).collect()}  # a row a column
    ranks = {(c, k): None for c, r in whole.items() for q in shares for k in (math.floor(q * (r["n"] - 1)), math.ceil(q * (r["n"] - 1)))}
    found: dict[tuple[int, int], float] = {}
    spans = {(c, k): (whole[c]["a"], whole[c]["b"], 0) for c, k in ranks}  # least and largest value, values below
    by_log = True
    while True:
        found |= {key: a for key, (a, b, _) in spans.items() if a == b}
        spans = {key: s for key, s in spans.items() if key not in found}
        if not spans:
            break
        for (c, k), counts in _round(flat, spans, by_log).items():
            below = spans[c, k][2]
            for _, n, a, b in sorted(counts):
                if below + n > k:
                    spans[c, k] = (a, b, below)
                    break
                below += n
        by_log = not by_log
    out: dict[str, list[float | None]] = {}
    for i, name in enumerate(columns):
        at = [q * (whole[i]["n"] - 1) for q in shares] if i in whole else []
        out[name] = [found[i, math.floor(p)] + (found[i, math.ceil(p)] - found[i, math.floor(p)]) * (p - math.floor(p)) for p in at] or [None] * len(shares)
    return out


def _round(flat: DataFrame, spans: dict[tuple[int, int], tuple[float, float, int]], by_log: bool) -> dict[tuple[int, int], list[tuple]]:
    """Of each open rank (bucket, number, least, largest) of the values in its interval."""
    rows = [(c, k, a, b) for (c, k), (a, b, _) in spans.items()]
    small = flat.sparkSession.createDataFrame(rows, "c int, k long, a double, b double")
    f = (lambda c: F.signum(c) * F.log1p(F.abs(c))) if by_log else F.col
    share = F.try_divide(f("x") - f("a"), f("b") - f("a"))
    bucket = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * BUCKETS), F.lit(BUCKETS - 1))
    inside = flat.join(F.broadcast(small), "c").where("x between a and b")  # six rows a column at most for three shares
    counted = inside.groupBy("c", "k", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("least"), F.max("x").alias("largest"))
    out: dict[tuple[int, int], list[tuple]] = {}
    for r in counted.collect():
        out.setdefault((r["c"], r["k"]), []).append((r["bucket"], r["n"], r["least"], r["largest"]))
    return out
