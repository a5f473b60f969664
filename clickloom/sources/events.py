"""From log lines to typed records."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Keys of prm.data.e that are evidence of touch.
TOUCH_KEYS = ("tmv", "tst", "ted", "tbb", "tcl", "tbf")
EVENT = """sess STRUCT<a: STRING, c: STRING>, act STRING, ts DOUBLE, date STRING, ip STRING, uri STRUCT<v: STRING>, ua STRUCT<v: STRING>,
  prm STRUCT<tm: DOUBLE, data: STRUCT<e: STRUCT<mmv: STRUCT<l: STRING>, tmv: STRUCT<l: STRING>, scl: STRUCT<l: STRING>, clk: STRING>>>"""
#: What a script takes for false, as JSON text.
FALSY = ("", "0", "-0", "0.0", "false", "null")


def first_mb(node: object) -> bool | None:
    """Whether the first `mb` found, in depth and in the order of keys, is other than the number 0; None if there is none."""
    todo = [node]
    while todo:
        x = todo.pop()
        if isinstance(x, dict):
            if "mb" in x:
                v = x["mb"]
                return isinstance(v, bool) or not isinstance(v, (int, float)) or v != 0
            todo += [v for v in reversed(list(x.values())) if isinstance(v, (dict, list))]
        elif isinstance(x, list):
            todo += [v for v in reversed(x) if isinstance(v, (dict, list))]
    return None


def find_mb() -> F.Column:
    """`mb` of the column `line`, at any depth. Only lines in which the key can stand are parsed for it."""

    @F.pandas_udf("boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([_mb(line) for line in batch], dtype="boolean")

    maybe = F.col("line").contains('"mb"') | F.col("line").contains("\\u00")
    return F.when(maybe, run(F.when(maybe, F.col("line")).otherwise(F.lit("{}"))))


def _mb(line: str) -> bool | None:
    try:
        return first_mb(json.loads(line))
    except (ValueError, RecursionError):
        return None


def parse(logs: DataFrame) -> DataFrame:
    """Typed records of the lines that are JSON objects; others are dropped.

    session_id is NULL where the record has none; tm is NULL or 0 where it has no event time.
    """
    e = F.from_json("line", EVENT, {"mode": "PERMISSIVE"})
    sane = F.try_parse_json("line").isNotNull() & F.col("line").rlike(r"^\s*\{")
    keys = F.json_object_keys(F.get_json_object("line", "$.prm.data.e"))
    truthy = lambda c: F.when(~F.trim(c).isin(*FALSY), c)
    return (
        logs.where(sane)
        .withColumn("r", e)
        .select(
            "site_id",
            "seq",
            truthy(F.col("r.sess.a")).alias("session_id"),
            F.col("r.sess.c").alias("page_id"),
            F.col("r.act").alias("act"),
            F.col("r.prm.tm").alias("tm"),
            F.col("r.ts").alias("ts"),
            F.col("r.date").alias("date"),
            F.col("r.ip").alias("ip"),
            F.coalesce(F.col("r.ua.v"), F.lit("")).alias("ua"),
            F.col("r.uri.v").alias("uri"),
            truthy(F.col("r.prm.data.e.mmv.l")).alias("mmv"),
            truthy(F.col("r.prm.data.e.tmv.l")).alias("tmv"),
            truthy(F.col("r.prm.data.e.scl.l")).alias("scl"),
            truthy(F.col("r.prm.data.e.clk")).isNotNull().alias("clk"),
            F.coalesce(F.arrays_overlap(keys, F.array(*map(F.lit, TOUCH_KEYS))), F.lit(False)).alias("touch"),
            find_mb().alias("mb"),
        )
    )
