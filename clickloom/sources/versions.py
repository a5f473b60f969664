"""Tables that are replaced or upserted as a whole step: what a stopped write leaves behind is never read.

`replace` writes a table's next version; the last complete one counts. An upserted table is dealt to buckets by the hash of
its key; an upsert writes a new file set for those buckets only that hold one of its keys, and then a manifest, itself
such a version, that names the folder of each bucket. On a cluster that has a table format with these steps, use that instead.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import delete, exists, names

BUCKETS = 64


def versions(spark: SparkSession, path: str) -> list[str]:
    """Names of the complete versions under `path`, the oldest first; a write that stopped has none."""
    return [n for n in names(spark, path) if n.startswith("v0") and exists(spark, f"{path}/{n}/_SUCCESS")]


def next_version(spark: SparkSession, path: str) -> str:
    had = versions(spark, path)
    return f"v{int(had[-1][1:]) + 1 if had else 1:08d}"


def current(spark: SparkSession, path: str) -> DataFrame | None:
    """The last complete version of the table, or None."""
    had = versions(spark, path)
    return spark.read.parquet(f"{path}/{had[-1]}") if had else None


def replace(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Writes the next version and, once it is complete, deletes those before the last one but it."""
    had = versions(spark, path)
    df.write.mode("overwrite").parquet(f"{path}/{next_version(spark, path)}")
    for name in had[:-1]:
        delete(spark, f"{path}/{name}")


def document(spark: SparkSession, path: str, version: int = -1) -> dict | None:
    """The last document under `path`, or an earlier one."""
    had = versions(spark, path)
    return json.loads(spark.read.parquet(f"{path}/{had[version]}").first()["body"]) if len(had) >= -version else None


def replace_document(spark: SparkSession, body: dict, path: str) -> None:
    replace(spark, spark.createDataFrame([(json.dumps(body),)], "body string").coalesce(1), path)


def _folders(path: str, doc: dict, buckets: list[int] | None) -> list[str]:
    return [f"{path}/data/at={v}/bucket={b}" for b, v in doc["data"].items() if buckets is None or int(b) in buckets]


def upserted(spark: SparkSession, path: str, keys: DataFrame | None = None) -> DataFrame | None:
    """The rows of an upserted table, or None without one; with `keys` (the key's columns) only those of their buckets.

    The buckets, at most as many as the table has, are all that reaches the driver.
    """
    doc = document(spark, f"{path}/manifest")
    if doc is None:
        return None
    wanted = None if keys is None else _touched(keys.select(*doc["key"]), doc["key"], doc["buckets"])
    folders = _folders(path, doc, wanted)
    if not folders:
        some = _folders(path, doc, None)
        if not some:
            return None
        return spark.read.option("basePath", f"{path}/data").parquet(some[0]).drop("at", "bucket").limit(0)
    return spark.read.option("basePath", f"{path}/data").option("mergeSchema", True).parquet(*folders).drop("at", "bucket")


def _bucket(key: list[str], buckets: int):
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def _touched(keys: DataFrame, key: list[str], buckets: int) -> list[int]:
    return sorted(r[0] for r in keys.select(_bucket(key, buckets).alias("b")).distinct().collect())


def upsert(spark: SparkSession, rows: DataFrame, path: str, key: list[str], buckets: int = BUCKETS) -> list[int]:
    """Rows of the keys of `rows` are replaced by them; the others stay. Returns the buckets that were written.

    rows: a table that may be read twice, a row a key.
    """
    doc = document(spark, f"{path}/manifest") or {"key": key, "buckets": buckets, "data": {}, "writes": 0}
    buckets = doc["buckets"]
    touched = _touched(rows, key, buckets)
    if not touched and doc["data"]:
        return []
    had = [f for f in _folders(path, doc, touched)]
    new = rows
    if had:
        old = spark.read.option("basePath", f"{path}/data").option("mergeSchema", True).parquet(*had).drop("at", "bucket")
        new = old.join(rows.select(*key), key, "left_anti").unionByName(rows, allowMissingColumns=True)
    at = doc["writes"] + 1
    new.withColumn("bucket", _bucket(key, buckets)).hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/data/at={at}")
    before = document(spark, f"{path}/manifest")
    now = {**doc, "data": {**doc["data"], **{str(b): at for b in touched}}, "writes": at}
    replace_document(spark, now, f"{path}/manifest")
    used = {v for d in (now, before) if d for v in d["data"].values()}
    for name in names(spark, f"{path}/data"):
        if name.startswith("at=") and int(name[3:]) not in used:
            delete(spark, f"{path}/data/{name}")
    return touched
