"""Publishing: change detection, metadata, change log by day, histories."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.sources import files

from .scoring import SCORES


def score_text(x: Column) -> Column:
    """Ten significant digits as C's %.10g writes them; '' for NULL. For the text files at the edge only."""

    @F.pandas_udf("string")
    def run(v: pd.Series) -> pd.Series:
        return v.map(lambda n: "" if pd.isna(n) else f"{n:.10g}")

    return run(x.cast("double"))


def changed_scores(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows of `new` without an old row, or with a score that differs; unknown scores are equal to each other."""
    o = old.select(*key, *(F.col(c).alias(f"_old_{c}") for c in SCORES), F.lit(True).alias("_had"))
    same = F.coalesce(F.col("_had"), F.lit(False))
    for c in SCORES:
        same = same & F.col(c).eqNullSafe(F.col(f"_old_{c}"))
    return new.join(o, key, "left").where(~same).select(*new.columns)


def first_known(records: DataFrame, key: list[str], columns: tuple[str, ...], order: str, even_empty: bool = False) -> DataFrame:
    """Of each column the first value of the key that isn't empty, or with `even_empty` the first record's."""
    pick = lambda c: F.min_by(F.col(c), F.when(F.lit(even_empty) | F.coalesce(F.col(c) != "", F.lit(False)), F.col(order)))
    return records.groupBy(*key).agg(*(pick(c).alias(c) for c in columns))


def last_known(records: DataFrame, key: list[str], columns: tuple[str, ...], order: Column) -> DataFrame:
    """Of each column the last value of the key that isn't empty, by `order` (such as file and row)."""
    pick = lambda c: F.max_by(F.col(c), F.when(F.coalesce(F.col(c) != "", F.lit(False)), order))
    return records.groupBy(*key).agg(*(pick(c).alias(c) for c in columns))


def with_metadata(rows: DataFrame, now: DataFrame, before: DataFrame, key: list[str], columns: tuple[str, ...] = ("ip", "user_agent")) -> DataFrame:
    """`rows` with each column from `now`, else from `before`, else ''."""
    n = now.select(*key, *(F.col(c).alias(f"_n_{c}") for c in columns))
    b = before.select(*key, *(F.col(c).alias(f"_b_{c}") for c in columns))
    known = lambda c: F.coalesce(F.nullif(F.col(f"_n_{c}"), F.lit("")), F.nullif(F.col(f"_b_{c}"), F.lit("")), F.lit(""))
    return rows.join(n, key, "left").join(b, key, "left").select(*rows.columns, *(known(c).alias(c) for c in columns))


def history_upsert(existing: DataFrame, now: DataFrame, key: list[str]) -> DataFrame:
    """All rows of `now`, and those of `existing` for other keys."""
    return existing.join(now.select(*key).distinct(), key, "left_anti").unionByName(now, allowMissingColumns=True)


def today_keys(log: DataFrame, day: str, key: list[str]) -> DataFrame:
    """Distinct keys with a session among the log's rows of that day."""
    return log.where(F.col("date").cast("string").startswith(day) & (F.coalesce(F.col("session_id").cast("string"), F.lit("")) != "")).select(*key).distinct()


def pruned_history(existing: DataFrame, delta: DataFrame, log: DataFrame, day: str, key: list[str]) -> DataFrame:
    """Existing rows and the delta's, restricted to the keys that the day's log has."""
    return history_upsert(existing, delta, key).join(today_keys(log, day, key), key, "left_semi")


def combined(parts: dict[str, DataFrame]) -> DataFrame:
    """Union of the devices' tables, with device_type."""
    out = None
    for device, df in sorted(parts.items()):
        tagged = df.withColumn("device_type", F.lit(device))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out


def append_log(delta: DataFrame, path: str, day: str, run: str = "0") -> None:
    """Adds the delta to the day's partition of the change log, as the part of one run; other days and runs stay.

    A run that is tried again writes its own part again, so nothing stands twice.
    """
    delta.write.mode("overwrite").parquet(f"{path}/day={day}/run={run}")


def reset_day(spark, path: str, day: str) -> None:
    """Empties the day's partition; nothing happens where there is none."""
    files.delete(spark, f"{path}/day={day}")


def owns_day(spark, path: str, day: str) -> bool:
    return files.exists(spark, f"{path}/day={day}")
