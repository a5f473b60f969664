"""Look-ups along a session: last K records of a kind, nearest earlier record, records between two others.

All work on (key, order) windows and equality joins on record numbers; none is a range join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def number_kinds(records: DataFrame, key: str, order: list[str], kinds: dict[str, Column]) -> DataFrame:
    """`records` with n_<kind> for each kind: its records so far, this one included."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return records.withColumns({f"n_{k}": F.count(F.when(c, 1)).over(w) for k, c in kinds.items()})


def last_k(numbered: DataFrame, key: str, at: Column, kind: str, is_kind: Column, k: int, keep: list[str], own: list[str]) -> DataFrame:
    """Each row where `at` holds with each of its last k records of the kind: key, `own` of the row, `keep` of the record."""
    n = f"n_{kind}"
    asked = numbered.where(at & (F.col(n) > 0)).select(key, *own, F.explode(F.sequence(F.greatest(F.lit(1), F.col(n) - k + 1).cast("long"), F.col(n))).alias("_i"))
    found = numbered.where(is_kind).select(key, F.col(n).alias("_i"), *(F.col(c).alias(f"h_{c}") for c in keep))
    return asked.join(found, [key, "_i"]).drop("_i")


def nearest_before(records: DataFrame, key: str, order: list[str], is_kind: Column, take: list[str], prefix: str = "prev_") -> DataFrame:
    """`records` with `take` of the nearest earlier record of the kind, NULL without one."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(F.when(is_kind, F.struct(*take)), ignorenulls=True).over(w)
    return records.withColumn("_p", last).select(*records.columns, *(F.col(f"_p.{c}").alias(prefix + c) for c in take))


def between(records: DataFrame, key: str, order: list[str], is_edge: Column, is_inner: Column, value: Column) -> DataFrame:
    """Edges with the number and sum of inner records since the edge before, or since the start: the difference of two running sums."""
    w = Window.partitionBy(key).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = records.withColumns({"_n": F.count(F.when(is_inner, 1)).over(upto), "_s": F.sum(F.when(is_inner, value)).over(upto)})
    edges = run.where(is_edge)
    zero = lambda c: F.coalesce(c, F.lit(0))
    return edges.withColumns(
        {"n_between": F.col("_n") - zero(F.lag("_n").over(w)), "sum_between": zero(F.col("_s")) - zero(F.lag("_s").over(w))}
    ).drop("_n", "_s")


def pause_groups(points: DataFrame, key: str, order: list[str], tm: str, pause: float) -> DataFrame:
    """Points with the number of pauses longer than `pause` before them."""
    w = Window.partitionBy(key).orderBy(*order)
    gap = F.when(F.col(tm) - F.lag(tm).over(w) > pause, 1).otherwise(0)
    return points.withColumn("_gap", gap).withColumn("pauses", F.sum("_gap").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("_gap")
