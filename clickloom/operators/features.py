"""Session features: aggregation of snapshots, summaries, profiles and correlations.

Means, least and largest values are over absolute values, spreads over signed ones; unknown values are
left out, but one unknown value makes a sum 0. Nothing known counts as 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.expressions import ratio

from .quantiles import quantiles
from .trajectory import features_of

KEY = ["site_id", "device_type", "session_id"]
TYPES = {"mobile": ("tmv_clk", "qml_ready"), "desktop": ("mmv_clk", "qml_ready")}


def _zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def mean(x: Column) -> Column:
    return _zero(F.avg(F.abs(x)))


def least(x: Column) -> Column:
    return _zero(F.min(F.abs(x)))


def largest(x: Column) -> Column:
    return _zero(F.max(F.abs(x)))


def total(x: Column, counted: Column | None = None) -> Column:
    """0 if any value (of the rows that are counted) is unknown."""
    there = F.lit(True) if counted is None else counted
    return F.when(F.bool_or(there & x.isNull()), 0.0).otherwise(_zero(F.sum(F.abs(x))))


def spread(x: Column) -> Column:
    return _zero(F.stddev_pop(x))


FAMILY = {"min": least, "max": largest, "mean": mean, "std": spread}


def family(prefix: str, x: Column, mean_only: bool) -> list[Column]:
    """`prefix`_mean, or all of min, max, mean and std."""
    return [f(x).alias(f"{prefix}_{name}") for name, f in FAMILY.items() if name == "mean" or not mean_only]


def mean_deviation(df: DataFrame, key: list[str], x: str, name: str) -> DataFrame:
    """(key, name): mean distance from the mean, signed values, unknown ones left out. The means are joined back: no group is gathered."""
    known = df.where(F.col(x).isNotNull()).select(*key, x)
    means = known.groupBy(*key).agg(F.avg(x).alias("_m"))
    return known.join(means, key).groupBy(*key).agg(F.avg(F.abs(F.col(x) - F.col("_m"))).alias(name))


def session_features(snaps: DataFrame, device: str, mean_only: bool = True) -> DataFrame:
    """One row a session: 21 columns on mobile, 29 on a desktop, or all statistics with mean_only off.

    snaps: KEY, type, scroll_data and s, of one device. Snapshots of other types leave a row of zeros.
    """
    counts = F.col("type").isin(*TYPES[device])
    rows = snaps.select(*KEY, counts.alias("ok"), F.when(counts, F.col("scroll_data")).alias("scroll_data"), *(F.when(counts, F.col(f"s.{c}")).alias(c) for c in ("n", "ms", "l", *features_of(device), "bot_score")), (counts & F.col("s.is_likely_bot")).alias("likely"))
    b = [c for n in ("n", "ms", "l") for c in family(f"mousemove_prm_data_b_{n}", F.col(n).cast("double"), mean_only)]
    names = (*features_of(device)[:9], "bot_score", *features_of(device)[9:])
    bot = [c for n in names for c in family(n if n.startswith("bot_") else f"bot_{n}", F.col(n), mean_only)]
    share = lambda cond: _zero(F.avg(F.when(F.col("ok"), F.coalesce(cond, F.lit(False)).cast("double"))))
    n_snaps = F.count_if("ok")
    per_session = rows.groupBy(*KEY).agg(
        *b, *bot,
        share(F.col("likely")).alias("bot_is_likely_bot_ratio"),
        F.coalesce(F.sum(F.size(F.coalesce("scroll_data", F.array()))), F.lit(0)).cast("long").alias("scroll_count"),
        _zero(ratio(F.sum(F.aggregate("scroll_data", F.lit(0.0), lambda a, x: a + F.coalesce(F.abs(x), F.lit(0.0)))), F.sum(F.size(F.filter("scroll_data", lambda x: x.isNotNull()))))).alias("scroll_prm_data_mean"),
        n_snaps.alias("mousemove_count"),
        n_snaps.alias("bot_detection_features_count"),
        share(F.col("bot_score") > 0.5).alias("bot_score_above_threshold_ratio"),
        share(F.col("bot_score") > 0.8).alias("bot_score_above_high_threshold_ratio"),
    )
    per_session = per_session.withColumn("ratio_scroll_count_on_mousemove_count", _zero(ratio(F.col("scroll_count"), F.col("mousemove_count"))))
    if mean_only:
        return per_session
    deltas = rows.select(*KEY, F.explode_outer("scroll_data").alias("d"), F.coalesce(F.size("scroll_data"), F.lit(0)).alias("_n"))
    there, d = F.col("_n") > 0, F.col("d")
    scroll = [least(d).alias("scroll_prm_data_min"), largest(d).alias("scroll_prm_data_max"), total(d, there).alias("scroll_prm_data_sum"), spread(d).alias("scroll_prm_data_std")]
    out = per_session.join(deltas.groupBy(*KEY).agg(*scroll), KEY)
    return out.join(mean_deviation(deltas.where(there), KEY, "d", "scroll_prm_data_mad"), KEY, "left").withColumn("scroll_prm_data_mad", _zero(F.col("scroll_prm_data_mad")))


def feature_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in KEY]


def summary(features: DataFrame) -> DataFrame:
    """One row: sessions, with features, mean score, over 0.5, over 0.8, mean likely ratio, classified as bots."""
    score = F.col("bot_score_mean")
    return features.agg(
        F.count(F.lit(1)).alias("total_sessions"),
        F.count_if(F.col("bot_detection_features_count") > 0).alias("sessions_with_features"),
        F.avg(score).alias("avg_bot_score"),
        F.count_if(score > 0.5).alias("high_score_sessions"),
        F.count_if(score > 0.8).alias("very_high_score_sessions"),
        F.avg("bot_is_likely_bot_ratio").alias("avg_likely_bot_ratio"),
        F.count_if(F.col("bot_is_likely_bot_ratio") > 0.5).alias("classified_as_bot"),
    )


def profile(features: DataFrame, columns: list[str]) -> DataFrame:
    """(column, count, mean, std, min, q25, q50, q75, max) with exact quartiles: one aggregate, and rounds of counts for the quartiles."""
    numbers = [F.col(f"`{c}`").cast("double") for c in columns]
    parts = [F.struct(F.lit(c).alias("column"), F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max")) for c, x in zip(columns, numbers, strict=True)]
    flat = features.agg(F.array(*parts).alias("p")).select(F.explode("p").alias("p")).select("p.*")
    found = quantiles(features, columns, [0.25, 0.5, 0.75])
    quartiles = features.sparkSession.createDataFrame([(c, *found[c]) for c in columns], "column string, q25 double, q50 double, q75 double")
    return flat.join(F.broadcast(quartiles), "column").select("column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")  # a row a column


def correlations(features: DataFrame, columns: list[str]) -> DataFrame:
    """(a, b, r): Pearson correlation of each pair of columns, in one aggregate over the rows."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    wide = features.agg(*(F.corr(a, b).alias(f"{i}") for i, (a, b) in enumerate(pairs)))
    return wide.select(F.explode(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{i}`").alias("r")) for i, (a, b) in enumerate(pairs)))).alias("x")).select("x.*")


def restrict(rows: DataFrame, changed: DataFrame, key: str = "session_id") -> DataFrame:
    """Rows of changed sessions only. `changed` has one row a session; Spark broadcasts it if its size allows."""
    return rows.join(changed.select(key).distinct(), key, "left_semi")


def upsert(existing: DataFrame, updated: DataFrame, key: list[str]) -> DataFrame:
    """Rows of `existing` whose key isn't updated, and those of `updated`, of which the last by `_order` stays if there is one."""
    if "_order" in updated.columns:
        updated = last_by_key(updated, key, "_order").drop("_order")
    return existing.join(updated.select(*key).distinct(), key, "left_anti").unionByName(updated, allowMissingColumns=True)


def last_by_key(df: DataFrame, key: list[str], order: str) -> DataFrame:
    w = Window.partitionBy(*key).orderBy(F.col(order).desc())
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
