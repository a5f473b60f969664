"""Min-max scaling and alignment of columns with a model's contract."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit(df: DataFrame, columns: list[str]) -> dict[str, dict[str, float]]:
    """{column: scale, min} that takes the column's range to [0, 1]; a constant column keeps its width. One aggregate; columns only reach the driver."""
    row = df.agg(*(f(c).cast("double").alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("lo", F.min), ("hi", F.max)))).first()
    out = {}
    for i, c in enumerate(columns):
        lo, hi = row[f"lo{i}"] or 0.0, row[f"hi{i}"] or 0.0
        scale = 1 / (hi - lo) if hi > lo else 1.0
        out[c] = {"scale": scale, "min": -lo * scale}
    return out


def scale(df: DataFrame, scaler: Mapping[str, Mapping[str, float]], keep: list[str]) -> DataFrame:
    """`keep` and x * scale + min of each of the scaler's columns, in its order. Missing columns raise."""
    if missing := [c for c in scaler if c not in df.columns]:
        raise ValueError(f"scaler needs columns that aren't there: {missing}")
    return df.select(*keep, *((F.coalesce(F.col(c).cast("double"), F.lit(0.0)) * float(p["scale"]) + float(p["min"])).alias(c) for c, p in scaler.items()))


def load_or_fit(df: DataFrame, columns: list[str], path: str) -> dict[str, dict[str, float]]:
    """The scaler at `path` if its columns are these, else one fitted and written there."""
    try:
        with open(path) as f:
            scaler = json.load(f)
        if list(scaler) == columns:
            return scaler
    except (FileNotFoundError, ValueError):
        pass
    scaler = fit(df, columns)
    with open(path, "w") as f:
        json.dump(scaler, f)
    return scaler


def aligned(df: DataFrame, columns: list[str], keep: list[str]) -> DataFrame:
    """Columns in a model's order; NULL and NaN are 0, infinities +-1e10. Missing columns raise."""
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"model needs columns that aren't there: {missing}")

    def clean(c: str):
        x = F.nanvl(F.coalesce(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0))
        return F.when(F.abs(x) == float("inf"), F.signum(x) * 1e10).otherwise(x).alias(c)

    return df.select(*keep, *map(clean, columns))
