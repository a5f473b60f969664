"""Device routing of sessions and records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ["site_id", "session_id"]


def session_devices(records: DataFrame) -> DataFrame:
    """(site_id, session_id, has_mb, mapped): what all records of a session say; `mapped` is mobile or not, or NULL.

    A touch session that never carried `mb` is mobile; else the last page-ready record with an `mb` decides.
    """
    ready = F.when(F.col("act") == "qml.ready", F.col("mb"))
    seen = records.where("session_id is not null").groupBy(*KEY).agg(
        F.bool_or(F.col("mb").isNotNull()).alias("has_mb"),
        F.bool_or("touch").alias("touched"),
        F.max_by(ready, F.when(ready.isNotNull(), F.col("seq"))).alias("last_mb"),
    )
    mapped = F.when(F.col("touched") & ~F.col("has_mb"), F.lit(True)).otherwise(F.col("last_mb"))
    return seen.select(*KEY, "has_mb", mapped.alias("mapped"))


def route(records: DataFrame) -> DataFrame:
    """`records` with device_type: the session's, else by the record's own `mb`, else mobile on touch without any `mb`, else desktop."""
    r, d = records.alias("r"), session_devices(records).alias("d")
    joined = r.join(d, (F.col("r.site_id") == F.col("d.site_id")) & (F.col("r.session_id") == F.col("d.session_id")), "left")
    own_touch = F.col("r.session_id").isNotNull() & ~F.coalesce(F.col("d.has_mb"), F.lit(False)) & F.col("r.touch")
    mobile = F.coalesce(F.col("d.mapped"), F.col("r.mb"), own_touch)
    return joined.select("r.*", F.when(mobile, "mobile").otherwise("desktop").alias("device_type"))
